"""Corpus pipeline over ``documents``: quality rules, line dedup, n-gram Jaccard
join, benchmark decontamination, mixing to target weights.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, with the columns of documents in all stages but the last.
``run`` applies them in order, writing each stage's rows as Parquet below the
shared checkpoint folder and reading them again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparksweep.llm import decontamination, jaccard_join, line_dedup, mixing, quality_rules, queries
from sparksweep.session import shared_dir, ship_package

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the default policy rejects: null, empty and wordless texts among them. Each row is judged on its
    own, so repeated rows stay or go together; columns beside those of documents are left out; an empty table stays empty."""
    ship_package(spark)
    return quality_rules.keep(docs.select(*COLUMNS))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut boilerplate lines; a document stays, also with little or no text left. Null and empty texts stay as they are; of
    rows with one line the smallest id keeps it, repeated rows of that id all do; n_chars is counted anew."""
    ship_package(spark)
    out = line_dedup.remove_boilerplate(docs)
    return out.withColumns({"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast("long")}).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near copies; of rows with equal id and text one. Texts
    without words (null, empty) are no copies of each other and stay; a row without id is ordered by its text's hash."""
    ship_package(spark)
    return jaccard_join.one_of_each(docs).select(*COLUMNS)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a window of a benchmark item. Null and empty texts hold none; repeated rows go together;
    an empty benchmark drops nothing."""
    ship_package(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.find_items(docs, benchmark).where("n_hit = 0").select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or thin the sources to their target weights, in shuffled order. A null source is a source; repeated rows
    draw the same count; a row without id draws by its text; adds rate, copy_no and shuffle_key."""
    ship_package(spark)
    return mixing.mix_sources(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_leaks),
    ("mixing to target weights", mix),
]

_STAGE_SQL = [
    ("s1", "WITH " + queries.QUALITY_CTES + """
        SELECT d.doc_id, text, lang, source, n_chars FROM bits b
        JOIN (SELECT row_number() OVER () AS rid, * FROM DOCS) d ON d.rid = b.rid WHERE (fail_bits & 63) = 0"""),
    ("s2", "WITH " + queries.LINE_CTES + """
        SELECT doc_id, CASE WHEN n_removed > 0 THEN clean_text ELSE text END AS text, lang, source,
               length(CASE WHEN n_removed > 0 THEN clean_text ELSE text END) AS n_chars FROM d LEFT JOIN k USING (rid)"""),
    ("s3", "WITH RECURSIVE " + queries.NEAR_CTES + """
        SELECT doc_id, text, lang, source, n_chars FROM d JOIN cls USING (rid) WHERE doc_id = class_id"""),
    ("s4", "WITH " + queries.LEAK_CTES + """
        SELECT doc_id, text, lang, source, n_chars FROM d LEFT JOIN c USING (rid) WHERE n_hit IS NULL"""),
]
ORACLE_SQL = "WITH " + ",\n".join(
    f"{name} AS MATERIALIZED ({sql.replace('DOCS', before)})"
    for (name, sql), before in zip(_STAGE_SQL, ["documents", "s1", "s2", "s3"], strict=True)
) + ",\n" + queries.MIX_SQL.strip().removeprefix("WITH ").replace("DOCS", "s4")


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = shared_dir(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
