"""Removal of boilerplate lines by their spread over sites.

A line is normalised (ASCII letters lower-cased, runs of white space made one
space, trimmed) and hashed. Per line hash, a HyperLogLog sketch of the sites it
occurs on is built in every task and the sketches are merged by aggregation,
so a line that a third of all rows hold costs one small sketch per task. An
estimate that is clearly below or above ``min_sites`` decides; lines whose estimate lies
within ``sigmas`` standard errors of it get an exact distinct count. Lines on
``min_sites`` sites or more are boilerplate and are cut from all documents but
the one with the smallest id that holds them, so that a text that was copied to
many sites is not lost with its last copy (``keep_first=False`` cuts there too).

Defined results: a null text has no lines and stays null; empty lines and lines
below ``min_chars`` characters are kept; a null site counts as one site; repeated rows add
nothing to the spread of a line, and rows that share the smallest id all keep
it; a row without id never keeps a boilerplate line; a document may end up with an empty text; an
empty table gives an empty result. Clashing column names of the input are
replaced by the operator's, other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparksweep.llm.batch import drop_columns
from sparksweep.session import shared_dir

MIN_SITES = 8
MIN_CHARS = 12
LG_K = 12
SIGMAS = 4.0
ADDED = ("n_lines", "n_removed", "clean_text", "_id", "_th", "_cut", "_lines", "_kept")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_hashes(text: Column, min_chars: int) -> Column:
    """A 64-bit hash per normalised line; null for lines that are too short to judge."""
    normal = F.regexp_replace(F.translate(text, UPPER, LOWER), r"[ \t\r\f\x0B]+", " ")
    return F.transform(F.split(normal, "\n"), lambda x: F.when(
        F.length(F.btrim(x)) >= min_chars, F.xxhash64(F.btrim(x))))


def line_table(docs: DataFrame, text: str = "text", site: str = "source", doc_id: str = "doc_id",
               min_chars: int = MIN_CHARS) -> DataFrame:
    """Per row: id, hash of the text, site and the hashes of its lines. Written to the
    shared folder, as every later step reads it, and none reads the texts for it."""
    spark = docs.sparkSession
    path = shared_dir(spark, "line-hashes")
    docs.select(F.col(doc_id).alias("_id"), F.xxhash64(F.col(text)).alias("_th"),
                F.coalesce(F.concat(F.lit("s"), F.col(site).cast("string")), F.lit("null")).alias("site"),
                line_hashes(F.col(text), min_chars).alias("hashes")).write.parquet(path)
    return spark.read.parquet(path)


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K, sigmas: float = SIGMAS) -> DataFrame:
    """The lines of a line table that occur on ``min_sites`` sites or more: hash h, smallest id ``first``."""
    lines = lines.select("site", "_id", F.explode(F.array_distinct("hashes")).alias("h")).where("h is not null")
    spread = lines.groupBy("h").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", lg_k)).alias("sites"),
                                    F.min("_id").alias("first"))
    margin = max(1.0, sigmas * 1.04 / 2 ** (lg_k / 2) * min_sites)
    likely = spread.where(F.col("sites") >= min_sites - margin)
    sure = likely.where(F.col("sites") > min_sites + margin).select("h", "first")
    near = likely.where(F.col("sites") <= min_sites + margin).select("h", "first")
    pairs = lines.groupBy("h", "site").agg(F.lit(1).alias("one"))  # a hot line is down to its sites before the join
    exact = pairs.join(near, "h").groupBy("h", "first").agg(F.count("one").alias("n")).where(F.col("n") >= min_sites)
    return sure.unionByName(exact.select("h", "first"))


def remove_boilerplate(docs: DataFrame, text: str = "text", site: str = "source", doc_id: str = "doc_id",
                       min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS, lg_k: int = LG_K,
                       sigmas: float = SIGMAS, keep_first: bool = True) -> DataFrame:
    """Add n_lines, n_removed (long) and clean_text to every row.

    Lines travel as hashes and places: the places to cut come back to a row
    as one array, keyed by its id and the hash of its text."""
    docs = drop_columns(docs, ADDED)
    lines = line_table(docs, text, site, doc_id, min_chars)
    path = shared_dir(docs.sparkSession, "boilerplate")  # a table of known size: the join with hot lines can be split
    boilerplate(lines, min_sites, lg_k, sigmas).write.parquet(path)
    bad = docs.sparkSession.read.parquet(path)
    own = lines.select("_id", "_th", F.posexplode("hashes").alias("place", "h")).where("h is not null")
    cut = own.join(bad, "h")
    if keep_first:
        cut = cut.where(F.col("_id").isNull() | ~F.col("_id").eqNullSafe(F.col("first")))
    cut = cut.groupBy("_id", "_th").agg(F.collect_set("place").alias("_cut"))
    out = docs.withColumn("_th", F.xxhash64(F.col(text)))
    out = out.join(cut.withColumnRenamed("_th", "_th2"), F.col(doc_id).eqNullSafe(F.col("_id")) & (F.col("_th") == F.col("_th2")), "left")
    out = out.withColumn("_lines", F.split(text, "\n")).withColumn("_kept", F.when(F.col("_cut").isNull(), F.col("_lines")).otherwise(
        F.filter("_lines", lambda x, i: ~F.array_contains("_cut", i))))
    return out.withColumns({
        "n_lines": F.coalesce(F.size("_lines"), F.lit(0)).cast("long"),
        "n_removed": F.coalesce(F.size("_lines") - F.size("_kept"), F.lit(0)).cast("long"),
        "clean_text": F.when(F.col("_cut").isNull(), F.col(text)).otherwise(F.array_join("_kept", "\n")),
    }).drop("_id", "_th", "_th2", "_cut", "_lines", "_kept")
