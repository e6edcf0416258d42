"""Runtime catalog from many sources in priority order (SRC-6).

Each source carries its own priority. ``*.yaml`` files are read document by document
(``yaml_docs``), all others line by line as JSON. Documents are parsed with PERMISSIVE
``from_json`` (a bad document becomes one reject, never an error), first-wins per name (WIN-1), then the
built-in defaults (JON-5). A
source that can't be read is a reject too. Remote sources (github, http) are
not fetched here: land their files first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparksweep.operators.catalog import FRAMEWORK_LABEL, RUNTIME_DOC_SCHEMA, first_wins, parse_runtime_documents, with_defaults
from sparksweep.operators.datasets import glob_to_regex
from sparksweep.session import shared_dir
from sparksweep.sources import yaml_docs

# fixed values: schemes of landed folders
LANDED = ("file://", "hdfs://", "s3a://", "abfs://", "abfss://", "gs://", "viewfs://")


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def _folder(spark: SparkSession, path: str) -> str:
    """The folder's full URI as the file system writes it."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(p).toString().rstrip("/")


REMOTE = ("github://", "http://", "https://")
NOTHING = "name string, framework string, num_nodes bigint, image string, prio int"


def _documents(spark: SparkSession, path: str, glob: str | None) -> DataFrame:
    """(file_path, at, line_no, raw, doc, error) of the YAML files and the JSON lines of a folder or file."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    is_yaml = F.col("_metadata.file_name").endswith(".yaml")  # prunes whole files
    lines = reader.text(path).where(~is_yaml).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("line_no"),
        F.col("value").alias("raw"), F.col("value").alias("doc"), F.lit(None).cast("string").alias("error")).where(F.trim("raw") != "")
    return lines.unionByName(yaml_docs.read_documents(spark, path).where(F.lit(True) if glob is None else F.regexp_extract(
        "file_path", r"([^/]*)$", 1).rlike(glob_to_regex(glob))))


def load_catalog(spark: SparkSession, sources: list[str], defaults: DataFrame | None = None,
                 glob: str | None = None, framework_label: str = FRAMEWORK_LABEL):
    """Returns (runtimes, rejects). ``sources`` are folders or files in priority order,
    each read on its own, a document a row, so a large file is
    split over many tasks. ``rejects`` (prio, source, file_path, doc, error) has
    the documents that fail a check and the sources that can't be read: remote
    ones (land their files first), unknown schemes and missing folders."""
    parts, skipped = [], []
    for prio, src in enumerate(sources):
        if src.startswith(REMOTE):
            skipped.append((prio, src, "remote source is not fetched"))
        elif "://" in src and not src.startswith(LANDED):
            skipped.append((prio, src, "unsupported scheme"))
        elif not _exists(spark, src):
            skipped.append((prio, src, "no such folder"))
        else:
            parts.append(_documents(spark, _folder(spark, src), glob).select(
                F.lit(prio).alias("prio"), F.lit(src).alias("source"), "*"))
    lost = spark.createDataFrame(skipped, "prio int, source string, error string").select(
        "prio", "source", F.lit(None).cast("string").alias("file_path"), F.lit(None).cast("string").alias("doc"), "error")
    if not parts:
        empty = spark.createDataFrame([], NOTHING)
        return (with_defaults(empty, defaults) if defaults is not None else empty), lost
    docs = reduce(DataFrame.unionByName, parts).withColumnRenamed("error", "unread")
    order = ["prio", "file_path", "at", "line_no"]
    parsed = parse_runtime_documents(docs, "doc", keep=[*order, "source", "raw", "unread"], framework_label=framework_label)
    parsed = parsed.withColumn("error", F.coalesce("unread", "error")).withColumnRenamed("raw", "doc")
    valid = parsed.filter(F.col("error").isNull())
    rejects = parsed.filter(F.col("error").isNotNull()).select("prio", "source", "file_path", "doc", "error").unionByName(lost)
    winners = first_wins(valid.select("name", *order, "framework", "num_nodes", "image"), "name", order)
    runtimes = winners.select("name", "framework", "num_nodes", "image", "prio")
    if defaults is not None:  # which reads the winners twice: written, so that the documents are parsed once
        path = shared_dir(spark, "catalog-winners")
        runtimes.write.parquet(path)
        runtimes = spark.read.schema(runtimes.schema).parquet(path)
        runtimes = with_defaults(runtimes, defaults)
    return runtimes, rejects


def yaml_text(doc: Column) -> Column:
    """A runtime document (a struct as ``parse_runtime_documents`` reads it from JSON) in YAML's block style."""
    def q(c: Column) -> Column:  # single quoted, so that no value is taken for another type
        return F.concat(F.lit("'"), F.replace(c, F.lit("'"), F.lit("''")), F.lit("'"))

    def line(indent: int, key: str, value: Column) -> Column:
        return F.concat(F.lit(" " * indent + key + ": "), q(value), F.lit("\n"))

    def pairs(indent: int, of: Column) -> Column:
        return F.array_join(F.transform(F.map_entries(of), lambda e: F.concat(F.lit(" " * indent), q(e["key"]), F.lit(": "), q(e["value"]), F.lit("\n"))), "")

    def rjob(j: Column) -> Column:
        return F.concat(F.lit("      - name: "), q(j["name"]), F.lit("  # replicated job\n        template:\n"),
                        F.coalesce(F.concat(F.lit("          metadata:\n            labels:\n"), pairs(14, j["template"]["metadata"]["labels"])), F.lit("")),
                        F.lit("          spec:\n            template:\n              spec:\n                containers:\n"),
                        F.array_join(F.transform(j["template"]["spec"]["template"]["spec"]["containers"], lambda c: F.concat(
                            F.lit("                - "), F.lit("name: "), q(c["name"]), F.lit("\n"),
                            F.coalesce(line(18, "image", c["image"]), F.lit("")))), ""))

    policy = doc["spec"]["mlPolicy"]
    held = F.concat(F.coalesce(F.concat(F.lit("    numNodes: "), policy["numNodes"], F.lit("\n")), F.lit("")),
                    *[F.coalesce(F.concat(F.lit(f"    {k}:\n"), pairs(6, policy[k])), F.lit("")) for k in ("torch", "mpi")])
    labels = doc["metadata"]["labels"]
    return F.concat(
        line(0, "kind", doc["kind"]), F.lit("metadata:\n"), F.coalesce(line(2, "name", doc["metadata"]["name"]), F.lit("")),
        F.when(F.size(labels) > 0, F.concat(F.lit("  labels:\n"), pairs(4, labels))).otherwise(F.lit("  labels: {}\n")),
        F.lit("spec:\n"), F.when(held != "", F.concat(F.lit("  mlPolicy:\n"), held)).otherwise(F.lit("  mlPolicy: {}\n")),
        F.lit("  template:\n    spec:\n      replicatedJobs:\n"),
        F.array_join(F.transform(doc["spec"]["template"]["spec"]["replicatedJobs"], rjob), ""))


def write_catalog_sources(catalog_docs: DataFrame, base: str, style: str = "json") -> list[str]:
    """Land documents as JSON lines or as YAML files of many documents, one folder per priority,
    rows in position order across the sorted file names."""
    ordered = (catalog_docs.select("prio", "pos", "doc")
               .repartitionByRange("prio", "pos").sortWithinPartitions("prio", "pos").select("prio", "doc"))
    if style == "yaml":  # after the exchange, whose sampling would render the texts once more
        doc = yaml_text(F.from_json("doc", RUNTIME_DOC_SCHEMA))
        ordered = ordered.withColumn("doc", F.concat(F.lit("---\n"), F.regexp_replace(doc, "\n$", "")))
    ordered.write.partitionBy("prio").mode("overwrite").text(base)
    # the source folders are read back from the file system listing (metadata,
    # one entry per source), not collected from the data
    spark = catalog_docs.sparkSession
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(base)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    prios = sorted(int(st.getPath().getName().split("=", 1)[1]) for st in fs.listStatus(root)
                   if st.isDirectory() and st.getPath().getName().startswith("prio="))
    folders = [f"{base}/prio={p}" for p in prios]
    if style == "yaml":  # the text writer names its files .txt
        Path = jvm.org.apache.hadoop.fs.Path
        for f in (st.getPath() for folder in folders for st in fs.listStatus(Path(folder)) if st.getPath().getName().endswith(".txt")):
            fs.rename(f, Path(f.getParent(), f.getName().removesuffix(".txt") + ".yaml"))
    return folders
