"""Source URIs (SRC-2, JOB-2): classify, validate and resolve to a scan.

Everything is a Column expression, so a table of millions of URIs is
classified inside the scan stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparksweep.operators.jobs import last_wins_map

# fixed values: where downloaded data lands and the catalog source schemes
DATASET_PATH = "/workspace/dataset"
MODEL_PATH = "/workspace/model"
HOST_RE = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"
PATH_RE = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def catalog_source(url: Column):
    """JOB-2 / the catalog loader's rule: (type, path) for github://, https://,
    http://, file:// and absolute paths; anything else is rejected (type NULL)."""
    t = (F.when(url.startswith("github://"), F.lit("github")).when(url.startswith("https://"), F.lit("https"))
         .when(url.startswith("http://"), F.lit("http")).when(url.startswith("file://"), F.lit("file"))
         .when(url.startswith("/"), F.lit("file")))
    p = (F.when(url.startswith("github://"), F.substring(url, 10, 1 << 30))
         .when(url.startswith("file://"), F.substring(url, 8, 1 << 30))
         .when(t.isNotNull(), url))
    return t, p


def classify_sources(df: DataFrame, url_col: str) -> DataFrame:
    t, p = catalog_source(F.col(url_col))
    return df.withColumn("source_type", t).withColumn("path", p).withColumn(
        "error", F.when(F.col("source_type").isNull(), F.lit("unsupported source scheme")))


def inventory(df: DataFrame, url_col: str) -> DataFrame:
    """JOB-2: per scheme and host the URIs and their distinct paths. Paths are
    made distinct before they are counted, so a host with a third of all URIs
    is spread over many tasks."""
    url = F.col(url_col)
    parts = df.select(F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)).alias("scheme"),
                      F.lower(F.regexp_extract(url, HOST_RE, 1)).alias("host"), F.regexp_extract(url, PATH_RE, 1).alias("path"))
    return parts.groupBy("scheme", "host", "path").agg(F.count(F.lit(1)).alias("n")).groupBy("scheme", "host").agg(
        F.sum("n").alias("uris"), F.count("path").alias("paths"))


def dataset_arg(url: Column) -> Column:
    """The dataset path rule: the path after the first segment is a file when it
    contains a dot (``dataset.data_files``), else a directory
    (``dataset.data_dir``). A source without a scheme is a hub name (hf://)."""
    full = F.when(url.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), url).otherwise(F.concat(F.lit("hf://"), url))
    parts = F.split(F.regexp_replace(F.regexp_extract(full, PATH_RE, 1), r"^/+|/+$", ""), "/")
    rel = F.when(F.size(parts) > 1, F.array_join(F.slice(parts, 2, 1 << 30), "/")).otherwise(F.lit("."))
    is_file = (rel != ".") & rel.contains(".")
    target = F.concat(F.lit(DATASET_PATH + "/"), rel)
    return F.when(is_file, F.concat(F.lit("dataset.data_files="), target)).otherwise(
        F.concat(F.lit("dataset.data_dir="), target))


def options_text(m: Column) -> Column:
    """A MAP<STRING,STRING> as sorted ``K=V`` text joined by ``;``."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="),
                                                                                       e["value"]))), ";")


def option_map(raw: Column) -> Column:
    """Initializer options as the job sees them: keys upper-cased, NULL values
    dropped (lists are joined with commas by the caller). Of keys that differ in case only the last one counts."""
    items = F.transform(F.filter(F.map_entries(raw), lambda e: e["value"].isNotNull()),
                        lambda e: F.struct(F.upper(e["key"]).alias("key"), e["value"].alias("value")))
    return last_wins_map(items, "key", "value")


def resolve(uri: Column, num_data_nodes: Column | None = None, mounts: dict | None = None):
    """SRC-2: (kind, scan, error) for hf://owner/name[/path], s3://bucket/key
    and cache://schema/table. hf needs a path after the host; cache needs
    exactly two parts and more than one data node. ``mounts`` maps a scheme to
    the base path the landed files live under."""
    mounts = mounts or {"hf": "/mnt/hf"}
    host = F.regexp_extract(uri, HOST_RE, 1)
    path = F.regexp_extract(uri, PATH_RE, 1)
    cache_parts = F.split(F.regexp_replace(uri, r"^cache://", ""), "/")
    kind = (F.when(uri.startswith("hf://"), F.lit("hf")).when(uri.startswith("s3://"), F.lit("s3"))
            .when(uri.startswith("cache://"), F.lit("cache")))
    nodes_ok = F.lit(True) if num_data_nodes is None else F.coalesce(num_data_nodes > 1, F.lit(False))
    err = (F.when(kind.isNull(), F.lit("unsupported scheme"))
           .when((kind == "hf") & (path == ""), F.lit("hf uri needs hf://<owner>/<name>"))
           .when((kind == "cache") & (F.size(cache_parts) != 2), F.lit("cache uri needs cache://<schema>/<table>"))
           .when((kind == "cache") & ~nodes_ok, F.lit("num_data_nodes must be greater than 1")))
    scan = (F.when(kind == "hf", F.concat(F.lit(mounts["hf"] + "/"), host, path))
            .when(kind == "s3", F.regexp_replace(uri, r"^s3://", "s3a://"))
            .when(kind == "cache", F.array_join(cache_parts, ".")))
    return kind, F.when(err.isNull(), scan), err


def mount_paths(uris: DataFrame, mounts: DataFrame, uri_col: str = "uri") -> DataFrame:
    """SRC-2 with a mount table: ``mounts`` (scheme, host, base), one row per
    (scheme, host), says where the files of a scheme and host were landed; each
    URI gets ``local_path`` = base + host + path. A host-specific mount wins over
    the scheme-wide one (host NULL). Two left joins keep the URI rows one to
    one; Spark broadcasts the mount table if its byte threshold allows."""
    u = (uris.withColumn("_scheme", F.regexp_extract(F.col(uri_col), r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
         .withColumn("_host", F.regexp_extract(F.col(uri_col), HOST_RE, 1))
         .withColumn("_path", F.regexp_extract(F.col(uri_col), PATH_RE, 1)))
    by_host = (mounts.filter(F.col("host").isNotNull()).select(
        F.col("scheme").alias("_s1"), F.col("host").alias("_h1"), F.col("base").alias("_b1")))
    by_scheme = (mounts.filter(F.col("host").isNull()).select(
        F.col("scheme").alias("_s2"), F.col("base").alias("_b2")))
    x = (u.join(by_host, (u["_scheme"] == by_host["_s1"]) & (u["_host"] == by_host["_h1"]), "left")
         .join(by_scheme, u["_scheme"] == by_scheme["_s2"], "left"))
    base = F.coalesce(F.col("_b1"), F.col("_b2"))
    path = F.when(base.isNotNull(), F.concat(F.regexp_replace(base, "/+$", ""), F.lit("/"), F.col("_host"),
                                              F.col("_path")))
    return x.select(*uris.columns, path.alias("local_path"))
