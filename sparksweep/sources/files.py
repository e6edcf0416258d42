"""Files as rows: listing, content hashes, differences of two manifests (SRC-3).

Folders are rows: each round lists the folders found in the round before, in tasks, until none is left, so the
number of rounds is the depth of the tree and no listing runs on the driver. A file's hash is read in chunks, so
its size doesn't matter for memory. Files are reached through ``pyarrow.fs`` (local, S3, GCS, Azure, HDFS).
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparksweep.operators.datasets import choose_files
from sparksweep.session import shared_dir, ship_package

CHUNK = 8 << 20
LISTED = "path string, is_dir boolean, size bigint, mtime timestamp"


def qualified(spark: SparkSession, path: str) -> str:
    """A path as a full URI for ``pyarrow.fs``. ``s3a://`` is pyarrow's ``s3://``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    uri = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toUri()
    root = f"{uri.getScheme()}://{uri.getAuthority() or ''}" + quote(uri.getPath())
    return "s3" + root[3:] if root.startswith("s3a:") else root


def _open(root: str):
    from pyarrow import fs

    filesystem, base = fs.FileSystem.from_uri(root)
    return filesystem, base.rstrip("/")


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path relative to the folder, size, mtime) of all files below it."""
    ship_package(spark)
    root = qualified(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        filesystem, base = _open(root)
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                found = filesystem.get_file_info(fs.FileSelector(f"{base}/{folder}".rstrip("/")))
                kind = [f.type == fs.FileType.Directory for f in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f.path[len(base):].lstrip("/") for f in found], pa.string()), pa.array(kind, pa.bool_()),
                     pa.array([None if d else f.size for f, d in zip(found, kind, strict=True)], pa.int64()),
                     pa.array([f.mtime for f in found], pa.timestamp("us", "UTC"))], ["path", "is_dir", "size", "mtime"])

    rounds, folders, left = [], spark.createDataFrame([("",)], "path string"), 1
    while left:
        at = shared_dir(spark, "listing")
        spread = min(left, spark.sparkContext.defaultParallelism * 16)
        folders.select("path").repartition(spread).mapInArrow(run, LISTED).write.parquet(at)
        rounds.append(spark.read.parquet(at))
        folders = rounds[-1].where("is_dir")
        left = folders.count()
    return reduce(DataFrame.unionByName, rounds).where("not is_dir").drop("is_dir")


def file_manifest(spark: SparkSession, path: str, patterns: list[str] | None = None, with_hash: bool = True) -> DataFrame:
    """Manifest (path, name, size, mtime, sha256) of the files that survive the ignore patterns
    (None: the defaults). Only these files' contents are read; a file that goes away meanwhile has no hash."""
    root = qualified(spark, path)
    files = choose_files(list_files(spark, path).withColumn("name", F.substring_index("path", "/", -1)), "name", patterns)
    files = files.select("path", "name", "size", "mtime")
    if not with_hash:
        return files.withColumn("sha256", F.lit(None).cast("string"))

    def digest(stream) -> str:
        held = hashlib.sha256()
        while chunk := stream.read(CHUNK):
            held.update(chunk)
        return held.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = _open(root)
        for batch in batches:
            out: list[str | None] = []
            for name in batch.column("path").to_pylist():
                try:
                    with filesystem.open_input_stream(f"{base}/{name}") as stream:
                        out.append(digest(stream))
                except FileNotFoundError:
                    out.append(None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], [*batch.schema.names, "sha256"])

    ship_package(spark)
    spread = max(1, min(files.count(), spark.sparkContext.defaultParallelism * 16))  # counted from the written listing
    return files.repartition(spread).mapInArrow(run, "path string, name string, size bigint, mtime timestamp, sha256 string")


def manifest_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """(path, change, old_size, size, sha256) of the files that were added, changed or are gone. Files are compared by
    hash if both manifests have it, else by size and time. One join by path."""
    a, b = old.alias("a"), new.alias("b")
    hashes = F.col("a.sha256").isNotNull() & F.col("b.sha256").isNotNull()
    same = F.when(hashes, F.col("a.sha256") == F.col("b.sha256")).otherwise(
        F.col("a.size").eqNullSafe(F.col("b.size")) & F.col("a.mtime").eqNullSafe(F.col("b.mtime")))
    change = (F.when(F.col("a.path").isNull(), F.lit("added")).when(F.col("b.path").isNull(), F.lit("gone")).when(~same, F.lit("changed")))
    return a.join(b, F.col("a.path") == F.col("b.path"), "full").select(
        F.coalesce("b.path", "a.path").alias("path"), change.alias("change"), F.col("a.size").alias("old_size"), F.col("b.size").alias("size"),
        F.col("b.sha256").alias("sha256")).where("change is not null")


def write_files(rows: DataFrame, path: str) -> int:
    """Write each row (path, content binary) as a file below ``path``, in tasks; a file appears whole, under
    its name, so a retried task changes nothing. Returns the number of files."""
    spark = rows.sparkSession
    ship_package(spark)
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(jpath)
    root = qualified(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = _open(root)
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                final = f"{base}/{name}"
                filesystem.create_dir(final.rsplit("/", 1)[0], recursive=True)
                held = f"{base}.tmp-{uuid.uuid4().hex}"
                with filesystem.open_output_stream(held) as out:
                    out.write(content.as_buffer())
                filesystem.move(held, final)
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    return rows.select("path", "content").mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0
