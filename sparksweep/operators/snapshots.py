"""Registration and deletion over a log of snapshots (SNK-1, SNK-2).

A set of tables lives in one folder. Rows lie in parquet files below ``data``, dealt by a hash of the table's key
into buckets; a manifest (parquet) lists the files of a version with their bucket and range of keys; a file
``versions/<number>.<manifest>`` publishes it. Files are never changed: an operation writes new files, then
a manifest, then the empty version file, whose creation is the commit. Whatever happens before leaves the tables as
they were, and running the operation again gives the same tables; a deletion over several tables
is one commit. Readers keep the version they have read until ``vacuum``.

Registration and deletion read only files that may hold one of the keys: the same bucket and a range
that contains it. The driver sees file names, as Spark's own file index does, and no rows.

One writer at a time is the rule: of two that publish the same number, the one whose manifest's name sorts last
withdraws its version and raises.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparksweep.operators.sinks import first_rows
from sparksweep.session import shared_dir, ship_package

BUCKET = "_bucket"
ENTRY = "tbl string, key string, schema string, file string, bucket int, low string, high string, n bigint"


class Conflict(RuntimeError):
    """Another writer has published the same version."""


def _ranges(batches):
    """File, bucket, range of keys and rows of each file in a batch: the aggregation behind it sorts a row per
    batch and file (texts as minima are not aggregated by hash), not a row per key."""
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        found = []
        for file in pc.unique(batch.column("file")).to_pylist():
            part = batch.filter(pc.equal(batch.column("file"), file))
            ends = pc.min_max(part.column("k")).as_py()
            found.append({"file": file, "bucket": part.column("bucket")[0].as_py(), "low": ends["min"], "high": ends["max"], "n": part.num_rows})
        yield pa.RecordBatch.from_pylist(found, schema=pa.schema([("file", pa.string()), ("bucket", pa.int32()), ("low", pa.string()),
                                                                  ("high", pa.string()), ("n", pa.int64())]))


class Snapshots:
    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.fs = self.jpath(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.read_files: list[str] = []  # of the last operation, for tests and logs

    # ------------------------------------------------------------ versions

    def _names(self, folder: str) -> list[str]:
        at = self.jpath(f"{self.path}/{folder}")
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def version(self) -> tuple[int, str | None]:
        """The latest version's number and manifest; (0, None) before the first."""
        names = [n.split(".", 1) for n in self._names("versions")]
        top = max((int(n) for n, _ in names), default=0)
        return top, min((m for n, m in names if int(n) == top), default=None)

    def entries(self) -> DataFrame:
        """The files of the latest version, and a row without a file per table."""
        manifest = self.version()[1]
        if manifest is None:
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).parquet(f"{self.path}/manifests/{manifest}")

    def _commit(self, base: int, entries: DataFrame) -> None:
        manifest = uuid.uuid4().hex
        entries.write.parquet(f"{self.path}/manifests/{manifest}")
        self._publish(base + 1, manifest)

    def _publish(self, number: int, manifest: str) -> None:
        at = self.jpath(f"{self.path}/versions/{number:020d}.{manifest}")
        self.fs.create(at, False).close()
        if self.version() != (number, manifest):
            self.fs.delete(at, False)
            raise Conflict(f"version {number} of {self.path} has been published by another writer")

    # --------------------------------------------------------------- files

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(self.buckets)).cast("int")

    def _write(self, table: str, key: str, rows: DataFrame) -> DataFrame:
        """New files with these rows, as manifest entries. A hot bucket is written by many tasks."""
        run = uuid.uuid4().hex
        folder = f"{self.path}/data/{run}"
        kind = T.StructType([rows.schema[key], T.StructField(BUCKET, T.IntegerType())])
        rows.withColumn(BUCKET, self._bucket(F.col(key))).hint("rebalance", F.col(BUCKET)).sortWithinPartitions(
            BUCKET, key).write.partitionBy(BUCKET).parquet(folder)
        name = F.concat(F.lit(f"{run}/{BUCKET}="), F.col(BUCKET), F.lit("/"), F.col("_metadata.file_name"))
        held = self.spark.read.schema(kind).parquet(folder).select(name.alias("file"), F.col(BUCKET).alias("bucket"), F.col(key).cast("string").alias("k"))
        ship_package(self.spark)
        return held.mapInArrow(_ranges, "file string, bucket int, low string, high string, n bigint").groupBy("file", "bucket").agg(
            F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).select(
            F.lit(table).alias("tbl"), F.lit(key).alias("key"), F.lit(None).cast("string").alias("schema"), "file", "bucket", "low", "high", "n")

    def _head(self, table: str) -> tuple[str, T.StructType]:
        row = self.entries().where((F.col("tbl") == table) & F.col("file").isNull()).first()
        if row is None:
            raise ValueError(f"no table named {table!r}")
        return row["key"], T.StructType.fromJson(json.loads(row["schema"]))

    def _open(self, files: list[str], schema: T.StructType) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/data/{f}" for f in files])

    def _holding(self, table: str, keys: DataFrame, key: str) -> list[str]:
        """Files of a table that may hold one of the keys."""
        wanted = keys.select(F.col(key).cast("string").alias("wanted"), self._bucket(F.col(key)).alias("at"))
        found = self.entries().where((F.col("tbl") == table) & F.col("file").isNotNull()).join(
            wanted, (F.col("bucket") == F.col("at")) & F.col("wanted").between(F.col("low"), F.col("high")), "left_semi")
        return sorted(r["file"] for r in found.select("file").collect())

    # ---------------------------------------------------------- operations

    def create(self, tables: dict[str, tuple[DataFrame, str]]) -> None:
        """Create or replace tables, (rows, key column) by name, in one commit."""
        base = self.version()[0]
        new = [self._write(name, key, rows) for name, (rows, key) in tables.items()]
        heads = self.spark.createDataFrame([(n, key, rows.schema.json(), None, None, None, None, 0) for n, (rows, key) in tables.items()], ENTRY)
        entries = self.entries().where(~F.col("tbl").isin(list(tables))).unionByName(heads)
        for e in new:
            entries = entries.unionByName(e)
        self._commit(base, entries)

    def read(self, table: str) -> DataFrame:
        _, schema = self._head(table)
        files = self.entries().where((F.col("tbl") == table) & F.col("file").isNotNull()).select("file").collect()
        return self._open(sorted(r["file"] for r in files), schema)

    def register(self, table: str, rows: DataFrame, keys: list[str], order: list[str]) -> int:
        """SNK-1: append ``rows`` whose ``keys`` (the first is the table's key) aren't in the table yet; of
        several new rows with equal keys the first by ``order``. Returns how many rows were ignored because the
        table holds their keys. A row with a null among its keys is always new. A table that doesn't exist is created."""
        base = self.version()[0]
        if not self.entries().where(F.col("tbl") == table).limit(1).count():
            self.create({table: (first_rows(rows, keys, order), keys[0])})
            self.read_files = []
            return 0
        key, schema = self._head(table)
        staged = shared_dir(self.spark, "registration")
        first_rows(rows, keys, order, "_rows").write.parquet(staged)
        batch = self.spark.read.parquet(staged)
        self.read_files = self._holding(table, batch, key)
        held = self._open(self.read_files, schema).select(*keys).distinct().withColumn("_held", F.lit(True))
        met = shared_dir(self.spark, "registration-met")  # the keys of the table are read once, for the count and the new rows
        batch.join(held, keys, "left").write.parquet(met)
        flagged = self.spark.read.parquet(met)
        new = self._write(table, key, flagged.where("_held is null").select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]))
        self._commit(base, self.entries().unionByName(new))
        return int(flagged.where("_held").agg(F.sum("_rows")).first()[0] or 0)

    def delete(self, names: DataFrame, key: str, tables: list[str], known: str | None = None) -> int:
        """SNK-2: the rows of the named keys go from all ``tables`` in one commit. ``known``: a name that this
        table doesn't hold is an error, and nothing is deleted. Returns the number of files replaced."""
        base = self.version()[0]
        path = shared_dir(self.spark, "deletion")
        names.select(key).distinct().write.parquet(path)
        gone = self.spark.read.parquet(path)
        holding = {t: self._holding(t, gone, key) for t in dict.fromkeys([*tables, *([known] if known else [])])}
        if known:
            there = self._open(holding[known], self._head(known)[1]).select(key)
            lost = gone.join(there, key, "left_anti").limit(1).collect()
            if lost:
                raise ValueError(f"no job named {lost[0][key]!r}")
        self.read_files = [f for t in tables for f in holding[t]]
        if not self.read_files:
            return 0
        removed = self.spark.createDataFrame([(f,) for f in self.read_files], "file string")
        entries = self.entries().join(removed, "file", "left_anti").select(*[F.col(f.name) for f in self.entries().schema.fields])
        for t in tables:
            if holding[t]:
                rest = self._open(holding[t], self._head(t)[1]).join(gone, key, "left_anti")
                entries = entries.unionByName(self._write(t, self._head(t)[0], rest))
        self._commit(base, entries)
        return len(self.read_files)

    def vacuum(self, keep: int = 1) -> int:
        """Delete files that none of the latest ``keep`` versions names, what crashed operations left, and the
        older versions; not while a writer is at work. Returns the number of files and leftovers deleted."""
        names = self._names("versions")
        kept = [n.split(".", 1)[1] for n in names[-keep:]]
        rest = [m for m in self._names("manifests") if m not in kept]

        def files(manifests: list[str]) -> DataFrame:
            return self.spark.read.schema(ENTRY).parquet(*[f"{self.path}/manifests/{m}" for m in manifests]).where("file is not null").select("file")

        live = files(kept)
        dead = [r["file"] for r in files(rest).distinct().join(live, "file", "left_anti").collect()] if rest else []
        named = {r["run"] for r in files(kept + rest).select(F.substring_index("file", "/", 1).alias("run")).distinct().collect()}
        lost = [r for r in self._names("data") if r not in named]
        for folder, gone in (("data", dead + lost), ("versions", names[:-keep]), ("manifests", rest)):
            for name in gone:
                self.fs.delete(self.jpath(f"{self.path}/{folder}/{name}"), True)
        return len(dead) + len(lost)
