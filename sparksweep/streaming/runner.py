"""Running streams to a durable sink, and landing files for a file source.

Sinks are folders in the shared folder with their own checkpoint, so a
restarted query resumes where it stopped and delivers each row once. Queries
here run with ``availableNow``: they drain what has landed and stop.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from sparksweep.session import shared_dir

STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def prepare(spark: SparkSession) -> None:
    """Stateful processors need the RocksDB state store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_PROVIDER)


class _Totals(StreamingQueryListener):
    """Adds up every progress report of the queries that run while it listens (``recentProgress`` keeps the last hundred)."""

    def __init__(self):
        self.found: dict[str, dict] = {}
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        t = self.found.setdefault(str(p.runId), {"rows_read": 0, "rows_dropped_late": 0, "batches": 0})
        t["rows_read"] += int(p.numInputRows or 0)
        t["rows_dropped_late"] += sum(int(op.numRowsDroppedByWatermark or 0) for op in p.stateOperators or [])
        t["batches"] += 1

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))


def _start(df: DataFrame, writer_fn, state_partitions: int | None) -> dict:
    """Run a query to its end with ``state_partitions`` state partitions (fixed in the
    checkpoint at the first start) and put the session's setting back. Returns the rows read and
    the rows dropped as late, over all of its micro-batches."""
    spark = df.sparkSession
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    totals = _Totals()
    spark.streams.addListener(totals)
    try:
        if state_partitions:
            spark.conf.set(key, str(state_partitions))
        try:
            q = writer_fn()
        finally:
            spark.conf.set(key, old)
        q.awaitTermination()
        if q.exception():
            raise q.exception()
        run = str(q.runId)
        end = time.monotonic() + 60
        while run not in totals.ended:  # reports come in order, the end last
            if time.monotonic() > end:
                raise RuntimeError("the stream's progress reports did not arrive")
            time.sleep(0.01)
    finally:
        spark.streams.removeListener(totals)
    return totals.found.get(run, {"rows_read": 0, "rows_dropped_late": 0, "batches": 0})


@dataclass(frozen=True)
class Landed:
    """Where a followed source landed: files per bucket, the folder of the rows
    without an event time, and how many these are."""
    files: int
    rejects: str
    rejected: int


def land_in_order(df: DataFrame, path: str, ts_col: str = "ts", buckets: int = 6, files_per_bucket: int | None = None,
                  copies: int = 1) -> Landed:
    """Write ``df`` as successive appends in event-time order (as a followed log
    would arrive), each spread over several files by a round-robin repartition.

    Buckets hold about equal numbers of rows (their bounds are quantiles of the
    event time), so a few early rows don't make a bucket of their own. A file
    stream reading ``files`` files per trigger takes exactly one bucket per
    micro-batch: every bucket fills all of its files and is written after the
    one before. With ``copies`` each bucket is delivered that many times in a row.
    Rows without an event time belong to no bucket: they go to ``rejects``.
    """
    spark = df.sparkSession
    rejects = path + "-rejects"
    df.filter(F.col(ts_col).isNull()).write.mode("append").parquet(rejects)
    rejected = spark.read.schema(df.schema).parquet(rejects).count()
    us = F.unix_micros(F.col(ts_col).cast("timestamp"))
    marks = [i / buckets for i in range(1, buckets)]
    got = df.agg(F.percentile_approx(us, marks).alias("q")).first()["q"] or []
    bounds = sorted(set(got))
    bucket = F.lit(0)
    for b in bounds:
        bucket = bucket + F.when(us > b, 1).otherwise(0)
    rows = df.filter(F.col(ts_col).isNotNull()).withColumn("_bucket", bucket)
    sizes = {r["_bucket"]: r["n"] for r in rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
    k = files_per_bucket or max(1, spark.sparkContext.defaultParallelism // 2)
    if not sizes:
        df.limit(0).write.mode("append").parquet(path)
        return Landed(k, rejects, rejected)
    for i in sorted(sizes):
        n = min(k, sizes[i])
        for _ in range(copies):
            rows.filter(F.col("_bucket") == i).drop("_bucket").repartition(n).write.mode("append").parquet(path)
            for _ in range(k - n):  # a small bucket is filled up with empty files, so that all have as many
                df.limit(0).write.mode("append").parquet(path)
    return Landed(k, rejects, rejected)


def late_rows(df: DataFrame, name: str, ts_col: str, delay: str) -> str:
    """Drain a stream into a table of the rows that a stateful operator with
    this watermark drops: behind the largest event time of all earlier
    micro-batches less ``delay``. Run it on the same source with the same
    triggers. Each batch writes its own folder (rows, and its largest event
    time), so a replayed batch changes nothing."""
    spark = df.sparkSession
    out, ckpt = shared_dir(spark, f"{name}-late"), shared_dir(spark, f"{name}-late-ckpt")
    marks = out + "-marks"
    schema = "top timestamp, batch_id bigint"
    spark.createDataFrame([], schema).write.parquet(f"{marks}/batch_id=-1")

    def write(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        seen = s.read.schema("top timestamp").parquet(*[f"{marks}/batch_id={b}" for b in range(-1, batch_id)])
        top = seen.agg(F.max("top").alias("t")).first()["t"]
        ts = F.col(ts_col).cast("timestamp")
        late = batch.filter(F.lit(False) if top is None else ts < F.lit(top) - F.expr(f"INTERVAL {delay}"))
        late.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        batch.agg(F.max(ts).alias("top")).write.mode("overwrite").parquet(f"{marks}/batch_id={batch_id}")

    _start(df, lambda: (df.writeStream.foreachBatch(write).option("checkpointLocation", ckpt)
                        .trigger(availableNow=True).start()), None)
    return out


def file_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
            .parquet(path))


def run_to_parquet(df: DataFrame, name: str, mode: str = "append", state_partitions: int | None = None,
                   stats: dict | None = None, checkpoint: str | None = None) -> str:
    """Drain ``df`` into a parquet folder (exactly once via the checkpoint).
    ``stats``, when given, receives rows read and rows dropped as late."""
    spark = df.sparkSession
    out, ckpt = shared_dir(spark, f"{name}-out"), checkpoint or shared_dir(spark, f"{name}-ckpt")
    got = _start(df, lambda: (df.writeStream.format("parquet").option("path", out)
                              .option("checkpointLocation", ckpt).outputMode(mode)
                              .trigger(availableNow=True).start()), state_partitions)
    if stats is not None:
        stats.update(got)
    return out


def run_to_changelog(df: DataFrame, name: str, mode: str = "update", state_partitions: int | None = None) -> str:
    """Drain an updating result into a changelog folder partitioned by batch id;
    a replayed batch overwrites its own folder, so the log stays exact."""
    spark = df.sparkSession
    out, ckpt = shared_dir(spark, f"{name}-log"), shared_dir(spark, f"{name}-ckpt")

    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}"))

    _start(df, lambda: (df.writeStream.foreachBatch(write).option("checkpointLocation", ckpt).outputMode(mode)
                        .trigger(availableNow=True).start()), state_partitions)
    return out


def latest_from_changelog(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The final value of every key: its row from the last batch that updated it."""
    log = spark.read.parquet(path)
    vals = [c for c in log.columns if c not in keys and c != "batch_id"]
    last = log.groupBy(*keys).agg(F.max_by(F.struct(*vals), F.col("batch_id")).alias("v"))
    return last.select(*keys, "v.*")


def register_stream(df: DataFrame, path: str, keys: list[str], order: list[str], name: str = "register", buckets: int = 64) -> DataFrame:
    """SNK-1 as a stream: every micro-batch appends only rows whose key the
    table does not hold yet (the first registration wins), reading only the files that may hold
    its keys. The checkpoint makes a restarted query resume after the last committed batch; a batch that runs twice adds
    nothing the second time. Returns the table."""
    from sparksweep.operators.snapshots import Snapshots
    ckpt = shared_dir(df.sparkSession, f"{name}-ckpt")

    def write(batch: DataFrame, batch_id: int) -> None:
        Snapshots(batch.sparkSession, path, buckets).register(name, batch, keys, order)

    _start(df, lambda: (df.writeStream.foreachBatch(write).option("checkpointLocation", ckpt)
                        .trigger(availableNow=True).start()), None)
    return Snapshots(df.sparkSession, path, buckets).read(name)
