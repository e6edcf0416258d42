"""Streaming traps: late rows, a deadline and a later hit in one micro-batch."""

import datetime as dt

from pyspark.sql import functions as F

from sparksweep.session import shared_dir
from sparksweep.streaming import runner as R
from sparksweep.streaming import status as SS

T0 = dt.datetime(2024, 1, 1)
STEP_SCHEMA = "job string, step string, ts timestamp_ntz, seq long, status string"
EVENT_SCHEMA = "job string, ts timestamp_ntz, seq long, status string"


def _land(spark, batches, schema, name):
    path = shared_dir(spark, name)
    for rows in batches:  # one append per micro-batch, oldest first
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return R.file_stream(spark, path, schema, files_per_trigger=1)


def test_late_step_event_does_not_move_status_back(spark):
    R.prepare(spark)
    later = [("j", "node-0", T0 + dt.timedelta(minutes=5), 2, "Complete"),
             ("j", "node-1", T0 + dt.timedelta(minutes=5), 3, "Complete")]
    late = [("j", "node-0", T0, 1, "Running")]  # older than what node-0 already reported
    stream = _land(spark, [later, late], STEP_SCHEMA, "late-steps")
    out = R.run_to_parquet(SS.live_job_status(stream), "late-steps", state_partitions=2)
    changes = sorted((r["version"], r["status"]) for r in spark.read.parquet(out).collect())
    assert changes == [(0, "Complete")]  # the late Running row changed nothing


def test_hit_after_deadline_in_the_same_batch_is_a_timeout(spark):
    R.prepare(spark)
    rows = [("a", T0, 1, "Running"), ("a", T0 + dt.timedelta(seconds=700), 2, "Complete"),
            ("b", T0, 3, "Running"), ("b", T0 + dt.timedelta(seconds=100), 4, "Complete"),
            ("c", T0, 5, "Running"), ("c", T0 + dt.timedelta(seconds=50), 6, "Failed")]
    stream = _land(spark, [rows], EVENT_SCHEMA, "deadline")
    out = R.run_to_parquet(SS.wait_for_status(stream, ("Complete",), 600), "deadline", state_partitions=2)
    got = {r["job"]: (r["outcome"], r["decided_at"]) for r in SS.wait_result(spark.read.parquet(out)).collect()}
    assert got["a"] == ("timed_out", T0 + dt.timedelta(seconds=600))
    assert got["b"] == ("reached", T0 + dt.timedelta(seconds=100))
    assert got["c"][0] == "failed"


def test_timer_fires_when_the_watermark_passes_the_deadline(spark):
    R.prepare(spark)
    first = [("quiet", T0, 1, "Running"), ("busy", T0, 2, "Running")]
    second = [("busy", T0 + dt.timedelta(seconds=900), 3, "Running")]  # moves the watermark past 600 s
    stream = _land(spark, [first, second], EVENT_SCHEMA, "timer")
    out = R.run_to_parquet(SS.wait_for_status(stream, ("Complete",), 600, "0 seconds"), "timer", state_partitions=2)
    got = {r["job"]: r["outcome"] for r in SS.wait_result(spark.read.parquet(out)).collect()}
    assert got == {"quiet": "timed_out", "busy": "timed_out"}


def test_windowed_observations_emit_closed_windows(spark, sf_dir):
    from pyspark.sql import functions as F

    from sparksweep.plans import views as V
    from sparksweep.streaming import logs as SL
    R.prepare(spark)
    events = V.table(spark, sf_dir, "events")
    landed = shared_dir(spark, "win-obs")
    k = R.land_in_order(events, landed).files
    stream = R.file_stream(spark, landed, events.schema, k)
    log = SL.event_time(V.metric_log(spark, sf_dir, stream))
    out = R.run_to_parquet(SL.windowed_observations(log, ["trial"], "1 day", delay="1 hour"), "win-obs",
                           state_partitions=2)
    got = {(r["window"]["start"], r["trial"], r["metric"]): (r["min"], r["max"], r["latest"])
           for r in spark.read.parquet(out).collect()}
    batch = SL.windowed_observations(SL.event_time(V.metric_log(spark, sf_dir)), ["trial"], "1 day")
    last = events.agg(F.max(F.col("ts").cast("timestamp"))).first()[0]
    closed = {(r["window"]["start"], r["trial"], r["metric"]): (r["min"], r["max"], r["latest"])
              for r in batch.collect() if r["window"]["end"] <= last - dt.timedelta(hours=1)}
    assert got and set(closed) <= set(got)
    assert all(got[key] == closed[key] for key in closed)


def test_every_late_row_is_counted(spark):
    """More micro-batches than the reports that a query keeps."""
    R.prepare(spark)
    key = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(key)
    spark.conf.set(key, "3")
    try:
        batches = [[("j", T0 + dt.timedelta(hours=h), h, "Running")] + ([("j", T0, 100 + h, "Running")] if h > 2 else []) for h in range(12)]
        stream = _land(spark, batches, EVENT_SCHEMA, "late-count")
        from sparksweep.streaming import logs as SL
        stats = {}
        out = R.run_to_parquet(SL.deliver_once(SL.event_time(stream), ["job", "seq"], "event_ts", "1 hour"), "late-count", state_partitions=2, stats=stats)
    finally:
        spark.conf.set(key, before)
    assert stats["rows_read"] == 21 and stats["batches"] >= 12
    assert stats["rows_dropped_late"] == 9 and spark.read.parquet(out).count() == 12


def _state(spark, ckpt, name):
    return spark.read.format("statestore").option("path", ckpt).option("stateVarName", name).load()


def test_decided_jobs_leave_the_state(spark):
    R.prepare(spark)
    hour = dt.timedelta(hours=1)
    batches = [[(f"j{h}", T0 + h * hour, 2 * h, "Running"), (f"j{h}", T0 + h * hour + dt.timedelta(minutes=5), 2 * h + 1,
                "Complete" if h % 2 else "Running")] for h in range(12)]
    batches.append([("j0", T0 + 12 * hour, 99, "Complete")])  # a job that was decided and forgotten
    ckpt = shared_dir(spark, "wait-ckpt")
    out = R.run_to_parquet(SS.wait_for_status(_land(spark, batches, EVENT_SCHEMA, "wait-state"), ("Complete",), 1800, "1 minute", keep_s=3600),
                           "wait-state", state_partitions=2, checkpoint=ckpt)
    left = {r["key"]["job"] for r in _state(spark, ckpt, "wait").collect()}
    # open or decided less than an hour ago: the rest is gone
    assert left <= {"j0", "j10", "j11"} and "j11" in left
    got = {r["job"]: r["outcome"] for r in SS.wait_result(spark.read.parquet(out)).collect()}
    assert got == {f"j{h}": "reached" if h % 2 else "timed_out" for h in range(12)}


def test_idle_jobs_leave_the_state(spark):
    R.prepare(spark)
    hour = dt.timedelta(hours=1)
    batches = [[(f"j{b}", "node-0", T0 + b * hour, b, "Running")] for b in range(6)]
    batches += [[("j0", "node-0", T0 + 7 * hour, 9, "Complete")], [("j9", "node-0", T0 + 8 * hour, 10, "Created")]]
    for idle, kept in ((3600, {"j0", "j9"}), (36000, {"j0", "j1", "j2", "j3", "j4", "j5", "j9"})):
        ckpt = shared_dir(spark, "idle-ckpt")
        stream = _land(spark, batches, STEP_SCHEMA, "idle")
        out = R.run_to_parquet(SS.live_job_status(stream, idle_s=idle, delay="1 minute"), "idle", state_partitions=1, checkpoint=ckpt)
        assert {r["key"]["job"] for r in _state(spark, ckpt, "last").collect()} == kept
        last = spark.read.parquet(out).groupBy("job").agg(F.max_by("status", "version").alias("status"))
        assert {r["job"]: r["status"] for r in last.collect()} == {
            "j0": "Complete", "j9": "Created", **{f"j{b}": "Running" for b in range(1, 6)}}
