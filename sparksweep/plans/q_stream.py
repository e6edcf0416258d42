"""Registered streaming queries (STR-1..5).

Each lands the events table as time-ordered files in the shared folder,
follows it with a file stream (one file per micro-batch), drains it with
``availableNow`` into a checkpointed sink and returns the sink's contents.
The final stream results equal the batch operators, so the DuckDB twins are
the batch SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparksweep.operators.steps import log_steps
from sparksweep.plans import views as V
from sparksweep.plans.q_jobs import TIMEOUT_S
from sparksweep.plans.q_logs import _OBS_SQL
from sparksweep.plans.registry import register
from sparksweep.plans.views import table, with_views
from sparksweep.session import shared_dir
from sparksweep.streaming import logs as SL
from sparksweep.streaming import runner as R
from sparksweep.streaming import status as SS

STATE_PARTITIONS = 4  # at least; a stream's own parameter, as the checkpoint keeps it
DELAY_S = 3600


def _events_stream(spark, sf_dir, name, copies=1, buckets_per_trigger=1):
    R.prepare(spark)
    events = table(spark, sf_dir, "events")
    path = shared_dir(spark, f"{name}-landed")
    landed = R.land_in_order(events, path, copies=copies)
    return R.file_stream(spark, path, events.schema, landed.files * buckets_per_trigger)


def _state_partitions(spark):
    """A task per core: the state of many jobs is worked on by all of them."""
    return max(STATE_PARTITIONS, spark.sparkContext.defaultParallelism)


_FIRST_CREATED = """SELECT job FROM (SELECT job, status, row_number() OVER (PARTITION BY job ORDER BY ts, seq) AS rn
                   FROM v_status_events) f WHERE rn = 1 AND status = 'Created'"""


@register("str1_follow_log", with_views("""
SELECT l.job, l.seq, l.line FROM v_job_log l
WHERE l.seq % 3 = 0 AND l.job IN (SELECT job FROM req) AND l.job NOT IN (SELECT job FROM pending)""",
    "v_job_log", "v_status_events", ctes={"req": _FIRST_CREATED, "pending": """
SELECT job FROM (SELECT job, status, row_number() OVER (PARTITION BY job ORDER BY ts DESC, seq DESC) AS rn
                 FROM v_status_events WHERE seq % 3 = 0) x WHERE rn = 1 AND status = 'Created'"""}))
def str1_follow_log(spark, sf_dir):
    """Log lines of step node-0 of the jobs whose first status was Created,
    followed as they land; a step that is still pending has no log."""
    se = V.status_events(spark, sf_dir)
    req = se.groupBy("job").agg(F.min_by("status", F.struct("ts", "seq")).alias("first")).filter(
        F.col("first") == "Created").select("job", F.lit("node-0").alias("step"))
    last = step_events(se).groupBy("job", F.col("step").alias("name")).agg(F.max_by("status", F.struct("ts", "seq")).alias("status"))
    steps = last.withColumn("status", F.when(F.col("status") == "Created", F.lit("Pending")).otherwise(F.col("status")))
    path = shared_dir(spark, "str1-requests")
    log_steps(steps, req).select("job", "step").distinct().write.parquet(path)  # once, not in every micro-batch
    stream = _events_stream(spark, sf_dir, "str1")
    lines = V.job_log(spark, sf_dir, V.status_events(spark, sf_dir, stream))
    lines = lines.withColumn("step", F.concat(F.lit("node-"), F.col("seq") % 3))
    out = R.run_to_parquet(SL.follow(lines, spark.read.parquet(path)).select("job", "seq", "line"), "str1", state_partitions=_state_partitions(spark))
    return spark.read.parquet(out)


@register("str2_deliver_once", with_views("SELECT job, seq, line FROM v_job_log", "v_job_log"))
def str2_deliver_once(spark, sf_dir):
    """Every log line delivered once although the source delivers each bucket of
    them twice. Nothing is late: the delay spans all event times."""
    stream = _events_stream(spark, sf_dir, "str2", copies=2)
    span = table(spark, sf_dir, "events").agg(F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))).first()[0] or 0
    lines = V.job_log(spark, sf_dir, V.status_events(spark, sf_dir, stream))
    once = SL.deliver_once(SL.event_time(lines), ["job", "seq"], "event_ts", f"{int(span) // 1_000_000 + 1} seconds")
    stats: dict = {}
    out = R.run_to_parquet(once.select("job", "seq", "line"), "str2", state_partitions=_state_partitions(spark), stats=stats)
    if stats["rows_dropped_late"]:
        raise RuntimeError(f"{stats['rows_dropped_late']} rows came behind the watermark")
    return spark.read.parquet(out)


@register("str3_live_observations", with_views(_OBS_SQL, "v_metric_log", ctes={"src": "SELECT * FROM v_metric_log"}))
def str3_live_observations(spark, sf_dir):
    """min / max / latest per (trial, metric) kept up to date by a stream; the
    final state (last update of each key) equals the batch observations."""
    stream = _events_stream(spark, sf_dir, "str3", buckets_per_trigger=2)
    log = SL.event_time(V.metric_log(spark, sf_dir, stream))
    obs = SL.live_observations(log, ["trial"])
    path = R.run_to_changelog(obs, "str3", state_partitions=_state_partitions(spark))
    return R.latest_from_changelog(spark, path, ["trial", "metric"])


@register("str3_windowed_observations", with_views(f"""
SELECT trial, metric, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, min(value) AS min, max(value) AS max, arg_max(value, ROW(ts, seq)) AS latest
FROM v_metric_log WHERE value IS NOT NULL AND NOT isnan(value)
  AND date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL {DELAY_S} SECOND
GROUP BY trial, metric, date_trunc('day', ts)""", "v_metric_log"))
def str3_windowed_observations(spark, sf_dir):
    """min / max / latest per (trial, metric, day), each day appended once when the watermark closes it."""
    stream = _events_stream(spark, sf_dir, "str3w")
    log = SL.event_time(V.metric_log(spark, sf_dir, stream))
    obs = SL.windowed_observations(log, ["trial"], "1 day", delay=f"{DELAY_S} seconds")
    got = spark.read.parquet(R.run_to_parquet(obs, "str3w", state_partitions=_state_partitions(spark)))
    return got.select("trial", "metric", F.col("window.start").cast("timestamp_ntz").alias("day"), "min", "max", "latest")


@register("snk1_register_stream", with_views("""
SELECT job, arg_min(status, ROW(ts, seq)) AS status, min(ts) AS ts FROM v_status_events GROUP BY job""", "v_status_events"))
def snk1_register_stream(spark, sf_dir):
    """Jobs registered by a stream of status events: the first event of a job is kept."""
    stream = _events_stream(spark, sf_dir, "snk1")
    ev = V.status_events(spark, sf_dir, stream).select("job", "status", "ts", "seq")
    return R.register_stream(ev, shared_dir(spark, "registered"), ["job"], ["ts", "seq"], buckets=8).select("job", "status", "ts")


_STEP_EVENTS_SQL = """
SELECT concat('j-', user_id, '-', CAST(ts AS DATE)) AS job, concat('node-', event_id % 3) AS step, ts, event_id AS seq,
       CASE event_type WHEN 'click' THEN 'Created' WHEN 'purchase' THEN 'Complete' WHEN 'error' THEN 'Failed'
                       ELSE 'Running' END AS status
FROM events"""


def step_events(status_events):
    return status_events.withColumn("step", F.concat(F.lit("node-"), F.col("seq") % 3))


@register("str4_live_job_status", with_views("""
SELECT job, CASE WHEN bool_or(status = 'Failed') THEN 'Failed' WHEN bool_or(status = 'Running') THEN 'Running'
                 WHEN bool_and(status = 'Complete') THEN 'Complete' ELSE 'Created' END AS status
FROM (SELECT job, step, status FROM (
        SELECT *, row_number() OVER (PARTITION BY job, step ORDER BY ts DESC, seq DESC) AS rn FROM se) x
      WHERE rn = 1) l
GROUP BY job""", ctes={"se": _STEP_EVENTS_SQL}))
def str4_live_job_status(spark, sf_dir):
    """Current status of every job from its step events, emitted on change;
    the last emission per job equals the batch fold."""
    stream = _events_stream(spark, sf_dir, "str4", buckets_per_trigger=2)
    ev = step_events(V.status_events(spark, sf_dir, stream))
    out = R.run_to_parquet(SS.live_job_status(ev), "str4", state_partitions=_state_partitions(spark))
    changes = spark.read.parquet(out)
    return changes.groupBy("job").agg(F.max_by("status", "version").alias("status"))


def _str5_sql():
    from sparksweep.plans.registry import ORACLE
    return f"""SELECT job, start, CASE WHEN open THEN 'waiting' ELSE outcome END AS outcome,
       CASE WHEN NOT open THEN status END AS status, CASE WHEN NOT open THEN decided_at END AS decided_at
FROM (SELECT *, outcome = 'timed_out' AND decided_at > (SELECT max(ts) FROM events) - INTERVAL {DELAY_S} SECOND AS open
      FROM ({ORACLE['agg9_wait_outcome']}) a) b"""


@register("str5_wait_with_timeout", _str5_sql())
def str5_wait_with_timeout(spark, sf_dir):
    """Waiting for Complete with a 6 h event-time timeout, one row per job; a
    job whose deadline lies past the stream's final watermark is still waiting."""
    stream = _events_stream(spark, sf_dir, "str5")
    ev = V.status_events(spark, sf_dir, stream)
    out = R.run_to_parquet(SS.wait_for_status(ev, ("Complete",), TIMEOUT_S, f"{DELAY_S} seconds"), "str5",
                           state_partitions=_state_partitions(spark))
    return SS.wait_result(spark.read.parquet(out))
