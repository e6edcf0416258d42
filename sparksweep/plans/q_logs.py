"""Registered log and observation queries (SRC-5, JOB-3, AGG-1, JOB-4, FLT-5, JON-7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparksweep.operators import metrics as M
from sparksweep.operators import outcomes as O
from sparksweep.operators import steps as ST
from sparksweep.plans import views as V
from sparksweep.plans.registry import register
from sparksweep.plans.views import table, with_views
from sparksweep.sources import logs as L


@register("src5_log_lines", with_views("""
SELECT doc_id, i - 1 AS line_no, parts[i] AS line
FROM (SELECT doc_id, parts, unnest(generate_series(1, len(parts))) AS i
      FROM (SELECT doc_id,
                   string_split(regexp_replace(regexp_replace(text, '\\r\\n|\\r', chr(10), 'g'), '\\n\\z', ''), chr(10)) AS parts
            FROM documents WHERE text IS NOT NULL AND length(text) > 0) a) b"""))
def src5_log_lines(spark, sf_dir):
    """Every document's whole text split into lines with splitlines rules."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return L.split_lines(docs, "text", ["doc_id"])


_PAIR_SQL = M.METRIC_PAIR.replace("'", "''")


@register("job3_metric_extraction", with_views(f"""
SELECT trial, seq, i - 1 AS pair_no, names[i] AS metric, TRY_CAST(texts[i] AS DOUBLE) AS value
FROM (SELECT trial, seq, names, texts, unnest(generate_series(1, len(names))) AS i
      FROM (SELECT trial, seq, regexp_extract_all(line, '{_PAIR_SQL}', 1) AS names,
                   regexp_extract_all(line, '{_PAIR_SQL}', 2) AS texts FROM v_metric_log) a) b""", "v_metric_log"))
def job3_metric_extraction(spark, sf_dir):
    """``name=value`` pairs of printed metric lines as typed rows."""
    return M.extract_metrics(V.metric_log(spark, sf_dir), "line", ["trial", "seq"])


_OBS_SQL = """
SELECT trial, metric, min(value) AS "min", max(value) AS "max", max(CASE WHEN rn = 1 THEN value END) AS latest
FROM (SELECT *, row_number() OVER (PARTITION BY trial, metric ORDER BY ts DESC, seq DESC) AS rn
      FROM src WHERE value IS NOT NULL AND NOT isnan(value)) x
GROUP BY trial, metric"""


@register("agg1_metric_observations", with_views(_OBS_SQL, "v_metric_log",
                                                 ctes={"src": "SELECT * FROM v_metric_log"}))
def agg1_metric_observations(spark, sf_dir):
    """min / max / latest per (trial, metric) over the whole metric log."""
    return M.observations(V.metric_log(spark, sf_dir), ["trial"])


@register("agg1_observations_from_log_text", with_views(_OBS_SQL, "v_metric_log", ctes={"src": f"""
SELECT l.trial, l.ts, l.seq, p.metric, p.value FROM v_metric_log l JOIN (
SELECT trial, seq, names[i] AS metric, TRY_CAST(texts[i] AS DOUBLE) AS value
FROM (SELECT trial, seq, names, texts, unnest(generate_series(1, len(names))) AS i
      FROM (SELECT trial, seq, regexp_extract_all(line, '{_PAIR_SQL}', 1) AS names,
                   regexp_extract_all(line, '{_PAIR_SQL}', 2) AS texts FROM v_metric_log) a) b) p
ON l.trial = p.trial AND l.seq = p.seq"""}))
def agg1_observations_from_log_text(spark, sf_dir):
    """Observations computed from the printed lines (JOB-3 feeding AGG-1)."""
    log = V.metric_log(spark, sf_dir)
    pairs = M.extract_metrics(log, "line", ["trial", "seq", "ts"])
    return M.observations(pairs, ["trial"])


@register("job4_job_outcomes", with_views(f"""
SELECT job, outcome, exit_code, duration_s, error, dependency FROM (
  SELECT job, outcome, exit_code, duration_s, error, dependency,
         row_number() OVER (PARTITION BY job ORDER BY seq DESC) AS rn
  FROM (SELECT job, seq,
          CASE WHEN regexp_matches(line, '{O.CANCELLED}') THEN 'Failed'
               WHEN regexp_matches(line, '{O.COMPLETED}') THEN
                    CASE WHEN TRY_CAST(regexp_extract(line, '{O.COMPLETED}', 1) AS INTEGER) = 0 THEN 'Complete' ELSE 'Failed' END
               WHEN regexp_matches(line, '{O.EXCEPTION}') THEN 'Failed'
               WHEN regexp_matches(line, '{O.DEP_FAILED}') THEN 'Skipped' END AS outcome,
          CASE WHEN regexp_matches(line, '{O.COMPLETED}') THEN TRY_CAST(regexp_extract(line, '{O.COMPLETED}', 1) AS INTEGER) END AS exit_code,
          CASE WHEN regexp_matches(line, '{O.COMPLETED}') AND regexp_matches(regexp_extract(line, '{O.COMPLETED}', 2), '{O.DURATION}') THEN
               coalesce(TRY_CAST(regexp_extract(regexp_extract(line, '{O.COMPLETED}', 2), '{O.DURATION}', 1) AS DOUBLE), 0) * 86400
             + CAST(regexp_extract(regexp_extract(line, '{O.COMPLETED}', 2), '{O.DURATION}', 2) AS DOUBLE) * 3600
             + CAST(regexp_extract(regexp_extract(line, '{O.COMPLETED}', 2), '{O.DURATION}', 3) AS DOUBLE) * 60
             + CAST(regexp_extract(regexp_extract(line, '{O.COMPLETED}', 2), '{O.DURATION}', 4) AS DOUBLE) END AS duration_s,
          CASE WHEN regexp_matches(line, '{O.CANCELLED}') THEN 'cancelled'
               WHEN regexp_matches(line, '{O.EXCEPTION}') THEN regexp_extract(line, '{O.EXCEPTION}', 1) END AS error,
          CASE WHEN regexp_matches(line, '{O.DEP_FAILED}') THEN regexp_extract(line, '{O.DEP_FAILED}', 1) END AS dependency
        FROM v_job_log) c
  WHERE outcome IS NOT NULL) r WHERE rn = 1""", "v_job_log"))
def job4_job_outcomes(spark, sf_dir):
    """Status, exit code, duration, error and failed dependency per job from its log."""
    return O.job_outcomes(V.job_log(spark, sf_dir), "job", "seq")


_REQ_SQL = "SELECT job, concat('node-', job_no % 3) AS step FROM v_jobs"


def _requests(spark, sf_dir):
    return V.jobs(spark, sf_dir).select("job", F.concat(F.lit("node-"), F.col("job_no") % 3).alias("step"))


@register("flt5_log_steps_exact", with_views("""
SELECT r.job, r.step AS requested, s.name AS step, s.status, regexp_replace(s.name, '-\\d+$', '') AS container
FROM req r JOIN v_steps s ON s.job = r.job AND s.name = r.step
WHERE s.status IS DISTINCT FROM 'Pending'""", "v_jobs", "v_steps", ctes={"req": _REQ_SQL}))
def flt5_log_steps_exact(spark, sf_dir):
    """Cluster mode: the requested step of every job, unless it is Pending."""
    return ST.log_steps(V.steps(spark, sf_dir), _requests(spark, sf_dir))


@register("flt5_log_steps_all_on_default", with_views("""
SELECT r.job, r.step AS requested, s.name AS step, s.status, regexp_replace(s.name, '-\\d+$', '') AS container
FROM req r JOIN v_steps s ON s.job = r.job AND (r.step = 'node-0' OR s.name = r.step)""",
                                                      "v_jobs", "v_steps", ctes={"req": _REQ_SQL}))
def flt5_log_steps_all_on_default(spark, sf_dir):
    """Container / process mode: ``node-0`` means every step of the job."""
    return ST.log_steps(V.steps(spark, sf_dir), _requests(spark, sf_dir), all_steps_on_default=True)


_JON7_SQL = with_views("""
SELECT c.experiment, c.trial, c.source, s.idx, concat(s.name, ': ', coalesce(s.status, 'unknown')) AS line
FROM (
  SELECT f.experiment, coalesce(q.requested, b.best, f.first) AS trial,
         CASE WHEN q.requested IS NOT NULL THEN 'requested' WHEN b.best IS NOT NULL THEN 'best' ELSE 'first' END AS source
  FROM (SELECT experiment, arg_min(job, job_no) AS first FROM v_jobs GROUP BY experiment) f
  LEFT JOIN (SELECT experiment, job AS best FROM (
               SELECT experiment, job, row_number() OVER (PARTITION BY experiment ORDER BY objective DESC, job_no) AS rn
               FROM v_jobs WHERE cond_type = 'Complete' AND cond_status = 'True') z WHERE rn = 1) b
    ON b.experiment = f.experiment
  LEFT JOIN (SELECT experiment, max(job) AS requested FROM v_jobs WHERE experiment LIKE '%0' GROUP BY experiment) q
    ON q.experiment = f.experiment) c
JOIN v_steps s ON s.job = c.trial""", "v_jobs", "v_steps")


@register("jon7_experiment_trial_logs", _JON7_SQL)
def jon7_experiment_trial_logs(spark, sf_dir):
    """Per experiment the log of the requested, else best, else first trial."""
    jobs = V.jobs(spark, sf_dir).withColumn(
        "complete", (F.col("cond_type") == "Complete") & (F.col("cond_status") == "True"))
    requests = (jobs.filter(F.col("experiment").endswith("0")).groupBy("experiment")
                .agg(F.max("job").alias("job")))
    chosen = ST.experiment_log_trial(jobs, requests, "objective", "maximize", trial="job", order="job_no",
                                     scored="complete")
    steps = V.steps(spark, sf_dir)
    x = chosen.join(steps, chosen.job == steps.job)
    return x.select("experiment", chosen.job.alias("trial"), "source", "idx",
                    F.concat(F.col("name"), F.lit(": "), F.coalesce(F.col("status"), F.lit("unknown"))).alias("line"))
