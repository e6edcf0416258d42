"""Registered queries of the stopping rules and of metrics reported per step."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from sparksweep.operators import early_stopping as E
from sparksweep.plans import sweep as S
from sparksweep.plans import views as V
from sparksweep.plans.q_sweep import N_TRIALS, RANDOM, WAVE, _DATA_SQL
from sparksweep.plans.registry import register
from sparksweep.plans.views import table, with_views

# whole numbers, so that sums are exact in any order
_MEANS_SQL = """SELECT trial, metric, step, total / CAST(step AS DOUBLE) AS mean FROM (
  SELECT trial, metric, row_number() OVER w AS step, CAST(sum(v) OVER w AS DOUBLE) AS total
  FROM (SELECT trial, metric, ts, seq, CAST(round(value * 1000) AS BIGINT) AS v FROM v_metric_log WHERE value IS NOT NULL AND NOT isnan(value)) a
  WINDOW w AS (PARTITION BY trial, metric ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) b"""
START, MIN_STEP, ETA, RUNGS = 3, 2, 2, 4


def _means(spark, sf_dir):
    log = V.metric_log(spark, sf_dir).where(F.col("value").isNotNull() & ~F.isnan("value"))
    return E.running_means(log.withColumn("value", F.round(F.col("value") * 1000).cast("bigint")), ["ts", "seq"])


@register("hpo_median_stop", with_views(f"""
SELECT trial, metric, step, round(mean, 6) AS mean, round(median, 6) AS median FROM (
  SELECT *, row_number() OVER (PARTITION BY trial, metric ORDER BY step) AS first FROM (
    SELECT m.*, (l[1 + (n - 2) // 2 + CASE WHEN (n - 2) // 2 >= r THEN 1 ELSE 0 END]
               + l[1 + (n - 1) // 2 + CASE WHEN (n - 1) // 2 >= r THEN 1 ELSE 0 END]) / 2 AS median
    FROM (SELECT *, row_number() OVER (PARTITION BY metric, step ORDER BY mean, trial) - 1 AS r FROM means) m
    JOIN (SELECT metric, step, list(mean ORDER BY mean, trial) AS l, count(*) AS n FROM means GROUP BY metric, step) g
      ON g.metric = m.metric AND g.step = m.step WHERE n > 1) x
  WHERE mean < median AND step >= {START}) y WHERE first = 1""", "v_metric_log", ctes={"means": _MEANS_SQL}))
def hpo_median_stop(spark, sf_dir):
    """The step at which the median rule would have stopped each trial of the metric log."""
    found = E.median_stop(_means(spark, sf_dir), start_step=START)
    return found.select("trial", "metric", "step", F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"))


def _rungs_sql() -> str:
    parts, ctes = [], {"means": _MEANS_SQL}
    for k in range(RUNGS):
        step = MIN_STEP * ETA ** k
        alive = "" if not k else f" AND (trial, metric) IN (SELECT (trial, metric) FROM rung{k - 1} WHERE promoted)"
        ctes[f"rung{k}"] = f"""SELECT *, rank < of // {ETA} AS promoted FROM (
  SELECT trial, metric, {k} AS rung, step, mean, row_number() OVER (PARTITION BY metric ORDER BY mean DESC, trial) - 1 AS rank,
         count(*) OVER (PARTITION BY metric) AS of FROM means WHERE step = {step}{alive}) x"""
        parts.append(f"SELECT trial, metric, rung, step, round(mean, 6) AS mean, rank, of, promoted FROM rung{k}")
    return with_views("\nUNION ALL ".join(parts), "v_metric_log", ctes=ctes)


@register("hpo_asha_rungs", _rungs_sql())
def hpo_asha_rungs(spark, sf_dir):
    """Successive halving over the metric log: rank and promotion of every trial at each rung it reached."""
    found = E.asha_rungs(_means(spark, sf_dir), MIN_STEP, ETA, RUNGS)
    return found.withColumn("mean", F.round("mean", 6))


def _errors(batch, p):
    ep, d, t = batch["l_extendedprice"], batch["l_discount"], batch["l_tax"]
    kinds = {"a": ep, "b": ep * (1 - d), "c": ep * (1 - d) * (1 + t)}
    y = np.stack([kinds[k] for k in p["kind"]])
    err = y - (p["slope"][:, None] * batch["l_quantity"] + p["shift"][:, None])
    return {"abs_err": np.abs(err).sum(axis=1), "n": np.full(len(err), err.shape[1], np.float64)}


@register("hpo_reported_series", with_views("""
SELECT trial_no, step, round(avg(abs(y - (slope * x + shift))), 4) AS mae, count(*) AS reports
FROM (SELECT t.*, d.x, d.step, CASE t.kind WHEN 'a' THEN d.y_a WHEN 'b' THEN d.y_b ELSE d.y_c END AS y FROM data d CROSS JOIN trials t) j
GROUP BY trial_no, step""", ctes={"trials": S.trial_table_sql(S.PRICE_SPACE, N_TRIALS, RANDOM, WAVE),
                                   "data": _DATA_SQL.replace(" FROM lineitem", ", year(l_shipdate) * 12 + month(l_shipdate) AS step FROM lineitem")}))
def hpo_reported_series(spark, sf_dir):
    """64 trials of a function that reports its error per month of the data, in one pass over lineitem."""
    trials = S.trial_table(spark, S.PRICE_SPACE, N_TRIALS, RANDOM, WAVE)
    data = table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_tax", (
        F.year("l_shipdate") * 12 + F.month("l_shipdate")).cast("long").alias("step"))
    got = S.score_series(data, trials, _errors, ["abs_err", "n"], {
        "mae": F.round(F.col("abs_err") / F.col("n"), 4), "reports": F.col("n").cast("long")}, N_TRIALS, ["slope", "shift", "kind"], "step")
    return got
