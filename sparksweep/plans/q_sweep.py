"""Registered sweep queries (HPO-1..7, TOP-1, TOP-2, WIN-3) over lineitem."""

from __future__ import annotations

from sparksweep.plans import sweep as S
from sparksweep.plans.registry import register
from sparksweep.plans.views import table, with_views

N_TRIALS = 64
WAVE = 4
GRID = S.GridSearch(points={"slope": 5, "shift": 4})
RANDOM = S.RandomSearch(S.PRICE_SEED)
OBJECTIVES = [S.Objective("mae", "minimize"), S.Objective("mse", "minimize")]

_DATA_SQL = """SELECT l_quantity AS x, l_extendedprice AS y_a,
       l_extendedprice * (1 - l_discount) AS y_b,
       l_extendedprice * (1 - l_discount) * (1 + l_tax) AS y_c FROM lineitem"""


def _scored_sql(algorithm, n) -> str:
    trials = S.trial_table_sql(S.PRICE_SPACE, n, algorithm, WAVE)
    return with_views("""
SELECT trial_no, trial, wave, slope, shift, kind,
       round(avg(abs(y - (slope * x + shift))), 4) AS mae,
       round(avg((y - (slope * x + shift)) * (y - (slope * x + shift))), 2) AS mse
FROM (SELECT t.*, d.x, CASE t.kind WHEN 'a' THEN d.y_a WHEN 'b' THEN d.y_b ELSE d.y_c END AS y
      FROM data d CROSS JOIN trials t) j
GROUP BY trial_no, trial, wave, slope, shift, kind""", ctes={"trials": trials, "data": _DATA_SQL})


@register("hpo7_sweep_random", _scored_sql(RANDOM, N_TRIALS))
def hpo7_sweep_random(spark, sf_dir):
    """64 random trials (uniform slope, log-uniform shift, categorical kind)
    scored by mae and mse over all of lineitem in one scan."""
    return S.sweep_price(spark, table(spark, sf_dir, "lineitem"), N_TRIALS, RANDOM, WAVE)


@register("hpo5_sweep_grid", _scored_sql(GRID, 50))
def hpo5_sweep_grid(spark, sf_dir):
    """Grid of 5 x 4 x 3 = 60 points capped at 50 trials (TOP-2), scored."""
    return S.sweep_price(spark, table(spark, sf_dir, "lineitem"), 50, GRID, WAVE)


_BEST_SQL = with_views("""
SELECT trial_no, trial, wave, slope, shift, kind, mae, mse FROM (
  SELECT *, row_number() OVER (ORDER BY mae, trial_no) AS rn FROM scored
  WHERE mae IS NOT NULL AND NOT isnan(mae)) b WHERE rn = 1""",
                       ctes={"scored": _scored_sql(RANDOM, N_TRIALS)})


@register("top1_best_trial", _BEST_SQL)
def top1_best_trial(spark, sf_dir):
    """Best of the random sweep on the first objective (mae, minimise)."""
    scored = hpo7_sweep_random(spark, sf_dir)
    return S.best_trial(scored, OBJECTIVES)


_SUFF_SQL = with_views("""
SELECT trial_no, trial, wave, slope, shift, kind,
       round(avg((y - (slope * x + shift)) * (y - (slope * x + shift))), 2) AS mse
FROM (SELECT t.*, d.x, CASE t.kind WHEN 'a' THEN d.y_a WHEN 'b' THEN d.y_b ELSE d.y_c END AS y
      FROM data d CROSS JOIN trials t) j
GROUP BY trial_no, trial, wave, slope, shift, kind""",
                       ctes={"trials": S.trial_table_sql(S.PRICE_SPACE, N_TRIALS, RANDOM, WAVE),
                             "data": _DATA_SQL})


@register("hpo7_sweep_sufficient_stats", _SUFF_SQL)
def hpo7_sweep_sufficient_stats(spark, sf_dir):
    """The same 64 trials' mse from one-row sufficient statistics."""
    return S.sweep_price_sufficient(spark, table(spark, sf_dir, "lineitem"), N_TRIALS, RANDOM, WAVE)


_BEST_JOB_SQL = with_views("""
SELECT experiment, job, job_no, objective FROM (
  SELECT experiment, job, job_no, objective,
         row_number() OVER (PARTITION BY experiment ORDER BY objective DESC, job_no) AS rn
  FROM v_jobs WHERE objective IS NOT NULL AND NOT isnan(objective)) b WHERE rn = 1""", "v_jobs")


@register("top1_best_job_per_experiment", _BEST_JOB_SQL)
def top1_best_job_per_experiment(spark, sf_dir):
    """Best trial (job) per experiment, maximising ``objective`` (HPO-6 direction)."""
    from sparksweep.plans import views as V
    jobs = V.jobs(spark, sf_dir).select("experiment", "job", "job_no", "objective")
    return S.best_trial(jobs, [S.Objective("objective", "MAXIMIZE")], ["experiment"], order_key="job_no")
