"""Which steps' logs may be read (FLT-5) and which trial's logs an experiment
shows (JON-7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparksweep.plans.sweep import best_trial

DEFAULT_STEP = "node-0"


def container_name(step: str = "name"):
    """Step name without its node number: ``node-3`` -> ``node``."""
    return F.regexp_replace(F.col(step), r"-\d+$", "")


def log_steps(steps: DataFrame, requests: DataFrame, all_steps_on_default: bool = False,
              job: str = "job", step: str = "step") -> DataFrame:
    """Steps whose logs are read for each (job, requested step).

    Exact mode (cluster backend): the step with that name, unless its status is
    Pending (a NULL status passes). With ``all_steps_on_default`` (container and
    process backends) a request for the default ``node-0`` means every step of
    the job, whatever its status; other names are matched exactly.
    """
    r = requests.select(F.col(job).alias("job"), F.col(step).alias("requested"))
    s = steps.select(F.col("job"), F.col("name"), F.col("status"))
    not_pending = ~F.col("status").eqNullSafe("Pending")
    if all_steps_on_default:
        cond = (r.job == s.job) & ((r.requested == DEFAULT_STEP) | (r.requested == s.name))
        keep = F.lit(True)
    else:
        cond = (r.job == s.job) & (r.requested == s.name)
        keep = not_pending
    out = r.join(s, cond).filter(keep)
    return out.select(r.job, "requested", s.name.alias("step"), "status",
                      container_name("name").alias("container"))


def experiment_log_trial(trials: DataFrame, requests: DataFrame, objective: str, direction: str,
                         experiment: str = "experiment", trial: str = "trial", order: str = "trial_no",
                         scored: str | None = None) -> DataFrame:
    """Per experiment the trial whose logs are shown: the requested one, else
    the best (among trials whose ``scored`` flag is true), else the first.
    Returns experiment, trial, source."""
    pool = trials if scored is None else trials.filter(F.col(scored))
    best = best_trial(pool.select(experiment, trial, order, objective), [(objective, direction)],
                      [experiment], order_key=order).select(experiment, F.col(trial).alias("best"))
    first = trials.groupBy(experiment).agg(F.min_by(F.col(trial), F.col(order)).alias("first"))
    req = requests.select(experiment, F.col(trial).alias("requested"))
    x = first.join(best, experiment, "left").join(req, experiment, "left")
    return x.select(
        experiment,
        F.coalesce("requested", "best", "first").alias(trial),
        F.when(F.col("requested").isNotNull(), F.lit("requested"))
        .when(F.col("best").isNotNull(), F.lit("best")).otherwise(F.lit("first")).alias("source"))
