"""Which trials a stopping rule would have ended, from their recorded metrics.

No scheduler: both rules read a table of reported values (trial, metric, step, value) and tell for each trial what
the rule decides. Numbers within groups come from the range-sorted index (``ordinal``), so neither a trial with a third of all
reports nor a step that all trials reach is one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparksweep.operators.ordinal import with_row_index, with_running_sum


def running_means(log: DataFrame, order: list[str], value: str = "value") -> DataFrame:
    """(trial, metric, step, mean): the reports of each trial and metric numbered from 1 in ``order`` and the mean
    of the values so far. NULL and NaN values are no reports."""
    clean = log.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select("trial", "metric", *order, F.col(value).alias("_value"))
    x = with_running_sum(clean, order, "_value", "_sum", group_cols=["trial", "metric"], index_col="_before")
    step = F.col("_before") + 1
    return x.select("trial", "metric", step.alias("step"), ((F.col("_sum") + F.col("_value")) / step).alias("mean"))


def median_stop(means: DataFrame, maximize: bool = True, start_step: int = 1) -> DataFrame:
    """Median rule: (trial, metric, step, mean, median) for the first step from ``start_step`` on at which a trial's running
    mean is worse than the median of the other trials' running means at this step. Trials that are never worse, or alone at
    each step, have no row. The median of the others follows from four order statistics of the step and the trial's own rank,
    one row per step that is joined back."""
    ranked = with_row_index(means, ["mean", "trial"], "_i", group_cols=["metric", "step"], group_index_col="_rank").drop("_i")
    size = ranked.groupBy("metric", "step").agg(F.count(F.lit(1)).alias("_n"))
    low, high = F.expr("(_n - 2) div 2"), F.expr("(_n - 1) div 2")  # the middle of the others, as ranks among them
    near = ranked.join(size.where("_n > 1"), ["metric", "step"])
    at = lambda k, off: F.max(F.when(F.col("_rank") == k + off, F.col("mean")))
    stats = near.groupBy("metric", "step").agg(F.first("_n").alias("_n"), at(low, 0).alias("_l0"), at(low, 1).alias("_l1"),
                                               at(high, 0).alias("_h0"), at(high, 1).alias("_h1"))
    x = ranked.join(stats, ["metric", "step"])
    pick = lambda k, here, after: F.when(k >= F.col("_rank"), F.col(after)).otherwise(F.col(here))
    x = x.withColumn("median", (pick(low, "_l0", "_l1") + pick(high, "_h0", "_h1")) / 2)
    worse = F.col("mean") < F.col("median") if maximize else F.col("mean") > F.col("median")
    first = x.where(worse & (F.col("step") >= start_step)).groupBy("trial", "metric").agg(
        F.min_by(F.struct("step", "mean", "median"), "step").alias("s"))
    return first.select("trial", "metric", "s.step", "s.mean", "s.median")


def asha_rungs(means: DataFrame, min_step: int = 1, eta: int = 3, rungs: int = 4, maximize: bool = True) -> DataFrame:
    """Successive halving: (trial, metric, rung, step, mean, rank, of, promoted) for the rungs at steps ``min_step * eta ** rung``.
    Of the trials promoted by the rung before that report this step, the best ``1 / eta`` (rounded down) are promoted;
    equal means are ranked by the trial's name."""
    sign = F.lit(-1.0 if maximize else 1.0)
    out, alive = [], None
    for rung in range(rungs):
        step = min_step * eta ** rung
        here = means.where(F.col("step") == step)
        if alive is not None:
            here = here.join(alive, ["trial", "metric"], "left_semi")
        ranked = with_row_index(here.withColumn("_key", F.col("mean") * sign), ["_key", "trial"], "_i", group_cols=["metric"], group_index_col="rank")
        size = ranked.groupBy("metric").agg(F.count(F.lit(1)).alias("of"))
        done = ranked.join(size, "metric").select("trial", "metric", F.lit(rung).cast("bigint").alias("rung"), "step", "mean", "rank", "of",
                                                  (F.col("rank") < F.expr(f"of div {eta}")).alias("promoted"))
        out.append(done)
        alive = done.where("promoted").select("trial", "metric")
    return reduce(DataFrame.unionByName, out)
