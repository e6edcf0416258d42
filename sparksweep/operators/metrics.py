"""Metric extraction and observations (JOB-3, AGG-1).

``extract_metrics`` turns printed ``name=value`` pairs in log lines into rows;
``observations`` folds a metric log into (min, max, latest) per trial and
metric. All three aggregates are mergeable (``max_by`` on a (ts, seq) struct),
so a hot trial is pre-aggregated in every task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed value: a metric name and a decimal number, as printed by ``print(f"loss={loss}")``
METRIC_PAIR = r"([A-Za-z_][A-Za-z0-9_./-]*)=([-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?)"


def extract_metrics(logs: DataFrame, line_col: str, keep: list[str]) -> DataFrame:
    """One row per ``name=value`` pair found in a line; unparsable values are NULL."""
    line = F.col(line_col)
    pairs = F.arrays_zip(F.regexp_extract_all(line, F.lit(METRIC_PAIR), 1).alias("name"),
                         F.regexp_extract_all(line, F.lit(METRIC_PAIR), 2).alias("text"))
    x = logs.select(*keep, F.posexplode(pairs).alias("pair_no", "p"))
    return x.select(*keep, F.col("pair_no").cast("bigint").alias("pair_no"), F.col("p.name").alias("metric"),
                    F.col("p.text").try_cast("double").alias("value"))


def observations(log: DataFrame, keys: list[str], metric: str = "metric", value: str = "value",
                 order: tuple[str, ...] = ("ts", "seq")) -> DataFrame:
    """min, max and latest value per (keys, metric). Rows with a NULL or NaN
    value are incomplete and dropped; latest is by ``order`` (ties impossible
    when the last order column is unique)."""
    v = F.col(value)
    clean = log.filter(v.isNotNull() & ~F.isnan(v))
    return clean.groupBy(*keys, metric).agg(
        F.min(v).alias("min"), F.max(v).alias("max"),
        F.max_by(v, F.struct(*[F.col(c) for c in order])).alias("latest"))


def observations_as_strings(obs: DataFrame) -> DataFrame:
    """The reference's API edge: metric values as strings."""
    return obs.select(*[c for c in obs.columns if c not in ("min", "max", "latest")],
                      *[F.col(c).cast("string").alias(c) for c in ("min", "max", "latest")])
