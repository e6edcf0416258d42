"""Followed logs (STR-1, STR-2) and live metric observations (STR-3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparksweep.operators.metrics import observations


def follow(lines: DataFrame, requests: DataFrame, keys: tuple = ("job", "step")) -> DataFrame:
    """STR-1: new lines of the chosen steps (FLT-5) as they arrive (stream-static join).
    ``requests`` is a written table, so a micro-batch reads it and computes nothing."""
    return lines.join(requests.select(*keys), list(keys), "left_semi")


def deliver_once(lines: DataFrame, keys: list[str], ts_col: str, delay: str) -> DataFrame:
    """STR-2: each (job, seq) delivered once even when the source replays it;
    state for a key is kept only while it can still be duplicated. ``delay`` is
    how late a row may come; later ones are listed by ``runner.late_rows``."""
    return lines.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark(keys)


def event_time(df: DataFrame, ts_col: str = "ts", out: str = "event_ts") -> DataFrame:
    """Watermarks need TIMESTAMP; the tables carry TIMESTAMP_NTZ."""
    return df.withColumn(out, F.col(ts_col).cast("timestamp"))


def live_observations(log: DataFrame, keys: list[str], ts_col: str = "event_ts",
                      delay: str = "1 day") -> DataFrame:
    """STR-3: min, max and latest per (keys, metric), updated every micro-batch
    (the batch AGG-1 applied to a stream; run in update mode)."""
    return observations(log.withWatermark(ts_col, delay), keys)


def windowed_observations(log: DataFrame, keys: list[str], window: str, ts_col: str = "event_ts",
                          delay: str = "1 hour", metric: str = "metric", value: str = "value") -> DataFrame:
    """STR-3, append form: min, max and latest per (keys, metric, event-time
    window), each window emitted once when the watermark closes it; its state
    is dropped then, so state stays bounded by the open windows."""
    v = F.col(value)
    clean = log.withWatermark(ts_col, delay).filter(v.isNotNull() & ~F.isnan(v))
    return clean.groupBy(F.window(ts_col, window).alias("window"), *keys, metric).agg(
        F.min(v).alias("min"), F.max(v).alias("max"),
        F.max_by(v, F.struct(F.col(ts_col), F.col("seq"))).alias("latest"))
