"""Outcome extraction from job logs (JOB-4).

The process runner writes one of four closing messages. Per job the last
matching line (by line order) decides: status, exit code, duration in seconds,
error text and failed dependency. One ``max_by`` per job: mergeable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the runner's closing messages
CANCELLED = r"\[JobCancelled\]"
COMPLETED = r"\] Completed with code (-?\d+) in (.+) seconds\."
EXCEPTION = r"^Exception: (.*)$"
DEP_FAILED = r"^Dependency (.+) failed\. Skipping$"
# a printed timedelta: "[D day[s], ]H:MM:SS[.ffffff]"
DURATION = r"^(?:(-?\d+) days?, )?(\d+):(\d{2}):(\d{2}(?:\.\d+)?)$"


def _duration_seconds(text: Column) -> Column:
    days = F.coalesce(F.regexp_extract(text, DURATION, 1).try_cast("double"), F.lit(0.0))
    ok = text.rlike(DURATION)
    secs = (days * 86400 + F.regexp_extract(text, DURATION, 2).cast("double") * 3600
            + F.regexp_extract(text, DURATION, 3).cast("double") * 60
            + F.regexp_extract(text, DURATION, 4).cast("double"))
    return F.when(ok, secs)


def classify_lines(logs: DataFrame, line_col: str = "line") -> DataFrame:
    line = F.col(line_col)
    code = F.regexp_extract(line, COMPLETED, 1).try_cast("int")
    status = (F.when(line.rlike(CANCELLED), F.lit("Failed"))
              .when(line.rlike(COMPLETED), F.when(code == 0, F.lit("Complete")).otherwise(F.lit("Failed")))
              .when(line.rlike(EXCEPTION), F.lit("Failed"))
              .when(line.rlike(DEP_FAILED), F.lit("Skipped")))
    return logs.select(
        "*",
        status.alias("outcome"),
        F.when(line.rlike(COMPLETED), code).alias("exit_code"),
        F.when(line.rlike(COMPLETED), _duration_seconds(F.regexp_extract(line, COMPLETED, 2))).alias("duration_s"),
        F.when(line.rlike(CANCELLED), F.lit("cancelled"))
        .when(line.rlike(EXCEPTION), F.regexp_extract(line, EXCEPTION, 1)).alias("error"),
        F.when(line.rlike(DEP_FAILED), F.regexp_extract(line, DEP_FAILED, 1)).alias("dependency"),
    )


def job_outcomes(logs: DataFrame, job_col: str, order_col: str, line_col: str = "line") -> DataFrame:
    """Per job: the outcome of the last closing message; jobs without one are not listed."""
    c = classify_lines(logs, line_col).filter(F.col("outcome").isNotNull())
    last = F.max_by(F.struct("outcome", "exit_code", "duration_s", "error", "dependency"), F.col(order_col))
    return c.groupBy(job_col).agg(last.alias("o")).select(job_col, "o.*")
