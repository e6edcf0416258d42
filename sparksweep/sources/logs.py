"""Batch log scan (SRC-5): text -> ordered lines with ``str.splitlines`` rules.

CRLF, CR, VT, FF, FS, GS, RS, NEL, U+2028 and U+2029 end a line like LF; one trailing line end adds no empty last
line; an empty text gives no rows, a text of just a line end gives one empty
line. Runs as a generator (posexplode) inside the scan stage: no shuffle, and
every text is processed whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: what ends a line for ``str.splitlines`` besides LF
LINE_END = r"\r\n|[\r\x0B\x0C\x1C\x1D\x1E\x85\u2028\u2029]"


def normalized(text: Column) -> Column:
    """Text with every line end as LF and one trailing LF removed."""
    return F.regexp_replace(F.regexp_replace(text, LINE_END, "\n"), r"\n\z", "")


def split_lines(df: DataFrame, text_col: str, keep: list[str], line_col: str = "line",
                index_col: str = "line_no") -> DataFrame:
    """One row per line: ``keep`` columns, 0-based ``index_col``, ``line_col``."""
    t = F.col(text_col)
    body = df.filter(t.isNotNull() & (F.length(t) > 0))
    x = body.select(*keep, F.posexplode(F.split(normalized(t), "\n", -1)).alias(index_col, line_col))
    return x.withColumn(index_col, F.col(index_col).cast("bigint"))


def read_text_logs(spark, paths, keep_path: bool = True) -> DataFrame:
    """Read whole log files (one row per file) and split them into lines."""
    df = spark.read.text(paths, wholetext=True)
    if keep_path:
        df = df.select(F.col("_metadata.file_path").alias("path"), "value")
    return split_lines(df, "value", ["path"] if keep_path else [])
