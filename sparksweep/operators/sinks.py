"""First rows per key (SNK-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_rows(rows: DataFrame, keys: list[str], order: list[str], count: str | None = None) -> DataFrame:
    """Per key the row with the smallest ``order`` (ties: the smallest of the
    other atomic columns), the same on every run: one mergeable ``min_by``. ``count`` names a
    column for the number of rows of the key."""
    kinds = dict(rows.dtypes)
    rest = [c for c in rows.columns if c not in keys]
    ties = [c for c in rest if c not in order and not kinds[c].startswith(("map", "array", "struct"))]
    best = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order, *ties)).alias("_first"),
                                   *([F.count(F.lit(1)).alias(count)] if count else []))
    return best.select(*keys, "_first.*", *([count] if count else [])).select(*rows.columns, *([count] if count else []))
