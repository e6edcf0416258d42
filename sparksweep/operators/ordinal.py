"""Skew-safe row numbers (the scalable row index of DAT-2, DAT-4 and TOP-3).

``row_number()`` over one global window moves every row into one task, and a
window per group moves a hot group into one task. Here rows are range
partitioned on the full sort key (so a hot group is cut across many tasks),
sorted inside each partition, and numbered as ``offset(partition) + position
in partition``. The offsets come from per-partition counts: one row per
partition, so the only thing that reaches the driver is bounded by the
partition count, never by the data.

The sorted rows are written once, each with its place in its partition, so that counting and numbering see
exactly the same partitions, also after an executor loss; the counts come from that one column of the written
files. The number of partitions follows the plan's own size estimate: nothing of the input runs before the write.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparksweep.session import plan_bytes, shared_dir, ship_package

_ROW = "_ss_row"
PARTITION_BYTES = 128 << 20


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    """At least as many as the session shuffles to, more if the size of the
    tables it reads says so: the partitions of the index can't be split later."""
    if num_partitions:
        return num_partitions
    size = plan_bytes(df)
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(size // PARTITION_BYTES, 1 << 14), 1)


def _ranged(df: DataFrame, keys: list[str], num_partitions: int | None, inside=None) -> DataFrame:
    """``df`` in range partitions, sorted, after ``inside``; written with ``_ROW``: partition number times 2**33 plus place."""
    rows = df.repartitionByRange(_partitions(df, num_partitions), *keys).sortWithinPartitions(*keys)
    if inside:
        rows = inside(rows)
    return _written(rows.withColumn(_ROW, F.monotonically_increasing_id()))


def _part(column=_ROW):
    return F.shiftright(column, 33).cast("int")


def _per_part(values: list) -> Column:
    """The value of each row's partition, from a list by partition number."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), _part() + 1) if values else F.lit(0)


def _written(df: DataFrame) -> DataFrame:
    path = shared_dir(df.sparkSession, "group-starts")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def with_row_index(df: DataFrame, order_cols: list[str], index_col: str = "row_idx",
                   group_cols: list[str] | tuple = (), group_index_col: str | None = None,
                   num_partitions: int | None = None) -> DataFrame:
    """Add a 0-based global index in (group_cols, order_cols) order and, when
    ``group_index_col`` is given, a 0-based index inside each group.

    ``order_cols`` should make the order total (add a unique tie-break); rows
    that tie completely get distinct but arbitrary consecutive numbers.
    """
    held = _ranged(df, list(group_cols) + list(order_cols), num_partitions)
    counts = {r["p"]: r["n"] for r in held.groupBy(_part().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    shifts, acc = [], 0  # what to add to a row's number to get its index
    for p in range(max(counts, default=-1) + 1):
        shifts.append(acc - (p << 33))
        acc += counts.get(p, 0)
    out = held.withColumn(index_col, (F.col(_ROW) + _per_part(shifts)).cast("bigint")).drop(_ROW)
    if group_index_col and group_cols:
        ren = {c: f"_ss_g{i}" for i, c in enumerate(group_cols)}
        # one row per group, written: Spark knows its size and broadcasts it when
        # small, else the join's hot partitions can be split
        side = _written(out.groupBy(*[F.col(c).alias(ren[c]) for c in group_cols]).agg(
            F.min(index_col).alias("_ss_start")))
        cond = [out[c].eqNullSafe(side[ren[c]]) for c in group_cols]
        out = (out.join(side, cond)
               .withColumn(group_index_col, F.col(index_col) - F.col("_ss_start"))
               .drop("_ss_start", *ren.values()))
    return out


def _before(batches):
    """The sum of the values before each row of a partition, in the partition's order."""
    total = 0.0
    for batch in batches:
        v = batch.column("_ss_v").to_numpy(zero_copy_only=False)
        sums = total + np.cumsum(v)
        if len(v):
            total = sums[-1]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums - v)], [*batch.schema.names, "_ss_in"])


def with_running_sum(df: DataFrame, order_cols: list[str], value_col: str, out_col: str,
                     group_cols: list[str] | tuple = (), num_partitions: int | None = None, index_col: str | None = None) -> DataFrame:
    """Add the sum of ``value_col`` over the rows before each row inside its
    group, in ``order_cols`` order (NULL counts as 0), and with ``index_col`` the number of these rows.

    Skew-safe segmented prefix sum: rows are range partitioned on
    (group, order); a running sum inside each range partition
    (as the rows lie, without another shuffle), written with them, plus the
    partition's offset (from one total per partition) gives a global exclusive
    prefix; subtracting the prefix at the group's first row gives the sum within
    the group.
    """
    v = F.coalesce(F.col(value_col).cast("double"), F.lit(0.0))
    ship_package(df.sparkSession)

    def inside(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("_ss_v", v)
        return rows.mapInArrow(_before, T.StructType([*rows.schema.fields, T.StructField("_ss_in", T.DoubleType())]))

    held = _ranged(df, list(group_cols) + list(order_cols), num_partitions, inside)
    found = held.groupBy(_part().alias("p")).agg(F.sum("_ss_v").alias("t"), F.count(F.lit(1)).alias("n")).collect()
    totals = {r["p"]: (r["t"], r["n"]) for r in found}
    offsets, shifts, acc, rows = [], [], 0.0, 0
    for p in range(max(totals, default=-1) + 1):
        offsets.append(acc)
        shifts.append(rows - (p << 33))
        acc, rows = acc + (totals.get(p, (0.0, 0))[0] or 0.0), rows + totals.get(p, (0.0, 0))[1]
    x = held.withColumn("_ss_cum", _per_part(offsets).cast("double") + F.col("_ss_in")).drop("_ss_in")
    x = x.withColumn("_ss_at", (F.col(_ROW) + _per_part(shifts)).cast("bigint"))
    start, first = F.lit(0.0), F.lit(0)
    if group_cols:
        ren = {c: f"_ss_g{i}" for i, c in enumerate(group_cols)}
        side = _written(x.groupBy(*[F.col(c).alias(ren[c]) for c in group_cols]).agg(
            F.min_by("_ss_cum", "_ss_at").alias("_ss_start"), F.min("_ss_at").alias("_ss_first")))
        cond = [x[c].eqNullSafe(side[ren[c]]) for c in group_cols]
        x, start, first = x.join(side, cond), F.col("_ss_start"), F.col("_ss_first")
        x = x.drop(*ren.values())
    x = x.withColumn(out_col, F.col("_ss_cum") - start)
    if index_col:
        x = x.withColumn(index_col, F.col("_ss_at") - first)
    return x.drop(_ROW, "_ss_v", "_ss_cum", "_ss_at", "_ss_start", "_ss_first")
