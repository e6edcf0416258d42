"""Sweeps on Spark: search space -> trial table -> every trial scored in one
pass over the data -> best trial (HPO-4..7, HPO-6, TOP-1, TOP-2, WIN-3).

Plan shape of ``score``: the data is scanned once. The trials' parameters (a
declared number of trials, checked) go to the tasks as arrays; a task computes
the additive partial sums of all trials on each Arrow batch and emits one row
per trial. No (row, trial) pair ever becomes a row: the only shuffle is
``trials x tasks`` rows, independent of the data size. More than
``TRIALS_PER_PASS`` trials are split by hash into passes of about that size.
"""

from __future__ import annotations

import math
import random
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparksweep.functions.search import Choice, LogUniform, Uniform, unit_draw, unit_draw_sql
from sparksweep.session import plan_bytes, ship_package

TRIALS_PER_PASS = 50_000        # trials whose parameters are shipped to the tasks at once
TRIALS_PER_PARTITION = 100_000


# ---------------------------------------------------------------- objectives

@dataclass(frozen=True)
class Objective:
    """A metric to optimise. The first objective of a sweep is optimised, the
    others are only reported (HPO-6). Direction strings are case-insensitive."""
    metric: str = "loss"
    direction: str = "minimize"

    def __post_init__(self):
        d = str(self.direction).strip().lower()
        if d.startswith("direction."):
            d = d.split(".", 1)[1]
        if d not in ("minimize", "maximize"):
            raise ValueError(f"direction must be minimize or maximize, got {self.direction!r}")
        object.__setattr__(self, "direction", d)

    @property
    def minimize(self) -> bool:
        return self.direction == "minimize"


def normalize_objectives(objectives) -> list[Objective]:
    """Default is minimise ``loss``. On read-back every objective carries the
    first one's direction, as the reference reports them."""
    if not objectives:
        return [Objective()]
    objs = [o if isinstance(o, Objective) else Objective(*o) if isinstance(o, tuple) else Objective(str(o))
            for o in objectives]
    return objs


def read_back_objectives(objectives) -> list[Objective]:
    objs = normalize_objectives(objectives)
    return [Objective(o.metric, objs[0].direction) for o in objs]


# ---------------------------------------------------------------- algorithms

@dataclass(frozen=True)
class RandomSearch:
    """Random search (HPO-4), the default algorithm. ``random_state`` None
    draws a seed once on the driver."""
    random_state: int | None = None

    def seed(self) -> int:
        return self.random_state if self.random_state is not None else random.randrange(2 ** 31)


@dataclass(frozen=True)
class GridSearch:
    """Grid search (HPO-5). Continuous parameters need a point count, given
    per parameter or once for all (the reference gives no step)."""
    points: int | dict | None = None

    def points_for(self, name: str, spec) -> int:
        if isinstance(spec, Choice):
            return len(spec.values)
        p = self.points.get(name) if isinstance(self.points, dict) else self.points
        if not p or p < 2:
            raise ValueError(f"grid search needs a point count >= 2 for continuous parameter {name!r}")
        return int(p)


def _check_space(space: dict) -> None:
    if not space:
        raise ValueError("search space is empty")
    for name, spec in space.items():
        if not isinstance(spec, (Uniform, LogUniform, Choice)):
            raise ValueError(f"parameter {name!r} has an unknown search type {type(spec).__name__}")


def _param_map(space: dict) -> Column:
    """Parameters as MAP<STRING,STRING>, the reference's string form."""
    kv = []
    for name in space:
        kv += [F.lit(name), F.col(name).cast("string")]
    return F.create_map(*kv)


def trial_table(spark: SparkSession, space: dict, num_trials: int = 10, algorithm=None,
                parallel_trials: int = 1) -> DataFrame:
    """The trial table: trial_no, trial, wave, one column per parameter, parameters map.

    ``num_trials`` caps the table (TOP-2) by construction, so a grid never
    builds its full product. ``wave`` is ``trial_no div parallel_trials + 1``
    (WIN-3): trials of a wave may run together.
    """
    _check_space(space)
    if num_trials < 1:
        raise ValueError("num_trials must be >= 1")
    if parallel_trials < 1:
        raise ValueError("parallel_trials must be >= 1")
    algorithm = algorithm or RandomSearch()
    if isinstance(algorithm, GridSearch):
        sizes = [algorithm.points_for(n, s) for n, s in space.items()]
        total = math.prod(sizes)
        n = min(total, num_trials)
    elif isinstance(algorithm, RandomSearch):
        n = num_trials
    else:
        raise ValueError(f"unknown algorithm {algorithm!r}")
    parts = max(1, min(n // TRIALS_PER_PARTITION + 1, spark.sparkContext.defaultParallelism))
    base = spark.range(0, n, 1, parts).withColumnRenamed("id", "trial_no")
    tn = F.col("trial_no")
    cols = [tn, F.concat(F.lit("trial-"), tn).alias("trial"),
            (F.floor(tn / parallel_trials) + 1).cast("bigint").alias("wave")]
    if isinstance(algorithm, GridSearch):
        # mixed-radix decode: the last parameter varies fastest
        stride = 1
        decoded = {}
        for (name, spec), size in reversed(list(zip(space.items(), sizes))):
            # whole numbers only; past the cap's last trial every digit is 0
            digit = F.expr(f"(trial_no div {stride}) % {size}") if stride < n else F.lit(0).cast("long")
            decoded[name] = spec.grid_point(digit, size).alias(name)
            stride *= size
        cols += [decoded[name] for name in space]
    else:
        seed = algorithm.seed()
        cols += [spec.from_unit(unit_draw(seed, tn, name)).alias(name) for name, spec in space.items()]
    out = base.select(*cols)
    return out.withColumn("parameters", _param_map(space))


def trial_table_sql(space: dict, num_trials: int, algorithm, parallel_trials: int = 1) -> str:
    """DuckDB twin of ``trial_table`` (without the map column)."""
    cols = ["range AS trial_no", "concat('trial-', range) AS trial",
            f"CAST(floor(range / {parallel_trials}) + 1 AS BIGINT) AS wave"]
    if isinstance(algorithm, GridSearch):
        sizes = [algorithm.points_for(n, s) for n, s in space.items()]
        n = min(math.prod(sizes), num_trials)
        stride = 1
        decoded = {}
        for (name, spec), size in reversed(list(zip(space.items(), sizes))):
            digit = f"((range // {stride}) % {size})" if stride < n else "0"
            decoded[name] = f"{spec.grid_point_sql(digit, size)} AS {name}"
            stride *= size
        cols += [decoded[name] for name in space]
    else:
        n = num_trials
        seed = algorithm.seed()
        cols += [f"{spec.from_unit_sql(unit_draw_sql(seed, 'range', name))} AS {name}"
                 for name, spec in space.items()]
    return f"SELECT {', '.join(cols)} FROM range({n})"


# ---------------------------------------------------------------- scoring

SPLIT_BYTES = 4 << 20  # Spark's default cost of opening a file: splits aren't smaller


def spread(data: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin the rows over at least ``min_partitions`` tasks (default: the
    cluster's parallelism) when the input, by the optimizer's estimate of its size, has fewer splits than that. Used
    before work that is multiplied per row (every trial), where a small input
    read as one split would otherwise keep one core busy. On large inputs,
    which already have more splits than cores, it adds nothing."""
    want = min_partitions or data.sparkSession.sparkContext.defaultParallelism
    size = plan_bytes(data)
    return data.repartition(want) if size < want * SPLIT_BYTES else data


TRIALS_AT_ONCE = 128  # rows of the error matrix that a task holds: this many x the rows of a batch


def score(data: DataFrame, trials: DataFrame, partials, names: list[str], metrics: dict[str, Column], num_trials: int,
          params: list[str], trial_key: str = "trial_no", keep: list[str] | None = None,
          trials_per_pass: int = TRIALS_PER_PASS) -> DataFrame:
    """Score every trial over ``data`` in one pass (HPO-7).

    ``partials(batch, params)`` gets one batch of the data as a dict of numpy
    arrays and up to ``TRIALS_AT_ONCE`` trials as a dict of arrays (``params``)
    and returns, for each of ``names``, the additive partial sums of these
    trials. ``metrics`` maps a name to a Column over the summed partials.
    ``num_trials`` is the declared size of ``trials`` (checked); ``keep`` the
    trial columns carried into the result.
    """
    keep = keep if keep is not None else [c for c in trials.columns if c != "parameters"]
    # the declared size bounds what is shipped: check it (reads at most n + 1 rows)
    if trials.limit(num_trials + 1).count() > num_trials:
        raise ValueError(f"the trial table has more than the declared num_trials={num_trials} rows")
    ship_package(data.sparkSession)
    schema = f"{trial_key} long, " + ", ".join(f"{n} double" for n in names)
    passes = max(1, math.ceil(num_trials / trials_per_pass))

    def task(spec: dict):
        def run(batches):
            keys = spec[trial_key]
            sums = {n: np.zeros(len(keys)) for n in names}
            for batch in batches:
                cols = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names}
                for at in range(0, len(keys), TRIALS_AT_ONCE):
                    part = slice(at, at + TRIALS_AT_ONCE)
                    for n, s in partials(cols, {p: spec[p][part] for p in params}).items():
                        sums[n][part] += s
            yield pa.RecordBatch.from_arrays([pa.array(keys), *[pa.array(sums[n]) for n in names]], [trial_key, *names])
        return run

    data = spread(data)
    parts = []
    for i in range(passes):
        some = trials if passes == 1 else trials.filter(F.pmod(F.xxhash64(trial_key), F.lit(passes)) == i)
        rows = some.select(trial_key, *params).toArrow()  # about trials_per_pass rows
        spec = {c: rows.column(c).to_numpy() for c in rows.column_names}
        parts.append(data.mapInArrow(task(spec), schema))
    summed = reduce(DataFrame.unionByName, parts).groupBy(trial_key).agg(*[F.sum(n).alias(n) for n in names])
    scored = summed.select(trial_key, *[m.alias(k) for k, m in metrics.items()])
    return trials.select(*keep).join(scored, trial_key)


def score_series(data: DataFrame, trials: DataFrame, partials, names: list[str], metrics: dict[str, Column], num_trials: int,
                 params: list[str], step: str, trial_key: str = "trial_no") -> DataFrame:
    """Score every trial at every step in one pass (a function that reports a metric per step): the column ``step`` of
    ``data``, a whole number, says to which step a row belongs. ``partials`` as in ``score``; the partial sums are keyed by
    (trial, step), added up in each task before the shuffle. A row per trial and step: trial_key, step, the metrics.
    Tasks hold trials x steps sums: steps are the reports of a run (days, epochs), not rows."""
    if trials.limit(num_trials + 1).count() > num_trials:
        raise ValueError(f"the trial table has more than the declared num_trials={num_trials} rows")
    ship_package(data.sparkSession)
    rows = trials.select(trial_key, *params).toArrow()  # num_trials rows
    spec = {c: rows.column(c).to_numpy() for c in rows.column_names}

    def run(batches):
        keys, sums = spec[trial_key], {}
        for batch in batches:
            cols = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names}
            steps = cols[step]
            for value in np.unique(steps):
                some = {c: v[steps == value] for c, v in cols.items()}
                held = sums.setdefault(int(value), {n: np.zeros(len(keys)) for n in names})
                for at in range(0, len(keys), TRIALS_AT_ONCE):
                    part = slice(at, at + TRIALS_AT_ONCE)
                    for n, s in partials(some, {p: spec[p][part] for p in params}).items():
                        held[n][part] += s
        for value, held in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array([value] * len(keys), pa.int64()), *[pa.array(held[n]) for n in names]],
                                             [trial_key, step, *names])

    schema = f"{trial_key} long, {step} long, " + ", ".join(f"{n} double" for n in names)
    summed = spread(data.where(F.col(step).isNotNull())).mapInArrow(run, schema).groupBy(trial_key, step).agg(*[F.sum(n).alias(n) for n in names])
    return summed.select(trial_key, step, *[m.alias(k) for k, m in metrics.items()])


def best_trial(scores: DataFrame, objectives, group_cols: list[str] | tuple = (),
               order_key: str = "trial_no") -> DataFrame:
    """Best trial per group, direction-aware on the first objective (TOP-1).

    NULL and NaN values of the objective are dropped first; a group with no
    valid trial gives no row. Ties go to the lowest ``order_key``. One
    mergeable ``min_by`` per group: partial aggregation, no window, no sort.
    """
    objs = normalize_objectives(objectives)
    m = F.col(objs[0].metric)
    valid = scores.filter(m.isNotNull() & ~F.isnan(m.cast("double")))
    key = F.struct((m if objs[0].minimize else -m).alias("k"), F.col(order_key).alias("o"))
    cols = [c for c in scores.columns if c not in group_cols]
    best = valid.groupBy(*group_cols).agg(F.min_by(F.struct(*cols), key).alias("best"))
    # a global aggregate over no valid trial still yields one (NULL) row: drop it
    return best.filter(F.col("best").isNotNull()).select(*group_cols, "best.*")


# ---------------------------------------------------------------- the price model

PRICE_SPACE = {
    "slope": Uniform(500.0, 2500.0),
    "shift": LogUniform(1.0, 10000.0),
    "kind": Choice(("a", "b", "c")),
}
PRICE_SEED = 7


def price_targets() -> dict[str, Column]:
    """Targets of the sample model: kind a = list price, b = after discount,
    c = after discount and tax."""
    ep, d, t = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    return {"a": ep, "b": ep * (1 - d), "c": ep * (1 - d) * (1 + t)}


KIND_CODES = {"a": 0, "b": 1, "c": 2}


def kind_code(kind: Column) -> Column:
    """The categorical kind as a small integer, compared per pair instead of text."""
    return F.when(kind == "a", F.lit(0)).when(kind == "b", F.lit(1)).otherwise(F.lit(2))


def price_partials(batch: dict, p: dict) -> dict:
    """Sums of |error|, error^2 and rows for some trials, one block of trials of a kind at a time."""
    x = batch["l_quantity"].astype(float)
    out = {n: np.zeros(len(p["slope"])) for n in ("abs_err", "sq_err", "n")}
    for code, kind in enumerate(("a", "b", "c")):
        mine = np.flatnonzero(p["kind_code"] == code)
        if len(mine):
            err = batch[f"y_{kind}"].astype(float) - p["shift"][mine, None] - p["slope"][mine, None] * x
            out["abs_err"][mine] = np.abs(err).sum(axis=1)
            out["sq_err"][mine] = np.einsum("ij,ij->i", err, err)
            out["n"][mine] = len(x)
    return out


def price_metrics() -> dict[str, Column]:
    return {"mae": F.round(F.col("abs_err") / F.col("n"), 4), "mse": F.round(F.col("sq_err") / F.col("n"), 2)}


def price_data(lineitem: DataFrame) -> DataFrame:
    """Feature and the three targets, computed once per row before the trials fan out."""
    return lineitem.select("l_quantity", *[c.alias(f"y_{k}") for k, c in price_targets().items()])


def sweep_price(spark: SparkSession, lineitem: DataFrame, num_trials: int = 64, algorithm=None,
                parallel_trials: int = 4) -> DataFrame:
    algorithm = algorithm or RandomSearch(PRICE_SEED)
    trials = trial_table(spark, PRICE_SPACE, num_trials, algorithm, parallel_trials)
    trials = trials.withColumn("kind_code", kind_code(F.col("kind")))
    n = min(num_trials, _space_size(algorithm))
    return score(price_data(lineitem), trials, price_partials, ["abs_err", "sq_err", "n"], price_metrics(), n,
                 params=["slope", "shift", "kind_code"], keep=["trial_no", "trial", "wave", "slope", "shift", "kind"])


def _space_size(algorithm) -> int:
    if isinstance(algorithm, GridSearch):
        return math.prod(algorithm.points_for(n, s) for n, s in PRICE_SPACE.items())
    return 1 << 62


# ---------------------------------------------------------------- sufficient statistics

def linear_sufficient_stats(data: DataFrame, x: Column, targets: dict[str, Column]) -> DataFrame:
    """One pass, one row: mean and variance of x and, per target, of y, with
    their covariance. The moments are centred and merged as such, so nothing
    cancels however many rows there are."""
    aggs = [F.avg(x).alias("mx"), F.var_pop(x).alias("vx")]
    for k, y in targets.items():
        aggs += [F.avg(y).alias(f"my_{k}"), F.var_pop(y).alias(f"vy_{k}"), F.covar_pop(x, y).alias(f"cxy_{k}")]
    return data.agg(*aggs)


def linear_mse_from_stats(stats: DataFrame, trials: DataFrame, slope: str, shift: str,
                          target_of: Column, target_keys: list[str]) -> DataFrame:
    """Mean squared error of ``y ~ slope*x + shift`` for every trial from the
    one-row statistics: Vy - 2a Cxy + a^2 Vx + (My - a Mx - b)^2. The
    statistics row is read once and enters the trial projection as literals."""
    st = stats.first().asDict()

    def pick(prefix):
        return F.coalesce(*[F.when(target_of == k, F.lit(st[f"{prefix}_{k}"]).cast("double")) for k in target_keys])

    a, b = F.col(slope), F.col(shift)
    off = pick("my") - a * F.lit(st["mx"]).cast("double") - b
    mse = pick("vy") - 2 * a * pick("cxy") + a * a * F.lit(st["vx"]).cast("double") + off * off
    return trials.select(*[c for c in trials.columns if c != "parameters"], F.round(mse, 2).alias("mse"))


def sweep_price_sufficient(spark: SparkSession, lineitem: DataFrame, num_trials: int = 64,
                           algorithm=None, parallel_trials: int = 4) -> DataFrame:
    algorithm = algorithm or RandomSearch(PRICE_SEED)
    trials = trial_table(spark, PRICE_SPACE, num_trials, algorithm, parallel_trials)
    stats = linear_sufficient_stats(price_data(lineitem), F.col("l_quantity"),
                                    {k: F.col(f"y_{k}") for k in price_targets()})
    return linear_mse_from_stats(stats, trials, "slope", "shift", F.col("kind"), ["a", "b", "c"])
