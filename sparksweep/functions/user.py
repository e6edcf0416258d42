"""User functions (UDF-1, UDF-2, HPO-8).

* ``run_on_nodes``: one user function on ``num_nodes x procs_per_node`` ranks at
  once, each on its shard, as a barrier stage (all ranks start together, one
  failed rank fails the run); results are combined with a plain aggregate.
* Job options: small callables applied with ``DataFrame.transform``; a later
  option wins, labels and annotations are replaced as a whole.
* ``sweep_by_function``: a Python function scored for every trial in one pass
  over the data (each task calls it per trial on its Arrow batch and emits
  additive partial sums); a failing trial is recorded, not fatal.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparksweep.session import ship_package

# fixed values: the environment a distributed trainer reads
RANK_ENV = ("RANK", "WORLD_SIZE", "NODE_RANK")


# ---------------------------------------------------------------- UDF-1

def run_on_nodes(df: DataFrame, fn, schema: T.StructType | str, num_nodes: int = 1, procs_per_node: int = 1,
                 env: dict | None = None, kwargs: dict | None = None, shard_key: str | None = None) -> DataFrame:
    """Run ``fn(batches, rank, world_size, **kwargs)`` on every rank.

    ``batches`` is the rank's shard as an iterator of pandas DataFrames; ``fn``
    yields pandas DataFrames matching ``schema`` (without the ``rank`` column,
    which is added). Ranks see RANK, WORLD_SIZE and NODE_RANK plus ``env`` in
    their environment while ``fn`` runs.
    """
    if num_nodes < 1 or procs_per_node < 1:
        raise ValueError("num_nodes and procs_per_node must be >= 1")
    world = num_nodes * procs_per_node
    env = dict(env or {})
    kwargs = dict(kwargs or {})
    out_schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    out_schema = T.StructType([T.StructField("rank", T.IntegerType(), False)] + list(out_schema.fields))
    ship_package(df.sparkSession)
    shards = df.repartition(world, shard_key) if shard_key else df.repartition(world)

    def per_rank(batches):
        from pyspark import BarrierTaskContext
        ctx = BarrierTaskContext.get()
        rank = ctx.partitionId()
        before = dict(os.environ)
        os.environ.update({k: str(v) for k, v in env.items()})
        os.environ.update({"RANK": str(rank), "WORLD_SIZE": str(world), "NODE_RANK": str(rank // procs_per_node)})
        try:
            ctx.barrier()  # rendezvous: every rank is up
            for out in fn(batches, rank=rank, world_size=world, **kwargs):
                out = out.copy()
                out.insert(0, "rank", rank)
                yield out
            ctx.barrier()  # every rank finished
        finally:  # the worker process runs other tasks later
            os.environ.clear()
            os.environ.update(before)

    return shards.mapInPandas(per_rank, out_schema, barrier=True)


# ---------------------------------------------------------------- UDF-2

ALL_BACKENDS = ("kubernetes", "container", "localprocess")


@dataclass(frozen=True)
class JobOption:
    backends: tuple = field(default=ALL_BACKENDS, init=False)

    def check(self, backend: str) -> None:
        if backend not in self.backends:
            raise ValueError(f"the backend {backend!r} has no option {type(self).__name__}; it works on {list(self.backends)}")

    def apply(self, jobs: DataFrame) -> DataFrame:  # pragma: no cover - abstract
        raise NotImplementedError


def _map(d: dict) -> Column:
    if not d:
        return F.create_map().cast("map<string,string>")
    kv = []
    for k, v in d.items():
        kv += [F.lit(k), F.lit(v)]
    return F.create_map(*kv)


@dataclass(frozen=True)
class Name(JobOption):
    """Custom job name (a literal, or a Column to name many jobs at once); all backends."""
    name: object = None

    def apply(self, jobs):
        c = self.name if isinstance(self.name, Column) else F.lit(self.name)
        return jobs.withColumn("name", c)


@dataclass(frozen=True)
class Labels(JobOption):
    """Job labels, replacing any earlier labels as a whole; cluster backend only."""
    labels: dict = None
    backends: tuple = field(default=("kubernetes",), init=False)

    def apply(self, jobs):
        return jobs.withColumn("labels", _map(self.labels or {}))


@dataclass(frozen=True)
class Annotations(JobOption):
    """Job annotations, replacing earlier ones as a whole; cluster backend only."""
    annotations: dict = None
    backends: tuple = field(default=("kubernetes",), init=False)

    def apply(self, jobs):
        return jobs.withColumn("annotations", _map(self.annotations or {}))


def apply_options(jobs: DataFrame, options: list, backend: str = "kubernetes") -> DataFrame:
    """Check every option against the backend first, then apply them in order."""
    for o in options:
        o.check(backend)
    base = jobs
    if "labels" not in base.columns:
        base = base.withColumn("labels", F.create_map().cast("map<string,string>"))
    if "annotations" not in base.columns:
        base = base.withColumn("annotations", F.create_map().cast("map<string,string>"))
    return reduce(lambda df, o: df.transform(o.apply), options, base)


# ---------------------------------------------------------------- HPO-8

TRIALS_PER_PASS = 20_000  # trials whose parameters are shipped to the tasks at once


def sweep_by_function(data: DataFrame, trials: DataFrame, fn, partials: list[str], finalize: dict[str, Column],
                      params: list[str], trial_key: str = "trial_no", trials_per_pass: int = TRIALS_PER_PASS) -> DataFrame:
    """Score ``fn`` for every trial in one pass over ``data`` per ``trials_per_pass`` trials.

    ``fn(pdf, **params)`` gets one Arrow batch of the data and the trial's
    parameters as strings (as the reference passes them) and returns a dict of
    additive partial sums named in ``partials``. ``finalize`` turns the summed
    partials into metrics. A trial whose function raises anywhere is ``Failed``
    with NULL metrics and the whole text of its first error (that of the lowest
    partition, then batch).
    """
    ship_package(data.sparkSession)
    passes = max(1, -(-trials.count() // trials_per_pass))
    fields = [T.StructField(trial_key, T.LongType()), T.StructField("ok", T.BooleanType()),
              T.StructField("error", T.StringType()), T.StructField("at", T.LongType())]
    fields += [T.StructField(p, T.DoubleType()) for p in partials]
    schema = T.StructType(fields)

    def task(spec):
        def per_task(batches):
            from pyspark import TaskContext
            part = TaskContext.get().partitionId() << 32
            sums = {tn: dict.fromkeys(partials, 0.0) for tn, _ in spec}
            errors: dict = {}
            for no, pdf in enumerate(batches):
                for tn, kw in spec:
                    if tn in errors:
                        continue
                    try:
                        got = fn(pdf, **kw)
                        for p in partials:
                            sums[tn][p] += float(got[p])
                    except Exception as e:  # noqa: BLE001 - a failing trial is recorded
                        errors[tn] = (f"{type(e).__name__}: {e}", part + no)
            out = []
            for tn, _ in spec:
                if tn in errors:
                    text, at = errors[tn]
                    out.append({trial_key: tn, "ok": False, "error": text, "at": at, **dict.fromkeys(partials, None)})
                else:
                    out.append({trial_key: tn, "ok": True, "error": None, "at": None, **sums[tn]})
            yield pd.DataFrame(out, columns=[f.name for f in fields])
        return per_task

    from sparksweep.plans.sweep import spread
    data = spread(data)
    parts = []
    for i in range(passes):
        some = trials if passes == 1 else trials.filter(F.pmod(F.xxhash64(trial_key), F.lit(passes)) == i)
        rows = some.select(trial_key, *[F.col(p).cast("string").alias(p) for p in params]).collect()
        parts.append(data.mapInPandas(task([(r[trial_key], {p: r[p] for p in params}) for r in rows]), schema))
    agg = reduce(DataFrame.unionByName, parts).groupBy(trial_key).agg(
        F.bool_and("ok").alias("ok"), F.min_by("error", "at").alias("error"), *[F.sum(p).alias(p) for p in partials])
    status = F.when(F.col("ok"), F.lit("Succeeded")).otherwise(F.lit("Failed"))
    metrics = [F.when(F.col("ok"), m).alias(k) for k, m in finalize.items()]
    return agg.select(trial_key, status.alias("status"), "error", *metrics)


def run_trials(trials: DataFrame, fn, params: list[str], metrics: list[str], parallel_trials: int | None = None,
               trial_key: str = "trial_no") -> DataFrame:
    """Small-data form: ``fn(**params)`` once per trial, ``parallel_trials``
    at a time (one partition each; default: as many as the cluster has cores);
    returns metrics or the whole error text."""
    fields = [T.StructField(trial_key, T.LongType()), T.StructField("status", T.StringType()),
              T.StructField("error", T.StringType())] + [T.StructField(m, T.DoubleType()) for m in metrics]
    schema = T.StructType(fields)

    def per_part(batches):
        for pdf in batches:
            out = []
            # records keep each column's own type (iterrows would widen ints to floats)
            for r in pdf.to_dict("records"):
                kw = {p: None if pd.isna(r[p]) else str(r[p]) for p in params}
                try:
                    res = fn(**kw)
                    out.append({trial_key: int(r[trial_key]), "status": "Succeeded", "error": None,
                                **{m: float(res[m]) for m in metrics}})
                except Exception as e:  # noqa: BLE001
                    out.append({trial_key: int(r[trial_key]), "status": "Failed",
                                "error": f"{type(e).__name__}: {e}", **dict.fromkeys(metrics)})
            yield pd.DataFrame(out, columns=[f.name for f in fields])

    ship_package(trials.sparkSession)
    src = trials.select(trial_key, *[F.col(p) for p in params]).repartition(
        parallel_trials or trials.sparkSession.sparkContext.defaultParallelism, trial_key)
    return src.mapInPandas(per_part, schema)
