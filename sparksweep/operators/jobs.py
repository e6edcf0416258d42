"""Job documents, runtimes and steps (PRJ-1, JON-1, JON-2, JON-4, FLT-1..4, AGG-11).

Joins carry no broadcast hints: Spark broadcasts a side that its own byte
threshold allows and splits skewed partitions otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: status vocabulary and step names
CREATED, RUNNING, COMPLETE, FAILED, UNKNOWN = "Created", "Running", "Complete", "Failed", "Unknown"
POD_PENDING, POD_SUCCEEDED = "Pending", "Succeeded"
NODE = "node"
INITIALIZERS = ("dataset-initializer", "model-initializer")


# ---------------------------------------------------------------- documents (PRJ-1)

JOB_DOC_SCHEMA = T.StructType([
    T.StructField("metadata", T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("namespace", T.StringType()),
        T.StructField("creationTimestamp", T.StringType()),
    ])),
    T.StructField("spec", T.StructType([
        T.StructField("runtimeRef", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField("trainer", T.StructType([T.StructField("numNodes", T.StringType())])),
    ])),
    T.StructField("status", T.StructType([
        T.StructField("conditions", T.ArrayType(T.StructType([
            T.StructField("type", T.StringType()), T.StructField("status", T.StringType())]))),
    ])),
])


def job_documents(jobs: DataFrame) -> DataFrame:
    """Render job rows as JSON documents shaped like the cluster's job objects; every second job's node count is
    quoted, and each 23rd job has no namespace."""
    conds = F.when(F.col("cond_type").isNull(), F.array().cast(
        "array<struct<type:string,status:string>>")).otherwise(
        F.array(F.struct(F.col("cond_type").alias("type"), F.col("cond_status").alias("status"))))
    space = F.when(F.col("job_no") % 23 != 0, F.concat(F.lit("team-"), F.col("job_no") % 3))

    def doc(num_nodes: Column) -> Column:
        return F.to_json(F.struct(
            F.struct(F.col("job").alias("name"), space.alias("namespace"),
                     F.date_format("created", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("creationTimestamp")).alias("metadata"),
            F.struct(F.struct(F.col("runtime_ref").alias("name")).alias("runtimeRef"),
                     F.struct(num_nodes.alias("numNodes")).alias("trainer")).alias("spec"),
            F.struct(conds.alias("conditions")).alias("status")))

    count = F.col("num_nodes")
    return jobs.select(F.when(F.col("job_no") % 2 == 0, doc(count)).otherwise(doc(count.cast("string"))).alias("doc"))


DOC_TIMES = ("yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'",
             "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")


def document_time(text: Column) -> Column:
    """The time of a document in any of its spellings; NULL if it has none of them."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in DOC_TIMES])


def last_wins_map(items: Column, key: str, value: str) -> Column:
    """A list of named values as a MAP; of several with one name the last counts. Items without a name are left out."""
    named = F.filter(items, lambda e: e[key].isNotNull())
    names = F.array_distinct(F.transform(named, lambda e: e[key]))
    return F.map_from_entries(F.transform(names, lambda k: F.struct(
        k.alias("key"), F.element_at(F.filter(named, lambda e: e[key] == k), -1)[value].alias("value"))))


def parse_job_documents(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """Flatten job documents: job, namespace, runtime_ref, num_nodes (quoted or not, 0 means unset),
    created, conditions, error (the first required field that is missing or
    unreadable; the reference raises there)."""
    d = F.from_json(F.col(doc_col), JOB_DOC_SCHEMA).alias("d")
    x = docs.select(d)
    text = F.col("d.metadata.creationTimestamp")
    created, nodes = document_time(text), F.col("d.spec.trainer.numNodes")
    return x.select(
        F.col("d.metadata.name").alias("job"),
        F.col("d.metadata.namespace").alias("namespace"),
        F.col("d.spec.runtimeRef.name").alias("runtime_ref"),
        F.nullif(F.trim(nodes).try_cast("bigint"), F.lit(0)).alias("job_num_nodes"),
        created.alias("created"),
        F.coalesce(F.col("d.status.conditions"),
                   F.array().cast("array<struct<type:string,status:string>>")).alias("conditions"),
        F.when(F.col("d.metadata.name").isNull(), F.lit("missing name"))
        .when(F.coalesce(F.col("d.metadata.namespace"), F.lit("")) == "", F.lit("missing namespace"))
        .when(F.col("d.spec").isNull(), F.lit("missing spec"))
        .when(text.isNull(), F.lit("missing creation time"))
        .when(created.isNull(), F.lit("unreadable creation time"))
        .when(nodes.isNotNull() & F.trim(nodes).try_cast("bigint").isNull(), F.lit("node count is not a number")).alias("error"),
    )


def spread_nulls(key: Column, *by: Column) -> Column:
    """A join key whose nulls, which match nothing, are dealt over all partitions."""
    return F.coalesce(key, F.concat(F.lit("\u0000"), F.xxhash64(*by).cast("string")))


def with_runtime(jobs: DataFrame, runtimes: DataFrame, ref: str = "runtime_ref", job: str = "job") -> DataFrame:
    """JON-1: attach the runtime by name. A job whose runtime is missing keeps
    its row with ``runtime_found = false`` (the reference raises)."""
    rt = runtimes.select(F.col("name").alias("_rt_name"), *[F.col(c).alias(f"rt_{c}")
                                                             for c in runtimes.columns if c != "name"])
    keyed = jobs.withColumn("_key", spread_nulls(F.col(ref), F.col(job)))
    out = keyed.join(rt, F.col("_key") == F.col("_rt_name"), "left")
    return out.withColumn("runtime_found", F.col("_rt_name").isNotNull()).drop("_rt_name", "_key")


def effective_num_nodes(job_nodes: Column, runtime_nodes: Column) -> Column:
    """The job's node count, else (NULL or 0) the runtime's."""
    return F.coalesce(F.nullif(job_nodes, F.lit(0)), runtime_nodes)


# ---------------------------------------------------------------- lookups and filters

def lookup(df: DataFrame, names: DataFrame, key: str = "job", name_col: str = "name") -> DataFrame:
    """FLT-1: every requested name with ``found``; the missing ones are the
    errors. One left join of the distinct names against the distinct keys
    (both sides already hash partitioned on the name by their distinct)."""
    req = names.select(F.col(name_col).alias("_req")).distinct()
    have = df.select(F.col(key).alias("_req")).distinct().withColumn("_hit", F.lit(True))
    x = req.join(have, "_req", "left")
    return x.select(F.col("_req").alias(name_col), F.coalesce(F.col("_hit"), F.lit(False)).alias("found"))


def jobs_of_runtime(jobs: DataFrame, runtime: str, ref: str = "runtime_ref") -> DataFrame:
    """FLT-2: jobs of one runtime; jobs without a runtime reference are kept (quirk)."""
    return jobs.filter(F.col(ref).isNull() | (F.col(ref) == runtime))


def label_selector(labels: Column, equals: dict | None = None, present: list | tuple = (),
                   within: dict | None = None) -> Column:
    """FLT-3: ``k=v``, ``k`` present and ``k in (..)`` terms, AND-ed, on a MAP column."""
    terms = [labels[k] == F.lit(v) for k, v in (equals or {}).items()]
    terms += [F.map_contains_key(labels, k) for k in present]
    terms += [labels[k].isin(list(vs)) for k, vs in (within or {}).items()]
    return reduce(lambda a, b: a & b, terms, F.lit(True))


def promote_labels(df: DataFrame, keys: list[str], labels: str = "labels") -> DataFrame:
    """Copy hot label keys out of the MAP into real columns (``label_<key>``
    with non-word characters as ``_``). Filters on those columns reach the
    parquet scan as pushed filters; filters on map entries never do."""
    import re
    return df.select("*", *[F.col(labels)[k].alias("label_" + re.sub(r"\W", "_", k)) for k in keys])


def step_labels(steps: DataFrame) -> DataFrame:
    """Steps with the pod labels of the cluster backend."""
    kind = F.when(F.col("name").startswith(NODE), F.lit(NODE)).otherwise(F.col("name"))
    return steps.withColumn("labels", F.create_map(
        F.lit("jobset-name"), F.col("job"), F.lit("replicatedjob-name"), kind,
        F.lit("job-completion-index"), F.col("idx").cast("string")))


def validate(df: DataFrame, required: dict[str, str], strict: bool = False, cache: bool = False):
    """FLT-4: split rows into (valid, rejects). ``required`` maps a column to the
    reason text used when it is NULL. Strict mode raises on the first reject.
    ``cache`` keeps the tagged rows (memory, then disk) when both outputs are used,
    so the input is read once."""
    reasons = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(r)) for c, r in required.items()]))
    tagged = df.withColumn("_reasons", reasons)
    if cache:
        tagged = tagged.persist()
    valid = tagged.filter(F.size("_reasons") == 0).drop("_reasons")
    rejects = tagged.filter(F.size("_reasons") > 0).withColumn("reason", F.array_join("_reasons", "; ")).drop(
        "_reasons")
    if strict:
        bad = rejects.limit(1).collect()
        if bad:
            raise ValueError(f"invalid row: {bad[0].asDict()}")
    return valid, rejects


# ---------------------------------------------------------------- devices (AGG-11)

# fixed values: resource names of the devices, in order of precedence
DEVICES = {"gpu": "nvidia.com/gpu", "tpu": "google.com/tpu", "cpu": "cpu"}


def container_device(limits: Column) -> tuple[Column, Column, Column]:
    """(device, count, error) of a container from its limits MAP: gpu before tpu
    before cpu. No limits at all: unknown, no error; limits without a known
    device: an error."""
    keys = DEVICES.items()
    device = F.coalesce(*[F.when(F.map_contains_key(limits, k), F.lit(d)) for d, k in keys])
    count = F.coalesce(*[F.when(F.map_contains_key(limits, k), F.try_element_at(limits, F.lit(k))) for _, k in keys])
    return device, count, F.when(limits.isNotNull() & device.isNull(), F.lit("no known device in the limits"))


def runtime_devices(runtimes: DataFrame) -> DataFrame:
    """Device from the ``limits`` MAP of the trainer container; per-node count
    overridden by the process count (torch / MPI); times num_nodes when numeric."""
    device, count, error = container_device(F.col("limits"))
    per_node = F.coalesce(F.col("procs_per_node").cast("string"), count)
    total = F.when(per_node.rlike(r"^\d+$") & (F.coalesce(F.col("num_nodes"), F.lit(0)) != 0),
                   (per_node.cast("bigint") * F.col("num_nodes")).cast("string")).otherwise(per_node)
    return runtimes.select(
        "name", "framework", "num_nodes",
        F.coalesce(device, F.lit(UNKNOWN)).alias("device"),
        F.coalesce(total, F.lit(UNKNOWN)).alias("device_count"), error.alias("error"))


def device_rollup(devices: DataFrame) -> DataFrame:
    ok = devices.filter(F.col("error").isNull())
    return ok.groupBy("framework", "device").agg(
        F.count(F.lit(1)).alias("runtimes"),
        F.sum(F.col("device_count").try_cast("bigint")).alias("devices"))


# ---------------------------------------------------------------- steps (JON-2)

# fixed values: pod label values and the process-count environment variable
LAUNCHER = "launcher"
NPROC_ENV = "PET_NPROC_PER_NODE"
MPI_COMMAND = "mpirun"


STEP_COLUMNS = ("step", "pod_name", "status", "device", "device_count")


def job_steps(jobs: DataFrame, pods: DataFrame, launcher_first: bool = False) -> DataFrame:
    """JON-2 flat: one row per (job, step); a job without steps keeps one row
    with NULL step (the reference's empty list). One join.

    ``jobs``: job, command (the trainer's first word). ``pods``: job, pod_name,
    rjob (replicated job), job_index, limits (MAP, of the pod's own container),
    env_nproc, status. Initializer pods keep their replicated-job name; node and
    launcher pods become ``node-<index>``, where the workers of an ``mpirun``
    trainer get index + 1 (its launcher is node-0). Pods of other replicated jobs
    are no steps. Device and count come from the container's limits; a node's
    count is PET_NPROC_PER_NODE if the pod sets it to digits. With
    ``launcher_first`` job_index numbers all pods of an ``mpirun`` job, its
    launcher first, and is taken apart here."""
    mpi, index, rjob = F.col("command") == MPI_COMMAND, F.col("job_index"), F.col("rjob")
    known = pods.filter(rjob.isin(*INITIALIZERS, NODE, LAUNCHER)).withColumn("_has", F.lit(True))
    x = jobs.select("job", "command").join(known, "job", "left")
    if launcher_first:
        worker = mpi & (rjob == NODE)
        x = x.withColumns({"rjob": F.when(worker & (index == 0), F.lit(LAUNCHER)).otherwise(rjob),
                           "job_index": F.when(worker & (index > 0), index - 1).otherwise(index)})
    device, count, _ = container_device(F.col("limits"))
    is_init = rjob.isin(*INITIALIZERS)
    shift = F.when(mpi & (rjob != LAUNCHER), F.lit(1)).otherwise(F.lit(0))
    env, has = F.col("env_nproc"), F.col("_has")
    return x.select(
        "job", F.when(has, F.when(is_init, rjob).otherwise(F.concat(F.lit(NODE + "-"), index + shift))).alias("step"),
        "pod_name", "status", F.when(has, F.coalesce(device, F.lit(UNKNOWN))).alias("device"),
        F.when(has, F.when(~is_init & env.rlike(r"^\d+$"), env).otherwise(F.coalesce(count, F.lit(UNKNOWN)))).alias("device_count"))


LIST_BUCKETS = 64


def nested_list(flat: DataFrame, keys: list[str], item: Column, present: Column, out: str) -> DataFrame:
    """One row per ``keys`` with the sorted list of its items. A long list is
    gathered in two levels, by (keys, bucket) and then by keys, so that only the
    finished list itself meets in one task."""
    bucket = F.pmod(F.xxhash64(item), F.lit(LIST_BUCKETS))
    parts = flat.withColumn("_item", F.when(present, item)).groupBy(*keys, bucket.alias("_bucket")).agg(
        F.collect_list("_item").alias("_part"))  # nulls are left out
    return parts.groupBy(*keys).agg(F.array_sort(F.flatten(F.collect_list("_part"))).alias(out))


def nested_steps(flat: DataFrame) -> DataFrame:
    """The reference's nested shape: one row per job with its sorted step list."""
    return nested_list(flat, ["job"], F.struct(*STEP_COLUMNS), F.col("step").isNotNull(), "steps")


# ---------------------------------------------------------------- networks (JON-4)

def with_network(containers: DataFrame, networks: DataFrame) -> DataFrame:
    """JON-4: container -> its network record (by the job label) for runtime and workdir."""
    n = networks.select(F.col("network").alias("_net"), "runtime", "workdir")
    return containers.join(n, containers.job == n._net, "left").drop("_net")


# ---------------------------------------------------------------- trials (JON-3)

def experiment_trials(trials: DataFrame, assignments: DataFrame, job_status: DataFrame) -> DataFrame:
    """JON-3: experiment -> trials -> train jobs (trial name = job name), flat:
    one row per (trial, parameter); assignments with a NULL name or value are
    dropped; a trial without assignments keeps one row."""
    a = assignments.filter(F.col("param").isNotNull() & F.col("value").isNotNull()).select(
        F.col("trial").alias("_t"), "param", "value")
    st = job_status.select(F.col("job").alias("_j"), F.col("status").alias("trial_status"))
    x = trials.join(st, trials.trial == st._j, "left").drop("_j")
    return x.join(a, x.trial == a._t, "left").drop("_t")


def nested_parameters(flat: DataFrame) -> DataFrame:
    """The reference's shape: parameters as a MAP per trial. Of several values assigned to one name the largest
    text counts (the flat rows have no order of their own)."""
    lists = nested_list(flat, ["experiment", "trial", "trial_status"], F.struct("param", "value"),
                        F.col("param").isNotNull(), "_items")
    return lists.select("experiment", "trial", "trial_status", last_wins_map(F.col("_items"), "param", "value").alias("parameters"))


def with_metrics(trials: DataFrame, observations: DataFrame) -> DataFrame:
    """Trials (one row each) with their metrics as a sorted list of (metric, min, max, latest)."""
    item = F.struct("metric", "min", "max", "latest")
    lists = nested_list(observations.withColumnRenamed("trial", "_t"), ["_t"], item, F.col("metric").isNotNull(), "metrics")
    empty = F.array().cast(lists.schema["metrics"].dataType)
    return trials.join(lists, F.col("trial") == F.col("_t"), "left").withColumn("metrics", F.coalesce("metrics", empty)).drop("_t")
