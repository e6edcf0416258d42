"""Status folds (AGG-2..7, AGG-9, AGG-10, WIN-4, TOP-3, JOB-5).

Every fold here is a per-group aggregate of mergeable parts (bool_or,
bool_and, sums, min_by / max_by), so a hot job or experiment is partially
aggregated in every task before the shuffle; no per-group lists are built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparksweep.operators.jobs import LIST_BUCKETS, COMPLETE, CREATED, FAILED, NODE, POD_SUCCEEDED, RUNNING, UNKNOWN
from sparksweep.operators.ordinal import with_row_index, with_running_sum

JOB_STATUSES = (CREATED, RUNNING, COMPLETE, FAILED)


# ---------------------------------------------------------------- AGG-2 / AGG-3

def conditions_fold(conditions: Column) -> Column:
    """Default Created; the last Complete/Failed condition with status "True" wins."""
    return F.aggregate(
        conditions, F.lit(CREATED),
        lambda acc, c: F.when(c["type"].isin(COMPLETE, FAILED) & (c["status"] == "True"), c["type"]).otherwise(acc))


def running_nodes(steps: DataFrame) -> DataFrame:
    """AGG-2: per job, node steps that are Running or Succeeded."""
    ok = F.col("name").startswith(NODE) & F.col("status").isin(RUNNING, POD_SUCCEEDED)
    return steps.groupBy("job").agg(F.sum(F.when(ok, 1).otherwise(0)).alias("running_nodes"))


def job_status(jobs: DataFrame, steps: DataFrame) -> DataFrame:
    """AGG-3: status from the conditions; only when there are none, Running if
    every node is running (AGG-2), else Created. ``jobs`` has job, num_nodes
    (effective) and conditions ARRAY<STRUCT<type,status>>."""
    rn = running_nodes(steps)
    x = jobs.join(rn, "job", "left").withColumn("running_nodes", F.coalesce("running_nodes", F.lit(0)))
    status = (F.when(F.size("conditions") > 0, conditions_fold(F.col("conditions")))
              .when(F.col("num_nodes") == F.col("running_nodes"), F.lit(RUNNING))
              .otherwise(F.lit(CREATED)))
    return x.withColumn("status", status)


# ---------------------------------------------------------------- AGG-4 / AGG-5

def container_status(state: Column, exit_code: Column) -> Column:
    """running -> Running, created -> Created, exited -> Complete on code 0,
    else (any other or missing code) Failed; any other state -> Unknown."""
    return (F.when(state == "running", F.lit(RUNNING)).when(state == "created", F.lit(CREATED))
            .when(state == "exited", F.when(exit_code == 0, F.lit(COMPLETE)).otherwise(F.lit(FAILED)))
            .otherwise(F.lit(UNKNOWN)))


def containers_job_status(containers: DataFrame, group: str = "job") -> DataFrame:
    """AGG-4: Failed > Running > all non-Unknown Complete > any Created > Unknown.
    Quirk kept: a job whose containers are all Unknown is Complete."""
    s = container_status(F.col("state"), F.col("exit_code")).alias("status")
    return containers.select(group, s).groupBy(group).agg(*_fold_flags()).select(group, _fold_status().alias("status"))


def _fold_flags() -> list[Column]:
    """The mergeable parts of the AGG-4 fold over ``status``."""
    s = F.col("status")
    return [F.bool_or(s == FAILED).alias("f"), F.bool_or(s == RUNNING).alias("r"),
            F.bool_and(s.isin(COMPLETE, UNKNOWN)).alias("c"), F.bool_or(s == CREATED).alias("m")]


def _merge_flags() -> list[Column]:
    return [(F.bool_and if c == "c" else F.bool_or)(c).alias(c) for c in "frcm"]


def _fold_status() -> Column:
    return (F.when(F.col("f"), F.lit(FAILED)).when(F.col("r"), F.lit(RUNNING)).when(F.col("c"), F.lit(COMPLETE))
            .when(F.col("m"), F.lit(CREATED)).otherwise(F.lit(UNKNOWN)))


def process_job_status(steps: DataFrame, status_col: str = "job_status", group: str = "job") -> DataFrame:
    """AGG-5: Failed > Running > Complete (all steps Complete) > Created.
    The reference can never return Complete; we do when every step is."""
    s = F.col(status_col)
    agg = steps.groupBy(group).agg(
        F.bool_or(s == FAILED).alias("f"), F.bool_or(s == RUNNING).alias("r"),
        F.bool_and(F.coalesce(s == COMPLETE, F.lit(False))).alias("c"))
    st = (F.when(F.col("f"), F.lit(FAILED)).when(F.col("r"), F.lit(RUNNING)).when(F.col("c"), F.lit(COMPLETE))
          .otherwise(F.lit(CREATED)))
    return agg.select(group, st.alias("status"))


def pod_to_job_status(pod_status: Column) -> Column:
    """Step (pod) phase in process-job vocabulary: Succeeded -> Complete,
    Pending or unknown -> Created."""
    return (F.when(pod_status == POD_SUCCEEDED, F.lit(COMPLETE)).when(pod_status == FAILED, F.lit(FAILED))
            .when(pod_status == RUNNING, F.lit(RUNNING)).otherwise(F.lit(CREATED)))


# ---------------------------------------------------------------- AGG-6

EXP_SUCCEEDED = "Succeeded"


def experiment_status(conditions: DataFrame, trial_status: DataFrame, experiment: str = "experiment",
                      order: str = "pos") -> DataFrame:
    """AGG-6 as mergeable aggregates. The ordered fold (Created; Succeeded=True
    -> Complete; Failed=True -> Failed; any other condition -> Running if some
    trial runs) ends on the last condition that changes the state: with a running
    trial that is the last condition of all, otherwise the last decisive one."""
    decisive = F.col("status") == "True"
    dec_type = F.when(decisive & (F.col("type") == EXP_SUCCEEDED), F.lit(COMPLETE)) \
        .when(decisive & (F.col("type") == FAILED), F.lit(FAILED))
    c = conditions.select(experiment, order, dec_type.alias("effect"))
    per = c.groupBy(experiment).agg(
        F.max_by(F.coalesce("effect", F.lit(RUNNING)), F.col(order)).alias("last_any"),
        F.max_by(F.col("effect"), F.when(F.col("effect").isNotNull(), F.col(order))).alias("last_decisive"))
    run = trial_status.groupBy(experiment).agg(F.bool_or(F.col("status") == RUNNING).alias("has_running"))
    x = per.join(run, experiment, "full")
    st = (F.when(F.coalesce("has_running", F.lit(False)) & F.col("last_any").isNotNull(), F.col("last_any"))
          .otherwise(F.coalesce("last_decisive", F.lit(CREATED))))
    return x.select(experiment, st.alias("status"))


# ---------------------------------------------------------------- AGG-7 / TOP-3

def containers_to_jobs(containers: DataFrame, list_pos: str = "idx") -> DataFrame:
    """AGG-7: containers grouped by job label in one pass: node count, creation
    time of the first listed container (a failed parse gives NULL, not "now"),
    the AGG-4 status and the steps (name, status) sorted by name."""
    created = F.col("created")
    if dict(containers.dtypes).get("created") == "string":
        created = F.try_to_timestamp(created)
    s = container_status(F.col("state"), F.col("exit_code"))
    x = containers.select("job", "name", list_pos, created.alias("created"), s.alias("status"))
    step = F.struct("name", "status")
    part = x.groupBy("job", F.pmod(F.xxhash64("name"), F.lit(LIST_BUCKETS)).alias("_bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.min_by("created", list_pos).alias("created"), F.min(list_pos).alias("first"),
        *_fold_flags(), F.collect_list(step).alias("part"))
    whole = part.groupBy("job").agg(
        F.sum("n").alias("num_nodes"), F.min_by("created", "first").alias("created"), *_merge_flags(),
        F.array_sort(F.flatten(F.collect_list("part"))).alias("steps"))
    return whole.select("job", "num_nodes", "created", _fold_status().alias("status"), "steps")


def step_order(steps: DataFrame, name: str = "name", group: str = "job", numeric: bool = False) -> DataFrame:
    """TOP-3: position of each step in its job's list, lexicographic by name
    (``node-10`` before ``node-2``, as the reference sorts). ``numeric`` orders
    by the text before the trailing number, then the number (``node-2`` first).
    Skew-safe ranks from the range-partitioned index."""
    if not numeric:
        x = with_row_index(steps, [name], "_g", group_cols=[group], group_index_col="step_rank")
        return x.drop("_g")
    keyed = steps.withColumn("_stem", F.regexp_replace(F.col(name), r"\d+$", "")).withColumn(
        "_num", F.regexp_extract(F.col(name), r"(\d+)$", 1).try_cast("bigint"))
    x = with_row_index(keyed, ["_stem", "_num", name], "_g", group_cols=[group], group_index_col="step_rank")
    return x.drop("_g", "_stem", "_num")


# ---------------------------------------------------------------- AGG-9

def check_wait(wanted, timeout_s: float, polling_s: float) -> None:
    """The argument checks of a wait on a cluster."""
    unknown = sorted(set(wanted) - set(JOB_STATUSES))
    if unknown:
        raise ValueError(f"can't wait for {unknown}; a job is one of {sorted(JOB_STATUSES)}")
    if timeout_s < polling_s:
        raise ValueError(f"a wait of {timeout_s} s ends before the first poll after {polling_s} s")


def wait_outcome(events: DataFrame, wanted=(COMPLETE,), timeout_s: int = 600, polling_s: int = 2,
                 check: bool = True, job: str = "job") -> DataFrame:
    """AGG-9 over a status history (job, ts, seq, status).

    The first change (by ts, seq) into a wanted status or into Failed decides:
    ``reached`` if wanted (tested first, as the container backend does), else
    ``failed``; nothing deciding before first-event + timeout -> ``timed_out``.
    ``check`` applies the cluster backends' argument checks.
    """
    wanted = tuple(wanted)
    if check:
        check_wait(wanted, timeout_s, polling_s)
    st = F.col("status")
    deciding = st.isin(*wanted) | (st == FAILED)
    key = F.when(deciding, F.struct("ts", "seq"))
    g = events.groupBy(job).agg(
        F.min("ts").alias("start"),
        F.min_by(F.struct(st.alias("status"), F.col("ts").alias("ts")), key).alias("d"))
    deadline = F.col("start") + F.make_dt_interval(secs=F.lit(float(timeout_s)))
    hit = F.col("d.ts").isNotNull() & (F.col("d.ts") <= deadline)
    outcome = (F.when(hit & F.col("d.status").isin(*wanted), F.lit("reached"))
               .when(hit, F.lit("failed")).otherwise(F.lit("timed_out")))
    return g.select(job, "start", outcome.alias("outcome"),
                    F.when(hit, F.col("d.status")).alias("status"),
                    F.when(hit, F.col("d.ts")).otherwise(deadline).alias("decided_at"))


# ---------------------------------------------------------------- AGG-10 / WIN-4

def sweep_progress(trials: DataFrame, num_trials: int, max_failed_trials: int | None,
                   experiment: str = "experiment") -> DataFrame:
    """AGG-10: trials by status against the sweep's limits."""
    s = F.col("status")

    def cnt(v):
        return F.sum(F.when(s == v, 1).otherwise(0)).cast("bigint")

    g = trials.groupBy(experiment).agg(
        F.count(F.lit(1)).alias("trials"), cnt(COMPLETE).alias("complete"), cnt(FAILED).alias("failed"),
        cnt(RUNNING).alias("running"), cnt(CREATED).alias("created"))
    mf = F.lit(max_failed_trials) if max_failed_trials is not None else F.lit(None).cast("bigint")
    return g.select(
        "*",
        F.greatest(F.lit(num_trials) - F.col("trials"), F.lit(0)).cast("bigint").alias("remaining"),
        (mf - F.col("failed")).cast("bigint").alias("failures_left"),
        F.coalesce(F.col("failed") > mf, F.lit(False)).alias("budget_exceeded"))


def failure_budget(trials: DataFrame, max_failed_trials: int, experiment: str = "experiment",
                   order: str = "trial_no", failed: Column | None = None) -> DataFrame:
    """WIN-4 (our table semantics): a trial counts while the failures before it
    in its experiment are within the budget. The count before each trial is a
    skew-safe segmented prefix sum (``ordinal.with_running_sum``), so an
    experiment with a third of all trials is still spread over many tasks."""
    f = failed if failed is not None else (F.col("status") == FAILED)
    x = trials.withColumn("_failed", F.when(f, 1).otherwise(0))
    x = with_running_sum(x, [order], "_failed", "_before", group_cols=[experiment])
    return (x.withColumn("failed_before", F.round(F.col("_before")).cast("bigint")).drop("_failed", "_before")
            .withColumn("counts", F.col("failed_before") <= max_failed_trials))


# ---------------------------------------------------------------- JOB-5

# fixed value: the accelerator resource name
GPU_RESOURCE = "nvidia.com/gpu"


def resource_totals(resources: DataFrame, jobs: DataFrame) -> DataFrame:
    """JOB-5: keys lower-cased, ``gpu`` -> ``nvidia.com/gpu``; per-node amounts
    summed and multiplied by the job's node count, rolled up per runtime."""
    k = F.lower(F.col("res_key"))
    r = resources.select("job", F.when(k == "gpu", F.lit(GPU_RESOURCE)).otherwise(k).alias("resource"),
                         F.col("quantity").try_cast("double").alias("q"))
    per_job = r.groupBy("job", "resource").agg(F.sum("q").alias("per_node"))
    j = jobs.select("job", "runtime_ref", "num_nodes")
    x = per_job.join(j, "job")
    return x.groupBy("runtime_ref", "resource").agg(
        F.sum(F.col("per_node") * F.col("num_nodes")).alias("total"),
        F.count(F.lit(1)).alias("jobs"))
