"""Registered job, step and status queries (PRJ-1, JON-1/2/4, FLT-1..4,
AGG-2..7, AGG-9..11, TOP-3, WIN-4, JOB-5)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from sparksweep.operators import jobs as J
from sparksweep.operators import status as S
from sparksweep.plans import views as V
from sparksweep.plans.registry import register
from sparksweep.plans.views import table, with_views

RUNTIME = "rt-3"
TIMEOUT_S = 6 * 3600
NUM_TRIALS, MAX_FAILED = 12, 2


def parsed_jobs(spark, sf_dir):
    """Job documents (JSON text) -> flat jobs with runtime and effective node count."""
    docs = J.job_documents(V.jobs(spark, sf_dir))
    flat = J.parse_job_documents(docs)
    x = J.with_runtime(flat, V.runtimes(spark, sf_dir))
    return x.withColumn("num_nodes", J.effective_num_nodes(F.col("job_num_nodes"), F.col("rt_num_nodes")))


def flat_jobs(spark, sf_dir):
    """Job rows with conditions array, runtime and effective node count (no JSON round trip)."""
    jobs = V.jobs(spark, sf_dir).select(
        "job", "runtime_ref", F.col("num_nodes").alias("job_num_nodes"),
        F.when(F.col("cond_type").isNull(), F.array().cast("array<struct<type:string,status:string>>"))
        .otherwise(F.array(F.struct(F.col("cond_type").alias("type"), F.col("cond_status").alias("status"))))
        .alias("conditions"))
    x = J.with_runtime(jobs, V.runtimes(spark, sf_dir).select("name", "num_nodes"))
    return x.withColumn("num_nodes", J.effective_num_nodes(F.col("job_num_nodes"), F.col("rt_num_nodes")))


def job_statuses(spark, sf_dir):
    return S.job_status(flat_jobs(spark, sf_dir), V.steps(spark, sf_dir))


_EFF = "coalesce(nullif(j.num_nodes, 0), r.num_nodes)"
_RN_SQL = """SELECT job, CAST(sum(CASE WHEN name LIKE 'node%' AND status IN ('Running', 'Succeeded') THEN 1 ELSE 0 END) AS BIGINT)
       AS running_nodes FROM v_steps GROUP BY job"""
_STATUS_SQL = f"""
SELECT j.job, j.experiment, j.job_no, {_EFF} AS num_nodes, coalesce(rn.running_nodes, 0) AS running_nodes,
       CASE WHEN j.cond_type IS NOT NULL THEN
                 CASE WHEN j.cond_type IN ('Complete', 'Failed') AND j.cond_status = 'True' THEN j.cond_type ELSE 'Created' END
            WHEN {_EFF} = coalesce(rn.running_nodes, 0) THEN 'Running' ELSE 'Created' END AS status
FROM v_jobs j LEFT JOIN v_runtimes r ON r.name = j.runtime_ref LEFT JOIN rn ON rn.job = j.job"""
_STATUS_CTES = {"rn": _RN_SQL, "js": _STATUS_SQL}


@register("prj1_job_documents", with_views(f"""
SELECT j.job, j.runtime_ref, {_EFF} AS num_nodes, j.created,
       CAST(CASE WHEN j.cond_type IS NULL THEN 0 ELSE 1 END AS INTEGER) AS n_conditions, r.name IS NOT NULL AS runtime_found,
       CASE WHEN job_no % 23 <> 0 THEN concat('team-', job_no % 3) END AS namespace,
       CASE WHEN job_no % 23 = 0 THEN 'missing namespace' END AS error
FROM v_jobs j LEFT JOIN v_runtimes r ON r.name = j.runtime_ref""", "v_jobs", "v_runtimes"))
def prj1_job_documents(spark, sf_dir):
    """JSON job documents flattened; node count falls back to the runtime's (0 = unset)."""
    x = parsed_jobs(spark, sf_dir)
    return x.select("job", "runtime_ref", "num_nodes", F.col("created").cast("timestamp_ntz").alias("created"),
                    F.size("conditions").alias("n_conditions"), "runtime_found", "namespace", "error")


@register("jon1_job_runtime", with_views("""
SELECT j.job, j.runtime_ref, r.framework, r.name IS NOT NULL AS runtime_found
FROM v_jobs j LEFT JOIN v_runtimes r ON r.name = j.runtime_ref""", "v_jobs", "v_runtimes"))
def jon1_job_runtime(spark, sf_dir):
    """Every job with its runtime by name; a missing runtime is flagged, not dropped."""
    x = J.with_runtime(V.jobs(spark, sf_dir).select("job", "runtime_ref"), V.runtimes(spark, sf_dir))
    return x.select("job", "runtime_ref", F.col("rt_framework").alias("framework"), "runtime_found")


_PODS_SQL = """
SELECT job, step, pod_name, status, CASE lim WHEN 0 THEN 'gpu' WHEN 1 THEN 'cpu' ELSE 'Unknown' END AS device,
       CASE WHEN NOT init AND kind = 1 THEN '4' ELSE CASE lim WHEN 0 THEN '2' WHEN 1 THEN '8' ELSE 'Unknown' END END AS device_count
FROM (SELECT s.job, s.name NOT LIKE 'node%' AS init, s.kind, s.status, concat(s.job, '-', s.name) AS pod_name,
             CASE WHEN s.idx % 3 = 0 AND s.kind = 2 THEN 3 ELSE s.idx % 3 END AS lim,
             CASE WHEN s.name NOT LIKE 'node%' THEN s.name ELSE concat('node-', s.idx) END AS step
      FROM v_steps s WHERE s.name NOT LIKE 'node%' OR s.idx % 6 <> 5) p"""
_STEPS_SQL = "SELECT j.job, p.step, p.pod_name, p.status, p.device, p.device_count FROM v_jobs j LEFT JOIN pods p ON p.job = j.job"


def _job_steps(spark, sf_dir):
    """Pods of every step, with limits of their own; some belong to a replicated job that is no step."""
    st = V.steps(spark, sf_dir)
    job = J.with_runtime(V.jobs(spark, sf_dir).select("job", "runtime_ref"), V.runtimes(spark, sf_dir).select("name", "framework"))
    jobs = job.select("job", F.when(F.col("rt_framework") == "mpi", F.lit("mpirun")).otherwise(F.lit("python")).alias("command"))
    init, idx, kind = ~F.col("name").startswith("node"), F.col("idx"), F.col("kind")
    limits = V.limits_map({"nvidia.com/gpu": F.when((idx % 3 == 0) & (kind != 2), F.lit("2")), "cpu": F.when(idx % 3 == 1, F.lit("8")),
                           "example.com/npu": F.when((idx % 3 == 0) & (kind == 2), F.lit("1"))})
    pods = st.select(
        "job", F.concat_ws("-", "job", "name").alias("pod_name"), "status", limits.alias("limits"), idx.cast("long").alias("job_index"),
        F.when(init, F.col("name")).when(idx % 6 == 5, F.lit("exporter")).otherwise(F.lit("node")).alias("rjob"),
        F.when(kind == 1, F.lit("4")).when(kind == 2, F.lit("four")).alias("env_nproc"))
    # an mpi job's first pod is its launcher, the others count from 0
    return J.job_steps(jobs, pods, launcher_first=True)


@register("jon2_job_steps", with_views(_STEPS_SQL, "v_jobs", "v_steps", ctes={"pods": _PODS_SQL}))
def jon2_job_steps(spark, sf_dir):
    """Jobs with their steps built from pods (one-to-many, flat): step names
    from pod labels (MPI workers shifted by one), device and count from the
    pod's own limits or process count; jobs without steps keep one row."""
    return _job_steps(spark, sf_dir)


@register("jon2_nested_steps", with_views(f"""
SELECT job, CASE WHEN step IS NOT NULL THEN row_number() OVER (PARTITION BY job ORDER BY step) - 1 END AS step_no,
       step, pod_name, status, device, device_count FROM ({_STEPS_SQL}) f""", "v_jobs", "v_steps", ctes={"pods": _PODS_SQL}))
def jon2_nested_steps(spark, sf_dir):
    """One row per job with its sorted step list, shown exploded with positions."""
    nested = J.nested_steps(_job_steps(spark, sf_dir))
    x = nested.select("job", F.posexplode_outer("steps").alias("step_no", "s"))
    return x.select("job", F.col("step_no").cast("bigint").alias("step_no"), "s.*")


_NET_SQL = """SELECT DISTINCT c.job AS network, j.runtime_ref AS runtime, concat('/workdir/', c.job) AS workdir
FROM v_containers c JOIN v_jobs j ON j.job = c.job"""


@register("jon4_container_network", with_views("""
SELECT c.name, c.job, n.runtime, n.workdir FROM v_containers c LEFT JOIN nets n ON n.network = c.job""",
                                               "v_containers", "v_jobs", ctes={"nets": _NET_SQL}))
def jon4_container_network(spark, sf_dir):
    """Containers with the runtime and workdir labels of their job's network."""
    cont = V.containers(spark, sf_dir)
    jobs = V.jobs(spark, sf_dir).select("job", "runtime_ref")
    nets = (cont.select("job").distinct().join(jobs, "job")
            .select(F.col("job").alias("network"), F.col("runtime_ref").alias("runtime"),
                    F.concat(F.lit("/workdir/"), F.col("job")).alias("workdir")))
    return J.with_network(cont.select("name", "job"), nets)


@register("flt1_lookup_by_name", with_views("""
SELECT DISTINCT r.name, j.job IS NOT NULL AS found
FROM (SELECT concat('job-', o_orderkey * 2) AS name FROM orders) r LEFT JOIN v_jobs j ON j.job = r.name""", "v_jobs"))
def flt1_lookup_by_name(spark, sf_dir):
    """Requested job names (twice every order key): found ones and missing ones."""
    names = table(spark, sf_dir, "orders").select(F.concat(F.lit("job-"), F.col("o_orderkey") * 2).alias("name"))
    return J.lookup(V.jobs(spark, sf_dir), names)


@register("flt2_jobs_of_runtime", with_views(f"""
SELECT job, runtime_ref FROM v_jobs WHERE runtime_ref IS NULL OR runtime_ref = '{RUNTIME}'""", "v_jobs"))
def flt2_jobs_of_runtime(spark, sf_dir):
    """Jobs of one runtime, keeping jobs without a runtime reference (quirk)."""
    return J.jobs_of_runtime(V.jobs(spark, sf_dir), RUNTIME).select("job", "runtime_ref")


@register("flt3_label_selector", with_views("""
SELECT job, name, idx FROM v_steps
WHERE (CASE WHEN name LIKE 'node%' THEN 'node' ELSE name END) = 'node'
  AND CAST(idx AS VARCHAR) IN ('0', '1') AND job IS NOT NULL""", "v_steps"))
def flt3_label_selector(spark, sf_dir):
    """Steps matching ``replicatedjob-name=node, job-completion-index in (0,1), jobset-name``."""
    s = J.step_labels(V.steps(spark, sf_dir))
    sel = J.label_selector(F.col("labels"), equals={"replicatedjob-name": "node"}, present=["jobset-name"],
                           within={"job-completion-index": ["0", "1"]})
    return s.filter(sel).select("job", "name", "idx")


_REQ = {"framework": "missing framework", "image": "missing image"}


@register("flt4_catalog_valid", with_views("""
SELECT name, prio, pos FROM v_catalog WHERE framework IS NOT NULL AND image IS NOT NULL""", "v_catalog"))
def flt4_catalog_valid(spark, sf_dir):
    """Catalog rows with every required field."""
    valid, _ = J.validate(V.catalog(spark, sf_dir), _REQ)
    return valid.select("name", "prio", "pos")


@register("flt4_catalog_rejects", with_views("""
SELECT name, pos, CASE WHEN framework IS NULL AND image IS NULL THEN 'missing framework; missing image'
                       WHEN framework IS NULL THEN 'missing framework' ELSE 'missing image' END AS reason
FROM v_catalog WHERE framework IS NULL OR image IS NULL""", "v_catalog"))
def flt4_catalog_rejects(spark, sf_dir):
    """Catalog rows that miss a required field, with the reasons (lenient mode)."""
    _, rejects = J.validate(V.catalog(spark, sf_dir), _REQ)
    return rejects.select("name", "pos", "reason")


@register("agg2_running_nodes", with_views(_RN_SQL, "v_steps"))
def agg2_running_nodes(spark, sf_dir):
    """Per job, node steps in Running or Succeeded."""
    return S.running_nodes(V.steps(spark, sf_dir))


@register("agg3_job_status", with_views(
    "SELECT job, num_nodes, running_nodes, status FROM js", "v_jobs", "v_runtimes", "v_steps", ctes=_STATUS_CTES))
def agg3_job_status(spark, sf_dir):
    """Job status: last decisive condition, else all nodes running, else Created."""
    return job_statuses(spark, sf_dir).select("job", "num_nodes", "running_nodes", "status")


_CSTAT = """CASE WHEN state = 'running' THEN 'Running' WHEN state = 'created' THEN 'Created'
                 WHEN state = 'exited' THEN CASE WHEN exit_code = 0 THEN 'Complete' ELSE 'Failed' END ELSE 'Unknown' END"""
_CJOB_SQL = f"""
SELECT job, CASE WHEN bool_or(s = 'Failed') THEN 'Failed' WHEN bool_or(s = 'Running') THEN 'Running'
                 WHEN bool_and(s IN ('Complete', 'Unknown')) THEN 'Complete' WHEN bool_or(s = 'Created') THEN 'Created'
                 ELSE 'Unknown' END AS status
FROM (SELECT job, {_CSTAT} AS s FROM v_containers) x GROUP BY job"""


@register("agg4_container_job_status", with_views(_CJOB_SQL, "v_containers"))
def agg4_container_job_status(spark, sf_dir):
    """Job status folded from container states and exit codes."""
    return S.containers_job_status(V.containers(spark, sf_dir))


@register("agg5_process_job_status", with_views("""
SELECT job, CASE WHEN bool_or(s = 'Failed') THEN 'Failed' WHEN bool_or(s = 'Running') THEN 'Running'
                 WHEN bool_and(s = 'Complete') THEN 'Complete' ELSE 'Created' END AS status
FROM (SELECT job, CASE WHEN status = 'Succeeded' THEN 'Complete' WHEN status = 'Failed' THEN 'Failed'
                       WHEN status = 'Running' THEN 'Running' ELSE 'Created' END AS s FROM v_steps) x
GROUP BY job""", "v_steps"))
def agg5_process_job_status(spark, sf_dir):
    """Job status folded from process-step statuses (Complete when all steps are)."""
    s = V.steps(spark, sf_dir).withColumn("job_status", S.pod_to_job_status(F.col("status")))
    return S.process_job_status(s)


_EXP_COND_SQL = """SELECT experiment, job_no AS pos,
       CASE cond_type WHEN 'Complete' THEN 'Succeeded' WHEN 'Failed' THEN 'Failed' ELSE 'Running' END AS type,
       cond_status AS status FROM v_jobs"""


@register("agg6_experiment_status", with_views("""
SELECT e.experiment,
       CASE WHEN coalesce(t.has_running, false) AND la.effect IS NOT NULL THEN la.effect
            ELSE coalesce(ld.effect, 'Created') END AS status
FROM (SELECT DISTINCT experiment FROM v_jobs) e
LEFT JOIN (SELECT experiment, bool_or(status = 'Running') AS has_running FROM js GROUP BY experiment) t
  ON t.experiment = e.experiment
LEFT JOIN (SELECT experiment, coalesce(effect, 'Running') AS effect FROM (
             SELECT experiment, effect, row_number() OVER (PARTITION BY experiment ORDER BY pos DESC) AS rn FROM eff) a
           WHERE rn = 1) la ON la.experiment = e.experiment
LEFT JOIN (SELECT experiment, effect FROM (
             SELECT experiment, effect, row_number() OVER (PARTITION BY experiment ORDER BY pos DESC) AS rn
             FROM eff WHERE effect IS NOT NULL) b WHERE rn = 1) ld ON ld.experiment = e.experiment""",
                                               "v_jobs", "v_runtimes", "v_steps",
                                               ctes={**_STATUS_CTES, "conds": _EXP_COND_SQL, "eff": """
SELECT experiment, pos, CASE WHEN status = 'True' AND type = 'Succeeded' THEN 'Complete'
                             WHEN status = 'True' AND type = 'Failed' THEN 'Failed' END AS effect FROM conds"""}))
def agg6_experiment_status(spark, sf_dir):
    """Experiment status from its ordered conditions and whether a trial runs."""
    jobs = V.jobs(spark, sf_dir)
    conds = jobs.select(
        "experiment", F.col("job_no").alias("pos"),
        F.when(F.col("cond_type") == "Complete", F.lit("Succeeded"))
        .when(F.col("cond_type") == "Failed", F.lit("Failed")).otherwise(F.lit("Running")).alias("type"),
        F.col("cond_status").alias("status"))
    trials = job_statuses(spark, sf_dir).join(jobs.select("job", "experiment"), "job")
    return S.experiment_status(conds, trials)


@register("agg7_containers_to_jobs", with_views(f"""
SELECT c.job, c.num_nodes, c.created, s.status, c.steps FROM (
  SELECT job, count(*) AS num_nodes, arg_min(created, idx) AS created,
         string_agg(concat(name, '=', {_CSTAT}), ',' ORDER BY name) AS steps
  FROM v_containers GROUP BY job) c JOIN cj s ON s.job = c.job""", "v_containers", ctes={"cj": _CJOB_SQL}))
def agg7_containers_to_jobs(spark, sf_dir):
    """Containers grouped into jobs: node count, first container's creation,
    status, sorted step list (shown as text)."""
    x = S.containers_to_jobs(V.containers(spark, sf_dir))
    return x.withColumn("steps", F.array_join(F.transform("steps", lambda s: F.concat(s["name"], F.lit("="), s["status"])), ","))


@register("agg7_jobs_of_runtime", with_views(f"""
SELECT c.job, c.num_nodes, c.created, s.status, c.steps FROM (
  SELECT job, count(*) AS num_nodes, arg_min(created, idx) AS created,
         string_agg(concat(name, '=', {_CSTAT}), ',' ORDER BY name) AS steps
  FROM v_containers GROUP BY job) c JOIN cj s ON s.job = c.job
WHERE c.job IN (SELECT job FROM v_jobs WHERE runtime_ref = '{RUNTIME}')""", "v_containers", "v_jobs", ctes={"cj": _CJOB_SQL}))
def agg7_jobs_of_runtime(spark, sf_dir):
    """Containers of one runtime (by the network's label) grouped into jobs."""
    cont = V.containers(spark, sf_dir)
    nets = V.jobs(spark, sf_dir).select(F.col("job").alias("network"), F.col("runtime_ref").alias("runtime"),
                                        F.concat(F.lit("/workdir/"), F.col("job")).alias("workdir"))
    mine = J.with_network(cont, nets).filter(F.col("runtime") == RUNTIME)
    x = S.containers_to_jobs(mine)
    return x.withColumn("steps", F.array_join(F.transform("steps", lambda s: F.concat(s["name"], F.lit("="), s["status"])), ","))


@register("top3_step_order", with_views("""
SELECT job, name, idx, row_number() OVER (PARTITION BY job ORDER BY name) - 1 AS step_rank FROM v_steps""", "v_steps"))
def top3_step_order(spark, sf_dir):
    """Each step's position in its job's list, lexicographic by name."""
    return S.step_order(V.steps(spark, sf_dir).select("job", "name", "idx"))


@register("agg9_wait_outcome", with_views(f"""
SELECT s.job, s.start,
       CASE WHEN d.ts IS NOT NULL AND d.ts <= s.start + INTERVAL {TIMEOUT_S} SECOND THEN
                 CASE WHEN d.status = 'Complete' THEN 'reached' ELSE 'failed' END
            ELSE 'timed_out' END AS outcome,
       CASE WHEN d.ts IS NOT NULL AND d.ts <= s.start + INTERVAL {TIMEOUT_S} SECOND THEN d.status END AS status,
       CASE WHEN d.ts IS NOT NULL AND d.ts <= s.start + INTERVAL {TIMEOUT_S} SECOND THEN d.ts
            ELSE s.start + INTERVAL {TIMEOUT_S} SECOND END AS decided_at
FROM (SELECT job, min(ts) AS start FROM v_status_events GROUP BY job) s
LEFT JOIN (SELECT job, status, ts FROM (
             SELECT job, status, ts, row_number() OVER (PARTITION BY job ORDER BY ts, seq) AS rn
             FROM v_status_events WHERE status IN ('Complete', 'Failed')) x WHERE rn = 1) d ON d.job = s.job""",
                                          "v_status_events"))
def agg9_wait_outcome(spark, sf_dir):
    """Waiting for Complete with a 6 h timeout over every job's status history."""
    return S.wait_outcome(V.status_events(spark, sf_dir), wanted=("Complete",), timeout_s=TIMEOUT_S)


@register("agg10_sweep_progress", with_views(f"""
SELECT experiment, count(*) AS trials,
       CAST(sum(CASE WHEN status = 'Complete' THEN 1 ELSE 0 END) AS BIGINT) AS complete,
       CAST(sum(CASE WHEN status = 'Failed' THEN 1 ELSE 0 END) AS BIGINT) AS failed,
       CAST(sum(CASE WHEN status = 'Running' THEN 1 ELSE 0 END) AS BIGINT) AS running,
       CAST(sum(CASE WHEN status = 'Created' THEN 1 ELSE 0 END) AS BIGINT) AS created,
       CAST(greatest({NUM_TRIALS} - count(*), 0) AS BIGINT) AS remaining,
       CAST({MAX_FAILED} - sum(CASE WHEN status = 'Failed' THEN 1 ELSE 0 END) AS BIGINT) AS failures_left,
       sum(CASE WHEN status = 'Failed' THEN 1 ELSE 0 END) > {MAX_FAILED} AS budget_exceeded
FROM js GROUP BY experiment""", "v_jobs", "v_runtimes", "v_steps", ctes=_STATUS_CTES))
def agg10_sweep_progress(spark, sf_dir):
    """Trials per experiment by status against num_trials and max_failed_trials."""
    jobs = V.jobs(spark, sf_dir).select("job", "experiment")
    trials = job_statuses(spark, sf_dir).join(jobs, "job")
    return S.sweep_progress(trials, NUM_TRIALS, MAX_FAILED)


@register("win4_failure_budget", with_views(f"""
SELECT job, experiment,
       CAST(coalesce(sum(CASE WHEN status = 'Failed' THEN 1 ELSE 0 END) OVER (
            PARTITION BY experiment ORDER BY job_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS failed_before,
       coalesce(sum(CASE WHEN status = 'Failed' THEN 1 ELSE 0 END) OVER (
            PARTITION BY experiment ORDER BY job_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) <= {MAX_FAILED} AS counts
FROM js""", "v_jobs", "v_runtimes", "v_steps", ctes=_STATUS_CTES))
def win4_failure_budget(spark, sf_dir):
    """Trials that still count under the experiment's failure budget."""
    jobs = V.jobs(spark, sf_dir).select("job", "experiment", "job_no")
    trials = job_statuses(spark, sf_dir).select("job", "status").join(jobs, "job")
    return S.failure_budget(trials, MAX_FAILED, order="job_no").select("job", "experiment", "failed_before",
                                                                       "counts")


_DEV_SQL = """
SELECT name, framework, num_nodes, coalesce(device, 'Unknown') AS device,
       coalesce(CASE WHEN regexp_matches(per_node, '^\\d+$') AND num_nodes IS NOT NULL
                     THEN CAST(CAST(per_node AS BIGINT) * num_nodes AS VARCHAR) ELSE per_node END, 'Unknown') AS device_count,
       CASE WHEN device IS NULL AND npu_limit IS NOT NULL THEN 'no known device in the limits' END AS error
FROM (SELECT name, framework, num_nodes, npu_limit,
             CASE WHEN gpu_limit IS NOT NULL THEN 'gpu' WHEN tpu_limit IS NOT NULL THEN 'tpu' WHEN cpu_limit IS NOT NULL THEN 'cpu' END AS device,
             CAST(coalesce(procs_per_node, gpu_limit, tpu_limit, cpu_limit) AS VARCHAR) AS per_node
      FROM v_runtimes) x"""


@register("agg11_runtime_devices", with_views(_DEV_SQL, "v_runtimes"))
def agg11_runtime_devices(spark, sf_dir):
    """Device type and total device count per runtime; limits without a known device -> error row."""
    return J.runtime_devices(V.runtimes(spark, sf_dir))


@register("agg11_device_rollup", with_views("""
SELECT framework, device, count(*) AS runtimes, CAST(sum(TRY_CAST(device_count AS BIGINT)) AS BIGINT) AS devices
FROM dev WHERE error IS NULL GROUP BY framework, device""", "v_runtimes", ctes={"dev": _DEV_SQL}))
def agg11_device_rollup(spark, sf_dir):
    """Device totals rolled up by framework and device type."""
    return J.device_rollup(J.runtime_devices(V.runtimes(spark, sf_dir)))


@register("job5_resource_totals", with_views("""
SELECT j.runtime_ref, r.resource, sum(r.per_node * coalesce(nullif(j.num_nodes, 0), rt.num_nodes)) AS total,
       count(*) AS jobs
FROM (SELECT job, CASE WHEN lower(res_key) = 'gpu' THEN 'nvidia.com/gpu' ELSE lower(res_key) END AS resource,
             sum(TRY_CAST(quantity AS DOUBLE)) AS per_node
      FROM v_resources GROUP BY 1, 2) r
JOIN v_jobs j ON j.job = r.job LEFT JOIN v_runtimes rt ON rt.name = j.runtime_ref
GROUP BY j.runtime_ref, r.resource""", "v_resources", "v_jobs", "v_runtimes"))
def job5_resource_totals(spark, sf_dir):
    """Requested resources per node, times the node count, summed per runtime."""
    jobs = flat_jobs(spark, sf_dir).select("job", "runtime_ref", "num_nodes")
    return S.resource_totals(V.resources(spark, sf_dir), jobs)


CAP = 5


@register("top2_trial_cap", with_views(f"""
SELECT experiment, job, trial_no FROM (
  SELECT experiment, job, row_number() OVER (PARTITION BY experiment ORDER BY job_no) - 1 AS trial_no FROM v_jobs) x
WHERE trial_no < {CAP}""", "v_jobs"))
def top2_trial_cap(spark, sf_dir):
    """Each experiment capped at num_trials = 5 by trial number. Spark keeps the
    first rows of each group in every task before the shuffle (WindowGroupLimit),
    so a hot experiment sends a few rows per task."""
    number = F.row_number().over(Window.partitionBy("experiment").orderBy("job_no"))
    x = V.jobs(spark, sf_dir).select("experiment", "job", "job_no").withColumn("number", number)
    return x.filter(F.col("number") <= CAP).select("experiment", "job", (F.col("number") - 1).alias("trial_no"))


