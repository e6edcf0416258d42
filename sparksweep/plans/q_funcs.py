"""Registered user-function, sink and dependency queries (UDF-1, UDF-2, HPO-8,
SNK-1, SNK-2, JON-3, JON-8)."""

from __future__ import annotations

import datetime as dt
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparksweep.functions import user as UF
from sparksweep.operators import jobs as J
from sparksweep.operators import experiments as EX
from sparksweep.operators import dependencies as DP
from sparksweep.operators.metrics import observations
from sparksweep.operators.snapshots import Snapshots
from sparksweep.plans import sweep as S
from sparksweep.plans import views as V
from sparksweep.plans.q_jobs import _STATUS_CTES, job_statuses
from sparksweep.plans.q_sweep import N_TRIALS, RANDOM, WAVE, _DATA_SQL
from sparksweep.plans.registry import register
from sparksweep.plans.views import table, with_views
from sparksweep.session import shared_dir
from sparksweep.sources.uris import options_text

A, B = 1000.0, 100.0
NODES, PROCS = 2, 2


def rank_partial_sums(batches, rank, world_size, a, b):
    """A user training step: partial sums of a linear model's squared error
    and gradient over this rank's shard."""
    n = s_err = s_err_x = s_sq = 0.0
    for pdf in batches:
        x = pdf["l_quantity"].to_numpy(dtype=np.float64)
        y = pdf["l_extendedprice"].to_numpy(dtype=np.float64)
        err = y - (a * x + b)
        n += len(err)
        s_err += float(err.sum())
        s_err_x += float((err * x).sum())
        s_sq += float((err * err).sum())
    yield pd.DataFrame({"n": [n], "s_err": [s_err], "s_err_x": [s_err_x], "s_sq": [s_sq]})


@register("udf1_rank_partial_sums", f"""
SELECT count(*) AS n, round(avg(e * e), 2) AS mse, round(-2 * avg(e * x), 4) AS grad_a,
       round(-2 * avg(e), 4) AS grad_b, {NODES * PROCS} AS ranks
FROM (SELECT l_quantity AS x, l_extendedprice - ({A} * l_quantity + {B}) AS e FROM lineitem) d""")
def udf1_rank_partial_sums(spark, sf_dir):
    """A user function on 2 nodes x 2 processes (barrier stage), each on its
    shard of lineitem; the per-rank partial sums are combined by one aggregate."""
    data = table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice")
    parts = UF.run_on_nodes(data, rank_partial_sums, "n double, s_err double, s_err_x double, s_sq double",
                            num_nodes=NODES, procs_per_node=PROCS, kwargs={"a": A, "b": B})
    t = parts.agg(F.sum("n").alias("n"), F.sum("s_err").alias("s_err"), F.sum("s_err_x").alias("s_err_x"),
                  F.sum("s_sq").alias("s_sq"), F.count_distinct("rank").alias("ranks"))
    return t.select(F.col("n").cast("bigint").alias("n"), F.round(F.col("s_sq") / F.col("n"), 2).alias("mse"),
                    F.round(-2 * F.col("s_err_x") / F.col("n"), 4).alias("grad_a"),
                    F.round(-2 * F.col("s_err") / F.col("n"), 4).alias("grad_b"),
                    F.col("ranks").cast("int").alias("ranks"))


@register("udf2_job_options", with_views("""
SELECT job, 'custom-' || job AS name,
       concat_ws(';', 'runtime=' || coalesce(runtime_ref, 'none'), 'team=research') AS labels,
       'owner=ml-platform' AS annotations
FROM v_jobs""", "v_jobs"))
def udf2_job_options(spark, sf_dir):
    """A chain of job options over every job row: custom name, labels (a later
    Labels option replaces the earlier one as a whole), annotations."""
    jobs = V.jobs(spark, sf_dir).select("job", "runtime_ref", "priority")
    opts = [UF.Name(F.concat(F.lit("custom-"), F.col("job"))),
            UF.Labels({"priority": "high"}),
            UF.Annotations({"owner": "ml-platform"}),
            UF.Labels({"team": "research"})]
    x = UF.apply_options(jobs, opts, backend="kubernetes")
    x = x.withColumn("labels", F.map_concat(
        F.create_map(F.lit("runtime"), F.coalesce(F.col("runtime_ref"), F.lit("none"))), F.col("labels")))
    return x.select("job", "name", options_text(F.col("labels")).alias("labels"),
                    options_text(F.col("annotations")).alias("annotations"))


def price_partials(pdf, slope, shift, kind):
    """A user objective: parameters arrive as strings, partial sums go back."""
    a, b = float(slope), float(shift)
    if kind == "c" and a > 2000:
        raise ValueError("slope too steep for kind c")
    ep = pdf["l_extendedprice"].to_numpy(dtype=np.float64)
    d = pdf["l_discount"].to_numpy(dtype=np.float64)
    t = pdf["l_tax"].to_numpy(dtype=np.float64)
    y = ep if kind == "a" else ep * (1 - d) if kind == "b" else ep * (1 - d) * (1 + t)
    err = y - (a * pdf["l_quantity"].to_numpy(dtype=np.float64) + b)
    return {"abs_err": float(np.abs(err).sum()), "sq_err": float((err * err).sum()), "n": float(len(err))}


def _hpo8_sql():
    trials = S.trial_table_sql(S.PRICE_SPACE, N_TRIALS, RANDOM, WAVE)
    return with_views("""
SELECT trial_no, CASE WHEN failed THEN 'Failed' ELSE 'Succeeded' END AS status,
       CASE WHEN failed THEN 'ValueError: slope too steep for kind c' END AS error,
       CASE WHEN failed THEN NULL ELSE mae END AS mae, CASE WHEN failed THEN NULL ELSE mse END AS mse
FROM (SELECT trial_no, kind = 'c' AND slope > 2000 AS failed,
             round(avg(abs(y - (slope * x + shift))), 4) AS mae,
             round(avg((y - (slope * x + shift)) * (y - (slope * x + shift))), 2) AS mse
      FROM (SELECT t.*, d.x, CASE t.kind WHEN 'a' THEN d.y_a WHEN 'b' THEN d.y_b ELSE d.y_c END AS y
            FROM data d CROSS JOIN trials t) j
      GROUP BY trial_no, kind, slope) s""", ctes={"trials": trials, "data": _DATA_SQL})


@register("hpo8_sweep_by_function", _hpo8_sql())
def hpo8_sweep_by_function(spark, sf_dir):
    """64 trials of a pandas objective scored in one pass over lineitem; the
    trials the function rejects are recorded as Failed."""
    trials = S.trial_table(spark, S.PRICE_SPACE, N_TRIALS, RANDOM, WAVE)
    data = table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    fin = {"mae": F.round(F.col("abs_err") / F.col("n"), 4), "mse": F.round(F.col("sq_err") / F.col("n"), 2)}
    return UF.sweep_by_function(data, trials, price_partials, ["abs_err", "sq_err", "n"], fin,
                                ["slope", "shift", "kind"])


T1, T2 = dt.datetime(1996, 6, 1), dt.datetime(1998, 1, 1)


@register("snk1_register_steps", with_views("""
SELECT job, name, status, 1 AS batch FROM v_steps WHERE ts < TIMESTAMP '1998-01-01'
UNION ALL
SELECT job, name, 'Updated' AS status, 2 AS batch FROM v_steps WHERE ts >= TIMESTAMP '1998-01-01'""", "v_steps"))
def snk1_register_steps(spark, sf_dir):
    """Steps registered in two overlapping batches: existing (job, step) rows
    are kept, the second batch's copies ignored; the table is read back."""
    steps = V.steps(spark, sf_dir).select("job", "name", "status", "ts")
    b1 = steps.filter(F.col("ts") < F.lit(T2)).select("job", "name", "status", F.lit(1).alias("batch"))
    b2 = steps.filter(F.col("ts") >= F.lit(T1)).select("job", "name", F.lit("Updated").alias("status"),
                                                       F.lit(2).alias("batch"))
    held = Snapshots(spark, shared_dir(spark, "steps-table"), 8)
    held.register("steps", b1, ["job", "name"], ["status"])
    held.register("steps", b2, ["job", "name"], ["status"])
    return held.read("steps")


_GONE = "(SELECT job FROM v_jobs WHERE priority = '5-LOW')"


@register("snk2_delete_jobs", with_views(f"""
SELECT 'jobs' AS tbl, job, count(*) AS n FROM v_jobs WHERE job NOT IN {_GONE} GROUP BY job
UNION ALL SELECT 'steps', job, count(*) FROM v_steps WHERE job NOT IN {_GONE} GROUP BY job
UNION ALL SELECT 'logs', job, count(*) FROM v_containers WHERE job NOT IN {_GONE} GROUP BY job
UNION ALL SELECT 'trials', job, count(*) FROM v_resources WHERE job NOT IN {_GONE} GROUP BY job""",
                                         "v_steps", "v_jobs", "v_containers", "v_resources"))
def snk2_delete_jobs(spark, sf_dir):
    """Jobs of priority 5-LOW deleted with all that hangs off them, from four
    tables in one commit; shown as rows per table and job."""
    steps = V.steps(spark, sf_dir)
    jobs = V.jobs(spark, sf_dir).select("job", "priority")
    tables = {"jobs": jobs, "steps": steps.select("job", "name", "status"),
              "logs": V.containers(spark, sf_dir, steps).select("job", "name", "state"),
              "trials": V.resources(spark, sf_dir, steps).select("job", "res_key", "quantity")}
    tomb = jobs.filter(F.col("priority") == "5-LOW").select("job")
    held = Snapshots(spark, shared_dir(spark, "job-tables"), 8)
    held.create({name: (df, "job") for name, df in tables.items()})
    held.delete(tomb, "job", list(tables), known="jobs")
    parts = [held.read(name).groupBy("job").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("tbl"), "job", "n") for name in tables]
    return reduce(DataFrame.unionByName, parts)


def shop_objective(balance, nation):
    """A user objective on parameters given as texts."""
    if nation == "3":
        raise ValueError("no model for nation 3")
    x = float(balance) / 1000
    return {"loss": (x - 1) ** 2, "size": abs(x)}


@register("hpo8_run_trials", """
SELECT s_suppkey AS trial_no, CASE WHEN s_nationkey = 3 THEN 'Failed' ELSE 'Succeeded' END AS status,
       CASE WHEN s_nationkey = 3 THEN 'ValueError: no model for nation 3' END AS error,
       CASE WHEN s_nationkey <> 3 THEN round((s_acctbal / 1000 - 1) * (s_acctbal / 1000 - 1), 6) END AS loss,
       CASE WHEN s_nationkey <> 3 THEN round(abs(s_acctbal / 1000), 6) END AS size
FROM supplier""")
def hpo8_run_trials(spark, sf_dir):
    """A Python function called once per trial (a trial per supplier), many at a time."""
    trials = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("long").alias("trial_no"),
                                                     F.col("s_acctbal").cast("double").alias("balance"), F.col("s_nationkey").alias("nation"))
    got = UF.run_trials(trials, shop_objective, ["balance", "nation"], ["loss", "size"])
    return got.select("trial_no", "status", "error", F.round("loss", 6).alias("loss"), F.round("size", 6).alias("size"))


@register("jon3_experiment_trials", with_views("""
SELECT j.experiment, j.job AS trial, js.status AS trial_status, a.param, a.value
FROM v_jobs j LEFT JOIN js ON js.job = j.job
LEFT JOIN (SELECT job, param, value FROM (
             SELECT job, CASE WHEN idx % 4 = 3 THEN NULL ELSE concat('p', idx) END AS param,
                    CASE WHEN kind = 2 AND idx % 5 = 0 THEN NULL ELSE CAST(quantity AS VARCHAR) END AS value
             FROM v_steps) x WHERE param IS NOT NULL AND value IS NOT NULL) a ON a.job = j.job""",
                                               "v_jobs", "v_runtimes", "v_steps", ctes=_STATUS_CTES))
def jon3_experiment_trials(spark, sf_dir):
    """Experiments with their trials (= train jobs), trial status and parameter assignments."""
    jobs = V.jobs(spark, sf_dir)
    trials = jobs.select("experiment", F.col("job").alias("trial"))
    st = V.steps(spark, sf_dir)
    assign = st.select(F.col("job").alias("trial"),
                       F.when(F.col("idx") % 4 == 3, F.lit(None).cast("string"))
                       .otherwise(F.concat(F.lit("p"), F.col("idx"))).alias("param"),
                       F.when((F.col("kind") == 2) & (F.col("idx") % 5 == 0), F.lit(None).cast("string"))
                       .otherwise(F.col("quantity").cast("string")).alias("value"))
    return J.experiment_trials(trials, assign, job_statuses(spark, sf_dir))


_ASSIGN_SQL = """SELECT job, concat('p', idx) AS param, CAST(quantity AS VARCHAR) AS value FROM v_steps
WHERE idx % 4 <> 3 AND NOT (kind = 2 AND idx % 5 = 0)"""
_TRIAL_OBS_SQL = """SELECT job, concat('m', kind) AS metric, min(quantity) AS mn, max(quantity) AS mx, arg_max(quantity, idx) AS latest
FROM v_steps GROUP BY job, kind"""


@register("jon3_experiment_documents", """
SELECT concat('exp-', c_custkey) AS experiment, CASE WHEN c_custkey % 7 <> 0 THEN 1 + c_custkey % 20 END AS num_trials,
       1 + c_custkey % 3 AS parallel_trials, CASE c_nationkey % 2 WHEN 0 THEN 'loss:minimize;accuracy:minimize' ELSE 'loss:maximize' END AS objectives,
       CASE c_nationkey % 3 WHEN 0 THEN 'grid' WHEN 1 THEN 'random' END AS algorithm,
       CASE WHEN c_nationkey % 3 = 1 THEN 'random_state=' || c_nationkey ELSE '' END AS settings,
       CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE 2 END AS parameters,
       CASE WHEN c_custkey % 5 = 0 THEN 'missing parameters' WHEN c_nationkey % 3 = 2 THEN 'missing algorithm'
            WHEN c_custkey % 7 = 0 THEN 'missing trial count' WHEN c_custkey % 11 = 0 THEN 'missing creation time' END AS error
FROM customer""")
def jon3_experiment_documents(spark, sf_dir):
    """Experiment documents (JSON, one per customer) flattened, with their missing fields."""
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    double = F.struct(F.lit("lr").alias("name"), F.lit("double").alias("parameterType"),
                      F.struct(F.lit("0.1").alias("min"), F.lit("0.9").alias("max"), F.lit("uniform").alias("distribution")).alias("feasibleSpace"))
    other = F.struct(F.lit("n").alias("name"), F.lit("int").alias("parameterType"),
                     F.struct(F.lit("1").alias("min"), F.lit("9").alias("max"), F.lit("uniform").alias("distribution")).alias("feasibleSpace"))
    setting = F.struct(F.lit("random_state").alias("name"), n.cast("string").alias("value"))
    none = F.lit(None)
    doc = F.struct(
        F.struct(F.concat(F.lit("exp-"), k).alias("name"), F.lit("lab").alias("namespace"),
                 F.when(k % 11 != 0, F.lit("2024-01-02T03:04:05Z")).alias("creationTimestamp")).alias("metadata"),
        F.struct(F.when(k % 5 != 0, F.array(double, other)).alias("parameters"),
                 F.struct(F.when(n % 2 == 0, F.lit("minimize")).otherwise(F.lit("maximize")).alias("type"), F.lit("loss").alias("objectiveMetricName"),
                          F.when(n % 2 == 0, F.array(F.lit("accuracy"))).alias("additionalMetricNames")).alias("objective"),
                 F.when(n % 3 == 0, F.struct(F.lit("grid").alias("algorithmName"), none.cast("array<struct<name:string,value:string>>").alias("algorithmSettings")))
                 .when(n % 3 == 1, F.struct(F.lit("random").alias("algorithmName"), F.array(setting).alias("algorithmSettings"))).alias("algorithm"),
                 F.when(k % 7 != 0, F.lit(1) + k % 20).alias("maxTrialCount"), (F.lit(1) + k % 3).alias("parallelTrialCount")).alias("spec"))
    x = EX.parse_experiment_documents(table(spark, sf_dir, "customer").select(F.to_json(doc).alias("doc")))
    shown = F.array_join(F.transform("objectives", lambda o: F.concat(o["metric"], F.lit(":"), o["direction"])), ";")
    return x.select("experiment", "num_trials", "parallel_trials", shown.alias("objectives"), "algorithm",
                    options_text(F.col("settings")).alias("settings"), F.coalesce(F.size("parameters"), F.lit(0)).alias("parameters"), "error")


@register("jon3_nested_trials", with_views("""
SELECT j.experiment, j.job AS trial, js.status AS trial_status, coalesce(p.parameters, '') AS parameters, m.metric_no,
       m.metric, m.mn AS min, m.mx AS max, m.latest
FROM v_jobs j LEFT JOIN js ON js.job = j.job
LEFT JOIN (SELECT job, string_agg(concat(param, '=', value), ';' ORDER BY concat(param, '=', value)) AS parameters FROM asg GROUP BY job) p ON p.job = j.job
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY job ORDER BY metric) - 1 AS metric_no FROM obs) m ON m.job = j.job""",
                                           "v_jobs", "v_runtimes", "v_steps",
                                           ctes={**_STATUS_CTES, "asg": _ASSIGN_SQL, "obs": _TRIAL_OBS_SQL}))
def jon3_nested_trials(spark, sf_dir):
    """One row per trial with its parameter map and metrics list, shown exploded by metric."""
    nested = J.nested_parameters(jon3_experiment_trials(spark, sf_dir))
    log = V.steps(spark, sf_dir).select(F.col("job").alias("trial"), F.concat(F.lit("m"), F.col("kind")).alias("metric"),
                                        F.col("quantity").alias("value"), F.col("idx").alias("seq"))
    x = J.with_metrics(nested, observations(log, ["trial"], order=("seq",)))
    x = x.select("experiment", "trial", "trial_status", options_text(F.col("parameters")).alias("parameters"),
                 F.posexplode_outer("metrics").alias("metric_no", "m"))
    return x.select("experiment", "trial", "trial_status", "parameters", F.col("metric_no").cast("bigint").alias("metric_no"), "m.*")


@register("jon8_dependency_graph", with_views("""
WITH RECURSIVE edges AS (SELECT e.job_no, e.depends_on FROM (SELECT o.o_orderkey AS job_no, p.o_orderkey AS depends_on
    FROM orders o JOIN orders p ON p.o_orderkey = o.o_orderkey - 7 WHERE o.o_orderkey % 3 = 0) e
  UNION ALL SELECT job_no, depends_on FROM v_deps WHERE depends_on IS NOT NULL AND depends_on < job_no),
bad(job_no) AS (
  SELECT job_no FROM v_deps WHERE NOT ok
  UNION
  SELECT d.job_no FROM edges d JOIN bad b ON d.depends_on = b.job_no)
SELECT job_no, CASE WHEN job_no IN (SELECT d.job_no FROM edges d JOIN bad b ON d.depends_on = b.job_no) THEN 'Skipped'
                    WHEN ok THEN 'Complete' ELSE 'Failed' END AS status
FROM v_deps""", "v_deps").replace("WITH v_deps AS", "WITH RECURSIVE v_deps AS").replace(
    ")\nWITH RECURSIVE edges AS", "),\nedges AS"))
def jon8_dependency_graph(spark, sf_dir):
    """Jobs with several dependencies: the customer's previous order (if its key
    is smaller) and, for every third key, the order seven keys before."""
    d = V.deps(spark, sf_dir).select("job_no", "ok", F.when(F.col("depends_on") < F.col("job_no"), F.col("depends_on")).alias("depends_on"))
    keys = d.select(F.col("job_no").alias("k"))
    more = d.filter("job_no % 3 = 0").join(keys, F.col("k") == F.col("job_no") - 7).select("job_no", "ok", F.col("k").alias("depends_on"))
    return DP.dependency_status(d.unionByName(more))


@register("jon8_dependency_skip", with_views("""
WITH RECURSIVE bad(job_no) AS (
  SELECT job_no FROM v_deps WHERE NOT ok
  UNION
  SELECT d.job_no FROM v_deps d JOIN bad b ON d.depends_on = b.job_no)
SELECT job_no, CASE WHEN job_no IN (SELECT d.job_no FROM v_deps d JOIN bad b ON d.depends_on = b.job_no) THEN 'Skipped'
                    WHEN ok THEN 'Complete' ELSE 'Failed' END AS status
FROM v_deps""", "v_deps").replace("WITH v_deps AS", "WITH RECURSIVE v_deps AS").replace(
    ")\nWITH RECURSIVE bad(job_no) AS (", "),\nbad(job_no) AS ("))
def jon8_dependency_skip(spark, sf_dir):
    """Chains of jobs per customer: a job after a failed or skipped one is skipped."""
    return DP.dependency_status(V.deps(spark, sf_dir))
