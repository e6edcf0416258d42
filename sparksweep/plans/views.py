"""Fixture views: the driver's tables re-shaped into the reference's entities.

Each view exists twice: as a DataFrame built with the DataFrame API (what the
Spark queries read) and as SQL text for the DuckDB twin (``VIEW_SQL``). The
two are written separately; the queries that read them compare both.

Every view reads whole tables; nothing is sampled or cut by id.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparksweep.session import plan_bytes

STEP_BYTES = 4 << 20  # of the line items' files in a task


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(col: Column, mapping: dict, default=None) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(col == k, F.lit(v)) if out is None else out.when(col == k, F.lit(v))
    return out if default is None else out.otherwise(default)


def limits_map(limits: dict):
    """MAP of the limits that aren't NULL; NULL if there are none."""
    entries = F.filter(F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in limits.items()]),
                       lambda e: e["value"].isNotNull())
    return F.when(F.size(entries) > 0, F.map_from_entries(entries))


def runtimes(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    return n.select(
        F.concat(F.lit("rt-"), k).alias("name"),
        _case(F.col("n_regionkey"), {0: "torch", 1: "mpi", 2: "torchtune", 3: "deepspeed"}).alias("framework"),
        (F.lit(1) + k % 4).alias("num_nodes"),
        limits_map({"nvidia.com/gpu": F.when(k % 3 == 0, F.lit("2")), "google.com/tpu": F.when(k % 3 == 1, F.lit("4")),
                    "cpu": F.when(k % 5 != 0, F.lit("8")), "example.com/npu": F.when(k == 5, F.lit("1"))}).alias("limits"),
        F.when(F.col("n_regionkey") < 2, F.lit(2)).alias("procs_per_node"),
    )


def jobs(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    k = F.col("o_orderkey")
    prio = F.col("o_orderpriority")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.concat(F.lit("job-"), k).alias("job"),
        k.alias("job_no"),
        F.concat(F.lit("exp-"), F.col("o_custkey")).alias("experiment"),
        F.when(k % 17 == 0, F.lit(None).cast("string"))
        .when(k % 19 == 0, F.lit("rt-gone"))
        .otherwise(F.concat(F.lit("rt-"), F.col("c_nationkey"))).alias("runtime_ref"),
        F.when(prio == "5-LOW", F.lit(None).cast("bigint"))
        .when(prio == "4-NOT SPECIFIED", F.lit(0).cast("bigint"))
        .otherwise(F.lit(1) + k % 4).alias("num_nodes"),
        F.col("o_orderdate").alias("created"),
        _case(F.col("o_orderstatus"), {"F": "Complete", "P": "Failed"}).alias("cond_type"),
        F.when(k % 11 == 0, F.lit("False")).otherwise(F.lit("True")).alias("cond_status"),
        prio.alias("priority"),
        F.col("o_totalprice").alias("objective"),
    )


def steps(spark, sf_dir) -> DataFrame:
    """One step per line item. The window is per order, whose size the schema
    bounds (some tens of lines at most), so no window partition can grow with the data; large
    tables are dealt over more tasks, so that a task sorts about as many rows at any size."""
    li = table(spark, sf_dir, "lineitem")
    tasks = plan_bytes(li) // STEP_BYTES
    if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")):
        li = li.repartition(tasks, "l_orderkey")
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    x = li.withColumn("idx", (F.row_number().over(w) - 1).cast("bigint"))
    idx = F.col("idx")
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    return x.select(
        F.concat(F.lit("job-"), F.col("l_orderkey")).alias("job"),
        idx,
        F.when((idx == 0) & (F.col("l_partkey") % 5 == 0), F.lit("dataset-initializer"))
        .otherwise(F.concat(F.lit("node-"), idx)).alias("name"),
        F.when(F.col("l_partkey") % 13 == 0, F.lit(None).cast("string"))
        .when((ls == "O") & (rf == "N"), F.lit("Pending"))
        .when(rf == "A", F.lit("Succeeded"))
        .when((ls == "O") & (rf == "R"), F.lit("Failed"))
        .otherwise(F.lit("Running")).alias("status"),
        F.col("l_shipdate").alias("ts"),
        F.col("l_quantity").alias("quantity"),
        (F.col("l_linenumber") % 3).alias("kind"),
    )


def containers(spark, sf_dir, steps_df: DataFrame | None = None) -> DataFrame:
    s = steps_df if steps_df is not None else steps(spark, sf_dir)
    st = F.col("status")
    return s.select(
        "job", "idx",
        F.concat(F.col("job"), F.lit("-node-"), F.col("idx")).alias("name"),
        F.col("ts").alias("created"),
        F.when(st == "Running", F.lit("running")).when(st == "Pending", F.lit("created"))
        .when(st.isin("Succeeded", "Failed"), F.lit("exited")).otherwise(F.lit("paused")).alias("state"),
        _case(st, {"Succeeded": 0, "Failed": 1}).alias("exit_code"),
    )


def resources(spark, sf_dir, steps_df: DataFrame | None = None) -> DataFrame:
    s = steps_df if steps_df is not None else steps(spark, sf_dir)
    return s.select("job", "idx", _case(F.col("kind"), {0: "CPU", 1: "gpu"}, F.lit("Memory")).alias("res_key"),
                    "quantity")


def metric_log(spark, sf_dir, events_df: DataFrame | None = None) -> DataFrame:
    e = events_df if events_df is not None else table(spark, sf_dir, "events")
    return e.select(
        F.concat(F.lit("t-"), F.col("user_id")).alias("trial"),
        F.col("event_type").alias("metric"),
        "value", "ts",
        F.col("event_id").alias("seq"),
        F.concat(F.col("event_type"), F.lit("="), F.col("value")).alias("line"),
    )


def status_events(spark, sf_dir, events_df: DataFrame | None = None) -> DataFrame:
    e = events_df if events_df is not None else table(spark, sf_dir, "events")
    return e.select(
        F.concat(F.lit("j-"), F.col("user_id"), F.lit("-"), F.col("ts").cast("date")).alias("job"),
        "ts",
        F.col("event_id").alias("seq"),
        _case(F.col("event_type"), {"click": "Created", "purchase": "Complete", "error": "Failed"},
              F.lit("Running")).alias("status"),
    )


def catalog(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        F.col("p_name").alias("name"),
        (F.col("p_size") % 3).alias("prio"),
        k.alias("pos"),
        F.when(k % 10 == 0, F.lit(None).cast("string")).otherwise(F.lower("p_type")).alias("framework"),
        F.when(k % 7 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("img/"), F.col("p_brand"))).alias("image"),
        (F.lit(1) + F.col("p_size") % 4).alias("num_nodes"),
    )


def catalog_defaults(spark, sf_dir) -> DataFrame:
    r = table(spark, sf_dir, "region")
    return r.select(F.concat(F.lit("default-"), F.lower("r_name")).alias("name")).unionByName(
        spark.range(1).select(F.lit("red plate").alias("name")))


def req_all(spark, sf_dir) -> DataFrame:
    """Requirement rows of every job (supplier). ``pos`` orders a job's list by
    (order, line, part, ship date): these numbers side by side in one decimal,
    made row by row, without a sort or a shuffle."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_linestatus", "l_orderkey", "l_linenumber",
                                                 "l_partkey", "l_shipdate")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    ln = F.col("l_linenumber") % 3
    name = (F.when(ln == 0, F.regexp_replace("p_name", " ", "_"))
            .when(ln == 1, F.upper(F.regexp_replace("p_name", " ", ".")))
            .otherwise(F.regexp_replace("p_name", " ", "-")))
    x = li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("l_suppkey").alias("job"), F.col("l_linestatus").alias("side"), "l_orderkey", "l_linenumber",
        req_position().alias("pos"), F.concat(name, F.lit("=="), F.col("p_size")).alias("requirement"))
    return x.select("job", "side", "l_orderkey", "pos", "requirement")


def req_position():
    """Order (12 digits), line (3), part (12), days since 1970 (5) as one whole number."""
    n = lambda c: F.col(c).cast("decimal(12,0)")
    days = F.unix_date(F.col("l_shipdate").cast("date")).cast("decimal(5,0)")
    part = n("l_partkey") * F.lit(Decimal(10 ** 5)) + days
    line = n("l_linenumber") * F.lit(Decimal(10 ** 17)) + part
    return (F.col("l_orderkey").cast("decimal(16,0)") * F.lit(Decimal(10 ** 20)) + line).cast("decimal(38,0)")


def req_runtime(spark, sf_dir, all_df: DataFrame | None = None) -> DataFrame:
    a = all_df if all_df is not None else req_all(spark, sf_dir)
    return a.filter(F.col("side") == "F").select("job", "pos", "requirement")


def req_job(spark, sf_dir, all_df: DataFrame | None = None) -> DataFrame:
    a = all_df if all_df is not None else req_all(spark, sf_dir)
    return a.filter(F.col("side") == "O").select("job", "pos", "requirement")


def deps(spark, sf_dir) -> DataFrame:
    """Each customer's orders as a chain: a job depends on the customer's
    previous order (by date, then key). The previous row comes from a join on
    the skew-safe global index (unique, so no hot key), not a window per customer."""
    from sparksweep.operators.ordinal import with_row_index
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    x = with_row_index(o, ["o_custkey", "o_orderdate", "o_orderkey"], "gi")
    prev = x.select(F.col("o_custkey").alias("pc"), (F.col("gi") + 1).alias("pg"),
                    F.col("o_orderkey").alias("depends_on"))
    y = x.join(prev, (x.o_custkey == prev.pc) & (x.gi == prev.pg), "left")
    return y.select(
        F.col("o_orderkey").alias("job_no"),
        F.col("o_custkey").alias("chain"),
        (F.col("o_orderstatus") != "P").alias("ok"),
        "depends_on",
    )


def pairs(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    u = c.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("prompt"))
    a = c.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    return u.join(a, ["conv_id", "turn"]).select("conv_id", "turn", "prompt", "answer")


def files(spark, sf_dir) -> DataFrame:
    pg = table(spark, sf_dir, "pages").select("page_id", "url")
    stem = F.regexp_extract("url", r"([^/?#]*)([?#].*)?$", 1)
    m = F.col("page_id") % 7
    x = pg.withColumn("stem", stem)
    return x.select(
        "page_id", "url",
        F.when(m == 0, F.concat("stem", F.lit(".bin"))).when(m == 1, F.concat("stem", F.lit(".h5")))
        .when(m == 2, F.concat("stem", F.lit(".pt"))).when(m == 3, F.lit(".pt"))
        .when(m == 4, F.concat("stem", F.lit(".msgpack"))).when(m == 5, F.concat("stem", F.lit(".safetensors")))
        .otherwise(F.col("stem")).alias("file_name"),
    )


def job_log(spark, sf_dir, events_df: DataFrame | None = None) -> DataFrame:
    """Closing messages of the process runner, one line per status event."""
    e = events_df if events_df is not None else status_events(spark, sf_dir)
    seq, job, st = F.col("seq"), F.col("job"), F.col("status")
    s2 = F.lpad((seq % 60).cast("string"), 2, "0")
    line = (F.when(st == "Complete", F.concat(F.lit("["), job, F.lit("] Completed with code 0 in 0:00:"), s2,
                                              F.lit(".250000 seconds.")))
            .when(st == "Failed", F.when(seq % 2 == 0, F.concat(F.lit("["), job, F.lit("] Completed with code "),
                                                                 F.lit(1) + seq % 3, F.lit(" in 1 day, 2:03:"), s2,
                                                                 F.lit(" seconds.")))
                  .otherwise(F.concat(F.lit("Exception: step "), seq, F.lit(" ran out of memory"))))
            .when(st == "Created", F.when(seq % 3 == 0, F.concat(F.lit("Dependency j-"), seq % 150,
                                                                  F.lit(" failed. Skipping")))
                  .when(seq % 3 == 1, F.lit("[JobCancelled]"))
                  .otherwise(F.concat(F.lit("waiting for "), job)))
            .otherwise(F.concat(F.lit("loss="), F.round(F.lit(1.0) / (F.lit(1) + seq % 97), 6),
                                F.lit(" step="), seq)))
    return e.select("job", "seq", "ts", line.alias("line"))


# DuckDB twins, written as SQL text. Dependencies are listed so that a query's
# WITH clause can pull in exactly what it needs.
VIEW_SQL: dict[str, tuple[tuple[str, ...], str]] = {
    "v_runtimes": ((), """
SELECT concat('rt-', n_nationkey) AS name,
       CASE n_regionkey WHEN 0 THEN 'torch' WHEN 1 THEN 'mpi' WHEN 2 THEN 'torchtune' WHEN 3 THEN 'deepspeed' END AS framework,
       1 + n_nationkey % 4 AS num_nodes,
       CASE WHEN n_nationkey % 3 = 0 THEN 2 END AS gpu_limit,
       CASE WHEN n_nationkey % 3 = 1 THEN 4 END AS tpu_limit,
       CASE WHEN n_nationkey % 5 <> 0 THEN 8 END AS cpu_limit,
       CASE WHEN n_nationkey = 5 THEN 1 END AS npu_limit,
       CASE WHEN n_regionkey < 2 THEN 2 END AS procs_per_node
FROM nation"""),
    "v_jobs": ((), """
SELECT concat('job-', o_orderkey) AS job, o_orderkey AS job_no,
       concat('exp-', o_custkey) AS experiment,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN 'rt-gone' ELSE concat('rt-', c_nationkey) END AS runtime_ref,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 0 ELSE 1 + o_orderkey % 4 END AS num_nodes,
       o_orderdate AS created,
       CASE o_orderstatus WHEN 'F' THEN 'Complete' WHEN 'P' THEN 'Failed' END AS cond_type,
       CASE WHEN o_orderkey % 11 = 0 THEN 'False' ELSE 'True' END AS cond_status,
       o_orderpriority AS priority, o_totalprice AS objective
FROM orders JOIN customer ON o_custkey = c_custkey"""),
    "v_steps": ((), """
SELECT concat('job-', l_orderkey) AS job, idx,
       CASE WHEN idx = 0 AND l_partkey % 5 = 0 THEN 'dataset-initializer' ELSE concat('node-', idx) END AS name,
       CASE WHEN l_partkey % 13 = 0 THEN NULL
            WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN 'Pending'
            WHEN l_returnflag = 'A' THEN 'Succeeded'
            WHEN l_linestatus = 'O' AND l_returnflag = 'R' THEN 'Failed'
            ELSE 'Running' END AS status,
       l_shipdate AS ts, l_quantity AS quantity, l_linenumber % 3 AS kind
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate) - 1 AS idx
      FROM lineitem) x"""),
    "v_containers": (("v_steps",), """
SELECT job, idx, concat(job, '-node-', idx) AS name, ts AS created,
       CASE WHEN status = 'Running' THEN 'running' WHEN status = 'Pending' THEN 'created'
            WHEN status IN ('Succeeded', 'Failed') THEN 'exited' ELSE 'paused' END AS state,
       CASE status WHEN 'Succeeded' THEN 0 WHEN 'Failed' THEN 1 END AS exit_code
FROM v_steps"""),
    "v_resources": (("v_steps",), """
SELECT job, idx, CASE kind WHEN 0 THEN 'CPU' WHEN 1 THEN 'gpu' ELSE 'Memory' END AS res_key, quantity FROM v_steps"""),
    "v_metric_log": ((), """
SELECT concat('t-', user_id) AS trial, event_type AS metric, value, ts, event_id AS seq,
       concat(event_type, '=', value) AS line
FROM events"""),
    "v_status_events": ((), """
SELECT concat('j-', user_id, '-', CAST(ts AS DATE)) AS job, ts, event_id AS seq,
       CASE event_type WHEN 'click' THEN 'Created' WHEN 'purchase' THEN 'Complete' WHEN 'error' THEN 'Failed' ELSE 'Running' END AS status
FROM events"""),
    "v_catalog": ((), """
SELECT p_name AS name, p_size % 3 AS prio, p_partkey AS pos,
       CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE lower(p_type) END AS framework,
       CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE concat('img/', p_brand) END AS image,
       1 + p_size % 4 AS num_nodes
FROM part"""),
    "v_catalog_defaults": ((), """
SELECT concat('default-', lower(r_name)) AS name FROM region UNION ALL SELECT 'red plate' AS name"""),
    "v_req_all": ((), """
SELECT l_suppkey AS job, l_linestatus AS side, l_orderkey,
       l_orderkey::HUGEINT * 100000000000000000000 + l_linenumber::HUGEINT * 100000000000000000
         + l_partkey::HUGEINT * 100000 + date_diff('day', DATE '1970-01-01', l_shipdate::DATE) AS pos,
       concat(CASE l_linenumber % 3 WHEN 0 THEN replace(p_name, ' ', '_') WHEN 1 THEN upper(replace(p_name, ' ', '.')) ELSE replace(p_name, ' ', '-') END,
              '==', p_size) AS requirement
FROM lineitem JOIN part ON l_partkey = p_partkey"""),
    "v_req_runtime": (("v_req_all",), "SELECT job, pos, requirement FROM v_req_all WHERE side = 'F'"),
    "v_req_job": (("v_req_all",), "SELECT job, pos, requirement FROM v_req_all WHERE side = 'O'"),
    "v_deps": ((), """
SELECT o_orderkey AS job_no, o_custkey AS chain, o_orderstatus <> 'P' AS ok,
       lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS depends_on
FROM orders"""),
    "v_pairs": ((), """
SELECT u.conv_id, u.turn, u.text AS prompt, a.text AS answer
FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
WHERE u.role = 'user' AND a.role = 'assistant'"""),
    "v_files": ((), """
SELECT page_id, url,
       CASE page_id % 7 WHEN 0 THEN concat(stem, '.bin') WHEN 1 THEN concat(stem, '.h5') WHEN 2 THEN concat(stem, '.pt')
            WHEN 3 THEN '.pt' WHEN 4 THEN concat(stem, '.msgpack') WHEN 5 THEN concat(stem, '.safetensors') ELSE stem END AS file_name
FROM (SELECT page_id, url, regexp_extract(url, '([^/?#]*)([?#].*)?$', 1) AS stem FROM pages) x"""),
    "v_job_log": (("v_status_events",), """
SELECT job, seq, ts,
  CASE status
    WHEN 'Complete' THEN concat('[', job, '] Completed with code 0 in 0:00:', lpad(CAST(seq % 60 AS VARCHAR), 2, '0'), '.250000 seconds.')
    WHEN 'Failed' THEN CASE WHEN seq % 2 = 0 THEN concat('[', job, '] Completed with code ', 1 + seq % 3, ' in 1 day, 2:03:', lpad(CAST(seq % 60 AS VARCHAR), 2, '0'), ' seconds.')
                            ELSE concat('Exception: step ', seq, ' ran out of memory') END
    WHEN 'Created' THEN CASE WHEN seq % 3 = 0 THEN concat('Dependency j-', seq % 150, ' failed. Skipping')
                             WHEN seq % 3 = 1 THEN '[JobCancelled]' ELSE concat('waiting for ', job) END
    ELSE concat('loss=', round(1.0 / (1 + seq % 97), 6), ' step=', seq) END AS line
FROM v_status_events"""),
}


def with_views(body: str, *names: str, ctes: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the WITH clause of the named views (and extra CTEs)."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in VIEW_SQL[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} AS ({VIEW_SQL[n][1].strip()})" for n in order]
    parts += [f"{k} AS ({v.strip()})" for k, v in (ctes or {}).items()]
    if not parts:
        return body.strip()
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


SPARK_VIEWS = {
    "v_runtimes": runtimes, "v_jobs": jobs, "v_steps": steps, "v_containers": containers,
    "v_resources": resources, "v_metric_log": metric_log, "v_status_events": status_events,
    "v_catalog": catalog, "v_catalog_defaults": catalog_defaults, "v_req_all": req_all,
    "v_req_runtime": req_runtime, "v_req_job": req_job, "v_deps": deps, "v_pairs": pairs,
    "v_files": files, "v_job_log": job_log,
}
