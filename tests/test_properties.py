"""Properties: partition independence, disjoint and complete shards, brute-force
checks of the iterative and user-function paths."""

import fnmatch
import os
import random
import tempfile

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparksweep.functions import search as SR
from sparksweep.functions import user as UF
from sparksweep.operators import datasets as D
from sparksweep.operators import ordinal as O
from sparksweep.operators import dependencies as DP
from sparksweep.plans import sweep as S


@pytest.mark.parametrize("parts", [1, 4, 200])
def test_draws_do_not_depend_on_partitioning(spark, parts):
    base = spark.range(0, 300, 1, parts).withColumnRenamed("id", "trial_no")
    x = base.select("trial_no", S.PRICE_SPACE["slope"].from_unit(SR.unit_draw(7, F.col("trial_no"), "slope"))
                    .alias("slope"))
    ref = spark.range(0, 300, 1, 1).withColumnRenamed("id", "trial_no").select(
        "trial_no", S.PRICE_SPACE["slope"].from_unit(SR.unit_draw(7, F.col("trial_no"), "slope")).alias("slope"))
    assert sorted(map(tuple, x.collect())) == sorted(map(tuple, ref.collect()))


def test_draws_stay_in_range(spark):
    t = S.trial_table(spark, S.PRICE_SPACE, 500, S.RandomSearch(3))
    r = t.agg(F.min("slope"), F.max("slope"), F.min("shift"), F.max("shift")).first()
    assert 500 <= r[0] and r[1] <= 2500 and 1 <= r[2] and r[3] <= 10000
    assert {x[0] for x in t.select("kind").distinct().collect()} == {"a", "b", "c"}


def test_grid_is_every_combination_and_capped(spark):
    g = S.GridSearch(points={"slope": 3, "shift": 2})
    full = S.trial_table(spark, S.PRICE_SPACE, 1000, g)
    assert full.count() == 18
    assert full.select("slope", "shift", "kind").distinct().count() == 18
    assert S.trial_table(spark, S.PRICE_SPACE, 5, g).count() == 5
    with pytest.raises(ValueError):
        S.trial_table(spark, S.PRICE_SPACE, 5, S.GridSearch())
    with pytest.raises(ValueError):
        S.trial_table(spark, {}, 5)


def test_sweep_chunks_equal_one_broadcast(spark):
    data = spark.range(0, 2000).select((F.col("id") % 37).cast("double").alias("x"),
                                       (F.col("id") * 1.5).alias("y"))
    trials = S.trial_table(spark, {"a": SR.Uniform(0, 3), "b": SR.Uniform(-5, 5)}, 40, S.RandomSearch(1))
    def errors(batch, p):
        err = batch["y"] - p["a"][:, None] * batch["x"] - p["b"][:, None]
        return {"abs_err": abs(err).sum(axis=1), "n": [err.shape[1]] * len(err)}

    m = {"mae": F.round(F.col("abs_err") / F.col("n"), 6)}
    one = S.score(data, trials, errors, ["abs_err", "n"], m, 40, ["a", "b"])
    chunked = S.score(data, trials, errors, ["abs_err", "n"], m, 40, ["a", "b"], trials_per_pass=7)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("BroadcastNestedLoopJoin", "CartesianProduct", "Generate"))
    with pytest.raises(ValueError):
        S.score(data, trials, errors, ["abs_err", "n"], m, 39, ["a", "b"])
    assert sorted(map(tuple, one.select("trial_no", "mae").collect())) == \
        sorted(map(tuple, chunked.select("trial_no", "mae").collect()))


def test_best_trial_direction_and_nan(spark):
    s = spark.createDataFrame([(0, 1.0), (1, float("nan")), (2, 0.5), (3, None), (4, 0.5)],
                              "trial_no long, loss double")
    assert S.best_trial(s, [S.Objective("loss", "minimize")]).first()["trial_no"] == 2
    assert S.best_trial(s, [S.Objective("loss", "MAXIMIZE")]).first()["trial_no"] == 0
    empty = spark.createDataFrame([(0, None)], "trial_no long, loss double")
    assert S.best_trial(empty, ["loss"]).count() == 0
    assert [o.direction for o in S.read_back_objectives([("a", "maximize"), ("b", "minimize")])] == \
        ["maximize", "maximize"]


@pytest.mark.parametrize("world", [1, 3, 4])
def test_shards_are_disjoint_complete_and_even(spark, world):
    df = spark.range(0, 1001).withColumnRenamed("id", "doc_id")
    x = D.shard(df, world, order_cols=["doc_id"])
    assert x.count() == 1001 and x.select("doc_id").distinct().count() == 1001
    sizes = [r["count"] for r in x.groupBy("rank").count().collect()]
    assert max(sizes) - min(sizes) <= 1 and len(sizes) == world
    h = D.shard(df, world, key="doc_id")
    assert h.count() == 1001 and h.select("doc_id").distinct().count() == 1001
    assert h.agg(F.min("rank"), F.max("rank")).first()[0] >= 0


def test_row_index_with_skewed_groups(spark):
    # one group holds most rows: the range partitioning still cuts it into many tasks
    df = spark.range(0, 5000).select(F.when(F.col("id") < 4000, F.lit("hot")).otherwise(
        (F.col("id") % 7).cast("string")).alias("g"), F.col("id"))
    x = O.with_row_index(df, ["id"], "i", group_cols=["g"], group_index_col="gi", num_partitions=16)
    got = {(r["g"], r["id"]): (r["i"], r["gi"]) for r in x.collect()}
    ordered = sorted((g, i) for g, i in got)
    for k, key in enumerate(ordered):
        assert got[key][0] == k
    for g in {g for g, _ in ordered}:
        ids = sorted(i for gg, i in ordered if gg == g)
        assert [got[(g, i)][1] for i in ids] == list(range(len(ids)))


@pytest.mark.parametrize("spec,n", [("train", 10), ("train[:10%]", 50), ("train[2:5]", 10), ("train[-3:]", 10),
                                    ("train[-20%:]", 50), ("train[5%:-10%]", 1000)])
def test_split_bounds_match_python_slices(spec, n):
    lo, hi = D.split_bounds(spec, n)
    _, a, b = D.parse_split(spec)

    def conv(t):
        if t is None:
            return None
        return int(round(int(t[:-1]) * n / 100.0)) if t.endswith("%") else int(t)
    assert list(range(n))[lo:hi] == list(range(n))[conv(a):conv(b)]


@pytest.mark.filterwarnings("ignore::FutureWarning")  # Python's re warns about "[[" sets
@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab.*?[]!-_", min_size=1, max_size=6), st.text(alphabet="ab.-_", max_size=6))
def test_glob_regex_matches_fnmatch(pattern, name):
    import re
    try:
        rx = re.compile(D.glob_to_regex(pattern).replace("(?s:", "(?:"))
    except re.error:
        return
    assert bool(rx.match(name)) == fnmatch.fnmatchcase(name, pattern)


def test_dependency_frontier_and_chain_paths_agree(spark):
    rnd = random.Random(5)
    edges, oks = [], {}
    for j in range(1, 120):
        oks[j] = rnd.random() > 0.15
        deps = rnd.sample(range(0, j), k=min(j, rnd.choice([0, 1, 2])))
        edges += [(j, d, oks[j]) for d in deps] or [(j, None, oks[j])]
    edges.append((0, None, True))
    oks[0] = True
    df = spark.createDataFrame(edges, "job_no long, depends_on long, ok boolean")
    got = dict((r["job_no"], r["status"]) for r in DP.dependency_status(df).collect())
    deps = {}
    for j, d, _ in edges:
        deps.setdefault(j, [])
        if d is not None:
            deps[j].append(d)
    status = {}
    for j in sorted(deps):
        ran = all(status[d] == "Complete" for d in deps[j])
        status[j] = ("Complete" if oks[j] else "Failed") if ran else "Skipped"
    assert got == status
    chain = spark.createDataFrame([(i, i - 1 if i else None, i != 5) for i in range(40)],
                                  "job_no long, depends_on long, ok boolean")
    got = dict((r["job_no"], r["status"]) for r in DP.dependency_status(chain).collect())
    assert [got[i] for i in range(40)] == ["Complete"] * 5 + ["Failed"] + ["Skipped"] * 34


def test_run_trials_sample_objective(spark):
    # the sample objective of the reference's README: loss = 1 - 2*lr - 0.01*epochs
    def train(lr, epochs):
        return {"loss": 1 - 2 * float(lr) - 0.01 * int(epochs)}
    trials = spark.createDataFrame([(0, 0.1, 5), (1, 0.2, 10), (2, None, 1)],
                                   "trial_no long, lr double, epochs long")
    got = {r["trial_no"]: (r["status"], r["loss"]) for r in
           UF.run_trials(trials, train, ["lr", "epochs"], ["loss"], parallel_trials=2).collect()}
    assert got[0] == ("Succeeded", pytest.approx(0.75))
    assert got[1] == ("Succeeded", pytest.approx(0.5))
    assert got[2][0] == "Failed"


def test_run_on_nodes_ranks_and_env(spark):
    def fn(batches, rank, world_size, tag):
        n = sum(len(b) for b in batches)
        yield pd.DataFrame({"n": [n], "world": [int(os.environ["WORLD_SIZE"])], "tag": [tag],
                            "node": [int(os.environ["NODE_RANK"])]})
    out = UF.run_on_nodes(spark.range(0, 1000), fn, "n long, world long, tag string, node long",
                          num_nodes=2, procs_per_node=2, kwargs={"tag": "t"}).collect()
    assert sorted(r["rank"] for r in out) == [0, 1, 2, 3]
    assert sum(r["n"] for r in out) == 1000
    assert {r["world"] for r in out} == {4} and sorted(r["node"] for r in out) == [0, 0, 1, 1]


def test_job_options_backend_check(spark):
    jobs = spark.createDataFrame([("j",)], "job string")
    with pytest.raises(ValueError):
        UF.apply_options(jobs, [UF.Labels({"a": "b"})], backend="container")
    x = UF.apply_options(jobs, [UF.Name("n"), UF.Labels({"a": "1"}), UF.Labels({"b": "2"})]).first()
    assert x["name"] == "n" and x["labels"] == {"b": "2"}


def test_running_sum_with_skewed_groups(spark):
    df = spark.range(0, 3000).select(
        F.when(F.col("id") < 2500, F.lit("hot")).otherwise((F.col("id") % 5).cast("string")).alias("g"),
        F.col("id"), ((F.col("id") * 7) % 3 == 0).cast("int").alias("v"))
    x = O.with_running_sum(df, ["id"], "v", "before", group_cols=["g"], num_partitions=12)
    got = {r["id"]: r["before"] for r in x.collect()}
    exp, acc = {}, {}
    for r in sorted(df.collect(), key=lambda r: (r["g"], r["id"])):
        exp[r["id"]] = acc.get(r["g"], 0)
        acc[r["g"]] = acc.get(r["g"], 0) + r["v"]
    assert got == exp


def test_promoted_labels_reach_the_scan(spark):
    from sparksweep.operators import jobs as J
    from sparksweep.session import shared_dir
    steps = spark.createDataFrame([("j1", "node-0", 0), ("j1", "dataset-initializer", 0), ("j2", "node-1", 1)],
                                  "job string, name string, idx int")
    path = shared_dir(spark, "labels")
    J.promote_labels(J.step_labels(steps), ["replicatedjob-name"]).write.parquet(path)
    df = spark.read.parquet(path).filter(F.col("label_replicatedjob_name") == "node")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "label_replicatedjob_name" in plan.split("PushedFilters:")[1].split("]")[0]
    assert sorted(r["name"] for r in df.collect()) == ["node-0", "node-1"]


def test_register_stream_keeps_first_rows(spark):
    from sparksweep.session import shared_dir
    from sparksweep.streaming import runner as R
    src = shared_dir(spark, "reg-src")
    spark.createDataFrame([("j", "s1", "a"), ("j", "s2", "a")], "job string, name string, v string") \
        .write.parquet(src)
    spark.createDataFrame([("j", "s2", "b"), ("j", "s3", "b")], "job string, name string, v string") \
        .write.mode("append").parquet(src)
    stream = R.file_stream(spark, src, "job string, name string, v string", files_per_trigger=1)
    out = R.register_stream(stream, shared_dir(spark, "reg-table"), ["job", "name"], ["v"])
    got = sorted((r["name"], r["v"]) for r in out.collect())
    assert [n for n, _ in got] == ["s1", "s2", "s3"] and dict(got)["s3"] == "b"


def test_requirement_merge_is_idempotent(spark):
    from pyspark.sql import Window
    from sparksweep.operators import requirements as R
    rnd = random.Random(11)
    names = ["torch", "Torch", "numpy", "NumPy", "pandas", "scipy", "a_b", "a-b", "A.B"]
    rt = [(j, p, f"{rnd.choice(names)}=={p}") for j in range(4) for p in range(12)]
    jb = [(j, p, f"{n}>=1") for j in range(3) for p, n in enumerate(rnd.sample(["torch", "pandas", "x-y"], 2))]
    rt_df = spark.createDataFrame(rt, "job int, pos int, requirement string")
    jb_df = spark.createDataFrame(jb, "job int, pos int, requirement string")
    once = R.merge(rt_df, jb_df)
    w = Window.partitionBy("job").orderBy("section", "pos")
    as_runtime = once.select("job", F.row_number().over(w).alias("pos"), "requirement")
    twice = R.merge(as_runtime, jb_df)

    def seq(df):
        out = {}
        for r in sorted(df.collect(), key=lambda r: (r["job"], r["section"], r["pos"])):
            out.setdefault(r["job"], []).append(r["requirement"])
        return out
    assert seq(once) == seq(twice)


def test_mount_table_paths(spark):
    from sparksweep.sources import uris as U
    uris = spark.createDataFrame([("hf://org/data/x.json",), ("hf://other/set",), ("s3://b/k/v",), ("gs://z/y",)],
                                 "uri string")
    mounts = spark.createDataFrame([("hf", None, "/mnt/hf"), ("hf", "org", "/fast/hf-org/"), ("s3", None, "/mnt/s3")],
                                   "scheme string, host string, base string")
    got = {r["uri"]: r["local_path"] for r in U.mount_paths(uris, mounts).collect()}
    assert got == {"hf://org/data/x.json": "/fast/hf-org/org/data/x.json", "hf://other/set": "/mnt/hf/other/set",
                   "s3://b/k/v": "/mnt/s3/b/k/v", "gs://z/y": None}


def test_replayed_rows_are_counted_as_late(spark, sf_dir):
    from sparksweep.plans import views as V
    from sparksweep.session import shared_dir
    from sparksweep.streaming import logs as SL
    from sparksweep.streaming import runner as R
    events = V.table(spark, sf_dir, "events")
    landed = shared_dir(spark, "late")
    k = R.land_in_order(events, landed).files
    R.land_in_order(events, landed, files_per_bucket=k)
    stream = R.file_stream(spark, landed, events.schema, 2 * k)
    lines = V.job_log(spark, sf_dir, V.status_events(spark, sf_dir, stream))
    stats = {}
    out = R.run_to_parquet(SL.deliver_once(SL.event_time(lines), ["job", "seq"], "event_ts", "1 day")
                           .select("job", "seq"), "late", state_partitions=4, stats=stats)
    n = events.count()
    assert spark.read.parquet(out).count() == n
    assert stats["rows_read"] == 2 * n and 0 < stats["rows_dropped_late"] <= n
    late = R.late_rows(SL.event_time(lines), "late", "event_ts", "1 day")
    assert spark.read.parquet(late).count() == stats["rows_dropped_late"]


def test_rows_without_time_are_kept_as_rejects(spark):
    import datetime as dt

    from sparksweep.session import shared_dir
    from sparksweep.streaming import runner as R
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(days=30, seconds=i)) for i in range(2000)] + [(5000, t0), (6000, None), (6001, None)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz")
    path = shared_dir(spark, "null-times")
    got = R.land_in_order(df, path, files_per_bucket=4)
    assert got.files == 4 and got.rejected == 2  # one early row makes no bucket of its own
    assert spark.read.parquet(path).count() == 2001
    assert sorted(r["id"] for r in spark.read.schema(df.schema).parquet(got.rejects).collect()) == [6000, 6001]


def test_grid_past_64_bits(spark):
    space = {f"p{i}": SR.Uniform(0, 1) for i in range(25)}
    t = S.trial_table(spark, space, 5, S.GridSearch(points=10)).orderBy("trial_no").collect()
    assert [round(r["p24"] * 9) for r in t] == [0, 1, 2, 3, 4] and all(r["p0"] == 0 for r in t)


def test_whole_error_text_of_the_first_failure(spark):
    from sparksweep.functions import user as UF

    def fails(pdf, a):
        raise ValueError("x" * 3000)

    trials = spark.createDataFrame([(0, 1.0), (1, 2.0)], "trial_no long, a double")
    got = UF.sweep_by_function(spark.range(10), trials, fails, ["s"], {"m": F.col("s")}, ["a"], trials_per_pass=1)
    assert [len(r["error"]) for r in got.collect()] == [3012, 3012]


def test_environment_of_a_rank_is_put_back(spark):
    import os

    from sparksweep.functions import user as UF

    def fn(batches, rank, world_size):
        import pandas as pd
        for _ in batches:
            pass
        yield pd.DataFrame({"x": [os.environ["MINE"]]})

    assert {r["x"] for r in UF.run_on_nodes(spark.range(4), fn, "x string", 2, env={"MINE": "1"}).collect()} == {"1"}
    left = spark.range(8).mapInPandas(lambda it: (p.assign(id=int("MINE" in os.environ)) for p in it), "id long")
    assert {r["id"] for r in left.collect()} == {0}


def test_arrow_overwrite_and_empty_set(spark):
    from sparksweep.session import shared_dir
    from sparksweep.sources import formats as FM
    path = shared_dir(spark, "arrow")
    FM.write_dataset(spark.range(100).repartition(7), path, "arrow")
    assert FM.read_dataset(spark, path, "arrow").count() == 100
    FM.write_dataset(spark.range(10).repartition(2), path, "arrow")
    assert sorted(r["id"] for r in FM.read_dataset(spark, path, "arrow").collect()) == list(range(10))
    FM.write_dataset(spark.range(0), path, "arrow")
    back = FM.read_dataset(spark, path, "arrow")
    assert back.columns == ["id"] and back.count() == 0


def test_dependency_graph_against_a_plain_walk(spark):
    rnd = random.Random(5)
    deps = {j: sorted(rnd.sample(range(j), min(j, rnd.choice([0, 1, 1, 1, 2, 3])))) for j in range(120)}
    ok = {j: rnd.random() > 0.05 for j in deps}
    rows = [(j, d, ok[j]) for j, ds in deps.items() for d in (ds or [None])]
    got = {r["job_no"]: r["status"] for r in DP.dependency_status(spark.createDataFrame(rows, "job_no long, depends_on long, ok boolean")).collect()}
    status = {}
    for j in sorted(deps):
        status[j] = "Skipped" if any(status[d] != "Complete" for d in deps[j]) else "Complete" if ok[j] else "Failed"
    assert got == status


def test_glob_tokens_match_fnmatch():
    import fnmatch
    import re

    from sparksweep.operators.datasets import glob_to_regex
    rnd = random.Random(3)
    names = ["".join(rnd.choice("ab.[]!-^\\*?x") for _ in range(rnd.randrange(6))) for _ in range(400)]
    for pattern in ["*", "a*", "?b", "[ab]*", "[!a]*", "*.x", "a[b", "[]a]", "a.b", "[a-b]x", "**", "[^a]", "\\*"]:
        rule = re.compile(glob_to_regex(pattern).replace("\\z", "\\Z"))
        assert [bool(rule.match(n)) for n in names] == [fnmatch.fnmatchcase(n, pattern) for n in names], pattern


def test_catalog_sources_by_exact_folder_with_rejects(spark):
    import json

    from sparksweep.operators.catalog import FRAMEWORK_LABEL
    from sparksweep.session import shared_dir
    from sparksweep.sources.catalog import load_catalog
    base = shared_dir(spark, "catalog-test")

    def doc(name, image):
        spec = {"template": {"spec": {"template": {"spec": {"containers": [{"name": "node", "image": image}]}}}}}
        return json.dumps({"kind": "TrainingRuntime", "metadata": {"name": name, "labels": {FRAMEWORK_LABEL: "torch"}},
                           "spec": {"template": {"spec": {"replicatedJobs": [{"name": "node", "template": spec["template"]}]}}}})

    for folder, docs in (("x y/a", [doc("r", "first"), "broken"]), ("data/x y/a", [doc("r", "second"), doc("s", "only")])):
        spark.createDataFrame([(d,) for d in docs], "value string").coalesce(1).write.text(f"{base}/{folder}")
    got, rejects = load_catalog(spark, ["github://o/r", f"{base}/x y/a", f"{base}/data/x y/a", "ftp://h/p", f"{base}/none"])
    assert {(r["name"], r["image"], r["prio"]) for r in got.collect()} == {("r", "first", 1), ("s", "only", 2)}
    assert sorted((r["prio"], r["error"]) for r in rejects.collect()) == [
        (0, "remote source is not fetched"), (1, "malformed document"), (3, "unsupported scheme"), (4, "no such folder")]

