"""Goldens on tiny hand tables, above all for the reference's quirks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparksweep.operators import catalog as C
from sparksweep.operators import datasets as D
from sparksweep.operators import jobs as J
from sparksweep.operators import requirements as R
from sparksweep.operators import status as S
from sparksweep.operators import steps as ST
from sparksweep.plans import space as SP
from sparksweep.sources import logs as L
from sparksweep.sources import uris as U


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: [(x is not None, x) for x in t])


def test_all_unknown_containers_are_complete(spark):
    c = spark.createDataFrame(
        [("a", "paused", None), ("a", "removing", None),        # all Unknown -> Complete (quirk)
         ("b", "running", None), ("b", "exited", 1),             # Failed wins over Running
         ("c", "exited", 0), ("c", "paused", None),              # non-Unknown all Complete
         ("d", "created", None), ("d", "exited", 0),             # a Created -> Created
         ("e", "exited", None)],                                 # exited without a code -> Failed
        "job string, state string, exit_code int")
    got = dict(rows(S.containers_job_status(c), "job", "status"))
    assert got == {"a": "Complete", "b": "Failed", "c": "Complete", "d": "Created", "e": "Failed"}


def test_null_runtime_jobs_are_kept(spark):
    j = spark.createDataFrame([("j1", "rt-1"), ("j2", None), ("j3", "rt-2")], "job string, runtime_ref string")
    assert rows(J.jobs_of_runtime(j, "rt-1"), "job") == [("j1",), ("j2",)]


def test_pt_pattern_only_drops_a_file_named_pt(spark):
    f = spark.createDataFrame([(n,) for n in ["model.pt", ".pt", "w.bin", "a.h5", "x.safetensors", "y.pth",
                                              ".pth", "z.msgpack"]], "file_name string")
    kept = [r[0] for r in rows(D.choose_files(f), "file_name")]
    assert kept == ["model.pt", "x.safetensors", "y.pth"]


def test_steps_sort_lexicographically(spark):
    s = spark.createDataFrame([("j", n) for n in ["node-2", "node-10", "node-1", "dataset-initializer"]],
                              "job string, name string")
    got = [r[0] for r in sorted((r["step_rank"], r["name"]) for r in S.step_order(s).collect())]
    assert got == [0, 1, 2, 3]
    order = [n for _, n in sorted((r["step_rank"], r["name"]) for r in S.step_order(s).collect())]
    assert order == ["dataset-initializer", "node-1", "node-10", "node-2"]


def test_last_decisive_condition_wins(spark):
    ct = "array<struct<type:string,status:string>>"
    jobs = spark.createDataFrame([
        ("a", 1, [("Complete", "True"), ("Failed", "True")]),
        ("b", 1, [("Failed", "True"), ("Complete", "False")]),
        ("c", 1, [("Complete", "False")]),
        ("d", 2, []),
        ("e", 1, []),
    ], f"job string, num_nodes long, conditions {ct}")
    steps = spark.createDataFrame([("d", "node-0", "Running"), ("d", "node-1", "Succeeded"),
                                   ("e", "node-0", "Pending"), ("a", "node-0", "Running")],
                                  "job string, name string, status string")
    got = dict(rows(S.job_status(jobs, steps), "job", "status"))
    assert got == {"a": "Failed", "b": "Failed", "c": "Created", "d": "Running", "e": "Created"}


def test_falsy_config_values_are_dropped(spark):
    from sparksweep.functions import render as RD
    cfg = spark.createDataFrame([
        ("bf16", 0, 2, None, True, 0, 0.0, ["q_proj", "v_proj"]),
        (None, 8, 0, "", False, 4, 0.1, []),
    ], "dtype string, batch_size int, epochs int, loss string, apply_lora_to_mlp boolean, lora_rank int, "
       "lora_dropout double, lora_attn_modules array<string>")
    got = [r[0] for r in cfg.select(RD.trainer_args(cfg.schema)).collect()]
    assert got == ["dtype=bf16 epochs=2 model.apply_lora_to_mlp=True model.lora_attn_modules=[q_proj,v_proj]",
                   "batch_size=8 model.lora_rank=4 model.lora_dropout=0.1"]


@pytest.mark.parametrize("text", ["", "\n", "a", "a\n", "a\n\n", "a\r\nb\rc\n", "\n\nx", "a\n\n\n"])
def test_splitlines_semantics(spark, text):
    df = spark.createDataFrame([(1, text)], "id int, t string")
    got = [r["line"] for r in sorted(L.split_lines(df, "t", ["id"]).collect(), key=lambda r: r["line_no"])]
    assert got == text.splitlines()


def test_requirement_merge_rules(spark):
    rt = spark.createDataFrame([(1, 1, "torch==2.0"), (1, 2, "numpy"), (1, 3, "Torch>=2.1"), (1, 4, "pandas"),
                                (2, 1, "a"), (2, 2, "a")], "job int, pos int, requirement string")
    jb = spark.createDataFrame([(1, 1, "NumPy==1.26")], "job int, pos int, requirement string")
    got = rows(R.merge(rt, jb), "job", "section", "pos", "requirement")
    # job 1: numpy overridden, torch's last duplicate kept at its position, then the job row;
    # job 2 has no job list: runtime list unchanged, duplicates included
    assert got == [(1, 0, 3, "Torch>=2.1"), (1, 0, 4, "pandas"), (1, 1, 1, "NumPy==1.26"),
                   (2, 0, 1, "a"), (2, 0, 2, "a")]


def test_canonical_names(spark):
    df = spark.createDataFrame([("  Foo.Bar_baz==1",), ("zope--interface",), ("",), ("   ",), ("==1",), (None,)],
                               "requirement string")
    x = R.with_names(df).withColumn("reason", R.reject_reason(F.col("requirement")))
    got = [(r["name"], r["reason"]) for r in x.collect()]
    assert got == [("foo-bar-baz", None), ("zope-interface", None), (None, "empty requirement"),
                   (None, "empty requirement"), (None, "unparsable requirement"), (None, "null requirement")]


def test_catalog_source_urls(spark):
    urls = [("github://owner/repo", "github", "owner/repo"),
            ("github://o/r/path/x", "github", "o/r/path/x"),
            ("https://x.io/rt.yaml", "https", "https://x.io/rt.yaml"),
            ("http://x.io/rt.yaml", "http", "http://x.io/rt.yaml"),
            ("file:///etc/rt", "file", "/etc/rt"),
            ("/abs/dir", "file", "/abs/dir"),
            ("ftp://nope", None, None)]
    df = spark.createDataFrame([(u,) for u, _, _ in urls], "url string")
    got = {r["url"]: (r["source_type"], r["path"]) for r in U.classify_sources(df, "url").collect()}
    assert got == {u: (t, p) for u, t, p in urls}


def test_cache_source_validation():
    assert D.CacheSource("cache://s/t", 3).cluster_size == 4
    for n in (1, 0, -1):
        with pytest.raises(ValueError):
            D.CacheSource("cache://s/t", n)
    with pytest.raises(ValueError):
        D.CacheSource("s3://s/t", 3)
    with pytest.raises(ValueError):
        D.CacheSource("cache://s/t/x", 3)


def test_source_option_map(spark):
    raw = F.create_map(F.lit("ignore_patterns"), F.lit("*.bin,*.h5"), F.lit("access_token"),
                       F.lit(None).cast("string"))
    got = spark.range(1).select(U.options_text(U.option_map(raw))).first()[0]
    assert got == "IGNORE_PATTERNS=*.bin,*.h5"


def test_wait_outcomes(spark):
    t0 = dt.datetime(2024, 1, 1)
    ev = spark.createDataFrame([
        ("ok", t0, 1, "Created"), ("ok", t0 + dt.timedelta(seconds=30), 2, "Complete"),
        ("bad", t0, 3, "Running"), ("bad", t0 + dt.timedelta(seconds=10), 4, "Failed"),
        ("slow", t0, 5, "Running"), ("slow", t0 + dt.timedelta(seconds=700), 6, "Complete"),
    ], "job string, ts timestamp_ntz, seq long, status string")
    got = dict(rows(S.wait_outcome(ev, ("Complete",), 600, 2), "job", "outcome"))
    assert got == {"ok": "reached", "bad": "failed", "slow": "timed_out"}
    got = dict(rows(S.wait_outcome(ev, ("Failed",), 600, 2), "job", "outcome"))
    assert got["bad"] == "reached"
    with pytest.raises(ValueError):
        S.wait_outcome(ev, ("Succeeded",), 600, 2)
    with pytest.raises(ValueError):
        S.wait_outcome(ev, ("Complete",), 1, 2)


def test_runtime_document_image_choice(spark):
    cat = spark.createDataFrame([("a", 12, "torch", "img/a", 2), ("b", 1, "torch", "img/b", 2),
                                 ("c", 2, "torch", None, 2), ("d", 3, None, "img/d", 2), ("e", 22, "mpi", "x", 3)],
                                "name string, pos int, framework string, image string, num_nodes int")
    docs = C.runtime_documents(cat)
    got = {r["name"]: (r["image"], r["num_nodes"], r["error"]) for r in
           C.parse_runtime_documents(docs, keep=["pos"]).collect()}
    assert got["a"] == ("img/a", 1, None)       # pos % 4 == 0: numNodes missing -> 1
    assert got["b"] == ("img/b", 2, None)       # no 'node' container: first with an image
    assert got["c"] == ("img/init", 2, None)    # 'node' has no image: first with one
    assert got["d"][2] == "missing framework"
    assert got["e"][2] == "not a runtime document"
    bad = spark.createDataFrame([("{not json",)], "doc string")
    assert C.parse_runtime_documents(bad).first()["error"] == "malformed document"


def test_log_steps_modes(spark):
    steps = spark.createDataFrame([("j", "node-0", "Running"), ("j", "node-1", "Pending"),
                                   ("j", "dataset-initializer", None)], "job string, name string, status string")
    req = spark.createDataFrame([("j", "node-1"), ("j", "dataset-initializer")], "job string, step string")
    assert rows(ST.log_steps(steps, req), "step", "container") == [("dataset-initializer", "dataset-initializer")]
    allreq = spark.createDataFrame([("j", "node-0")], "job string, step string")
    assert len(ST.log_steps(steps, allreq, all_steps_on_default=True).collect()) == 3
    assert len(ST.log_steps(steps, allreq).collect()) == 1


def test_bool_read_back_is_case_insensitive(spark):
    df = spark.createDataFrame([("True",), ("true",), ("FALSE",), ("x",)], "t string")
    got = [r[0] for r in df.select(SP.convert_value(F.col("t"), "bool")).collect()]
    assert got == [True, True, False, False]


def test_strict_validation_raises(spark):
    df = spark.createDataFrame([("a", None)], "name string, image string")
    with pytest.raises(ValueError):
        J.validate(df, {"image": "missing image"}, strict=True)


def test_unsupported_format():
    from sparksweep.sources.formats import check_format
    assert check_format("PARQUET") == "parquet"
    with pytest.raises(ValueError):
        check_format("avro")


def test_steps_from_pods(spark):
    gpu, cpu, npu = {"nvidia.com/gpu": "2", "cpu": "8"}, {"cpu": "8"}, {"example.com/npu": "1"}
    pods = spark.createDataFrame([
        ("m", "p0", "launcher", 0, cpu, None, "Running"), ("m", "p1", "node", 0, gpu, "8", "Running"),
        ("m", "p2", "node", 1, None, "x", None), ("m", "p3", "exporter", 0, cpu, None, "Running"),
        ("t", "p4", "node", 0, npu, None, "Running"), ("t", "p5", "dataset-initializer", 0, cpu, "3", "Succeeded")],
        "job string, pod_name string, rjob string, job_index long, limits map<string,string>, env_nproc string, status string")
    jobs = spark.createDataFrame([("m", "mpirun"), ("t", "torchrun"), ("none", "python")], "job string, command string")
    flat = J.job_steps(jobs, pods)
    assert rows(flat, "job", "step", "pod_name", "device", "device_count") == [
        ("m", "node-0", "p0", "cpu", "8"), ("m", "node-1", "p1", "gpu", "8"), ("m", "node-2", "p2", "Unknown", "Unknown"),
        ("none", None, None, None, None), ("t", "dataset-initializer", "p5", "cpu", "8"),
        ("t", "node-0", "p4", "Unknown", "Unknown")]
    nested = {r["job"]: [s["step"] for s in r["steps"]] for r in J.nested_steps(flat).collect()}
    assert nested == {"m": ["node-0", "node-1", "node-2"], "t": ["dataset-initializer", "node-0"], "none": []}


def test_devices_from_the_limits_map(spark):
    rts = spark.createDataFrame([("a", None, 2, None), ("b", {"example.com/npu": "1"}, 2, None), ("c", {"cpu": "4"}, 3, None),
                                 ("d", {"cpu": "4", "google.com/tpu": "2"}, 2, 5), ("e", {"cpu": "500m"}, 2, None)],
                                "name string, limits map<string,string>, num_nodes int, procs_per_node int")
    got = J.runtime_devices(rts.withColumn("framework", F.lit("torch")))
    assert rows(got, "name", "device", "device_count", "error") == [
        ("a", "Unknown", "Unknown", None), ("b", "Unknown", "Unknown", "no known device in the limits"),
        ("c", "cpu", "12", None), ("d", "tpu", "10", None), ("e", "cpu", "500m", None)]


def test_job_documents_with_odd_fields_are_rejects(spark):
    t = '"creationTimestamp":"2024-01-02T03:04:05Z"'
    docs = spark.createDataFrame([(x,) for x in (
        '{"metadata":{"name":"a","namespace":"n","creationTimestamp":"2024-01-02T03:04:05.123Z"},"spec":{"trainer":{"numNodes":"2"}}}',
        '{"metadata":{"name":"b","namespace":"n","creationTimestamp":"yesterday"},"spec":{"trainer":{"numNodes":3}}}',
        '{"metadata":{"namespace":"n",' + t + '},"spec":{"runtimeRef":{"name":"r"}}}',
        '{"metadata":{"name":"d","namespace":"n",' + t + '}}', "nonsense",
        '{"metadata":{"name":"e",' + t + '},"spec":{}}', '{"metadata":{"name":"f","namespace":"n",' + t + '},"spec":{"trainer":{"numNodes":"two"}}}')], "doc string")
    got = J.parse_job_documents(docs).select("job", F.col("created").cast("string").alias("t"), "job_num_nodes", "error").collect()
    assert [tuple(r) for r in got] == [
        ("a", "2024-01-02 03:04:05.123", 2, None), ("b", None, 3, "unreadable creation time"), (None, "2024-01-02 03:04:05", None, "missing name"),
        ("d", "2024-01-02 03:04:05", None, "missing spec"), (None, None, None, "missing name"), ("e", "2024-01-02 03:04:05", None, "missing namespace"),
        ("f", "2024-01-02 03:04:05", None, "node count is not a number")]


def test_repeated_names_do_not_fail(spark):
    from sparksweep.operators import experiments as EX
    doc = ('{"metadata":{"name":"e","namespace":"n","creationTimestamp":"2024-01-02T03:04:05.5Z"},"spec":{"parameters":[{"name":"p","parameterType":"categorical",'
           '"feasibleSpace":{"list":["1,2","3"]}}],"objective":{"type":"minimize","objectiveMetricName":"loss"},"algorithm":{"algorithmName":"random",'
           '"algorithmSettings":[{"name":"random_state","value":"1"},{"name":"x","value":"0"},{"name":"random_state","value":"2"}]},'
           '"maxTrialCount":1,"parallelTrialCount":1}}').replace(".5Z", ".500Z")
    x = EX.parse_experiment_documents(spark.createDataFrame([(doc,)], "doc string"))
    r = x.first()
    assert r["error"] is None and r["settings"] == {"random_state": "2", "x": "0"} and r["created"].microsecond == 500_000
    assert SP.read_back_space(EX.parameter_settings(x)).first()["choices"] == "1,2|3"  # two choices, one with a comma
    flat = spark.createDataFrame([("e", "t", "Complete", "lr", "0.1"), ("e", "t", "Complete", "lr", "0.2"), ("e", "u", "Complete", None, None)],
                                 "experiment string, trial string, trial_status string, param string, value string")
    assert {r["trial"]: r["parameters"] for r in J.nested_parameters(flat).collect()} == {"t": {"lr": "0.2"}, "u": {}}
    m = spark.range(1).select(U.option_map(F.create_map(F.lit("a"), F.lit("1"), F.lit("A"), F.lit("2"), F.lit("b"), F.lit(None))).alias("m"))
    assert m.first()["m"] == {"A": "2"}


def test_lines_end_as_in_splitlines(spark):
    from sparksweep.sources.logs import split_lines
    texts = ["a\x0bb\x0cc\x85d\u2028e", "x\x1cy\x1dz\x1e", "p\r\nq\rr\n", "\u2029", "", "no end"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {}
    for r in split_lines(df, "text", ["id"]).orderBy("id", "line_no").collect():
        got.setdefault(r["id"], []).append(r["line"])
    assert [got.get(i, []) for i in range(len(texts))] == [t.splitlines() for t in texts]


def test_merge_keeps_unreadable_rows_and_lists_them(spark):
    from sparksweep.operators import requirements as R
    rt = spark.createDataFrame([(1, 1, "torch==1"), (1, 2, "@@bad"), (1, 3, "numpy")], "job int, pos int, requirement string")
    jb = spark.createDataFrame([(1, 1, "Torch==2"), (1, 2, "torch==3"), (1, 3, None)], "job int, pos int, requirement string")
    assert rows(R.merge(rt, jb), "section", "requirement") == [
        (0, "@@bad"), (0, "numpy"), (1, None), (1, "Torch==2"), (1, "torch==3")]
    assert rows(R.merge_rejects(rt, jb), "section", "pos", "reason") == [
        (0, 2, "unparsable requirement"), (1, 2, "listed twice"), (1, 3, "null requirement")]


def test_cluster_mode_needs_the_node_container(spark):
    cat = spark.createDataFrame([("a", 12, "torch", "img/a", 2), ("b", 1, "torch", "img/b", 2),
                                 ("c", 2, "torch", None, 2), ("d", 4, "torch", "img/d", 2)],
                                "name string, pos int, framework string, image string, num_nodes int")
    got = {r["name"]: (r["image"], r["error"]) for r in
           C.parse_runtime_documents(C.runtime_documents(cat), mode="cluster").collect()}
    # b: the labelled initializer comes first and has no container ``node``; the next labelled job has one
    assert got == {"a": ("img/a", None), "b": ("img/b", None), "c": (None, "no trainer container"), "d": (None, "no trainer container")}


def test_numeric_step_order_and_array_distinct(spark):
    s = spark.createDataFrame([("j", n) for n in ["node-2", "node-10", "node-1", "dataset-initializer"]],
                              "job string, name string")
    order = [n for _, n in sorted((r["step_rank"], r["name"]) for r in S.step_order(s, numeric=True).collect())]
    assert order == ["dataset-initializer", "node-1", "node-2", "node-10"]
    arr = spark.createDataFrame([(["b", "a", "b", "c", "a"],)], "v array<string>")
    assert arr.select(R.ordered_distinct_array(F.col("v"))).first()[0] == ["b", "a", "c"]


def test_algorithm_round_trip(spark):
    from sparksweep.plans import sweep as SW
    algo = SW.RandomSearch(7)
    settings = dict(SP.algorithm_settings(algo))
    df = spark.createDataFrame([("e", SP.algorithm_name(algo), settings["random_state"])],
                               "experiment string, algorithm string, random_state string")
    got = SP.read_back_algorithm(df).first()
    assert (got["algorithm"], got["random_state"], got["error"]) == ("RandomSearch", 7, None)
    assert SP.algorithm_settings(SW.GridSearch()) == []
