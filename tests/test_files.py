"""Files as rows (SRC-3) and Arrow files read by ranges of record batches (SRC-1)."""

import hashlib
import os

import pyarrow as pa
from pyspark.sql import functions as F

from sparksweep.session import shared_dir
from sparksweep.sources import files as FL
from sparksweep.sources import formats as FM

NAMES = ["a.bin", "b.safetensors", "c.pt", ".pt", "sub/d.h5", "sub/e.json", "sub/deep/er/f x%20.txt", "sub/deep/é.txt"]


def tree(spark, names, big=0):
    root = shared_dir(spark, "tree of files")
    for n in names:
        os.makedirs(os.path.dirname(f"{root}/{n}"), exist_ok=True)
        with open(f"{root}/{n}", "w") as f:
            f.write(n + "x" * big)
    return root


def test_manifest_of_a_tree(spark):
    root = tree(spark, NAMES)
    got = {r["path"]: r for r in FL.file_manifest(spark, root).collect()}
    assert sorted(got) == sorted(["b.safetensors", "c.pt", "sub/e.json", "sub/deep/er/f x%20.txt", "sub/deep/é.txt"])
    for path, r in got.items():
        assert r["sha256"] == hashlib.sha256(path.encode()).hexdigest() and r["size"] == len(path.encode())
        assert r["name"] == path.rsplit("/", 1)[-1] and abs(r["mtime"].timestamp() - os.path.getmtime(f"{root}/{path}")) < 1
    everything = FL.file_manifest(spark, root, patterns=[], with_hash=False).collect()
    assert len(everything) == len(NAMES) and {r["sha256"] for r in everything} == {None}


def test_hash_in_chunks_and_empty_folder(spark, monkeypatch):
    monkeypatch.setattr(FL, "CHUNK", 1000)
    root = tree(spark, ["one", "two"], big=12345)
    got = {r["path"]: r["sha256"] for r in FL.file_manifest(spark, root).collect()}
    assert got == {n: hashlib.sha256((n + "x" * 12345).encode()).hexdigest() for n in ("one", "two")}
    empty = shared_dir(spark, "empty")
    os.makedirs(empty)
    assert FL.file_manifest(spark, empty).count() == 0


def test_differences(spark):
    schema = "path string, name string, size long, mtime timestamp, sha256 string"
    row = lambda p, size, sha, t=0: (p, p, size, None if t is None else __import__("datetime").datetime(2024, 1, 1 + t), sha)
    old = spark.createDataFrame([row("same", 1, "a"), row("gone", 1, "b"), row("new content", 1, "c"), row("touched", 1, "d"), row("no hash", 1, None),
                                 row("no hash, touched", 1, None)], schema)
    new = spark.createDataFrame([row("same", 1, "a"), row("more", 2, "x"), row("new content", 1, "y"), row("touched", 1, "d", 5), row("no hash", 1, "z"),
                                 row("no hash, touched", 1, None, 3)], schema)
    got = {r["path"]: r["change"] for r in FL.manifest_diff(old, new).collect()}
    assert got == {"gone": "gone", "more": "added", "new content": "changed", "no hash, touched": "changed"}
    assert FL.manifest_diff(old, old).count() == 0


def test_listing_runs_in_tasks(spark, monkeypatch):
    root = tree(spark, [f"d{i}/e{j}/f{k}" for i in range(4) for j in range(3) for k in range(2)])
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        n = FL.list_files(spark, root).count()
        ran = len(jobs.getJobIdsForGroup("listing"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert n == 24 and ran >= 6  # a write and a count for each of the three levels


def test_one_arrow_file_is_read_by_many_tasks(spark):
    path = shared_dir(spark, "one arrow file")
    os.makedirs(path)
    batch = pa.RecordBatch.from_pydict({"id": list(range(1000)), "t": ["x" * 100] * 1000})
    with pa.ipc.new_file(f"{path}/big.arrow", batch.schema) as out:
        for _ in range(40):
            out.write_batch(batch)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512k")
    try:
        got = FM.read_dataset(spark, path, "arrow")
        tasks = got.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sum(r["n"] for r in tasks) == 40_000 and len(tasks) >= 6 and max(r["n"] for r in tasks) <= 12_000
    assert "content" not in plan  # no row holds a file
    assert got.agg(F.sum("id")).first()[0] == 40 * sum(range(1000))


def test_arrow_files_of_several_sizes_and_none(spark):
    path = shared_dir(spark, "arrow-mixed")
    FM.write_dataset(spark.range(100).repartition(5), path, "arrow")
    assert sorted(r["id"] for r in FM.read_dataset(spark, path, "arrow", "id long").collect()) == list(range(100))
    FM.write_dataset(spark.range(10).where("id < 0"), path, "arrow")
    back = FM.read_dataset(spark, path, "arrow")
    assert back.count() == 0 and back.columns == ["id"]
