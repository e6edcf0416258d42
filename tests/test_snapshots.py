"""Registration and deletion by snapshots (SNK-1, SNK-2): crashes at each step, files read, conflicts."""

import pytest
from pyspark.sql import functions as F

from sparksweep.operators.snapshots import Conflict, Snapshots
from sparksweep.session import shared_dir

JOBS = "job string, v string"


def tables(spark, n=300, buckets=4):
    held = Snapshots(spark, shared_dir(spark, "snap test"), buckets)  # a path with a space
    jobs = spark.range(n).select(F.format_string("job-%05d", "id").alias("job"), (F.col("id") % 3).alias("kind"))
    steps = jobs.select("job", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("step"))
    held.create({"jobs": (jobs, "job"), "steps": (steps, "job")})
    return held


def shown(held, name):
    return sorted(map(tuple, held.read(name).collect()), key=repr)


def test_rows_are_registered_once(spark):
    held = Snapshots(spark, shared_dir(spark, "snap"), 4)
    a = spark.createDataFrame([("j", "s1", "old"), ("j", "s2", "old"), ("j", "s2", "older")], "job string, name string, v string")
    b = spark.createDataFrame([("j", "s2", "new"), ("j", "s2", "newer"), ("j", "s3", "new"), ("j", None, "x")], "job string, name string, v string")
    assert held.register("t", a, ["job", "name"], ["v"]) == 0
    assert held.register("t", b, ["job", "name"], ["v"]) == 2
    assert held.register("t", b.where("name is not null"), ["job", "name"], ["v"]) == 3
    assert shown(held, "t") == sorted([("j", "s1", "old"), ("j", "s2", "old"), ("j", "s3", "new"), ("j", None, "x")], key=repr)
    assert held.register("t", a.where("false"), ["job", "name"], ["v"]) == 0
    with pytest.raises(ValueError, match="no table"):
        held.read("none")


def test_registration_reads_only_files_that_may_hold_a_key(spark):
    held = Snapshots(spark, shared_dir(spark, "snap"), 4)
    day = lambda d, n=200: spark.range(n).select(F.format_string(f"{d}-%05d", "id").alias("job"), F.lit(d).alias("v"))
    for d in ("2024-01-01", "2024-01-02", "2024-01-03"):
        held.register("t", day(d), ["job"], ["v"])
        assert held.read_files == []  # later keys lie behind every range
    files = {r["file"] for r in held.entries().where("file is not null").collect()}
    assert held.register("t", day("2024-01-02", 1), ["job"], ["v"]) == 1
    assert 1 <= len(held.read_files) < len(files) / 3  # one bucket of one day
    assert held.read("t").count() == 600


@pytest.mark.parametrize("step", ["_write", "_publish"])
def test_a_crash_at_any_step_loses_nothing(spark, monkeypatch, step):
    held = tables(spark)
    names = spark.createDataFrame([(f"job-{i:05d}",) for i in range(0, 300, 7)], "job string")
    before = {t: shown(held, t) for t in ("jobs", "steps")}
    gone = {r["job"] for r in names.collect()}
    real, calls = getattr(Snapshots, step), []

    def crash(self, *args):
        out = real(self, *args) if step == "_write" else None
        if step == "_write" and not calls:  # the first table's new files are written, the second's not
            calls.append(1)
            return out
        raise RuntimeError("killed")

    monkeypatch.setattr(Snapshots, step, crash)
    with pytest.raises(RuntimeError, match="killed"):
        held.delete(names, "job", ["jobs", "steps"], known="jobs")
    monkeypatch.undo()
    assert {t: shown(held, t) for t in before} == before  # both tables as they were
    again = Snapshots(spark, held.path, held.buckets)
    assert again.delete(names, "job", ["jobs", "steps"], known="jobs") > 0
    for t in before:
        assert shown(again, t) == [r for r in before[t] if r[0] not in gone]
    new = spark.createDataFrame([("job-00000", 5), ("job-00001", 5)], "job string, kind long")
    monkeypatch.setattr(Snapshots, step, crash)
    calls.append(1)
    with pytest.raises(RuntimeError, match="killed"):
        again.register("jobs", new, ["job"], ["kind"])
    monkeypatch.undo()
    assert again.register("jobs", new, ["job"], ["kind"]) == 1  # job-00000 was deleted, job-00001 is still there
    assert ("job-00000", 5) in shown(again, "jobs") and ("job-00001", 1) in shown(again, "jobs")


def test_unknown_names_are_errors_and_delete_nothing(spark):
    held = tables(spark, 20)
    at = held.version()
    with pytest.raises(ValueError, match="no job named 'job-99999'"):
        held.delete(spark.createDataFrame([("job-00001",), ("job-99999",)], "job string"), "job", ["jobs", "steps"], known="jobs")
    assert held.version() == at and held.read("jobs").count() == 20
    assert held.delete(spark.createDataFrame([("job-99999",)], "job string"), "job", ["jobs", "steps"]) == 0
    assert held.delete(held.read("jobs").select("job"), "job", ["jobs", "steps"], known="jobs") > 0
    assert held.read("jobs").count() == held.read("steps").count() == 0 and held.read("jobs").columns == ["job", "kind"]


def test_readers_keep_their_version_until_vacuum(spark):
    held = tables(spark, 50)
    reader = held.read("steps")
    held.delete(spark.createDataFrame([("job-00003",)], "job string"), "job", ["jobs", "steps"], known="jobs")
    assert reader.count() == 150 and held.read("steps").count() == 147
    assert held.vacuum(keep=2) == 0 and reader.count() == 150
    held.delete(spark.createDataFrame([("job-00004",)], "job string"), "job", ["jobs", "steps"])
    assert held.vacuum() > 0
    assert held.read("steps").count() == 144 and len(shown(held, "jobs")) == 48


def test_two_writers_of_one_version_conflict(spark):
    held = tables(spark, 5)
    number = held.version()[0]
    held._publish(number + 1, "a" * 32)
    with pytest.raises(Conflict):
        held._publish(number + 1, "b" * 32)
    assert held.version() == (number + 1, "a" * 32)
