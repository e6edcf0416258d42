"""What queries do once per job, document or file, so that their cost grows no faster than the input."""

from __future__ import annotations

import pyarrow as pa
import pytest

from sparksweep.operators import catalog as C
from sparksweep.operators import snapshots as SN
from sparksweep.plans import q_catalog as Q
from sparksweep.plans import views as V
from sparksweep.session import shared_dir
from sparksweep.sources import catalog as SC
from sparksweep.streaming import status as SS


class _Handle:
    """A state handle that counts its calls."""

    def __init__(self):
        self.held, self.calls = None, []

    def getValueState(self, name, schema):  # noqa: N802
        return self

    def get(self):
        self.calls.append("get")
        return self.held

    def update(self, value):
        self.calls.append("update")
        self.held = value

    def registerTimer(self, at):  # noqa: N802
        self.calls.append("timer")

    def deleteTimer(self, at):  # noqa: N802
        self.calls.append("no timer")


def _batch(processor, handle, rows):
    handle.calls.clear()
    return [tuple(r) for r in processor.handleInputRows(("j",), iter(rows), None)], handle.calls


def test_a_jobs_steps_are_read_and_written_once_a_batch():
    p, h = SS.JobStatusProcessor(), _Handle()
    p.init(h)
    rows = [{"step": f"node-{k % 3}", "ts_us": k, "seq": k, "status": "Running"} for k in range(9)]
    assert _batch(p, h, rows) == ([("j", "Running", 0)], ["get", "update"])
    done = [{"step": f"node-{k}", "ts_us": 20 + k, "seq": 20, "status": "Complete"} for k in range(3)]
    assert _batch(p, h, done) == ([("j", "Complete", 1)], ["get", "update"])
    assert _batch(p, h, rows) == ([], ["get"])  # older rows move nothing


def test_a_job_decided_in_its_first_batch_takes_one_timer():
    p, h = SS.WaitProcessor(("Complete",), 600, 3600), _Handle()
    p.init(h)
    rows = [{"ts_us": 5, "seq": 2, "status": "Complete"}, {"ts_us": 1, "seq": 1, "status": "Running"}]
    out, calls = _batch(p, h, rows)
    assert out == [("j", 1, "waiting", None, None), ("j", 1, "reached", "Complete", 5)]
    assert calls == ["get", "update", "timer"]


@pytest.mark.parametrize("style", ["json", "yaml"])
def test_documents_are_parsed_once_with_defaults(spark, style):
    rows = [("a", 0, 1, "torch", "img/a", 2), ("b", 1, 2, "torch", "img/b", 2)]
    docs = C.runtime_documents(spark.createDataFrame(rows, "name string, prio int, pos bigint, framework string, image string, num_nodes int"))
    sources = SC.write_catalog_sources(docs, shared_dir(spark, "once"), style=style)
    got, _ = SC.load_catalog(spark, sources, spark.createDataFrame([("a",), ("z",)], "name string"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "from_json" not in plan
    assert sorted(r["name"] for r in got.collect()) == ["a", "b", "z"]


def test_rejects_read_their_tables_once(spark, sf_dir):
    got = Q.jon6_requirement_rejects(spark, sf_dir)
    assert not [f for f in got.inputFiles() if "lineitem" in f]


def test_files_are_ranged_without_a_row_per_key():
    batch = pa.RecordBatch.from_pydict({"file": ["f", "f", "g", "f"], "bucket": pa.array([1, 1, 2, 1], pa.int32()),
                                        "k": pa.array(["b", None, None, "a"], pa.string())})
    (got,) = SN._ranges([batch])
    assert got.to_pylist() == [{"file": "f", "bucket": 1, "low": "a", "high": "b", "n": 3},
                               {"file": "g", "bucket": 2, "low": None, "high": None, "n": 1}]


def test_large_tables_sort_steps_in_more_tasks(spark, sf_dir, monkeypatch):
    few = V.steps(spark, sf_dir)
    monkeypatch.setattr(V, "STEP_BYTES", 2000)
    many = V.steps(spark, sf_dir)
    assert many.rdd.getNumPartitions() > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert few.exceptAll(many).isEmpty() and many.exceptAll(few).isEmpty()
