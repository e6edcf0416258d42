"""YAML catalogs (SRC-6): the parser, and documents cut from files in many tasks."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from sparksweep.session import shared_dir
from sparksweep.sources import catalog as SC
from sparksweep.sources.yaml_docs import YamlError, parse, read_documents

TORCH = """\
apiVersion: trainer/v1alpha1
kind: ClusterTrainingRuntime
metadata:
  name: torch-distributed
  labels:
    trainer/framework: torch
spec:
  mlPolicy:
    numNodes: 1
  template:
    spec:
      replicatedJobs:
      - name: node
        template:
          spec:
            template:
              spec:
                containers:
                - name: trainer
                  image: "pytorch/pytorch:2.0.0"
"""

GOLDEN = [
    ("a: 1\nb:\n  c: x\n  d:\n  - 1\n  - {e: f, g: [1, 2]}\nh: 'it''s'", {"a": 1, "b": {"c": "x", "d": [1, {"e": "f", "g": [1, 2]}]}, "h": "it's"}),
    ("- a\n- - b\n  - c\n-\n  d: 1\n- e: 2\n  f:\n", ["a", ["b", "c"], {"d": 1}, {"e": 2, "f": None}]),
    ("a: |\n  x\n    y\n\n  z\nb: >\n  p\n  q\n\n  r\n", {"a": "x\n  y\n\nz\n", "b": "p q\nr\n"}),
    ("a: |-\n  x\n\nb: |+\n  t\n\nc: d", {"a": "x", "b": "t\n\n", "c": "d"}),
    ("a: yes\nb: 'yes'\nc: 0x1F\nd: 017\ne: 1_000\nf: 1.5\ng: ~\nh: 1e3", {"a": True, "b": "yes", "c": 31, "d": 15, "e": 1000, "f": 1.5, "g": None, "h": "1e3"}),
    ("image: host:5000/a/b:2 # tag\nurl: http://x:1/y#z", {"image": "host:5000/a/b:2", "url": "http://x:1/y#z"}),
    ("a: one\n  two\nb: \"q\\n\\u00e9 \\\n   r\"\r\n", {"a": "one two", "b": "q\né r"}),
    ("a: [1,\n  2]\nb: {}\nc: []", {"a": [1, 2], "b": {}, "c": []}), ("", None), ("# nothing\n", None), ("word", "word"),
]


@pytest.mark.parametrize("text,value", GOLDEN)
def test_documents(text, value):
    assert parse(text) == value


@pytest.mark.parametrize("text,why", [
    ("a: &x 1", "anchor"), ("a: *x", "alias"), ("a: !t 1", "tag"), ("? a\n: b", "explicit key"), ("<<: {a: 1}", "merge key"), ("a:\n\t- b", "tab"),
    (" a: 1\nb: 2", "no level"), ("a: 1\n b: 2", "inside a plain"), ("a: [1, 2", "no end"), ("a: \"x", "no end"), ("a: b: c", "plain text"), ("a: - b", "sequence")])
def test_what_is_not_read_is_an_error(text, why):
    with pytest.raises(YamlError, match=why):
        parse(text)


def test_against_a_full_implementation():
    yaml = pytest.importorskip("yaml")
    rng = random.Random(4)
    leaf = [1, -2, 0.5, None, True, "", "text", "two words", "a: b", "#x", "x #y", "line1\nline2", "line\n\n  ind\n", "- x", "'q'", '"d"', "é漢", "yes", "12",
            "~", "[x]", "%a", "@b", "*c", "&d", "!e", "long text " * 20, "tab\tx", "back\\slash", "http://h:80/p?q=1#f"]

    def value(depth=0):
        r = rng.random()
        if depth < 4 and r < 0.35:
            return {rng.choice(["a", "b c", "x-y", "k.1/z", "1"]) + str(i): value(depth + 1) for i in range(rng.randrange(4))}
        return [value(depth + 1) for _ in range(rng.randrange(4))] if depth < 4 and r < 0.6 else rng.choice(leaf)

    for style in (False, None, True):
        for width in (20, 1000):
            for _ in range(300):
                text = yaml.safe_dump(value(), default_flow_style=style, width=width, indent=rng.choice([2, 4]))
                assert parse(text) == yaml.safe_load(text), text


def _folder(spark, files):
    base = shared_dir(spark, "yaml-test")
    os.makedirs(base)
    for name, text in files.items():
        with open(f"{base}/{name}", "w", newline="") as f:
            f.write(text)
    return base


def test_catalog_of_yaml_files(spark):
    other = TORCH.replace("torch", "mpi").replace("numNodes: 1", "numNodes: \"4\"")
    base = _folder(spark, {
        "a.yaml": "%YAML 1.1\n---\n" + TORCH + "---\n" + other + "--- # empty\n\n---\nkind: [\nmetadata: broken\nspec: x\n",
        "b.yaml": TORCH.replace("numNodes: 1", "numNodes: 9"), "c.yaml": other.replace("name: node", "name: other").replace("mpi-", "x-"),
        "d.json": json.dumps(parse(TORCH.replace("torch-", "json-"))) + "\n", "e.yml": "not: read as yaml"})
    got, rejects = SC.load_catalog(spark, [base])
    assert sorted(tuple(r) for r in got.select("name", "framework", "num_nodes", "image").collect()) == [
        ("json-distributed", "torch", 1, "pytorch/pytorch:2.0.0"), ("mpi-distributed", "mpi", 4, "pympi/pympi:2.0.0"),
        ("torch-distributed", "torch", 1, "pytorch/pytorch:2.0.0")]
    lost = {(r["file_path"].rsplit("/", 1)[1], r["error"].split(":")[0]) for r in rejects.collect()}
    assert lost == {("a.yaml", "malformed YAML"), ("c.yaml", "no node job"), ("e.yml", "malformed document")}
    assert rejects.where(F.col("file_path").endswith("a.yaml")).count() == 1  # one document, one reject
    one, _ = SC.load_catalog(spark, [f"{base}/b.yaml", base], framework_label="trainer/framework")
    assert one.where("name = 'torch-distributed'").first()["num_nodes"] == 9


def test_a_large_file_is_cut_in_many_tasks(spark):
    n = 400
    base = _folder(spark, {"big.yaml": "".join("---\n" + TORCH.replace("torch-", f"rt{i}-") for i in range(n))})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        docs = read_documents(spark, base)
        rows = docs.select("doc", "error", F.spark_partition_id().alias("p")).collect()
        got, rejects = SC.load_catalog(spark, [base])
        assert got.count() == n and rejects.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len({r["p"] for r in rows}) > 10 and len(rows) == n and not any(r["error"] for r in rows)
    assert {json.loads(r["doc"])["metadata"]["name"] for r in rows} == {f"rt{i}-distributed" for i in range(n)}
