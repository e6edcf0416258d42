"""The registered queries against their DuckDB twins, and the subpackage's separateness."""

import re
from pathlib import Path

import pytest

import corpus_pipeline
from sparksweep.llm import queries
from tests.oracle_check import digest, duck

TWINS = dict(queries.ORACLE)
if corpus_pipeline.ORACLE_SQL is not None:
    TWINS["pipeline"] = corpus_pipeline.ORACLE_SQL


@pytest.mark.parametrize("name", sorted(TWINS))
def test_twin(spark, sf_dir, name):
    fn = corpus_pipeline.run if name == "pipeline" else queries.QUERIES[name]
    df = fn(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    twin = duck(sf_dir).sql(TWINS[name])
    rows = twin.fetchall()
    assert sorted(df.columns) == sorted(twin.columns) and len(got) == len(rows) > 0
    assert digest(df.columns, got)[0] == digest(twin.columns, rows)[0]


def test_all_are_registered():
    assert [n.split("_")[0] for n in sorted(queries.QUERIES, key=lambda n: int(re.match(r"op(\d+)_", n)[1]))] == [
        f"op{i}" for i in range(1, 14)]


def test_nothing_else_imports_the_subpackage():
    top = Path(corpus_pipeline.__file__).parent
    for p in [*top.glob("*.py"), *top.glob("sparksweep/**/*.py"), *top.glob("tests/*.py")]:
        if p.name not in ("__spark_entry__.py", "corpus_pipeline.py") and "llm" not in p.relative_to(top).parts:
            assert not re.search(r"sparksweep\.llm|from sparksweep import llm|corpus_pipeline", p.read_text()), p
