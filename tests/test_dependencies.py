"""Dependency graphs (JON-8): cycles, contraction and rounds against a plain walk."""

import random

import pytest

from sparksweep.operators import dependencies as DP

SCHEMA = "job_no long, depends_on long, ok boolean"


def plain(deps, ok):
    """Status by the definition, with reachability sets."""
    below = {j: [k for k, ds in deps.items() if j in ds] for j in deps}

    def reach(j, along):
        seen, todo = set(), [j]
        while todo:
            for k in along.get(todo.pop(), ()):
                if k in deps and k not in seen:
                    seen.add(k)
                    todo.append(k)
        return seen

    up, down = {j: reach(j, deps) for j in deps}, {j: reach(j, below) for j in deps}
    loop = {j for j in deps if j in up[j]}
    out = {}
    for j in deps:
        after, before = bool(loop & (up[j] | {j})), bool(loop & (down[j] | {j}))
        skipped = after or any(not ok[k] for k in up[j])
        out[j] = "Cycle" if after and before else "Skipped" if skipped else "Complete" if ok[j] else "Failed"
    return out


def status(spark, deps, ok, **kw):
    rows = [(j, d, ok[j]) for j, ds in deps.items() for d in (ds or [None])]
    df = spark.createDataFrame(rows, SCHEMA)
    return {r["job_no"]: r["status"] for r in DP.dependency_status(df, **kw).collect()}


@pytest.mark.parametrize("deps", [
    {1: [2], 2: [1]}, {1: [1], 2: [1]}, {1: [2, 3], 2: [1], 3: []}, {1: [99], 2: [1, 99]},
    {1: [2], 2: [1], 3: [2], 4: [3, 5], 5: [4], 6: [5], 7: [], 1000: [7, 4], 1001: [1002], 1002: [1003], 1003: [1001], 1004: [1003, 7]}])
def test_cycles_are_rows(spark, deps):
    ok = {j: True for j in deps}
    assert status(spark, deps, ok) == plain(deps, ok)


@pytest.mark.parametrize("seed,local", [(1, DP.LOCAL), (3, 25)])
def test_random_graphs_with_cycles(spark, seed, local):
    rnd = random.Random(seed)
    n = 60
    deps = {j: sorted({rnd.randrange(n) if rnd.random() < 0.06 else rnd.randrange(max(1, j)) for _ in range(rnd.choice([0, 1, 1, 2, 3]))} - {j}) for j in range(n)}
    ok = {j: rnd.random() > 0.06 for j in deps}
    assert status(spark, deps, ok, local=local) == plain(deps, ok)


def test_dense_rest_is_solved_by_rounds(spark, monkeypatch):
    monkeypatch.setattr(DP, "FILL", 1)
    rnd = random.Random(6)
    deps = {j: sorted(rnd.sample(range(j), min(j, 4))) for j in range(40)} | {40: [41, 3, 4], 41: [40, 5, 6], 42: [41, 40, 7]}
    ok = {j: j not in (20, 21) for j in deps}
    assert status(spark, deps, ok, local=0) == plain(deps, ok)


def ladder(n):
    """Two rungs a level, each depending on both of the level before: depth n, all with several dependencies."""
    deps = {0: [], 1: []}
    for i in range(1, n):
        deps[2 * i], deps[2 * i + 1] = [2 * i - 2, 2 * i - 1], [2 * i - 2, 2 * i - 1]
    return deps


def test_a_ladder_ends_in_tens_of_rounds(spark, monkeypatch):
    rounds = []
    real = DP._contract
    monkeypatch.setattr(DP, "_contract", lambda *a: rounds.append(1) or real(*a))
    deps = ladder(5000)
    ok = {j: j != 4000 for j in deps}
    got = status(spark, deps, ok)
    assert not rounds  # 10,000 jobs are solved in one task
    want = {j: "Failed" if j == 4000 else "Skipped" if j > 4001 else "Complete" for j in deps}
    assert got == want
    deps = ladder(150)
    got = status(spark, deps, {j: j != 100 for j in deps}, local=150)
    assert got == {j: "Failed" if j == 100 else "Skipped" if j > 101 else "Complete" for j in deps}
    assert 1 <= len(rounds) <= 20  # depth 150 in a few rounds, each taking out a part of all jobs
