"""Stopping rules on hand tables and against plain Python."""

import random
import statistics

from sparksweep.operators import early_stopping as E

SCHEMA = "trial string, metric string, ts long, value double"


def test_median_rule_against_plain_python(spark):
    rnd = random.Random(8)
    series = {f"t{i}": [rnd.randrange(-50, 50) for _ in range(rnd.randrange(1, 12))] for i in range(9)}
    rows = [(t, "loss", k, float(v)) for t, vs in series.items() for k, v in enumerate(vs)] + [("t0", "loss", 99, None), ("t1", "loss", 98, float("nan"))]
    means = E.running_means(spark.createDataFrame(rows, SCHEMA).repartition(5), ["ts"])
    plain = {t: [sum(vs[: k + 1]) / (k + 1) for k in range(len(vs))] for t, vs in series.items()}
    assert {(r["trial"], r["step"]): r["mean"] for r in means.collect()} == {(t, k + 1): m for t, ms in plain.items() for k, m in enumerate(ms)}
    for maximize in (True, False):
        want = {}
        for t, ms in plain.items():
            for k in range(1, len(ms)):
                others = [o[k] for n, o in plain.items() if n != t and len(o) > k]
                if others and (ms[k] < statistics.median(others) if maximize else ms[k] > statistics.median(others)):
                    want[t] = (k + 1, statistics.median(others))
                    break
        got = {r["trial"]: (r["step"], r["median"]) for r in E.median_stop(means, maximize, start_step=2).collect()}
        assert got == want and want


def test_rungs_promote_the_best_and_break_ties_by_name(spark):
    rows = [(t, "acc", s, v) for t, v in [("a", 1.0), ("b", 3.0), ("c", 3.0), ("d", 2.0), ("e", 0.0)] for s in range(1, 5 if t != "b" else 2)]
    got = {(r["rung"], r["trial"]): (r["rank"], r["of"], r["promoted"]) for r in E.asha_rungs(
        E.running_means(spark.createDataFrame(rows, SCHEMA), ["ts"]), 1, 2, 3).collect()}
    assert got == {(0, "b"): (0, 5, True), (0, "c"): (1, 5, True), (0, "d"): (2, 5, False), (0, "a"): (3, 5, False), (0, "e"): (4, 5, False),
                   (1, "c"): (0, 1, False)}  # b reported only one step; one trial is too few for a further promotion
    assert E.asha_rungs(E.running_means(spark.createDataFrame([], SCHEMA), ["ts"])).count() == 0
