"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Every query runs to completion into Spark's ``noop`` sink (nothing is
collected to the driver); all queries run once as a warm-up and then in turn
$BENCH_REPEAT (default 2) times, of which the best counts. ``python bench.py
--duckdb`` times the DuckDB twins of the same queries on as many threads.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparksweep.plans import registry  # noqa: E402
from sparksweep.plans import sweep as S  # noqa: E402
from sparksweep.plans.views import table  # noqa: E402
from sparksweep.session import local_session, remove_scratch  # noqa: E402

HEADLINE = [
    "hpo7_sweep_random",            # flagship: 64 trials, one shared scan
    "top1_best_trial",
    "hpo7_sweep_sufficient_stats",
    "hpo8_sweep_by_function",
    "agg1_metric_observations",
    "jon2_job_steps",
    "agg3_job_status",
    "dat2_split_slice",
    "jon6_requirement_merge",
    "top3_step_order",
    "prj2_runtime_documents",
    "jon8_dependency_skip",
]


def sweep_n(n):
    def q(spark, sf_dir):
        return S.sweep_price(spark, table(spark, sf_dir, "lineitem"), n, S.RandomSearch(S.PRICE_SEED), 4)
    return q


def suff_n(n):
    def q(spark, sf_dir):
        return S.sweep_price_sufficient(spark, table(spark, sf_dir, "lineitem"), n, S.RandomSearch(S.PRICE_SEED), 4)
    return q


EXTRA = {"sweep_16": sweep_n(16), "sweep_256": sweep_n(256), "sweep_1024": sweep_n(1024), "suffstats_256": suff_n(256)}


def run(spark, fn, sf_dir) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def duckdb_main() -> None:
    """The twins' times: a single-node engine on the same machine and number of cores."""
    import duckdb
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    con = duckdb.connect(config={"threads": os.environ.get("BENCH_CPUS", "8")})
    for name in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM read_parquet('{sf_dir}/{name}')")
    registry.load_all()
    times = {}
    for name in HEADLINE:
        for i in range(3):
            t0 = time.perf_counter()
            con.execute(f"CREATE OR REPLACE TEMP TABLE got AS {registry.ORACLE[name]}")
            if i:
                times[name] = round(min(times.get(name, 1e9), time.perf_counter() - t0), 3)
    print(json.dumps({"metric": "duckdb_twins", "unit": "sec", "queries": times}))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = local_session(cpus=cpus, shuffle_partitions=max(int(cpus) if cpus.isdigit() else 8, 4) * 2,
                          app="sparksweep-bench")
    registry.load_all()
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))
    todo = [(n, registry.QUERIES[n]) for n in HEADLINE] + list(EXTRA.items())
    times = {}
    for _ in range(1 + repeat):  # the first round over all queries warms up and doesn't count
        for name, fn in todo:
            times.setdefault(name, []).append(run(spark, fn, sf_dir))
    times = {name: round(min(t[1:]), 3) for name, t in times.items()}
    remove_scratch(spark)
    spark.stop()
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    duckdb_main() if "--duckdb" in sys.argv else main()
