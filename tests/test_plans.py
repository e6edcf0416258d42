"""Plans: no exchange between cached tables, group limits, and no jobs at plan time."""

import contextlib

from pyspark.sql import functions as F

from sparksweep.operators import datasets as D
from sparksweep.operators.ordinal import with_row_index
from sparksweep.plans import q_jobs, sweep


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def jobs_run(spark, name):
    """A list that gets the number of jobs run inside."""
    found = []
    spark.sparkContext.setJobGroup(name, name)
    try:
        yield found
    finally:
        found.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(name)))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_cached_tables_join_without_exchange(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = D.cached_table(spark.range(1000).selectExpr("id as k", "id % 7 as x"), D.CacheSource("cache://plans/a", 3), key="k", buckets=8)
        b = D.cached_table(spark.range(3000).selectExpr("id % 1000 as k2", "id as y"), D.CacheSource("cache://plans/b", 3), key="k2", buckets=8)
        joined = a.join(b, a.k == b.k2).groupBy("k").agg(F.sum("y").alias("y"))
        plan = plan_of(joined)
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert joined.count() == 1000 and joined.agg(F.sum("y")).first()[0] == sum(range(3000))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for t in "ab":
            D.drop_cached(spark, D.CacheSource(f"cache://plans/{t}", 3))


def test_buckets_follow_the_size(spark):
    source = D.CacheSource("cache://plans/c", 3)
    df = spark.range(1 << 20)  # 8 MB by the estimate
    assert D.buckets_for(df, source) == 4 and D.buckets_for(df, source, bucket_bytes=1 << 20) == 8
    again = D.cached_table(df.limit(10), source)
    assert again.count() == 10
    assert D.cached_table(df.limit(20), source).count() == 20  # replaced
    D.drop_cached(spark, source)


def test_trial_cap_has_a_group_limit(spark, sf_dir):
    assert "WindowGroupLimit" in plan_of(q_jobs.top2_trial_cap(spark, sf_dir))


def test_the_index_runs_its_input_once(spark):
    grouped = spark.range(1000).groupBy((F.col("id") % 50).alias("g")).agg(F.sum("id").alias("s"))
    with jobs_run(spark, "index") as jobs:
        x = with_row_index(grouped, ["g"], num_partitions=4)
    # the input's shuffle stage, range bounds, write, counts of the written files, their schemas; adaptive execution counts stages as jobs
    assert jobs[0] <= 8
    assert sorted((r["g"], r["row_idx"]) for r in x.collect()) == [(i, i) for i in range(50)]
    with jobs_run(spark, "spread") as jobs:
        sweep.spread(grouped, 16)
    assert jobs[0] == 0


def test_an_empty_index(spark):
    assert with_row_index(spark.range(0), ["id"]).count() == 0
