"""Dependency skipping (JON-8): which jobs run, which are skipped, which wait for each other.

A job runs only when every dependency succeeded. So a job is skipped if any job above it failed, or
lies on a cycle, since jobs of a cycle never run. Jobs on a cycle, or between two
cycles (what is left when jobs without dependencies and jobs without dependants are taken away again and again),
have status ``Cycle``.

1. Chains: a job with one dependency follows it up to the nearest job with none or several, by
   pointer jumping: log2(depth) rounds.
2. The graph of the jobs with several dependencies is contracted. Each round takes out an independent set of
   the jobs with few edges (dependencies times dependants at most ``FILL``) and links their
   dependencies to their dependants, so that the rounds grow with the logarithm of the number of jobs and not with the
   depth. What a job knows (a failure or a cycle above, a cycle below) goes to its neighbours when it is
   taken out; an edge from a job to itself shows a cycle.
3. A rest of at most ``LOCAL`` edges is solved in one task. If no job with few edges is left before, the rest, in which every
   job has many edges and paths are short, is solved by rounds over the edges.
4. Backwards through the rounds, each job reads its answer from the neighbours it had when it was taken out.

All rounds are joins on job keys, written to the shared folder.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparksweep.session import shared_dir

FILL = 12
LOCAL = 100_000


def _settled(df: DataFrame, name: str) -> DataFrame:
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def dependency_status(deps: DataFrame, job: str = "job_no", depends_on: str = "depends_on", ok: str = "ok",
                      local: int = LOCAL) -> DataFrame:
    """JON-8: (job, status) with status Complete, Failed, Skipped or Cycle. ``deps`` has one row per (job,
    dependency) edge (NULL dependency = none) and the job's own outcome ``ok``. A dependency that is no job of the table counts as
    succeeded; a job that depends on itself is a cycle."""
    edges = deps.select(F.col(job).alias("j"), F.col(depends_on).alias("d")).filter(F.col("d").isNotNull()).distinct()
    degree = edges.groupBy("j").agg(F.count(F.lit(1)).alias("n"), F.min("d").alias("d"))
    jobs = deps.groupBy(F.col(job).alias("j")).agg(F.bool_and(F.col(ok)).alias("ok"))
    jobs = _settled(jobs.join(degree, "j", "left"), "deps-jobs")
    several = jobs.filter("n > 1").select(F.col("j").alias("d"), F.lit(True).alias("many"))
    fine = jobs.select(F.col("j").alias("d"), F.col("ok").alias("d_ok"))
    # up: the next job to look at; stop: the job with several dependencies that was reached
    single = jobs.filter("n = 1").select("j", "d").join(fine, "d", "left").join(several, "d", "left").select(
        "j", F.when(F.col("many").isNull() & F.col("d_ok").isNotNull(), F.col("d")).alias("up"),
        F.when(F.col("many"), F.col("d")).alias("stop"), F.coalesce(~F.col("d_ok"), F.lit(False)).alias("skipped"))
    status = F.when(F.col("skipped"), F.lit("Skipped")).when(F.col("ok"), F.lit("Complete")).otherwise(F.lit("Failed"))
    chains = _chains(jobs.filter("n is null").select("j"), single)
    if chains is None:
        return _whole(edges, jobs, status, job, local)
    many = jobs.filter("n > 1").select("j")
    if not many.limit(1).count():  # nothing but chains
        return jobs.select("j", "ok").join(chains.select("j", "skipped"), "j").select(F.col("j").alias(job), status.alias("status"))
    state = chains.select(F.col("j").alias("d"), "stop", F.col("skipped").alias("above"))
    links = edges.join(many, "j", "left_semi").join(fine, "d", "left").join(several, "d", "left").join(state, "d", "left").select(
        "j", F.when(F.col("many"), F.col("d")).otherwise(F.col("stop")).alias("p"),
        (~F.coalesce("d_ok", F.lit(True)) | F.coalesce("above", F.lit(False))).alias("bad"))
    links = _settled(links, "deps-links")
    hit = links.filter("bad").select("j").distinct().withColumn("hit", F.lit(True))
    start = jobs.filter("n > 1").join(hit, "j", "left").select(F.col("j").alias("v"), (~F.col("ok")).alias("bad"), F.coalesce("hit", F.lit(False)).alias("hit"))
    solved = solve(links.filter("p is not null").select("p", F.col("j").alias("s")).distinct(), start, local)
    if solved.filter("after").limit(1).count():
        return _whole(edges, jobs, status, job, local)
    top = solved.select(F.col("v").alias("stop"), (F.col("bad") | F.col("hit")).alias("stop_bad"))
    rows = solved.select(F.col("v").alias("j"), F.col("hit").alias("skipped")).unionByName(chains.join(top, "stop", "left").select(
        "j", (F.col("skipped") | F.coalesce("stop_bad", F.lit(False))).alias("skipped")))
    return jobs.select("j", "ok").join(rows, "j").select(F.col("j").alias(job), status.alias("status"))


def _whole(edges: DataFrame, jobs: DataFrame, status: Column, job: str, local: int) -> DataFrame:
    """The status of a graph with cycles: these may run through jobs of one dependency, so all jobs are solved together."""
    inner = edges.join(jobs.select(F.col("j").alias("d")), "d").select(F.col("d").alias("p"), F.col("j").alias("s"))
    solved = solve(inner, jobs.select(F.col("j").alias("v"), (~F.col("ok")).alias("bad"), F.lit(False).alias("hit")), local)
    rows = solved.select("v", (~F.col("bad")).alias("ok"), (F.col("hit") | F.col("after")).alias("skipped"), (F.col("after") & F.col("before")).alias("cycle"))
    return rows.select(F.col("v").alias(job), F.when(F.col("cycle"), F.lit("Cycle")).otherwise(status).alias("status"))


def _chains(roots: DataFrame, single: DataFrame) -> DataFrame | None:
    """(j, stop, skipped) of the jobs with at most one dependency; None if some never arrive, because they
    lie on or below a cycle of such jobs. After round k a job knows whether one of
    its 2^k nearest ancestors failed. Rows that have arrived leave the loop; only the open ones are joined and written again."""
    done = [roots.select("j", F.lit(None).cast(dict(single.dtypes)["stop"]).alias("stop"), F.lit(False).alias("skipped"))]
    rows = _settled(single, "deps-chains")
    left = rows.filter("up is not null").count()
    done.append(rows.filter("up is null").select("j", "stop", "skipped"))
    now = rows.filter("up is not null")
    while left:
        arrived = reduce(DataFrame.unionByName, done)
        above = arrived.withColumn("up", F.lit(None).cast(dict(now.dtypes)["up"])).unionByName(now).select(
            F.col("j").alias("up"), F.col("up").alias("up2"), F.col("stop").alias("stop2"), F.col("skipped").alias("more"))
        rows = _settled(now.drop("stop").join(above, "up").select(
            "j", F.col("up2").alias("up"), F.col("stop2").alias("stop"), (F.col("skipped") | F.col("more")).alias("skipped")), "deps-chains")
        done.append(rows.filter("up is null").select("j", "stop", "skipped"))
        now = rows.filter("up is not null")
        before, left = left, now.count()
        if left == before:
            return None
    return reduce(DataFrame.unionByName, done)


# ------------------------------------------------------------ the general graph

def solve(edges: DataFrame, nodes: DataFrame, local: int = LOCAL) -> DataFrame:
    """For nodes (v, bad, hit) and edges (p, s), s depending on p: (v, bad, hit, after, before). hit: a bad node or a hit
    one lies above; after: a cycle lies above or here; before: a cycle lies below or here."""
    loops = edges.filter("p = s").select(F.col("p").alias("v")).distinct().withColumn("loop", F.lit(True))
    nodes = nodes.join(loops, "v", "left").select("v", "bad", "hit", F.coalesce("loop", F.lit(False)).alias("after"), F.coalesce("loop", F.lit(False)).alias("before"))
    edges, nodes = _settled(edges.filter("p != s"), "deps-edges"), _settled(nodes, "deps-flags")
    taken = []
    left = edges.count()
    while left > local:
        out, edges2, nodes2 = _contract(edges, nodes, len(taken))
        if out is None:
            break
        taken.append(out)
        edges, nodes = edges2, nodes2
        left = edges.count()
    done = _settled(_local(edges, nodes) if left <= local else _by_rounds(edges, nodes), "deps-core")
    for gone, ins, outs in reversed(taken):
        val = done.select(F.col("v").alias("u"), (F.col("bad") | F.col("hit")).alias("u_bad"), F.col("after").alias("u_after"), F.col("before").alias("u_before"))
        up = ins.join(val, ins.p == val.u).groupBy("v").agg(F.bool_or("u_bad").alias("x_hit"), F.bool_or("u_after").alias("x_after"))
        down = outs.join(val, outs.s == val.u).groupBy("v").agg(F.bool_or("u_before").alias("x_before"))
        no = F.lit(False)
        back = gone.join(up, "v", "left").join(down, "v", "left").select(
            "v", "bad", (F.col("hit") | F.coalesce("x_hit", no)).alias("hit"), (F.col("after") | F.coalesce("x_after", no)).alias("after"),
            (F.col("before") | F.coalesce("x_before", no)).alias("before"))
        done = _settled(done.unionByName(back), "deps-back")
    return done


def _contract(edges: DataFrame, nodes: DataFrame, number: int):
    """One round: ((nodes, edges in, edges out) taken out, edges left, nodes left); the first is None if no node has few edges."""
    ends = edges.select(F.col("p").alias("v"), F.lit(0).alias("i"), F.lit(1).alias("o")).unionAll(
        edges.select(F.col("s").alias("v"), F.lit(1).alias("i"), F.lit(0).alias("o")))
    few = ends.groupBy("v").agg(F.sum("i").alias("i"), F.sum("o").alias("o")).filter(F.col("i") * F.col("o") <= FILL).select(
        "v", F.xxhash64("v", F.lit(number)).alias("rank"))
    few = _settled(few, "deps-few")
    # of two neighbours with few edges the one of higher rank stays in the choice
    a, b = few.select(F.col("v").alias("p"), F.col("rank").alias("rp")), few.select(F.col("v").alias("s"), F.col("rank").alias("rs"))
    lower = edges.join(a, "p").join(b, "s").select(F.when(F.struct("rp", "p") < F.struct("rs", "s"), F.col("p")).otherwise(F.col("s")).alias("v"))
    free = nodes.join(ends.select("v").distinct(), "v", "left_anti").select("v")  # without any edge
    picked = few.select("v").join(lower.distinct(), "v", "left_anti").unionAll(free)
    gone = _settled(nodes.join(picked, "v"), "deps-gone")
    if not gone.limit(1).count():
        return None, edges, nodes
    mark = gone.select("v", F.lit(True).alias("g"))
    tagged = _settled(edges.join(mark.withColumnsRenamed({"v": "p", "g": "gp"}), "p", "left").join(
        mark.withColumnsRenamed({"v": "s", "g": "gs"}), "s", "left"), "deps-tagged")
    ins = tagged.filter("gs").select("p", F.col("s").alias("v"))
    outs = tagged.filter("gp").select(F.col("p").alias("v"), "s")
    through = ins.join(outs, "v").select("p", "s")
    loops = through.filter("p = s").select(F.col("p").alias("v"), F.lit(False).alias("hit"), F.lit(True).alias("after"), F.lit(True).alias("before"))
    told = (outs.join(gone, "v").select(F.col("s").alias("v"), (F.col("bad") | F.col("hit")).alias("hit"), "after", F.lit(False).alias("before"))
            .unionByName(ins.join(gone, "v").select(F.col("p").alias("v"), F.lit(False).alias("hit"), F.lit(False).alias("after"), "before"))
            .unionByName(loops).filter("hit or after or before"))
    told = told.groupBy("v").agg(*[F.bool_or(c).alias(f"t_{c}") for c in ("hit", "after", "before")])
    kept = nodes.join(gone.select("v"), "v", "left_anti").join(told, "v", "left")
    kept = kept.select("v", "bad", *[(F.col(c) | F.coalesce(f"t_{c}", F.lit(False))).alias(c) for c in ("hit", "after", "before")])
    rest = tagged.filter("gp is null and gs is null").select("p", "s").unionAll(through.filter("p != s")).distinct()
    return (gone, ins, outs), _settled(rest, "deps-edges"), _settled(kept, "deps-flags")


def _local(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """The answer for a graph whose size is bounded by ``LOCAL`` edges, in one task; nodes without edges don't go there."""
    ends = edges.select(F.col("p").alias("v")).unionAll(edges.select(F.col("s").alias("v"))).distinct()
    held = nodes.join(ends, "v", "left_semi")
    kind = dict(nodes.dtypes)["v"]
    flags = ["bad", "hit", "after", "before"]
    no = F.lit(None).cast("boolean")
    rows = edges.select("p", "s", *[no.alias(c) for c in flags]).unionByName(held.select(F.col("v").alias("p"), F.lit(None).cast(kind).alias("s"), *flags))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        own = part[part["bad"].notna()]
        number = {v: i for i, v in enumerate(own["p"])}
        e = part[part["bad"].isna()]
        pairs = list(zip(e["p"].map(number).astype(int), e["s"].map(number).astype(int), strict=True))
        down, up = [[] for _ in number], [[] for _ in number]
        for p, s in pairs:
            down[p].append(s)
            up[s].append(p)

        def trimmed(a: list, b: list) -> set:
            """Nodes that are left when those without a neighbour in ``a`` are taken away again and again."""
            count = [len(x) for x in a]
            free = [i for i, n in enumerate(count) if not n]
            gone = set(free)
            while free:
                for j in b[free.pop()]:
                    count[j] -= 1
                    if not count[j]:
                        gone.add(j)
                        free.append(j)
            return set(range(len(a))) - gone

        def reach(start: list, along: list) -> set:
            """Nodes reached from ``start`` by one step or more."""
            seen, todo = set(), list(start)
            while todo:
                for j in along[todo.pop()]:
                    if j not in seen:
                        seen.add(j)
                        todo.append(j)
            return seen

        after = trimmed(up, down) | {i for i, x in enumerate(own["after"]) if x}  # a cycle lies above or here
        before = trimmed(down, up) | {i for i, x in enumerate(own["before"]) if x}
        after |= reach(list(after), down)
        before |= reach(list(before), up)
        hit = {i for i, x in enumerate(own["hit"]) if x}
        hit |= reach([i for i, x in enumerate(own["bad"]) if x] + list(hit), down)
        n = range(len(number))
        return pd.DataFrame({"v": own["p"].to_numpy(), "bad": own["bad"].to_numpy(), "hit": [i in hit for i in n],
                             "after": [i in after for i in n], "before": [i in before for i in n]})

    solved = rows.groupBy(F.lit(0).alias("one")).applyInPandas(run, f"v {kind}, bad boolean, hit boolean, after boolean, before boolean")
    return solved.unionByName(nodes.join(ends, "v", "left_anti"))


def _by_rounds(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """The answer for a graph in which every node has many edges: cycles by taking away nodes without edges in
    or out, then flags along the edges until nothing is new."""
    rest, left, before = edges, edges.count(), -1
    while left and left != before:
        rest = rest.join(rest.select(F.col("s").alias("p")).distinct(), "p", "left_semi").join(
            rest.select(F.col("p").alias("s")).distinct(), "s", "left_semi").select("p", "s")
        rest = _settled(rest, "deps-trim")
        before, left = left, rest.count()
    core = rest.select(F.col("p").alias("v")).distinct().withColumn("core", F.lit(True))
    now = _settled(nodes.join(core, "v", "left").select(
        "v", "bad", "hit", *[(F.col(c) | F.coalesce("core", F.lit(False))).alias(c) for c in ("after", "before")]), "deps-flags")
    changed = now
    while True:
        f, b = changed.select(F.col("v").alias("p"), (F.col("bad") | F.col("hit")).alias("hit"), "after"), changed.select(F.col("v").alias("s"), "before")
        told = (edges.join(f.filter("hit or after"), "p").select(F.col("s").alias("v"), "hit", "after", F.lit(False).alias("before"))
                .unionByName(edges.join(b.filter("before"), "s").select(F.col("p").alias("v"), F.lit(False).alias("hit"), F.lit(False).alias("after"), "before")))
        told = told.groupBy("v").agg(*[F.bool_or(c).alias(f"t_{c}") for c in ("hit", "after", "before")])
        flags = ("hit", "after", "before")
        new = _settled(now.join(told, "v", "left").select(
            "v", "bad", *[(F.col(c) | F.coalesce(f"t_{c}", F.lit(False))).alias(c) for c in flags],
            reduce(lambda x, y: x | y, [~F.col(c) & F.coalesce(f"t_{c}", F.lit(False)) for c in flags]).alias("new")), "deps-flags")
        changed, now = new.filter("new").drop("new"), new.drop("new")
        if not changed.limit(1).count():
            return now
