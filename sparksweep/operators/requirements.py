"""Requirement lists (WIN-2, SET-1, JON-6, AGG-8, JOB-1).

A requirement list is a long table (job, pos, requirement). Everything is
keyed by (job, canonical name): last-wins dedup is one ``max_by`` per key,
the override merge is an anti join on that key, so no list is ever gathered
into one row or one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparksweep.session import shared_dir

# fixed value: the leading distribution name of a requirement string
NAME_RE = r"^\s*([A-Za-z0-9][A-Za-z0-9._-]*)"
REST_RE = r"^\s*[A-Za-z0-9][A-Za-z0-9._-]*(.*)$"


def raw_name(req: Column) -> Column:
    """The name as written; NULL when the text is NULL, blank or unparsable."""
    n = F.regexp_extract(req, NAME_RE, 1)
    return F.when(req.isNotNull() & (n != ""), n)


def canonical(name: Column) -> Column:
    """Runs of ``-``, ``_`` and ``.`` become ``-``; lower case."""
    return F.lower(F.regexp_replace(name, r"[-_.]+", "-"))


def with_names(reqs: DataFrame, col: str = "requirement") -> DataFrame:
    r = F.col(col)
    return reqs.withColumn("raw_name", raw_name(r)).withColumn("name", canonical(F.col("raw_name")))


def reject_reason(req: Column) -> Column:
    return (F.when(req.isNull(), F.lit("null requirement"))
            .when(req.rlike(r"^\s*$"), F.lit("empty requirement"))
            .when(F.regexp_extract(req, NAME_RE, 1) == "", F.lit("unparsable requirement")))


def last_wins(reqs: DataFrame, job: str = "job") -> DataFrame:
    """WIN-2: per (job, canonical name) the last occurrence, at its own position."""
    x = with_names(reqs).filter(F.col("name").isNotNull())
    return x.groupBy(job, "name").agg(F.max("pos").alias("pos"),
                                      F.max_by("requirement", "pos").alias("requirement"))


def merge_rejects(runtime_reqs: DataFrame, job_reqs: DataFrame, job: str = "job") -> DataFrame:
    """What makes the reference refuse a merge, as rows (job, section, pos,
    requirement, reason): text without a name in either list, and every
    occurrence but the first of a name that a job lists twice."""
    return reject_sections(runtime_reqs.select(job, F.lit(0).alias("section"), "pos", "requirement").unionByName(
        job_reqs.select(job, F.lit(1).alias("section"), "pos", "requirement")), job)


def reject_sections(reqs: DataFrame, job: str = "job") -> DataFrame:
    """``merge_rejects`` for both lists in one table, marked by ``section`` (0 runtime, 1 job). The rows with their
    names are written once, so that what they come from is computed once (a filter before would compute it again)."""
    path = shared_dir(reqs.sparkSession, "rejects")
    with_names(reqs.select(job, "section", "pos", "requirement")).drop("raw_name").write.parquet(path)
    rows = reqs.sparkSession.read.parquet(path)
    bad = rows.where("name is null").withColumn("reason", reject_reason(F.col("requirement"))).drop("name")
    named = rows.where("section = 1 and name is not null")
    first = named.groupBy(job, "name").agg(F.min("pos").alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    twice = named.join(first, [job, "name"]).filter(F.col("pos") > F.col("_first")).select(
        job, "section", "pos", "requirement", F.lit("listed twice").alias("reason"))
    return bad.unionByName(twice)


def ordered_distinct(df: DataFrame, keys: list[str], value: str, pos: str = "pos") -> DataFrame:
    """SET-1: distinct values, each at its first position."""
    return df.groupBy(*keys, value).agg(F.min(pos).alias(pos))


def ordered_distinct_array(values: Column) -> Column:
    """SET-1 on an array column: distinct values in first-seen order."""
    return F.array_distinct(values)


def duplicate_names(reqs: DataFrame, job: str = "job") -> DataFrame:
    """AGG-8: every (job, canonical name) listed more than once; the reference
    raises on the first, we report them all."""
    x = with_names(reqs).filter(F.col("name").isNotNull())
    return x.groupBy(job, "name").agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)


def merge(runtime_reqs: DataFrame, job_reqs: DataFrame, job: str = "job") -> DataFrame:
    """JON-6: a job's list overrides the runtime's on canonical name.

    Runtime-only names first (last duplicate wins, at its position), then the
    job's rows verbatim; a job with no job list keeps the runtime list as it is
    (duplicates included). Output: job, section (0 runtime, 1 job), pos,
    requirement. A runtime row without a readable name can't be overridden: it
    stays, at its position, and is listed by ``merge_rejects``.
    """
    side = lambda df, n: df.select(job, F.lit(n).alias("section"), "pos", "requirement")
    return merge_sections(side(runtime_reqs, 0).unionByName(side(job_reqs, 1)), job)


def merge_sections(reqs: DataFrame, job: str = "job") -> DataFrame:
    """JON-6 for both lists in one table, marked by ``section`` (0 runtime, 1 job). The rows with their names are written
    once, so that what they come from is computed once; the merge reads them by section."""
    path = shared_dir(reqs.sparkSession, "requirements")
    with_names(reqs.select(job, "section", "pos", "requirement")).write.partitionBy("section").parquet(path)
    rows = reqs.sparkSession.read.schema(f"{job} {dict(reqs.dtypes)[job]}, pos {dict(reqs.dtypes)['pos']}, requirement string, name string, section int").parquet(path)
    has_list = rows.where("section = 1").select(job).distinct().withColumn("_has", F.lit(True))
    named = rows.where("name is not null").groupBy(job, "name").agg(
        F.max("section").alias("_top"), F.max(F.when(F.col("section") == 0, F.col("pos"))).alias("pos"),
        F.max_by(F.when(F.col("section") == 0, F.col("requirement")), F.when(F.col("section") == 0, F.col("pos"))).alias("requirement"))
    kept = named.where("_top = 0").join(has_list, job).select(job, "pos", "requirement")
    flagged = rows.where("section = 0").join(has_list, job, "left")
    as_is = flagged.where("_has is null or name is null").select(job, "pos", "requirement")
    runtime_part = kept.unionByName(as_is).withColumn("section", F.lit(0))
    job_part = rows.where("section = 1").select(job, "pos", "requirement").withColumn("section", F.lit(1))
    return runtime_part.unionByName(job_part).select(job, "section", "pos", "requirement")


def inventory(reqs: DataFrame, job: str = "job"):
    """JOB-1: per canonical name the rows, jobs and distinct specifiers, plus
    a rejects table (null, blank or unparsable text)."""
    r = F.col("requirement")
    x = with_names(reqs)
    good = x.filter(F.col("name").isNotNull()).withColumn("spec", F.trim(F.regexp_extract(r, REST_RE, 1)))
    inv = good.groupBy("name").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(job).alias("jobs"),
                                   F.count_distinct("spec").alias("specifiers"))
    rejects = x.filter(F.col("name").isNull()).withColumn("reason", reject_reason(r))
    return inv, rejects
