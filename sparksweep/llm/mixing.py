"""Mixing sources to target weights by Poisson replication (built-in functions only).

A source whose target share of the mix is larger than its share of the corpus
is repeated, one whose share is smaller is thinned: its mean repetition rate is
target size / size. Each document draws its number of copies from a Poisson
distribution with that mean, by inverting the distribution at a number in
[0, 1) taken from a hash of the seed and the document's id: the draw is the same on
any cluster and after any lost task. The copies are dealt over the partitions
by a second hash and sorted by it within each, which is a random order of the whole mix.

Defined results: a null source is a source of its own; a document without id
draws by its text; rows with the same id draw the same count; a null text has
size 0; a source of size 0 has rate 1; sources that ``weights`` doesn't name
have weight 0; an empty table gives an empty mix. Clashing column names of
the input are replaced by the operator's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparksweep.llm.batch import drop_columns
from sparksweep.session import shared_dir

SEED = "mix-1"
ADDED = ("rate", "copy_no", "shuffle_key", "_key", "_source", "_cdf", "_copies")


def _poisson_cdf(rate: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... as an array, as far as a double below 1 can reach."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    first = F.struct((-rate).alias("logp"), F.exp(-rate).alias("c"), F.array(F.exp(-rate)).alias("all"))

    def step(acc, k):
        logp = acc["logp"] + F.ln(rate) - F.ln(k.cast("double"))
        c = acc["c"] + F.exp(logp)
        return F.struct(logp.alias("logp"), c.alias("c"), F.concat(acc["all"], F.array(c)).alias("all"))

    whole = F.aggregate(F.sequence(F.lit(1), last), first, step, lambda acc: acc["all"])
    return F.when(rate > 0, whole).otherwise(F.array(F.lit(1.0)))


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = 0.5, total: float = 1.0,
                 source: str = "source", text: str = "text") -> DataFrame:
    """One row per source: _source, size (characters), rate. Without explicit
    weights a source weighs size**alpha; the mix has ``total`` times the corpus'
    characters. The sizes are written to the shared folder first: the totals
    come from there, and the planner knows the table's size, so that it
    broadcasts it only if it is small."""
    spark = docs.sparkSession
    path = shared_dir(spark, "mix-sizes")
    docs.groupBy(F.col(source).cast("string").alias("_source")).agg(
        F.coalesce(F.sum(F.length(text)), F.lit(0)).cast("long").alias("size")).write.parquet(path)
    size = spark.read.parquet(path)
    if weights is None:
        weight = F.pow(F.col("size").cast("double"), F.lit(float(alpha)))
    elif weights:
        named = F.create_map(*[F.lit(x) for k, w in weights.items() for x in (k, float(w))])
        weight = F.coalesce(named[F.col("_source")], F.lit(0.0))
    else:
        weight = F.lit(0.0)
    size = size.withColumn("_weight", F.when(F.col("size") > 0, weight).otherwise(0.0))
    both = size.agg(F.sum("size").alias("all"), F.sum("_weight").alias("weights")).first()
    scale = float(total) * float(both["all"] or 0) / (both["weights"] or 1.0)
    rate = F.when(F.col("size") > 0, F.col("_weight") * scale / F.col("size")).otherwise(1.0)
    return size.select("_source", "size", F.round(rate, 9).alias("rate"))


def _unit(seed: str, key: Column) -> Column:
    """A number in [0, 1) of 52 bits."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), key)), 1, 13), 16, 10).cast("double") / float(1 << 52)


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = 0.5, total: float = 1.0,
                seed: str = SEED, source: str = "source", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The mix: the input's rows times their counts, with rate, copy_no (from 1)
    and shuffle_key, in the order of a global shuffle."""
    docs = drop_columns(docs, ADDED)
    rates = source_rates(docs, weights, alpha, total, source, text)
    rates = rates.select(F.col("_source").alias("_s"), "rate", _poisson_cdf(F.col("rate")).alias("_cdf"))
    key = F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(F.col(text), F.lit("")))))
    out = docs.join(rates, F.col(source).cast("string").eqNullSafe(F.col("_s"))).drop("_s")
    out = out.withColumn("_key", key).withColumn("_copies", F.size(F.filter("_cdf", lambda c: c <= _unit(seed, F.col("_key")))))
    out = out.drop("_cdf").where("_copies > 0").withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    out = out.withColumn("shuffle_key", F.md5(F.concat(F.lit(seed + ":order:"), F.col("_key"), F.lit(":"), F.col("copy_no").cast("string"))))
    return out.drop("_key", "_copies").repartition("shuffle_key").sortWithinPartitions("shuffle_key")
