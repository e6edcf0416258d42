"""Search-space and algorithm read-back (HPO-9).

Stored settings are text (as in the experiment documents). A long table
(experiment, param, kind, min_text, max_text, distribution, choices_text) is
converted to typed columns with ``try_cast``; every problem becomes a row of
a rejects table instead of an exception, so a million stored experiments are
read back in one pass. Booleans are true for "1" and "true" in any case and
optional integers become integers (the reference misses both by mistake).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the algorithm names and distributions the read-back knows
ALGORITHMS = {"random": "RandomSearch", "grid": "GridSearch"}
DISTRIBUTIONS = ("uniform", "logUniform")
CATEGORICAL = "categorical"  # every other kind is a continuous parameter


def convert_value(text: Column, kind: str) -> Column:
    """Text setting to a typed value: bool (case-insensitive), int, double or string."""
    if kind == "bool":
        return F.when(text.isNotNull(), F.lower(F.trim(text)).isin("true", "1"))
    if kind == "int":
        return F.trim(text).try_cast("bigint")
    if kind == "double":
        return F.trim(text).try_cast("double")
    return text


def read_back_space(settings: DataFrame) -> DataFrame:
    """Typed search-space rows with ``error`` (NULL when valid). Choices come as an array (``choices``), or as text
    joined by commas (``choices_text``)."""
    lo, hi = convert_value(F.col("min_text"), "double"), convert_value(F.col("max_text"), "double")
    given = lambda c: F.coalesce(F.col(c) != "", F.lit(False))
    dist = F.col("distribution")
    if "choices" in settings.columns:
        choices = F.when(F.size("choices") > 0, F.col("choices"))
    else:
        choices = F.when(given("choices_text"), F.split(F.col("choices_text"), ","))
    listed = F.coalesce(F.col("kind") == CATEGORICAL, F.lit(False))
    err = (F.when(listed & choices.isNull(), F.lit("no choices"))
           .when(~listed & ~(given("min_text") & given("max_text") & given("distribution")), F.lit("bounds or distribution missing"))
           .when(~listed & (lo.isNull() | hi.isNull()), F.lit("bound is not a number"))
           .when(~listed & ~dist.isin(*DISTRIBUTIONS), F.lit("unknown distribution")))
    return settings.select(
        "experiment", "param", "kind",
        F.when(~listed, lo).alias("min"), F.when(~listed, hi).alias("max"),
        F.when(~listed, dist).alias("distribution"),
        F.when(listed, F.array_join(choices, "|")).alias("choices"),
        err.alias("error"))


def read_back_algorithm(algos: DataFrame, name_col: str = "algorithm") -> DataFrame:
    """Algorithm name (matched exactly) -> class name; ``random_state`` as an
    integer. An unknown or missing name and a state that is no integer are errors."""
    n, text = F.col(name_col), F.col("random_state")
    mapped = F.coalesce(*[F.when(n == k, F.lit(v)) for k, v in ALGORITHMS.items()])
    state = F.when(n == "random", convert_value(text, "int"))
    return algos.select(
        "experiment", mapped.alias("algorithm"), state.alias("random_state"),
        F.when(mapped.isNull(), F.concat(F.lit("unknown algorithm: "), F.coalesce(n, F.lit("none"))))
        .when((n == "random") & text.isNotNull() & state.isNull(), F.lit("random_state is not an integer")).alias("error"))


def settings_from_part(part: DataFrame) -> DataFrame:
    """Stored search-space settings derived from ``part``: one parameter per part,
    experiments by brand, with bad numbers, missing bounds and unknown names."""
    k, size = F.col("p_partkey"), F.col("p_size")
    kind = (F.when(k % 13 == 0, F.lit("float16")).when(size % 4 == 0, F.lit("double"))
            .when(size % 4 == 1, F.lit("int")).when(size % 4 == 2, F.lit("categorical")).otherwise(F.lit("discrete")))
    lo = F.when(k % 9 == 0, F.lit("abc")).when(k % 11 == 0, F.lit(None).cast("string")).otherwise(
        (F.col("p_retailprice") / 1000).cast("string"))
    hi = F.when(k % 19 == 0, (F.col("p_retailprice") / 1000).cast("string")).otherwise(
        (F.col("p_retailprice") / 100).cast("string"))
    dist = F.when(k % 17 == 0, F.lit("normal")).when(size % 3 == 0, F.lit("logUniform")).otherwise(F.lit("uniform"))
    choices = F.when(k % 7 == 0, F.lit(None).cast("string")).otherwise(
        F.concat_ws(",", F.lower(F.col("p_type")), F.col("p_brand"), size.cast("string")))
    return part.select(F.col("p_brand").alias("experiment"), F.concat(F.lit("param_"), k).alias("param"),
                       kind.alias("kind"), lo.alias("min_text"), hi.alias("max_text"), dist.alias("distribution"),
                       choices.alias("choices_text"))



def algorithm_settings(algorithm) -> list[tuple[str, str]]:
    """The forward direction: an algorithm as stored (name, value) text
    settings; ``random_state`` is written only when set."""
    from sparksweep.plans.sweep import GridSearch, RandomSearch
    if isinstance(algorithm, RandomSearch):
        return [] if algorithm.random_state is None else [("random_state", str(algorithm.random_state))]
    if isinstance(algorithm, GridSearch):
        return []
    raise ValueError(f"unknown algorithm {algorithm!r}")


def algorithm_name(algorithm) -> str:
    from sparksweep.plans.sweep import GridSearch, RandomSearch
    if isinstance(algorithm, RandomSearch):
        return "random"
    if isinstance(algorithm, GridSearch):
        return "grid"
    raise ValueError(f"unknown algorithm {algorithm!r}")
