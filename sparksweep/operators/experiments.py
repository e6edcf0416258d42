"""Experiment documents (JON-3, HPO-9): JSON text to flat rows and typed settings.

One pass with ``from_json`` and higher-order functions, no shuffle. A document
that misses a required field is a row with ``error`` set, where the reference raises.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparksweep.operators.jobs import document_time, last_wins_map

EXPERIMENT_SCHEMA = """
metadata struct<name: string, namespace: string, creationTimestamp: string>,
spec struct<
  parameters: array<struct<name: string, parameterType: string,
    feasibleSpace: struct<min: string, max: string, distribution: string, list: array<string>>>>,
  objective: struct<type: string, objectiveMetricName: string, additionalMetricNames: array<string>>,
  algorithm: struct<algorithmName: string, algorithmSettings: array<struct<name: string, value: string>>>,
  maxTrialCount: bigint, parallelTrialCount: bigint, maxFailedTrialCount: bigint>
"""


def parse_experiment_documents(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """experiment, num_trials, parallel_trials, max_failed_trials, objectives
    (list of metric and direction, the first one's direction for all), algorithm,
    settings (MAP), parameters (list as documented), created, error."""
    d = docs.select(F.from_json(doc_col, EXPERIMENT_SCHEMA).alias("d"))
    meta, spec = F.col("d.metadata"), F.col("d.spec")
    created = document_time(meta["creationTimestamp"])
    text = lambda c: F.coalesce(c, F.lit("")) == ""
    number = lambda c: F.coalesce(c, F.lit(0)) == 0
    required = [("name", text(meta["name"])), ("namespace", text(meta["namespace"])), ("spec", spec.isNull()),
                ("parameters", F.coalesce(F.size(spec["parameters"]), F.lit(0)) <= 0), ("objective", spec["objective"].isNull()),
                ("algorithm", spec["algorithm"].isNull()), ("trial count", number(spec["maxTrialCount"])),
                ("parallel trial count", number(spec["parallelTrialCount"])), ("creation time", created.isNull()),
                ("objective metric", spec["objective"]["objectiveMetricName"].isNull())]
    error = F.coalesce(*[F.when(missing, F.lit(f"missing {what}")) for what, missing in required])
    goal = spec["objective"]
    metrics = F.concat(F.array(goal["objectiveMetricName"]), F.coalesce(goal["additionalMetricNames"], F.array().cast("array<string>")))
    return d.select(
        meta["name"].alias("experiment"), spec["maxTrialCount"].alias("num_trials"),
        spec["parallelTrialCount"].alias("parallel_trials"), spec["maxFailedTrialCount"].alias("max_failed_trials"),
        F.transform(metrics, lambda m: F.struct(m.alias("metric"), goal["type"].alias("direction"))).alias("objectives"),
        spec["algorithm"]["algorithmName"].alias("algorithm"),
        last_wins_map(F.coalesce(spec["algorithm"]["algorithmSettings"], F.array().cast("array<struct<name:string,value:string>>")),
                      "name", "value").alias("settings"),
        spec["parameters"].alias("parameters"), created.alias("created"), error.alias("error"))


def parameter_settings(experiments: DataFrame) -> DataFrame:
    """The long table that ``space.read_back_space`` reads, one row per parameter of the valid experiments."""
    x = experiments.filter(F.col("error").isNull()).select("experiment", F.explode("parameters").alias("p"))
    space = F.col("p.feasibleSpace")
    return x.select("experiment", F.col("p.name").alias("param"), F.col("p.parameterType").alias("kind"),
                    space["min"].alias("min_text"), space["max"].alias("max_text"), space["distribution"].alias("distribution"),
                    space["list"].alias("choices"))
