"""The README's quick start, run as written (sweep over the smoke tables)."""

from pyspark.sql import functions as F

from sparksweep.functions.search import choice, loguniform, uniform
from sparksweep.plans import sweep as S


def test_readme_sweep(spark, sf_dir):
    data = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    space = {"slope": uniform(500, 2500), "shift": loguniform(1, 1e4), "kind": choice(["a", "b", "c"])}
    trials = S.trial_table(spark, space, num_trials=256, algorithm=S.RandomSearch(7), parallel_trials=4)
    def errors(batch, p):  # partial sums of some trials over one batch of rows
        err = batch["l_extendedprice"] - p["shift"][:, None] - p["slope"][:, None] * batch["l_quantity"]
        return {"abs_err": abs(err).sum(axis=1), "n": [err.shape[1]] * len(err)}

    scores = S.score(data.select("l_quantity", "l_extendedprice"), trials, errors, ["abs_err", "n"],
                     {"mae": F.col("abs_err") / F.col("n")}, num_trials=256, params=["slope", "shift"])
    rows = scores.collect()
    assert len(rows) == 256 and all(r["mae"] >= 0 for r in rows)
    best = S.best_trial(scores, [S.Objective("mae", "minimize")]).first()
    assert best["mae"] == min(r["mae"] for r in rows)
