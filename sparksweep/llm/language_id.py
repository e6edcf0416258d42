"""Language identification by the nearest of several centroids per language.

A text becomes a vector: lower-cased letters with single spaces between words,
counts of all 1- to 3-grams of characters hashed to ``DIMS`` places,
log(1 + count) times the inverse document frequency, length 1. The texts of
each language are clustered (spherical k-means) into ``CENTROIDS`` centroids; a
text gets the language of the centroid with the largest cosine. A text farther
from it than the centroid's radius (its farthest member in the sample, times
``SLACK``) is marked ``rejected``.

Only the fit works on a sample: at most ``PER_LANG`` labelled texts per
language, those with the smallest hashes of their ids. Predictions read whole texts.
The model (languages x CENTROIDS x DIMS x 4 bytes) is sent to the tasks in blocks of languages
of at most ``MODEL_BYTES``, each in a pass of its own over the texts that keeps the nearest centroid so far.

Defined results: a null text, or one without letters, is ``und`` with score 0;
so is every text if nothing was learned. Rows without id hash as the empty id.
Repeated rows are judged each on its own. Clashing column names of the input
are replaced by the operator's, other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparksweep.llm.batch import drop_columns, mix, slices
from sparksweep.session import shared_dir

DIMS = 1 << 13
CENTROIDS = 4
PER_LANG = 400
SLACK = 1.1
MODEL_BYTES = 64 << 20
UNKNOWN = "und"
ADDED = ("lang_pred", "score", "rejected")
NOT_LETTERS = re.compile(r"[\W\d_]+")
CHUNK = 1 << 20


@dataclass
class Model:
    langs: list[str]  # of each centroid
    centroids: np.ndarray
    radius: np.ndarray
    idf: np.ndarray
    path: str = ""  # of all centroids
    later: tuple[tuple[str, str], ...] = ()  # first and last language of each further block


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % divisor


def counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed 1- to 3-grams of a whole text; None without letters."""
    plain = NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    if not plain:
        return None
    code = np.frombuffer(f" {plain} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    total = np.zeros(DIMS, np.int64)
    shift = np.uint64(64 - DIMS.bit_length() + 1)
    for at in range(0, len(code), CHUNK):  # a chunk sees two more characters for its 2- and 3-grams
        part = code[at: at + CHUNK + 2].astype(np.uint64)
        size = min(CHUNK, len(code) - at)
        gram = part + np.uint64(1)
        for n in (1, 2, 3):
            if n > 1:
                gram = gram[: len(part) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + part[n - 1:]
            total += np.bincount((mix(gram[:size] * np.uint64(0xD1342543DE82EF95)) >> shift).astype(np.int64), minlength=DIMS)
    return total


def vectors(rows: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(rows, dtype=np.float32) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def cluster(v: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from farthest-first seeds: centroids and, for each, the
    smallest cosine of a member."""
    seeds = [v.mean(axis=0) / max(1e-12, np.linalg.norm(v.mean(axis=0)))]
    while len(seeds) < min(k, len(v)):
        seeds.append(v[np.argmin((v @ np.array(seeds).T).max(axis=1))])
    c = np.array(seeds, np.float32)
    for _ in range(rounds):
        own = (v @ c.T).argmax(axis=1)
        c = np.array([v[own == i].sum(axis=0) if (own == i).any() else c[i] for i in range(len(c))], np.float32)
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    near = v @ c.T
    own, best = near.argmax(axis=1), near.max(axis=1)
    used = [i for i in range(len(c)) if (own == i).any()]
    return c[used], np.array([best[own == i].min() for i in used], np.float32)


def fit(train: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
        per_lang: int = PER_LANG, k: int = CENTROIDS) -> Model:
    """Learn from a bounded sample of the rows with a language; the counts per language are of all rows."""
    spark = train.sparkSession
    order = F.xxhash64(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit("lang-sample"))
    rows = train.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), order.alias("o"))
    size = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    # First thinned to about twice the bound by the hash alone, so that no window holds a whole language.
    share = F.least(F.lit(1.0), F.lit(2.0 * per_lang + 50) / F.col("n"))
    path = shared_dir(spark, "lang-sizes")
    size.write.parquet(path)
    thin = rows.join(spark.read.parquet(path).withColumn("share", share), "lang").where(
        (F.col("o") / float(1 << 64) + 0.5) <= F.col("share"))
    first = Window.partitionBy("lang").orderBy("o", "text")
    sample = thin.withColumn("r", F.row_number().over(first)).where(F.col("r") <= per_lang).select("lang", "text")

    def count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [(x, c) for x, t in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True)
                     if (c := counts(t)) is not None]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.string()),
                                              pa.array([c.astype(np.int32).tobytes() for _, c in found], pa.binary())], ["lang", "counts"])

    path = shared_dir(spark, "lang-sample")
    sample.mapInArrow(count_rows, "lang string, counts binary").write.parquet(path)
    sample = spark.read.parquet(path)

    def frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(DIMS, np.int64), 0
        for batch in batches:
            for c in batch.column(0).to_pylist():
                df += np.frombuffer(c, np.int32) > 0
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, DIMS)), pa.array(np.concatenate([[n], df]))], ["dim", "n"])

    df = np.zeros(DIMS + 1, np.int64)
    for r in sample.select("counts").mapInArrow(frequency, "dim long, n long").groupBy("dim").agg(F.sum("n").alias("n")).collect():
        df[r["dim"] + 1] = r["n"]  # DIMS + 1 rows
    idf = np.log((1 + df[0]) / (1 + df[1:])).astype(np.float32) + 1

    def centroids(key, group):
        v = vectors(np.stack([np.frombuffer(c, np.int32) for c in sorted(group["counts"])]), idf)
        c, near = cluster(v, k)
        return pd.DataFrame({"lang": [key[0]] * len(c), "centroid": [x.tobytes() for x in c], "near": near.astype(float)})

    found = sample.groupBy("lang").applyInPandas(centroids, "lang string, centroid binary, near double")
    path = shared_dir(spark, "lang-centroids")
    found.write.parquet(path)
    found = spark.read.parquet(path)
    most, bounds, held = MODEL_BYTES // (DIMS * 4), [], 0
    for r in found.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").collect():  # a row per language
        if bounds and held + r["n"] <= most:
            bounds[-1] = (bounds[-1][0], r["lang"])
        else:
            bounds.append((r["lang"], r["lang"]))
            held = 0
        held += r["n"]
    model = _block(found, bounds[0] if bounds else ("", ""), idf)
    model.path, model.later = path, tuple(bounds[1:])
    return model


def _block(found: DataFrame, bounds: tuple[str, str], idf: np.ndarray) -> Model:
    got = found.where(F.col("lang").between(*map(F.lit, bounds))).orderBy("lang", "near", "centroid").collect()  # at most MODEL_BYTES
    return Model([r["lang"] for r in got], np.array([np.frombuffer(r["centroid"], np.float32) for r in got]).reshape(-1, DIMS),
                 np.array([(1 - r["near"]) * SLACK + 1e-3 for r in got]), idf)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add lang_pred, score (cosine with the nearest centroid, 0 to 1) and rejected."""
    spark, docs = docs.sparkSession, drop_columns(docs, ADDED)
    out = _pass(docs, model, text)
    for bounds in model.later:
        path = shared_dir(spark, "lang-pass")
        out.write.parquet(path)
        out = _pass(spark.read.parquet(path), _block(spark.read.parquet(model.path), bounds, model.idf), text, True)
    return out


def _pass(docs: DataFrame, model: Model, text: str, again: bool = False) -> DataFrame:
    """The nearest of the model's centroids, or what an earlier pass found if that is as near."""
    held = docs
    if again:
        docs = drop_columns(docs, ADDED)
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most MODEL_BYTES
    block, plain = 128, len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in slices(batches, text):
            texts = batch.column(text).to_pylist()
            lang, score, far = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
            if again:
                lang = batch.column("lang_pred").to_pylist()
                score, far = (np.array(batch.column(n).to_pylist()) for n in ("score", "rejected"))
            for at in range(0, len(texts) if m.langs else 0, block):
                rows = [(i, c) for i in range(at, min(at + block, len(texts))) if (c := counts(texts[i])) is not None]
                if not rows:
                    continue
                near = vectors(np.stack([c for _, c in rows]), m.idf) @ m.centroids.T
                for (i, _), j, s in zip(rows, near.argmax(axis=1).tolist(), near.max(axis=1).tolist(), strict=True):
                    if again and s <= score[i]:
                        continue
                    lang[i], score[i], far[i] = m.langs[j], min(1.0, max(0.0, s)), 1 - s > m.radius[j]
            yield pa.RecordBatch.from_arrays([*batch.columns[:plain], pa.array(lang, pa.string()), pa.array(score), pa.array(far)], schema.names)

    return held.mapInArrow(run, schema)
