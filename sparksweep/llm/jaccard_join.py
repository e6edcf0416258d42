"""N-gram Jaccard self-join with Bayesian candidate pruning.

Two documents are linked if their sets of 5-word shingles (A-Z lower-cased;
words are runs of letters, digits and non-ASCII) have a Jaccard similarity of
``THRESHOLD`` or more.

1. Documents with the same words in the same order form one class; from here on
   only classes are compared, and a class counts with its size.
2. Each class has ``BANDS * ROWS`` MinHash values; classes that agree in all
   values of a band share a bucket. A pair at the threshold shares none with
   probability (1 - 0.8**4)**32 = 5e-8.
3. The smallest class of a bucket is its pivot. All classes that ever met a
   pivot form its group, so a bucket of any size costs one row per member, and
   every candidate pair lies in some group; it is compared in the group of the
   smallest pivot that both know.
4. A group is cut by hash into blocks of ``BLOCK`` bytes of signatures and shingles (thousands of
   classes), and each pair of blocks is one unit of work of bounded memory. A member is sent to each unit of its block:
   one row if the group is one block. Within a unit pairs are compared by MinHash values, 16 at
   a time; a pair whose posterior probability (uniform prior) of reaching the
   threshold falls below ``TOLERANCE`` is dropped; the rest is verified exactly on the shingle sets. No
   pair leaves the task: a class gets its number of linked documents and one
   edge to the smallest class of its local component.
5. Groups of near copies are the connected components of these edges (large-star
   and small-star rounds, each written to the shared folder).

The result has a row per input row: class_id (smallest id in the connected
group), n_links (linked documents, copies included) and first (true for one
row of each group and its identical rows). ``one_of_each`` keeps that row.

Defined results: texts without words (null, empty) are linked to nothing; a
text of fewer than 5 words has one shingle of all its words; rows without id
get a negative id from their text's hash; repeated rows are copies of each other; an empty
table gives an empty result. Only the id and text columns are read, so other columns can't clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparksweep.llm.batch import NOT_ALNUM, Forest, RollingHash, mix, powers, shingles, slices, word_hashes
from sparksweep.session import shared_dir

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 4
STEP = 16
TOLERANCE = 1e-9
BLOCK = 8 << 20


class MinHash:
    def __init__(self, n: int = BANDS * ROWS):
        self.a = mix(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)
        self.b = mix(np.arange(n + 1, 2 * n + 1, dtype=np.uint64))

    def signatures(self, sh: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """uint32 matrix (row, hash); rows without shingles are all ones."""
        out = np.full((len(bounds) - 1, len(self.a)), 0xFFFFFFFF, np.uint32)
        full = np.flatnonzero(np.diff(bounds))
        if len(full):
            for j, (a, b) in enumerate(zip(self.a, self.b, strict=True)):
                out[full, j] = np.minimum.reduceat((sh * a + b) >> np.uint64(32), bounds[full]).astype(np.uint32)
        return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    parts = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    factor = powers(ROWS + 1)[1:]
    return mix((parts * factor).sum(axis=2, dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def fingerprints(words: np.ndarray, rows: np.ndarray) -> list[bytes | None]:
    """128 bits of each row's word sequence; None without words."""
    size = np.diff(rows)
    at = np.arange(len(words)) - np.repeat(rows[:-1], size)
    out: list[bytes | None] = [None] * len(size)
    full = np.flatnonzero(size)
    if not len(full):
        return out
    longest = int(size.max())
    halves = []
    for base in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
        value = np.add.reduceat(words * powers(longest, base)[at], rows[full])
        halves.append(mix(value + size[full].astype(np.uint64)))
        words = mix(words)
    both = np.stack(halves, axis=1)
    for i, row in zip(full.tolist(), both, strict=True):
        out[i] = row.tobytes()
    return out


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE, n: int = BANDS * ROWS) -> dict[int, int]:
    """After k values: the least number of matches at which the posterior
    P(J >= threshold) is ``tolerance`` or more. With a uniform prior it is
    P(Binomial(k + 1, threshold) <= matches)."""
    out = {}
    for k in range(STEP, n + 1, STEP):
        total = 0.0
        for m in range(k + 1):
            total += math.comb(k + 1, m) * threshold**m * (1 - threshold) ** (k + 1 - m)
            if total >= tolerance:
                out[k] = m
                break
    return out


class Sets:
    """The sets of a unit's members as dense numbers, to intersect one with many at once."""

    def __init__(self, sets: list[np.ndarray]):
        size = np.array([len(x) for x in sets])
        _, ids = np.unique(np.concatenate(sets), return_inverse=True)
        self.sets = np.split(ids, np.cumsum(size)[:-1])
        self.mark = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.int32)

    def shared(self, i: int, others: np.ndarray) -> np.ndarray:
        """How many values set i shares with each of the others."""
        self.mark[self.sets[i]] = 1
        rest = [self.sets[x] for x in others.tolist()]
        sums = np.concatenate([[0], np.cumsum(self.mark[np.concatenate(rest)])])
        self.mark[self.sets[i]] = 0
        ends = np.concatenate([[0], np.cumsum([len(x) for x in rest])])
        return np.diff(sums[ends])


def compare(group: list[dict], pivot: int, same: bool, a: int, threshold: float, least: dict[int, int]) -> list[tuple]:
    """Links among the members of one unit of work, as (node, a node of
    its local component, linked documents). ``same``: all pairs, else those
    between block ``a`` and the other one."""
    found = {m["node"]: m for m in group}  # a class whose text was fetched twice counts once
    members = [found[k] for k in sorted(found)]
    sig = np.stack([np.frombuffer(m["signature"], np.uint32) for m in members])
    sets = Sets([np.frombuffer(m["shingles"], np.uint64) for m in members])
    earlier = Sets([np.array([p for p in m["pivots"] if p < pivot], np.int64) for m in members])
    sizes = np.array([len(s) for s in sets.sets])
    block, copies = np.array([m["block"] for m in members]), np.array([m["size"] for m in members])
    links, forest = np.zeros(len(members), np.int64), Forest(len(members))
    for i in range(len(members) - 1):
        j = np.arange(i + 1, len(members))
        if not same:
            j = j[block[j] != block[i]]
        j = j[np.minimum(sizes[j], sizes[i]) >= threshold * np.maximum(sizes[j], sizes[i]) - 1e-9]
        matches = np.zeros(len(j), np.int64)
        for k in range(STEP, sig.shape[1] + 1, STEP):
            if not len(j):
                break
            matches += (sig[j, k - STEP: k] == sig[i, k - STEP: k]).sum(axis=1)
            alive = matches >= least[k]
            j, matches = j[alive], matches[alive]
        if len(j):
            j = j[earlier.shared(i, j) == 0]  # others are compared in the group of a smaller pivot
        if len(j):
            both = sets.shared(i, j)
            j = j[both >= threshold * (sizes[i] + sizes[j] - both) - 1e-9]
            links[i] += copies[j].sum()
            links[j] += copies[i]
            forest.link(np.full(len(j), i), j)
    at = np.flatnonzero(links)
    return [(members[i]["node"], members[r]["node"], n) for i, r, n in zip(at.tolist(), forest.find(at).tolist(), links[at].tolist(), strict=True)]


def _classes(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (_doc, _id, _th, fp) and classes (node, fp, first, first_doc, size, bands, weight in bytes), both written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, minhash = RollingHash(), MinHash()
        for batch in slices(batches, "_text"):
            words, rows = word_hashes(hasher, batch.column("_text"), NOT_ALNUM)
            fp = fingerprints(words, rows)
            sh, bounds = shingles(words, rows, WORDS)
            keys = band_keys(minhash.signatures(sh, bounds)).view(np.int64)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(fp) + 1, dtype=np.int32) * BANDS), pa.array(keys.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("_doc"), batch.column("_id"), batch.column("_th"), pa.array(fp, pa.binary()), flat,
                                              pa.array(minhash.a.size * 4 + 8 * np.diff(bounds), pa.int64())],
                                             ["_doc", "_id", "_th", "fp", "bands", "weight"])

    path = shared_dir(spark, "jaccard-rows")
    docs.mapInArrow(run, "_doc long, _id long, _th long, fp binary, bands array<long>, weight long").write.parquet(path)
    rows = spark.read.parquet(path)
    path = shared_dir(spark, "jaccard-classes")
    rows.where("fp is not null").groupBy("fp").agg(
        F.min(F.struct("_id", "_th")).alias("first"), F.min("_doc").alias("first_doc"), F.count(F.lit(1)).alias("size"),
        F.first("bands").alias("bands"), F.first("weight").alias("weight")).withColumn("node", F.monotonically_increasing_id()).write.parquet(path)
    return rows.drop("bands", "weight"), spark.read.parquet(path)


def _groups(spark: SparkSession, classes: DataFrame) -> DataFrame:
    """Members of pivot groups: node, pivot; written."""
    bands = classes.select("node", F.explode("bands").alias("band"))
    pivots = bands.groupBy("band").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("n")).where("n > 1")
    path = shared_dir(spark, "jaccard-groups")
    bands.join(pivots.select("band", "pivot"), "band").select("pivot", "node").distinct().write.parquet(path)
    return spark.read.parquet(path)


def _units(spark: SparkSession, docs: DataFrame, classes: DataFrame, groups: DataFrame, block: int) -> DataFrame:
    """A row for each member and unit of work: pivot, a, b, node, block, size, pivots, signature, shingles."""
    known = groups.groupBy("node").agg(F.collect_set("pivot").alias("pivots"))  # at most BANDS
    path = shared_dir(spark, "jaccard-members")
    known.join(classes.drop("bands", "first_doc"), "node").write.parquet(path)
    members = spark.read.parquet(path)
    wanted = members.select(F.col("first._id").alias("_id"), F.col("fp").alias("want"), "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, minhash = RollingHash(), MinHash()
        for batch in slices(batches, "_text"):
            words, rows = word_hashes(hasher, batch.column("_text"), NOT_ALNUM)
            fp, (sh, bounds) = fingerprints(words, rows), shingles(words, rows, WORDS)
            sig = minhash.signatures(sh, bounds)
            ok = [i for i, (x, y) in enumerate(zip(fp, batch.column("want").to_pylist(), strict=True)) if x == y]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").take(pa.array(ok, pa.int64())), pa.array([sig[i].tobytes() for i in ok], pa.binary()),
                 pa.array([np.unique(sh[bounds[i]: bounds[i + 1]]).tobytes() for i in ok], pa.binary())],
                ["node", "signature", "shingles"])

    texts = docs.select("_id", "_text").join(wanted, "_id")
    found = texts.mapInArrow(run, "node long, signature binary, shingles binary")
    path = shared_dir(spark, "jaccard-blocks")  # a table of its own, so that the join with a hot pivot can be split
    groups.join(classes.select("node", "weight"), "node").groupBy("pivot").agg(
        F.ceil(F.sum("weight") / block).cast("int").alias("blocks")).write.parquet(path)
    mine = groups.join(spark.read.parquet(path), "pivot").withColumn("block", F.pmod(F.xxhash64("node", "pivot"), "blocks").cast("int"))
    mine = mine.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    mine = mine.select("pivot", "node", "block", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"))
    return mine.join(members.select("node", "size", "pivots"), "node").join(found, "node")


def _links(units: DataFrame, threshold: float) -> DataFrame:
    least = least_matches(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group = None, []

        def done() -> pa.RecordBatch:
            rows = compare(group, key[0], key[1] == key[2], key[1], threshold, least) if len(group) > 1 else []
            cols = list(zip(*rows, strict=True)) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["node", "root", "links"])

        for batch in batches:
            for row in batch.to_pylist():
                k = (row["pivot"], row["a"], row["b"])
                if k != key:
                    if group:
                        yield done()
                    key, group = k, []
                group.append(row)
        if group:
            yield done()

    by = ("pivot", "a", "b")
    return units.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, "node long, root long, links long")


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Connected components of (u, v): a row (u, v) for each node u but the
    smallest, v, of its component. Large-star and small-star rounds until nothing changes."""
    def kept(df: DataFrame) -> tuple[DataFrame, tuple]:
        path = shared_dir(spark, "jaccard-stars")
        df.write.parquet(path)
        df = spark.read.parquet(path)
        return df, tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())

    now, mark = kept(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while mark[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.inline(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))))
        now, after = kept(small.where("u != v").distinct())
        if after == mark:
            break
        mark = after
    return now


def _keyed(docs: DataFrame, text: str, doc_id: str, prefix: str = "_") -> dict:
    th = F.xxhash64(F.col(text))
    return {f"{prefix}id": F.coalesce(F.col(doc_id).cast("long"), -F.shiftrightunsigned(th, 1) - 1), f"{prefix}th": th}


def link(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """A row per input row: doc_id, class_id, n_links, first, _id and _th (the row's key)."""
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("long").alias("_doc"), F.col(text).alias("_text"),
                       *[c.alias(k) for k, c in _keyed(docs, text, doc_id).items()])
    rows, classes = _classes(spark, docs)
    groups = _groups(spark, classes)
    path = shared_dir(spark, "jaccard-links")
    _links(_units(spark, docs, classes, groups, block), threshold).write.parquet(path)
    links = spark.read.parquet(path)
    stars = components(spark, links.select(F.col("node").alias("u"), F.col("root").alias("v")))
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    nodes = (classes.select("node", "fp", "first", "first_doc", "size")
             .join(stars.withColumnsRenamed({"u": "node", "v": "top"}), "node", "left").join(counts, "node", "left")
             .withColumn("top", F.coalesce("top", "node")))
    label = nodes.groupBy("top").agg(F.min("first").alias("chosen"), F.min("first_doc").alias("first_doc")).select(
        "top", "chosen", F.coalesce("first_doc", "chosen._id").alias("class_id"))
    nodes = nodes.drop("first_doc").join(label, "top").select(
        "fp", "class_id", "chosen", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = rows.join(nodes, "fp", "left")
    return out.select(F.col("_doc").alias("doc_id"), F.coalesce("class_id", "_id").alias("class_id"),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce(F.col("chosen") == F.struct("_id", "_th"), F.lit(True)).alias("first"), "_id", "_th")


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """The input's columns for one row of each group: the one with the smallest id."""
    names = {c.lower() for c in docs.columns}
    prefix = "_"
    while {f"{prefix}id", f"{prefix}th"} & names:  # a name that no column has
        prefix += "_"
    key = [f"{prefix}id", f"{prefix}th"]
    firsts = link(docs, text, doc_id, threshold).where("first").select(F.col("_id").alias(key[0]), F.col("_th").alias(key[1])).distinct()
    keyed = docs.withColumns(_keyed(docs, text, doc_id, prefix))
    return keyed.join(firsts, key, "left_semi").dropDuplicates(key).select(*[F.col(f"`{c}`") for c in docs.columns])
