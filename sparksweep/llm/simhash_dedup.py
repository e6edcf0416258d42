"""SimHash near-duplicate detection by tiled exact comparison.

1. Fingerprint: A-Z lower-cased, words between white space, shingles of
   ``SHINGLE`` words joined by one space, repeats included (a text of fewer words
   has one shingle of all its words). A shingle's hash is XXH64 of its UTF-8 with
   seed 42; a bit is 1 if it is set in more than half of the hashes. Without words
   the fingerprint is zero, which is linked like any other.
2. Only different fingerprints are compared. They lie in cells by the population
   counts of their two halves, at most 33 * 33 cells at any size. Two fingerprints
   within ``RADIUS`` bits lie in cells whose counts differ by ``RADIUS`` in sum at
   most, so a cell meets itself and 40 others (20 of them as the left side), whatever
   the input.
3. A cell of more than ``CHUNK`` fingerprints is cut by hash into chunks, each sorted
   by finer population counts and cut into tiles of ``TILE`` fingerprints. A pair of
   chunks is one unit of work of bounded memory (2 MB); tiles, not single
   fingerprints, are the rows that are shuffled.
4. Within a unit a pair of tiles is skipped if the ranges of their eight bytes'
   population counts lie more than ``RADIUS`` apart in sum (the counts differ by at
   least as much as the bits do); all others are compared exactly by exclusive-or and
   bit counts. No pair leaves the task: a fingerprint gets an edge to one
   fingerprint of its local component.
5. Components of these edges by large-star and small-star rounds in shared folders.

All comparisons are exact, so no link is missed; the number of tile pairs grows with
the square of the *different* fingerprints, copies cost nothing.

Defined results: null, empty and blank texts have fingerprint zero and form one
component; repeated rows give equal rows; rows without id take part, but
component_id is the smallest id that is not null (null if no row has one); an
empty table gives an empty result. Texts are hashed in blocks, so their length is not
limited. Only the id and text columns are read, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparksweep.llm.batch import LOWER, WHITE, Forest, slices, utf8, word_bounds
from sparksweep.llm.jaccard_join import components
from sparksweep.session import shared_dir

SHINGLE = 4
SEED = 42
RADIUS = 4
TILE = 512
CHUNK = 131_072
HASH_BLOCK = 1 << 18


def bit_counts(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set among the hashes of each row (rows, 64).

    Eight counters of a byte each lie in one word, so up to 255 hashes are added at once."""
    size = np.diff(bounds)
    out = np.zeros((len(size), 64), np.int64)
    pieces = -(-size // 255)
    before = np.cumsum(pieces) - pieces
    first = np.repeat(bounds[:-1] - 255 * before, pieces) + 255 * np.arange(pieces.sum())
    full = np.flatnonzero(size)
    if not len(full):
        return out
    lanes = np.uint64(0x0101010101010101)
    for bit in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(bit)) & lanes, first)
        out[full, bit::8] = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8).astype(np.int64), before[full], axis=0)
    return out


def simhash(column: pa.Array, k: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each text, as unsigned 64-bit numbers."""
    buf, offs = utf8(column)
    buf = LOWER[buf]
    starts, ends, rows = word_bounds(buf, offs, WHITE)
    if not len(starts):
        return np.zeros(len(column), np.uint64)
    length = ends - starts
    last = np.cumsum(length + 1) - 1  # past the last byte of each word, in the joined text
    first = last - length
    joined = np.full(int(last[-1]) + 1, 0x20, np.uint8)
    inner = np.ones(len(joined), bool)
    inner[last] = False
    joined[inner] = buf[~WHITE[buf]]
    data = memoryview(joined.tobytes())
    size = np.diff(rows)
    count = np.where(size >= k, size - k + 1, np.minimum(size, 1))
    bounds = np.concatenate([[0], np.cumsum(count)])
    word = np.arange(bounds[-1]) + np.repeat(rows[:-1] - bounds[:-1], count)  # the first word of each shingle
    till = np.minimum(word + k, np.repeat(rows[1:], count)) - 1
    digest = xxhash.xxh64_intdigest
    ones = np.zeros((len(size), 64), np.int64)
    for at in range(0, len(word), HASH_BLOCK):
        part = slice(at, at + HASH_BLOCK)
        hashes = np.array([digest(data[a:b], SEED) for a, b in zip(first[word[part]].tolist(), last[till[part]].tolist(), strict=True)],
                          np.uint64)
        ones += bit_counts(hashes, np.clip(bounds - at, 0, len(hashes)))
    return np.packbits(2 * ones > count[:, None], axis=1, bitorder="little").view(np.uint64).reshape(-1)


def byte_counts(prints: np.ndarray) -> np.ndarray:
    """Population counts of the eight bytes of each fingerprint (n, 8)."""
    return np.bitwise_count(np.ascontiguousarray(prints).view(np.uint8).reshape(-1, 8)).astype(np.int16)


def tiles(prints: np.ndarray, size: int = TILE) -> list[np.ndarray]:
    """Fingerprints in tiles, sorted by the counts of their quarters, then bytes."""
    c = byte_counts(prints)
    order = np.lexsort((prints, c[:, 6], c[:, 4], c[:, 2], c[:, 0], c[:, 4] + c[:, 5], c[:, 0] + c[:, 1]))
    prints = prints[order]
    return [prints[i: i + size] for i in range(0, len(prints), size)]


def compare(left: list[np.ndarray], right: list[np.ndarray] | None, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Edges (fingerprint, fingerprint of its local component) of all pairs within
    ``radius`` between the tiles of two chunks, or within one (``right`` is None)."""
    every = left if right is None else left + right
    start = np.cumsum([0] + [len(t) for t in every])
    counts = [byte_counts(t) for t in every]
    low, high = np.array([c.min(axis=0) for c in counts]), np.array([c.max(axis=0) for c in counts])
    cols = np.arange(0 if right is None else len(left), len(every))
    forest = Forest(int(start[-1]))
    for i in range(len(left)):
        others = cols[cols >= i] if right is None else cols
        gap = np.maximum(np.maximum(low[others] - high[i], low[i] - high[others]), 0).sum(axis=1)
        for j in others[gap <= radius].tolist():
            near = np.bitwise_count(every[i][:, None] ^ every[j][None, :]) <= radius
            if i == j:
                near = np.triu(near, 1)
            if near.any():
                a, b = np.nonzero(near)
                forest.link(a + start[i], b + start[j])
    at = np.flatnonzero(forest.root != np.arange(len(forest.root)))
    prints = np.concatenate(every)
    return prints[at], prints[forest.find(at)]


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """(key, rows) of each run of equal keys in sorted batches."""
    now, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in keys])
        edges = np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows], strict=True):
            key = tuple(values[:, a].tolist())
            if key != now:
                if held:
                    yield now, pa.Table.from_batches(held)
                now, held = key, []
            held.append(batch.slice(a, b - a))
    if held:
        yield now, pa.Table.from_batches(held)


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(id, print) of each row, the fingerprint's bits as a signed long; written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(simhash(batch.column("text")).view(np.int64))], ["id", "print"])

    path = shared_dir(docs.sparkSession, "simhash-prints")
    docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, "id long, print long").write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def _tiles(nodes: DataFrame, chunk: int, size: int) -> tuple[DataFrame, DataFrame]:
    """Cells (hi, lo, chunks), at most 33 * 33, and tiles (hi, lo, chunk, prints); both written."""
    spark = nodes.sparkSession
    placed = nodes.select("print", F.bit_count(F.shiftrightunsigned("print", 32)).alias("hi"),
                          F.bit_count(F.col("print").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))).alias("lo"))
    path = shared_dir(spark, "simhash-cells")
    placed.groupBy("hi", "lo").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("chunks")).write.parquet(path)
    cells = spark.read.parquet(path)
    by = ["hi", "lo", "chunk"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in _runs(batches, by):
            cut = tiles(rows.column("print").to_numpy().view(np.uint64), size)
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([k] * len(cut), pa.int32()) for k in key], pa.array([t.view(np.int64) for t in cut], pa.list_(pa.int64()))],
                [*by, "prints"])

    path = shared_dir(spark, "simhash-tiles")
    placed.join(F.broadcast(cells), ["hi", "lo"]).select(
        "hi", "lo", F.pmod(F.xxhash64("print"), "chunks").cast("int").alias("chunk"), "print").repartition(*by).sortWithinPartitions(
        *by).mapInArrow(run, "hi int, lo int, chunk int, prints array<long>").write.parquet(path)
    return cells, spark.read.parquet(path)


def links(nodes: DataFrame, radius: int = RADIUS, chunk: int = CHUNK, size: int = TILE) -> DataFrame:
    """Edges (u, v) between different fingerprints that keep all components of the pairs within ``radius``."""
    cells, cut = _tiles(nodes, chunk, size)
    steps = [(h, x) for h in range(radius + 1) for x in range(-radius, radius + 1) if h + abs(x) <= radius and (h, x) >= (0, 0)]

    def side(which: int) -> DataFrame:
        """Tiles with the other cell and chunk of each unit they take part in, on the left (0) or right (1)."""
        sign = 1 - 2 * which
        away = F.explode(F.array(*[F.struct(F.lit(h).alias("h"), F.lit(x).alias("x")) for h, x in steps])).alias("away")
        other = cut.select("*", away).select(
            "hi", "lo", "chunk", "prints", (F.col("hi") + sign * F.col("away.h")).alias("hi2"), (F.col("lo") + sign * F.col("away.x")).alias("lo2"))
        found = cells.select(F.col("hi").alias("hi2"), F.col("lo").alias("lo2"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk2"))
        met = other.join(F.broadcast(found), ["hi2", "lo2"])
        mine, theirs = [F.col(c) for c in ("hi", "lo", "chunk")], [F.col(c) for c in ("hi2", "lo2", "chunk2")]
        same_cell = (F.col("hi") == F.col("hi2")) & (F.col("lo") == F.col("lo2"))
        met = met.where(~same_cell | (F.col("chunk") <= F.col("chunk2") if which == 0 else F.col("chunk") > F.col("chunk2")))
        first, second = (mine, theirs) if which == 0 else (theirs, mine)
        return met.select(*[c.alias(n) for c, n in zip(first + second, by, strict=True)], F.lit(which).alias("side"), "prints")

    by = ["hi_a", "lo_a", "chunk_a", "hi_b", "lo_b", "chunk_b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in _runs(batches, by):
            held: list[list] = [[], []]
            for which, prints in zip(rows.column("side").to_pylist(), (x for c in rows.column("prints").chunks for x in c), strict=True):
                held[which].append(prints.values.to_numpy(zero_copy_only=False).view(np.uint64))
            u, v = compare(held[0], None if key[:3] == key[3:] else held[1], radius)
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    units = side(0).unionByName(side(1)).repartition(*by).sortWithinPartitions(*by, "side")
    path = shared_dir(nodes.sparkSession, "simhash-links")
    units.mapInArrow(run, "u long, v long").distinct().write.parquet(path)
    return nodes.sparkSession.read.parquet(path)


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", radius: int = RADIUS,
                    chunk: int = CHUNK, size: int = TILE) -> DataFrame:
    """A row per input row: doc_id, fingerprint (16 hex digits), component_id."""
    spark = docs.sparkSession
    rows = fingerprints(docs, text, doc_id)
    path = shared_dir(spark, "simhash-nodes")
    rows.groupBy("print").agg(F.min("id").alias("first")).write.parquet(path)
    nodes = spark.read.parquet(path)
    stars = components(spark, links(nodes, radius, chunk, size)).withColumnsRenamed({"u": "print", "v": "top"})
    nodes = nodes.join(stars, "print", "left").withColumn("top", F.coalesce("top", "print"))
    label = nodes.groupBy("top").agg(F.min("first").alias("component_id"))
    path = shared_dir(spark, "simhash-labels")  # a table of its own, so that the join with a hot fingerprint can be split
    nodes.join(label, "top").select("print", "component_id").write.parquet(path)
    return rows.join(spark.read.parquet(path), "print").select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
