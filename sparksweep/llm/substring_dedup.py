"""Removal of repeated byte strings by column-wise multi-document construction.

Every byte that lies in a string of ``SIZE`` (200) bytes which also starts
somewhere else, in the same or another document, is removed. Texts count as
UTF-8 bytes; strings never cross documents.

Inserting one symbol per document and round, as the construction asks, takes
as many rounds over the whole collection as the longest document has bytes. So whole
documents are first cut down to the places where repeats can be:

1. Each window (string of SIZE bytes) names an anchor, its smallest 64-byte
   gram by hash. Neighbouring windows with one anchor form a piece, which is at
   most 2 * SIZE - 64 bytes long. Equal windows have equal anchors at equal places.
2. Anchors are counted by hash, with the smallest and largest hash of their
   pieces. One occurrence: none of its windows repeats. Several, all of one
   piece: all its windows repeat. Anchors with different pieces are mixed.
3. The different pieces of mixed anchors, aligned at their anchors, are the
   documents of the construction: from the last column to the first, each
   round inserts one symbol of every piece, which turns the order of the suffixes at
   column c+1 into that at column c (the symbols in this order are the
   collection's Burrows-Wheeler transform at that column) and updates the
   lengths of common prefixes of neighbours. A window whose common prefix with a neighbour
   is SIZE or longer repeats. At most 2 * SIZE - 64 rounds, each linear in the pieces.
   Anchors with more than ``HOT`` different pieces are decided by counting their windows' hashes.
4. Repeated windows go back to the documents as byte ranges.

Hashes are compared in pairs (128 bits). Broadcast are two Bloom filters of at
most ``FILTER_BYTES`` each, which only spare rows: a false positive costs a
row, never a wrong result.

Defined results: a null or empty text has 0 bytes and the hash of the empty string;
repeated rows are documents that repeat each other; an empty table gives an
empty result. Clashing column names of the input are replaced by the operator's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparksweep.llm.batch import RollingHash, drop_columns, mix, slices, utf8
from sparksweep.llm.language_model import fill, probe
from sparksweep.session import shared_dir

SIZE = 200
GRAM = 64
CHUNK = 1 << 20
HOT = 20_000
COLLECTION = 20_000  # pieces that are built together
SEGMENTS = 64
FILTER_BYTES = 16 << 20
ADDED = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "removed")


def pieces(buf: np.ndarray, offs: np.ndarray, hasher: RollingHash, size: int = SIZE, gram: int = GRAM):
    """Arrays (row, first window, past-last window, anchor place, anchor hash) of all pieces."""
    width = size - gram + 1
    out = []
    last_window = len(buf) - size + 1
    up, down = hasher.tables(CHUNK)
    for at in range(0, max(0, last_window), CHUNK - size):
        upto = min(at + CHUNK - size, last_window)  # windows at .. upto-1
        part = buf[at: upto + size - 1]
        n = len(part) - gram + 1
        pre = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(hasher.values[part] * up[: len(part)], out=pre[1:])
        g = mix((pre[gram:] - pre[:-gram]) * down[:n])
        # The place in the low bits makes the first of equal grams the smallest.
        key = (g & np.uint64((1 << 64) - CHUNK)) | np.arange(n, dtype=np.uint64)
        # The minimum of any ``width`` keys, from running minima within blocks of that size.
        blocks = np.concatenate([key, np.full(-n % width, np.iinfo(np.uint64).max)]).reshape(-1, width)
        left = np.minimum.accumulate(blocks, axis=1).reshape(-1)
        right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        windows = upto - at
        place = (np.minimum(right[:windows], left[width - 1: width - 1 + windows]) & np.uint64(CHUNK - 1)).astype(np.int64)
        first, past = np.searchsorted(offs, [at, upto - 1], "right") - 1
        bounds = np.clip(offs[first: past + 2], at, upto)
        row = np.repeat(np.arange(first, past + 1), np.diff(bounds))
        p = np.flatnonzero(np.arange(at, upto) + size <= offs[row + 1])
        if len(p):
            q, r = place[p], row[p]
            new = np.concatenate([[True], (q[1:] != q[:-1]) | (r[1:] != r[:-1])])
            begin = np.flatnonzero(new)
            end = np.concatenate([begin[1:], [len(p)]]) - 1
            # Anchors are the smallest of many hashes: mixed again, they are spread evenly.
            out.append((r[begin], at + p[begin], at + p[end] + 1, at + q[begin], mix(g[q[begin]])))
    return [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)]


def repeated_windows(strings: list[bytes], rel: np.ndarray, size: int = SIZE) -> list[np.ndarray]:
    """For strings that are aligned so that byte ``rel`` of each is at the same
    column: which of its windows also occur at the same column of another string.

    Column by column from the last to the first; ``order`` has the strings that
    reach the column, sorted by their suffixes there, ``lcp`` the common prefix of each with the one before."""
    m = len(strings)
    length = np.array([len(s) for s in strings], np.int64)
    low = int(rel.max()) - rel  # first column of each string
    high = low + length
    width = int(high.max())
    flat = np.frombuffer(b"".join(strings), np.uint8)
    begin = np.concatenate([[0], np.cumsum(length)[:-1]])
    table = np.zeros((width, m), np.uint8)
    cols = np.arange(len(flat)) - np.repeat(begin - low, length)
    table[cols, np.repeat(np.arange(m), length)] = flat
    found = np.zeros((width, m), bool)
    enters = np.argsort(high, kind="stable")[::-1]
    enter_at = -high[enters]
    order, lcp = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for c in range(width - 1, -1, -1):
        stay = low[order] <= c
        if not stay.all():  # a string that ended here passes its bound on to the next
            kept = np.flatnonzero(stay)
            if len(kept):
                lcp = np.minimum.reduceat(lcp[: kept[-1] + 1], np.concatenate([[0], kept[:-1] + 1]))
                lcp[0] = 0
            else:
                lcp = lcp[:0]
            order = order[kept]
        a, b = np.searchsorted(enter_at, [-(c + 1), -c])
        if b > a:  # empty suffixes come before all others and share nothing
            new = enters[a:b]
            order, lcp = np.concatenate([new, order]), np.concatenate([np.zeros(len(new), np.int64), lcp])
            if len(lcp) > len(new):
                lcp[len(new)] = 0
        if not len(order):
            continue
        symbol = table[c, order]
        perm = np.argsort(symbol, kind="stable")
        bwt = symbol[perm]
        common = np.zeros(len(perm), np.int64)
        # Between neighbours with one symbol: 1 + the least bound between their old places.
        between = np.minimum.reduceat(np.append(lcp, 0), perm + 1)
        same = np.flatnonzero(bwt[1:] == bwt[:-1])
        common[same + 1] = between[same] + 1
        order, lcp = order[perm], common
        equal = lcp >= size
        if equal.any():
            hit = equal.copy()
            hit[:-1] |= equal[1:]
            found[c, order[hit]] = True
    return [found[a: max(a, h - size + 1), i] for i, (a, h) in enumerate(zip(low.tolist(), high.tolist(), strict=True))]


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))).reshape(-1, 2)
    return [(int(a), int(b)) for a, b in edge]


def _scan(docs: DataFrame, emit, schema: str) -> DataFrame:
    """Run ``emit(batch, buf, offs, hasher, pieces, piece hashes)`` over slices of (_id, _th, _text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seen = RollingHash(), set()
        for batch in slices(batches, "_text"):
            buf, offs = utf8(batch.column("_text"))
            row, p1, p2, a, g = pieces(buf, offs, hasher)
            h = hasher.ranges(buf, p1, p2 + SIZE - 1)
            yield emit(batch, buf, offs, row, p1, p2, a, g, h, seen)
    return docs.mapInArrow(run, schema)


def _filter(anchors: DataFrame) -> np.ndarray:
    """A Bloom filter of the anchors (column anchor), 2 bytes for each, FILTER_BYTES at most; a row per segment."""
    n = anchors.count()
    size = max(64, min(FILTER_BYTES, 2 * n) // SEGMENTS)
    shift = 64 - (SEGMENTS.bit_length() - 1)

    def build(key, table):
        keys = table.column("anchor").combine_chunks().to_numpy(zero_copy_only=False).view(np.uint64)
        return pa.table({"segment": pa.array([key[0].as_py()], pa.int32()),
                         "bits": pa.array([fill(keys, np.ones(len(keys), np.int64), size, 2.0).tobytes()], pa.binary())})

    parts = np.zeros((SEGMENTS, size), np.uint8)
    keyed = anchors.select(F.shiftrightunsigned("anchor", shift).cast("int").alias("segment"), "anchor")
    # A segment is salted, so that no task holds more than its share of a large set; the parts are joined here.
    salts = max(1, n // (SEGMENTS * 500_000))
    keyed = keyed.withColumn("salt", F.pmod(F.xxhash64("anchor"), F.lit(salts)))
    for r in keyed.groupBy("segment", "salt").applyInArrow(build, "segment int, bits binary").toLocalIterator():
        parts[r["segment"]] |= np.frombuffer(r["bits"], np.uint8)
    return parts


def _in_filter(parts: np.ndarray, keys: np.ndarray) -> np.ndarray:
    return probe(parts, keys, 2.0, 1) > 0


def _anchors(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Anchors that occur more than once: anchor, mixed (with different pieces); written."""
    def emit(batch, buf, offs, row, p1, p2, a, g, h, seen):
        return pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(h.view(np.int64))], ["anchor", "piece"])

    path = shared_dir(spark, "substring-anchors")
    (_scan(docs, emit, "anchor long, piece long").groupBy("anchor").agg(
        F.count(F.lit(1)).alias("n"), F.min("piece").alias("low"), F.max("piece").alias("high"))
        .where("n > 1").select("anchor", (F.col("low") != F.col("high")).alias("mixed")).write.parquet(path))
    return spark.read.parquet(path)


def _instances(spark: SparkSession, docs: DataFrame, anchors: DataFrame) -> DataFrame:
    """Pieces that may repeat, one row for each place: _id, _th, anchor, piece,
    start (byte), windows; the first of a kind in a task carries rel (the anchor's place
    in the piece) and bytes, if its anchor may be mixed. Written."""
    sent = spark.sparkContext.broadcast((_filter(anchors.select("anchor")), _filter(anchors.where("mixed").select("anchor"))))
    names = ["_id", "_th", "anchor", "piece", "start", "windows", "rel", "bytes"]

    def emit(batch, buf, offs, row, p1, p2, a, g, h, seen):
        several, mixed = sent.value
        at = np.flatnonzero(_in_filter(several, g))
        may = _in_filter(mixed, g[at])
        text, rel = [], []
        raw = buf.tobytes() if may.any() else b""
        if len(seen) > 500_000:
            seen.clear()
        for i, wanted in zip(at.tolist(), may.tolist(), strict=True):
            k = (int(g[i]), int(h[i]))
            if wanted and k not in seen:
                seen.add(k)
                text.append(raw[p1[i]: p2[i] + SIZE - 1])
                rel.append(int(a[i] - p1[i]))
            else:
                text.append(None)
                rel.append(None)
        rows = pa.array(row[at])
        return pa.RecordBatch.from_arrays(
            [batch.column("_id").take(rows), batch.column("_th").take(rows), pa.array(g[at].view(np.int64)),
             pa.array(h[at].view(np.int64)), pa.array((p1 - offs[row])[at]), pa.array((p2 - p1)[at]),
             pa.array(rel, pa.int64()), pa.array(text, pa.binary())], names)

    path = shared_dir(spark, "substring-pieces")
    kind = docs.schema["_id"].dataType.simpleString()
    _scan(docs, emit, f"_id {kind}, _th long, anchor long, piece long, start long, windows long, rel long, bytes binary").write.parquet(path)
    return spark.read.parquet(path)


def _construct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor: the ranges of repeated windows of each piece."""
    held: list[tuple] = []
    names = ["anchor", "piece", "ranges"]
    kind = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))

    def done(rows: list[tuple]) -> pa.RecordBatch:
        flags = repeated_windows([r[3] for r in rows], np.array([r[2] for r in rows], np.int64))
        found = [(r[0], r[1], [{"from": a, "to": b} for a, b in runs(f)]) for r, f in zip(rows, flags, strict=True) if f.any()]
        cols = list(zip(*found, strict=True)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], kind)], names)

    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in ("anchor", "piece", "rel", "bytes")], strict=True):
            if len(held) >= COLLECTION and held[-1][0] != row[0]:
                yield done(held)
                held = []
            held.append(row)
    if held:
        yield done(held)


def _window_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per window of each piece: anchor, piece, window, h1 (with its place relative to the anchor), h2."""
    hasher = RollingHash()
    for batch in batches:
        for anchor, piece, rel, text in zip(*[batch.column(c).to_pylist() for c in ("anchor", "piece", "rel", "bytes")], strict=True):
            buf = np.frombuffer(text, np.uint8)
            at = np.arange(len(buf) - SIZE + 1)
            h = hasher.ranges(buf, at, at + SIZE)
            h2 = mix(h * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(anchor & (1 << 64) - 1) + (rel - at).astype(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), anchor)), pa.array(np.full(len(at), piece)), pa.array(at),
                                              pa.array(h.view(np.int64)), pa.array(h2.view(np.int64))], ["anchor", "piece", "window", "h1", "h2"])


def _mixed_ranges(spark: SparkSession, found: DataFrame, anchors: DataFrame, hot: int) -> DataFrame:
    """Ranges of repeated windows of the pieces of mixed anchors: anchor, piece, ranges."""
    mixed = anchors.where("mixed").select("anchor")
    path = shared_dir(spark, "substring-mixed")
    (found.where("bytes is not null").select("anchor", "piece", "rel", "bytes").dropDuplicates(["anchor", "piece"])
     .join(mixed, "anchor", "left_semi").write.parquet(path))
    kinds = spark.read.parquet(path)
    many = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select("anchor")
    cold = kinds.join(many, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor")
    schema = "anchor long, piece long, ranges array<struct<from: long, to: long>>"
    cold = cold.mapInArrow(_construct, schema)
    path = shared_dir(spark, "substring-windows")
    (kinds.join(many, "anchor", "left_semi").mapInArrow(
        _window_hashes, "anchor long, piece long, window long, h1 long, h2 long").write.parquet(path))
    windows = spark.read.parquet(path)
    twice = windows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1", "h2")
    warm = windows.join(twice, ["h1", "h2"], "left_semi").groupBy("anchor", "piece").agg(F.collect_list(F.struct(
        F.col("window").alias("from"), (F.col("window") + 1).alias("to"))).alias("ranges"))
    path = shared_dir(spark, "substring-ranges")
    cold.unionByName(warm).write.parquet(path)
    return spark.read.parquet(path)


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", hot: int = HOT, keep_text: bool = True) -> DataFrame:
    """Add n_bytes, n_removed, n_spans (long), kept_sha256, removed (byte ranges);
    with ``keep_text`` the text column holds what is left, else it is dropped. What is left is
    decoded with replacement characters where a cut splits a character."""
    spark = docs.sparkSession
    docs = drop_columns(docs, ADDED)
    keyed = docs.withColumns({"_id": F.col(doc_id), "_th": F.xxhash64(F.col(text)), "_text": F.col(text)})
    source = keyed.select("_id", "_th", "_text")
    anchors = _anchors(spark, source)
    found = _instances(spark, source, anchors)
    ranges = _mixed_ranges(spark, found, anchors, hot)
    places = found.select("_id", "_th", "anchor", "piece", "start", "windows")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("from"), F.col("windows").alias("to")))
    several = places.groupBy("anchor", "piece").agg(F.count(F.lit(1)).alias("n")).where("n > 1").join(
        anchors.where("mixed"), "anchor", "left_semi").select("anchor", "piece", F.lit(True).alias("several"))
    path = shared_dir(spark, "substring-verdicts")  # a table of its own, so that the join with a hot piece can be split
    ranges.join(several, ["anchor", "piece"], "full").write.parquet(path)
    verdict = spark.read.parquet(path)
    mixed = places.join(verdict, ["anchor", "piece"]).withColumn(
        "ranges", F.when(F.col("several"), whole).otherwise(F.col("ranges")))
    plain = places.join(anchors.where("not mixed"), "anchor", "left_semi").withColumn("ranges", whole)
    parts = plain.select("_id", "_th", "start", "ranges").unionByName(mixed.select("_id", "_th", "start", "ranges"))
    cuts = parts.groupBy("_id", "_th").agg(F.flatten(F.collect_set(F.transform("ranges", lambda r: F.struct(
        (F.col("start") + r["from"]).alias("a"), (F.col("start") + r["to"] + (SIZE - 1)).alias("b"))))).alias("_cuts"))
    cuts = cuts.select(F.col("_id").alias("_id2"), F.col("_th").alias("_th2"), "_cuts")
    joined = keyed.drop("_text").join(cuts, F.col("_id").eqNullSafe(F.col("_id2")) & F.col("_th").eqNullSafe(F.col("_th2")), "left")
    joined = joined.select(*docs.columns, "_cuts")
    keep = [f for f in docs.schema.fields if keep_text or f.name != text]
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([*keep, *[T.StructField(c, T.LongType()) for c in ADDED[:3]],
                           T.StructField("kept_sha256", T.StringType()), T.StructField("removed", span)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            out: dict[str, list] = {c: [] for c in ADDED}
            left: list = []
            for value, cuts in zip(batch.column(text).to_pylist(), batch.column("_cuts").to_pylist(), strict=True):
                raw = (value or "").encode()
                spans: list[list[int]] = []
                for c in sorted(cuts or (), key=lambda c: c["a"]):
                    if spans and c["a"] <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], c["b"])
                    else:
                        spans.append([c["a"], c["b"]])
                at, kept = 0, []
                for a, b in spans:
                    kept.append(raw[at:a])
                    at = b
                rest = b"".join([*kept, raw[at:]])
                row = (len(raw), len(raw) - len(rest), len(spans), hashlib.sha256(rest).hexdigest(),
                       [{"start": a, "end": b} for a, b in spans])
                for c, v in zip(ADDED, row, strict=True):
                    out[c].append(v)
                left.append(value if value is None or not spans else rest.decode("utf-8", "replace"))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(left, pa.string()) if f.name == text else batch.column(f.name) for f in keep],
                 *[pa.array(out[c], pa.int64()) for c in ADDED[:3]], pa.array(out["kept_sha256"], pa.string()),
                 pa.array(out["removed"], kind)], schema.names)

    return joined.mapInArrow(cut, schema)
