"""Language-model scores from a log-frequency Bloom filter.

Counts. Texts are lower-cased (A-Z) and cut at white space; each text ends with
an end token, which is also the context of its first word. Every task counts
the n-grams (orders 1 to ``ORDER``) of its training texts as 64-bit hashes,
summed up before the shuffle, and sends them to segments by the leading bits of the hash;
the number of segments follows the input's size. A segment sums its counts and
writes (1) the exact unigram counts and (2) its part of the filter.

Filter. A count c is quantised to q = 1 + floor(log_b c); the n-gram is inserted
with each level 1..q. A probe asks for levels 1, 2, ... until one is missing.
Its keys are the segment and 36 more bits of the hash. A segment's part has ``BITS`` bits for each level of its
n-grams, so the filter grows with the n-grams and its rate of false positives is the same at any size. The model is
P(w|v) = (c(vw) + MU * P(w)) / (c(v) + MU) with P(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)),
all counts quantised, applied from order 1 up.

Probes. The texts to score are cut into units of at most ``UNIT_BYTES`` (or one text), written once. Consecutive
segments make a block of at most ``BLOCK_BYTES``; the distinct n-grams of each unit are written as questions by block.
One block after the other is broadcast to the workers, which read that block's questions, and no others, and write the
levels found: no shuffle. Answered questions are deleted. The levels then meet their units in the one shuffle of the scoring.

Exact unigram base. The ``TOP`` most frequent token types are broadcast (16 bytes
each); the other tokens' exact counts are answered with the levels, by the block that holds them.

Defined results: a null or empty text is its end token; with no training texts every count is
0; repeated rows are scored each on its own; an empty table gives an empty result. Clashing
column names of the input are replaced by the operator's, other columns pass through.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparksweep.llm.batch import WHITE, RollingHash, drop_columns, free_names, mix, slices, utf8, word_hashes
from sparksweep.session import shared_dir

ORDER = 2
BASE = 2.0
MU = 20.0
PROBES = 5
BITS = 24  # of the filter per n-gram and level
UNIT_BYTES = 4 << 20
SEGMENT_BYTES = 8 << 20  # of training text for each segment
BLOCK_BYTES = 64 << 20  # of the model that are broadcast at once
TOP = 1 << 18
HELD = 2 << 20  # n-grams that a task gathers before it sums them up
END = np.uint64(0x5851F42D4C957F2D)
ADDED = ("n_tokens", "n_known", "train_tokens", "base_score", "score")


@dataclass
class Model:
    segments: int  # of the filter
    top_hash: np.ndarray  # sorted
    top_count: np.ndarray
    tokens: int
    types: int
    path: str  # of the counts and the filter's parts


def with_ends(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Insert the end token after every row's words."""
    return np.insert(words, rows[1:], END), rows + np.arange(len(rows))


def ngrams(tokens: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """The hash of each token with the n-1 before it; the end token stands before a text."""
    at = np.arange(len(tokens)) - np.repeat(rows[:-1], np.diff(rows))
    h = tokens.copy()
    for back in range(1, n):
        before = np.full(len(tokens), END)
        ok = at >= back
        before[ok] = tokens[np.flatnonzero(ok) - back]
        h = mix(h + before * np.uint64(0x9E3779B97F4A7C15 + 2 * back))
    return h


def contexts(tokens: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """The hash of the n-1 tokens before each token, as ``ngrams`` hashes them."""
    before = np.concatenate([[END], tokens[:-1]]) if len(tokens) else tokens.copy()
    before[rows[:-1][np.diff(rows) > 0]] = END
    if n == 2:
        return before
    at = np.arange(len(tokens)) - np.repeat(rows[:-1], np.diff(rows))
    h = before.copy()
    for back in range(2, n):
        far = np.full(len(tokens), END)
        ok = at >= back
        far[ok] = tokens[np.flatnonzero(ok) - back]
        h = mix(h + far * np.uint64(0x9E3779B97F4A7C15 + 2 * (back - 1)))
    return h


def summed(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
    return hashes[first], np.add.reduceat(counts, first) if len(first) else counts


def planes(numbers: np.ndarray) -> bytes:
    """The numbers' bytes, first the lowest of all, so that the high ones compress."""
    return numbers.view(np.uint8).reshape(len(numbers), numbers.dtype.itemsize).T.tobytes()


def from_planes(data: bytes, dtype) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).reshape(-1)


def squeeze(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unsqueeze(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def spare(segments: int) -> np.uint64:
    """The low bits that the filter's keys leave out: 36 are kept below those that name the segment."""
    return np.uint64(max(0, 28 - (segments.bit_length() - 1)))


def short(hashes: np.ndarray, segments: int) -> np.ndarray:
    return hashes >> spare(segments) << spare(segments)


def pack(hashes: np.ndarray, drop: np.uint64) -> bytes:
    """Sorted hashes, whose ``drop`` low bits are 0, by their differences."""
    return squeeze(planes(np.diff(hashes >> drop, prepend=np.uint64(0))))


def unpack(data: bytes, drop: np.uint64) -> np.ndarray:
    return np.cumsum(from_planes(unsqueeze(data), np.uint64), dtype=np.uint64) << drop


def pack_numbers(numbers: np.ndarray) -> bytes:
    return squeeze(planes(np.ascontiguousarray(numbers)))


def pack_texts(column: pa.Array) -> tuple[bytes, bytes]:
    """The texts' bytes and their bounds."""
    buf, offs = utf8(column)
    return squeeze(buf.tobytes()), pack_numbers(offs)


def unpack_texts(data: bytes, bounds: bytes) -> pa.Array:
    offs = from_planes(unsqueeze(bounds), np.int64)
    return pa.StringArray.from_buffers(len(offs) - 1, pa.py_buffer(offs.astype(np.int32).tobytes()), pa.py_buffer(unsqueeze(data)))


@dataclass
class Unit:
    """The n-grams of some texts: ``kinds`` of tokens (sorted) and ``keys`` of longer ones."""
    tokens: np.ndarray
    rows: np.ndarray
    kinds: np.ndarray
    which: np.ndarray
    keys: np.ndarray

    @staticmethod
    def read(hasher: RollingHash, row: dict, order: int, segments: int) -> Unit:
        tokens, rows = with_ends(*word_hashes(hasher, unpack_texts(row["texts"], row["bounds"]), WHITE))
        kinds, which = np.unique(tokens, return_inverse=True)
        return Unit(tokens, rows, kinds, which, wanted_keys(tokens, rows, order, segments))


def wanted_keys(tokens: np.ndarray, rows: np.ndarray, order: int, segments: int) -> np.ndarray:
    """The filter's keys of a unit's distinct n-grams and contexts of two tokens or more, sorted."""
    found = [*[ngrams(tokens, rows, n) for n in range(2, order + 1)], *[contexts(tokens, rows, n) for n in range(3, order + 1)]]
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *[short(x, segments) for x in found]]))


def levels(counts: np.ndarray, base: float) -> np.ndarray:
    return 1 + np.floor(np.log(np.maximum(counts, 1)) / np.log(base) + 1e-9).astype(np.int64)


def typical(level: np.ndarray, base: float) -> np.ndarray:
    """The middle of the counts of a level; 0 for level 0."""
    low = np.ceil(base ** np.maximum(level - 1.0, 0) - 1e-9)
    high = np.maximum(low, np.ceil(base ** level.astype(float) - 1e-9) - 1)
    return np.where(level > 0, (low + high) / 2, 0.0)


def _key_hashes(keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    a = mix(keys + np.uint64(level * 0xC2B2AE3D27D4EB4F & (1 << 64) - 1))
    return a, mix(a) | np.uint64(1)


def _place(a: np.ndarray, b: np.ndarray, i: int, bits: int) -> np.ndarray:
    """The i-th place of each key in a segment's filter of ``bits`` bits."""
    return (((a + np.uint64(i) * b) >> np.uint64(20)) % np.uint64(bits)).astype(np.int64)


def fill(keys: np.ndarray, counts: np.ndarray, size: int, base: float) -> np.ndarray:
    """A segment's filter (size bytes) with every key at levels 1..q."""
    flags = np.zeros(size * 8, bool)
    q = levels(counts, base)
    level = 1
    while len(keys):
        a, b = _key_hashes(keys, level)
        for i in range(PROBES):
            flags[_place(a, b, i, size * 8)] = True
        level += 1
        keys, q = keys[q >= level], q[q >= level]
    return np.packbits(flags, bitorder="little")


def probe(parts: np.ndarray, keys: np.ndarray, base: float, top_level: int = 64) -> np.ndarray:
    """The typical count of every key's level."""
    return typical(probe_levels(parts, keys, top_level), base)


def probe_levels(parts: np.ndarray, keys: np.ndarray, top_level: int = 64) -> np.ndarray:
    """Every key's level: levels are asked for until one is missing."""
    segments, size = parts.shape
    flat = parts.reshape(-1)
    shift = np.uint64(64 - (segments.bit_length() - 1))
    level = np.zeros(len(keys), np.int64)
    live = np.arange(len(keys))
    for step in range(1, top_level + 1):
        a, b = _key_hashes(keys[live], step)
        for i in range(PROBES):
            place = _place(a, b, i, size * 8)
            at = (keys[live] >> shift).astype(np.int64) * size + (place >> 3)
            hit = (flat[at] >> (place & 7).astype(np.uint8)) & 1 == 1
            live, a, b = live[hit], a[hit], b[hit]
        level[live] = step
        if not len(live):
            break
    return level


def train(docs: DataFrame, text: str = "text", order: int = ORDER, base: float = BASE,
          bits: int = BITS, top: int = TOP) -> Model:
    spark = docs.sparkSession
    docs = docs.select(F.col(text).alias("text"))
    total = int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    segments = 1 << max(3, (total // SEGMENT_BYTES).bit_length())
    shift = np.uint64(64 - (segments.bit_length() - 1))
    drop = {n: np.uint64(0) if n == 1 else spare(segments) for n in range(1, order + 1)}  # unigram counts are exact

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = RollingHash()
        held = {n: ([], []) for n in range(1, order + 1)}

        def flush(n: int, whole: bool):
            hashes, counts = summed(np.concatenate(held[n][0]), np.concatenate(held[n][1]))
            if not whole and len(hashes) < HELD // 2:
                held[n] = ([hashes], [counts])
                return
            held[n] = ([], [])
            cut = np.searchsorted(hashes, np.arange(1, segments, dtype=np.uint64) << shift)
            hs, cs = np.split(hashes, cut), np.split(counts, cut)
            full = [i for i in range(segments) if len(hs[i])]
            for at in range(0, len(full), 64):
                part = full[at: at + 64]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.int32()), pa.array([n] * len(part), pa.int32()),
                     pa.array([pack(hs[i], drop[n]) for i in part], pa.binary()),
                     pa.array([pack_numbers(cs[i].astype(np.int64)) for i in part], pa.binary())], ["segment", "n", "hashes", "counts"])

        for batch in slices(batches, "text"):
            tokens, rows = with_ends(*word_hashes(hasher, batch.column(0), WHITE))
            for n in range(1, order + 1):
                h = ngrams(tokens, rows, n)
                h, c = summed(h if n == 1 else short(h, segments), np.ones(len(tokens), np.int64))
                held[n][0].append(h)
                held[n][1].append(c)
                if sum(map(len, held[n][0])) > HELD:
                    yield from flush(n, False)
        for n in range(1, order + 1):
            if held[n][0]:
                yield from flush(n, True)

    def reduce(key, table):
        keys, out = [], {}
        for n in range(1, order + 1):
            mine = table.filter(pc.equal(table.column("n"), n))
            h = np.concatenate([np.zeros(0, np.uint64), *[unpack(x, drop[n]) for x in mine.column("hashes").to_pylist()]])
            c = np.concatenate([np.zeros(0, np.int64), *[from_planes(unsqueeze(x), np.int64) for x in mine.column("counts").to_pylist()]])
            out[n] = summed(h, c)
            keys.append(out[n])
        counts = np.concatenate([c for _, c in keys])
        size = max(64, int(levels(counts, base).sum()) * bits // 8)
        parts = fill(short(np.concatenate([k for k, _ in keys]), segments), counts, size, base)
        h, c = out[1]
        bucket, n = np.unique(levels(c, 1.1), return_counts=True)
        return pa.table({"segment": pa.array([key[0].as_py()], pa.int32()), "hashes": pa.array([h.tobytes()], pa.binary()),
                         "counts": pa.array([c.tobytes()], pa.binary()), "types": pa.array([len(h)], pa.int64()),
                         "tokens": pa.array([int(c.sum())], pa.int64()), "filter": pa.array([parts.tobytes()], pa.binary()),
                         "hist": pa.array([[{"b": int(b), "n": int(k)} for b, k in zip(bucket, n, strict=True)]],
                                          pa.list_(pa.struct([("b", pa.int64()), ("n", pa.int64())])))})

    path = shared_dir(spark, "lm-counts")
    (docs.mapInArrow(count, "segment int, n int, hashes binary, counts binary").groupBy("segment").applyInArrow(
        reduce, "segment int, hashes binary, counts binary, types long, tokens long, filter binary, "
                "hist array<struct<b: long, n: long>>").write.parquet(path))
    got = spark.read.parquet(path)
    sizes = got.agg(F.sum("tokens").alias("tokens"), F.sum("types").alias("types")).first()
    hist = got.select(F.inline("hist")).groupBy("b").agg(F.sum("n").alias("n")).orderBy(F.desc("b")).collect()  # some hundred rows
    least, room = 1 << 62, top
    for r in hist:
        if r["n"] > room:
            break
        least, room = r["b"], room - r["n"]
    most = got.select("hashes", "counts").mapInArrow(_types(lambda c: levels(c, 1.1) >= least), "h long, c long").toArrow()
    h, c = (np.asarray(most.column(i)) for i in (0, 1))  # at most ``top`` rows
    h = h.view(np.uint64)
    by = np.argsort(h)
    return Model(segments, h[by], c[by], int(sizes["tokens"] or 0), int(sizes["types"] or 0), path)


def _types(wanted):
    """Unpack the unigram counts that are wanted into rows (h, c)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for hs, cs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                h, c = np.frombuffer(hs, np.int64), np.frombuffer(cs, np.int64)
                ok = wanted(c)
                yield pa.RecordBatch.from_arrays([pa.array(h[ok]), pa.array(c[ok])], ["h", "c"])
    return run


def frequent(kinds: np.ndarray, top_hash: np.ndarray, top_count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which kinds are among the most frequent, and their counts (0 for the others)."""
    if not len(top_hash):
        return np.zeros(len(kinds), bool), np.zeros(len(kinds), np.int64)
    place = np.minimum(np.searchsorted(top_hash, kinds), len(top_hash) - 1)
    found = top_hash[place] == kinds
    return found, np.where(found, top_count[place], 0)


def look_up(block: dict, tokens: np.ndarray, keys: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Exact counts of the tokens, and the levels of the tokens and then of the keys; both are sorted.
    ``block``: segment -> (filter, sorted unigram hashes, their counts)."""
    shift = np.uint64(64 - (segments.bit_length() - 1))
    counts, level = np.zeros(len(tokens), np.int64), np.zeros(len(tokens) + len(keys), np.uint8)
    of_tokens, of_keys = tokens >> shift, keys >> shift
    for segment, (part, hashes, exact) in block.items():
        ends = np.array([segment, segment + 1], np.uint64)
        a, b = np.searchsorted(of_tokens, ends)
        if a < b:
            counts[a:b] = frequent(tokens[a:b], hashes, exact)[1]
            level[a:b] = probe_levels(part[None, :], short(tokens[a:b], segments))
        a, b = np.searchsorted(of_keys, ends)
        if a < b:
            level[len(tokens) + a: len(tokens) + b] = probe_levels(part[None, :], keys[a:b])
    return counts, level


def _levels(units: DataFrame, model: Model, top, order: int) -> DataFrame:
    """(id, block, n, counts, levels): what the model's blocks say of each unit's n-grams; n: number of tokens asked for."""
    spark, segments, drop = units.sparkSession, model.segments, spare(model.segments)
    parts = spark.read.parquet(model.path).select("segment", "filter", "hashes", "counts")
    largest = parts.agg(F.max(F.length("filter") + F.length("hashes") + F.length("counts"))).first()[0] or 1
    width = min(segments, 1 << max(0, (BLOCK_BYTES // largest).bit_length() - 1))  # segments of a block
    cuts = np.arange(width, segments, width, dtype=np.uint64) << np.uint64(64 - (segments.bit_length() - 1))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = RollingHash()
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                unit = Unit.read(hasher, row, order, segments)
                rare = unit.kinds[~frequent(unit.kinds, *top.value)[0]]
                words, keys = (np.split(x, np.searchsorted(x, cuts)) for x in (rare, unit.keys))
                full = [j for j in range(len(keys)) if len(words[j]) or len(keys[j])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full, pa.int32()), pa.array([row["id"]] * len(full), pa.string()),
                     pa.array([pack(words[j], np.uint64(0)) for j in full], pa.binary()),
                     pa.array([pack(keys[j], drop) for j in full], pa.binary())], ["block", "id", "words", "keys"])

    questions, answers = shared_dir(spark, "lm-questions"), shared_dir(spark, "lm-levels")
    units.mapInArrow(ask, "block int, id string, words binary, keys binary").write.partitionBy("block").parquet(questions)
    asked = spark.read.schema("id string, words binary, keys binary, block int").parquet(questions)

    def answers_of(sent):
        def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    words = unpack(batch.column("words")[i].as_py(), np.uint64(0))
                    counts, level = look_up(sent.value, words, unpack(batch.column("keys")[i].as_py(), drop), segments)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id").slice(i, 1), pa.array([len(words)], pa.int64()), pa.array([pack_numbers(counts)], pa.binary()),
                         pa.array([squeeze(level.tobytes())], pa.binary())], ["id", "n", "counts", "levels"])
        return answer

    for j, first in enumerate(range(0, segments, width)):
        rows = parts.where(F.col("segment").between(first, first + width - 1)).toArrow().to_pylist()  # at most BLOCK_BYTES
        sent = spark.sparkContext.broadcast({r["segment"]: tuple(np.frombuffer(r[c], t) for c, t in (
            ("filter", np.uint8), ("hashes", np.uint64), ("counts", np.int64))) for r in rows})
        asked.where(F.col("block") == j).select("id", "words", "keys").mapInArrow(
            answers_of(sent), "id string, n long, counts binary, levels binary").write.parquet(f"{answers}/block={j}")
        sent.destroy()
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(questions)  # all answers are written
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return spark.read.schema("id string, n long, counts binary, levels binary, block int").parquet(answers)


def _scores(units: DataFrame, model: Model, row: str, order: int, base: float, mu: float) -> DataFrame:
    """(row, n_tokens, n_known, base_score, score) of the texts of the units."""
    segments, names = model.segments, units.columns
    denominator = model.tokens + 0.5 * (model.types + 1)
    top = units.sparkSession.sparkContext.broadcast((model.top_hash, model.top_count))  # at most ``top`` types

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = RollingHash()
        unit, held = None, []

        def done() -> pa.RecordBatch:
            u = Unit.read(hasher, unit, order, segments)
            found, exact = frequent(u.kinds, *top.value)
            exact[~found] = np.concatenate([np.zeros(0, np.int64), *[c for c, _, _ in held]])
            level = np.where(found, levels(exact, base), 0)
            level[~found] = np.concatenate([np.zeros(0, np.uint8), *[w for _, w, _ in held]])
            kinds = typical(level, base)
            longer = typical(np.concatenate([np.zeros(0, np.uint8), *[k for _, _, k in held]]).astype(np.int64), base)

            def look(hashes: np.ndarray) -> np.ndarray:
                found, of = np.unique(short(hashes, segments), return_inverse=True)
                return longer[np.searchsorted(u.keys, found)][of]

            p = ((kinds + 0.5) / denominator)[u.which]
            for n in range(2, order + 1):
                both, before = look(ngrams(u.tokens, u.rows, n)), contexts(u.tokens, u.rows, n)
                of = kinds[np.searchsorted(u.kinds, before)] if n == 2 else look(before)
                p = (both + mu * p) / (np.maximum(of, both) + mu)
            sums = lambda x: pa.array(np.add.reduceat(x, u.rows[:-1]))  # noqa: E731  every text has its end token
            return pa.RecordBatch.from_arrays(
                [pa.array(from_planes(unsqueeze(unit["ids"]), np.int64)), pa.array(np.diff(u.rows)), sums((exact > 0)[u.which].astype(np.int64)),
                 sums(np.log10((exact + 0.5) / denominator)[u.which]), sums(np.log10(np.minimum(p, 1.0)))],
                [row, "n_tokens", "n_known", "base_score", "score"])

        for batch in batches:
            for i in range(batch.num_rows):
                at = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                if at["block"] is not None:
                    level = np.frombuffer(unsqueeze(at["levels"]), np.uint8)
                    held.append((from_planes(unsqueeze(at["counts"]), np.int64), level[: at["n"]], level[at["n"]:]))
                    continue
                if unit:  # the unit stands before its answers, which follow by block
                    yield done()
                unit, held = {n: at[n] for n in names}, []
        if unit:
            yield done()

    both = units.unionByName(_levels(units, model, top, order), allowMissingColumns=True)
    return both.repartition("id").sortWithinPartitions("id", F.col("block").asc_nulls_first()).mapInArrow(
        finish, f"`{row}` long, n_tokens long, n_known long, base_score double, score double")


def score(docs: DataFrame, model: Model, text: str = "text", order: int = ORDER, base: float = BASE, mu: float = MU) -> DataFrame:
    """Add n_tokens, n_known, train_tokens (long), base_score and score (log10)."""
    spark = docs.sparkSession
    docs = drop_columns(docs, ADDED)
    plain = [c for c in docs.columns if c != text]
    row, unit = free_names(docs.columns, "row", "unit")
    fields = [("id", "string"), ("ids", "binary"), ("texts", "binary"), ("bounds", "binary")]
    schema = T.StructType([f for f in docs.schema.fields if f.name != text] + [
        T.StructField(row, T.LongType()), T.StructField(unit, T._parse_datatype_string(f"struct<{', '.join(f'{n}: {t}' for n, t in fields)}>"))])
    arrow = pa.struct([(n, pa.string() if t == "string" else pa.binary()) for n, t in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, UNIT_BYTES):
            texts, bounds = pack_texts(batch.column(text))
            ids = batch.column(row).to_numpy(zero_copy_only=False).astype(np.int64)
            made = {"id": uuid.uuid4().hex, "ids": pack_numbers(ids), "texts": texts, "bounds": bounds}
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in plain], batch.column(row),
                                              pa.array([made] + [None] * (batch.num_rows - 1), arrow)], schema.names)

    path = shared_dir(spark, "lm-units")
    docs.withColumn(row, F.monotonically_increasing_id()).mapInArrow(run, schema).write.parquet(path)
    got = spark.read.schema(schema).parquet(path)
    scores = _scores(got.where(F.col(f"`{unit}`").isNotNull()).select(f"`{unit}`.*"), model, row, order, base, mu)
    out = got.drop(unit).join(scores, row)
    return out.select(*[f"`{c}`" for c in plain], "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
                      "base_score", "score")
