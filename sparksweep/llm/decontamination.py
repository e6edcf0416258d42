"""Benchmark decontamination with one Aho-Corasick automaton.

Test items (questions and answers) are normalised: A-Z lower-cased, every run
of other ASCII than letters and digits made one space. Each window of ``n``
consecutive words of an item is a pattern; an item of fewer words, but not
none, is one. A document's text is normalised the same way and scanned once;
matched words are mapped back to character offsets of the original text.

The items' texts are sent to the tasks, in blocks of at most ``block_bytes`` of
item text (larger benchmarks are scanned block by block, with a checkpoint
between, so that no task holds more than one automaton; a single item above
the bound is a block of its own).

Defined results: null or wordless texts have no words and are clean; an empty benchmark
hits nothing; items with equal ids count once; an item without id is named ``null``;
repeated rows are judged each on its own. Clashing column names of the input
are replaced by the operator's, other columns pass through.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparksweep.llm.batch import LOWER, NOT_ALNUM, drop_columns, slices
from sparksweep.session import checkpoint_root

WORDS = 10
BLOCK_BYTES = 1 << 18
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")  # before A-Z are lower-cased
# Lower-cases A-Z and makes every separator a space; bytes from 0x80 stay.
NORMAL = bytes(0x20 if NOT_ALNUM[LOWER[b]] else LOWER[b] for b in range(256))
ADDED = ("n_words", "n_hit", "items", "spans")
NONE = np.zeros((0, 2), np.int64)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(NORMAL).split()


def automaton(items: list[tuple[str, str]], n: int) -> ahocorasick.Automaton:
    """Patterns are `` w1 w2 ... wn ``, as latin-1 strings of the UTF-8 bytes;
    the value of one is its number of words and the ids of its items."""
    found: dict[str, tuple[int, set[str]]] = {}
    for item, text in items:
        words = words_of(text)
        size = min(n, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            pattern = (b" " + b" ".join(words[i: i + size]) + b" ").decode("latin-1")
            found.setdefault(pattern, (size, set()))[1].add(item)
    out = ahocorasick.Automaton()
    for pattern, value in found.items():
        out.add_word(pattern, value)
    if found:
        out.make_automaton()
    return out


def scan(patterns: ahocorasick.Automaton, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
    """Runs of hit words as (first, past last) rows, and the ids of the matched items."""
    line = b" " + b" ".join(words) + b" "
    first, last, items = [], [], set()
    for end, (size, ids) in patterns.iter(line.decode("latin-1")):
        last.append(end)
        first.append(size)
        items |= ids
    if not last:
        return NONE, items
    spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 0x20)
    past = np.searchsorted(spaces, np.array(last))
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, past - np.array(first), 1)
    np.add.at(change, past, -1)
    hit = np.concatenate([[0], (np.cumsum(change[:-1]) > 0).astype(np.int64), [0]])
    edge = np.flatnonzero(np.diff(hit))
    return edge.reshape(-1, 2), items


def _spans(text: str, runs: np.ndarray, old: list[dict]) -> tuple[int, list[dict]]:
    """Number of hit words and their character spans, joined with spans found before."""
    at = np.array([m.span() for m in WORD.finditer(text)], np.int64).reshape(-1, 2)
    mark = np.zeros(len(at) + 2, np.int64)
    for a, b in runs.tolist():
        mark[a + 1: b + 1] = 1
    for s in old:
        mark[np.searchsorted(at[:, 0], s["start"]) + 1: np.searchsorted(at[:, 0], s["end"]) + 1] = 1
    edge = np.flatnonzero(np.diff(mark)).reshape(-1, 2)
    return int(mark.sum()), [{"start": int(at[a, 0]), "end": int(at[b - 1, 1])} for a, b in edge.tolist()]


def find_items(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
               item_text: str = "text", n: int = WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Add n_words, n_hit (long), items (ids of the items with a match, sorted
    as strings) and spans (start and past-end characters of the maximal hit runs)."""
    docs = drop_columns(docs, ADDED)
    bench = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("i"),
                             F.coalesce(F.col(item_text), F.lit("")).alias("t")).distinct()
    total = bench.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-int(total) // block_bytes))
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    schema = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
                           T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", span)])
    plain = docs.columns
    types = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))]

    def scan_block(items: list[tuple[str, str]], later: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            patterns = automaton(items, n)
            for batch in slices(batches, text):
                cols: list[list] = [[], [], [], []]
                before = (zip(*[batch.column(c).to_pylist() for c in ("items", "spans")], strict=True) if later
                          else repeat(((), ())))
                for value, (old_items, old) in zip(batch.column(text).to_pylist(), before):  # noqa: B905
                    words = words_of(value)
                    runs, ids = scan(patterns, words) if len(patterns) and words else (NONE, set())
                    hit, spans = _spans(value, runs, old) if len(runs) or old else (0, [])
                    for c, v in zip(cols, (len(words), hit, sorted(ids.union(old_items)), spans), strict=True):
                        c.append(v)
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in plain],
                                                  *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]], schema.names)
        return run

    out = docs
    if blocks > 1:
        checkpoint_root(docs.sparkSession)
    place = F.pmod(F.xxhash64("i", "t"), F.lit(blocks))
    for b in range(blocks):
        items = [tuple(r) for r in bench.where(place == b).collect()]  # at most about block_bytes of text
        out = out.mapInArrow(scan_block(items, b > 0), schema)
        if b + 1 < blocks:
            out = out.checkpoint()
    return out


def digest(found: DataFrame) -> DataFrame:
    """n_items, items_sha256 and contaminated from ``find_items``."""
    return found.withColumns({
        "n_items": F.size("items").cast("long"),
        "items_sha256": F.sha2(F.array_join("items", ","), 256),
        "contaminated": F.col("n_hit") > 0,
    })
