"""Cross-tokenizer alignment with exact-text deduplication.

Two tokenizers, A (byte-level BPE from a ``tokenizers`` file) and B (a ``sentencepiece`` BPE with byte
fallback), cut the same bytes, a space and the text. Where an A and a B token end at the same byte, a group ends; the A and
the B token that end there are linked.

1. Rows are shuffled by their full text, with copies counted before the shuffle, so a text of a third of all rows
   is one row per task. Each distinct text is tokenised and aligned once; its measures and its different
   linked pairs with their numbers are written.
2. A pair's count over all documents is the sum of its numbers, each times the copies of its text.
3. Which pairs can occur follows from the vocabularies alone: tokens that end at the same byte are
   suffixes of each other, so there are at most as many pairs as the tokens of both have different suffixes
   (``pair_bound``, below 1,000,000 for the vocabularies used here). The counts are therefore gathered and broadcast
   at any size of the corpus (16 bytes a pair), and each text adds up its links in place.
4. The measures are joined to all ids by the text's SHA-256.

``align`` returns the rows with the groups' digest; ``pair_counts`` the corpus-wide table of pairs.

Defined results: texts that are null or empty, and texts whose joined A or B bytes differ from space and text
(characters that B normalises away, as U+2581), have no tokens: zeros and an empty digest. Special tokens' strings
are plain text. Rows without id are kept; repeated rows count each; equal counts of a B id
are all best; an empty table gives an empty result. Whole texts are tokenised, one at a time if
long. Only the id and text columns are read, so other columns can't clash.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparksweep.llm.batch import slices
from sparksweep.session import shared_dir

FOLDER = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
BATCH = 1 << 20


def byte_alphabet() -> dict[str, int]:
    """The byte of each character of byte-level vocabularies: printable Latin-1 characters
    stand for themselves, the other bytes in order for the characters from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """The bytes of the tokens of one tokenizer, by id."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.size = np.array([len(t) for t in tokens])
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of a sequence of tokens."""
        size = self.size[ids]
        return self.flat[np.repeat(self.start[ids] - (np.cumsum(size) - size), size) + np.arange(size.sum())]


class Tokenizers:
    """Both tokenizers and their vocabularies.

    A's file is read as a vocabulary with merges in the order of their ids (checked), so that its byte-pair
    encoding is run by ``tiktoken``, whose ranks are these ids: the same tokens in a third of the time."""

    # fixed value: the words of byte-level vocabularies
    PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, folder: str = FOLDER, a_file: str = A_FILE, b_file: str = B_FILE):
        import sentencepiece
        import tiktoken

        with open(f"{folder}/{a_file}", encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, alphabet = model["vocab"], byte_alphabet()
        merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if any(x >= y for x, y in zip(merged, merged[1:], strict=False)) or len(vocab) - len(merged) != 256:
            raise ValueError(f"{a_file}: not a byte-level vocabulary with its merges in the order of their ids")
        ranks = {bytes(alphabet[c] for c in token): i for token, i in vocab.items()}
        self.a = tiktoken.Encoding("a", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.a_words = Vocabulary([t for t, _ in sorted(ranks.items(), key=lambda x: x[1])])
        self.b = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{b_file}")
        self.b_words = Vocabulary([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                                   for i, p in enumerate(self.b.id_to_piece(i) for i in range(self.b.get_piece_size()))])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The ids of A and B of all texts, one after the other, and their bounds by text. Texts that
        either doesn't spell as space and text have none."""
        raw = [(" " + t).encode() for t in texts]
        sides = [(self.a_words, [self.a.encode_ordinary(" " + t) for t in texts]), (self.b_words, self.b.encode(texts, num_threads=1))]
        size = np.array([len(r) for r in raw])
        whole = np.ones(len(texts), bool)
        found = []
        for words, held in sides:
            ids = np.frombuffer(array("i", chain.from_iterable(held)), np.int32).astype(np.int64)
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in held])])
            spelt = np.concatenate([[0], np.cumsum(words.size[ids])])[bounds]
            whole &= np.diff(spelt) == size
            found.append((words, ids, bounds))
        for words, ids, bounds in found:  # of equal length: compare the bytes
            text = np.frombuffer(b"".join(compress(raw, whole.tolist())), np.uint8)
            wrong = np.flatnonzero(words.spell(ids[np.repeat(whole, np.diff(bounds))]) != text)
            at = np.flatnonzero(whole)
            whole[at[np.searchsorted(np.cumsum(size[at]), wrong, "right")]] = False
        out = []
        for _, ids, bounds in found:
            count = np.diff(bounds)
            out += [ids[np.repeat(whole, count)], np.concatenate([[0], np.cumsum(np.where(whole, count, 0))])]
        return tuple(out)


def pair_bound(a_bytes: list[bytes], b_bytes: list[bytes]) -> int:
    """At most so many (A id, B id) pairs can end at the same byte of a text: one's bytes are a suffix of the other's."""
    def ids(tokens):
        held: dict[bytes, int] = {}
        for t in tokens:
            held[t] = held.get(t, 0) + 1
        return held

    a, b = ids(a_bytes), ids(b_bytes)
    pairs = sum(n * b.get(t[i:], 0) for t, n in a.items() for i in range(len(t)))
    return pairs + sum(n * a.get(t[i:], 0) for t, n in b.items() for i in range(1, len(t)))


class Aligner:
    """Groups and links of two token sequences over the same bytes."""

    def __init__(self, a_words: Vocabulary, b_words: Vocabulary):
        self.a, self.b = a_words.size, b_words.size
        self.width = len(self.b)
        # decimal ids with what follows them: within a group, at the end of its A part, at the end of its B part
        words = [f"{i}{end}".encode() for n, end in ((len(self.a), ","), (len(self.a), "|"), (len(self.b), ","), (len(self.b), ";")) for i in range(n)]
        self.word_size = np.array([len(w) for w in words])
        self.words = np.array(words).view(np.uint8).reshape(len(words), -1)
        self.inside = np.arange(self.words.shape[1]) < self.word_size[:, None]

    def align(self, a: np.ndarray, a_bounds: np.ndarray, b: np.ndarray, b_bounds: np.ndarray):
        """For the texts in these bounds: the linked pairs (the last tokens of each group) with their
        bounds by text, and the SHA-256 of each text's groups ('' without tokens)."""
        a_end, b_end = np.cumsum(self.a[a]), np.cumsum(self.b[b])
        stop = np.zeros((2, int(a_end[-1]) + 1 if len(a) else 1), bool)
        stop[0, a_end], stop[1, b_end] = True, True
        a_last, b_last = stop[1, a_end], stop[0, b_end]
        i, j = np.flatnonzero(a_last), np.flatnonzero(b_last)
        a_code, b_code = a + a_last * len(self.a), b + 2 * len(self.a) + b_last * self.width
        # A tokens come behind the B tokens of earlier groups, B tokens behind the A tokens of their own group too
        merged = np.empty(len(a) + len(b), np.int64)
        merged[np.arange(len(a)) + np.concatenate([[0], j + 1])[np.cumsum(a_last) - a_last]] = a_code
        merged[np.arange(len(b)) + (i + 1)[np.cumsum(b_last) - b_last]] = b_code
        chars = memoryview(self.words[merged][self.inside[merged]].tobytes())
        ends = np.concatenate([[0], np.cumsum(self.word_size[merged])])[a_bounds + b_bounds].tolist()
        digests = [hashlib.sha256(chars[x: y - 1]).hexdigest() if y > x else "" for x, y in zip(ends, ends[1:], strict=False)]
        return a[i] * self.width + b[j], np.searchsorted(i, a_bounds), digests


def _aligned(docs: DataFrame, folder: str, a_file: str, b_file: str) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, key) and distinct texts (key, copies, n_a, n_b, n_groups, groups_sha256, pairs, times); the second written."""
    names = ["key", "copies", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner = None
        for batch in slices(batches, "text", BATCH):
            if both is None:
                both = Tokenizers(folder, a_file, b_file)
                aligner = Aligner(both.a_words, both.b_words)
                pairs_of_a_text = len(aligner.a) * aligner.width
            a, a_bounds, b, b_bounds = both.encode(batch.column("text").to_pylist())
            links, bounds, digests = aligner.align(a, a_bounds, b, b_bounds)
            text = np.repeat(np.arange(len(digests)), np.diff(bounds))
            pairs, times = np.unique(text * pairs_of_a_text + links, return_counts=True)
            ends = pa.array(np.searchsorted(pairs, np.arange(len(digests) + 1) * pairs_of_a_text), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("copies"), *[pa.array(np.diff(x), pa.int64()) for x in (a_bounds, b_bounds, bounds)],
                 pa.array(digests, pa.string()), pa.ListArray.from_arrays(ends, pa.array(pairs % pairs_of_a_text, pa.int64())),
                 pa.ListArray.from_arrays(ends, pa.array(times, pa.int64()))], names)

    key = F.unhex(F.sha2("text", 256))
    texts = docs.where("text != ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies")).select("text", key.alias("key"), "copies")
    path = shared_dir(docs.sparkSession, "alignment-texts")
    texts.mapInArrow(run, "key binary, copies long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, times array<long>"
                     ).write.parquet(path)
    return docs.select("doc_id", key.alias("key")), docs.sparkSession.read.parquet(path)


def _counts(texts: DataFrame) -> DataFrame:
    """(pair, count) over all documents."""
    each = texts.select("copies", F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    return each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum(F.col("p.times") * F.col("copies")).alias("count"))


def pair_counts(docs: DataFrame, text: str = "text", folder: str = FOLDER, a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """(a_id, b_id, count): how often A and B tokens end together, over all rows."""
    _, texts = _aligned(docs.select(F.lit(None).cast("long").alias("doc_id"), F.col(text).alias("text")), folder, a_file, b_file)
    width = len(Tokenizers(folder, a_file, b_file).b_words.tokens)
    return _counts(texts).select(F.expr(f"pair div {width}").alias("a_id"), F.expr(f"pair % {width}").alias("b_id"), "count")


def align(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", folder: str = FOLDER, a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """A row per input row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows, texts = _aligned(docs, folder, a_file, b_file)
    both = Tokenizers(folder, a_file, b_file)
    bound, width = pair_bound(both.a_words.tokens, both.b_words.tokens), len(both.b_words.tokens)
    path = shared_dir(spark, "alignment-pairs")
    _counts(texts).write.parquet(path)
    found = spark.read.parquet(path).toArrow()  # at most ``bound`` rows, whatever the corpus
    if found.num_rows > bound:
        raise RuntimeError(f"{found.num_rows} pairs of tokens, the vocabularies allow {bound}")
    pair, count = (found.column(c).to_numpy() for c in ("pair", "count"))
    order = np.argsort(pair)
    pair, count = pair[order], count[order]
    highest = np.zeros(width, np.int64)
    np.maximum.at(highest, pair % width, count)
    table = spark.sparkContext.broadcast((pair, count, count == highest[pair % width]))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, count, best = table.value
        for batch in batches:
            held, times = batch.column("pairs"), batch.column("times")
            size = held.value_lengths().to_numpy(zero_copy_only=False)
            at, times = np.searchsorted(pair, held.flatten().to_numpy()), times.flatten().to_numpy()
            ends = np.concatenate([[0], np.cumsum(size)])

            def total(values: np.ndarray) -> pa.Array:
                sums = np.concatenate([[0], np.cumsum(values)])
                return pa.array(np.diff(sums[ends]), pa.int64())

            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("key", "n_a", "n_b", "n_groups", "groups_sha256")], total(times), total(times * best[at]),
                 total(times * count[at])], ["key", "n_a", "n_b", "n_groups", "groups_sha256", "n_links", "n_best", "count_sum"])

    measures = texts.drop("copies").mapInArrow(
        measure, "key binary, n_a long, n_b long, n_groups long, groups_sha256 string, n_links long, n_best long, count_sum long")
    path = shared_dir(spark, "alignment-measures")  # a table of its own, so that the join with a hot text can be split
    measures.write.parquet(path)
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    return rows.join(spark.read.parquet(path), "key", "left").select(
        "doc_id", *zero, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
