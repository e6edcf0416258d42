"""Cross-tokenizer alignment against a plain Python version."""

import hashlib
import random
from collections import Counter

import pytest
from tokenizers import Tokenizer

from sparksweep.llm import queries, token_alignment


@pytest.fixture(scope="module")
def both():
    found = token_alignment.Tokenizers()
    found.plain = Tokenizer.from_file(f"{token_alignment.FOLDER}/{token_alignment.A_FILE}")  # A by the library of its file
    found.plain.encode_special_tokens = True
    return found


def ends(sizes):
    out, at = [], 0
    for n in sizes:
        at += n
        out.append(at)
    return out


def plain(rows, both):
    """The contract, one token at a time."""
    a_char = token_alignment.byte_alphabet()
    names = {i: t for t, i in both.plain.get_vocab().items()}
    docs = []
    for d, text in rows:
        raw = b" " + (text or "").encode()
        a = both.plain.encode(raw.decode(), add_special_tokens=False).ids if text else []
        b = both.b.encode(text) if text else []
        a_raw = [bytes(a_char[c] for c in names[i]) for i in a]
        pieces = [both.b.id_to_piece(i) for i in b]
        b_raw = [bytes([int(p[3:5], 16)]) if both.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces, strict=True)]
        if not text or b"".join(a_raw) != raw or b"".join(b_raw) != raw:
            docs.append((d, [], [], []))
            continue
        a_end, b_end = ends(map(len, a_raw)), ends(map(len, b_raw))
        common = sorted(set(a_end) & set(b_end))
        ends_b = dict(zip(b_end, b, strict=True))
        links = [(x, ends_b[e]) for x, e in zip(a, a_end, strict=True) if e in ends_b]
        groups, i, j = [], 0, 0
        for c in common:
            p, q = i, j
            while i < len(a) and a_end[i] <= c:
                i += 1
            while j < len(b) and b_end[j] <= c:
                j += 1
            groups.append((a[p:i], b[q:j]))
        docs.append((d, a, b, groups, links))
    count = Counter(pair for x in docs if x[1] for pair in x[4])
    highest = {}
    for (_, y), n in count.items():
        highest[y] = max(highest.get(y, 0), n)
    out = []
    for x in docs:
        if not x[1]:
            out.append((x[0], 0, 0, 0, 0, 0, 0, ""))
            continue
        d, a, b, groups, links = x
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        out.append((d, len(a), len(b), len(groups), len(links), sum(count[k] == highest[k[1]] for k in links), sum(count[k] for k in links),
                    hashlib.sha256(text.encode()).hexdigest()))
    return out


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def same(got, rows, both):
    assert sorted(map(tuple, got.select(*COLUMNS).collect()), key=repr) == sorted(plain(rows, both), key=repr)


def test_alignment(spark, both):
    rng = random.Random(2)
    word = lambda: rng.choice(["the", "Straße", "tokenizer", "naïve", "漢字", "😀", "foo_bar", "1234", "é", " ", "<s>", "</s>", "<unk>", "<|endoftext|>", "<0x0A>", "Ġ"])
    rows = [(i, rng.choice([" ", "  ", "\n", "\t"]).join(word() for _ in range(rng.randrange(1, 40)))) for i in range(120)]
    rows += [(1000, None), (1001, ""), (1002, " "), (1003, "\n"), (1004, "a▁b"), (1005, "\x00\x01"), (1006, "<0x41>"), (1007, "́ combining"),
             (1008, "long text, " * 20000), (1009, "a" * 3000), (None, "no id"), (None, None), (1010, "the"), (1011, "the"), (1012, " the")]
    rows += [(2000 + i, rows[5][1]) for i in range(30)] + [rows[3], rows[3]]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, key string, copies int").repartition(6)
    same(token_alignment.align(df), rows, both)
    assert token_alignment.align(df.where("false")).count() == 0
    pairs = token_alignment.pair_counts(df.where("doc_id in (1010, 1011)")).collect()
    assert [(both.a_words.tokens[p["a_id"]], both.b_words.tokens[p["b_id"]], p["count"]) for p in pairs] == [(b" the", b" the", 2)]


def test_query(spark, sf_dir, both):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    same(queries.QUERIES["op11_token_alignment"](spark, sf_dir), rows, both)


def test_bound_of_pairs(both):
    assert token_alignment.pair_bound([b"a", b"ba", b"c"], [b"a", b"cba", b"x"]) == 4  # a-a, ba-a, a-cba, ba-cba
    assert token_alignment.pair_bound(both.a_words.tokens, both.b_words.tokens) < 1_000_000


def test_every_character_is_cut_alike(both):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 50000):
        texts = [f"a{chr(c)} {chr(c)}1{chr(c)}{chr(c)}b  {chr(c)}  " for c in points[at: at + 50000]]
        for text, ids in zip(texts, both.plain.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            assert both.a.encode_ordinary(text) == ids.ids, ascii(text)


def test_every_token_is_one_token(both):
    # so that ranks and merges agree: no token is ever merged from other parts than its own merge's
    assert all(both.a._encode_single_piece(t) == [i] for i, t in enumerate(both.a_words.tokens))
