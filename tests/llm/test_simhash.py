"""SimHash near-duplicates against a plain Python version."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from sparksweep.llm import queries, simhash_dedup
from tests.llm.helpers import lower


def plain_print(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    shingles = [" ".join(w[i: i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    bits = Counter()
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), seed=42)
        bits.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(shingles))


def plain_components(rows, prints, radius=4):
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[max(top(i), top(j))] = min(top(i), top(j))
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[top(i)] = min(ids.get(top(i), d), d)
    return [ids.get(top(i)) for i in range(len(rows))]


def expected(rows):
    prints = [plain_print(t) for _, t in rows]
    return sorted(((d, f"{p:016x}", c) for (d, _), p, c in zip(rows, prints, plain_components(rows, prints), strict=True)), key=repr)


def fixture():
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(3000)}"
    rows = []
    for _ in range(8):
        base = [word() for _ in range(300)]
        for copy in range(12):
            w = list(base)
            for _ in range(copy // 2):
                w[rng.randrange(len(w))] = word()
            rows.append((5000 - len(rows), rng.choice([" ", "\t", " \n "]).join(w)))
    rows += [(7000 + i, " ".join(word() for _ in range(rng.randrange(1, 9)))) for i in range(150)]
    rows += [(1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "one"), (6, "a b c"), (7, "a b c d"), (8, "ÄÖ é 漢字 x"), (9, "a\x0bb\x0cc"),
             (10, "long text " * 30000), (11, "tie tie tie tie tie"), (None, "a b c"), (None, "no id at all in here"), (12, "a\xa0b")]
    return [*rows, rows[0], rows[0]]


@pytest.mark.parametrize("chunk,size", [(131072, 512), (16, 4)])
def test_components(spark, chunk, size):
    rows = fixture()
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, print string, component_id int").repartition(5)
    got = simhash_dedup.near_duplicates(df, chunk=chunk, size=size)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)


def test_empty_table_and_other_names(spark):
    df = spark.createDataFrame([(3, "a b")], "k int, body string")
    assert simhash_dedup.near_duplicates(df, "body", "k").first()["component_id"] == 3
    assert simhash_dedup.near_duplicates(df.where("false"), "body", "k").count() == 0


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op12_simhash_dedup"](spark, sf_dir)
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)


def test_prints_of_long_texts_in_blocks(monkeypatch):
    rng = random.Random(9)
    texts = [" ".join(f"v{rng.randrange(400)}" for _ in range(n)) for n in (0, 3, 4, 700, 1, 2000, 255, 258)]
    monkeypatch.setattr(simhash_dedup, "HASH_BLOCK", 100)
    assert simhash_dedup.simhash(pa.array(texts)).tolist() == [plain_print(t) for t in texts]


def test_every_pair_within_the_radius_is_found():
    rng = np.random.default_rng(3)
    near = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    prints = [near]
    for _ in range(6):  # copies at 1 to 6 differing bits
        flips = np.zeros(40, np.uint64)
        for _ in range(rng.integers(1, 7)):
            flips |= np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64)
        prints.append(near ^ flips)
    prints = np.unique(np.concatenate(prints))
    u, v = simhash_dedup.compare(simhash_dedup.tiles(prints, 7), None)
    root = {int(p): int(p) for p in prints}
    for a, b in zip(u.tolist(), v.tolist(), strict=True):
        root[a] = b
    plain = plain_components([(i, None) for i in range(len(prints))], [int(p) for p in prints])
    groups = Counter(root.values())
    assert sorted(groups.values()) == sorted(Counter(plain).values())
    half = len(prints) // 2  # and between two chunks
    u2, v2 = simhash_dedup.compare(simhash_dedup.tiles(prints[:half], 7), simhash_dedup.tiles(prints[half:], 7))
    assert all(any((a ^ int(p)).bit_count() <= 4 for p in prints if int(p) != a) for a in u2.tolist()) and len(u2) == len(v2)
