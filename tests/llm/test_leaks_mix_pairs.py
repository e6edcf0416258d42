"""Decontamination, mixing, n-gram Jaccard join."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from sparksweep.llm import decontamination, jaccard_join, mixing
from tests.llm.helpers import alnum_words, docs, near_groups


def plain_leaks(text, items):
    words = alnum_words(text)
    hit, found = set(), set()
    for item, t in items:
        w = alnum_words(t)
        n = min(10, len(w))
        grams = {tuple(w[i: i + n]) for i in range(len(w) - n + 1)} if w else set()
        for i in range(len(words) - n + 1):
            if grams and tuple(words[i: i + n]) in grams:
                hit |= set(range(i, i + n))
                found.add("null" if item is None else str(item))
    ids = sorted(found)
    return len(words), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)


@pytest.fixture(scope="module")
def leaks():
    rng = random.Random(11)
    word = lambda: rng.choice(["alpha", "Beta", "gamma", "délta", "Épsilon", "zeta9", "ß", "eta", "x"])
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([25, 12, 10, 3, 2, 0, 30])]
    items += [(7, None), (8, "..."), (None, "a null id item"), items[1], (20, "shared " + items[0][1])]
    texts = [None, "", "!!!", items[0][1], "A; " + items[0][1].replace(" ", " -- ").upper() + " end", items[2][1] + " " + items[2][1],
             " ".join(word() for _ in range(400)), "a NULL id... item", "x" * 50000, "word " * 20000 + items[1][1]]
    texts += [" ".join([*(word() for _ in range(20)), *items[6][1].split()[3:15], *(word() for _ in range(9))]) for _ in range(8)]
    return items, [*texts, texts[3]]


@pytest.mark.parametrize("block_bytes", [1 << 18, 60])
def test_leaks(spark, leaks, block_bytes):
    items, texts = leaks
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame([(i, t, "mine") for i, t in enumerate(texts)], "doc_id int, text string, SPANS string")
    found = decontamination.find_items(df, bench, block_bytes=block_bytes)
    rows = {r["doc_id"]: r for r in decontamination.digest(found).collect()}
    for i, t in enumerate(texts):
        r = rows[i]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == plain_leaks(t, items), i
        inside = sum(len(alnum_words(t[s["start"]: s["end"]])) for s in r["spans"])
        assert inside == r["n_hit"]
        assert all(a["end"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:]))


def test_leaks_of_empty_tables(spark, leaks):
    items, texts = leaks
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = docs(spark, [(i, t) for i, t in enumerate(texts)])
    assert decontamination.find_items(df, bench.where("false")).where("n_hit > 0 or size(items) > 0").count() == 0
    assert decontamination.find_items(df.where("false"), bench).count() == 0


def poisson(u, rate):
    k, p = 0, math.exp(-rate)
    c = p
    while c <= u:
        k += 1
        p *= rate / k
        c += p
    return k


def test_mix_draws_and_order(spark):
    rows = [(i, "text " * (1 + i % 7), ("hot", "mid", "rare", None)[min(3, i % 40)] if i % 40 < 4 else "hot") for i in range(2000)]
    rows += [(None, "no id", "mid"), (None, None, "rare"), (5000, "", "void"), (7, rows[7][1], "hot"), (5001, "z" * 100000, "mid")]
    df = docs(spark, rows).withColumn("RATE", F.lit("old"))
    got = mixing.mix_sources(df)
    assert sorted(got.columns) == sorted(["doc_id", "text", "lang", "source", "n_chars", "rate", "copy_no", "shuffle_key"])
    out = got.collect()
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len(t or "")
    scale = sum(size.values()) / sum(math.sqrt(v) for v in size.values())
    rate = {s: round(math.sqrt(v) * scale / v, 9) if v else 1.0 for s, v in size.items()}
    expected = []
    for d, t, s in rows:
        key = str(d) if d is not None else "text:" + hashlib.md5((t or "").encode()).hexdigest()
        u = int(hashlib.md5(f"mix-1:{key}".encode()).hexdigest()[:13], 16) / (1 << 52)
        expected += [(d, t, s, c + 1) for c in range(poisson(u, rate[s]))]
    assert sorted([(r["doc_id"], r["text"], r["source"], r["copy_no"]) for r in out], key=repr) == sorted(expected, key=repr)
    keys = [r["shuffle_key"] for r in got.where("doc_id is not null and doc_id != 7").collect()]
    assert len(set(keys)) == len(keys)
    for part in got.select("shuffle_key").rdd.glom().collect():  # each partition is in the order of the key
        assert part == sorted(part)
    again = mixing.mix_sources(df.repartition(5)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, out))
    assert mixing.mix_sources(df.where("false")).count() == 0


def test_mix_to_given_weights(spark):
    df = spark.range(30000).selectExpr("id as doc_id", "'0123456789' as text", "if(id % 10 = 0, 'a', if(id % 10 = 1, 'b', 'c')) as source")
    got = {r["source"]: r["count"] for r in mixing.mix_sources(df, weights={"a": 3.0, "b": 1.0}, total=0.5).groupBy("source").count().collect()}
    assert "c" not in got  # no weight
    assert abs(got["a"] / 11250 - 1) < 0.05 and abs(got["b"] / 3750 - 1) < 0.07


def test_large_rates_have_their_mean_and_spread(spark):
    df = spark.range(4000).selectExpr("id as doc_id", "'x' as text", "if(id < 2000, 'a', 'b') as source")
    got = mixing.mix_sources(df, weights={"a": 1.0}, total=1500.0).groupBy("doc_id").agg(F.count("*").alias("n")).agg(
        F.count("*").alias("docs"), F.avg("n").alias("mean"), F.variance("n").alias("var")).first()
    assert got["docs"] == 2000 and abs(got["mean"] / 3000 - 1) < 0.01 and abs(got["var"] / 3000 - 1) < 0.15


def near_rows():
    rng = random.Random(13)
    word = lambda: f"w{rng.randrange(5000)}"
    rows = []
    for family in range(6):
        base = [word() for _ in range(rng.choice([30, 80, 200]))]
        for copy in range(14):
            w = list(base)
            for _ in range(copy // 2 if family < 4 else rng.randrange(4)):
                w[rng.randrange(len(w))] = word()
            rows.append((1000 - len(rows), " ".join(w)))
    rows += [(2000 + i, " ".join(word() for _ in range(rng.randrange(1, 60)))) for i in range(40)]
    rows += [(1, None), (2, ""), (3, "?! ..."), (4, "Two words"), (5, "two, WORDS"), (6, "one"), (7, "a b c d e"), (8, "A-B-C-D-E"),
             (9, "a b c d e f"), (11, "long " * 20000), (12, "long " * 20001)]
    return [*rows, rows[0], rows[0], (4000, rows[3][1].upper())]


@pytest.mark.parametrize("block", [jaccard_join.BLOCK, 4096])
def test_links_and_groups(spark, block):
    rows = near_rows()
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, class_id string").repartition(5)
    got = sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard_join.link(df, block=block).collect())
    plain = near_groups(rows)
    assert got == sorted((d, plain[i][0], plain[i][1]) for i, (d, _) in enumerate(rows))


def test_rows_of_units_grow_with_the_group(spark, monkeypatch):
    rng = random.Random(17)
    base = [f"w{rng.randrange(9999)}" for _ in range(60)]
    seen = []
    real = jaccard_join._units
    monkeypatch.setattr(jaccard_join, "_units", lambda *a: seen.append(real(*a)) or seen[-1])
    for n in (500, 2000):  # near copies of one text: each differs in its last word
        df = spark.createDataFrame([(i, " ".join([*base, f"x{i}"])) for i in range(n)], "doc_id long, text string")
        assert {tuple(r) for r in jaccard_join.link(df).select("class_id", "n_links").distinct().collect()} == {(0, n - 1)}
    few, many = (u.count() for u in seen)
    assert many <= 5 * few and many < 20_000


def test_one_of_each_group_stays(spark):
    rows = near_rows() + [(None, rows_text := "only nulls here " * 9), (None, rows_text)]
    df = docs(spark, rows)
    kept = jaccard_join.one_of_each(df)
    assert kept.columns == df.columns
    plain = near_groups([(10**9 if d is None else d, t) for d, t in rows])
    assert sorted(r["doc_id"] or 10**9 for r in kept.collect()) == sorted({g for g, _ in plain.values()})
    assert jaccard_join.one_of_each(df.where("false")).count() == 0


def test_one_of_each_keeps_columns_of_any_name(spark):
    rows = [(i, "the same text for all of them here", f"v{i}", i) for i in (3, 1, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _id string, __TH int")
    assert [tuple(r) for r in jaccard_join.one_of_each(df).collect()] == [(1, "the same text for all of them here", "v1", 1)]


def test_components_of_a_long_chain(spark):
    n = 200
    edges = spark.createDataFrame([((i * 7919) % 1009, ((i + 1) * 7919) % 1009) for i in range(n)], "u long, v long")
    got = jaccard_join.components(spark, edges).collect()
    low = min((i * 7919) % 1009 for i in range(n + 1))
    assert len(got) == n and {r["v"] for r in got} == {low}


def test_pruning_bound():
    least = jaccard_join.least_matches()
    assert least[128] < 0.8 * 128 and all(least[k] <= k for k in least)
    # a pair at the threshold falls below the bound in any round with a probability of about the tolerance
    miss = sum(sum(math.comb(k, m) * 0.8**m * 0.2 ** (k - m) for m in range(least[k])) for k in least)
    assert miss < 1e-6
