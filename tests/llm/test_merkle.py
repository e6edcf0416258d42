"""Merkle manifest against a plain Python version."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from sparksweep.llm import merkle_manifest
from tests.llm.helpers import SCHEMA, lower


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    d, text, lang, source, n = row
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (d, source, lang, n, text)])


def tree(nodes):
    """(root, siblings of each node level by level as (left, right))."""
    paths = [[] for _ in nodes]
    where = list(range(len(nodes)))
    while len(nodes) > 1:
        for i, w in enumerate(where):
            run = w // 8 * 8
            paths[i].append((nodes[run:w], nodes[w + 1:run + 8]))
            where[i] = w // 8
        nodes = [H(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def plain_manifest(rows):
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    for v in by.values():
        v.sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
    subs = {x: tree([plain_leaf(r) for r in by[x]]) for x in langs}
    root, tops = tree([subs[x][0] for x in langs])
    out = []
    for x, top in zip(langs, tops, strict=True):
        for r, path in zip(by[x], subs[x][1], strict=True):
            full = path + top
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            node = plain_leaf((r[0], lower(r[1]) if r[1] is not None else None, *r[2:]) if hit else r)
            for a, b in full:
                node = H(*a, node, *b)
            out.append((r[0], plain_leaf(r), subs[x][0], root, H(*[n for a, b in full for n in a + b]), node, node == root))
    return out


def result(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"tree": F.lit("x"), "POS": F.lit(1), "leaf": F.lit(None)}).repartition(4)
    low = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.translate(
        "text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))
    suspect = tuple(low if f == "text" else F.col(f) for f in merkle_manifest.FIELDS)
    return merkle_manifest.manifest(df, suspect=suspect, **kw)


def fixture(sizes, seed=1):
    rng = random.Random(seed)
    rows, ids = [], iter(rng.sample(range(10**15), sum(sizes.values())))
    for lang, n in sizes.items():
        rows += [(next(ids), rng.choice(["Text A", "all small", "ÄÖ", "", None, "L" * 50000]), lang, rng.choice(["s", None]), rng.choice([None, 5]))
                 for _ in range(n)]
    return rows


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@pytest.mark.parametrize("sizes,levels", [
    ({"en": 700, None: 9, "de": 1, "é": 8, "": 65, "Z": 64, "zz": 2, "a": 3, "b": 1, "c": 1}, 1),
    ({"en": 700, None: 9, "de": 1, "": 65, "=": 5}, 2), ({"en": 300}, 4), ({"en": 1}, 4), ({None: 1, "x": 1}, 4)])
def test_manifest(spark, sizes, levels):
    rows = fixture(sizes)
    if len(rows) > 100:  # null ids, one id twice, identical rows
        rows += [(None, "no id", "en", None, None), (None, None, None, None, None), (rows[0][0], "Other", "en", "s", 1), rows[1], rows[1]]
    got = result(spark, rows, levels=levels).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(plain_manifest(rows), key=repr)


def test_proofs_check_rows_one_by_one(spark):
    rows = fixture({"en": 100, "de": 10}, 3)
    leaves = {r[0]: plain_leaf(r) for r in rows}
    got = result(spark, rows, levels=1, keep_proofs=True).collect()
    for r in got:
        path = [(p["place"], p["nodes"]) for p in r["proof"]]
        assert merkle_manifest.fold(leaves[r["doc_id"]], path) == r["root"]
        assert merkle_manifest.fold(H("other"), path) != r["root"]
        assert H(*merkle_manifest.siblings(path)) == r["proof_sha256"]


def test_untampered_rows_verify_and_empty_table(spark):
    df = spark.createDataFrame(fixture({"en": 20}), SCHEMA)
    assert {r["verified"] for r in merkle_manifest.manifest(df).collect()} == {True}
    assert merkle_manifest.manifest(df.where("false")).count() == 0
