"""Merkle manifest of a dataset: one tree per language, one tree over their roots.

H is the lowercase hex SHA-256 of its inputs, concatenated (digests as hex text). A row's leaf is H
of its fields in order, each ``-`` if null, else its UTF-8 byte count, ``:`` and its value.
The leaves of a language ascend by id; every ``FAN`` consecutive nodes (the last run
may be shorter) become their H until one, the subroot, remains. The subroots, ordered by language (null
first, bytewise), are reduced in the same way to the root.

Cogrouped subtree exchange:

1. Leaves are range partitioned by (language, id) and written once; a leaf's place within its language
   comes from counts per file partition and language, so a language may hold all rows.
2. A superblock is an aligned run of ``FAN ** LEVELS`` leaves. Its local reduction gives one node.
3. Above the superblocks a level is a shuffle by run of eight nodes; what is left is the subroot of each
   language, and above them the root. On the way down each node gets its outer runs (own run, then its
   ancestors'): a join by parent with eight children at most, so no key is hot.
4. Leaves and their superblock's outer nodes are cogrouped by superblock: each group reduces its leaves
   again, joins their local siblings with the outer ones to proofs, and folds every leaf to a root. Full
   proofs, of about 450 bytes a level, leave the task only with ``keep_proofs``; else a row carries their H.

A kept proof and ``fold`` check a single row without the others.

Defined results: rows without id come first in their language; rows of equal language and id are
ordered by leaf, and identical rows are interchangeable; empty text is ``0:``; a language of one
row has that leaf as its subroot, and a table of one language that subroot as its root; a proof without siblings is H
of nothing; an empty table gives an empty result. Fields are hashed whole, by Spark's functions. Only the
fields, the language and the id are read, so other columns can't clash.
"""

from __future__ import annotations

import hashlib
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparksweep.session import shared_dir

FAN = 8
LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<place:int,nodes:array<string>>>"


def H(parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(fields: list[Column]) -> Column:
    """The leaf of a row: H of its fields, each with its byte count."""
    def one(c: Column) -> Column:
        c = c.cast("string")
        return F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c))
    return F.sha2(F.concat(*[one(c) for c in fields]), 256)


def reduce_run(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes of each level, from ``nodes`` up; a single node is hashed on until ``levels`` is reached."""
    out = [nodes]
    for _ in range(levels):
        now = out[-1]
        out.append([H(now[i: i + FAN]) for i in range(0, len(now), FAN)])
    return out


def fold(node: str, path: list[tuple[int, list[str]]]) -> str:
    """The root that follows from a leaf and the runs it lies in: (its place, the run's nodes)."""
    for place, nodes in path:
        node = H([*nodes[:place], node, *nodes[place + 1:]])
    return node


def siblings(path: list[tuple[int, list[str]]]) -> list[str]:
    return [n for place, nodes in path for i, n in enumerate(nodes) if i != place]


def height(n: int) -> int:
    """Levels above ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def _written(df: DataFrame, name: str) -> DataFrame:
    path = shared_dir(df.sparkSession, f"merkle-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _placed(leaves: DataFrame, order: list) -> DataFrame:
    """With ``pos``, the place within its ``tree`` in the given order, and ``n``, the tree's size. Written first, so that
    counting and numbering see the same partitions."""
    ranged = leaves.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    # an id is its partition's number times 2**33 plus the row's place in it
    held = _written(ranged.withColumn("row", F.monotonically_increasing_id()), "rows").withColumn("part", F.shiftright("row", 33))
    counts = held.groupBy("tree", "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("here"))
    tree = Window.partitionBy("tree")  # a row per partition of the range shuffle
    starts = _written(counts.withColumns({
        "n": F.sum("here").over(tree),
        "before": F.sum("here").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("here")}), "starts")
    return held.join(starts, ["tree", "part"]).withColumn("pos", F.col("before") + F.col("row") - F.col("first")).drop(
        "row", "part", "first", "before", "here")


def _climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The runs (tree, run, nodes) of each level above nodes (tree, pos, size, digest), and the roots (tree, digest)."""
    levels, roots = [], nodes.where("size = 1").select("tree", "digest")
    now, most = nodes.where("size > 1"), nodes.agg(F.max("size")).first()[0] or 0
    while most > 1:
        run = F.array_sort(F.collect_list(F.struct("pos", "digest")))["digest"]
        runs = _written(now.groupBy("tree", F.expr(f"pos div {FAN}").alias("run"), "size").agg(run.alias("nodes")), f"runs-{len(levels)}")
        levels.append(runs.select("tree", "run", "nodes"))
        up = runs.select("tree", F.col("run").alias("pos"), F.expr(f"(size + {FAN - 1}) div {FAN}").alias("size"),
                         F.sha2(F.array_join("nodes", ""), 256).alias("digest"))
        roots = roots.unionByName(up.where("size = 1").select("tree", "digest"))
        now, most = up.where("size > 1"), -(-most // FAN)
    return levels, roots


def _descend(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Nodes (tree, pos, path, ...) of the lowest level, from the trees' tops (tree, path, ...)."""
    done = tops.withColumn("pos", F.lit(0).cast("long"))
    rest = [c for c in tops.columns if c not in ("tree", "path")]
    for runs in reversed(levels):  # a lower tree has no run at this level and stays at place 0
        met = done.join(runs.withColumnRenamed("run", "pos"), ["tree", "pos"], "left")
        met = met.select("tree", "pos", "path", "nodes", *rest, F.posexplode(F.coalesce("nodes", F.array(F.lit("")))).alias("place", "node"))
        own = F.array(F.struct("place", "nodes"))
        done = met.select("tree", F.when(F.col("nodes").isNull(), F.col("pos")).otherwise(F.col("pos") * FAN + F.col("place")).alias("pos"),
                          F.when(F.col("nodes").isNull(), F.col("path")).otherwise(F.concat(own, "path")).cast(_PATH).alias("path"), *rest)
    return done


def manifest(docs: DataFrame, fields=FIELDS, doc_id: str = "doc_id", lang: str = "lang", suspect: tuple[Column, ...] | None = None,
             levels: int = LEVELS, keep_proofs: bool = False) -> DataFrame:
    """A row per input row: doc_id, lang, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``suspect``: fields as they are found on checking (by default as given): folded_root is what they fold to.
    ``keep_proofs`` adds proof: the runs from the leaf up, as (place, the run's nodes)."""
    given = leaf([F.col(f) for f in fields])
    tree = F.coalesce(F.concat(F.lit("="), F.col(lang).cast("string")), F.lit(""))  # in the order of the languages, null first
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), tree.alias("tree"), given.alias("leaf"),
                       (leaf(list(suspect)) if suspect else given).alias("found"))
    block = FAN ** levels
    # ids go through pandas as text: beside a null they would become floats
    leaves = _written(_placed(rows, [F.col("id").asc_nulls_first(), "leaf"]).withColumns(
        {"block": F.expr(f"pos div {block}"), "id": F.col("id").cast("string")}), "leaves")

    def local(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pos")
        steps = min(levels, height(int(part["n"].iloc[0])))
        top = reduce_run(part["leaf"].tolist(), steps)[-1][0]
        return pd.DataFrame({"tree": [part["tree"].iloc[0]], "pos": [part["block"].iloc[0]], "n": [part["n"].iloc[0]], "digest": [top]})

    blocks = leaves.groupBy("tree", "block").applyInPandas(local, "tree string, pos long, n long, digest string")
    blocks = _written(blocks.withColumn("size", F.expr(f"(n + {block - 1}) div {block}")), "blocks")
    inner, subroots = _climb(blocks)
    subroots = subroots.select(F.lit("root").alias("tree"), F.col("tree").alias("lang"), "digest")
    subroots = _written(_placed(subroots, ["lang"]).withColumnRenamed("n", "size"), "subroots")
    outer, root = _climb(subroots)
    tops = _descend(outer, root.select("tree", F.array().cast(_PATH).alias("path"), F.col("digest").alias("root")))
    tops = subroots.join(tops, ["tree", "pos"]).select(F.col("lang").alias("tree"), "path", F.col("digest").alias("subroot"), "root")
    paths = _written(_descend(inner, tops).withColumnRenamed("pos", "block"), "paths")

    def finish(mine: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        mine = mine.sort_values("pos")
        first = above.iloc[0]
        upper = [(int(step["place"]), list(step["nodes"])) for step in first["path"]]
        rest, root = siblings(upper), first["root"]
        rows = reduce_run(mine["leaf"].tolist(), min(levels, height(int(mine["n"].iloc[0]))))
        proofs, folded, kept = [], [], []
        for at, found in enumerate(mine["found"]):
            path = [(at // FAN**k % FAN, row[at // FAN**k // FAN * FAN: (at // FAN**k // FAN + 1) * FAN]) for k, row in enumerate(rows[:-1])]
            proofs.append(H(siblings(path) + rest))
            folded.append(fold(found, path + upper))
            kept.append([{"place": p, "nodes": n} for p, n in path + upper] if keep_proofs else None)
        out = pd.DataFrame({"doc_id": mine["id"], "tree": mine["tree"], "leaf": mine["leaf"], "subroot": first["subroot"], "root": root,
                            "proof_sha256": proofs, "folded_root": folded, "verified": [f == root for f in folded]})
        if keep_proofs:
            out["proof"] = kept
        return out

    schema = ("doc_id string, tree string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
              + (f", proof {_PATH}" if keep_proofs else ""))
    done = leaves.groupBy("tree", "block").cogroup(paths.groupBy("tree", "block")).applyInPandas(finish, schema)
    tree = F.when(F.col("tree") != "", F.substring("tree", 2, 2**31 - 1))
    return done.select(F.col("doc_id").cast("long").alias("doc_id"), tree.alias("lang"), *done.columns[2:])
