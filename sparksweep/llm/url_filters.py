"""URL filters by a bit-parallel wildcard automaton.

Every glob becomes a row of states, one per literal byte and one for the
start; the rows of all globs are packed side by side into 64-bit words. One
step of the automaton reads a byte of the canonical URL and moves all states
of all globs at once (Shift-And with a carry between words); a batch of URLs is
stepped together. ``*`` stands for any run of bytes without ``/``, ``**`` for
any run; a glob must match the whole canonical URL, which is ``.`` + host +
path, so ``*.example.com/en/**`` is a host with its subdomains and a path prefix.

Site rules (``host/path``) are globs of that form; of those that fit, the
longest wins. Where no rule fits, the longest fitting glob of the filter list
decides (a tie blocks), and else the default.

Defined results: a null URL, or one without ``://``, has an empty host and
path; very long URLs are read whole; repeated rows are judged each on its own;
an empty table gives an empty result. Clashing column names of the input are
replaced by the operator's, other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparksweep.llm.batch import drop_columns, free_names, slices, utf8

RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/")]
GLOBS = [("block", "*cheap-pills.**"), ("block", "*spam-farm.**"), ("block", "*casino*.**"),
         ("block", "**/wp-login.php"), ("block", "**/cgi-bin/**")]
ADDED = ("host", "path", "rule", "globs", "verdict")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def site_glob(rule: str) -> str:
    host, _, path = rule.partition("/")
    return f"*.{host}/{path}**"


class WildcardAutomaton:
    """All globs in one set of masks; ``match`` returns a bool matrix (url, glob)."""

    def __init__(self, globs: list[str]):
        places, loops, accept, start = [], [], [], []
        at = 0
        for g in globs:
            start.append(at)
            for part in re.findall(r"\*\*|\*|[^*]+", g):
                if part[0] == "*":
                    loops.append((at, part))
                else:
                    for c in part.encode():
                        at += 1
                        places.append((at, c))
            accept.append(at)
            at += 1
        self.words = max(1, -(-at // 64))
        bit = lambda i: (i >> 6, np.uint64(1) << np.uint64(i & 63))
        self.move = np.zeros((256, self.words), np.uint64)  # a literal leads to this state
        self.stay = np.zeros((256, self.words), np.uint64)  # a wildcard keeps this state
        self.first = np.zeros(self.words, np.uint64)
        for i, c in places:
            w, b = bit(i)
            self.move[c, w] |= b
        for i, kind in loops:
            w, b = bit(i)
            self.stay[:, w] |= b
            if kind == "*":
                self.stay[ord("/"), w] &= ~b
        for i in start:
            w, b = bit(i)
            self.first[w] |= b
        self.accept = np.array(accept, np.int64)

    def match(self, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """buf: the URLs' bytes, offs: their bounds."""
        n, size = len(offs) - 1, np.diff(offs)
        order = np.argsort(-size, kind="stable")
        at, size = offs[:-1][order], size[order]
        state = np.tile(self.first, (n, 1))
        one, top = np.uint64(1), np.uint64(63)
        for step in range(int(size[0]) if n else 0):
            live = int(np.searchsorted(-size, -step, "left"))  # URLs longer than ``step``
            c, d = buf[at[:live] + step], state[:live]
            moved = d << one
            moved[:, 1:] |= d[:, :-1] >> top
            state[:live] = (moved & self.move[c]) | (d & self.stay[c])
        out = np.empty((n, len(self.accept)), bool)
        out[order] = (state[:, self.accept >> 6] >> (self.accept & 63).astype(np.uint64)) & one != 0
        return out


def judge(pages: DataFrame, url: str = "url", rules=RULES, globs=GLOBS, default: str = "allow") -> DataFrame:
    """Add host, path, rule (null if none fits), globs (those that match) and verdict."""
    u = F.col(url)
    host = F.regexp_extract(u, r"://([^/?#]*)", 1)
    path = F.regexp_extract(u, r"://[^/?#]*([^?#]*)", 1)
    base = drop_columns(pages, ADDED).withColumns({
        "host": F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), "path": F.coalesce(path, F.lit(""))})
    canonical, = free_names(base.columns, "canonical")
    base = base.withColumn(canonical, F.concat(F.lit("."), F.col("host"), F.col("path")))
    schema = T.StructType([f for f in base.schema.fields if f.name != canonical] + [
        T.StructField("rule", T.StringType()), T.StructField("globs", T.ArrayType(T.StringType())),
        T.StructField("verdict", T.StringType())])
    rules, globs = list(rules), list(globs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = WildcardAutomaton([site_glob(r) for _, r in rules] + [g for _, g in globs])
        by_length = sorted(range(len(rules)), key=lambda i: len(rules[i][1]))
        for batch in slices(batches, canonical):
            hits = masks.match(*utf8(batch.column(canonical)))
            best = np.full(len(hits), -1)
            for i in by_length:  # the longest comes last
                best[hits[:, i]] = i
            rule, found, verdict = [], [], []
            for row, b in zip(hits[:, len(rules):], best.tolist(), strict=True):
                fit = [globs[j] for j in np.flatnonzero(row)]
                rule.append(rules[b][1] if b >= 0 else None)
                found.append([g for _, g in fit])
                verdict.append(rules[b][0] if b >= 0 else
                               max(fit, key=lambda x: (len(x[1]), x[0] == "block"))[0] if fit else default)
            names = [f.name for f in schema.fields]
            cols = [batch.column(f) for f in names[:-3]]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(rule, pa.string()), pa.array(found, pa.list_(pa.string())),
                 pa.array(verdict, pa.string())], names)

    return base.mapInArrow(run, schema)
