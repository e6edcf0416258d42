"""Small fixtures and plain Python versions of the operators' definitions."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows, schema=SCHEMA):
    """rows: (doc_id, text[, source[, lang]])."""
    full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "s0", len(r[1]) if r[1] is not None else None)
            for r in rows]
    return spark.createDataFrame(full, schema)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def shingle_set(text):
    w = alnum_words(text)
    return {tuple(w[i: i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near_groups(rows):
    """rows: [(id, text)] -> {place: (smallest id of its group, links)}."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    links = Counter()
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both * 10 >= 8 * (len(sets[i]) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                root[max(top(i), top(j))] = min(top(i), top(j))
    low = {}
    for i, (d, _) in enumerate(rows):
        low[top(i)] = min(low.get(top(i), d), d)
    return {i: (low[top(i)], links[i]) for i in range(len(rows))}


def repeated_bytes(texts, size=200):
    """Per text: (bytes, removed, runs, hash of what is left)."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[p: p + size] for b in raw for p in range(len(b) - size + 1))
    out = []
    for b in raw:
        cover = bytearray(len(b))
        for p in range(len(b) - size + 1):
            if seen[b[p: p + size]] > 1:
                cover[p: p + size] = b"\x01" * size
        kept = bytes(x for x, c in zip(b, cover, strict=True) if not c)
        out.append((len(b), sum(cover), len(re.findall(rb"\x01+", bytes(cover))), hashlib.sha256(kept).hexdigest()))
    return out


def crc(doc_id, divisor):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % divisor
