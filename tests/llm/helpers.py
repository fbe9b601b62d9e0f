"""Small tables with every awkward row, and brute-force versions."""

from __future__ import annotations

import re

import xxhash
from pyspark.sql import functions as F

SF001 = "/root/testdata/sf0.001"
CLASHING = ("fp", "id", "u", "v", "h", "chunk", "bucket", "component_id", "items", "n", "row", "spans", "label2", "text_2", "k")


def documents(spark, rows, clash=True):
    """Documents from (doc_id, text[, lang[, source]]) tuples, with extra columns."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASHING}) if clash else df


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_fingerprint(text, n=4):
    words = plain_words(ascii_lower(text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]).encode(), 42) for i in range(max(1, len(words) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def union_find(ids, pairs):
    """Least id reachable from each id."""
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def brute_removed(items, length, earlier):
    """For (order, tokens) items the removed token places: windows that also
    start elsewhere, or (``earlier``) in an item of a smaller order."""
    where = {}
    for i, (order, tokens) in enumerate(items):
        for s in range(len(tokens) - length + 1):
            where.setdefault(tuple(tokens[s : s + length]), []).append((order, i, s))
    out = []
    for i, (order, tokens) in enumerate(items):
        gone = [False] * len(tokens)
        for s in range(len(tokens) - length + 1):
            starts = where[tuple(tokens[s : s + length])]
            if (min(o for o, _, _ in starts) < order) if earlier else len(starts) > 1:
                gone[s : s + length] = [True] * length
        out.append(gone)
    return out
