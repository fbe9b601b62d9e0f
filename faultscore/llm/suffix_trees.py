"""Operator 2: substring deduplication by prefix-partitioned suffix trees.

A window is 35 consecutive words of one text.  Every word covered by a window
whose word sequence also starts at any other place, in the same text or
another, is removed; windows are judged on the input.

Windows that cannot repeat are set aside by their anchors (``repeats``); the
other suffixes meet in the partition of their anchor (those of a hot anchor in
that of their whole window, which decides them).  There variable-length
prefixes split them into groups that fit in memory: a group of over ``GROUP``
suffixes is split by its next word, again and again, up to the window's
length.  Each group's suffixes then form a subtree, built downward, a few
words an edge; its internal nodes at the window's depth are the repeated
windows, and the places below a node their starts.

Defined results: words are runs of characters other than \\x20 and \\x09-\\x0D;
null and empty texts have no word and the hash of the empty string; texts
under 35 words lose nothing; repeated rows are copies of each other; a null
doc_id is a text like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import repeats
from .chunks import ask, bucket_count, pack, unpack, replies_of, with_replies

WINDOW = 35
ANCHOR = 8
#: Words of an edge that are compared at once.
EDGE = 5
#: Suffixes of a subtree at most (unless they are all one node).
GROUP = 1 << 17
BYTES_PER_BUCKET = 8 << 20
WORD_BYTES = 6


def _children(node: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, int]:
    """A number per (node, label)."""
    order = np.lexsort((label, node))
    n, l = node[order], label[order]
    fresh = np.r_[True, (n[1:] != n[:-1]) | (l[1:] != l[:-1])]
    out = np.empty(len(node), dtype=np.int64)
    out[order] = np.cumsum(fresh) - 1
    return out, int(fresh.sum())


def prefix_groups(tokens: np.ndarray, suffix: np.ndarray, depth: int, most: int = GROUP) -> tuple[np.ndarray, np.ndarray]:
    """(group of each suffix, prefix length of each group): prefixes of the
    least length that leaves at most ``most`` suffixes, ``depth`` at most."""
    group, size = np.zeros(len(suffix), dtype=np.int64), np.zeros(1, dtype=np.int64)
    for d in range(depth):
        big = np.bincount(group, minlength=len(size)) > most
        rows = np.flatnonzero(big[group] & (size[group] == d))
        if not len(rows):
            break
        child, n = _children(group[rows], tokens[suffix[rows] + d])
        group[rows] = len(size) + child
        size = np.r_[size, np.full(n, d + 1)]
    used, group = np.unique(group, return_inverse=True)
    return group, size[used]


def subtree_nodes(edges: np.ndarray, tokens: np.ndarray, suffix: np.ndarray, root: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The node of each suffix at ``depth``, or -1 where it is there alone.

    ``root`` is each suffix's group and ``at`` the group's prefix length;
    ``edges`` holds a label for every EDGE consecutive tokens.
    """
    out = np.full(len(suffix), -1, dtype=np.int64)
    rows, node, at = np.arange(len(suffix)), root, at.copy()
    while len(rows):
        done = at >= depth
        several = np.bincount(node)[node] > 1
        out[rows[done & several]] = node[done & several]
        go = ~done & several
        rows, node, at = rows[go], node[go], at[go]
        if not len(rows):
            break
        long = depth - at >= EDGE
        place = suffix[rows] + at
        label = np.where(long, edges[np.minimum(place, len(edges) - 1)], tokens[place])
        node, n = _children(node, label)
        node += int(out.max(initial=-1)) + 1  # numbers of finished nodes are not used again
        at = at + np.where(long, EDGE, 1)
    return out


def deep_nodes(tokens: np.ndarray, suffix: np.ndarray, depth: int, most: int = GROUP) -> np.ndarray:
    """A number for each suffix, equal where the first ``depth`` tokens are; -1 for one alone."""
    out = np.full(len(suffix), -1, dtype=np.int64)
    if not len(suffix):
        return out
    edges = repeats.grams(tokens, EDGE) if len(tokens) >= EDGE else np.zeros(1, dtype=np.uint64)
    group, size = prefix_groups(tokens, suffix, depth, most)
    order = np.argsort(group, kind="stable")
    ends = np.cumsum(np.bincount(group, minlength=len(size)))
    lo = base = 0
    while lo < len(suffix):
        # as many whole groups as fit, one at least
        k = max(int(np.searchsorted(ends, lo + most, side="right")) - 1, int(np.searchsorted(ends, lo, side="right")))
        rows = order[lo : ends[k]]
        got = subtree_nodes(edges, tokens, suffix[rows], group[rows] - group[rows].min(), size[group[rows]], depth)
        out[rows] = np.where(got >= 0, got + base, -1)
        base += int(got.max(initial=-1)) + 1
        lo = int(ends[k])
    return out


def places(forks: repeats.Forks) -> np.ndarray:
    """For each window of the different stretches, the number of places it starts at."""
    total = np.repeat(forks.value, forks.windows)
    node = deep_nodes(forks.tokens, repeats.ranges(forks.starts, forks.windows), WINDOW)
    several = node >= 0
    if several.any():
        total[several] = np.bincount(node[several], weights=total[several]).astype(np.int64)[node[several]]
    return total


RULE = repeats.Rule(
    length=WINDOW,
    width=WORD_BYTES,
    combine=lambda of, number, n: np.bincount(of, weights=number, minlength=n).astype(np.int64),
    repeated=lambda total, number: total > 1,
    window_values=places,
)


def _six(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES])


def _found(chunk, buckets: int, replies: dict):
    tokens, _, _ = repeats.word_tokens(chunk)
    runs = repeats.anchor_runs(tokens, WINDOW, ANCHOR)
    runs, chosen = repeats.candidates(tokens, runs, WINDOW, buckets, replies, across_texts=False)
    found = repeats.stretches(tokens, runs, chosen, WINDOW)
    return tokens, runs, found, np.bincount(found.of, minlength=len(found.rep))


def deduplicate(docs: DataFrame, most_stretches: int = repeats.MOST_STRETCHES) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row."""
    chunks = pack(docs)
    buckets = bucket_count(chunks, BYTES_PER_BUCKET)

    def anchors(chunk, replies):
        tokens, _, _ = repeats.word_tokens(chunk)
        return repeats.tell_anchors(tokens, repeats.anchor_runs(tokens, WINDOW, ANCHOR), WINDOW, buckets)

    def keys(chunk, replies):
        _, runs, found, count = _found(chunk, buckets, replies[0])
        return repeats.send_keys(runs, found, count, buckets)

    def forks(chunk, replies):
        tokens, runs, found, count = _found(chunk, buckets, replies[0])
        state = repeats.read_states(runs, found, buckets, replies[1])
        return repeats.send_forks(runs, found, count, state, _six(tokens.values), RULE, buckets)

    def remove(batches):
        for batch in batches:
            for chunk, r in unpack(batch):
                shared, states, bits = replies_of(batch, r)
                tokens, runs, found, _ = _found(chunk, buckets, shared)
                state = repeats.read_states(runs, found, buckets, states)
                goes = repeats.decided_windows(runs, found, state, buckets, bits)
                starts = repeats.ranges(runs.first[found.chosen], runs.count[found.chosen])
                yield pa.RecordBatch.from_pydict(_rows(chunk, tokens, repeats.covered(len(tokens.values), starts[goes], WINDOW)), schema=_OUT)

    first = ask(chunks, buckets, anchors, lambda told: repeats.shared_anchors(told, most_stretches))
    second = ask(with_replies(chunks, first), buckets, keys, lambda told: repeats.answer_keys(told, RULE))
    third = ask(with_replies(chunks, first, second), buckets, forks, lambda told: repeats.answer_forks(told, RULE))
    return with_replies(chunks, first, second, third).mapInArrow(remove, "doc_id long, n_words long, n_removed long, kept_sha256 string")


_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])


def _rows(chunk, tokens, gone: np.ndarray) -> dict:
    out = {"doc_id": chunk.ids, "n_words": tokens.count, "n_removed": [], "kept_sha256": []}
    for a, n, at, size in zip(tokens.first.tolist(), tokens.count.tolist(), chunk.starts.tolist(), chunk.sizes.tolist()):
        mine = gone[a : a + n]
        removed = int(mine.sum())
        words = chunk.data[at : at + size].split() if removed < n else []
        kept = compress(words, (~mine).tolist()) if removed else words
        out["n_removed"].append(removed)
        out["kept_sha256"].append(hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


def q_deduplicate(spark, sf_dir):
    return deduplicate(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word, ws FROM w),
win AS (SELECT doc_id, i, word, CASE WHEN i + 34 <= len(ws) THEN array_to_string(list_slice(ws, i, i + 34), ' ') END AS s FROM p),
rep AS (SELECT doc_id, i, word, CASE WHEN s IS NOT NULL AND count(*) OVER (PARTITION BY s) > 1 THEN 1 ELSE 0 END AS r FROM win),
cov AS (SELECT doc_id, i, word, max(r) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM rep),
g AS (SELECT doc_id, count(*) AS n_words, sum(gone)::BIGINT AS n_removed, sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (gone = 0), '')) AS kept_sha256 FROM cov GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM documents LEFT JOIN g USING (doc_id)
"""
