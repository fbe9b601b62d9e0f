"""Operator 13 against a dictionary of prefixes."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from helpers import SF001
from pyspark.sql import functions as F

from faultscore.llm import prefix_trie


def table(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.withColumns({c: F.lit("extra") for c in ("depth", "path", "own", "h", "base", "m", "n", "key", "shard", "ends")})


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest(), role or "", text or ""))
    own = {c: [(r, x) for *_, r, x in sorted(t)] for c, t in own.items()}
    members = {}
    for c, turns in own.items():
        base = c - (c % 5 if c >= 0 else -((-c) % 5))
        h = zlib.crc32(str(c).encode()) % 9
        seq = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append((c, d == len(seq)))
    kids, out = {}, []
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) if p in kids else 1
        saved[p] = sum(saved[k] for k in kids.get(p, [])) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c, e in m if e)))
        up = min(c for c, _ in members[p[:-1]]) if p else None
        out.append((min(c for c, _ in m), len(p), up, len(m), len(kids.get(p, [])), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


AWKWARD = [
    (0, 0, "user", "hello"), (0, 1, "assistant", "wörld 🙂"), (0, 2, None, None), (0, None, "system", "first of all"), (0, 2, "user", "a tie"), (0, 2, "user", "a tie"),
    (1, 0, "user", "hello"), (2, 0, "", "hello"), (2, 1, "", ""), (3, 5, "user", "x" * 100_000), (4, 0, "user", None), (None, 0, "user", "no conversation"),
    (6, 0, "user", "base is absent"), (11, 0, "u", "se"), (12, 0, "us", "e"), (13, 3, "user", "q"), (-1, 0, "user", "negative"), (-7, 0, "user", "negative"), (-5, 0, "a", "b"), (-5, 1, "c", "d"),
]


@pytest.mark.parametrize("shard_rows", [1, 3, 1000])
def test_awkward_rows(spark, shard_rows):
    assert rows_of(prefix_trie.trie(table(spark, AWKWARD), shard_rows)) == brute(AWKWARD)


@pytest.mark.parametrize("shard_rows", [5, 40])
def test_a_hot_conversation_and_a_long_one_over_many_shards(spark, shard_rows):
    g = random.Random(5)
    rows = []
    for c in range(300):
        turns = 3 if c % 3 == 0 else g.randrange(1, 7)
        for t in range(turns):
            rows.append((c, t, "user", "same" if c % 3 == 0 or g.random() < 0.7 else f"turn {g.randrange(3)}"))
    rows += [(c, t, "user", "same") for c in (1000, 1001, 1002) for t in range(60)] + [(1002, 60, "user", "one more")]
    assert rows_of(prefix_trie.trie(table(spark, rows), shard_rows)) == brute(rows)


def test_rows_are_sorted_tile_by_tile():
    g = np.random.default_rng(2)
    lengths = g.integers(0, 30, 400)
    starts = np.cumsum(lengths) - lengths
    ids = g.integers(0, 2, (lengths.sum(), 2)).astype(np.uint64)
    ids[:, 0] = 0
    conv = g.permutation(400)
    order = prefix_trie.sorted_rows(conv, starts, lengths, ids, tile=4)
    want = sorted(range(400), key=lambda i: ([tuple(x) for x in ids[starts[i] : starts[i] + lengths[i]].tolist()], conv[i]))
    assert order.tolist() == want


def test_empty_table(spark):
    assert prefix_trie.trie(table(spark, AWKWARD).limit(0)).collect() == []
    assert prefix_trie.trie(table(spark, AWKWARD).where("conv_id IS NULL")).collect() == []


def test_given_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(prefix_trie.trie(spark.read.parquet(f"{SF001}/conversations.parquet"), 13)) == brute(rows)
