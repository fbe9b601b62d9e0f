"""Operator 12 against products of all pairs."""

import math

import numpy as np
import pytest
from helpers import SF001
from pyspark.sql import functions as F

from faultscore.llm import ball_tree

LONG = (1 << 63) - 1


def table(spark, rows, clash=True):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    return df.withColumns({c: F.lit("extra") for c in ("entry", "v", "copies", "dim", "shard", "query", "rank", "score", "kth")}) if clash else df


def whole(x):
    return max(-LONG - 1, min(LONG, math.floor(256 * x) if abs(x) < 1e300 else (LONG if x > 0 else -LONG - 1)))


def brute(rows, k=5, every=50):
    good = [(i, [whole(x) for x in v]) for i, v, _ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, (qi, qv) in enumerate(good):
        if qi % every:
            continue
        found = sorted((-max(-LONG - 1, min(LONG, sum(a * b for a, b in zip(qv, v)))), i) for c, (i, v) in enumerate(good) if c != q and len(v) == len(qv))[:k]
        out += [(qi, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def random_rows(n, dim, seed, spread=1.0):
    g = np.random.default_rng(seed)
    return [(i, [float(x) for x in v], 1) for i, v in enumerate(g.normal(size=(n, dim)) * spread)]


@pytest.mark.parametrize("shard_rows", [1, 7, 1000])
def test_awkward_rows(spark, shard_rows):
    rows = random_rows(60, 3, 1)
    rows += [(100, None, 1), (150, [1.0, None, 2.0], 1), (200, [1.0, float("nan"), 2.0], 1), (250, [float("inf"), 0.0, 0.0], 1), (None, [9.0, 9.0, 9.0], 1)]
    rows += [(300, [1.0, 1.0], 1), (301, [0.5, 0.5], 2), (350, [], 1), (351, [], 1), (400, [0.0, 0.0, 0.0], None), (450, [1.0] * 5, 1)]
    rows += [(500, [0.25, 0.5, -1.0], 1)] * 3 + [(500, [1.0, 0.0, 0.0], 1), (501, [0.25, 0.5, -1.0], 1)] + [(7, [2.0, 2.0, 2.0], 1)] * 9
    assert rows_of(ball_tree.top_k(table(spark, rows), shard_rows=shard_rows, leaf=4)) == brute(rows)


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, [1.0, 2.0], 0) for i in range(101)]
    assert rows_of(ball_tree.top_k(table(spark, rows, clash=False), shard_rows=20, leaf=8)) == brute(rows)


def test_products_beyond_doubles_and_beyond_64_bits(spark):
    rows = [(i, [float(x) * 1e7 + (1 << 33), float(x) * 1e6 - 12345.0], 0) for i, x in enumerate(range(51))]
    rows += [(50 + i, [x, -x], 0) for i, x in enumerate((1e12, 1e18, 1e200, -1e200, 3.0))]
    assert rows_of(ball_tree.top_k(table(spark, rows), shard_rows=9, leaf=4)) == brute(rows)


def test_shards_do_not_matter_and_bounds_prune(spark):
    g = np.random.default_rng(3)
    centres = g.normal(size=(20, 16))
    rows = [(i, [float(x) for x in centres[i % 20] + g.normal(size=16) * 0.05], 0) for i in range(1500)]
    assert rows_of(ball_tree.top_k(table(spark, rows), shard_rows=200)) == brute(rows)
    vectors = np.floor(256 * np.array([v for _, v, _ in rows]))
    tree = ball_tree.BallTree(vectors, 16)
    query, length = vectors[:1], np.sqrt((vectors[:1] ** 2).sum(axis=1))
    for node, (lo, hi) in enumerate(zip(tree.lo, tree.hi)):
        assert (vectors[tree.order[lo:hi]] @ query[0]).max() <= tree.bound(node, query, length)[0]
    kth = np.sort(vectors @ query[0])[-5]
    leaves = [n for n, child in enumerate(tree.left) if child < 0]
    assert sum(tree.bound(n, query, length)[0] >= kth for n in leaves) < len(leaves) / 2


def test_empty_table(spark):
    assert ball_tree.top_k(table(spark, random_rows(2, 2, 1)).limit(0)).collect() == []


def test_given_vectors(spark):
    rows = [(r.vec_id, [float(x) for x in r.embedding], r.label) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()]
    assert rows_of(ball_tree.top_k(spark.read.parquet(f"{SF001}/embeddings.parquet"), shard_rows=100)) == brute(rows)
