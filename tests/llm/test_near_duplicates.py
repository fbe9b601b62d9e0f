"""Operators 5 and 6, and connected components."""

import random

import numpy as np
import pytest
from helpers import SF001, brute_fingerprint, documents, union_find
from pyspark.sql import functions as F

from faultscore.llm import pivots, simhash
from faultscore.llm.components import components


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_union_find(spark, seed):
    rnd = random.Random(seed)
    pairs = [(rnd.randint(0, 120), rnd.randint(0, 120)) for _ in range(90)] + [(500, i) for i in range(501, 540)] + [(i, i + 1) for i in range(600, 640)]
    got = {r.id: r.component for r in components(spark.createDataFrame(pairs + [(None, 3)], "a long, b long")).collect()}
    linked = {i for a, b in pairs if a != b for i in (a, b)}
    assert got == {i: c for i, c in union_find({i for p in pairs for i in p}, pairs).items() if i in linked}


def test_no_links_no_components(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("radius", [0, 3, 4])
def test_bit_sliced_buckets_equal_brute_force(radius):
    rnd = random.Random(radius)
    fps, group = [], []
    for g, size in enumerate([1, 2, 63, 64, 65, 200]):
        centre = rnd.getrandbits(64)
        for _ in range(size):
            x = centre if rnd.random() < 0.7 else rnd.getrandbits(64)
            for _ in range(rnd.randint(0, 6)):
                x ^= 1 << rnd.randrange(64)
            fps.append(x)
            group.append(g)
    got = simhash.bucket_links(np.array(group), np.array(fps, dtype=np.uint64), radius)
    pairs = [(i, j) for i in range(len(fps)) for j in range(i) if group[i] == group[j] and (fps[i] ^ fps[j]).bit_count() <= radius]
    want = union_find(range(len(fps)), pairs)
    assert got.tolist() == [want[i] for i in range(len(fps))]


def test_every_pair_within_the_radius_shares_a_bucket():
    rnd = random.Random(5)
    for pieces in (5, 6, 7):
        kept = simhash.masks(pieces, 4)
        for _ in range(200):
            diff = 0
            for _ in range(4):
                diff |= 1 << rnd.randrange(64)
            diff = diff - (1 << 64) if diff >> 63 else diff
            assert any(diff & m == 0 for m in kept)


def awkward():
    rnd = random.Random(9)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 8))) for _ in range(300)]
    base = [rnd.choice(words) for _ in range(400)]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 60)))) for i in range(30)]
    for i in range(12):
        copy = list(base)
        copy[rnd.randrange(len(copy))] = "changed"
        rows.append((100 + i, " ".join(copy)))
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, "ONE"), (204, "one"), (205, "Éa éa"), (206, "x " * 3000), (206, "x " * 3000), (3, rows[3][1]), (None, rows[4][1])]
    return rows


@pytest.mark.parametrize("block", [simhash.BLOCK, 4])
def test_simhash_classes_equal_brute_force(spark, block, monkeypatch):
    rows = awkward()
    if block != simhash.BLOCK:
        whole = simhash.links
        monkeypatch.setattr(simhash, "links", lambda nodes, radius: whole(nodes, radius, block))
    got = [(r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(documents(spark, rows)).collect()]
    fp = [(d, brute_fingerprint(t)) for d, t in rows]
    known = [(d, f) for d, f in fp if d is not None]
    classes = union_find({d for d, _ in known}, [(a, b) for a, f in known for b, g in known if (f ^ g).bit_count() <= 4])
    assert sorted(got, key=str) == sorted(((d, f, None if d is None else classes[d]) for d, f in fp), key=str)


def test_simhash_query_on_the_test_table(spark):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.q_near_duplicates(spark, SF001).collect()}
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    fp = {d: brute_fingerprint(t) for d, t in rows}
    classes = union_find(fp, [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 4])
    assert got == {d: (f"{fp[d]:016x}", classes[d]) for d in fp}


def test_simhash_of_an_empty_table(spark):
    assert simhash.near_duplicates(documents(spark, [(1, "a")]).limit(0)).collect() == []


# ---------------------------------------------------------------- operator 6


def vectors(seed, n=600, dim=64):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        if i and rng.random() < 0.5:
            base = np.array(out[rng.integers(len(out))][1])
            v = base + rng.normal(size=dim) * np.linalg.norm(base) / np.sqrt(dim) * rng.uniform(0.05, 0.5)
        else:
            v = rng.normal(size=dim)
        out.append((i, v.astype(np.float32).tolist(), int(rng.integers(3))))
    return out


def brute_links(rows, cosine=0.93):
    v = np.array([r[1] for r in rows], dtype=np.float64)
    n = np.sqrt((v * v).sum(axis=1))
    label = np.array([r[2] for r in rows])
    ok = ((v @ v.T) / np.outer(n, n) >= cosine) & (label[:, None] == label[None, :])
    np.fill_diagonal(ok, False)
    return ok


@pytest.mark.parametrize("block", [pivots.BLOCK, 40])
def test_pivot_index_finds_nine_links_in_ten_and_none_too_many(spark, block):
    rows = vectors(7)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("id", F.lit("clash"))
    got = {r.vec_id: r for r in pivots.near_duplicates(df, block=block).collect()}
    ok = brute_links(rows)
    want = ok.sum(axis=1)
    assert want.sum() > 100
    assert all(got[i].n_links <= want[i] for i in got)
    assert sum(r.n_links for r in got.values()) >= 0.9 * want.sum()
    classes = union_find(range(len(rows)), np.argwhere(ok).tolist())
    assert sum(got[i].component_id == classes[i] for i in got) >= 0.9 * len(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


@pytest.mark.parametrize("count", [64, 256, 1024])
@pytest.mark.parametrize("copies", [0.95, 0.98])
def test_pivots_inside_a_hot_group_lose_no_links(spark, monkeypatch, count, copies):
    rng = np.random.default_rng(count)
    unit = lambda a: a / np.linalg.norm(a, axis=1, keepdims=True)
    centre = unit(rng.normal(size=(1, 64)))
    noise = rng.normal(size=(1000, 64))
    noise = unit(noise - (noise @ centre.T) * centre)
    hot = np.sqrt(copies) * centre + np.sqrt(1 - copies) * noise
    other = unit(rng.normal(size=(2000, 64)))
    other[:300] = unit(other[300:600] + 0.03 * rng.normal(size=(300, 64)))
    rows = [(i, v.tolist(), 1) for i, v in enumerate(rng.permutation(np.vstack([hot, other])))]
    monkeypatch.setattr(pivots, "pivot_count", lambda n: count)
    got = {r.vec_id: r.n_links for r in pivots.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    want = brute_links(rows).sum(axis=1)
    assert all(got[i] <= want[i] for i in got)
    assert sum(got.values()) >= 0.95 * want.sum()
    assert sum(got[i] for i in got if want[i] < 10) >= 0.95 * want[want < 10].sum() > 0


@pytest.mark.parametrize("lean", [0.0, 0.8])
def test_vectors_that_lean_to_one_side_keep_their_links_and_few_pairs_meet(spark, monkeypatch, lean):
    """Cosines of unrelated vectors around ``lean``; links of 0.93 to 0.99."""
    rng = np.random.default_rng(5)
    unit = lambda a: a / np.linalg.norm(a, axis=1, keepdims=True)
    n, dim = 3000, 128
    x = unit(np.sqrt(lean) * unit(rng.normal(size=(1, dim))) + np.sqrt(1 - lean) * unit(rng.normal(size=(n, dim))))
    aside = rng.normal(size=(300, dim))
    aside = unit(aside - (aside * x[:300]).sum(axis=1, keepdims=True) * x[:300])
    cosine = rng.uniform(0.931, 0.99, size=(300, 1))
    rows = [(i, v.tolist(), 1) for i, v in enumerate(rng.permutation(np.vstack([x, cosine * x[:300] + np.sqrt(1 - cosine**2) * aside])))]
    monkeypatch.setattr(pivots, "pivot_count", lambda n: 1024)
    got = {r.vec_id: r.n_links for r in pivots.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    want = brute_links(rows).sum(axis=1)
    assert want.sum() >= 600 and all(got[i] <= want[i] for i in got)
    assert sum(got.values()) >= 0.95 * want.sum()
    units = np.array([r[1] for r in rows])
    units = unit(units)
    table, mean = pivots.reference(units[rng.permutation(len(units))[:1024]], pivots.COSINE)
    near = pivots.nearest(units, table, mean, pivots.PREFIX)
    lists = np.bincount(near.ravel(), minlength=len(table)).astype(float)
    assert (lists * lists).sum() < 0.1 * len(units) ** 2  # comparisons of all lists against all pairs


def test_a_row_that_is_the_mean_has_a_description():
    units = np.array([[1.0, 0.0], [0.0, 1.0], [-1.0, 0.0], [0.0, -1.0]])
    table, mean = pivots.reference(units, 0.93)
    assert len(table) == 4 and not mean.any()
    assert pivots.nearest(np.zeros((1, 2)), table, mean, 2).shape == (1, 2)


def test_a_length_with_one_or_two_pivots_keeps_its_links(spark, monkeypatch):
    rows = vectors(3, n=60)
    monkeypatch.setattr(pivots, "pivot_count", lambda n: 2)
    want = brute_links(rows).sum(axis=1)
    assert want.sum() > 0
    got = pivots.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    assert {r.vec_id: r.n_links for r in got.collect()} == dict(enumerate(want))


def test_awkward_vectors(spark):
    one, two = [1.0, 0.0, 0.0], [0.99, 0.01, 0.0]
    rows = [(1, one, 1), (2, two, 1), (3, one, 2), (4, one, None), (5, None, 1), (6, [0.0] * 3, 1), (7, [1.0, None, 0.0], 1), (8, [float("nan"), 1.0, 0.0], 1), (9, [float("inf"), 0.0, 0.0], 1), (10, [1.0, 0.0], 1), (11, one, 1), (11, one, 1), (None, one, 1), (12, [], 1)]
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in pivots.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), min_shared=1).collect()), key=str)
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 12)]
    assert got == sorted([(1, 3, 1, True), (2, 3, 1, False), (11, 3, 1, False), (11, 3, 1, False), (None, 0, None, True), *alone], key=str)


def test_pivots_of_an_empty_table(spark):
    assert pivots.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []
