"""Operators 2 and 3: suffix trees, induced sorting, and the anchored search."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from helpers import brute_removed, documents, plain_words

from faultscore.llm import induced_sorting, repeats, suffix_trees
from faultscore.llm.chunks import Chunk, bucket_of, from_six, pack, to_six


def texts(seed):
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 6))) for _ in range(80)]
    words = lambda n: [rnd.choice(vocab) for _ in range(n)]
    shared = words(60)
    rows = [(i, " ".join(words(rnd.randint(0, 90)))) for i in range(12)]
    rows += [(20 + i, " ".join(words(rnd.randint(3, 30)) + shared[i : i + 45] + words(rnd.randint(0, 30)))) for i in range(8)]
    rows += [(40, "x " * 120), (41, "a" * 200), (42, "a" * 77 + "b"), (43, None), (44, ""), (45, "x " * 50), (46, "  \t one\ntwo \r "), (None, " ".join(shared))]
    rows += [rows[3], rows[3], (47, rows[5][1]), (48, rows[5][1]), (49, " ".join(words(9000) + shared))]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_suffix_trees_remove_what_brute_force_removes(spark, seed):
    rows = texts(seed)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed, r.kept_sha256) for r in suffix_trees.deduplicate(documents(spark, rows)).collect())
    words = [plain_words(t) for _, t in rows]
    gone = brute_removed([(0, w) for w in words], 35, earlier=False)
    want = sorted((d is None, d or 0, len(w), sum(g), hashlib.sha256(" ".join(x for x, y in zip(w, g) if not y).encode()).hexdigest()) for (d, _), w, g in zip(rows, words, gone))
    assert got == want
    assert sum(x[3] for x in got) > 500


@pytest.mark.parametrize("seed", [3, 4])
def test_induced_sorting_removes_what_brute_force_removes(spark, seed):
    rows = texts(seed)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in induced_sorting.deduplicate(documents(spark, rows)).collect())
    data = [(t or "").encode() for _, t in rows]
    gone = brute_removed([(float("inf") if d is None else d, b) for (d, _), b in zip(rows, data)], 50, earlier=True)
    want = []
    for (d, _), b, g in zip(rows, data, gone):
        spans = sum(y and not x for x, y in zip([False] + g, g))
        want.append((d is None, d or 0, len(b), sum(g), spans, hashlib.sha256(bytes(x for x, y in zip(b, g) if not y)).hexdigest()))
    assert got == sorted(want)
    assert sum(x[3] for x in got) > 500


def hot_line(seed, n):
    """One phrase in every text, each time among other words; some texts come twice."""
    rnd = random.Random(seed)
    words = lambda k: [f"w{rnd.randrange(5000)}" for _ in range(k)]
    phrase = words(14)
    rows = [" ".join(words(40) + phrase + words(40)) for _ in range(n)]
    rows += [t + " tail" for t in rows[::5]] + [" ".join(words(5) + t.split()[20:80]) for t in rows[::7]]
    return list(enumerate(rows))


@pytest.mark.parametrize("module,length", [(suffix_trees, 35), (induced_sorting, 50)])
def test_windows_of_a_hot_anchor_are_removed_as_brute_force_does(spark, module, length):
    rows = hot_line(6, 40)
    items = [(0 if length == 35 else i, plain_words(t) if length == 35 else t.encode()) for i, t in rows]
    want = {i: sum(g) for (i, _), g in zip(rows, brute_removed(items, length, earlier=length == 50))}
    assert sum(want.values()) > 500
    for most in (3, repeats.MOST_STRETCHES):
        got = {r.doc_id: r.n_removed for r in module.deduplicate(documents(spark, rows).repartition(3), most_stretches=most).collect()}
        assert got == want


@pytest.mark.parametrize("module", [suffix_trees, induced_sorting])
def test_a_hot_anchor_is_spread_over_the_buckets(module):
    rows, buckets, length = hot_line(8, 6000), 64, module.WINDOW
    data = [t.encode() for _, t in rows]
    chunk = Chunk(0, [i for i, _ in rows], np.array([len(b) for b in data], dtype=np.int64), b"".join(data))
    tokens = repeats.word_tokens(chunk)[0] if module is suffix_trees else repeats.byte_tokens(chunk)
    told = dict(repeats.tell_anchors(tokens, repeats.anchor_runs(tokens, length, module.ANCHOR), length, buckets))
    replies = {b: next(repeats.shared_anchors([(0, p)], 100))[1] for b, p in told.items()}
    runs, found = (module._found(chunk, buckets, replies)[k] for k in ((1, 2) if module is suffix_trees else (0, 1)))
    load = np.bincount(bucket_of(runs.anchor[found.rep], buckets), minlength=buckets)
    assert load.max() < 2 * load.mean()
    assert np.unique(runs.anchor[found.rep], return_counts=True)[1].max() <= 100


def test_empty_tables(spark):
    empty = documents(spark, [(1, "a")]).limit(0)
    assert suffix_trees.deduplicate(empty).collect() == []
    assert induced_sorting.deduplicate(empty).collect() == []


def test_several_chunks_and_long_texts_give_the_same_rows(spark):
    rows = [(i, t) for i, (_, t) in enumerate(texts(5))]
    chunks = pack(documents(spark, rows).repartition(3), chunk_bytes=500)
    assert chunks.count() > 5
    assert chunks.selectExpr("sum(n_bytes)").first()[0] == sum(len((t or "").encode()) for _, t in rows)


@pytest.mark.parametrize("trial", range(40))
def test_induction_orders_suffixes_and_carries_common_prefixes(trial):
    rnd = random.Random(trial)
    segments = ["".join(rnd.choice("ab" if trial % 2 else "abcd") for _ in range(rnd.randint(1, 40))) for _ in range(rnd.randint(1, 12))]
    if trial % 5 == 0:
        segments += ["a" * 70, "b" + "a" * 60]
    if trial % 3 == 0:
        segments += [s[3:] or "a" for s in segments]
    text = b"\0" + b"\0".join(s.encode() for s in segments) + b"\0"
    depth = rnd.choice([3, 8, 10, 50])
    memory = rnd.choice([100, 1 << 20])  # a hundred bytes: nearly all tuples pass the disk
    run = induced_sorting.Induction(np.frombuffer(text, dtype=np.uint8), depth, memory).run()
    got = [(int(p), int(c)) for ps, cs in run for p, c in zip(ps, cs) if text[p]]
    assert sorted(p for p, _ in got) == [i for i, b in enumerate(text) if b]
    padded = text + b"\0" * 100
    for (p, _), (q, c) in zip(got, got[1:]):
        a, b = padded[p : p + depth], padded[q : q + depth]
        assert a <= b
        assert c == next((i for i in range(depth) if a[i] != b[i]), depth)


@pytest.mark.parametrize("trial", range(30))
def test_deep_nodes_are_the_repeated_windows(trial):
    rnd = random.Random(trial)
    tokens = np.array([rnd.randint(0, 2) for _ in range(rnd.randint(60, 200))], dtype=np.uint64)
    depth = rnd.choice([3, 7, 12])
    suffix = np.arange(len(tokens) - depth + 1)
    want = defaultdict(list)
    for s in suffix:
        want[tuple(tokens[s : s + depth])].append(s)
    got = defaultdict(list)
    for s, n in zip(suffix, suffix_trees.deep_nodes(tokens, suffix, depth, most=rnd.choice([2, 5, 1000]))):
        if n >= 0:
            got[n].append(s)
    assert {tuple(v) for v in got.values()} == {tuple(v) for v in want.values() if len(v) > 1}


@pytest.mark.parametrize("k", [1, 2, 3, 7, 8, 13])
def test_grams_hash_content_alone(k):
    values = np.random.default_rng(k).integers(0, 1 << 62, size=40, dtype=np.uint64)
    both = np.concatenate([values, values])
    g = repeats.grams(both, k)
    assert (g[: 41 - k] == g[40 : 40 + 41 - k]).all()
    assert len(set(g.tolist())) == 40


def test_six_byte_numbers_round_trip():
    x = np.array([0, 1, (1 << 48) - 1, 123456789012], dtype=np.uint64)
    assert (from_six(to_six(x)) == x).all()


@pytest.mark.parametrize("buckets", [1, 7, 1 << 17])
def test_buckets_in_use_are_walked_once(buckets):
    from faultscore.llm.chunks import by_bucket

    bucket = np.random.default_rng(3).integers(0, buckets, 500)
    got = list(by_bucket(bucket, buckets))
    assert [b for b, _ in got] == sorted(set(bucket.tolist()))
    assert all(np.array_equal(at, np.flatnonzero(bucket == b)) for b, at in got)
    assert list(by_bucket(bucket[:0], buckets)) == []
