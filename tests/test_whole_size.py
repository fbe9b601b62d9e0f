"""Whole jobs at size: results that do not depend on how many blocks or tasks the rows fill."""

import json
from dataclasses import replace

import numpy as np
import pytest
from fixtures import machine_frame
from pyspark import RDD
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F
from test_exact_trees import shape

from faultscore.operators import boosting, candidates, exact_trees
from faultscore.operators.boosting import BoostingConfig, fit_boosted_trees
from faultscore.operators.candidates import CandidateConfig, class_balance, fit_candidate
from faultscore.operators import ensembles
from faultscore.operators.ensembles import NODE_COLUMNS, NODE_SCHEMA, TreeEnsembleModel, leaf_values, packed_trees, tree_sums, unpacked_tree
from faultscore.operators.exact_trees import TreeConfig
from faultscore.operators.network import NetworkConfig, fit_network
from faultscore.plans.experiment import prepare
from faultscore.schema import MACHINE_TASK as S


@pytest.fixture(scope="module")
def prepared(spark):
    exp = prepare(machine_frame(spark), S, 3, CandidateConfig(seed=3))
    yield exp
    exp.close()


def test_a_network_of_many_blocks_takes_every_step(prepared):
    """A batch is ``batch`` rows of the table and not of each block."""
    cfg = NetworkConfig(hidden=6, epochs=2, batch=50, seed=3)
    n = prepared.train.count()
    one = fit_network(prepared.train, "udi", 4.0, cfg)
    three = fit_network(prepared.train, "udi", 4.0, replace(cfg, block_rows=-(-n // 3)))
    assert three[1] == one[1]
    assert json.loads(three[0].getOrDefault("weights")) == json.loads(one[0].getOrDefault("weights"))
    assert NetworkConfig().most_turns * NetworkConfig().block_rows > 10**11  # no table goes a step a job


def test_a_forest_of_a_large_table_is_no_row_a_tree(prepared, monkeypatch):
    """Above ``tree_finish_rows`` trees are still grown in a task each, and are the same."""
    width, balance = prepared.stats.vector_width(S), class_balance(prepared.train)
    config = CandidateConfig(seed=3, forest_trees=3)
    want = shape(fit_candidate("random_forest", prepared.train, balance, config, width, "udi")[0].nodes)
    monkeypatch.setattr(exact_trees, "bootstrap", lambda *a: pytest.fail("a row a tree"))
    got = fit_candidate("random_forest", prepared.train, balance, replace(config, tree_finish_rows=100), width, "udi")
    assert shape(got[0].nodes) == want


def test_trees_grown_in_pieces_are_the_same(monkeypatch):
    g = np.random.default_rng(7)
    x = np.stack([g.integers(0, k, 3000).astype(float) for k in (1, 2, 24, 60, 2500)], axis=1)
    y, m = (g.random(3000) < 0.1).astype(np.int8), g.integers(1, 5, 3000).astype(np.uint8)
    ranked = exact_trees.Ranked(x)
    for cfg in (TreeConfig(min_rows=2, columns=2, seed=5), TreeConfig(max_depth=4, min_rows=8, seed=5)):
        grown = []
        for together in (1, 40, 500, 10**6):
            monkeypatch.setattr(exact_trees, "TOGETHER", together)
            for bits in (18, 1):  # sums of a value in one double, or in two
                monkeypatch.setattr(exact_trees, "TIMES_BITS", bits)
                grown.append([c.tolist() for c in exact_trees.grow_subtree(ranked, y, m, 0, "", 1.0, 9.0, cfg)])
        assert all(nodes == grown[0] for nodes in grown)
        feature, left, right = grown[0][2], grown[0][4], grown[0][5]
        children = [c for f, a, b in zip(feature, left, right) if f >= 0 for c in (a, b)]
        assert children == list(range(1, len(feature)))  # level by level


def test_rows_go_out_as_ranks_with_ids_of_any_length(spark):
    ids = ["", "é", "a17", "x" * 60, *map(str, range(300))]
    rows = [(i, int(k % 3 == 0), [float(k % 7), float(k), -1.0]) for k, i in enumerate(ids)]
    table = spark.createDataFrame([*rows, (None, 1, [5.0, -3.0, 2.0])], "id string, y int, x array<double>").repartition(5)
    found, y, x = exact_trees.unpacked([r.asDict() for r in exact_trees.packed(table).collect()])
    by_id = {text[k].tobytes(): int(p) for at, text in found.parts for k, p in enumerate(at)}
    assert sorted(by_id) == sorted(i.encode() for i in ids)  # a row without an id is never drawn
    for i, label, values in rows:
        p = by_id[i.encode()]
        assert y[p] == label and [x.values[x.first[f] + x.ranks[f][p]] for f in range(3)] == values
    want = {i: k for i, k in zip(ids, exact_trees.drawn_times(42, 3, [i.encode() for i in ids]).tolist())}
    got = exact_trees.drawn_times(42, 3, found).tolist()
    assert {i: got[by_id[i.encode()]] for i in ids} == want


def test_a_streamed_tree_is_one_row(spark):
    nodes = [(t, n, *rest) for t in range(3) for n, rest in enumerate([(0, 0.5, 1, 2, 0.0), (-1, 0.0, -1, -1, 0.1 * t), (-1, 0.0, -1, -1, 1.0)])]
    table = spark.createDataFrame(nodes, NODE_SCHEMA)
    packed = {r.tree: unpacked_tree(r.nodes) for r in packed_trees(table.orderBy(F.desc("node"))).collect()}
    assert sorted(packed) == [0, 1, 2]
    assert [packed[2][c].tolist() for c in ("feature", "threshold", "left", "right", "value")] == [list(c) for c in zip(*[n[2:] for n in nodes if n[0] == 2])]
    rows = spark.createDataFrame([(Vectors.dense([0.0]),), (Vectors.dense([1.0]),)], ["features"])
    scored = TreeEnsembleModel(trees=3, link="mean", broadcastNodes=1).with_nodes(table).transform(rows)
    assert sorted(r.score for r in scored.collect()) == [pytest.approx(0.1), 1.0]


def random_trees(g, trees, width, depth):
    """Node tables of trees grown at random, cuts among few values."""
    rows = []
    for t in range(trees):
        nodes, going = [None], [(0, 0)]
        while going:
            at, level = going.pop(0)
            if level < depth and g.random() < 0.8:
                nodes[at] = (t, at, int(g.integers(width)), float(g.integers(0, 9)) / 2, len(nodes), len(nodes) + 1, 0.0)
                going += [(len(nodes), level + 1), (len(nodes) + 1, level + 1)]
                nodes += [None, None]
            else:
                nodes[at] = (t, at, -1, 0.0, -1, -1, float(g.normal()))
        rows += nodes
    return {c: np.array(v) for c, v in zip(NODE_COLUMNS, zip(*rows))}


def test_small_trees_are_scored_all_at_once_to_the_last_bit(monkeypatch):
    g = np.random.default_rng(11)
    for depth, masks in ((4, True), (0, True), (6, False)):
        nodes = random_trees(g, 60, 3, depth)
        x = g.integers(-1, 11, (700, 3)) / 2
        x[::9, 1], x[3] = np.nan, [np.inf, -np.inf, -0.0]
        starts = np.flatnonzero(np.r_[True, nodes["tree"][1:] != nodes["tree"][:-1]])
        want = np.zeros(len(x))
        for lo, hi in zip(starts, [*starts[1:], len(nodes["tree"])]):
            want += leaf_values(x, nodes, lo, hi)
        assert tree_sums(x, nodes).tolist() == want.tolist()
        assert (nodes["masks"] is not None) == masks
        assert tree_sums(x[:0], nodes).tolist() == []
    monkeypatch.setattr(ensembles, "leaf_values", lambda *a: pytest.fail("tree by tree"))
    tree_sums(x, random_trees(g, 5, 3, 4))


def test_sums_of_blocks_take_one_stage(prepared, monkeypatch):
    """Boosting by a job a level: no shuffle of sums below ``DIRECT_BLOCKS`` blocks, and the same trees."""
    cfg = BoostingConfig(rounds=3, seed=3, block_rows=-(-prepared.train.count() // 6))
    nodes = lambda: sorted(map(tuple, fit_boosted_trees(prepared.train, "udi", 5.0, cfg).nodes.collect()))
    monkeypatch.setattr(boosting, "DIRECT_BLOCKS", 0)
    want = nodes()
    monkeypatch.undo()
    monkeypatch.setattr(RDD, "treeReduce", lambda *a, **k: pytest.fail("another stage"))
    assert nodes() == want


def test_a_few_blocks_of_many_columns_are_boosted_in_a_task(monkeypatch):
    """Three blocks of 26 columns, as labels and documents fill at size, need no job a level."""
    assert 3 * BoostingConfig().block_rows * 26 <= boosting.TASK_VALUES
    assert 3 * BoostingConfig().block_rows * 26 <= candidates.TREE_TASK_VALUES
    cfg = candidates.task_config("random_forest", CandidateConfig(), 26, 720_000)
    assert cfg.finish_rows >= 720_000
    assert candidates.task_config("random_forest", CandidateConfig(), 26, 2_000_000) == candidates.tree_config("random_forest", CandidateConfig(), 26)
