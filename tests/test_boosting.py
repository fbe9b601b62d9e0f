"""Boosting, running sums and ensemble models."""

import random
from dataclasses import replace

import numpy as np
import pytest
from fixtures import machine_frame
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from faultscore.operators.boosting import BoostingConfig, fit_boosted_trees
from faultscore.operators.candidates import CandidateConfig, class_balance
from faultscore.operators.ensembles import NODE_COLUMNS, TreeEnsembleModel, leaf_values
from faultscore.operators.prefix_sums import prefix_sums
from faultscore.plans.experiment import prepare
from faultscore.schema import MACHINE_TASK as S

CFG = BoostingConfig(rounds=5, seed=3, checkpoint_interval=2)


@pytest.fixture(scope="module")
def prepared(spark):
    exp = prepare(machine_frame(spark), S, 3, CandidateConfig(seed=3))
    yield exp
    exp.close()


def nodes_of(model):
    return sorted(tuple(r) for r in model.nodes.collect())


def test_blocks_do_not_change_the_trees(prepared):
    weight = class_balance(prepared.train).positive_weight()
    one = fit_boosted_trees(prepared.train, "udi", weight, CFG)
    # the same fineness of the sums, so that only the blocks differ
    scale = BoostingConfig().block_rows
    import faultscore.operators.boosting as b

    original = b.gradient_scale
    b.gradient_scale = lambda w, _: original(w, scale)
    try:
        many = fit_boosted_trees(prepared.train, "udi", weight, replace(CFG, block_rows=100))
    finally:
        b.gradient_scale = original
    assert nodes_of(one) == nodes_of(many)


def test_trees_lower_the_loss_and_separate(prepared):
    weight = class_balance(prepared.train).positive_weight()
    rows = prepared.train.select("udi", "label", "features")
    loss = []
    for rounds in (1, 40):
        model = fit_boosted_trees(prepared.train, "udi", weight, replace(CFG, rounds=rounds))
        p = model.transform(rows)
        loss.append(p.agg(F.avg(-F.when(F.col("label") == 1, F.log("score") * weight).otherwise(F.log(1 - F.col("score"))))).first()[0])
    assert loss[1] < 0.8 * loss[0]


def test_all_leaves_obey_the_hessian_bound(prepared):
    model = fit_boosted_trees(prepared.train, "udi", 1.0, replace(CFG, rounds=1, min_child_hessian=1e9))
    assert [r.feature for r in model.nodes.collect()] == [-1]


def test_saved_model_and_streamed_trees_score_alike(spark, prepared, scratch):
    model = fit_boosted_trees(prepared.train, "udi", 5.0, replace(CFG, rounds=3))
    rows = prepared.part("validation")
    want = {r.udi: r.score for r in model.transform(rows).collect()}
    assert len(want) == rows.count()
    PipelineModel(stages=[model]).write().overwrite().save(f"{scratch}/m")
    again = PipelineModel.load(f"{scratch}/m")
    assert {r.udi: r.score for r in again.transform(rows).collect()} == want
    streamed = model.copy()
    streamed.set(streamed.broadcastNodes, 1)
    got = streamed.transform(rows)
    assert got.columns == model.transform(rows).columns
    assert {r.udi: r.score for r in got.collect()} == pytest.approx(want, abs=1e-12)


def test_a_leaf_alone_and_deep_trees(spark):
    nodes = [(0, 0, -1, 0.0, -1, -1, 0.25), (1, 0, 0, 1.0, 1, 2, 0.0), (1, 1, -1, 0.0, -1, -1, 0.0), (1, 2, 1, -1.0, 3, 4, 0.0), (1, 3, -1, 0.0, -1, -1, 0.5), (1, 4, -1, 0.0, -1, -1, 1.0)]
    from faultscore.operators.ensembles import NODE_SCHEMA

    model = TreeEnsembleModel(trees=2, link="mean").with_nodes(spark.createDataFrame(nodes, NODE_SCHEMA))
    rows = spark.createDataFrame([(i, Vectors.dense(x)) for i, x in enumerate(((1.0, 0.0), (1.5, -1.0), (2.0, 0.0)))], ["i", "features"])
    assert [r.score for r in model.transform(rows).orderBy("i").collect()] == [0.125, 0.375, 0.625]


@pytest.mark.parametrize("descending", [False, True])
def test_running_sums(spark, descending):
    g = random.Random(4)
    rows = [(k, v, g.randrange(5)) for k in ("a", "b", None) for v in g.sample(range(1000), 200 if k == "a" else 5)]
    got = prefix_sums(spark.createDataFrame(rows, "k string, v int, n long"), ["k"], "v", ["n"], descending, parts=7).collect()
    want = sorted(((k, v, n, sum(m for q, w, m in rows if q == k and (w >= v if descending else w <= v)), sum(m for q, _, m in rows if q == k)) for k, v, n in rows), key=str)
    assert sorted((tuple(r) for r in got), key=str) == want


def test_one_tree_equals_a_plain_search(prepared):
    """The root split against a loop over all cuts of all columns."""
    weight = class_balance(prepared.train).positive_weight()
    cfg = replace(CFG, rounds=1, depth=1, subsample=1.1, column_fraction=1.0, bins=4096)
    root = min(fit_boosted_trees(prepared.train, "udi", weight, cfg).nodes.collect(), key=lambda r: r.node)
    data = prepared.train.select("label", "features").collect()
    x, y = np.array([r.features.toArray() for r in data]), np.array([r.label for r in data])
    w = np.where(y == 1, weight, 1.0)
    g, h = w * (0.5 - y), w * 0.25
    best = (-1.0, None, None)
    for f in range(x.shape[1]):
        for v in np.unique(x[:, f])[:-1]:
            left = x[:, f] <= v
            gl, hl, gr, hr = g[left].sum(), h[left].sum(), g[~left].sum(), h[~left].sum()
            if min(hl, hr) >= 2:
                gain = gl**2 / (hl + 1) + gr**2 / (hr + 1) - (gl + gr) ** 2 / (hl + hr + 1)
                best = max(best, (gain, f, v), key=lambda b: b[0])
    assert (root.feature, root.threshold) == (best[1], pytest.approx(best[2]))


def test_rounds_over_blocks_keep_few_states(spark, prepared, monkeypatch):
    """The last state and what it is made from, not one of every round since the checkpoint."""
    import faultscore.operators.boosting as boosting

    kept, before, plain = [], spark.sparkContext._jsc.getPersistentRDDs().size(), boosting.applied
    monkeypatch.setattr(boosting, "applied", lambda *a: kept.append(spark.sparkContext._jsc.getPersistentRDDs().size()) or plain(*a))
    fit_boosted_trees(prepared.train, "udi", 3.0, BoostingConfig(rounds=12, seed=3, block_rows=200))
    assert len(kept) == 12 and max(kept) - before <= 3
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before


def test_leaf_values_are_those_of_a_walk_row_by_row():
    """Random trees of any shape, behind another tree's nodes; missing numbers go right."""
    g = np.random.default_rng(5)
    for size in (0, 1, 7, 40):
        nodes, open_nodes = [(-1, 0.0, -1, -1, g.normal())], [0]
        for _ in range(size):
            n = open_nodes.pop(int(g.integers(len(open_nodes))))
            left, right = (len(nodes), len(nodes) + 1) if g.random() < 0.5 else (len(nodes) + 1, len(nodes))
            nodes[n] = (int(g.integers(3)), float(g.integers(5)), left, right, 0.0)
            open_nodes += [len(nodes), len(nodes) + 1]
            nodes += [(-1, 0.0, -1, -1, g.normal()), (-1, 0.0, -1, -1, g.normal())]
        x = g.integers(0, 6, (50, 3)).astype(float)
        x[::7, 1] = np.nan
        other = [(-1, 0.0, -1, -1, 9.0)]
        table = {"tree": np.array([0] + [1] * len(nodes)), "node": np.array([0, *range(len(nodes))])}
        table |= {c: np.array(v) for c, v in zip(NODE_COLUMNS[2:], zip(*(other + nodes)))}
        want = []
        for row in x:
            n = 0
            while nodes[n][0] >= 0:
                n = nodes[n][2] if row[nodes[n][0]] <= nodes[n][1] else nodes[n][3]
            want.append(nodes[n][4])
        assert leaf_values(x, table, 1, 1 + len(nodes)).tolist() == want
        assert leaf_values(x[:0], table, 1, 1 + len(nodes)).tolist() == []


def test_a_few_blocks_are_fitted_in_a_task(spark, prepared):
    """The trees of a job a level, without these jobs; beyond the bounds the jobs are back."""
    weight, cfg = class_balance(prepared.train).positive_weight(), replace(CFG, rounds=6, block_rows=100)
    blocks = -(-prepared.train.count() // 100)
    assert blocks > 1
    sc, found = spark.sparkContext, {}
    for allowed in (1, blocks - 1, blocks):
        sc.setJobGroup(f"boosting-{allowed}", "")
        model = fit_boosted_trees(prepared.train, "udi", weight, cfg, task_blocks=allowed)
        found[allowed] = nodes_of(model), len(sc.statusTracker().getJobIdsForGroup(f"boosting-{allowed}"))
    sc.setJobGroup("others", "")
    assert found[1][0] == found[blocks - 1][0] == found[blocks][0]
    assert min(found[1][1], found[blocks - 1][1]) >= found[blocks][1] + 6 * CFG.depth - 2


def test_the_candidate_takes_a_few_blocks_in_a_task(spark, monkeypatch):
    import faultscore.operators.boosting as boosting
    from faultscore.operators.candidates import fit_candidate

    config = CandidateConfig(seed=3, boosted_rounds=2, boosted_block_rows=200)
    exp = prepare(machine_frame(spark), S, 3, config)
    balance = class_balance(exp.train)
    monkeypatch.setattr(boosting, "grow_over_blocks", lambda *a: pytest.fail("a job a level"))
    assert 200 < exp.train.count() <= 800
    model, _ = fit_candidate("boosted_trees", exp.train, balance, config, exp.stats.vector_width(S), "udi")
    assert {r.tree for r in model.nodes.collect()} == {0, 1}
    exp.close()


def test_sums_of_rare_bins_and_of_siblings_are_those_of_all_rows():
    import faultscore.operators.boosting as b

    g = np.random.default_rng(7)
    n, sizes = 5000, [2, 2, 9, 40, 1]
    bins = np.stack([g.random(n) < 0.03, g.random(n) > 0.1, g.integers(0, 9, n), g.integers(0, 40, n), np.zeros(n)]).astype(np.uint16)
    label = ((bins[3] > 30) ^ (g.random(n) < 0.1) ^ (bins[0] == 1)).astype(np.int8)
    row = {"n": n, "label": label.tobytes(), "ids": g.integers(0, 2**52, n).astype(np.uint64).tobytes(), "bins": bins.tobytes(), "margin": g.normal(size=n).tobytes()}
    cfg, columns, scale = BoostingConfig(seed=3), [0, 1, 2, 3, 4], b.gradient_scale(3.0, 8192)
    block = b.Block(row)
    block.index()
    assert sorted(block.rare) == [0, 1, 4] and len(block.rare[4][1]) == 0
    block.begin(0, 3.0, scale, cfg)
    seen = []

    def summed(tree):
        """Before a level is chosen: what a plain loop adds up for each open node."""
        at, want = tree.leaves(bins, n), np.zeros((2, len(tree.open), sum(sizes)))
        for i, node in enumerate(tree.open):
            rows, first = np.flatnonzero((at == node) & block.drawn), 0
            for f in columns:
                np.add.at(want[0, i], first + bins[f][rows], block.g[rows])
                np.add.at(want[1, i], first + bins[f][rows], block.h[rows])
                first += sizes[f]
        found = block.sums(tree, columns, sizes)
        assert (found == want[:, tree.lighter()]).all()
        seen.append((want, b.choose_splits(b.by_column(want / scale, columns, sizes), columns, cfg)))
        return found

    tree = b.grow_tree(columns, sizes, scale, cfg, summed)
    assert len(seen) == cfg.depth and seen[-1][0].shape[1] > 2
    plain = b.Tree()
    for _, splits in seen:
        plain.grow(splits)
    assert (plain.feature, plain.bin, plain.left) == (tree.feature, tree.bin, tree.left)
    assert all((p == t).all() for p, t in zip(plain.sums, tree.sums))
    high = b.halves(np.array([[[2.0**52 + 1, -(2.0**40) - 3]]] * 2))
    assert (b.whole_numbers(high + high) == 2 * np.array([2.0**52 + 1, -(2.0**40) - 3])).all()
