"""Exact trees and forests: layouts, plain versions, awkward rows."""

from dataclasses import replace

import numpy as np
import pytest
from fixtures import machine_frame
from pyspark.sql import functions as F

from faultscore.operators.candidates import CandidateConfig
from faultscore.operators import exact_trees
from faultscore.operators.exact_trees import TreeConfig, best_cut, bootstrap, class_weights, draws, drawn_times, fit_forest, fit_tree, grow_trees, training_table
from faultscore.plans.experiment import prepare
from faultscore.schema import MACHINE_TASK as S


@pytest.fixture(scope="module")
def prepared(spark):
    exp = prepare(machine_frame(spark), S, 3, CandidateConfig(seed=3))
    yield exp
    exp.close()


def shape(nodes):
    """Trees as nested tuples, free of node numbers."""
    by = {(r.tree, r.node): r for r in nodes.collect()}

    def walk(tree, node):
        r = by[tree, node]
        return round(r.value, 12) if r.feature < 0 else (r.feature, round(r.threshold, 12), walk(tree, r.left), walk(tree, r.right))

    return {t: walk(t, 0) for t in {t for t, _ in by}}


def test_large_nodes_split_over_all_tasks_give_the_same_tree(prepared):
    cfg = TreeConfig(max_depth=4, min_rows=8, seed=3)
    whole = fit_tree(prepared.train, "udi", cfg).nodes
    spread = fit_tree(prepared.train, "udi", replace(cfg, finish_rows=150)).nodes
    assert shape(whole) == shape(spread)
    assert sorted(r.node for r in spread.collect()) == list(range(spread.count()))


def test_forest_nodes_split_over_all_tasks_give_the_same_trees(prepared):
    cfg = TreeConfig(min_rows=2, columns=2, seed=3)
    whole = fit_forest(prepared.train, "udi", 3, cfg).nodes
    spread = fit_forest(prepared.train, "udi", 3, replace(cfg, finish_rows=200)).nodes
    assert shape(whole) == shape(spread)


def test_all_large_tree_ends_in_leaves(prepared):
    cfg = TreeConfig(max_depth=2, min_rows=8, seed=3)
    assert shape(fit_tree(prepared.train, "udi", cfg).nodes) == shape(fit_tree(prepared.train, "udi", replace(cfg, finish_rows=1)).nodes)


def test_forest_grows_until_leaves_are_pure_or_small(spark, prepared):
    rows = bootstrap(training_table(prepared.train, "udi", "label", "features"), 2, 3)
    nodes = grow_trees(rows, class_weights(rows), TreeConfig(min_rows=1, columns=2, seed=3))
    assert {r.value for r in nodes.where("feature < 0").collect()} == {0.0, 1.0}


def test_draws_are_poisson(prepared):
    rows = bootstrap(training_table(prepared.train, "udi", "label", "features"), 40, 3)
    n = prepared.train.count() * 40
    got = {r.m: r["count"] / n for r in rows.groupBy("m").count().collect()}
    for k, p in ((1, 0.3679), (2, 0.1839), (3, 0.0613)):
        assert got[k] == pytest.approx(p, abs=0.02)
    w = class_weights(rows).first()
    assert w.w0 * (w.n - w.n1) == pytest.approx(w.n / 2) and w.w1 * w.n1 == pytest.approx(w.n / 2)


def test_best_cut_equals_a_plain_search():
    g = np.random.default_rng(1)
    for _ in range(50):
        n = int(g.integers(4, 40))
        x, y, m = g.integers(0, 5, (n, 3)).astype(float), g.integers(0, 2, n), g.integers(1, 4, n)
        best = None
        for f in range(3):
            values = np.unique(x[:, f])
            for a, b in zip(values, values[1:]):
                left = x[:, f] <= a
                if min(left.sum(), (~left).sum()) < 2:
                    continue
                gini = 0.0
                for side in (left, ~left):
                    w = np.array([2.0 * (m * (1 - y))[side].sum(), 3.0 * (m * y)[side].sum()])
                    gini += w.sum() * (1 - ((w / w.sum()) ** 2).sum())
                if best is None or gini < best[0] - 1e-9:
                    best = (gini, f, (a + b) / 2)
        got = best_cut(x, y, m, 2.0, 3.0, TreeConfig(min_rows=2), [0, 1, 2])
        assert (got is None) == (best is None)
        if got:
            assert got == pytest.approx(best[1:])


def test_one_class_and_constant_columns(spark):
    from pyspark.ml.linalg import Vectors

    rows = spark.createDataFrame([(i, 0, Vectors.dense([1.0, float(i)])) for i in range(20)], ["id", "label", "features"])
    assert [(r.feature, r.value) for r in fit_tree(rows, "id", TreeConfig(3, 2)).nodes.collect()] == [(-1, 0.0)]
    same = spark.createDataFrame([(i, i % 2, Vectors.dense([1.0])) for i in range(20)], ["id", "label", "features"])
    assert [(r.feature, r.value) for r in fit_tree(same, "id", TreeConfig(3, 2)).nodes.collect()] == [(-1, 0.5)]


def test_forest_rows_go_out_once_a_group_and_not_once_a_tree(prepared, monkeypatch):
    cfg = TreeConfig(min_rows=2, columns=2, seed=3)
    rows = bootstrap(training_table(prepared.train, "udi", "label", "features"), 11, 3)
    want = shape(grow_trees(rows, class_weights(rows), cfg))
    monkeypatch.setattr(exact_trees, "bootstrap", lambda *a: pytest.fail("a row a tree"))
    assert shape(fit_forest(prepared.train, "udi", 11, cfg).nodes) == want


def test_a_tree_draws_the_same_rows_in_sql_and_in_a_task(spark):
    ids = [str(i) for i in range(3000)] + ["é", "a\nb", ""]
    df = spark.createDataFrame([(i,) for i in [*ids, None]], "id string").withColumn("m", draws(42, F.lit(7), F.col("id")))
    got = {r.id: r.m for r in df.collect()}
    assert got.pop(None) is None
    assert [got[i] for i in ids] == drawn_times(42, 7, [i.encode() for i in ids]).tolist()


def test_sums_of_a_draw_come_with_its_weights(prepared):
    rows = bootstrap(training_table(prepared.train, "udi", "label", "features"), 2, 3)
    found = class_weights(rows, F.count(F.lit(1)).alias("rows"), F.max("m").alias("most"))
    assert {(r.tree, r["rows"], r.most) for r in found.collect()} == {(r.tree, r["rows"], r.most) for r in rows.groupBy("tree").agg(F.count("*").alias("rows"), F.max("m").alias("most")).collect()}
