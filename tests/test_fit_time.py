"""What keeps the whole jobs of the model queries short: the same results with
fewer passes, spread over the cores."""

import hashlib
import threading
from dataclasses import replace

import numpy as np
import pytest
from fixtures import machine_frame
from pyspark.sql import functions as F
from test_exact_trees import shape

from faultscore.functions import hashes
from faultscore.operators import candidates, exact_trees
from faultscore.operators.candidates import CandidateConfig, PriorScoreModel, class_balance, fit_candidate, tree_config
from faultscore.operators.ensembles import NODE_SCHEMA, TreeEnsembleModel
from faultscore.operators.exact_trees import TreeConfig, fit_tree, grow_drawn, training_table
from faultscore.operators.scoring import spread
from faultscore.plans import experiment, model_queries
from faultscore.plans.experiment import fit_missing, prepare
from faultscore.plans.resume import run_folder
from faultscore.schema import MACHINE_TASK as S

SMALL = CandidateConfig(seed=3)


@pytest.fixture(scope="module")
def prepared(spark):
    exp = prepare(machine_frame(spark), S, 3, SMALL)
    yield exp
    exp.close()


def test_md5_of_many_texts_is_md5(monkeypatch):
    monkeypatch.setattr(hashes, "TOGETHER", 7)
    g = np.random.default_rng(2)
    for head in (b"", b"42:7:", b"x" * 60):
        for length in (0, 1, 2, 3, 4, 8, 49, 50, 51, 55, 56, 64, 130):
            texts = g.integers(0, 256, (20, length)).astype(np.uint8)
            want = [int(hashlib.md5(head + t.tobytes()).hexdigest()[:16], 16) for t in texts]
            assert hashes.md5_heads(head, texts).tolist() == want
    assert hashes.md5_heads(b"a", np.zeros((0, 4), dtype=np.uint8)).tolist() == []


def test_groups_of_a_drawn_forest_go_with_the_cores(spark, prepared):
    table = training_table(prepared.train, "udi", "label", "features")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        nodes = grow_drawn(table, 250, TreeConfig(min_rows=2, columns=2, seed=3))
        assert nodes.rdd.getNumPartitions() == exact_trees.CORE_GROUPS * spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_the_single_tree_of_a_task_has_the_nodes_of_passes(prepared, monkeypatch):
    config, balance = replace(SMALL, tree_finish_rows=150), class_balance(prepared.train)
    width = prepared.stats.vector_width(S)
    want = shape(fit_tree(prepared.train, "udi", tree_config("decision_tree", config, width)).nodes)
    passes, splits_of = [], exact_trees.splits_of
    monkeypatch.setattr(exact_trees, "splits_of", lambda *a: passes.append(1) or splits_of(*a))
    grown = lambda: shape(fit_candidate("decision_tree", prepared.train, balance, config, width, "udi")[0].nodes)
    assert grown() == want and not passes
    monkeypatch.setattr(candidates, "TREE_TASK_ROWS", balance.rows - 1)  # beyond the bound by passes, as before
    assert grown() == want and passes


def test_the_forest_is_submitted_behind_short_fits(prepared, monkeypatch):
    ended, seen, forest = set(), {}, threading.Event()

    def fit(name, *rest):
        seen[name] = set(ended)
        if name == "random_forest":
            forest.set()
        if name == "boosted_trees":
            assert forest.wait(60)  # the long one runs beside the forest
        ended.add(name)
        return PriorScoreModel(prior=0.1), {}

    monkeypatch.setattr(experiment, "fit_candidate", fit)
    names = ("random_forest", "majority_baseline", "logistic_regression", "decision_tree", "boosted_trees")
    exp = replace(prepared, models={}, extras={}, scorers={})
    fit_missing(exp, names)
    assert {"logistic_regression", "decision_tree", "majority_baseline"} <= seen["random_forest"]
    assert list(exp.models) == list(names)


def test_rows_are_spread_over_the_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(100).coalesce(1)
    assert spread(rows).rdd.getNumPartitions() == cores
    assert sorted(r.id for r in spread(rows).collect()) == list(range(100))
    many = spark.range(100).repartition(cores + 1)
    assert spread(many) is many


def test_the_table_is_worked_out_once_for_audit_and_split(spark, scratch, monkeypatch):
    df, held = machine_frame(spark), []
    validate = experiment.validate
    monkeypatch.setattr(experiment, "validate", lambda rows, spec: held.append((rows, rows.storageLevel.useMemory)) or validate(rows, spec))
    exp = prepare(df, S, 3, SMALL, run_folder(df, S, 3, SMALL, scratch))
    assert [kept for _, kept in held] == [True] and exp.audit["rows"] == df.count()
    assert not held[0][0].storageLevel.useMemory  # released behind it
    plain = prepare(df, S, 3, SMALL)
    assert sorted(map(tuple, exp.split.collect())) == sorted(map(tuple, plain.split.select(*exp.split.columns).collect()))
    plain.close()


def test_nodes_reach_the_driver_as_columns(spark, prepared, monkeypatch):
    nodes = spark.createDataFrame([(1, 0, -1, 0.0, -1, -1, 0.5), (0, 2, -1, 0.0, -1, -1, 1.0), (0, 0, 0, 0.0, 1, 2, 0.0), (0, 1, -1, 0.0, -1, -1, 0.0)], NODE_SCHEMA)
    monkeypatch.setattr(type(nodes), "toPandas", lambda self: pytest.fail("row by row"))
    from pyspark.ml.linalg import Vectors

    rows = spark.createDataFrame([(Vectors.dense([-1.0]),), (Vectors.dense([1.0]),)], ["features"])
    scored = TreeEnsembleModel(trees=2, link="mean").with_nodes(nodes).transform(rows)
    assert sorted(r.score for r in scored.collect()) == [0.25, 0.75]


def test_batch_score_check_goes_through_the_experiment_once(spark, monkeypatch):
    calls, scored = [], spark.createDataFrame([(1, 0.4, 0), (2, 0.6, 1), (3, 0.6, 0)], "udi long, failure_probability double, predicted_failure int")
    found = type("Found", (), {"threshold": 0.5})()
    monkeypatch.setattr(model_queries, "experiment", lambda *a: calls.append(a) or found)
    monkeypatch.setattr(model_queries, "_batch_scored", lambda spark, sf, exp: scored if exp is found else None)
    got = model_queries.batch_score_check(spark, "anywhere")
    assert len(calls) == 1
    assert {r.udi: r.consistent for r in got.collect()} == {1: True, 2: True, 3: False}
    assert got.where(F.col("consistent").isNull()).count() == 0


def test_values_counted_and_sorted_are_the_same_and_constant_columns_are_passed_over(monkeypatch):
    g = np.random.default_rng(4)
    x = np.stack([g.integers(0, k, 400).astype(float) for k in (1, 2, 2, 3, 300)], axis=1)
    y, m = g.integers(0, 2, 400), g.integers(1, 4, 400)
    ranked, cfg, looks = exact_trees.Ranked(x), TreeConfig(min_rows=2, columns=2, seed=5), []
    plain = exact_trees.distinct_values
    grown = lambda: [c.tolist() for c in exact_trees.grow_subtree(ranked, y, m, 0, "", 1.0, 2.0, cfg)]

    def noted(x, f, sizes, r, s, *rest):
        out = plain(x, f, sizes, r, s, *rest)
        looks.append((len(r), len(out[0])))
        return out

    monkeypatch.setattr(exact_trees, "distinct_values", noted)
    counted, rows_counted = grown(), sum(n for n, _ in looks)
    monkeypatch.setattr(exact_trees, "MOST_SUM", 1)  # always sorted
    assert grown() == counted
    level_cuts = exact_trees.level_cuts
    monkeypatch.setattr(exact_trees, "level_cuts", lambda *a: level_cuts(*a[:-1]))  # nothing known from above
    looks.clear()
    assert grown() == counted and sum(n for n, _ in looks) > rows_counted
