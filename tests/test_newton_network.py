"""Newton steps and the mini-batch network against plain numpy."""

from dataclasses import replace

import numpy as np
import pytest
from fixtures import machine_frame
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

import faultscore.operators.network as network
from faultscore.operators.candidates import CandidateConfig, class_balance
from faultscore.operators.network import Adam, NetworkConfig, Weights, fit_network, gradient_sums
from faultscore.operators.newton import fit_logistic
from faultscore.plans.experiment import prepare
from faultscore.schema import MACHINE_TASK as S

CFG = NetworkConfig(hidden=6, epochs=3, batch=200, seed=3)


@pytest.fixture(scope="module")
def prepared(spark):
    exp = prepare(machine_frame(spark), S, 3, CandidateConfig(seed=3))
    yield exp
    exp.close()


def data_of(exp):
    rows = exp.train.orderBy("udi").collect()
    return np.array([r.features.toArray() for r in rows]), np.array([float(r.label) for r in rows]), [r.udi for r in rows]


def test_newton_solution_has_no_gradient(prepared, scratch):
    balance = class_balance(prepared.train)
    model, info = fit_logistic(prepared.train, balance.balanced_weight())
    x, y, _ = data_of(prepared)
    beta, b = np.array(model.getOrDefault("coefficients")), model.getOrDefault("intercept")
    w = np.where(y == 1, balance.rows / (2 * balance.positives), balance.rows / (2 * balance.negatives))
    p = 1 / (1 + np.exp(-(x @ beta + b)))
    gradient = np.r_[x.T @ (w * (p - y)) + beta, (w * (p - y)).sum()]
    assert np.abs(gradient).max() < 1e-8 * len(y)
    assert info["steps"] < 30 and info["objective_history"] == sorted(info["objective_history"], reverse=True)
    PipelineModel(stages=[model]).write().overwrite().save(f"{scratch}/m")
    rows = prepared.part("validation")
    score = lambda m: {r.udi: r.score for r in m.transform(rows).collect()}
    assert score(PipelineModel.load(f"{scratch}/m")) == score(model)


def test_gradient_is_the_slope_of_the_loss():
    g = np.random.default_rng(1)
    x, y = g.normal(size=(30, 4)), g.integers(0, 2, 30).astype(float)
    w, keep = Weights.drawn(4, 5, 7), (g.random((30, 5)) > 0.2) / 0.8
    got = gradient_sums(w, x, y, keep, 3.0)
    for i in range(len(w.vector)):
        ends = []
        for h in (1e-6, -1e-6):
            moved = w.vector.copy()
            moved[i] += h
            ends.append(gradient_sums(Weights(4, 5, moved), x, y, keep, 3.0)[-2])
        assert got[i] == pytest.approx((ends[0] - ends[1]) / 2e-6, abs=1e-5)


def test_one_step_equals_numpy(prepared):
    """One batch of all rows: gradient by autograd-free formulas, Adam by hand."""
    cfg = replace(CFG, epochs=1, batch=10**6, dropout=0.0, decay=0.1)
    model, losses = fit_network(prepared.train, "udi", 4.0, cfg)
    x, y, _ = data_of(prepared)
    w = Weights.drawn(x.shape[1], cfg.hidden, cfg.seed)
    hidden = np.maximum(x @ w.first + w.first_bias, 0)
    z = hidden @ w.second + w.second_bias
    p = 1 / (1 + np.exp(-z))
    assert losses == [pytest.approx(np.mean(np.where(y == 1, -4.0 * np.log(p), -np.log(1 - p))))]
    dz = np.where(y == 1, -4.0 * (1 - p), p) / len(y)
    dh = np.outer(dz, w.second) * (hidden > 0)
    gradient = np.r_[(x.T @ dh).ravel(), dh.sum(0), hidden.T @ dz, dz.sum()] + 0.1 * w.vector
    want = w.vector - cfg.rate * gradient / (np.abs(gradient) + 1e-8)
    import json

    assert json.loads(model.getOrDefault("weights")) == pytest.approx(want, abs=1e-9)
    assert Adam(1, 0.5, 0.0).step(np.zeros(1), np.ones(1)) == pytest.approx([-0.5])


def test_blocks_add_up_to_the_same_network(prepared):
    """The same batches, the rows of each in several blocks."""
    one = fit_network(prepared.train, "udi", 4.0, CFG)
    n = prepared.train.count()
    blocks = network.make_blocks(prepared.train, "udi", "label", "features", 3, CFG.seed)
    vector, losses = network.fit_over_blocks(blocks, 8, max(1, -(-n // CFG.batch)), 4.0, CFG)
    import json

    assert losses == pytest.approx(one[1], rel=1e-9)
    assert vector == pytest.approx(np.array(json.loads(one[0].getOrDefault("weights"))), abs=1e-7)
    assert one[1][-1] < one[1][0]


def test_turns_take_the_steps_of_one_block(prepared):
    """Rows of three blocks, dealt by batch: the same network to the last bit, and a job a turn."""
    import json

    sc = prepared.train.sparkSession.sparkContext
    one = fit_network(prepared.train, "udi", 4.0, CFG)
    n = prepared.train.count()
    blocks = network.make_blocks(prepared.train, "udi", "label", "features", 3, CFG.seed)
    sc.setJobGroup("turns", "turns")
    try:
        vector, losses = network.fit_by_turns(blocks, 8, max(1, -(-n // CFG.batch)), 4.0, CFG)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert losses == one[1]
    assert vector.tolist() == json.loads(one[0].getOrDefault("weights"))
    assert len(sc.statusTracker().getJobIdsForGroup("turns")) <= CFG.epochs * 3 + 5


def test_several_blocks_go_by_turns(prepared, monkeypatch):
    """Two to ``most_turns`` blocks need no job a step."""
    taken = []
    for form in ("fit_in_block", "fit_by_turns", "fit_over_blocks"):
        monkeypatch.setattr(network, form, lambda *a, form=form: (taken.append(form), (np.zeros(61), [0.0]))[1])
    n = prepared.train.count()
    for rows, most in ((n, 256), (-(-n // 3), 256), (-(-n // 3), 2)):
        fit_network(prepared.train, "udi", 4.0, replace(CFG, block_rows=rows, most_turns=most))
    assert taken == ["fit_in_block", "fit_by_turns", "fit_over_blocks"]


def test_kept_units_are_hashed_one_by_one(prepared):
    ids = np.array([0, 1, 7, 2**52 - 1], dtype=np.uint64)
    rows = network.Rows({"ids": ids.tobytes(), "label": bytes(4), "x": np.zeros(4).tobytes()}, 1)
    got = rows.keep(np.array([3, 0, 2]), 5, CFG)
    want = [[network.unit_hash(ids[[i]], CFG.seed, "drop", 5, u)[0] >= int(CFG.dropout * 2**32) for u in range(CFG.hidden)] for i in (3, 0, 2)]
    assert got.tolist() == (np.array(want) / (1 - CFG.dropout)).tolist()


def test_epochs_must_be_positive(prepared):
    with pytest.raises(ValueError, match="epochs must be positive"):
        fit_network(prepared.train, "udi", 4.0, replace(CFG, epochs=0))
