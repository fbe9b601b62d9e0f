import json
import os

import pytest

from faultscore.operators.candidates import CandidateConfig
from faultscore.operators.scoring import predict_rows
from faultscore.plans.experiment import run_experiment
from faultscore.schema import MACHINE_TASK as S
from faultscore.sources.bundle import load_bundle

from fixtures import machine_frame

SMALL = CandidateConfig(seed=5, forest_trees=30, forest_depth=10, boosted_rounds=30, logistic_max_iter=200)


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("run"))
    exp = run_experiment(machine_frame(spark), S, out_dir=out, seed=5, config=SMALL, importance_repeats=3)
    return exp, out


def test_training_saves_reusable_bundle_and_test_evidence(spark, trained):
    exp, out = trained
    report = exp.report
    assert report["selected_model"] in report["validation_candidates"]
    assert "boosted_trees" in report["validation_candidates"]
    assert report["test_metrics"]["average_precision"] > 0.70
    saved = json.loads("".join(r.value for r in spark.read.text(os.path.join(out, "metrics"), wholetext=True).collect()))
    assert saved == json.loads(json.dumps(report))
    bundle = load_bundle(spark, os.path.join(out, "bundle"), S.features)
    rows = exp.raw_part("test").orderBy("udi").limit(4)
    predictions = predict_rows(bundle.model, bundle.threshold, rows, S.features, keep=["udi"])
    assert predictions.count() == 4
    assert spark.read.option("header", True).csv(os.path.join(out, "test_predictions")).count() == report["split_summary"]["test"]["rows"]
    importance = spark.read.option("header", True).csv(os.path.join(out, "validation_permutation_importance"))
    assert {r.feature for r in importance.collect()} == set(S.features)
    assert len(report["validation_permutation_importance"]) == len(S.features)


def test_selection_rule_and_baseline(trained):
    exp, _ = trained
    metrics = exp.validation_metrics
    best = max(metrics.values(), key=lambda m: (m["average_precision"], m["f1"]))
    assert metrics[exp.chosen]["average_precision"] == best["average_precision"]
    # the prior baseline scores every row the same: AP = positive rate
    base = metrics["majority_baseline"]
    positives = base["confusion_matrix"][1][0] + base["confusion_matrix"][1][1]
    rows = sum(sum(r) for r in base["confusion_matrix"])
    assert base["average_precision"] == pytest.approx(positives / rows, abs=1e-6)
    for m in metrics.values():
        assert 0.01 <= m["threshold"] <= 0.99


def test_test_split_scored_once_with_validation_threshold(trained):
    exp, _ = trained
    assert exp.test_metrics["threshold"] == exp.validation_metrics[exp.chosen]["threshold"]
    cm = exp.test_metrics["confusion_matrix"]
    assert sum(map(sum, cm)) == exp.report["split_summary"]["test"]["rows"]


def test_scoring_keeps_cardinality_with_unknown_and_missing_values(spark, trained):
    exp, _ = trained
    rows = spark.createDataFrame(
        [(1, "L", 298.1, 308.6, 1551.0, 42.8, 0.0), (2, "Z", None, 310.1, 1280.0, 67.5, 220.0), (3, None, 300.0, float("nan"), 1400.0, 50.0, 100.0)],
        "id long, type string, air_temperature double, process_temperature double, rotational_speed double, torque double, tool_wear double",
    )
    out = predict_rows(exp.scorers[exp.chosen], exp.threshold, rows, S.features, keep=["id"]).collect()
    assert sorted(r.id for r in out) == [1, 2, 3]
    assert all(0.0 <= r.failure_probability <= 1.0 for r in out)
    assert all(r.predicted_failure == int(r.failure_probability >= exp.threshold) for r in out)


def test_missing_feature_at_scoring_is_rejected(spark, trained):
    exp, _ = trained
    rows = spark.createDataFrame([(1.0,)], "torque double")
    with pytest.raises(ValueError, match="prediction rows are missing features"):
        predict_rows(exp.scorers[exp.chosen], 0.5, rows, S.features)


def test_bundle_rejections(spark, trained, tmp_path):
    exp, out = trained
    with pytest.raises(ValueError, match="feature schema does not match"):
        load_bundle(spark, os.path.join(out, "bundle"), tuple(reversed(S.features)))
    with pytest.raises(ValueError, match="invalid model bundle"):
        load_bundle(spark, str(tmp_path / "nothing-here"), S.features)


def test_training_requires_a_positive(spark):
    from faultscore.operators.candidates import class_balance

    df = spark.createDataFrame([(0,), (0,)], "label int")
    with pytest.raises(ValueError, match="at least one positive"):
        class_balance(df)


def test_candidate_choice_rejects_empty():
    from faultscore.operators.selection import choose_from_rows

    with pytest.raises(ValueError, match="at least one candidate"):
        choose_from_rows([])


def test_boosted_configuration_is_frozen():
    from faultscore.operators.candidates import BOOSTED_PARAMETERS, ClassBalance, settings

    assert BOOSTED_PARAMETERS["n_estimators"] == 500 and BOOSTED_PARAMETERS["max_depth"] == 4
    used = settings("boosted_trees", ClassBalance(100, 10), CandidateConfig(seed=17), 8)
    assert used["rounds"] == 500 and used["step"] == 0.05 and used["depth"] == 4 and used["seed"] == 17
    assert used["subsample"] == used["column_fraction"] == 0.8 and used["min_child_hessian"] == 2.0
    assert used["l2"] == 1.0 and used["l1"] == 0.0 and used["positive_weight"] == 9.0
    assert ClassBalance(100, 10).positive_weight() == 9.0


def test_prediction_sink_reports_count(spark, trained, tmp_path):
    from faultscore.operators.scoring import write_predictions

    exp, _ = trained
    preds = predict_rows(exp.scorers[exp.chosen], exp.threshold, exp.raw_part("validation"), S.features, keep=["udi"])
    assert write_predictions(preds, str(tmp_path / "nested" / "out"), "csv") == exp.report["split_summary"]["validation"]["rows"]


def test_prediction_count_is_of_this_write(spark, trained, tmp_path):
    from faultscore.operators.scoring import write_predictions

    exp, _ = trained
    preds = predict_rows(exp.scorers[exp.chosen], exp.threshold, exp.raw_part("test"), S.features, keep=["udi"])
    counts = [write_predictions(preds, str(tmp_path / "out"), mode="append") for _ in range(2)]
    assert counts == [exp.report["split_summary"]["test"]["rows"]] * 2


def test_close_scores_pick_by_full_doubles():
    from faultscore.operators.selection import choose_from_rows

    rows = [{"name": "a", "average_precision": 0.5002793438, "f1": 0.9}, {"name": "b", "average_precision": 0.5002793463, "f1": 0.1}]
    assert choose_from_rows(rows)["name"] == "b"


def test_fits_do_not_depend_on_the_input_layout(spark):
    from faultscore.operators.candidates import SCORE_COL
    from faultscore.plans.experiment import candidate_scores, prepare

    names = ("random_forest", "boosted_trees")
    cfg = CandidateConfig(seed=2, forest_trees=10, forest_depth=6, boosted_rounds=4)
    scores = []
    for parts in (1, 4, 8):
        exp = prepare(machine_frame(spark).repartition(parts), S, 2, cfg)
        scores.append(sorted((r.model, r.udi, r[SCORE_COL]) for r in candidate_scores(exp, names).collect()))
        exp.close()
    assert scores[0] == scores[1] == scores[2]


def test_fit_share_bounds_the_fitted_rows(spark):
    from faultscore.plans.experiment import prepare

    exp = prepare(machine_frame(spark), S, 2, CandidateConfig(seed=2, fit_share=0.5))
    assert 200 < exp.train.count() < 400
    exp.close()


def test_a_replaced_file_gives_new_rows(spark, tmp_path):
    from faultscore.plans.model_queries import R_QUERIES

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    for n in (1000, 600):
        events.where(f"event_id < (SELECT min(event_id) FROM parquet.`/root/testdata/sf0.001/events.parquet`) + {n}").write.mode("overwrite").parquet(str(tmp_path / "events.parquet"))
        rows = spark.read.parquet(str(tmp_path / "events.parquet")).count()
        assert R_QUERIES["batch_score_linear"](spark, str(tmp_path)).count() == pytest.approx(rows * 0.2, abs=2)


def test_fit_benchmark_reports_medians_and_parity(spark):
    from faultscore.plans.experiment import prepare
    from faultscore.plans.fit_benchmark import run_fit_benchmark

    exp = prepare(machine_frame(spark, 400), S, 3, CandidateConfig(seed=3, boosted_rounds=3))
    report = run_fit_benchmark(exp, repeats=2, partitions=(4, 1))
    assert {(r["kind"], r["repeats"]) for r in report["layouts"]} == {("4", 2), ("1", 2)}
    parity = report["parity_with_first"][1]
    assert parity["rows_matched"] == 80 and parity["unmatched_a"] == 0
    assert report["splits_read"] == ["train", "validation"]
    with pytest.raises(ValueError, match="repeats must be at least one"):
        run_fit_benchmark(exp, repeats=0)


def test_mlp_comparison_reports_losses_and_both_splits(trained):
    from faultscore.plans.experiment import mlp_comparison

    exp, _ = trained
    exp.config.mlp_epochs = 10
    report = mlp_comparison(exp)
    assert report["layers"] == [8, 24, 1] and report["hidden_activation"] == "ReLU"
    assert report["objective"]["first"] > report["objective"]["last"]
    assert report["metrics"]["test"]["threshold"] == report["metrics"]["validation"]["threshold"] == report["threshold"]
    assert sum(map(sum, report["metrics"]["test"]["confusion_matrix"])) == exp.report["split_summary"]["test"]["rows"]


def test_second_task_with_two_categoricals(spark):
    from faultscore.plans.experiment import evaluate_chosen, prepare, train_candidates
    from faultscore.schema import DOCUMENT_TASK
    from faultscore.sources.adapters import load_documents

    from fixtures import SF01

    cfg = CandidateConfig(seed=1, include=("majority_baseline", "logistic_regression"))
    exp = prepare(load_documents(spark, SF01), DOCUMENT_TASK, 1, cfg)
    names = exp.stats.vector_names(DOCUMENT_TASK)
    assert names[0] == "n_chars" and len(names) == 1 + len(exp.stats.categories["lang"]) + len(exp.stats.categories["source"])
    train_candidates(exp)
    evaluate_chosen(exp)
    assert set(exp.validation_metrics) == {"majority_baseline", "logistic_regression"}
    assert sum(map(sum, exp.test_metrics["confusion_matrix"])) == exp.part("test").count()


def test_prediction_file_is_in_id_order(spark, trained):
    _, out = trained
    path = os.path.join(out, "test_predictions")
    files = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    ids = []
    for name in files:
        with open(os.path.join(path, name), encoding="utf-8") as f:
            ids += [int(line.split(",")[0]) for line in f.read().splitlines()[1:] if line]
    assert ids == sorted(ids) and len(ids) > 0


def test_predict_command_from_csv_by_name(spark, trained, tmp_path):
    from faultscore.plans.commands import predict

    _, out = trained
    path = tmp_path / "rows.csv"
    # two scoring rows in the shape of the reference's example file, extra key column last
    path.write_text(
        "type,air_temperature,process_temperature,rotational_speed,torque,tool_wear,row\n"
        "L,12,30,30,42.8,0,a\nH,3,10,50,167.5,80,b\n",
        encoding="utf-8",
    )
    written = predict(spark, S, os.path.join(out, "bundle"), str(path), str(tmp_path / "pred"), keep=["row"])
    assert written == 2
    got = spark.read.option("header", True).csv(str(tmp_path / "pred")).collect()
    assert sorted(r.row for r in got) == ["a", "b"]
