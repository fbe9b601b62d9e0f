"""A training run that ends between two stages and is started again."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from faultscore.operators.candidates import CandidateConfig
from faultscore.plans import experiment
from faultscore.plans.experiment import run_experiment
from faultscore.plans.resume import RunFolder, run_digest
from faultscore.schema import MACHINE_TASK as S

from fixtures import machine_frame

CONFIG = CandidateConfig(seed=7, logistic_max_iter=5, include=("majority_baseline", "decision_tree", "logistic_regression"), parallel_fits=1)


def test_a_restarted_run_goes_on_and_reports_the_same(spark, scratch, monkeypatch):
    fit, validate, fitted, audited = experiment.fit_candidate, experiment.validate, [], []

    def lost(name, *rest):
        if name == "logistic_regression":
            raise RuntimeError("driver lost")
        fitted.append(name)
        return fit(name, *rest)

    def seen(*rest):
        audited.append(1)
        return validate(*rest)

    monkeypatch.setattr(experiment, "fit_candidate", lost)
    monkeypatch.setattr(experiment, "validate", seen)
    run = lambda resume: run_experiment(machine_frame(spark), S, seed=7, config=CONFIG, importance_repeats=2, resume_dir=resume)
    with pytest.raises(RuntimeError, match="driver lost"):
        run(scratch)
    assert fitted == ["majority_baseline", "decision_tree"] and audited == [1]

    monkeypatch.setattr(experiment, "fit_candidate", lambda name, *rest: (fitted.append(name), fit(name, *rest))[1])
    resumed = run(scratch)
    assert fitted[2:] == ["logistic_regression"] and audited == [1]  # nothing committed is done again
    again = run(scratch)
    assert len(fitted) == 3 and again.report == resumed.report

    monkeypatch.setattr(experiment, "fit_candidate", fit)
    whole = run(None)
    same = lambda r: {k: v for k, v in json.loads(json.dumps(r)).items() if k != "fitted_rows"}
    assert same(whole.report) == same(resumed.report)
    whole.close()


def test_other_rows_or_settings_are_another_run(spark):
    df = machine_frame(spark, 100)
    first = run_digest(df, S, 7, CONFIG)
    assert first == run_digest(df.repartition(3), S, 7, replace(CONFIG, include=("mlp",), parallel_fits=2))
    changed = df.withColumn("torque", F.when(F.col("udi") == 5, 1.0).otherwise(F.col("torque")))
    others = [run_digest(changed, S, 7, CONFIG), run_digest(df, S, 8, CONFIG), run_digest(df, S, 7, replace(CONFIG, boosted_rounds=3)), run_digest(df.unionByName(df.limit(1)), S, 7, CONFIG)]
    assert len({first, *others}) == 5


def test_a_stage_without_its_record_is_made_anew(spark, scratch):
    folder, made = RunFolder(spark, scratch), []

    def table():
        made.append(1)
        return spark.range(3)

    spark.range(9).write.parquet(f"{scratch}/outputs/t-lost")  # an attempt that was never committed
    assert folder.table("t", table).count() == 3 and folder.table("t", table).count() == 3
    assert made == [1]
    assert RunFolder(spark).committed("t") is None and RunFolder(spark).record("t", lambda: 5) == 5
