"""Whole jobs as plain functions: audit a table, train on it, score rows with
a saved bundle, compare training layouts.  Each returns data, not text."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..operators.audit import validate
from ..operators.candidates import CandidateConfig
from ..operators.scoring import predict_rows, write_predictions
from ..schema import TaskSpec
from ..sources.bundle import load_bundle
from ..sources.csv import read_scoring_csv
from .experiment import prepare, run_experiment
from .fit_benchmark import run_fit_benchmark


def audit(df: DataFrame, spec: TaskSpec) -> dict[str, Any]:
    return validate(df, spec)


def train(
    df: DataFrame, spec: TaskSpec, out_dir: str, seed: int = 42, config: CandidateConfig | None = None,
    with_mlp: bool = False,
) -> dict[str, Any]:
    exp = run_experiment(df, spec, out_dir=out_dir, seed=seed, config=config, with_mlp=with_mlp)
    exp.close()
    return {**exp.report, "outcome": {"model": exp.chosen, "threshold": exp.threshold, "held_out": exp.test_metrics}}


def predict(
    spark: SparkSession, spec: TaskSpec, bundle_path: str, input_path: str, out_path: str,
    keep: list[str] | None = None, input_format: str = "csv", output_format: str = "csv",
) -> int:
    """Score every input row; extra input columns listed in ``keep`` stay as keys."""
    bundle = load_bundle(spark, bundle_path, spec.features)
    rows = read_scoring_csv(spark, input_path, spec) if input_format == "csv" else spark.read.format(input_format).load(input_path)
    keep = [k for k in (keep or []) if k in rows.columns]
    predictions = predict_rows(bundle.model, bundle.threshold, rows, spec.features, keep=keep)
    return write_predictions(predictions, out_path, output_format)


def benchmark(df: DataFrame, spec: TaskSpec, seed: int = 42, repeats: int = 3, config: CandidateConfig | None = None) -> dict:
    exp = prepare(df, spec, seed, config)
    try:
        return run_fit_benchmark(exp, repeats=repeats)
    finally:
        exp.close()
