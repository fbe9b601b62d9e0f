"""The train -> select -> evaluate -> explain -> save plan.

With a run folder (``resume``) every stage is committed as it ends, and a run
that is started again over the same rows and settings goes on from there.

To the driver come class counts, split boundaries, preprocessing statistics
(with the category lists), one metrics row per candidate, the chosen name and
threshold, and the fitted trees.  Candidates are scored into ONE unioned
validation table so a single grouped sweep and a single grouped metrics job
cover all of them.  What a run persists it releases in ``close``.
"""

from __future__ import annotations

import json
import os
from concurrent.futures import ThreadPoolExecutor, wait
from dataclasses import asdict, dataclass, field
from functools import reduce
from typing import Any

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, predicted
from ..operators.audit import validate
from ..operators.candidates import (
    LABEL_COL,
    SCORE_COL,
    CandidateConfig,
    ProbabilityScore,
    class_balance,
    fit_candidate,
    network_config,
    settings,
    training_rows,
    writes_probability,
)
from ..operators.importance import permutation_importance
from ..operators.metrics import binary_metrics
from ..operators.preprocess import FEATURES_COL, PreprocessStats, fit_preprocessor
from ..operators.scoring import spread
from ..operators.selection import choose_from_rows
from ..operators.split import TEST, TRAIN, VALIDATION, split_summary, stratified_split
from ..operators.threshold import select_threshold
from ..schema import TaskSpec
from ..session import ensure_checkpoint_dir
from ..sources.bundle import Bundle, save_bundle
from .resume import RunFolder, run_folder

#: Criteria in the order in which they decide.
SELECTION_CRITERIA = ["validation average_precision", "validation f1", "candidate order"]
THRESHOLD_CRITERIA = ["validation f1", "recall", "distance to 0.5", "lowest threshold"]
#: Fits of a few short jobs, and those whose tasks keep every core busy: a job that
#: is submitted behind these waits for all their tasks, so they come last.
SHORT_FITS = ("majority_baseline", "logistic_regression", "decision_tree")
WIDE_FITS = ("random_forest",)
METRIC_FIELDS = ("threshold", "accuracy", "precision", "recall", "f1", "roc_auc", "average_precision")


@dataclass
class Experiment:
    spec: TaskSpec
    seed: int
    config: CandidateConfig
    split: DataFrame
    audit: dict[str, Any]
    preprocessor: PipelineModel
    stats: PreprocessStats
    features: DataFrame  # id, split, label, features (persisted, or a committed table)
    folder: RunFolder
    train: DataFrame | None = None  # training rows of features, in the layout to fit
    models: dict[str, Any] = field(default_factory=dict)  # fitted classifiers (on the feature vector)
    scorers: dict[str, PipelineModel] = field(default_factory=dict)  # preprocessing + classifier + score
    extras: dict[str, dict] = field(default_factory=dict)
    validation_metrics: dict[str, dict] = field(default_factory=dict)
    chosen: str | None = None
    threshold: float | None = None
    test_metrics: dict | None = None
    importance: list[dict] | None = None
    report: dict | None = None
    held: list[DataFrame] = field(default_factory=list)  # persisted by this run

    def hold(self, df: DataFrame) -> DataFrame:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        self.held.append(df)
        return df

    def close(self) -> None:
        """Release what the run persisted; fitted models stay usable."""
        while self.held:
            self.held.pop().unpersist()

    def part(self, name: str) -> DataFrame:
        return self.features.where(F.col("split") == name)

    def raw_part(self, name: str) -> DataFrame:
        return self.split.where(F.col("split") == name)


def metrics_record(row: dict) -> dict:
    """The reference's metrics record: seven scalars and the 2x2 matrix."""
    out = {k: row[k] for k in METRIC_FIELDS}
    out["confusion_matrix"] = [[int(row["tn"]), int(row["fp"])], [int(row["fn"]), int(row["tp"])]]
    return out


def prepare(df: DataFrame, spec: TaskSpec, seed: int = 42, config: CandidateConfig | None = None, folder: RunFolder | None = None) -> Experiment:
    """Audit once, split, fit preprocessing on train, featurize every split."""
    ensure_checkpoint_dir(df.sparkSession)
    folder = folder or RunFolder(df.sparkSession)
    if not folder.keeps or folder.committed("split") is not None:
        return _prepared(df, spec, seed, config, folder)
    # audit and split go through the table half a dozen times
    held = spread(df).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _prepared(held, spec, seed, config, folder)
    finally:
        held.unpersist()


def _prepared(df: DataFrame, spec: TaskSpec, seed: int, config: CandidateConfig | None, folder: RunFolder) -> Experiment:
    audit = folder.record("audit", lambda: validate(df, spec))
    classes = {0: audit["rows"] - audit["positive_rows"], 1: audit["positive_rows"]}
    split = folder.table("split", lambda: stratified_split(df, spec, seed, class_rows=classes))
    if not folder.keeps:
        split = split.persist(StorageLevel.MEMORY_AND_DISK)

    def fitted() -> tuple[PipelineModel, dict]:
        model, stats = fit_preprocessor(split.where(F.col("split") == TRAIN), spec)
        return model, asdict(stats)

    preprocessor, stats = folder.model("preprocessing", fitted)
    labelled = split.select(col(spec.id_column), "split", col(spec.target).cast("int").alias(LABEL_COL), *[col(f) for f in spec.features])
    features = folder.table("features", lambda: preprocessor.transform(labelled).select(col(spec.id_column), "split", LABEL_COL, FEATURES_COL))
    exp = Experiment(spec, seed, config or CandidateConfig(seed=seed), split, audit, preprocessor, PreprocessStats(**stats), features, folder)
    if not folder.keeps:
        exp.held.append(split)
        exp.features = exp.hold(features)
    exp.train = training_rows(exp.part(TRAIN), spec.id_column, exp.config)
    if not folder.keeps:
        exp.train = exp.hold(exp.train)
    return exp


def scorer_for(exp: Experiment, name: str, model) -> PipelineModel:
    """preprocessing + classifier (+ score stage) as one persistable model."""
    stages = list(exp.preprocessor.stages) + [model]
    if writes_probability(model):
        stages.append(ProbabilityScore())
    return PipelineModel(stages=stages)


def score_features(exp: Experiment, name: str, model, rows: DataFrame) -> DataFrame:
    scored = model.transform(rows)
    if writes_probability(model):
        scored = ProbabilityScore().transform(scored)
    return scored.select(col(exp.spec.id_column), LABEL_COL, SCORE_COL)


def fit_missing(exp: Experiment, names: tuple[str, ...]) -> None:
    """Fit those of the named candidates that the experiment has not fitted yet.

    Fits are independent and seeded; submitting them from a few driver threads
    overlaps their small per-iteration jobs (Spark schedules concurrent jobs;
    results do not depend on the interleaving).
    """
    missing = [n for n in names if n not in exp.models]
    if not missing:
        return
    width = exp.stats.vector_width(exp.spec)
    # committed tables are not kept in memory but while something is fitted to them
    fitting = exp.folder.keeps and any(exp.folder.committed(f"candidate-{n}") is None for n in missing)
    train = exp.train.persist(StorageLevel.MEMORY_AND_DISK) if fitting else exp.train
    try:
        balance = class_balance(train) if fitting or not exp.folder.keeps else None

        def one(name: str):
            return exp.folder.model(f"candidate-{name}", lambda: fit_candidate(name, train, balance, exp.config, width, exp.spec.id_column))

        with ThreadPoolExecutor(max_workers=max(1, min(len(missing), exp.config.parallel_fits))) as pool:
            futures = {name: pool.submit(one, name) for name in missing if name not in WIDE_FITS}
            wait([future for name, future in futures.items() if name in SHORT_FITS])
            futures |= {name: pool.submit(one, name) for name in missing if name in WIDE_FITS}
            fitted = {name: futures[name].result() for name in missing}
    finally:
        if fitting:
            train.unpersist()
    for name, (model, extra) in fitted.items():
        exp.models[name], exp.extras[name] = model, extra
        exp.scorers[name] = scorer_for(exp, name, model)


def candidate_scores(exp: Experiment, names: tuple[str, ...], part: str = VALIDATION) -> DataFrame:
    """id, label, score, model and ordinal of each named candidate, fitted if need be."""
    fit_missing(exp, names)
    rows = spread(exp.part(part))
    frames = [score_features(exp, n, exp.models[n], rows).withColumns({"model": F.lit(n), "ordinal": F.lit(i)}) for i, n in enumerate(names)]
    return reduce(DataFrame.unionByName, frames)


def at_thresholds(scores: DataFrame, picks: dict[str, float]) -> DataFrame:
    """The scores with each model's threshold (one per candidate) as a column."""
    per_model = F.lit(None).cast("double")
    for name, t in picks.items():
        per_model = F.when(F.col("model") == name, F.lit(t)).otherwise(per_model)
    return scores.withColumn("threshold", per_model)


def compare(exp: Experiment, names: tuple[str, ...]) -> DataFrame:
    """Validation metrics of the named candidates, each at its own threshold."""
    scores = exp.folder.table("scores-" + "-".join(names), lambda: candidate_scores(exp, names))
    if not exp.folder.keeps:
        scores = exp.hold(scores)
    picks = {r["model"]: float(r["threshold"]) for r in select_threshold(scores, LABEL_COL, SCORE_COL, ["model"]).collect()}
    return binary_metrics(at_thresholds(scores, picks), LABEL_COL, SCORE_COL, "threshold", ["model"])


def train_candidates(exp: Experiment, names: tuple[str, ...] | None = None) -> Experiment:
    """fit each candidate on train, score validation, sweep, measure."""
    names = names or exp.config.include

    def measured() -> dict[str, dict]:
        by_name = {r["model"]: r.asDict() for r in compare(exp, names).collect()}
        return {name: metrics_record(by_name[name]) for name in names}

    exp.validation_metrics.update(exp.folder.record("validation-" + "-".join(names), measured))
    return exp


def evaluate_chosen(exp: Experiment) -> Experiment:
    """H2 + I1: pick on validation, score test once with that threshold."""
    best = choose_from_rows([dict(name=n, **m) for n, m in exp.validation_metrics.items()])
    exp.chosen, exp.threshold = best["name"], float(best["threshold"])
    fit_missing(exp, (exp.chosen,))

    def measured() -> dict:
        test_scores = score_features(exp, exp.chosen, exp.models[exp.chosen], spread(exp.part(TEST)))
        return metrics_record(binary_metrics(test_scores, LABEL_COL, SCORE_COL, exp.threshold).first().asDict())

    exp.test_metrics = exp.folder.record(f"test-{exp.chosen}", measured)
    return exp


def test_predictions(exp: Experiment) -> DataFrame:
    """A4: id, actual_failure, failure_probability, predicted_failure."""
    model = exp.models[exp.chosen]
    scores = score_features(exp, exp.chosen, model, exp.part(TEST))
    return scores.select(
        col(exp.spec.id_column),
        F.col(LABEL_COL).alias("actual_failure"),
        F.col(SCORE_COL).alias("failure_probability"),
        predicted(F.col(SCORE_COL), exp.threshold).alias("predicted_failure"),
    )


def importance_of_chosen(exp: Experiment, repeats: int = 10) -> DataFrame:
    spec = exp.spec
    rows = exp.raw_part(VALIDATION).select(col(spec.id_column), *[col(f) for f in spec.features], col(spec.target))
    return permutation_importance(rows, spec, exp.scorers[exp.chosen].transform, exp.seed, repeats, spec.target)


def importance_rows(exp: Experiment, repeats: int = 10) -> list[dict]:
    """The importance table as the report holds it: a row a feature."""
    return exp.folder.record(f"importance-{exp.chosen}-{repeats}", lambda: [r.asDict() for r in importance_of_chosen(exp, repeats).collect()])


def build_report(exp: Experiment) -> dict:
    balance, width = class_balance(exp.train), exp.stats.vector_width(exp.spec)
    summary = {
        r["split"]: {"rows": int(r["rows"]), "positive_rows": int(r["positive_rows"]), "positive_rate": float(r["positive_rate"])}
        for r in split_summary(exp.split, exp.spec.target).collect()
    }
    return {
        "split_summary": {k: summary[k] for k in (TRAIN, VALIDATION, TEST) if k in summary},
        "selection_criteria": SELECTION_CRITERIA,
        "threshold_criteria": THRESHOLD_CRITERIA,
        "estimators": {n: settings(n, balance, exp.config, width) for n in exp.validation_metrics},
        "fitted_rows": {"partitions": exp.train.rdd.getNumPartitions(), "share_of_training_ids": exp.config.fit_share},
        "validation_candidates": exp.validation_metrics,
        "selected_model": exp.chosen,
        "selected_threshold": exp.threshold,
        "validation_permutation_importance": exp.importance,
        "test_metrics": exp.test_metrics,
        "dataset_audit": exp.audit,
    }


def write_text(spark, text: str, path: str) -> None:
    """A small text artefact written through Spark (shared storage safe)."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def run_experiment(
    df: DataFrame,
    spec: TaskSpec,
    out_dir: str | None = None,
    seed: int = 42,
    config: CandidateConfig | None = None,
    importance_repeats: int = 10,
    with_mlp: bool = False,
    resume_dir: str | None = None,
) -> Experiment:
    """The whole training run; writes bundle, predictions, importance, report.

    ``resume_dir`` is a folder that every driver sees: stages are committed
    below it, and a run started again takes up what is committed.
    """
    folder = run_folder(df, spec, seed, config or CandidateConfig(seed=seed), resume_dir) if resume_dir else None
    exp = prepare(df, spec, seed, config, folder)
    train_candidates(exp)
    evaluate_chosen(exp)
    exp.importance = importance_rows(exp, importance_repeats)
    if with_mlp:
        exp_mlp = mlp_comparison(exp)
        exp.extras["mlp_comparison"] = exp_mlp
    exp.report = build_report(exp)
    if with_mlp:
        exp.report["mlp_comparison"] = exp.extras["mlp_comparison"]
    if out_dir:
        spark = df.sparkSession
        save_bundle(spark, Bundle(exp.scorers[exp.chosen], exp.threshold, spec.features, exp.chosen, seed),
                    os.path.join(out_dir, "bundle"))
        # id order as in the reference's file: a range-partitioned sort at the sink only
        test_predictions(exp).orderBy(col(spec.id_column)).write.mode("overwrite").option("header", True).csv(
            os.path.join(out_dir, "test_predictions")
        )
        measured = df.sparkSession.createDataFrame([tuple(r.values()) for r in exp.importance], list(exp.importance[0])).coalesce(1)  # a row a feature
        measured.write.mode("overwrite").option("header", True).csv(os.path.join(out_dir, "validation_permutation_importance"))
        write_text(spark, json.dumps(exp.report, indent=2), os.path.join(out_dir, "metrics"))
    return exp


def mlp_comparison(exp: Experiment) -> dict:
    """network fitted on train, threshold from validation, measured on
    validation and test; it stands outside the selection."""
    fit_missing(exp, ("mlp",))
    model, history = exp.models["mlp"], exp.extras["mlp"].get("objective_history", [])
    score = lambda part: score_features(exp, "mlp", model, exp.part(part))
    t = float(select_threshold(score(VALIDATION), LABEL_COL, SCORE_COL).first()["threshold"])
    measured = {part: metrics_record(binary_metrics(score(part), LABEL_COL, SCORE_COL, t).first().asDict()) for part in (VALIDATION, TEST)}
    return {
        "layers": [exp.stats.vector_width(exp.spec), exp.config.mlp_hidden, 1],
        "hidden_activation": "ReLU",
        "dropout": network_config(exp.config).dropout,
        "epochs": exp.config.mlp_epochs,
        "objective": {"first": history[0] if history else None, "last": history[-1] if history else None},
        "threshold": t,
        "metrics": measured,
    }
