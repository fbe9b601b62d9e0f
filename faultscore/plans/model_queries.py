"""Registered queries whose results come from trained models, in the full
reference configuration on the tables they are given.

Fits cost minutes and are deterministic, so queries over the same rows share
the stages that a run has committed in the shared folder, also across drivers.
Each call digests the whole task table, and a table with other rows is fitted
anew.  Only what a query needs is fitted.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import col, rounded
from ..operators.boosting import fit_boosted_trees
from ..operators.candidates import CANDIDATE_ORDER, LABEL_COL, SCORE_COL, CandidateConfig, PriorScore, boosting_config, class_balance, tree_config
from ..operators.exact_trees import bootstrap, class_weights, fit_tree, training_table
from ..operators.metrics import binary_metrics
from ..operators.parity import score_parity
from ..operators.scoring import predict_rows, score_rows, spread, write_predictions
from ..operators.split import split_summary
from ..operators.threshold import select_threshold
from ..schema import DOCUMENT_TASK, TaskSpec
from ..schema import MACHINE_TASK as S
from ..session import ensure_checkpoint_dir
from ..sources.adapters import load_documents, load_machine
from ..sources.bundle import Bundle, load_bundle, save_bundle
from ..sources.checksums import file_checksums, verify_checksums
from ..sources.csv import read_labelled_csv, read_scoring_csv
from .experiment import (
    Experiment,
    build_report,
    compare,
    evaluate_chosen,
    fit_missing,
    importance_of_chosen,
    importance_rows,
    prepare,
    test_predictions,
    train_candidates,
)
from .resume import run_folder


#: Boosted trees that are compared with SQL node by node.
FIRST_TREES = 2


def prepared(df: DataFrame, spec: TaskSpec = S) -> Experiment:
    """Audit + split + train-only preprocessing of the given rows; the stages are
    committed in the shared folder, where every later query takes them up."""
    config = CandidateConfig(seed=42)
    root = os.path.join(ensure_checkpoint_dir(df.sparkSession), "runs")
    return prepare(df, spec, 42, config, run_folder(df, spec, 42, config, root))


def experiment(spark: SparkSession, sf: str) -> Experiment:
    """The machine experiment with every candidate fitted and the pick made."""
    return evaluate_chosen(train_candidates(prepared(load_machine(spark, sf))))


METRIC_COLUMNS = ("accuracy", "precision", "recall", "f1", "roc_auc", "average_precision", "threshold")


def reported(metrics: DataFrame) -> DataFrame:
    """Metrics rounded to six places, as results are compared."""
    return metrics.withColumns({c: rounded(F.col(c)) for c in METRIC_COLUMNS if c in metrics.columns})


def candidate_comparison(spark: SparkSession, sf: str) -> DataFrame:
    return reported(compare(prepared(load_machine(spark, sf)), CANDIDATE_ORDER))


def _one_model(name: str):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return reported(compare(prepared(load_machine(spark, sf)), (name,)))

    return query


def comparison_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and positives behind each candidate's confusion matrix."""
    m = candidate_comparison(spark, sf)
    return m.select("model", (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("rows"), (F.col("fn") + F.col("tp")).alias("positives"))


def heldout_evaluation(spark: SparkSession, sf: str) -> DataFrame:
    exp = experiment(spark, sf)
    preds = test_predictions(exp).withColumn("model", F.lit(exp.chosen))
    return reported(binary_metrics(preds, "actual_failure", "failure_probability", exp.threshold, ["model"]))


def heldout_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and positives of the held-out evaluation."""
    m = heldout_evaluation(spark, sf)
    return m.select((F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("rows"), (F.col("fn") + F.col("tp")).alias("positives"))


def _consistent(exp: Experiment):
    p = F.col("failure_probability")
    return (p >= 0) & (p <= 1) & (F.col("predicted_failure") == (p >= F.lit(exp.threshold)).cast("int"))


def test_predictions_check(spark: SparkSession, sf: str) -> DataFrame:
    """Held-out ids with their outcome, and whether score and prediction agree."""
    exp = experiment(spark, sf)
    return test_predictions(exp).select("udi", "actual_failure", _consistent(exp).alias("consistent"))


def test_predictions_query(spark: SparkSession, sf: str) -> DataFrame:
    return test_predictions(experiment(spark, sf))


def permutation_importance_model(spark: SparkSession, sf: str) -> DataFrame:
    drops = importance_of_chosen(experiment(spark, sf), 10)
    return drops.withColumns({c: rounded(F.col(c)) for c in ("mean_average_precision_drop", "standard_deviation")})


def experiment_report(spark: SparkSession, sf: str) -> DataFrame:
    """The whole report of the training run, importance included."""
    exp = experiment(spark, sf)
    exp.importance = importance_rows(exp, 10)
    report, test = build_report(exp), exp.test_metrics
    return spark.createDataFrame(
        [(exp.chosen, exp.threshold, test["average_precision"], test["f1"], json.dumps(report, sort_keys=True))],
        "selected_model string, selected_threshold double, test_average_precision double, test_f1 double, report string",
    )


def report_summary(spark: SparkSession, sf: str) -> DataFrame:
    """The parts of the report that no trained model has a share in: rows,
    positives and rate of each split, and the audit of the table."""
    exp = prepared(load_machine(spark, sf))
    parts = split_summary(exp.split, S.target).select(F.col("split").alias("part"), "rows", "positive_rows", rounded(F.col("positive_rate")).alias("positive_rate"))
    audit = spark.createDataFrame([("audit", exp.audit["rows"], exp.audit["positive_rows"], float(exp.audit["positive_rate"]))], "part string, rows long, positive_rows long, positive_rate double")
    return parts.unionByName(audit.withColumn("positive_rate", rounded(F.col("positive_rate"))))


def _bundle_dir(spark: SparkSession, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), "bundles", f"{name}-{uuid.uuid4().hex}")


def _saved_bundle(spark: SparkSession, exp: Experiment) -> tuple[str, Bundle]:
    path = _bundle_dir(spark, exp.chosen)
    save_bundle(spark, Bundle(exp.scorers[exp.chosen], exp.threshold, S.features, exp.chosen, exp.seed), path)
    return path, load_bundle(spark, path, S.features)


def batch_score(spark: SparkSession, sf: str) -> DataFrame:
    """Saved bundle -> load -> score every machine row, keeping the key."""
    return _batch_scored(spark, sf, experiment(spark, sf))


def _batch_scored(spark: SparkSession, sf: str, exp: Experiment) -> DataFrame:
    _, bundle = _saved_bundle(spark, exp)
    return predict_rows(bundle.model, bundle.threshold, spread(load_machine(spark, sf)), S.features, keep=["udi"])


def batch_score_check(spark: SparkSession, sf: str) -> DataFrame:
    """Every machine row once, and whether its score and prediction agree."""
    exp = experiment(spark, sf)
    return _batch_scored(spark, sf, exp).select("udi", _consistent(exp).alias("consistent"))


def bundle_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of the loaded bundle against the in-memory model on test rows."""
    exp = experiment(spark, sf)
    _, bundle = _saved_bundle(spark, exp)
    test = spread(exp.raw_part("test"))
    before = score_rows(exp.scorers[exp.chosen], test, S.features, keep=["udi", S.target])
    after = score_rows(bundle.model, test, S.features, keep=["udi"])
    return score_parity(before, after, "udi", S.target).withColumns(
        {"model_name": F.lit(bundle.model_name), "threshold": F.lit(bundle.threshold)}
    )


def bundle_roundtrip_check(spark: SparkSession, sf: str) -> DataFrame:
    """The round trip loses no row and changes no score."""
    return bundle_roundtrip(spark, sf).select("rows_matched", "unmatched_a", "unmatched_b", rounded(F.col("max_abs_difference"), 12).alias("max_abs_difference"))


def prior_scorer(exp: Experiment) -> tuple[PipelineModel, float]:
    """Preprocessing and the training rate, with its validation threshold."""
    prior = PriorScore().fit(exp.part("train"))
    scorer = PipelineModel(stages=list(exp.preprocessor.stages) + [prior])
    val = score_rows(scorer, exp.raw_part("validation"), S.features, keep=[S.target])
    return scorer, float(select_threshold(val, S.target, SCORE_COL).first()["threshold"])


def batch_score_linear(spark: SparkSession, sf: str) -> DataFrame:
    """Prior-rate model through the full bundle path (SQL-checkable)."""
    exp = prepared(load_machine(spark, sf))
    scorer, t = prior_scorer(exp)
    path = _bundle_dir(spark, "majority_baseline")
    save_bundle(spark, Bundle(scorer, t, S.features, "majority_baseline", exp.seed), path)
    bundle = load_bundle(spark, path, S.features)
    preds = predict_rows(bundle.model, bundle.threshold, exp.raw_part("test"), S.features, keep=["udi"])
    return preds.select("udi", rounded(F.col("failure_probability")).alias("failure_probability"), "predicted_failure")


def written_csv(table: DataFrame, name: str) -> str:
    """The table as headed CSV in the shared folder, the last column first and a
    byte-order mark before the header, as spreadsheets write it."""
    columns = [table.columns[-1], *table.columns[:-1]]
    path = os.path.join(ensure_checkpoint_dir(table.sparkSession), "csv", f"{name}-{uuid.uuid4().hex}")
    marked = table.select(*[col(c) for c in columns]).withColumnRenamed(columns[0], "\ufeff" + columns[0])
    marked.write.option("header", True).csv(path)
    return path


def scan_labelled_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The machine table through a CSV file and its audited reader."""
    machine = load_machine(spark, sf)
    table = read_labelled_csv(spark, written_csv(machine.withColumn("not_asked_for", F.lit("x, \"y\"")), "labelled"), S)
    return table.select(*[col(f.name).cast(f.dataType).alias(f.name) for f in machine.schema.fields])


def batch_score_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Test rows through a CSV file, the saved prior-rate model and the
    prediction file, which is read back."""
    exp = prepared(load_machine(spark, sf))
    scorer, t = prior_scorer(exp)
    path = _bundle_dir(spark, "majority_baseline_csv")
    save_bundle(spark, Bundle(scorer, t, S.features, "majority_baseline", exp.seed), path)
    bundle = load_bundle(spark, path, S.features)
    rows = read_scoring_csv(spark, written_csv(exp.raw_part("test").select("udi", *S.features), "scoring"), S)
    preds = predict_rows(bundle.model, bundle.threshold, rows, S.features, keep=["udi"])
    out = os.path.join(ensure_checkpoint_dir(spark), "csv", f"predictions-{uuid.uuid4().hex}")
    write_predictions(preds, out, "csv")
    back = spark.read.option("header", True).schema("udi long, failure_probability double, predicted_failure int").csv(out)
    return back.select("udi", rounded(F.col("failure_probability")).alias("failure_probability"), "predicted_failure")


def checksums(spark: SparkSession, sf: str) -> DataFrame:
    sums = file_checksums(spark, sf, "*.parquet")
    return sums.select(F.col("path").alias("file"), "length", "sha256")


#: Orders a file of the written shards holds.
SHARD_ORDERS = 5000


def order_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Every order as a line of text, with the shard its key falls into."""
    orders = spark.read.parquet(os.path.join(sf, "orders.parquet"))
    line = F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus")
    return orders.select(F.floor(F.col("o_orderkey") / SHARD_ORDERS).cast("long").alias("shard"), "o_orderkey", line.alias("line"))


def shard_checksums(spark: SparkSession, sf: str) -> DataFrame:
    """The orders written as text, a file a shard in key order, and the files'
    digests by shard, read back block by block."""
    path = os.path.join(ensure_checkpoint_dir(spark), "shards", uuid.uuid4().hex)
    dealt = order_lines(spark, sf).repartition("shard").sortWithinPartitions("shard", "o_orderkey")
    dealt.select("shard", "line").write.partitionBy("shard").text(path)
    sums = file_checksums(spark, path, "part-*")
    return sums.select(F.regexp_extract("path", r"shard=(\d+)/", 1).cast("long").alias("shard"), "length", "sha256")


def checksum_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """The shards' files against a manifest worked out from the rows, in which
    every tenth digest is false and one file more than there are is named."""
    lines = order_lines(spark, sf).groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "line"))).alias("rows"))
    whole = F.concat(F.array_join("rows.line", "\n"), F.lit("\n"))
    digest = F.when(F.col("shard") % 10 == 0, F.lit("0" * 64)).otherwise(F.sha2(whole, 256))
    manifest = lines.select(F.col("shard").cast("string").alias("path"), digest.alias("sha256"))
    missing = lines.agg((F.max("shard") + 1).cast("string").alias("path"), F.lit("f" * 64).alias("sha256"))
    actual = shard_checksums(spark, sf).withColumn("path", F.col("shard").cast("string"))
    return verify_checksums(actual, manifest.unionByName(missing)).select(F.col("path").cast("long").alias("shard"), "expected", "actual")


def node_table(nodes: DataFrame, last_tree: int | None = None) -> DataFrame:
    """A node table as it is compared."""
    kept = nodes if last_tree is None else nodes.where(F.col("tree") <= last_tree)
    return kept.select("tree", "node", "feature", rounded(F.col("threshold")).alias("threshold"), F.col("left").alias("left_node"), F.col("right").alias("right_node"), rounded(F.col("value"), 9).alias("value"))


def boosted_first_trees(spark: SparkSession, sf: str) -> DataFrame:
    """The first trees of the boosted candidate, each node with its sums' outcome."""
    exp = prepared(load_machine(spark, sf))
    cfg = replace(boosting_config(exp.config), rounds=FIRST_TREES)
    return node_table(fit_boosted_trees(exp.train, S.id_column, class_balance(exp.train).positive_weight(), cfg).nodes)


def tree_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """The decision tree, node by node."""
    exp = prepared(load_machine(spark, sf))
    return node_table(fit_tree(exp.train, S.id_column, tree_config("decision_tree", exp.config, 0)).nodes)


def forest_bootstrap(spark: SparkSession, sf: str) -> DataFrame:
    """What each tree of the forest draws, and the class weights of its draw."""
    exp = prepared(load_machine(spark, sf))
    rows = bootstrap(training_table(exp.train, S.id_column, "label", "features"), exp.config.forest_trees, exp.seed)
    # one pass: drawing every row for every tree is the work here
    found = class_weights(rows, F.count(F.lit(1)).alias("rows"), F.max("m").alias("most"))
    return found.select("tree", "rows", F.col("n").alias("draws"), "most", F.col("n1").alias("positive_draws"), rounded(F.col("w0"), 9).alias("w0"), rounded(F.col("w1"), 9).alias("w1"))


def logistic_gradient(spark: SparkSession, sf: str) -> DataFrame:
    """The gradient of the penalised loss at the fitted coefficients, a mean over
    the training rows, worked out row by row without the solver: zero."""
    exp = prepared(load_machine(spark, sf))
    fit_missing(exp, ("logistic_regression",))
    model, balance = exp.models["logistic_regression"], class_balance(exp.train)
    beta = [*model.getOrDefault("coefficients"), 0.0]
    rows = model.transform(exp.train).select(F.concat(vector_to_array("features"), F.array(F.lit(1.0))).alias("x"), (balance.balanced_weight() * (F.col(SCORE_COL) - F.col(LABEL_COL))).alias("e"))
    each = rows.select(F.posexplode("x").alias("position", "x"), "e").groupBy("position").agg(F.sum(F.col("x") * F.col("e")).alias("g"))
    penalty = F.element_at(F.array(*[F.lit(float(b)) for b in beta]), F.col("position") + 1)
    return each.select("position", (rounded((F.col("g") + penalty) / F.lit(float(balance.rows)), 8) + F.lit(0.0)).alias("gradient"))


def document_candidate_comparison(spark: SparkSession, sf: str) -> DataFrame:
    """The same experiment on labels joined to documents (toxic target)."""
    return reported(compare(prepared(load_documents(spark, sf), DOCUMENT_TASK), CANDIDATE_ORDER))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    return candidate_comparison(spark, sf)


R_QUERIES = {
    "model_baseline": _one_model("majority_baseline"),
    "model_logistic": _one_model("logistic_regression"),
    "model_tree": _one_model("decision_tree"),
    "model_forest": _one_model("random_forest"),
    "model_boosted": _one_model("boosted_trees"),
    "model_mlp": _one_model("mlp"),
    "candidate_comparison": candidate_comparison,
    "comparison_counts": comparison_counts,
    "heldout_evaluation": heldout_evaluation,
    "heldout_counts": heldout_counts,
    "test_predictions": test_predictions_query,
    "test_predictions_check": test_predictions_check,
    "permutation_importance_model": permutation_importance_model,
    "experiment_report": experiment_report,
    "batch_score": batch_score,
    "batch_score_check": batch_score_check,
    "bundle_roundtrip": bundle_roundtrip,
    "bundle_roundtrip_check": bundle_roundtrip_check,
    "batch_score_linear": batch_score_linear,
    "report_summary": report_summary,
    "scan_labelled_csv": scan_labelled_csv,
    "batch_score_csv": batch_score_csv,
    "file_checksums": checksums,
    "shard_checksums": shard_checksums,
    "checksum_manifest": checksum_manifest,
    "document_candidate_comparison": document_candidate_comparison,
    "boosted_first_trees": boosted_first_trees,
    "tree_nodes": tree_nodes,
    "logistic_gradient": logistic_gradient,
    "forest_bootstrap": forest_bootstrap,
}
