"""Benchmark: the pipeline stages at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value" (total seconds), "unit", "queries"
(seconds per stage), "sf", ...}.  Every stage forces full execution (noop
sink or a collected aggregate).  Stages named ``published_...`` run at the
published figures' scale (10,000 rows, from the sf0.01 folder beside the
given one): preprocessing, the boosted fit of 500 rounds, the forest of 250
trees, the perceptron, and the whole experiment.  $BENCH_BOOSTED_ROUNDS
overrides the rounds of the fit at the given scale.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark import StorageLevel  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from faultscore.functions.scorers import torque_wear_score  # noqa: E402
from faultscore.operators.audit import validate  # noqa: E402
from faultscore.operators.candidates import CandidateConfig, class_balance, fit_candidate, training_rows  # noqa: E402
from faultscore.operators.importance import permutation_importance  # noqa: E402
from faultscore.operators.metrics import binary_metrics  # noqa: E402
from faultscore.operators.preprocess import fit_preprocessor  # noqa: E402
from faultscore.operators.scoring import predict_rows  # noqa: E402
from faultscore.operators.split import split_summary, stratified_split  # noqa: E402
from faultscore.operators.threshold import select_threshold  # noqa: E402
from faultscore.plans.experiment import prepare, run_experiment, scorer_for  # noqa: E402
from faultscore.schema import MACHINE_TASK as S  # noqa: E402
from faultscore.sources.adapters import load_machine  # noqa: E402


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rounds = int(os.environ.get("BENCH_BOOSTED_ROUNDS", "500"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("faultscore-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="faultscore-bench-", dir="/tmp"))
    spark.range(1000).agg(F.sum("id")).first()  # JVM warm-up, not timed

    times: dict[str, float] = {}
    state: dict = {}

    def stage(name, fn):
        start = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - start, 3)
        return out

    machine = stage("load", lambda: _load(spark, sf_dir))
    stage("audit", lambda: validate(machine, S))

    def split():
        df = stratified_split(machine, S, 42).persist(StorageLevel.MEMORY_AND_DISK)
        state["summary"] = split_summary(df, S.target).collect()
        return df

    parts = stage("split", split)
    train = parts.where(F.col("split") == "train")

    def preprocess():
        model, stats = fit_preprocessor(train, S)
        labelled = parts.select("udi", "split", F.col(S.target).alias("label"), *S.features)
        feats = model.transform(labelled).select("udi", "split", "label", "features").persist(StorageLevel.MEMORY_AND_DISK)
        noop(feats)
        return model, feats

    pre, feats = stage("preprocess_fit_transform", preprocess)
    cfg = CandidateConfig(boosted_rounds=rounds)
    tr = training_rows(feats.where(F.col("split") == "train"), "udi", cfg).persist(StorageLevel.MEMORY_AND_DISK)
    balance = class_balance(tr)

    def scored():
        return parts.select("udi", "split", F.col(S.target).alias("label"),
                            torque_wear_score(F.col("torque"), F.col("tool_wear")).alias("score"))

    def metrics():
        picks = select_threshold(scored(), "label", "score", ["split"]).collect()
        t = {r["split"]: r["threshold"] for r in picks}
        expr = F.lit(None).cast("double")
        for k, v in t.items():
            expr = F.when(F.col("split") == k, F.lit(v)).otherwise(expr)
        return binary_metrics(scored().withColumn("t", expr), "label", "score", "t", ["split"]).collect()

    stage("threshold_and_metrics", metrics)

    def importance():
        rows = parts.where(F.col("split") == "validation").select("udi", *S.features, S.target)
        scorer = lambda df: df.withColumn("score", torque_wear_score(F.col("torque"), F.col("tool_wear")))
        return permutation_importance(rows, S, scorer, 42, 10, S.target).collect()

    stage("permutation_importance", importance)
    models = {}
    for name, key in (("logistic_regression", "logistic_fit"), ("decision_tree", "tree_fit"), ("boosted_trees", "boosted_fit")):
        models[name] = stage(key, lambda n=name: fit_candidate(n, tr, balance, cfg, 8, "udi")[0])

    def score_all():
        class _E:  # minimal holder for scorer_for
            preprocessor = pre
        scorer = scorer_for(_E, "logistic_regression", models["logistic_regression"])
        noop(predict_rows(scorer, 0.5, machine, S.features, keep=["udi"]))

    stage("batch_score", score_all)
    published = os.path.join(os.path.dirname(os.path.abspath(sf_dir)), "sf0.01")
    if os.path.isdir(published):
        _published(spark, published, stage)
    sf_match = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "pipeline_total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf_match.group(1)) if sf_match else sf_dir,
        "rows": {r["split"]: r["rows"] for r in state["summary"]},
        "boosted_rounds": rounds,
        # training + 2,000 validation rows.
        "baseline_seconds": {"published_boosted_trees_fit": 0.8554, "published_preprocess": 0.0370},
        "cpus": int(cpus),
    }))
    spark.stop()


def _published(spark, sf_dir, stage) -> None:
    """The stages of the published figures, at their 6,000 training rows."""
    table = load_machine(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
    noop(table)
    config = CandidateConfig()
    exp = prepare(table, S, 42, config)
    raw = exp.raw_part("train").union(exp.raw_part("validation")).select("udi", *S.features)

    def preprocess():
        model, _ = fit_preprocessor(exp.raw_part("train"), S)
        noop(model.transform(raw).select("features"))

    stage("published_preprocess", preprocess)
    balance = class_balance(exp.train)
    for name in ("boosted_trees", "random_forest", "mlp"):
        stage(f"published_{name}_fit", lambda n=name: fit_candidate(n, exp.train, balance, config, 8, "udi"))
    exp.close()
    stage("published_run_experiment", lambda: run_experiment(table, S, config=config).close())


def _load(spark, sf_dir):
    df = load_machine(spark, sf_dir)
    noop(df)
    return df


if __name__ == "__main__":
    main()
