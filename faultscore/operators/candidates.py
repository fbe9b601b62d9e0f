"""Candidate classifiers (F1-F9) on the preprocessed feature vector.

Every fitted candidate ends in a stage that writes ``score`` = probability
of class 1 as a double column, so metrics, thresholds and scoring treat
all candidates alike.  Each has the reference's configuration:

* majority_baseline  - the training positive rate for every row
* logistic_regression - balanced class weights, C = 1, Newton steps (``newton``;
                       MLlib's L-BFGS for vectors too wide for a Gram matrix)
* decision_tree      - exact cuts (``exact_trees``), depth 6, min 8 rows per
                       node, balanced weights
* random_forest      - 250 exact trees without a depth limit, min 2 rows per
                       node, sqrt features, weights balanced in each bootstrap
* boosted_trees      - second-order boosting on histograms (``boosting``) in
                       the frozen configuration, positives weighted neg/pos
* mlp                - 24 ReLU units, dropout, mini-batches (``network``; for
                       comparison only)
"""

from __future__ import annotations

import math
from dataclasses import asdict, dataclass, field, replace
from typing import Any

from pyspark import SparkContext, keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasLabelCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, hash_key
from .boosting import BoostingConfig, fit_boosted_trees
from .exact_trees import TreeConfig, fit_forest, fit_tree
from .network import NetworkConfig, fit_network
from .newton import WIDEST, fit_logistic
from .preprocess import FEATURES_COL

LABEL_COL = "label"
WEIGHT_COL = "class_weight"
SCORE_COL = "score"

# The reference's frozen candidate configuration.
BOOSTED_PARAMETERS: dict[str, Any] = {
    "n_estimators": 500,
    "learning_rate": 0.05,
    "max_depth": 4,
    "subsample": 0.8,
    "colsample_bytree": 0.8,
    "min_child_weight": 2.0,
    "reg_lambda": 1.0,
    "reg_alpha": 0.0,
}
#: Blocks (1,048,576 rows) that boosting goes through in one task, where a job a level would take longer.
BOOSTED_TASK_BLOCKS = 4
#: Rows of a tree that are grown in one task, where a pass a level would take longer (if they
#: are ``TREE_TASK_VALUES`` values at most: a task holds them as ranks of one to four bytes).
TREE_TASK_ROWS = 4_194_304
TREE_TASK_VALUES = 33_554_432
CANDIDATE_ORDER = ("majority_baseline", "logistic_regression", "decision_tree", "random_forest", "boosted_trees")


class ProbabilityScore(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """score = probability vector element 1 (JVM-side vector_to_array)."""

    @keyword_only
    def __init__(self, inputCol: str = "probability", outputCol: str = SCORE_COL):
        super().__init__()
        self._setDefault(inputCol="probability", outputCol=SCORE_COL)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), vector_to_array(F.col(self.getInputCol()))[1])


class _PriorParams(HasLabelCol, HasOutputCol):
    prior = Param(Params._dummy(), "prior", "training positive rate", typeConverter=TypeConverters.toFloat)


class PriorScoreModel(Model, _PriorParams, DefaultParamsReadable, DefaultParamsWritable):
    """Constant score = the training positive rate (a literal, no join)."""

    @keyword_only
    def __init__(self, prior: float = 0.0, labelCol: str = LABEL_COL, outputCol: str = SCORE_COL):
        super().__init__()
        self._setDefault(prior=0.0, labelCol=LABEL_COL, outputCol=SCORE_COL)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), F.lit(float(self.getOrDefault(self.prior))))


class PriorScore(Estimator, _PriorParams, DefaultParamsReadable, DefaultParamsWritable):
    """Majority baseline: fit = one average over the training labels."""

    @keyword_only
    def __init__(self, labelCol: str = LABEL_COL, outputCol: str = SCORE_COL):
        super().__init__()
        self._setDefault(labelCol=LABEL_COL, outputCol=SCORE_COL)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> PriorScoreModel:
        rate = dataset.agg(F.avg(F.col(self.getLabelCol()).cast("double"))).first()[0]
        return PriorScoreModel(prior=float(rate or 0.0), labelCol=self.getLabelCol(), outputCol=self.getOutputCol())


@dataclass(frozen=True)
class ClassBalance:
    rows: int
    positives: int

    @property
    def negatives(self) -> int:
        return self.rows - self.positives

    def balanced_weight(self) -> Column:
        """n / (2 * n_class) for the row's class."""
        pos_w = self.rows / (2.0 * self.positives)
        neg_w = self.rows / (2.0 * self.negatives) if self.negatives else 0.0
        return F.when(F.col(LABEL_COL) == 1, F.lit(pos_w)).otherwise(F.lit(neg_w))

    def positive_weight(self) -> float:
        """F8: training negatives / training positives."""
        return self.negatives / self.positives

    def positive_scaled_weight(self) -> Column:
        return F.when(F.col(LABEL_COL) == 1, F.lit(self.positive_weight())).otherwise(F.lit(1.0))


def class_balance(train: DataFrame, label: str = LABEL_COL) -> ClassBalance:
    row = train.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("p")).first()
    balance = ClassBalance(rows=int(row["n"]), positives=int(row["p"] or 0))
    if balance.positives < 1:
        raise ValueError("training split must contain at least one positive example")
    return balance


@dataclass
class CandidateConfig:
    """Tunable sizes; defaults are the reference's configuration."""

    seed: int = 42
    logistic_max_iter: int = 2000
    # Largest mean gradient at the solution.
    logistic_tol: float = 1e-12
    tree_depth: int = 6
    tree_min_rows: int = 8
    forest_trees: int = 250
    forest_depth: int | None = None
    forest_min_rows: int = 2
    boosted_rounds: int = BOOSTED_PARAMETERS["n_estimators"]
    boosted_step: float = BOOSTED_PARAMETERS["learning_rate"]
    boosted_depth: int = BOOSTED_PARAMETERS["max_depth"]
    boosted_subsample: float = BOOSTED_PARAMETERS["subsample"]
    boosted_feature_fraction: float = BOOSTED_PARAMETERS["colsample_bytree"]
    boosted_min_child_hessian: float = BOOSTED_PARAMETERS["min_child_weight"]
    boosted_l2: float = BOOSTED_PARAMETERS["reg_lambda"]
    boosted_l1: float = BOOSTED_PARAMETERS["reg_alpha"]
    # Rows of a block; boosting sums over blocks, or runs in the only one.
    boosted_block_rows: int = 262_144
    # Nodes of more rows are split by passes over all tasks, smaller ones in one.
    tree_finish_rows: int = 262_144
    max_bins: int = 256
    mlp_hidden: int = 24
    mlp_epochs: int = 40
    # Boosting truncates its lineage every this many rounds (reliable
    # checkpoints in spark.checkpoint.dir), so a lost executor replays at
    # most this many rounds.
    checkpoint_interval: int = 25
    include: tuple[str, ...] = field(default=CANDIDATE_ORDER)
    # Candidates fitted at the same time (driver threads submitting jobs).
    parallel_fits: int = 5
    # Training rows are dealt into partitions by a hash of the id and sorted by
    # id in each.  Learners sample by partition and row order, so the number
    # belongs to the model: it goes with the number of rows (None) or is given,
    # and neither the input's layout nor the cluster's size has a say in it.
    fit_partitions: int | None = None
    rows_per_partition: int = 50_000
    # Bound on the labelled rows that are fitted: None for all, else the share
    # whose hashed id lies below it.  The report names it.
    fit_share: float | None = None


def training_rows(train: DataFrame, id_column: str, config: CandidateConfig) -> DataFrame:
    """The rows to fit, in the layout that the configuration names."""
    if config.fit_share is not None:
        digits = F.conv(F.substring(hash_key(f"fit{config.seed}", col(id_column)), 1, 8), 16, 10).cast("double")
        train = train.where(digits < F.lit(config.fit_share * 2**32))
    parts = config.fit_partitions or max(1, -(-train.count() // config.rows_per_partition))
    return train.repartition(parts, col(id_column)).sortWithinPartitions(col(id_column))


def wide_logistic(balance: ClassBalance, config: CandidateConfig) -> LogisticRegression:
    """C = 1 is a penalty of 1 / rows there, as balanced weights sum to the rows."""
    return LogisticRegression(
        featuresCol=FEATURES_COL, labelCol=LABEL_COL, weightCol=WEIGHT_COL, maxIter=config.logistic_max_iter,
        regParam=1.0 / balance.rows, elasticNetParam=0.0, standardization=False, tol=config.logistic_tol,
    )


def settings(name: str, balance: ClassBalance, config: CandidateConfig, width: int) -> dict[str, Any]:
    """The parameters that a candidate is fitted with."""
    if name == "logistic_regression":
        return {"c": 1.0, "class_weight": "balanced", "max_steps": config.logistic_max_iter, "tolerance": config.logistic_tol}
    if name == "decision_tree":
        return asdict(tree_config(name, config, width))
    if name == "random_forest":
        return {"trees": config.forest_trees, **asdict(tree_config(name, config, width))}
    if name == "boosted_trees":
        return {**asdict(boosting_config(config)), "positive_weight": balance.positive_weight()}
    if name == "mlp":
        return {**asdict(network_config(config)), "positive_weight": balance.positive_weight()}
    return {"strategy": "prior"}


def writes_probability(model: Model) -> bool:
    """Whether a model gives a probability vector and not the score itself."""
    return model.hasParam("probabilityCol")


def network_config(config: CandidateConfig) -> NetworkConfig:
    return NetworkConfig(hidden=config.mlp_hidden, epochs=config.mlp_epochs, seed=config.seed, block_rows=config.boosted_block_rows)


def boosting_config(config: CandidateConfig) -> BoostingConfig:
    return BoostingConfig(
        rounds=config.boosted_rounds, step=config.boosted_step, depth=config.boosted_depth, subsample=config.boosted_subsample,
        column_fraction=config.boosted_feature_fraction, min_child_hessian=config.boosted_min_child_hessian, l2=config.boosted_l2, l1=config.boosted_l1,
        bins=config.max_bins, seed=config.seed, block_rows=config.boosted_block_rows, checkpoint_interval=config.checkpoint_interval,
    )


def tree_config(name: str, config: CandidateConfig, width: int) -> TreeConfig:
    if name == "decision_tree":
        return TreeConfig(config.tree_depth, config.tree_min_rows, None, config.seed, config.tree_finish_rows)
    return TreeConfig(config.forest_depth, config.forest_min_rows, max(1, int(math.sqrt(width))), config.seed, config.tree_finish_rows)


def task_config(name: str, config: CandidateConfig, width: int, rows: int) -> TreeConfig:
    """The same trees, grown in a task each where that has room for the rows."""
    cfg = tree_config(name, config, width)
    fits = rows <= TREE_TASK_ROWS and rows * width <= TREE_TASK_VALUES
    return replace(cfg, finish_rows=max(cfg.finish_rows, rows)) if fits else cfg


def fit_candidate(name: str, features: DataFrame, balance: ClassBalance, config: CandidateConfig, width: int, id_column: str):
    """Fit one candidate on featurized training rows; returns (model, extra)."""
    if name == "majority_baseline":
        return PriorScore(labelCol=LABEL_COL).fit(features), {}
    if name == "logistic_regression" and width <= WIDEST:
        return fit_logistic(features, balance.balanced_weight(), LABEL_COL, FEATURES_COL, tolerance=config.logistic_tol, max_steps=config.logistic_max_iter)
    if name == "logistic_regression":
        weighted = features.withColumn(WEIGHT_COL, balance.balanced_weight())
        return without_summary(wide_logistic(balance, config).fit(weighted)), {}
    if name == "decision_tree":
        return fit_tree(features, id_column, task_config(name, config, width, balance.rows), LABEL_COL), {}
    if name == "random_forest":
        return fit_forest(features, id_column, config.forest_trees, task_config(name, config, width, balance.rows), LABEL_COL), {}
    if name == "boosted_trees":
        return fit_boosted_trees(features, id_column, balance.positive_weight(), boosting_config(config), LABEL_COL, task_blocks=BOOSTED_TASK_BLOCKS), {}
    if name == "mlp":
        model, losses = fit_network(features, id_column, balance.positive_weight(), network_config(config), LABEL_COL)
        return model, {"objective_history": losses}
    raise ValueError(f"unknown candidate: {name}")


def without_summary(model: Model) -> Model:
    """The model less its training summary, which holds the training rows and
    the session: scoring tasks would have to carry it, and cannot once the
    session observes a write."""
    if getattr(model, "hasSummary", False):
        model._java_obj.setSummary(SparkContext._active_spark_context._jvm.scala.Option.empty())
    return model
