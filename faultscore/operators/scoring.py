"""Batch scoring with a fitted scorer.

Row-local: projection, the frozen preprocessing SQL, the classifier's
predict and the inclusive threshold.  Cardinality is preserved and the
caller's key columns are kept (Spark has no row order to rely on).
"""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.columns import col, predicted
from .candidates import SCORE_COL

MISSING_FEATURES = "prediction rows are missing features: {}"


def check_features(rows: DataFrame, features: tuple[str, ...] | list[str]) -> None:
    missing = sorted(set(features) - set(rows.columns))
    if missing:
        raise ValueError(MISSING_FEATURES.format(missing))


def spread(rows: DataFrame) -> DataFrame:
    """The rows, dealt to every core where their input has fewer partitions: trees
    take longer than a shuffle of what they score."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)


def score_rows(model: PipelineModel, rows: DataFrame, features, keep: list[str] | None = None) -> DataFrame:
    """keep columns + features -> keep columns + ``score``."""
    check_features(rows, features)
    keep = [k for k in (keep or []) if k not in features]
    projected = rows.select(*[col(k) for k in keep], *[col(f) for f in features])
    return model.transform(projected).select(*[col(k) for k in keep], *[col(f) for f in features], SCORE_COL)


def predict_rows(
    model: PipelineModel, threshold: float, rows: DataFrame, features, keep: list[str] | None = None
) -> DataFrame:
    """keep columns + failure_probability + predicted_failure."""
    scored = score_rows(model, rows, features, keep)
    keep = [k for k in (keep or []) if k not in features]
    return scored.select(
        *[col(k) for k in keep],
        F.col(SCORE_COL).alias("failure_probability"),
        predicted(F.col(SCORE_COL), threshold).alias("predicted_failure"),
    )


def write_predictions(predictions: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> int:
    """A3: write predictions (keys kept) and report how many rows this write
    wrote, counted on the way to the sink."""
    observed = Observation(f"written-{uuid.uuid4().hex}")
    writer = predictions.observe(observed, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return int(observed.get["rows"])
