"""Logistic regression by Newton steps (F2).

Minimises  |beta|^2 / (2 C)  +  sum of weighted log losses, the intercept left
free.  A step is one pass: every task adds up the weighted Gram matrix, the
gradient and the loss of its rows, a groupBy adds the tasks up, and only these
(width + 1)^2 sums reach the driver, which solves for the step.  A step that does
not lower the loss is halved.  The steps end where the gradient, as a mean over
the rows, is zero to ``tolerance``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .preprocess import FEATURES_COL

#: Widest vector whose Gram matrix is added up (32 MB a task).
WIDEST = 2_000


def log_odds(x: Column, coefficients: list[float], intercept: float) -> Column:
    products = F.zip_with(x, F.array(*[F.lit(float(c)) for c in coefficients]), lambda a, b: a * b)
    return F.aggregate(products, F.lit(float(intercept)), lambda a, b: a + b)


class LogisticModel(Model, HasFeaturesCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the class-1 probability."""

    coefficients = Param(Params._dummy(), "coefficients", "one a feature", typeConverter=TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "log odds at zero", typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, coefficients: list[float] | None = None, intercept: float = 0.0, featuresCol: str = FEATURES_COL, outputCol: str = "score"):
        super().__init__()
        self._setDefault(intercept=0.0, featuresCol=FEATURES_COL, outputCol="score")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x = vector_to_array(F.col(self.getFeaturesCol()))
        z = log_odds(x, self.getOrDefault("coefficients"), self.getOrDefault("intercept"))
        return dataset.withColumn(self.getOutputCol(), F.lit(1.0) / (F.lit(1.0) + F.exp(-z)))


def sums_at(rows: DataFrame, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Gram matrix, gradient and loss over (x, y, w) rows; the last column is the intercept's."""
    d = len(beta)

    def run(batches):
        total = np.zeros(d * d + d + 1)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.c_[batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, d - 1), np.ones(batch.num_rows)]
            y, w = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.float64) for i in (1, 2))
            z = x @ beta
            p = 1.0 / (1.0 + np.exp(-z))
            total[: d * d] += ((x * (w * p * (1.0 - p))[:, None]).T @ x).ravel()
            total[d * d : -1] += x.T @ (w * (p - y))
            total[-1] += (w * (np.logaddexp(0.0, z) - y * z)).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["at", "value"])

    got = np.zeros(d * d + d + 1)
    for r in rows.mapInArrow(run, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).collect():
        got[r["at"]] = r["value"]
    return got[: d * d].reshape(d, d), got[d * d : -1], float(got[-1])


def fit_logistic(train: DataFrame, weight: Column, label: str = "label", features: str = FEATURES_COL, c: float = 1.0, tolerance: float = 1e-12, max_steps: int = 100) -> tuple[LogisticModel, dict]:
    rows = train.select(vector_to_array(F.col(features)).alias("x"), F.col(label).cast("double").alias("y"), weight.cast("double").alias("w"))
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    if width > WIDEST:
        raise ValueError(f"Newton steps take at most {WIDEST} columns")
    ridge = np.r_[np.full(width, 1.0 / c), 0.0]
    beta, steps, losses = np.zeros(width + 1), 0, []

    def whole(b):
        gram, gradient, loss = sums_at(rows, b)
        return gram + np.diag(ridge), gradient + ridge * b, loss + 0.5 * float(ridge @ (b * b))

    gram, gradient, loss = whole(beta)
    while steps < max_steps and np.abs(gradient).max() > tolerance * n:
        step, share = np.linalg.lstsq(gram, gradient, rcond=None)[0], 1.0
        losses.append(loss)
        while True:
            found = whole(beta - share * step)
            if found[2] <= loss + 1e-12 * abs(loss) or share < 1e-6:
                break
            share /= 2.0
        if share < 1e-6:
            break
        beta, (gram, gradient, loss), steps = beta - share * step, found, steps + 1
    model = LogisticModel(coefficients=beta[:-1].tolist(), intercept=float(beta[-1]))
    return model, {"steps": steps, "objective_history": [*losses, loss]}
