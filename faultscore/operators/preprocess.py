"""Train-only preprocessing (E1-E6) as a persistable PipelineModel.

Statistics are learned from the training rows only: exact interpolated
medians (scalable selection, see ``quantiles``), population mean and
standard deviation of the imputed values, the most frequent category (ties
to the smallest) and the sorted category list.  Imputation and scaling are
frozen into a ``SQLTransformer`` statement; categories go through
``StringIndexer`` and ``OneHotEncoder``, so a wide block is one sparse vector
and not a column per category.  There is no Python on the data path, and the
fitted preprocessor saves and loads with the rest of the pipeline.  Feature
vector = z-scores in numeric order, then one-hot blocks (unknown category ->
all zeros; missing -> the train mode).  Lists of ``LISTED_CATEGORIES`` values
together reach the driver; beyond that, or with an empty string among them,
the categories are a table (``vocabulary``), and only each column's mode and number of values do.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, nan_to_null
from ..schema import TaskSpec
from ..session import ensure_checkpoint_dir
from .quantiles import exact_medians
from .vocabulary import CategoryTableModel, category_counts, category_summary, category_table

FEATURES_COL = "features"
#: Categories of all columns together that the driver may hold.
LISTED_CATEGORIES = 4096


@dataclass(frozen=True)
class PreprocessStats:
    medians: dict[str, float]
    means: dict[str, float]
    scales: dict[str, float]
    modes: dict[str, str]
    categories: dict[str, list[str]]  # empty if they are a table
    widths: dict[str, int] = field(default_factory=dict)

    def vector_width(self, spec: TaskSpec) -> int:
        return len(spec.numeric) + sum(self.widths[c] if c in self.widths else len(self.categories[c]) for c in spec.categorical)

    def vector_names(self, spec: TaskSpec) -> list[str]:
        names = [f"{c}" for c in spec.numeric]
        for c in spec.categorical:
            names += [f"{c}={v}" for v in self.categories[c]]
        return names


def _lit(value: float) -> str:
    return f"CAST('{value!r}' AS DOUBLE)"


def _quote(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


EPS = 2.220446049250313e-16


def _scale(std: float | None, mean: float) -> float:
    """Population std, or 1 for a (near) constant column as the reference scaler does."""
    if std is None or math.isnan(std) or std < 10 * EPS * max(1.0, abs(mean)):
        return 1.0
    return std


def steady(value: float) -> float:
    """Twelve digits: what the order of a sum leaves behind that would tip a value
    that lies on a cut of a tree to either side."""
    return float(f"{value:.11e}")


def fit_stats(train: DataFrame, spec: TaskSpec, listed: int = LISTED_CATEGORIES) -> tuple[PreprocessStats, DataFrame | None]:
    """Learn every statistic from the training rows; beside them the category
    table, or None where ``listed`` categories hold them all.

    Pass 1 counts rows and non-missing values and takes the raw moments;
    the exact medians need one more pass (or a few at scale); the moments
    are recomputed on imputed values only if some training value is
    missing; one grouped pass gives the counts of all categories.
    """
    values = [nan_to_null(col(c)) for c in spec.numeric]
    first = train.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(x).alias(f"n_{i}") for i, x in enumerate(values)],
        *[F.avg(x).alias(f"mean_{i}") for i, x in enumerate(values)],
        *[F.stddev_pop(x).alias(f"std_{i}") for i, x in enumerate(values)],
    ).first()
    counts = {c: int(first[f"n_{i}"]) for i, c in enumerate(spec.numeric)}
    medians = exact_medians(train, list(spec.numeric), counts)
    for c, value in medians.items():
        if value is None:
            raise ValueError(f"{c} has no observed training values")
    moments = first
    if any(counts[c] < first["rows"] for c in spec.numeric):
        imputed = [F.coalesce(x, F.lit(medians[c])) for x, c in zip(values, spec.numeric)]
        moments = train.agg(
            *[F.avg(x).alias(f"mean_{i}") for i, x in enumerate(imputed)],
            *[F.stddev_pop(x).alias(f"std_{i}") for i, x in enumerate(imputed)],
        ).first()
    means = {c: steady(moments[f"mean_{i}"]) for i, c in enumerate(spec.numeric)}
    scales = {c: steady(_scale(moments[f"std_{i}"], means[c])) for i, c in enumerate(spec.numeric)}
    modes, widths, categories, table = {}, {}, {}, None
    if spec.categorical:
        counts = category_counts(train, list(spec.categorical))
        few = counts.limit(listed + 1).collect()
        # MLlib's attributes have no empty names, so an empty string makes a table too.
        if len(few) > listed or any(r["v"] == "" for r in few):
            counts = counts.checkpoint()
            summary = category_summary(counts)
            table = category_table(counts, summary, len(spec.numeric))
        else:
            summary = {}
            for i in {r["feature"] for r in few}:
                # Most frequent value, ties to the smallest; categories sorted.
                of = [r for r in few if r["feature"] == i]
                summary[i] = (len(of), min(of, key=lambda r: (-r["n"], r["v"]))["v"], sum(r["n"] for r in of))
                categories[spec.categorical[i]] = sorted(r["v"] for r in of)
        for i, c in enumerate(spec.categorical):
            if i not in summary:
                raise ValueError(f"{c} has no observed training values")
            widths[c], modes[c] = summary[i][:2]
    return PreprocessStats(medians, means, scales, modes, categories, widths), table


def preprocess_statement(stats: PreprocessStats, spec: TaskSpec) -> tuple[str, list[str], list[str]]:
    """The SQL of the z-scores and filled categories, and their column names."""
    parts, scaled, filled = [], [], []
    for i, c in enumerate(spec.numeric):
        value = f"coalesce(nanvl(CAST(`{c}` AS DOUBLE), CAST(NULL AS DOUBLE)), {_lit(stats.medians[c])})"
        parts.append(f"(({value} - {_lit(stats.means[c])}) / {_lit(stats.scales[c])}) AS `_z_{i}`")
        scaled.append(f"_z_{i}")
    for i, c in enumerate(spec.categorical):
        parts.append(f"coalesce(CAST(`{c}` AS STRING), {_quote(stats.modes[c])}) AS `_cat_{i}`")
        filled.append(f"_cat_{i}")
    return "SELECT *, " + ", ".join(parts) + " FROM __THIS__", scaled, filled


def build_preprocessor(spark, stats: PreprocessStats, spec: TaskSpec, output_col: str = FEATURES_COL, table: DataFrame | None = None) -> PipelineModel:
    statement, scaled, filled = preprocess_statement(stats, spec)
    stages = [SQLTransformer(statement=statement)]
    if table is not None:
        widths = [stats.widths[c] for c in spec.categorical]
        model = CategoryTableModel(inputCols=scaled, categoryCols=filled, widths=widths, outputCol=output_col)
        return PipelineModel(stages=stages + [model.with_table(table)])
    blocks = []
    for name, c in zip(filled, spec.categorical):
        # An unknown category is one more index, which the encoder drops.
        indexer = StringIndexerModel.from_labels(stats.categories[c], name, f"{name}_index", handleInvalid="keep")
        probe = indexer.transform(spark.createDataFrame([], f"{name} string"))  # the encoder reads its width from the metadata
        encoder = OneHotEncoder(inputCols=[f"{name}_index"], outputCols=[f"{name}_block"], dropLast=True).fit(probe)
        stages += [indexer, encoder]
        blocks.append(f"{name}_block")
    stages.append(VectorAssembler(inputCols=scaled + blocks, outputCol=output_col))
    return PipelineModel(stages=stages)


def fit_preprocessor(train: DataFrame, spec: TaskSpec, listed: int = LISTED_CATEGORIES) -> tuple[PipelineModel, PreprocessStats]:
    """Fit on the training rows only; reuse for every other split."""
    ensure_checkpoint_dir(train.sparkSession)
    stats, table = fit_stats(train, spec, listed)
    return build_preprocessor(train.sparkSession, stats, spec, table=table), stats
