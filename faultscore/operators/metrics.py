"""Binary-classification metrics on (label, score[, group]) DataFrames.

Everything starts from the distinct-score table D = (group..., score, n,
pos): one aggregation with map-side combine.  Ranking metrics need prefix
sums in descending score order; instead of one window per group (a single
task holding every distinct score) D is dealt by range of (group, score), cut
where the distinct scores lie and not at fixed values, so that scores that
crowd around one rate spread over all tasks as well.  Each range is summed by
itself and starts at the total of the ranges above it (``prefix_sums``).

Average precision is the step sum  sum_i (R_i - R_{i-1}) P_i  over distinct
scores (not the trapezoid); ROC-AUC counts ties as one half and is NULL when
a group has only one class.  A group key may be NULL: it is a group like any
other.  A row without a label or a score fails the job, as one metrics record
must describe all rows.  Results are full doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, ratio
from .prefix_sums import prefix_sums

# Fixed text: what a vector length mismatch is reported as.
MISMATCH = "labels and probabilities must be matching vectors"


def scored_label(label: str, score: str) -> tuple[Column, Column]:
    """(label, score) columns that raise on a row that lacks either."""
    y, p = col(label), col(score).cast("double")
    bad = y.isNull() | p.isNull() | F.isnan(p)
    return F.when(bad, F.raise_error(F.lit(MISMATCH)).cast("long")).otherwise(y.cast("long")), F.when(bad, F.raise_error(F.lit(MISMATCH)).cast("double")).otherwise(p)


def score_table(
    df: DataFrame, label: str, score: str, by: list[str], carry: list[str] | None = None
) -> DataFrame:
    """D: rows and positives per (group, distinct score).

    ``carry`` columns are constant within a group (e.g. its threshold) and
    ride along as extra grouping keys.
    """
    keys = [col(b) for b in (*by, *(carry or []))]
    y, p = scored_label(label, score)
    return df.groupBy(*keys, p.alias("score")).agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("pos"))


def ranking_table(table: DataFrame, by: list[str], parts: int | None = None) -> DataFrame:
    """Per distinct score: tp / pp at that score (inclusive, descending order),
    group totals P and N."""
    summed = prefix_sums(table, by, "score", ["n", "pos"], descending=True, parts=parts)
    names = {"pos_upto": "tp", "n_upto": "pp", "n_all": "n_total", "pos_all": "p_total"}
    return summed.withColumnsRenamed(names)


def ranking_metrics(
    df: DataFrame, label: str, score: str, by: list[str] | None = None, parts: int | None = None
) -> DataFrame:
    """average_precision and roc_auc per group."""
    by = list(by or [])
    ranked = ranking_table(score_table(df, label, score, by), by, parts)
    return _ranking_aggregate(ranked, by)


def _ranking_aggregate(ranked: DataFrame, by: list[str], threshold: Column | None = None) -> DataFrame:
    """One grouped aggregation: AP and AUC sums, and the confusion counts
    at ``threshold`` when given."""
    neg_total = F.col("n_total") - F.col("p_total")
    fp = F.col("pp") - F.col("tp")
    ap_term = F.col("pos").cast("double") * F.col("tp").cast("double") / F.col("pp").cast("double")
    neg_here = (F.col("n") - F.col("pos")).cast("double")
    auc_term = F.col("pos").cast("double") * ((neg_total - fp).cast("double") + neg_here / F.lit(2.0))
    aggregates = [
        F.first("p_total").alias("positives"),
        F.first("n_total").alias("rows"),
        F.sum(ap_term).alias("_ap"),
        F.sum(auc_term).alias("_auc"),
    ]
    if threshold is not None:
        hit = F.col("score") >= threshold
        aggregates += [
            F.first(threshold).alias("threshold"),
            F.sum(F.when(hit, F.col("pos")).otherwise(0)).cast("long").alias("tp_at"),
            F.sum(F.when(hit, F.col("n") - F.col("pos")).otherwise(0)).cast("long").alias("fp_at"),
        ]
    agg = ranked.groupBy(*[col(b) for b in by]).agg(*aggregates)
    negatives = F.col("rows") - F.col("positives")
    out = agg.withColumns(
        {
            "average_precision": ratio(F.col("_ap"), F.col("positives")),
            "roc_auc": F.when((F.col("positives") == 0) | (negatives == 0), F.lit(None)).otherwise(
                F.col("_auc") / (F.col("positives").cast("double") * negatives.cast("double"))
            ),
        }
    ).drop("_ap", "_auc")
    if threshold is not None:
        out = out.withColumns(
            {
                "tp": F.col("tp_at"),
                "fp": F.col("fp_at"),
                "fn": F.col("positives") - F.col("tp_at"),
                "tn": negatives - F.col("fp_at"),
            }
        ).drop("tp_at", "fp_at")
    return out


def _threshold_column(threshold: float | str) -> tuple[Column, list[str]]:
    """A literal threshold, or the name of a per-group threshold column."""
    if isinstance(threshold, str):
        return F.col(threshold), [threshold]
    if not 0.0 <= float(threshold) <= 1.0:
        raise ValueError("threshold must be between zero and one")
    return F.lit(float(threshold)), []


def confusion_matrix(
    df: DataFrame, label: str, score: str, threshold: float | str, by: list[str] | None = None
) -> DataFrame:
    """G1: [[tn, fp], [fn, tp]] as four columns, labels (0, 1).

    A direct aggregation: map-side partial counts, one row per group and task.
    """
    by = list(by or [])
    limit, _ = _threshold_column(threshold)
    y, p = scored_label(label, score)
    hit = p >= limit
    positive = y == 1
    return df.groupBy(*[col(b) for b in by]).agg(
        F.first(limit).alias("threshold"),
        F.count_if(~positive & ~hit).alias("tn"),
        F.count_if(~positive & hit).alias("fp"),
        F.count_if(positive & ~hit).alias("fn"),
        F.count_if(positive & hit).alias("tp"),
    )


def rates(frame: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 from tn/fp/fn/tp columns."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return frame.withColumns(
        {
            "accuracy": ratio(tp + tn, tp + tn + fp + fn),
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "f1": ratio(F.lit(2) * tp, F.lit(2) * tp + fp + fn),
        }
    )


def binary_metrics(
    df: DataFrame,
    label: str,
    score: str,
    threshold: float | str,
    by: list[str] | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Threshold, accuracy, precision, recall, f1, roc_auc,
    average_precision and tn/fp/fn/tp per group: one score table, one
    ranking pass and one final aggregation (no join).

    ``threshold`` is a float in [0, 1] or the name of a column holding each
    group's threshold.
    """
    by = list(by or [])
    limit, carry = _threshold_column(threshold)
    ranked = ranking_table(score_table(df, label, score, by, carry), by, parts)
    out = rates(_ranking_aggregate(ranked, by, limit))
    return out.select(
        *[col(b) for b in by],
        "threshold",
        "accuracy", "precision", "recall", "f1", "roc_auc", "average_precision",
        "tn", "fp", "fn", "tp",
    )
