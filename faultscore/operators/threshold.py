"""Threshold sweep and selection (H1).

Instead of 99 full metric passes, each distinct score is tagged with the
number k of grid points at or below it; a (group, k) histogram has at most
100 rows per group, and the confusion counts at grid point j are suffix sums
over k >= j.  Selection: highest F1, then recall, then closeness to 0.5,
then the lowest threshold (the reference's first-wins rule).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import col, ratio
from ..functions.grid import GRID_POINTS, grid_point, points_at_or_below
from .metrics import scored_label


def threshold_sweep(df: DataFrame, label: str, score: str, by: list[str] | None = None) -> DataFrame:
    """Per group and grid point: threshold, tp, fp, fn, tn, precision, recall, f1."""
    by = list(by or [])
    keys = [col(b) for b in by]
    # Rows go straight into the (group, k) histogram: map-side partial
    # aggregation leaves at most 100 rows per group and task to shuffle.
    y, p = scored_label(label, score)
    histogram = df.groupBy(*keys, points_at_or_below(p).alias("k")).agg(F.count(F.lit(1)).alias("h_n"), F.sum(y).alias("h_pos"))
    # At most 100 histogram entries per group: gather them into one array
    # and read the suffix sums for each grid point off that array, so the
    # dense table comes from the histogram alone (no second pass over the
    # scored rows, no join, no window).
    per_group = histogram.groupBy(*keys).agg(F.collect_list(F.struct("k", "h_n", "h_pos")).alias("h"))
    zero = F.lit(0).cast("long")

    def total(entries, field):
        return F.aggregate(entries, zero, lambda acc, x: acc + x[field])

    swept = per_group.select(
        *keys, "h", F.explode(F.sequence(F.lit(1), F.lit(GRID_POINTS))).alias("grid_index")
    ).select(
        *keys,
        "grid_index",
        total(F.filter("h", lambda x: x["k"] >= F.col("grid_index")), "h_pos").alias("tp"),
        total(F.filter("h", lambda x: x["k"] >= F.col("grid_index")), "h_n").alias("pp"),
        total(F.col("h"), "h_pos").alias("p_total"),
        total(F.col("h"), "h_n").alias("n_total"),
    )
    tp, pp = F.col("tp"), F.col("pp")
    fp = pp - tp
    fn = F.col("p_total") - tp
    return swept.select(
        *keys,
        "grid_index",
        grid_point(F.col("grid_index")).alias("threshold"),
        tp.cast("long").alias("tp"),
        fp.cast("long").alias("fp"),
        fn.cast("long").alias("fn"),
        (F.col("n_total") - F.col("p_total") - fp).cast("long").alias("tn"),
        ratio(tp, pp).alias("precision"),
        ratio(tp, F.col("p_total")).alias("recall"),
        ratio(F.lit(2) * tp, F.lit(2) * tp + fp + fn).alias("f1"),
    )


def select_threshold(df: DataFrame, label: str, score: str, by: list[str] | None = None) -> DataFrame:
    """One row per group: the chosen threshold and its F1 / recall."""
    by = list(by or [])
    keys = [col(b) for b in by]
    swept = threshold_sweep(df, label, score, by)
    order = Window.partitionBy(*keys).orderBy(
        F.col("f1").desc(),
        F.col("recall").desc(),
        F.abs(F.col("threshold") - F.lit(0.5)).asc(),
        F.col("grid_index").asc(),
    )
    return (
        swept.withColumn("_rn", F.row_number().over(order))
        .where(F.col("_rn") == 1)
        .select(*keys, "threshold", "f1", "recall")
    )
