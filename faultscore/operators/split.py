"""Deterministic, stratified train/validation/test split.

The split is a ``split`` column on the one table, never three collected
frames.  Allocation follows the two-stage rule of the reference: hold out
ceil(0.4 n) rows, then send ceil(0.5 m) of those m rows to test; every
stage allocates per class by largest remainder (ties: lower class first).
Inside a class rows are ordered by md5('seed:id'), then id; the first
n_train rows train, the next n_validation validate, the rest test.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import col, hash_key, rounded
from ..schema import TaskSpec
from .audit import validate
from .ranking import FINAL_BUCKET_ROWS, select_ranked_keys

TRAIN, VALIDATION, TEST = "train", "validation", "test"
SPLITS = (TRAIN, VALIDATION, TEST)
# The reference's split fractions and default seed.
HOLDOUT_FRACTION = 0.40
TEST_SHARE_OF_HOLDOUT = 0.50
DEFAULT_SEED = 42


def class_counts(df: DataFrame, target: str) -> DataFrame:
    """Rows per class (a handful of rows after partial aggregation)."""
    return df.groupBy(col(target).alias("cls")).agg(F.count(F.lit(1)).alias("n"))


def _largest_remainder(counts: dict, draws: int) -> dict:
    """floor(share * draws) per class plus one for the largest remainders
    (ties: lower class first), share = class rows / all rows, in double."""
    total = sum(counts.values())
    continuous = {c: (n / total if total else 0.0) * draws for c, n in counts.items()}
    whole = {c: math.floor(v) for c, v in continuous.items()}
    need = draws - sum(whole.values())
    order = sorted(counts, key=lambda c: (-(continuous[c] - whole[c]), c))
    return {c: whole[c] + (1 if rank < need else 0) for rank, c in enumerate(order)}


def allocate(class_rows: dict) -> list[dict]:
    """Per-class n_train / n_validation / n_test from {class: rows}.

    Arithmetic on one number per class, so it runs on the driver; the
    counting that grows with the data is a Spark aggregation.
    """
    counts = {c: int(n) for c, n in class_rows.items() if n > 0}
    total = sum(counts.values())
    n_train = total - math.ceil(HOLDOUT_FRACTION * total)
    train = _largest_remainder(counts, n_train)
    rest = {c: counts[c] - train[c] for c in counts}
    m = total - n_train
    n_val = m - math.ceil(TEST_SHARE_OF_HOLDOUT * m)
    val = _largest_remainder(rest, n_val)
    return [
        {"cls": c, "n": counts[c], "n_train": train[c], "n_validation": val[c], "n_test": rest[c] - val[c]}
        for c in sorted(counts)
    ]


def allocation(counts: DataFrame) -> DataFrame:
    """D2 as a DataFrame: class counts (a Spark aggregation) -> allocation."""
    rows = allocate({r["cls"]: r["n"] for r in counts.collect()})
    cls_type = counts.schema["cls"].dataType.simpleString()
    return counts.sparkSession.createDataFrame(
        [(r["cls"], r["n"], r["n_train"], r["n_validation"], r["n_test"]) for r in rows],
        f"cls {cls_type}, n long, n_train long, n_validation long, n_test long",
    )


def _check_allocation(rows: list) -> None:
    if not rows:
        raise ValueError("dataset cannot be empty")
    if min(r["n"] for r in rows) < 2:
        raise ValueError("the least populated class has fewer than 2 members")
    classes = len(rows)
    for field in ("n_train", "n_validation", "n_test"):
        if sum(r[field] for r in rows) < classes:
            raise ValueError(f"{field} is smaller than the number of classes ({classes})")


def stratified_split(
    df: DataFrame,
    spec: TaskSpec,
    seed: int = DEFAULT_SEED,
    spark: SparkSession | None = None,
    class_rows: dict[int, int] | None = None,
    audit: bool = False,
    final_rows: int = FINAL_BUCKET_ROWS,
) -> DataFrame:
    """Add an exact stratified ``split`` column (deterministic for a seed).

    ``audit`` validates the table first, unless its caller has; ``class_rows``
    ({class: rows}, e.g. from that audit) saves the counting pass.
    """
    spark = spark or df.sparkSession
    if audit:
        found = validate(df, spec)
        class_rows = {0: found["rows"] - found["positive_rows"], 1: found["positive_rows"]}
    if class_rows is None:
        class_rows = {int(r["cls"]): r["n"] for r in class_counts(df, spec.target).collect()}
    rows = allocate(class_rows)
    _check_allocation(rows)
    keyed = df.withColumn("_split_key", hash_key(seed, col(spec.id_column)))
    sizes = {r["cls"]: int(r["n"]) for r in rows}
    wanted = []
    for r in rows:
        for rank in {int(r["n_train"]), int(r["n_train"] + r["n_validation"])}:
            if 0 < rank:
                wanted.append((r["cls"], rank, None))
    boundary = select_ranked_keys(
        spark, keyed.select(col(spec.target).cast("int").alias("_cls"), "_split_key", col(spec.id_column).alias("_id")),
        "_cls", "_split_key", "_id", wanted, sizes, final_rows,
    )
    key, ident, cls = F.col("_split_key"), col(spec.id_column), col(spec.target)

    def upto(bound: tuple[str, object] | None) -> Column:
        if bound is None:
            return F.lit(False)
        return (key < F.lit(bound[0])) | ((key == F.lit(bound[0])) & (ident <= F.lit(bound[1])))

    label = F.lit(TEST)
    for r in rows:
        train_end = int(r["n_train"])
        val_end = train_end + int(r["n_validation"])
        in_train = upto(boundary.get((r["cls"], train_end)) if train_end else None)
        in_val = upto(boundary.get((r["cls"], val_end)) if val_end else None)
        label = F.when(
            cls == F.lit(r["cls"]),
            F.when(in_train, F.lit(TRAIN)).when(in_val, F.lit(VALIDATION)).otherwise(F.lit(TEST)),
        ).otherwise(label)
    return keyed.withColumn("split", label).drop("_split_key")


def hash_split(
    df: DataFrame,
    spec: TaskSpec,
    seed: int = DEFAULT_SEED,
    train_fraction: float = 1.0 - HOLDOUT_FRACTION,
    validation_fraction: float = HOLDOUT_FRACTION * (1.0 - TEST_SHARE_OF_HOLDOUT),
) -> DataFrame:
    """Row-local split by hash position in [0, 1): no job, stable on append.

    Counts are binomial rather than exact; strata hold in expectation.
    """
    position = F.conv(F.substring(hash_key(seed, col(spec.id_column)), 1, 8), 16, 10).cast("double") / F.lit(
        float(2**32)
    )
    return df.withColumn(
        "split",
        F.when(position < F.lit(train_fraction), F.lit(TRAIN))
        .when(position < F.lit(train_fraction + validation_fraction), F.lit(VALIDATION))
        .otherwise(F.lit(TEST)),
    )


def split_summary(df: DataFrame, target: str) -> DataFrame:
    """Rows, positive rows and positive rate per split."""
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(col(target).cast("long")).alias("positive_rows"),
        rounded(F.avg(col(target).cast("double"))).alias("positive_rate"),
    )
