"""Data-quality audit of a labelled table (checks C1-C7).

All value checks run as ONE aggregate pass (partial aggregation on every
partition, a single-row merge); the key-uniqueness check is a separate
aggregation shuffled on the key.  Only the one-row counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, is_float_type, is_infinite, is_missing
from ..schema import TaskSpec

# Error texts of the reference contract.
MISSING_COLUMNS = "missing required columns: {}"
EMPTY = "dataset cannot be empty"
HAS_MISSING = "required columns contain missing values"
BAD_TARGET = "{} must contain only 0 and 1"
BAD_CATEGORY = "{} contains an unknown product category"
NOT_FINITE = "numeric feature columns must be finite"
NOT_UNIQUE = "{} must be unique"


def check_columns(df: DataFrame, spec: TaskSpec) -> None:
    """B1: sorted set difference of required names (driver-side, schema only)."""
    missing = sorted(set(spec.required) - set(df.columns))
    if missing:
        raise ValueError(MISSING_COLUMNS.format(missing))


def audit_stats(df: DataFrame, spec: TaskSpec) -> DataFrame:
    """One-row DataFrame with every count the audit needs."""
    check_columns(df, spec)
    types = dict((field.name, field.dataType) for field in df.schema.fields)
    target = col(spec.target)
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for name in spec.required:
        missing = is_missing(col(name), is_float_type(types[name]))
        aggregates.append(F.count_if(missing).alias(f"missing_{name}"))
    aggregates.append(F.count_if(target.isNotNull() & ~target.isin(0, 1)).alias("invalid_target"))
    for name in spec.categorical:
        domain = spec.category_domain.get(name)
        if domain:
            aggregates.append(
                F.count_if(col(name).isNotNull() & ~col(name).isin(*domain)).alias(f"invalid_{name}")
            )
    for name in spec.numeric:
        aggregates.append(F.count_if(is_infinite(col(name))).alias(f"nonfinite_{name}"))
    aggregates.append(F.coalesce(F.sum(target.cast("long")), F.lit(0)).alias("positive_rows"))
    aggregates.append(F.avg(target.cast("double")).alias("positive_rate"))
    return df.agg(*aggregates)


def duplicate_keys(df: DataFrame, key_columns: list[str] | tuple[str, ...]) -> DataFrame:
    """Keys that occur more than once, with their counts (shuffle on the key)."""
    return (
        df.groupBy(*[col(k) for k in key_columns])
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )


def validate(df: DataFrame, spec: TaskSpec) -> dict[str, object]:
    """Raise the first failing check in the reference order, else summarise."""
    stats = audit_stats(df, spec).first().asDict()
    if stats["rows"] == 0:
        raise ValueError(EMPTY)
    if any(stats[f"missing_{name}"] for name in spec.required):
        raise ValueError(HAS_MISSING)
    if stats["invalid_target"]:
        raise ValueError(BAD_TARGET.format(spec.target))
    for name in spec.categorical:
        if stats.get(f"invalid_{name}"):
            raise ValueError(BAD_CATEGORY.format(name))
    if any(stats[f"nonfinite_{name}"] for name in spec.numeric):
        raise ValueError(NOT_FINITE)
    if duplicate_keys(df, [spec.id_column]).take(1):
        raise ValueError(NOT_UNIQUE.format(spec.id_column))
    return {
        "rows": int(stats["rows"]),
        "feature_count": len(spec.features),
        "positive_rows": int(stats["positive_rows"]),
        "positive_rate": float(stats["positive_rate"]),
        "missing_values": 0,
        "duplicate_ids": 0,
        "excluded_id_columns": list(spec.id_columns),
        "excluded_leak_columns": list(spec.leak_columns),
    }


def audit_summary(df: DataFrame, spec: TaskSpec) -> DataFrame:
    """C7 as a one-row DataFrame (no driver round trip).

    missing_values and duplicate_ids are computed, not assumed: a table that
    passes the audit reports zeros.
    """
    stats = audit_stats(df, spec)
    missing_total = sum((F.col(f"missing_{name}") for name in spec.required), F.lit(0))
    dup = duplicate_keys(df, [spec.id_column]).agg(F.count(F.lit(1)).alias("duplicate_ids"))
    return stats.select(
        F.col("rows"),
        F.lit(len(spec.features)).alias("feature_count"),
        F.col("positive_rows"),
        F.round("positive_rate", 6).alias("positive_rate"),
        missing_total.cast("long").alias("missing_values"),
        dup.scalar().alias("duplicate_ids"),
        F.lit(",".join(spec.id_columns)).alias("excluded_id_columns"),
        F.lit(",".join(spec.leak_columns)).alias("excluded_leak_columns"),
    )


def feature_target(df: DataFrame, spec: TaskSpec) -> DataFrame:
    """Leakage-safe projection, features in fixed order + int target."""
    return df.select(*[col(name) for name in spec.features], col(spec.target).cast("int").alias(spec.target))
