"""Column expressions shared by the operators (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType


def col(name: str) -> Column:
    """Column by exact name; names may hold spaces or brackets."""
    return F.col(f"`{name}`")


def is_float_type(data_type: DataType) -> bool:
    return isinstance(data_type, (DoubleType, FloatType))


def is_missing(column: Column, floating: bool) -> Column:
    """NULL, or NaN for float columns (pandas treats both as missing)."""
    return (column.isNull() | F.isnan(column)) if floating else column.isNull()


def nan_to_null(column: Column) -> Column:
    """Spark keeps NaN apart from NULL; imputers must see both as missing."""
    return F.nanvl(column.cast("double"), F.lit(None).cast("double"))


def is_infinite(column: Column) -> Column:
    return F.abs(column.cast("double")) == F.lit(float("inf"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as double, 0 when the denominator is 0."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(
        numerator.cast("double") / denominator.cast("double")
    )


def predicted(score: Column, threshold: Column | float) -> Column:
    """Inclusive threshold predicate: score >= t -> 1, else 0."""
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (score >= limit).cast("int")


def hash_key(seed: int | str, *parts: Column | str) -> Column:
    """md5 hex of 'seed:part1:part2...', a stable per-row random key."""
    pieces: list[Column] = [F.lit(str(seed))]
    for part in parts:
        pieces.append(F.lit(":"))
        pieces.append(F.lit(part) if isinstance(part, str) else part.cast("string"))
    return F.md5(F.concat(*pieces))


def rounded(column: Column, digits: int = 6) -> Column:
    """Round reported doubles so results do not depend on summation order."""
    return F.round(column.cast("double"), digits)
