"""CSV sources (A1, A2) read by column NAME, then cast strictly.

Spark applies an explicit CSV schema by position, and a double schema
silently turns 'inf' into NULL; so every column is read as a string from
the header (Spark strips a UTF-8 BOM), picked by name, and cast with
``try_cast`` so a bad value becomes NULL and is then reported by the audit
instead of failing somewhere later.  Target and flag columns stay doubles, so
that the audit judges the value as it was written.  Text is taken as it is:
a category with a blank in front is another category.  Missing-value tokens
are explicit, and loading a labelled file audits it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import col
from ..operators.audit import check_columns, validate
from ..schema import TaskSpec

# Tokens read as missing (the defaults of pandas.read_csv).
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
POSITIVE_INF = ("inf", "+inf", "infinity", "+infinity")
NEGATIVE_INF = ("-inf", "-infinity")


def _clean(name: str) -> Column:
    value = col(name)
    return F.when(value.isin(*MISSING_TOKENS), F.lit(None).cast("string")).otherwise(value)


def _typed(name: str, spec: TaskSpec) -> Column:
    value = _clean(name)
    if name in spec.numeric:
        lowered = F.lower(F.trim(value))
        return (
            F.when(lowered.isin(*POSITIVE_INF), F.lit(float("inf")))
            .when(lowered.isin(*NEGATIVE_INF), F.lit(float("-inf")))
            .otherwise(value.try_cast("double"))
            .alias(name)
        )
    if name == spec.id_column:
        return value.try_cast("long").alias(name)
    if name == spec.target or name in spec.leak_columns:
        return value.try_cast("double").alias(name)
    return value.alias(name)


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def read_labelled_csv(spark: SparkSession, path: str, spec: TaskSpec, audit: bool = True) -> DataFrame:
    """A1: the labelled table by name (missing columns raise; extras dropped),
    audited unless the caller does that."""
    raw = read_csv_strings(spark, path)
    check_columns(raw, spec)
    table = raw.select(*[_typed(name, spec) for name in spec.required])
    if audit:
        validate(table, spec)
    return table


def read_scoring_csv(spark: SparkSession, path: str, spec: TaskSpec) -> DataFrame:
    """A2: scoring rows; known columns typed, extra columns kept as strings."""
    raw = read_csv_strings(spark, path)
    known = set(spec.required)
    return raw.select(*[(_typed(c, spec) if c in known else col(c)) for c in raw.columns])
