"""Running sums over tables of any size, without a task per group.

Rows are dealt by range of (keys, order), so a group of many rows spreads over
many tasks and the cut places follow the data; each range is summed by itself
and starts at the total of the ranges of its group before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import col
from ..session import ensure_checkpoint_dir


def _ordered(name: str, descending: bool) -> Column:
    return col(name).desc() if descending else col(name).asc()


def dealt_by_range(df: DataFrame, keys: list[str], order: str, descending: bool = False, parts: int | None = None) -> DataFrame:
    """``df`` plus ``_part``, the number of the range of (keys, order) a row
    falls into; ranges are cut where the rows lie, so they are about even."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *[col(k) for k in keys], _ordered(order, descending))
    # the range of a row must stay what it was, so the dealt rows are checkpointed
    return dealt.withColumn("_part", F.spark_partition_id()).checkpoint()


def prefix_sums(df: DataFrame, keys: list[str], order: str, columns: list[str], descending: bool = False, parts: int | None = None) -> DataFrame:
    """``df`` plus, for each summed column c, ``c_upto`` (c of the row and of all
    rows of its group before it) and ``c_all`` (of the whole group).

    (keys, order) must be unique and the sums integers.  Keys may be null.
    """
    by = [col(k) for k in keys]
    dealt = dealt_by_range(df, keys, order, descending, parts)
    inside = Window.partitionBy("_part", *by).orderBy(_ordered(order, descending)).rowsBetween(Window.unboundedPreceding, 0)
    local = dealt.withColumns({f"{c}_upto": F.sum(col(c)).over(inside) for c in columns})
    totals = dealt.groupBy("_part", *by).agg(*[F.sum(col(c)).alias(f"_total_{c}") for c in columns])
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("_part").alias("_offset_part"),
        *[col(k).alias(f"_key_{i}") for i, k in enumerate(keys)],
        *[F.coalesce(F.sum(f"_total_{c}").over(before), F.lit(0)).alias(f"_before_{c}") for c in columns],
        *[F.sum(f"_total_{c}").over(group).alias(f"{c}_all") for c in columns],
    )
    same = F.col("_part") == F.col("_offset_part")
    for i, k in enumerate(keys):
        same = same & col(k).eqNullSafe(F.col(f"_key_{i}"))
    joined = local.join(offsets, same).withColumns({f"{c}_upto": F.col(f"{c}_upto") + F.col(f"_before_{c}") for c in columns})
    return joined.select(*[col(c) for c in df.columns], *[f"{c}_upto" for c in columns], *[f"{c}_all" for c in columns])
