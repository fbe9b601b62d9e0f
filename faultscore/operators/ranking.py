"""Exact rank selection over a hash order, without a global sort.

Rows are ordered by (hex key, id) inside a class.  To find the row at a
given rank we count rows per key prefix (4 hex digits = 65,536 buckets per
level), prefix-sum those counts, keep only the bucket that holds the rank,
and refine with the next 4 digits until the bucket is small enough to rank
with a window.  Every level is one distributed aggregation whose output is
bounded by 65,536 rows per wanted rank; only the boundary keys (a handful of
scalars) reach the driver.  No window ever spans a whole class.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LEVEL_DIGITS = 4
# A bucket at or below this many rows is ranked directly with one window.
FINAL_BUCKET_ROWS = 100_000


@dataclass
class _Target:
    tag: int
    cls: object
    rank: int  # 1-based rank within the class
    prefix: str = ""
    offset: int = 0  # rows of the class ordered before the prefix bucket
    size: int = -1


def select_ranked_keys(
    spark: SparkSession,
    df: DataFrame,
    cls_col: str,
    key_col: str,
    id_col: str,
    wanted: list[tuple[object, int, int]],
    class_sizes: dict[object, int],
    final_rows: int = FINAL_BUCKET_ROWS,
) -> dict[tuple[object, int], tuple[str, object]]:
    """Return {(cls, rank): (key, id)} of the row at each wanted rank.

    ``wanted`` holds (cls, rank, ...) tuples with 1 <= rank <= class size.
    """
    targets = [
        _Target(tag=i, cls=cls, rank=rank, size=class_sizes[cls])
        for i, (cls, rank, *_rest) in enumerate(wanted)
    ]
    found: dict[tuple[object, int], tuple[str, object]] = {}
    active = list(targets)
    level = 0
    while active:
        final = [t for t in active if t.size <= final_rows or len(t.prefix) >= 32]
        if final:
            found.update(_rank_in_bucket(spark, df, cls_col, key_col, id_col, final))
        active = [t for t in active if t not in final]
        if not active:
            break
        level += 1
        _refine(spark, df, cls_col, key_col, active, level * LEVEL_DIGITS)
    return found


def _targets_frame(spark: SparkSession, targets: list[_Target], cls_type: str) -> DataFrame:
    rows = [(t.tag, t.cls, t.prefix, t.rank - t.offset) for t in targets]
    return spark.createDataFrame(rows, f"tag int, t_cls {cls_type}, t_prefix string, need long")


def _cls_type(df: DataFrame, cls_col: str) -> str:
    return df.schema[cls_col].dataType.simpleString()


def _refine(spark, df, cls_col, key_col, targets, digits) -> None:
    """Narrow each target to the sub-bucket of ``digits`` hex digits holding its rank."""
    parent = digits - LEVEL_DIGITS
    tframe = _targets_frame(spark, targets, _cls_type(df, cls_col))
    counts = (
        df.select(F.col(cls_col).alias("t_cls"), F.substring(key_col, 1, digits).alias("bucket"))
        .withColumn("t_prefix", F.substring("bucket", 1, parent) if parent else F.lit(""))
        .join(F.broadcast(tframe.select("t_cls", "t_prefix").distinct()), ["t_cls", "t_prefix"])
        .groupBy("t_cls", "t_prefix", "bucket")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    order = Window.partitionBy("t_cls", "t_prefix").orderBy("bucket")
    cumulative = counts.withColumn("before", F.sum("cnt").over(order) - F.col("cnt"))
    hits = (
        cumulative.join(F.broadcast(tframe), ["t_cls", "t_prefix"])
        .where((F.col("before") < F.col("need")) & (F.col("need") <= F.col("before") + F.col("cnt")))
        .select("tag", "bucket", "before", "cnt")
        .collect()
    )
    by_tag = {row["tag"]: row for row in hits}
    for target in targets:
        row = by_tag[target.tag]
        target.prefix = row["bucket"]
        target.offset += int(row["before"])
        target.size = int(row["cnt"])


def _rank_in_bucket(spark, df, cls_col, key_col, id_col, targets) -> dict:
    """Rank the rows of each (small) target bucket and pick the wanted row."""
    result = {}
    by_length: dict[int, list[_Target]] = {}
    for target in targets:
        by_length.setdefault(len(target.prefix), []).append(target)
    for length, group in by_length.items():
        tframe = _targets_frame(spark, group, _cls_type(df, cls_col))
        rows = df.select(
            F.col(cls_col).alias("t_cls"),
            (F.substring(key_col, 1, length) if length else F.lit("")).alias("t_prefix"),
            F.col(key_col).alias("_key"),
            F.col(id_col).alias("_id"),
        ).join(F.broadcast(tframe), ["t_cls", "t_prefix"])
        order = Window.partitionBy("tag").orderBy("_key", "_id")
        picked = (
            rows.withColumn("_rn", F.row_number().over(order))
            .where(F.col("_rn") == F.col("need"))
            .select("tag", "_key", "_id")
            .collect()
        )
        by_tag = {row["tag"]: row for row in picked}
        for target in group:
            row = by_tag[target.tag]
            result[(target.cls, target.rank)] = (row["_key"], row["_id"])
    return result
