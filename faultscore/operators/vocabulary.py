"""Category lists as a table, for columns with more categories than a driver should hold.

``category_table`` numbers the different values of all categorical columns
by range-cut running sums, so no task and no driver holds a column's values.
To the driver come, for each column, its number of values and the most
frequent one.  ``CategoryTableModel`` joins the table to rows and puts the
sparse feature vector together:

* a column with at most ``broadcastCategories`` values is looked up in a
  broadcast table of that many rows;
* of a wider column, the values that each hold over one in ``HOT_PART`` of the
  training rows (``HOT_PART`` of them at most) are broadcast, the rest is
  joined by value.  Rows found hot go to that join under spread keys that
  match nothing, so no task gets a hot value's rows.

A value without a number leaves its block at zero.  Every position is an
absolute one: numeric columns first, then the blocks in column order.
"""

from __future__ import annotations

import os

from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, NumericType, StringType

from ..functions.columns import col
from ..session import ensure_checkpoint_dir
from .prefix_sums import prefix_sums

TABLE_SCHEMA = "feature int, v string, hot boolean, position int"
TABLE_COLUMNS = tuple(f.split()[0] for f in TABLE_SCHEMA.split(", "))
#: Values of a column that are broadcast whole.
BROADCAST_CATEGORIES = 4096
#: A value is hot if it holds more than one in so many training rows.
HOT_PART = 1024
#: Keys over which the rows of hot values are spread.
SPREAD = 1 << 16
#: The widest vector that has 32-bit positions.
WIDEST = (1 << 31) - 1


def category_counts(train: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, v, n): rows of each different value; feature is the column's number.  Nulls are left out."""
    pairs = F.array(*[F.struct(F.lit(i).alias("feature"), col(c).cast("string").alias("v")) for i, c in enumerate(columns)])
    return train.select(F.inline(pairs)).where(F.col("v").isNotNull()).groupBy("feature", "v").agg(F.count(F.lit(1)).alias("n"))


def category_summary(counts: DataFrame) -> dict[int, tuple[int, str, int]]:
    """Per feature number: how many values, the most frequent one (ties to the smallest), its rows and the others'."""
    first = F.min(F.struct((-F.col("n")).alias("less"), "v"))
    rows = counts.groupBy("feature").agg(F.count(F.lit(1)).alias("width"), first.alias("first"), F.sum("n").alias("rows")).collect()
    return {r["feature"]: (r["width"], r["first"]["v"], r["rows"]) for r in rows}


def category_table(counts: DataFrame, summary: dict[int, tuple[int, str, int]], start: int) -> DataFrame:
    """``TABLE_SCHEMA``: values in ascending order have the positions from ``start`` on, column after column."""
    ensure_checkpoint_dir(counts.sparkSession)
    ranked = prefix_sums(counts.withColumn("_one", F.lit(1).cast("long")), ["feature"], "v", ["_one"])
    before, first, rows = start, F.lit(None).cast("long"), F.lit(None).cast("long")
    for i in sorted(summary):
        first = F.when(F.col("feature") == i, F.lit(before)).otherwise(first)
        rows = F.when(F.col("feature") == i, F.lit(summary[i][2])).otherwise(rows)
        before += summary[i][0]
    if before > WIDEST:
        raise ValueError(f"a feature vector has {WIDEST} places at most, {before} are asked for")
    table = ranked.select("feature", "v", (F.col("n") * HOT_PART > rows).alias("hot"), (first + F.col("_one_upto") - 1).cast("int").alias("position"))
    return table.checkpoint()


class _TableWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.table.write.mode("overwrite").parquet(os.path.join(path, "categories"))


class _TableReader(DefaultParamsReader):
    def load(self, path: str):
        model = super().load(path)
        return model.with_table(SparkSession.active().read.schema(TABLE_SCHEMA).parquet(os.path.join(path, "categories")))


def _hashable(kind: DataType) -> bool:
    return isinstance(kind, (NumericType, StringType, BooleanType))


def sparse_vectors(numeric: int, width: int):
    """Arrow function of (array of numeric values, array of positions or nulls) to sparse vectors of ``width``."""

    def build(values, positions):
        import numpy as np
        import pyarrow as pa

        rows = len(values)
        z = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, numeric)
        at = positions.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int32).reshape(rows, -1)
        index = np.hstack([np.broadcast_to(np.arange(numeric, dtype=np.int32), (rows, numeric)), at])
        value = np.hstack([z, np.ones(at.shape)])
        held = (index >= 0) & (value != 0)
        ends = np.concatenate([[0], np.cumsum(held.sum(axis=1))]).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(a[held])) for a in (index, value)]
        kinds = [pa.array(np.zeros(rows, dtype=np.int8)), pa.array(np.full(rows, width, dtype=np.int32))]
        return pa.StructArray.from_arrays([*kinds, *lists], ["type", "size", "indices", "values"])

    return F.arrow_udf(build, VectorUDT())


class CategoryTableModel(Model, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the feature vector of the numeric ``inputCols`` and the filled ``categoryCols``; rows keep no order."""

    categoryCols = Param(Params._dummy(), "categoryCols", "string columns without nulls", typeConverter=TypeConverters.toListString)
    widths = Param(Params._dummy(), "widths", "number of values of each category column", typeConverter=TypeConverters.toListInt)
    broadcastCategories = Param(Params._dummy(), "broadcastCategories", "values of a column that are broadcast whole", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCols=(), categoryCols=(), widths=(), broadcastCategories: int = BROADCAST_CATEGORIES, outputCol: str = "features"):
        super().__init__()
        self._setDefault(inputCols=[], categoryCols=[], widths=[], broadcastCategories=BROADCAST_CATEGORIES, outputCol="features")
        self._set(**{k: list(v) if isinstance(v, tuple) else v for k, v in self._input_kwargs.items()})
        self.table: DataFrame | None = None

    def with_table(self, table: DataFrame) -> CategoryTableModel:
        self.table = table.select(*TABLE_COLUMNS)
        return self

    def broadcast_up_to(self, categories: int) -> CategoryTableModel:
        return self._set(broadcastCategories=categories)

    def write(self):
        return _TableWriter(self)

    @classmethod
    def read(cls):
        return _TableReader(cls)

    def copy(self, extra=None):
        other = super().copy(extra)
        return other if self.table is None else other.with_table(self.table)

    def _looked_up(self, rows: DataFrame, number: int, column: str, width: int) -> DataFrame:
        """``rows`` plus ``__at_{number}``, the position of the column's value."""
        at, hot, cold, value = (f"__{n}_{number}" for n in ("at", "hot", "cold", "v"))
        of = self.table.where(F.col("feature") == number)
        if width <= self.getOrDefault("broadcastCategories"):
            all_of = F.broadcast(of.select(F.col("v").alias(value), F.col("position").alias(at)))
            return rows.join(all_of, col(column) == F.col(value), "left").drop(value)
        few = F.broadcast(of.where("hot").select(F.col("v").alias(value), F.col("position").alias(hot)))
        rest = of.where(~F.col("hot")).select(F.col("v").alias(value), F.lit(0).alias("__none"), F.col("position").alias(cold))
        spread = F.xxhash64(*[col(f.name) for f in rows.schema.fields if _hashable(f.dataType)])
        found = rows.join(few, col(column) == F.col(value), "left").drop(value)
        found = found.withColumn("__spread", F.when(F.col(hot).isNull(), 0).otherwise(1 + F.pmod(spread, F.lit(SPREAD))).cast("int"))
        joined = found.join(rest, (col(column) == F.col(value)) & (F.col("__spread") == F.col("__none")), "left")
        return joined.withColumn(at, F.coalesce(hot, cold)).drop(value, hot, cold, "__spread", "__none")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        numeric, columns, widths = self.getInputCols(), self.getOrDefault("categoryCols"), self.getOrDefault("widths")
        rows = dataset
        for i, (c, width) in enumerate(zip(columns, widths)):
            rows = self._looked_up(rows, i, c, width)
        vectors = sparse_vectors(len(numeric), len(numeric) + sum(widths))
        z = F.array(*[col(c).cast("double") for c in numeric]) if numeric else F.array().cast("array<double>")
        out = rows.withColumn(self.getOutputCol(), vectors(z, F.array(*[F.col(f"__at_{i}") for i in range(len(columns))])))
        return out.drop(*[f"__at_{i}" for i in range(len(columns))])
