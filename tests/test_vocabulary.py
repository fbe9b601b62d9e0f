"""Category lists as a table: same vectors as the listed form, bounded driver."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from faultscore.operators import vocabulary
from faultscore.operators.preprocess import fit_preprocessor
from faultscore.schema import TaskSpec

TASK = TaskSpec(id_column="id", extra_id_columns=(), categorical=("kind", "odd name"), numeric=("x",), target="y", leak_columns=(), category_domain={})


def rows(spark, n=3000):
    """A third of all rows in one category, nulls, quotes and umlauts."""
    i = F.col("id")
    kind = F.when(i % 3 == 0, "hot").when(i % 31 == 0, None).when(i % 41 == 0, "it's ü").otherwise(F.concat(F.lit("k"), i % 200))
    return spark.range(n).select("id", kind.alias("kind"), (i % 5).alias("odd name"), (i * 7 % 101).cast("double").alias("x"), F.lit(0).alias("y"))


def vectors(model, df):
    return sorted((r.id, list(r.v)) for r in model.transform(df).select("id", vector_to_array("features").alias("v")).collect())


@pytest.mark.parametrize("broadcast", [vocabulary.BROADCAST_CATEGORIES, 2])
def test_table_gives_the_vectors_of_the_list(spark, broadcast):
    df = rows(spark)
    train = df.where("id % 4 <> 0")
    listed, few = fit_preprocessor(train, TASK)
    held, stats = fit_preprocessor(train, TASK, listed=0)
    held.stages[-1].broadcast_up_to(broadcast)
    assert stats.categories == {} and stats.widths == few.widths and stats.modes == few.modes
    assert stats.vector_width(TASK) == few.vector_width(TASK) == len(few.vector_names(TASK))
    unseen = df.unionByName(df.limit(3).withColumn("kind", F.lit("never seen")).withColumn("odd name", F.lit(None).cast("long")))
    assert vectors(held, unseen) == vectors(listed, unseen)


def test_table_is_saved_with_the_model(spark, tmp_path):
    df = rows(spark, 500)
    model, _ = fit_preprocessor(df, TASK, listed=0)
    model.save(str(tmp_path / "m"))
    assert vectors(PipelineModel.load(str(tmp_path / "m")), df) == vectors(model, df)


def test_an_empty_string_is_a_category(spark):
    df = rows(spark, 200).withColumn("kind", F.when(F.col("id") % 2 == 0, "").otherwise(F.col("kind")))
    model, stats = fit_preprocessor(df, TASK)
    assert stats.modes["kind"] == ""
    got = dict(vectors(model, df))
    assert all((got[i][1] == 1.0) == (i % 2 == 0 or i % 31 == 0 and i % 3 != 0) for i in got)


def test_a_column_without_values_raises(spark):
    with pytest.raises(ValueError, match="kind has no observed"):
        fit_preprocessor(rows(spark, 50).withColumn("kind", F.lit(None).cast("string")), TASK)


def test_hot_rows_are_spread_and_match_nothing_twice(spark):
    model, stats = fit_preprocessor(rows(spark), TASK, listed=0)
    hot = {r.v for r in model.stages[-1].table.where("feature = 0 AND hot").collect()}
    assert "hot" in hot and len(hot) <= vocabulary.HOT_PART
    model.stages[-1].broadcast_up_to(0)
    assert model.transform(rows(spark)).count() == 3000
    assert model.transform(rows(spark).limit(0)).count() == 0


def test_a_million_categories(spark):
    n = 1_200_000
    df = spark.range(n).select(
        "id", F.when(F.col("id") % 6 == 0, "hot").otherwise(F.md5(F.col("id").cast("string"))).alias("kind"), F.lit(1).alias("odd name"),
        (F.col("id") % 10).cast("double").alias("x"), F.lit(0).alias("y"),
    )
    model, stats = fit_preprocessor(df, TASK)
    assert stats.categories == {} and stats.widths == {"kind": 1_000_001, "odd name": 1} and stats.modes["kind"] == "hot"
    out = model.transform(df.where("id < 2000")).select(F.unwrap_udt("features").alias("v"))
    got = out.select(F.size("v.indices").alias("k"), F.col("v.size").alias("size"), F.col("v.indices")[F.size("v.indices") - 1].alias("last")).distinct().collect()
    assert {(r.k, r.size, r.last) for r in got} <= {(k, 1_000_003, 1_000_002) for k in (2, 3)}
