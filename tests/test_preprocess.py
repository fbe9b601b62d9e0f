import random
import statistics

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from faultscore.operators.preprocess import fit_preprocessor
from faultscore.operators.quantiles import exact_medians, kth_values
from faultscore.schema import MACHINE_TASK as S

from fixtures import machine_frame


@pytest.mark.parametrize("final", [100_000, 7])
def test_exact_median_with_ties_nan_and_null(spark, final):
    rng = random.Random(3)
    a = [float(rng.randrange(20)) for _ in range(501)]
    b = [rng.random() for _ in range(400)] + [float("nan")] * 5 + [None] * 5
    c = [5.0] * 300 + [1.0, 9.0]
    rows = [(a[i] if i < len(a) else None, b[i] if i < len(b) else None, c[i] if i < len(c) else None) for i in range(max(len(a), len(b), len(c)))]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(4)
    got = exact_medians(df, ["a", "b", "c"], final_values=final)
    assert got["a"] == statistics.median(a)
    assert got["b"] == statistics.median([x for x in b if x is not None and x == x])
    assert got["c"] == 5.0


def test_kth_values_every_rank(spark):
    values = [float(v) for v in [7, 3, 3, 9, 1, 4, 4, 4, 8, 2, 6, 5, 3]]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    ranks = list(range(1, len(values) + 1))
    got = kth_values(df, {"x": ranks}, final_values=5)["x"]
    assert [got[r] for r in ranks] == sorted(values)


def test_fitted_statistics_come_from_train_only(spark):
    df = machine_frame(spark)
    train = df.where(F.col("udi") <= 300)
    _, stats = fit_preprocessor(train, S)
    torque = [r.torque for r in train.select("torque").collect()]
    assert stats.medians["torque"] == pytest.approx(statistics.median(torque))
    assert stats.means["torque"] == pytest.approx(statistics.fmean(torque))
    assert stats.scales["torque"] == pytest.approx(statistics.pstdev(torque))
    assert stats.categories["type"] == ["H", "L", "M"]


def test_unknown_category_is_all_zero_and_missing_takes_mode(spark):
    df = machine_frame(spark)
    model, stats = fit_preprocessor(df, S)
    probe = spark.createDataFrame(
        [(1, "X", None, 300.0, 310.0, 1500.0, 40.0, 100.0), (2, None, float("nan"), 300.0, 310.0, 1500.0, 40.0, 100.0)],
        "udi long, type string, air_temperature double, process_temperature double, rotational_speed double, torque double, tool_wear double, x double",
    ).drop("x").withColumnRenamed("air_temperature", "air_t").withColumnRenamed("udi", "udi")
    probe = probe.select("udi", "type", F.col("air_t").alias("air_temperature"), "process_temperature", "rotational_speed", "torque", "tool_wear")
    out = {r.udi: r.v for r in model.transform(probe).select("udi", vector_to_array("features").alias("v")).collect()}
    assert out[1][5:] == [0.0, 0.0, 0.0]
    mode_pos = 5 + stats.categories["type"].index(stats.modes["type"])
    assert out[2][mode_pos] == 1.0
    # missing numeric -> median -> z-score of the median
    expected = (stats.medians["air_temperature"] - stats.means["air_temperature"]) / stats.scales["air_temperature"]
    assert out[2][0] == pytest.approx(expected)


def test_constant_column_keeps_scale_one(spark):
    df = machine_frame(spark).withColumn("tool_wear", F.lit(5.0))
    _, stats = fit_preprocessor(df, S)
    assert stats.scales["tool_wear"] == 1.0


def test_many_categories_make_one_sparse_block(spark):
    df = machine_frame(spark).withColumn("type", F.concat(F.lit("t"), F.col("udi") % 700))
    model, stats = fit_preprocessor(df, S)
    assert len(stats.categories["type"]) == 700
    row = model.transform(df.where("udi = 1")).select("features").first()
    assert len(row.features) == 5 + 700 and len(row.features.indices) <= 6
