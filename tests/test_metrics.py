import random

import pytest
from pyspark.sql import functions as F

from faultscore.operators.metrics import binary_metrics, confusion_matrix, ranking_metrics, score_table
from faultscore.operators.prefix_sums import dealt_by_range
from faultscore.operators.threshold import select_threshold, threshold_sweep

from brute import average_precision, grid, roc_auc, select_threshold as brute_threshold


def frame(spark, y, p, group=None):
    rows = [(g if group else 0, a, b) for a, b, g in zip(y, p, group or [0] * len(y))]
    return spark.createDataFrame(rows, "g int, label int, score double")


def test_confusion_matrix_matches_reference_case(spark):
    df = frame(spark, [0, 0, 1, 1], [0.1, 0.8, 0.4, 0.9])
    row = binary_metrics(df, "label", "score", 0.5).first()
    assert (row.tn, row.fp, row.fn, row.tp) == (1, 1, 1, 1)
    assert row.precision == 0.5 and row.recall == 0.5


def test_threshold_is_not_fixed_at_half(spark):
    df = frame(spark, [0, 0, 0, 1, 1], [0.05, 0.10, 0.20, 0.25, 0.30])
    t = select_threshold(df, "label", "score").first().threshold
    assert 0.20 <= t < 0.5


def test_threshold_out_of_range_rejected(spark):
    df = frame(spark, [0, 1], [0.1, 0.9])
    with pytest.raises(ValueError, match="between zero and one"):
        binary_metrics(df, "label", "score", 1.5)


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("parts", [1, 7, 64])
def test_ranking_metrics_match_brute_force_with_ties(spark, seed, parts):
    rng = random.Random(seed)
    n = 300
    groups = [rng.randrange(3) for _ in range(n)]
    y = [1 if rng.random() < 0.2 else 0 for _ in range(n)]
    p = [round(rng.random() * (0.5 + 0.4 * a), 2) for a in y]
    df = frame(spark, y, p, groups).repartition(5)
    got = {r.g: r for r in ranking_metrics(df, "label", "score", ["g"], parts=parts).collect()}
    for g in range(3):
        ys = [a for a, k in zip(y, groups) if k == g]
        ps = [b for b, k in zip(p, groups) if k == g]
        assert got[g].average_precision == pytest.approx(average_precision(ys, ps), abs=1e-6)
        assert got[g].roc_auc == pytest.approx(roc_auc(ys, ps), abs=1e-6)


def test_one_class_auc_is_null_and_no_positive_ap_is_zero(spark):
    df = frame(spark, [0, 0, 0], [0.1, 0.2, 0.3])
    row = ranking_metrics(df, "label", "score").first()
    assert row.roc_auc is None and row.average_precision == 0.0


@pytest.mark.parametrize("seed", [4, 5, 6, 7])
def test_threshold_selection_matches_reference_loop(spark, seed):
    rng = random.Random(seed)
    n = 400
    y = [1 if rng.random() < 0.15 else 0 for _ in range(n)]
    p = [min(1.0, round(rng.random() * 0.6 + 0.35 * a, 2)) for a in y]
    df = frame(spark, y, p).repartition(3)
    got = select_threshold(df, "label", "score").first().threshold
    assert got == brute_threshold(y, p)


def test_constant_score_picks_grid_point_nearest_half(spark):
    df = frame(spark, [0, 1, 0, 0], [0.005] * 4)
    got = select_threshold(df, "label", "score").first().threshold
    assert got == min(grid(), key=lambda t: (abs(t - 0.5), t))


def test_sweep_counts_every_grid_point(spark):
    y = [0, 1, 1, 0, 1]
    p = [0.01, 0.5, 0.99, 0.3, 0.0]
    rows = threshold_sweep(frame(spark, y, p), "label", "score").orderBy("grid_index").collect()
    assert len(rows) == 99
    for row, t in zip(rows, grid()):
        assert row.threshold == t
        assert row.tp == sum(1 for a, b in zip(y, p) if a == 1 and b >= t)
        assert row.fp == sum(1 for a, b in zip(y, p) if a == 0 and b >= t)


def test_metrics_invariant_to_partitioning(spark):
    rng = random.Random(9)
    y = [rng.randrange(2) for _ in range(200)]
    p = [round(rng.random(), 1) for _ in range(200)]
    a = binary_metrics(frame(spark, y, p).repartition(1), "label", "score", 0.4).first()
    b = binary_metrics(frame(spark, y, p).repartition(7), "label", "score", 0.4).first()
    assert list(a) == pytest.approx(list(b), abs=1e-12)
    c = confusion_matrix(frame(spark, y, p), "label", "score", 0.4).first()
    assert (c.tn, c.fp, c.fn, c.tp) == (a.tn, a.fp, a.fn, a.tp)


def test_grouped_binary_metrics_match_brute_force(spark):
    rng = random.Random(11)
    n = 400
    groups = [rng.randrange(2) for _ in range(n)]
    y = [1 if rng.random() < 0.25 else 0 for _ in range(n)]
    p = [round(rng.random() * (0.6 + 0.3 * a), 3) for a in y]
    df = frame(spark, y, p, groups).repartition(4)
    got = {r.g: r for r in binary_metrics(df, "label", "score", 0.3, ["g"]).collect()}
    for g in range(2):
        ys = [a for a, k in zip(y, groups) if k == g]
        ps = [b for b, k in zip(p, groups) if k == g]
        assert got[g].average_precision == pytest.approx(average_precision(ys, ps), abs=1e-6)
        assert got[g].roc_auc == pytest.approx(roc_auc(ys, ps), abs=1e-6)


def test_a_null_group_is_a_group(spark):
    rows = [(None, 1, 0.9), (None, 0, 0.2), ("a", 1, 0.3), ("a", 0, 0.6)]
    df = spark.createDataFrame(rows, "g string, label int, score double")
    ranked = {r.g: r.average_precision for r in ranking_metrics(df, "label", "score", ["g"]).collect()}
    assert ranked == {None: 1.0, "a": 0.5}
    assert {r.g for r in binary_metrics(df, "label", "score", 0.5, ["g"]).collect()} == {None, "a"}


@pytest.mark.parametrize("bad", [(0, float("nan")), (1, None), (None, 0.95)])
@pytest.mark.parametrize("metric", [lambda d: binary_metrics(d, "label", "score", 0.5), lambda d: confusion_matrix(d, "label", "score", 0.5), lambda d: select_threshold(d, "label", "score")])
def test_unscored_rows_fail_the_job(spark, bad, metric):
    df = spark.createDataFrame([(1, 0.4), (0, 0.1), bad], "label int, score double")
    with pytest.raises(Exception, match="matching vectors"):
        metric(df).collect()


def test_metrics_are_not_rounded(spark):
    y, p = [1, 0, 1, 0, 0, 0, 1], [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3]
    got = ranking_metrics(frame(spark, y, p), "label", "score").first()
    assert got.average_precision == pytest.approx(average_precision(y, p), abs=1e-14)


def test_crowded_scores_spread_over_all_ranges(spark):
    n, parts = 100_000, 8
    # every score inside one millionth, with ties, one in seven positive, and a few far away
    crowd = spark.range(n).select(
        (F.lit(0.03) + (F.pmod(F.xxhash64("id"), F.lit(60_000)) / 60_000) * 1e-6).alias("score"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(7)) == 0).cast("int").alias("label")
    )
    df = crowd.unionByName(spark.createDataFrame([(0.9, 1), (0.0, 0), (-1.0, 0), (5e-324, 1)], "score double, label int"))
    table = score_table(df, "label", "score", [])
    sizes = [r["count"] for r in dealt_by_range(table, [], "score", True, parts).groupBy("_part").count().collect()]
    assert len(sizes) == parts and max(sizes) < 2 * sum(sizes) / parts
    rows = df.toPandas().groupby("score").label.agg(["sum", "count"]).sort_index(ascending=False)
    pos, tp, pp = rows["sum"], rows["sum"].cumsum(), rows["count"].cumsum()
    neg, fp = rows["count"] - pos, pp - tp
    got = ranking_metrics(df, "label", "score", parts=parts).first()
    assert got.average_precision == pytest.approx((pos * tp / pp).sum() / pos.sum(), rel=1e-10)
    assert got.roc_auc == pytest.approx((pos * (neg.sum() - fp + neg / 2)).sum() / (pos.sum() * neg.sum()), rel=1e-10)
