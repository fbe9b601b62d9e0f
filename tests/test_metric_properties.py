"""Property test: distributed metrics equal brute force on generated inputs."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from faultscore.operators.metrics import binary_metrics
from faultscore.operators.threshold import select_threshold

from brute import average_precision, confusion, roc_auc, select_threshold as brute_threshold

rows = st.lists(
    st.tuples(st.integers(0, 1), st.integers(0, 20).map(lambda k: k / 20)),
    min_size=2, max_size=60,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows, threshold=st.integers(1, 99).map(lambda k: k / 100), parts=st.sampled_from([1, 64]))
def test_binary_metrics_match_brute_force(spark, data, threshold, parts):
    y = [a for a, _ in data]
    p = [b for _, b in data]
    df = spark.createDataFrame(data, "label int, score double")
    got = binary_metrics(df, "label", "score", threshold, parts=parts).first()
    assert (got.tn, got.fp, got.fn, got.tp) == confusion(y, p, threshold)
    assert got.average_precision == pytest.approx(average_precision(y, p), abs=1e-6)
    want_auc = roc_auc(y, p)
    assert (got.roc_auc is None) == (want_auc is None)
    if want_auc is not None:
        assert got.roc_auc == pytest.approx(want_auc, abs=1e-6)
    assert select_threshold(df, "label", "score").first().threshold == brute_threshold(y, p)
