import pytest
from pyspark.sql import functions as F

from faultscore.operators.audit import audit_summary, duplicate_keys, feature_target, validate
from faultscore.schema import MACHINE_TASK as S
from faultscore.sources.adapters import load_machine

from fixtures import SF001, machine_frame


def test_schema_audit_and_leakage_exclusions(spark):
    df = machine_frame(spark)
    audit = validate(df, S)
    features = feature_target(df, S)
    assert audit["rows"] == 1000
    assert tuple(features.columns) == (*S.features, S.target)
    assert set(S.leak_columns).isdisjoint(features.columns)
    assert set(S.id_columns).isdisjoint(features.columns[:-1])


def test_missing_required_column_is_rejected(spark):
    with pytest.raises(ValueError, match="missing required columns"):
        validate(machine_frame(spark).drop("torque"), S)


@pytest.mark.parametrize(
    "change, message",
    [
        (lambda df: df.where(F.lit(False)), "dataset cannot be empty"),
        (lambda df: df.withColumn("torque", F.when(F.col("udi") == 3, F.lit(None)).otherwise(F.col("torque"))), "missing values"),
        (lambda df: df.withColumn("torque", F.when(F.col("udi") == 3, F.lit(float("nan"))).otherwise(F.col("torque"))), "missing values"),
        (lambda df: df.withColumn("machine_failure", F.when(F.col("udi") == 3, F.lit(2)).otherwise(F.col("machine_failure"))), "only 0 and 1"),
        (lambda df: df.withColumn("type", F.when(F.col("udi") == 3, F.lit("X")).otherwise(F.col("type"))), "unknown product category"),
        (lambda df: df.withColumn("torque", F.when(F.col("udi") == 3, F.lit(float("inf"))).otherwise(F.col("torque"))), "must be finite"),
        (lambda df: df.withColumn("udi", F.when(F.col("udi") == 3, F.lit(4)).otherwise(F.col("udi"))), "must be unique"),
    ],
)
def test_audit_errors(spark, change, message):
    with pytest.raises(ValueError, match=message):
        validate(change(machine_frame(spark)), S)


def test_first_failing_check_wins(spark):
    df = machine_frame(spark).withColumn("type", F.lit("X")).withColumn("machine_failure", F.lit(2))
    with pytest.raises(ValueError, match="only 0 and 1"):
        validate(df, S)


def test_duplicate_keys_on_composite_key(spark):
    from faultscore.sources.tables import read_table

    lineitem = read_table(spark, SF001, "lineitem")
    dups = duplicate_keys(lineitem, ["l_orderkey", "l_linenumber"])
    total = lineitem.count()
    distinct = lineitem.select("l_orderkey", "l_linenumber").distinct().count()
    extra = dups.agg(F.sum(F.col("n") - 1)).first()[0] or 0
    assert total - distinct == extra


def test_audit_summary_on_given_table(spark):
    row = audit_summary(load_machine(spark, SF001), S).first()
    assert row.rows == 1000 and row.missing_values == 0 and row.duplicate_ids == 0
    assert row.excluded_leak_columns == "twf,hdf,pwf,osf,rnf"


def test_audit_command_summary(spark):
    from faultscore.plans.commands import audit

    summary = audit(machine_frame(spark), S)
    assert summary["rows"] == 1000 and summary["feature_count"] == 6
    assert summary["excluded_leak_columns"] == list(S.leak_columns)
    assert 0 < summary["positive_rows"] < summary["rows"]
