"""The labelled machine table for tests: derived by the adapter from the
given sf0.001 ``events`` table (1,000 rows, failure flags included)."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultscore.sources.adapters import load_machine

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def machine_frame(spark, rows: int | None = None):
    """All 1,000 machine rows, or the first ``rows`` by udi (tests only)."""
    df = load_machine(spark, SF001)
    return df.where(F.col("udi") < rows) if rows else df
