"""Every oracle-backed registered query against DuckDB (the driver's gate)."""

import importlib
import math
import re
import sys

import duckdb
import pytest

from fixtures import SF001

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
entry = importlib.import_module("__spark_entry__")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    return repr(v)


def test_every_oracle_key_is_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


# The training-data operators have their own tests beside them.
@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if not re.match(r"op\d+_|pipeline$", n)))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF001)
    cols = sorted(df.columns)
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    rel = con.sql(entry.oracle_sql()[name])
    idx = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    assert sorted(rel.columns) == cols
    want = sorted(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert got == want


def test_entry_runs_on_smoke_data(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert {r.model for r in rows} >= {"majority_baseline", "logistic_regression", "boosted_trees"}
    assert "average_precision" in df.columns
