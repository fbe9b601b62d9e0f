"""Closed-form scorers: deterministic score columns for oracle-checked keys.

A scorer maps feature columns to a probability-like score in [0, 1].  The
SQL text next to each is the same arithmetic for DuckDB (all in double).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _rounded_unit(value: Column, scale: float) -> Column:
    """floor(v*scale + 0.5)/scale clipped to [0, 1] (plain double arithmetic,
    identical in every IEEE engine; ROUND differs between engines)."""
    stepped = F.floor(value * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), stepped))


def torque_wear_score(torque: Column, wear: Column, scale: float = 100.0) -> Column:
    """least(1, greatest(0, round(torque/400 + wear/1000, 2))) with ties."""
    return _rounded_unit(torque.cast("double") / F.lit(400.0) + wear.cast("double") / F.lit(1000.0), scale)


def torque_wear_score_sql(torque: str = "torque", wear: str = "tool_wear", scale: float = 100.0) -> str:
    value = f"(CAST({torque} AS DOUBLE) / CAST(400.0 AS DOUBLE) + CAST({wear} AS DOUBLE) / CAST(1000.0 AS DOUBLE))"
    stepped = f"CAST(floor({value} * CAST({scale} AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS DOUBLE) / CAST({scale} AS DOUBLE)"
    return f"least(CAST(1.0 AS DOUBLE), greatest(CAST(0.0 AS DOUBLE), {stepped}))"
