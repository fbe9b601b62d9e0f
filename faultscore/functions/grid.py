"""The threshold grid: 99 points from 0.01 to 0.99.

Fixed values: start 0.01, stop 0.99, 99 points, point i = i*step + start
with step = (stop - start) / 98, and the last point exactly stop.  This is
how the reference's evenly spaced grid is computed in double precision.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GRID_START = 0.01
GRID_STOP = 0.99
GRID_POINTS = 99
GRID_STEP = (GRID_STOP - GRID_START) / (GRID_POINTS - 1)


def grid_values() -> list[float]:
    values = [i * GRID_STEP + GRID_START for i in range(GRID_POINTS)]
    values[-1] = GRID_STOP
    return values


def grid_point(index: Column) -> Column:
    """Grid value for a 1-based index column (1..99)."""
    return F.when(index >= GRID_POINTS, F.lit(GRID_STOP)).otherwise(
        (index - 1).cast("double") * F.lit(GRID_STEP) + F.lit(GRID_START)
    )


def points_at_or_below(score: Column) -> Column:
    """Number of grid points t with t <= score (0..99), without a lookup.

    An arithmetic estimate is corrected by one step in each direction
    against the exact grid values, so the count is exact.
    """
    estimate = F.floor((score - F.lit(GRID_START)) / F.lit(GRID_STEP)).cast("int") + 1
    clipped = F.least(F.greatest(estimate, F.lit(0)), F.lit(GRID_POINTS))
    lowered = F.when((clipped >= 1) & (score < grid_point(clipped)), clipped - 1).otherwise(clipped)
    return F.when(
        (lowered < GRID_POINTS) & (score >= grid_point(lowered + 1)), lowered + 1
    ).otherwise(lowered)


GRID_SQL = f"""
grid AS (
  SELECT CAST(i + 1 AS INTEGER) AS grid_index,
         CASE WHEN i = {GRID_POINTS - 1} THEN {GRID_STOP}::DOUBLE
              ELSE i::DOUBLE * (({GRID_STOP}::DOUBLE - {GRID_START}::DOUBLE) / {GRID_POINTS - 1}::DOUBLE) + {GRID_START}::DOUBLE
         END AS threshold
  FROM range(0, {GRID_POINTS}) AS r(i)
)"""
