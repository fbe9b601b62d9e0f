"""SQL building blocks for the DuckDB oracle queries.

The oracle states each result in the plainest correct SQL (a window over a
whole class, a range join against the 99-point grid) so it checks the
scalable Spark formulation independently.  All arithmetic is in DOUBLE with
the same operation order as the Spark side.
"""

from __future__ import annotations

from ..functions.grid import GRID_SQL
from ..functions.scorers import torque_wear_score_sql
from ..sources.adapters import MACHINE_SQL

D = "DOUBLE"


def split_sql(source: str, id_col: str, target: str, seed: int = 42, name: str = "labelled_split") -> str:
    """CTEs: allocation (two-stage largest remainder) + ranked split."""
    return f"""
{name}_counts AS (SELECT {target} AS cls, count(*) AS n FROM {source} GROUP BY 1),
{name}_s1 AS (SELECT cls, n, sum(n) OVER () AS total FROM {name}_counts),
{name}_s2 AS (SELECT *, total - CAST(ceil(CAST(0.4 AS {D}) * CAST(total AS {D})) AS BIGINT) AS n_tr FROM {name}_s1),
{name}_s3 AS (SELECT *, (CAST(n AS {D}) / CAST(total AS {D})) * CAST(n_tr AS {D}) AS cont FROM {name}_s2),
{name}_s4 AS (SELECT *, CAST(floor(cont) AS BIGINT) AS whole FROM {name}_s3),
{name}_s5 AS (SELECT *, cont - CAST(whole AS {D}) AS rem, n_tr - sum(whole) OVER () AS need FROM {name}_s4),
{name}_s6 AS (SELECT *, whole + CASE WHEN row_number() OVER (ORDER BY rem DESC, cls ASC) <= need THEN 1 ELSE 0 END AS n_train FROM {name}_s5),
{name}_s7 AS (SELECT *, n - n_train AS rest, total - n_tr AS m FROM {name}_s6),
{name}_s8 AS (SELECT *, m - CAST(ceil(CAST(0.5 AS {D}) * CAST(m AS {D})) AS BIGINT) AS n_v FROM {name}_s7),
{name}_s9 AS (SELECT *, (CASE WHEN m = 0 THEN CAST(0.0 AS {D}) ELSE CAST(rest AS {D}) / CAST(m AS {D}) END) * CAST(n_v AS {D}) AS cont2 FROM {name}_s8),
{name}_s10 AS (SELECT *, CAST(floor(cont2) AS BIGINT) AS whole2 FROM {name}_s9),
{name}_s11 AS (SELECT *, cont2 - CAST(whole2 AS {D}) AS rem2, n_v - sum(whole2) OVER () AS need2 FROM {name}_s10),
{name}_alloc AS (
  SELECT cls, n, n_train,
         whole2 + CASE WHEN row_number() OVER (ORDER BY rem2 DESC, cls ASC) <= need2 THEN 1 ELSE 0 END AS n_validation,
         rest
  FROM {name}_s11),
{name}_ranked AS (
  SELECT t.*, row_number() OVER (PARTITION BY {target} ORDER BY md5('{seed}:' || CAST({id_col} AS VARCHAR)), {id_col}) AS _rn
  FROM {source} t),
{name} AS (
  SELECT r.* EXCLUDE (_rn),
         CASE WHEN r._rn <= a.n_train THEN 'train'
              WHEN r._rn <= a.n_train + a.n_validation THEN 'validation' ELSE 'test' END AS split
  FROM {name}_ranked r JOIN {name}_alloc a ON r.{target} = a.cls)"""


MACHINE_SPLIT = MACHINE_SQL + "," + split_sql("machine", "udi", "machine_failure", name="machine_split")

SCORE_A = torque_wear_score_sql("torque", "tool_wear", 100.0)
SCORE_B = torque_wear_score_sql("torque", "tool_wear", 10.0)
SCORE_TORQUE = torque_wear_score_sql("torque", "0", 100.0)

SCORED = (
    MACHINE_SPLIT
    + f""",
scored AS (SELECT udi, split, machine_failure AS label, {SCORE_A} AS score FROM machine_split)"""
)


def ranking_sql(source: str, group: str, score: str = "score", label: str = "label", name: str = "rk", places: int | None = 6) -> str:
    """CTE ``name``: group, rows, positives, average_precision, roc_auc."""
    cut = (lambda x: f"round({x}, {places})") if places is not None else (lambda x: f"({x})")
    return f"""
{name}_d AS (SELECT {group} AS g, {score} AS score, count(*) AS n, CAST(sum({label}) AS BIGINT) AS pos FROM {source} GROUP BY 1, 2),
{name}_c AS (
  SELECT g, score, n, pos,
         sum(pos) OVER (PARTITION BY g ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
         sum(n) OVER (PARTITION BY g ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pp,
         sum(pos) OVER (PARTITION BY g) AS p_total, sum(n) OVER (PARTITION BY g) AS n_total
  FROM {name}_d),
{name} AS (
  SELECT g, CAST(max(n_total) AS BIGINT) AS rows, CAST(max(p_total) AS BIGINT) AS positives,
         {cut(f"CASE WHEN max(p_total) = 0 THEN CAST(0.0 AS {D}) ELSE sum(CAST(pos AS {D}) * CAST(tp AS {D}) / CAST(pp AS {D})) / CAST(max(p_total) AS {D}) END")} AS average_precision,
         {cut(f"CASE WHEN max(p_total) = 0 OR max(n_total) = max(p_total) THEN NULL ELSE sum(CAST(pos AS {D}) * (CAST(n_total - p_total - (pp - tp) AS {D}) + CAST(n - pos AS {D}) / CAST(2.0 AS {D}))) / (CAST(max(p_total) AS {D}) * CAST(max(n_total) - max(p_total) AS {D})) END")} AS roc_auc
  FROM {name}_c GROUP BY g)"""


def sweep_sql(source: str, group: str, score: str = "score", label: str = "label", name: str = "sw") -> str:
    """CTE ``name``: per group and grid point the confusion counts and rates."""
    return f"""
{GRID_SQL.strip()},
{name}_tot AS (SELECT {group} AS g, count(*) AS n_total, CAST(sum({label}) AS BIGINT) AS p_total FROM {source} GROUP BY 1),
{name}_hits AS (
  SELECT s.{group} AS g, grid.grid_index, count(*) AS pp, CAST(sum(s.{label}) AS BIGINT) AS tp
  FROM {source} s JOIN grid ON s.{score} >= grid.threshold GROUP BY 1, 2),
{name}_all AS (
  SELECT t.g, grid.grid_index, grid.threshold, t.n_total, t.p_total,
         coalesce(h.tp, 0) AS tp, coalesce(h.pp, 0) AS pp
  FROM {name}_tot t JOIN grid ON true
  LEFT JOIN {name}_hits h ON h.g = t.g AND h.grid_index = grid.grid_index),
{name} AS (
  SELECT g, grid_index, threshold, tp, pp - tp AS fp, p_total - tp AS fn, n_total - p_total - (pp - tp) AS tn,
         CASE WHEN pp = 0 THEN CAST(0.0 AS {D}) ELSE CAST(tp AS {D}) / CAST(pp AS {D}) END AS precision,
         CASE WHEN p_total = 0 THEN CAST(0.0 AS {D}) ELSE CAST(tp AS {D}) / CAST(p_total AS {D}) END AS recall,
         CASE WHEN 2 * tp + (pp - tp) + (p_total - tp) = 0 THEN CAST(0.0 AS {D})
              ELSE CAST(2 * tp AS {D}) / CAST(2 * tp + (pp - tp) + (p_total - tp) AS {D}) END AS f1
  FROM {name}_all)"""


def pick_sql(sweep: str, name: str = "pick") -> str:
    return f"""
{name} AS (
  SELECT g, threshold, f1, recall FROM (
    SELECT *, row_number() OVER (PARTITION BY g ORDER BY f1 DESC, recall DESC, abs(threshold - CAST(0.5 AS {D})) ASC, grid_index ASC) AS _r
    FROM {sweep}) WHERE _r = 1)"""


def confusion_sql(source: str, group: str, threshold_expr: str, score: str = "score", label: str = "label", name: str = "cm") -> str:
    return f"""
{name} AS (
  SELECT {group} AS g, CAST(sum(CASE WHEN {label} = 0 AND {score} < {threshold_expr} THEN 1 ELSE 0 END) AS BIGINT) AS tn,
         CAST(sum(CASE WHEN {label} = 0 AND {score} >= {threshold_expr} THEN 1 ELSE 0 END) AS BIGINT) AS fp,
         CAST(sum(CASE WHEN {label} = 1 AND {score} < {threshold_expr} THEN 1 ELSE 0 END) AS BIGINT) AS fn,
         CAST(sum(CASE WHEN {label} = 1 AND {score} >= {threshold_expr} THEN 1 ELSE 0 END) AS BIGINT) AS tp
  FROM {source} GROUP BY 1)"""


def rates_select(prefix: str = "") -> str:
    p = prefix
    def r(num: str, den: str) -> str:
        return f"round(CASE WHEN {den} = 0 THEN CAST(0.0 AS {D}) ELSE CAST({num} AS {D}) / CAST({den} AS {D}) END, 6)"
    return ", ".join([
        f"{r(f'{p}tp + {p}tn', f'{p}tp + {p}tn + {p}fp + {p}fn')} AS accuracy",
        f"{r(f'{p}tp', f'{p}tp + {p}fp')} AS precision",
        f"{r(f'{p}tp', f'{p}tp + {p}fn')} AS recall",
        f"{r(f'2 * {p}tp', f'2 * {p}tp + {p}fp + {p}fn')} AS f1",
    ])
