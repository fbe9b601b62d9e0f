"""DuckDB SQL of the learners' first trees, from the training rows' features.

Each statement is the plain form of what the operators do in distributed form:
running sums as windows over a whole feature, one CTE per level and tree.
"""

from __future__ import annotations

from ..operators.boosting import BoostingConfig, LEAST_GAIN, columns_of_round, multiplier
from ..operators.exact_trees import TreeConfig, poisson_steps
from ..schema import MACHINE_TASK as S
from .catalog import ORACLE
from .oracle_sql import MACHINE_SPLIT, confusion_sql, pick_sql, ranking_sql, rates_select, sweep_sql

CATEGORIES = ("H", "L", "M")
WIDTH = len(S.numeric) + len(CATEGORIES)


def long_features_sql(part: str = "train", name: str = "x") -> str:
    """CTEs ``rows`` (udi, label) and ``x`` (udi, f, v) of a split, scaled by the training rows."""
    train = "(SELECT * FROM machine_split WHERE split = 'train')"
    steady = lambda x: f"(SELECT CAST(format('{{:.11e}}', {x}) AS DOUBLE) FROM {train})"
    z = [f"SELECT udi, {i} AS f, ({c} - {steady(f'avg({c})')}) / {steady(f'stddev_pop({c})')} + 0.0 AS v FROM machine_split WHERE split = '{part}'" for i, c in enumerate(S.numeric)]
    z += [f"SELECT udi, {len(S.numeric) + j} AS f, CAST(type = '{v}' AS DOUBLE) AS v FROM machine_split WHERE split = '{part}'" for j, v in enumerate(CATEGORIES)]
    return f"{name}_rows AS MATERIALIZED (SELECT udi, machine_failure AS label FROM machine_split WHERE split = '{part}'),\n{name} AS MATERIALIZED (" + "\nUNION ALL ".join(z) + ")"


def first_boosted_trees_sql(trees: int, cfg: BoostingConfig) -> str:
    least = f"least(24, 51 - {(cfg.block_rows - 1).bit_length()} - ceil(log2(greatest(2.0, w))))"
    ctes = [
        MACHINE_SPLIT,
        long_features_sql(),
        "balance AS MATERIALIZED (SELECT *, CAST(neg AS DOUBLE) / CAST(pos AS DOUBLE) AS w FROM (SELECT sum(label)::BIGINT AS pos, sum(1 - label)::BIGINT AS neg FROM x_rows))",
        f"scale AS MATERIALIZED (SELECT w, pow(2.0, {least}) AS s, -2.0 * (neg - w * pos) / (neg + w * pos) AS base FROM balance)",
        "c AS (SELECT f, v, n, sum(n) OVER (PARTITION BY f ORDER BY v) AS upto, sum(n) OVER (PARTITION BY f) AS alln FROM (SELECT f, v, count(*) AS n FROM x GROUP BY f, v))",
        f"edges AS MATERIALIZED (SELECT f, v, row_number() OVER (PARTITION BY f ORDER BY v) - 1 AS b FROM c WHERE floor(CAST(upto * {cfg.bins} AS DOUBLE) / alln) > floor(CAST((upto - n) * {cfg.bins} AS DOUBLE) / alln))",
        "binned AS MATERIALIZED (SELECT x.udi, x.f, e.b FROM x ASOF JOIN edges e ON x.f = e.f AND x.v <= e.v)",
        "m0 AS MATERIALIZED (SELECT udi, label, (SELECT base FROM scale) AS margin FROM x_rows)",
    ]
    out = []
    for r in range(trees):
        a, b = multiplier(cfg.seed, r)
        digest = f"CAST('0x' || substr(md5('{cfg.seed}:' || udi::VARCHAR), 1, 13) AS HUGEINT)"
        kept = f"(({digest} * {a}::HUGEINT + {b}::HUGEINT) % 18446744073709551616::HUGEINT) // 4294967296::HUGEINT < {cfg.subsample} * 4294967296.0"
        columns = ", ".join(map(str, columns_of_round(WIDTH, cfg.column_fraction, cfg.seed, r)))
        ctes += [
            f"p{r} AS (SELECT udi, label, margin, 1.0 / (1.0 + exp(-margin)) AS p, CASE WHEN label = 1 THEN w ELSE 1.0 END AS rw, s, {kept} AS kept FROM m{r}, scale)",
            f"g{r} AS MATERIALIZED (SELECT udi, kept, CAST(round_even(rw * (p - label) * s, 0) AS HUGEINT) AS g, CAST(round_even(rw * p * (1.0 - p) * s, 0) AS HUGEINT) AS h FROM p{r})",
            f"a{r}_0 AS MATERIALIZED (SELECT udi, 0 AS node FROM m{r})",
            f"base{r}_0 AS MATERIALIZED (SELECT 0 AS first, 1 AS next)",
        ]
        for level in range(cfg.depth):
            k, up = f"{r}_{level}", f"{r}_{level + 1}"
            ctes += [
                f"hist{k} AS (SELECT a.node, b.f, b.b, CAST(sum(g.g) AS DOUBLE) / (SELECT s FROM scale) AS g, CAST(sum(g.h) AS DOUBLE) / (SELECT s FROM scale) AS h "
                f"FROM a{k} a JOIN g{r} g USING (udi) JOIN binned b USING (udi) WHERE g.kept AND a.node >= (SELECT first FROM base{k}) AND b.f IN ({columns}) GROUP BY ALL)",
                f"cum{k} AS MATERIALIZED (SELECT node, f, b, sum(g) OVER u AS gl, sum(h) OVER u AS hl, sum(g) OVER t AS g, sum(h) OVER t AS h FROM hist{k} WINDOW u AS (PARTITION BY node, f ORDER BY b), t AS (PARTITION BY node, f))",
                f"gain{k} AS (SELECT *, gl * gl / (hl + {cfg.l2}) + (g - gl) * (g - gl) / (h - hl + {cfg.l2}) - g * g / (h + {cfg.l2}) AS gain FROM cum{k} WHERE hl >= {cfg.min_child_hessian} AND h - hl >= {cfg.min_child_hessian})",
                f"best{k} AS (SELECT * FROM gain{k} WHERE gain > {LEAST_GAIN} QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, b) = 1)",
                f"split{k} AS MATERIALIZED (SELECT *, (SELECT next FROM base{k}) + 2 * (row_number() OVER (ORDER BY node) - 1) AS child FROM best{k})",
                f"base{up} AS MATERIALIZED (SELECT next AS first, next + 2 * (SELECT count(*) FROM split{k}) AS next FROM base{k})",
                f"a{up} AS MATERIALIZED (SELECT a.udi, s.child + CAST(b.b > s.b AS INTEGER) AS node FROM a{k} a JOIN split{k} s USING (node) JOIN binned b ON b.udi = a.udi AND b.f = s.f UNION ALL SELECT udi, node FROM a{k} WHERE node NOT IN (SELECT node FROM split{k}))",
            ]
        splits = " UNION ALL ".join(f"SELECT * FROM split{r}_{level}" for level in range(cfg.depth))
        ctes += [
            f"splits{r} AS MATERIALIZED ({splits})",
            f"sums{r} AS (SELECT 0 AS node, CAST(sum(g) AS DOUBLE) / (SELECT s FROM scale) AS g, CAST(sum(h) AS DOUBLE) / (SELECT s FROM scale) AS h FROM g{r} WHERE kept UNION ALL SELECT child, gl, hl FROM splits{r} UNION ALL SELECT child + 1, g - gl, h - hl FROM splits{r})",
            f"nodes{r} AS MATERIALIZED (SELECT {r} AS tree, n.node, coalesce(s.f, -1) AS feature, coalesce(e.v, 0.0) AS threshold, coalesce(s.child, -1) AS left_node, coalesce(s.child + 1, -1) AS right_node, "
            f"CASE WHEN s.node IS NULL THEN -{cfg.step} * n.g / (n.h + {cfg.l2}) ELSE 0.0 END AS value FROM sums{r} n LEFT JOIN splits{r} s USING (node) LEFT JOIN edges e ON e.f = s.f AND e.b = s.b)",
            f"m{r + 1} AS MATERIALIZED (SELECT m.udi, m.label, m.margin + n.value AS margin FROM m{r} m JOIN a{r}_{cfg.depth} a USING (udi) JOIN nodes{r} n USING (node))",
        ]
        out.append(f"SELECT * FROM nodes{r}")
    return "WITH " + ",\n".join(ctes) + "\nSELECT CAST(tree AS INTEGER) AS tree, CAST(node AS INTEGER) AS node, CAST(feature AS INTEGER) AS feature, round(threshold, 6) AS threshold, CAST(left_node AS INTEGER) AS left_node, CAST(right_node AS INTEGER) AS right_node, round(value, 9) AS value FROM (" + " UNION ALL ".join(out) + ")"


def tree_ctes(cfg: TreeConfig) -> list[str]:
    """CTEs ``nodes`` and ``leaf_of`` (udi of train and validation rows, node)."""
    both = long_features_sql("train", "x") + ",\n" + long_features_sql("validation", "y")
    ctes = [
        MACHINE_SPLIT,
        both,
        "every AS MATERIALIZED (SELECT * FROM x UNION ALL SELECT * FROM y)",
        "w AS MATERIALIZED (SELECT CAST(count(*) AS DOUBLE) / (2.0 * CAST(sum(1 - label) AS DOUBLE)) AS w0, CAST(count(*) AS DOUBLE) / (2.0 * CAST(sum(label) AS DOUBLE)) AS w1 FROM x_rows)",
        "t0 AS MATERIALIZED (SELECT udi, 0 AS node FROM x_rows UNION ALL SELECT udi, 0 FROM y_rows)",
        "b0 AS MATERIALIZED (SELECT 0 AS first, 1 AS next)",
    ]

    def pure(n0: str, n1: str) -> str:
        return f"((w0 * ({n0})) * (w0 * ({n0})) + (w1 * ({n1})) * (w1 * ({n1}))) / (w0 * ({n0}) + w1 * ({n1}))"

    for k in range(cfg.max_depth):
        ctes += [
            f"d{k} AS (SELECT t.node, x.f, x.v, count(*) AS c, sum(r.label)::BIGINT AS c1 FROM t{k} t JOIN x_rows r USING (udi) JOIN x USING (udi) WHERE t.node >= (SELECT first FROM b{k}) GROUP BY ALL)",
            f"u{k} AS (SELECT *, sum(c) OVER p AS l, sum(c1) OVER p AS l1, sum(c) OVER q AS n, sum(c1) OVER q AS n1, lead(v) OVER (PARTITION BY node, f ORDER BY v) AS above "
            f"FROM d{k} WINDOW p AS (PARTITION BY node, f ORDER BY v), q AS (PARTITION BY node, f))",
            f"g{k} AS (SELECT *, {pure('l - l1', 'l1')} + {pure('(n - n1) - (l - l1)', 'n1 - l1')} AS gain FROM u{k}, w WHERE n1 > 0 AND n1 < n AND l >= {cfg.min_rows} AND n - l >= {cfg.min_rows})",
            f"s{k} AS MATERIALIZED (SELECT node, f, CASE WHEN (v + above) / 2.0 >= above THEN v ELSE (v + above) / 2.0 END AS thr, (SELECT next FROM b{k}) + 2 * (row_number() OVER (ORDER BY node) - 1) AS child "
            f"FROM (SELECT * FROM g{k} QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, v) = 1))",
            f"b{k + 1} AS MATERIALIZED (SELECT next AS first, next + 2 * (SELECT count(*) FROM s{k}) AS next FROM b{k})",
            f"t{k + 1} AS MATERIALIZED (SELECT t.udi, CASE WHEN s.node IS NULL THEN t.node ELSE s.child + CAST(e.v > s.thr AS INTEGER) END AS node FROM t{k} t LEFT JOIN s{k} s USING (node) LEFT JOIN every e ON e.udi = t.udi AND e.f = s.f)",
        ]
    splits = " UNION ALL ".join(f"SELECT * FROM s{k}" for k in range(cfg.max_depth))
    ctes += [
        f"splits AS MATERIALIZED ({splits})",
        f"leaves AS MATERIALIZED (SELECT t.node, (w1 * sum(label)) / (w0 * sum(1 - label) + w1 * sum(label)) AS value FROM t{cfg.max_depth} t JOIN x_rows USING (udi), w GROUP BY t.node, w0, w1)",
    ]
    return ctes


def tree_nodes_sql(cfg: TreeConfig) -> str:
    return "WITH " + ",\n".join(tree_ctes(cfg)) + """
SELECT 0 AS tree, CAST(node AS INTEGER) AS node, CAST(f AS INTEGER) AS feature, round(thr, 6) AS threshold, CAST(child AS INTEGER) AS left_node, CAST(child + 1 AS INTEGER) AS right_node, 0.0 AS value FROM splits
UNION ALL SELECT 0, CAST(node AS INTEGER), -1, 0.0, -1, -1, round(value, 9) FROM leaves"""


def model_tree_sql(cfg: TreeConfig) -> str:
    """Validation metrics of the tree at its own threshold."""
    ctes = [
        *tree_ctes(cfg),
        f"vs AS MATERIALIZED (SELECT 'decision_tree' AS model, r.label, l.value AS score FROM y_rows r JOIN t{cfg.max_depth} t USING (udi) JOIN leaves l USING (node))",
        sweep_sql("vs", "model"), pick_sql("sw"), "vt AS (SELECT vs.*, pick.threshold AS picked FROM vs, pick)",
        confusion_sql("vt", "model", "picked"), ranking_sql("vs", "model"),
    ]
    return "WITH " + ",\n".join(c.strip().rstrip(",") for c in ctes) + f"""
SELECT cm.g AS model, round(pick.threshold, 6) AS threshold, {rates_select('cm.')}, rk.roc_auc, rk.average_precision, cm.tn, cm.fp, cm.fn, cm.tp
FROM cm, pick, rk"""


def forest_bootstrap_sql(trees: int, seed: int) -> str:
    steps = ", ".join(repr(s) for s in poisson_steps())
    return f"""WITH {MACHINE_SPLIT.strip().rstrip(',')},
draws AS (
  SELECT tree, machine_failure AS label,
    len(list_filter([{steps}], lambda s: s <= CAST(CAST('0x' || substr(md5('{seed}:' || tree::VARCHAR || ':' || udi::VARCHAR), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0)) AS m
  FROM machine_split, range({trees}) AS r(tree) WHERE split = 'train')
SELECT CAST(tree AS INTEGER) AS tree, count(*) AS rows, CAST(sum(m) AS BIGINT) AS draws, CAST(max(m) AS INTEGER) AS most, CAST(sum(m * label) AS BIGINT) AS positive_draws,
  round(CASE WHEN sum(m * (1 - label)) = 0 THEN 0.0 ELSE CAST(sum(m) AS DOUBLE) / (2.0 * CAST(sum(m * (1 - label)) AS DOUBLE)) END, 9) AS w0,
  round(CASE WHEN sum(m * label) = 0 THEN 0.0 ELSE CAST(sum(m) AS DOUBLE) / (2.0 * CAST(sum(m * label) AS DOUBLE)) END, 9) AS w1
FROM draws WHERE m > 0 GROUP BY tree"""


#: The tree of the comparison: depth 6, 8 rows in a node at least.
TREE = TreeConfig(max_depth=6, min_rows=8)
#: A shard's file: its lines in key order, each with its line end.
SHARD_FILES = """WITH shards AS (
  SELECT CAST(floor(o_orderkey / 5000) AS BIGINT) AS shard,
    string_agg(o_orderkey::VARCHAR || '|' || o_orderstatus || chr(10), '' ORDER BY o_orderkey) AS content
  FROM orders GROUP BY 1)"""


#: The registered learner queries that SQL can express.
LEARNER_ORACLE = {
    "shard_checksums": SHARD_FILES + " SELECT shard, CAST(strlen(content) AS BIGINT) AS length, sha256(content) AS sha256 FROM shards",
    "checksum_manifest": SHARD_FILES + """
SELECT shard, repeat('0', 64) AS expected, sha256(content) AS actual FROM shards WHERE shard % 10 = 0
UNION ALL SELECT max(shard) + 1, repeat('f', 64), NULL FROM shards""",
    "boosted_first_trees": first_boosted_trees_sql(2, BoostingConfig()),
    # the condition that the solution meets; the coefficients themselves have no closed form
    "logistic_gradient": f"SELECT CAST(unnest(range({WIDTH + 1})) AS INTEGER) AS position, CAST(0.0 AS DOUBLE) AS gradient",
    # the same rows through CSV files
    "scan_labelled_csv": ORACLE["scan_labelled"],
    "batch_score_csv": ORACLE["batch_score_linear"],
    "report_summary": "WITH " + MACHINE_SPLIT.strip().rstrip(",") + """
SELECT split AS part, count(*) AS rows, CAST(sum(machine_failure) AS BIGINT) AS positive_rows, round(avg(CAST(machine_failure AS DOUBLE)), 6) AS positive_rate FROM machine_split GROUP BY split
UNION ALL SELECT 'audit', count(*), CAST(sum(machine_failure) AS BIGINT), round(avg(CAST(machine_failure AS DOUBLE)), 6) FROM machine_split""",
    "tree_nodes": tree_nodes_sql(TREE),
    "model_tree": model_tree_sql(TREE),
    "forest_bootstrap": forest_bootstrap_sql(250, 42),
}
