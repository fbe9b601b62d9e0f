"""Registered queries: one Spark DataFrame per operator of the inventory,
each reading the given tables (or what Spark derives from them), plus the
DuckDB oracle SQL for every key whose result does not involve a trained
model.  Column names match between the two sides.
"""

from __future__ import annotations

from typing import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import predicted, rounded
from ..functions.scorers import torque_wear_score
from ..operators import audit as audit_ops
from ..operators.importance import permutation_importance
from ..operators.metrics import binary_metrics, confusion_matrix, ranking_metrics
from ..operators.parity import score_parity
from ..operators.preprocess import FEATURES_COL, fit_preprocessor
from ..operators.quantiles import exact_medians
from ..operators.selection import choose_candidate
from ..operators.split import TRAIN, allocation, class_counts, hash_split, split_summary, stratified_split
from ..operators.threshold import select_threshold, threshold_sweep
from ..schema import CUSTOMER_TASK, DOCUMENT_TASK, MACHINE_TASK, ORDER_TASK
from ..sources.adapters import load_documents, load_machine, load_orders
from ..sources.tables import read_table
from . import oracle_sql as O

Query = Callable[[SparkSession, str], DataFrame]
S = MACHINE_TASK
SEED = 42


# ---------------------------------------------------------------- helpers

def _split(spark: SparkSession, sf: str) -> DataFrame:
    return stratified_split(load_machine(spark, sf), S, SEED)


def _scored(spark: SparkSession, sf: str, scale: float = 100.0) -> DataFrame:
    """Machine rows with split, label and the closed-form score."""
    return _split(spark, sf).select(
        "udi", "split", F.col("machine_failure").alias("label"),
        torque_wear_score(F.col("torque"), F.col("tool_wear"), scale).alias("score"),
    )


def _validation(spark: SparkSession, sf: str) -> DataFrame:
    return _split(spark, sf).where(F.col("split") == "validation")


def _with_gaps(split: DataFrame) -> DataFrame:
    """The machine table with missing cells by a fixed rule over all rows, and
    categories outside the training part that no training row has."""
    cell = {c: (F.col("udi") * 31 + i) for i, c in enumerate(S.numeric)}
    numeric = {c: F.when(n % 7 == 0, F.lit(None)).when(n % 11 == 0, F.lit(float("nan"))).otherwise(F.col(c)) for c, n in cell.items()}
    kind = F.when(F.col("udi") % 13 == 0, F.lit(None)).when((F.col("udi") % 17 == 0) & (F.col("split") != TRAIN), F.lit("X")).otherwise(F.col("type"))
    return split.withColumns({**numeric, "type": kind})


def _fitted(spark: SparkSession, sf: str, gaps: bool = False):
    split = _with_gaps(_split(spark, sf)) if gaps else _split(spark, sf)
    model, stats = fit_preprocessor(split.where(F.col("split") == TRAIN), S)
    return split, model, stats


METRICS = ("threshold", "accuracy", "precision", "recall", "f1", "roc_auc", "average_precision", "mean_average_precision_drop", "standard_deviation",
           "average_precision_a", "average_precision_b", "roc_auc_a", "roc_auc_b", "max_abs_difference")


def _reported(metrics: DataFrame) -> DataFrame:
    """Operators return full doubles; reported ones have six places."""
    return metrics.withColumns({c: rounded(F.col(c)) for c in METRICS if c in metrics.columns})


# ------------------------------------------------------- sources / audit

def q_scan_labelled(spark, sf):
    return load_machine(spark, sf)


def q_feature_target(spark, sf):
    return audit_ops.feature_target(load_machine(spark, sf), S)


def q_audit_counts(spark, sf):
    return audit_ops.audit_stats(load_machine(spark, sf), S).select("rows", "positive_rows", rounded(F.col("positive_rate")).alias("positive_rate"))


def q_audit_missing(spark, sf):
    stats = audit_ops.audit_stats(load_machine(spark, sf), S)
    return stats.select(*[f"missing_{c}" for c in S.required])


def q_audit_domains(spark, sf):
    machine = audit_ops.audit_stats(load_machine(spark, sf), S).select(
        F.lit("machine").alias("table_name"), "invalid_target", F.col("invalid_type").alias("invalid_category")
    )
    orders = audit_ops.audit_stats(load_orders(spark, sf), ORDER_TASK).select(
        F.lit("orders").alias("table_name"), "invalid_target", F.col("invalid_o_orderstatus").alias("invalid_category")
    )
    return machine.unionByName(orders)


def q_audit_finite(spark, sf):
    return audit_ops.audit_stats(load_machine(spark, sf), S).select(*[f"nonfinite_{c}" for c in S.numeric])


def q_audit_duplicate_keys(spark, sf):
    return audit_ops.duplicate_keys(read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_audit_summary(spark, sf):
    return audit_ops.audit_summary(load_machine(spark, sf), S)


# ---------------------------------------------------------------- split

def q_split_allocation(spark, sf):
    return allocation(class_counts(load_machine(spark, sf), S.target))


def q_stratified_split(spark, sf):
    return _split(spark, sf).select("udi", "machine_failure", "split")


def q_stratified_split_refined(spark, sf):
    """The same split by refining hash prefixes down to buckets of 40 rows."""
    return stratified_split(load_machine(spark, sf), S, SEED, audit=True, final_rows=40).select("udi", "machine_failure", "split")


def q_split_sorted(spark, sf):
    return _split(spark, sf).select("split", "udi").orderBy("split", "udi")


def q_split_summary(spark, sf):
    return split_summary(_split(spark, sf), S.target)


def q_document_split_summary(spark, sf):
    docs = stratified_split(load_documents(spark, sf), DOCUMENT_TASK, SEED)
    return split_summary(docs, DOCUMENT_TASK.target)


def q_hash_split(spark, sf):
    return hash_split(load_machine(spark, sf), S, SEED).select("udi", "split")


# -------------------------------------------------------- preprocessing

def _median_rows(spark, medians: dict) -> DataFrame:
    rows = [(c, medians[c]) for c in S.numeric]
    return spark.createDataFrame(rows, "feature string, median double").select("feature", rounded(F.col("median")).alias("median"))


def q_impute_median(spark, sf):
    return _median_rows(spark, _fitted(spark, sf)[2].medians)


def q_impute_median_gaps(spark, sf):
    return _median_rows(spark, _fitted(spark, sf, gaps=True)[2].medians)


def q_impute_median_narrowed(spark, sf):
    """The same medians by narrowing brackets down to 50 values."""
    train = _with_gaps(_split(spark, sf)).where(F.col("split") == TRAIN)
    return _median_rows(spark, exact_medians(train, list(S.numeric), final_values=50))


def q_standardize(spark, sf):
    _, _, stats = _fitted(spark, sf)
    rows = [(c, stats.means[c], stats.scales[c]) for c in S.numeric]
    return spark.createDataFrame(rows, "feature string, mean double, std double").select(
        "feature", rounded(F.col("mean")).alias("mean"), rounded(F.col("std")).alias("std")
    )


def q_impute_mode(spark, sf, gaps=False):
    _, _, stats = _fitted(spark, sf, gaps)
    return spark.createDataFrame([(c, stats.modes[c]) for c in S.categorical], "feature string, mode string")


def q_one_hot(spark, sf, gaps=False):
    split, model, stats = _fitted(spark, sf, gaps)
    width = len(S.numeric)
    out = model.transform(split).select("udi", "split", vector_to_array(FEATURES_COL).alias("v"))
    cols = [F.col("v")[width + i].cast("int").alias(f"type_{v}") for i, v in enumerate(stats.categories["type"])]
    return out.select("udi", "split", *cols)


def q_feature_vector(spark, sf, gaps=False):
    split, model, _ = _fitted(spark, sf, gaps)
    out = model.transform(split).select("udi", "split", F.posexplode(vector_to_array(FEATURES_COL)).alias("position", "value"))
    return out.select("udi", "split", "position", rounded(F.col("value")).alias("value"))


def _orders_by_customer(spark, sf):
    """Orders split by class, customer and status as categories held in a table."""
    split = stratified_split(load_orders(spark, sf), CUSTOMER_TASK, SEED).select(
        "o_orderkey", "split", "o_totalprice", "o_orderstatus", F.col("o_custkey").cast("string").alias("o_custkey")
    )
    model, _ = fit_preprocessor(split.where(F.col("split") == TRAIN), CUSTOMER_TASK, listed=0)
    return split, model


def q_category_table(spark, sf):
    """Places of all categories in the vector, and which of them are hot."""
    return _orders_by_customer(spark, sf)[1].stages[-1].table


def q_one_hot_joined(spark, sf):
    """Places set in each row's vector; customers are joined, statuses broadcast."""
    split, model = _orders_by_customer(spark, sf)
    model.stages[-1].broadcast_up_to(64)
    sparse = model.transform(split).select("o_orderkey", "split", F.unwrap_udt(FEATURES_COL).alias("x"))
    places = sparse.select("o_orderkey", "split", F.inline(F.arrays_zip("x.indices", "x.values")))
    return places.where(F.col("indices") >= len(CUSTOMER_TASK.numeric)).select(
        "o_orderkey", "split", F.col("indices").alias("position"), F.col("values").cast("int").alias("value")
    )


def q_preprocess_train_only(spark, sf):
    """Mean z-score per split and numeric feature: zero on train by
    construction, not on the splits that were only transformed."""
    split, model, _ = _fitted(spark, sf)
    z = model.transform(split).select("split", F.posexplode(vector_to_array(FEATURES_COL)).alias("position", "value"))
    return (
        z.where(F.col("position") < len(S.numeric))
        .groupBy("split", "position")
        .agg((rounded(F.avg("value")) + F.lit(0.0)).alias("mean_z"))
    )


def q_document_audit_summary(spark, sf):
    return audit_ops.audit_summary(load_documents(spark, sf), DOCUMENT_TASK)


# --------------------------------------------------- weights / baseline

def q_prior_baseline(spark, sf):
    split = _split(spark, sf)
    rate = split.where(F.col("split") == "train").agg(F.avg(F.col("machine_failure").cast("double")).alias("prior"))
    return split.where(F.col("split") != "train").select("udi", "split", rounded(rate.scalar()).alias("score"))


def q_class_weights(spark, sf):
    train = _split(spark, sf).where(F.col("split") == "train")
    counts = train.groupBy(F.col("machine_failure").alias("cls")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # over two rows
    return counts.select("cls", "n", rounded(total.cast("double") / (F.lit(2.0) * F.col("n").cast("double"))).alias("weight"))


def q_positive_weight(spark, sf):
    train = _split(spark, sf).where(F.col("split") == "train")
    agg = train.agg(
        F.sum(F.col("machine_failure").cast("long")).alias("positives"),
        F.sum((1 - F.col("machine_failure")).cast("long")).alias("negatives"),
    )
    return agg.select("positives", "negatives", rounded(F.col("negatives").cast("double") / F.col("positives").cast("double")).alias("scale_pos_weight"))


# ------------------------------------------------------------- metrics

def q_apply_threshold(spark, sf):
    scored = _scored(spark, sf)
    return scored.select("udi", "split", "score", predicted(F.col("score"), 0.5).alias("predicted"))


def q_confusion_matrix(spark, sf):
    return confusion_matrix(_scored(spark, sf), "label", "score", 0.5, ["split"]).drop("threshold")


def q_binary_metrics(spark, sf):
    return _reported(binary_metrics(_scored(spark, sf), "label", "score", 0.5, ["split"]))


def q_average_precision(spark, sf):
    return _reported(ranking_metrics(_scored(spark, sf), "label", "score", ["split"])).select("split", "rows", "positives", "average_precision")


def q_roc_auc(spark, sf):
    return _reported(ranking_metrics(_scored(spark, sf), "label", "score", ["split"])).select("split", "rows", "positives", "roc_auc")


def q_ranking_null_group(spark, sf):
    """Ranking metrics by a group key that is NULL for the test part."""
    group = F.when(F.col("split") != "test", F.col("split")).alias("grp")
    scored = _scored(spark, sf).select(group, "label", "score")
    return _reported(ranking_metrics(scored, "label", "score", ["grp"])).select("grp", "rows", "positives", "average_precision", "roc_auc")


def q_threshold_sweep(spark, sf):
    swept = threshold_sweep(_scored(spark, sf), "label", "score", ["split"])
    return swept.select(
        "split", "grid_index", rounded(F.col("threshold")).alias("threshold"), "tp", "fp", "fn", "tn",
        rounded(F.col("precision")).alias("precision"), rounded(F.col("recall")).alias("recall"), rounded(F.col("f1")).alias("f1"),
    )


def q_select_threshold(spark, sf):
    picked = select_threshold(_scored(spark, sf), "label", "score", ["split"])
    return _reported(picked).select("split", "threshold", "f1", "recall")


def _closed_form_candidates(spark, sf) -> DataFrame:
    """Validation scores of three closed-form scorers, tagged by name."""
    scorers = [
        ("torque_wear", 0, torque_wear_score(F.col("torque"), F.col("tool_wear"), 100.0)),
        ("torque_wear_coarse", 1, torque_wear_score(F.col("torque"), F.col("tool_wear"), 10.0)),
        ("torque_only", 2, torque_wear_score(F.col("torque"), F.lit(0.0), 100.0)),
    ]
    each = F.array(*[F.struct(F.lit(n).alias("model"), F.lit(i).alias("ordinal"), s.alias("score")) for n, i, s in scorers])
    val = _validation(spark, sf).select("udi", F.col("machine_failure").alias("label"), F.explode(each).alias("c"))
    return val.select("udi", "label", "c.score", "c.model", "c.ordinal")


def _scorer_metrics(spark, sf):
    scores = _closed_form_candidates(spark, sf)
    picks = select_threshold(scores, "label", "score", ["model", "ordinal"]).select("model", F.col("threshold").alias("picked"))
    # a handful of rows (one per candidate): broadcast is bounded by the candidate count
    with_t = scores.join(F.broadcast(picks), "model")
    return binary_metrics(with_t, "label", "score", "picked", ["model", "ordinal"])


def q_scorer_comparison(spark, sf):
    return _reported(_scorer_metrics(spark, sf))


def q_choose_candidate(spark, sf):
    return _reported(choose_candidate(_scorer_metrics(spark, sf))).select("model", "threshold", "f1", "average_precision")


def q_permutation_importance(spark, sf):
    rows = _validation(spark, sf).select("udi", *S.features, "machine_failure")

    def scorer(df: DataFrame) -> DataFrame:
        return df.withColumn("score", torque_wear_score(F.col("torque"), F.col("tool_wear"), 100.0))

    return _reported(permutation_importance(rows, S, scorer, SEED, 10, "machine_failure"))


def q_score_parity(spark, sf):
    val = _scored(spark, sf, 100.0).where(F.col("split") == "validation")
    other = _scored(spark, sf, 10.0).where(F.col("split") == "validation")
    return _reported(score_parity(val.select("udi", "label", "score"), other.select("udi", "label", "score"), "udi", "label"))


# ------------------------------------------------------------ registry

O_QUERIES: dict[str, Query] = {
    "scan_labelled": q_scan_labelled,
    "feature_target": q_feature_target,
    "audit_counts": q_audit_counts,
    "audit_missing": q_audit_missing,
    "audit_domains": q_audit_domains,
    "audit_finite": q_audit_finite,
    "audit_duplicate_keys": q_audit_duplicate_keys,
    "audit_summary": q_audit_summary,
    "split_allocation": q_split_allocation,
    "stratified_split": q_stratified_split,
    "stratified_split_refined": q_stratified_split_refined,
    "split_sorted": q_split_sorted,
    "split_summary": q_split_summary,
    "document_split_summary": q_document_split_summary,
    "hash_split": q_hash_split,
    "impute_median": q_impute_median,
    "impute_median_gaps": q_impute_median_gaps,
    "impute_median_narrowed": q_impute_median_narrowed,
    "impute_mode_gaps": lambda spark, sf: q_impute_mode(spark, sf, gaps=True),
    "one_hot_gaps": lambda spark, sf: q_one_hot(spark, sf, gaps=True),
    "feature_vector_gaps": lambda spark, sf: q_feature_vector(spark, sf, gaps=True),
    "standardize": q_standardize,
    "impute_mode": q_impute_mode,
    "one_hot": q_one_hot,
    "feature_vector": q_feature_vector,
    "category_table": q_category_table,
    "one_hot_joined": q_one_hot_joined,
    "preprocess_train_only": q_preprocess_train_only,
    "document_audit_summary": q_document_audit_summary,
    "prior_baseline": q_prior_baseline,
    "class_weights": q_class_weights,
    "positive_weight": q_positive_weight,
    "apply_threshold": q_apply_threshold,
    "confusion_matrix": q_confusion_matrix,
    "binary_metrics": q_binary_metrics,
    "average_precision": q_average_precision,
    "roc_auc": q_roc_auc,
    "ranking_null_group": q_ranking_null_group,
    "threshold_sweep": q_threshold_sweep,
    "select_threshold": q_select_threshold,
    "scorer_comparison": q_scorer_comparison,
    "choose_candidate": q_choose_candidate,
    "permutation_importance": q_permutation_importance,
    "score_parity": q_score_parity,
}


# ------------------------------------------------------------ oracle SQL

def _with(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip().rstrip(",") for c in ctes if c.strip())


def _missing_sql(name: str) -> str:
    if name in S.numeric:
        return f"count_if({name} IS NULL OR isnan({name})) AS missing_{name}"
    return f"count_if({name} IS NULL) AS missing_{name}"


_CATEGORIES = O.split_sql("(SELECT *, CAST(o_orderpriority LIKE '1%' AS INTEGER) AS urgent FROM orders)", "o_orderkey", "urgent", name="orders_split") + """,
cells AS (
  SELECT 0 AS feature, o_orderkey, split, o_orderstatus AS v FROM orders_split
  UNION ALL SELECT 1, o_orderkey, split, CAST(o_custkey AS VARCHAR) FROM orders_split),
counted AS (SELECT feature, v, count(*) AS n FROM cells WHERE split = 'train' AND v IS NOT NULL GROUP BY feature, v),
places AS (
  SELECT feature, v, n * 1024 > sum(n) OVER (PARTITION BY feature) AS hot, CAST(row_number() OVER (ORDER BY feature, v) AS INTEGER) AS position
  FROM counted)"""
_TRAIN = "machine_split_train AS (SELECT * FROM machine_split WHERE split = 'train')"
_STATS = ",\n".join(
    f"(SELECT avg({c}) FROM machine_split_train) AS mean_{i}, (SELECT stddev_pop({c}) FROM machine_split_train) AS std_{i}"
    for i, c in enumerate(S.numeric)
)
_TRAIN_FRACTION = 1.0 - 0.4
_VALIDATION_CUT = _TRAIN_FRACTION + 0.4 * (1.0 - 0.5)


def _feature_vector_sql() -> str:
    parts = []
    for i, c in enumerate(S.numeric):
        parts.append(
            f"SELECT udi, split, {i} AS position, round((coalesce({c}, (SELECT median({c}) FROM machine_split_train)) - "
            f"(SELECT avg({c}) FROM machine_split_train)) / (SELECT stddev_pop({c}) FROM machine_split_train), 6) AS value FROM machine_split"
        )
    for j, v in enumerate(("H", "L", "M")):
        parts.append(
            f"SELECT udi, split, {len(S.numeric) + j} AS position, round(CAST(type = '{v}' AS DOUBLE), 6) AS value FROM machine_split"
        )
    return _with(O.MACHINE_SPLIT, _TRAIN) + "\n" + "\nUNION ALL\n".join(parts)


def _candidates_cte() -> str:
    return f"""cand AS (
  SELECT udi, machine_failure AS label, {O.SCORE_A} AS score, 'torque_wear' AS model, 0 AS ordinal FROM machine_split WHERE split = 'validation'
  UNION ALL
  SELECT udi, machine_failure AS label, {O.SCORE_B} AS score, 'torque_wear_coarse' AS model, 1 AS ordinal FROM machine_split WHERE split = 'validation'
  UNION ALL
  SELECT udi, machine_failure AS label, {O.SCORE_TORQUE} AS score, 'torque_only' AS model, 2 AS ordinal FROM machine_split WHERE split = 'validation')"""


_CANDIDATE_METRICS = _with(
    O.MACHINE_SPLIT,
    _candidates_cte(),
    O.sweep_sql("cand", "model"),
    O.pick_sql("sw"),
    "cand_t AS (SELECT c.*, p.threshold AS picked FROM cand c JOIN pick p ON c.model = p.g)",
    O.confusion_sql("cand_t", "model", "picked"),
    O.ranking_sql("cand", "model"),
) + f"""
SELECT cm.g AS model, round(p.threshold, 6) AS threshold, {O.rates_select('cm.')}, rk.roc_auc, rk.average_precision,
       cm.tn, cm.fp, cm.fn, cm.tp, o.ordinal
FROM cm JOIN pick p ON cm.g = p.g JOIN rk ON cm.g = rk.g
JOIN (SELECT DISTINCT model, ordinal FROM cand) o ON o.model = cm.g"""


def _importance_sql(repeats: int = 10) -> str:
    feats = list(S.features)
    names = ", ".join(f"'{f}'" for f in feats)
    around = "PARTITION BY rep ORDER BY k, udi"
    donor = ", ".join(f"coalesce(lead({f}) OVER ({around}), first_value({f}) OVER ({around})) AS d_{f}" for f in feats)
    replaced = ", ".join(f"CASE WHEN feature = '{f}' THEN d_{f} ELSE {f} END AS {f}" for f in feats)
    return _with(
        O.MACHINE_SPLIT,
        "val AS (SELECT udi, machine_failure AS label, " + ", ".join(feats) + " FROM machine_split WHERE split = 'validation')",
        f"keyed AS (SELECT val.*, rep, md5('42:' || CAST(rep AS VARCHAR) || ':' || CAST(udi AS VARCHAR)) AS k FROM val, range({repeats}) t(rep))",
        f"donor AS (SELECT *, {donor} FROM keyed)",
        f"expanded AS (SELECT *, unnest([{names}]) AS feature FROM donor)",
        f"permuted AS (SELECT udi, label, feature, rep, {replaced} FROM expanded)",
        f"perm_scored AS (SELECT feature || '|' || CAST(rep AS VARCHAR) AS grp, feature, rep, label, {O.SCORE_A} AS score FROM permuted)",
        O.ranking_sql("perm_scored", "grp", name="rp", places=None),
        f"base_scored AS (SELECT 'all' AS grp, label, {O.SCORE_A} AS score FROM val)",
        O.ranking_sql("base_scored", "grp", name="rb", places=None),
        "drops AS (SELECT split_part(rp.g, '|', 1) AS feature, (SELECT average_precision FROM rb) - rp.average_precision AS d FROM rp)",
    ) + """
SELECT feature, round(avg(d), 6) + 0.0 AS mean_average_precision_drop, round(stddev_pop(d), 6) AS standard_deviation
FROM drops GROUP BY feature ORDER BY mean_average_precision_drop DESC, feature"""


def _gaps_cte() -> str:
    cells = ", ".join(
        f"CASE WHEN (udi * 31 + {i}) % 7 = 0 OR (udi * 31 + {i}) % 11 = 0 THEN NULL ELSE {c} END AS {c}" for i, c in enumerate(S.numeric)
    )
    kind = "CASE WHEN udi % 13 = 0 THEN NULL WHEN udi % 17 = 0 AND split <> 'train' THEN 'X' ELSE type END AS type"
    return f"gaps AS (SELECT udi, split, {cells}, {kind} FROM machine_split), gaps_train AS (SELECT * FROM gaps WHERE split = 'train')"


_GAPS_MODE = "(SELECT type FROM gaps_train WHERE type IS NOT NULL GROUP BY type ORDER BY count(*) DESC, type LIMIT 1)"


def _gaps_vector_sql() -> str:
    parts = []
    for i, c in enumerate(S.numeric):
        filled = f"coalesce({c}, (SELECT median({c}) FROM gaps_train))"
        stat = lambda f, x=filled: f"(SELECT {f}({x}) FROM gaps_train)"
        parts.append(f"SELECT udi, split, {i} AS position, round(({filled} - {stat('avg')}) / {stat('stddev_pop')}, 6) AS value FROM gaps")
    for j, v in enumerate(("H", "L", "M")):
        parts.append(f"SELECT udi, split, {len(S.numeric) + j} AS position, CAST(coalesce(type, {_GAPS_MODE}) = '{v}' AS DOUBLE) AS value FROM gaps")
    return _with(O.MACHINE_SPLIT, _gaps_cte()) + "\n" + "\nUNION ALL\n".join(parts)


_PARITY_SQL = _with(
    O.MACHINE_SPLIT,
    f"pa AS (SELECT udi, machine_failure AS label, {O.SCORE_A} AS score_a FROM machine_split WHERE split = 'validation')",
    f"pb AS (SELECT udi, {O.SCORE_B} AS score_b FROM machine_split WHERE split = 'validation')",
    "pj AS (SELECT coalesce(pa.udi, pb.udi) AS udi, pa.label, pa.score_a, pb.score_b FROM pa FULL OUTER JOIN pb ON pa.udi = pb.udi)",
    "pm AS (SELECT 'all' AS grp, * FROM pj WHERE score_a IS NOT NULL AND score_b IS NOT NULL)",
    O.ranking_sql("pm", "grp", score="score_a", name="ra"),
    O.ranking_sql("pm", "grp", score="score_b", name="rb"),
) + """
SELECT count_if(score_a IS NOT NULL AND score_b IS NOT NULL) AS rows_matched,
       count_if(score_b IS NULL) AS unmatched_a, count_if(score_a IS NULL) AS unmatched_b,
       (SELECT average_precision FROM ra) AS average_precision_a, (SELECT average_precision FROM rb) AS average_precision_b,
       (SELECT roc_auc FROM ra) AS roc_auc_a, (SELECT roc_auc FROM rb) AS roc_auc_b,
       round(max(abs(score_a - score_b)), 6) AS max_abs_difference
FROM pj"""

_DOCS = """docs AS (SELECT l.doc_id, d.lang, d.source, CAST(d.n_chars AS DOUBLE) AS n_chars, l.toxic, l.quality
                FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""

ORACLE: dict[str, str] = {
    "scan_labelled": _with(O.MACHINE_SQL) + "\nSELECT * FROM machine",
    "feature_target": _with(O.MACHINE_SQL) + "\nSELECT " + ", ".join(S.features) + ", CAST(machine_failure AS INTEGER) AS machine_failure FROM machine",
    "audit_counts": _with(O.MACHINE_SQL) + "\nSELECT count(*) AS rows, CAST(sum(machine_failure) AS BIGINT) AS positive_rows, round(avg(CAST(machine_failure AS DOUBLE)), 6) AS positive_rate FROM machine",
    "audit_missing": _with(O.MACHINE_SQL) + "\nSELECT " + ", ".join(_missing_sql(c) for c in S.required) + " FROM machine",
    "audit_domains": _with(O.MACHINE_SQL) + """
SELECT 'machine' AS table_name, count_if(machine_failure IS NOT NULL AND machine_failure NOT IN (0, 1)) AS invalid_target,
       count_if(type IS NOT NULL AND type NOT IN ('L', 'M', 'H')) AS invalid_category FROM machine
UNION ALL
SELECT 'orders' AS table_name, count_if(CAST(starts_with(o_orderpriority, '1') AS INTEGER) NOT IN (0, 1)) AS invalid_target,
       count_if(o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O', 'P')) AS invalid_category FROM orders""",
    "audit_finite": _with(O.MACHINE_SQL) + "\nSELECT " + ", ".join(f"count_if(isinf({c})) AS nonfinite_{c}" for c in S.numeric) + " FROM machine",
    "audit_duplicate_keys": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "audit_summary": _with(O.MACHINE_SQL) + "\nSELECT count(*) AS rows, 6 AS feature_count, CAST(sum(machine_failure) AS BIGINT) AS positive_rows, "
    "round(avg(CAST(machine_failure AS DOUBLE)), 6) AS positive_rate, CAST("
    + " + ".join(_missing_sql(c).split(" AS ")[0] for c in S.required)
    + " AS BIGINT) AS missing_values, (SELECT count(*) FROM (SELECT udi FROM machine GROUP BY udi HAVING count(*) > 1)) AS duplicate_ids, "
    "'udi,product_id' AS excluded_id_columns, 'twf,hdf,pwf,osf,rnf' AS excluded_leak_columns FROM machine",
    "split_allocation": _with(O.MACHINE_SPLIT) + "\nSELECT cls, n, n_train, n_validation, rest - n_validation AS n_test FROM machine_split_alloc",
    "stratified_split": _with(O.MACHINE_SPLIT) + "\nSELECT udi, machine_failure, split FROM machine_split",
    "stratified_split_refined": _with(O.MACHINE_SPLIT) + "\nSELECT udi, machine_failure, split FROM machine_split",
    "split_sorted": _with(O.MACHINE_SPLIT) + "\nSELECT split, udi FROM machine_split ORDER BY split, udi",
    "split_summary": _with(O.MACHINE_SPLIT) + "\nSELECT split, count(*) AS rows, CAST(sum(machine_failure) AS BIGINT) AS positive_rows, "
    "round(avg(CAST(machine_failure AS DOUBLE)), 6) AS positive_rate FROM machine_split GROUP BY split",
    "document_split_summary": _with(_DOCS, O.split_sql("docs", "doc_id", "toxic", name="doc_split"))
    + "\nSELECT split, count(*) AS rows, CAST(sum(toxic) AS BIGINT) AS positive_rows, round(avg(CAST(toxic AS DOUBLE)), 6) AS positive_rate FROM doc_split GROUP BY split",
    "hash_split": _with(O.MACHINE_SQL) + f"""
SELECT udi, CASE WHEN pos < {_TRAIN_FRACTION!r} THEN 'train' WHEN pos < {_VALIDATION_CUT!r} THEN 'validation' ELSE 'test' END AS split
FROM (SELECT udi, CAST(('0x' || substr(md5('42:' || CAST(udi AS VARCHAR)), 1, 8))::BIGINT AS DOUBLE) / 4294967296.0 AS pos FROM machine)""",
    "impute_median": _with(O.MACHINE_SPLIT, _TRAIN) + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, round(median({c}), 6) AS median FROM machine_split_train" for c in S.numeric
    ),
    **{k: _with(O.MACHINE_SPLIT, _gaps_cte()) + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, round(median({c}), 6) AS median FROM gaps_train" for c in S.numeric
    ) for k in ("impute_median_gaps", "impute_median_narrowed")},
    "impute_mode_gaps": _with(O.MACHINE_SPLIT, _gaps_cte()) + f"\nSELECT 'type' AS feature, {_GAPS_MODE} AS mode",
    "one_hot_gaps": _with(O.MACHINE_SPLIT, _gaps_cte(), f"filled AS (SELECT udi, split, coalesce(type, {_GAPS_MODE}) AS type FROM gaps)")
    + "\nSELECT udi, split, CAST(type = 'H' AS INTEGER) AS type_H, CAST(type = 'L' AS INTEGER) AS type_L, CAST(type = 'M' AS INTEGER) AS type_M FROM filled",
    "feature_vector_gaps": _gaps_vector_sql(),
    "standardize": _with(O.MACHINE_SPLIT, _TRAIN) + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std FROM machine_split_train" for c in S.numeric
    ),
    "impute_mode": _with(O.MACHINE_SPLIT, _TRAIN)
    + "\nSELECT 'type' AS feature, type AS mode FROM (SELECT type, count(*) AS c FROM machine_split_train WHERE type IS NOT NULL GROUP BY type ORDER BY c DESC, type ASC LIMIT 1)",
    "one_hot": _with(O.MACHINE_SPLIT, _TRAIN)
    + "\nSELECT udi, split, CAST(type = 'H' AS INTEGER) AS type_H, CAST(type = 'L' AS INTEGER) AS type_L, CAST(type = 'M' AS INTEGER) AS type_M FROM machine_split",
    "feature_vector": _feature_vector_sql(),
    "category_table": _with(_CATEGORIES) + "\nSELECT feature, v, hot, position FROM places",
    "one_hot_joined": _with(_CATEGORIES) + "\nSELECT o_orderkey, split, position, 1 AS value FROM cells JOIN places USING (feature, v)",
    "preprocess_train_only": _with(O.MACHINE_SPLIT, _TRAIN) + "\n" + "\nUNION ALL\n".join(
        f"SELECT split, {i} AS position, round(avg((coalesce({c}, (SELECT median({c}) FROM machine_split_train)) - "
        f"(SELECT avg({c}) FROM machine_split_train)) / (SELECT stddev_pop({c}) FROM machine_split_train)), 6) + 0.0 AS mean_z "
        f"FROM machine_split GROUP BY split"
        for i, c in enumerate(S.numeric)
    ),
    "document_audit_summary": _with(_DOCS) + """
SELECT count(*) AS rows, 3 AS feature_count, CAST(sum(toxic) AS BIGINT) AS positive_rows, round(avg(CAST(toxic AS DOUBLE)), 6) AS positive_rate,
       CAST(count_if(doc_id IS NULL) + count_if(lang IS NULL) + count_if(source IS NULL) + count_if(n_chars IS NULL OR isnan(n_chars))
            + count_if(toxic IS NULL) + count_if(quality IS NULL) AS BIGINT) AS missing_values,
       (SELECT count(*) FROM (SELECT doc_id FROM docs GROUP BY doc_id HAVING count(*) > 1)) AS duplicate_ids,
       'doc_id' AS excluded_id_columns, 'quality' AS excluded_leak_columns
FROM docs""",
    "prior_baseline": _with(O.MACHINE_SPLIT)
    + "\nSELECT udi, split, round((SELECT avg(CAST(machine_failure AS DOUBLE)) FROM machine_split WHERE split = 'train'), 6) AS score FROM machine_split WHERE split <> 'train'",
    "class_weights": _with(O.MACHINE_SPLIT, _TRAIN)
    + "\nSELECT machine_failure AS cls, count(*) AS n, round(CAST((SELECT count(*) FROM machine_split_train) AS DOUBLE) / (2.0 * CAST(count(*) AS DOUBLE)), 6) AS weight FROM machine_split_train GROUP BY 1",
    "positive_weight": _with(O.MACHINE_SPLIT, _TRAIN)
    + "\nSELECT CAST(sum(machine_failure) AS BIGINT) AS positives, CAST(sum(1 - machine_failure) AS BIGINT) AS negatives, "
    "round(CAST(sum(1 - machine_failure) AS DOUBLE) / CAST(sum(machine_failure) AS DOUBLE), 6) AS scale_pos_weight FROM machine_split_train",
    "apply_threshold": _with(O.SCORED) + "\nSELECT udi, split, score, CAST(score >= 0.5 AS INTEGER) AS predicted FROM scored",
    "confusion_matrix": _with(O.SCORED, O.confusion_sql("scored", "split", "CAST(0.5 AS DOUBLE)")) + "\nSELECT g AS split, tn, fp, fn, tp FROM cm",
    "binary_metrics": _with(O.SCORED, O.confusion_sql("scored", "split", "CAST(0.5 AS DOUBLE)"), O.ranking_sql("scored", "split"))
    + f"\nSELECT cm.g AS split, CAST(0.5 AS DOUBLE) AS threshold, {O.rates_select('cm.')}, rk.roc_auc, rk.average_precision, cm.tn, cm.fp, cm.fn, cm.tp FROM cm JOIN rk ON cm.g = rk.g",
    "average_precision": _with(O.SCORED, O.ranking_sql("scored", "split")) + "\nSELECT g AS split, rows, positives, average_precision FROM rk",
    "roc_auc": _with(O.SCORED, O.ranking_sql("scored", "split")) + "\nSELECT g AS split, rows, positives, roc_auc FROM rk",
    "ranking_null_group": _with(O.SCORED, "ng AS (SELECT CASE WHEN split <> 'test' THEN split END AS grp, label, score FROM scored)", O.ranking_sql("ng", "grp"))
    + "\nSELECT g AS grp, rows, positives, average_precision, roc_auc FROM rk",
    "threshold_sweep": _with(O.SCORED, O.sweep_sql("scored", "split"))
    + "\nSELECT g AS split, grid_index, round(threshold, 6) AS threshold, tp, fp, fn, tn, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM sw",
    "select_threshold": _with(O.SCORED, O.sweep_sql("scored", "split"), O.pick_sql("sw"))
    + "\nSELECT g AS split, round(threshold, 6) AS threshold, round(f1, 6) AS f1, round(recall, 6) AS recall FROM pick",
    "scorer_comparison": _CANDIDATE_METRICS,
    "choose_candidate": "SELECT model, threshold, f1, average_precision FROM (" + _CANDIDATE_METRICS + ") ORDER BY average_precision DESC, f1 DESC, ordinal ASC LIMIT 1",
    "permutation_importance": _importance_sql(),
    "score_parity": _PARITY_SQL,
    "batch_score_linear": _with(
        O.MACHINE_SPLIT,
        "prior AS (SELECT avg(CAST(machine_failure AS DOUBLE)) AS p FROM machine_split WHERE split = 'train')",
        "vs AS (SELECT split, machine_failure AS label, (SELECT p FROM prior) AS score FROM machine_split WHERE split = 'validation')",
        O.sweep_sql("vs", "split"),
        O.pick_sql("sw"),
    ) + """
SELECT udi, round((SELECT p FROM prior), 6) AS failure_probability,
       CAST((SELECT p FROM prior) >= (SELECT threshold FROM pick) AS INTEGER) AS predicted_failure
FROM machine_split WHERE split = 'test'""",
    "comparison_counts": _with(O.MACHINE_SPLIT)
    + "\nSELECT unnest(['majority_baseline', 'logistic_regression', 'decision_tree', 'random_forest', 'boosted_trees']) AS model, rows, positives "
    "FROM (SELECT count(*) AS rows, CAST(sum(machine_failure) AS BIGINT) AS positives FROM machine_split WHERE split = 'validation')",
    "heldout_counts": _with(O.MACHINE_SPLIT) + "\nSELECT count(*) AS rows, CAST(sum(machine_failure) AS BIGINT) AS positives FROM machine_split WHERE split = 'test'",
    "test_predictions_check": _with(O.MACHINE_SPLIT) + "\nSELECT udi, machine_failure AS actual_failure, true AS consistent FROM machine_split WHERE split = 'test'",
    "batch_score_check": _with(O.MACHINE_SQL) + "\nSELECT udi, true AS consistent FROM machine",
    "bundle_roundtrip_check": _with(O.MACHINE_SPLIT)
    + "\nSELECT count(*) AS rows_matched, 0 AS unmatched_a, 0 AS unmatched_b, CAST(0 AS DOUBLE) AS max_abs_difference FROM machine_split WHERE split = 'test'",
    "model_baseline": _with(
        O.MACHINE_SPLIT,
        "vs AS (SELECT 'majority_baseline' AS model, machine_failure AS label, (SELECT avg(CAST(machine_failure AS DOUBLE)) FROM machine_split WHERE split = 'train') AS score "
        "FROM machine_split WHERE split = 'validation')",
        O.sweep_sql("vs", "model"),
        O.pick_sql("sw"),
        "vt AS (SELECT vs.*, pick.threshold AS picked FROM vs, pick)",
        O.confusion_sql("vt", "model", "picked"),
        O.ranking_sql("vs", "model"),
    ) + f"""
SELECT cm.g AS model, round(pick.threshold, 6) AS threshold, {O.rates_select('cm.')}, rk.roc_auc, rk.average_precision, cm.tn, cm.fp, cm.fn, cm.tp
FROM cm, pick, rk""",
}
