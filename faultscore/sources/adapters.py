"""Adapters that derive labelled tables from the given parquet tables.

Each adapter is a pure projection (plus one equi-join for documents), so
Catalyst prunes the scan to the source columns it needs and the work grows
with the source table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table


def _flag(condition: Column) -> Column:
    return condition.cast("int")


def machine_table(events: DataFrame) -> DataFrame:
    """events -> machine readings with failure-mode flags and target.

    udi = event_id; type from user_id % 10 (<5 L, <8 M, else H);
    torque = value; tool_wear = props.k; air/process/speed = hour/minute/
    second of ts.  The five flags construct the target, so they are leak
    columns exactly as in the original data set.
    """
    bucket = F.col("user_id") % 10
    kind = F.when(bucket < 5, "L").when(bucket < 8, "M").otherwise("H")
    base = events.select(
        F.col("event_id").alias("udi"),
        F.concat(kind, F.col("user_id").cast("string")).alias("product_id"),
        kind.alias("type"),
        F.hour("ts").cast("double").alias("air_temperature"),
        F.minute("ts").cast("double").alias("process_temperature"),
        F.second("ts").cast("double").alias("rotational_speed"),
        F.col("value").alias("torque"),
        F.get_json_object("props", "$.k").cast("int").cast("double").alias("tool_wear"),
    )
    torque, wear = F.col("torque"), F.col("tool_wear")
    flagged = base.select(
        "*",
        _flag((wear >= 70) & (torque >= 90)).alias("twf"),
        _flag((F.col("air_temperature") >= 20) & (torque >= 150)).alias("hdf"),
        _flag((F.col("rotational_speed") < 5) & (torque >= 120)).alias("pwf"),
        _flag((F.col("type") == "L") & (torque >= 200)).alias("osf"),
        _flag(
            F.substring(F.md5(F.concat(F.lit("rnf:"), F.col("udi").cast("string"))), 1, 2) == "00"
        ).alias("rnf"),
    )
    return flagged.withColumn(
        "machine_failure", F.greatest("twf", "hdf", "pwf", "osf", "rnf")
    ).select(
        "udi", "product_id", "type", "air_temperature", "process_temperature",
        "rotational_speed", "torque", "tool_wear", "machine_failure",
        "twf", "hdf", "pwf", "osf", "rnf",
    )


def document_table(labels: DataFrame, documents: DataFrame) -> DataFrame:
    """labels joined to documents on doc_id (text is not a feature)."""
    docs = documents.select("doc_id", "lang", "source", F.col("n_chars").cast("double").alias("n_chars"))
    return labels.join(docs, "doc_id", "inner").select(
        "doc_id", "lang", "source", "n_chars", "toxic", "quality"
    )


def order_table(orders: DataFrame) -> DataFrame:
    """orders with status as category; urgent priority as target."""
    return orders.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        F.col("o_orderpriority").startswith("1").cast("int").alias("urgent"),
        "o_orderpriority",
    )


def load_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Machine table from events."""
    return machine_table(read_table(spark, sf_dir, "events"))


def load_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_table(read_table(spark, sf_dir, "labels"), read_table(spark, sf_dir, "documents"))


def load_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_table(read_table(spark, sf_dir, "orders"))


# The same derivations in SQL, used by the DuckDB oracle queries.
MACHINE_SQL = """
machine_base AS (
  SELECT event_id AS udi,
         CASE WHEN user_id % 10 < 5 THEN 'L' WHEN user_id % 10 < 8 THEN 'M' ELSE 'H' END AS type,
         user_id,
         CAST(hour(ts) AS DOUBLE) AS air_temperature,
         CAST(minute(ts) AS DOUBLE) AS process_temperature,
         CAST(second(ts) AS DOUBLE) AS rotational_speed,
         value AS torque,
         CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE) AS tool_wear
  FROM events
),
machine_flags AS (
  SELECT udi, type || CAST(user_id AS VARCHAR) AS product_id, type, air_temperature,
         process_temperature, rotational_speed, torque, tool_wear,
         CAST(tool_wear >= 70 AND torque >= 90 AS INTEGER) AS twf,
         CAST(air_temperature >= 20 AND torque >= 150 AS INTEGER) AS hdf,
         CAST(rotational_speed < 5 AND torque >= 120 AS INTEGER) AS pwf,
         CAST(type = 'L' AND torque >= 200 AS INTEGER) AS osf,
         CAST(substr(md5('rnf:' || CAST(udi AS VARCHAR)), 1, 2) = '00' AS INTEGER) AS rnf
  FROM machine_base
),
machine AS (
  SELECT udi, product_id, type, air_temperature, process_temperature, rotational_speed,
         torque, tool_wear, greatest(twf, hdf, pwf, osf, rnf) AS machine_failure,
         twf, hdf, pwf, osf, rnf
  FROM machine_flags
)"""
