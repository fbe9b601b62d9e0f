"""From raw documents to a training mixture, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept, and returns a DataFrame that is written as parquet and reread as the
next one's docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultscore.llm import decontamination, language_id, mixing, secrets_scan, simhash
from faultscore.llm.common import ship_package, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents whose language cannot be told (no text, or no
    letter in it) go."""
    ship_package(spark)
    known = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sample = language_id.learn(known.where(~language_id.held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    told = language_id.predict(docs, sample, ("__lang_pred", "__score"))
    return told.where(F.col("__lang_pred") != language_id.UNDETERMINED).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of each group of near copies the document with the least id stays."""
    ship_package(spark)
    classes = simhash.near_duplicates(docs).where("doc_id = component_id")
    ids = written(classes.groupBy(F.col("doc_id").alias("__id")).agg(F.count("*").alias("__rows")), "stays")
    # one plan at every size: without the hint small inputs would not move their texts, large ones would
    stays = docs.join(ids.hint("merge"), docs["doc_id"] == ids["__id"])
    single = stays.where("__rows = 1").select(*docs.columns)
    # rows of one id are one document: the least row stays; a null id is in no class
    rest = [c for c in docs.columns if c != "doc_id"]
    repeated = stays.where("__rows > 1").groupBy("doc_id").agg(F.min(F.struct(*rest)).alias("__row"))
    return single.unionByName(repeated.select("doc_id", "__row.*").select(*docs.columns)).unionByName(docs.where("doc_id IS NULL"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that hold a benchmark item go."""
    found = decontamination.contained(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    held = written(found.select(F.col("doc_id").alias("__id")).distinct(), "held")
    return docs.join(held, docs["doc_id"] == held["__id"], "left_anti")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: secrets are masked; the documents stay."""
    ship_package(spark)
    return secrets_scan.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: sources are mixed to square-root weights and shuffled."""
    ship_package(spark)
    return mixing.mix(docs)


STAGES = [
    ("language_id", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("secret_scan", secrets),
    ("mixture", mixture),
]

#: Suffix automata and fingerprints have no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
