"""Operator 8: mix sources to target weights by Poisson replication.

Every source gets a mean repetition rate ``weight * rows_out / rows_in``.  A
document's copy count is the Poisson quantile, at its source's rate, of a
uniform number hashed from (seed, doc_id); the document is exploded by that
count and all copies are shuffled globally: each copy has a hashed key and
the output is range-partitioned and sorted by it.

Sources, their rates and the steps of each rate's distribution function are
tables joined to the documents, so neither their number nor a rate is bounded.
Only the numbers of sources by size reach the driver (N rows have at most
sqrt(2 N) different sizes).

Defined results: a null source is a source of its own; a source with no
weight has rate 0; weights of the caller's that ask for ``MAX_ASKED_RATE``
copies of a document or more, or for less than none, are taken for a mistake
and raise; a null doc_id hashes as the text ``null``; rows with an
equal doc_id share one draw, and keep their own copies; an empty table gives
an empty table; a null or empty text is a document like any other.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hex_unit, pick, written

SEED = 11
#: Share of a source in the mixture goes with its rows to this power.
TEMPERATURE = 0.5
KEYS = ("doc_id", "source")


def poisson_cdf(rate: float) -> list[float]:
    """P(X <= k) for k = 0, 1, ... until no double below 1 is left above it."""
    out, term, acc, k = [], math.exp(-rate), 0.0, 0
    while True:
        acc += term
        out.append(acc)
        k += 1
        term *= rate / k
        if k > rate and term < 1e-17:
            return out


#: exp(-rate) must stay a normal double for the recurrence from 0.
MOST_FROM_ZERO = 500.0
#: Mean copies of a document that weights given by the caller may not reach.
MAX_ASKED_RATE = 1e6
#: Least and greatest uniform number above 0.
LEAST, MOST = 2.0**-52, 1 - 2.0**-52


def steps_from_mode(rate: float) -> tuple[int, list[float]]:
    """(first, P(X <= k) for k = first, first + 1, ...), worked outwards from
    the mode: steps that every or no uniform number above 0 passes are left out."""
    mode, reach = int(rate), 12 * math.ceil(math.sqrt(rate)) + 12
    up = np.cumprod(rate / np.arange(mode + 1, mode + reach + 1, dtype=np.float64))
    down = np.cumprod(np.arange(mode, max(0, mode - reach), -1, dtype=np.float64) / rate)
    terms = np.concatenate([down[::-1], [1.0], up])
    cdf = np.cumsum(terms) / math.fsum(terms)
    lo, hi = np.searchsorted(cdf, LEAST), np.searchsorted(cdf, min(MOST, cdf[-1]))  # rounding may leave the last a bit below 1
    return mode - len(down) + int(lo), cdf[lo:hi].tolist()


def poisson_steps(rate: float) -> tuple[int, list[float]]:
    return (0, poisson_cdf(rate)) if rate <= MOST_FROM_ZERO else steps_from_mode(rate)


def source_rates(docs: DataFrame, weights: dict | None = None, rows_out: int | None = None) -> DataFrame | None:
    """(__source, __rate) of every source; None if there is no row.

    Without weights a source's goes with its rows ** TEMPERATURE.
    """
    spark = docs.sparkSession
    sizes = written(pick(docs, __source="source").groupBy("__source").agg(F.count("*").alias("n")), "sources")
    numbers = sorted(map(tuple, sizes.groupBy("n").agg(F.count("*")).collect()))
    if not numbers:
        return None
    total = float(sum(n * k for n, k in numbers) if rows_out is None else rows_out)
    if weights is None:
        raw = math.fsum(k * n**TEMPERATURE for n, k in numbers)
        return sizes.select("__source", (F.pow("n", F.lit(TEMPERATURE)) / F.lit(raw) * F.lit(total) / F.col("n")).alias("__rate"))
    given = spark.createDataFrame([(s, float(w)) for s, w in weights.items()], f"s {dict(sizes.dtypes)['__source']}, w double")
    rates = sizes.join(given, sizes["__source"].eqNullSafe(given["s"]), "left").select("__source", (F.coalesce("w", F.lit(0.0)) * F.lit(total) / F.col("n")).alias("__rate"))
    if rates.where(~F.col("__rate").between(0, MAX_ASKED_RATE) | (F.col("__rate") == MAX_ASKED_RATE)).count():
        raise ValueError(f"weights must ask for 0 to {MAX_ASKED_RATE:.0f} copies of a document")
    return rates


def rate_steps(rates: DataFrame) -> DataFrame:
    """(__of, __first, __cdf) of every different rate."""

    def run(batches):
        for pdf in batches:
            steps = [poisson_steps(r) for r in pdf["__of"]]
            yield pd.DataFrame({"__of": pdf["__of"], "__first": [f for f, _ in steps], "__cdf": [c for _, c in steps]})

    different = rates.select(F.col("__rate").alias("__of")).distinct()
    return written(different.mapInPandas(run, "__of double, __first long, __cdf array<double>"), "steps")


def copy_count(doc_id: Column, seed: int = SEED) -> Column:
    """The Poisson quantile of the document's hashed uniform, at its source's rate."""
    u = hex_unit(f"poisson{seed}", F.coalesce(doc_id.cast("string"), F.lit("null")))
    passed = F.aggregate("__cdf", F.lit(0), lambda k, c: k + (u >= c).cast("int"))
    return F.when(u > 0, F.col("__first") + passed).otherwise(0).cast("int")


def mix(docs: DataFrame, weights: dict | None = None, rows_out: int | None = None, seed: int = SEED) -> DataFrame:
    """Replicated and shuffled documents: the input's columns, then
    ``copy_no`` (1, 2, ...) and ``shuffle_key`` (the order of the mixture)."""
    rates = source_rates(docs, weights, rows_out)
    if rates is None:
        return docs.withColumns({"copy_no": F.lit(1), "shuffle_key": F.lit(0.0)}).limit(0)
    rates = written(rates, "rates")
    steps = rate_steps(rates)
    docs = docs.drop("copy_no", "shuffle_key")
    rated = docs.join(rates, docs["source"].eqNullSafe(rates["__source"])).join(steps, F.col("__rate") == F.col("__of"))
    n = copy_count(docs["doc_id"], seed)
    counted = rated.select(*[docs[f"`{c}`"] for c in docs.columns], n.alias("__n"))
    copies = counted.withColumn("copy_no", F.explode(F.when(F.col("__n") > 0, F.sequence(F.lit(1), "__n")).otherwise(F.array().cast("array<int>")))).drop("__n")
    key = hex_unit(f"shuffle{seed}", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("copy_no").cast("string"))
    return copies.withColumn("shuffle_key", key).orderBy("shuffle_key", "doc_id", "copy_no")


def q_mix(spark, sf_dir):
    """Whole documents mixed to square-root weights."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs).select("doc_id", "source", "copy_no", F.round("shuffle_key", 12).alias("shuffle_key"), "text")


#: The same draw in SQL: the quantile counts the steps of the distribution
#: function at or below the uniform number.  64 steps hold every rate here.
ORACLE = """
WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
r AS (SELECT source, sqrt(n) / (SELECT sum(sqrt(n)) FROM n) * (SELECT sum(n) FROM n) / n AS rate FROM n),
terms AS (SELECT source, k, CASE WHEN k = 0 THEN exp(-rate) ELSE exp(-rate + k * ln(rate) - lgamma(k + 1)) END AS p FROM r, range(64) t(k)),
cdf AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms),
steps AS (SELECT source, list(c) AS cs FROM cdf WHERE c < 0.99999999999999 GROUP BY source),
d AS (SELECT doc_id, d.source, text, len(list_filter(cs, lambda c: c <= ('0x' || substr(md5('poisson11:' || doc_id), 1, 13))::BIGINT / 4503599627370496.0)) AS n
      FROM documents d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source),
e AS (SELECT doc_id, source, text, unnest(range(1, n + 1))::INTEGER AS copy_no FROM d)
SELECT doc_id, source, copy_no,
       round(('0x' || substr(md5('shuffle11:' || doc_id || ':' || copy_no), 1, 13))::BIGINT / 4503599627370496.0, 12) AS shuffle_key, text
FROM e
"""
