"""Operator 10: benchmark decontamination by size-partitioned MinHash
containment search, in DataFrame functions only.

An item (a short test text) is found in a document when at least 80 % of the
item's distinct five-word shingles occur in the document.  Words are runs of
letters and digits of the lower-cased text.

Items are partitioned by size.  Within a partition every item keeps a
bottom-k MinHash sketch (its k smallest shingle hashes) with k set by the
partition's largest size: ``k = floor(0.2 * n) + 1``.  A document that holds
80 % of an item's shingles misses at most ``floor(0.2 * n)`` of them, so at
least one value of the sketch is among the document's shingles: the search
loses no pair.  Documents are probed with every shingle of the whole text.
Candidate pairs are then verified by exact shingle containment.

An item of one to four words is, where short items are asked for, one shingle
by itself, looked up among the runs of as many words of every document; texts
are cut into runs of such a size only if an item has it.

Defined results: null and empty texts have no shingles, and neither hold an
item nor can be found as one; documents under five words hold short items
only; very long texts are searched whole; repeated rows give the result of
each row's id once per (doc_id, item_id); rows of one item id are one item
with all their shingles; rows with a null id are not searched; ties do not
occur, as every pair counts; other columns, whatever their names, are not
read; empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, written

WORDS = 5
CONTAINMENT = 0.8


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def shingles(text: Column, sizes: tuple[int, ...] = (WORDS,)) -> Column:
    """Distinct 64-bit hashes of the shingles of a text, of each size in words."""
    # Bound once by an outer transform: the regular expression runs once a text.
    return F.transform(F.array(words_of(text)), lambda w: F.array_distinct(F.concat(*[_of_words(w, n) for n in sizes])))[0]


def _of_words(words: Column, n: int) -> Column:
    # sequence() counts down when its end is below its start: guard short texts
    last = F.size(words) - n
    none = F.array().cast("array<bigint>")
    return F.when(last >= 0, F.transform(F.sequence(F.lit(1), last + 1), lambda i: F.xxhash64(F.slice(words, i, n)))).otherwise(none)


def _whole(words: Column) -> Column:
    """A short item's only shingle: all its words."""
    short = F.size(words).between(1, WORDS - 1)
    return F.when(short, F.array(F.xxhash64(words))).otherwise(F.array_distinct(_of_words(words, WORDS)))


def short_sizes(items: DataFrame) -> tuple[int, ...]:
    """The sizes in words of the items under five: four numbers at most."""
    sizes = items.where(F.col("item_id").isNotNull()).select(F.size(words_of(F.col("text"))).alias("n"))
    return tuple(sorted(r["n"] for r in sizes.where(F.col("n").between(1, WORDS - 1)).distinct().collect()))


def item_shingles(items: DataFrame, short_items: bool = False) -> DataFrame:
    """(item_id, n, h): one row per distinct shingle of an item id."""
    of_item = F.transform(F.array(words_of(F.col("text"))), _whole)[0] if short_items else shingles(F.col("text"))
    exploded = pick(items, item_id="item_id", text="text").where(F.col("item_id").isNotNull()).select("item_id", F.explode(of_item).alias("h")).distinct()
    sizes = exploded.groupBy("item_id").agg(F.count("*").alias("n"))
    return exploded.join(sizes, "item_id").select("item_id", "n", "h")


def size_class(n: Column) -> Column:
    """Partition of an item: sizes from 2**c up to 2**(c+1) - 1."""
    return F.floor(F.log2(n.cast("double"))).cast("int")


def sketches(shingled: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """(item_id, h): the bottom-k sketch of every item, k by size partition."""
    classed = shingled.withColumn("size_class", size_class(F.col("n")))
    # one row per power of two: 63 at most, whatever the items
    largest = classed.groupBy("size_class").agg(F.max("n").alias("largest"))
    k = F.floor((1 - F.lit(containment)) * F.col("largest") + 1e-9) + 1
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy("h"))
    return classed.join(F.broadcast(largest), "size_class").withColumn("r", rank).where(F.col("r") <= k).select("item_id", "h")


def contained(docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT, short_items: bool = False) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared, containment) of every pair of
    ids with ``n_shared >= containment * n_shingles``.

    ``short_items`` finds items of one to four words as well.  It is off by
    default: a word or two in a text is no reason to drop it from a corpus.
    """
    texts = pick(docs, doc_id="doc_id", text="text").where(F.col("doc_id").isNotNull())
    sizes = ((*short_sizes(items), WORDS) if short_items else (WORDS,))
    shingled = written(item_shingles(items, short_items), "items")
    of_text = F.explode(shingles(F.col("text"), sizes)).alias("h")
    probe = texts.select("doc_id", of_text)
    # The planner broadcasts either item table only below the session's size threshold.
    found = probe.join(written(sketches(shingled, containment), "sketches"), "h")
    candidates = written(found.groupBy("doc_id").agg(F.collect_set("item_id").alias("items")), "candidates")
    verify = texts.join(candidates, "doc_id").select("doc_id", "items", of_text)
    shared = (
        verify.join(shingled, "h").where(F.array_contains("items", F.col("item_id")))
        .select("doc_id", "item_id", "n", "h").distinct()
        .groupBy("doc_id", "item_id", "n").agg(F.count("*").alias("n_shared"))
    )
    share = F.col("n_shared") / F.col("n")
    return shared.where(share >= containment - 1e-12).select("doc_id", "item_id", F.col("n").alias("n_shingles"), "n_shared", F.round(share, 6).alias("containment"))


def q_contained(spark, sf_dir):
    """Every benchmark item inside every document, items of any length."""
    return contained(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), short_items=True)


ORACLE = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents WHERE doc_id IS NOT NULL),
iw AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
sizes AS (SELECT 5 AS k UNION SELECT len(w) FROM iw WHERE len(w) BETWEEN 1 AND 4),
ds AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - k + 2), lambda i: list_slice(w, i, i + k - 1))) AS s FROM dw, sizes),
its AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - least(len(w), 5) + 2), lambda i: list_slice(w, i, i + least(len(w), 5) - 1))) AS s FROM iw WHERE len(w) > 0),
n AS (SELECT item_id, count(*) AS n FROM its GROUP BY item_id),
j AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN its USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n AS n_shingles, n_shared, round(n_shared / n, 6) AS containment
FROM j JOIN n USING (item_id) WHERE n_shared / n >= 0.8 - 1e-12
"""
