"""Operator 6: embedding near-duplicates by a pivot-permutation index.

Pivots are reference vectors out of the table, no two of a length within the
linking angle of each other: a hot group of near copies then holds one pivot,
or few, which its members share, and not many whose order is noise.  Nearness
to pivots is measured from the mean of a bounded sample of vectors.  Vectors
that all lean to one side would otherwise have the same few pivots nearest, so
that most would meet in most lists; measured so, what they have in common
drops out.  Every vector is described by its ``PREFIX`` nearest pivots; an
inverted list per (label, pivot) holds the vectors that have the pivot in their
description.  Two vectors of a list that share at least ``MIN_SHARED`` pivots
are a candidate pair, and its cosine (of the vectors as given) is worked out in
double precision.  A pair lies in the lists of all the pivots it shares and
counts in the first one only.  A length with no more pivots than ``PREFIX`` has
all of them in every description, so its pairs are all compared, block by block.

The number of pivots grows with the square root of the table, so a list grows
as slowly; only the pivots (bounded by ``MAX_PIVOTS``) go to every task.
Equal vectors of a label are one entry with a count.  A list of over ``BLOCK``
entries is cut in blocks, each pair of blocks a group of its own.  Groups
report counts and one link per entry, never all pairs.

Defined results: vectors that are null, zero, or hold null or non-finite
components, and those without a label, link with nothing and are classes of
their own; vectors of different lengths never link; a null vec_id has no class
and is no link's end; rows of one vec_id are vectors of their own; an empty
table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, shuffle_partitions, written
from .components import components
from .simhash import _union

COSINE = 0.93
PIVOTS = 64
#: Rows that PIVOTS pivots stand for; four times the rows take twice the pivots.
ROWS_FOR_PIVOTS = 65_536
MAX_PIVOTS = 16_384
PREFIX = 8
#: Unrelated vectors share a pivot in PREFIX squared of as many pairs as there are
#: pivots; to ask for more shared ones would drop links that lean to one side.
MIN_SHARED = 1
BLOCK = 4096
ROWS_PER_PARTITION = 20_000
#: Rows whose nearness to all pivots a task holds at once.
DESCRIBED_ROWS = 256
#: Pairs whose descriptions are compared at once.
PAIRS = 1 << 17


def pivot_count(n: int) -> int:
    return min(MAX_PIVOTS, PIVOTS * max(1, math.ceil(math.sqrt(n / ROWS_FOR_PIVOTS))))


def unit_rows(vectors: pd.Series) -> np.ndarray:
    a = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    return a / np.sqrt((a * a).sum(axis=1, keepdims=True))


def far_apart(vectors: np.ndarray, cosine: float) -> np.ndarray:
    """Row numbers of the unit vectors less those with ``cosine`` or more to an earlier one kept."""
    kept, free = [], np.ones(len(vectors), dtype=bool)
    for i in range(len(vectors)):
        if free[i]:
            kept.append(i)
            free &= vectors @ vectors[i] < cosine
    return np.array(kept, dtype=np.int64)


def seen_from(units: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Unit vectors from ``mean`` towards the rows (zero for a row that is the mean)."""
    a = units - mean
    norm = np.sqrt((a * a).sum(axis=1, keepdims=True))
    return np.divide(a, norm, out=np.zeros_like(a), where=norm > 0)


def reference(sample: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(pivots as seen from the mean, the mean) of a sample of unit vectors."""
    mean = sample.mean(axis=0)
    return seen_from(sample[far_apart(sample, cosine)], mean), mean


def nearest(units: np.ndarray, pivots: np.ndarray, mean: np.ndarray, prefix: int) -> np.ndarray:
    """Numbers of each row's nearest pivots, ascending, some rows at a time."""
    out = np.empty((len(units), min(prefix, len(pivots))), dtype=np.int64)
    for lo in range(0, len(units), DESCRIBED_ROWS):
        far = -(seen_from(units[lo : lo + DESCRIBED_ROWS], mean) @ pivots.T)
        if prefix < len(pivots):
            out[lo : lo + len(far)] = np.argpartition(far, prefix - 1, axis=1)[:, :prefix]
        else:
            out[lo : lo + len(far)] = np.arange(len(pivots))
    return np.sort(out, axis=1)


def describe(entries: DataFrame, pivots: dict[int, tuple[np.ndarray, np.ndarray]], prefix: int) -> DataFrame:
    """Entries plus ``near``: numbers of the nearest pivots, ascending.

    Vectors of a length that no pivot has are described by pivot -1.
    """
    shared = entries.sparkSession.sparkContext.broadcast(pivots)  # MAX_PIVOTS vectors at most

    def run(batches):
        for pdf in batches:
            near = [[-1]] * len(pdf)
            sizes = pdf["embedding"].map(len).to_numpy()
            for dim in np.unique(sizes):
                if int(dim) in shared.value:
                    rows = np.flatnonzero(sizes == dim)
                    top = nearest(unit_rows(pdf["embedding"].iloc[rows]), *shared.value[int(dim)], prefix)
                    for r, t in zip(rows, top):
                        near[r] = t.tolist()
            yield pdf.assign(near=near)

    fields = ", ".join(f"{n} {t}" for n, t in entries.dtypes)
    return entries.mapInPandas(run, f"{fields}, near array<int>")


def bitsets(near: list, words: int) -> np.ndarray:
    out = np.zeros((len(near), words), dtype=np.uint64)
    for i, pivots in enumerate(near):
        for p in map(int, pivots):
            if p >= 0:
                out[i, p // 64] |= np.uint64(1 << (p % 64))
    return out


def shared_pivots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shared-pivot count and the first shared pivot of each pair of rows (-1: none)."""
    both = a & b
    count = np.bitwise_count(both).sum(axis=1, dtype=np.int64)
    word = np.argmax(both != 0, axis=1)
    value = both[np.arange(len(both)), word]
    low = value & (np.uint64(0) - value)
    return count, np.where(value != 0, 64 * word + np.bitwise_count(low - np.uint64(1)).astype(np.int64), -1)


def group_links(pivot: int, own: np.ndarray, near: list, vectors: np.ndarray, copies: np.ndarray, cosine: float, min_shared: int, words: int):
    """(copies linked to each entry, label of its class) within one group.

    Entries of two blocks meet across, those of one block among themselves.
    """
    n = len(vectors)
    linked, parent, sets = np.zeros(n, dtype=np.int64), np.arange(n), bitsets(near, words)
    norm = np.sqrt((vectors * vectors).sum(axis=1))
    across = own.min() != own.max()
    for lo in range(0, n, 512):
        hi = min(lo + 512, n)
        ok = (vectors[lo:hi] @ vectors[lo:].T) / (norm[lo:hi, None] * norm[None, lo:]) >= cosine
        ok &= np.arange(lo, hi)[:, None] < np.arange(lo, n)[None, :]
        if across:
            ok &= own[lo:hi, None] != own[None, lo:]
        i, j = np.nonzero(ok)
        if not len(i):
            continue
        if pivot >= 0:
            least = min(min_shared, max(map(len, near)))  # a length may have fewer pivots
            found = np.zeros(len(i), dtype=bool)
            for at in range(0, len(i), PAIRS):
                here = slice(at, at + PAIRS)
                count, first = shared_pivots(sets[lo:hi][i[here]], sets[lo:][j[here]])
                found[here] = (count >= least) & (first == pivot)
            i, j = i[found], j[found]
        i, j = i + lo, j + lo
        linked += np.bincount(i, weights=copies[j], minlength=n).astype(np.int64) + np.bincount(j, weights=copies[i], minlength=n).astype(np.int64)
        _union(parent, i, j)
    return linked, parent


def link_counts(entries: DataFrame, n: int, cosine: float, prefix: int, min_shared: int, block: int = BLOCK) -> DataFrame:
    """(root, id, links): links of an entry found in one group, and its class there."""
    spark = entries.sparkSession
    sample = entries.select("id", "embedding").orderBy(F.xxhash64("id"), "id").limit(pivot_count(n)).collect()
    pivots: dict[int, list] = {}
    for r in sample:
        pivots.setdefault(len(r["embedding"]), []).append(r["embedding"])
    tables = {dim: reference(unit_rows(pd.Series(rows)), cosine) for dim, rows in pivots.items()}
    words = max([1, *(-(-len(t) // 64) for t, _ in tables.values())])
    described = written(describe(entries, tables, prefix), "described")
    listed = described.withColumn("dim", F.size("embedding")).withColumn("pivot", F.explode("near"))
    counts = listed.groupBy("label", "dim", "pivot").agg(F.count("*").alias("m"))
    large = counts.where(F.col("m") > block).select("label", "dim", "pivot", F.ceil(F.col("m") / block).cast("int").alias("nb"))
    split = listed.join(large, ["label", "dim", "pivot"], "left").withColumn("nb", F.coalesce("nb", F.lit(1)))
    dealt = split.withColumn("own", F.pmod(F.xxhash64("id"), F.col("nb")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    group = F.xxhash64("label", "dim", "pivot", F.least("own", "other"), F.greatest("own", "other"))
    dealt = dealt.select("id", "copies", "embedding", "near", "pivot", "own", group.alias("g"))
    # a list of several blocks deals each of its rows once a block
    rows_dealt = counts.agg(F.sum(F.col("m") * F.ceil(F.col("m") / block))).first()[0] or 0
    parts = max(shuffle_partitions(spark), -(-int(rows_dealt) // ROWS_PER_PARTITION))

    def run(batches):
        got = [b for b in batches if len(b)]
        if not got:
            return
        pdf = pd.concat(got).sort_values(["g", "id"], kind="stable")
        for _, grp in pdf.groupby("g", sort=False):
            if len(grp) < 2:
                continue
            vectors = np.stack([np.asarray(v, dtype=np.float64) for v in grp["embedding"]])
            ids = grp["id"].to_numpy()
            linked, root = group_links(int(grp["pivot"].iloc[0]), grp["own"].to_numpy(), list(grp["near"]), vectors, grp["copies"].to_numpy(), cosine, min_shared, words)
            hit = np.flatnonzero(linked)
            if len(hit):
                yield pd.DataFrame({"root": ids[root[hit]], "id": ids[hit], "links": linked[hit]})

    kind = dict(entries.dtypes)["id"]
    return dealt.repartition(parts, "g").mapInPandas(run, f"root {kind}, id {kind}, links long")


def usable(rows: DataFrame):
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    nonzero = F.exists("embedding", lambda x: x != 0)
    return F.coalesce(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & finite & nonzero, F.lit(False))


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, prefix: int = PREFIX, min_shared: int = MIN_SHARED, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    rows = pick(vectors, vec_id="vec_id", embedding="embedding", label="label").withColumn("embedding", F.col("embedding").cast("array<double>"))
    good = rows.where(usable(rows))
    entries = written(good.groupBy("label", "embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")), "entries")
    found = written(link_counts(entries, entries.count(), cosine, prefix, min_shared, block), "vector-links")
    totals = found.groupBy("id").agg(F.sum("links").alias("links"))
    classes = components(found.select("root", "id"))
    done = entries.join(totals, "id", "left").join(classes, "id", "left").select(
        "label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id")
    )
    linked = good.join(done, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~usable(rows)).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def q_near_duplicates(spark, sf_dir):
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


#: Every pair of a label, and least ids handed on along links; vec_id is taken as unique.
ORACLE = f"""
WITH RECURSIVE typed AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
usable AS (
  SELECT * FROM typed
  WHERE label IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM usable a JOIN usable b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= {COSINE}),
reach(id, least) AS (
  SELECT vec_id, vec_id FROM usable
  UNION
  SELECT l.b, r.least FROM reach r JOIN links l ON l.a = r.id WHERE r.least < l.b),
classes AS (SELECT id, min(least) AS least FROM reach GROUP BY id),
totals AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT t.vec_id, coalesce(n, 0) AS n_links, coalesce(c.least, t.vec_id) AS component_id, coalesce(c.least, t.vec_id) = t.vec_id AS kept
FROM typed t LEFT JOIN classes c ON c.id = t.vec_id LEFT JOIN totals k ON k.a = t.vec_id"""
