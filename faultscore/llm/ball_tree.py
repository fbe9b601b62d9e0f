"""Operator 12: exact inner-product top-k by ball trees.

Candidates are dealt by hash into shards; the rows of a shard grow with the
square root of the table until ``SHARD_BYTES``, so a shard always fits in its
task.  A shard's task builds a ball tree (median cuts along the widest
component) and lets the queries stream past it, a block at a time: the node
with the highest upper bound ``q.centre + |q| radius`` comes first, a query
leaves a node whose bound is below the query's current kth score, and leaves are
multiplied out exactly.

The current kth score is shared between shards: each query first visits the one
shard that its own row was dealt to, and the kth score found there is the bound
it starts with in all the others, which then only report what reaches it.
Candidates go through the shuffle once a round however many queries there are;
queries (the small side) are copied to the shards.

Equal rows are one entry with a count, so a hot row is worked on once.

Defined results: vectors that are null or hold null or non-finite components,
and rows without vec_id, take no part; every row is a query or candidate of its
own, also rows of one vec_id, so equal query rows return equal results once a
row and the other copies of a query's row are among its candidates; vectors of
different lengths are not compared; empty vectors score 0 with each other; ties
go to the smaller vec_id; scores and components beyond 64 bits stand at the
nearest 64-bit number; fewer than k candidates are all returned; extra columns
are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, written

K = 5
SCALE = 256
QUERY_EVERY = 50
#: A shard has SHARD_ROWS times the square root of the entries, MIN_SHARD_ROWS
#: at least, and SHARD_BYTES of components at most.
SHARD_ROWS = 16
MIN_SHARD_ROWS = 2048
SHARD_BYTES = 64 << 20
LEAF = 64
QUERY_BLOCK = 512
LONGEST = (1 << 63) - 1


class BallTree:
    """Nodes over rows ``order[lo:hi]`` of integer vectors, children after parents."""

    def __init__(self, vectors: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(vectors))
        self.lo, self.hi, self.left = [0], [len(vectors)], [-1]
        at = 0
        while at < len(self.lo):
            lo, hi = self.lo[at], self.hi[at]
            if hi - lo > leaf:
                rows = self.order[lo:hi]
                part = vectors[rows]
                widest = int(np.argmax(part.max(axis=0) - part.min(axis=0))) if part.shape[1] else 0
                if part.shape[1]:
                    self.order[lo:hi] = rows[np.argpartition(part[:, widest], (hi - lo) // 2)]
                self.left[at] = len(self.lo)
                middle = lo + (hi - lo) // 2
                self.lo += [lo, middle]
                self.hi += [middle, hi]
                self.left += [-1, -1]
            at += 1
        self.centre = np.stack([vectors[self.order[a:b]].mean(axis=0) for a, b in zip(self.lo, self.hi)])
        self.radius = np.array([np.sqrt(((vectors[self.order[a:b]] - c) ** 2).sum(axis=1).max()) for a, b, c in zip(self.lo, self.hi, self.centre)])
        self.length = np.sqrt((self.centre**2).sum(axis=1))

    def bound(self, node: int, queries: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """No row of the node has a larger product; the last term covers rounding."""
        reach = lengths * self.radius[node]
        return queries @ self.centre[node] + reach + 1e-9 * (lengths * self.length[node] + reach) + 1.0


def exact_products(queries: np.ndarray, vectors: np.ndarray, safe: bool) -> np.ndarray:
    """Products as doubles where those hold every one exactly, else as integers."""
    if safe:
        return queries @ vectors.T
    big = queries.astype(object) @ vectors.astype(object).T
    return np.clip(big, -LONGEST - 1, LONGEST) if big.size else big


def lowered(score: np.ndarray) -> np.ndarray:
    """Doubles no larger than the integers they were rounded from."""
    return np.where(np.isfinite(score) & (np.abs(score) >= 2.0**53), score - np.abs(score) * 1e-12, score)


class Shard:
    def __init__(self, entry: np.ndarray, ids: np.ndarray, copies: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        self.entry, self.ids, self.copies, self.whole = entry, ids, copies, vectors
        self.float = vectors.astype(np.float64)
        self.tree = BallTree(self.float, leaf)
        self.largest = float(np.abs(self.float).max(initial=0.0))

    def search(self, entry: np.ndarray, queries: np.ndarray, kth: np.ndarray, k: int):
        """(query, row, score) of up to k rows a query that reach its ``kth``
        and are not the query's own only copy; best first, ties by id."""
        q = queries.astype(np.float64)
        lengths = np.sqrt((q * q).sum(axis=1))
        safe = self.largest * float(np.abs(q).max(initial=0.0)) * max(1, q.shape[1]) < 2**53
        best = np.full((len(q), k), -np.inf, dtype=np.float64 if safe else object)
        rows = np.full((len(q), k), -1, dtype=np.int64)
        bar = kth.copy()
        tree, ids = self.tree, np.r_[self.ids, np.iinfo(np.int64).max]  # row -1 comes last
        everyone = np.arange(len(q))
        heap, pushed = [], 0

        def push(node, active):
            nonlocal pushed
            bound = tree.bound(node, q[active], lengths[active])
            stay = bound >= bar[active]
            if stay.any():
                heapq.heappush(heap, (-float(bound[stay].max()), pushed, node, active[stay], bound[stay]))
                pushed += 1

        push(0, everyone)
        while heap:
            _, _, node, active, bound = heapq.heappop(heap)
            active = active[bound >= bar[active]]
            if not len(active):
                continue
            if tree.left[node] >= 0:
                push(tree.left[node], active)
                push(tree.left[node] + 1, active)
                continue
            here = tree.order[tree.lo[node] : tree.hi[node]]
            score = exact_products(q[active], self.float[here], True) if safe else exact_products(queries[active], self.whole[here], False)
            own = (self.entry[here][None, :] == entry[active][:, None]) & (self.copies[here] == 1)[None, :]
            score[own] = -np.inf
            reach = (score >= bar[active][:, None]) & (score > -np.inf)
            hit = reach.any(axis=1)
            if not hit.any():
                continue
            at = active[hit]
            scores = np.concatenate([best[at], np.where(reach[hit], score[hit], -np.inf)], axis=1)
            found = np.concatenate([rows[at], np.where(reach[hit], here[None, :], -1)], axis=1)
            top = np.lexsort((ids[found], -scores), axis=1)[:, :k] if safe else np.array([sorted(range(scores.shape[1]), key=lambda j, r=r: (-scores[r, j], ids[found[r, j]]))[:k] for r in range(len(at))])
            best[at], rows[at] = np.take_along_axis(scores, top, axis=1), np.take_along_axis(found, top, axis=1)
            bar[at] = np.maximum(bar[at], lowered(best[at][:, -1].astype(np.float64)))
        query, place = np.nonzero(rows >= 0)
        return query, rows[query, place], best[query, place]


def integer_entries(vectors: DataFrame, scale: int) -> DataFrame:
    """Usable rows as (vec_id, v, copies), numbered once and for all."""
    rows = pick(vectors, vec_id="vec_id", embedding="embedding").withColumn("embedding", F.col("embedding").cast("array<double>"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    edge = float(1 << 63)

    def whole(x: Column) -> Column:
        y = x * F.lit(float(scale))
        return F.when(y >= edge, F.lit(LONGEST)).when(y <= -edge, F.lit(-LONGEST - 1)).otherwise(F.floor(y))

    usable = F.coalesce(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite, F.lit(False))
    counted = rows.where(usable).select("vec_id", F.transform("embedding", whole).alias("v")).groupBy("vec_id", "v").agg(F.count("*").alias("copies"))
    return written(counted.select(F.monotonically_increasing_id().alias("entry"), F.col("vec_id").cast("long").alias("vec_id"), "v", "copies"), "entries")


FOUND = "query long, query_id long, query_copies long, vec_id long, score long, copies long"


def matrix(values: pa.Array, dim: int) -> np.ndarray:
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), dim)


def visit(candidates: DataFrame, queries: DataFrame, shards: int, k: int, leaf: int) -> DataFrame:
    """Every (dim, shard) group's queries searched in the group's candidates.

    Both have dim, shard, entry, vec_id, v, copies, and queries their kth score.
    """
    columns = ["dim", "shard", "query", "entry", "vec_id", "v", "copies", "kth"]
    rows = candidates.withColumns({"query": F.lit(False), "kth": F.lit(None).cast("double")}).select(*columns)
    rows = rows.unionByName(queries.withColumn("query", F.lit(True)).select(*columns))
    # a shard has its own task; candidates come first there, queries stream behind them
    dealt = rows.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("dim", "shard", "query")

    def run(batches):
        key, held, shard = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            dims, numbers, kinds = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            cuts = np.flatnonzero((dims[1:] != dims[:-1]) | (numbers[1:] != numbers[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
                dim, part = int(dims[lo]), batch.slice(lo, hi - lo)
                if (dim, numbers[lo]) != key:
                    key, held, shard = (dim, numbers[lo]), [], None
                if not kinds[lo]:
                    held.append(part)
                    continue
                if shard is None and held:
                    whole = pa.Table.from_batches(held).combine_chunks()
                    entry, ids, copies = (whole.column(c).to_numpy() for c in ("entry", "vec_id", "copies"))
                    shard, held = Shard(entry, ids, copies, matrix(whole.column("v").combine_chunks(), dim), leaf), []
                if shard is None:
                    continue
                entry, ids, copies = (part.column(c).to_numpy() for c in ("entry", "vec_id", "copies"))
                wanted = matrix(part.column("v"), dim)
                kth = part.column("kth").fill_null(-math.inf).to_numpy(zero_copy_only=False).copy()
                for at in range(0, len(entry), QUERY_BLOCK):
                    here = slice(at, at + QUERY_BLOCK)
                    query, row, score = shard.search(entry[here], wanted[here], kth[here], k)
                    own = shard.entry[row] == entry[here][query]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, type=pa.int64()) for x in (entry[here][query], ids[here][query], copies[here][query], shard.ids[row], [int(s) for s in score], shard.copies[row] - own)],
                        names=[f.split()[0] for f in FOUND.split(", ")],
                    )

    return dealt.mapInArrow(run, FOUND)


def top_k(vectors: DataFrame, is_query: Column | None = None, k: int = K, scale: int = SCALE, shard_rows: int | None = None, leaf: int = LEAF) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query row's k best others.

    ``is_query`` is a condition on vec_id; ``shard_rows`` overrides the rule.
    """
    entries = integer_entries(vectors, scale).withColumn("dim", F.size("v"))
    n, width = entries.agg(F.count("*"), F.coalesce(F.avg("dim"), F.lit(0.0))).first()
    per = shard_rows or max(1, min(max(MIN_SHARD_ROWS, math.ceil(SHARD_ROWS * math.sqrt(n))), int(SHARD_BYTES / (8 * max(1.0, width)))))
    shards = max(1, -(-n // per))
    dealt = entries.withColumn("shard", F.pmod(F.xxhash64("entry"), F.lit(shards)))
    asked = dealt.where(is_query if is_query is not None else F.col("vec_id") % QUERY_EVERY == 0)
    home = written(visit(dealt, asked.withColumn("kth", F.lit(None).cast("double")), shards, k, leaf), "home")
    # k found entries stand for k rows at least; doubles round, so a bound beyond them is lowered
    kth = home.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= k)
    least = F.col("least").cast("double")
    kth = kth.select(F.col("query").alias("entry"), (least - F.when(F.abs(least) >= float(1 << 53), F.abs(least) * 1e-12).otherwise(0.0)).alias("kth"))
    away = asked.join(kth, "entry", "left").withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    away = away.where("other != shard").withColumn("shard", F.col("other").cast("long"))
    found = home.unionByName(visit(dealt, away, shards, k, leaf)) if shards > 1 else home
    each = found.where("copies > 0").withColumn("_", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)).cast("int"))))
    ranked = each.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= k)
    rows = ranked.withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), F.col("query_copies"))))
    return rows.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def q_top_k(spark, sf_dir):
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = f"""
WITH usable AS (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.r AS qr, q.vec_id AS query_id, c.vec_id,
         coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0)::BIGINT AS score
  FROM usable q JOIN usable c ON q.r != c.r AND len(q.v) = len(c.v)
  WHERE q.vec_id % {QUERY_EVERY} = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= {K}
"""
