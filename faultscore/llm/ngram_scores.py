"""Operator 4: language-model scoring by stupid backoff.

The model is the corpus itself, and a text is scored by all other documents:
counts leave out the document's own.  With c(g) the count of an n-gram in the
other documents, a word scores c(g) / c(g less its last word) for the longest
n-gram g ending at it with c(g) > 0, times ALPHA for each order backed off
from; a word found nowhere else scores ALPHA ** m / (N + 1), where N is the
other documents' number of words and m the longest order tried.  The text's
score is the sum of the logarithms.

The count tables are partitioned by the n-gram's hash; each chunk's n-grams
are joined to them by exchange of messages (``chunks``), and the scores are
summed per document.  Orders up to two are counted first; a longer n-gram is
looked up only where both n-grams one shorter are found in other documents,
as its count is 0 otherwise.

Words are runs of characters other than \\x20 and \\x09-\\x0D, with A-Z in lower
case.  Defined results: null and wordless texts have 0 words, score 0 and no
mean; repeated rows are other documents to each other; a null doc_id is a
document like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats
from .chunks import Chunk, ask, bucket_count, bucket_of, by_bucket, from_six, mixed, pack, replies_of, to_six, unpack, with_replies

ORDER = 3
ALPHA = 0.4
BYTES_PER_BUCKET = 8 << 20


class GramTable:
    """The n-grams of one order in a chunk."""

    def __init__(self, hashes: np.ndarray, text: np.ndarray) -> None:
        order = np.argsort(hashes, kind="stable")
        key, owner = hashes[order], text[order]
        fresh = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, dtype=bool)
        run = fresh | np.r_[True, owner[1:] != owner[:-1]] if len(key) else fresh
        heads, runs = np.flatnonzero(fresh), np.flatnonzero(run)
        self.keys = key[heads]
        self.counts = np.diff(np.r_[heads, len(key)])
        self.index = np.empty(len(key), dtype=np.int64)
        self.index[order] = np.cumsum(fresh) - 1
        self.own = np.empty(len(key), dtype=np.int64)  # count in the n-gram's own text
        self.own[order] = np.repeat(np.diff(np.r_[runs, len(key)]), np.diff(np.r_[runs, len(key)]))


class ChunkGrams:
    """Words of a chunk, and its n-grams by order; an n-gram stands at its last word."""

    def __init__(self, chunk: Chunk) -> None:
        self.tokens, _, _ = repeats.word_tokens(Chunk(chunk.chunk, chunk.ids, chunk.sizes, chunk.data.lower()))
        self.n = len(self.tokens.values)
        self.text = np.repeat(np.arange(len(chunk.ids)), self.tokens.count)
        self.depth = np.arange(self.n) - np.repeat(self.tokens.first, self.tokens.count)  # words before it in its text
        self.other = {0: np.full(self.n, 0, dtype=np.int64)}

    def places(self, order: int) -> np.ndarray:
        return np.flatnonzero(self.depth >= order - 1)

    def table(self, order: int, places: np.ndarray) -> GramTable:
        if not len(places):
            return GramTable(np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64))
        hashes = repeats.grams(self.tokens.values, order)[places - order + 1]
        return GramTable(mixed(hashes + np.uint64(order)), self.text[places])

    def learn(self, order: int, places: np.ndarray, table: GramTable, totals: np.ndarray) -> None:
        """Set the counts in other documents at each place."""
        self.other[order] = np.zeros(self.n, dtype=np.int64)
        self.other[order][places] = totals[table.index] - table.own

    def worth(self, order: int) -> np.ndarray:
        """Places whose n-gram may be found elsewhere: both shorter ones are."""
        places = self.places(order)
        shorter = self.other[order - 1]
        return places[(shorter[places] > 0) & (shorter[places - 1] > 0)]


EMPTY = np.uint64(0x0123456789ABCDEF)


def _first_round(grams: ChunkGrams):
    return [(order, places, grams.table(order, places)) for order in (1, 2) for places in (grams.places(order),)]


def _send(tables: list[GramTable], buckets: int, words: int | None = None):
    """Per bucket the keys and their counts; the empty n-gram counts the words."""
    keys = np.concatenate([t.keys for t in tables] + ([np.array([EMPTY])] if words is not None else []))
    counts = np.concatenate([t.counts for t in tables] + ([np.array([words])] if words is not None else [])).astype(np.int64)
    squeeze = zstandard.ZstdCompressor(level=1)
    for b, rows in by_bucket(bucket_of(keys, buckets), buckets):
        yield b, len(rows).to_bytes(8, "little") + to_six(keys[rows]) + squeeze.compress(counts[rows].tobytes())


def _totals(tables: list[GramTable], buckets: int, replies: dict, words: bool) -> list[np.ndarray]:
    """What the buckets answered, in the order of the tables' keys (the words last)."""
    keys = np.concatenate([t.keys for t in tables] + ([np.array([EMPTY])] if words else []))
    out = np.zeros(len(keys), dtype=np.int64)
    expand = zstandard.ZstdDecompressor()
    for b, rows in by_bucket(bucket_of(keys, buckets), buckets):
        out[rows] = np.frombuffer(expand.decompress(replies[b]), dtype=np.int64)
    return np.split(out, np.cumsum([len(t.keys) for t in tables]))


def count_grams(told):
    """The count table of one hash partition: each chunk's keys with their totals."""
    expand, squeeze = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
    keys, counts = [], []
    for _, p in told:
        n = int.from_bytes(p[:8], "little")
        keys.append(from_six(p[8 : 8 + 6 * n]))
        counts.append(np.frombuffer(expand.decompress(p[8 + 6 * n :]), dtype=np.int64))
    _, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(int(inverse.max(initial=-1)) + 1, dtype=np.int64)
    np.add.at(total, inverse, np.concatenate(counts))
    at = 0
    for (c, _), k in zip(told, keys):
        yield c, squeeze.compress(total[inverse[at : at + len(k)]].tobytes())
        at += len(k)


def _known(chunk: Chunk, buckets: int, replies: dict) -> ChunkGrams:
    """The chunk with the counts of orders 0 to 2 set."""
    grams = ChunkGrams(chunk)
    tables = _first_round(grams)
    *totals, words = _totals([t for _, _, t in tables], buckets, replies, True)
    for (order, places, table), total in zip(tables, totals):
        grams.learn(order, places, table, total)
    grams.other[0] = words[0] - grams.tokens.count[grams.text]
    return grams


def word_scores(grams: ChunkGrams, orders: int) -> np.ndarray:
    """Natural logarithm of each word's stupid-backoff score."""
    tried = np.minimum(grams.depth + 1, orders)
    out = tried * math.log(ALPHA) - np.log(grams.other[0] + 1.0)
    for order in range(1, orders + 1):
        found = np.flatnonzero(grams.other[order] > 0)
        shorter = grams.other[order - 1]
        context = shorter[found] if order == 1 else shorter[found - 1]
        out[found] = (tried[found] - order) * math.log(ALPHA) + np.log(grams.other[order][found] / context)
    return out


def score(docs: DataFrame, orders: int = ORDER) -> DataFrame:
    """(doc_id, n_words, log_score, mean_log) of every row."""
    if orders < 2:
        raise ValueError("orders must be 2 or more")
    chunks = pack(docs)
    buckets = bucket_count(chunks, BYTES_PER_BUCKET)

    def first(chunk, replies):
        grams = ChunkGrams(chunk)
        return _send([t for _, _, t in _first_round(grams)], buckets, grams.n)

    def further(chunk, replies):
        grams = advance(chunk, replies)
        order = 2 + len(replies)
        return _send([grams.table(order, grams.worth(order))], buckets)

    def advance(chunk, replies) -> ChunkGrams:
        grams = _known(chunk, buckets, replies[0])
        for order, got in enumerate(replies[1:], 3):
            places = grams.worth(order)
            table = grams.table(order, places)
            (total, _) = _totals([table], buckets, got, False)
            grams.learn(order, places, table, total)
        return grams

    def run(batches):
        for batch in batches:
            for chunk, r in unpack(batch):
                grams = advance(chunk, replies_of(batch, r))
                total = np.bincount(grams.text, weights=word_scores(grams, orders), minlength=len(chunk.ids))
                yield pa.RecordBatch.from_pydict({"doc_id": chunk.ids, "n_words": grams.tokens.count, "log_score": total}, schema=_OUT)

    rounds = [ask(chunks, buckets, first, count_grams)]
    for _ in range(3, orders + 1):
        rounds.append(ask(with_replies(chunks, *rounds), buckets, further, count_grams))
    scored = with_replies(chunks, *rounds).mapInArrow(run, "doc_id long, n_words long, log_score double")
    return scored.withColumn("mean_log", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")))


_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("log_score", pa.float64())])


def q_score(spark, sf_dir):
    found = score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_words", F.round("log_score", 4).alias("log_score"), F.round("mean_log", 6).alias("mean_log"))


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, ws FROM w),
g AS (SELECT doc_id, i, ws[i] AS g1, CASE WHEN i > 1 THEN ws[i - 1] || ' ' || ws[i] END AS g2,
             CASE WHEN i > 2 THEN ws[i - 2] || ' ' || ws[i - 1] || ' ' || ws[i] END AS g3 FROM p),
c AS (SELECT doc_id, i,
             count(*) OVER () - count(*) OVER (PARTITION BY doc_id) AS c0,
             count(*) OVER (PARTITION BY g1) - count(*) OVER (PARTITION BY g1, doc_id) AS c1,
             CASE WHEN g2 IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY g2) - count(*) OVER (PARTITION BY g2, doc_id) END AS c2,
             CASE WHEN g3 IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY g3) - count(*) OVER (PARTITION BY g3, doc_id) END AS c3 FROM g),
k AS (SELECT *, lag(c1) OVER o AS k1, lag(c2) OVER o AS k2, least(i, 3) AS m FROM c WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
s AS (SELECT doc_id, CASE WHEN c3 > 0 THEN ln(c3 / k2) WHEN c2 > 0 THEN (m - 2) * ln(0.4) + ln(c2 / k1)
                          WHEN c1 > 0 THEN (m - 1) * ln(0.4) + ln(c1 / c0) ELSE m * ln(0.4) - ln(c0 + 1) END AS l FROM k),
t AS (SELECT doc_id, count(*) AS n_words, sum(l) AS log_score FROM s GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, round(coalesce(log_score, 0.0), 4) AS log_score, round(log_score / n_words, 6) AS mean_log
FROM documents LEFT JOIN t USING (doc_id)
"""
