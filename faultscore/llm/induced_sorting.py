"""Operator 3: suffix-array deduplication by external induced sorting.

Texts are bytes.  Every byte covered by a 50-byte string that also starts in
a document with a smaller doc_id is removed; strings are judged on the input
and never cross documents.

Strings that cannot repeat are set aside by their anchors (``repeats``); the
other stretches meet in the partition of their anchor, the shard (windows of a
hot anchor in that of the whole window, which decides them).  A shard's
suffixes are sorted by induction: the leftmost S-type suffixes are ordered
first, byte block by byte block and only where they are still tied; the order
of all L-type suffixes is induced from them, then that of all S-type suffixes
from the L-type ones.  Suffix tuples (place, common prefix with the suffix
before) travel in a monotone priority queue with a bucket per first byte.
The queue keeps a fixed number of bytes in memory and the rest in an unnamed
file of the task.  Common prefixes are carried along: two induced suffixes
share one byte more than the least common prefix between their sources.
Suffixes that share 50 bytes are neighbours, so one pass finds each string's
least doc_id.

Orders and common prefixes are exact up to 50 bytes, which is all the rule
asks; the ordering of the seeds needs no deeper recursion for the same reason.

Defined results: null and empty texts have no byte, nothing removed and the
hash of the empty string; texts under 50 bytes lose nothing; rows of one
doc_id do not remove from each other; a null doc_id comes after all others;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import repeats
from .chunks import NO_ID, ask, bucket_count, pack, replies_of, unpack, with_replies

WINDOW = 50
ANCHOR = 16
BYTES_PER_BUCKET = 8 << 20
#: Bytes of suffix tuples that a queue holds in memory.
QUEUE_BYTES = 64 << 20
SYMBOLS = 256


class TupleQueue:
    """Suffix tuples by first byte, in the order they came; a monotone
    priority queue when bytes are taken in order.  Beyond ``memory`` bytes the
    tuples lie in a temporary file without a name, gone with the task."""

    def __init__(self, memory: int = QUEUE_BYTES) -> None:
        self.memory, self.held = memory, 0
        self.parts: list[list] = [[] for _ in range(SYMBOLS)]
        self.file = None

    def push(self, symbol: int, place: np.ndarray, lcp: np.ndarray) -> None:
        self.parts[symbol].append((place, lcp))
        self.held += place.nbytes + lcp.nbytes
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for parts in self.parts:
            for i, part in enumerate(parts):
                if not isinstance(part[0], int):
                    parts[i] = (self.file.tell(), len(part[0]))
                    self.file.write(part[0].astype(np.int64).tobytes() + part[1].astype(np.uint8).tobytes())
        self.held = 0

    def _read(self, part) -> tuple[np.ndarray, np.ndarray]:
        if not isinstance(part[0], int):
            self.held -= part[0].nbytes + part[1].nbytes
            return part
        at, n = part
        self.file.seek(at)
        data = self.file.read(9 * n)
        return np.frombuffer(data, dtype=np.int64, count=n), np.frombuffer(data, dtype=np.uint8, offset=8 * n, count=n)

    def take(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        """All tuples of a byte that have come since the last take."""
        parts, self.parts[symbol] = self.parts[symbol], []
        got = [self._read(p) for p in parts]
        if not got:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint8)
        return np.concatenate([p for p, _ in got]), np.concatenate([c for _, c in got])


class Induction:
    """Sorted suffixes of a text of symbols 1..255, 0 being a separator that
    also ends the text, to the given depth."""

    def __init__(self, text: np.ndarray, depth: int, memory: int = QUEUE_BYTES) -> None:
        self.depth = depth
        self.memory = memory
        self.text = text
        self.padded = np.r_[text, np.zeros(depth + 8, dtype=np.uint8)]
        self.is_s = self._types()

    def _types(self) -> np.ndarray:
        text = self.text.astype(np.int16)
        step = np.sign(np.diff(text))  # > 0: S, < 0: L, 0: as the next
        places = np.where(step != 0, np.arange(len(step)), len(step))
        nearest = np.minimum.accumulate(places[::-1])[::-1]
        return np.r_[np.r_[step, np.int16(1)][nearest] > 0, True]

    def common(self, a: int, b: int) -> int:
        differ = np.flatnonzero(self.padded[a : a + self.depth] != self.padded[b : b + self.depth])
        return int(differ[0]) if len(differ) else self.depth

    def seeds(self) -> tuple[np.ndarray, np.ndarray]:
        """Leftmost S-type places in order, and their common prefixes."""
        place = np.flatnonzero(self.is_s & np.r_[False, ~self.is_s[:-1]])
        lcp = np.full(len(place), self.depth, dtype=np.uint8)
        tied, group = np.arange(len(place)), np.zeros(len(place), dtype=np.int64)
        for at in range(0, self.depth, 8):
            block = np.ascontiguousarray(self.padded[place[tied][:, None] + np.arange(at, at + 8)])
            key = block.view(">u8")[:, 0].astype(np.uint64)
            order = np.lexsort((key, group))
            place[tied] = place[tied][order]
            key = key[order]
            same_group = np.r_[False, group[1:] == group[:-1]]  # groups stay where they are
            differ = key ^ np.r_[np.uint64(0), key[:-1]]
            fresh = same_group & (differ != 0)
            shared = np.zeros(len(key), dtype=np.int64)
            for bits in range(8, 64, 8):
                shared += differ < np.uint64(1 << (64 - bits))
            lcp[tied[fresh]] = np.minimum(at + shared[fresh], self.depth)
            if at == 0 and len(tied):
                lcp[tied[0]] = 0
            number = np.cumsum(~same_group | fresh)
            several = np.bincount(number)[number] > 1
            tied, group = tied[several], number[several]
            if not len(tied):
                break
        return place, lcp

    def _spread(self, place, lcp, to_s: bool, queue: TupleQueue, least: np.ndarray, seen: np.ndarray) -> None:
        """Push the predecessors of sorted suffixes that are of the wanted type.

        ``least`` holds, per byte, the least common prefix met since the last
        push to it."""
        before = place - 1
        taken = np.flatnonzero((place > 0) & (self.is_s[before] == to_s))
        floor = np.minimum.accumulate(lcp)
        if not len(taken):
            np.minimum(least, floor[-1], out=least)
            return
        symbol = self.text[before[taken]]
        order = np.argsort(symbol, kind="stable")
        source, symbol = taken[order], symbol[order]
        first = np.r_[True, symbol[1:] != symbol[:-1]]
        # least of lcp over (previous source of the byte, this source]
        over = np.minimum.reduceat(np.r_[lcp, np.uint8(self.depth)], source + 1)
        between = np.r_[np.uint8(0), over[:-1]]
        heads = symbol[first]
        between[first] = np.minimum(least[heads], floor[source[first]])
        shared = np.minimum(between.astype(np.int64) + 1, self.depth).astype(np.uint8)
        shared[np.flatnonzero(first)[~seen[heads]]] = 0
        seen[heads] = True
        np.minimum(least, floor[-1], out=least)
        tail = np.r_[np.minimum.accumulate(lcp[::-1])[::-1][1:], np.uint8(self.depth)]
        last = np.r_[first[1:], True]
        least[heads] = tail[source[last]]
        places = before[source]
        cuts = np.flatnonzero(first).tolist() + [len(source)]
        for s, a, b in zip(heads.tolist(), cuts, cuts[1:]):
            queue.push(s, places[a:b], shared[a:b])

    def _drain(self, symbol: int, to_s: bool, queue: TupleQueue, out: TupleQueue, least, seen) -> int | None:
        """Take the byte's tuples, and those they push to it, in order; the last place."""
        last = None
        while True:
            place, lcp = queue.take(symbol)
            if not len(place):
                return last
            out.push(symbol, place, lcp)
            self._spread(place, lcp, to_s, queue, least, seen)
            last = int(place[-1])

    def run(self):
        """For each byte in order (places, common prefixes with the place before)."""
        n = lambda: (np.full(SYMBOLS, self.depth, dtype=np.uint8), np.zeros(SYMBOLS, dtype=bool))
        seed, seed_lcp = self.seeds()
        cuts = np.searchsorted(self.text[seed], np.arange(SYMBOLS + 1))
        todo, l_out, s_out = (TupleQueue(self.memory) for _ in range(3))
        least, seen = n()
        for c in range(SYMBOLS):
            last = self._drain(c, False, todo, l_out, least, seen)
            mine, lcp = seed[cuts[c] : cuts[c + 1]], seed_lcp[cuts[c] : cuts[c + 1]].copy()
            if len(mine):
                lcp[0] = 0 if last is None else self.common(last, int(mine[0]))
                self._spread(mine, lcp, False, todo, least, seen)
        least, seen = n()
        todo = TupleQueue(self.memory)
        l_kept: list = [None] * SYMBOLS
        for c in reversed(range(SYMBOLS)):
            last = self._drain(c, True, todo, s_out, least, seen)
            place, lcp = l_out.take(c)
            l_kept[c] = len(place)
            if len(place):
                down = np.r_[np.uint8(0), lcp[:0:-1]]
                down[0] = 0 if last is None else self.common(last, int(place[-1]))
                self._spread(place[::-1], down, True, todo, least, seen)
                l_out.push(c, place, lcp)
        for c in range(SYMBOLS):
            place, lcp = l_out.take(c)
            s_place, s_lcp = s_out.take(c)
            if len(s_place):
                # in falling order: the common prefix is that with the next greater suffix
                up = np.r_[s_lcp[1:], np.uint8(0)][::-1].copy()
                s_place = s_place[::-1]
                up[0] = self.common(int(place[-1]), int(s_place[0])) if len(place) else 0
                place, lcp = np.r_[place, s_place], np.r_[lcp, up]
            if len(place):
                yield place, lcp


def least_ids(forks: repeats.Forks) -> np.ndarray:
    """For each window of the different stretches, the least doc_id it starts in."""
    found = np.repeat(forks.value, forks.windows)
    if not len(found):
        return found
    sizes = forks.windows + WINDOW - 1
    begin = np.cumsum(sizes + 1) - sizes  # a separator before each stretch, and one at the end
    text = np.zeros(int((sizes + 1).sum()) + 1, dtype=np.uint8)
    text[repeats.ranges(begin, sizes)] = forks.tokens[repeats.ranges(forks.starts, sizes)] + np.uint8(1)  # UTF-8 has no byte 255
    slot = np.full(len(text), -1, dtype=np.int64)  # window number of a place
    slot[repeats.ranges(begin, forks.windows)] = np.arange(len(found))
    for place, lcp in Induction(text, WINDOW).run():
        mine = slot[place]
        number = np.cumsum(lcp < WINDOW)
        whole = np.flatnonzero(mine >= 0)
        if len(whole):
            number, mine = number[whole], mine[whole]
            head = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
            low = np.minimum.reduceat(found[mine], head)
            found[mine] = np.repeat(low, np.diff(np.r_[head, len(mine)]))
    return found


def _least(of: np.ndarray, number: np.ndarray, n: int) -> np.ndarray:
    out = np.full(n, NO_ID, dtype=np.int64)
    np.minimum.at(out, of, number)
    return out


RULE = repeats.Rule(length=WINDOW, width=1, combine=_least, repeated=lambda least, own: least < own, window_values=least_ids)


def _found(chunk, buckets: int, replies: dict):
    tokens = repeats.byte_tokens(chunk)
    runs = repeats.anchor_runs(tokens, WINDOW, ANCHOR)
    runs, chosen = repeats.candidates(tokens, runs, WINDOW, buckets, replies, across_texts=True)
    found = repeats.stretches(tokens, runs, chosen, WINDOW)
    ids = chunk.order_ids[runs.text[found.chosen]]
    return runs, found, ids, _least(found.of, ids, len(found.rep))


def deduplicate(docs: DataFrame, most_stretches: int = repeats.MOST_STRETCHES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    chunks = pack(docs)
    buckets = bucket_count(chunks, BYTES_PER_BUCKET)

    def anchors(chunk, replies):
        tokens = repeats.byte_tokens(chunk)
        return repeats.tell_anchors(tokens, repeats.anchor_runs(tokens, WINDOW, ANCHOR), WINDOW, buckets)

    def keys(chunk, replies):
        runs, found, _, least = _found(chunk, buckets, replies[0])
        return repeats.send_keys(runs, found, least, buckets)

    def forks(chunk, replies):
        runs, found, _, least = _found(chunk, buckets, replies[0])
        state = repeats.read_states(runs, found, buckets, replies[1])
        return repeats.send_forks(runs, found, least, state, np.frombuffer(chunk.data, dtype=np.uint8), RULE, buckets)

    def remove(batches):
        for batch in batches:
            for chunk, r in unpack(batch):
                shared, states, bits = replies_of(batch, r)
                runs, found, ids, least = _found(chunk, buckets, shared)
                state = repeats.read_states(runs, found, buckets, states)
                width = runs.count[found.chosen]
                # the chunk's own earlier documents remove from its later ones
                goes = repeats.decided_windows(runs, found, state, buckets, bits) | np.repeat(ids > least[found.of], width)
                starts = repeats.ranges(runs.first[found.chosen], width)
                yield pa.RecordBatch.from_pydict(_rows(chunk, repeats.covered(len(chunk.data), starts[goes], WINDOW)), schema=_OUT)

    first = ask(chunks, buckets, anchors, lambda told: repeats.shared_anchors(told, most_stretches))
    second = ask(with_replies(chunks, first), buckets, keys, lambda told: repeats.answer_keys(told, RULE))
    third = ask(with_replies(chunks, first, second), buckets, forks, lambda told: repeats.answer_forks(told, RULE))
    return with_replies(chunks, first, second, third).mapInArrow(remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def _rows(chunk, gone: np.ndarray) -> dict:
    raw = np.frombuffer(chunk.data, dtype=np.uint8)
    out = {"doc_id": chunk.ids, "n_bytes": chunk.sizes, "n_removed": [], "n_spans": [], "kept_sha256": []}
    for at, n in zip(chunk.starts.tolist(), chunk.sizes.tolist()):
        mine = gone[at : at + n]
        removed = int(mine.sum())
        out["n_removed"].append(removed)
        out["n_spans"].append(int((mine & ~np.r_[False, mine[:-1]]).sum()) if removed else 0)
        out["kept_sha256"].append(hashlib.sha256(raw[at : at + n][~mine] if removed else chunk.data[at : at + n]).hexdigest())
    return out


def q_deduplicate(spark, sf_dir):
    return deduplicate(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = """
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, h, length(h) // 2 AS n, unnest(range(0, length(h) // 2)) AS i FROM h),
win AS (SELECT doc_id, i, substr(h, 2 * i + 1, 2) AS b, CASE WHEN i + 50 <= n THEN substr(h, 2 * i + 1, 100) END AS s FROM p),
rep AS (SELECT doc_id, i, b, CASE WHEN s IS NOT NULL AND min(doc_id) OVER (PARTITION BY s) < doc_id THEN 1 ELSE 0 END AS r FROM win),
cov AS (SELECT doc_id, i, b, max(r) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM rep),
edge AS (SELECT *, CASE WHEN gone = 1 AND coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), 0) = 0 THEN 1 ELSE 0 END AS e FROM cov),
g AS (SELECT doc_id, count(*) AS n_bytes, sum(gone)::BIGINT AS n_removed, sum(e)::BIGINT AS n_spans,
             sha256(unhex(coalesce(string_agg(b, '' ORDER BY i) FILTER (gone = 0), ''))) AS kept_sha256 FROM edge GROUP BY doc_id)
SELECT doc_id, coalesce(n_bytes, 0) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM documents LEFT JOIN g USING (doc_id)
"""
