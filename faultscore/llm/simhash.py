"""Operator 5: SimHash near-duplicates by bit-sliced comparison.

A fingerprint bit is set when it is set in over half of the XXH64 values of
the text's word shingles.  Fingerprints within the radius are linked.  If 64
bits are cut into ``pieces`` parts, two fingerprints that differ in at most
``radius`` bits agree on at least ``pieces - radius`` parts, so every link
lies in a bucket of some choice of that many parts: the buckets lose none.
Within a bucket fingerprints are stored as vertical bit planes, 64 to a
machine word.  One fingerprint meets a word of 64 others at a time: planes
are XORed with its bits and added by carry-save adders to bitwise counters;
words whose 64 counters all exceed the radius are abandoned.

Equal fingerprints are one node, and a bucket reports at most one link per
member (to its component's first member there), never all pairs.  Buckets of
over ``BLOCK`` members are cut in blocks, each pair of blocks a group of its
own.

Defined results: null and wordless texts have fingerprint zero and are linked
like any other; texts under the shingle length have one shingle; a null doc_id
has no class (component null) but a fingerprint; repeated rows give a row each;
an empty table gives an empty result.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_text, pick, shuffle_partitions, written
from .components import components

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Mean members of a bucket that the number of pieces is chosen for.
BUCKET = 256
#: Members that meet in one group at most.
BLOCK = 8192
ROWS_PER_PARTITION = 400_000


def fingerprint(text: str | None, n: int = SHINGLE) -> int:
    # bytes.lower and bytes.split act on A-Z and on \x20 \x09-\x0D alone
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    if len(words) > n:
        starts, ends = starts[: len(words) - n + 1], ends[n - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts.tolist(), ends.tolist())), dtype=np.uint64, count=len(starts))
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        ones += np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, n: int = SHINGLE) -> DataFrame:
    """(doc_id, fp long) of every row; fp is the fingerprint as a signed long."""

    def marked(texts: list) -> tuple[np.ndarray]:
        return (np.array([fingerprint(t, n) for t in texts], dtype=np.uint64).view(np.int64),)

    return map_text(docs, "text", [("fp", "long", pa.int64())], lambda: marked, ["doc_id"])


def pieces_for(n: int, radius: int, bucket: int = BUCKET) -> int:
    """Fewest pieces whose buckets hold ``bucket`` members on average."""
    for pieces in range(radius + 1, 13):
        if n / 2 ** (64 * (pieces - radius) / pieces) <= bucket:
            return pieces
    return 12


def masks(pieces: int, radius: int) -> list[int]:
    """Bit masks of every choice of ``pieces - radius`` parts, as signed longs."""
    cuts = [64 * i // pieces for i in range(pieces + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in itertools.pairwise(cuts)]
    chosen = (sum(c) for c in itertools.combinations(parts, pieces - radius))
    return [m - (1 << 64) if m >> 63 else m for m in chosen]


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """planes[word, bit]: lane l of the word is that bit of fingerprint 64 * word + l."""
    words = -(-len(fps) // 64)
    bits = np.zeros((words * 64, 64), dtype=np.uint8)
    bits[: len(fps)] = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(bits.reshape(words, 64, 64).transpose(0, 2, 1), axis=2, bitorder="little").copy().view(np.uint64)[..., 0]


FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def within_radius(planes: np.ndarray, used: np.ndarray, query: np.ndarray, radius: int) -> np.ndarray:
    """For each row a word of lanes within ``radius`` bits of its query.

    ``planes`` is (rows, 64); carry-save adders take two planes a step into
    counters of one, two, four and eight; counts over seven stay in ``over``.
    """
    out = np.zeros(len(query), dtype=np.uint64)
    rows = np.arange(len(query))
    ones, twos, fours = (np.zeros(len(query), dtype=np.uint64) for _ in range(3))
    over = ~used
    for bit in range(0, 64, 2):
        x, y = (planes[rows, b] ^ (np.uint64(0) - ((query[rows] >> np.uint64(b)) & np.uint64(1))) for b in (bit, bit + 1))
        u = ones ^ x
        carry = (ones & x) | (u & y)
        ones = u ^ y
        up = twos & carry
        twos = twos ^ carry
        over = over | (fours & up)
        fours = fours ^ up
        if bit % 8 == 6:
            alive = exceeded(ones, twos, fours, over, radius) != FULL
            if not alive.all():
                rows, ones, twos, fours, over = (a[alive] for a in (rows, ones, twos, fours, over))
                if not len(rows):
                    return out
    out[rows] = ~exceeded(ones, twos, fours, over, radius)
    return out


def exceeded(ones, twos, fours, over, radius: int) -> np.ndarray:
    """Lanes whose count (ones + 2 twos + 4 fours, or over 7) is above the radius."""
    above = over.copy()
    for value in range(radius + 1, 8):
        above |= (ones if value & 1 else ~ones) & (twos if value & 2 else ~twos) & (fours if value & 4 else ~fours)
    return above


#: (query, word) rows compared at once.
AT_ONCE = 1 << 15


def bucket_links(group: np.ndarray, fps: np.ndarray, radius: int) -> np.ndarray:
    """Label of each member: the least index in its bucket linked to it, in
    steps, by pairs within the radius.  ``group`` is sorted."""
    n = len(fps)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[first, n])
    end = np.repeat(first + size, size)
    planes, index = bit_planes(fps), np.arange(n)
    # each member meets the words from its own to its bucket's last, in lanes behind it
    word = index // 64
    meets = (end - 1) // 64 - word + 1
    parent = np.arange(n)
    for lo, hi in _slices(meets, AT_ONCE):
        m = meets[lo:hi]
        q = np.repeat(index[lo:hi], m)
        w = word[q] + np.arange(len(q)) - np.repeat(np.cumsum(m) - m, m)
        skip = np.where(w == word[q], q % 64 + 1, 0)
        most = np.minimum(end[q] - w * 64, 64)
        used = np.where(skip < 64, FULL << (skip % 64).astype(np.uint64), np.uint64(0)) & (FULL >> (64 - most).astype(np.uint64))
        hits = within_radius(planes[w], used, fps[q], radius)
        some = np.flatnonzero(hits)
        bits = np.unpackbits(hits[some].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        r, lane = np.nonzero(bits)
        _union(parent, q[some[r]], w[some[r]] * 64 + lane)
    return parent


def _slices(weights: np.ndarray, most: int):
    """Index ranges of about ``most`` weight, one index at least."""
    total = np.cumsum(weights)
    lo = 0
    while lo < len(weights):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + most, side="right")))
        yield lo, hi
        lo = hi


def _union(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the classes of each pair; parent[i] is the least index of i's class so far."""
    while True:
        pa, pb = parent[a], parent[b]
        apart = pa != pb
        if not apart.any():
            return
        a, b, pa, pb = a[apart], b[apart], pa[apart], pb[apart]
        np.minimum.at(parent, np.maximum(pa, pb), np.minimum(pa, pb))
        while True:  # point every member at its root
            root = parent[parent]
            if (root == parent).all():
                break
            parent[:] = root


def links(nodes: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(a, b) links of bucket members, from nodes (fp long, id)."""
    spark = nodes.sparkSession
    n = nodes.count()
    keep = masks(pieces_for(n, radius), radius)
    keyed = nodes.select("fp", "id", F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(keep)])).alias("k")).select("fp", "id", "k.t", "k.key")
    counts = keyed.groupBy("t", "key").agg(F.count("*").alias("m"))
    # a large bucket meets in pairs of blocks: member block i goes to (i, j) for every j
    large = counts.where(F.col("m") > block).select("t", "key", F.ceil(F.col("m") / block).cast("int").alias("nb"))
    split = keyed.join(large, ["t", "key"], "left").withColumn("nb", F.coalesce("nb", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("nb")).cast("int")
    dealt = split.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    dealt = dealt.select("fp", "id", F.xxhash64("t", "key", F.least("own", "other"), F.greatest("own", "other")).alias("g"))
    parts = max(shuffle_partitions(spark), -(-n * len(keep) // ROWS_PER_PARTITION))

    def run(batches):
        got = [b for b in batches if len(b)]
        if not got:
            return
        pdf = pd.concat(got)
        group, fps, ids = (pdf[c].to_numpy() for c in ("g", "fp", "id"))
        order = np.lexsort((ids, group))
        group, fps, ids = group[order], fps[order].view(np.uint64), ids[order]
        alone = np.r_[True, group[1:] != group[:-1]] & np.r_[group[1:] != group[:-1], True]
        group, fps, ids = group[~alone], fps[~alone], ids[~alone]
        if len(ids):
            root = bucket_links(group, fps, radius)
            linked = np.flatnonzero(root != np.arange(len(root)))
            yield pd.DataFrame({"a": ids[root[linked]], "b": ids[linked]})

    kind = dict(nodes.dtypes)["id"]
    return dealt.repartition(parts, "g").mapInPandas(run, f"a {kind}, b {kind}")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) of every row."""
    marked = written(fingerprints(pick(docs, doc_id="doc_id", text="text"), shingle), "fingerprints")
    nodes = written(marked.where(F.col("doc_id").isNotNull()).groupBy("fp").agg(F.min("doc_id").alias("id")), "nodes")
    found = components(links(nodes, radius))
    classes = nodes.join(found, "id", "left").select("fp", F.coalesce("component", "id").alias("component_id"))
    return marked.join(classes, "fp", "left").select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def q_near_duplicates(spark, sf_dir):
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")
