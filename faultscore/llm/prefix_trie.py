"""Operator 13: the trie of conversations that begin alike.

Conversations are rebuilt (the first turns of a base conversation, then the own
later ones) as sequences of 128-bit turn ids; from there on no text moves.  They
are dealt into shards by range of (sequence, conv_id), so each shard holds a
stretch of the sorted conversations and an often repeated one spreads over many
shards.  A shard sorts its padded turn-id matrix (numpy lexsort, a few columns at
a time over the rows not told apart yet), walks the columns accumulating with OR
where a row differs from the one before, which marks the node starts of every
depth, and aggregates each depth by reduceat.

Only nodes that hold a shard's first or last row can go on in another shard.
These are reported in parts with a digest of their sequence, two per depth and
shard, and recombined in one step; all others are complete where they are found
and meet the recombined ones only through their parent's conv_id.

A shard's rows grow with the square root of the table until ``SHARD_BYTES``, so
the parts to recombine stay a small fraction of the table.  Digests of ids are
made in order: whole in the shard, or from the shards' joined ids as they stream
past in shard order (SHA-256 has no other way); no list is held whole.

Defined results: turns go by turn, null first, ties by the md5 of role and text;
a null role or text is empty; a null conv_id has no conversation; repeated turns
are turns of their own; the remainder of a negative conv_id is the one that SQL
gives (toward zero); a conversation whose rebuilt form has no turn is a member of
the root alone; very long texts are hashed where they are read, and a very long
conversation must fit in a task as ids (24 bytes a turn); extra columns are not
read; an empty table has no root, so the result is empty.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, written

EVERY = 5
MOST_SHARED = 8
#: A shard has SHARD_ROWS times the square root of the conversations,
#: MIN_SHARD_ROWS at least, and SHARD_BYTES of ids at most.
SHARD_ROWS = 8
MIN_SHARD_ROWS = 1024
SHARD_BYTES = 48 << 20
BYTES_PER_TURN = 24
#: Columns of the matrix that are sorted at a time.
TILE = 8
NO_IDS = hashlib.sha256(b"").hexdigest()


def turn_lists(conversations: DataFrame) -> DataFrame:
    """(conv_id, own): each conversation's turns in order, as md5 and text bytes."""
    rows = pick(conversations, conv_id="conv_id", turn="turn", role="role", text="text").where("conv_id IS NOT NULL")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct("turn", F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("m"), F.octet_length(text).cast("long").alias("n"))
    return rows.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("own"))


def shared_turns(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string")) % (MOST_SHARED + 1)


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, path, sizes): joined turn ids (16 bytes each) and text bytes."""
    lists = turn_lists(conversations)
    heads = lists.where(F.col("conv_id") % EVERY == 0).select(F.col("conv_id").alias("base"), F.slice("own", 1, MOST_SHARED).alias("head"))
    taken = lists.withColumns({"base": F.col("conv_id") - F.col("conv_id") % EVERY, "h": shared_turns(F.col("conv_id")).cast("int")})
    first = F.when(F.col("head").isNull(), F.slice("own", 1, 0)).otherwise(F.slice("head", F.lit(1), F.col("h")))
    turns = F.concat(first, F.slice("own", F.col("h") + 1, F.size("own")))
    whole = taken.join(heads, "base", "left").select("conv_id", turns.alias("t"))
    path = F.unhex(F.array_join(F.transform("t", lambda t: t["m"]), ""))
    return written(whole.select("conv_id", path.alias("path"), F.transform("t", lambda t: t["n"]).alias("sizes")), "conversations")


def sorted_rows(conv: np.ndarray, starts: np.ndarray, lengths: np.ndarray, ids: np.ndarray, tile: int = TILE) -> np.ndarray:
    """Rows in order of their id sequences (shorter first), then conv_id.

    The padded matrix is sorted ``tile`` columns at a time; rows that these tell
    apart, or that have ended, need no further columns.
    """
    order = np.argsort(conv, kind="stable")
    group = np.zeros(len(conv), dtype=np.int64)  # by place: first place of the rows alike so far
    places, at = np.arange(len(conv)), 0
    while len(places) > 1:
        rows = order[places]
        column = np.arange(at, at + tile)
        there = lengths[rows][:, None] > column
        matrix = ids[np.minimum(starts[rows][:, None] + column, len(ids) - 1)] * there[:, :, None]
        keys = [conv[rows]]
        for c in reversed(range(tile)):
            keys += [matrix[:, c, 1], matrix[:, c, 0], there[:, c]]
        by = np.lexsort([*keys, group[places]])
        order[places], matrix, there = rows[by], matrix[by], there[by]
        new = np.r_[True, group[places][1:] != group[places][:-1]]
        new[1:] |= (there[1:] != there[:-1]).any(axis=1) | (matrix[1:] != matrix[:-1]).any(axis=(1, 2))
        first = np.flatnonzero(new)
        group[places] = np.repeat(places[first], np.diff(np.r_[first, len(places)]))
        alike = np.repeat(np.diff(np.r_[first, len(places)]) > 1, np.diff(np.r_[first, len(places)]))
        places, at = places[alike & there[:, -1]], at + tile
    return order


def add_up(parents: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, dtype=np.int64)
    np.add.at(out, parents, values)
    return out


def shard_levels(conv: np.ndarray, starts: np.ndarray, lengths: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> list[dict]:
    """The nodes of each depth over sorted rows, top-down."""
    n = len(conv)
    changed = np.zeros(n, dtype=bool)
    rows, node_of, levels = np.arange(n), np.zeros(n, dtype=np.int64), []
    for depth in range(int(lengths.max()) + 1):
        if depth:
            rows = rows[lengths[rows] >= depth]
            here = ids[starts[rows] + depth - 1]
            differs = np.ones(len(rows), dtype=bool)
            differs[1:] = (rows[1:] != rows[:-1] + 1) | (here[1:] != here[:-1]).any(axis=1)
            changed[rows] |= differs
        begins = changed[rows].copy()
        begins[0] = True
        first = np.flatnonzero(begins)
        parent = node_of[rows[first]]
        node_of[rows] = np.cumsum(begins) - 1
        ended = rows[lengths[rows] == depth]
        of, at = np.unique(node_of[ended], return_index=True)
        ends = dict(zip(of.tolist(), (",".join(map(str, x.tolist())) for x in np.split(conv[ended], at[1:])))) if len(ended) else {}
        m = len(first)
        level = {
            "parent": parent, "n": np.diff(np.r_[first, len(rows)]), "conv": np.minimum.reduceat(conv[rows], first), "ends": ends,
            "bytes": sizes[starts[rows[first]] + depth - 1] if depth else np.zeros(1, dtype=np.int64),
            "first": (np.arange(m) == 0) & (rows[0] == 0), "last": (np.arange(m) == m - 1) & (rows[-1] == n - 1),
        }
        levels.append(level)
    return levels


def add_subtrees(levels: list[dict]) -> None:
    """Bottom-up: children, leaves and saved tokens, for nodes at the shard's
    edges only what their complete children bring."""
    below = None
    for level in reversed(levels):
        m = len(level["n"])
        edge = level["edge"] = level["first"] | level["last"]
        children, leaves, saved = (np.zeros(m, dtype=np.int64) for _ in range(3))
        if below is not None:
            inside = ~below["edge"]
            children, leaves, saved = (add_up(below["parent"][inside], x[inside], m) for x in (np.ones(len(inside), dtype=np.int64), below["leaves"], below["saved"]))
        level["children"] = children
        level["leaves"] = np.where(~edge & (children == 0), 1, leaves)
        level["saved"] = np.where(edge, saved, saved + (level["n"] - 1) * level["bytes"])
        below = level


NODES = "shard long, side int, depth long, conv_id long, parent_conv_id long, parent_side int, n_convs long, n_children long, n_leaves long, saved_tokens long, bytes long, key binary, parent_key binary, ends string"


def shard_rows(shard: int, levels: list[dict], first_ids: np.ndarray, last_ids: np.ndarray):
    """NODES rows, a batch per depth.  Edge nodes carry keys, parts and ids."""
    keys = [hashlib.md5(b"").digest()] * 2
    for depth, level in enumerate(levels):
        parents = keys
        if depth:
            keys = [hashlib.md5(k + ids[depth - 1].astype(">u8").tobytes()).digest() if k and len(ids) >= depth else None for k, ids in zip(keys, (first_ids, last_ids))]
        m, edge = len(level["n"]), level["edge"]
        side = np.where(level["first"], 0, 1)
        known = np.zeros(m, dtype=bool) if not depth else ~levels[depth - 1]["edge"][level["parent"]]
        up = levels[depth - 1] if depth else level
        ends = [level["ends"].get(i, "") if e else (hashlib.sha256(level["ends"][i].encode()).hexdigest() if i in level["ends"] else NO_IDS) for i, e in enumerate(edge.tolist())]
        whole = lambda x, mask=None: pa.array(x, pa.int64(), mask=mask)
        yield pa.RecordBatch.from_arrays(
            [
                whole(np.full(m, shard)), pa.array(side.astype(np.int32), mask=~edge), whole(np.full(m, depth)), whole(level["conv"]),
                whole(up["conv"][level["parent"]], ~known), pa.array(np.where(up["first"][level["parent"]], 0, 1).astype(np.int32), mask=known),
                whole(level["n"]), whole(level["children"]), whole(level["leaves"]), whole(level["saved"]), whole(level["bytes"]),
                pa.array([keys[s] if e else None for s, e in zip(side.tolist(), edge.tolist())], pa.binary()),
                pa.array([parents[s] if e and depth else None for s, e in zip(side.tolist(), edge.tolist())], pa.binary()), pa.array(ends, pa.string()),
            ],
            names=[f.split()[0] for f in NODES.split(", ")],
        )


def shard_nodes(rows: DataFrame, shards: int) -> DataFrame:
    dealt = rows.repartitionByRange(shards, "path", "conv_id")

    def run(batches):
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got).combine_chunks()
        conv = table.column("conv_id").to_numpy()
        path, sizes = table.column("path").combine_chunks(), table.column("sizes").combine_chunks()
        lengths = sizes.value_lengths().to_numpy().astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        ids = np.frombuffer(b"".join(path.to_pylist()), dtype=">u8").astype(np.uint64).reshape(-1, 2)
        ids = ids if len(ids) else np.zeros((1, 2), dtype=np.uint64)
        order = sorted_rows(conv, starts, lengths, ids)
        conv, starts, lengths = conv[order], starts[order], lengths[order]
        levels = shard_levels(conv, starts, lengths, ids, sizes.flatten().to_numpy(zero_copy_only=False))
        add_subtrees(levels)
        ends = [ids[s : s + n] for s, n in ((starts[0], lengths[0]), (starts[-1], lengths[-1]))]
        yield from shard_rows(TaskContext.get().partitionId(), levels, *ends)

    return written(dealt.mapInArrow(run, NODES), "trie")


EDGES = "key binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def recombined(parts: pd.DataFrame) -> pd.DataFrame:
    """Whole edge nodes from the parts that the shards report of them."""
    parts = parts.assign(key=parts["key"].map(bytes), parent_key=parts["parent_key"].map(lambda k: bytes(k) if k is not None else None))
    nodes = parts.groupby("key", sort=False).agg(
        depth=("depth", "first"), conv_id=("conv_id", "min"), n_convs=("n_convs", "sum"), n_children=("n_children", "sum"),
        n_leaves=("n_leaves", "sum"), saved_tokens=("saved_tokens", "sum"), bytes=("bytes", "first"), parent_key=("parent_key", "first"),
    ).reset_index()
    where = dict(zip(nodes["key"], range(len(nodes))))
    parent = np.array([where.get(k, -1) for k in nodes["parent_key"]])
    children, leaves, saved = (nodes[c].to_numpy(dtype=np.int64).copy() for c in ("n_children", "n_leaves", "saved_tokens"))
    saved += (nodes["n_convs"].to_numpy() - 1) * nodes["bytes"].to_numpy()
    depth = nodes["depth"].to_numpy()
    by_depth = np.argsort(depth, kind="stable")
    cuts = np.flatnonzero(np.diff(depth[by_depth])) + 1
    for here in reversed(np.split(by_depth, cuts)):
        leaves[here] = np.where(children[here] == 0, 1, leaves[here])
        here = here[parent[here] >= 0]
        np.add.at(children, parent[here], 1)
        np.add.at(leaves, parent[here], leaves[here])
        np.add.at(saved, parent[here], saved[here])
    conv = nodes["conv_id"].to_numpy()
    above = pd.array(np.where(parent >= 0, conv[parent], 0), dtype="Int64")
    above[parent < 0] = pd.NA
    return pd.DataFrame({"key": nodes["key"], "depth": depth, "conv_id": conv, "parent_conv_id": above, "n_convs": nodes["n_convs"], "n_children": children, "n_leaves": leaves, "saved_tokens": saved})


def digests(edges: DataFrame) -> DataFrame:
    """(key, ends_sha256) of edge nodes from the shards' joined ids, streamed."""
    chunks = edges.where("ends != ''").select("key", "shard", "ends").repartition("key").sortWithinPartitions("key", "shard")

    def run(batches):
        key, digest = None, None
        for batch in batches:
            done = []
            for k, ends in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if k != key:
                    if key is not None:
                        done.append((key, digest.hexdigest()))
                    key, digest = k, hashlib.sha256(ends.encode())
                else:
                    digest.update(b"," + ends.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.binary()), pa.array([h for _, h in done], pa.string())], names=["key", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()], pa.string())], names=["key", "ends_sha256"])

    return chunks.mapInArrow(run, "key binary, ends_sha256 string")


def trie(conversations: DataFrame, shard_rows: int | None = None) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.  ``shard_rows`` overrides the rule."""
    rows = rebuilt(conversations)
    n, turns = rows.agg(F.count("*"), F.coalesce(F.sum(F.size("sizes")), F.lit(0))).first()
    per = shard_rows or max(MIN_SHARD_ROWS, math.ceil(SHARD_ROWS * math.sqrt(n)))
    found = shard_nodes(rows, max(1, -(-n // per), -(-turns * BYTES_PER_TURN // SHARD_BYTES)))
    numbers = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    result = ["conv_id", "depth", "parent_conv_id", *numbers, "ends_sha256"]
    edges = found.where("side IS NOT NULL")
    parts = edges.select("key", "parent_key", "depth", "conv_id", *numbers, "bytes")

    def combine(batches):
        got = [b for b in batches if len(b)]
        if got:
            yield recombined(pd.concat(got))

    # two nodes a depth and shard, so far fewer than conversations
    whole = written(parts.repartition(1).mapInPandas(combine, EDGES), "edges")
    at_edges = whole.join(digests(edges), "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_IDS)))
    inside = found.where("side IS NULL").withColumnRenamed("ends", "ends_sha256")
    parents = edges.select("shard", F.col("side").alias("parent_side"), F.col("depth").alias("above"), "key").join(whole.select("key", F.col("conv_id").alias("over")), "key").drop("key")
    below = inside.where("parent_side IS NOT NULL").withColumn("above", F.col("depth") - 1).join(parents, ["shard", "parent_side", "above"])
    below = below.withColumn("parent_conv_id", F.col("over"))
    return at_edges.select(*result).unionByName(inside.where("parent_side IS NULL").select(*result)).unionByName(below.select(*result))


def q_trie(spark, sf_dir):
    return trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


ORACLE = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, md5(length(role)::VARCHAR || ':' || role || text)) AS own
  FROM turns GROUP BY conv_id
), taken AS (
  SELECT conv_id, own, conv_id - conv_id % {EVERY} AS base,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
        lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384))), 4294967295::BIGINT) % {MOST_SHARED + 1} AS h
  FROM own
), rebuilt AS (
  SELECT t.conv_id, list_concat(coalesce(list_slice(b.own, 1, t.h), []), list_slice(t.own, t.h + 1, len(t.own))) AS seq
  FROM taken t LEFT JOIN own b ON b.conv_id = t.base
), members AS (
  SELECT conv_id, d AS depth, list_slice(seq, 1, d) AS prefix, len(seq) = d AS ends FROM rebuilt, unnest(range(0, len(seq) + 1)) AS u(d)
), nodes AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * CASE WHEN depth = 0 THEN 0 ELSE strlen(prefix[depth].text) END AS saved,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ids
  FROM members GROUP BY prefix, depth
), above AS (
  SELECT list_slice(prefix, 1, depth - 1) AS prefix, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), marked AS (
  SELECT n.*, coalesce(a.n_children, 0) AS n_children FROM nodes n LEFT JOIN above a ON a.prefix = n.prefix AND a.depth = n.depth
), sums AS (
  SELECT list_slice(prefix, 1, d) AS prefix, d AS depth, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
  FROM marked, unnest(range(0, depth + 1)) AS u(d) GROUP BY ALL
)
SELECT m.conv_id, m.depth, p.conv_id AS parent_conv_id, m.n_convs, m.n_children, s.n_leaves, s.saved_tokens, sha256(m.ids) AS ends_sha256
FROM marked m JOIN sums s ON s.prefix = m.prefix AND s.depth = m.depth
LEFT JOIN nodes p ON p.depth = m.depth - 1 AND p.prefix = list_slice(m.prefix, 1, m.depth - 1)
"""
