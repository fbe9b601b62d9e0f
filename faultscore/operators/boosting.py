"""Second-order gradient boosting on histograms.

Values are binned once, at the ranks of an even cut of the training rows.  Rows
lie in blocks (one table row each: bins, labels, hashed ids, margins).  A level
of a tree is one pass over the blocks that sums gradient and hessian by (node,
feature, bin), adds up these sums, and chooses a split per node from a table
that is as large as the tree is wide and not as the data is long.  Of two
siblings only the lighter one is summed: the other is the parent less it.
Rows are drawn for each tree by a hash of (seed, round, id), columns by the order
of md5(seed:round:column).

Gradients and hessians are rounded to whole multiples of a power of two before
they are added, so sums are exact integers: neither blocks nor the order in
which tasks finish change a tree.

A round's margins are the last round's with its tree applied; they stay cached
and are checkpointed every ``checkpoint_interval`` rounds.  Where all rows are
one block there is nothing to add up between tasks, and the rounds run inside
that block's task with the same functions.  So they do over a few blocks if the
caller allows that (``task_blocks``, and ``TASK_VALUES`` at most): starting a
job a level takes longer there than adding up the blocks one after another.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, hash_key
from ..session import ensure_checkpoint_dir
from .ensembles import NODE_COLUMNS, NODE_SCHEMA, TreeEnsembleModel
from .prefix_sums import prefix_sums

#: Smallest gain that is worth a split.
LEAST_GAIN = 1e-6
#: Blocks whose sums (some 200 KB each) the driver adds up itself.
DIRECT_BLOCKS = 128
#: Binned values (rows times columns, two bytes each) that a task holds of several blocks.
TASK_VALUES = 33_554_432


@dataclass(frozen=True)
class BoostingConfig:
    rounds: int = 500
    step: float = 0.05
    depth: int = 4
    subsample: float = 0.8
    column_fraction: float = 0.8
    min_child_hessian: float = 2.0
    l2: float = 1.0
    l1: float = 0.0
    bins: int = 256
    seed: int = 42
    block_rows: int = 262_144
    checkpoint_interval: int = 25


def bin_edges(values: DataFrame, bins: int) -> dict[int, list[float]]:
    """Upper edges of each feature's bins: the values at which the running count
    passes a further ``1/bins`` of the rows.  (feature, value) rows come in; at
    most ``bins`` edges a feature reach the driver."""
    table = values.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    summed = prefix_sums(table, ["feature"], "value", ["n"])
    share = lambda n: F.floor(n * F.lit(bins) / F.col("n_all"))
    edges = summed.where(share(F.col("n_upto")) > share(F.col("n_upto") - F.col("n"))).select("feature", "value").collect()
    out: dict[int, list[float]] = {}
    for r in sorted(edges, key=lambda r: (r["feature"], r["value"])):
        out.setdefault(r["feature"], []).append(r["value"])
    return out


def columns_of_round(width: int, fraction: float, seed: int, number: int) -> list[int]:
    """The columns that a tree may split on, ascending."""
    order = sorted(range(width), key=lambda f: hashlib.md5(f"{seed}:{number}:{f}".encode()).hexdigest())
    return sorted(order[: max(1, int(fraction * width))])


def multiplier(seed: int, number: int) -> tuple[int, int]:
    """The two 64-bit numbers that hash the ids anew in a round."""
    digest = hashlib.md5(f"{seed}:rows:{number}".encode()).hexdigest()
    return int(digest[:16], 16) | 1, int(digest[16:], 16)


def drawn(ids: np.ndarray, share: float, seed: int, number: int) -> np.ndarray:
    a, b = multiplier(seed, number)
    with np.errstate(over="ignore"):
        return ((ids * np.uint64(a) + np.uint64(b)) >> np.uint64(32)).astype(np.float64) < share * 2.0**32


def gradient_scale(weight: float, block_rows: int) -> float:
    """A power of two fine enough for the sums and small enough for exact doubles."""
    return 2.0 ** min(24, 51 - math.ceil(math.log2(max(2, block_rows))) - math.ceil(math.log2(max(2.0, weight))))


def gradients(margin: np.ndarray, label: np.ndarray, weight: float, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Whole-number first and second derivatives of the weighted logistic loss."""
    p = 1.0 / (1.0 + np.exp(-margin))
    w = np.where(label == 1, weight, 1.0)
    return np.rint(w * (p - label) * scale), np.rint(w * p * (1.0 - p) * scale)


def rare_rows(bins: np.ndarray) -> tuple[int, np.ndarray] | None:
    """A column's commonest bin and the rows of all others, if those are the fewer."""
    common = int(np.argmax(np.bincount(bins, minlength=1)))
    rows = np.flatnonzero(bins != common)
    return (common, rows) if 2 * len(rows) < len(bins) else None


def level_sums(bins: np.ndarray, place: np.ndarray, used: np.ndarray, g: np.ndarray, h: np.ndarray, nodes: int, columns: list[int], sizes: list[int], rare: dict[int, tuple[int, np.ndarray]]) -> np.ndarray:
    """(2, node, bins of one column after another) sums over the used rows; ``place``
    is a row's node at this level.  Of a column in ``rare`` only the rows outside its
    commonest bin are added up: that bin has the rest of the node."""
    rows = np.flatnonzero(used)
    at = place.take(rows)
    weights = g.take(rows), h.take(rows)
    whole = np.stack([np.bincount(at, weights=w, minlength=nodes) for w in weights])
    out = np.zeros((2, nodes, sum(sizes[f] for f in columns)))
    first = 0
    for f in columns:
        size = sizes[f]
        part = out[:, :, first : first + size]
        first += size
        if f in rare:
            common, others = rare[f]
            others = others[used.take(others)]
            key = place.take(others) * size + bins[f].take(others)
            for k, w in enumerate((g, h)):
                part[k] = np.bincount(key, weights=w.take(others), minlength=nodes * size).reshape(nodes, size)
            part[:, :, common] = whole - part.sum(axis=2)
        else:
            key = at * size + bins[f].take(rows)
            for k, w in enumerate(weights):
                part[k] = np.bincount(key, weights=w, minlength=nodes * size).reshape(nodes, size)
    return out


def by_column(sums: np.ndarray, columns: list[int], sizes: list[int]) -> np.ndarray:
    """(2, node, column, bin) sums, columns of fewer bins filled up with zeros."""
    wide = np.array([sizes[f] for f in columns])
    filled = np.arange(wide.max()) < wide[:, None]
    out = np.zeros((*sums.shape[:2], *filled.shape))
    out[:, :, filled] = sums
    return out


def score(g: np.ndarray, h: np.ndarray, cfg: BoostingConfig) -> np.ndarray:
    """What a node with these sums takes off the loss."""
    g = np.sign(g) * np.maximum(np.abs(g) - cfg.l1, 0.0)
    return g * g / (h + cfg.l2)


def choose_splits(sums: np.ndarray, columns: list[int], cfg: BoostingConfig) -> list[dict]:
    """Each node's best split (ties: first column, lowest bin), or none; the sums
    of both sides come along, so a level needs no pass for its leaves."""
    left = np.cumsum(sums, axis=3)
    whole = left[:, :, :1, -1:]
    right = whole - left
    gain = score(left[0], left[1], cfg) + score(right[0], right[1], cfg) - score(whole[0], whole[1], cfg)
    allowed = (left[1] >= cfg.min_child_hessian) & (right[1] >= cfg.min_child_hessian)
    gain = np.where(allowed, gain, -np.inf).reshape(len(gain), -1)
    best = np.argmax(gain, axis=1)
    out = []
    for n, at in enumerate(best.tolist()):
        i, b = divmod(at, sums.shape[3])
        split = gain[n, at] > LEAST_GAIN
        out.append({"sums": whole[:, n, 0, 0], "feature": columns[i] if split else -1, "bin": b, "left": left[:, n, i, b], "right": right[:, n, i, b]})
    return out


class Tree:
    """A tree while it grows: nodes in order of their level, an open level last."""

    def __init__(self):
        self.feature, self.bin, self.left, self.sums = [-1], [0], [-1], [None]
        self.open, self.parents = [0], []

    def grow(self, splits: list[dict]) -> None:
        """``parents`` are the places of the split nodes among those that were open;
        their children lie in ``open`` pair by pair."""
        opened, self.parents = [], []
        for i, (node, s) in enumerate(zip(self.open, splits)):
            self.sums[node] = s["sums"]
            if s["feature"] >= 0:
                self.parents.append(i)
                self.feature[node], self.bin[node], self.left[node] = s["feature"], s["bin"], len(self.feature)
                for side in ("left", "right"):
                    opened.append(len(self.feature))
                    self.feature.append(-1)
                    self.bin.append(0)
                    self.left.append(-1)
                    self.sums.append(s[side])
        self.open = opened

    def lighter(self) -> list[int]:
        """The places in ``open`` of the children with the smaller hessian, one a pair."""
        if not self.parents:
            return list(range(len(self.open)))
        return [2 * k + int(self.sums[self.open[2 * k + 1]][1] < self.sums[self.open[2 * k]][1]) for k in range(len(self.parents))]

    def leaves(self, bins: np.ndarray, n: int, at: np.ndarray | None = None) -> np.ndarray:
        """The node that each row has come to, from the root or from where it was."""
        at = np.zeros(n, dtype=np.int64) if at is None else at
        feature, edge, left = np.array(self.feature), np.array(self.bin), np.array(self.left)
        inner, here = feature >= 0, np.arange(len(feature))
        # the two sides of each node, a leaf's being itself
        side = np.stack([np.where(inner, left, here), np.where(inner, left + 1, here)], axis=1).reshape(-1)
        first, flat, rows = np.maximum(feature, 0) * n, bins.reshape(-1), np.arange(n)
        while True:
            going = inner.take(at)
            count = np.count_nonzero(going)
            if not count:
                return at
            if 2 * count > n:
                at = side.take(2 * at + (flat.take(first.take(at) + rows) > edge.take(at)))
            else:
                moved = np.flatnonzero(going)
                node = at.take(moved)
                at[moved] = side.take(2 * node + (flat.take(first.take(node) + moved) > edge.take(node)))

    def values(self, cfg: BoostingConfig) -> np.ndarray:
        g, h = np.array(self.sums).T
        return -cfg.step * np.sign(g) * np.maximum(np.abs(g) - cfg.l1, 0.0) / (h + cfg.l2)

    def rows(self, number: int, edges: dict[int, list[float]], cfg: BoostingConfig) -> list[tuple]:
        value = self.values(cfg)
        return [
            (number, n, f, float(edges[f][b]) if f >= 0 else 0.0, left, left + 1 if f >= 0 else -1, float(value[n]) if f < 0 else 0.0)
            for n, (f, b, left) in enumerate(zip(self.feature, self.bin, self.left))
        ]


class Block:
    """Rows of one block, as they are packed in the block table."""

    def __init__(self, row: dict):
        self.n = int(row["n"])
        self.label = np.frombuffer(row["label"], dtype=np.int8)
        self.ids = np.frombuffer(row["ids"], dtype=np.uint64)
        self.bins = np.frombuffer(row["bins"], dtype=np.uint16).reshape(-1, self.n)
        self.margin = np.frombuffer(row["margin"], dtype=np.float64)

        self.rare: dict[int, tuple[int, np.ndarray]] = {}

    def index(self) -> None:
        """For a block that is summed many times."""
        found = {f: rare_rows(b) for f, b in enumerate(self.bins)}
        self.rare = {f: r for f, r in found.items() if r is not None}

    def begin(self, number: int, weight: float, scale: float, cfg: BoostingConfig) -> None:
        self.g, self.h = gradients(self.margin, self.label, weight, scale)
        self.drawn, self.at = drawn(self.ids, cfg.subsample, cfg.seed, number), None

    def sums(self, tree: Tree, columns: list[int], sizes: list[int]) -> np.ndarray:
        """Sums of the lighter open nodes, behind ``begin``."""
        lighter = tree.lighter()
        place = np.full(len(tree.feature), -1)
        place[[tree.open[i] for i in lighter]] = np.arange(len(lighter))
        self.at = tree.leaves(self.bins, self.n, self.at)
        at = place.take(self.at)
        return level_sums(self.bins, at, self.drawn & (at >= 0), self.g, self.h, len(lighter), columns, sizes, self.rare)

    def apply(self, tree: Tree, cfg: BoostingConfig, at: np.ndarray | None = None) -> None:
        self.margin = self.margin + tree.values(cfg).take(tree.leaves(self.bins, self.n, at))


def grow_tree(columns: list[int], sizes: list[int], scale: float, cfg: BoostingConfig, summed) -> Tree:
    """A tree, level by level; ``summed(tree)`` adds up the lighter open nodes over
    all rows, nodes on the last axis but one."""
    tree, above = Tree(), None
    for _ in range(cfg.depth):
        if not tree.open:
            break
        found, lighter = summed(tree), tree.lighter()
        if above is None:
            above = found
        else:
            sums = np.empty((*found.shape[:-2], len(tree.open), found.shape[-1]), dtype=found.dtype)
            sums[..., lighter, :] = found
            sums[..., [i ^ 1 for i in lighter], :] = above[..., tree.parents, :] - found
            above = sums
        tree.grow(choose_splits(by_column(whole_numbers(above) / scale, columns, sizes), columns, cfg))
    return tree


def halves(sums: np.ndarray) -> np.ndarray:
    """Whole numbers in two, so that those of any number of blocks add up exactly."""
    whole = sums.astype(np.int64)
    return np.stack([whole >> 32, whole & 0xFFFFFFFF])


def whole_numbers(sums: np.ndarray) -> np.ndarray:
    """Sums as doubles, put together where they are ``halves``."""
    return sums if sums.ndim == 3 else sums[0].astype(np.float64) * 2.0**32 + sums[1]


BLOCKS = "block long, n long, label binary, ids binary, bins binary, margin binary"


def make_blocks(rows: DataFrame, edges: dict[int, list[float]], width: int, base: float, n: int, cfg: BoostingConfig) -> DataFrame:
    """(label, id, x) rows as blocks of about ``block_rows`` rows, by hash of the id."""
    count = max(1, -(-n // cfg.block_rows))
    dealt = rows.withColumn("block", F.pmod(F.col("id"), F.lit(count))).repartition(count, "block").sortWithinPartitions("block", "id")
    held = rows.sparkSession.sparkContext.broadcast({f: np.array(e) for f, e in edges.items()})  # at most ``bins`` edges a feature

    def pack(key, table):
        table = table.sort_by([("id", "ascending")])
        x = table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        bins = np.stack([np.searchsorted(held.value[f], x[:, f]) for f in range(width)]).astype(np.uint16)
        values = [key[0].as_py(), len(x), table.column("label").to_numpy().astype(np.int8).tobytes(), table.column("id").to_numpy().astype(np.uint64).tobytes(), bins.tobytes(), np.full(len(x), base).tobytes()]
        names = [f.split()[0] for f in BLOCKS.split(", ")]
        return pa.table({k: pa.array([v], pa.binary() if isinstance(v, bytes) else pa.int64()) for k, v in zip(names, values)})

    return dealt.groupBy("block").applyInArrow(pack, BLOCKS)


def column_sizes(edges: dict[int, list[float]], width: int) -> list[int]:
    return [len(edges[f]) for f in range(width)]


def grow_in_task(blocks: DataFrame, edges: dict, width: int, weight: float, cfg: BoostingConfig) -> DataFrame:
    """All rounds in a task that holds the blocks."""
    scale, sizes = gradient_scale(weight, cfg.block_rows), column_sizes(edges, width)

    def run(batches):
        held = [Block(row) for batch in batches for row in batch.to_pylist()]
        for block in held:
            block.index()
        for number in range(cfg.rounds if held else 0):
            columns = columns_of_round(width, cfg.column_fraction, cfg.seed, number)
            for block in held:
                block.begin(number, weight, scale, cfg)
            tree = grow_tree(columns, sizes, scale, cfg, lambda tree, columns=columns: sum(halves(block.sums(tree, columns, sizes)) for block in held))
            for block in held:
                block.apply(tree, cfg, block.at)
            nodes = zip(*tree.rows(number, edges, cfg))
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(nodes, NODE_TYPES)], names=list(NODE_COLUMNS))

    return blocks.repartition(1).mapInArrow(run, NODE_SCHEMA)


NODE_TYPES = (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.float64())


def grow_over_blocks(blocks: DataFrame, edges: dict, width: int, weight: float, cfg: BoostingConfig) -> DataFrame:
    """A job a level over the blocks.  There are thousands of these, so they are
    plain RDD jobs, which need no planning and leave no plan behind."""
    spark, scale, sizes = blocks.sparkSession, gradient_scale(weight, cfg.block_rows), column_sizes(edges, width)
    ensure_checkpoint_dir(spark)
    packed = blocks.rdd.map(lambda r: (r["block"], r.asDict())).persist(StorageLevel.MEMORY_AND_DISK)
    # a block a partition, so that all are worked on at the same time
    state = packed.partitionBy(max(1, packed.count()), int).values().persist(StorageLevel.MEMORY_AND_DISK)
    held, out = [packed, state], []
    for number in range(cfg.rounds):
        columns = columns_of_round(width, cfg.column_fraction, cfg.seed, number)
        tree = grow_tree(columns, sizes, scale, cfg, lambda tree, state=state, number=number, columns=columns: summed_over_blocks(state, tree, number, columns, sizes, weight, scale, cfg))
        out += tree.rows(number, edges, cfg)
        while len(held) > 1:  # what the last state was made from
            held.pop(0).unpersist()
        state = applied(state, tree, cfg).persist(StorageLevel.MEMORY_AND_DISK)
        held.append(state)
        if number % cfg.checkpoint_interval == cfg.checkpoint_interval - 1:
            state.checkpoint()
            state.count()
    while held:
        held.pop().unpersist()
    return spark.createDataFrame(out, NODE_SCHEMA)


def summed_over_blocks(state: RDD, tree: Tree, number: int, columns: list[int], sizes: list[int], weight: float, scale: float, cfg: BoostingConfig) -> np.ndarray:
    def sums(row: dict) -> np.ndarray:
        block = Block(row)
        block.begin(number, weight, scale, cfg)
        return halves(block.sums(tree, columns, sizes))

    # lighter nodes of a level x bins of the columns; a tree of sums takes another stage, with a shuffle
    found = state.map(sums)
    return (found.reduce if state.getNumPartitions() <= DIRECT_BLOCKS else found.treeReduce)(lambda a, b: a + b)


def applied(state: RDD, tree: Tree, cfg: BoostingConfig) -> RDD:
    def run(row: dict) -> dict:
        block = Block(row)
        block.apply(tree, cfg)
        return {**row, "margin": block.margin.tobytes()}

    return state.map(run)


def boosting_rows(train: DataFrame, id_column: str, label: str, features: str, seed: int) -> DataFrame:
    """(id hash, label, x) of training rows."""
    digest = F.conv(F.substring(hash_key(seed, col(id_column)), 1, 13), 16, 10).cast("long")
    return train.select(digest.alias("id"), F.col(label).cast("int").alias("label"), vector_to_array(F.col(features)).alias("x"))


def fit_boosted_trees(train: DataFrame, id_column: str, weight: float, cfg: BoostingConfig, label: str = "label", features: str = "features", task_blocks: int = 1) -> TreeEnsembleModel:
    """Trees that add up to the log odds, positives weighted by ``weight``.  Rows of up
    to ``task_blocks`` blocks are fitted in a task."""
    spark = train.sparkSession
    rows = boosting_rows(train, id_column, label, features, cfg.seed)
    n, width, positives = rows.agg(F.count(F.lit(1)), F.max(F.size("x")), F.sum("label")).first()
    values = rows.select(F.posexplode("x").alias("feature", "value"))
    edges = bin_edges(values.withColumn("value", F.col("value") + F.lit(0.0)), cfg.bins)
    # one Newton step from even odds: zero for weight = negatives / positives
    base = -2.0 * ((n - positives) - weight * positives) / ((n - positives) + weight * positives)
    blocks = make_blocks(rows, edges, width, base, n, cfg)
    in_task = n <= cfg.block_rows or (n <= task_blocks * cfg.block_rows and n * width <= TASK_VALUES)
    nodes = (grow_in_task if in_task else grow_over_blocks)(blocks, edges, width, weight, cfg)
    path = f"{ensure_checkpoint_dir(spark)}/boosted-{uuid.uuid4().hex}"
    nodes.write.mode("overwrite").parquet(path)
    return TreeEnsembleModel(trees=cfg.rounds, base=base, link="sigmoid").with_nodes(spark.read.schema(NODE_SCHEMA).parquet(path))
