"""Tree ensembles as tables, and the model that scores with them.

A tree is rows of one node table: tree, node (0 is the root), feature (-1 on a
leaf), threshold (at most goes left), left, right, value.  A model keeps its
node table as parquet beside its parameters, so no tree lives on the driver.

Scoring adds up each row's leaf values over the trees: through a sigmoid of the
sum (boosted trees) or as a mean (forest, single tree).  A table of up to
``BROADCAST_NODES`` nodes is broadcast; a larger one streams, a packed tree at a
time, past blocks of rows, so that neither side has to fit in one place.
"""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .preprocess import FEATURES_COL

NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, value double"
NODE_COLUMNS = tuple(f.split()[0] for f in NODE_SCHEMA.split(", "))
#: Nodes (36 bytes each) of a table that is broadcast.
BROADCAST_NODES = 2_000_000
#: Rows that trees stream past together at most, and those that are worth a block of their own.
BLOCK_ROWS = 262_144
LEAST_BLOCK_ROWS = 65_536
NODE_DTYPES = {"feature": np.int32, "threshold": np.float64, "left": np.int32, "right": np.int32, "value": np.float64}
PACKED_TREE = "tree int, nodes binary"


def leaf_values(x: np.ndarray, nodes: dict[str, np.ndarray], lo: int, hi: int) -> np.ndarray:
    """The leaf value of each row in the tree of node rows lo..hi (node i at lo + i)."""
    feature, threshold, left, right, value = (nodes[c][lo:hi] for c in ("feature", "threshold", "left", "right", "value"))
    inner, here = feature >= 0, np.arange(hi - lo)
    # the two sides of each node, a leaf's being itself
    side = np.stack([np.where(inner, right, here), np.where(inner, left, here)], axis=1).reshape(-1)
    column, flat = np.maximum(feature, 0).astype(np.int64), x.reshape(-1)
    at, rows, ended = np.zeros(len(x), dtype=np.int64), np.arange(len(x)), np.zeros(len(x), dtype=np.int64)
    first = rows * x.shape[1]
    while True:
        going = inner.take(at)
        n = np.count_nonzero(going)
        if 2 * n <= len(at):  # rows on leaves are set aside once they are half of all
            ended[rows] = at
            if not n:
                return value.take(ended)
            rows, first, at = rows[going], first[going], at[going]
        at = side.take(2 * at + (flat.take(first + column.take(at)) <= threshold.take(at)))


class LeafMasks:
    """Trees of few leaves, scored all at once (leaves are bits, from the left): a value
    above a node's threshold rules out the leaves on the node's left, whether a row
    comes past the node or not, and of what is left the first leaf is the row's."""

    def __init__(self, nodes: dict[str, np.ndarray], starts: list[int], ends: list[int]):
        self.trees, self.values, found = len(starts), np.zeros(len(starts) * MASK_LEAVES), {}
        for tree, (lo, hi) in enumerate(zip(starts, ends)):
            feature, threshold, left, right, value = (nodes[c][lo:hi].tolist() for c in NODE_DTYPES)
            leaves = 0

            def walk(node: int) -> int:
                """The leaves below a node."""
                nonlocal leaves
                if feature[node] < 0:
                    self.values[tree * MASK_LEAVES + leaves] = value[node]
                    leaves += 1
                    return 1 << leaves - 1
                below = walk(left[node])
                found.setdefault(feature[node], []).append((threshold[node], tree, MASK_ALL ^ below))
                return below | walk(right[node])

            walk(0)
        self.columns = []
        for f, cuts in sorted(found.items()):
            edges = np.unique([c[0] for c in cuts])
            table = np.full((len(edges) + 1, self.trees), MASK_ALL, dtype=np.uint16)
            for threshold, tree, mask in cuts:
                table[np.searchsorted(edges, threshold) + 1, tree] &= mask
            self.columns.append((f, edges, np.bitwise_and.accumulate(table, axis=0)))
        self.first = np.arange(self.trees) * MASK_LEAVES

    @classmethod
    def of(cls, nodes: dict[str, np.ndarray], starts: list[int], ends: list[int]) -> LeafMasks | None:
        """None where a tree has more leaves than bits, or the tables were too large."""
        sizes = np.array(ends) - starts
        inner = np.count_nonzero(nodes["feature"] >= 0)
        if not len(sizes) or sizes.max() > 2 * MASK_LEAVES - 1 or (min(inner, 256 * len(np.unique(nodes["feature"]))) + 1) * len(sizes) > MASK_ENTRIES:
            return None
        out = cls(nodes, starts, ends)
        return out if sum(table.size for _, _, table in out.columns) <= MASK_ENTRIES else None

    def sums(self, x: np.ndarray) -> np.ndarray:
        """Leaf values added up tree by tree."""
        total = np.empty(len(x))
        bins = [(np.searchsorted(edges, x[:, f]), table) for f, edges, table in self.columns]
        for lo in range(0, len(x), MASK_ROWS):
            left = np.full((min(MASK_ROWS, len(x) - lo), self.trees), MASK_ALL, dtype=np.uint16)
            for at, table in bins:
                left &= table.take(at[lo : lo + MASK_ROWS], axis=0)
            leaf = self.first + FIRST_BIT.take(left)
            total[lo : lo + MASK_ROWS] = np.cumsum(self.values.take(leaf), axis=1)[:, -1]  # in the order of the trees
        return total


#: Leaves of a tree, entries of all tables and rows at a time of ``LeafMasks``.
MASK_LEAVES, MASK_ENTRIES, MASK_ROWS = 16, 1 << 23, 64
MASK_ALL = (1 << MASK_LEAVES) - 1
FIRST_BIT = np.array([0, *((m & -m).bit_length() - 1 for m in range(1, MASK_ALL + 1))], dtype=np.uint8)


def tree_sums(x: np.ndarray, nodes: dict) -> np.ndarray:
    """Sum of leaf values over all trees of a table sorted by (tree, node).  What is
    worked out of the table is kept with it."""
    if "starts" not in nodes:
        nodes["starts"] = np.flatnonzero(np.r_[True, nodes["tree"][1:] != nodes["tree"][:-1]]) if len(nodes["tree"]) else []
        nodes["ends"] = [*nodes["starts"][1:], len(nodes["tree"])] if len(nodes["tree"]) else []
        nodes["masks"] = LeafMasks.of(nodes, nodes["starts"], nodes["ends"])
    if nodes["masks"] is not None:
        return nodes["masks"].sums(x)
    total = np.zeros(len(x))
    for lo, hi in zip(nodes["starts"], nodes["ends"]):
        total += leaf_values(x, nodes, lo, hi)
    return total


def packed_trees(nodes: DataFrame) -> DataFrame:
    """A row a tree: its nodes' columns, by node, one behind the other."""

    def pack(key, table):
        table = table.sort_by([("node", "ascending")])
        data = b"".join(table.column(c).to_numpy().astype(t).tobytes() for c, t in NODE_DTYPES.items())
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([data], pa.binary())], names=["tree", "nodes"])

    return nodes.groupBy("tree").applyInArrow(pack, PACKED_TREE)


def unpacked_tree(data: bytes) -> dict[str, np.ndarray]:
    out, at = {}, 0
    n = memoryview(data).nbytes // sum(np.dtype(t).itemsize for t in NODE_DTYPES.values())
    for c, t in NODE_DTYPES.items():
        out[c] = np.frombuffer(data, dtype=t, count=n, offset=at)
        at += out[c].nbytes
    return out


def feature_matrix(values: pa.Array) -> np.ndarray:
    width = len(values[0]) if len(values) else 0
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), width)


class _EnsembleWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.nodes.write.mode("overwrite").parquet(os.path.join(path, "nodes"))


class _EnsembleReader(DefaultParamsReader):
    def load(self, path: str):
        model = super().load(path)
        model.nodes = SparkSession.active().read.schema(NODE_SCHEMA).parquet(os.path.join(path, "nodes"))
        return model


class TreeEnsembleModel(Model, HasFeaturesCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the class-1 probability; ``link`` is sigmoid (of base + sum) or mean."""

    trees = Param(Params._dummy(), "trees", "number of trees", typeConverter=TypeConverters.toInt)
    base = Param(Params._dummy(), "base", "margin before the first tree", typeConverter=TypeConverters.toFloat)
    link = Param(Params._dummy(), "link", "sigmoid or mean", typeConverter=TypeConverters.toString)
    broadcastNodes = Param(Params._dummy(), "broadcastNodes", "largest node table that is broadcast", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, trees: int = 0, base: float = 0.0, link: str = "sigmoid", broadcastNodes: int = BROADCAST_NODES, featuresCol: str = FEATURES_COL, outputCol: str = "score"):
        super().__init__()
        self._setDefault(trees=0, base=0.0, link="sigmoid", broadcastNodes=BROADCAST_NODES, featuresCol=FEATURES_COL, outputCol="score")
        self._set(**self._input_kwargs)
        self.nodes: DataFrame | None = None

    def with_nodes(self, nodes: DataFrame) -> TreeEnsembleModel:
        self.nodes = nodes.select(*NODE_COLUMNS)
        return self

    def write(self):
        return _EnsembleWriter(self)

    @classmethod
    def read(cls):
        return _EnsembleReader(cls)

    def copy(self, extra=None):
        other = super().copy(extra)
        return other if self.nodes is None else other.with_nodes(self.nodes)

    def _finish(self):
        base, trees, sigmoid = self.getOrDefault("base"), self.getOrDefault("trees"), self.getOrDefault("link") == "sigmoid"
        return lambda total: 1.0 / (1.0 + np.exp(-(base + total))) if sigmoid else total / max(1, trees)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out, finish = self.getOutputCol(), self._finish()
        given = [c for c in dataset.columns if c != out]
        rows = dataset.select(*[F.col(f"`{c}`") for c in given]).withColumn("__x", vector_to_array(F.col(self.getFeaturesCol())))
        small = self.nodes.limit(self.getOrDefault("broadcastNodes") + 1).count() <= self.getOrDefault("broadcastNodes")
        if small:
            table = self.nodes.toArrow().sort_by([("tree", "ascending"), ("node", "ascending")])  # columns, never a row at a time
            held = dataset.sparkSession.sparkContext.broadcast({c: table.column(c).to_numpy() for c in NODE_COLUMNS})
            probability = F.pandas_udf(lambda x: pd.Series(finish(tree_sums(_stacked(x), held.value))), "double")
            return rows.withColumn(out, probability("__x")).drop("__x")
        return self._streamed(rows, given, finish).drop("__x")

    def _streamed(self, rows: DataFrame, given: list[str], finish) -> DataFrame:
        """Each block's rows first, then every tree past them."""
        spark, out = rows.sparkSession, self.getOutputCol()
        n, cores = rows.count(), spark.sparkContext.defaultParallelism
        blocks = max(1, -(-n // BLOCK_ROWS), min(cores, -(-n // LEAST_BLOCK_ROWS)))
        held = rows.select(F.struct(*[F.col(f"`{c}`") for c in given]).alias("row"), F.col("__x").alias("x"), *[F.lit(None).cast(t.split()[1]).alias(t.split()[0]) for t in PACKED_TREE.split(", ")])
        # by all plain columns, so that rows of one feature vector are spread too
        plain = [f"row.`{c}`" for c, t in rows.dtypes if c in given and not t.startswith(("map", "vector", "array", "struct"))]
        held = held.withColumns({"block": F.pmod(F.xxhash64("x", *plain), F.lit(blocks)).cast("int"), "kind": F.lit(0)})
        trees = packed_trees(self.nodes).select(F.lit(None).cast(held.schema["row"].dataType).alias("row"), F.lit(None).cast("array<double>").alias("x"), "tree", "nodes", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"))
        dealt = held.unionByName(trees).repartitionById(blocks, "block").sortWithinPartitions("kind", "tree")  # a block a partition

        def run(batches):
            parts, x, total = [], None, None
            for batch in batches:
                rows_here = batch.num_rows - int(pc.sum(batch.column("kind")).as_py() or 0)
                if rows_here:
                    parts.append(batch.slice(0, rows_here))
                if rows_here == batch.num_rows or not parts:
                    continue
                if x is None:
                    x = np.concatenate([feature_matrix(p.column("x")) for p in parts])
                    total = np.zeros(len(x))
                for data in batch.column("nodes").slice(rows_here):
                    nodes = unpacked_tree(data.as_buffer())
                    total += leaf_values(x, nodes, 0, len(nodes["feature"]))
            at, found = 0, finish(np.zeros(sum(p.num_rows for p in parts)) if total is None else total)
            for p in parts:
                yield pa.RecordBatch.from_arrays([p.column("row"), pa.array(found[at : at + p.num_rows])], names=["row", "__score"])
                at += p.num_rows

        schema = held.select("row").schema.add("__score", "double")
        return spark.createDataFrame([], schema).unionByName(dealt.mapInArrow(run, schema)).select("row.*", F.col("__score").alias(out), F.lit(None).alias("__x"))


def _stacked(x) -> np.ndarray:
    return np.stack(x.to_numpy()) if len(x) else np.zeros((0, 0))
