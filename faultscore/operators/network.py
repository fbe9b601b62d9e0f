"""A network of one hidden layer, trained by mini-batches.

ReLU units with dropout, weighted logistic loss, Adam with weight decay.  Rows lie
in blocks (one table row each).  In every epoch a row's batch is a hash of (seed,
epoch, id); a step takes ``batch`` rows on average, of however many blocks.  The
units that a row drops are hashes of (seed, epoch, id, unit), so a lost task comes
out the same again.  Where all rows are one block the steps run inside its task.

A step needs the weights of the step before, and its own batch only.  So up to
``most_turns`` blocks an epoch's rows are dealt by batch into as many turns, each
no longer than a block on average; a task takes the steps of a turn and hands
weights and moments to the next one.  Beyond that (a caller's wish, for steps that
are worth a job) no row moves: the tasks add up the gradient of their blocks' rows,
a groupBy adds up the tasks, and the driver takes the step.  All three forms take
the same steps with the same functions.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, hash_key
from .preprocess import FEATURES_COL


@dataclass(frozen=True)
class NetworkConfig:
    hidden: int = 24
    dropout: float = 0.15
    rate: float = 0.002
    decay: float = 1e-4
    batch: int = 128
    epochs: int = 40
    seed: int = 42
    block_rows: int = 262_144
    most_turns: int = 1 << 20  # a turn is a job; a step alone is never worth one


def numbers(*parts) -> tuple[int, int]:
    """Two 64-bit numbers out of the parts."""
    digest = hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()
    return int(digest[:16], 16) | 1, int(digest[16:], 16)


@lru_cache(maxsize=8)
def unit_numbers(seed: int, epoch: int, hidden: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``unit_hash`` takes of (seed, epoch, unit), an entry a unit."""
    found = [numbers(seed, "drop", epoch, u) for u in range(hidden)]
    return tuple(np.array(c, dtype=np.uint64) for c in zip(*[(a, b, a ^ (b | 1) | 1) for a, b in found]))


def unit_hash(ids: np.ndarray, *parts) -> np.ndarray:
    """A number in [0, 2^32) for every id."""
    a, b = numbers(*parts)
    with np.errstate(over="ignore"):
        mixed = ids * np.uint64(a) + np.uint64(b)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(a ^ (b | 1) | 1)
    return mixed >> np.uint64(32)


class Weights:
    """The parameters as one vector, and their parts as views of it."""

    def __init__(self, width: int, hidden: int, vector: np.ndarray | None = None):
        self.width, self.hidden = width, hidden
        self.vector = np.zeros(width * hidden + 2 * hidden + 1) if vector is None else vector
        cut = width * hidden
        self.first, self.first_bias = self.vector[:cut].reshape(width, hidden), self.vector[cut : cut + hidden]
        self.second, self.second_bias = self.vector[cut + hidden : cut + 2 * hidden], self.vector[-1:]

    @classmethod
    def drawn(cls, width: int, hidden: int, seed: int) -> Weights:
        """Uniform within one over the root of the inputs."""
        out, g = cls(width, hidden), np.random.default_rng(seed)
        out.first[:], out.first_bias[:] = g.uniform(-1, 1, (width, hidden)) / np.sqrt(width), g.uniform(-1, 1, hidden) / np.sqrt(width)
        out.second[:], out.second_bias[:] = g.uniform(-1, 1, hidden) / np.sqrt(hidden), g.uniform(-1, 1, 1) / np.sqrt(hidden)
        return out

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.first + self.first_bias, 0.0) @ self.second + self.second_bias


def gradient_sums(w: Weights, x: np.ndarray, y: np.ndarray, keep: np.ndarray, weight: float) -> np.ndarray:
    """Summed gradient, then summed loss and number of rows; ``keep`` scales the units."""
    before = x @ w.first + w.first_bias
    units = np.maximum(before, 0.0) * keep
    z = units @ w.second + w.second_bias
    p = 1.0 / (1.0 + np.exp(-z))
    found = np.empty(len(w.vector) + 2)
    out = Weights(w.width, w.hidden, found[:-2])
    ones, zeros = weight * y, 1.0 - y
    dz = zeros * p - ones * (1.0 - p)
    back = dz[:, None] * w.second
    back *= keep
    back *= before > 0
    np.matmul(x.T, back, out=out.first)
    back.sum(axis=0, out=out.first_bias)
    np.matmul(units.T, dz, out=out.second)
    out.second_bias[0] = dz.sum()
    found[-2:] = (ones * np.logaddexp(0.0, -z) + zeros * np.logaddexp(0.0, z)).sum(), len(x)
    return found


class Adam:
    def __init__(self, size: int, rate: float, decay: float):
        self.rate, self.decay, self.t = rate, decay, 0
        self.mean, self.square = np.zeros(size), np.zeros(size)

    def step(self, vector: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        gradient = gradient + self.decay * vector
        self.t += 1
        self.mean = 0.9 * self.mean + 0.1 * gradient
        self.square = 0.999 * self.square + 0.001 * gradient * gradient
        return vector - self.rate * (self.mean / (1 - 0.9**self.t)) / (np.sqrt(self.square / (1 - 0.999**self.t)) + 1e-8)


class Rows:
    """A block's rows, and those of one batch after another."""

    def __init__(self, row: dict, width: int):
        self.ids, self.y = np.frombuffer(row["ids"], dtype=np.uint64), np.frombuffer(row["label"], dtype=np.int8).astype(np.float64)
        self.x = np.frombuffer(row["x"], dtype=np.float64).reshape(-1, width)

    def batches(self, epoch: int, count: int, cfg: NetworkConfig) -> np.ndarray:
        return (unit_hash(self.ids, cfg.seed, "batch", epoch) % np.uint64(count)).astype(np.int64)

    def keep(self, at: np.ndarray | slice, epoch: int, cfg: NetworkConfig) -> np.ndarray:
        a, b, c = unit_numbers(cfg.seed, epoch, cfg.hidden)
        mixed = self.ids[at][:, None] * a + b  # unit_hash of every unit at once
        mixed = (mixed ^ (mixed >> np.uint64(29))) * c
        return (mixed >> np.uint64(32) >= np.uint64(cfg.dropout * 2**32)) / (1.0 - cfg.dropout)

    def sums(self, w: Weights, at: np.ndarray, epoch: int, weight: float, cfg: NetworkConfig) -> np.ndarray:
        return gradient_sums(w, self.x[at], self.y[at], self.keep(at, epoch, cfg), weight)


class Dealt:
    """An epoch's rows by batch (numbers from 0, in the order of ``dealt``), of which
    the kept units are hashed for many batches at a time."""

    def __init__(self, rows: Rows, dealt: np.ndarray, batches: int, epoch: int, weight: float, cfg: NetworkConfig):
        order = np.argsort(dealt, kind="stable")
        self.rows = object.__new__(Rows)
        self.rows.ids, self.rows.y, self.rows.x = rows.ids[order], rows.y[order], rows.x[order]
        self.bounds = np.searchsorted(dealt[order], np.arange(batches + 1)).tolist()
        self.epoch, self.weight, self.cfg, self.kept, self.lo, self.hi = epoch, weight, cfg, None, 0, 0

    def sums(self, w: Weights, b: int) -> np.ndarray:
        lo, hi = self.bounds[b], self.bounds[b + 1]
        if not self.lo <= lo <= hi <= self.hi:
            self.lo, self.hi = lo, min(len(self.rows.ids), max(hi, lo + KEPT_ROWS))
            self.kept = self.rows.keep(slice(self.lo, self.hi), self.epoch, self.cfg)
        return gradient_sums(w, self.rows.x[lo:hi], self.rows.y[lo:hi], self.kept[lo - self.lo : hi - self.lo], self.weight)


BLOCKS = "block long, ids binary, label binary, x binary"
#: Rows whose kept units are hashed together.
KEPT_ROWS = 2048


def make_blocks(train: DataFrame, id_column: str, label: str, features: str, count: int, seed: int) -> DataFrame:
    digest = F.conv(F.substring(hash_key(seed, col(id_column)), 1, 13), 16, 10).cast("long")
    rows = train.select(digest.alias("id"), F.col(label).cast("int").alias("label"), vector_to_array(F.col(features)).alias("x"))

    def pack(key, table):
        table = table.sort_by([("id", "ascending")])
        x = table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        parts = [table.column("id").to_numpy().astype(np.uint64).tobytes(), table.column("label").to_numpy().astype(np.int8).tobytes(), x.tobytes()]
        return pa.table([pa.array([key[0].as_py()]), *(pa.array([p], pa.binary()) for p in parts)], names=[f.split()[0] for f in BLOCKS.split(", ")])

    return rows.withColumn("block", F.pmod(F.col("id"), F.lit(count))).groupBy("block").applyInArrow(pack, BLOCKS)


def take_steps(w: Weights, adam: Adam, sums, batches) -> tuple[Weights, list[float]]:
    """A step for each of the batches; ``sums(weights, batch)`` adds up one."""
    seen = []
    for b in batches:
        got = sums(w, b)
        if got[-1]:
            w = Weights(w.width, w.hidden, adam.step(w.vector, got[:-2] / got[-1]))
            seen.append(got[-2] / got[-1])
    return w, seen


def train_epochs(width: int, batches: int, cfg: NetworkConfig, sums) -> tuple[Weights, list[float]]:
    """All steps; ``sums(weights, epoch, batch)`` adds up one batch."""
    w = Weights.drawn(width, cfg.hidden, cfg.seed)
    adam, losses = Adam(len(w.vector), cfg.rate, cfg.decay), []
    for epoch in range(cfg.epochs):
        w, seen = take_steps(w, adam, lambda w, b, epoch=epoch: sums(w, epoch, b), range(batches))
        losses.append(float(np.mean(seen)))
    return w, losses


def by_batch(dealt: np.ndarray, batches: int) -> list[np.ndarray]:
    """The rows of each batch, in their order."""
    order = np.argsort(dealt, kind="stable")
    return np.split(order, np.searchsorted(dealt[order], np.arange(1, batches)))


def fit_in_block(blocks: DataFrame, width: int, batches: int, weight: float, cfg: NetworkConfig) -> tuple[np.ndarray, list[float]]:
    def run(parts):
        for part in parts:
            for row in part.to_pylist():
                rows, dealt = Rows(row, width), {}

                def sums(w, epoch, b, rows=rows, dealt=dealt):
                    if epoch not in dealt:
                        dealt.clear()
                        dealt[epoch] = Dealt(rows, rows.batches(epoch, batches, cfg), batches, epoch, weight, cfg)
                    return dealt[epoch].sums(w, b)

                w, losses = train_epochs(width, batches, cfg, sums)
                yield pa.RecordBatch.from_arrays([pa.array([w.vector]), pa.array([losses])], names=["vector", "losses"])

    r = blocks.mapInArrow(run, "vector array<double>, losses array<double>").first()
    return np.array(r["vector"]), list(r["losses"])


def fit_by_turns(blocks: DataFrame, width: int, batches: int, weight: float, cfg: NetworkConfig) -> tuple[np.ndarray, list[float]]:
    """A shuffle an epoch, that deals the rows of ``long`` batches to a turn, and a
    job a turn, which is plain RDD work and needs no planning."""
    held = blocks.rdd.map(lambda r: r.asDict()).persist(StorageLevel.MEMORY_AND_DISK)
    spark, count = blocks.sparkSession, max(1, held.count())
    long = -(-batches // count)
    turns = -(-batches // long)
    w = Weights.drawn(width, cfg.hidden, cfg.seed)
    adam, losses = Adam(len(w.vector), cfg.rate, cfg.decay), []
    for epoch in range(cfg.epochs):

        def deal(row: dict, epoch=epoch):
            rows = Rows(row, width)
            turn = rows.batches(epoch, batches, cfg) // long
            for t, at in enumerate(by_batch(turn, turns)):
                if len(at):
                    yield t, {"ids": rows.ids[at].tobytes(), "label": rows.y[at].astype(np.int8).tobytes(), "x": rows.x[at].tobytes()}

        dealt, seen = held.flatMap(deal).partitionBy(turns, int).values(), []
        for t in range(turns):

            def run(parts, epoch=epoch, t=t, vector=w.vector, adam=adam):
                rows = joined(list(parts), width)
                if rows is None:
                    return
                at = Dealt(rows, rows.batches(epoch, batches, cfg) - t * long, long, epoch, weight, cfg)
                w, seen = take_steps(Weights(width, cfg.hidden, vector), adam, at.sums, range(long))
                yield w.vector, adam, seen

            for vector, adam, losses_of_turn in spark.sparkContext.runJob(dealt, run, [t]):
                w = Weights(width, cfg.hidden, vector)
                seen += losses_of_turn
        losses.append(float(np.mean(seen)))
    held.unpersist()
    return w.vector, losses


def joined(parts: list[dict], width: int) -> Rows | None:
    """The pieces of a turn as one block, by id as in any block."""
    if not parts:
        return None
    rows = Rows({k: b"".join(p[k] for p in parts) for k in ("ids", "label", "x")}, width)
    order = np.argsort(rows.ids, kind="stable")  # pieces come in any order, and equal ids in one piece
    rows.ids, rows.y, rows.x = rows.ids[order], rows.y[order], rows.x[order]
    return rows


def fit_over_blocks(blocks: DataFrame, width: int, batches: int, weight: float, cfg: NetworkConfig) -> tuple[np.ndarray, list[float]]:
    held = blocks.persist(StorageLevel.MEMORY_AND_DISK)

    def sums(w, epoch, b):
        vector = w.vector

        def run(parts):
            for part in parts:
                for row in part.to_pylist():
                    rows = Rows(row, width)
                    at = np.flatnonzero(rows.batches(epoch, batches, cfg) == b)
                    got = rows.sums(Weights(width, cfg.hidden, vector), at, epoch, weight, cfg)
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(got))), pa.array(got)], names=["at", "value"])

        out = np.zeros(len(vector) + 2)
        for r in held.mapInArrow(run, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).collect():
            out[r["at"]] = r["value"]
        return out

    w, losses = train_epochs(width, batches, cfg, sums)
    held.unpersist()
    return w.vector, losses


class NetworkModel(Model, HasFeaturesCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the class-1 probability; dropout is for training only."""

    weights = Param(Params._dummy(), "weights", "all parameters as JSON", typeConverter=TypeConverters.toString)
    width = Param(Params._dummy(), "width", "inputs", typeConverter=TypeConverters.toInt)
    hidden = Param(Params._dummy(), "hidden", "units", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, weights: str = "[]", width: int = 0, hidden: int = 0, featuresCol: str = FEATURES_COL, outputCol: str = "score"):
        super().__init__()
        self._setDefault(featuresCol=FEATURES_COL, outputCol="score")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        import pandas as pd

        w = Weights(self.getOrDefault("width"), self.getOrDefault("hidden"), np.array(json.loads(self.getOrDefault("weights"))))

        def probability(x):
            return pd.Series(1.0 / (1.0 + np.exp(-w.log_odds(np.stack(x.to_numpy())))) if len(x) else np.zeros(0))

        return dataset.withColumn(self.getOutputCol(), F.pandas_udf(probability, "double")(vector_to_array(F.col(self.getFeaturesCol()))))


def fit_network(train: DataFrame, id_column: str, weight: float, cfg: NetworkConfig, label: str = "label", features: str = FEATURES_COL) -> tuple[NetworkModel, list[float]]:
    """The model, and the mean training loss of each epoch."""
    if cfg.epochs < 1:
        raise ValueError("epochs must be positive")
    n, width = train.agg(F.count(F.lit(1)), F.max(F.size(vector_to_array(F.col(features))))).first()
    count = max(1, -(-n // cfg.block_rows))
    blocks = make_blocks(train, id_column, label, features, count, cfg.seed)
    fit = fit_in_block if count == 1 else fit_by_turns if count <= cfg.most_turns else fit_over_blocks
    vector, losses = fit(blocks, width, max(1, -(-n // cfg.batch)), weight, cfg)
    return NetworkModel(weights=json.dumps(vector.tolist()), width=width, hidden=cfg.hidden), losses
