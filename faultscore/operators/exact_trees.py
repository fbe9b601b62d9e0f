"""Classification trees with exact cuts: one tree (F3) or a forest.

Rows carry a tree number, a multiplicity and a path (the sides taken from the
root).  Nodes of more than ``finish_rows`` rows are split level by level: one
groupBy to the distinct values of (node, column), running class counts over them
by range (``prefix_sums``), the Gini gain of every cut row by row, and the best
cut of each node as an aggregation; no cut is left out and nothing is binned.
Nodes that are small enough are grown to the end, each in a task of its own with
the same rule, all nodes of a level at once.  Trees are a table and never pass
the driver.

Counts are whole numbers and class weights are applied to the finished counts,
so neither the layout nor the order of the rows changes a tree.  Ties go to the
first column, then to the lowest cut; a cut lies half way between two values.
Where a node may see a part of the columns only (forest), these come in the
order of md5(seed:tree:path:column), columns with one value in the node do not
count, and the search goes on behind the part until some cut is valid.

A forest's trees draw every row a Poisson(1) number of times, by a hash of (seed,
tree, id), and weigh the classes by their numbers in the tree's own draw.  Where
a tree's draw is small enough for one task, the rows go out once for a group of
trees and not once a tree: the group's task draws and grows one after another.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import col
from ..functions.hashes import md5_heads
from ..session import ensure_checkpoint_dir
from .ensembles import NODE_COLUMNS, NODE_SCHEMA, TreeEnsembleModel
from .prefix_sums import prefix_sums

#: Tasks that grow trees at most (each takes one group after another).
MOST_TASKS = 8192
#: Groups of a drawn forest for each core: few enough that the rows seldom go out,
#: enough that cores which are free later still find one.
CORE_GROUPS = 4
#: Draws that are counted in doubles together with those of class 1.
MOST_SUM = 1 << 26
#: Bits of a sum of draws where those of class 1 and the rows stand in the same double.
TIMES_BITS = 18
#: Rows of nodes that are grown together, few enough to stay in a core's cache.
TOGETHER = 131_072
#: Draws of a row beyond which Poisson(1) has no mass that 52 bits can tell.
MOST_DRAWS = 17


@dataclass(frozen=True)
class TreeConfig:
    max_depth: int | None = None
    min_rows: int = 1
    columns: int | None = None  # that a node may see; None for all
    seed: int = 42
    finish_rows: int = 262_144


def poisson_steps() -> list[float]:
    """Cumulated Poisson(1) probabilities of 0, 1, ... draws."""
    return np.cumsum([math.exp(-1) / math.factorial(k) for k in range(MOST_DRAWS + 1)]).tolist()


def draw_steps() -> list[int]:
    """The least 13-digit hexadecimal numbers that give 1, 2, ... draws."""
    return [c for c in (math.ceil(s * 2.0**52) for s in poisson_steps()) if c < 1 << 52]


def draws(seed: int, tree: Column, id_column: Column) -> Column:
    """How often a tree draws a row."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), tree.cast("string"), F.lit(":"), id_column.cast("string")))
    unit, out = F.substring(digest, 1, 13), None
    for k, step in enumerate(draw_steps()):  # digits of one length stand in the order of their numbers
        small = unit < F.lit(f"{step:013x}")
        out = F.when(small, F.lit(k)) if out is None else out.when(small, F.lit(k))
    return out.when(unit.isNotNull(), F.lit(len(draw_steps())))


class Ids:
    """Ids' text by length, to be hashed for one tree after another."""

    def __init__(self, ids: list[bytes]):
        self.hold(np.array([len(i) for i in ids], dtype=np.int64), np.frombuffer(b"".join(ids), dtype=np.uint8))

    @classmethod
    def of(cls, lengths: np.ndarray, text: np.ndarray) -> Ids:
        """Of ids that stand one behind the other."""
        out = object.__new__(cls)
        out.hold(lengths, text)
        return out

    def hold(self, lengths: np.ndarray, text: np.ndarray) -> None:
        self.n, self.parts = len(lengths), []
        starts = np.cumsum(lengths, dtype=np.int64) - lengths
        for length in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == length)
            found = np.empty((len(at), length), dtype=np.uint8)
            for lo in range(0, len(at), TOGETHER):  # places take eight times the text
                found[lo : lo + TOGETHER] = text[starts[at[lo : lo + TOGETHER]][:, None] + np.arange(length)]
            self.parts.append((at, found))


def drawn_times(seed: int, tree: int, ids: Ids | list[bytes]) -> np.ndarray:
    """``draws`` of one tree, from the ids' text."""
    ids = ids if isinstance(ids, Ids) else Ids(ids)
    head, steps, out = f"{seed}:{tree}:".encode(), np.array(draw_steps(), dtype=np.uint64), np.zeros(ids.n, dtype=np.uint8)
    for at, text in ids.parts:
        for lo in range(0, len(at), TOGETHER):
            units = md5_heads(head, text[lo : lo + TOGETHER]) >> np.uint64(12)
            out[at[lo : lo + TOGETHER]] = np.searchsorted(steps, units, side="right")
    return out


def training_table(train: DataFrame, id_column: str, label: str, features: str) -> DataFrame:
    return train.select(col(id_column).alias("id"), F.col(label).cast("int").alias("y"), vector_to_array(F.col(features)).alias("x"))


def bootstrap(rows: DataFrame, trees: int, seed: int) -> DataFrame:
    """(tree, id, y, x, m): each tree's drawn rows with their multiplicity."""
    dealt = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "id")
    each = dealt.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    return each.withColumn("m", draws(seed, F.col("tree"), F.col("id"))).where("m > 0").select("tree", "id", "y", "x", "m")


def class_weights(rows: DataFrame, *more: Column) -> DataFrame:
    """(tree, n, n1, w0, w1): n / (2 n_class) of each tree's own draw; 0 for no
    rows.  Further sums of a tree's draw come from the same pass."""
    counts = rows.groupBy("tree").agg(F.sum(F.col("m").cast("long")).alias("n"), F.sum((F.col("m") * F.col("y")).cast("long")).alias("n1"), *more)
    weight = lambda c: F.when(c == 0, F.lit(0.0)).otherwise(F.col("n").cast("double") / (F.lit(2.0) * c.cast("double")))
    named = ("tree", "n", "n1")
    return counts.select(*named, weight(F.col("n") - F.col("n1")).alias("w0"), weight(F.col("n1")).alias("w1"), *[c for c in counts.columns if c not in named])


@lru_cache(maxsize=8)
def column_texts(width: int) -> list[bytes]:
    return [str(f).encode() for f in range(width)]


def column_order(seed: int, tree: int, path: str, width: int) -> list[int]:
    head, md5 = f"{seed}:{tree}:{path}:".encode(), hashlib.md5
    return sorted(range(width), key=[md5(head + f).digest() for f in column_texts(width)].__getitem__)


def purity(a: np.ndarray, b: np.ndarray, w0: float, w1: float) -> np.ndarray:
    """Of a side with a rows of class 0 and b of class 1; larger is purer."""
    x, y = w0 * a, w1 * b
    return (x * x + y * y) / (x + y)


class Ranked:
    """A matrix as the ranks of its values by column, and the values."""

    def __init__(self, x: np.ndarray):
        found = [np.unique(x[:, f], return_inverse=True) for f in range(x.shape[1])]
        self.hold([r.reshape(-1) for _, r in found], [v for v, _ in found])

    @classmethod
    def of(cls, ranks: list[np.ndarray], values: list[np.ndarray]) -> Ranked:
        """Of ranks that are known, and each column's values."""
        out = object.__new__(cls)
        out.hold(ranks, values)
        return out

    def hold(self, ranks: list[np.ndarray], values: list[np.ndarray]) -> None:
        sizes = [len(v) for v in values]
        self.ranks = np.empty((len(ranks), len(ranks[0])), dtype=np.min_scalar_type(max(0, *sizes) - 1) if max(0, *sizes) > 1 else np.uint8)
        for f, r in enumerate(ranks):
            self.ranks[f] = r
        self.values, self.first = np.concatenate(values), np.cumsum([0, *sizes[:-1]])
        self.bits, self.sizes = max(sizes).bit_length(), np.array(sizes)

    def part(self, rows: np.ndarray) -> Ranked:
        out = object.__new__(Ranked)
        out.ranks, out.values, out.first, out.bits, out.sizes = self.ranks.take(rows, axis=1), self.values, self.first, self.bits, self.sizes
        return out


def sums_of(drawn: np.ndarray, few: int, m_bits: int) -> np.ndarray:
    """Draws, those of class 1 and (if the draws are so few that one double holds all
    sums of them) a row, as one number each."""
    codes = np.arange(2 << m_bits)
    times, ones = codes >> 1, (codes >> 1) * (codes & 1)
    both = times + (ones << TIMES_BITS) + (1 << 2 * TIMES_BITS) if few == 2 else times + ones * MOST_SUM
    return both.astype(np.float64).take(drawn)


def distinct_values(x: Ranked, f: np.ndarray, sizes: np.ndarray, r: np.ndarray, s: np.ndarray, drawn: np.ndarray, weights: np.ndarray | None, m_bits: int, few: int) -> tuple[np.ndarray, ...]:
    """(node, rank, draws, draws of class 1, rows) of each distinct value that a node
    has in its column ``f``, by node and rank.  ``s`` is the node of each of the rows
    ``r``, ``drawn`` a row's draws and class, ``weights`` the same as ``sums_of`` has
    them.  Where all values of the columns are not many more than the rows they are
    counted, else sorted; ``few`` is 0 for draws too many to be counted."""
    ends = np.cumsum(sizes)
    one = len(f) == 1  # one node: its column as it lies
    if one:
        ranks = x.ranks[f[0]].take(r)
    else:
        at = (f * x.ranks.shape[1]).take(s)
        at += r
        ranks = x.ranks.reshape(-1).take(at)
    if few and ends[-1] <= 4 * len(r):
        place = ranks
        if not one:
            place = (ends - sizes).take(s)
            place += ranks
        sums = np.bincount(place, weights=weights, minlength=ends[-1])
        if few == 2:
            at = np.flatnonzero(sums)
            sums, low = sums[at].astype(np.int64), (1 << TIMES_BITS) - 1
            found = sums & low, sums >> TIMES_BITS & low, sums >> 2 * TIMES_BITS
        else:
            size = np.bincount(place, minlength=ends[-1])
            at = np.flatnonzero(size)
            sums = sums[at].astype(np.int64)
            found = sums % MOST_SUM, sums // MOST_SUM, size[at]
        if one:
            return np.zeros(len(at), dtype=np.int64), at, *found
        node = np.searchsorted(ends, at, side="right")
        return node, at - (ends - sizes)[node], *found
    # node, rank, draws and class in one number: a sort of these is all that moves
    key = ((s << x.bits | ranks) << m_bits) | drawn
    key.sort()
    value = key >> m_bits
    times = (key & ((1 << m_bits) - 1)) >> 1
    at = np.append(0, np.flatnonzero(value[1:] != value[:-1]) + 1)
    first = value[at]
    return first >> x.bits, first & ((1 << x.bits) - 1), np.add.reduceat(times, at), np.add.reduceat(times * (key & 1), at), np.diff(np.append(at, len(key)))


def level_cuts(x: Ranked, y: np.ndarray, m: np.ndarray, rows: np.ndarray, slot: np.ndarray, w0: float, w1: float, cfg: TreeConfig, orders: np.ndarray, constant: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(column, rank of the last value that goes left, cut) of each node, column
    -1 for none, and the (draws, draws of class 1, rows) that go left.  ``slot`` is the
    node of each of the rows; a node looks at its columns in the order of its line in
    ``orders``.  Columns known to be ``constant`` in a node (a line a node) are passed
    over there, and those found so are noted."""
    count, width = orders.shape
    constant = np.zeros((count, width), dtype=bool) if constant is None else constant
    feature, low = np.full(count, -1), np.zeros(count, dtype=np.int64)
    cut, top, seen = np.zeros(count), np.full(count, -np.inf), np.zeros(count, dtype=np.int64)
    gone = np.zeros((count, 3), dtype=np.int64)
    m_bits, draws = int(m.max()).bit_length() + 1, int(m.sum(dtype=np.int64))
    few = 0 if draws >= MOST_SUM else 1 + (draws < 1 << TIMES_BITS and len(rows) < 1 << 53 - 2 * TIMES_BITS)
    drawn = ((m << 1) | y).take(rows)
    weights = sums_of(drawn, few, m_bits) if few else None
    known = np.take_along_axis(constant, orders, axis=1)
    if known.any():
        orders = np.take_along_axis(orders, np.argsort(known, axis=1, kind="stable"), axis=1)  # known ones last
    going = width - known.sum(axis=1)
    size_of = np.bincount(slot, minlength=count)

    def look(wanted: np.ndarray, f: np.ndarray) -> None:
        r, s, d, w = rows, slot, drawn, weights
        if not wanted.all():
            held = np.flatnonzero(wanted.take(slot))
            r, s, d, w = rows.take(held), slot.take(held), drawn.take(held), None if weights is None else weights.take(held)
        node, rank, times, ones, size = distinct_values(x, f, np.where(wanted, x.sizes.take(f), 0), r, s, d, w, m_bits, few)
        total, ones, size = np.cumsum(times), np.cumsum(ones), np.cumsum(size)
        inside = node[1:] == node[:-1]
        ends = np.append(np.flatnonzero(~inside), len(node) - 1)
        starts = np.append(0, ends[:-1] + 1)
        nodes, cuts = node[ends], ends - starts
        seen[nodes] += cuts > 0
        constant[nodes, f[nodes]] = cuts == 0
        at = np.flatnonzero(inside)
        if not len(at):
            return
        i = np.repeat(np.arange(len(nodes)), cuts)
        whole, whole1, all_rows = total[ends], ones[ends], size[ends]
        before, before1, before_rows = (np.append(0, c[:-1]) for c in (whole, whole1, all_rows))
        if cfg.min_rows > 1:
            here = size[at]
            valid = (here >= (before_rows + cfg.min_rows)[i]) & (here <= (all_rows - cfg.min_rows)[i])
            at, i = at[valid], i[valid]
            if not len(at):
                return
        left, left1 = total[at] - before[i], ones[at] - before1[i]
        right, right1 = (whole - before)[i] - left, (whole1 - before1)[i] - left1
        gain = purity(left - left1, left1, w0, w1) + purity(right - right1, right1, w0, w1)
        groups = np.flatnonzero(np.append(True, i[1:] != i[:-1]))
        most = np.maximum.reduceat(gain, groups)
        hit = np.flatnonzero(gain == np.repeat(most, np.diff(np.append(groups, len(at)))))
        of = i[hit]
        hit = hit[np.append(True, of[1:] != of[:-1])]  # the lowest of equal cuts
        n = nodes[i[hit]]
        better = (feature[n] < 0) | (gain[hit] > top[n]) | ((gain[hit] == top[n]) & (f[n] < feature[n]))
        n, hit = n[better], hit[better]
        top[n], feature[n] = gain[hit], f[n]
        low[n] = rank[at[hit]]
        gone[n] = np.stack([left[hit], left1[hit], size[at[hit]] - before_rows[i[hit]]], axis=1)
        a, b = x.values[x.first[f[n]] + low[n]], x.values[x.first[f[n]] + rank[at[hit] + 1]]
        middle = (a + b) / 2.0
        cut[n] = np.where(middle >= b, a, middle)

    for k, f in enumerate(orders.T):
        wanted = going > k
        if cfg.columns is not None:
            wanted &= (seen < cfg.columns) | (feature < 0)
        if not wanted.any():
            break
        sizes = x.sizes.take(f)
        if sizes[wanted].sum() <= 4 * size_of[wanted].sum():
            look(wanted, f)
            continue
        # nodes of fewer rows than their column has values are sorted, apart from the others
        scarce = sizes > 4 * size_of
        for part in (wanted & ~scarce, wanted & scarce):
            if part.any():
                look(part, f)
    return feature, low, cut, gone


def best_cut(x: np.ndarray, y: np.ndarray, m: np.ndarray, w0: float, w1: float, cfg: TreeConfig, order: list[int]):
    """(column, cut) of a node's rows, or None."""
    feature, _, cut, _ = level_cuts(Ranked(x), y, m, np.arange(len(y)), np.zeros(len(y), dtype=np.int64), w0, w1, cfg, np.array([order]))
    return None if feature[0] < 0 else (int(feature[0]), float(cut[0]))


@dataclass
class Open:
    """Nodes that are still to be split: numbers, paths, known constant columns and
    (draws, draws of class 1, rows), a line a node, and their rows with the node that
    each is in."""

    number: np.ndarray
    paths: list[str]
    constant: np.ndarray
    sums: np.ndarray
    rows: np.ndarray
    slot: np.ndarray

    def one(self, k: int, rows: np.ndarray) -> Open:
        return Open(self.number[k : k + 1], [self.paths[k]], self.constant[k : k + 1], self.sums[k : k + 1], rows, np.zeros(len(rows), dtype=np.int64))


class Grown:
    """The nodes of a tree while it grows, children numbered in pairs as they come."""

    def __init__(self):
        self.parts, self.count = [], 1

    def note(self, number: np.ndarray, feature: np.ndarray, threshold: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The numbers of the first children of the nodes that have a column."""
        split = feature >= 0
        left = np.full(len(number), -1)
        left[split] = self.count + 2 * np.arange(np.count_nonzero(split))
        self.count += 2 * np.count_nonzero(split)
        self.parts.append((number, feature, threshold, left, value))
        return left[split]

    def leaves(self, number: np.ndarray, sums: np.ndarray, w0: float, w1: float) -> None:
        self.note(number, np.full(len(number), -1), np.zeros(len(number)), leaf_value(sums, w0, w1))

    def columns(self, tree: int) -> list[np.ndarray]:
        """The NODE columns, numbers from 0 level by level."""
        number, *rest = (np.concatenate(c) for c in zip(*self.parts))
        feature, threshold, left, value = (c[np.argsort(number)] for c in rest)
        level, levels = np.zeros(1, dtype=np.int64), []
        while len(level):
            levels.append(level)
            first = left[level]
            first = first[first >= 0]
            level = np.stack([first, first + 1], axis=1).reshape(-1)
        order = np.concatenate(levels)
        place = np.empty(self.count, dtype=np.int64)
        place[order] = np.arange(self.count)
        feature, threshold, left, value = feature[order], threshold[order], left[order], value[order]
        inner = left >= 0
        left = np.where(inner, place[left], -1)
        return [np.full(self.count, tree), np.arange(self.count), feature, threshold, left, np.where(inner, left + 1, -1), value]


def leaf_value(sums: np.ndarray, w0: float, w1: float) -> np.ndarray:
    n, n1 = sums[:, 0], sums[:, 1].astype(np.float64)
    return w1 * n1 / (w0 * (n - n1) + w1 * n1)


def splittable(sums: np.ndarray, depth: np.ndarray, cfg: TreeConfig) -> np.ndarray:
    """Whether nodes hold both classes and rows enough, and are not too deep."""
    n, n1, size = sums.T
    out = (n1 > 0) & (n1 < n) & (size >= 2 * cfg.min_rows)
    return out if cfg.max_depth is None else out & (depth < cfg.max_depth)


def grow_level(x: Ranked, y: np.ndarray, m: np.ndarray, nodes: Open, tree: int, w0: float, w1: float, cfg: TreeConfig, grown: Grown) -> Open:
    """Splits all that can be; what comes back are the children that may be split."""
    rows, slot, width = nodes.rows, nodes.slot, len(x.ranks)
    orders = np.array([range(width) if cfg.columns is None else column_order(cfg.seed, tree, p, width) for p in nodes.paths])
    feature, low, cut, gone = level_cuts(x, y, m, rows, slot, w0, w1, cfg, orders, nodes.constant)
    split = np.flatnonzero(feature >= 0)
    value = leaf_value(nodes.sums, w0, w1)
    value[split] = 0.0
    first = grown.note(nodes.number, feature, np.where(feature >= 0, cut, 0.0), value)
    # both children of a split node, one behind the other
    number = np.stack([first, first + 1], axis=1).reshape(-1)
    sums = np.stack([gone[split], nodes.sums[split] - gone[split]], axis=1).reshape(-1, 3)
    depth = np.repeat([len(nodes.paths[i]) + 1 for i in split.tolist()], 2)
    alive = splittable(sums, depth, cfg)
    grown.leaves(number[~alive], sums[~alive], w0, w1)
    open_nodes = np.flatnonzero(alive)
    none = np.zeros(0, dtype=np.int64)
    if not len(open_nodes):
        return Open(none, [], nodes.constant[:0], sums[:0], none, none)
    # the number of each node's two sides among the open children
    place = np.full(2 * len(feature), -1)
    place[(2 * split[:, None] + [0, 1]).reshape(-1)[alive]] = np.arange(len(open_nodes))
    if len(feature) == 1:
        side = x.ranks[feature[0]].take(rows) > low[0]
        child = place.take(side)
    else:
        at = (np.maximum(feature, 0) * x.ranks.shape[1]).take(slot)
        at += rows
        child = 2 * slot
        child += x.ranks.reshape(-1).take(at) > low.take(slot)
        child = place.take(child)
    if not (len(split) == len(feature) and alive.all()):
        held = np.flatnonzero(child >= 0)
        rows, child = rows.take(held), child.take(held)
    parents = split[open_nodes >> 1]
    paths = [nodes.paths[i] + "01"[k & 1] for i, k in zip(parents.tolist(), open_nodes.tolist())]
    return Open(number[alive], paths, nodes.constant[parents], sums[alive], rows, child)


def grow_subtree(x: Ranked, y: np.ndarray, m: np.ndarray, tree: int, path: str, w0: float, w1: float, cfg: TreeConfig) -> list[np.ndarray]:
    """The NODE columns (numbers from 0, level by level) of a tree grown until
    nothing splits.  Nodes of many rows are split one by one; smaller ones wait
    until they fill a core's cache and are grown to the end together."""
    grown, few, large = Grown(), [], []
    times = np.bincount(y, m, 2)
    whole = Open(np.zeros(1, dtype=np.int64), [path], np.zeros((1, len(x.ranks)), dtype=bool), np.array([[times.sum(), times[1], len(y)]], dtype=np.int64), np.arange(len(y)), np.zeros(len(y), dtype=np.int64))
    if splittable(whole.sums, np.array([len(path)]), cfg).all():
        large.append(whole)
    else:
        grown.leaves(whole.number, whole.sums, w0, w1)

    def finish_few() -> None:
        rows = np.concatenate([nodes.rows for nodes in few])
        slot = np.repeat(np.arange(len(few)), [len(nodes.rows) for nodes in few])
        joined = [np.concatenate([getattr(nodes, c) for nodes in few]) for c in ("number", "constant", "sums")]
        here = Open(joined[0], [nodes.paths[0] for nodes in few], *joined[1:], np.arange(len(rows)), slot)
        part, y_part, m_part = x.part(rows), y.take(rows), m.take(rows)
        few.clear()
        while here.paths:
            here = grow_level(part, y_part, m_part, here, tree, w0, w1, cfg, grown)

    while large:
        nodes = large.pop()
        if len(nodes.rows) <= TOGETHER:
            if sum(len(other.rows) for other in few) + len(nodes.rows) > TOGETHER:
                finish_few()
            few.append(nodes)
            continue
        below = grow_level(x, y, m, nodes, tree, w0, w1, cfg, grown)
        large += [below.one(k, below.rows[below.slot == k]) for k in range(len(below.paths))]
    if few:
        finish_few()
    return grown.columns(tree)


NODE_TYPES = (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.float64())


GROWN = "path string, " + NODE_SCHEMA


def finish(rows: DataFrame, weights: DataFrame, cfg: TreeConfig) -> DataFrame:
    """Every (tree, path) group of rows grown to the end in a task of its own."""
    held = rows.join(F.broadcast(weights.select("tree", "w0", "w1")), "tree").select("tree", "path", "id", "y", "x", "m", "w0", "w1")  # a row a tree
    # a number of tasks that goes with the groups, for small ones are long work too
    groups = rows.select("tree", "path").distinct().count()
    held = held.repartition(max(1, min(MOST_TASKS, groups)), "tree", "path")

    def grow(table):
        table = table.sort_by([("id", "ascending")])
        x = table.column("x").combine_chunks()
        matrix = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
        y, m = (table.column(c).to_numpy().astype(np.int64) for c in ("y", "m"))
        tree, path, w0, w1 = (table.column(c)[0].as_py() for c in ("tree", "path", "w0", "w1"))
        nodes = grow_subtree(Ranked(matrix), y, m, tree, path, w0, w1, cfg)
        return pa.table([pa.array([path] * len(nodes[0])), *(pa.array(c).cast(t) for c, t in zip(nodes, NODE_TYPES))], names=["path", *NODE_COLUMNS])

    return held.groupBy("tree", "path").applyInArrow(grow, GROWN)


def splits_of(rows: DataFrame, weights: DataFrame, cfg: TreeConfig) -> DataFrame:
    """(tree, path, feature, threshold) of the nodes that split."""
    values = rows.select("tree", "path", F.posexplode("x").alias("f", "v"), "y", "m")
    table = values.groupBy("tree", "path", "f", F.col("v") + F.lit(0.0)).agg(F.sum(F.col("m").cast("long")).alias("c"), F.sum((F.col("m") * F.col("y")).cast("long")).alias("c1"), F.count(F.lit(1)).alias("r"))
    table = table.toDF("tree", "path", "f", "v", "c", "c1", "r")
    summed = prefix_sums(table, ["tree", "path", "f"], "v", ["c", "c1", "r"]).join(F.broadcast(weights.select("tree", "w0", "w1")), "tree")

    def pure(total: Column, ones: Column) -> Column:
        x, y = F.col("w0") * (total - ones).cast("double"), F.col("w1") * ones.cast("double")
        return F.try_divide(x * x + y * y, x + y)

    right, right1 = F.col("c_all") - F.col("c_upto"), F.col("c1_all") - F.col("c1_upto")
    x, y = F.col("w0") * ((F.col("c_all") - F.col("c1_all")) - (F.col("c_upto") - F.col("c1_upto"))).cast("double"), F.col("w1") * right1.cast("double")
    gain = pure(F.col("c_upto"), F.col("c1_upto")) + F.try_divide(x * x + y * y, x + y)
    valid = (F.col("r_upto") >= cfg.min_rows) & (F.col("r_all") - F.col("r_upto") >= cfg.min_rows) & (right > 0)
    cuts = summed.withColumn("gain", F.when(valid, gain)).where((F.col("c1_all") > 0) & (F.col("c1_all") < F.col("c_all")))
    # per column its best cut (the lowest of equal ones), if it has several values
    best = cuts.groupBy("tree", "path", "f").agg(F.max(F.struct("gain", (-F.col("v")).alias("low"))).alias("b"), F.count(F.lit(1)).alias("values")).where("values > 1")
    digest = F.md5(F.concat_ws(":", F.lit(str(cfg.seed)), F.col("tree").cast("string"), "path", F.col("f").cast("string")))
    node = Window.partitionBy("tree", "path")  # a row a column
    best = best.withColumn("place", F.row_number().over(node.orderBy(digest)) if cfg.columns is not None else F.lit(0)).where("b.gain IS NOT NULL")
    inside = F.col("place") <= F.lit(cfg.columns or 0)
    choice = node.orderBy(F.when(inside, 0).otherwise(F.col("place")), F.desc("b.gain"), "f")
    chosen = best.withColumn("_n", F.row_number().over(choice)).where("_n = 1").select("tree", "path", "f", (-F.col("b.low")).alias("low"))
    above = table.join(chosen, ["tree", "path", "f"]).where(F.col("v") > F.col("low")).groupBy("tree", "path", "f", "low").agg(F.min("v").alias("high"))
    middle = (F.col("low") + F.col("high")) / F.lit(2.0)
    return above.select("tree", "path", F.col("f").alias("feature"), F.when(middle >= F.col("high"), F.col("low")).otherwise(middle).alias("threshold"))


def stored(df: DataFrame, label: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def grow_trees(rows: DataFrame, weights: DataFrame, cfg: TreeConfig) -> DataFrame:
    """The node table of all trees; rows are (tree, id, y, x, m)."""
    open_rows, split, finished = rows.withColumn("path", F.lit("")), [], []
    for depth in range(cfg.max_depth if cfg.max_depth is not None else 1 << 30):
        sizes = open_rows.groupBy("tree", "path").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > cfg.finish_rows)
        if sizes.isEmpty():
            break
        sizes = stored(sizes, "large-nodes")
        large = open_rows.join(sizes.select("tree", "path"), ["tree", "path"])
        finished.append(open_rows.join(sizes.select("tree", "path"), ["tree", "path"], "left_anti"))
        found = stored(splits_of(large, weights, cfg), "splits")
        split.append(found)
        going = large.join(found, ["tree", "path"], "left")
        finished.append(going.where("feature IS NULL").select(*open_rows.columns))  # leaves
        side = F.when(F.get("x", F.col("feature")) <= F.col("threshold"), "0").otherwise("1")
        going = going.where("feature IS NOT NULL").withColumn("path", F.concat("path", side)).select(*open_rows.columns)
        open_rows = stored(going, "open-rows")
    finished.append(open_rows)
    if not split:
        return finish(open_rows, weights, cfg).select(*NODE_COLUMNS)
    parts = [leaf_or_subtree(part, weights, cfg) for part in finished]
    grown = parts[0]
    for part in parts[1:]:
        grown = grown.unionByName(part)
    grown = stored(grown, "subtrees")
    inner = split[0]
    for more in split[1:]:
        inner = inner.unionByName(more)
    return numbered(inner, grown)


def leaf_or_subtree(rows: DataFrame, weights: DataFrame, cfg: TreeConfig) -> DataFrame:
    """Small groups grown; a large one that did not split is a leaf."""
    held = rows.join(F.broadcast(weights.select("tree", "w0", "w1")), "tree")
    sums = held.groupBy("tree", "path").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("m").cast("long")).alias("n"), F.sum((F.col("m") * F.col("y")).cast("long")).alias("n1"), F.first("w0").alias("w0"), F.first("w1").alias("w1"))
    large = sums.where(F.col("rows") > cfg.finish_rows)
    ones = F.col("w1") * F.col("n1")
    value = ones / (F.col("w0") * (F.col("n") - F.col("n1")) + ones)
    i, d = (lambda x: F.lit(x).cast("int")), F.lit(0.0)
    leaves = large.select("path", "tree", i(0).alias("node"), i(-1).alias("feature"), d.alias("threshold"), i(-1).alias("left"), i(-1).alias("right"), value.alias("value"))
    small = rows.join(large.select("tree", "path"), ["tree", "path"], "left_anti")
    return finish(small, weights, cfg).unionByName(leaves)


def numbered(inner: DataFrame, grown: DataFrame) -> DataFrame:
    """Inner nodes and subtrees of each tree under numbers that start at its root."""
    sizes = inner.select("tree", "path", F.lit(1).alias("size")).unionByName(grown.groupBy("tree", "path").agg(F.count(F.lit(1)).cast("int").alias("size")))
    order = Window.partitionBy("tree").orderBy(F.length("path"), "path").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("tree", "path", F.coalesce(F.sum("size").over(order), F.lit(0)).cast("int").alias("first"))
    below = grown.join(first, ["tree", "path"]).select(
        "tree", (F.col("node") + F.col("first")).alias("node"), "feature", "threshold",
        F.when(F.col("left") >= 0, F.col("left") + F.col("first")).otherwise(-1).alias("left"), F.when(F.col("right") >= 0, F.col("right") + F.col("first")).otherwise(-1).alias("right"), "value",
    )
    child = lambda side: first.select("tree", F.expr("substring(path, 1, length(path) - 1)").alias("path"), F.col("first").alias(side), F.col("path").alias("_p")).where(F.col("_p").endswith("0" if side == "left" else "1")).drop("_p")
    above = inner.join(first, ["tree", "path"]).join(child("left"), ["tree", "path"]).join(child("right"), ["tree", "path"])
    above = above.select("tree", F.col("first").alias("node"), "feature", "threshold", "left", "right", F.lit(0.0).alias("value"))
    return above.unionByName(below).select(*[F.col(c).cast(t) for c, t in (f.split() for f in NODE_SCHEMA.split(", "))])


def fit_tree(train: DataFrame, id_column: str, cfg: TreeConfig, label: str = "label", features: str = "features") -> TreeEnsembleModel:
    """One tree over all rows, classes weighted alike."""
    table = training_table(train, id_column, label, features)
    if table.count() <= cfg.finish_rows:
        return TreeEnsembleModel(trees=1, link="mean").with_nodes(stored(grow_whole(table, cfg), "tree"))
    rows = table.withColumns({"tree": F.lit(0), "m": F.lit(1)}).select("tree", "id", "y", "x", "m")
    nodes = stored(grow_trees(rows, class_weights(rows), cfg), "tree")
    return TreeEnsembleModel(trees=1, link="mean").with_nodes(nodes)


#: A block's ids and labels (``feature`` -1), its ranks in a column, or (``block`` -1) a column's values.
PACKED = "feature int, block long, lengths binary, ids binary, y binary, data binary"


def packed_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in PACKED.split(", ")]
    types = [pa.int32(), pa.int64(), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def packed(rows: DataFrame) -> DataFrame:
    """Training rows in blocks: a table row for each one's ids and labels, and one for
    its ranks in each column, a column's values being ranked in one task."""
    def pack(batches):
        part, count = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            if batch.num_rows:
                ids = batch.column("id").cast(pa.binary())
                lengths, text = pc.binary_length(ids).to_numpy(zero_copy_only=False), b"".join(ids.to_pylist())
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                y = batch.column("y").to_numpy(zero_copy_only=False).astype(np.int8)
                out = [(-1, part + count, lengths.astype(np.int32).tobytes(), text, y.tobytes(), None)]
                out += [(f, part + count, None, None, None, x[:, f].tobytes()) for f in range(x.shape[1])]
                yield packed_batch(out)
                count += 1

    def rank(batches):
        held: dict[int, dict[int, bytes]] = {}
        for batch in batches:
            for row in batch.select(["feature", "block", "data"]).to_pylist():
                held.setdefault(row["feature"], {})[row["block"]] = row["data"]
        for f, column in held.items():
            blocks = sorted(column)
            values, ranks = np.unique(np.concatenate([np.frombuffer(column[b], dtype=np.float64) for b in blocks]), return_inverse=True)
            ranks = ranks.reshape(-1).astype(np.min_scalar_type(max(1, len(values) - 1)))
            ends = np.cumsum([len(column[b]) // 8 for b in blocks])
            yield packed_batch([(f, -1, None, None, None, values.tobytes())])
            for b, lo, hi in zip(blocks, [0, *ends], ends):
                yield packed_batch([(f, b, None, None, None, ranks[lo:hi].tobytes())])

    # a row without an id is never drawn
    blocks = stored(rows.select(F.col("id").cast("string").alias("id"), "y", "x").where("id IS NOT NULL").mapInArrow(pack, PACKED), "packed")
    columns = blocks.where("feature >= 0")
    width = columns.agg(F.max("feature")).first()[0]
    if width is None:
        return blocks
    ranked = columns.repartitionById(min(width + 1, MOST_TASKS), F.pmod("feature", F.lit(min(width + 1, MOST_TASKS))).cast("int")).mapInArrow(rank, PACKED)
    return stored(blocks.where("feature < 0").unionByName(ranked), "ranked")


def unpacked(rows: list[dict]) -> tuple[Ids, np.ndarray, Ranked]:
    """(ids, y, x) of ``packed`` rows, which go as they are taken."""
    rows.sort(key=lambda r: (r["feature"], r["block"]))
    blocks = [r for r in rows if r["feature"] < 0]
    joined = lambda name, dtype: np.frombuffer(b"".join(b[name] for b in blocks), dtype=dtype)
    ids, y = Ids.of(joined("lengths", np.int32), joined("ids", np.uint8)), joined("y", np.int8)
    ranks, values = [], []
    for f in range(rows[-1]["feature"] + 1):
        column = [r["data"] for r in rows if r["feature"] == f]
        values.append(np.frombuffer(column[0], dtype=np.float64))
        ranks.append(np.frombuffer(b"".join(column[1:]), dtype=np.min_scalar_type(max(1, len(values[-1]) - 1))))
    rows.clear()
    return ids, y, Ranked.of(ranks, values)


def grown_batch(x: Ranked, y: np.ndarray, m: np.ndarray, tree: int, cfg: TreeConfig) -> pa.RecordBatch:
    """A tree's nodes, classes weighted by their draws."""
    n1, n = np.bincount(y, m, 2)[1], int(m.sum(dtype=np.int64))
    w0, w1 = (n / (2.0 * c) if c else 0.0 for c in (n - n1, n1))
    nodes = grow_subtree(x, y, m, tree, "", w0, w1, cfg)
    return pa.RecordBatch.from_arrays([pa.array(c).cast(t) for c, t in zip(nodes, NODE_TYPES)], names=list(NODE_COLUMNS))


def grow_whole(rows: DataFrame, cfg: TreeConfig) -> DataFrame:
    """The node table of a tree over all rows, once each, in a task."""

    def run(batches):
        held = [row for batch in batches for row in batch.to_pylist()]
        if held:
            _, y, x = unpacked(held)
            yield grown_batch(x, y, np.ones(len(y), dtype=np.uint8), 0, cfg)

    return packed(rows.withColumn("id", F.lit(""))).repartition(1).mapInArrow(run, NODE_SCHEMA)


def grow_drawn(rows: DataFrame, trees: int, cfg: TreeConfig) -> DataFrame:
    """The node table of a forest whose draws are small enough for a task each:
    a task takes the rows once and draws and grows the trees of its group."""
    spark = rows.sparkSession
    groups = min(trees, CORE_GROUPS * spark.sparkContext.defaultParallelism)
    blocks = packed(rows).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def run(batches):
        held, group = [], None
        for batch in batches:
            if batch.num_rows:
                group = batch.column("group")[0].as_py()
                held += batch.drop_columns(["group"]).to_pylist()
        if not held:
            return
        ids, y, x = unpacked(held)
        for tree in range(group, trees, groups):
            times = drawn_times(cfg.seed, tree, ids)
            at = np.flatnonzero(times)
            if len(at):
                yield grown_batch(x.part(at), y[at], times[at], tree, cfg)

    return blocks.repartitionById(groups, "group").mapInArrow(run, NODE_SCHEMA)


#: Share of the rows that a draw holds at least once.
DRAWN_SHARE = 1.0 - math.exp(-1)


def fit_forest(train: DataFrame, id_column: str, trees: int, cfg: TreeConfig, label: str = "label", features: str = "features") -> TreeEnsembleModel:
    """Trees over Poisson draws of the rows, classes weighted alike in each draw."""
    table = training_table(train, id_column, label, features)
    if table.count() * DRAWN_SHARE <= cfg.finish_rows:
        nodes = stored(grow_drawn(table, trees, cfg), "forest")
        return TreeEnsembleModel(trees=trees, link="mean").with_nodes(nodes)
    rows = stored(bootstrap(table, trees, cfg.seed), "bootstrap")
    nodes = stored(grow_trees(rows, stored(class_weights(rows), "weights"), cfg), "forest")
    return TreeEnsembleModel(trees=trees, link="mean").with_nodes(nodes)
