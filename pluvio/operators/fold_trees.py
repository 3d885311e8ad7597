"""Trees and forests of all folds and settings at once, node for node what Spark's own fits give.

A fit of Spark's reads its rows once a level, and each fold and setting is a fit of its own. Here a row is
stored once, as one number that holds its bins (the cuts of all folds and settings together) and its label; a level of
all trees is one pass over these rows, whose class counts are summed and split where they lie, so that only
chosen splits reach the driver. Candidate cuts, the rows' counts in a forest's trees and the features that a node
may split on are drawn as Spark draws them (``RandomForest.findSplits``, ``BaggedPoint``, ``selectNodesToSplit``), and gains are
computed in its order, so the trees are the same.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import counted_batches, materialize

#: Bytes of class counts that a task holds in a pass; trees beyond it take another pass.
HELD = 64 << 20

#: Rows that are looked through at once.
AT_ONCE = 1 << 17

#: Trees of a forest, whose numbers take TREE_BITS; a row's counts in all of them share COUNT_BITS.
MOST_TREES, TREE_BITS, COUNT_BITS = 10, 4, 60

#: Spark's bytes of class counts for which a level is taken at once (maxMemoryInMB).
GROUP = 256 << 20

_MASK = (1 << 64) - 1


@dataclass
class Setting:
    """What a tree depends on beside its rows; trees of a smaller depth are these, cut (:meth:`Tree.values`)."""

    bins: int
    impurity: str
    depth: int


@dataclass
class Tree:
    """A tree by heap numbers: the root is 1, node k's children are 2k and 2k + 1; feature -1 is a leaf."""

    fold: int
    setting: int
    number: int
    depth: int
    feature: np.ndarray = field(init=False)
    cut: np.ndarray = field(init=False)
    counts: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        n = 2 << self.depth
        self.feature, self.cut, self.counts = np.full(n, -1, np.int64), np.full(n, 255, np.int64), np.zeros((n, 2))

    def values(self, depth: int, share: bool) -> np.ndarray:
        """Per node of the last level, the score of a row that gets there in the tree cut at ``depth``: positives or their share.

        As in a fit, two leaves that predict one class become a leaf of their parent.
        """
        leaf = self.feature < 0
        leaf[1 << depth:] = True
        kind = self.counts.argmax(axis=1)
        for level in range(depth - 1, -1, -1):
            at = slice(1 << level, 2 << level)
            below = slice(2 << level, 4 << level)
            both = leaf[below].reshape(-1, 2).all(axis=1) & (kind[below].reshape(-1, 2)[:, 0] == kind[below].reshape(-1, 2)[:, 1])
            leaf[at] |= both
        total = self.counts.sum(axis=1)
        own = np.divide(self.counts[:, 1], total, out=np.zeros(len(total)), where=total != 0) if share else self.counts[:, 1]
        value, ended = np.array(own), leaf.copy()
        for level in range(self.depth):
            above = np.repeat(np.arange(1 << level, 2 << level), 2)
            below = np.arange(2 << level, 4 << level)
            value[below] = np.where(ended[above], value[above], value[below])
            ended[below] |= ended[above]
        return value[1 << self.depth:]


@dataclass
class _Layout:
    """How a row's number holds its bins: ``cuts`` per feature, of all folds and settings; the lowest bit is the label."""

    cuts: list[np.ndarray]

    def __post_init__(self) -> None:
        bits = [len(c).bit_length() for c in self.cuts]
        self.shifts = [1 + sum(bits[:j]) for j in range(len(bits))]
        self.masks = [(1 << b) - 1 for b in bits]
        self.bits = 1 + sum(bits)

    def pack(self, values: np.ndarray, label: np.ndarray) -> np.ndarray:
        row = label.astype(np.int64)
        for j, cuts in enumerate(self.cuts):
            row |= np.searchsorted(cuts, values[:, j], side="left") << self.shifts[j]
        return row

    def bins(self, row: np.ndarray, maps: Sequence[np.ndarray]) -> np.ndarray:
        """(feature, row) bins of one fold and setting."""
        return np.stack([np.take(maps[j], (row >> self.shifts[j]) & self.masks[j]) for j in range(len(self.cuts))])

    def maps(self, own: Sequence[np.ndarray]) -> list[np.ndarray]:
        """Per feature, the bin by ``own`` cuts of each bin by all cuts."""
        return [np.searchsorted(o, np.append(c, np.inf), side="left").astype(np.uint8) for c, o in zip(self.cuts, own)]


# ---------------------------------------------------------------------------
# Spark's draws
# ---------------------------------------------------------------------------

def _signed(x: int, bits: int = 64) -> int:
    x &= (1 << bits) - 1
    return x - (1 << bits) if x >> (bits - 1) else x


class JavaRandom:
    """java.util.Random."""

    def __init__(self, seed: int) -> None:
        self.at = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1)

    def _next(self) -> int:
        self.at = (self.at * 0x5DEECE66D + 0xB) & ((1 << 48) - 1)
        return _signed(self.at >> 16, 32)

    def long(self) -> int:
        return _signed((self._next() << 32) + self._next())


def _murmur(data: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """Scala's MurmurHash3.bytesHash of 64-bit numbers, highest byte first; all as unsigned 64-bit arrays."""
    m = np.uint64(0xFFFFFFFF)

    def rotated(x, by):
        return ((x << np.uint64(by)) | (x >> np.uint64(32 - by))) & m

    turned = data.astype(">u8").view("<u4").astype(np.uint64).reshape(-1, 2)
    h = seed
    for k in (turned[:, 0], turned[:, 1]):
        k = (rotated((k * np.uint64(0xCC9E2D51)) & m, 15) * np.uint64(0x1B873593)) & m
        h = (rotated(h ^ k, 13) * np.uint64(5) + np.uint64(0xE6546B64)) & m
    h = h ^ np.uint64(8)
    h = ((h ^ (h >> np.uint64(16))) * np.uint64(0x85EBCA6B)) & m
    h = ((h ^ (h >> np.uint64(13))) * np.uint64(0xC2B2AE35)) & m
    return h ^ (h >> np.uint64(16))


class XorShift:
    """Spark's XORShiftRandom, one generator per seed."""

    def __init__(self, seeds: Sequence[int]) -> None:
        data = np.array([s & _MASK for s in seeds], np.uint64)
        low = _murmur(data, np.full(len(data), 0x3C074A61, np.uint64))
        self.at = (_murmur(data, low) << np.uint64(32)) | low

    def _next(self, bits: int) -> np.ndarray:
        x = self.at
        x = x ^ (x << np.uint64(21))
        x = x ^ (x >> np.uint64(35))
        self.at = x = x ^ (x << np.uint64(4))
        return x & np.uint64((1 << bits) - 1)

    def int32(self) -> int:
        return _signed(int(self._next(32)[0]), 32)

    def double(self) -> np.ndarray:
        high = self._next(26) << np.uint64(27)
        return (high + self._next(27)).astype(np.float64) * 2.0 ** -53


def _subsets(seeds: Sequence[int], n: int, k: int) -> np.ndarray:
    """Per seed, ``k`` of ``n`` features (SamplingUtils.reservoirSampleAndCount)."""
    out = np.tile(np.arange(k), (len(seeds), 1))
    rng = XorShift(seeds)
    for item in range(k, n):
        at = (rng.double() * (item + 1)).astype(np.int64)
        hit = np.flatnonzero(at < k)
        out[hit, at[hit]] = item
    return out


def _map_order(keys: Sequence[int], shift: int = 0) -> list[int]:
    """The order in which a Scala map from these numbers, added in ascending order, is walked through."""
    keys = sorted(keys)
    if shift == 0 and len(keys) <= 4:
        return keys

    def improved(key: int) -> int:
        h = (key + ~(key << 9)) & 0xFFFFFFFF
        h ^= h >> 14
        h = (h + (h << 4)) & 0xFFFFFFFF
        return h ^ (h >> 10)

    places: dict[int, list[int]] = {}
    for key in keys:
        places.setdefault((improved(key) >> shift) & 31, []).append(key)
    alone = [own[0] for _, own in sorted(places.items()) if len(own) == 1]
    return alone + [key for _, own in sorted(places.items()) if len(own) > 1 for key in _map_order(own, shift + 5)]


def _as_split(stack: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """(tree, node) pairs in the order in which Spark splits a group: tree by tree, each tree's as they were taken."""
    place = {tree: k for k, tree in enumerate(_map_order({tree for tree, _ in stack}))}
    return sorted(stack, key=lambda own: place[own[0]])


class _Sampler:
    """Positions that Spark's BernoulliSampler takes of a partition's rows, block by block."""

    def __init__(self, fraction: float, seed: int) -> None:
        self.fraction, self.rng, self.seen = fraction, XorShift([seed]), 0
        self.gaps = fraction <= 0.4
        if self.gaps:
            self.lnq = math.log1p(-fraction)
            self.next = self._gap()

    def _gap(self) -> int:
        return int(math.log(max(float(self.rng.double()[0]), 5e-11)) / self.lnq)

    def taken(self, n: int) -> np.ndarray:
        """Positions of the next ``n`` rows that are taken."""
        if self.fraction >= 1:
            return np.arange(n)
        if not self.gaps:
            return np.flatnonzero([float(self.rng.double()[0]) <= self.fraction for _ in range(n)])
        out = []
        while self.next < self.seen + n:
            out.append(self.next - self.seen)
            self.next += 1 + self._gap()
        self.seen += n
        return np.array(out, np.int64)


def _cuts(values: np.ndarray, expected: float, bins: int) -> np.ndarray:
    """A feature's candidate cuts from its sampled values (RandomForest.findSplitsForContinuousFeature)."""
    seen = values[values != 0]
    if not len(seen):
        return np.zeros(0)
    value, count = np.unique(seen, return_counts=True)
    count = count.astype(np.float64)
    if expected - len(seen) > 2.220446049250313e-16 * len(seen) * 100:
        at = int(np.searchsorted(value, 0.0))
        value, count = np.insert(value, at, 0.0), np.insert(count, at, expected - len(seen))
    if len(value) - 1 <= bins - 1:
        return (value[:-1] + value[1:]) / 2.0
    out, stride = [], expected / bins
    current, target = count[0], stride
    for i in range(1, len(value)):
        before = current
        current = current + count[i]
        if abs(before - target) < abs(current - target):
            out.append((value[i - 1] + value[i]) / 2.0)
            target += stride
    return np.array(out)


# ---------------------------------------------------------------------------
# Passes
# ---------------------------------------------------------------------------

def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
    """Columns of at least AT_ONCE rows, the last of what is left."""
    held, n = [], 0
    for batch in batches:
        if len(batch):
            held.append(batch)
            n += len(batch)
        if n >= AT_ONCE:
            yield pa.Table.from_batches(held).combine_chunks().columns
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().columns


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy()


def _matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
    """(row, feature) doubles of a column of lists."""
    return np.concatenate([np.asarray(c.flatten()) for c in column.chunks]).reshape(n, -1)


def _sample(df: DataFrame, fold: str, rates: Sequence[float], seed: int) -> list[np.ndarray] | None:
    """Per fold, the training rows that Spark samples for cuts; None where a vector has no number."""
    rng = JavaRandom(XorShift([seed]).int32())
    seeds = [rng.long() for _ in range(df.rdd.getNumPartitions())]

    def run(batches):
        part = TaskContext.get().partitionId()
        samplers = [_Sampler(rate, seeds[part]) for rate in rates]
        for values, folds in _blocks(batches):
            folds = _numbers(folds)
            x = _matrix(values, len(folds))
            if np.isnan(x).any():
                yield pa.record_batch([pa.array([-1], pa.int32()), pa.array([[]], pa.list_(pa.float64()))], names=["fold", "x"])
            for i, sampler in enumerate(samplers):
                own = np.flatnonzero(folds != i)
                own = own[sampler.taken(len(own))]
                yield pa.record_batch([pa.array(np.full(len(own), i, np.int32)), pa.array(list(x[own]), pa.list_(pa.float64()))], names=["fold", "x"])

    found = df.select(vector_to_array("features").alias("x"), F.col(fold).cast("int").alias("fold")).mapInArrow(run, "fold int, x array<double>").toArrow()
    folds = found["fold"].to_numpy()
    if (folds < 0).any():
        return None
    x = _matrix(found["x"], len(folds))
    return [x[folds == i] for i in range(len(rates))]


def _packed(df: DataFrame, fold: str, layout: _Layout) -> DataFrame:
    """(fold, row) in the partitions and order of ``df``."""
    def run(batches):
        for values, labels, folds in _blocks(batches):
            row = layout.pack(_matrix(values, len(folds)), _numbers(labels))
            yield from pa.table([folds, pa.array(row)], names=["fold", "row"]).to_batches(AT_ONCE)

    return df.select(vector_to_array("features").alias("x"), "label", F.col(fold).cast("int").alias("fold")).mapInArrow(run, "fold int, row long")


def _bagged(rows: DataFrame, fold: int, trees: int, seed: int) -> DataFrame:
    """(fold, row, counts): a fold's training rows with their counts in each tree, as a fit draws them.

    Partition p of a fit draws the counts one after the other, tree after tree and row after row, from a Poisson generator
    of the seed + p + 1. ``sampleByKey`` draws once an item from one of the seed + p, so items are pairs of row and tree.
    """
    spark = rows.sparkSession
    jvm = spark.sparkContext._jvm
    items = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.shiftleft(F.col("row"), TREE_BITS).bitwiseOR(t.cast("long")))
    pairs = rows.filter(F.col("fold") != fold).select(F.lit(0).alias("_1"), F.explode(items).alias("_2"))
    encoders = jvm.org.apache.spark.sql.Encoders
    typed = getattr(pairs._jdf, "as")(encoders.tuple(encoders.INT(), encoders.LONG()))
    shares = jvm.java.util.HashMap()
    shares.put(0, 1.0)
    drawn = jvm.org.apache.spark.api.java.JavaPairRDD.fromJavaRDD(typed.toJavaRDD()).sampleByKey(True, shares, seed + 1)
    back = DataFrame(spark._jsparkSession.createDataset(drawn.values().rdd(), encoders.LONG()).toDF(), spark)

    def run(batches):
        # Equal rows side by side whose trees ascend are taken for one row, which counts the same.
        for (items,) in _blocks(batches):
            item = _numbers(items)
            row, tree = item >> TREE_BITS, item & ((1 << TREE_BITS) - 1)
            first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (tree[1:] < tree[:-1])))
            counts = np.add.reduceat(np.int64(1) << (COUNT_BITS // trees * tree), first)
            yield from pa.table([pa.array(np.full(len(first), fold, np.int32)), pa.array(row[first]), pa.array(counts)], names=["fold", "row", "counts"]).to_batches(AT_ONCE)

    return back.mapInArrow(run, "fold int, row long, counts long")


def _routed(tree: Tree, bins: np.ndarray, at: np.ndarray | None, depth: int) -> np.ndarray:
    """Heap numbers at ``depth`` of the rows ``at`` (all by default); below a leaf, its leftmost node."""
    d, n = bins.shape
    flat, start = bins.ravel(), np.arange(n) if at is None else at
    node = np.ones(len(start), np.int64)
    offset, cut = np.maximum(tree.feature, 0) * n, tree.cut
    for _ in range(depth):
        right = np.take(flat, np.take(offset, node) + start) > np.take(cut, node)
        node += node
        node += right
    return node


@dataclass
class _Job:
    """A tree's nodes to split at a level: (node, features) and the features' places in the class counts."""

    tree: Tree
    nodes: np.ndarray
    features: np.ndarray
    all_features: bool
    bins: int  # of the widest feature
    trees: int

    @property
    def width(self) -> int:
        return self.features.shape[1] * self.bins * 2

    @property
    def held(self) -> int:
        return len(self.nodes) * self.width * 8


def _splits(rows: DataFrame, jobs: list[_Job], level: int, layout: _Layout, maps: dict, cuts: dict, settings: Sequence[Setting], bagged: bool) -> pa.Table:
    """(job, node, n0, n1, gain, place, bin, l0, l1) of the best split of every node, from one pass."""
    sides = sorted({(j.tree.fold, j.tree.setting) for j in jobs})

    def count(batches):
        held = [np.zeros((j.features.shape[1], len(j.nodes) * j.bins * 2), np.int64) for j in jobs]
        local = []
        for j in jobs:
            own = np.full(2 << level, -1, np.int64)
            own[j.nodes] = np.arange(len(j.nodes))
            local.append(own)
        for block in _blocks(batches):
            folds, row = _numbers(block[0]), _numbers(block[1])
            for fold in sorted({f for f, _ in sides}):
                own = np.flatnonzero((folds == fold) if bagged else (folds != fold))
                mine, counts = row[own], _numbers(block[2])[own] if bagged else None
                label = mine & 1
                for bins_of in sorted({settings[s].bins for f, s in sides if f == fold}):
                    bins = layout.bins(mine, maps[fold, bins_of])
                    for i, j in enumerate(jobs):
                        if j.tree.fold == fold and settings[j.tree.setting].bins == bins_of:
                            _count(held[i], j, local[i], bins, label, counts, level)
        for i, j in enumerate(jobs):
            # (place, node, bin, label) to one value per node
            table = np.ascontiguousarray(held[i].reshape(-1, len(j.nodes), j.bins * 2).transpose(1, 0, 2)).reshape(len(j.nodes), -1)
            some = table.any(axis=1)
            table, nodes = np.ascontiguousarray(table[some]), j.nodes[some]
            size = j.width * 8
            for at in range(0, len(nodes), max(1, (8 << 20) // size)):
                part = table[at:at + max(1, (8 << 20) // size)]
                offsets = pa.array(np.arange(len(part) + 1) * size, pa.int32())
                yield pa.record_batch([pa.array(np.full(len(part), i, np.int32)), pa.array(nodes[at:at + len(part)].astype(np.int32)),
                                       pa.Array.from_buffers(pa.binary(), len(part), [None, offsets.buffers()[1], pa.py_buffer(part)])],
                                      names=["job", "node", "counts"])

    def best(batches):
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for job, node, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                own = np.frombuffer(counts.as_buffer(), np.int64)
                known = sums.get((job, node))
                if known is None:
                    sums[job, node] = own.copy()
                else:
                    known += own
        for i, j in enumerate(jobs):
            nodes = np.array(sorted(n for k, n in sums if k == i), np.int64)
            if len(nodes):
                table = np.stack([sums.pop((i, int(n))) for n in nodes]).reshape(len(nodes), -1, j.bins, 2)
                features = j.features[np.searchsorted(j.nodes, nodes)]
                tried = np.array([len(c) for c in cuts[j.tree.fold, settings[j.tree.setting].bins]])[features]
                columns = _best(table, tried, settings[j.tree.setting].impurity)
                yield pa.record_batch([pa.array(np.full(len(nodes), i, np.int32)), pa.array(nodes.astype(np.int32)), *columns], names=names)

    names = ["job", "node", "n0", "n1", "gain", "place", "bin", "l0", "l1"]
    counted = rows.mapInArrow(count, "job int, node int, counts binary").repartition("job", "node")
    return counted.mapInArrow(best, "job int, node int, n0 double, n1 double, gain double, place int, bin int, l0 double, l1 double").toArrow()


def _count(held: np.ndarray, job: _Job, local: np.ndarray, bins: np.ndarray, label: np.ndarray, counts: np.ndarray | None, level: int) -> None:
    """Add the rows to a tree's class counts, (place, node x bin x label)."""
    weight = start = None
    if counts is not None:
        bits = COUNT_BITS // job.trees
        weight = (counts >> (bits * job.tree.number)) & ((1 << bits) - 1)
        start = np.flatnonzero(weight)
    at = np.take(local, _routed(job.tree, bins, start, level))
    live = np.flatnonzero(at >= 0)
    start = live if start is None else start[live]
    if not len(start):
        return
    at = at[live]
    first = at * (job.bins * 2) + label[start]
    weight = None if weight is None else weight[start].astype(np.float64)
    flat, n = bins.ravel(), bins.shape[1]
    for place in range(job.features.shape[1]):
        where = start + (place * n if job.all_features else np.take(job.features[:, place] * n, at))
        into = np.bincount(first + 2 * np.take(flat, where).astype(np.int64), weight, held.shape[1])
        held[place] += into if weight is None else into.astype(np.int64)


def _impurity(n0: np.ndarray, n1: np.ndarray, kind: str) -> np.ndarray:
    total = n0 + n1
    with np.errstate(divide="ignore", invalid="ignore"):
        a, b = n0 / total, n1 / total
        if kind == "gini":
            out = (1.0 - a * a) - b * b
        else:
            parts = [np.where(f > 0, f * (np.log(f) / math.log(2)), 0.0) for f in (a, b)]
            out = (0.0 - parts[0]) - parts[1]
    return np.where(total == 0, 0.0, out)


def _best(table: np.ndarray, tried: np.ndarray, kind: str) -> list[pa.Array]:
    """Best split of nodes by (node, place, bin, label) counts; ``tried`` is the number of cuts of each node's features."""
    upto = table.cumsum(axis=2).astype(np.float64)
    l0, l1 = upto[:, :, :-1, 0], upto[:, :, :-1, 1]
    n0, n1 = upto[:, :1, -1:, 0], upto[:, :1, -1:, 1]
    r0, r1 = n0 - l0, n1 - l1
    left, right = l0 + l1, r0 + r1
    total = left + right
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = _impurity(n0, n1, kind) - left / total * _impurity(l0, l1, kind) - right / total * _impurity(r0, r1, kind)
    lowest = -np.finfo(np.float64).max
    gain = np.where((left < 1) | (right < 1) | (gain < 0), lowest, gain)
    gain = np.where(np.arange(gain.shape[2]) < tried[:, :, None], gain, -np.inf)
    chosen = gain.reshape(len(gain), -1).argmax(axis=1)
    place, cut = np.divmod(chosen, gain.shape[2])
    at = np.arange(len(gain))
    return [pa.array(x) for x in (n0[:, 0, 0], n1[:, 0, 0], gain[at, place, cut], place.astype(np.int32), cut.astype(np.int32), l0[at, place, cut], l1[at, place, cut])]


class FoldTrees:
    """The trees of all folds (each the validation side once) and settings, grown level by level."""

    def __init__(self, df: DataFrame, fold: str, sizes: Sequence[int], settings: Sequence[Setting], trees: int, seed: int, forest: bool = False) -> None:
        """``sizes`` are the training rows of each fold; ``forest`` draws rows and features as a random forest does."""
        self.df, self.fold, self.sizes, self.settings = df, fold, list(sizes), list(settings)
        self.n_trees, self.seed, self.forest = trees, seed, forest
        self._kept: DataFrame | None = None

    def grow(self) -> bool:
        """False, before any tree is grown, where rows can't be stored as numbers or Spark would take a level in parts."""
        needed = max(10_000, *(s.bins ** 2 for s in self.settings))
        if any(max(10_000, s.bins ** 2) != needed for s in self.settings):
            return False
        rates = [needed / n if needed < n else 1.0 for n in self.sizes]
        sampled = _sample(self.df, self.fold, rates, self.seed)
        if sampled is None or not all(len(x) for x in sampled):
            return False
        d = self.n_features = sampled[0].shape[1]
        self.tried = math.ceil(math.sqrt(d)) if self.forest and self.n_trees > 1 else d
        self.cuts = {(i, b): [_cuts(x[:, j], rates[i] * self.sizes[i], min(b, self.sizes[i])) for j in range(d)]
                     for i, x in enumerate(sampled) for b in {s.bins for s in self.settings}}
        if not all(any(len(c) for c in own) for own in self.cuts.values()):
            return False
        self.layout = _Layout([np.unique(np.concatenate([own[j] for own in self.cuts.values()])) for j in range(d)])
        self.maps = {key: self.layout.maps(own) for key, own in self.cuts.items()}
        # A sample larger than expected gives a cut or two beyond the setting's bins.
        if any(s.bins > 250 or self.n_trees * (1 << max(0, s.depth - 1)) * self.tried * s.bins * 24 > GROUP for s in self.settings):
            return False
        if self.layout.bits + self.forest * TREE_BITS > 63 or self.n_trees > MOST_TREES:
            return False
        packed = _packed(self.df, self.fold, self.layout)
        with counted_batches(self.df.sparkSession):
            if self.forest:
                # Draws follow the rows' partitions, which a stored table wouldn't keep.
                self._kept = self.rows = packed.persist(StorageLevel.DISK_ONLY)
                stored = None
                for i in range(len(self.sizes)):
                    own = _bagged(self.rows, i, self.n_trees, self.seed)
                    stored = own if stored is None else stored.unionAll(own)
                training = materialize(stored)
            else:
                training = self.rows = materialize(packed)
            most = 2 * self.df.sparkSession.sparkContext.defaultParallelism
            self._levels(training.coalesce(most) if training.rdd.getNumPartitions() > most else training)
        return True

    def _levels(self, training: DataFrame) -> None:
        self.trees = [[[Tree(i, s, t, own.depth) for t in range(self.n_trees)] for s, own in enumerate(self.settings)] for i in range(len(self.sizes))]
        subsets = self.tried < self.n_features
        models = [(i, s) for i in range(len(self.sizes)) for s in range(len(self.settings))]
        # Spark's stack of nodes, its top first, and its draws of features
        waiting = {m: [(t, 1) for t in reversed(range(self.n_trees))] if self.settings[m[1]].depth else [] for m in models}
        draws = {m: JavaRandom(self.seed) for m in models}
        for level in range(max(s.depth for s in self.settings)):
            jobs: list[_Job] = []
            order: dict[tuple[int, int], list[tuple[int, int]]] = {}
            for m in models:
                stack = order[m] = waiting[m]
                chosen = _subsets([draws[m].long() for _ in stack], self.n_features, self.tried) if subsets else np.tile(np.arange(self.n_features), (len(stack), 1))
                for t in range(self.n_trees):
                    own = [k for k, (tree, _) in enumerate(stack) if tree == t]
                    if own:
                        nodes = np.array([stack[k][1] for k in own])
                        by = nodes.argsort()
                        jobs.append(_Job(self.trees[m[0]][m[1]][t], nodes[by], chosen[own][by], not subsets, 1 + max(map(len, self.cuts[m[0], self.settings[m[1]].bins])), self.n_trees))
            if not jobs:
                break
            pushed: dict[tuple[int, int, int], set] = {}
            for group in _groups(jobs):
                found = _splits(training, group, level, self.layout, self.maps, self.cuts, self.settings, self.forest)
                columns = {c: found[c].to_numpy() for c in found.column_names}
                for i, j in enumerate(group):
                    own = columns["job"] == i
                    self._split(j, {c: v[own] for c, v in columns.items()}, level, pushed)
            for m in models:
                waiting[m] = []
                for t, node in _as_split(order[m]):
                    for child in (2 * node, 2 * node + 1):
                        if child in pushed.get((*m, t), ()):
                            waiting[m].append((t, child))
                waiting[m].reverse()

    def _split(self, job: _Job, found: dict[str, np.ndarray], level: int, pushed: dict) -> None:
        tree, setting = job.tree, self.settings[job.tree.setting]
        node = found["node"].astype(np.int64)
        n0, n1, l0, l1 = (found[c] for c in ("n0", "n1", "l0", "l1"))
        tree.counts[node] = np.stack([n0, n1], axis=1)
        split = found["gain"] > 0
        node, n0, n1, l0, l1 = node[split], n0[split], n1[split], l0[split], l1[split]
        features = job.features[np.searchsorted(job.nodes, node), found["place"][split]]
        tree.feature[node], tree.cut[node] = features, found["bin"][split]
        on = pushed.setdefault((tree.fold, tree.setting, tree.number), set())
        for child, a, b in ((2 * node, l0, l1), (2 * node + 1, n0 - l0, n1 - l1)):
            tree.counts[child] = np.stack([a, b], axis=1)
            if level + 1 < setting.depth:
                on.update(child[np.abs(_impurity(a, b, setting.impurity)) >= 2.220446049250313e-16].tolist())

    def seen(self) -> dict[tuple[int, int], list[tuple[int, int, int]]]:
        """Per fold and setting of single trees, (node of the last level, label, rows) of the validation rows."""
        layout, maps, settings, trees = self.layout, self.maps, self.settings, self.trees
        k = len(self.sizes)

        def run(batches):
            sums = {(i, s): np.zeros(2 << own.depth, np.int64) for i in range(k) for s, own in enumerate(settings)}
            for folds, row in _blocks(batches):
                folds, row = _numbers(folds), _numbers(row)
                for i in range(k):
                    mine = row[folds == i]
                    for s, own in enumerate(settings):
                        node = _routed(trees[i][s][0], layout.bins(mine, maps[i, own.bins]), None, own.depth) - (1 << own.depth)
                        sums[i, s] += np.bincount(node * 2 + (mine & 1), minlength=2 << own.depth)
            for (i, s), own in sums.items():
                at = np.flatnonzero(own)
                yield pa.record_batch([pa.array(np.full(len(at), v, np.int32)) for v in (i, s)] + [pa.array(at.astype(np.int32)), pa.array(own[at])], names=["fold", "setting", "at", "n"])

        with counted_batches(self.df.sparkSession):
            found = self.rows.mapInArrow(run, "fold int, setting int, at int, n long").groupBy("fold", "setting", "at").agg(F.sum("n").alias("n")).collect()
        out: dict[tuple[int, int], list] = {(i, s): [] for i in range(k) for s in range(len(settings))}
        for i, s, at, n in found:
            out[i, s].append((at >> 1, at & 1, n))
        return out

    def scored(self, wanted: Sequence[tuple[int, int]]) -> DataFrame:
        """(fold, label, s0, s1 ...) of the validation rows: the forest's raw score for each (setting, depth)."""
        layout, maps, settings, k = self.layout, self.maps, self.settings, len(self.sizes)
        trees = self.trees
        values = {(i, s, d): [t.values(d, True) for t in trees[i][s]] for i in range(k) for s, d in wanted}
        names = ["fold", "label", *(f"s{c}" for c in range(len(wanted)))]

        def run(batches):
            for folds, row in _blocks(batches):
                folds, row = _numbers(folds), _numbers(row)
                out = np.zeros((len(wanted), len(row)))
                for i in range(k):
                    own = np.flatnonzero(folds == i)
                    mine = row[own]
                    for s in sorted({s for s, _ in wanted}):
                        bins = layout.bins(mine, maps[i, settings[s].bins])
                        depths = [(c, d) for c, (at, d) in enumerate(wanted) if at == s]
                        sums = {c: np.zeros(len(mine)) for c, _ in depths}
                        for t, tree in enumerate(trees[i][s]):
                            node = _routed(tree, bins, None, settings[s].depth) - (1 << settings[s].depth)
                            for c, d in depths:
                                sums[c] += np.take(values[i, s, d][t], node)
                        for c, _ in depths:
                            out[c, own] = sums[c]
                yield from pa.table([pa.array(folds), pa.array((row & 1).astype(np.float64)), *map(pa.array, out)], names=names).to_batches(AT_ONCE)

        schema = ", ".join(["fold int", "label double", *(f"s{c} double" for c in range(len(wanted)))])
        with counted_batches(self.df.sparkSession):
            return materialize(self.rows.mapInArrow(run, schema))

    def __enter__(self) -> FoldTrees:
        return self

    def __exit__(self, *_) -> None:
        if self._kept is not None:
            self._kept.unpersist()


def _groups(jobs: list[_Job]) -> Iterator[list[_Job]]:
    """Trees whose class counts a task holds at once."""
    group, held = [], 0
    for job in jobs:
        if group and held + job.held > HELD:
            yield group
            group, held = [], 0
        group.append(job)
        held += job.held
    if group:
        yield group
