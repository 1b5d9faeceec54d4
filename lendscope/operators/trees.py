"""Forests and boosted trees on binned features.

``bin_table`` turns every feature slot of the assembled vector into at most
``MAX_BINS`` bins (exact quantiles of the training rows for numeric slots; 0 / 1
slots get two), so a row is one byte per slot.

*Forest.* Tree ``t`` takes row ``i`` Poisson(1) times, drawn from a hash of
(seed, t, row_id), of all rows: the bag does not depend on partitions or row order.
The rows are packed into chunks by a hash of row_id; trees are grown some at a
time, so that the bags on disk are as many as the cluster's tasks hold. A bag of
up to ``BAG_BYTES`` goes to the task that grows its tree. A larger one's nodes are split
by sums over the chunks, a job a level, until their rows fit into a task; each task
then grows some of these nodes, and its part is a tree of its own whose values
add up with the other parts'. The tasks write their trees to the shared folder; the
driver gets each slot's gains only.

*Boosting.* The binned rows are dealt into chunks by a hash of row_id. Up to
``SHARES`` tasks put the chunks' rows into files of their machine, which any worker there maps;
a cached row names them, so later tasks go where they are. Each level of a tree is a
job that carries the tree so far: a task sums its rows' gradients and hessians per
(node, slot, bin), of slots with two bins only over the rows in the second, since the
node's total tells the rest, and of two children only over the one with less
weight; only these sums reach the driver, which takes the splits with the largest
second-order gain. The rows, gradients and margins stay with the share; if its files are
gone they are made again from the chunks and the trees so far. A table of one share
grows its trees in that task. A table too large for shares is kept one chunk a
partition in memory and travels with each level's job, the sums of many chunks being
added up in two steps. Sums run in the order of chunks, so any layout of the input
gives the same model; of equal splits the first slot's is taken, so the number of
shares chooses none.
"""

from __future__ import annotations

import json
import math
import os
import shutil
import tempfile

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import drop_dir, release, shared_dir, stored_table
from .quantiles import exact_quantiles

MAX_BINS = 32
CHUNK_ROWS = 65_536
#: Packed rows of a forest's bag that a task holds to grow a tree, or part of one.
BAG_BYTES = 96 << 20
#: Trees up to this size are shipped whole; of larger forests a task holds so much, and so many rows, when it scores.
TREE_BYTES = 32 << 20
SCORE_ROWS = 1 << 19
FOLD = 25
#: Tasks that may hold a boosted table, the rows of each, and how often lost ones are made again.
SHARES, SHARE_ROWS, RELOADS = 64, 1 << 21, 4
#: Chunks whose sums go straight to the driver.
DIRECT = 64
#: Open nodes and rows of a forest tree handled at a time; weights and gains up to this share of a node's weight count as none.
BLOCK, ROWS, LEAST = 4096, 1 << 16, 1e-11
#: Gains of splits that differ by no more than this share are equal.
TIE = 1e-9
_KEY = "row_id"


# --- hashing and bins ----------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: uniform bits from (seed, number) sums."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def uniform(ids: np.ndarray, *salts: int) -> np.ndarray:
    """A number in [0, 1) per id, from a hash of the id and the salts."""
    x = _mix(np.asarray(ids, np.int64).view(np.uint64))
    for s in salts:
        with np.errstate(over="ignore"):
            x = _mix(x + np.uint64((s * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64)))
    return (x >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def poisson(u: np.ndarray, rate: float) -> np.ndarray:
    """Poisson counts of uniform numbers (inverse distribution function)."""
    term, total, cdf = math.exp(-rate), 0.0, []
    for k in range(1, 20):
        total += term
        cdf.append(total)
        term *= rate / k
    return np.searchsorted(np.array(cdf), u, side="right")


def bin_table(df: DataFrame, numeric, size: int, max_bins: int = MAX_BINS) -> list[list[float]]:
    """Upper bin edges per feature slot: quantiles for the ``numeric`` columns,
    which are the first slots, 0.5 for the others. A value goes to the bin of
    the first edge that is not below it."""
    numeric = list(numeric)
    edges: list[list[float]] = [[] for _ in numeric] + [[0.5] for _ in range(size - len(numeric))]
    if numeric:
        long = df.select([F.col(c).cast("double").alias(c) for c in numeric]).unpivot([], numeric, "feature", "x")
        q = exact_quantiles(long.where(F.col("x").isNotNull() & ~F.isnan("x")), "feature", "x", [i / max_bins for i in range(1, max_bins)])
        for r in q.groupBy("feature").agg(F.array_sort(F.collect_set("q")).alias("e")).collect():  # at most max_bins numbers a column
            edges[numeric.index(r["feature"])] = [float(v) for v in r["e"]]
    return edges


def binned(values: np.ndarray, edges) -> np.ndarray:
    """Bins (rows x slots, one byte each) of dense feature rows."""
    out = np.empty(values.shape, np.uint8)
    for j, e in enumerate(edges):
        out[:, j] = np.searchsorted(np.asarray(e), values[:, j], side="left")
    return out


def _binned_rows(df: DataFrame, edges, features: str, label: str, weight: str) -> DataFrame:
    """(row_id, x: one byte per slot, y, w)."""
    size = len(edges)

    def run(batches):
        for b in batches:
            values = np.asarray(b.column("v").flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, size)
            x = np.ascontiguousarray(binned(values, edges))
            off = (np.arange(b.num_rows + 1) * size).astype(np.int32)
            packed = pa.Array.from_buffers(pa.binary(), b.num_rows, [None, pa.py_buffer(off), pa.py_buffer(x)])
            yield pa.RecordBatch.from_arrays([b.column("row_id"), packed, b.column("y"), b.column("w")], ["row_id", "x", "y", "w"])

    rows = df.select(F.col(_KEY).cast("long").alias("row_id"), vector_to_array(features).alias("v"),
                     F.col(label).cast("double").alias("y"), F.col(weight).cast("double").alias("w"))
    return rows.mapInArrow(run, "row_id long, x binary, y double, w double")


def _matrix(x, slots: int) -> np.ndarray:
    return np.frombuffer(b"".join(x), np.uint8).reshape(-1, slots)


# --- trees as arrays -------------------------------------------------------------

FIELDS = (("feature", np.int32), ("bin", np.uint8), ("left", np.int32), ("right", np.int32), ("value", np.float64), ("gain", np.float64))


def walk(tree: dict, x: np.ndarray) -> np.ndarray:
    """The leaf of each row: left if its bin is at most the node's."""
    at = np.zeros(len(x), np.int64)
    while True:
        f = tree["feature"][at]
        inner = np.flatnonzero(f >= 0)
        if not len(inner):
            return at
        n = at[inner]
        goes = x[inner, f[inner]] <= tree["bin"][n]
        at[inner] = np.where(goes, tree["left"][n], tree["right"][n])


# --- a forest's tree -----------------------------------------------------------

class _Growing:
    """The arithmetic of a forest's tree: the splits of nodes by weighted Gini
    decrease, from sums that may come from any number of pieces.

    A row is a row of words: the bits of its narrow slots, its weight (below
    zero for class 0), the bins of its wide slots as bytes. A node has a key, made from its parent's: the slots that it tries
    are drawn from it, ``tries`` at first and as many more when none of them
    splits it, until all are tried; so where a node is grown does not matter."""

    def __init__(self, wide, narrow, bins: int, tries: int, max_depth: int):
        self.wide, self.narrow, self.bins, self.tries, self.max_depth = wide, narrow, bins, tries, max_depth
        self.slots = len(wide) + len(narrow)
        self.is_wide = np.zeros(self.slots, bool)
        self.is_wide[wide] = True
        self.place = np.empty(self.slots, np.int64)  # of a slot among those of its kind
        self.place[wide], self.place[narrow] = np.arange(len(wide)), np.arange(len(narrow))
        self.words = max(1, -(-len(narrow) // 64))

        self.row_words = self.words + 1 + -(-len(wide) // 8)

    def pack(self, x: np.ndarray, s: np.ndarray) -> np.ndarray:
        """Rows of bins (rows x slots) and signed weights."""
        bits = np.zeros((len(x), 64 * self.words), np.uint8)
        bits[:, :len(self.narrow)] = x[:, self.narrow]
        out = np.zeros((len(x), self.row_words), np.uint64)
        out[:, :self.words] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
        out[:, self.words] = np.ascontiguousarray(s, float).view(np.uint64)
        out.view(np.uint8)[:, 8 * self.words + 8:][:, :len(self.wide)] = x[:, self.wide]
        return out

    def rows(self, packed) -> np.ndarray:
        return np.frombuffer(packed, np.uint64).reshape(-1, self.row_words)

    def weights(self, rows: np.ndarray) -> np.ndarray:
        return rows[:, self.words].view(float)

    def bins_of(self, rows: np.ndarray, i: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The bin of row ``i`` in the wide slot at ``place``."""
        return rows.view(np.uint8).ravel()[i * (8 * self.row_words) + place + 8 * (self.words + 1)]

    @staticmethod
    def children(keys: np.ndarray) -> np.ndarray:
        """The keys of the left and right child of each node, in turn."""
        with np.errstate(over="ignore"):
            return np.stack([_mix(keys + np.uint64(s)) for s in (0x9E3779B97F4A7C15, 0x3C6EF372FE94F82B)], axis=1).ravel()

    def looks(self, keys: np.ndarray, first: int) -> np.ndarray:
        """(node x slot) the next slots of the nodes that have tried ``first``:
        a random order of all slots, as far as it is asked for."""
        upto, row = min(first + self.tries, self.slots), np.arange(len(keys))
        order = np.tile(np.arange(self.slots), (len(keys), 1))
        for i in range(upto):
            with np.errstate(over="ignore"):
                u = _mix(keys + np.uint64((i + 1) * 0xD1B54A32D192ED03 % (1 << 64))) >> np.uint64(11)
            j = i + (u.astype(np.float64) * ((self.slots - i) / float(1 << 53))).astype(np.int64)
            order[row, i], order[row, j] = order[row, j], order[row, i]
        return order[:, first:upto]

    def plan(self, look: np.ndarray):
        """What the sums of nodes that try these slots need: the bits of their
        narrow slots, the try of each, and their wide slots as (node, try, slot)."""
        n, k = look.shape
        node, turn = np.divmod(np.arange(n * k), k)
        wide, place = self.is_wide[look].ravel(), self.place[look].ravel()
        tried = np.zeros((n, 64 * self.words), np.uint8)
        turn_of = np.zeros((n, 64 * self.words), np.int16)
        tried[node[~wide], place[~wide]] = 1
        turn_of[node[~wide], place[~wide]] = turn[~wide]
        held = np.bincount(node[wide], minlength=n)
        return k, np.packbits(tried, axis=1, bitorder="little").view("<u8"), turn_of, (node[wide], turn[wide], place[wide], held, np.cumsum(held) - held)

    def sums(self, rows, mine: np.ndarray, n: int, plan):
        """Weights by class of rows that stand at nodes ``mine``: per (node, try,
        class) of the rows with 1 in a narrow slot, per (wide try, bin, class)."""
        s = self.weights(rows)
        k, tried, turn_of, (_, _, slot, held, first) = plan
        y, w, at, cells, weights = (s > 0).astype(np.int64), np.abs(s), np.arange(len(s)), [], []
        for word in range(self.words):
            v = rows[:, word] & tried[:, word].take(mine)
            i = np.flatnonzero(v)
            v = v[i]
            while len(i):
                lowest = v & (~v + np.uint64(1))
                node = mine[i]
                turn = turn_of.take(node * turn_of.shape[1] + (64 * word + np.bitwise_count(lowest - np.uint64(1)).astype(np.int64)))
                cells.append((node * k + turn) * 2 + y[i])
                weights.append(w[i])
                v ^= lowest
                more = np.flatnonzero(v)
                i, v = i[more], v[more]
        ones = np.bincount(np.concatenate(cells), np.concatenate(weights), n * k * 2) if cells else np.zeros(n * k * 2)
        by_bin = np.zeros(len(slot) * self.bins * 2)
        if len(slot):
            count = held[mine]
            i = np.repeat(at, count)
            pair = np.arange(len(i)) - np.repeat(np.cumsum(count) - count - first[mine], count)
            by_bin = np.bincount((pair * self.bins + self.bins_of(rows, i, slot[pair])) * 2 + y[i], w[i], len(by_bin))
        return ones.reshape(n, k, 2), by_bin.reshape(-1, self.bins, 2)

    def best(self, whole: np.ndarray, ones: np.ndarray, by_bin: np.ndarray, look: np.ndarray, plan):
        """(slot or -1, last bin that goes left, gain) of nodes with these sums:
        of equal splits that of the first try and bin, however the sums were rounded."""
        n, k = look.shape
        node, turn = plan[3][:2]

        def gains(low, all_):
            high = np.maximum(all_ - low, 0.0)
            nl, nr, total = low.sum(-1), high.sum(-1), all_.sum(-1)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = (low ** 2).sum(-1) / nl + (high ** 2).sum(-1) / nr - (all_ ** 2).sum(-1) / total
            return np.where((nl > LEAST * total) & (nr > LEAST * total), gain, -np.inf)

        total = whole.sum(-1)
        slack = lambda top, total: top - (TIE * np.abs(top) + 1e-13 * total)
        gain, cut = gains(np.maximum(whole[:, None] - ones, 0.0), whole[:, None]), np.zeros((n, k), np.int64)
        if len(node):
            g = gains(by_bin.cumsum(axis=1), whole[node][:, None])
            cut[node, turn] = c = (g >= slack(g.max(axis=1), total[node])[:, None]).argmax(axis=1)
            gain[node, turn] = g[np.arange(len(g)), c]
        j = (gain >= slack(gain.max(axis=1), total)[:, None]).argmax(axis=1)
        at = np.arange(n)
        gain = gain[at, j]
        return np.where(gain > LEAST * total, look[at, j], -1), cut[at, j], gain

    def right(self, rows: np.ndarray, mine: np.ndarray, slot: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """Whether each row goes right at its node's split."""
        place, wide, i = self.place[slot], self.is_wide[slot], np.arange(len(mine))
        word, shift = np.where(wide, 0, place >> 6), np.where(wide, 0, place & 63).astype(np.uint64)
        out = (rows.ravel()[i * self.row_words + word[mine]] >> shift[mine]) & np.uint64(1) > 0
        if wide.any():
            w = np.flatnonzero(wide[mine])
            out[w] = self.bins_of(rows, w, place[mine[w]]) > cut[mine[w]]
        return out

    def descend(self, tree: dict, rows) -> np.ndarray:
        """The leaf of each row."""
        at = np.zeros(len(rows), np.int64)
        i = np.flatnonzero(tree["feature"][at] >= 0)
        while len(i):
            v = at[i]
            goes = self.right(rows[i], v, tree["feature"], tree["bin"])
            at[i] = np.where(goes, tree["right"][v], tree["left"][v])
            i = i[tree["feature"][at[i]] >= 0]
        return at

    def _split(self, rows, offset, keys, whole):
        """The best splits of nodes whose rows lie one after another."""
        m = len(keys)
        slot, cut, gain = np.full(m, -1), np.zeros(m, np.int64), np.zeros(m)
        first = 0
        while first < m:
            last = max(first + 1, min(first + BLOCK, int(np.searchsorted(offset, offset[first] + ROWS, "right")) - 1))
            todo = np.arange(first, last)
            for seen in range(0, self.slots, self.tries):
                if not len(todo):
                    break
                look = self.looks(keys[todo], seen)
                plan, sums, at = self.plan(look), None, np.full(last - first, -1)
                at[todo - first] = np.arange(len(todo))
                for a in range(offset[first], offset[last], ROWS):
                    b = min(a + ROWS, offset[last])
                    lo, hi = np.searchsorted(offset, [a, b - 1], "right") - 1
                    mine = np.repeat(at[lo - first:hi + 1 - first], np.minimum(offset[lo + 1:hi + 2], b) - np.maximum(offset[lo:hi + 1], a))
                    part = rows[a:b]
                    if len(todo) < last - first:
                        kept = np.flatnonzero(mine >= 0)
                        part, mine = part[kept], mine[kept]
                    got = self.sums(part, mine, len(todo), plan)
                    sums = got if sums is None else [s + g for s, g in zip(sums, got)]
                slot[todo], cut[todo], gain[todo] = self.best(whole[todo], *sums, look, plan)
                todo = todo[slot[todo] < 0]
            first = last
        return slot, cut, np.where(slot >= 0, gain, 0.0)

    def grow(self, held: list, sizes, keys, depths) -> dict:
        """The trees below nodes whose rows lie one after another (``sizes`` of
        them each), in one tree's arrays: these nodes first, then level by level.
        ``held`` has the rows and is emptied, so that they can be freed."""
        rows, sizes = held.pop(), np.asarray(sizes, np.int64)
        keys, depths, levels, made = np.asarray(keys, np.uint64), np.asarray(depths, np.int64), [], 0
        whole, offset = np.zeros((len(keys), 2)), np.concatenate([[0], np.cumsum(sizes)])
        for a, b, lo, hi, mine in _pieces(offset):
            s = self.weights(rows[a:b])
            whole[lo:hi] += np.bincount(mine * 2 + (s > 0), np.abs(s), (hi - lo) * 2).reshape(-1, 2)

        def new(whole, depths):
            """More nodes; which of them are open."""
            total = whole.sum(-1)
            levels.append({k: np.full(len(whole), v, t) for (k, t), v in zip(FIELDS, (-1, 0, -1, -1, 0.0, 0.0))})
            levels[-1]["value"][:] = np.divide(whole[:, 1], total, out=np.zeros(len(whole)), where=total > 0)
            return (whole.min(axis=1) > LEAST * total) & (depths < self.max_depth)  # both classes are left

        open_ = new(whole, depths)
        if not open_.all():
            rows = rows[np.repeat(open_, sizes)]
        while open_.any():
            at, made = np.flatnonzero(open_), made + len(open_)
            whole, sizes, keys, depths, level = whole[at], sizes[at], keys[at], depths[at], levels[-1]
            offset = np.concatenate([[0], np.cumsum(sizes)])
            slot, cut, gain = self._split(rows, offset, keys, whole)
            m, goes = len(at), np.empty(int(offset[-1]), np.int8)
            counts, sums = np.zeros((m, 2), np.int64), np.zeros((m, 2, 2))
            for a, b, lo, hi, mine in _pieces(offset):
                side = self.right(rows[a:b], mine, slot[lo:hi], cut[lo:hi])
                goes[a:b] = side
                s, place = self.weights(rows[a:b]), mine * 2 + side
                counts[lo:hi] += np.bincount(place, minlength=(hi - lo) * 2).reshape(-1, 2)
                sums[lo:hi] += np.bincount(place * 2 + (s > 0), np.abs(s), (hi - lo) * 4).reshape(-1, 2, 2)
            split = np.flatnonzero((slot >= 0) & (counts.min(axis=1) > 0))
            place = at[split]
            level["feature"][place], level["bin"][place], level["gain"][place] = slot[split], cut[split], gain[split]
            level["left"][place] = made + 2 * np.arange(len(split))
            level["right"][place] = level["left"][place] + 1
            open_ = np.zeros((m, 2), bool)
            whole, keys, depths = sums[split].reshape(-1, 2), self.children(keys[split]), np.repeat(depths[split] + 1, 2)
            open_[split] = new(whole, depths).reshape(-1, 2)
            ends = np.where(open_, counts, 0)
            starts = (np.cumsum(ends) - ends.ravel()).reshape(-1, 2)
            order = np.empty(int(ends.sum()), np.int32 if len(goes) < 1 << 31 else np.int64)  # the rows of the open children
            for side in (0, 1):
                i = np.flatnonzero(goes == side)
                if not open_[:, side].all():
                    i = i[np.repeat(open_[:, side], counts[:, side])]
                n = ends[:, side]
                order[np.arange(len(i)) + np.repeat(starts[:, side] - (np.cumsum(n) - n), n)] = i
            rows = rows.take(order, axis=0)
            sizes, open_ = counts[split].ravel(), open_[split].ravel()
        return {k: np.concatenate([v[k] for v in levels]) for k, _ in FIELDS}


def _pieces(offset: np.ndarray):
    """(first row, end, first node, end, node of each row less the first) of the
    rows, ``ROWS`` at a time; node ``i`` has those from ``offset[i]`` on."""
    for a in range(0, int(offset[-1]), ROWS):
        b = min(a + ROWS, int(offset[-1]))
        lo, hi = np.searchsorted(offset, [a, b - 1], "right")
        yield a, b, lo - 1, hi, np.repeat(np.arange(hi + 1 - lo), np.minimum(offset[lo:hi + 1], b) - np.maximum(offset[lo - 1:hi], a))


def grow_bag(x: np.ndarray, y: np.ndarray, w: np.ndarray, max_depth: int, tries: int, rng: np.random.Generator, bins: int) -> dict:
    """A classification tree of one bag (rows x slots) by weighted Gini
    decrease. Leaves may hold one row."""
    g = _Growing(np.arange(x.shape[1]), np.arange(0), bins, tries, max_depth)
    kept = np.flatnonzero(w > 0)
    return g.grow([g.pack(x[kept], np.where(y[kept] == 1, w[kept], -w[kept]))], [len(kept)], rng.integers(0, 1 << 63, 1).astype(np.uint64), [0])


# --- the model --------------------------------------------------------------------

class TreeModel(Model, MLWritable, MLReadable):
    """A fitted ensemble: adds ``probability`` and ``prediction`` from the
    assembled ``features``. ``kind`` is "forest" (leaf shares are averaged) or
    "boosted" (leaf values are summed into log odds).

    The trees are a list, or a stored table that the executors wrote: a row per
    tree, or several whose values add up to a tree's. A table of more than ``TREE_BYTES`` never comes to the driver: rows
    meet the trees in a join, group by group."""

    meta = Param(Params._dummy(), "meta", "kind, bin edges, importances and size of the trees as JSON", typeConverter=TypeConverters.toString)

    def __init__(self, kind: str | None = None, edges=None, trees=None, importance=None, table: DataFrame | None = None, size: int = 0,
                 count: int | None = None):
        super().__init__()
        self.table, self._list = table, trees
        if kind is not None:
            self._set(meta=json.dumps({"kind": kind, "edges": edges, "importance": [float(v) for v in importance], "bytes": size,
                                       "trees": len(trees) if count is None else count}))

    @property
    def told(self) -> dict:
        return json.loads(self.getOrDefault(self.meta))

    @property
    def large(self) -> bool:
        return self.table is not None and self.told.get("bytes", 0) > TREE_BYTES

    @property
    def trees(self) -> list[dict]:
        """All trees here, for those who ask: a large forest is as large in the driver."""
        if self._list is not None:
            return self._list
        trees = [_tree_of(r) for r in self.table.orderBy("tree").collect()] if self.table is not None else []
        if not self.large:
            self._list = trees
        return trees

    @property
    def featureImportances(self):
        from pyspark.ml.linalg import Vectors
        return Vectors.dense(self.told["importance"])

    def _transform(self, df: DataFrame) -> DataFrame:
        told = self.told
        edges, forest, count = told["edges"], told["kind"] == "forest", told.get("trees")
        if self.large and not df.isStreaming:
            out = self._joined(df, edges, told["bytes"], count)
        else:
            shared = df.sparkSession.sparkContext.broadcast(self.trees)  # the model itself

            @F.pandas_udf("double")
            def positive(v: pd.Series) -> pd.Series:
                if not len(v):
                    return pd.Series([], dtype="float64")
                x, out = binned(np.stack(v.to_numpy()), edges), np.zeros(len(v))
                for t in shared.value:
                    out += t["value"][walk(t, x)]
                return pd.Series(out / max(1, len(shared.value) if count is None else count) if forest else 1.0 / (1.0 + np.exp(-out)))

            out = df.withColumn("prediction", positive(vector_to_array("features")))
        p = F.col("prediction")
        out = out.withColumn("probability", array_to_vector(F.array(F.lit(1.0) - p, p)))
        return out.withColumn("prediction", (p > 0.5).cast("double"))

    def _joined(self, df: DataFrame, edges, size: int, count: int | None) -> DataFrame:
        """``prediction`` by a large forest: blocks of rows meet groups of trees,
        so that a task holds about ``TREE_BYTES`` of trees and ``SCORE_ROWS``
        rows. The rows are written once, with a number each."""
        key, slots = "_tree_row", len(edges)
        rows = stored_table(df.withColumn(key, F.monotonically_increasing_id()), "to-score")
        blocks, parts = max(1, -(-rows.count() // SCORE_ROWS)), -(-size // TREE_BYTES)
        x = _binned_rows(rows.select(F.col(key).alias(_KEY), "features", F.lit(0).alias("y"), F.lit(0).alias("w")), edges, "features", "y", "w")
        x = x.select("row_id", "x", F.pmod(F.xxhash64("row_id"), F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
        trees = self.table.select("*", (F.col("tree") % parts).alias("part"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))

        def summed(key, r, t):
            x, out = _matrix(r["x"], slots), np.zeros(len(r))
            for tree in sorted((row for _, row in t.iterrows()), key=lambda row: row["tree"]):
                tree = _tree_of(tree)
                out += tree["value"][walk(tree, x)]
            return pd.DataFrame({"row_id": r["row_id"], "s": out, "n": len(t), "part": int(key[0])})

        sums = x.groupBy("part", "block").cogroup(trees.groupBy("part", "block")).applyInPandas(summed, "row_id long, s double, n long, part int")
        in_order = F.transform(F.array_sort(F.collect_list(F.struct("part", "s"))), lambda v: v["s"])  # a number a group of trees
        mean = F.aggregate(in_order, F.lit(0.0), lambda a, v: a + v) / (F.sum("n") if count is None else F.lit(count))
        return rows.join(sums.groupBy(F.col("row_id").alias(key)).agg(mean.alias("prediction")), key).select(*df.columns, "prediction")

    def write(self):
        return _TreeWriter(self)

    @classmethod
    def read(cls):
        return _TreeReader(cls)


class _TreeWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        spark = self.sparkSession
        DefaultParamsWriter.saveMetadata(self.instance, path, spark.sparkContext)
        table = self.instance.table
        if table is None:
            table = spark.createDataFrame([_tree_row(i, t) for i, t in enumerate(self.instance.trees)], _TREES)
        table.write.parquet(path + "/trees")  # a row per tree


class _TreeReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession.sparkContext)
        model = self.cls()
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        model.table = self.sparkSession.read.schema(_TREES).parquet(path + "/trees")
        return model


# --- forest ------------------------------------------------------------------------

_BAG = "unit int, chunk int, root binary, rows binary"


def _records(batch, *names):
    """The rows of a batch as dicts; binary columns as buffers, not copied."""
    for i in range(batch.num_rows):
        cells = ((n, batch.column(n)[i]) for n in names)
        yield {n: c.as_buffer() if isinstance(c, pa.BinaryScalar) else c.as_py() for n, c in cells}


def _signed_chunks(df: DataFrame, edges, n: int, g: _Growing, features: str, label: str, weight: str) -> DataFrame:
    """One row per chunk: the ids and packed rows of it."""
    rows = _binned_rows(df, edges, features, label, weight).withColumn("chunk", F.pmod(F.xxhash64("row_id"), F.lit(n)).cast("int"))

    def pack(key, p):
        p = p[p["y"].isin([0.0, 1.0]) & (p["w"] > 0)].sort_values("row_id", kind="stable")
        w = p["w"].to_numpy(float)
        packed = g.pack(_matrix(p["x"], g.slots), np.where(p["y"] == 1, w, -w))
        return pd.DataFrame([(int(key[0]), p["row_id"].to_numpy(np.int64).tobytes(), packed.tobytes())], columns=["chunk", "ids", "rows"])

    return rows.groupBy("chunk").applyInPandas(pack, "chunk int, ids binary, rows binary")


def _drawn(g: _Growing, ids: np.ndarray, rows: np.ndarray, seed: int, t: int, rate: float) -> np.ndarray:
    """The rows of tree ``t``'s bag: each as often as its Poisson number says, in its weight."""
    k = poisson(uniform(ids, seed, t), rate)
    at = np.flatnonzero(k)
    out = rows.take(at, axis=0)
    g.weights(out)[:] *= k[at]
    return out


class _Top:
    """A tree whose nodes are split by sums over all chunks, until every open
    one has few enough rows to be grown in a task (``units``)."""

    def __init__(self, key: np.ndarray):
        self.tree = {k: [v] for (k, _), v in zip(FIELDS, (-1, 0, -1, -1, 0.0, 0.0))}
        self.open = [(0, int(key), 0, 0)]  # node, key, depth, slots tried
        self.shipped: list[tuple] = []  # node, key, depth, rows

    def split(self, g: _Growing, counts, whole, parts, held: int) -> None:
        """Next nodes from the sums of the open ones; ``parts`` by slots tried."""
        was, self.open = self.open, []
        found = {}
        for at, look, plan, ones, by_bin in parts:
            found.update(zip(at.tolist(), zip(*(v.tolist() for v in g.best(whole[at], ones, by_bin, look, plan)))))
        for i, (v, key, depth, seen) in enumerate(was):
            total = whole[i].sum()
            self.tree["value"][v] = float(whole[i, 1] / total) if total > 0 else 0.0
            if whole[i].min() <= LEAST * total or depth >= g.max_depth:
                continue
            if counts[i] <= held:
                self.tree["value"][v] = 0.0  # its unit tells
                self.shipped.append((v, key, depth, int(counts[i])))
                continue
            slot, cut, gain = found[i]
            if slot < 0:
                if seen + g.tries < g.slots:
                    self.open.append((v, key, depth, seen + g.tries))
                continue
            n = len(self.tree["feature"])
            for k, value in (("feature", slot), ("bin", cut), ("left", n), ("right", n + 1), ("gain", gain)):
                self.tree[k][v] = value
            for j, child in enumerate(g.children(np.array([key], np.uint64)).tolist()):
                for k, value in zip(self.tree, (-1, 0, -1, -1, 0.0, 0.0)):
                    self.tree[k].append(value)
                self.open.append((n + j, child, depth + 1, 0))

    def units(self, held: int) -> list[list[tuple]]:
        """The shipped nodes, put together to as many rows as a task holds."""
        out, rows = [[]], 0
        for s in self.shipped:
            if out[-1] and rows + s[3] > held:
                out.append([])
                rows = 0
            out[-1].append(s[:3])
            rows += s[3]
        return out


def _plans(g: _Growing, open_):
    """(places of nodes, their slots, plan) of open nodes, by how many slots they tried."""
    seen, keys = np.array([o[3] for o in open_]), np.array([o[1] for o in open_], np.uint64)
    for s in np.unique(seen):
        at = np.flatnonzero(seen == s)
        look = g.looks(keys[at], int(s))
        yield at, look, g.plan(look)


def _top_level(chunks: DataFrame, g: _Growing, tops: dict, seed: int, rate: float, held: int) -> None:
    """One more level of the ``tops`` (by tree): the sums of the open nodes over all
    chunks, added in the order of the chunks, then their splits."""
    asked = {t: (_Boosting.arrays(top.tree), top.open) for t, top in tops.items() if top.open}

    def sums(batches):
        plans = {t: list(_plans(g, open_)) for t, (_, open_) in asked.items()}
        for batch in batches:
            for row in _records(batch, "chunk", "ids", "rows"):
                ids, rows = np.frombuffer(row["ids"], np.int64), g.rows(row["rows"])
                for t, (tree, open_) in asked.items():
                    bag, place = _drawn(g, ids, rows, seed, t, rate), np.full(len(tree["feature"]), -1)
                    place[[o[0] for o in open_]] = np.arange(len(open_))
                    mine, n = place[g.descend(tree, bag)], len(open_)
                    i = np.flatnonzero(mine >= 0)
                    bag, mine = bag[i], mine[i]
                    s = g.weights(bag)
                    out = [np.bincount(mine, minlength=n).astype(float), np.bincount(mine * 2 + (s > 0), np.abs(s), n * 2)]
                    for at, look, plan in plans[t]:
                        own = np.full(n, -1)
                        own[at] = np.arange(len(at))
                        own = own[mine]
                        i = np.flatnonzero(own >= 0)
                        out += g.sums(bag[i], own[i], len(at), plan)
                    flat = np.concatenate([np.ravel(o) for o in out])
                    yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([row["chunk"]], pa.int32()), pa.array([flat.tobytes()], pa.binary())],
                                                     ["tree", "chunk", "sums"])

    def add(key, p):
        return pd.DataFrame({"tree": [int(key[0])], "sums": [_added(zip(p["chunk"], p["sums"])).tobytes()]})

    added = chunks.mapInArrow(sums, "tree int, chunk int, sums binary").groupBy("tree").applyInPandas(add, "tree int, sums binary").collect()
    for r in added:  # nodes x tries x bins numbers a tree
        top, flat = tops[r["tree"]], np.frombuffer(bytes(r["sums"]), float)
        n, parts, to = len(top.open), [], 3 * len(top.open)
        counts, whole = flat[:n], flat[n:to].reshape(n, 2)
        for at, look, plan in _plans(g, top.open):
            ones, wide = look.size * 2, len(plan[3][0]) * g.bins * 2
            parts.append((at, look, plan, flat[to:to + ones].reshape(*look.shape, 2), flat[to + ones:to + ones + wide].reshape(-1, g.bins, 2)))
            to += ones + wide
        top.split(g, counts, whole, parts, held)


def _grown(chunks: DataFrame, g: _Growing, tops: dict, seed: int, rate: float, held: int) -> DataFrame:
    """(tree, fields, share) of the ``tops`` with all that is below their
    shipped nodes: a row per unit. The units of a tree are trees themselves, and
    their values add up to the tree's: a leaf's value is in one of them."""
    units = [(t, u, nodes) for t, top in sorted(tops.items()) for u, nodes in enumerate(top.units(held))]
    trees = {t: _Boosting.arrays(top.tree) for t, top in tops.items()}
    mine: dict = {}
    for i, (t, _, nodes) in enumerate(units):
        mine.setdefault(t, []).append((i, [v[0] for v in nodes]))

    def bag(batches):
        for batch in batches:
            for row in _records(batch, "chunk", "ids", "rows"):
                ids, rows = np.frombuffer(row["ids"], np.int64), g.rows(row["rows"])
                for t, parts in mine.items():
                    drawn = _drawn(g, ids, rows, seed, t, rate)
                    whole = len(trees[t]["feature"]) == 1  # no top: all rows are the unit's
                    leaf = None if whole else g.descend(trees[t], drawn)
                    for i, nodes in parts:
                        if whole:
                            cells = b"", drawn
                        else:
                            place = np.full(len(trees[t]["feature"]), -1, np.int32)
                            place[nodes] = np.arange(len(nodes))
                            root = place[leaf]
                            kept = np.flatnonzero(root >= 0)
                            cells = root[kept], drawn[kept]
                        cells = [pa.array([bytes(c)], pa.binary()) for c in cells]
                        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([row["chunk"]], pa.int32()), *cells],
                                                         ["unit", "chunk", "root", "rows"])

    def grow(batches):
        held: dict = {}
        for batch in batches:
            for row in _records(batch, "unit", "chunk", "root", "rows"):
                held.setdefault(row["unit"], []).append((row["chunk"], row["root"], g.rows(row["rows"])))
        batch = row = None
        while held:
            i, pieces = held.popitem()
            (t, u, nodes), pieces = units[i], sorted(pieces, key=lambda p: p[0])
            top, rows = trees[t], [np.concatenate([p[2] for p in pieces])]
            sizes = [len(rows[0])]
            if len(top["feature"]) > 1:
                root = np.concatenate([np.frombuffer(p[1], np.int32) for p in pieces])
                order, sizes = np.argsort(root, kind="stable"), np.bincount(root, minlength=len(nodes))
                rows = [rows[0][order]]
            elif not sizes[0]:
                continue  # an empty bag
            del pieces
            tree = _joined_trees(top, [v[0] for v in nodes], g.grow(rows, sizes, [v[1] for v in nodes], [v[2] for v in nodes]), u == 0)
            own = np.bincount(np.maximum(tree["feature"], 0), tree["gain"], g.slots)
            cells = [*_tree_row(t, tree)[1:], own.tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), *[pa.array([c], pa.binary()) for c in cells]], ["tree", *[k for k, _ in FIELDS], "gains"])

    spark = chunks.sparkSession
    empty = spark.createDataFrame([(i, -1, bytearray(), bytearray()) for i in range(len(units))], _BAG)  # every unit is grown, also one without rows
    bags = chunks.mapInArrow(bag, _BAG).union(empty)
    return bags.repartitionById(len(units), "unit").mapInArrow(grow, _TREES + ", gains binary")


def _joined_trees(top: dict, nodes, below: dict, first: bool) -> dict:
    """``top`` with the trees ``below`` its ``nodes`` (their roots come first). Values of
    the top's other leaves and its gains are kept in the first unit only."""
    n, r = len(top["feature"]), len(nodes)
    to = np.concatenate([np.asarray(nodes, np.int64), n + np.arange(max(0, len(below["feature"]) - r))]).astype(np.int32)
    out = {}
    for k, t in FIELDS:
        v = below[k]
        if k in ("left", "right"):
            v = np.where(v >= 0, to[np.maximum(v, 0)] if len(to) else v, -1)
        own = top[k] if first or k not in ("value", "gain") else np.zeros(n, t)
        out[k] = np.concatenate([own, v[r:]]).astype(t)
        out[k][to[:r]] = v[:r]
    return out


def fit_forest(df: DataFrame, edges, n_rows: int, label: str, weight: str, features: str = "features", numTrees: int = 300,
               maxDepth: int | None = None, seed: int = 42, tree_rows: int | None = None) -> TreeModel:
    """A random forest with the square root of the slots tried per node. A
    bag is drawn from all rows, a row once on average; ``tree_rows`` is for callers
    who ask for smaller ones."""
    spark, slots = df.sparkSession, len(edges)
    rate = min(1.0, tree_rows / max(1, n_rows)) if tree_rows else 1.0
    bins, depth = max((len(e) for e in edges), default=0) + 1, maxDepth or 1 << 30
    g = _Growing(*_kinds(edges), bins, max(1, math.isqrt(slots)), depth)
    held = max(1, BAG_BYTES // (8 * g.row_words))
    bag = n_rows * (1 - math.exp(-rate))
    bag = max(1, int(bag + 6 * math.sqrt(bag)))  # with room for chance
    packed, store = _signed_chunks(df, edges, max(1, -(-n_rows // CHUNK_ROWS)), g, features, label, weight), shared_dir(spark, "bagged")
    packed.write.mode("overwrite").parquet(store)
    chunks = spark.read.schema(packed.schema).parquet(store)
    path, slots_now = shared_dir(spark, "forest"), max(1, spark.sparkContext.defaultParallelism)
    keys = _mix(_mix(np.arange(numTrees, dtype=np.uint64)) + np.uint64(seed % (1 << 64)))
    group = max(1, 2 * slots_now * held // bag)  # trees at a time: the bags on disk are as many as the cluster's tasks hold
    group -= group % slots_now if group > slots_now else 0
    for first in range(0, numTrees, group):
        tops = {t: _Top(keys[t]) for t in range(first, min(first + group, numTrees))}
        if bag <= held:
            for top in tops.values():
                (v, key, d, _), top.open = top.open[0], []
                top.shipped = [(v, key, d, bag)]
        while any(top.open for top in tops.values()):
            _top_level(chunks, g, tops, seed, rate, held)
        _grown(chunks, g, tops, seed, rate, held).write.mode("append").parquet(path)
        release(spark)
    drop_dir(spark, store)
    # the trees stay where the executors write them; the driver gets the slots' gains and the size
    schema = StructType.fromDDL(_TREES + ", gains binary")
    grown = spark.read.schema(schema).parquet(path) if numTrees else spark.createDataFrame([], schema)
    told = grown.select("tree", "gains", sum(F.octet_length(k) for k, _ in FIELDS).alias("bytes")).orderBy("tree").collect()
    own: dict = {}
    for r in told:
        own[r["tree"]] = own.get(r["tree"], 0.0) + np.frombuffer(bytes(r["gains"]), float)
    share = sum((v / v.sum() if v.sum() else v for v in own.values()), np.zeros(slots))
    return TreeModel("forest", edges, None, share / share.sum() if share.sum() else share, grown.drop("gains"), sum(r["bytes"] for r in told), len(own))


# --- boosting ------------------------------------------------------------------------

PARTS = ("ids", "wide", "ones", "at", "y", "w", "m")


def _kinds(edges):
    """The slots with more than two bins, and the others."""
    many = np.array([len(e) > 1 for e in edges], bool)
    return np.flatnonzero(many), np.flatnonzero(~many)


def _chunks(df: DataFrame, edges, n: int, features: str, label: str, weight: str) -> DataFrame:
    """One row per chunk, packed as binary: ids, the bins of the wide slots (slot by
    slot), the entries of the narrow slots whose bin is 1 (slot and row), y, w, m (margins)."""
    rows = _binned_rows(df, edges, features, label, weight).withColumn("chunk", F.pmod(F.xxhash64("row_id"), F.lit(n)).cast("int"))
    slots, (wide, narrow) = len(edges), _kinds(edges)

    def pack(key, p):
        p = p.sort_values("row_id", kind="stable")
        raw = lambda c, t: p[c].to_numpy(t).tobytes()
        x = _matrix(p["x"], slots)
        at, ones = np.nonzero(x[:, narrow])
        row = (int(key[0]), raw("row_id", np.int64), np.ascontiguousarray(x[:, wide].T).tobytes(), ones.astype(np.int32).tobytes(),
               at.astype(np.int32).tobytes(), raw("y", float), raw("w", float), np.zeros(len(p)).tobytes())
        return pd.DataFrame([row], columns=["chunk", *PARTS])

    return rows.groupBy("chunk").applyInPandas(pack, "chunk int, " + ", ".join(f"{k} binary" for k in PARTS))


class _Chunk:
    """The arrays of a packed chunk; ``x`` has the bins of all slots, slot by slot."""

    def __init__(self, parts, b: _Boosting):
        ids, wide, ones, at, y, w, m = parts
        self.ids = np.frombuffer(ids, np.int64)
        self.y, self.w, self.m = (np.frombuffer(v, float) for v in (y, w, m))
        self.ones, self.at = np.frombuffer(ones, np.int32).astype(np.int64), np.frombuffer(at, np.int32)
        n = len(self.ids)
        self.x = np.zeros((b.slots, n), np.uint8)
        self.x[b.wide] = np.frombuffer(wide, np.uint8).reshape(len(b.wide), n)
        self.x[b.narrow[self.ones], self.at] = 1

    def step(self, tree: dict, node: np.ndarray, steps: int) -> np.ndarray:
        """The nodes of the rows that stand at ``node``, so many levels further down."""
        own, inner, n = np.arange(len(tree["feature"])), tree["feature"] >= 0, len(node)
        base = np.where(inner, tree["feature"], 0).astype(np.int64) * n
        left, right = np.where(inner, tree["left"], own), np.where(inner, tree["right"], own)
        flat, row = self.x.ravel(), np.arange(n)
        for _ in range(steps):
            node = np.where(flat[base[node] + row] <= tree["bin"][node], left[node], right[node])
        return node


class _Boosting:
    """The arithmetic of a boosted tree, the same wherever it runs."""

    def __init__(self, edges, seed: int, step: float, depth: int, rows: float, columns: float, penalty: float, least: float):
        self.slots, self.bins = len(edges), max((len(e) for e in edges), default=0) + 1
        self.wide, self.narrow = _kinds(edges)
        self.seed, self.step, self.depth = seed, step, depth
        self.rows, self.columns, self.penalty, self.least = rows, columns, penalty, least

    def usable(self, turn: int) -> np.ndarray:
        """The slots that tree ``turn`` may split on."""
        picked = np.random.default_rng([self.seed, turn]).permutation(self.slots)
        return np.sort(picked[:max(1, int(self.columns * self.slots))])

    def slopes(self, c: _Chunk, turn: int):
        """Gradient and hessian of each row; a row that the tree does not sample has none."""
        p = 1.0 / (1.0 + np.exp(-c.m))
        w = np.where(uniform(c.ids, self.seed, turn) < self.rows, c.w, 0.0)
        return w * (p - c.y), w * p * (1.0 - p)

    def sums(self, c: _Chunk, slopes, node: np.ndarray, active, used) -> np.ndarray:
        """Gradient and hessian sums of the rows that stand at the ``active``
        nodes: of the nodes, of (node, used wide slot, bin) and of the rows
        with 1 in (node, used narrow slot); one flat array."""
        n, bins, k = len(active), self.bins, len(self.narrow)
        place = np.full(max(int(node.max(initial=0)), max(active)) + 1, n, np.int64)  # the others: one node more
        place[active] = np.arange(n)
        mine = place[node]
        wide = np.flatnonzero(np.isin(self.wide, used))
        kept = np.isin(self.narrow, used)
        base, cell = mine * bins, mine[c.at] * k + c.ones
        whole, by_bin, ones = np.empty((n, 2)), np.empty((n, len(wide), bins, 2)), np.empty((n, int(kept.sum()), 2))
        for j, v in enumerate(slopes):
            whole[:, j] = np.bincount(mine, v, n + 1)[:n]
            ones[..., j] = np.bincount(cell, v[c.at], (n + 1) * k)[:n * k].reshape(n, k)[:, kept]
        for i, s in enumerate(self.wide[wide]):
            at = base + c.x[s]
            for j, v in enumerate(slopes):
                by_bin[:, i, :, j] = np.bincount(at, v, (n + 1) * bins)[:n * bins].reshape(n, bins)
        return np.concatenate([a.ravel() for a in (whole, by_bin, ones)])

    def opened(self, flat: np.ndarray, active, used) -> np.ndarray:
        """The sums as (active nodes x used slots x bins x 2): bin 0 of a narrow slot is what bin 1 leaves."""
        n, bins = len(active), self.bins
        wide = np.isin(used, self.wide)
        whole, by_bin, ones = np.split(flat, np.cumsum([n * 2, n * int(wide.sum()) * bins * 2]))
        out = np.zeros((n, len(used), bins, 2))
        out[:, wide] = by_bin.reshape(n, -1, bins, 2)
        ones = ones.reshape(n, -1, 2)
        rest = whole.reshape(n, 1, 2) - ones
        rest[..., 1] = np.maximum(rest[..., 1], 0.0)
        out[:, ~wide, 0] = rest
        if bins > 1:
            out[:, ~wide, 1] = ones
        return out

    def split(self, tree: dict, active, sums: np.ndarray, used) -> list[int]:
        """Splits the active nodes of ``tree`` (lists by field) by the sums of
        their rows; returns the new nodes."""
        low = sums.cumsum(axis=2)
        all_ = low[:, :, -1:, :]
        high = all_ - low
        part = lambda a: a[..., 0] ** 2 / (a[..., 1] + self.penalty)
        leaf = lambda a: float(-self.step * a[0] / (a[1] + self.penalty))
        gain = 0.5 * (part(low) + part(high) - part(all_))
        gain = np.where((low[..., 1] >= self.least) & (high[..., 1] >= self.least), gain, -np.inf).reshape(len(active), -1)
        if active == [0]:
            tree["value"][0] = leaf(all_[0, 0, 0])
        new = []
        for i, v in enumerate(active):
            top = gain[i].max()
            if top <= 1e-9:
                continue
            best = int((gain[i] >= top - TIE * max(top, 1.0)).argmax())  # of equal splits the first, however the sums were rounded
            j, c = divmod(best, self.bins)
            n = len(tree["feature"])
            for k, value in (("feature", int(used[j])), ("bin", c), ("left", n), ("right", n + 1), ("gain", float(gain[i, best]))):
                tree[k][v] = value
            for side in (low[i, j, c], high[i, j, c]):
                for k, value in (("feature", -1), ("bin", 0), ("left", -1), ("right", -1), ("value", leaf(side)), ("gain", 0.0)):
                    tree[k].append(value)
            new += [n, n + 1]
        return new

    @staticmethod
    def start() -> dict:
        return {k: [v] for (k, _), v in zip(FIELDS, (-1, 0, -1, -1, 0.0, 0.0))}

    @staticmethod
    def arrays(tree: dict) -> dict:
        return {k: np.array(tree[k], t) for k, t in FIELDS}


def _tree_row(turn: int, tree: dict) -> tuple:
    return (turn, *[tree[k].tobytes() for k, _ in FIELDS])


def _tree_of(row) -> dict:
    return {k: np.frombuffer(bytes(row[k]), t) for k, t in FIELDS}


_TREES = "tree int, " + ", ".join(f"{k} binary" for k, _ in FIELDS)


class _Share:
    """The rows of some chunks, one after another, in a folder of the machine that
    holds them: every worker there maps the files. Wide slots lie slot by slot, of
    the narrow ones the bits and, row by row, the slots with 1 (filled up by one
    slot more). What a turn and level leave has files of its own, which are
    replaced as a whole: a task that runs again finds the same."""

    def __init__(self, path: str, b: _Boosting):
        self.path, self.b = path, b
        self.ids, self.y, self.w, self.wide, self.bits, self.ones = (self._load(k) for k in ("ids", "y", "w", "wide", "bits", "ones"))

    def _load(self, name: str) -> np.ndarray:
        return np.load(f"{self.path}/{name}.npy", mmap_mode="r")

    @staticmethod
    def _save(path: str, name: str, v: np.ndarray) -> None:
        with open(f"{path}/{name}.{os.getpid()}", "wb") as f:
            np.save(f, v)
        os.replace(f.name, f"{path}/{name}.npy")

    @classmethod
    def write(cls, chunks: list, b: _Boosting, trees: list) -> str:
        """A folder with the rows of packed chunks; margins are those after ``trees``."""
        path, k = tempfile.mkdtemp(prefix="lendscope-share-"), len(b.narrow)
        of = lambda i, t: [np.frombuffer(p[i], t) for p in chunks] or [np.empty(0, t)]
        ids = of(0, np.int64)
        n, most, pairs, start = sum(map(len, ids)), 0, [], 0
        bits = np.zeros((n, max(1, -(-k // 64))), np.uint64)
        for ones, at, i in zip(of(2, np.int32), of(3, np.int32), ids):  # by row
            x = np.zeros((len(i), 64 * bits.shape[1]), np.uint8)
            x[at, ones] = 1
            bits[start:start + len(i)] = np.packbits(x, axis=1, bitorder="little").view(np.uint64)
            count = np.bincount(at, minlength=len(i))
            most = max(most, int(count.max(initial=0)))
            pairs.append((ones, at + start, np.arange(len(at)) - (np.cumsum(count) - count)[at]))
            start += len(i)
        filled = np.full((n, most), k, np.int16 if k < 1 << 15 else np.int32)
        for ones, at, place in pairs:
            filled[at, place] = ones
        wide = np.concatenate([v.reshape(len(b.wide), len(i)) for v, i in zip(of(1, np.uint8), ids)], axis=1)
        y, w, m = (np.concatenate(of(i, float)) for i in (4, 5, 6))
        for name, v in (("ids", np.concatenate(ids)), ("y", y), ("w", w), ("wide", wide), ("bits", bits), ("ones", filled)):
            cls._save(path, name, v)
        share = cls(path, b)
        for t in trees:
            m = m + share.values(t)
        cls._save(path, f"m-{len(trees)}", m)
        return path

    def goes(self, rows: np.ndarray, slot: int, cut: int) -> np.ndarray:
        """Whether the rows go right."""
        at = int(np.searchsorted(self.b.wide, slot))
        if at < len(self.b.wide) and self.b.wide[at] == slot:
            return self.wide[at].take(rows) > cut
        at = int(np.searchsorted(self.b.narrow, slot))
        return (self.bits[:, at >> 6].take(rows) >> np.uint64(at & 63)) & np.uint64(1) > cut

    def values(self, tree: dict) -> np.ndarray:
        """The tree's value of each row."""
        out, at = np.empty(len(self.ids)), {0: np.arange(len(self.ids), dtype=np.int32)}
        for v, slot in enumerate(tree["feature"].tolist()):  # a node comes before its children
            rows = at.pop(v)
            if slot < 0:
                out[rows] = tree["value"][v]
            else:
                goes = self.goes(rows, slot, int(tree["bin"][v]))
                at[int(tree["left"][v])], at[int(tree["right"][v])] = rows[~goes], rows[goes]
        return out

    def sums(self, rows: np.ndarray, slopes, wide, narrow) -> np.ndarray:
        """Gradient and hessian sums of the rows: whole, by (wide slot, bin), and
        with 1 in the narrow slots; one flat array."""
        bins, most, first = self.b.bins, self.ones.shape[1], 1 + len(wide) * self.b.bins
        out = np.zeros((first + len(narrow), 2))
        for a in range(0, len(rows), ROWS):
            part = rows[a:a + ROWS]
            ones = self.ones.take(part, axis=0).ravel().astype(np.intp)
            xs = [self.wide[s].take(part).astype(np.intp) for s in wide]
            for j, v in enumerate(slopes):
                v = v.take(part)
                out[0, j] += v.sum()
                out[first:, j] += np.bincount(ones, np.repeat(v, most), len(self.b.narrow) + 1)[:-1][narrow]
                for i, x in enumerate(xs):
                    out[1 + i * bins:1 + (i + 1) * bins, j] += np.bincount(x, v, bins)
        return out.ravel()

    def answer(self, turn: int, level: int, last: dict | None, tree: dict, was, active, asked) -> np.ndarray:
        """The sums of the ``asked`` ones of the ``active`` nodes of a tree that
        level ``level - 1``, of the nodes ``was``, has made; ``last`` is the tree before."""
        b, used = self.b, self.b.usable(turn)
        if level == 0:
            if last is not None and not os.path.exists(f"{self.path}/m-{turn}.npy"):
                self._save(self.path, f"m-{turn}", self._load(f"m-{turn - 1}") + self.values(last))
            self.m = self._load(f"m-{turn}")
            slopes = np.stack(b.slopes(self, turn))
            self._save(self.path, f"slopes-{turn}", slopes)
            rows = {0: np.flatnonzero(uniform(self.ids, b.seed, turn) < b.rows).astype(np.int32)}
        else:
            slopes, held = self._load(f"slopes-{turn}"), self._load(f"rows-{turn}-{level - 1}")
            ends, rows = held[:len(was)], {}
            for v, here in zip(was, np.split(held[len(was):], ends[:-1])):
                slot = int(tree["feature"][v])
                if slot >= 0:
                    goes = self.goes(here, slot, int(tree["bin"][v]))
                    rows[int(tree["left"][v])], rows[int(tree["right"][v])] = here[~goes], here[goes]
        if level + 1 < b.depth:
            rows = {v: rows[v] for v in active}
            self._save(self.path, f"rows-{turn}-{level}", np.concatenate([np.cumsum([len(r) for r in rows.values()]), *rows.values()]).astype(np.int32))
        for name in os.listdir(self.path):  # the turn before has ended
            of = name.split(".")[0].split("-")
            if len(of) > 1 and int(of[1]) < turn - (of[0] == "m"):
                os.unlink(f"{self.path}/{name}")
        wide, narrow = np.flatnonzero(np.isin(b.wide, used)), np.flatnonzero(np.isin(b.narrow, used))
        return np.concatenate([self.sums(rows[v], slopes, wide, narrow) for v in asked])


def _grown_by(b: _Boosting, turn: int, ask) -> dict:
    """The tree of a round from the sums that ``ask`` gives for nodes. Of two
    children the one with less weight is asked for, the other is what it leaves."""
    used, tree, was, active, asked, rest, known = b.usable(turn), b.start(), [], [0], [0], {}, {}
    cuts = np.cumsum([2, int(np.isin(used, b.wide).sum()) * b.bins * 2])
    for level in range(b.depth):
        if not active:
            break
        now = dict(zip(asked, ask(level, b.arrays(tree), was, active, asked).reshape(len(asked), -1)))
        for v, (sibling, parent) in rest.items():
            now[v] = known[parent] - now[sibling]
            now[v][1::2] = np.maximum(now[v][1::2], 0.0)
        known = now
        table = np.stack([known[v] for v in active])
        sums = b.opened(np.concatenate([t.ravel() for t in np.split(table, cuts, axis=1)]), active, used)
        b.split(tree, active, sums, used)
        asked, rest, was, active = [], {}, active, []
        for i, v in enumerate(was):
            if tree["feature"][v] < 0:
                continue
            left, right = tree["left"][v], tree["right"][v]
            weights = sums[i, int(np.searchsorted(used, tree["feature"][v])), :, 1].cumsum()
            less, more = (left, right) if 2 * weights[tree["bin"][v]] <= weights[-1] else (right, left)
            asked.append(less)
            rest[more] = (less, v)
            active += [left, right]
    return b.arrays(tree)


def _held(chunks: DataFrame, n_tasks: int, b: _Boosting, trees: list) -> RDD:
    """(number, folder) of ``n_tasks`` shares, cached where the folders are, so that
    later tasks go there."""
    def load(batches):
        held = {row["chunk"]: [row[k] for k in PARTS] for batch in batches for row in _records(batch, "chunk", *PARTS)}
        path = _Share.write([p for _, p in sorted(held.items())], b, trees)
        yield pa.RecordBatch.from_arrays([pa.array([path])], ["path"])

    rows = chunks.repartitionById(n_tasks, F.col("chunk") % n_tasks).mapInArrow(load, "path string").rdd
    return rows.mapPartitionsWithIndex(lambda i, rs: [(i, r["path"]) for r in rs]).persist(StorageLevel.MEMORY_AND_DISK)


def _rounds_held(chunks: DataFrame, n_tasks: int, b: _Boosting, rounds: int) -> list[dict]:
    """Rounds of boosting whose rows stay where tasks hold them: a job a level
    gets only the tree so far there and sums back; a single share is grown in its
    task. If a share's files are not where a task runs, the shares are made
    again; where that goes on, the trees so far are given."""
    trees: list[dict] = []
    for _ in range(RELOADS):
        shares = _held(chunks, n_tasks, b, trees)
        try:
            while len(trees) < rounds:
                turn, last = len(trees), trees[-1] if trees else None
                if n_tasks == 1:
                    trees += shares.mapValues(lambda path: _turns_here(path, b, range(turn, rounds), last)).collect()[0][1]
                else:
                    trees.append(_grown_by(b, turn, lambda *now: _asked(shares, b, turn, last, now)))
            return trees
        except _Lost:
            continue
        finally:
            shares.foreach(lambda s: shutil.rmtree(s[1], ignore_errors=True))
            shares.unpersist()
    return trees


class _Lost(Exception):
    """A share's files are not where its task runs."""


def _turns_here(path: str, b: _Boosting, turns: range, last: dict | None) -> list[dict]:
    share, out = _Share(path, b), []
    for turn in turns:
        before = out[-1] if out else last
        out.append(_grown_by(b, turn, lambda *now: share.answer(turn, now[0], before, *now[1:])))
    return out


def _asked(shares: RDD, b: _Boosting, turn: int, last: dict | None, now) -> np.ndarray:
    """The sums of nodes over all shares, in their order."""
    def answer(path):
        try:
            return _Share(path, b).answer(turn, now[0], last, *now[1:]).tobytes()
        except FileNotFoundError:
            return None

    told = shares.mapValues(answer).collect()
    if any(v is None for _, v in told):
        raise _Lost
    return _added(told)


def _moved(b: _Boosting, trees):
    """The packed chunk with the values of ``trees`` in its margins."""
    def run(parts):
        c = _Chunk(parts, b)
        m = c.m
        for t in trees:
            m = m + t["value"][c.step(t, np.zeros(len(m), np.int64), b.depth)]
        return (*parts[:-1], m.tobytes())

    return run


def _round(chunks: RDD, n_chunks: int, b: _Boosting, turn: int) -> dict:
    """One round over many chunks, a job per level."""
    used, tree, active = b.usable(turn), b.start(), [0]
    for level in range(b.depth):
        if not active:
            break
        now, nodes = b.arrays(tree), list(active)

        def sums(parts):
            c = _Chunk(parts, b)
            return b.sums(c, b.slopes(c, turn), c.step(now, np.zeros(len(c.ids), np.int64), level), nodes, used).tobytes()

        added = chunks.mapValues(sums)
        if n_chunks > DIRECT:  # two steps: as many sums as the square root of the chunks reach the driver
            steps = math.isqrt(n_chunks)
            added = added.map(lambda kv: (kv[0] % steps, kv)).groupByKey(steps, int).mapValues(lambda kvs: _added(kvs).tobytes())
        active = b.split(tree, active, b.opened(_added(added.collect()), nodes, used), used)
    return b.arrays(tree)


def _added(numbered) -> np.ndarray:
    """The sum of the arrays, in the order of their numbers."""
    total = 0.0
    for _, v in sorted(numbered):
        total = total + np.frombuffer(v, float)
    return total


def fit_boosted(df: DataFrame, edges, n_rows: int, label: str, weight: str, features: str = "features", maxIter: int = 300,
                stepSize: float = 0.05, maxDepth: int = 6, subsamplingRate: float = 0.8, columnRate: float = 0.8, leafPenalty: float = 1.0,
                minChildWeight: float = 1.0, seed: int = 42, chunk_rows: int = CHUNK_ROWS, fold: int = FOLD) -> TreeModel:
    """Boosted trees with logistic loss: second-order gains, an L2 penalty on
    leaf values, one sample of rows and of slots per tree. Up to ``SHARES``
    tasks of ``SHARE_ROWS`` rows hold a table through all rounds; the chunks of a larger
    one travel with each level's job. The sums and splits are the same."""
    spark, slots = df.sparkSession, len(edges)
    b = _Boosting(edges, seed, stepSize, maxDepth, subsamplingRate, columnRate, leafPenalty, minChildWeight)
    path, n_chunks = shared_dir(spark, "boosting"), max(1, -(-n_rows // chunk_rows))
    packed = _chunks(df, edges, n_chunks, features, label, weight)
    packed.write.mode("overwrite").parquet(f"{path}/0")
    chunks = spark.read.schema(packed.schema).parquet(f"{path}/0")
    n_tasks, trees = min(n_chunks, SHARES, max(1, spark.sparkContext.defaultParallelism)), []
    if n_rows <= n_tasks * max(SHARE_ROWS, chunk_rows):
        trees = _rounds_held(chunks, n_tasks, b, maxIter)
    if len(trees) < maxIter:
        trees = _rounds_over_chunks(chunks, n_chunks, b, maxIter, trees, fold, path)
    drop_dir(spark, path)
    gains, uses = np.zeros(slots), np.zeros(slots)
    for t in trees:
        inner = t["feature"] >= 0
        gains += np.bincount(t["feature"][inner], t["gain"][inner], slots)
        uses += np.bincount(t["feature"][inner], minlength=slots)
    mean = np.divide(gains, uses, out=np.zeros(slots), where=uses > 0)  # mean gain of a slot's splits
    return TreeModel("boosted", edges, trees, mean / mean.sum() if mean.sum() else mean)


def _rounds_over_chunks(stored: DataFrame, n_chunks: int, b: _Boosting, rounds: int, trees: list, fold: int, path: str) -> list[dict]:
    """The rounds after ``trees`` over many chunks, one chunk a partition. After a tree its
    values go into the chunks' margins, kept in memory; every ``fold`` rounds the
    chunks are written, which ends the lineage."""
    sc = stored.sparkSession.sparkContext
    dealt = lambda pairs: pairs.partitionBy(n_chunks, int).persist(StorageLevel.MEMORY_AND_DISK)
    moved = _moved(b, trees)
    chunks, before, trees, written = dealt(stored.rdd.map(lambda r: (r["chunk"], moved([bytes(r[k]) for k in PARTS])))), None, list(trees), f"{path}/0"
    for turn in range(len(trees), rounds):
        trees.append(_round(chunks, n_chunks, b, turn))
        if before is not None:  # the chunks are in memory by now
            before.unpersist()
        if turn + 1 == rounds:
            break
        before, chunks = chunks, chunks.mapValues(_moved(b, trees[-1:])).persist(StorageLevel.MEMORY_AND_DISK)
        if (turn + 1) % fold == 0:
            chunks.saveAsPickleFile(f"{path}/{turn + 1}")
            for old in (before, chunks):
                old.unpersist()
            drop_dir(stored.sparkSession, written)
            written, before = f"{path}/{turn + 1}", None
            chunks = dealt(sc.pickleFile(written))
    chunks.unpersist()
    return trees
