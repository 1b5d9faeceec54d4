"""Approximate nearest neighbours with balanced posting lists.

Centroids come from a balanced clustering of a bounded sample; a navigable
graph over them lives in every task's memory. Each vector is listed under its
nearest centroid and, near a border, under further ones (within a distance
ratio, and not hidden behind one already chosen). A query searches the graph
and opens the nearest lists within a ratio of the nearest one; distances are
then computed exactly in double precision.

How many lists a query opens is measured, not fixed: the neighbours of a sample
of rows are found by brute force over the whole table, and as many lists are
opened as reach ``TARGET`` of them. So it grows with the number of lists where
the vectors call for it, up to all of them.

A long list is cut into blocks, and the queries of a list into blocks too, so
that no task holds a whole hot list.

Defined results: vectors that are null, zero, or hold null or non-finite
components take no part, neither do null ids (see ``vectors.usable`` for
repeated ids and other lengths); a query has all candidates if fewer than
``k`` were reached; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Shipped, materialised, table
from .vectors import best_ids, bisected, distinct_vectors, queries_of, ranked, stacked, usable

SAMPLE = 65_536
LIST_ROWS = 128
MOST_LISTS = 16_384
DEGREE = 16
ENTRIES, OPENED = 32, 4
# A list is hidden by one chosen whose centroid is nearer to its own than HIDE_RATIO times the vector is.
COPIES, COPY_RATIO, HIDE_RATIO = 6, 1.25, 0.3
PROBES, PROBE_RATIO = 64, 1.6  # the least of each
TARGET, CALIBRATING = 0.99, 256
BLOCK_ROWS = 4096


class CentroidGraph:
    """Centroids with pruned nearest-neighbour links, searched best first."""

    def __init__(self, centroids: np.ndarray):
        self.c = centroids
        self.sq = (centroids ** 2).sum(axis=1)
        self.probes, self.ratio = len(centroids), np.inf
        self.links = self._connected(self._neighbours())
        step = max(1, len(centroids) // ENTRIES)
        self.entries = np.arange(0, len(centroids), step)[:ENTRIES]

    def _distances(self, rows: np.ndarray) -> np.ndarray:
        return np.maximum(self.sq[rows][:, None] + self.sq[None] - 2 * self.c[rows] @ self.c.T, 0)

    def _neighbours(self) -> list[list[int]]:
        n, near = len(self.c), min(3 * DEGREE, len(self.c) - 1)
        out: list[list[int]] = [[] for _ in range(n)]
        for lo in range(0, n, 512):
            rows = np.arange(lo, min(lo + 512, n))
            d = self._distances(rows)
            d[np.arange(len(rows)), rows] = np.inf
            for i, own in zip(rows, np.argsort(d, axis=1)[:, :near]):
                chosen: list[int] = []
                for j in own:  # a link is left out where a chosen one leads closer
                    if len(chosen) < DEGREE // 2 and all(((self.c[j] - self.c[c]) ** 2).sum() > d[i - lo, j] for c in chosen):
                        chosen.append(int(j))
                out[i] = chosen
        for i in range(n):
            for j in list(out[i]):
                if i not in out[j] and len(out[j]) < DEGREE:
                    out[j].append(i)
        return out

    def _connected(self, links: list[list[int]]) -> np.ndarray:
        """Links as a padded table, after joining parts that no path connects."""
        n = len(links)
        part = np.full(n, -1)
        for i in range(n):
            if part[i] < 0:
                stack = [i]
                part[i] = i
                while stack:
                    x = stack.pop()
                    for y in links[x]:
                        if part[y] < 0:
                            part[y] = i
                            stack.append(y)
                if i:  # join to the nearest centroid of the parts before
                    own, rest = np.flatnonzero(part == i), np.flatnonzero((part >= 0) & (part < i))
                    if len(rest):
                        d = self._distances(own)[:, rest]
                        a, b = np.unravel_index(d.argmin(), d.shape)
                        links[own[a]].append(int(rest[b]))
                        links[rest[b]].append(int(own[a]))
        wide = max(map(len, links), default=0)
        table_ = np.repeat(np.arange(n)[:, None], max(1, wide), axis=1)
        for i, own in enumerate(links):
            table_[i, :len(own)] = own
        return table_

    def search(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(centroids, distances) of the ``width`` nearest found by walking the
        graph, nearest first, for a block of vectors at once: each step opens
        every vector's ``OPENED`` nearest centroids that are not open yet, until
        all that are kept are open."""
        width = min(width, len(self.c))
        keep = min(len(self.c), max(width, ENTRIES))  # a narrow walk ends in the first hollow
        rows = np.arange(len(x))[:, None]
        near = np.repeat(self.entries[None], len(x), axis=0)
        seen = np.zeros((len(x), len(self.c)), dtype=bool)
        seen[rows, near] = True
        dist = ((x[:, None] - self.c[near]) ** 2).sum(axis=2)
        fresh = np.ones(near.shape, dtype=bool)
        while True:
            order = np.argsort(dist, axis=1, kind="stable")[:, :keep]
            near, dist, fresh = near[rows, order], dist[rows, order], fresh[rows, order]
            fresh &= np.isfinite(dist)
            live = np.flatnonzero(fresh.any(axis=1))
            if not len(live):
                return near[:, :width], np.sqrt(dist[:, :width])
            at = np.argsort(~fresh[live], axis=1, kind="stable")[:, :OPENED]
            still = fresh[live[:, None], at]
            fresh[live[:, None], at] = False
            step = np.where(still[:, :, None], self.links[near[live[:, None], at]], near[live, :1, None]).reshape(len(live), -1)
            step.sort(axis=1)
            new = ~seen[live[:, None], step]
            new[:, 1:] &= step[:, 1:] != step[:, :-1]
            seen[live[:, None], step] = True
            a, b = np.nonzero(new)
            d = np.full(step.shape, np.inf)
            d[a, b] = ((x[live[a]] - self.c[step[a, b]]) ** 2).sum(axis=1)
            wide = (len(x), step.shape[1])
            more, far = np.zeros(wide, dtype=near.dtype), np.full(wide, np.inf)
            more[live], far[live] = step, d
            near, dist, fresh = np.hstack([near, more]), np.hstack([dist, far]), np.hstack([fresh, np.isfinite(far)])

    def ordered(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(centroids, distances) of the ``width`` nearest, by comparing all (only to calibrate)."""
        d = np.sqrt(np.maximum((x ** 2).sum(axis=1)[:, None] + self.sq[None] - 2 * x @ self.c.T, 0))
        near = np.argsort(d, axis=1, kind="stable")[:, :width]
        return near, np.take_along_axis(d, near, axis=1)

    def lists_of(self, x: np.ndarray) -> list[np.ndarray]:
        """The lists that each vector belongs to."""
        near, dist = self.search(x, 4 * COPIES)
        out = []
        for own, d in zip(near, dist):
            chosen = [0]
            for j in range(1, len(own)):
                if len(chosen) == COPIES or not d[j] <= COPY_RATIO * d[0]:
                    break
                if (((self.c[own[chosen]] - self.c[own[j]]) ** 2).sum(axis=1) > (HIDE_RATIO * d[j]) ** 2).all():
                    chosen.append(j)
            out.append(own[chosen])
        return out

    def probes_of(self, x: np.ndarray) -> list[np.ndarray]:
        """The lists that each query opens."""
        near, dist = self.search(x, self.probes)
        limit = np.where(dist[:, 0] > 0, self.ratio * dist[:, 0], np.inf)  # on its centroid a query has no scale
        return [own[np.isfinite(d) & (d <= most + 1e-12)] for own, d, most in zip(near, dist, limit)]

    def calibrate(self, x: np.ndarray, query: np.ndarray, neighbours: np.ndarray) -> float:
        """Set how many lists a query opens and within which ratio, so that the
        queries ``x`` reach ``TARGET`` of their true ``neighbours`` (``query``
        tells whose each is); the share that they reach."""
        if not len(query):
            return 1.0
        n = len(self.c)
        lists = [own for lo in range(0, len(neighbours), 256) for own in self.lists_of(neighbours[lo:lo + 256])]
        order, dist = self.ordered(x, n)
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.broadcast_to(np.arange(n), order.shape), axis=1)
        need = np.array([rank[q, own].min() for q, own in zip(query, lists)])
        self.probes = min(n, max(PROBES, int(np.quantile(need, TARGET, method="higher")) + 1))
        within = need < self.probes
        first = np.where(dist[:, 0] > 0, dist[:, 0], np.inf)
        self.ratio = max(PROBE_RATIO, float((dist[query, need] / first[query])[within].max(initial=0.0)))
        while True:  # the graph may miss near centroids; then open more
            opened = [set(own.tolist()) for own in self.probes_of(x)]
            share = float(np.mean([not opened[q].isdisjoint(own.tolist()) for q, own in zip(query, lists)]))
            if share >= TARGET or self.probes == n:
                return share
            self.probes = min(n, self.probes + max(1, self.probes // 4))


def true_neighbours(nodes: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vectors of a sample of nodes, which of them each neighbour is of, the
    neighbours' vectors): the ``k`` nearest other nodes, by brute force over all."""
    picked = nodes.orderBy(F.xxhash64(F.lit("calibrating"), "node"), "node").limit(CALIBRATING).select("node", "v").toPandas()
    x, own_node = np.stack(picked["v"]).astype(float), picked["node"].to_numpy(np.int64)
    shared = nodes.sparkSession.sparkContext.broadcast((x, own_node))  # CALIBRATING rows

    def nearest(batches):
        q, self_node = shared.value
        best = None  # (distances, nodes, vectors), k a query
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                b = whole.slice(at, 4096)
                v, node = np.array(b.column("v").flatten()).reshape(b.num_rows, -1), b.column("node").to_numpy()
                d = np.maximum((q ** 2).sum(axis=1)[:, None] + (v ** 2).sum(axis=1)[None] - 2 * q @ v.T, 0)
                d[self_node[:, None] == node[None]] = np.inf
                top = np.argsort(d, axis=1)[:, :k]
                new = np.take_along_axis(d, top, axis=1), node[top], v[top]
                if best is not None:
                    new = tuple(np.concatenate(pair, axis=1) for pair in zip(best, new))
                    top = np.argsort(new[0], axis=1)[:, :k]
                    new = np.take_along_axis(new[0], top, axis=1), np.take_along_axis(new[1], top, axis=1), np.take_along_axis(new[2], top[:, :, None], axis=1)
                best = new
        if best is not None:
            i, j = np.nonzero(np.isfinite(best[0]))
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(best[0][i, j]), pa.array(best[1][i, j]), pa.array([r.tobytes() for r in best[2][i, j]], pa.binary())],
                                             names=["query", "d", "node", "raw"])

    rank = F.row_number().over(Window.partitionBy("query").orderBy("d", "node"))
    found = nodes.select("node", "v").mapInArrow(nearest, "query long, d double, node long, raw binary")
    found = found.withColumn("_r", rank).where(F.col("_r") <= k).select("query", "raw").toPandas()
    shared.unpersist()
    return x, found["query"].to_numpy(np.int64), stacked(found["raw"])


def _placed(rows: DataFrame, graph, pick: str, extra: str, kind: str) -> DataFrame:
    """Rows (node, [extra,] v) exploded to their lists, the vector as binary."""
    def run(batches):
        walk = getattr(graph.value, pick)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                x = np.array(b.column("v").flatten()).reshape(b.num_rows, -1)
                lists = walk(x)
                back = pa.array(np.repeat(np.arange(b.num_rows), [len(p) for p in lists]))
                raw = pa.array([r.tobytes() for r in x], pa.binary())
                names = ["node"] + [extra] * bool(extra)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(lists).astype(np.int64)), *[b.column(c).take(back) for c in names], raw.take(back)],
                                                 names=["list", *names, "raw"])

    return rows.mapInArrow(run, f"list long, node long, {f'{extra} {kind}, ' * bool(extra)}raw binary")


def _blocked(rows: DataFrame, name: str, other: str, sizes: DataFrame) -> DataFrame:
    """Deal the rows of a list to its blocks and copy them to every block of the other side."""
    dealt = rows.join(sizes, "list").withColumn(name, F.pmod(F.xxhash64("node"), F.col(f"n_{name}")))
    return dealt.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"n_{other}") - 1))).drop("n_p", "n_q")


def search(df: DataFrame, every: int, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance) of the ``k`` nearest
    found of every row whose id is divisible by ``every``."""
    spark = df.sparkSession
    rows = usable(df, lambda c: c)
    rows = rows.where(F.exists("v", lambda c: c != 0))
    nodes = distinct_vectors(rows, k)
    queries = queries_of(rows, nodes, every)
    total = nodes.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = np.stack(nodes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("v").toPandas()["v"])
    centroids = CentroidGraph(bisected(sample, max(1, min(MOST_LISTS, len(sample) // 4, -(-total // LIST_ROWS)))))
    centroids.calibrate(*true_neighbours(nodes, k))
    graph = Shipped(spark, centroids)
    postings = materialised(_placed(nodes.select("node", "ids", "v"), graph, "lists_of", "ids", "array<long>"), "postings")
    asked = nodes.join(queries.select("node").distinct(), "node", "left_semi").select("node", "v")
    probes = materialised(_placed(asked, graph, "probes_of", "", ""), "probes")
    count = lambda t, name: t.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias(f"n_{name}"))
    sizes = materialised(count(postings, "p").join(count(probes, "q"), "list"), "blocks")

    def scan(_, own: pd.DataFrame, asked_: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"node": [], "vec_id": [], "score": []}).astype({"node": "int64", "vec_id": "int64", "score": "float64"})]
        if len(own) and len(asked_):
            v, ids = stacked(own["raw"]), list(own["ids"])
            sq = (v ** 2).sum(axis=1)
            for node, q in zip(asked_["node"], stacked(asked_["raw"])):
                near = sq - 2 * v @ q  # ranks all; the best are then measured exactly
                top = np.argpartition(near, min(4 * k, len(v) - 1))[:4 * k + 1] if len(v) > 4 * k + 1 else np.arange(len(v))
                out.append(best_ids(node, [ids[t] for t in top], np.sqrt(((v[top] - q) ** 2).sum(axis=1)), k, False))
        return pd.concat(out)

    key = ["list", "p", "q"]
    found = _blocked(postings, "p", "q", sizes).groupBy(*key).cogroup(_blocked(probes, "q", "p", sizes).groupBy(*key)) \
        .applyInPandas(scan, "node long, vec_id long, score double")
    return ranked(found, queries, k, F.col("score"))


def query(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), every=100)
