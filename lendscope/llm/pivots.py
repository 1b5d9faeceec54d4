"""Exact top-k inner products with a pivot-distance index.

Integer vectors get one more coordinate that brings all of them to the same
length; the largest inner product is then the smallest distance. Each vector
is keyed by its nearest pivot and its distance from it, vectors are sorted by
that key, and stretches of the sorted order are annuli around a pivot. A query
opens annuli in the order of their triangle-inequality bound, some more each
round, until no annulus left can hold a score as good as its k-th best.

Exactness: scores are integer arithmetic; bounds leave room for rounding and
keep ties, so an annulus is passed over only if all it could hold is worse.

Defined results: vectors that are null or hold null or non-finite components
take no part, neither do null ids (see ``vectors.usable`` for repeated ids and
other lengths); components must lie within +-2^22 after scaling, else the
query fails; a query has all candidates if there are fewer than ``k``; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialised, table
from .mixing import running
from .vectors import bisected, distinct_vectors, queries_of, ranked, stacked, usable

SCALE = 256
SAMPLE = 16_384
MOST_PIVOTS = 256
ANNULUS_ROWS = 512
QUERY_ROWS = 2048
OPENED = (2, 12)  # annuli of the first rounds; the last opens all that the bounds leave
LARGEST = 1 << 22


def _keyed(rows: DataFrame, pivots, longest: int) -> DataFrame:
    """node, ids, raw, pivot, far (distance to the nearest pivot)."""
    def run(batches):
        centres, _ = pivots.value
        for b in batches:
            v = np.array(b.column("v").flatten(), dtype=np.int64).reshape(b.num_rows, -1)
            x = lifted(v, longest)
            d = distances(x, centres)
            yield pa.RecordBatch.from_arrays([b.column("node"), b.column("ids"), pa.array([r.tobytes() for r in v], pa.binary()),
                                              pa.array(d.argmin(axis=1)), pa.array(d.min(axis=1))], names=["node", "ids", "raw", "pivot", "far"])

    return rows.select("node", "ids", "v").mapInArrow(run, "node long, ids array<long>, raw binary, pivot long, far double")


def lifted(v: np.ndarray, longest: int) -> np.ndarray:
    """The vectors with a last coordinate that makes every squared length ``longest``."""
    return np.hstack([v.astype(float), np.sqrt(np.maximum(longest - (v * v).sum(axis=1), 0)).astype(float)[:, None]])


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = np.empty((len(x), len(centres)))
    for lo in range(0, len(x), 256):
        out[lo:lo + 256] = np.sqrt(((x[lo:lo + 256, None] - centres[None]) ** 2).sum(axis=2))
    return out


def _to_pivots(rows: DataFrame, pivots) -> DataFrame:
    """node, pivot, away, sq: every query's distance to every pivot, and its squared length."""
    def run(batches):
        centres, _ = pivots.value
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                b = whole.slice(at, 1024)
                v = np.array(b.column("v").flatten(), dtype=np.int64).reshape(b.num_rows, -1)
                d = distances(np.hstack([v.astype(float), np.zeros((len(v), 1))]), centres)
                p = len(centres)
                yield pa.RecordBatch.from_arrays([b.column("node").take(pa.array(np.repeat(np.arange(len(v)), p))), pa.array(np.tile(np.arange(p), len(v))),
                                                  pa.array(d.ravel()), pa.array(np.repeat((v * v).sum(axis=1), p))], names=["node", "pivot", "away", "sq"])

    return rows.select("node", "v").mapInArrow(run, "node long, pivot long, away double, sq long")


def search(df: DataFrame, every: int, k: int = 5, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score (integer inner product of the scaled,
    floored vectors) of the ``k`` best of every row whose id is divisible by
    ``every``."""
    spark = df.sparkSession
    rows = usable(df, lambda c: F.floor(c * scale))
    nodes = distinct_vectors(rows, k)
    queries = queries_of(rows, nodes, every)
    square = F.aggregate("v", F.lit(0).cast("long"), lambda s, c: s + c * c)
    widest, longest, total = nodes.select(F.array_max(F.transform("v", F.abs)).alias("m"), square.alias("s")).agg(F.max("m"), F.max("s"), F.count(F.lit(1))).first()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if widest > LARGEST:
        raise ValueError(f"a scaled component of {widest} is beyond {LARGEST}")
    sample = lifted(np.stack(nodes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("v").toPandas()["v"]).astype(np.int64), longest)
    centres = bisected(sample, max(1, min(MOST_PIVOTS, int(np.sqrt(total)), len(sample))))
    pivots = spark.sparkContext.broadcast((centres, longest))  # at most MOST_PIVOTS vectors
    keyed = running(_keyed(nodes, pivots, longest), ["pivot", "far", "node"], {"_place": F.lit(1)})
    keyed = materialised(keyed.withColumn("annulus", F.floor(F.col("_place") / ANNULUS_ROWS)).drop("_place"), "keyed")
    annuli = keyed.groupBy("pivot", "annulus").agg(F.min("far").alias("low"), F.max("far").alias("high"))
    asked = materialised(nodes.join(queries.select("node").distinct(), "node", "left_semi").select("node", "v"), "asked")
    parts = max(1, -(-asked.count() // QUERY_ROWS))
    gap = F.greatest(F.lit(0.0), F.col("low") - F.col("away"), F.col("away") - F.col("high"))
    slack = 1e-9 * (F.col("sq") + longest) + 1e-6
    # |q - v|^2 = |q|^2 + longest - 2 q.v, so a least distance is a largest score
    bounds = _to_pivots(asked, pivots).join(annuli, "pivot") \
        .select("node", "pivot", "annulus", ((F.col("sq") + longest - gap * gap) / 2 + slack).alias("bound"))
    order = Window.partitionBy("node").orderBy(F.desc("bound"), "pivot", "annulus")
    best = spark.createDataFrame([], "node long, vec_id long, score long")
    left = bounds
    for opened in (*OPENED, None):
        floors = _floors(best, k)
        # an annulus whose bound is below the floor cannot hold a better score
        left = left.join(floors, "node", "left").withColumn("floor", F.coalesce("floor", F.lit(-(2**63)))).where("bound >= floor")
        left = materialised(left, "left")
        turn = left
        if opened:
            turn = materialised(left.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= opened).drop("_r"), "turn")
            left = left.join(turn.select("node", "pivot", "annulus"), ["node", "pivot", "annulus"], "left_anti").drop("floor")
        best = materialised(best.union(_scanned(keyed, turn, asked, parts, k)), "best")
    return ranked(best, queries, k, F.desc("score"))


def _floors(best: DataFrame, k: int) -> DataFrame:
    """(node, floor): the (k + 1)-th best score so far; one more than ``k``, as
    the query itself is among its best."""
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("_r", rank).where(F.col("_r") <= k + 1).where(F.col("_r") == k + 1).select("node", F.col("score").alias("floor"))


def _scanned(keyed: DataFrame, turn: DataFrame, asked: DataFrame, parts: int, k: int) -> DataFrame:
    """(node, vec_id, score): of every opened annulus what is among its k + 1
    best for the query (ties included) and reaches the query's floor."""
    opened = turn.select("node", "pivot", "annulus", "floor").join(asked, "node").withColumn("part", F.pmod(F.xxhash64("node"), F.lit(parts)))
    spread = keyed.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))

    def scan(_, own: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(queries):
            return pd.DataFrame({"node": [], "vec_id": [], "score": []}).astype("int64")
        v, q = stacked(own["raw"], np.int64), np.stack(queries["v"]).astype(np.int64)
        # float products are exact while every partial sum stays below 2^53
        exact = v.shape[1] * float(np.abs(v).max()) * float(np.abs(q).max()) < 2 ** 53
        score = (q.astype(float) @ v.T.astype(float)).astype(np.int64) if exact else q @ v.T
        floor = queries["floor"].to_numpy(np.int64)
        if len(v) > k + 1:
            floor = np.maximum(floor, np.partition(score, len(v) - k - 1, axis=1)[:, len(v) - k - 1])
        at, who = np.nonzero(score >= floor[:, None])
        ids, size = np.concatenate(list(own["ids"])), own["ids"].map(len).to_numpy()
        first, n = (np.cumsum(size) - size)[who], size[who]
        place = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return pd.DataFrame({"node": np.repeat(queries["node"].to_numpy()[at], n), "vec_id": ids[place], "score": np.repeat(score[at, who], n)})

    key = ["pivot", "annulus", "part"]
    return spread.groupBy(*key).cogroup(opened.groupBy(*key)).applyInPandas(scan, "node long, vec_id long, score long")


def query(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), every=50)
