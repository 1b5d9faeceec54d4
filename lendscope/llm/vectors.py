"""Vector tables for the search operators.

Rows with equal vectors are searched once: a row of a distinct vector carries
its ``k + 1`` smallest ids, which is all that any result of ``k`` neighbours
besides the query itself can hold.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialised


def usable(df: DataFrame, component) -> DataFrame:
    """(vec_id, v) of the rows that take part: id and vector not null, every
    component finite; ``component`` maps a double component to its value. Of
    rows that repeat an id the smallest vector counts; vectors of another than
    the most common length (the shorter, of equally common) take no part."""
    x = F.col("embedding").cast("array<double>")
    odd = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where("vec_id IS NOT NULL AND x IS NOT NULL AND size(x) > 0").where(~odd)
    rows = rows.select("vec_id", F.transform("x", component).alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))
    rows = materialised(rows, "vectors")
    length = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (length["d"] if length else 0))


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(node, ids, v): each distinct vector with its k + 1 smallest ids, the
    first of them being its node. Ranks are limited before the shuffle, so a
    vector that a third of the rows share brings few of them along."""
    rank = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = rows.withColumn("_r", rank).where(F.col("_r") <= k + 1)
    ids = few.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    return materialised(ids.select(F.element_at("ids", 1).alias("node"), "ids", "v"), "distinct")


def queries_of(rows: DataFrame, nodes: DataFrame, every: int) -> DataFrame:
    """(query_id, node) of the rows whose id is divisible by ``every``."""
    asked = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "v")
    return materialised(asked.join(nodes.select("node", "v"), "v").select("query_id", "node"), "queries")


def stacked(column, dtype=np.float64) -> np.ndarray:
    """A matrix from a column of little-endian binary vectors."""
    rows = list(column)
    return np.frombuffer(b"".join(rows), dtype=dtype).reshape(len(rows), -1) if rows else np.zeros((0, 0), dtype)


def best_ids(node, ids: list, value: np.ndarray, k: int, largest: bool) -> pd.DataFrame:
    """The k + 1 best (value, id) of one query among candidate vectors."""
    firsts = np.array([i[0] for i in ids])
    top = np.lexsort((firsts, -value if largest else value))[:k + 1]
    flat = [(value[t], i) for t in top for i in ids[t]]
    flat.sort(key=lambda x: (-x[0] if largest else x[0], x[1]))
    return pd.DataFrame({"node": node, "vec_id": [i for _, i in flat[:k + 1]], "score": [s for s, _ in flat[:k + 1]]})


def ranked(found: DataFrame, queries: DataFrame, k: int, order: Column) -> DataFrame:
    """query_id, rank, vec_id, score: per query its k best of (node, vec_id,
    score) rows, the query's own id left out."""
    unique = found.groupBy("node", "vec_id").agg(F.first("score").alias("score"))
    few = unique.withColumn("_r", F.row_number().over(Window.partitionBy("node").orderBy(order, "vec_id"))).where(F.col("_r") <= k + 1)
    own = queries.join(few, "node").where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(order, "vec_id"))
    return own.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def bisected(points: np.ndarray, parts: int, low: float = 0.35, rounds: int = 4) -> np.ndarray:
    """Centres of a balanced hierarchical clustering: the largest part is cut
    in two by 2-means, the cut moved so that each side keeps at least ``low``."""
    import heapq
    heap, seq = [(-len(points), 0, np.arange(len(points)))], 1
    done = []
    while heap and len(heap) + len(done) < parts:
        _, _, own = heapq.heappop(heap)
        x = points[own]
        if len(own) < 2 or (x == x[0]).all():
            done.append(own)
            continue
        a = x[0]
        b = x[((x - a) ** 2).sum(axis=1).argmax()]
        for _ in range(rounds):
            side = ((x - a) ** 2).sum(axis=1) > ((x - b) ** 2).sum(axis=1)
            if side.all() or not side.any():
                break
            a, b = x[~side].mean(axis=0), x[side].mean(axis=0)
        order = np.argsort(x @ (b - a), kind="stable")
        cut = int(np.clip((~side).sum(), max(1, int(low * len(own))), len(own) - max(1, int(low * len(own)))))
        for half in (own[order[:cut]], own[order[cut:]]):
            heapq.heappush(heap, (-len(half), seq, half))
            seq += 1
    return np.stack([points[own].mean(axis=0) for own in [h[2] for h in heap] + done])
