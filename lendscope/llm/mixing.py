"""Mixing sources to target weights by weighted fair queueing.

Each document gets a virtual finish time, the words of its source up to and
including it (in a seeded shuffled order) divided by the source's target; the
documents of all sources, repeated up to ``max_repeats`` times, are sorted by
that time and the sequence is cut at the total budget. Every source then
reaches its target at virtual time 1, give or take a document.

Defined results: a null text has size 0; the null source is a source of its
own, ranked last; sources without words get target 0; ties in the shuffled
order fall to the smaller id; repeated rows are separate documents; an empty
table gives an empty mix; other columns are ignored, whatever their names.

All running totals come from range-partitioned rows plus the totals of the
earlier partitions, so a source that holds most rows spans many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialised, scratch, unused

SEED = 20240229


def running(df: DataFrame, order: list, totals: dict[str, Column]) -> DataFrame:
    """Adds, for each name of ``totals``, the sum of its expression over the
    rows before this one in the global order of ``order``.

    Rows are range-partitioned and written once with their partition number;
    the partitions' sums (a row per partition) are shifted onto the rows.
    """
    ranged = materialised(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranged")
    w_parts = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    w_rows = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("_part").agg(*[F.sum(e).alias(k) for k, e in totals.items()])
    shift = sums.select("_part", *[F.coalesce(F.sum(k).over(w_parts), F.lit(0)).alias(f"_at_{k}") for k in totals])
    out = ranged.select("*", *[F.coalesce(F.sum(e).over(w_rows), F.lit(0)).alias(k) for k, e in totals.items()])
    out = out.join(F.broadcast(shift), "_part")  # a row per range partition
    return out.select(*df.columns, *[(F.col(k) + F.col(f"_at_{k}")).alias(k) for k in totals])


def source_targets(sizes: DataFrame, weights=(3, 1, 2), share: float = 1.5, max_repeats: int = 2) -> DataFrame:
    """(source, source_size, target) from (source, size) rows.

    Weights repeat over the sources in code point order, null last. ``share``
    of all words is dealt out by weight; what a source gets beyond
    ``max_repeats`` times its size is dealt out again among the others. The
    fixed point is min(cap, level * weight): with the sources in the order of
    cap / weight, the level is found where the running totals of caps and
    weights first leave no further source full.
    """
    by_source = materialised(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    named = F.when(F.col("source").isNull(), F.lit(1)).otherwise(F.lit(0))
    ranked = running(by_source.withColumn("_null", named), ["_null", "source"], {"_rank": F.lit(1)})
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    caps = ranked.select("source", "source_size", weight.alias("_w"), (F.col("source_size") * float(max_repeats)).alias("_cap"))
    caps = caps.withColumn("_full", F.col("_cap") / F.col("_w"))
    filled = materialised(running(caps.withColumn("_null", F.col("source").isNull()), ["_full", "_null", "source"],
                                  {"_caps": F.col("_cap"), "_weights": F.col("_w")}), "filled")
    all_words, all_weights = filled.agg(F.sum("source_size"), F.sum("_w")).first()
    budget = share * (all_words or 0)
    level = (F.lit(budget) - F.col("_caps")) / (F.lit(all_weights or 0.0) - F.col("_weights"))
    # sources that tie in _full all qualify or none does; the first of them, whose level is right, has the highest
    first = filled.select("_full", (-level).alias("level")).where("-level <= _full").agg(F.min(F.struct("_full", "level")).alias("m")).first()["m"]
    lam = None if first is None else -first["level"]
    target = F.col("_cap") if lam is None else F.least(F.col("_cap"), F.lit(lam) * F.col("_w"))
    return filled.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, max_repeats: int = 2, seed: int = SEED,
        key: Column | None = None) -> DataFrame:
    """One row per document: doc_id, source, [key,] size, source_size, target,
    copies (times the mix takes it) and taken = copies * size.

    ``key`` adds a column that tells documents apart for a later join.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    key = F.lit(0).cast("long") if key is None else key
    sized = docs.select("doc_id", "source", key.alias("key"), size.alias("size"))
    sized = materialised(sized.withColumn("_shuffled", F.xxhash64(F.lit(seed), "doc_id", "key", "size")), "sized")
    targets = materialised(source_targets(sized, weights, share, max_repeats), "targets")
    t = targets.select(F.col("source").alias("_s"), "source_size", "target")
    placed = running(sized.withColumn("_null", F.col("source").isNull()),
                     ["_null", "source", "_shuffled", "doc_id", "size"], {"_row": F.lit(1), "_words": F.col("size")})
    starts = running(targets.select("source", "source_size", F.col("source").isNull().alias("_null")),
                     ["_null", "source"], {"_start": F.col("source_size")}).select(F.col("source").alias("_t"), "_start")
    placed = placed.join(t.join(starts, t["_s"].eqNullSafe(starts["_t"])), F.col("source").eqNullSafe(F.col("_s")))
    passes = F.greatest(F.lit(1), F.least(F.lit(max_repeats), F.ceil(F.col("target") / F.greatest(F.col("source_size"), F.lit(1)))))
    turns = placed.withColumn("_turn", F.explode(F.sequence(F.lit(0), passes.cast("int") - 1)))
    words = F.col("_turn") * F.col("source_size") + F.col("_words") - F.col("_start") + F.col("size")
    queue = turns.withColumn("_time", F.when(F.col("target") > 0, words / F.col("target")).otherwise(F.lit(float("inf"))))
    keep = ["doc_id", "source", "key", "size", "source_size", "target", "_row", "_time"]
    budget = float(targets.agg(F.sum("target")).first()[0] or 0.0)
    queue = running(queue.select(keep), ["_time", "_row"], {"_before": F.col("size")})
    taken = (F.col("_before") + F.col("size") <= F.lit(budget + 1e-6)) & (F.col("_time") < float("inf"))
    out = queue.groupBy("_row", *keep[:6]).agg(F.sum(taken.cast("long")).alias("copies"))
    return out.select(*keep[:6], "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as many times as it is taken.

    Rows that agree in every column are told apart by count alone.
    """
    row = F.xxhash64(*[F.col(c) for c in docs.columns])
    d, k, own, copies, rows = unused(docs.columns, "_d", "_k", "_key", "_copies", "_rows")
    spark = docs.sparkSession
    with scratch(spark):
        picked = mix(docs, key=row, **settings).groupBy(F.col("doc_id").alias(d), F.col("key").alias(k))
        picked = materialised(picked.agg(F.sum("copies").alias(copies), F.count(F.lit(1)).alias(rows)), "picked", keep=True)
    keyed = docs.withColumn(own, row)
    same = lambda t: keyed["doc_id"].eqNullSafe(t[d]) & (keyed[own] == t[k])
    took_any = F.col(copies) > 0
    once, often = picked.where((F.col(rows) == 1) & took_any), picked.where((F.col(rows) > 1) & took_any)
    took = keyed.join(once, same(once)).select(*docs.columns, copies)
    if not often.isEmpty():  # equal rows: one stands for all of them
        alike = keyed.join(often, same(often)).dropDuplicates([d, own])
        took = took.union(alike.select(*docs.columns, copies))
    return took.withColumn(k, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))).select(docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    from .common import table
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
