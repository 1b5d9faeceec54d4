"""Exact quantiles and prefix sums of tables of any size.

*Quantiles.* A mergeable sketch per group (``percentile_approx``, partial sums per
task) names for every asked probability a bracket of two values that the exact
rank lies between: the sketch errs by at most 1 / ``ACCURACY`` of the rows, the
bracket reaches twice as far on both sides, and in groups too small for that
it is the whole group. One more pass counts the rows between brackets (a few
numbers per task) and, per value, those inside one; only these are shuffled and
ranked. A rank is looked up exactly and interpolated linearly (NumPy's
"linear" method). A group's values never meet in one task, only those of a
bracket: about 4 / ``ACCURACY`` of the rows, or a group of fewer than 4 *
``ACCURACY`` rows.

*Prefix sums.* Rows are range-partitioned and written once; a partition's
totals are shifted by those of the partitions before it, which are a table,
too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored_table
from .small import null_safe_join

#: Accuracy of the sketch: it errs by at most one row in so many.
ACCURACY = 10_000


def exact_quantiles(long: DataFrame, group: str, value: str, probs, accuracy: int = ACCURACY) -> DataFrame:
    """(group, pi, p, q) for every group with at least one value (NULL and NaN
    are none); ``q`` is the linear-interpolated quantile of probability ``p``.
    Eager up to the counts, which are written once: the rows are read twice."""
    asked = [float(p) for p in probs]
    place = sorted(range(len(asked)), key=asked.__getitem__)
    probs = [asked[i] for i in place]  # ascending, so bracket ends ascend too
    v, slack = F.col("v"), 2.0 / accuracy
    x = long.select(F.col(group).alias("g"), F.col(value).cast("double").alias("v")).where(v.isNotNull() & ~F.isnan(v))
    ends = [max(0.0, p - slack) for p in probs] + [min(1.0, p + slack) for p in probs]
    told = x.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("least"), F.max("v").alias("most"),
                              F.percentile_approx("v", ends, accuracy).alias("ends"))
    small = F.col("n") < 4 * accuracy
    told = stored_table(told.select(
        "g", "n", F.when(small, F.array_repeat("least", len(probs))).otherwise(F.slice("ends", 1, len(probs))).alias("lo"),
        F.when(small, F.array_repeat("most", len(probs))).otherwise(F.slice("ends", len(probs) + 1, len(probs))).alias("hi")), "brackets")
    lo, hi = F.col("lo"), F.col("hi")
    # k: the brackets that begin at or below a value; it is inside one if it is inside the last of them
    k = sum((F.when(v >= lo[i], 1).otherwise(0) for i in range(len(probs))), F.lit(0))
    placed = null_safe_join(x, told.select("g", "lo", "hi"), ["g"]).select("g", "v", "hi", k.alias("k"))
    counted = placed.select("g", "k", F.when(v <= F.get("hi", F.col("k") - 1), v).alias("v")).groupBy("g", "k", "v").agg(F.count(F.lit(1)).alias("c"))
    counted = stored_table(counted, "counted")
    below = counted.groupBy("g").agg(F.array(*[F.sum(F.when(F.col("k") <= i, F.col("c")).otherwise(0)) for i in range(len(probs))]).alias("below"))
    inside = F.filter(F.sequence(F.lit(0), F.lit(len(probs) - 1)), lambda i: (v >= lo[i]) & (v <= hi[i]))
    held = null_safe_join(counted.where(v.isNotNull()), told.select("g", "lo", "hi"), ["g"]).select("g", "v", "c", F.explode(inside).alias("pi"))
    run = F.sum("c").over(Window.partitionBy("g", "pi").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    ranked = null_safe_join(null_safe_join(held.withColumn("run", run), told.select("g", "n"), ["g"]), below, ["g"])
    ranked = (ranked.withColumn("p", F.element_at(F.array(*[F.lit(p) for p in probs]), F.col("pi") + 1))
                    .withColumn("pos", F.col("p") * (F.col("n") - 1))
                    .withColumn("end", F.element_at("below", F.col("pi") + 1) + F.col("run")))
    at = lambda rank: F.max(F.when((F.col("end") - F.col("c") <= rank) & (rank < F.col("end")), F.col("v")))
    found = ranked.groupBy("g", "pi", "p", "pos").agg(at(F.floor("pos")).alias("a"), at(F.ceil("pos")).alias("b"))
    q = F.col("a") + (F.col("b") - F.col("a")) * (F.col("pos") - F.floor("pos"))
    q = F.when(F.col("a").isNull() | F.col("b").isNull(), F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double")).otherwise(q)
    place = F.element_at(F.array(*[F.lit(i) for i in place]), F.col("pi") + 1)
    return found.select(F.col("g").alias(group), place.alias("pi"), "p", q.alias("q"))


def prefix_before(df: DataFrame, by, order: str, value: str, out: str = "before", partitions: int | None = None) -> DataFrame:
    """Adds ``out`` = sum of ``value`` over the rows of the same ``by`` group
    whose ``order`` is smaller (``order`` unique within a group).

    The rows are range-partitioned on (by, order) and written once with their
    partition number. A partition covers a stretch of the order, so the totals
    per (partition, group) are at most partitions + groups rows; their running
    sums are joined back."""
    by = list(by)
    ranged = df.repartitionByRange(*by, order) if partitions is None else df.repartitionByRange(partitions, *by, order)
    ranged = stored_table(ranged.withColumn("_pid", F.spark_partition_id()), "ranged")
    totals = ranged.groupBy("_pid", *by).agg(F.sum(value).alias("_pc"))
    earlier = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # a group's partitions
    offsets = totals.select("_pid", *by, F.coalesce(F.sum("_pc").over(earlier), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_pid", *by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.withColumn("_in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return null_safe_join(summed, offsets, ["_pid", *by]).withColumn(out, F.col("_off") + F.col("_in")).drop("_pid", "_in", "_off")
