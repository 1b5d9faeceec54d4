"""Exact-size stratified sampling without replacement, and seeded ordering.

Quota: largest-remainder split of a per-year cap ``n`` over the label
classes, in integer arithmetic (``floor(count * n / total)``, leftover units
to the largest remainders). Years with at most ``n`` rows are kept whole.

Cap: inside each stratum the rows with the smallest
``md5(seed || '_' || key)`` are kept. A per-stratum window would put a whole
stratum (possibly a third of the table) into one task, so the cut is located
from counts instead:

1. every row gets a bucket = the first ``b`` bits of its hash; counts per
   (stratum, bucket) are aggregated map-side (at most strata x 2^b rows);
2. a running sum over those counts finds, per stratum, the bucket in which
   the quota is reached and how many rows of it are still needed;
3. rows in earlier buckets are kept by a plain broadcast filter; only the
   rows of that one boundary bucket (about 2^-b of the stratum) are
   ranked exactly by the full hash.

``b`` is 16 up to strata of 2^32 rows and grows with the largest stratum
beyond that (about half its bit length, in steps of 4), so the per-stratum
count table and the boundary bucket -- each ranked in one task -- both stay
near the square root of the stratum size.

The result is exactly the ``quota`` smallest hashes of each stratum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored_table
from .quantiles import prefix_before
from .small import null_safe_join

SEED = 42
MIN_BUCKET_HEX, MAX_BUCKET_HEX = 4, 7  # 16 to 28 bits of the hash


def bucket_hex(largest: int | None) -> int:
    """Hex digits of the bucket prefix for a largest stratum of ``largest`` rows."""
    if not largest or largest <= 1:
        return MIN_BUCKET_HEX
    half_bits = (int(largest - 1).bit_length() + 1) // 2
    return max(MIN_BUCKET_HEX, min(MAX_BUCKET_HEX, -(-half_bits // 4)))


def order_key(key, seed: int = SEED):
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat_ws("_", F.lit(str(seed)), k.cast("string")))


def strata_quota(df: DataFrame, n: int, by: str = "issue_year",
                 label: str = "loan_status") -> DataFrame:
    """(by, label, available, quota) with integer largest-remainder quotas."""
    c = df.groupBy(by, label).agg(F.count(F.lit(1)).alias("available"))
    w = Window.partitionBy(by)  # one row per class: a handful per year
    c = (c.withColumn("total", F.sum("available").over(w))
          .withColumn("base", F.expr(f"available * {int(n)} div total"))
          .withColumn("rem", F.expr(f"available * {int(n)} % total")))
    c = c.withColumn("left", F.lit(int(n)) - F.sum("base").over(w))
    order = Window.partitionBy(by).orderBy(F.desc("rem"), F.desc("available"), F.asc(label))
    c = c.withColumn("pos", F.row_number().over(order))
    quota = F.when(F.col("total") <= n, F.col("available")).otherwise(
        F.col("base") + F.when(F.col("pos") <= F.col("left"), 1).otherwise(0))
    return c.select(by, label, "available", quota.cast("long").alias("quota"))


def hash_cap(df: DataFrame, quotas: DataFrame, strata, key: str,
             seed: int = SEED, quota_col: str = "quota") -> DataFrame:
    """Rows of ``df`` with the ``quota`` smallest hashes of ``key`` per stratum.

    ``quotas`` and the cut table have one row per stratum and are written once,
    so the joins know their sizes.
    """
    strata = list(strata)
    has_avail = "available" in quotas.columns
    sel = quotas.select(*strata, F.col(quota_col).alias("_q"),
                        *(["available"] if has_avail else []))
    q = stored_table(sel, "quotas")
    # Largest stratum from the written quota table (no pass over the data).
    largest = q.agg(F.max("available")).first()[0] if has_avail else None
    digits = bucket_hex(largest)
    h = order_key(key, seed)
    keyed = df.withColumn("_h", h).withColumn(
        "_b", F.conv(F.substring("_h", 1, digits), 16, 10).cast("int"))
    cnt = keyed.groupBy(*strata, "_b").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*strata).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    cum = null_safe_join(cnt.withColumn("_cum", F.sum("_c").over(w)), q.select(*strata, "_q"), strata)
    # Boundary bucket per stratum: first bucket whose running count reaches q.
    # Strata whose quota is not below their rows keep everything.
    reached = (F.col("_cum") >= F.col("_q")) & (F.col("_q") > 0)
    need = F.struct("_b", (F.col("_q") - (F.col("_cum") - F.col("_c"))).alias("_need"))
    lim = (cum.groupBy(*strata)
              .agg(F.min(F.when(reached, need)).alias("m"), (F.max("_cum") <= F.max("_q")).alias("_all"))
              .select(*strata, F.col("m._b").alias("_cut"), F.col("m._need").alias("_need"), "_all"))
    tagged = null_safe_join(keyed, stored_table(lim, "cuts"), strata)  # one row per stratum
    below = tagged.where(F.col("_all") | (F.col("_b") < F.col("_cut")))
    edge = tagged.where(~F.col("_all") & (F.col("_b") == F.col("_cut")))
    rk = Window.partitionBy(*strata, "_b").orderBy("_h")
    edge = edge.withColumn("_r", F.row_number().over(rk)).where(F.col("_r") <= F.col("_need"))
    cols = df.columns
    return below.select(*cols).unionByName(edge.select(*cols))


def stratified_cap(df: DataFrame, n: int, by: str = "issue_year", label: str = "loan_status",
                   key: str = "row_id", seed: int = SEED) -> DataFrame:
    """Exactly ``quota`` rows per (year, class); see module docstring."""
    q = strata_quota(df, n, by, label)
    return hash_cap(df, q, [by, label], key, seed)


def seeded_order(df: DataFrame, key: str = "row_id", seed: int = SEED) -> DataFrame:
    """Global seeded shuffle: a range-partitioned sort on the hash key."""
    return df.withColumn("shuffle_key", order_key(key, seed)).orderBy("shuffle_key", key)


def seeded_positions(df: DataFrame, key: str = "row_id", seed: int = SEED) -> DataFrame:
    """Every row with ``shuffle_key`` and its 0-based ``shuffle_pos`` in the
    seeded global order (hash, then key).

    A global ``row_number`` would put the whole table in one task; instead the
    rows are range-partitioned on the order and each position is the count
    of rows before it (``prefix_before``: running counts per partition plus
    the totals of earlier partitions)."""
    o = (df.withColumn("shuffle_key", order_key(key, seed))
           .withColumn("_ord", F.struct("shuffle_key", F.col(key)))
           .withColumn("_one", F.lit(1).cast("long")))
    return prefix_before(o, [], "_ord", "_one", out="shuffle_pos").drop("_ord", "_one")
