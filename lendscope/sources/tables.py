"""Readers for the driver tables and the raw loans view derived from them.

The loans view is the raw input of the first job: one row per order, with
text percentages, ``Mon-YYYY`` months, ``n/a`` tokens and injected missing
values, so that every cleaning rule has something to act on. It is a plain
join/aggregate plan: lineitem is pre-aggregated per order before it meets
orders (both sides end up hash-partitioned on the order key), customer joins
on its key, and nation/region are broadcast (25 and 5 rows by definition of
the schema, independent of scale).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def loans_raw(spark: SparkSession, sf_dir: str, decided_only: bool = False) -> DataFrame:
    """Raw loan applications as text, derived from orders/customer/lineitem.

    ``decided_only`` drops the rows whose status will read ``Current`` (order
    status 'O') at the orders scan. Cleaning drops them anyway, but its filter
    sits above the status CASE expression, which Catalyst cannot push into the
    reader; stated on the source column it reaches the parquet scan, and those
    orders never reach the joins or the shuffle."""
    t = lambda n: table(spark, sf_dir, n)
    li = (t("lineitem")
          .groupBy("l_orderkey")
          .agg(F.count(F.lit(1)).alias("n"),
               F.sum(F.round(F.col("l_discount") * 100).cast("int")).alias("d"),
               F.sum(F.round(F.col("l_tax") * 100).cast("int")).alias("t"),
               F.sum(F.col("l_quantity").cast("int")).alias("q")))
    o = t("orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                           "o_totalprice", "o_orderdate", "o_orderpriority")
    if decided_only:
        st = F.col("o_orderstatus")
        o = o.where(st.isNull() | (st != "O"))
    c = t("customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = t("nation").select("n_nationkey", "n_name", "n_regionkey")
    r = t("region").select("r_regionkey", "r_name")
    j = (o.join(c, o.o_custkey == c.c_custkey)
          .join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))
          .join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"))
          # Both sides are order-sized at any scale: a sort-merge join on the order
          # key, which the per-order aggregate of lineitem is already hashed by.
          .join(li, F.col("l_orderkey") == F.col("o_orderkey"), "left"))
    k, ck = F.col("o_orderkey"), F.col("c_custkey")
    months = F.when(k % 3 == 0, 60).otherwise(36)
    grade = F.substr(F.lit("ABCDE"), F.substr("o_orderpriority", F.lit(1), F.lit(1)).cast("int"), F.lit(1))
    pct = lambda v: F.floor(F.col(v).cast("double") / F.col("n")).cast("int").cast("string")
    return j.select(
        k.alias("row_id"),
        F.when(k % 53 == 0, F.lit(None).cast("double")).otherwise(F.col("o_totalprice")).alias("loan_amnt"),
        F.when(k % 3 == 0, " 60 months").otherwise(" 36 months").alias("term"),
        F.when(k % 97 == 0, "n/a").otherwise(F.concat(F.lit(" "), pct("d"), F.lit("%"))).alias("int_rate"),
        (F.col("o_totalprice") / months).alias("installment"),
        grade.alias("grade"),
        F.concat(grade, (k % 5 + 1).cast("string")).alias("sub_grade"),
        F.when(ck % 13 == 0, "n/a").when(ck % 11 == 0, "< 1 year").when(ck % 11 == 10, "10+ years")
         .otherwise(F.concat((ck % 11).cast("string"), F.lit(" years"))).alias("emp_length"),
        F.when(F.col("r_name") == "AFRICA", "RENT").when(F.col("r_name") == "AMERICA", "OWN")
         .when(F.col("r_name") == "ASIA", "MORTGAGE").otherwise("OTHER").alias("home_ownership"),
        F.col("c_acctbal").alias("annual_inc"),
        F.when(ck % 3 == 0, "Not Verified").when(ck % 3 == 1, "Source Verified")
         .otherwise("Verified").alias("verification_status"),
        F.lower("c_mktsegment").alias("purpose"),
        F.col("n_name").alias("addr_state"),
        (F.col("t").cast("double") / F.col("n")).alias("dti"),
        (F.lit(600) + ck % 50 * 5).cast("double").alias("fico_range_low"),
        (F.lit(604) + ck % 50 * 5).cast("double").alias("fico_range_high"),
        F.col("n").cast("double").alias("open_acc"),
        F.when(k % 89 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(pct("q"), F.lit("%"))).alias("revol_util"),
        F.when(k % 101 == 0, "unknown").otherwise(F.date_format("o_orderdate", "MMM-yyyy")).alias("issue_d"),
        F.when(F.col("o_orderstatus") == "F", "Fully Paid").when(F.col("o_orderstatus") == "O", "Current")
         .when(k % 4 == 0, "Default").otherwise("Charged Off").alias("loan_status"),
    )
