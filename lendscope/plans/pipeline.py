"""The shared front of every registered query: raw scan -> clean -> split.

Kept lazy: each registered query extends this plan, so Catalyst prunes the
columns a query does not use all the way into the parquet scans of the
driver tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import (FIXTURE_SPLITS, YEAR, apply_null_tokens, clean_loans,
                               feature_view, temporal_split)
from ..session import shared_dir
from ..sources.tables import loans_raw

OUT_DECIMAL = "decimal(18,6)"


def r6(c) -> Column:
    """Presentation rounding of doubles to 6 decimals (same cast in the oracle)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(OUT_DECIMAL)


def scan_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_null_tokens(loans_raw(spark, sf_dir))


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Undecided loans are dropped at the orders scan (see ``loans_raw``);
    # ``clean_loans`` applies the same status rule again on the label.
    return clean_loans(apply_null_tokens(loans_raw(spark, sf_dir, decided_only=True)))


def splits(spark: SparkSession, sf_dir: str, ranges=FIXTURE_SPLITS) -> DataFrame:
    return temporal_split(clean(spark, sf_dir), ranges)


_STORED: dict = {}
#: Bytes of a row group of the stored table: tasks can share a file only by its row groups.
ROW_GROUP_BYTES = 4 << 20


def stored_path(spark: SparkSession, sf_dir: str) -> str:
    """Path of the cleaned table, written once as parquet partitioned by
    ``issue_year`` under the session's shared checkpoint location."""
    key = (spark.sparkContext.applicationId, sf_dir)
    path = _STORED.get(key)
    if path is None:
        path = shared_dir(spark, "clean")
        (clean(spark, sf_dir).hint("rebalance", YEAR).write.mode("overwrite").option("parquet.block.size", ROW_GROUP_BYTES)
         .partitionBy(YEAR).parquet(path))
        _STORED[key] = path
    return path


def stored_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned table read back: later jobs (sampling, profiles, drift,
    features, learners) scan it instead of re-running the raw joins, and a
    year filter prunes whole directories."""
    return spark.read.parquet(stored_path(spark, sf_dir))


def split_rows(spark: SparkSession, sf_dir: str, name: str, ranges=FIXTURE_SPLITS) -> DataFrame:
    """Rows of one split: a year-range filter on the partition column."""
    lo, hi = ranges[name]
    return (stored_clean(spark, sf_dir).where(F.col(YEAR).between(lo, hi))
            .withColumn("split", F.lit(name)))


def stored_splits(spark: SparkSession, sf_dir: str, ranges=FIXTURE_SPLITS) -> DataFrame:
    """All split rows with their ``split`` label (years outside every range
    are pruned)."""
    lo = min(a for a, _ in ranges.values())
    hi = max(b for _, b in ranges.values())
    c = stored_clean(spark, sf_dir).where(F.col(YEAR).between(lo, hi))
    return temporal_split(c, ranges)


def split_features(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return feature_view(split_rows(spark, sf_dir, name))


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loan applications as a scoring client sends them: every field as text,
    percentages as plain numbers (no '%'), categories untrimmed."""
    from ..operators.clean import NUMERIC, PERCENT
    from ..operators.score import TEXT_FIELDS
    s = scan_loans(spark, sf_dir)
    cols = [F.col("row_id")]
    for c in NUMERIC:
        v = F.col(c).cast("string")
        cols.append((F.rtrim(v, F.lit("%")) if c in PERCENT else v).alias(c))
    cols += [F.col(c).cast("string").alias(c) for c in TEXT_FIELDS]
    return s.select(*cols)
