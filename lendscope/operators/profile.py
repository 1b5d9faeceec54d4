"""Profiles and checks: one aggregate pass each, results as small tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .clean import FIXTURE_SPLITS, HELPERS, LABEL, SPLIT, YEAR


def prep_counts(raw: DataFrame, kept_status: list, year_col_expr) -> DataFrame:
    """rows_read, rows_status_kept, rows_kept (status kept and month parsed)."""
    st = F.col(LABEL).isin(kept_status)
    return raw.agg(F.count(F.lit(1)).alias("rows_read"),
                   F.count_if(st).alias("rows_status_kept"),
                   F.count_if(st & year_col_expr.isNotNull()).alias("rows_kept"))


def year_counts(clean: DataFrame, sampled: DataFrame) -> DataFrame:
    """(issue_year, available, sampled) per year."""
    a = clean.groupBy(YEAR).agg(F.count(F.lit(1)).alias("available"))
    s = sampled.groupBy(YEAR).agg(F.count(F.lit(1)).alias("sampled"))
    return (a.join(s, YEAR, "left")
             .select(YEAR, "available", F.coalesce("sampled", F.lit(0)).alias("sampled")))


def _missing(df: DataFrame, c: str):
    """NULL, or NaN in a floating column."""
    x = F.col(c)
    return x.isNull() | F.isnan(x) if dict(df.dtypes)[c] in ("double", "float") else x.isNull()


def missing_by_column(df: DataFrame, cols=None) -> DataFrame:
    """(column_name, missing) for every column, from one wide aggregate."""
    cols = cols or df.columns
    wide = df.agg(*[F.count_if(_missing(df, c)).alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "missing")


def class_distribution(df: DataFrame, label: str = LABEL) -> DataFrame:
    """(label, count, percent) -- percent of all rows, 0..100."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())  # one row per class
    return c.select(label, "count", (F.col("count") * 100.0 / total).alias("percent"))


def split_report(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Per split: rows, feature count, default rate, year range, missing cells."""
    feats = [c for c in df.columns if c not in HELPERS]
    missing = sum(F.count_if(_missing(df, c)) for c in feats)
    return (df.groupBy(SPLIT)
              .agg(F.count(F.lit(1)).alias("rows"),
                   F.lit(len(feats)).alias("features"),
                   F.avg(label).alias("default_rate"),
                   F.min(YEAR).alias("min_year"), F.max(YEAR).alias("max_year"),
                   missing.alias("missing_cells")))


def split_missing(df: DataFrame) -> DataFrame:
    """(split, column_name, missing) for every feature column of every split."""
    feats = [c for c in df.columns if c not in HELPERS]
    wide = df.groupBy(SPLIT).agg(*[F.count_if(_missing(df, c)).alias(c) for c in feats])
    return wide.unpivot([SPLIT], feats, "column_name", "missing")


def split_violations(stored: DataFrame, clean: DataFrame, ranges=FIXTURE_SPLITS) -> DataFrame:
    """Audit of (split, issue_year): rows and whether the year belongs to it.

    Rows of ``clean`` whose year is in no range appear with split NULL, so
    silently dropped years are visible too.
    """
    spark = stored.sparkSession
    exp = spark.createDataFrame([(k, lo, hi) for k, (lo, hi) in ranges.items()],
                                "split string, lo int, hi int")  # one row per split
    got = stored.groupBy(SPLIT, YEAR).agg(F.count(F.lit(1)).alias("rows"))
    audit = (got.join(F.broadcast(exp), SPLIT, "left")
                .select(SPLIT, YEAR, "rows",
                        F.coalesce(F.col(YEAR).between(F.col("lo"), F.col("hi")),
                                   F.lit(False)).alias("valid")))
    y = F.col(YEAR)
    in_any = None
    for lo, hi in ranges.values():
        in_any = y.between(lo, hi) if in_any is None else in_any | y.between(lo, hi)
    dropped = (clean.where(~in_any).groupBy(YEAR).agg(F.count(F.lit(1)).alias("rows"))
                    .select(F.lit(None).cast("string").alias(SPLIT), YEAR, "rows",
                            F.lit(False).alias("valid")))
    return audit.unionByName(dropped)


def training_checks(features: DataFrame, labels: DataFrame, key: str = "row_id",
                    label: str = LABEL) -> DataFrame:
    """One row: row counts of X and y, unmatched keys, missing cells, verdict.

    One full outer join on the key (both sides hash-partitioned by it) and
    one aggregate; X and y are never paired by position.
    """
    feats = [c for c in features.columns if c != key]
    miss = sum(F.col(c).isNull().cast("long") for c in feats)
    fx = features.select(key, F.lit(True).alias("_x"), miss.alias("_mx"))
    fy = labels.select(key, F.lit(True).alias("_y"), F.col(label).isNull().alias("_my"))
    out = fx.join(fy, key, "full_outer").agg(
        F.count("_x").alias("rows_x"), F.count("_y").alias("rows_y"),
        F.count_if(F.col("_x").isNull() | F.col("_y").isNull()).alias("unmatched"),
        F.coalesce(F.sum("_mx"), F.lit(0)).alias("missing_x"),
        F.count_if(F.col("_my")).alias("missing_y"))
    ok = ((F.col("rows_x") == F.col("rows_y")) & (F.col("unmatched") == 0)
          & (F.col("missing_x") == 0) & (F.col("missing_y") == 0))
    return out.select("rows_x", "rows_y", "unmatched", "missing_x", "missing_y", ok.alias("passed"))


def join_labels(features: DataFrame, labels: DataFrame, key: str = "row_id") -> DataFrame:
    """Features and labels stored apart, paired by key (never by position)."""
    return features.join(labels, key, "inner")


def combine(train: DataFrame, prod: DataFrame) -> DataFrame:
    """Refit training set: baseline rows plus current rows."""
    return train.unionByName(prod)
