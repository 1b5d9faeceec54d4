"""Population drift between a baseline and a current table.

Numeric columns get a 10-quantile PSI, categorical columns the total absolute
difference of category frequencies. Both are computed for *all* columns in
one long-format plan (``unpivot`` is a per-row expansion, no shuffle):

* edges: exact distributed quantiles of the baseline (see ``quantiles``);
* histograms: the long table meets a broadcast edge table (one row per
  feature -- bounded by the schema width, not by the data) and is counted per
  (feature, bin) with map-side partial aggregation, so the shuffle carries
  at most features x bins rows per task;
* categorical: counts per (feature, value) with partial aggregation, totals
  per feature broadcast back.

Values and edges are rounded to 9 decimals so that a value sitting on an
interpolated edge falls in the same bin in every engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import drift_status
from .clean import column_roles
from .quantiles import exact_quantiles

EPS = 1e-4          # Fixed value: proportion given to an empty bin.
PAD = 1e-5          # Fixed value: widening of the outer edges.
SINGLE_PAD = 1e-3   # Fixed value: half-width of the bin of a constant column.
DIGITS = 9
PROBS = [i / 10 for i in range(11)]
SIDE_BASE, SIDE_CUR = "base", "cur"


def _sides(train: DataFrame, prod: DataFrame, num, cat) -> DataFrame:
    """One frame with a ``side`` column: numeric columns as double,
    categorical columns as text."""
    def sel(df, side):
        return df.select(F.lit(side).alias("side"),
                         *[F.col(c).cast("double").alias(c) for c in num],
                         *[F.col(c).cast("string").alias(c) for c in cat])
    return sel(train, SIDE_BASE).unionByName(sel(prod, SIDE_CUR))


def _feature_table(spark, cols) -> DataFrame:
    # One row per column name: bounded by the schema, not by the data.
    return spark.createDataFrame([(c,) for c in cols], "feature string")


def _long(both: DataFrame, cols) -> DataFrame:
    long = both.select("side", *cols).unpivot(["side"], list(cols), "feature", "x")
    x = F.col("x")
    return long.where(x.isNotNull() & ~F.isnan(x)).withColumn("x", F.round(x, DIGITS))


def _edges(both: DataFrame, cols, method: str = "exact") -> DataFrame:
    """(feature, edges, n_base, n_cur, constant_feature) -- one row per
    feature, as a small literal table: extremes and side counts from one
    aggregate, the baseline's quantiles from brackets (see ``quantiles``)."""
    spark = both.sparkSession
    long = _long(both, cols)
    is_b, x = F.col("side") == SIDE_BASE, F.col("x")
    stats = {r["feature"]: r for r in long.groupBy("feature").agg(
        F.min(F.when(is_b, x)).alias("bmin"), F.max(F.when(is_b, x)).alias("bmax"),
        F.min(F.when(~is_b, x)).alias("cmin"), F.max(F.when(~is_b, x)).alias("cmax"),
        F.count_if(is_b).alias("n_base"), F.count_if(~is_b).alias("n_cur")).collect()}  # a row per column
    base, qs = long.where(is_b), {}
    if method == "exact":
        for r in exact_quantiles(base, "feature", "x", PROBS).orderBy("feature", "pi").collect():
            qs.setdefault(r["feature"], []).append(r["q"])
    else:
        for r in base.groupBy("feature").agg(F.percentile_approx("x", PROBS, 100_000).alias("qs")).collect():
            qs[r["feature"]] = list(r["qs"])
    rows = []
    for c in cols:
        st = stats.get(c)
        rows.append((c, qs.get(c), st["bmin"] if st else None, st["bmax"] if st else None,
                     st["cmin"] if st else None, st["cmax"] if st else None,
                     int(st["n_base"]) if st else 0, int(st["n_cur"]) if st else 0))
    lit = spark.createDataFrame(rows, "feature string, q array<double>, bmin double, bmax double, "
                                      "cmin double, cmax double, n_base long, n_cur long")
    # Rounding, de-duplication and the outer-edge fix-up as Spark expressions
    # (same rounding as the values) over the one-row-per-feature table.
    e = F.array_sort(F.array_distinct(F.transform("q", lambda v: F.round(v, DIGITS))))
    lit = lit.withColumn("e", e)
    e, n = F.col("e"), F.size(F.col("e"))
    lo = F.least(e[0], F.col("bmin"), F.col("cmin")) - PAD
    hi = F.greatest(F.element_at(e, -1), F.col("bmax"), F.col("cmax")) + PAD
    fixed = F.when(n == 1, F.array(e[0] - SINGLE_PAD, e[0] + SINGLE_PAD)).otherwise(
        F.concat(F.array(lo), F.slice(e, 2, F.greatest(n - 2, F.lit(0))), F.array(hi)))
    return lit.select("feature", F.transform(fixed, lambda v: F.round(v, DIGITS)).alias("edges"),
                      "n_base", "n_cur", (n == 1).alias("constant_feature"))


def _bins(both: DataFrame, cols, edges: DataFrame) -> DataFrame:
    long = _long(both, cols)
    e = F.col("edges")
    x = F.col("x")
    # bin = number of inner edges (1 .. n-2, at most 9) not above x; written
    # out as plain comparisons so it stays inside whole-stage codegen.
    n_inner = F.size(e) - 2
    bin_ = sum(F.when((n_inner >= k) & (x >= F.try_element_at(e, F.lit(k + 1))), 1).otherwise(0)
               for k in range(1, len(PROBS) - 1))
    binned = (long.join(F.broadcast(edges.select("feature", "edges")), "feature")
                  .where((x >= e[0]) & (x <= F.element_at(e, -1)))
                  .select("feature", "side", bin_.alias("bin")))
    is_b = F.col("side") == SIDE_BASE
    counts = binned.groupBy("feature", "bin").agg(F.count_if(is_b).alias("base_count"),
                                                  F.count_if(~is_b).alias("cur_count"))
    grid = edges.where(e.isNotNull()).select(
        "feature", "n_base", "n_cur",
        F.explode(F.sequence(F.lit(0), F.size(e) - 2)).alias("bin"))
    g = (grid.join(counts, ["feature", "bin"], "left")
             .select("feature", "bin", "n_base", "n_cur",
                     F.coalesce("base_count", F.lit(0)).alias("base_count"),
                     F.coalesce("cur_count", F.lit(0)).alias("cur_count")))
    tp = F.try_divide(F.col("base_count"), F.col("n_base"))  # NULL on an empty side
    cp = F.try_divide(F.col("cur_count"), F.col("n_cur"))
    g = (g.withColumn("tp", F.when(tp == 0, F.lit(EPS)).otherwise(tp))
          .withColumn("cp", F.when(cp == 0, F.lit(EPS)).otherwise(cp)))
    w = Window.partitionBy("feature")  # at most 10 rows per feature
    return g.select("feature", "bin", "base_count", "cur_count", "n_base", "n_cur",
                    (F.col("tp") / F.sum("tp").over(w)).alias("base_prop"),
                    (F.col("cp") / F.sum("cp").over(w)).alias("cur_prop"))


def _psi(both: DataFrame, cols, method: str = "exact") -> DataFrame:
    """(feature, metric, constant_feature); the flag marks a baseline with a
    single edge, whose PSI is 0 whatever the current side does (T3)."""
    edges = _edges(both, cols, method)  # small literal table, one row per feature
    b = _bins(both, cols, edges)
    term = (F.col("cur_prop") - F.col("base_prop")) * F.ln(F.col("cur_prop") / F.col("base_prop"))
    psi = b.groupBy("feature").agg(F.sum(term).alias("psi"),
                                   F.min(F.least("n_base", "n_cur")).alias("nmin"))
    const = edges.select("feature", F.coalesce("constant_feature", F.lit(False)).alias("constant_feature"))
    return (_feature_table(both.sparkSession, cols).join(psi, "feature", "left")
            .join(F.broadcast(const), "feature", "left")
            .select("feature", F.when(F.col("nmin") > 0, F.col("psi"))
                                .otherwise(F.lit(0.0)).alias("metric"),
                    F.coalesce("constant_feature", F.lit(False)).alias("constant_feature")))


def _categorical(both: DataFrame, cols) -> DataFrame:
    long = (both.select("side", *cols).unpivot(["side"], list(cols), "feature", "value")
                .where(F.col("value").isNotNull()))
    is_b = F.col("side") == SIDE_BASE
    vc = long.groupBy("feature", "value").agg(F.count_if(is_b).alias("bc"),
                                              F.count_if(~is_b).alias("cc"))
    tot = vc.groupBy("feature").agg(F.sum("bc").alias("nb"), F.sum("cc").alias("nc"))
    d = (vc.join(F.broadcast(tot), "feature")  # one row per feature
           .groupBy("feature")
           .agg(F.sum(F.abs(F.try_divide(F.col("bc"), F.col("nb"))
                            - F.try_divide(F.col("cc"), F.col("nc")))).alias("m"),
                F.min(F.least("nb", "nc")).alias("nmin")))
    return (_feature_table(both.sparkSession, cols).join(d, "feature", "left")
            .select("feature", F.when(F.col("nmin") > 0, F.col("m"))
                                .otherwise(F.lit(0.0)).alias("metric")))


def psi_edges(train: DataFrame, prod: DataFrame, cols, method: str = "exact") -> DataFrame:
    """(feature, edges, n_base, n_cur, constant_feature) per numeric column."""
    return _edges(_sides(train, prod, cols, []), cols, method)


def psi_bins(train: DataFrame, prod: DataFrame, cols, method: str = "exact") -> DataFrame:
    """(feature, bin, base_count, cur_count, n_base, n_cur, base_prop, cur_prop)."""
    both = _sides(train, prod, cols, [])
    return _bins(both, cols, _edges(both, cols, method))


def numeric_psi(train: DataFrame, prod: DataFrame, cols, method: str = "exact") -> DataFrame:
    """(feature, metric, constant_feature): PSI per numeric column; 0 when a
    side is empty."""
    return _psi(_sides(train, prod, cols, []), cols, method)


def categorical_drift(train: DataFrame, prod: DataFrame, cols) -> DataFrame:
    """(feature, metric): sum over the union of categories of |f_base - f_cur|."""
    return _categorical(_sides(train, prod, [], cols), cols)


def drift_report(train: DataFrame, prod: DataFrame, exclude=(), method: str = "exact",
                 numeric=None, categorical=None) -> DataFrame:
    """(feature, feature_type, metric, constant_feature, drift_status) for
    every column, sorted by metric descending (feature name breaks ties).
    ``constant_feature`` is true for a numeric column whose baseline has one
    distinct value (its PSI is 0 by the reference rule, T3).

    Eager: the report (one row per column) is returned as a small table.
    The sides are not cached: the numeric passes (edge counts, histograms)
    and the categorical pass read disjoint columns, so each one scans only
    its own columns of the columnar input (pruned, with partition filters)
    instead of all of them being written to and read back from a cache.
    """
    num, cat = column_roles(train.schema, drop=tuple(exclude))
    num = numeric if numeric is not None else num
    cat = categorical if categorical is not None else cat
    spark = train.sparkSession
    schema = ("feature string, feature_type string, metric double, constant_feature boolean, "
              "drift_status string")
    parts = []
    if num:
        parts.append(_psi(_sides(train, prod, num, []), num, method)
                     .withColumn("feature_type", F.lit("Numerical")))
    if cat:
        parts.append(_categorical(_sides(train, prod, [], cat), cat)
                     .withColumn("feature_type", F.lit("Categorical"))
                     .withColumn("constant_feature", F.lit(False)))
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.select("feature", "feature_type", "metric", "constant_feature",
                     drift_status(F.col("metric")).alias("drift_status"))
    rows = out.collect()
    return spark.createDataFrame(rows, out.schema).orderBy(F.desc("metric"), "feature")


def drift_summary(report: DataFrame, ratio_limit: float = 0.30) -> DataFrame:
    """One row: counts per status and the refit recommendation."""
    st = F.col("drift_status")
    agg = report.agg(F.count(F.lit(1)).alias("total_features"),
                     F.count_if(st == "No Drift").alias("no_drift"),
                     F.count_if(st == "Moderate Drift").alias("moderate_drift"),
                     F.count_if(st == "Significant Drift").alias("significant_drift"))
    ratio = ((F.col("moderate_drift") + F.col("significant_drift"))
             / F.nullif(F.col("total_features"), F.lit(0)))
    rec = (F.col("significant_drift") > 0) | F.coalesce(F.col("ratio") > ratio_limit, F.lit(False))
    return (agg.withColumn("ratio", ratio)
               .withColumn("retraining_recommended", rec)
               .select("total_features", "no_drift", "moderate_drift", "significant_drift",
                       F.col("ratio").alias("moderate_or_above_ratio"),
                       "retraining_recommended",
                       F.when(F.col("retraining_recommended"), "Retraining Recommended")
                        .otherwise("No Retraining Needed").alias("overall_status")))
