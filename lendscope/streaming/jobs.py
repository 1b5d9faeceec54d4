"""Structured Streaming jobs: continuous scoring, windowed drift counts and their PSI.

The streams run with ``trigger(availableNow=True)`` into a parquet sink with a
checkpoint next to it. A caller that names the folder (``base``) can run the
stream again there: it resumes after the last committed batch, and the result
is read through the sink's commit log, so every row is there once, whatever
was lost in between. Without a name each run is one of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import drift_status
from ..operators.drift import EPS
from ..operators.quantiles import exact_quantiles
from ..session import shared_dir, stored_table

DIGITS = 9
DECILES = [i / 10 for i in range(11)]
NO_BASELINE = "No Baseline"


def run_to_parquet(stream: DataFrame, spark: SparkSession, name: str,
                   mode: str = "append", base: str | None = None) -> DataFrame:
    """Drain a stream (availableNow) into a parquet sink; read it back.

    ``base`` is the job's folder in shared storage, to be given again after a
    restart; the default is a fresh one."""
    base = base or shared_dir(spark, name)
    out, ckpt = base + "/out", base + "/_checkpoint"
    q = (stream.writeStream.format("parquet").outputMode(mode)
         .option("path", out).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def score_stream(stream: DataFrame, score: Column, key: str = "row_id") -> DataFrame:
    """Stateless per-row scoring of arriving applications (append)."""
    p = score.alias("y_prob")
    return (stream.select(key, p)
                  .withColumn("y_pred", (F.col("y_prob") > 0.5).cast("int"))
                  .withColumn("prediction_label",
                              F.when(F.col("y_pred") == 1, "High Risk").otherwise("Low Risk")))


def score_stream_model(stream: DataFrame, model, key: str = "row_id") -> DataFrame:
    """Streaming scoring with a fitted version (transform + learner): the
    pipeline is stateless per row, so it runs unchanged on micro-batches."""
    from ..operators.score import risk_bands, positive_prob
    out = model.transform(stream).select(key, positive_prob().alias("y_prob"),
                                         F.col("prediction").cast("int").alias("y_pred"))
    return risk_bands(out)


def baseline_edges(baseline: DataFrame, group: str, value: str) -> DataFrame:
    """Frozen decile edges per group from a batch baseline: (group, inner)
    where ``inner`` are the distinct interior edges (rounded to 9)."""
    q = exact_quantiles(baseline.select(group, F.round(F.col(value).cast("double"), DIGITS).alias(value)),
                        group, value, DECILES)
    e = q.groupBy(group).agg(F.array_sort(F.collect_set(F.round("q", DIGITS))).alias("e"))
    n = F.size("e")
    inner = F.slice("e", 2, F.greatest(n - 2, F.lit(0)))
    # One row per group, written once: its size is known to the stream's join.
    return stored_table(e.select(F.col(group).cast("string").alias(group), inner.alias("inner")), "stream-edges")


def _bin(value: str) -> Column:
    """Number of inner edges not above the value; 0 without edges or value."""
    x = F.round(F.col(value).cast("double"), DIGITS)
    inner = F.coalesce("inner", F.array().cast("array<double>"))
    return sum(F.when((F.size(inner) >= k) & (x >= F.try_element_at(inner, F.lit(k))), 1).otherwise(0)
               for k in range(1, len(DECILES) - 1))


def drift_stream(stream: DataFrame, edges: DataFrame, group: str, value: str, ts: str,
                 window: str = "7 days", watermark: str = "1 day") -> DataFrame:
    """Counts per (tumbling window, group, bin) of arriving values against
    frozen edges; windows are emitted once the watermark closes them.
    A group the baseline does not have is counted in bin 0, as is a missing
    value. Window bounds are epoch seconds (UTC), independent of the session zone."""
    # Event times are wall-clock (timestamp_ntz) in UTC: read them as UTC
    # instants whatever the session time zone is.
    tz = stream.sparkSession.conf.get("spark.sql.session.timeZone")
    s = (stream.withColumn(ts, F.from_utc_timestamp(F.col(ts).cast("timestamp"), tz))
               .withWatermark(ts, watermark)
               .join(edges, group, "left")  # one row per group; hinted by baseline_edges
               .select(ts, group, _bin(value).alias("bin")))
    return (s.groupBy(F.window(ts, window).alias("w"), group, "bin")
             .agg(F.count(F.lit(1)).alias("n"))
             .select(F.unix_seconds(F.col("w.start")).alias("window_start"),
                     F.unix_seconds(F.col("w.end")).alias("window_end"), group, "bin", "n"))


def window_psi(counts: DataFrame, baseline: DataFrame, edges: DataFrame, group: str, value: str) -> DataFrame:
    """(window_start, window_end, group, n_cur, psi, drift_status) of the closed
    windows that :func:`drift_stream` emitted, against the baseline behind
    ``edges``.

    Missing values count in bin 0 on both sides; an empty bin gets ``EPS``. A
    group without a baseline (a null group has none) has no PSI and the status
    ``No Baseline``. The baseline shrinks to ten counts a group by partial
    aggregation before any join.
    """
    had = (baseline.select(group, value).join(edges, group).select(group, _bin(value).alias("bin"))
                   .groupBy(group, "bin").agg(F.count(F.lit(1)).alias("base")))
    grid = edges.select(group, F.explode(F.sequence(F.lit(0), F.size("inner"))).alias("bin"))
    grid = grid.join(had, [group, "bin"], "left").withColumn("base", F.coalesce("base", F.lit(0)))
    grid = grid.withColumn("tp", F.col("base") / F.sum("base").over(Window.partitionBy(group)))  # at most 10 rows
    at = ["window_start", "window_end"]
    total = counts.groupBy(*at, group).agg(F.sum("n").alias("n_cur"))
    now = counts.select(*at, group, "bin", "n")
    full = total.join(grid, group, "left").join(now, [*at, group, "bin"], "left")
    cp = F.coalesce("n", F.lit(0)) / F.col("n_cur")
    full = full.select(*at, group, "n_cur", F.when(F.col("tp") == 0, EPS).otherwise(F.col("tp")).alias("tp"),
                       F.when(cp == 0, EPS).otherwise(cp).alias("cp"))
    w = Window.partitionBy(*at, group)  # at most 10 rows
    share = full.select(*at, group, "n_cur", (F.col("tp") / F.sum("tp").over(w)).alias("b"),
                        (F.col("cp") / F.sum("cp").over(w)).alias("c"))
    psi = share.groupBy(*at, group, "n_cur").agg(F.sum((F.col("c") - F.col("b")) * F.ln(F.col("c") / F.col("b"))).alias("psi"))
    return psi.withColumn("drift_status", F.when(F.col("psi").isNull(), NO_BASELINE).otherwise(drift_status("psi")))
