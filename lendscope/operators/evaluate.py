"""Binary-classifier evaluation over a scored table.

Input rows: (by..., y_true 0/1, y_pred 0/1, y_prob). All metrics are
aggregates grouped by ``by`` (e.g. model and split), so any number of models
is evaluated in one pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quantiles import prefix_before

THRESHOLD = 0.5


def predict_from_prob(prob) -> "F.Column":
    """Class 1 iff probability of class 1 is above 0.5."""
    return (prob > THRESHOLD).cast("int")


def confusion(df: DataFrame, by=("model_name",), y="y_true", p="y_pred", extra=()) -> DataFrame:
    t, q = F.col(y), F.col(p)
    return df.groupBy(*by).agg(F.count_if((t == 0) & (q == 0)).alias("tn"),
                               F.count_if((t == 0) & (q == 1)).alias("fp"),
                               F.count_if((t == 1) & (q == 0)).alias("fn"),
                               F.count_if((t == 1) & (q == 1)).alias("tp"), *extra)


def _safe_div(a, b):
    return F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))


def metrics_from_counts(c: DataFrame) -> DataFrame:
    """accuracy, precision, recall, f1 from tn/fp/fn/tp; 0 when undefined."""
    tn, fp, fn, tp = (F.col(x).cast("double") for x in ("tn", "fp", "fn", "tp"))
    prec = _safe_div(tp, tp + fp)
    rec = _safe_div(tp, tp + fn)
    return (c.withColumn("accuracy", _safe_div(tp + tn, tp + tn + fp + fn))
             .withColumn("precision", prec).withColumn("recall", rec)
             .withColumn("f1_score", _safe_div(2 * tp, 2 * tp + fp + fn)))


def binary_metrics(df: DataFrame, by=("model_name",)) -> DataFrame:
    return metrics_from_counts(confusion(df, by))


def roc_auc(df: DataFrame, by=("model_name",), y="y_true", score="y_prob", digits: int | None = None) -> DataFrame:
    """Exact ROC-AUC (ties count 1/2) per group; NULL with one class only.

    Positives and negatives are counted per distinct score (map-side partial
    aggregation). The negatives ranked below each score are a prefix sum over
    range partitions, so a group spans many tasks. ``digits`` optionally rounds
    scores first.
    """
    s = F.col(score) if digits is None else F.round(F.col(score), digits)
    by = list(by)
    g = (df.select(*by, s.alias("_s"), F.col(y).alias("_y"))
           .groupBy(*by, "_s")
           .agg(F.count_if(F.col("_y") == 1).alias("_pos"), F.count_if(F.col("_y") == 0).alias("_neg")))
    return _ranked(g, by).select(*by, "positives", "negatives", "roc_auc")


def _ranked(g: DataFrame, by: list, sums=()) -> DataFrame:
    """positives, negatives, roc_auc and the totals of ``sums`` per group, from
    counts (_pos, _neg) per distinct score _s."""
    agg = prefix_before(g, by, "_s", "_neg", out="_below").groupBy(*by).agg(
        F.sum(F.col("_pos") * (F.col("_below") + 0.5 * F.col("_neg"))).alias("_num"),
        F.sum("_pos").alias("positives"), F.sum("_neg").alias("negatives"), *[F.sum(c).alias(c) for c in sums])
    auc = F.col("_num") / (F.col("positives") * F.col("negatives"))
    return agg.withColumn("roc_auc", F.when((F.col("positives") > 0) & (F.col("negatives") > 0), auc))


def classification_report(df: DataFrame, by=("model_name",)) -> DataFrame:
    """Per class precision/recall/f1/support, accuracy, macro and weighted avg."""
    by = list(by)
    c = confusion(df, by)
    d = lambda a, b: _safe_div(a.cast("double"), b.cast("double"))
    tn, fp, fn, tp = F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp")
    n0, n1 = tn + fp, fn + tp
    p0, r0 = d(tn, tn + fn), d(tn, tn + fp)
    p1, r1 = d(tp, tp + fp), d(tp, tp + fn)
    f0, f1 = d(2 * tn, 2 * tn + fn + fp), d(2 * tp, 2 * tp + fp + fn)
    tot = (n0 + n1).cast("double")
    acc = d(tp + tn, n0 + n1)
    rows = F.array(
        F.struct(F.lit("0").alias("label"), p0.alias("precision"), r0.alias("recall"), f0.alias("f1_score"), n0.alias("support")),
        F.struct(F.lit("1").alias("label"), p1.alias("precision"), r1.alias("recall"), f1.alias("f1_score"), n1.alias("support")),
        F.struct(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), acc.alias("f1_score"), (n0 + n1).alias("support")),
        F.struct(F.lit("macro avg").alias("label"), ((p0 + p1) / 2).alias("precision"), ((r0 + r1) / 2).alias("recall"),
                 ((f0 + f1) / 2).alias("f1_score"), (n0 + n1).alias("support")),
        F.struct(F.lit("weighted avg").alias("label"), ((p0 * n0 + p1 * n1) / tot).alias("precision"),
                 ((r0 * n0 + r1 * n1) / tot).alias("recall"), ((f0 * n0 + f1 * n1) / tot).alias("f1_score"),
                 (n0 + n1).alias("support")))
    return c.select(*by, F.inline(rows))


def evaluation(df: DataFrame, by=("model_name",)) -> DataFrame:
    """Confusion counts, the four threshold metrics and ROC-AUC per group. The
    rows are scored once: all of it comes from counts per distinct score."""
    by = list(by)
    t, cells = F.col("y_true"), ["tn", "fp", "fn", "tp"]
    g = confusion(df.withColumn("_s", F.col("y_prob")), [*by, "_s"], extra=[F.count_if(t == 1).alias("_pos"), F.count_if(t == 0).alias("_neg")])
    m = _ranked(g, by, cells)
    return metrics_from_counts(m.select(*by, *cells, "roc_auc")).select(*by, *cells, "accuracy", "precision", "recall", "f1_score", "roc_auc")
