"""Model metric records, the comparison rule, ranking and the version table.

Records: one row per (segment, model) with accuracy, precision, recall,
f1_score, roc_auc, training_time. The comparison rule is a column
expression over two records; ranking counts a record's wins by it inside the
array of its segment's records, never as an all-pairs join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Comparison thresholds.
AUC_GAP = 0.005
TIE_EPS = 1e-6
# Promotion tolerance on F1.
F1_TOLERANCE = 0.01
# Metric files skipped when reading records.
SKIP_SUFFIX, SKIP_NAME, SKIP_PART = "_v1.json", "model_registry.json", "comparison"

METRIC_SCHEMA = T.StructType([
    T.StructField("model_name", T.StringType()),
    T.StructField("training_time_seconds", T.DoubleType()),
    T.StructField("metrics", T.StructType([
        T.StructField(n, T.DoubleType()) for n in
        ("accuracy", "precision", "recall", "f1_score", "roc_auc")])),
    T.StructField("confusion_matrix", T.StructType([
        T.StructField(n, T.LongType()) for n in ("tn", "fp", "fn", "tp")])),
])


def read_metric_records(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """All metric documents under ``path`` except archived ``*_v1.json``,
    the registry and comparison files; records without a name or any of the
    five metrics are skipped, a missing training time is 0.0."""
    df = (spark.read.schema(METRIC_SCHEMA).option("multiLine", multi_line)
          .option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true").json(path))
    # Logical file name: the document's own name, or for records written by
    # ``write_metric_files`` the folder name ``file_name=<name>``.
    folder = F.regexp_extract(F.col("_metadata.file_path"), "file_name=([^/]+)/[^/]*$", 1)
    fname = F.coalesce(F.nullif(folder, F.lit("")), F.col("_metadata.file_name"))
    keep = (~fname.endswith(SKIP_SUFFIX) & (fname != SKIP_NAME) & ~fname.contains(SKIP_PART)
            & F.col("model_name").isNotNull())
    for m in METRIC_SCHEMA["metrics"].dataType.names:
        keep = keep & F.col(f"metrics.{m}").isNotNull()
    return df.where(keep).select(
        fname.alias("file_name"), "model_name",
        *[F.col(f"metrics.{m}").alias(m) for m in ("accuracy", "precision", "recall", "f1_score", "roc_auc")],
        F.coalesce("training_time_seconds", F.lit(0.0)).alias("training_time"))


def write_metric_files(records: DataFrame, path: str) -> None:
    """One JSON document per record, in a folder per file name (the folder
    name is what the reader filters on)."""
    doc = records.select(
        "file_name", "model_name", F.col("training_time").alias("training_time_seconds"),
        F.struct(*[F.col(m) for m in ("accuracy", "precision", "recall", "f1_score", "roc_auc")]).alias("metrics"),
        F.struct(*[F.col(m) for m in ("tn", "fp", "fn", "tp")]).alias("confusion_matrix"))
    (doc.repartition("file_name").write.mode("overwrite").partitionBy("file_name")
        .json(path))


def compare_col(a, b) -> Column:
    """-1 if record ``a`` ranks above ``b``, 1 if below, 0 if tied; records are
    struct columns or their names."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    d = a["roc_auc"] - b["roc_auc"]
    out = F.when(F.abs(d) >= AUC_GAP, F.when(d > 0, -1).otherwise(1))
    for k, sign in (("f1_score", 1), ("recall", 1), ("training_time", -1)):
        dk = (a[k] - b[k]) * sign
        out = out.when(F.abs(dk) > TIE_EPS, F.when(dk > 0, -1).otherwise(1))
    return out.otherwise(0)


RANK_FIELDS = ["segment", "model_name", "accuracy", "precision", "recall",
               "f1_score", "roc_auc", "training_time"]


def rank_models(records: DataFrame, segment: str | None = None) -> DataFrame:
    """Adds ``rank`` (1 = champion) inside each segment: most pairwise wins
    first, then the higher ROC-AUC, then the name. The rule is not transitive,
    so wins are counted instead of sorting by it.

    A segment's records (one per model: their number is that of the learners
    tried, not of the data) meet in one array, where wins are counted."""
    seg = F.col(segment) if segment else F.lit("all")
    r = records.select(seg.cast("string").alias("segment"),
                       F.struct(*[F.col(c).cast("double" if c != "model_name" else "string").alias(c)
                                  for c in RANK_FIELDS[1:]]).alias("rec"))

    def placed(a):
        wins = F.size(F.filter("recs", lambda b: compare_col(a, b) == -1))
        return F.struct((-wins).alias("minus_wins"), (-a["roc_auc"]).alias("auc"),
                        a["model_name"].alias("name"), a.alias("rec"))

    ranked = (r.groupBy("segment").agg(F.collect_list("rec").alias("recs"))
               .select("segment", F.posexplode(F.array_sort(F.transform("recs", placed))).alias("pos", "p")))
    return ranked.select("segment", "p.rec.*", (F.col("pos") + 1).cast("long").alias("rank"))


def model_key(name) -> Column:
    """Registry key of a model name (learner family or cleaned name)."""
    n = F.lower(F.col(name) if isinstance(name, str) else name)
    fallback = F.btrim(F.replace(F.replace(n, F.lit(" "), F.lit("_")), F.lit("baseline"), F.lit("")),
                       F.lit("_"))
    return (F.when(n.contains("logistic"), F.lit("logistic_regression"))
             .when(n.contains("forest"), F.lit("random_forest"))
             .when(n.contains("xgboost"), F.lit("xgboost"))
             .otherwise(fallback))


def model_path(key) -> Column:
    """Folder of a learner's saved model, relative to the store."""
    k = F.col(key) if isinstance(key, str) else key
    return F.concat(F.lit("models/"), k)


def _f4(c) -> Column:
    return F.format_string("%.4f", c)


def selection_reason(ranked: DataFrame) -> DataFrame:
    """(segment, model_name, reason) for each segment's champion."""
    w = Window.partitionBy("segment").orderBy("rank")  # a handful of rows per segment
    nxt = lambda c: F.lead(c).over(w)
    r = ranked.select("*", nxt("model_name").alias("ru_name"), nxt("roc_auc").alias("ru_auc"),
                      nxt("f1_score").alias("ru_f1"), nxt("recall").alias("ru_recall"))
    champ = r.where(F.col("rank") == 1)
    d = F.col("roc_auc") - F.col("ru_auc")
    alone = F.concat(F.lit("Selected "), F.col("model_name"), F.lit(" as the best model with ROC-AUC="),
                     _f4("roc_auc"), F.lit("."))
    margin = F.concat(F.lit("Highest ROC-AUC ("), _f4("roc_auc"), F.lit(") on the validation split. "),
                      F.lit("It outperforms the next best model ("), F.col("ru_name"),
                      F.lit(" with ROC-AUC="), _f4("ru_auc"), F.lit(") by a significant margin of "),
                      _f4(d), F.lit("."))
    recall = F.when(F.col("recall") > F.col("ru_recall"),
                    F.concat(F.lit("and higher Recall ("), _f4("recall"), F.lit(" vs "), _f4("ru_recall"), F.lit(").")))\
              .otherwise(F.lit("and competitive Recall."))
    tie = F.concat(F.lit("Statistically similar ROC-AUC to "), F.col("ru_name"), F.lit(" (difference of "),
                   _f4(F.abs(d)), F.lit(" is less than 0.005). "),
                   F.lit("Selected as the best model because of a higher F1 Score ("), _f4("f1_score"),
                   F.lit(" vs "), _f4("ru_f1"), F.lit(") "), recall)
    reason = F.when(F.col("ru_name").isNull(), alone).when(d >= AUC_GAP, margin).otherwise(tie)
    return champ.select("segment", "model_name", reason.alias("reason"))


def promotion(candidate: DataFrame, deployed: DataFrame) -> DataFrame:
    """Joins one-row candidate and deployed metric tables on ``segment``;
    promoted iff AUC >= deployed AUC and F1 >= deployed F1 - 0.01 (missing
    deployed metrics count as 0)."""
    c = candidate.select("segment", F.col("roc_auc").alias("cand_roc_auc"), F.col("f1_score").alias("cand_f1"))
    d = deployed.select("segment", F.col("roc_auc").alias("dep_roc_auc"), F.col("f1_score").alias("dep_f1"))
    j = c.join(d, "segment", "left").withColumns({
        "dep_roc_auc": F.coalesce("dep_roc_auc", F.lit(0.0)), "dep_f1": F.coalesce("dep_f1", F.lit(0.0))})
    auc_ok = F.col("cand_roc_auc") >= F.col("dep_roc_auc")
    f1_ok = F.col("cand_f1") >= F.col("dep_f1") - F1_TOLERANCE
    return j.withColumn("roc_pass", auc_ok).withColumn("f1_pass", f1_ok) \
            .withColumn("promoted", auc_ok & f1_ok)


def promotion_reason(decision: DataFrame) -> Column:
    return F.concat(
        F.lit("Retrained model satisfied promotion criteria: ROC-AUC ("), _f4("cand_roc_auc"),
        F.lit(") >= Deployed Test ROC-AUC ("), _f4("dep_roc_auc"), F.lit("), and F1 Score ("),
        _f4("cand_f1"), F.lit(") did not decrease by more than 1% compared to deployed F1 ("),
        _f4("dep_f1"), F.lit(")."))


def append_version(versions: DataFrame, record: DataFrame) -> DataFrame:
    """Append a record as the next version: version = current + 1 and
    previous_version = current (an empty table starts at 1). The version
    table is append-only; the current record is the highest version."""
    cur = versions.agg(F.max(F.coalesce("version", F.lit(1)))).first()[0] or 0  # one number
    nxt = (record.withColumn("version", F.lit(cur + 1).cast("int"))
                 .withColumn("previous_version", F.lit(cur if cur > 0 else None).cast("int")))
    return versions.unionByName(nxt.select(*versions.columns))


def current_version(versions: DataFrame) -> DataFrame:
    """The record with the highest version (missing version counts as 1), with
    a display name. Reason and date come from the promotion's field, else the
    record's own, else the selection's, else a default."""
    v = versions.withColumn("version", F.coalesce("version", F.lit(1)))
    best = v.agg(F.max_by(F.struct(*v.columns), F.col("version")).alias("r")).select("r.*")

    def first_of(name, default):
        there = [c for c in (f"promotion_{name}", name, f"selection_{name}") if c in v.columns]
        return F.coalesce(*there, F.lit(default)).alias(name)

    return best.select(
        "version", "selected_model",
        F.initcap(F.replace(F.col("selected_model"), F.lit("_"), F.lit(" "))).alias("display_name"),
        first_of("reason", "Champion model selected."), first_of("date", "N/A"), "model_path", "previous_version")
