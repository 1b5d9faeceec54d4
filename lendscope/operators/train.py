"""Learners: logistic regression (Spark ML), random forest and boosted trees
(``trees``).

A fitted version is one ``PipelineModel`` directory that holds transform and
model together.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import class_weights, feature_pipeline, feature_names, pos_weight
from .trees import bin_table, fit_boosted, fit_forest

LABEL = "loan_status"
# Learner settings of the reference.
LR_PARAMS = dict(C=1.0, maxIter=1000)
RF_PARAMS = dict(numTrees=300, maxDepth=None, seed=42)
RF_V1_PARAMS = dict(numTrees=100, maxDepth=12, seed=42)
GBT_PARAMS = dict(maxIter=300, stepSize=0.05, maxDepth=6, subsamplingRate=0.8, columnRate=0.8, leafPenalty=1.0, seed=42)


def balanced(df: DataFrame, label: str = LABEL, out: str = "weight") -> DataFrame:
    """Attach balanced class weights n / (k * n_c); a binary label has two."""
    weight = None
    for r in class_weights(df.where(F.col(label).isin(0, 1)), label).collect():
        case = (F.col(label) == r[label], F.lit(float(r["weight"])))
        weight = F.when(*case) if weight is None else weight.when(*case)
    weight = F.lit(None).cast("double") if weight is None else weight
    return df.where(F.col(label).isin(0, 1)).withColumn(out, weight)


def positive_weighted(df: DataFrame, label: str = LABEL, out: str = "weight") -> DataFrame:
    """Weight positives by negatives/positives, negatives by 1."""
    pw = pos_weight(df, label).first()["pos_weight"]  # one number
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(float(pw))).otherwise(F.lit(1.0)))


def lr(n_rows: int, C: float = 1.0, maxIter: int = 1000, tol: float = 1e-10,
       **kw) -> LogisticRegression:
    """L2 logistic regression matching ``C * sum(w_i * loss_i) + ||b||^2 / 2``:
    Spark minimises ``sum(w_i * loss_i) / sum(w_i) + regParam * ||b||^2 / 2``
    and balanced weights sum to n, so regParam = 1 / (C * n)."""
    return LogisticRegression(featuresCol="features", labelCol=LABEL, weightCol="weight",
                              regParam=1.0 / (C * max(n_rows, 1)), elasticNetParam=0.0,
                              standardization=False, maxIter=maxIter, tol=tol, **kw)


def family(key: str) -> str:
    """The learner family a registry key names, in any case."""
    k = key.lower()
    for kind, parts in (("logistic", ("logistic",)), ("forest", ("random", "forest")), ("boosted", ("xgboost", "gbt", "boost"))):
        if any(p in k for p in parts):
            return kind
    raise ValueError(f"unknown learner key: {key}")


def fit(key: str, train: DataFrame, num, cat, features_model=None, **params):
    """Fit a learner with the weighting its family uses.

    ``features_model`` -- a feature pipeline already fitted on the same
    training rows -- is reused instead of fitting the statistics again. The
    columns of the transformed rows that the learner needs are persisted once;
    counts, bin edges and the learner read them from there."""
    kind = family(key)
    if features_model is None:
        features_model = feature_pipeline(num, cat).fit(train)
    rows = features_model.transform(train)
    # not the categories, their indices and their encodings: they are in the features
    needed = [c for c in rows.columns if c in train.columns and c not in cat] if kind != "logistic" else [LABEL]
    rows = rows.select(*needed, "features").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = rows.count()
        if kind == "logistic":
            model = lr(n, **params).fit(balanced(rows))
        else:
            size = rows.select(F.size(vector_to_array("features")).alias("n")).first()["n"] if n else 0
            present = [c for c in num if c in rows.columns]  # columns without any value are dropped
            edges = bin_table(rows, present, size)
            if kind == "forest":
                model = fit_forest(balanced(rows), edges, n, LABEL, "weight", **{**RF_PARAMS, **params})
            else:
                model = fit_boosted(positive_weighted(rows), edges, n, LABEL, "weight", **{**GBT_PARAMS, **params})
    finally:
        rows.unpersist()
    return PipelineModel(stages=list(features_model.stages) + [model])


def importances(model, spark=None) -> DataFrame:
    """(idx, name, importance) sorted descending; coefficients for LR."""
    est = model.stages[-1]
    names = feature_names(model, spark)
    if hasattr(est, "featureImportances"):
        vals = est.featureImportances.toArray().tolist()
    else:
        vals = est.coefficients.toArray().tolist()
    sp = names.sparkSession
    imp = sp.createDataFrame(list(enumerate(float(v) for v in vals)), "idx int, importance double")
    return names.join(imp, "idx").orderBy(F.desc("importance"), "name")
