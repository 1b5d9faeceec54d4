"""Scoring applications in batch: input contract, coercion, risk output."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import score_number
from .clean import CATEGORICAL, NUMERIC

TEXT_FIELDS = CATEGORICAL + ["issue_d"]
# Input contract: 9 numbers and 9 texts, all required.
APPLICATION_SCHEMA = T.StructType(
    [T.StructField("row_id", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in NUMERIC + TEXT_FIELDS])

# Risk texts.
LOW_TEXT, LOW_LABEL = "Loan Likely to be Repaid", "Low Risk"
HIGH_TEXT, HIGH_LABEL = "High Default Risk", "High Risk"


def split_rejects(apps: DataFrame):
    """(accepted, rejected): a row missing any required field is rejected,
    with the number of missing fields."""
    miss = sum(F.col(c).isNull().cast("int") for c in NUMERIC + TEXT_FIELDS)
    tagged = apps.withColumn("missing_fields", miss)
    return (tagged.where(F.col("missing_fields") == 0).drop("missing_fields"),
            tagged.where(F.col("missing_fields") > 0))


def coerce_applications(apps: DataFrame, invalid: str = "zero", trim: bool = True) -> DataFrame:
    """Numbers: unparsable -> 0.0 (``invalid="zero"``) or NULL; texts trimmed."""
    cols = [F.col("row_id")]
    for c in NUMERIC:
        v = score_number(c) if invalid == "zero" else F.col(c).try_cast("double")
        cols.append(v.alias(c))
    for c in TEXT_FIELDS:
        v = F.col(c).cast("string")
        cols.append((F.trim(v) if trim else v).alias(c))
    return apps.select(*cols)


def risk_bands(df: DataFrame, prob: str = "y_prob", pred: str = "y_pred") -> DataFrame:
    """Text, label, probability rounded half-even to 4, score = round(100 p)."""
    hi = F.col(pred) == 1
    return df.select(
        "*",
        F.when(hi, HIGH_TEXT).otherwise(LOW_TEXT).alias("prediction"),
        F.when(hi, HIGH_LABEL).otherwise(LOW_LABEL).alias("prediction_label"),
        F.bround(F.col(prob), 4).alias("probability"),
        F.bround(F.col(prob) * 100, 0).cast("int").alias("risk_score"))


def positive_prob(col: str = "probability") -> Column:
    return vector_to_array(F.col(col))[1]


def scores(out: DataFrame) -> tuple[Column, Column]:
    """(probability of class 1, class) of a transformed table: from a learner's
    ``probability`` vector, or from the ``y_prob`` column of a fixed rule."""
    if "y_prob" in out.columns:
        return F.col("y_prob"), (F.col("y_prob") > 0.5).cast("int")
    return positive_prob(), F.col("prediction").cast("int")


def score(model, apps: DataFrame) -> DataFrame:
    """Coerce -> fitted transform + learner -> risk output, per row."""
    prob, pred = scores(out := model.transform(coerce_applications(apps)))
    return risk_bands(out.select("row_id", prob.alias("y_prob"), pred.alias("y_pred")))
