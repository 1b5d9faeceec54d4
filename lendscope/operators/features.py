"""Feature pipeline: fit statistics on the training split, apply everywhere.

Spark ML stages, so one ``PipelineModel`` holds transform and learner
together and saves/loads as a directory:

* ``MedianImputer`` -- exact medians (distributed quantiles, not the
  approximate ``ml.feature.Imputer``); a column with no values is dropped;
* ``ModeImputer`` -- most frequent value, ties to the smallest, NULLs ignored;
* ``PopulationScaler`` -- (x - mean) / population sigma, sigma 0 -> 1
  (``ml.feature.StandardScaler`` uses the sample sigma);
* ``StringIndexer`` (alphabetical, unseen kept) + ``OneHotEncoder`` with the
  last slot dropped -- that slot is the unseen one, so unseen -> all zeros;
* ``VectorAssembler`` -- numeric block, then categorical block (sparse).

Fitting runs a handful of aggregate jobs; only per-column statistics reach
the driver.
"""

from __future__ import annotations

import json

from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import exact_quantiles
from .small import known


class _Stats(Params):
    stats = Param(Params._dummy(), "stats", "fitted statistics as JSON",
                  typeConverter=TypeConverters.toString)

    def _stats(self) -> dict:
        return json.loads(self.getOrDefault(self.stats))


class MedianImputer(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self, inputCols=None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=inputCols)

    def _fit(self, df: DataFrame):
        cols = self.getInputCols()
        if not cols:
            return MedianImputerModel(inputCols=[], stats="{}")
        long = df.select([F.col(c).cast("double").alias(c) for c in cols]) \
                 .unpivot([], cols, "feature", "x").where(F.col("x").isNotNull() & ~F.isnan("x"))
        med = {r["feature"]: r["q"] for r in exact_quantiles(long, "feature", "x", [0.5]).collect()}
        return MedianImputerModel(inputCols=cols, stats=json.dumps(med))


class MedianImputerModel(Model, HasInputCols, _Stats, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self, inputCols=None, stats=None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=inputCols, stats=stats)

    def _transform(self, df: DataFrame) -> DataFrame:
        med = self._stats()
        keep = [c for c in self.getInputCols() if c in med]
        dropped = [c for c in self.getInputCols() if c not in med]
        out = df.withColumns({c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(float(med[c]))), F.lit(float(med[c])))
                              for c in keep})
        return out.drop(*dropped)


class ModeImputer(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self, inputCols=None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=inputCols)

    def _fit(self, df: DataFrame):
        cols = self.getInputCols()
        if not cols:
            return ModeImputerModel(inputCols=[], stats="{}")
        long = df.select([F.col(c).cast("string").alias(c) for c in cols]) \
                 .unpivot([], cols, "feature", "value").where(F.col("value").isNotNull())
        cnt = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
        # max_by over (count desc, value asc): one row per feature.
        best = cnt.groupBy("feature").agg(
            F.min(F.struct((-F.col("n")).alias("k"), F.col("value").alias("v"))).alias("m"))
        mode = {r["feature"]: r["m"]["v"] for r in best.collect()}
        return ModeImputerModel(inputCols=cols, stats=json.dumps(mode))


class ModeImputerModel(Model, HasInputCols, _Stats, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self, inputCols=None, stats=None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=inputCols, stats=stats)

    def _transform(self, df: DataFrame) -> DataFrame:
        mode = self._stats()
        keep = [c for c in self.getInputCols() if c in mode]
        dropped = [c for c in self.getInputCols() if c not in mode]
        out = df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(mode[c])) for c in keep})
        return out.drop(*dropped)


class PopulationScaler(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self, inputCols=None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=inputCols)

    def _fit(self, df: DataFrame):
        cols = [c for c in self.getInputCols() if c in df.columns]
        if not cols:
            return PopulationScalerModel(inputCols=[], stats="{}")
        row = df.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
                     *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(cols)]).first()
        st = {c: [row[f"m_{i}"], row[f"s_{i}"]] for i, c in enumerate(cols)}
        return PopulationScalerModel(inputCols=cols, stats=json.dumps(st))


class PopulationScalerModel(Model, HasInputCols, _Stats, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self, inputCols=None, stats=None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=inputCols, stats=stats)

    def _transform(self, df: DataFrame) -> DataFrame:
        st = self._stats()
        out = {}
        for c, (m, s) in st.items():
            s = 1.0 if (s is None or s == 0) else float(s)
            out[c] = (F.col(c) - F.lit(float(m if m is not None else 0.0))) / F.lit(s)
        return df.withColumns(out)


class OnPresent(Estimator):
    """A stage made at fit time for those columns that are left: the imputers
    drop a column without any value. ``make`` gets the columns and returns the
    stage (None: nothing to do); only the fitted stage is saved."""

    def __init__(self, columns, make):
        super().__init__()
        self.columns, self.make = list(columns), make

    def _fit(self, df: DataFrame):
        present = [c for c in self.columns if c in df.columns]
        stage = self.make(present) if present else SQLTransformer(statement="SELECT * FROM __THIS__")
        return stage.fit(df) if isinstance(stage, Estimator) else stage


def feature_pipeline(num, cat, output: str = "features") -> Pipeline:
    """Median+scale the numeric columns, mode+one-hot the categorical ones.
    Columns without any value are dropped (see ``dropped_columns``)."""
    idx = [f"{c}__idx" for c in cat]
    ohe = [f"{c}__ohe" for c in cat]

    def index(cols):
        return StringIndexer(inputCols=cols, outputCols=[f"{c}__idx" for c in cols],
                             stringOrderType="alphabetAsc", handleInvalid="keep")

    def encode(cols):
        return OneHotEncoder(inputCols=cols, outputCols=[c.removesuffix("idx") + "ohe" for c in cols], dropLast=True)

    def assemble(cols):
        return VectorAssembler(inputCols=cols, outputCol=output, handleInvalid="keep")

    stages = [MedianImputer(inputCols=list(num)), PopulationScaler(inputCols=list(num)),
              ModeImputer(inputCols=list(cat))]
    if cat:
        stages += [OnPresent(cat, index), OnPresent(idx, encode)]
    stages.append(OnPresent(list(num) + ohe, assemble))
    return Pipeline(stages=stages)


def dropped_columns(model, spark) -> DataFrame:
    """(column_name): the columns a fitted pipeline leaves out, having no value."""
    rows = [(c,) for s in model.stages if isinstance(s, (MedianImputerModel, ModeImputerModel))
            for c in s.getInputCols() if c not in s._stats()]
    return spark.createDataFrame(rows, "column_name string")  # bounded by the schema


def _stage(model, cls):
    for s in model.stages:
        if isinstance(s, cls):
            return s
    return None


def feature_names(model, spark=None) -> DataFrame:
    """(idx, name): ``num__c`` then ``cat__c_value`` in slot order."""
    from pyspark.ml.feature import StringIndexerModel
    scaler = _stage(model, PopulationScalerModel)
    num = list(scaler._stats()) if scaler is not None else []
    names = [f"num__{c}" for c in num]
    si = _stage(model, StringIndexerModel)
    if si is not None:
        for c, labels in zip(si.getInputCols(), si.labelsArray):
            names += [f"cat__{c}_{v}" for v in labels]
    from pyspark.sql import SparkSession
    spark = spark or SparkSession.getActiveSession()
    # One row per feature slot: bounded by the fitted category counts.
    return spark.createDataFrame(list(enumerate(names)), "idx int, name string")


def category_slots(model) -> DataFrame:
    """(feature, value, slot): the fitted category -> output slot table."""
    from pyspark.ml.feature import StringIndexerModel
    from pyspark.sql import SparkSession
    scaler = _stage(model, PopulationScalerModel)
    base = len(scaler._stats()) if scaler is not None else 0
    rows = []
    si = _stage(model, StringIndexerModel)
    if si is not None:
        for c, labels in zip(si.getInputCols(), si.labelsArray):
            for v in labels:
                rows.append((c, v, base + len(rows)))
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(rows, "feature string, value string, slot int")


def one_hot_long(model, df: DataFrame, cat, key: str = "row_id") -> DataFrame:
    """(key, slot, name) for every categorical value seen at fit time --
    the non-zero entries of the one-hot block, as a long table. The slot
    table (one row per fitted category) is broadcast within the bound,
    joined by shuffle beyond it."""
    from pyspark.ml.feature import StringIndexerModel
    mode = _stage(model, ModeImputerModel)
    imputed = mode.transform(df.select(key, *cat))
    long = imputed.unpivot([key], list(cat), "feature", "value")
    slots = category_slots(model)
    n_slots = sum(len(x) for x in (_stage(model, StringIndexerModel).labelsArray
                                   if _stage(model, StringIndexerModel) else []))
    return (long.join(known(slots, n_slots), ["feature", "value"])  # fitted categories, size known
                .select(key, "slot", F.concat(F.lit("cat__"), F.col("feature"), F.lit("_"),
                                              F.col("value")).alias("name")))


def class_weights(df: DataFrame, label: str = "loan_status") -> DataFrame:
    """Balanced weights n / (k * n_c) per class."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy()  # one row per class
    return c.select(label, "count",
                    (F.sum("count").over(w) / (F.count(F.lit(1)).over(w) * F.col("count"))).alias("weight"))


def pos_weight(df: DataFrame, label: str = "loan_status") -> DataFrame:
    """negatives / positives (1.0 when there are no positives)."""
    return df.agg(F.count_if(F.col(label) == 0).alias("negatives"),
                  F.count_if(F.col(label) == 1).alias("positives")) \
             .withColumn("pos_weight", F.coalesce(F.col("negatives") / F.nullif(F.col("positives"), F.lit(0)),
                                                  F.lit(1.0)))


