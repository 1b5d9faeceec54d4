"""Feature pipeline statistics, persistence and learners."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from lendscope.operators import features as fe
from lendscope.operators import train as tr
from lendscope.operators.clean import NUMERIC, feature_view
from lendscope.plans import pipeline
from lendscope.plans.registry import FEATURE_CAT
from lendscope.session import shared_dir


@pytest.fixture(scope="module")
def train(spark, small):
    s = pipeline.stored_splits(spark, small)
    return feature_view(s.where(F.col("split") == "train"), drop=("issue_year", "split"))


def test_standardized_train_has_mean0_sd1(spark, train):
    m = fe.feature_pipeline(NUMERIC, FEATURE_CAT).fit(train)
    out = m.transform(train)
    for c in NUMERIC:
        r = out.agg(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).first()
        assert r["m"] == pytest.approx(0.0, abs=1e-9)
        assert r["s"] == pytest.approx(1.0, abs=1e-9) or r["s"] == pytest.approx(0.0, abs=1e-12)
    # one-hot block: at most one slot per categorical, unseen category -> zeros
    from pyspark.ml.functions import vector_to_array
    n_slots = fe.feature_names(m, spark).count()
    arr = out.select(vector_to_array("features").alias("a"))
    onehot = arr.select(F.size("a").alias("n"),
                        F.aggregate(F.slice("a", len(NUMERIC) + 1, n_slots), F.lit(0.0), lambda acc, v: acc + v).alias("s"))
    r = onehot.agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.max("s").alias("smax")).first()
    assert r["lo"] == r["hi"] == n_slots
    assert r["smax"] <= len(FEATURE_CAT)


def test_pipeline_save_load_roundtrip(spark, train):
    m = fe.feature_pipeline(NUMERIC, FEATURE_CAT).fit(train)
    path = shared_dir(spark, "model")
    m.write().overwrite().save(path)
    back = PipelineModel.load(path)
    a = m.transform(train).select("row_id", "features").orderBy("row_id").collect()
    b = back.transform(train).select("row_id", "features").orderBy("row_id").collect()
    assert a == b


def test_lr_matches_newton_solution(spark, train):
    m = tr.fit("logistic_regression", train, NUMERIC, [])
    coef = m.stages[-1].coefficients.toArray()
    b0 = m.stages[-1].intercept
    x = m.transform(train).select("features", "loan_status").collect()
    X = np.array([r["features"].toArray() for r in x])
    y = np.array([r["loan_status"] for r in x], dtype=float)
    n, k = len(y), 2
    w = np.where(y == 1, n / (k * y.sum()), n / (k * (n - y.sum())))
    Xb = np.hstack([np.ones((n, 1)), X])
    beta = np.zeros(Xb.shape[1])
    for _ in range(50):  # Newton on C * sum w_i loss_i + ||b||^2 / 2 (intercept unpenalised)
        p = 1 / (1 + np.exp(-Xb @ beta))
        g = Xb.T @ (w * (p - y))
        g[1:] += beta[1:]
        H = (Xb * (w * p * (1 - p))[:, None]).T @ Xb
        H[1:, 1:] += np.eye(len(beta) - 1)
        beta -= np.linalg.solve(H, g)
    assert b0 == pytest.approx(beta[0], abs=1e-5)
    assert np.allclose(coef, beta[1:], atol=1e-5)


def test_small_forest_and_boosting_fit(spark, train):
    rf = tr.fit("random_forest", train, NUMERIC, FEATURE_CAT, numTrees=5, maxDepth=4)
    imp = tr.importances(rf, spark).collect()
    assert sum(r["importance"] for r in imp) == pytest.approx(1.0, abs=1e-9)
    gb = tr.fit("xgboost", train, NUMERIC, FEATURE_CAT, maxIter=3, maxDepth=3)
    assert len(tr.importances(gb, spark).collect()) == len(imp)
    with pytest.raises(ValueError):
        tr.fit("svm", train, NUMERIC, FEATURE_CAT)


def test_all_missing_column_dropped_and_mode_ties(spark):
    rows = [(1, None, "b"), (2, None, "a"), (3, None, "a"), (4, None, "b"), (5, None, None)]
    df = spark.createDataFrame(rows, "row_id long, empty double, c string")
    med = fe.MedianImputer(inputCols=["empty"]).fit(df)
    assert "empty" not in med.transform(df).columns  # T14: nothing to impute from
    mode = fe.ModeImputer(inputCols=["c"]).fit(df)
    assert mode._stats() == {"c": "a"}  # tie between a and b -> smallest
    assert mode.transform(df).where("row_id = 5").first()["c"] == "a"


def test_scaler_zero_sigma_divides_by_one(spark):
    df = spark.createDataFrame([(1, 3.0), (2, 3.0)], "row_id long, x double")
    m = fe.PopulationScaler(inputCols=["x"]).fit(df)
    assert [r["x"] for r in m.transform(df).collect()] == [0.0, 0.0]


def test_pipeline_drops_columns_without_values(spark, tmp_path):
    rows = [(i, None, float(i), None, "ab"[i % 2]) for i in range(6)]
    df = spark.createDataFrame(rows, "row_id long, e double, x double, n string, c string")
    m = fe.feature_pipeline(["e", "x"], ["n", "c"]).fit(df)
    assert [r["name"] for r in fe.feature_names(m, spark).orderBy("idx").collect()] == ["num__x", "cat__c_a", "cat__c_b"]
    assert sorted(r[0] for r in fe.dropped_columns(m, spark).collect()) == ["e", "n"]
    m.write().overwrite().save(str(tmp_path / "m"))
    from pyspark.ml import PipelineModel
    assert PipelineModel.load(str(tmp_path / "m")).transform(df).first()["features"].size == 3
    assert fe.feature_pipeline(["x"], ["n"]).fit(df).transform(df).first()["features"].size == 1


def test_nan_is_missing(spark):
    from lendscope.operators.profile import missing_by_column
    df = spark.createDataFrame([(1, float("nan")), (2, 1.0), (3, 3.0), (4, None)], "row_id long, x double")
    m = fe.feature_pipeline(["x"], []).fit(df)
    got = [r["features"][0] for r in m.transform(df).orderBy("row_id").collect()]
    assert got[0] == got[3] == 0.0 and got[2] == -got[1] > 0
    assert {r["column_name"]: r["missing"] for r in missing_by_column(df).collect()} == {"row_id": 0, "x": 2}


def test_forest_is_the_same_from_any_partitioning(spark, train):
    def weights(df):
        m = tr.fit("Random Forest", df, NUMERIC, [], numTrees=5, maxDepth=4)
        return m.stages[-1].featureImportances.toArray().tolist()
    assert weights(train.repartition(1)) == pytest.approx(weights(train.repartition(7)), abs=1e-12)
