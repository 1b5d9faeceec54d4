"""The version table and the refit chain."""

import json
import threading

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from lendscope.operators import refit, train as tr, versions as vs

NUM, CAT = ["x"], ["c"]


def rule(expr):
    return PipelineModel(stages=[SQLTransformer(statement=f"SELECT *, CAST({expr} AS DOUBLE) AS y_prob FROM __THIS__")])


@pytest.fixture()
def store(tmp_path):
    return str(tmp_path / "store")


def add(spark, store, n, **kw):
    return vs.commit(spark, store, rule(f"{n} / 10.0"), "logistic_regression", f"m{n}", f"reason {n}", "2020-01-01",
                     {"accuracy": n / 10, "precision": 0, "recall": 0, "f1_score": 0, "roc_auc": .5}, **kw)


def test_commit_and_load(spark, store):
    assert vs.versions(spark, store).count() == 0 and vs.latest(spark, store) is None
    with pytest.raises(ValueError):
        vs.load_model(spark, store)
    a, b = add(spark, store, 1, expected=0), add(spark, store, 2)
    assert (a["version"], a["previous_version"], b["version"], b["previous_version"]) == (1, None, 2, 1)
    assert b["metrics"]["accuracy"] == .2 and b["model_path"] == "version-000002/model"
    one = spark.range(1)
    assert vs.load_model(spark, store).transform(one).first()["y_prob"] == .2
    assert vs.load_model(spark, store, a).transform(one).first()["y_prob"] == .1
    with pytest.raises(vs.VersionConflict):
        add(spark, store, 3, expected=1)
    assert vs.versions(spark, store).count() == 2
    assert not vs.exists(spark, f"{store}/version-000003")


def test_two_writers_never_get_the_same_number(spark, store):
    got, lost = [], []

    def write(n, expected):
        try:
            got.append(add(spark, store, n, expected=expected)["version"])
        except vs.VersionConflict:
            lost.append(n)

    for expected in (0, 1):  # both decided against the same current version: one wins
        threads = [threading.Thread(target=write, args=(n, expected)) for n in (1, 2, 3)]
        [t.start() for t in threads]
        [t.join() for t in threads]
    assert sorted(got) == [1, 2] and len(lost) == 4
    threads = [threading.Thread(target=write, args=(n, None)) for n in (4, 5, 6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(got) == [1, 2, 3, 4, 5]
    rows = vs.versions(spark, store).orderBy("version").collect()
    assert [r["version"] for r in rows] == [1, 2, 3, 4, 5] and len({r["token"] for r in rows}) == 5
    import os
    assert not [f for f in os.listdir(store) if f.startswith("_writing")]


def test_taken_folder_is_not_replaced(spark, store):
    add(spark, store, 1)
    vs.write_text(spark, f"{store}/_writing-x/record.json", json.dumps({"version": 1, "token": "x"}))
    assert not vs._claim(spark, f"{store}/_writing-x", f"{store}/version-000001", "x")
    assert vs.latest(spark, store)["reason"] == "reason 1"


def test_job_commits_once(spark, store):
    a = add(spark, store, 1, job="j")
    assert add(spark, store, 9, job="j") == a and vs.versions(spark, store).count() == 1


@pytest.fixture(scope="module")
def loans(spark):
    rows = [(i, float(i % 17), "abc"[i % 3], int((i % 17) + (i * 7 % 5) > 10)) for i in range(400)]
    return spark.createDataFrame(rows, "row_id long, x double, c string, loan_status int").persist()


def summary(spark, needed=True):
    return spark.createDataFrame([(needed,)], "retraining_recommended boolean")


def chain(spark, store, loans, **kw):
    part = [loans.where(F.col("row_id") % 4 == k) for k in range(4)]
    return refit.refit_chain(spark, store, kw.pop("summary", summary(spark)), *part, NUM, CAT, "2021-01-01", **{"job": "j1", **kw}).first()


def test_rejected_candidate_leaves_the_table_and_the_transform(spark, store, loans):
    perfect = rule("CASE WHEN (x + (row_id * 7 % 5)) > 10 THEN 0.9 ELSE 0.1 END")
    vs.commit(spark, store, perfect, "logistic_regression", "perfect", "r", "d", expected=0)
    before = vs.versions(spark, store).collect()
    r = chain(spark, store, loans)
    assert r["outcome"] == "rejected" and not (r["roc_pass"] and r["f1_pass"]) and r["deployed_roc_auc"] == 1.0 and r["version"] is None
    assert vs.versions(spark, store).collect() == before and not vs.exists(spark, f"{store}/candidates/j1")
    told = refit.evaluate_current(spark, store, loans).first()
    assert told["model_name"] == "perfect" and told["roc_auc"] == 1.0


def test_promoted_candidate_is_the_learner_of_the_current_version(spark, store, loans):
    vs.commit(spark, store, rule("0.5"), "random_forest", "poor", "r", "d", expected=0, settings={"numTrees": 3, "maxDepth": 2})
    assert chain(spark, store, loans, summary=summary(spark, False))["outcome"] == "not recommended"
    r = chain(spark, store, loans, same_split=True)
    assert r["outcome"] == "promoted" and r["version"] == 2 and r["deployed_roc_auc"] == .5
    now = vs.latest(spark, store)
    assert now["previous_version"] == 1 and now["selected_model"] == "random_forest" and "promotion criteria" in now["reason"]
    model = vs.load_model(spark, store)
    assert len(model.stages[-1].trees) == 3 and now["metrics"]["roc_auc"] == pytest.approx(r["candidate_roc_auc"])
    # the same job again: no second version; another job refits the new current version
    again = chain(spark, store, loans)
    assert again["outcome"] == "promoted" and again["version"] == 2 and vs.versions(spark, store).count() == 2


def test_restart_reads_the_fitted_candidate(spark, store, loans, monkeypatch):
    vs.commit(spark, store, rule("0.5"), "logistic_regression", "poor", "r", "d", expected=0)
    real = vs.commit

    def lost(*a, **k):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(vs, "commit", lost)
    with pytest.raises(RuntimeError):
        chain(spark, store, loans)
    assert vs.versions(spark, store).count() == 1

    fits = []
    fit = tr.fit
    monkeypatch.setattr(tr, "fit", lambda *a, **k: fits.append(1) or fit(*a, **k))
    calls = []

    def beaten(*a, **k):  # another writer commits first
        if not calls:
            calls.append(1)
            real(spark, store, rule("0.5"), "logistic_regression", "other", "r", "d", expected=1)
        return real(*a, **k)

    monkeypatch.setattr(vs, "commit", beaten)
    r = chain(spark, store, loans)
    assert r["outcome"] == "promoted" and r["version"] == 3 and not fits
    assert [v["model_name"] for v in vs.versions(spark, store).orderBy("version").collect()] == ["poor", "other", "other"]
