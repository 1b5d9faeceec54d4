"""Gated refit, promotion and held-out evaluation of stored versions.

The gate reads the one-row drift summary; only when it recommends a refit is
the champion's learner fitted on baseline + current rows and evaluated on the
validation split. Fitted versions are ``PipelineModel`` directories (feature
transform and learner together), so a rejected candidate can never run with
the wrong transform.
"""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_dir

from . import evaluate as ev
from . import rank as rk
from . import train as tr
from . import versions as vs
from .profile import combine
from .score import scores


def refit_recommended(summary: DataFrame) -> bool:
    row = summary.select("retraining_recommended").first()
    return bool(row and row[0])


def scored_by(model, df: DataFrame, name: str, label: str = "loan_status") -> DataFrame:
    """(model_name, row_id, y_true, y_pred, y_prob) from a fitted pipeline."""
    prob, pred = scores(out := model.transform(df))
    return out.select(F.lit(name).alias("model_name"), "row_id", F.col(label).alias("y_true"), pred.alias("y_pred"), prob.alias("y_prob"))


def refit_if_needed(summary: DataFrame, train: DataFrame, prod: DataFrame, val: DataFrame,
                    key: str, num, cat, force: bool = False, **params):
    """Returns (model, metrics) of the refit candidate, or (None, None) when
    the drift summary does not recommend a refit."""
    if not (force or refit_recommended(summary)):
        return None, None
    model = tr.fit(key, combine(train, prod), num, cat, **params)
    metrics = ev.evaluation(scored_by(model, val, key))
    return model, metrics


def evaluate_version(path: str, test: DataFrame, name: str = "current") -> DataFrame:
    """Load a saved version and evaluate it on a held-out split."""
    model = PipelineModel.load(path)
    return ev.evaluation(scored_by(model, test, name))


def evaluate_current(spark, store: str, test: DataFrame) -> DataFrame:
    """The current version, found through the version table, on a held-out split."""
    record = vs.latest(spark, store)
    return ev.evaluation(scored_by(vs.load_model(spark, store, record), test, record["model_name"]))


OUTCOME_SCHEMA = ("outcome string, candidate_roc_auc double, candidate_f1 double, deployed_roc_auc double, deployed_f1 double, "
                  "roc_pass boolean, f1_pass boolean, version int")


def refit_chain(spark, store: str, summary: DataFrame, train: DataFrame, prod: DataFrame, val: DataFrame, test: DataFrame, num, cat,
                date: str, job: str, same_split: bool = False, force: bool = False) -> DataFrame:
    """Gate, fit, decide and commit: one restartable job.

    The learner and its settings are the current version's. The candidate is
    fitted with a transform of its own on train + prod and evaluated on
    ``val``; the deployed version on ``test``, or on ``val`` too with
    ``same_split`` (T8). A promoted candidate becomes the next version, transform
    included; a rejected one leaves the table and the loadable model as they are
    (T9). If another version is committed meanwhile, the decision is made again
    against it.

    Restarts: under the same ``job`` name the fitted candidate and its metrics
    are read from ``<store>/candidates/<job>`` and a commit is not repeated.
    Returns one row (outcome: "not recommended", "promoted" or "rejected").
    """
    def told(outcome, decision=None, version=None):
        d = decision
        row = (outcome, d and d["cand_roc_auc"], d and d["cand_f1"], d and d["dep_roc_auc"], d and d["dep_f1"],
               d and d["roc_pass"], d and d["f1_pass"], version)
        return spark.createDataFrame([row], OUTCOME_SCHEMA)

    if not (force or refit_recommended(summary)):
        return told("not recommended")
    home = f"{store}/candidates/{job}"
    while True:
        current = vs.latest(spark, store)
        if current is None:
            raise ValueError(f"no version in {store}: nothing to refit")
        if current["job"] == job:  # committed before a restart
            return told("promoted", _decision(spark, home, store, current["previous_version"], val, test, same_split, current), current["version"])
        settings = json.loads(current["settings"] or "{}")
        _candidate(spark, home, current["selected_model"], settings, train, prod, val, num, cat)
        decision = _decision(spark, home, store, current["version"], val, test, same_split, current)
        if not decision["promoted"]:
            drop_dir(spark, home)
            return told("rejected", decision)
        metrics = json.loads(spark.read.text(f"{home}/metrics", wholetext=True).first()[0])
        try:
            done = vs.commit(spark, store, PipelineModel.load(f"{home}/model"), current["selected_model"], current["model_name"],
                             decision["reason"], date, metrics, settings, expected=current["version"], job=job)
        except vs.VersionConflict:
            continue
        return told("promoted", decision, done["version"])


def _candidate(spark, home: str, key: str, settings: dict, train, prod, val, num, cat) -> None:
    """Fit and evaluate the candidate unless a run before has; the metrics are
    written last, so a folder that has them is whole."""
    if vs.exists(spark, f"{home}/metrics"):
        return
    model = tr.fit(key, combine(train, prod), num, cat, **settings)
    model.write().overwrite().save(f"{home}/model")
    metrics = ev.evaluation(scored_by(model, val, key)).first().asDict()
    vs.write_text(spark, f"{home}/metrics", json.dumps(metrics))


def _decision(spark, home: str, store: str, version: int, val, test, same_split: bool, current):
    """The promotion rule on the candidate's and the deployed version's metrics."""
    row = lambda m: spark.createDataFrame([("all", m["roc_auc"], m["f1_score"])], "segment string, roc_auc double, f1_score double")
    candidate = json.loads(spark.read.text(f"{home}/metrics", wholetext=True).first()[0])
    deployed = vs.versions(spark, store).where(F.col("version") == version).first() or current
    now = ev.evaluation(scored_by(vs.load_model(spark, store, deployed), val if same_split else test, deployed["model_name"])).first()
    decision = rk.promotion(row(candidate), row(now))
    return decision.withColumn("reason", rk.promotion_reason(decision)).first()
