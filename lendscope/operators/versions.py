"""The stored version table: one folder per model version.

    <store>/version-000002/record.json   number, learner, metrics, reason, ...
    <store>/version-000002/model/        the fitted PipelineModel: transform and
                                         learner together

A version is written under a temporary name and renamed to its number, so it
is there whole or not at all. The rename does not replace an existing folder:
of two writers that both want number n one gets it, and the other sees the
conflict, either by the rename or by the token of the record it reads back. A
writer that decided against a certain current version says so
(``expected``), and its commit fails if another version came meanwhile.
"""

from __future__ import annotations

import json
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_dir

METRICS = ("accuracy", "precision", "recall", "f1_score", "roc_auc")
RECORD_SCHEMA = T.StructType([
    T.StructField("version", T.IntegerType()), T.StructField("previous_version", T.IntegerType()),
    T.StructField("selected_model", T.StringType()), T.StructField("model_name", T.StringType()),
    T.StructField("model_path", T.StringType()), T.StructField("reason", T.StringType()), T.StructField("date", T.StringType()),
    T.StructField("metrics", T.StructType([T.StructField(m, T.DoubleType()) for m in METRICS])),
    T.StructField("settings", T.StringType()), T.StructField("job", T.StringType()), T.StructField("token", T.StringType()),
])


class VersionConflict(RuntimeError):
    """Another writer committed a version first."""


def _fs(spark: SparkSession, path: str):
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark._jsc.hadoopConfiguration())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file through Spark's file system layer; fails if it is there."""
    hpath, fs = _fs(spark, path)
    out = fs.create(hpath, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def exists(spark: SparkSession, path: str) -> bool:
    hpath, fs = _fs(spark, path)
    return fs.exists(hpath)


def _name(version: int) -> str:
    return f"version-{version:06d}"


def versions(spark: SparkSession, store: str) -> DataFrame:
    """The version table, one row per committed version; an absent or empty
    store is an empty table."""
    hpath, fs = _fs(spark, f"{store}/version-*/record.json")
    found = fs.globStatus(hpath)
    if not found:
        return spark.createDataFrame([], RECORD_SCHEMA)
    return spark.read.schema(RECORD_SCHEMA).json(f"{store}/version-*/record.json")


def latest(spark: SparkSession, store: str):
    """The record (a row) with the highest version, or None."""
    return versions(spark, store).orderBy(F.desc("version")).limit(1).first()


def load_model(spark: SparkSession, store: str, record=None) -> PipelineModel:
    """The model of a version record (default: the current one)."""
    record = record if record is not None else latest(spark, store)
    if record is None:
        raise ValueError(f"no version in {store}")
    return PipelineModel.load(f"{store}/{record['model_path']}")


def commit(spark: SparkSession, store: str, model: PipelineModel | None, selected_model: str, model_name: str, reason: str, date: str,
           metrics: dict | None = None, settings: dict | None = None, expected: int | None = None, job: str | None = None, attempts: int = 20):
    """Add a version; returns its record.

    ``expected`` is the current version that the decision was made against (0:
    none): if another one is current by now, nothing is written and
    :class:`VersionConflict` is raised. Without it the next free number is
    taken. A ``job`` that has committed before gets its record back, so that a
    restarted job does not add a second version.
    """
    if job is not None:
        done = versions(spark, store).where(F.col("job") == job).limit(1).first()
        if done is not None:
            return done
    token = uuid.uuid4().hex
    temporary = f"{store}/_writing-{token}"
    try:
        if model is not None:
            model.write().overwrite().save(f"{temporary}/model")
        for _ in range(attempts):
            current = latest(spark, store)
            number = current["version"] if current is not None else 0
            if expected is not None and number != expected:
                raise VersionConflict(f"version {number} is current, not {expected}")
            target = _name(number + 1)
            record = {"version": number + 1, "previous_version": number or None, "selected_model": selected_model, "model_name": model_name,
                      "model_path": f"{target}/model", "reason": reason, "date": date,
                      "metrics": {m: float(metrics[m]) if metrics.get(m) is not None else None for m in METRICS} if metrics else None,
                      "settings": json.dumps(settings or {}, sort_keys=True), "job": job, "token": token}
            drop_dir(spark, f"{temporary}/record.json")
            write_text(spark, f"{temporary}/record.json", json.dumps(record) + "\n")
            if _claim(spark, temporary, f"{store}/{target}", token):
                return versions(spark, store).where(F.col("version") == number + 1).first()
        raise VersionConflict(f"no free version number after {attempts} attempts")
    finally:
        drop_dir(spark, temporary)


def _claim(spark: SparkSession, temporary: str, target: str, token: str) -> bool:
    """Rename without replacing; True if the folder there is then our own."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path
    src, dst = path(temporary), path(target)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(dst.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        files.rename(src, dst, options)
    except Exception:  # noqa: BLE001 -- whatever the file system says, the record tells who won
        if not exists(spark, target):
            raise
    # a rename that raced with another may have moved our folder into the winner's
    drop_dir(spark, f"{target}/{temporary.rsplit('/', 1)[1]}")
    won = spark.read.schema(RECORD_SCHEMA).json(f"{target}/record.json").first()
    return won is not None and won["token"] == token
