"""Split sinks, row numbers of files, streams that restart."""

import os
import time

from pyspark.sql import functions as F

from lendscope.sources import files as fl
from lendscope.streaming import jobs as sj


def test_one_split_is_rewritten_alone(spark, tmp_path):
    rows = [(i, float(i), i % 2, ["train", "val", "test"][i % 3]) for i in range(30)]
    df = spark.createDataFrame(rows, "row_id long, x double, loan_status int, split string")
    path = str(tmp_path / "s")
    fl.write_splits(df, path)
    fl.write_splits(df.where("split = 'val' AND row_id < 10").withColumn("x", F.lit(-1.0)), path)
    for name in ("train", "val", "test"):
        x, y = fl.read_split(spark, path, name)
        assert "loan_status" not in x.columns and "PartitionFilters: [isnotnull(split" in x._jdf.queryExecution().toString()
        got = {r["row_id"]: (r["x"], r["loan_status"]) for r in x.join(y.drop("split"), "row_id").collect()}
        want = {r[0]: (r[1], r[2]) for r in rows if r[3] == name}
        assert got == (want if name != "val" else {i: (-1.0, i % 2) for i in want if i < 10})


def test_equal_rows_of_a_file_get_ids_of_their_own(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"accepted_{name}.csv").write_text("loan_amnt,term\n" + "5, 36 months\n" * 2000 + "6, 60 months\n")
    schema = fl.RAW_SCHEMA
    schema = type(schema)([f for f in schema if f.name in ("row_id", "loan_amnt", "term")])
    read = lambda: {r["row_id"]: (r["loan_amnt"], r["term"]) for r in fl.read_loans(spark, str(tmp_path), schema=schema).collect()}
    first = read()
    assert len(first) == 4002
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # other tasks, same ids
    try:
        assert read() == first
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_stopped_stream_resumes_and_gives_each_row_once(spark, tmp_path):
    src, base = str(tmp_path / "in"), str(tmp_path / "job")
    for k in range(4):
        spark.range(k * 10, k * 10 + 10).selectExpr("id AS row_id", "id / 100.0D AS z").coalesce(1).write.mode("append").parquet(src)
    stream = lambda: sj.score_stream(spark.readStream.schema("row_id long, z double").option("maxFilesPerTrigger", 1).parquet(src), F.col("z"))
    q = (stream().writeStream.format("parquet").option("path", base + "/out").option("checkpointLocation", base + "/_checkpoint").start())
    while not (q.lastProgress and q.lastProgress["batchId"] >= 1):  # stopped in the middle
        time.sleep(.1)
    q.stop()
    # what a lost task left behind is not in the commit log
    left = spark.createDataFrame([(999, 0.0, 0, "x")], "row_id long, y_prob double, y_pred int, prediction_label string")
    left.coalesce(1).write.parquet(str(tmp_path / "left"))
    part = next(f for f in os.listdir(tmp_path / "left") if f.endswith(".parquet"))
    os.replace(tmp_path / "left" / part, tmp_path / "job" / "out" / part)
    got = sj.run_to_parquet(stream(), spark, "scores", base=base)
    assert sorted(r["row_id"] for r in got.collect()) == list(range(40))
    spark.range(40, 45).selectExpr("id AS row_id", "id / 100.0D AS z").coalesce(1).write.mode("append").parquet(src)
    got = sj.run_to_parquet(stream(), spark, "scores", base=base)
    assert sorted(r["row_id"] for r in got.collect()) == list(range(45))


def test_category_dictionary_and_vectors(spark, tmp_path):
    """Slots by column order and value; unseen and modeless values take none; dense vectors read as cells too."""
    from pyspark.ml.linalg import Vectors
    from lendscope.operators import dictionary as di
    from lendscope.operators import features as fe
    from lendscope.sources.files import read_vectors, write_vectors
    fit = spark.createDataFrame([(1, 1.0, "b", True, None), (2, 2.0, "a", None, None), (3, 3.0, "b", False, None)], "row_id long, x double, c string, f boolean, e string")
    slots = di.category_dictionary(fit, ["f", "c", "e"], 1)
    exp = [("f", "false", 1, "cat__f_false"), ("f", "true", 2, "cat__f_true"), ("c", "a", 3, "cat__c_a"), ("c", "b", 4, "cat__c_b")]
    assert [tuple(r) for r in slots.orderBy("slot").collect()] == exp
    assert di.category_dictionary(fit.limit(0), ["c"]).count() == di.category_dictionary(fit, []).count() == 0
    modes = fe.ModeImputer(inputCols=["c", "e"]).fit(fit)
    new = spark.createDataFrame([(7, 5.0, "zzz", None), (8, 6.0, None, "q"), (9, 0.0, "a", None)], "row_id long, x double, c string, e string")
    vectors = di.encoded(new, ["x"], slots, modes, ["c", "e"], 5)
    write_vectors(vectors, di.slot_names(["x"], slots), str(tmp_path / "v"))
    cells, names = read_vectors(spark, str(tmp_path / "v"), cells=True)
    assert sorted(tuple(r) for r in cells.collect()) == [(7, 0, 5.0), (8, 0, 6.0), (8, 4, 1.0), (9, 0, 0.0), (9, 3, 1.0)]
    assert names.where("slot = 0").first()["name"] == "num__x" and names.count() == 5
    back = {r["row_id"]: r["features"] for r in read_vectors(spark, str(tmp_path / "v"))[0].collect()}
    assert back[8] == Vectors.sparse(5, [0, 4], [6.0, 1.0])
    dense = spark.createDataFrame([(1, Vectors.dense([3.0, 0.0])), (2, Vectors.sparse(2, [], []))], ["row_id", "features"])
    write_vectors(dense, di.slot_names(["x", "y"], slots.limit(0)), str(tmp_path / "w"))
    assert sorted(tuple(r) for r in read_vectors(spark, str(tmp_path / "w"), cells=True)[0].collect()) == [(1, 0, 3.0), (1, 1, 0.0)]
    write_vectors(vectors.limit(0), di.slot_names([], slots.limit(0)), str(tmp_path / "n"))
    assert read_vectors(spark, str(tmp_path / "n"), cells=True)[0].count() == 0
