"""Category slots as a table, and feature vectors built from it.

``StringIndexer`` keeps every category in a Python list of the driver. Here
the categories stay a table (feature, value, slot, name): distinct values by
partial aggregation, slots by their rank in (column order, value), which is a
prefix sum over range partitions. Rows meet it by a join, whose sides adaptive
execution measures: broadcast if small, else shuffled, a hot value split.

``encoded`` gives each row's vector in the stored form of Spark ML's vectors
(type, size, indices, values), so it is written as plain Parquet and read back
as a vector or as cells, without the model (``sources.files.read_vectors``).

Defined results: NULL takes the mode, and no slot if its column has no mode;
a value that the dictionary lacks takes no slot; numeric cells are all stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import ModeImputerModel
from .quantiles import prefix_before

VECTOR = "struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"


def category_dictionary(df: DataFrame, columns, base: int = 0) -> DataFrame:
    """(feature, value, slot, name) of the categories of ``columns``, in their
    order and by value within a column, from slot ``base`` on."""
    columns = list(columns)
    if not columns:
        return df.sparkSession.createDataFrame([], "feature string, value string, slot long, name string")
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "feature", "value")
    place = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("feature"))
    known = long.where(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.lit(1).cast("long").alias("_one"))
    ranked = prefix_before(known.withColumn("_ord", F.struct(place.alias("p"), "value")), [], "_ord", "_one", out="slot")
    return ranked.select("feature", "value", (F.col("slot") + F.lit(base)).cast("long").alias("slot"),
                         F.concat(F.lit("cat__"), "feature", F.lit("_"), "value").alias("name"))


def slot_names(numeric, dictionary: DataFrame) -> DataFrame:
    """(slot, name) of all slots: the numeric block, then the categories."""
    block = dictionary.sparkSession.createDataFrame([(i, f"num__{c}") for i, c in enumerate(numeric)], "slot long, name string")  # bounded by the schema
    return block.unionByName(dictionary.select("slot", "name"))


def category_cells(df: DataFrame, dictionary: DataFrame, modes: ModeImputerModel, columns, key: str = "row_id") -> DataFrame:
    """(key, slot, name) of every category a row has, missing ones imputed."""
    columns = [c for c in columns if c in modes._stats()]
    if not columns:
        return df.where(F.lit(False)).select(key, F.lit(0).cast("long").alias("slot"), F.lit("").alias("name"))
    long = modes.transform(df.select(key, *columns)).unpivot([key], columns, "feature", "value")
    return long.join(dictionary, ["feature", "value"]).select(key, "slot", "name")


def encoded(df: DataFrame, numeric, dictionary: DataFrame, modes: ModeImputerModel, columns, size: int, key: str = "row_id") -> DataFrame:
    """(key, features): ``numeric`` columns (imputed and scaled before) in the
    first slots, a one for each category; a row's cells are as many as its columns."""
    cells = category_cells(df, dictionary, modes, columns, key).groupBy(key).agg(F.sort_array(F.collect_list(F.col("slot").cast("int"))).alias("_on"))
    on = F.coalesce("_on", F.array().cast("array<int>"))
    head = F.array(*[F.lit(i) for i in range(len(numeric))]).cast("array<int>")
    values = F.array(*[F.col(c).cast("double") for c in numeric]).cast("array<double>")
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), F.concat(head, on).alias("indices"),
                      F.concat(values, F.transform(on, lambda _: F.lit(1.0))).alias("values"))
    return df.select(key, *numeric).join(cells, key, "left").select(key, vector.cast(VECTOR).alias("features"))
