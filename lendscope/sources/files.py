"""File sources and sinks: delimited loan files, generic table writer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import NA_TOKENS
from ..operators.clean import KEY, LABEL, RAW_SCHEMA, SPLIT, apply_null_tokens

# Fixed value: file-name pattern of the raw loan files (plain or compressed).
LOAN_GLOB = "accepted*.csv*"

# Text is kept exactly as written: no whitespace trimming, no quote games.
_CSV_TEXT = {"header": "true", "ignoreLeadingWhiteSpace": "false",
             "ignoreTrailingWhiteSpace": "false", "nullValue": "", "emptyValue": ""}


def _by_name(spark: SparkSession, path: str, names, options: dict) -> DataFrame:
    """The named text columns of delimited files, wherever they stand in the
    files and whatever stands beside them; an absent one is an error, and so is
    a file whose header differs from the first file's."""
    df = (spark.read.options(**_CSV_TEXT, **options).option("escape", '"')
          .option("enforceSchema", "false").option("mode", "PERMISSIVE").csv(path))
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise ValueError(f"columns not in the header of {path}: {', '.join(absent)}")
    return df


def read_loans(spark: SparkSession, path: str, glob: str = LOAN_GLOB,
               na_tokens=NA_TOKENS, schema=RAW_SCHEMA) -> DataFrame:
    """Delimited loan files under ``path`` (searched recursively, names
    matching ``glob``; gzip/bzip2 are decoded by the reader), the columns of
    ``schema`` taken by their name in the header, all text but the key, with
    the missing-value tokens turned into NULL. Files without a ``row_id`` get
    one by :func:`numbered`."""
    names = [f.name for f in schema]
    df = _by_name(spark, path, [n for n in names if n != "row_id"], {"recursiveFileLookup": "true", "pathGlobFilter": glob})
    if "row_id" in names and "row_id" not in df.columns:
        df = numbered(df)
    return apply_null_tokens(df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema]), na_tokens)


def numbered(df: DataFrame) -> DataFrame:
    """``df`` read from files, with ``row_id``: a 64-bit hash of the file, the
    row's content and, among equal rows of a file, its number. The same on every
    read, however the files are cut into tasks. Equal rows are counted by partial
    aggregation and dealt out again, so many of them make no hot key."""
    cols = df.columns
    counted = df.withColumn("_file", F.input_file_name()).groupBy("_file", *[F.col(f"`{c}`") for c in cols]).agg(F.count(F.lit(1)).alias("_rows"))
    each = counted.withColumn("_nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_rows"))))
    return each.select(F.xxhash64("_file", *[F.col(f"`{c}`") for c in cols], "_nth").alias("row_id"), *[F.col(f"`{c}`") for c in cols])


def write_splits(df: DataFrame, path: str, label: str = LABEL, key: str = KEY, split: str = SPLIT) -> None:
    """X (all columns but the label) and y (key, label) per split, as
    ``<path>/X/split=...`` and ``<path>/y/split=...``. Only the splits that
    ``df`` has are replaced; the others stay."""
    for name, part in (("X", df.drop(label)), ("y", df.select(key, label, split))):
        (part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(split).parquet(f"{path}/{name}"))


def read_split(spark: SparkSession, path: str, name: str, split: str = SPLIT) -> tuple[DataFrame, DataFrame]:
    """(X, y) of one split; only its folders are read."""
    return tuple(spark.read.parquet(f"{path}/{part}").where(F.col(split) == name) for part in ("X", "y"))


def write_vectors(df: DataFrame, names: DataFrame, path: str) -> None:
    """Feature vectors (key, features) and the (slot, name) table of their slots,
    as ``<path>/vectors`` and ``<path>/slots``; vectors may be Spark ML's or
    their stored form (``operators.dictionary.VECTOR``)."""
    df.write.mode("overwrite").parquet(f"{path}/vectors")
    names.write.mode("overwrite").parquet(f"{path}/slots")


def read_vectors(spark: SparkSession, path: str, key: str = KEY, cells: bool = False) -> tuple[DataFrame, DataFrame]:
    """(vectors, names) as written, the vectors as Spark ML's; with ``cells`` as
    rows (key, slot, value), dense vectors included, by built-in functions."""
    from pyspark.ml.linalg import VectorUDT
    raw = spark.read.parquet(f"{path}/vectors")
    kind, names = raw.schema[key].dataType, spark.read.parquet(f"{path}/slots")
    stored = VectorUDT.sqlType()
    form = stored if cells else VectorUDT()
    vectors = spark.read.schema(T.StructType([T.StructField(key, kind), T.StructField("features", form)])).parquet(f"{path}/vectors")
    if not cells:
        return vectors, names
    dense = F.sequence(F.lit(0), F.size("features.values") - 1)
    slots = F.when(F.col("features.type") == 0, F.col("features.indices")).when(F.size("features.values") > 0, dense).otherwise(F.array().cast("array<int>"))
    cell = F.explode(F.arrays_zip(slots.alias("slot"), F.col("features.values").alias("value"))).alias("x")
    return vectors.select(key, cell).select(key, "x.slot", "x.value"), names


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=(),
                compression: str | None = None, mode: str = "overwrite") -> None:
    """Write a result table (parquet, json or csv) to ``path``."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if compression:
        w = w.option("compression", compression)
    if fmt == "csv":
        w = w.options(**_CSV_TEXT)
    w.format(fmt).save(path)


def read_applications(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Application records (JSON lines or delimited) under the input contract:
    every field is read as text, so numbers that do not parse reach the
    score-time coercion instead of failing the read."""
    from ..operators.score import APPLICATION_SCHEMA
    if fmt == "json":
        return spark.read.schema(APPLICATION_SCHEMA).option("mode", "PERMISSIVE").option("primitivesAsString", "true").json(path)
    names = [f.name for f in APPLICATION_SCHEMA]
    return _by_name(spark, path, names, {}).select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in APPLICATION_SCHEMA])
