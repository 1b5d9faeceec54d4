"""A training corpus from raw documents: language ID, near-dedup, masking of
personal data, mixing of sources, packing.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps,
with the columns of ``documents``; the last returns the packed pieces. Stages
are written as Parquet and read back, so a failure repeats one stage.

Defined results: a null or letterless text goes in the language stage; repeated
rows are near duplicates of each other, one stays; null doc_ids, langs and
sources are kept like others; an empty table gives no pieces; further columns
pass through every stage but the last, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.llm import dedup, language, mixing, packing, pii
from lendscope.llm.common import materialised, table, unused

#: A document stays if some language explains at least this share of its probability.
LEAST_SHARE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned; texts without letters go."""
    lang, share = unused(docs.columns, "_lang_pred", "_score")
    told = language.identify(docs, language.fit(language.learning_rows(docs)), docs.columns, (lang, share))
    return told.where((F.col(lang) != "und") & (F.col(share) >= LEAST_SHARE)).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that share 80 % of their five-word shingles."""
    return dedup.deduplicated(docs, width=5, percent=80)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, identifiers replaced by their kind."""
    masked = docs.withColumn("text", pii.mask(F.col("text")))
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.digested(docs)


STAGES = [
    ("language", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # fitted models, signatures and packing are beyond SQL; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialised(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
