"""Cleaning, labelling and the temporal split.

One narrow (shuffle-free) projection each; filters sit directly above the scan
so Catalyst pushes the status predicate into the reader when the input is a
file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import (NA_TOKENS, STATUS_LABEL, label_of, null_tokens,
                                 parse_month, pct_to_double, to_double)

# Canonical loan columns.
NUMERIC = ["loan_amnt", "int_rate", "installment", "annual_inc", "dti",
           "fico_range_low", "fico_range_high", "open_acc", "revol_util"]
CATEGORICAL = ["term", "grade", "sub_grade", "emp_length", "home_ownership",
               "verification_status", "purpose", "addr_state"]
PERCENT = ["int_rate", "revol_util"]
PLAIN_NUMERIC = [c for c in NUMERIC if c not in PERCENT]
LABEL, YEAR, KEY, SPLIT = "loan_status", "issue_year", "row_id", "split"
HELPERS = (LABEL, YEAR, KEY, SPLIT)

# Raw scan schema: everything but the key is text, as in a delimited file.
RAW_SCHEMA = T.StructType(
    [T.StructField(KEY, T.LongType())]
    + [T.StructField(c, T.StringType()) for c in
       ["loan_amnt", "term", "int_rate", "installment", "grade", "sub_grade",
        "emp_length", "home_ownership", "annual_inc", "verification_status",
        "purpose", "addr_state", "dti", "fico_range_low", "fico_range_high",
        "open_acc", "revol_util", "issue_d", "loan_status"]])

# Split years of the reference (train 2007-2015, val 2016,
# test 2017, prod 2018) and the years used with the driver tables.
REFERENCE_SPLITS = {"train": (2007, 2015), "val": (2016, 2016),
                    "test": (2017, 2017), "prod": (2018, 2018)}
FIXTURE_SPLITS = {"train": (1995, 1998), "val": (1999, 1999),
                  "test": (2000, 2000), "prod": (2001, 2001)}


def apply_null_tokens(df: DataFrame, tokens=NA_TOKENS) -> DataFrame:
    """What a delimited-file reader does to text columns: NA tokens -> NULL."""
    return df.select([null_tokens(c, tokens).alias(c) if t == "string" else F.col(c)
                      for c, t in df.dtypes])


def clean_loans(df: DataFrame, trim_text: bool = True) -> DataFrame:
    """Keep decided loans, label them, parse percentages, months and numbers.

    Rows whose month does not parse are dropped (no year, no split). With
    ``trim_text`` categories are trimmed here and at scoring time, so a
    client that trims input still matches the trained categories.
    """
    status = F.col(LABEL)
    kept = df.where(status.isin(list(STATUS_LABEL)))
    issue = parse_month(F.col("issue_d"))
    cols = []
    for c in df.columns:
        if c == LABEL:
            cols.append(label_of(status).alias(LABEL))
        elif c in PERCENT:
            cols.append(pct_to_double(c).alias(c))
        elif c in PLAIN_NUMERIC:
            cols.append(to_double(F.col(c)).alias(c))
        elif c == "issue_d":
            cols.append(issue.alias("issue_d"))
        elif c in CATEGORICAL and trim_text:
            cols.append(F.trim(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    cols.append(F.year(issue).alias(YEAR))
    return kept.select(cols).where(F.col(YEAR).isNotNull())


def temporal_split(df: DataFrame, ranges: dict = FIXTURE_SPLITS,
                   year: str = YEAR) -> DataFrame:
    """Adds ``split`` from year ranges; rows in no range are dropped."""
    y = F.col(year)
    s = None
    for name, (lo, hi) in ranges.items():
        cond = y.between(lo, hi)
        s = F.when(cond, F.lit(name)) if s is None else s.when(cond, F.lit(name))
    return df.withColumn(SPLIT, s).where(F.col(SPLIT).isNotNull())


def feature_view(df: DataFrame, drop=HELPERS) -> DataFrame:
    """The feature columns the reference writes as X: helpers removed and the
    month kept as text (it is read back from a delimited file as a string)."""
    cols = [F.col(c).cast("string").alias(c) if c == "issue_d" else F.col(c)
            for c in df.columns if c not in drop]
    return df.select(cols)


def column_roles(schema: T.StructType, drop=HELPERS):
    """Numeric vs categorical columns from the schema; booleans are categorical."""
    num, cat = [], []
    for f in schema.fields:
        if f.name in drop:
            continue
        if isinstance(f.dataType, T.NumericType):
            num.append(f.name)
        else:
            cat.append(f.name)
    return num, cat
