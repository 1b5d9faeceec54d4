"""Column expressions of the cleaning, naming and status rules.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none needs Python at run time.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text the pandas CSV reader turns into a missing value by
# default (pandas' documented `na_values` list).
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
             "n/a", "nan", "null"]

# Loan statuses kept and their label.
STATUS_LABEL = {"Fully Paid": 0, "Charged Off": 1, "Default": 1}

# Drift thresholds (metric < 0.10 none, < 0.25 moderate).
DRIFT_NONE, DRIFT_MODERATE = 0.10, 0.25
STATUS_NONE, STATUS_MODERATE, STATUS_SIGNIFICANT = "No Drift", "Moderate Drift", "Significant Drift"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_tokens(c, tokens=NA_TOKENS) -> Column:
    """Text equal to one of the missing-value tokens becomes NULL."""
    c = _c(c)
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


#: Text that counts as a number: decimal notation, or an infinity (the cast
#: alone would also take type suffixes and hexadecimal floats).
NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)\s*$"


def to_double(c) -> Column:
    """Lenient numeric coercion: unparsable text or NaN becomes NULL."""
    c = _c(c)
    number = (F.typeof(c) != "string") | c.cast("string").rlike(NUMBER)
    v = F.when(number, c.try_cast("double"))
    return F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v)


def pct_to_double(c) -> Column:
    """' 13.56%' -> 13.56; every trailing '%' is removed; bad text -> NULL."""
    return to_double(F.rtrim(_c(c).cast("string"), F.lit("%")))


def parse_month(c) -> Column:
    """'Mon-YYYY' -> first day of that month as a date; bad text -> NULL."""
    return F.try_to_timestamp(_c(c), F.lit("MMM-yyyy")).cast("date")


def label_of(c) -> Column:
    """Loan status text -> 0/1 label (NULL for statuses that are not kept)."""
    c = _c(c)
    out = None
    for k, v in STATUS_LABEL.items():
        out = (F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v)))
    return out.cast("int")


def drift_status(c) -> Column:
    c = _c(c)
    return (F.when(c < DRIFT_NONE, STATUS_NONE)
             .when(c < DRIFT_MODERATE, STATUS_MODERATE)
             .otherwise(STATUS_SIGNIFICANT))


def safe_name(c) -> Column:
    """Feature names a boosted-tree library accepts: '<' '[' ']' replaced."""
    c = _c(c)
    return F.replace(F.replace(F.replace(c, F.lit("<"), F.lit("less_than")),
                               F.lit("["), F.lit("(")), F.lit("]"), F.lit(")"))


def score_number(c) -> Column:
    """Score-time numeric coercion: unparsable or missing -> 0.0."""
    return F.coalesce(to_double(F.trim(_c(c).cast("string"))), F.lit(0.0))
