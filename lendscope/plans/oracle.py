"""Independent DuckDB SQL for the registered queries.

Every query is written from scratch in SQL over the driver's views; only the
common front (raw loans view -> clean -> split) is shared as CTE text.
Doubles are presented as DECIMAL(18,6) exactly as the Spark side does.
"""

from __future__ import annotations

from ..functions.columns import NA_TOKENS
from ..operators.clean import CATEGORICAL, NUMERIC

NUM = NUMERIC
CAT = CATEGORICAL
FEATURE_CAT = CAT + ["issue_d"]


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_NA = ", ".join(_q(t) for t in NA_TOKENS)

RAW = f"""
li AS (SELECT l_orderkey, COUNT(*) AS n, SUM(CAST(ROUND(l_discount*100) AS INT)) AS d,
  SUM(CAST(ROUND(l_tax*100) AS INT)) AS t, SUM(CAST(l_quantity AS INT)) AS q FROM lineitem GROUP BY l_orderkey),
raw AS (SELECT o_orderkey AS row_id,
 CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE o_totalprice END AS loan_amnt,
 CASE WHEN o_orderkey % 3 = 0 THEN ' 60 months' ELSE ' 36 months' END AS term,
 CASE WHEN o_orderkey % 97 = 0 THEN 'n/a' ELSE ' ' || CAST(CAST(FLOOR(CAST(d AS DOUBLE)/n) AS INT) AS VARCHAR) || '%' END AS int_rate,
 o_totalprice / (CASE WHEN o_orderkey % 3 = 0 THEN 60 ELSE 36 END) AS installment,
 SUBSTR('ABCDE', CAST(SUBSTR(o_orderpriority,1,1) AS INT), 1) AS grade,
 SUBSTR('ABCDE', CAST(SUBSTR(o_orderpriority,1,1) AS INT), 1) || CAST(o_orderkey % 5 + 1 AS VARCHAR) AS sub_grade,
 CASE WHEN c_custkey % 13 = 0 THEN 'n/a' WHEN c_custkey % 11 = 0 THEN '< 1 year' WHEN c_custkey % 11 = 10 THEN '10+ years'
      ELSE CAST(c_custkey % 11 AS VARCHAR) || ' years' END AS emp_length,
 CASE r_name WHEN 'AFRICA' THEN 'RENT' WHEN 'AMERICA' THEN 'OWN' WHEN 'ASIA' THEN 'MORTGAGE' ELSE 'OTHER' END AS home_ownership,
 c_acctbal AS annual_inc,
 CASE c_custkey % 3 WHEN 0 THEN 'Not Verified' WHEN 1 THEN 'Source Verified' ELSE 'Verified' END AS verification_status,
 LOWER(c_mktsegment) AS purpose, n_name AS addr_state,
 CAST(t AS DOUBLE)/n AS dti,
 CAST(600 + c_custkey % 50 * 5 AS DOUBLE) AS fico_range_low, CAST(604 + c_custkey % 50 * 5 AS DOUBLE) AS fico_range_high,
 CAST(n AS DOUBLE) AS open_acc,
 CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE CAST(CAST(FLOOR(CAST(q AS DOUBLE)/n) AS INT) AS VARCHAR) || '%' END AS revol_util,
 CASE WHEN o_orderkey % 101 = 0 THEN 'unknown' ELSE STRFTIME(o_orderdate, '%b-%Y') END AS issue_d,
 CASE o_orderstatus WHEN 'F' THEN 'Fully Paid' WHEN 'O' THEN 'Current' ELSE CASE WHEN o_orderkey % 4 = 0 THEN 'Default' ELSE 'Charged Off' END END AS loan_status
FROM orders JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey
 JOIN region ON n_regionkey=r_regionkey LEFT JOIN li ON l_orderkey=o_orderkey)"""

_TEXT_RAW = ["term", "int_rate", "grade", "sub_grade", "emp_length", "home_ownership",
             "verification_status", "purpose", "addr_state", "revol_util", "issue_d", "loan_status"]
_RAW_COLS = ["row_id", "loan_amnt", "term", "int_rate", "installment", "grade", "sub_grade",
             "emp_length", "home_ownership", "annual_inc", "verification_status", "purpose",
             "addr_state", "dti", "fico_range_low", "fico_range_high", "open_acc",
             "revol_util", "issue_d", "loan_status"]


def _scan_cols():
    out = []
    for c in _RAW_COLS:
        if c in _TEXT_RAW:
            out.append(f"CASE WHEN {c} IN ({_NA}) THEN NULL ELSE {c} END AS {c}")
        else:
            out.append(c)
    return ",\n ".join(out)


SCAN = f"scan AS (SELECT {_scan_cols()} FROM raw)"


def _num(e: str) -> str:
    return f"(CASE WHEN isnan(TRY_CAST({e} AS DOUBLE)) THEN NULL ELSE TRY_CAST({e} AS DOUBLE) END)"


def _clean_cols():
    out = ["row_id"]
    for c in _RAW_COLS[1:]:
        if c in ("int_rate", "revol_util"):
            out.append(f"{_num(f'RTRIM({c}, {_q(chr(37))})')} AS {c}")
        elif c in NUM:
            out.append(f"{_num(c)} AS {c}")
        elif c == "issue_d":
            out.append("CAST(TRY_STRPTIME(issue_d, '%b-%Y') AS DATE) AS issue_d")
        elif c == "loan_status":
            out.append("CAST(CASE loan_status WHEN 'Fully Paid' THEN 0 ELSE 1 END AS INTEGER) AS loan_status")
        elif c in CAT:
            out.append(f"TRIM({c}) AS {c}")
        else:
            out.append(c)
    out.append("CAST(YEAR(TRY_STRPTIME(issue_d, '%b-%Y')) AS INTEGER) AS issue_year")
    return ",\n ".join(out)


CLEAN = f"""clean0 AS (SELECT {_clean_cols()} FROM scan
 WHERE loan_status IN ('Fully Paid', 'Charged Off', 'Default')),
clean AS (SELECT * FROM clean0 WHERE issue_year IS NOT NULL)"""

SPLIT = """splits AS (SELECT *, CASE WHEN issue_year BETWEEN 1995 AND 1998 THEN 'train'
 WHEN issue_year = 1999 THEN 'val' WHEN issue_year = 2000 THEN 'test'
 WHEN issue_year = 2001 THEN 'prod' END AS split FROM clean
 WHERE issue_year BETWEEN 1995 AND 2001)"""

FEATURES = ("feat AS (SELECT row_id, split, " + ", ".join(NUM + CAT)
            + ", CAST(issue_d AS VARCHAR) AS issue_d FROM splits)")

FRONT = ",\n".join([RAW, SCAN, CLEAN, SPLIT, FEATURES])


def with_front(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join([FRONT, *ctes]) + "\n" + select


def d6(e: str) -> str:
    return f"CAST({e} AS DECIMAL(18,6))"
