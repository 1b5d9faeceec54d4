import pytest
"""Delimited loan files: discovery, schema, NA tokens, then cleaning."""

import gzip

from lendscope.operators.clean import clean_loans
from lendscope.sources.files import read_loans

HEADER = ("row_id,loan_amnt,term,int_rate,installment,grade,sub_grade,emp_length,home_ownership,"
          "annual_inc,verification_status,purpose,addr_state,dti,fico_range_low,fico_range_high,"
          "open_acc,revol_util,issue_d,loan_status")
ROWS = [
    "1,1000, 36 months, 13.56%,30.5,B,B2,10+ years,RENT,50000,Verified,car,CA,12.5,700,704,5,45.1%,Mar-2016,Fully Paid",
    "2,abc, 60 months,7%%,40,C,C1,n/a,OWN,NA,Not Verified,debt,NY,,690,694,3,,Dec-2015,Charged Off",
    "3,500, 36 months,n/a,10,A,A1,< 1 year,MORTGAGE,1,Verified,car,TX,1,650,654,1,1%,bad,Default",
    "4,700, 36 months,5%,10,A,A1,1 year,MORTGAGE,1,Verified,car,TX,1,650,654,1,1%,Jan-2017,Current",
]


def test_read_and_clean_delimited_loans(spark, tmp_path):
    sub = tmp_path / "raw" / "2018"
    sub.mkdir(parents=True)
    with gzip.open(sub / "accepted_2007_to_2018Q4.csv.gz", "wt") as f:
        f.write(HEADER + "\n" + "\n".join(ROWS) + "\n")
    (tmp_path / "raw" / "rejected_2007.csv").write_text(HEADER + "\n" + ROWS[0].replace("1,", "9,", 1) + "\n")
    raw = read_loans(spark, str(tmp_path / "raw"))
    got = {r["row_id"]: r for r in raw.collect()}
    assert set(got) == {1, 2, 3, 4}  # the rejected file does not match the pattern
    assert got[1]["term"] == " 36 months"  # leading space kept as text
    assert got[2]["emp_length"] is None and got[3]["int_rate"] is None  # 'n/a' -> missing
    clean = {r["row_id"]: r for r in clean_loans(raw).collect()}
    assert set(clean) == {1, 2}  # 3: month does not parse; 4: status not kept
    assert clean[1]["int_rate"] == 13.56 and clean[1]["revol_util"] == 45.1
    assert clean[2]["int_rate"] == 7.0 and clean[2]["loan_amnt"] is None
    assert clean[1]["loan_status"] == 0 and clean[2]["loan_status"] == 1
    assert clean[1]["issue_year"] == 2016 and str(clean[2]["issue_d"]) == "2015-12-01"
    assert clean[1]["term"] == "36 months"


def test_applications_contract_and_coercion(spark, tmp_path):
    import json
    from pyspark.sql import functions as F
    from lendscope.operators import score as sc
    from lendscope.sources.files import read_applications
    # The documented example request, plus a bad number, an
    # untrimmed term and a request missing a required field.
    example = {"annual_inc": 78000.0, "emp_length": "10+ years", "home_ownership": "MORTGAGE", "addr_state": "CA",
               "loan_amnt": 15000.0, "term": " 36 months", "int_rate": 11.49, "installment": 356.48,
               "purpose": "debt_consolidation", "issue_d": "2018-01-01", "fico_range_low": 710.0,
               "fico_range_high": 714.0, "open_acc": 12.0, "revol_util": 38.5, "dti": 14.2, "grade": "B",
               "sub_grade": "B2", "verification_status": "Source Verified"}
    bad = dict(example, row_id=2, dti="fourteen")
    missing = {k: v for k, v in example.items() if k != "grade"} | {"row_id": 3}
    lines = [json.dumps(dict(example, row_id=1)), json.dumps(bad), json.dumps(missing)]
    (tmp_path / "apps.json").write_text("\n".join(lines) + "\n")
    apps = read_applications(spark, str(tmp_path / "apps.json"))
    ok, rejected = sc.split_rejects(apps)
    assert [r["row_id"] for r in rejected.collect()] == [3]
    x = {r["row_id"]: r for r in sc.coerce_applications(ok).collect()}
    assert x[1]["dti"] == 14.2 and x[2]["dti"] == 0.0  # bad number -> 0.0 (T11)
    assert x[1]["term"] == "36 months"  # trimmed at scoring (T10)
    bands = sc.risk_bands(spark.createDataFrame([(0.46500, 0), (0.5, 0), (0.99995, 1)], "y_prob double, y_pred int"))
    got = [(r["prediction_label"], float(r["probability"]), r["risk_score"]) for r in bands.collect()]
    assert got == [("Low Risk", 0.465, 46), ("Low Risk", 0.5, 50), ("High Risk", 1.0, 100)]  # half-even


def test_compare_rule_column_matches_python(spark):
    from rules import compare
    from lendscope.operators import rank
    recs = [(0.700, 0.50, 0.4, 1.0), (0.704, 0.45, 0.5, 2.0), (0.708, 0.40, 0.6, 3.0), (0.7001, 0.50, 0.4, 0.5)]
    f = ["roc_auc", "f1_score", "recall", "training_time"]
    pairs = [(dict(zip(f, a)), dict(zip(f, b))) for a in recs for b in recs if a != b]
    df = spark.createDataFrame([(a, b) for a, b in pairs],
                               "a struct<roc_auc double, f1_score double, recall double, training_time double>, "
                               "b struct<roc_auc double, f1_score double, recall double, training_time double>")
    got = [r[0] for r in df.select(rank.compare_col("a", "b")).collect()]
    assert got == [compare(a, b) for a, b in pairs]


def test_decided_only_scan_pushes_status_and_keeps_rows(spark, small):
    """Dropping undecided loans at the orders scan gives the same cleaned rows
    as the status filter on the label, and the predicate reaches the reader."""
    from pyspark.sql import functions as F

    from lendscope.operators.clean import apply_null_tokens
    from lendscope.sources.tables import loans_raw

    early = clean_loans(apply_null_tokens(loans_raw(spark, small, decided_only=True)))
    late = clean_loans(apply_null_tokens(loans_raw(spark, small)))
    assert early.count() == late.count() > 0
    assert early.exceptAll(late).count() == 0 and late.exceptAll(early).count() == 0
    raw = loans_raw(spark, small, decided_only=True)
    assert raw.where(F.col("loan_status") == "Current").count() == 0
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert "o_orderstatus" in plan and "PushedFilters: [Or(IsNull(o_orderstatus)" in plan


def test_session_shuffle_sizing_by_master():
    """A cluster master keeps the cluster's shuffle count and gets AQE's large
    initial count; a local master gets a small fixed count (conf only, no JVM)."""
    from unittest import mock

    from lendscope import session as S

    seen = {}

    class B:
        def appName(self, _):
            return self

        def master(self, m):
            seen["master"] = m
            return self

        def config(self, k, v):
            seen[k] = v
            return self

        def getOrCreate(self):
            return mock.MagicMock()

    for master, want_parts, want_initial in (("local[4]", "8", None),
                                             ("spark://h:7077", None, "20000")):
        seen.clear()
        with mock.patch.object(S.SparkSession, "builder", B()):
            S.get_session(master)
        assert seen.get("spark.sql.shuffle.partitions") == want_parts
        assert seen.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == want_initial


def test_loans_are_read_by_column_name(spark, tmp_path):
    from lendscope.operators.clean import RAW_SCHEMA
    names = [f.name for f in RAW_SCHEMA if f.name != "row_id"]
    header = ["extra", *reversed(names), "more"]
    row = {n: f"v_{n}" for n in names} | {"extra": "1", "more": 'say ""hi"", x', names[0]: "a, b"}
    (tmp_path / "accepted_x.csv").write_text(",".join(header) + "\n" + ",".join(f'"{row[h]}"' for h in header) + "\n")
    got = read_loans(spark, str(tmp_path)).collect()[0]
    assert {n: got[n] for n in names} == {n: row[n] for n in names} and got["row_id"] is not None
    (tmp_path / "accepted_x.csv").write_text(",".join(header[:-2]) + "\n")
    with pytest.raises(ValueError, match=names[0]):
        read_loans(spark, str(tmp_path))


def test_learner_family_ignores_case():
    from lendscope.operators.train import family
    assert [family(k) for k in ("XGBoost", "gbt", "Logistic Regression", "random_forest")] == ["boosted", "boosted", "logistic", "forest"]
