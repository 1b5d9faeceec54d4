"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Each builder takes (spark, sf_dir) and returns a lazy DataFrame over the
whole driver tables; doubles are presented as DECIMAL(18,6) so both engines
hash the same values.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import drift as drift_ops
from ..operators.clean import CATEGORICAL, NUMERIC, PLAIN_NUMERIC
from ..session import keep_compiled
from . import oracle as O
from .pipeline import FIXTURE_SPLITS, clean, r6, scan_loans, split_features, splits

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        @wraps(fn)
        def run(spark, d):
            keep_compiled(spark)
            return fn(spark, d)
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


FEATURE_CAT = CATEGORICAL + ["issue_d"]


def _num_out(df: DataFrame) -> DataFrame:
    return df.select([r6(c).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# ---------------------------------------------------------------- step 1: scan, clean, split

_RAW_COLS = O._RAW_COLS
_D = lambda c: O.d6(c) + f" AS {c}"


@register("scan_loans", O.with_front(select="SELECT " + ", ".join(
    _D(c) if c in ("loan_amnt", "installment", "annual_inc", "dti", "fico_range_low",
                   "fico_range_high", "open_acc") else c for c in _RAW_COLS) + " FROM scan"))
def q_scan_loans(spark, d):
    return _num_out(scan_loans(spark, d))


@register("null_tokens", O.with_front(select="""SELECT row_id, int_rate, emp_length, revol_util,
 CAST((int_rate IS NULL) AS INTEGER) + CAST((emp_length IS NULL) AS INTEGER) + CAST((revol_util IS NULL) AS INTEGER) AS n_missing
 FROM scan"""))
def q_null_tokens(spark, d):
    s = scan_loans(spark, d)
    n = sum(F.col(c).isNull().cast("int") for c in ("int_rate", "emp_length", "revol_util"))
    return s.select("row_id", "int_rate", "emp_length", "revol_util", n.alias("n_missing"))


@register("clean_filter", O.with_front(select="""SELECT row_id, loan_status FROM scan
 WHERE loan_status IN ('Fully Paid', 'Charged Off', 'Default')"""))
def q_clean_filter(spark, d):
    s = scan_loans(spark, d)
    return s.where(F.col("loan_status").isin("Fully Paid", "Charged Off", "Default")) \
            .select("row_id", "loan_status")


@register("label_map", O.with_front(select="SELECT row_id, loan_status FROM clean"))
def q_label_map(spark, d):
    return clean(spark, d).select("row_id", "loan_status")


@register("percent_clean", O.with_front(
    select=f"SELECT row_id, {O.d6('int_rate')} AS int_rate, {O.d6('revol_util')} AS revol_util FROM clean"))
def q_percent_clean(spark, d):
    return clean(spark, d).select("row_id", r6("int_rate").alias("int_rate"),
                                  r6("revol_util").alias("revol_util"))


@register("parse_issue", O.with_front(select="SELECT row_id, issue_d, issue_year FROM clean"))
def q_parse_issue(spark, d):
    return clean(spark, d).select("row_id", "issue_d", "issue_year")


@register("numeric_coerce", O.with_front(
    select="SELECT row_id, " + ", ".join(_D(c) for c in PLAIN_NUMERIC) + " FROM clean"))
def q_numeric_coerce(spark, d):
    return clean(spark, d).select("row_id", *[r6(c).alias(c) for c in PLAIN_NUMERIC])


@register("temporal_split", O.with_front(select="SELECT row_id, issue_year, split FROM splits"))
def q_temporal_split(spark, d):
    return splits(spark, d).select("row_id", "issue_year", "split")


# ---------------------------------------------------------------- drift

def _train_prod(spark, d):
    return split_features(spark, d, "train"), split_features(spark, d, "prod")


_SQL_LONG = f"""long AS (SELECT side, feature, ROUND(x, 9) AS x FROM (
  SELECT CASE split WHEN 'train' THEN 'base' ELSE 'cur' END AS side, {", ".join(NUMERIC)}
  FROM feat WHERE split IN ('train', 'prod'))
  UNPIVOT (x FOR feature IN ({", ".join(NUMERIC)})) WHERE NOT isnan(x))"""
_SQL_EDGES = """qs AS (SELECT feature, UNNEST(quantile_cont(x, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])) AS q
  FROM long WHERE side = 'base' GROUP BY feature),
raw_e AS (SELECT feature, list_sort(list_distinct(list(ROUND(q, 9)))) AS e FROM qs GROUP BY feature),
mm AS (SELECT feature,
  MIN(x) FILTER (WHERE side = 'base') AS bmin, MAX(x) FILTER (WHERE side = 'base') AS bmax,
  MIN(x) FILTER (WHERE side = 'cur') AS cmin, MAX(x) FILTER (WHERE side = 'cur') AS cmax,
  COUNT(*) FILTER (WHERE side = 'base') AS n_base, COUNT(*) FILTER (WHERE side = 'cur') AS n_cur
  FROM long GROUP BY feature),
ed AS (SELECT r.feature, m.n_base, m.n_cur, list_transform(
  CASE WHEN len(e) = 1 THEN [e[1] - 0.001::DOUBLE, e[1] + 0.001::DOUBLE]
  ELSE [LEAST(e[1], bmin, cmin) - 0.00001::DOUBLE] || e[2:len(e) - 1] || [GREATEST(e[len(e)], bmax, cmax) + 0.00001::DOUBLE] END,
  lambda v: ROUND(v, 9)) AS edges
  FROM raw_e r JOIN mm m ON r.feature = m.feature)"""
_SQL_BINS = """binned AS (SELECT l.feature, l.side, len(list_filter(edges[2:len(edges) - 1], lambda v: l.x >= v)) AS bin
  FROM long l JOIN ed ON l.feature = ed.feature
  WHERE l.x >= edges[1] AND l.x <= edges[len(edges)]),
cnt AS (SELECT feature, bin, COUNT(*) FILTER (WHERE side = 'base') AS base_count,
  COUNT(*) FILTER (WHERE side = 'cur') AS cur_count FROM binned GROUP BY feature, bin),
grid AS (SELECT feature, n_base, n_cur, UNNEST(range(0, len(edges) - 1)) AS bin FROM ed),
g0 AS (SELECT g.feature, g.bin, g.n_base, g.n_cur, COALESCE(c.base_count, 0) AS base_count,
  COALESCE(c.cur_count, 0) AS cur_count FROM grid g LEFT JOIN cnt c ON g.feature = c.feature AND g.bin = c.bin),
g1 AS (SELECT *, CASE WHEN base_count = 0 THEN 0.0001::DOUBLE ELSE base_count::DOUBLE / n_base END AS tp,
  CASE WHEN cur_count = 0 THEN 0.0001::DOUBLE ELSE cur_count::DOUBLE / n_cur END AS cp FROM g0),
pb AS (SELECT feature, bin, base_count, cur_count, n_base, n_cur,
  tp / SUM(tp) OVER (PARTITION BY feature) AS base_prop, cp / SUM(cp) OVER (PARTITION BY feature) AS cur_prop FROM g1)"""
_SQL_PSI = """psi AS (SELECT feature, CASE WHEN MIN(LEAST(n_base, n_cur)) > 0
  THEN SUM((cur_prop - base_prop) * LN(cur_prop / base_prop)) ELSE 0.0 END AS metric FROM pb GROUP BY feature)"""
_SQL_CAT = f"""clong AS (SELECT side, feature, value FROM (
  SELECT CASE split WHEN 'train' THEN 'base' ELSE 'cur' END AS side, {", ".join(FEATURE_CAT)}
  FROM feat WHERE split IN ('train', 'prod'))
  UNPIVOT (value FOR feature IN ({", ".join(FEATURE_CAT)}))),
vc AS (SELECT feature, value, COUNT(*) FILTER (WHERE side = 'base') AS bc,
  COUNT(*) FILTER (WHERE side = 'cur') AS cc FROM clong GROUP BY feature, value),
tot AS (SELECT feature, SUM(bc) AS nb, SUM(cc) AS nc FROM vc GROUP BY feature),
cat AS (SELECT v.feature, CASE WHEN MIN(LEAST(nb, nc)) > 0
  THEN SUM(ABS(bc::DOUBLE / nb - cc::DOUBLE / nc)) ELSE 0.0 END AS metric
  FROM vc v JOIN tot t ON v.feature = t.feature GROUP BY v.feature)"""
_SQL_STATUS = """CASE WHEN metric < 0.1 THEN 'No Drift' WHEN metric < 0.25 THEN 'Moderate Drift'
  ELSE 'Significant Drift' END"""
_SQL_REPORT = f"""rep AS (SELECT p.feature, 'Numerical' AS feature_type, p.metric,
  COALESCE(len(r.e) = 1, FALSE) AS constant_feature FROM psi p LEFT JOIN raw_e r ON p.feature = r.feature
  UNION ALL SELECT feature, 'Categorical' AS feature_type, metric, FALSE AS constant_feature FROM cat),
report AS (SELECT feature, feature_type, metric, constant_feature, {_SQL_STATUS} AS drift_status FROM rep)"""


@register("psi_edges", O.with_front(_SQL_LONG, _SQL_EDGES, select=f"""
SELECT feature, CAST(i AS INTEGER) AS edge_index, {O.d6('edges[i + 1]')} AS edge FROM (
  SELECT feature, edges, UNNEST(range(0, len(edges))) AS i FROM ed)"""))
def q_psi_edges(spark, d):
    tr, pr = _train_prod(spark, d)
    e = drift_ops.psi_edges(tr, pr, NUMERIC)
    return e.select("feature", F.posexplode("edges").alias("edge_index", "edge")) \
            .select("feature", "edge_index", r6("edge").alias("edge"))


@register("psi_bins", O.with_front(_SQL_LONG, _SQL_EDGES, _SQL_BINS, select=f"""
SELECT feature, CAST(bin AS INTEGER) AS bin, base_count, cur_count,
 {O.d6('base_prop')} AS base_prop, {O.d6('cur_prop')} AS cur_prop FROM pb"""))
def q_psi_bins(spark, d):
    tr, pr = _train_prod(spark, d)
    b = drift_ops.psi_bins(tr, pr, NUMERIC)
    return b.select("feature", "bin", "base_count", "cur_count",
                    r6("base_prop").alias("base_prop"), r6("cur_prop").alias("cur_prop"))


@register("drift_numeric", O.with_front(_SQL_LONG, _SQL_EDGES, _SQL_BINS, _SQL_PSI,
                                        select=f"SELECT feature, {O.d6('metric')} AS metric FROM psi"))
def q_drift_numeric(spark, d):
    tr, pr = _train_prod(spark, d)
    return drift_ops.numeric_psi(tr, pr, NUMERIC).select("feature", r6("metric").alias("metric"))


@register("drift_categorical", O.with_front(_SQL_CAT,
                                            select=f"SELECT feature, {O.d6('metric')} AS metric FROM cat"))
def q_drift_categorical(spark, d):
    tr, pr = _train_prod(spark, d)
    return drift_ops.categorical_drift(tr, pr, FEATURE_CAT).select("feature", r6("metric").alias("metric"))


_REPORTS: dict = {}


def drift_report_df(spark, d):
    """The drift report, computed once per session and input (one row per
    feature, so it is kept as a small literal table) and shared by the
    summary, the top-k view and the refit gate."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _REPORTS:
        tr, pr = _train_prod(spark, d)
        rep = drift_ops.drift_report(tr, pr)
        _REPORTS[key] = (rep.collect(), rep.schema)
    rows, schema = _REPORTS[key]
    return spark.createDataFrame(rows, schema)


_DRIFT_CTES = (_SQL_LONG, _SQL_EDGES, _SQL_BINS, _SQL_PSI, _SQL_CAT, _SQL_REPORT)


@register("drift_report", O.with_front(*_DRIFT_CTES, select=f"""
SELECT feature, feature_type, {O.d6('metric')} AS metric, constant_feature, drift_status FROM report
ORDER BY metric DESC, feature"""))
def q_drift_report(spark, d):
    r = drift_report_df(spark, d)
    return r.select("feature", "feature_type", r6("metric").alias("metric"), "constant_feature",
                    "drift_status")


@register("drift_summary", O.with_front(*_DRIFT_CTES, select=f"""
SELECT COUNT(*) AS total_features,
 COUNT(*) FILTER (WHERE drift_status = 'No Drift') AS no_drift,
 COUNT(*) FILTER (WHERE drift_status = 'Moderate Drift') AS moderate_drift,
 COUNT(*) FILTER (WHERE drift_status = 'Significant Drift') AS significant_drift,
 {O.d6("(COUNT(*) FILTER (WHERE drift_status <> 'No Drift'))::DOUBLE / NULLIF(COUNT(*), 0)")} AS moderate_or_above_ratio,
 (COUNT(*) FILTER (WHERE drift_status = 'Significant Drift') > 0)
   OR COALESCE((COUNT(*) FILTER (WHERE drift_status <> 'No Drift'))::DOUBLE / NULLIF(COUNT(*), 0) > 0.3, FALSE)
   AS retraining_recommended,
 CASE WHEN (COUNT(*) FILTER (WHERE drift_status = 'Significant Drift') > 0)
   OR COALESCE((COUNT(*) FILTER (WHERE drift_status <> 'No Drift'))::DOUBLE / NULLIF(COUNT(*), 0) > 0.3, FALSE)
   THEN 'Retraining Recommended' ELSE 'No Retraining Needed' END AS overall_status
FROM report"""))
def q_drift_summary(spark, d):
    s = drift_ops.drift_summary(drift_report_df(spark, d))
    return s.withColumn("moderate_or_above_ratio", r6("moderate_or_above_ratio"))


# ---------------------------------------------------------------- step 2: sampling, profiles, joins

from ..functions.columns import STATUS_LABEL, parse_month  # noqa: E402
from ..operators import profile as prof  # noqa: E402
from ..operators import sample as smp  # noqa: E402
from ..operators.clean import HELPERS  # noqa: E402
from ..session import shared_dir, stored_table  # noqa: E402
from .pipeline import split_rows, stored_clean, stored_splits  # noqa: E402

CAP = 500  # per-year cap used with the driver tables (20,000 in the reference)

_SQL_QUOTA = f"""qc AS (SELECT issue_year, loan_status, COUNT(*) AS available FROM clean GROUP BY issue_year, loan_status),
qc2 AS (SELECT *, SUM(available) OVER (PARTITION BY issue_year) AS total FROM qc),
qc3 AS (SELECT *, (available * {CAP}) // total AS base, (available * {CAP}) % total AS rem FROM qc2),
qc4 AS (SELECT *, {CAP} - SUM(base) OVER (PARTITION BY issue_year) AS lft,
  ROW_NUMBER() OVER (PARTITION BY issue_year ORDER BY rem DESC, available DESC, loan_status) AS pos FROM qc3),
quota AS (SELECT issue_year, loan_status, available,
  CAST(CASE WHEN total <= {CAP} THEN available ELSE base + CASE WHEN pos <= lft THEN 1 ELSE 0 END END AS BIGINT) AS quota FROM qc4)"""
_SQL_CAP = """capped AS (SELECT c.* FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY issue_year, loan_status
  ORDER BY md5(concat_ws('_', '42', CAST(row_id AS VARCHAR)))) AS rn FROM clean) c
  JOIN quota q ON c.issue_year = q.issue_year AND c.loan_status = q.loan_status WHERE c.rn <= q.quota)"""


def _capped(spark, d):
    return smp.stratified_cap(stored_clean(spark, d), CAP)


@register("strata_quota", O.with_front(_SQL_QUOTA, select="SELECT issue_year, loan_status, available, quota FROM quota"))
def q_strata_quota(spark, d):
    return smp.strata_quota(stored_clean(spark, d), CAP)


@register("stratified_cap", O.with_front(_SQL_QUOTA, _SQL_CAP,
                                         select="SELECT row_id, issue_year, loan_status FROM capped"))
def q_stratified_cap(spark, d):
    return _capped(spark, d).select("row_id", "issue_year", "loan_status")


@register("shuffle_order", O.with_front(_SQL_QUOTA, _SQL_CAP, select="""
SELECT row_id, shuffle_key, ROW_NUMBER() OVER (ORDER BY shuffle_key, row_id) - 1 AS shuffle_pos
FROM (SELECT row_id, md5(concat_ws('_', '42', CAST(row_id AS VARCHAR))) AS shuffle_key FROM capped)"""))
def q_shuffle_order(spark, d):
    """The whole capped sample in its seeded global order, with positions."""
    return smp.seeded_positions(_capped(spark, d)).select("row_id", "shuffle_key", "shuffle_pos")


@register("year_counts", O.with_front(_SQL_QUOTA, _SQL_CAP, select="""
SELECT a.issue_year, a.available, COALESCE(s.sampled, 0) AS sampled
FROM (SELECT issue_year, COUNT(*) AS available FROM clean GROUP BY issue_year) a
LEFT JOIN (SELECT issue_year, COUNT(*) AS sampled FROM capped GROUP BY issue_year) s ON a.issue_year = s.issue_year"""))
def q_year_counts(spark, d):
    return prof.year_counts(stored_clean(spark, d), _capped(spark, d))


@register("prep_counts", O.with_front(select="""
SELECT COUNT(*) AS rows_read,
 COUNT(*) FILTER (WHERE loan_status IN ('Fully Paid', 'Charged Off', 'Default')) AS rows_status_kept,
 COUNT(*) FILTER (WHERE loan_status IN ('Fully Paid', 'Charged Off', 'Default')
   AND TRY_STRPTIME(issue_d, '%b-%Y') IS NOT NULL) AS rows_kept FROM scan"""))
def q_prep_counts(spark, d):
    return prof.prep_counts(scan_loans(spark, d), list(STATUS_LABEL), parse_month(F.col("issue_d")))


_CLEAN_COLS = O._RAW_COLS + ["issue_year"]


@register("missing_by_column", O.with_front(select=" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS missing FROM clean"
    for c in _CLEAN_COLS)))
def q_missing_by_column(spark, d):
    return prof.missing_by_column(stored_clean(spark, d))


@register("class_distribution", O.with_front(select=f"""
SELECT loan_status, COUNT(*) AS count, {O.d6('COUNT(*) * 100.0 / SUM(COUNT(*)) OVER ()')} AS percent
FROM clean GROUP BY loan_status"""))
def q_class_distribution(spark, d):
    return prof.class_distribution(stored_clean(spark, d)).withColumn("percent", r6("percent"))


@register("split_report", O.with_front(select=f"""
SELECT split, COUNT(*) AS rows, 18 AS features, {O.d6('AVG(loan_status)')} AS default_rate,
 MIN(issue_year) AS min_year, MAX(issue_year) AS max_year,
 CAST({' + '.join(f'COUNT(*) FILTER (WHERE {c} IS NULL)' for c in NUMERIC + CATEGORICAL + ['issue_d'])} AS BIGINT) AS missing_cells
FROM splits GROUP BY split"""))
def q_split_report(spark, d):
    return prof.split_report(stored_splits(spark, d)).withColumn("default_rate", r6("default_rate"))


@register("split_missing", O.with_front(select=" UNION ALL ".join(
    f"SELECT split, '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS missing FROM splits GROUP BY split"
    for c in NUMERIC + CATEGORICAL + ["issue_d"])))
def q_split_missing(spark, d):
    return prof.split_missing(stored_splits(spark, d))


@register("split_violations", O.with_front(select="""
SELECT split, issue_year, COUNT(*) AS rows,
 CASE split WHEN 'train' THEN issue_year BETWEEN 1995 AND 1998 WHEN 'val' THEN issue_year = 1999
   WHEN 'test' THEN issue_year = 2000 WHEN 'prod' THEN issue_year = 2001 ELSE FALSE END AS valid
FROM splits GROUP BY split, issue_year
UNION ALL
SELECT NULL AS split, issue_year, COUNT(*) AS rows, FALSE AS valid FROM clean
WHERE NOT issue_year BETWEEN 1995 AND 2001 GROUP BY issue_year"""))
def q_split_violations(spark, d):
    return prof.split_violations(stored_splits(spark, d), stored_clean(spark, d))


@register("label_join", O.with_front(select=f"""
SELECT row_id, split, loan_status, {O.d6('loan_amnt')} AS loan_amnt FROM splits"""))
def q_label_join(spark, d):
    s = stored_splits(spark, d)
    feats = s.drop("loan_status")
    labels = s.select("row_id", "loan_status")
    return prof.join_labels(feats, labels).select("row_id", "split", "loan_status",
                                                  r6("loan_amnt").alias("loan_amnt"))


@register("combined_train", O.with_front(select="""
SELECT row_id, split, loan_status FROM splits WHERE split IN ('train', 'prod')"""))
def q_combined_train(spark, d):
    return prof.combine(split_rows(spark, d, "train"), split_rows(spark, d, "prod")) \
        .select("row_id", "split", "loan_status")


@register("parquet_roundtrip", O.with_front(select=f"""
SELECT row_id, issue_year, loan_status, issue_d, {O.d6('int_rate')} AS int_rate, term FROM clean"""))
def q_parquet_roundtrip(spark, d):
    path = shared_dir(spark, "clean")
    clean(spark, d).write.mode("overwrite").partitionBy("issue_year").parquet(path)
    back = spark.read.parquet(path)
    return back.select("row_id", "issue_year", "loan_status", "issue_d",
                       r6("int_rate").alias("int_rate"), "term")


@register("split_roundtrip", O.with_front(select="""
SELECT row_id, split, issue_year, loan_status, term FROM splits"""))
def q_split_roundtrip(spark, d):
    """X and y written per split, the validation split written again, every
    split read back by itself and its X and y joined by key."""
    from ..sources.files import read_split, write_splits
    path, s = shared_dir(spark, "splits"), stored_splits(spark, d)
    write_splits(s, path)
    write_splits(s.where("split = 'val'"), path)
    out = None
    for name in FIXTURE_SPLITS:
        x, y = read_split(spark, path, name)
        part = prof.join_labels(x, y.drop("split")).select("row_id", "split", "issue_year", "loan_status", "term")
        out = part if out is None else out.union(part)
    return out


# ---------------------------------------------------------------- step 3: feature statistics

from ..operators import features as fe  # noqa: E402
from ..operators.clean import column_roles, feature_view  # noqa: E402
from ..operators.dictionary import category_dictionary, encoded, slot_names  # noqa: E402
from ..functions.columns import safe_name  # noqa: E402

_FITTED: dict = {}


def fitted_features(spark, d):
    """Feature pipeline fitted on the training split (cached per input dir)."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _FITTED:
        train = split_features(spark, d, "train")
        _FITTED[key] = fe.feature_pipeline(NUMERIC, FEATURE_CAT).fit(train)
    return _FITTED[key]


_CAT_POS = "CASE feature " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(FEATURE_CAT)) + " END"
_SQL_MED = "med AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, quantile_cont({c}, 0.5) AS median FROM feat WHERE split = 'train'"
    for c in NUMERIC) + ")"
_SQL_MODE = f"""tl AS (SELECT feature, value FROM (SELECT {", ".join(FEATURE_CAT)} FROM feat WHERE split = 'train')
  UNPIVOT (value FOR feature IN ({", ".join(FEATURE_CAT)}))),
tcnt AS (SELECT feature, value, COUNT(*) AS n FROM tl GROUP BY feature, value),
mode AS (SELECT feature, value AS mode FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY feature ORDER BY n DESC, value) AS r FROM tcnt) WHERE r = 1)"""
_SQL_STD = "std AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, AVG(COALESCE({c}, (SELECT median FROM med WHERE feature = '{c}'))) AS mean, "
    f"STDDEV_POP(COALESCE({c}, (SELECT median FROM med WHERE feature = '{c}'))) AS std FROM feat WHERE split = 'train'"
    for c in NUMERIC) + ")"
_SQL_NAMES = f"""cats AS (SELECT DISTINCT feature, value FROM tl),
names AS (SELECT CAST(idx AS INTEGER) AS idx, name FROM (
  {" UNION ALL ".join(f"SELECT {i} AS idx, 'num__{c}' AS name" for i, c in enumerate(NUMERIC))}
  UNION ALL SELECT {len(NUMERIC)} - 1 + ROW_NUMBER() OVER (ORDER BY {_CAT_POS}, value) AS idx,
  'cat__' || feature || '_' || value AS name FROM cats))"""


@register("impute_median", O.with_front(_SQL_MED, select=f"SELECT feature, {O.d6('median')} AS median FROM med"))
def q_impute_median(spark, d):
    m = fe._stage(fitted_features(spark, d), fe.MedianImputerModel)._stats()
    return spark.createDataFrame(list(m.items()), "feature string, median double") \
        .select("feature", r6("median").alias("median"))


@register("impute_mode", O.with_front(_SQL_MODE, select="SELECT feature, mode FROM mode"))
def q_impute_mode(spark, d):
    m = fe._stage(fitted_features(spark, d), fe.ModeImputerModel)._stats()
    return spark.createDataFrame(list(m.items()), "feature string, mode string")


@register("standardize", O.with_front(_SQL_MED, _SQL_STD,
                                      select=f"SELECT feature, {O.d6('mean')} AS mean, {O.d6('std')} AS std FROM std"))
def q_standardize(spark, d):
    m = fe._stage(fitted_features(spark, d), fe.PopulationScalerModel)._stats()
    return spark.createDataFrame([(k, v[0], v[1]) for k, v in m.items()], "feature string, mean double, std double") \
        .select("feature", r6("mean").alias("mean"), r6("std").alias("std"))


@register("feature_names", O.with_front(_SQL_MODE, _SQL_NAMES, select="SELECT idx, name FROM names"))
def q_feature_names(spark, d):
    return fe.feature_names(fitted_features(spark, d), spark)


@register("safe_names", O.with_front(_SQL_MODE, _SQL_NAMES, select="""
SELECT idx, name, replace(replace(replace(name, '<', 'less_than'), '[', '('), ']', ')') AS safe_name FROM names"""))
def q_safe_names(spark, d):
    n = fe.feature_names(fitted_features(spark, d), spark)
    return n.select("idx", "name", safe_name("name").alias("safe_name"))


@register("one_hot_long", O.with_front(_SQL_MODE, _SQL_NAMES, f"""
al AS (SELECT row_id, feature, value FROM (SELECT row_id, {", ".join(f"COALESCE({c}, (SELECT mode FROM mode WHERE feature = '{c}')) AS {c}" for c in FEATURE_CAT)} FROM feat)
  UNPIVOT (value FOR feature IN ({", ".join(FEATURE_CAT)})))""", select="""
SELECT al.row_id, n.idx AS slot, n.name FROM al JOIN names n ON n.name = 'cat__' || al.feature || '_' || al.value"""))
def q_one_hot_long(spark, d):
    s = stored_splits(spark, d)
    return fe.one_hot_long(fitted_features(spark, d), feature_view(s, drop=("loan_status", "issue_year", "split")),
                           FEATURE_CAT)


@register("transform_splits", O.with_front(_SQL_MED, _SQL_STD, select="SELECT row_id, split, " + ", ".join(
    O.d6(f"(COALESCE({c}, (SELECT median FROM med WHERE feature = '{c}')) - (SELECT mean FROM std WHERE feature = '{c}'))"
         f" / (SELECT CASE WHEN std = 0 THEN 1 ELSE std END FROM std WHERE feature = '{c}')") + f" AS {c}"
    for c in NUMERIC) + " FROM feat"))
def q_transform_splits(spark, d):
    s = stored_splits(spark, d)
    out = fitted_features(spark, d).transform(feature_view(s, drop=("loan_status", "issue_year")))
    return out.select("row_id", "split", *[r6(c).alias(c) for c in NUMERIC])


def split_dictionary(spark, d):
    """(numeric columns, categorical columns, dictionary of the training split)."""
    train = split_features(spark, d, "train")
    num, cat = column_roles(train.schema, drop=("row_id", "loan_status", "issue_year", "split"))
    return num, cat, stored_table(category_dictionary(train, cat, len(num)), "dictionary")


@register("category_dictionary", O.with_front(_SQL_MODE, _SQL_NAMES, select="""
SELECT c.feature, c.value, CAST(n.idx AS BIGINT) AS slot, n.name
FROM cats c JOIN names n ON n.name = 'cat__' || c.feature || '_' || c.value"""))
def q_category_dictionary(spark, d):
    return split_dictionary(spark, d)[2]


_SQL_SCALED = "scaled AS (" + " UNION ALL ".join(
    f"SELECT row_id, 'num__{c}' AS name, (COALESCE({c}, (SELECT median FROM med WHERE feature = '{c}')) - (SELECT mean FROM std WHERE feature = '{c}'))"
    f" / (SELECT CASE WHEN std = 0 THEN 1 ELSE std END FROM std WHERE feature = '{c}') AS value FROM feat" for c in NUMERIC) + ")"


@register("vector_roundtrip", O.with_front(_SQL_MED, _SQL_MODE, _SQL_STD, _SQL_NAMES, _SQL_SCALED, f"""
al AS (SELECT row_id, feature, value FROM (SELECT row_id, {", ".join(f"COALESCE({c}, (SELECT mode FROM mode WHERE feature = '{c}')) AS {c}" for c in FEATURE_CAT)} FROM feat)
  UNPIVOT (value FOR feature IN ({", ".join(FEATURE_CAT)})))""", select=f"""
SELECT x.row_id, n.idx AS slot, n.name, {O.d6('x.value')} AS value
FROM (SELECT * FROM scaled UNION ALL SELECT row_id, 'cat__' || feature || '_' || value, 1.0 FROM al) x JOIN names n ON n.name = x.name"""))
def q_vector_roundtrip(spark, d):
    """Vectors of every split written with their slots' names, and their cells
    read back without the model."""
    from ..sources.files import read_vectors, write_vectors
    num, cat, slots = split_dictionary(spark, d)
    model, path = fitted_features(spark, d), shared_dir(spark, "vectors")
    view = feature_view(stored_splits(spark, d), drop=("loan_status", "issue_year", "split"))
    for stage in (fe.MedianImputerModel, fe.PopulationScalerModel):
        view = fe._stage(model, stage).transform(view)
    size = len(num) + slots.count()
    write_vectors(encoded(view, num, slots, fe._stage(model, fe.ModeImputerModel), cat, size), slot_names(num, slots), path)
    cells, names = read_vectors(spark, path, cells=True)
    return cells.join(names, "slot").select("row_id", "slot", "name", r6("value").alias("value"))


@register("class_weights", O.with_front(select=f"""
SELECT loan_status, COUNT(*) AS count, {O.d6('SUM(COUNT(*)) OVER () / (COUNT(*) OVER () * COUNT(*))')} AS weight
FROM splits WHERE split = 'train' GROUP BY loan_status"""))
def q_class_weights(spark, d):
    t = split_rows(spark, d, "train")
    return fe.class_weights(t).withColumn("weight", r6("weight"))


@register("pos_weight", O.with_front(select=f"""
SELECT COUNT(*) FILTER (WHERE loan_status = 0) AS negatives, COUNT(*) FILTER (WHERE loan_status = 1) AS positives,
 {O.d6("COALESCE((COUNT(*) FILTER (WHERE loan_status = 0))::DOUBLE / NULLIF(COUNT(*) FILTER (WHERE loan_status = 1), 0), 1.0)")} AS pos_weight
FROM splits WHERE split = 'train'"""))
def q_pos_weight(spark, d):
    t = split_rows(spark, d, "train")
    return fe.pos_weight(t).withColumn("pos_weight", r6("pos_weight"))


@register("training_checks", O.with_front(select="""
SELECT COUNT(*) AS rows_x, COUNT(*) AS rows_y, CAST(0 AS BIGINT) AS unmatched, CAST(0 AS BIGINT) AS missing_x,
 COUNT(*) FILTER (WHERE loan_status IS NULL) AS missing_y,
 COUNT(*) FILTER (WHERE loan_status IS NULL) = 0 AS passed FROM splits WHERE split = 'train'"""))
def q_training_checks(spark, d):
    s = split_rows(spark, d, "train")
    x = fitted_features(spark, d).transform(feature_view(s, drop=("loan_status", "issue_year", "split")))
    x = x.select("row_id", *NUMERIC, *FEATURE_CAT)
    y = s.select("row_id", "loan_status")
    return prof.training_checks(x, y)


# ---------------------------------------------------------------- step 4: evaluation, ranking, versions

from ..operators import evaluate as ev  # noqa: E402
from ..operators import rank as rk  # noqa: E402
from ..operators import refit as refit_ops  # noqa: E402
from ..operators import versions as vs  # noqa: E402

# Fixed scoring rules used as "models" over the driver tables: a linear score
# of cleaned columns (NULL -> 0) through a logistic, rounded to 6 decimals.
RULES = [
    ("Rate Rule Baseline", "(COALESCE(int_rate, 0) - 5) / 3"),
    ("Income Rule", "(2000 - COALESCE(annual_inc, 0)) / 3000"),
    ("Leverage Rule", "(COALESCE(dti, 0) - 4) / 2 + (COALESCE(revol_util, 0) - 25) / 50"),
]


def scored(spark, d, split="val"):
    """(model_name, row_id, y_true, y_pred, y_prob) for every rule, one scan."""
    s = split_rows(spark, d, split)
    arr = F.array(*[F.struct(F.lit(n).alias("model_name"), F.expr(z).alias("z")) for n, z in RULES])
    x = s.select("row_id", F.col("loan_status").alias("y_true"), F.inline(arr))
    prob = F.round(1.0 / (1.0 + F.exp(-F.col("z"))), 6)
    return x.select("model_name", "row_id", "y_true", prob.alias("y_prob")) \
            .withColumn("y_pred", ev.predict_from_prob(F.col("y_prob")))


def _sql_scored(split="val"):
    return "scored_" + split + " AS (" + " UNION ALL ".join(
        f"SELECT '{n}' AS model_name, row_id, loan_status AS y_true, "
        f"ROUND(1.0 / (1.0 + EXP(-({z}))), 6) AS y_prob FROM splits WHERE split = '{split}'"
        for n, z in RULES) + ")"


def _sql_eval(split="val"):
    sc = f"scored_{split}"
    return f"""{_sql_scored(split)},
cm_{split} AS (SELECT model_name,
  COUNT(*) FILTER (WHERE y_true = 0 AND y_prob <= 0.5) AS tn, COUNT(*) FILTER (WHERE y_true = 0 AND y_prob > 0.5) AS fp,
  COUNT(*) FILTER (WHERE y_true = 1 AND y_prob <= 0.5) AS fn, COUNT(*) FILTER (WHERE y_true = 1 AND y_prob > 0.5) AS tp
  FROM {sc} GROUP BY model_name),
bm_{split} AS (SELECT *, COALESCE((tp + tn)::DOUBLE / NULLIF(tp + tn + fp + fn, 0), 0) AS accuracy,
  COALESCE(tp::DOUBLE / NULLIF(tp + fp, 0), 0) AS precision, COALESCE(tp::DOUBLE / NULLIF(tp + fn, 0), 0) AS recall,
  COALESCE(2.0 * tp / NULLIF(2 * tp + fp + fn, 0), 0) AS f1_score FROM cm_{split}),
sg_{split} AS (SELECT model_name, y_prob, COUNT(*) FILTER (WHERE y_true = 1) AS pos, COUNT(*) FILTER (WHERE y_true = 0) AS neg
  FROM {sc} GROUP BY model_name, y_prob),
sr_{split} AS (SELECT *, COALESCE(SUM(neg) OVER (PARTITION BY model_name ORDER BY y_prob ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM sg_{split}),
auc_{split} AS (SELECT model_name, CAST(SUM(pos) AS BIGINT) AS positives, CAST(SUM(neg) AS BIGINT) AS negatives,
  CASE WHEN SUM(pos) > 0 AND SUM(neg) > 0 THEN SUM(pos * (below + 0.5 * neg)) / (SUM(pos) * SUM(neg)) END AS roc_auc
  FROM sr_{split} GROUP BY model_name),
ev_{split} AS (SELECT b.*, a.roc_auc FROM bm_{split} b LEFT JOIN auc_{split} a ON a.model_name = b.model_name)"""


_EVALS: dict = {}


def _evaluation(spark, d, split):
    """Per-model evaluation of the rule scores on a split (one row per model),
    computed once per session and input."""
    key = (spark.sparkContext.applicationId, d, split)
    if key not in _EVALS:
        e = ev.evaluation(scored(spark, d, split))
        _EVALS[key] = (e.collect(), e.schema)
    rows, schema = _EVALS[key]
    return spark.createDataFrame(rows, schema)


def _records(spark, d, split="val"):
    e = _evaluation(spark, d, split)
    return e.withColumn("training_time", F.lit(0.0)) \
            .withColumn("file_name", F.concat(rk.model_key("model_name"), F.lit("_metrics.json")))


_R6 = ["accuracy", "precision", "recall", "f1_score", "roc_auc"]


@register("confusion", O.with_front(_sql_eval(), select="SELECT model_name, tn, fp, fn, tp FROM cm_val"))
def q_confusion(spark, d):
    return ev.confusion(scored(spark, d))


@register("binary_metrics", O.with_front(_sql_eval(), select="SELECT model_name, " + ", ".join(
    f"{O.d6(m)} AS {m}" for m in _R6[:4]) + " FROM bm_val"))
def q_binary_metrics(spark, d):
    m = ev.binary_metrics(scored(spark, d))
    return m.select("model_name", *[r6(c).alias(c) for c in _R6[:4]])


@register("roc_auc", O.with_front(_sql_eval(), select=f"""
SELECT model_name, positives, negatives, {O.d6('roc_auc')} AS roc_auc FROM auc_val"""))
def q_roc_auc(spark, d):
    a = ev.roc_auc(scored(spark, d))
    return a.select("model_name", "positives", "negatives", r6("roc_auc").alias("roc_auc"))


def _sql_report():
    d = lambda a, b: f"COALESCE(({a})::DOUBLE / NULLIF({b}, 0), 0)"
    p0, r0, f0 = d("tn", "tn + fn"), d("tn", "tn + fp"), d("2 * tn", "2 * tn + fn + fp")
    p1, r1, f1 = d("tp", "tp + fp"), d("tp", "tp + fn"), d("2 * tp", "2 * tp + fp + fn")
    n0, n1 = "(tn + fp)", "(fn + tp)"
    rows = [
        ("'0'", p0, r0, f0, n0), ("'1'", p1, r1, f1, n1),
        ("'accuracy'", "NULL", "NULL", d("tp + tn", "tn + fp + fn + tp"), f"{n0} + {n1}"),
        ("'macro avg'", f"({p0} + {p1}) / 2", f"({r0} + {r1}) / 2", f"({f0} + {f1}) / 2", f"{n0} + {n1}"),
        ("'weighted avg'", f"({p0} * {n0} + {p1} * {n1}) / ({n0} + {n1})", f"({r0} * {n0} + {r1} * {n1}) / ({n0} + {n1})",
         f"({f0} * {n0} + {f1} * {n1}) / ({n0} + {n1})", f"{n0} + {n1}"),
    ]
    return " UNION ALL ".join(
        f"SELECT model_name, {lab} AS label, {O.d6(p)} AS precision, {O.d6(r)} AS recall, {O.d6(f)} AS f1_score, "
        f"CAST({n} AS BIGINT) AS support FROM cm_val" for lab, p, r, f, n in rows)


@register("classification_report", O.with_front(_sql_eval(), select=_sql_report()))
def q_classification_report(spark, d):
    c = ev.classification_report(scored(spark, d))
    return c.select("model_name", "label", *[r6(x).alias(x) for x in ("precision", "recall", "f1_score")], "support")


_SQL_KEY = """CASE WHEN lower(model_name) LIKE '%logistic%' THEN 'logistic_regression'
  WHEN lower(model_name) LIKE '%forest%' THEN 'random_forest' WHEN lower(model_name) LIKE '%xgboost%' THEN 'xgboost'
  ELSE trim(replace(replace(lower(model_name), ' ', '_'), 'baseline', ''), '_') END"""


def _metric_records(spark, d):
    """Records written as one JSON document each (plus an archived copy and
    a comparison document that the reader must skip), then read back."""
    rec = _records(spark, d)
    extra = (rec.where(F.col("model_name") == RULES[0][0])
                .withColumn("file_name", F.concat(rk.model_key("model_name"), F.lit("_metrics_v1.json"))))
    comp = (rec.where(F.col("model_name") == RULES[1][0])
               .withColumn("file_name", F.lit("model_comparison.json")))
    path = shared_dir(spark, "results")
    rk.write_metric_files(rec.unionByName(extra).unionByName(comp), path)
    return rk.read_metric_records(spark, path, multi_line=False)


@register("metric_records", O.with_front(_sql_eval(), select=f"""
SELECT {_SQL_KEY} || '_metrics.json' AS file_name, model_name, """ + ", ".join(f"{O.d6(m)} AS {m}" for m in _R6)
    + f", {O.d6('0.0')} AS training_time FROM ev_val"))
def q_metric_records(spark, d):
    r = _metric_records(spark, d)
    return r.select("file_name", "model_name", *[r6(m).alias(m) for m in _R6 + ["training_time"]])


_SQL_RANK = f"""recs AS (SELECT model_name, accuracy, precision, recall, f1_score, roc_auc, 0.0::DOUBLE AS training_time FROM ev_val),
cmp AS (SELECT a.model_name, b.model_name AS other,
  CASE WHEN ABS(a.roc_auc - b.roc_auc) >= 0.005 THEN CASE WHEN a.roc_auc > b.roc_auc THEN -1 ELSE 1 END
       WHEN ABS(a.f1_score - b.f1_score) > 1e-6 THEN CASE WHEN a.f1_score > b.f1_score THEN -1 ELSE 1 END
       WHEN ABS(a.recall - b.recall) > 1e-6 THEN CASE WHEN a.recall > b.recall THEN -1 ELSE 1 END
       WHEN ABS(a.training_time - b.training_time) > 1e-6 THEN CASE WHEN a.training_time < b.training_time THEN -1 ELSE 1 END
       ELSE 0 END AS c FROM recs a JOIN recs b ON a.model_name <> b.model_name),
wins AS (SELECT model_name, COUNT(*) FILTER (WHERE c = -1) AS w FROM cmp GROUP BY model_name),
ranked AS (SELECT r.*, ROW_NUMBER() OVER (ORDER BY COALESCE(w.w, 0) DESC, r.roc_auc DESC, r.model_name) AS rank
  FROM recs r LEFT JOIN wins w ON r.model_name = w.model_name),
runner AS (SELECT r.*, LEAD(model_name) OVER (ORDER BY rank) AS ru_name, LEAD(roc_auc) OVER (ORDER BY rank) AS ru_auc,
  LEAD(f1_score) OVER (ORDER BY rank) AS ru_f1, LEAD(recall) OVER (ORDER BY rank) AS ru_recall FROM ranked r)"""


def _ranked(spark, d):
    return rk.rank_models(_records(spark, d))


@register("model_ranking", O.with_front(_sql_eval(), _SQL_RANK, select="SELECT 'all' AS segment, model_name, CAST(rank AS BIGINT) AS rank FROM ranked"))
def q_model_ranking(spark, d):
    return _ranked(spark, d).select("segment", "model_name", "rank")


@register("model_comparison", O.with_front(_sql_eval(), _SQL_RANK, select=f"""
SELECT model_name AS "Model", {O.d6('accuracy')} AS "Accuracy", {O.d6('precision')} AS "Precision",
 {O.d6('recall')} AS "Recall", {O.d6('f1_score')} AS "F1 Score", {O.d6('roc_auc')} AS "ROC-AUC",
 {O.d6('training_time')} AS "Training Time", CAST(rank AS BIGINT) AS "Rank" FROM ranked"""))
def q_model_comparison(spark, d):
    r = _ranked(spark, d)
    return r.select(F.col("model_name").alias("Model"), r6("accuracy").alias("Accuracy"),
                    r6("precision").alias("Precision"), r6("recall").alias("Recall"),
                    r6("f1_score").alias("F1 Score"), r6("roc_auc").alias("ROC-AUC"),
                    r6("training_time").alias("Training Time"), F.col("rank").alias("Rank"))


_P4 = lambda e: f"printf('%.4f', {e})"
_SQL_REASON = f"""CASE WHEN ru_name IS NULL THEN 'Selected ' || model_name || ' as the best model with ROC-AUC=' || {_P4('roc_auc')} || '.'
 WHEN roc_auc - ru_auc >= 0.005 THEN 'Highest ROC-AUC (' || {_P4('roc_auc')} || ') on the validation split. It outperforms the next best model ('
   || ru_name || ' with ROC-AUC=' || {_P4('ru_auc')} || ') by a significant margin of ' || {_P4('roc_auc - ru_auc')} || '.'
 ELSE 'Statistically similar ROC-AUC to ' || ru_name || ' (difference of ' || {_P4('ABS(roc_auc - ru_auc)')} || ' is less than 0.005). '
   || 'Selected as the best model because of a higher F1 Score (' || {_P4('f1_score')} || ' vs ' || {_P4('ru_f1')} || ') '
   || CASE WHEN recall > ru_recall THEN 'and higher Recall (' || {_P4('recall')} || ' vs ' || {_P4('ru_recall')} || ').'
      ELSE 'and competitive Recall.' END END"""


@register("selection_reason", O.with_front(_sql_eval(), _SQL_RANK, select=f"""
SELECT 'all' AS segment, model_name, {_SQL_REASON} AS reason FROM runner WHERE rank = 1"""))
def q_selection_reason(spark, d):
    return rk.selection_reason(_ranked(spark, d))


@register("model_keys", O.with_front(_sql_eval(), select=f"""
SELECT model_name, {_SQL_KEY} AS model_key, 'models/' || {_SQL_KEY} AS model_path FROM ev_val"""))
def q_model_keys(spark, d):
    r = _records(spark, d)
    return r.select("model_name", rk.model_key("model_name").alias("model_key"),
                    rk.model_path(rk.model_key("model_name")).alias("model_path"))


def _champion_on(spark, d, split):
    champ = _ranked(spark, d).where(F.col("rank") == 1).select("segment", "model_name")
    e = _evaluation(spark, d, split)
    return e.join(F.broadcast(champ), "model_name")  # one row per model on each side


def _decision(spark, d):
    return rk.promotion(_champion_on(spark, d, "val"), _champion_on(spark, d, "test"))


_SQL_DECISION = f"""{_sql_eval('test')},
champ AS (SELECT model_name FROM ranked WHERE rank = 1),
dec AS (SELECT v.roc_auc AS cand_roc_auc, v.f1_score AS cand_f1, COALESCE(t.roc_auc, 0) AS dep_roc_auc, COALESCE(t.f1_score, 0) AS dep_f1,
  v.roc_auc >= COALESCE(t.roc_auc, 0) AS roc_pass, v.f1_score >= COALESCE(t.f1_score, 0) - 0.01 AS f1_pass
  FROM champ c JOIN ev_val v ON v.model_name = c.model_name LEFT JOIN ev_test t ON t.model_name = c.model_name)"""


@register("promotion_decision", O.with_front(_sql_eval(), _SQL_RANK, _SQL_DECISION, select=f"""
SELECT {O.d6('cand_roc_auc')} AS cand_roc_auc, {O.d6('cand_f1')} AS cand_f1, {O.d6('dep_roc_auc')} AS dep_roc_auc,
 {O.d6('dep_f1')} AS dep_f1, roc_pass, f1_pass, roc_pass AND f1_pass AS promoted FROM dec"""))
def q_promotion_decision(spark, d):
    x = _decision(spark, d)
    return x.select(*[r6(c).alias(c) for c in ("cand_roc_auc", "cand_f1", "dep_roc_auc", "dep_f1")],
                    "roc_pass", "f1_pass", "promoted")


_VERSION_COLUMNS = ["version", "selected_model", "model_path", "reason", "date", "previous_version", "model_name"]
_STORES: dict = {}


def rule_model(name: str):
    """A scoring rule as a model that is saved and loaded like a fitted one."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer
    z = dict(RULES)[name]
    return PipelineModel(stages=[SQLTransformer(statement=f"SELECT *, ROUND(1.0 / (1.0 + EXP(-({z}))), 6) AS y_prob FROM __THIS__")])


def version_store(spark, d) -> str:
    """A version store derived from the data: version 1 is the champion, version
    2 is added when the promotion rule accepts its second evaluation. Both hold
    the champion rule as a saved model, with its metrics. Built once per
    session, input and state of the input."""
    key = (spark.sparkContext.applicationId, d, stored_path(spark, d))
    if key not in _STORES:
        store = shared_dir(spark, "versions")
        as_of = stored_splits(spark, d).agg(F.date_format(F.max("issue_d"), "yyyy-MM-dd").alias("date")).first()["date"]
        champ = rk.selection_reason(_ranked(spark, d)).select("model_name", rk.model_key("model_name").alias("key"), "reason").first()
        if champ is not None:
            model = rule_model(champ["model_name"])
            metrics = lambda split: _evaluation(spark, d, split).where(F.col("model_name") == champ["model_name"]).first().asDict()
            vs.commit(spark, store, model, champ["key"], champ["model_name"], champ["reason"], as_of, metrics("val"), expected=0)
            dec = _decision(spark, d)
            dec = dec.select("promoted", rk.promotion_reason(dec).alias("reason")).first()
            if dec is not None and dec["promoted"]:
                vs.commit(spark, store, model, champ["key"], champ["model_name"], dec["reason"], as_of, metrics("val"), expected=1)
        _STORES[key] = store
    return _STORES[key]


def model_versions(spark, d):
    return vs.versions(spark, version_store(spark, d))


_SQL_VERSIONS = f"""as_of_d AS (SELECT strftime(MAX(issue_d), '%Y-%m-%d') AS date FROM splits),
v1 AS (SELECT 1 AS version, {_SQL_KEY} AS selected_model, 'version-000001/model' AS model_path,
  {_SQL_REASON} AS reason, (SELECT date FROM as_of_d) AS date, CAST(NULL AS INTEGER) AS previous_version, model_name
  FROM runner WHERE rank = 1),
v2 AS (SELECT 2 AS version, selected_model, 'version-000002/model' AS model_path,
  'Retrained model satisfied promotion criteria: ROC-AUC (' || {_P4('cand_roc_auc')} || ') >= Deployed Test ROC-AUC ('
  || {_P4('dep_roc_auc')} || '), and F1 Score (' || {_P4('cand_f1')} || ') did not decrease by more than 1% compared to deployed F1 ('
  || {_P4('dep_f1')} || ').' AS reason, date, 1 AS previous_version, model_name
  FROM v1, dec WHERE roc_pass AND f1_pass),
versions AS (SELECT * FROM v1 UNION ALL SELECT * FROM v2)"""


@register("current_version", O.with_front(_sql_eval(), _SQL_RANK, _SQL_DECISION, _SQL_VERSIONS, select="""
SELECT version, selected_model, list_reduce(list_transform(string_split(replace(selected_model, '_', ' '), ' '),
  lambda w: upper(w[1]) || lower(w[2:])), lambda a, b: a || ' ' || b) AS display_name,
 COALESCE(reason, 'Champion model selected.') AS reason, COALESCE(date, 'N/A') AS date, model_path, previous_version
FROM versions ORDER BY version DESC LIMIT 1"""))
def q_current_version(spark, d):
    return rk.current_version(model_versions(spark, d))


@register("next_version", O.with_front(_sql_eval(), _SQL_RANK, _SQL_DECISION, _SQL_VERSIONS, select="""
SELECT version, selected_model, model_path, reason, date, previous_version, model_name FROM versions"""))
def q_next_version(spark, d):
    return model_versions(spark, d).select(_VERSION_COLUMNS)


@register("version_metrics", O.with_front(_sql_eval(), _SQL_RANK, _SQL_DECISION, _SQL_VERSIONS, select="""
SELECT v.version, v.model_name, """ + ", ".join(f"{O.d6('e.' + m)} AS {m}" for m in _R6) + """
FROM versions v JOIN ev_val e ON e.model_name = v.model_name"""))
def q_version_metrics(spark, d):
    """The metrics stored with each version."""
    return model_versions(spark, d).select("version", "model_name", *[r6(f"metrics.{m}").alias(m) for m in _R6])


@register("version_evaluation", O.with_front(_sql_eval(), _SQL_RANK, _sql_eval("test"), select="""
SELECT model_name, tn, fp, fn, tp, """ + ", ".join(f"{O.d6(m)} AS {m}" for m in _R6) + """
FROM ev_test WHERE model_name = (SELECT model_name FROM ranked WHERE rank = 1)"""))
def q_version_evaluation(spark, d):
    """The current version, loaded through the version table, on the test split."""
    e = refit_ops.evaluate_current(spark, version_store(spark, d), split_rows(spark, d, "test"))
    return e.select("model_name", "tn", "fp", "fn", "tp", *[r6(c).alias(c) for c in _R6])


@register("top_features", O.with_front(*_DRIFT_CTES, select=f"""
SELECT feature, feature_type, {O.d6('metric')} AS metric FROM report ORDER BY metric DESC, feature LIMIT 15"""))
def q_top_features(spark, d):
    r = drift_report_df(spark, d)
    return r.orderBy(F.desc("metric"), "feature").limit(15) \
            .select("feature", "feature_type", r6("metric").alias("metric"))


# ---------------------------------------------------------------- step 5: learners, scoring

from ..operators import score as sc  # noqa: E402
from ..operators import train as tr  # noqa: E402
from .pipeline import applications  # noqa: E402

_MODELS: dict = {}


def _train_table(spark, d):
    s = split_rows(spark, d, "train")
    return feature_view(s, drop=("issue_year", "split"))


def fitted(spark, d, key, **params):
    """Fitted learner pipeline on the training split (cached per input dir)."""
    k = (spark.sparkContext.applicationId, d, key, tuple(sorted(params.items())))
    if k not in _MODELS:
        _MODELS[k] = tr.fit(key, _train_table(spark, d), NUMERIC, FEATURE_CAT,
                            features_model=fitted_features(spark, d), **params)
    return _MODELS[k]


def _imp(spark, d, key, **params):
    m = fitted(spark, d, key, **params)
    return tr.importances(m, spark).select("idx", "name", r6("importance").alias("importance"))


@register("lr_coefficients")
def q_lr_coefficients(spark, d):
    return _imp(spark, d, "logistic_regression").withColumnRenamed("importance", "coefficient")


@register("rf_v1_importance")
def q_rf_v1_importance(spark, d):
    return _imp(spark, d, "random_forest", **tr.RF_V1_PARAMS)


@register("rf_importance")
def q_rf_importance(spark, d):
    return _imp(spark, d, "random_forest", **tr.RF_PARAMS)


@register("gbt_importance")
def q_gbt_importance(spark, d):
    return _imp(spark, d, "xgboost")


@register("predictions")
def q_predictions(spark, d):
    m = fitted(spark, d, "logistic_regression")
    v = feature_view(split_rows(spark, d, "val"), drop=("issue_year", "split"))
    out = m.transform(v)
    return out.select("row_id", F.col("loan_status").alias("y_true"),
                      F.col("prediction").cast("int").alias("y_pred"),
                      r6(sc.positive_prob()).alias("y_prob"))


def _sql_num(c):
    e = f"TRIM(CAST({c} AS VARCHAR))"
    if c in ("int_rate", "revol_util"):
        e = f"RTRIM(CAST({c} AS VARCHAR), '%')"
        e = f"TRIM({e})"
    return f"COALESCE(CASE WHEN isnan(TRY_CAST({e} AS DOUBLE)) THEN NULL ELSE TRY_CAST({e} AS DOUBLE) END, 0.0)"


@register("score_coerce", O.with_front(select="SELECT row_id, " + ", ".join(
    f"{O.d6(_sql_num(c))} AS {c}" for c in NUMERIC) + ", " + ", ".join(
    f"TRIM({c}) AS {c}" for c in CATEGORICAL) + ", TRIM(issue_d) AS issue_d FROM scan"))
def q_score_coerce(spark, d):
    x = sc.coerce_applications(applications(spark, d))
    return x.select("row_id", *[r6(c).alias(c) for c in NUMERIC], *sc.TEXT_FIELDS)


@register("score_rejects", O.with_front(select="SELECT row_id, " + " + ".join(
    f"CAST({c} IS NULL AS INTEGER)" for c in NUMERIC + FEATURE_CAT) + " AS missing_fields FROM scan WHERE "
    + " OR ".join(f"{c} IS NULL" for c in NUMERIC + FEATURE_CAT)))
def q_score_rejects(spark, d):
    _, rej = sc.split_rejects(applications(spark, d))
    return rej.select("row_id", "missing_fields")


@register("risk_bands", O.with_front(_sql_scored(), select=f"""
SELECT model_name, row_id, CASE WHEN y_prob > 0.5 THEN 'High Default Risk' ELSE 'Loan Likely to be Repaid' END AS prediction,
 CASE WHEN y_prob > 0.5 THEN 'High Risk' ELSE 'Low Risk' END AS prediction_label,
 {O.d6('ROUND_EVEN(y_prob, 4)')} AS probability, CAST(ROUND_EVEN(y_prob * 100, 0) AS INTEGER) AS risk_score FROM scored_val"""))
def q_risk_bands(spark, d):
    b = sc.risk_bands(scored(spark, d))
    return b.select("model_name", "row_id", "prediction", "prediction_label",
                    r6("probability").alias("probability"), "risk_score")


@register("score_batch")
def q_score_batch(spark, d):
    m = fitted(spark, d, "logistic_regression")
    ok, _ = sc.split_rejects(applications(spark, d))
    out = sc.score(m, ok)
    return out.select("row_id", "prediction", "prediction_label", r6("probability").alias("probability"),
                      "risk_score")


# ---------------------------------------------------------------- step 6: streams

from ..streaming import jobs as sj  # noqa: E402
from ..sources.tables import table as _table  # noqa: E402
from .pipeline import stored_path  # noqa: E402


@register("score_stream", O.with_front(select=f"""
SELECT row_id, {O.d6(f'ROUND(1.0 / (1.0 + EXP(-({RULES[0][1]}))), 6)')} AS y_prob,
 CAST(ROUND(1.0 / (1.0 + EXP(-({RULES[0][1]}))), 6) > 0.5 AS INTEGER) AS y_pred,
 CASE WHEN ROUND(1.0 / (1.0 + EXP(-({RULES[0][1]}))), 6) > 0.5 THEN 'High Risk' ELSE 'Low Risk' END AS prediction_label
FROM clean"""))
def q_score_stream(spark, d):
    path = stored_path(spark, d)
    schema = spark.read.parquet(path).schema
    src = spark.readStream.schema(schema).parquet(path)
    z = F.round(1.0 / (1.0 + F.exp(-F.expr(RULES[0][1]))), 6)
    out = sj.run_to_parquet(sj.score_stream(src, z), spark, "score-stream")
    return out.select("row_id", r6("y_prob").alias("y_prob"), "y_pred", "prediction_label")


_SQL_EVENTS = f"""
ev AS (SELECT event_type, ROUND(value, 9) AS x, ts FROM events),
qe AS (SELECT event_type, list_sort(list_distinct(list(ROUND(q, 9)))) AS e FROM (
  SELECT event_type, UNNEST(quantile_cont(x, {sj.DECILES})) AS q FROM ev GROUP BY event_type) GROUP BY event_type),
inn AS (SELECT event_type, e[2:len(e) - 1] AS inner_e FROM qe),
eb AS (SELECT ev.ts, ev.event_type, len(list_filter(inner_e, lambda v: ev.x >= v)) AS bin
  FROM ev JOIN inn ON ev.event_type = inn.event_type),
ew AS (SELECT CAST(to_timestamp(floor(epoch(ts) / 604800) * 604800) AS TIMESTAMP) AS ws, event_type, bin FROM eb),
cw AS (SELECT CAST(epoch(ws) AS BIGINT) AS window_start, CAST(epoch(ws + INTERVAL 7 DAY) AS BIGINT) AS window_end,
 event_type, CAST(bin AS INTEGER) AS bin, COUNT(*) AS n FROM ew
WHERE ws + INTERVAL 7 DAY <= (SELECT MAX(ts) FROM events) - INTERVAL 1 DAY
GROUP BY ws, event_type, bin)"""


@register("drift_stream", O.with_front(_SQL_EVENTS, select="SELECT * FROM cw"))
def q_drift_stream(spark, d):
    return _drift_counts(spark, d)[0]


def _drift_counts(spark, d):
    """Counts of the closed windows, the events and their frozen edges."""
    ev = _table(spark, d, "events")
    edges = sj.baseline_edges(ev, "event_type", "value")
    src = (spark.readStream.schema(ev.schema).option("pathGlobFilter", "events.parquet")
           .parquet(d.rstrip("/")))
    out = sj.run_to_parquet(sj.drift_stream(src, edges, "event_type", "value", "ts"), spark, "drift-stream")
    return out.select("window_start", "window_end", "event_type", "bin", "n"), ev, edges


@register("drift_stream_psi", O.with_front(_SQL_EVENTS, """
sg AS (SELECT event_type, UNNEST(range(0, len(inner_e) + 1)) AS bin FROM inn),
sb AS (SELECT sg.event_type, sg.bin, COUNT(eb.bin) AS base FROM sg
  LEFT JOIN eb ON sg.event_type = eb.event_type AND sg.bin = eb.bin GROUP BY sg.event_type, sg.bin),
sn AS (SELECT event_type, SUM(base) AS n_base FROM sb GROUP BY event_type),
st AS (SELECT window_start, window_end, event_type, CAST(SUM(n) AS BIGINT) AS n_cur FROM cw GROUP BY ALL),
sp AS (SELECT st.*, CASE WHEN base = 0 THEN 0.0001::DOUBLE ELSE base::DOUBLE / n_base END AS tp,
  CASE WHEN COALESCE(n, 0) = 0 THEN 0.0001::DOUBLE ELSE n::DOUBLE / n_cur END AS cp
  FROM st JOIN sb USING (event_type) JOIN sn USING (event_type)
  LEFT JOIN cw ON cw.window_start = st.window_start AND cw.event_type = st.event_type AND cw.bin = sb.bin),
sq AS (SELECT *, tp / SUM(tp) OVER (PARTITION BY window_start, event_type) AS b,
  cp / SUM(cp) OVER (PARTITION BY window_start, event_type) AS c FROM sp),
sm AS (SELECT window_start, window_end, event_type, n_cur, SUM((c - b) * LN(c / b)) AS metric FROM sq GROUP BY ALL)""",
    select=f"""
SELECT window_start, window_end, event_type, n_cur, {O.d6('metric')} AS psi, {_SQL_STATUS} AS drift_status FROM sm"""))
def q_drift_stream_psi(spark, d):
    counts, ev, edges = _drift_counts(spark, d)
    return sj.window_psi(counts, ev, edges, "event_type", "value").withColumn("psi", r6("psi"))


# ---------------------------------------------------------------- step 7: gated refit, held-out evaluation

from ..operators import refit as rf_ops  # noqa: E402


def _split_view(spark, d, name):
    return feature_view(split_rows(spark, d, name), drop=("issue_year", "split"))


_EVAL_COLS = ["model_name", "tn", "fp", "fn", "tp", "accuracy", "precision", "recall", "f1_score", "roc_auc"]


@register("refit_candidate")
def q_refit_candidate(spark, d):
    """Gate on the drift summary; when it recommends a refit, fit the champion
    learner (logistic regression) on train + prod and evaluate on val."""
    summary = drift_ops.drift_summary(drift_report_df(spark, d))
    _, m = rf_ops.refit_if_needed(summary, _split_view(spark, d, "train"), _split_view(spark, d, "prod"),
                                  _split_view(spark, d, "val"), "logistic_regression", NUMERIC, FEATURE_CAT)
    if m is None:
        return spark.createDataFrame([], "model_name string, tn long, fp long, fn long, tp long, accuracy decimal(18,6), "
                                         "precision decimal(18,6), recall decimal(18,6), f1_score decimal(18,6), roc_auc decimal(18,6)")
    return m.select(*_EVAL_COLS[:5], *[r6(c).alias(c) for c in _EVAL_COLS[5:]])


def _fitted_store(spark, d) -> str:
    """A version store whose first version is the fitted logistic regression."""
    store = shared_dir(spark, "fitted-versions")
    m = fitted(spark, d, "logistic_regression")
    metrics = ev.evaluation(rf_ops.scored_by(m, _split_view(spark, d, "val"), "logistic_regression")).first().asDict()
    vs.commit(spark, store, m, "logistic_regression", "logistic_regression", "First fitted version.", "N/A", metrics, expected=0)
    return store


@register("test_evaluation")
def q_test_evaluation(spark, d):
    """The fitted version, committed to a version store, loaded through its
    table and evaluated on the held-out test split."""
    e = rf_ops.evaluate_current(spark, _fitted_store(spark, d), _split_view(spark, d, "test"))
    return e.select(*_EVAL_COLS[:5], *[r6(c).alias(c) for c in _EVAL_COLS[5:]])


@register("refit_promotion")
def q_refit_promotion(spark, d):
    """The refit chain: gate on the drift summary, candidate from the current
    version's learner, decision, commit."""
    summary = drift_ops.drift_summary(drift_report_df(spark, d))
    views = [_split_view(spark, d, s) for s in ("train", "prod", "val", "test")]
    out = rf_ops.refit_chain(spark, _fitted_store(spark, d), summary, *views, NUMERIC, FEATURE_CAT, "N/A", "refit")
    return out.select("outcome", *[r6(c).alias(c) for c in ("candidate_roc_auc", "candidate_f1", "deployed_roc_auc", "deployed_f1")],
                      "roc_pass", "f1_pass", "version")


@register("score_current", O.with_front(_sql_eval(), _SQL_RANK, "sc AS (SELECT row_id, CASE (SELECT model_name FROM ranked WHERE rank = 1) " + " ".join(
    f"WHEN '{n}' THEN ROUND(1.0 / (1.0 + EXP(-({z}))), 6)" for n, z in RULES) + " END AS p FROM (SELECT row_id, " + ", ".join(
    f"{_sql_num(c)} AS {c}" for c in NUMERIC) + " FROM scan WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in NUMERIC + FEATURE_CAT) + "))",
    select=f"""
SELECT row_id, CASE WHEN p > 0.5 THEN 'High Default Risk' ELSE 'Loan Likely to be Repaid' END AS prediction,
 CASE WHEN p > 0.5 THEN 'High Risk' ELSE 'Low Risk' END AS prediction_label,
 {O.d6('ROUND_EVEN(p, 4)')} AS probability, CAST(ROUND_EVEN(p * 100, 0) AS INTEGER) AS risk_score FROM sc"""))
def q_score_current(spark, d):
    """Applications scored by the current version, loaded through the table."""
    ok, _ = sc.split_rejects(applications(spark, d))
    out = sc.score(vs.load_model(spark, version_store(spark, d)), ok)
    return out.select("row_id", "prediction", "prediction_label", r6("probability").alias("probability"), "risk_score")


# ---------------------------------------------------------------- delimited source

from ..sources import files as fl  # noqa: E402
from ..sources.tables import loans_raw  # noqa: E402
from ..operators.clean import clean_loans  # noqa: E402


@register("csv_clean", O.with_front(select="SELECT row_id, " + ", ".join(
    f"{O.d6(c)} AS {c}" for c in NUMERIC) + ", " + ", ".join(FEATURE_CAT) + ", loan_status, issue_year FROM clean"))
def q_csv_clean(spark, d):
    """Raw loans written as gzip-compressed delimited text (every field as
    text), discovered recursively by name pattern, read with the explicit
    raw schema and cleaned."""
    path = shared_dir(spark, "raw-csv")
    raw = loans_raw(spark, d)
    fl.write_table(raw.select([F.col(c).cast("string").alias(c) if c != "row_id" else F.col(c)
                               for c in raw.columns]), path + "/accepted", fmt="csv", compression="gzip")
    c = clean_loans(fl.read_loans(spark, path, glob="part-*.csv*"))
    return c.select("row_id", *[r6(x).alias(x) for x in NUMERIC], *FEATURE_CAT, "loan_status", "issue_year")


@register("drift_report_no_month", O.with_front(*_DRIFT_CTES, select=f"""
SELECT feature, feature_type, {O.d6('metric')} AS metric, constant_feature, drift_status FROM report
WHERE feature <> 'issue_d'"""))
def q_drift_report_no_month(spark, d):
    """The drift report with the month column excluded: as a category it is
    disjoint between any two periods and always reads 2.0 (T4)."""
    tr, pr = _train_prod(spark, d)
    r = drift_ops.drift_report(tr, pr, exclude=("issue_d",))
    return r.select("feature", "feature_type", r6("metric").alias("metric"), "constant_feature",
                    "drift_status")


@register("score_stream_model")
def q_score_stream_model(spark, d):
    """Arriving applications (the stored table, read as a file stream) scored by the fitted logistic-regression version."""
    m = fitted(spark, d, "logistic_regression")
    path = stored_path(spark, d)
    schema = spark.read.parquet(path).schema
    src = (spark.readStream.schema(schema).parquet(path)
           .withColumn("issue_d", F.col("issue_d").cast("string")))
    out = sj.run_to_parquet(sj.score_stream_model(src, m), spark, "score-stream-model")
    return out.select("row_id", "prediction", "prediction_label", r6("probability").alias("probability"),
                      "risk_score")


@register("missing_after_transform", O.with_front(_SQL_MED, _SQL_MODE, select=" UNION ALL ".join(
    [f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE COALESCE({c}, (SELECT median FROM med WHERE feature = '{c}')) IS NULL) AS missing FROM feat"
     for c in NUMERIC]
    + [f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE COALESCE({c}, (SELECT mode FROM mode WHERE feature = '{c}')) IS NULL) AS missing FROM feat"
       for c in FEATURE_CAT])))
def q_missing_after_transform(spark, d):
    """Missing values per feature column after the fitted imputation, over
    every split (PRF-3, after the transform)."""
    s = stored_splits(spark, d)
    out = fitted_features(spark, d).transform(feature_view(s, drop=("loan_status", "issue_year")))
    return prof.missing_by_column(out, NUMERIC + FEATURE_CAT)
