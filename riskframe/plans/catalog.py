"""Registered queries over the driver tables and their DuckDB oracles.

Every query reads the parquet tables under ``sf_dir`` (through the ``loans``
fixture view or ``events``) and runs one library operator over the whole
table. ``ORACLE`` holds the same computation in DuckDB SQL. Doubles are
rounded to 6 dp on both sides (``rounded`` / ``r6``).
"""

from __future__ import annotations

import re
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import (clean, column_state, correlate, distribution, evaluate, group_curves,
                         profile, stability)
from ..schema import BAD_STATUSES, EMP_LENGTH_YEARS, GOOD_STATUSES, MODEL_FEATURES
from ..sources import fixture
from ..sources.fixture import SPLIT_YEAR, duckdb_with
from ..session import cut_lineage
from ..sources.loans import read_loans_csv, write_loans_csv

# --- fixed values: the fixture's column groups --------------------------------
NUM_COLS = ["loan_amnt", "int_rate", "annual_inc", "revol_util", "open_acc", "pub_rec",
            "mort_acc", "mths_since_last_delinq", "revol_bal", "pct_tl_nvr_dlq", "policy_code"]
CAT_COLS = ["term", "grade", "sub_grade", "emp_length", "home_ownership", "addr_state"]
THRESHOLD = 0.5

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every DOUBLE column (the oracle convention)."""
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


def r6(expr: str) -> str:
    return f"round({expr}, 6)"


# --- frames shared by the queries ---------------------------------------------
# Plans (not data) are memoised per session and folder: a DataFrame is an
# immutable plan, so queries share its construction and analysis; every action
# still scans the parquet tables.
_PLANS: dict = {}


def _memo(kind: str, spark, sf, build):
    key = (kind, id(spark), sf)
    hit = _PLANS.get(key)
    if hit is None or hit.sparkSession is not spark:
        hit = _PLANS[key] = build(spark, sf)
    return hit


def _loans(spark, sf):
    return _memo("loans", spark, sf, fixture.loans)


def _definitive(spark, sf):
    from ..operators.clean import definitive_outcomes, label_loans, parse_dates
    return _memo("definitive", spark, sf,
                 lambda s, d: parse_dates(definitive_outcomes(label_loans(_loans(s, d)))))


def _model_frame(spark, sf):
    return clean.drop_leakage(_definitive(spark, sf))


def _test_scores(spark, sf):
    return fixture.scored(spark, sf).filter(F.col("side") == "test")


Q: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        Q[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# --- sources (S1, S4, S5) ------------------------------------------------------
_LOANS_COLS = ["id", "loan_amnt", "term", "int_rate", "grade", "sub_grade", "emp_length",
               "home_ownership", "addr_state", "annual_inc", "issue_d", "earliest_cr_line",
               "loan_status", "revol_util", "open_acc", "pub_rec", "mort_acc",
               "mths_since_last_delinq", "revol_bal", "pct_tl_nvr_dlq", "policy_code"]
_LOANS_DOUBLES = {"loan_amnt", "int_rate", "annual_inc", "revol_util", "mths_since_last_delinq",
                  "revol_bal", "pct_tl_nvr_dlq", "policy_code"}
_LOANS_TYPES = {c: ("double" if c in _LOANS_DOUBLES else
                    "bigint" if c in ("id", "open_acc", "pub_rec", "mort_acc") else "string")
                for c in _LOANS_COLS}


def _sel(cols, doubles) -> str:
    return ", ".join(r6(c) + f" AS {c}" if c in doubles else c for c in cols)


@register("scan_loans", duckdb_with("loans") + f"SELECT {_sel(_LOANS_COLS, _LOANS_DOUBLES)} FROM loans")
def q_scan_loans(spark, sf):
    return _loans(spark, sf)


_HOSTILE_SQL = ("'He said \"' || coalesce(grade, '') || '\", then' || chr(10) || ' left; ' || "
                "CASE WHEN id % 5 = 0 THEN '\"' ELSE ',' END")


@register("scan_csv", duckdb_with("loans") + f"""SELECT CAST(id AS VARCHAR) AS id, {r6('loan_amnt')} AS loan_amnt,
  term, {r6('int_rate')} AS int_rate, {_HOSTILE_SQL} AS "desc", home_ownership, CAST(NULL AS DOUBLE) AS dti FROM loans""")
def q_scan_csv(spark, sf):
    """The CSV reader over all loans: quotes, line breaks, another column order, a lacking column."""
    loans = _loans(spark, sf)
    text = F.concat(F.lit('He said "'), F.coalesce("grade", F.lit("")), F.lit('", then\n left; '),
                    F.when(F.col("id") % 5 == 0, F.lit('"')).otherwise(F.lit(",")))
    cols = ["desc", "int_rate", "id", "home_ownership", "term", "loan_amnt"]
    path = _shared(spark, "loans-csv")
    write_loans_csv(loans.withColumn("desc", text).select(*cols), path)
    return read_loans_csv(spark, path).select("id", "loan_amnt", "term", "int_rate", "desc",
                                              "home_ownership", "dti")


def _shared(spark, name: str) -> str:
    import uuid
    from ..session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("preview_head", duckdb_with("loans")
          + f"SELECT {_sel(_LOANS_COLS, _LOANS_DOUBLES)} FROM loans ORDER BY id LIMIT 5")
def q_preview_head(spark, sf):
    return clean.preview_head(_loans(spark, sf), 5, "id")


@register("table_info", duckdb_with("loans") + _union([
    f"SELECT '{c}' AS column, '{_LOANS_TYPES[c]}' AS dtype, count({c}) AS non_null, "
    f"count(*) AS n_rows FROM loans" for c in _LOANS_COLS]))
def q_table_info(spark, sf):
    return clean.table_info(_loans(spark, sf))


# --- projections / filters (P1-P3, P7, F2, F3) --------------------------------
@register("parse_dates", duckdb_with("loans") + """
SELECT id,
  CASE WHEN regexp_matches(issue_d, '^[A-Za-z]{3}-[0-9]{4}$') THEN CAST(try_strptime(issue_d, '%b-%Y') AS DATE) END AS issue_d,
  CASE WHEN regexp_matches(earliest_cr_line, '^[A-Za-z]{3}-[0-9]{4}$') THEN CAST(try_strptime(earliest_cr_line, '%b-%Y') AS DATE) END AS earliest_cr_line,
  CAST(year(CASE WHEN regexp_matches(issue_d, '^[A-Za-z]{3}-[0-9]{4}$') THEN CAST(try_strptime(issue_d, '%b-%Y') AS DATE) END) AS INTEGER) AS issue_year,
  CAST(date_trunc('month', CASE WHEN regexp_matches(issue_d, '^[A-Za-z]{3}-[0-9]{4}$') THEN CAST(try_strptime(issue_d, '%b-%Y') AS DATE) END) AS DATE) AS issue_month_yr
FROM loans""")
def q_parse_dates(spark, sf):
    return clean.parse_dates(_loans(spark, sf)).select(
        "id", "issue_d", "earliest_cr_line", "issue_year", "issue_month_yr")


@register("date_parse_report", duckdb_with("loans") + _union([
    f"SELECT '{c}' AS column, count({c}) AS n_text, "
    f"count(CASE WHEN regexp_matches({c}, '^[A-Za-z]{{3}}-[0-9]{{4}}$') THEN try_strptime({c}, '%b-%Y') END) AS n_parsed, "
    f"count({c}) - count(CASE WHEN regexp_matches({c}, '^[A-Za-z]{{3}}-[0-9]{{4}}$') THEN try_strptime({c}, '%b-%Y') END) AS n_failed "
    f"FROM loans" for c in ["issue_d", "earliest_cr_line"]]))
def q_date_parse_report(spark, sf):
    return clean.date_parse_counts(_loans(spark, sf))


@register("issue_period", duckdb_with("definitive") + """
SELECT issue_year, issue_month_yr, count(*) AS n_loans FROM definitive
WHERE issue_year IS NOT NULL GROUP BY issue_year, issue_month_yr""")
def q_issue_period(spark, sf):
    d = _definitive(spark, sf)
    return (d.filter(F.col("issue_year").isNotNull()).groupBy("issue_year", "issue_month_yr")
            .agg(F.count(F.lit(1)).alias("n_loans")).orderBy("issue_month_yr"))


@register("label_loans", duckdb_with("labeled") + "SELECT id, loan_status, is_bad FROM labeled")
def q_label_loans(spark, sf):
    return clean.label_loans(_loans(spark, sf)).select("id", "loan_status", "is_bad")


@register("definitive_outcomes", duckdb_with("definitive")
          + "SELECT id, loan_status, is_bad FROM definitive")
def q_definitive_outcomes(spark, sf):
    return clean.definitive_outcomes(clean.label_loans(_loans(spark, sf))).select(
        "id", "loan_status", "is_bad")


_STATUSES = ", ".join("'" + s + "'" for s in BAD_STATUSES + GOOD_STATUSES)


@register("outcome_counts", duckdb_with("loans") + f"""
SELECT count(*) AS rows_before, CAST(count_if(loan_status IN ({_STATUSES})) AS BIGINT) AS rows_after,
  CAST(count(*) - count_if(loan_status IN ({_STATUSES})) AS BIGINT) AS rows_removed FROM loans""")
def q_outcome_counts(spark, sf):
    return clean.outcome_counts(_loans(spark, sf))


_FEATURES_PRESENT = [c for c in MODEL_FEATURES if c in _LOANS_COLS]


@register("select_present", duckdb_with("loans")
          + f"SELECT {_sel(_FEATURES_PRESENT, _LOANS_DOUBLES)} FROM loans")
def q_select_present(spark, sf):
    return clean.select_present(_loans(spark, sf), MODEL_FEATURES)


@register("predict_threshold", duckdb_with("scored") + f"""
SELECT id, {r6('score')} AS score, CAST(score >= {THRESHOLD}::DOUBLE AS INTEGER) AS prediction FROM scored""")
def q_predict_threshold(spark, sf):
    from ..functions.scalar import at_threshold
    s = fixture.scored(spark, sf)
    return s.select("id", "score", at_threshold("score", THRESHOLD).alias("prediction"))


# --- missingness and drops (A3, A4, P4, P5, P6) --------------------------------
_DEF_COLS = _LOANS_COLS + ["is_bad", "issue_year", "issue_month_yr"]
_DEF_TYPES = dict(_LOANS_TYPES, issue_d="date", earliest_cr_line="date", is_bad="int",
                  issue_year="int", issue_month_yr="date")
_DROPPED_MISSING = ["mths_since_last_delinq"]           # > 40 % missing on the fixture
_DROPPED_LEAKAGE = ["id", "policy_code"] + _DROPPED_MISSING
_MODEL_COLS = [c for c in _DEF_COLS if c not in _DROPPED_LEAKAGE]
_NON_FEATURES = ["is_bad", "loan_status", "issue_year", "issue_month_yr"]


def _kind(t: str) -> str:
    return "numeric" if t in ("double", "bigint", "int") else "categorical" if t == "string" else "other"


def _missing_sql(frame: str, cols: list[str]) -> str:
    return _union([f"SELECT '{c}' AS column, CAST(count_if({c} IS NULL) AS BIGINT) AS missing_count, "
                   f"count(*) AS n_rows FROM {frame}" for c in cols])


@register("missing_table", duckdb_with("definitive") + f"""
SELECT column, missing_count, {r6('missing_count * 100::DOUBLE / n_rows')} AS missing_pct
FROM ({_missing_sql('definitive', _DEF_COLS)}) WHERE missing_count > 0""")
def q_missing_table(spark, sf):
    return clean.missing_table(_definitive(spark, sf))


@register("drop_high_missing", duckdb_with("definitive") + "SELECT " + _sel(
    [c for c in _DEF_COLS if c not in _DROPPED_MISSING], _LOANS_DOUBLES) + " FROM definitive")
def q_drop_high_missing(spark, sf):
    return clean.drop_high_missing(_definitive(spark, sf))


@register("drop_leakage", duckdb_with("definitive") + "SELECT " + _sel(_MODEL_COLS, _LOANS_DOUBLES)
          + " FROM definitive")
def q_drop_leakage(spark, sf):
    return _model_frame(spark, sf)


@register("column_types", duckdb_with("definitive") + _union([
    f"SELECT '{c}' AS column, '{_DEF_TYPES[c]}' AS dtype, '{_kind(_DEF_TYPES[c])}' AS kind "
    f"FROM (SELECT 1 FROM definitive LIMIT 1)" for c in _MODEL_COLS]))
def q_column_types(spark, sf):
    return clean.column_types_frame(_model_frame(spark, sf))


_PLAN_COLS = [c for c in _MODEL_COLS if c not in _NON_FEATURES]


def _strategy(t: str) -> str:
    k = _kind(t)
    return "'median'" if k == "numeric" else "'most_frequent'" if k == "categorical" else "NULL"


@register("impute_plan", duckdb_with("definitive") + "SELECT * FROM (" + _union([
    f"SELECT '{c}' AS column, '{_kind(_DEF_TYPES[c])}' AS kind, "
    f"CAST(count_if({c} IS NULL) AS BIGINT) AS missing_count, "
    f"{r6(f'count_if({c} IS NULL) * 100::DOUBLE / count(*)')} AS missing_pct, "
    f"{_strategy(_DEF_TYPES[c])} AS strategy FROM definitive" for c in _PLAN_COLS])
    + ") WHERE missing_count > 0")
def q_impute_plan(spark, sf):
    return clean.impute_plan(_model_frame(spark, sf), exclude=_NON_FEATURES)


# --- profile (A1, A2, A5-A10, A17-A25, P8) --------------------------------------
@register("status_distribution", duckdb_with("loans") + f"""
SELECT loan_status, count(*) AS count,
  {r6('count(*) * 100::DOUBLE / sum(count(*)) OVER ()')} AS pct
FROM loans WHERE loan_status IS NOT NULL GROUP BY loan_status""")
def q_status_distribution(spark, sf):
    return profile.status_distribution(_loans(spark, sf))


@register("class_balance", duckdb_with("definitive") + f"""
SELECT is_bad, count(*) AS count, {r6('count(*) * 100::DOUBLE / sum(count(*)) OVER ()')} AS pct
FROM definitive GROUP BY is_bad""")
def q_class_balance(spark, sf):
    return profile.class_balance(_definitive(spark, sf))


def _d(c: str) -> str:
    return f"CAST({c} AS DOUBLE)"


def _corr_sql(x: str, y: str, frame: str = "definitive") -> str:
    xs, ys = _d(x), _d(y)
    pair = f"FILTER (WHERE {x} IS NOT NULL AND {y} IS NOT NULL)"
    return (f"CASE WHEN count(*) {pair} < 2 OR min({xs}) {pair} = max({xs}) {pair} "
            f"OR min({ys}) {pair} = max({ys}) {pair} THEN NULL ELSE corr({xs}, {ys}) END")


def _moments_sql(cols) -> str:
    return _union([
        f"SELECT '{c}' AS column, "
        f"CASE WHEN count({c}) < 3 THEN NULL WHEN min({c}) = max({c}) THEN 0::DOUBLE ELSE skewness({_d(c)}) END AS skewness, "
        f"CASE WHEN count({c}) < 4 THEN NULL WHEN min({c}) = max({c}) THEN 0::DOUBLE ELSE kurtosis({_d(c)}) END AS kurtosis "
        f"FROM definitive" for c in cols])


@register("moments", duckdb_with("definitive")
          + f"SELECT column, {r6('skewness')} AS skewness, {r6('kurtosis')} AS kurtosis FROM ({_moments_sql(NUM_COLS)})")
def q_moments(spark, sf):
    return profile.moments(_definitive(spark, sf), NUM_COLS)


@register("high_skew", duckdb_with("definitive")
          + f"SELECT column, {r6('skewness')} AS skewness, {r6('kurtosis')} AS kurtosis FROM ({_moments_sql(NUM_COLS)}) "
            "WHERE abs(skewness) > 1::DOUBLE")
def q_high_skew(spark, sf):
    return profile.high_skew(_definitive(spark, sf), NUM_COLS)


@register("skew_partition", duckdb_with("definitive") + "SELECT column, " + r6("skew") + """ AS skew,
  CASE WHEN abs(skew) > 0.75::DOUBLE THEN 'skewed' ELSE 'standard' END AS "group" FROM (""" + _union([
    f"SELECT '{c}' AS column, CASE WHEN count({c}) < 3 OR min({c}) = max({c}) THEN NULL "
    f"ELSE skewness({_d(c)}) * (count({c}) - 2) / sqrt(count({c}) * (count({c}) - 1)::DOUBLE) END AS skew "
    f"FROM definitive" for c in NUM_COLS]) + ")")
def q_skew_partition(spark, sf):
    return profile.skew_partition(_definitive(spark, sf), NUM_COLS)


@register("describe_numeric", duckdb_with("definitive") + _union([
    f"SELECT '{c}' AS column, count({c}) AS count, {r6(f'avg({_d(c)})')} AS mean, "
    f"{r6(f'stddev_samp({_d(c)})')} AS std, {r6(f'min({_d(c)})')} AS min, "
    f"{r6(f'quantile_cont({_d(c)}, 0.25)')} AS p25, {r6(f'quantile_cont({_d(c)}, 0.5)')} AS p50, "
    f"{r6(f'quantile_cont({_d(c)}, 0.75)')} AS p75, {r6(f'max({_d(c)})')} AS max FROM definitive"
    for c in NUM_COLS]))
def q_describe_numeric(spark, sf):
    return profile.describe_numeric(_definitive(spark, sf), NUM_COLS)


@register("near_zero_variance", duckdb_with("definitive") + "SELECT column, " + r6("std") + " AS std FROM ("
          + _union([f"SELECT '{c}' AS column, stddev_samp({_d(c)}) AS std FROM definitive" for c in NUM_COLS])
          + ") WHERE std < 1e-6")
def q_near_zero_variance(spark, sf):
    return profile.near_zero_variance(_definitive(spark, sf), NUM_COLS)


_PROFILE_COLS = [*NUM_COLS, "is_bad"]


@register("profile_increments", duckdb_with("definitive") + ", " + f"""
m AS ({_moments_sql(_PROFILE_COLS)}), p AS (""" + _union([
    f"SELECT '{c}' AS column, count(*) AS n_rows, count(*) - count({c}) AS n_missing, avg({_d(c)}) AS mean, "
    f"stddev_samp({_d(c)}) AS std, min({_d(c)}) AS mn, max({_d(c)}) AS mx, {_corr_sql(c, 'is_bad')} AS corr "
    f"FROM definitive" for c in _PROFILE_COLS]) + f""")
SELECT p.column, n_rows, n_missing, {r6('mean')} AS mean, {r6('std')} AS std, {r6('mn')} AS mn, {r6('mx')} AS mx,
  {r6('skewness')} AS skewness, {r6('kurtosis')} AS kurtosis, {r6('corr')} AS corr FROM p JOIN m ON p.column = m.column""")
def q_profile_increments(spark, sf):
    """The loans come year by year: each year's state is saved, and the profile of all columns is
    read from the merged states alone (A3, A5, A6, A9, A11)."""
    path = _shared(spark, "profile")
    d = _definitive(spark, sf)
    years = column_state.column_state(d, _PROFILE_COLS, "is_bad", ("issue_year",))
    column_state.save_state(years, path)
    state = cut_lineage(column_state.load_state(spark, path))
    parts = [column_state.moments_of(state), column_state.corr_target_of(state)]
    out = state.select("column", "n_rows", "n_missing", "mean", "mn", "mx").join(
        column_state.basics_of(state).select("column", "std"), "column")
    for p in parts:
        out = out.join(p, "column")
    return out


def _long_sql(frame: str, cols: list[str], extra: str = "", cast: str = "VARCHAR") -> str:
    return _union([f"SELECT {extra}'{c}' AS column, CAST({c} AS {cast}) AS value FROM {frame} "
                   f"WHERE {c} IS NOT NULL" for c in cols])


@register("category_counts", duckdb_with("definitive")
          + f"SELECT column, value, count(*) AS count FROM ({_long_sql('definitive', CAT_COLS)}) GROUP BY column, value")
def q_category_counts(spark, sf):
    return profile.category_counts(_definitive(spark, sf), CAT_COLS)


@register("bad_rate", duckdb_with("definitive")
          + f"SELECT column, value, {r6('avg(CAST(y AS DOUBLE))')} AS bad_rate, count(*) AS n_loans "
            f"FROM ({_long_sql('definitive', CAT_COLS, 'is_bad AS y, ')}) GROUP BY column, value")
def q_bad_rate(spark, sf):
    return profile.bad_rate(_definitive(spark, sf), CAT_COLS)


@register("yearly_stats", duckdb_with("definitive") + f"""
SELECT issue_year, count(id) AS loan_count, {r6('avg(loan_amnt)')} AS avg_loan_amnt,
  {r6('avg(int_rate)')} AS avg_int_rate, {r6('avg(CAST(is_bad AS DOUBLE))')} AS bad_rate
FROM definitive WHERE issue_year IS NOT NULL GROUP BY issue_year""")
def q_yearly_stats(spark, sf):
    return profile.yearly_stats(_definitive(spark, sf))


@register("year_range", duckdb_with("definitive")
          + "SELECT min(issue_year) AS min_year, max(issue_year) AS max_year FROM definitive")
def q_year_range(spark, sf):
    return profile.year_range(_definitive(spark, sf))


@register("time_split", duckdb_with("definitive") + f"""
SELECT id, CASE WHEN issue_year < {SPLIT_YEAR} THEN 'train' ELSE 'test' END AS side, is_bad
FROM definitive WHERE issue_year IS NOT NULL""")
def q_time_split(spark, sf):
    return profile.time_split(_definitive(spark, sf), SPLIT_YEAR).select("id", "side", "is_bad")


@register("split_report", duckdb_with("definitive") + f"""
SELECT CASE WHEN issue_year < {SPLIT_YEAR} THEN 'train' ELSE 'test' END AS side, count(*) AS n_rows,
  {r6('avg(CAST(is_bad AS DOUBLE)) * 100::DOUBLE')} AS bad_rate_pct, {len(_PLAN_COLS)} AS n_features
FROM definitive WHERE issue_year IS NOT NULL GROUP BY 1""")
def q_split_report(spark, sf):
    return profile.split_report(_model_frame(spark, sf), SPLIT_YEAR)


@register("class_weight", duckdb_with("definitive") + f"""
SELECT n_neg, n_pos, {r6('CASE WHEN n_pos > 0 THEN n_neg / n_pos ELSE 1::DOUBLE END')} AS scale_pos_weight
FROM (SELECT CAST(count_if(is_bad = 0) AS BIGINT) AS n_neg, CAST(count_if(is_bad = 1) AS BIGINT) AS n_pos
      FROM definitive WHERE issue_year < {SPLIT_YEAR})""")
def q_class_weight(spark, sf):
    train, _ = profile.split_frames(_definitive(spark, sf), SPLIT_YEAR)
    return profile.class_weight(train)


@register("ordinal_levels", duckdb_with("definitive") + f"""
SELECT column, level, CAST(row_number() OVER (PARTITION BY column ORDER BY
    CASE WHEN column = 'sub_grade' THEN substr(level, 1, 1) ELSE level END,
    CASE WHEN column = 'sub_grade' THEN TRY_CAST(substr(level, 2) AS INTEGER) END, level) - 1 AS INTEGER) AS rank
FROM (SELECT DISTINCT column, value AS level FROM ({_long_sql('definitive', ['grade', 'sub_grade'])})
      ) WHERE TRUE""")
def q_ordinal_levels(spark, sf):
    return profile.ordinal_levels(_definitive(spark, sf))


@register("impute_median", duckdb_with("definitive") + _union([
    f"SELECT '{c}' AS column, {r6(f'quantile_cont({_d(c)}, 0.5)')} AS median FROM definitive"
    for c in NUM_COLS]))
def q_impute_median(spark, sf):
    return profile.impute_median(_definitive(spark, sf), NUM_COLS)


@register("impute_mode", duckdb_with("definitive") + f"""
SELECT column, min(value) AS mode, max(cnt) AS count FROM (
  SELECT column, value, cnt, max(cnt) OVER (PARTITION BY column) AS top FROM (
    SELECT column, value, count(*) AS cnt FROM ({_long_sql('definitive', CAT_COLS)}) GROUP BY column, value))
WHERE cnt = top GROUP BY column""")
def q_impute_mode(spark, sf):
    return profile.impute_mode(_definitive(spark, sf), CAT_COLS)


# --- correlations (A11-A13) ----------------------------------------------------
_CORR_TARGET_COLS = NUM_COLS + ["is_bad"]


@register("corr_target", duckdb_with("definitive") + _union([
    f"SELECT '{c}' AS column, {r6(_corr_sql(c, 'is_bad'))} AS corr FROM definitive"
    for c in _CORR_TARGET_COLS]))
def q_corr_target(spark, sf):
    return correlate.corr_target(_definitive(spark, sf), _CORR_TARGET_COLS, "is_bad")


_CORR_PAIRS_SQL = _union([
    f"SELECT '{x}' AS col_x, '{y}' AS col_y, {_corr_sql(x, y)} AS corr FROM definitive"
    for x in NUM_COLS for y in NUM_COLS])


@register("corr_matrix", duckdb_with("definitive")
          + f"SELECT col_x, col_y, {r6('corr')} AS corr FROM ({_CORR_PAIRS_SQL})")
def q_corr_matrix(spark, sf):
    return correlate.corr_matrix(_definitive(spark, sf), NUM_COLS)


@register("high_corr_pairs", duckdb_with("definitive")
          + f"SELECT col_x, col_y, {r6('corr')} AS corr FROM ({_CORR_PAIRS_SQL}) "
            "WHERE col_x < col_y AND abs(corr) > 0.85::DOUBLE")
def q_high_corr_pairs(spark, sf):
    return correlate.high_corr_pairs(_definitive(spark, sf), NUM_COLS)


# --- distributions (A14-A16) ---------------------------------------------------
@register("histogram", duckdb_with("definitive") + f"""
, long AS ({_long_sql('definitive', NUM_COLS, cast='DOUBLE')}),
e AS (SELECT column, count(*) AS n, min(value) AS mn, max(value) AS mx,
        quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.75) AS q75 FROM long GROUP BY column),
e2 AS (SELECT column, n, mn, mx, mx - mn AS ptp,
        2::DOUBLE * (q75 - q25) * pow(CAST(n AS DOUBLE), -1::DOUBLE / 3::DOUBLE) AS fd,
        (mx - mn) / sqrt(CAST(n AS DOUBLE)) / 2::DOUBLE AS half_sqrt,
        (mx - mn) / (log2(CAST(n AS DOUBLE)) + 1::DOUBLE) AS sturges FROM e),
e3 AS (SELECT column, CASE WHEN ptp = 0 THEN mn - 0.5::DOUBLE ELSE mn END AS lo,
        CASE WHEN ptp = 0 THEN mx + 0.5::DOUBLE ELSE mx END AS hi,
        CASE WHEN ptp = 0 THEN 1 ELSE greatest(1, CAST(ceil(ptp / least(greatest(fd, half_sqrt), sturges))
          AS INTEGER)) END AS n_bins FROM e2),
c AS (SELECT l.column, least(CAST(floor((l.value - e3.lo) * e3.n_bins / (e3.hi - e3.lo)) AS INTEGER),
        e3.n_bins - 1) AS bin, count(*) AS cnt FROM long l JOIN e3 ON l.column = e3.column GROUP BY 1, 2),
g AS (SELECT column, lo, hi, n_bins, CAST(unnest(range(0, n_bins)) AS INTEGER) AS bin FROM e3)
SELECT g.column, g.bin, {r6('g.lo + g.bin * ((g.hi - g.lo) / g.n_bins)')} AS lower,
  {r6('g.lo + (g.bin + 1) * ((g.hi - g.lo) / g.n_bins)')} AS upper,
  CAST(coalesce(c.cnt, 0) AS BIGINT) AS count
FROM g LEFT JOIN c ON g.column = c.column AND g.bin = c.bin""")
def q_histogram(spark, sf):
    return distribution.histogram(_definitive(spark, sf), NUM_COLS)


@register("kde_curve", duckdb_with("definitive") + f"""
, long AS ({_long_sql('definitive', NUM_COLS, cast='DOUBLE')}),
st AS (SELECT column, count(*) AS n, min(value) AS mn, max(value) AS mx,
         stddev_samp(value) * pow(CAST(count(*) AS DOUBLE), -0.2::DOUBLE) AS h,
         (max(value) - min(value)) / 199::DOUBLE AS step FROM long GROUP BY column),
v AS (SELECT column, value, count(*) AS cnt FROM long GROUP BY column, value),
k AS (SELECT v.column, p.point, sum(v.cnt * exp(-0.5::DOUBLE * pow((s.mn + p.point * s.step - v.value) / s.h, 2))) AS k
      FROM v JOIN st s ON v.column = s.column AND s.h > 0, range(0, 200) p(point) GROUP BY ALL)
SELECT k.column, CAST(point AS INTEGER) AS point, {r6('mn + point * step')} AS x,
  {r6('k / (n * h) * 0.3989422804014327::DOUBLE')} AS density,
  {r6('k / (n * h) * 0.3989422804014327::DOUBLE * step * 1000::DOUBLE')} AS permille
FROM k JOIN st ON k.column = st.column""")
def q_kde_curve(spark, sf):
    """Density, and the share of the mass on each grid step in 1/1000 (which no rounding hides)."""
    from pyspark.sql import Window
    k = distribution.kde_curve(_definitive(spark, sf), NUM_COLS)
    w = Window.partitionBy("column")   # 200 rows each
    step = (F.max("x").over(w) - F.min("x").over(w)) / F.lit(199.0)
    return k.withColumn("permille", F.col("density") * step * F.lit(1000.0))


@register("box_stats", duckdb_with("definitive") + f"""
, long AS ({_union([f"SELECT is_bad, '{c}' AS column, CAST({c} AS DOUBLE) AS value FROM definitive WHERE {c} IS NOT NULL AND is_bad IS NOT NULL" for c in NUM_COLS])}),
q AS (SELECT is_bad, column, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
        quantile_cont(value, 0.75) AS q3 FROM long GROUP BY is_bad, column),
f AS (SELECT *, q1 - 1.5::DOUBLE * (q3 - q1) AS lo_f, q3 + 1.5::DOUBLE * (q3 - q1) AS hi_f FROM q)
SELECT l.is_bad, l.column, {r6('f.q1')} AS q1, {r6('f.median')} AS median, {r6('f.q3')} AS q3,
  {r6('min(l.value) FILTER (WHERE l.value >= f.lo_f AND l.value <= f.hi_f)')} AS whisker_lo,
  {r6('max(l.value) FILTER (WHERE l.value >= f.lo_f AND l.value <= f.hi_f)')} AS whisker_hi,
  count(*) FILTER (WHERE NOT (l.value >= f.lo_f AND l.value <= f.hi_f)) AS n_outliers, count(*) AS n
FROM long l JOIN f ON l.is_bad = f.is_bad AND l.column = f.column
GROUP BY l.is_bad, l.column, f.q1, f.median, f.q3""")
def q_box_stats(spark, sf):
    return distribution.box_stats(_definitive(spark, sf), NUM_COLS, "is_bad")


# --- evaluation on the test side of the score fixture (W1-W4, E1-E7) ----------
_CURVE = duckdb_with("scored") + """
, t AS (SELECT * FROM scored WHERE side = 'test'),
c AS (SELECT score, CAST(count_if(label = 1) AS BIGINT) AS pos, CAST(count_if(label = 0) AS BIGINT) AS neg
      FROM t WHERE score IS NOT NULL AND label IS NOT NULL GROUP BY score),
cum AS (SELECT score, pos, neg, CAST(sum(pos) OVER (ORDER BY score DESC) AS DOUBLE) AS tp,
          CAST(sum(neg) OVER (ORDER BY score DESC) AS DOUBLE) AS fp FROM c),
tot AS (SELECT CAST(sum(pos) AS DOUBLE) AS P, CAST(sum(neg) AS DOUBLE) AS N FROM c)
"""


@register("pr_curve", _CURVE + f"""
SELECT {r6('score')} AS threshold, {r6('tp / (tp + fp)')} AS precision, {r6('tp / P')} AS recall FROM cum, tot
UNION ALL SELECT NULL, 1::DOUBLE, 0::DOUBLE""")
def q_pr_curve(spark, sf):
    return evaluate.pr_curve(_test_scores(spark, sf))


@register("roc_curve", _CURVE + f"""
SELECT {r6('score')} AS threshold, {r6('fp / N')} AS fpr, {r6('tp / P')} AS tpr FROM cum, tot
UNION ALL SELECT NULL, 0::DOUBLE, 0::DOUBLE""")
def q_roc_curve(spark, sf):
    return evaluate.roc_curve(_test_scores(spark, sf))


@register("f1_by_threshold", _CURVE + f"""
SELECT {r6('score')} AS threshold, {r6('tp / (tp + fp)')} AS precision, {r6('tp / P')} AS recall,
  {r6('coalesce(2::DOUBLE * (tp / (tp + fp)) * (tp / P) / ((tp / (tp + fp)) + (tp / P)), 0::DOUBLE)')} AS f1
FROM cum, tot""")
def q_f1_by_threshold(spark, sf):
    return evaluate.f1_by_threshold(_test_scores(spark, sf))


# ROC by the rank sum (average ranks of ties), PR by the trapezoid over the curve's points.
_METRICS = _CURVE + """
, ranked AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2::DOUBLE AS r
             FROM t WHERE score IS NOT NULL AND label IS NOT NULL),
points AS (SELECT tp / P AS recall, tp / (tp + fp) AS prec, score FROM cum, tot),
steps AS (SELECT (recall - lag(recall, 1, 0::DOUBLE) OVER (ORDER BY score DESC))
            * (prec + lag(prec, 1, 1::DOUBLE) OVER (ORDER BY score DESC)) / 2::DOUBLE AS area FROM points),
m AS (SELECT pr_auc, (rank_sum - P * (P + 1) / 2::DOUBLE) / (P * N) AS roc_auc FROM tot,
        (SELECT sum(r) AS rank_sum FROM ranked WHERE label = 1), (SELECT sum(area) AS pr_auc FROM steps)),
b AS (SELECT 2::DOUBLE * tp / (tp + fp + P) AS best_f1, score AS best_threshold
      FROM cum, tot ORDER BY best_f1 DESC, score ASC LIMIT 1)
"""


@register("curve_metrics", _METRICS + f"""
SELECT {r6('roc_auc')} AS roc_auc, {r6('pr_auc')} AS pr_auc, {r6('best_f1')} AS best_f1,
  {r6('best_threshold')} AS best_threshold, CAST(P AS BIGINT) AS n_pos, CAST(N AS BIGINT) AS n_neg
FROM m, b, tot""")
def q_curve_metrics(spark, sf):
    return evaluate.curve_metrics(_test_scores(spark, sf))


@register("roc_auc", _METRICS + f"SELECT {r6('roc_auc')} AS roc_auc FROM m")
def q_roc_auc(spark, sf):
    return evaluate.roc_auc(_test_scores(spark, sf))


@register("pr_auc", _METRICS + f"SELECT {r6('pr_auc')} AS pr_auc FROM m")
def q_pr_auc(spark, sf):
    return evaluate.pr_auc(_test_scores(spark, sf))


# Prices as scores of finished orders in five groups: thousands of distinct values, several
# buckets. The SQL takes areas and neighbours by lag and lead over the group's points.
_BY = """WITH g AS (SELECT o_orderkey % 5 AS part, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label,
        CAST(o_totalprice AS DOUBLE) AS score FROM orders),
c AS (SELECT part, score, CAST(count_if(label = 1) AS DOUBLE) AS pos, CAST(count_if(label = 0) AS DOUBLE) AS neg
      FROM g GROUP BY part, score),
cum AS (SELECT *, sum(pos) OVER u AS tp, sum(neg) OVER u AS fp, sum(pos) OVER (PARTITION BY part) AS P,
          sum(neg) OVER (PARTITION BY part) AS N FROM c WINDOW u AS (PARTITION BY part ORDER BY score DESC)),
pts AS (SELECT *, lag(tp / (tp + fp), 1, 1::DOUBLE) OVER u AS prec0, lag(tp, 1, 0::DOUBLE) OVER u AS tp0,
          lag(fp, 1, 0::DOUBLE) OVER u AS fp0, lead(tp) OVER u AS tp1, lead(fp) OVER u AS fp1
        FROM cum WINDOW u AS (PARTITION BY part ORDER BY score DESC))
"""
_PRICE_CUT = 150_000.0
_PRICE_ROWS = 700  # rows per bucket: every group has several buckets


def _price_scores(spark, sf):
    from ..sources.tables import read_table
    return read_table(spark, sf, "orders").select(
        (F.col("o_orderkey") % 5).alias("part"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("label"),
        F.col("o_totalprice").cast("double").alias("score"))


@register("metrics_by_group", _BY + f"""
SELECT part, CAST(any_value(P) AS BIGINT) AS n_pos, CAST(any_value(N) AS BIGINT) AS n_neg,
  {r6('sum((fp - fp0) * (tp + tp0)) / 2 / any_value(P) / any_value(N)')} AS roc_auc,
  {r6('sum((tp - tp0) * (tp / (tp + fp) + prec0)) / 2 / any_value(P)')} AS pr_auc,
  {r6('max(2 * tp / (tp + fp + P))')} AS best_f1,
  {r6('min(score) FILTER (WHERE 2 * tp / (tp + fp + P) = best)')} AS best_threshold,
  CAST(any_value(N) - sum(neg) FILTER (WHERE score >= {_PRICE_CUT}) AS BIGINT) AS tn,
  CAST(sum(neg) FILTER (WHERE score >= {_PRICE_CUT}) AS BIGINT) AS fp,
  CAST(any_value(P) - sum(pos) FILTER (WHERE score >= {_PRICE_CUT}) AS BIGINT) AS fn,
  CAST(sum(pos) FILTER (WHERE score >= {_PRICE_CUT}) AS BIGINT) AS tp
FROM (SELECT *, max(2 * tp / (tp + fp + P)) OVER (PARTITION BY part) AS best FROM pts) GROUP BY part""")
def q_metrics_by_group(spark, sf):
    """Areas, best F1 and confusion cells of five groups in one job (E1, E2, E5, E6, E10), over a
    continuous score and several buckets."""
    return group_curves.metrics_by(_price_scores(spark, sf), ["part"], _PRICE_CUT,
                                   rows_per_bucket=_PRICE_ROWS).drop("precision", "recall", "f1")


@register("roc_by_group", _BY + f"""
SELECT part, {r6('score')} AS threshold, {r6('fp / N')} AS fpr, {r6('tp / P')} AS tpr FROM pts
WHERE tp1 IS NULL OR (tp - tp0) * (fp1 - fp) <> (tp1 - tp) * (fp - fp0)
UNION ALL SELECT DISTINCT part, NULL, 0::DOUBLE, 0::DOUBLE FROM pts""")
def q_roc_by_group(spark, sf):
    """Thinned ROC curves of five groups (W2): corners only."""
    return group_curves.roc_by(_price_scores(spark, sf), ["part"], rows_per_bucket=_PRICE_ROWS)


@register("pr_by_group", _BY + f"""
SELECT part, {r6('score')} AS threshold, {r6('tp / (tp + fp)')} AS precision, {r6('tp / P')} AS recall FROM pts
WHERE tp1 IS NULL OR tp <> tp0 OR tp1 <> tp
UNION ALL SELECT DISTINCT part, NULL, 1::DOUBLE, 0::DOUBLE FROM pts""")
def q_pr_by_group(spark, sf):
    """Thinned precision-recall curves of five groups."""
    return group_curves.pr_by(_price_scores(spark, sf), ["part"], rows_per_bucket=_PRICE_ROWS)


def _confusion_sql(threshold_expr: str) -> str:
    return f"""
, cm AS (SELECT CAST(count_if(label = 0 AND NOT (score >= {threshold_expr})) AS BIGINT) AS tn,
                CAST(count_if(label = 0 AND score >= {threshold_expr}) AS BIGINT) AS fp,
                CAST(count_if(label = 1 AND NOT (score >= {threshold_expr})) AS BIGINT) AS fn,
                CAST(count_if(label = 1 AND score >= {threshold_expr}) AS BIGINT) AS tp
         FROM scored WHERE side = 'test' AND label IS NOT NULL)
"""


_T = f"{THRESHOLD}::DOUBLE"


_CELLS = """
SELECT 0 AS actual, 0 AS predicted, tn AS count FROM cm UNION ALL SELECT 0, 1, fp FROM cm
UNION ALL SELECT 1, 0, fn FROM cm UNION ALL SELECT 1, 1, tp FROM cm"""


@register("confusion_matrix", duckdb_with("scored") + _confusion_sql(_T) + _CELLS)
def q_confusion_matrix(spark, sf):
    return evaluate.confusion_matrix(_test_scores(spark, sf), THRESHOLD)


def _f1_bad_select(src: str) -> str:
    return (f"SELECT {r6('coalesce(tp / CAST(tp + fp AS DOUBLE), 0::DOUBLE)')} AS precision, "
            f"{r6('coalesce(tp / CAST(tp + fn AS DOUBLE), 0::DOUBLE)')} AS recall, "
            f"{r6('coalesce(2::DOUBLE * tp / (2::DOUBLE * tp + fp + fn), 0::DOUBLE)')} AS f1 FROM {src}")


@register("f1_bad", duckdb_with("scored") + _confusion_sql(_T) + _f1_bad_select("cm"))
def q_f1_bad(spark, sf):
    return evaluate.f1_bad(_test_scores(spark, sf), THRESHOLD)


_REPORT_TAIL = """
, k AS (SELECT *, coalesce(tn / CAST(tn + fn AS DOUBLE), 0::DOUBLE) AS p0, coalesce(tn / CAST(tn + fp AS DOUBLE), 0::DOUBLE) AS r0,
          coalesce(tp / CAST(tp + fp AS DOUBLE), 0::DOUBLE) AS p1, coalesce(tp / CAST(tp + fn AS DOUBLE), 0::DOUBLE) AS r1,
          tn + fp AS s0, fn + tp AS s1, tn + fp + fn + tp AS n FROM cm),
k2 AS (SELECT *, coalesce(2::DOUBLE * p0 * r0 / (p0 + r0), 0::DOUBLE) AS f0,
          coalesce(2::DOUBLE * p1 * r1 / (p1 + r1), 0::DOUBLE) AS f1 FROM k)
"""


_REPORT_ROWS = f"""
SELECT 'Good Loan (0)' AS row, {r6('p0')} AS precision, {r6('r0')} AS recall, {r6('f0')} AS f1, s0 AS support FROM k2
UNION ALL SELECT 'Bad Loan (1)', {r6('p1')}, {r6('r1')}, {r6('f1')}, s1 FROM k2
UNION ALL SELECT 'accuracy', NULL, NULL, {r6('(tn + tp) / CAST(n AS DOUBLE)')}, n FROM k2
UNION ALL SELECT 'macro avg', {r6('(p0 + p1) / 2')}, {r6('(r0 + r1) / 2')}, {r6('(f0 + f1) / 2')}, n FROM k2
UNION ALL SELECT 'weighted avg', {r6('(p0 * s0 + p1 * s1) / n')}, {r6('(r0 * s0 + r1 * s1) / n')},
  {r6('(f0 * s0 + f1 * s1) / n')}, n FROM k2"""


@register("classification_report", duckdb_with("scored") + _confusion_sql(_T) + _REPORT_TAIL + _REPORT_ROWS)
def q_classification_report(spark, sf):
    return evaluate.classification_report(_test_scores(spark, sf), THRESHOLD)


@register("optimal_threshold", _METRICS + _confusion_sql("(SELECT best_threshold FROM b)") + f"""
SELECT {r6('b.best_threshold')} AS threshold, {r6('b.best_f1')} AS best_f1, x.* FROM b, ({_f1_bad_select('cm')}) x""")
def q_optimal_threshold(spark, sf):
    return evaluate.optimal_threshold(_test_scores(spark, sf))


def _report_sql(threshold: str, curve: str = duckdb_with("scored")) -> str:
    return curve + _confusion_sql(threshold) + _REPORT_TAIL + _REPORT_ROWS


@register("optimal_report", _report_sql("(SELECT best_threshold FROM b)", _METRICS))
def q_optimal_report(spark, sf):
    return evaluate.optimal_report(_test_scores(spark, sf))


@register("optimal_confusion", _METRICS + _confusion_sql("(SELECT best_threshold FROM b)") + _CELLS)
def q_optimal_confusion(spark, sf):
    return evaluate.optimal_confusion(_test_scores(spark, sf))


@register("no_skill", duckdb_with("scored")
          + f"SELECT {r6('avg(CAST(label AS DOUBLE))')} AS no_skill FROM scored WHERE side = 'test'")
def q_no_skill(spark, sf):
    return profile.no_skill(_test_scores(spark, sf), "label")


# --- stability (E8, E9, F14) --------------------------------------------------
def _psi_sql(source: str) -> str:
    probs = ", ".join(f"{i / 10}" for i in range(11))
    return f"""
, src AS ({source}),
st AS (SELECT min(value) FILTER (WHERE side = 'expected') AS e_min, max(value) FILTER (WHERE side = 'expected') AS e_max,
         min(value) FILTER (WHERE side = 'actual') AS a_min, max(value) FILTER (WHERE side = 'actual') AS a_max FROM src),
q AS (SELECT quantile_cont(value, [{probs}]) AS qs FROM src WHERE side = 'expected'),
e AS (SELECT list_sort(list_distinct(list_concat([least(e_min, coalesce(a_min, e_min))], qs,
         [greatest(e_max, coalesce(a_max, e_max))]))) AS edges FROM st, q WHERE e_min < e_max),
e2 AS (SELECT list_concat(edges[1:len(edges) - 1], [edges[len(edges)] + 1e-8]) AS edges FROM e WHERE len(edges) >= 3),
b AS (SELECT s.side, CASE WHEN s.value IS NULL OR s.value < e2.edges[1] OR s.value >= e2.edges[len(e2.edges)] THEN NULL
         ELSE CAST(len(list_filter(e2.edges, lambda x: x <= s.value)) - 1 AS INTEGER) END AS bin, e2.edges
      FROM src s, e2 WHERE s.side IN ('expected', 'actual')),
tots AS (SELECT count(*) FILTER (WHERE side = 'expected') AS e_tot, count(*) FILTER (WHERE side = 'actual') AS a_tot FROM b),
cnt AS (SELECT bin, any_value(edges) AS edges, count(*) FILTER (WHERE side = 'expected') AS e_cnt,
          count(*) FILTER (WHERE side = 'actual') AS a_cnt FROM b GROUP BY bin),
sh AS (SELECT bin, CASE WHEN bin IS NULL THEN NULL ELSE edges[bin + 1] END AS lower,
          CASE WHEN bin IS NULL THEN NULL ELSE edges[bin + 2] END AS upper,
          CASE WHEN e_cnt = 0 THEN 1e-5 ELSE e_cnt / CAST(e_tot AS DOUBLE) END AS expected_share,
          CASE WHEN a_cnt = 0 THEN 1e-5 ELSE a_cnt / CAST(a_tot AS DOUBLE) END AS actual_share FROM cnt, tots),
comp AS (SELECT *, (actual_share - expected_share) * ln(actual_share / expected_share) AS component FROM sh)
"""


_PSI_BAND = ("CASE WHEN psi IS NULL OR isnan(psi) THEN NULL WHEN psi < 0.1 THEN 'stable' "
             "WHEN psi < 0.25 THEN 'minor shift' ELSE 'major shift' END")


def _psi_total(source_views: str, source: str) -> str:
    return (duckdb_with(source_views) + _psi_sql(source)
            + f", tot AS (SELECT sum(component) AS psi, CAST(count(bin) AS INTEGER) AS n_bins FROM comp)\n"
              f"SELECT {r6('psi')} AS psi, n_bins, {_PSI_BAND} AS band FROM tot")


@register("psi", _psi_total("drift", "SELECT side, value FROM drift"))
def q_psi(spark, sf):
    return stability.psi(fixture.drift(spark, sf))


@register("psi_bins", duckdb_with("drift") + _psi_sql("SELECT side, value FROM drift") + f"""
SELECT bin, {r6('lower')} AS lower, {r6('upper')} AS upper, {r6('expected_share')} AS expected_share,
  {r6('actual_share')} AS actual_share, {r6('component')} AS component FROM comp""")
def q_psi_bins(spark, sf):
    return stability.psi_table(fixture.drift(spark, sf))


@register("score_psi", _psi_total("scored", """SELECT CASE WHEN side = 'train' THEN 'expected'
  WHEN side = 'test' THEN 'actual' END AS side, CAST(score AS DOUBLE) AS value FROM scored"""))
def q_score_psi(spark, sf):
    return stability.score_psi(fixture.scored(spark, sf))


@register("psi_baseline", "\nUNION ALL\n".join(
    "SELECT * FROM (" + _psi_total("drift", "SELECT side, value FROM drift" if part is None else
                 f"SELECT side, value FROM drift WHERE side = 'expected' OR (side = 'actual' AND {where})")
    .replace("SELECT round(psi", f"SELECT '{name}' AS batch, round(psi") + ")"
    for name, part, where in (("whole", None, ""), ("low", 1, "value < 100"), ("rest", 2, "(value >= 100 OR value IS NULL)"))))
def q_psi_baseline(spark, sf):
    """Batches against a saved baseline (E8, E9, F14): two batches, and both by adding their
    counts. The rows of the expected side are read by the fit alone."""
    drift, path = fixture.drift(spark, sf), _shared(spark, "psi-baseline")
    stability.PsiBaseline.fit(drift.filter("side = 'expected'")).save(spark, path)
    kept = stability.PsiBaseline.load(spark, path)
    batch = F.when(F.col("value") < 100, "low").otherwise("rest").alias("batch")
    counts = cut_lineage(kept.counts_of(
        drift.filter("side = 'actual'").select("value", batch), "value", ("batch",)))
    return kept.compare(counts.unionByName(counts.withColumn("batch", F.lit("whole"))),
                        ("batch",)).drop("n_rows")


# --- feature steps (X1-X8, X10, X11) -------------------------------------------
from ..features import transformers as X  # noqa: E402

_EMP_SQL = ("CASE emp_length " + " ".join(f"WHEN '{k}' THEN {float(v)}::DOUBLE"
                                          for k, v in EMP_LENGTH_YEARS.items()) + " END")


@register("emp_length", duckdb_with("loans") + f"SELECT id, {_EMP_SQL} AS emp_length_num FROM loans")
def q_emp_length(spark, sf):
    return X.EmpLengthConverter().transform(_loans(spark, sf)).select("id", "emp_length_num")


def _month(c: str) -> str:
    return (f"CASE WHEN regexp_matches({c}, '^[A-Za-z]{{3}}-[0-9]{{4}}$') "
            f"THEN CAST(try_strptime({c}, '%b-%Y') AS DATE) END")


@register("credit_history", duckdb_with("loans") + f"""
SELECT id, {r6(f"greatest(coalesce(datediff('day', {_month('earliest_cr_line')}, {_month('issue_d')}) / 365.25::DOUBLE, 0::DOUBLE), 0::DOUBLE)")} AS credit_hist_years
FROM loans""")
def q_credit_history(spark, sf):
    return X.CreditHistoryCalculator().transform(_loans(spark, sf)).select("id", "credit_hist_years")


@register("count_binarize", duckdb_with("loans") + """
SELECT id, coalesce(CAST(pub_rec > 0 AS INTEGER), 0) AS pub_rec_binary,
  coalesce(CAST(mort_acc > 0 AS INTEGER), 0) AS mort_acc_binary, 0 AS pub_rec_bankruptcies_binary
FROM loans""")
def q_count_binarize(spark, sf):
    return X.CountBinarizer().transform(_loans(spark, sf)).select(
        "id", "pub_rec_binary", "mort_acc_binary", "pub_rec_bankruptcies_binary")


_FE_STAGES = lambda: [X.EmpLengthConverter(), X.CreditHistoryCalculator(), X.CountBinarizer()]
# Written by hand from the steps: the employment text, both dates and the counts go, what is
# made of them follows at the end.
_FE_NAMES = ["loan_amnt", "term", "int_rate", "grade", "sub_grade", "home_ownership", "addr_state",
             "annual_inc", "revol_util", "open_acc", "revol_bal", "pct_tl_nvr_dlq",
             "emp_length_num", "credit_hist_years", "pub_rec_binary", "mort_acc_binary",
             "pub_rec_bankruptcies_binary"]


@register("feature_names", duckdb_with("definitive") + _union([
    f"SELECT {i} AS position, '{n}' AS name FROM (SELECT 1 FROM definitive LIMIT 1)"
    for i, n in enumerate(_FE_NAMES)]))
def q_feature_names(spark, sf):
    from ..plans.feature_plan import feature_columns
    cols = feature_columns(_model_frame(spark, sf))
    names = X.feature_names_out(_FE_STAGES(), cols)
    return spark.createDataFrame(list(enumerate(names)), "position int, name string")


YJ_LAMBDA = 0.5


def _yj_sql(x: str, lam: str) -> str:
    """Yeo-Johnson of SQL expression ``x`` at ``lam``, all branches."""
    return (f"CASE WHEN {x} >= 0 THEN CASE WHEN {lam} = 0 THEN ln(1::DOUBLE + {x}) "
            f"ELSE (pow({x} + 1::DOUBLE, {lam}) - 1::DOUBLE) / {lam} END "
            f"WHEN {lam} = 2 THEN -ln(1::DOUBLE - {x}) "
            f"ELSE -(pow(1::DOUBLE - {x}, 2::DOUBLE - {lam}) - 1::DOUBLE) / (2::DOUBLE - {lam}) END")


@register("yeo_johnson", duckdb_with("definitive") + "SELECT id, " + ", ".join(
    r6(_yj_sql(_d(c), f"{YJ_LAMBDA}::DOUBLE")) + f" AS {c}" for c in NUM_COLS) + " FROM definitive")
def q_yeo_johnson(spark, sf):
    from ..functions.scalar import yeo_johnson
    return _definitive(spark, sf).select("id", *[
        yeo_johnson(F.col(c).cast("double"), YJ_LAMBDA).alias(c) for c in NUM_COLS])


_SCALE_COLS = NUM_COLS


@register("standard_scale", duckdb_with("definitive") + """
, med AS (SELECT """ + ", ".join(f"quantile_cont({_d(c)}, 0.5) AS m_{c}" for c in _SCALE_COLS) + """ FROM definitive),
filled AS (SELECT id, """ + ", ".join(f"coalesce({_d(c)}, m_{c}) AS {c}" for c in _SCALE_COLS) + """ FROM definitive, med),
mom AS (SELECT """ + ", ".join(f"avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}" for c in _SCALE_COLS) + """ FROM filled)
SELECT id, """ + ", ".join(r6(f"({c} - mu_{c}) / CASE WHEN sd_{c} = 0 THEN 1::DOUBLE ELSE sd_{c} END") + f" AS {c}"
                            for c in _SCALE_COLS) + " FROM filled, mom")
def q_standard_scale(spark, sf):
    d = _definitive(spark, sf)
    return X.StandardNumericScaler(inputCols=_SCALE_COLS).fit(d).transform(d).select("id", *_SCALE_COLS)


def _train_sql(view: str = "definitive") -> str:
    return f"train AS (SELECT * FROM {view} WHERE issue_year < {SPLIT_YEAR})"


def _mode_sql(c: str) -> str:
    """The most frequent training value, the smallest on ties."""
    return (f"(SELECT {c} FROM train WHERE {c} IS NOT NULL GROUP BY {c} "
            f"ORDER BY count(*) DESC, {c} LIMIT 1)")


def _code_sql(c: str) -> str:
    key = (f"substr({c}, 1, 1), TRY_CAST(substr({c}, 2) AS INTEGER), {c}" if c == "sub_grade" else c)
    return (f"lv_{c} AS (SELECT {c} AS level, CAST(row_number() OVER (ORDER BY {key}) - 1 AS DOUBLE) AS code "
            f"FROM (SELECT DISTINCT {c} FROM train WHERE {c} IS NOT NULL))")


@register("ordinal_encode", duckdb_with("definitive") + f"""
, {_train_sql()}, {_code_sql('grade')}, {_code_sql('sub_grade')},
filled AS (SELECT id, coalesce(grade, {_mode_sql('grade')}) AS grade,
             coalesce(sub_grade, {_mode_sql('sub_grade')}) AS sub_grade FROM definitive)
SELECT d.id, coalesce(g.code, -1::DOUBLE) AS grade, coalesce(s.code, -1::DOUBLE) AS sub_grade
FROM filled d LEFT JOIN lv_grade g ON g.level = d.grade LEFT JOIN lv_sub_grade s ON s.level = d.sub_grade""")
def q_ordinal_encode(spark, sf):
    """Levels of the training years over all years: nulls take the mode, unseen levels -1."""
    d, train = _definitive(spark, sf), _train_test(spark, sf)[0]
    return X.OrdinalLevelEncoder(inputCols=["grade", "sub_grade"]).fit(train).transform(d).select(
        "id", "grade", "sub_grade")


_OHE = ["term", "home_ownership", "addr_state"]


@register("one_hot", duckdb_with("definitive") + f", {_train_sql()}, " + ", ".join(
    f"lv_{c} AS (SELECT {c} AS level, row_number() OVER (ORDER BY {c}) - 1 AS code, count(*) OVER () AS width "
    f"FROM (SELECT DISTINCT {c} FROM train WHERE {c} IS NOT NULL))" for c in _OHE) + "\n" + _union([
        f"SELECT d.id, '{c}' AS column, CAST((SELECT max(width) FROM lv_{c}) AS INTEGER) AS width, "
        f"CAST(coalesce(l.code, -1) AS INTEGER) AS hot, CASE WHEN l.code IS NULL THEN 0::DOUBLE ELSE 1::DOUBLE END AS total "
        f"FROM definitive d LEFT JOIN lv_{c} l ON l.level = coalesce(d.{c}, {_mode_sql(c)})" for c in _OHE]))
def q_one_hot(spark, sf):
    """Width, place of the one and sum of every indicator vector; levels from the training years."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    d, train = _definitive(spark, sf), _train_test(spark, sf)[0]
    out = Pipeline(stages=X.one_hot_stages(_OHE)).fit(train).transform(d)
    long = out.select("id", F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), vector_to_array(f"{c}__ohe").alias("v")) for c in _OHE])))
    return long.select("id", "column", F.size("v").alias("width"),
                       (F.array_position("v", F.lit(1.0)) - 1).cast("int").alias("hot"),
                       F.aggregate("v", F.lit(0.0), lambda a, x: a + x).alias("total"))


def _train_test(spark, sf):
    return profile.split_frames(_model_frame(spark, sf), SPLIT_YEAR)


# Post-engineering columns of the fixture's X in order, with their kind:
# orig = original numeric (routed by skew), new = engineered numeric (standard).
_PLAN_CANDIDATES = ([(c, "orig") for c in ["loan_amnt", "int_rate", "annual_inc", "revol_util", "open_acc",
                                           "revol_bal", "pct_tl_nvr_dlq"]]
                    + [(c, "new") for c in ["emp_length_num", "credit_hist_years", "pub_rec_binary",
                                            "mort_acc_binary"]]
                    + [("grade", "ord"), ("sub_grade", "ord")]
                    + [(c, "ohe") for c in ["term", "home_ownership", "addr_state"]])
_SKEW_SQL = _union([
    f"SELECT '{c}' AS column, CASE WHEN count({c}) < 3 OR min({c}) = max({c}) THEN NULL "
    f"ELSE skewness({_d(c)}) * (count({c}) - 2) / sqrt(count({c}) * (count({c}) - 1)::DOUBLE) END AS skew "
    f"FROM definitive WHERE issue_year < {SPLIT_YEAR}" for c, k in _PLAN_CANDIDATES if k == "orig"])


@register("feature_plan", duckdb_with("definitive") + f"""
, cand AS (SELECT * FROM (VALUES {", ".join(f"('{c}', {i}, '{k}')" for i, (c, k) in enumerate(_PLAN_CANDIDATES))}) t(column, base, kind)),
sk AS ({_SKEW_SQL}),
g AS (SELECT c.column, c.base, CASE c.kind WHEN 'orig' THEN CASE WHEN abs(s.skew) > 0.75::DOUBLE THEN 'skewed' ELSE 'standard' END
        WHEN 'new' THEN 'standard' WHEN 'ord' THEN 'ordinal' ELSE 'one_hot' END AS grp
      FROM cand c LEFT JOIN sk s ON s.column = c.column)
SELECT column, grp AS "group", CAST(row_number() OVER (ORDER BY CASE grp WHEN 'skewed' THEN 0 WHEN 'standard' THEN 1
  WHEN 'ordinal' THEN 2 ELSE 3 END, base) - 1 AS INTEGER) AS position FROM g""")
def q_feature_plan(spark, sf):
    from ..plans.feature_plan import fit_plan, plan_frame
    train, _ = _train_test(spark, sf)
    return plan_frame(spark, fit_plan(train))


_SKEW_DEMO = ["annual_inc", "revol_util", "loan_amnt", "revol_bal", "pct_tl_nvr_dlq"]
# Points that reach past the first bracket of the search.
_YJ_GRID = [-0.5, 0.0, 0.5, 1.0, 1.5, 2.0, 3.0, 4.0, 6.0, 10.0, 23.0]
_YJ_FILLED = ("long AS (" + _union([
    f"SELECT '{c}' AS column, coalesce({_d(c)}, (SELECT quantile_cont({_d(c)}, 0.5) FROM definitive)) AS x "
    f"FROM definitive" for c in _SKEW_DEMO]) + ")")


def _yj_loglik_sql(grid: str) -> str:
    """(column, lam, ll): log-likelihood per row at every λ of a relation ``g(lam)``."""
    return (f"SELECT column, lam, -ln(var_pop({_yj_sql('x', 'lam')})) / 2::DOUBLE "
            f"+ (lam - 1::DOUBLE) * avg(sign(x) * ln(1::DOUBLE + abs(x))) AS ll "
            f"FROM long, {grid} GROUP BY column, lam")


def _filled_demo(d: DataFrame) -> DataFrame:
    med = X.fit_medians(d, _SKEW_DEMO)
    return d.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m))
                          for c, m in zip(_SKEW_DEMO, med)})


@register("yeo_johnson_likelihood", duckdb_with("definitive") + f", {_YJ_FILLED}\n" + "SELECT column, "
          "lam AS lambda, CASE WHEN isfinite(ll) THEN round(ll, 4) END AS log_likelihood FROM ("
          + _yj_loglik_sql(f"(SELECT unnest({_YJ_GRID}::DOUBLE[]) AS lam) g") + ")")
def q_yeo_johnson_likelihood(spark, sf):
    """Log-likelihood per row of every skewed column on a fixed grid of λ."""
    got = X.yeo_johnson_likelihoods(_filled_demo(_definitive(spark, sf)), {c: _YJ_GRID for c in _SKEW_DEMO})
    each = got.select("column", "n", "t", F.posexplode("v").alias("i", "var"))
    lam = F.element_at(F.array(*[F.lit(v) for v in _YJ_GRID]), F.col("i") + 1)
    ll = -F.log("var") / 2 + (lam - 1) * F.col("t") / F.col("n")
    # A map that overflows has no likelihood.
    return each.select("column", lam.alias("lambda"), F.when(
        F.abs(ll) < F.lit(float("inf")), F.round(ll, 4)).alias("log_likelihood"))


# The best λ by grids in SQL: steps of 0.25 on [-2, 24], then 0.01 and 0.001 around the best.
# A spread below the rounding of the mapped values has no likelihood.
def _yj_refine(source: str, name: str, step: float, below: float, above: float) -> str:
    y = _yj_sql('x', 'lam')
    return (f"{name} AS (SELECT column, arg_max(lam, ll) AS lam FROM (SELECT column, lam, "
            f"CASE WHEN var_pop({y}) > pow(1e-10 * avg({y}), 2) THEN -ln(var_pop({y})) / 2::DOUBLE "
            f"+ (lam - 1::DOUBLE) * avg(sign(x) * ln(1::DOUBLE + abs(x))) END AS ll "
            f"FROM (SELECT l.column, l.x, s.lam + r.i * {step}::DOUBLE AS lam "
            f"FROM long l JOIN {source} s ON l.column = s.column, "
            f"range({round(-below / step)}, {round(above / step) + 1}) r(i)) GROUP BY column, lam) "
            f"GROUP BY column)")


_YJ_BEST = ("origin AS (SELECT DISTINCT column, 0::DOUBLE AS lam FROM long), "
            + _yj_refine("origin", "b1", 0.25, 2, 24) + ", " + _yj_refine("b1", "b2", 0.01, 0.25, 0.25)
            + ", " + _yj_refine("b2", "best", 0.001, 0.01, 0.01))


@register("skew_reduction", duckdb_with("definitive") + f", {_YJ_FILLED}, {_YJ_BEST}\n" + f"""
SELECT l.column, {r6('skewness(x)')} AS skew_before, abs(skewness({_yj_sql('x', 'lam')})) < abs(skewness(x)) AS reduced,
  round(skewness({_yj_sql('x', 'lam')}), 1) AS skew_after
FROM long l JOIN best b ON l.column = b.column GROUP BY l.column""")
def q_skew_reduction(spark, sf):
    """Skew before and after median imputation + Yeo-Johnson (X11)."""
    # Medians, λ and moments read the same five columns: joined once.
    d = _definitive(spark, sf).select(*_SKEW_DEMO).persist()
    try:
        filled = _filled_demo(d)
        lams = X.fit_yeo_johnson_lambdas(filled, _SKEW_DEMO)
        from ..functions.scalar import yeo_johnson
        mapped = {f"{c}_after": yeo_johnson(c, lam) for c, lam in zip(_SKEW_DEMO, lams)}
        # A row per column and side, collected while the rows are kept.
        got = {r["column"]: r["skewness"] for r in profile.moments(
            filled.withColumns(mapped), [*_SKEW_DEMO, *mapped]).collect()}
    finally:
        d.unpersist()
    both = spark.createDataFrame([(c, got[c], got[f"{c}_after"]) for c in _SKEW_DEMO if c in got],
                                 "column string, skew_before double, after double")
    return both.select(
        "column", "skew_before", (F.abs("after") < F.abs("skew_before")).alias("reduced"),
        F.round("after", 1).alias("skew_after"))


@register("yeo_johnson_fit", duckdb_with("definitive") + f", {_YJ_FILLED}, {_YJ_BEST}\n"
          "SELECT column, round(lam, 2) AS lambda FROM best")
def q_yeo_johnson_fit(spark, sf):
    d = _definitive(spark, sf)
    m = X.SkewedNumericScaler(inputCols=_SKEW_DEMO).fit(d)
    return spark.createDataFrame(
        [(c, round(lam, 2)) for c, lam in zip(_SKEW_DEMO, m.getOrDefault("lambdas"))],
        "column string, lambda double")


# --- models, scoring, persistence (X9, X12, L1-L5, E9, E10, S6, S7, B1-B4) -------
# Every query fits its own model, so its time is its own. The learners are the published ones
# where the model itself is asked about; queries about scoring use SCORING_ROUNDS rounds.
SCORING_ROUNDS = 5
TUNED_ROUNDS = 60  # of the published 897, which `tuned_booster()` has as its limit
# The label follows the features: a model below its floor has learnt little. The forest, whose
# trees see few features each, is the weakest on the smallest tables.
AUC_FLOOR = {"gbt": 0.9, "tuned": 0.9, "second": 0.75}


def _fits(spark, sf, *kinds: str):
    """({kind: pipeline model}, plan) of learners on the training years."""
    from .. import model as M
    train, _ = _train_test(spark, sf)
    learner = {"gbt": M.baseline_booster, "second": M.second_learner,
               "tuned": lambda: M.tuned_booster(M.TUNED_PARAMS | {"n_estimators": TUNED_ROUNDS}),
               "scoring": lambda: M.baseline_booster(max_iter=SCORING_ROUNDS)}
    return M.fit_pipelines(train, {k: learner[k]() for k in kinds})


def _fit(spark, sf, kind: str):
    """(pipeline model, plan) of one learner on the training years."""
    models, plan = _fits(spark, sf, kind)
    return models[kind], plan


@contextmanager
def _joined_once(spark, sf):
    """Missing shares, training rows and scored rows all come from the definitive loans: while
    this lasts, their joins are computed once and kept."""
    d = _definitive(spark, sf).persist()
    try:
        yield
    finally:
        d.unpersist()


def _test_rows(spark, sf):
    return _definitive(spark, sf).filter(F.col("issue_year") >= SPLIT_YEAR)


def _scores_of(mdl, rows, keep=("id", "is_bad")) -> DataFrame:
    from .. import model as M
    return M.predict_proba(mdl, rows, keep=list(keep)).withColumnsRenamed(
        {"is_bad": "label", "probability": "score"})


def _model_scores(spark, sf, kind: str, rows=None, keep=("id", "is_bad")) -> DataFrame:
    return _scores_of(_fit(spark, sf, kind)[0], rows if rows is not None else _test_rows(spark, sf),
                      keep)


_N_TEST = f"(SELECT count(*) FROM definitive WHERE issue_year >= {SPLIT_YEAR})"


def _metrics_sql(*kinds: str, more: str = "") -> str:
    return _union([f"SELECT '{k}' AS model, {_N_TEST} AS n_rows, true AS strong, true AS auc_by_ranks, "
                   f"true AS in_range{more} FROM (SELECT 1 FROM definitive LIMIT 1)" for k in kinds])


def _metric_facts(kind: str, s: DataFrame) -> tuple:
    """Facts that must hold of a model's scores: rows scored, AUC above the floor, AUC equal to
    the rank formula computed another way, metrics in range."""
    s = s.persist()   # curves, F1 and ranks read the same scores
    try:
        m = evaluate.model_comparison({kind: s}, THRESHOLD).first()
        # Average ranks from the counts per distinct score, in buckets (no global window).
        from ..operators.ordered import cumulative_sums
        c = s.groupBy("score").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("p"))
        r = cumulative_sums(c, "score", ["n"]).agg(
            F.sum(F.col("p") * (F.col("cum_n") - (F.col("n") - 1) / 2)).alias("ranks"),
            F.sum("p").alias("p"), F.sum("n").alias("n")).first()
        auc = (r["ranks"] - r["p"] * (r["p"] + 1) / 2) / (r["p"] * (r["n"] - r["p"]))
        return (kind, int(r["n"]), m["roc_auc"] > AUC_FLOOR[kind], abs(auc - m["roc_auc"]) < 1e-9,
                all(0 <= m[x] <= 1 for x in ("roc_auc", "pr_auc", "f1_bad")))
    finally:
        s.unpersist()


_METRIC_FACTS = ("model string, n_rows bigint, strong boolean, auc_by_ranks boolean, "
                 "in_range boolean")


def _model_metrics(spark, sf, *kinds: str) -> DataFrame:
    with _joined_once(spark, sf):
        return spark.createDataFrame([_metric_facts(k, _model_scores(spark, sf, k)) for k in kinds],
                                     _METRIC_FACTS)


@register("fit_gbt", duckdb_with("definitive") + _metrics_sql("gbt"))
def q_fit_gbt(spark, sf):
    return _model_metrics(spark, sf, "gbt")


@register("fit_second", duckdb_with("definitive") + _metrics_sql("second"))
def q_fit_second(spark, sf):
    return _model_metrics(spark, sf, "second")


@register("fit_tuned", duckdb_with("definitive") + _metrics_sql(
    "tuned", more=", true AS best_round_is_least, true AS ended_by_patience, true AS several_rounds"))
def q_fit_tuned(spark, sf):
    """The tuned booster (L3): besides the metrics, its best round has the least held-out loss,
    and it grew ``patience`` rounds more (or to the limit, which is TUNED_ROUNDS here)."""
    with _joined_once(spark, sf):
        mdl, _ = _fit(spark, sf, "tuned")
        facts = _metric_facts("tuned", _scores_of(mdl, _test_rows(spark, sf)))
    booster, limit = mdl.stages[-1], TUNED_ROUNDS
    curve, best = booster.getOrDefault("lossCurve"), booster.getOrDefault("bestRound")
    row = (*facts, curve[best - 1] == min(curve), len(curve) == min(limit, best + 10), best > 10)
    return spark.createDataFrame([row], _METRIC_FACTS + ", best_round_is_least boolean, "
                                 "ended_by_patience boolean, several_rounds boolean")


@register("model_comparison", duckdb_with("definitive") + _metrics_sql("gbt", "second").replace(
    "auc_by_ranks", "auc_as_single"))
def q_model_comparison(spark, sf):
    """Two models in one set of jobs (E10): as strong as they should be, and the same areas as
    each model's own curve gives."""
    with _joined_once(spark, sf):
        models, _ = _fits(spark, sf, "gbt", "second")
        scores = {k: cut_lineage(_scores_of(m, _test_rows(spark, sf))) for k, m in models.items()}
    rows = []
    for m in evaluate.model_comparison(scores, THRESHOLD).collect():
        one = evaluate.curve_metrics(scores[m["model"]]).first()
        rows.append((m["model"], one["n_pos"] + one["n_neg"], m["roc_auc"] > AUC_FLOOR[m["model"]],
                     abs(one["roc_auc"] - m["roc_auc"]) + abs(one["pr_auc"] - m["pr_auc"]) < 1e-9,
                     all(0 <= m[x] <= 1 for x in ("roc_auc", "pr_auc", "f1_bad"))))
    return spark.createDataFrame(rows, _METRIC_FACTS.replace("auc_by_ranks", "auc_as_single"))


# Stumps on the grade's place in the alphabet and the number of public records.
_STUMP_FEATURES = ["coalesce(ascii(grade) - 64, 0)", "coalesce(pub_rec, -1)",
                   "coalesce(open_acc, -1)"]
_STUMP = {"step": 0.3, "alpha": 0.8832802589188683, "lam": 0.32434502100527396}
_STUMP_ROUNDS = 3


def _stump_sql() -> str:
    """Boosting by exhaustive search over all splits of all features, round by round."""
    def weight(g, h):
        return (f"-{_STUMP['step']}::DOUBLE * sign({g}) * greatest(abs({g}) - {_STUMP['alpha']}::DOUBLE, 0) "
                f"/ ({h} + {_STUMP['lam']}::DOUBLE)")

    xs = [f"x{i}" for i in range(len(_STUMP_FEATURES))]
    out = "base AS (SELECT {}, is_bad AS y, CASE WHEN is_bad = 1 THEN (SELECT count_if(is_bad = 0)::DOUBLE " \
          "/ count_if(is_bad = 1) FROM definitive) ELSE 1::DOUBLE END AS w, 0::DOUBLE AS m FROM definitive)".format(
              ", ".join(f"CAST({e} AS DOUBLE) AS {x}" for e, x in zip(_STUMP_FEATURES, xs)))
    rows, before = [], "base"
    for r in range(1, _STUMP_ROUNDS + 1):
        parts = _union([f"SELECT {i} AS f, {x} AS x, sum(w * (1 / (1 + exp(-m)) - y)) AS g, "
                        f"sum(w / (1 + exp(-m)) * (1 - 1 / (1 + exp(-m)))) AS h FROM {before} GROUP BY {x}"
                        for i, x in enumerate(xs)])
        out += f""", sums{r} AS ({parts}),
cum{r} AS (SELECT f, (x + lead(x) OVER (PARTITION BY f ORDER BY x)) / 2 AS t, sum(g) OVER u AS gl, sum(h) OVER u AS hl,
  sum(g) OVER (PARTITION BY f) - sum(g) OVER u AS gr, sum(h) OVER (PARTITION BY f) - sum(h) OVER u AS hr
  FROM sums{r} WINDOW u AS (PARTITION BY f ORDER BY x)),
best{r} AS (SELECT f, t, {weight('gl', 'hl')} AS lv, {weight('gr', 'hr')} AS rv FROM cum{r} WHERE t IS NOT NULL
  ORDER BY gl * gl / hl + gr * gr / hr DESC LIMIT 1),
m{r} AS (SELECT {', '.join(xs)}, y, w, m + CASE WHEN CASE f {' '.join(f'WHEN {i} THEN {x}' for i, x in enumerate(xs))} END <= t
  THEN lv ELSE rv END AS m FROM {before}, best{r})"""
        rows.append(f"SELECT CAST({r} AS INTEGER) AS round, CAST(f AS INTEGER) AS feature, t AS threshold, {r6('lv')} AS left_value, "
                    f"{r6('rv')} AS right_value, (SELECT {r6('sum(w * (ln(1 + exp(m)) - y * m)) / sum(w)')} FROM m{r}) AS loss FROM best{r}")
        before = f"m{r}"
    return out + "\n" + _union(rows)


@register("boosted_stumps", duckdb_with("definitive") + ", " + _stump_sql())
def q_boosted_stumps(spark, sf):
    """Three rounds of the Newton booster with depth 1 (L3): splits, regularised leaf values and
    losses, against an exhaustive search."""
    from pyspark.ml.feature import VectorAssembler
    from .. import model as M
    from ..boosting import NewtonBooster
    d = _definitive(spark, sf)
    xs = [f"x{i}" for i in range(len(_STUMP_FEATURES))]
    rows = M.with_weight(d, M.positive_weight(d)).select("is_bad", M.WEIGHT_COL, *[
        F.expr(e).cast("double").alias(x) for e, x in zip(_STUMP_FEATURES, xs)])
    fitted = NewtonBooster(
        featuresCol="x", labelCol="is_bad", weightCol=M.WEIGHT_COL, maxIter=_STUMP_ROUNDS,
        maxDepth=1, stepSize=_STUMP["step"], regAlpha=_STUMP["alpha"], regLambda=_STUMP["lam"],
        minChildWeight=0.0).fit(VectorAssembler(inputCols=xs, outputCol="x").transform(rows))
    return spark.createDataFrame(
        [(r + 1, t.feature[0], t.threshold[0], t.value[t.left[0]], t.value[t.right[0]], loss)
         for r, (t, loss) in enumerate(zip(fitted.all_trees(), fitted.getOrDefault("lossCurve")))],
        "round int, feature int, threshold double, left_value double, right_value double, "
        "loss double")


# Skew of the original numeric columns over the training years routes them.
_SKEWED_SQL = f"skewed AS (SELECT column FROM ({_SKEW_SQL}) WHERE abs(skew) > 0.75::DOUBLE)"
_N_HOT = " + ".join(f"(SELECT count(DISTINCT {c}) FROM train)" for c in _OHE)


@register("fit_pipeline", duckdb_with("definitive") + f""", {_train_sql()}, {_SKEWED_SQL}
SELECT {_N_TEST} AS n_rows, CAST({sum(k in ('orig', 'new', 'ord') for _, k in _PLAN_CANDIDATES)} + {_N_HOT} AS INTEGER) AS n_features,
  CAST((SELECT count(*) FROM skewed) AS INTEGER) AS n_skewed, 0::BIGINT AS n_missing""")
def q_fit_pipeline(spark, sf):
    """Of the fitted end-to-end pipeline (X12): rows, width of the vector, columns in the skewed
    branch, and vector entries that are missing."""
    from pyspark.ml.functions import vector_to_array
    mdl, plan = _fit(spark, sf, "scoring")
    v = mdl.transform(_test_rows(spark, sf)).select(vector_to_array("features").alias("v"))
    return v.agg(F.count(F.lit(1)).alias("n_rows"), F.max(F.size("v")).alias("n_features"),
                 F.lit(len(plan.skewed)).alias("n_skewed"),
                 F.count_if(F.exists("v", lambda x: F.isnan(x) | x.isNull())).alias("n_missing"))


# Inputs of the numeric columns that are standardised as they are, over all years.
_ENGINEERED = {"emp_length_num": _EMP_SQL, "credit_hist_years":
               "greatest(coalesce(datediff('day', earliest_cr_line, issue_d) / 365.25::DOUBLE, 0::DOUBLE), 0::DOUBLE)",
               "pub_rec_binary": "coalesce(CAST(pub_rec > 0 AS INTEGER), 0)",
               "mort_acc_binary": "coalesce(CAST(mort_acc > 0 AS INTEGER), 0)"}
_STANDARD_SQL = _union([
    f"SELECT id, issue_year, '{c}' AS column, CAST({_ENGINEERED.get(c, c)} AS DOUBLE) AS x FROM definitive "
    f"WHERE '{c}' NOT IN (SELECT column FROM skewed)" for c, k in _PLAN_CANDIDATES if k in ("orig", "new")])


@register("assemble_features", duckdb_with("definitive") + f"""
, {_train_sql()}, {_SKEWED_SQL}, {_code_sql('grade')}, {_code_sql('sub_grade')},
std AS ({_STANDARD_SQL}),
med AS (SELECT column, quantile_cont(x, 0.5) AS med FROM std WHERE issue_year < {SPLIT_YEAR} GROUP BY column),
fill AS (SELECT s.id, s.issue_year, s.column, coalesce(s.x, m.med) AS x FROM std s JOIN med m ON s.column = m.column),
mom AS (SELECT column, avg(x) AS mu, stddev_pop(x) AS sd FROM fill WHERE issue_year < {SPLIT_YEAR} GROUP BY column),
test AS (SELECT * FROM definitive WHERE issue_year >= {SPLIT_YEAR})
SELECT f.id, f.column AS feature, {r6('(f.x - mu) / CASE WHEN sd = 0 THEN 1::DOUBLE ELSE sd END')} AS value
FROM fill f JOIN mom ON f.column = mom.column WHERE f.issue_year >= {SPLIT_YEAR}
""" + "".join(f"""UNION ALL SELECT d.id, '{c}', coalesce(l.code, -1::DOUBLE) FROM test d
LEFT JOIN lv_{c} l ON l.level = coalesce(d.{c}, {_mode_sql(c)})
""" for c in ("grade", "sub_grade")) + "".join(f"""UNION ALL SELECT id, '{c}=' || v, 1::DOUBLE FROM
(SELECT id, coalesce({c}, {_mode_sql(c)}) AS v FROM test) WHERE v IN (SELECT {c} FROM train)
""" for c in _OHE))
def q_assemble_features(spark, sf):
    """Assembled vectors of the test rows (X9) as (id, feature, value): standardised columns, codes
    and the ones among the indicators. Skewed columns: see ``assemble_skewed``."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import StringIndexerModel
    from pyspark.ml.functions import vector_to_array
    mdl, plan = _fit(spark, sf, "scoring")
    labels = next(st for st in mdl.stages if isinstance(st, StringIndexerModel)).labelsArray
    names = [*plan.skewed, *plan.standard, *plan.ordinal,
             *[f"{c}={v}" for c, vs in zip(plan.one_hot, labels) for v in vs]]
    long = PipelineModel(stages=mdl.stages[:-1]).transform(_test_rows(spark, sf)).select(
        "id", F.posexplode(vector_to_array("features")).alias("i", "value"))
    dense = len(plan.skewed) + len(plan.standard) + len(plan.ordinal)
    return (long.filter((F.col("i") >= len(plan.skewed)) & ((F.col("i") < dense) | (F.col("value") != 0)))
            .select("id", F.element_at(F.array(*[F.lit(n) for n in names]), F.col("i") + 1)
                    .alias("feature"), "value"))


# The skewed branch: λ by finer and finer grids over the filled training rows, then the mapped and
# standardised values of the test rows by grade.
_YJ_FINEST = ", ".join([_YJ_BEST, _yj_refine("best", "b4", 1e-4, 1e-3, 1e-3),
                        _yj_refine("b4", "b5", 1e-5, 1e-4, 1e-4),
                        _yj_refine("b5", "b6", 1e-6, 1e-5, 1e-5)])
_SKEWED_RAW = _union([
    f"SELECT issue_year, grade, '{c}' AS column, {_d(c)} AS x FROM definitive "
    f"WHERE '{c}' IN (SELECT column FROM skewed)" for c, k in _PLAN_CANDIDATES if k == "orig"])


@register("assemble_skewed", duckdb_with("definitive") + f"""
, {_SKEWED_SQL}, raw AS ({_SKEWED_RAW}),
med AS (SELECT column, quantile_cont(x, 0.5) AS med FROM raw WHERE issue_year < {SPLIT_YEAR} GROUP BY column),
filled AS (SELECT r.issue_year, r.grade, r.column, coalesce(r.x, m.med) AS x FROM raw r JOIN med m ON r.column = m.column),
long AS (SELECT column, x FROM filled WHERE issue_year < {SPLIT_YEAR}), {_YJ_FINEST},
mapped AS (SELECT f.issue_year, f.grade, f.column, {_yj_sql('x', 'lam')} AS y FROM filled f JOIN b6 ON f.column = b6.column),
mom AS (SELECT column, avg(y) AS mu, stddev_pop(y) AS sd FROM mapped WHERE issue_year < {SPLIT_YEAR} GROUP BY column)
SELECT m.column AS feature, grade, count(*) AS n, round(avg((y - mu) / sd), 2) AS mean,
  round(avg(pow((y - mu) / sd, 2)), 2) AS square
FROM mapped m JOIN mom ON m.column = mom.column WHERE issue_year >= {SPLIT_YEAR} GROUP BY m.column, grade""")
def q_assemble_skewed(spark, sf):
    """The skewed positions of the assembled vectors (X9) over the test rows, by grade: imputed,
    mapped with the λ of the training rows, standardised."""
    from pyspark.ml.functions import vector_to_array
    from ..features.joint_fit import fit_preprocessing
    from ..plans.feature_plan import fit_plan
    train = cut_lineage(_train_test(spark, sf)[0])
    plan = fit_plan(train)
    rows = _test_rows(spark, sf).withColumn("by", F.col("grade"))
    for stage in fit_preprocessing(train, plan):
        rows = stage.transform(rows)
    v = vector_to_array("features")
    return rows.select("by", F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), v[i].alias("x")) for i, c in enumerate(plan.skewed)])
    )).groupBy("feature", F.col("by").alias("grade")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("x"), 2).alias("mean"),
        F.round(F.avg(F.col("x") * F.col("x")), 2).alias("square"))


def _valid():
    return (F.col("probability") >= 0) & (F.col("probability") <= 1)


@register("predict_proba", duckdb_with("definitive") + f"SELECT {_N_TEST} AS n_rows, {_N_TEST} AS n_valid")
def q_predict_proba(spark, sf):
    p = _model_scores(spark, sf, "scoring").withColumnRenamed("score", "probability")
    return p.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(_valid()).alias("n_valid"))


@register("score_psi_model", duckdb_with("definitive") + f"""SELECT count_if(issue_year < {SPLIT_YEAR})::BIGINT AS n_train,
  count_if(issue_year >= {SPLIT_YEAR})::BIGINT AS n_test, true AS has_band, true AS not_negative FROM definitive""")
def q_score_psi_model(spark, sf):
    """PSI of model scores, train vs test (E9); the side comes along with the scores."""
    rows = profile.time_split(_definitive(spark, sf), SPLIT_YEAR)
    with _joined_once(spark, sf):
        s = _model_scores(spark, sf, "scoring", rows, keep=("side",)).persist()
        try:
            n = {r["side"]: r["count"] for r in s.groupBy("side").count().collect()}
            p = stability.score_psi(s).first()
        finally:
            s.unpersist()
    return spark.createDataFrame(
        [(n.get("train", 0), n.get("test", 0), p["band"] is not None, p["psi"] >= 0)],
        "n_train bigint, n_test bigint, has_band boolean, not_negative boolean")


def _saved_scorer(spark, mdl, plan):
    from ..score import Scorer
    path = _shared(spark, "scorer")
    Scorer(mdl, plan).save(path)
    return Scorer.load(path, spark)


_SCORED_SQL = "AS n_rows, {0} AS n_valid, 0::BIGINT AS n_off_threshold".format


def _score_facts(scored: DataFrame) -> DataFrame:
    off = F.col("prediction") != (F.col("probability") >= THRESHOLD).cast("int")
    return scored.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(_valid()).alias("n_valid"),
                      F.count_if(off).alias("n_off_threshold"))


@register("score_batch", duckdb_with("definitive") + f"SELECT {_N_TEST} {_SCORED_SQL(_N_TEST)}")
def q_score_batch(spark, sf):
    """Load the saved artifact and score the raw test applications."""
    with _joined_once(spark, sf):
        return cut_lineage(_score_facts(_saved_scorer(spark, *_fit(spark, sf, "scoring")).score(
            _test_rows(spark, sf), THRESHOLD)))   # one row, counted while the loans are kept


@register("score_csv", duckdb_with("loans")
          + f"SELECT (SELECT count(*) FROM loans) {_SCORED_SQL('(SELECT count(*) FROM loans)')}")
def q_score_csv(spark, sf):
    """The deployment path (S1, S7, B1-B4): raw applications from CSV through the loaded Scorer."""
    path = _shared(spark, "applications-csv")
    write_loans_csv(_loans(spark, sf).drop("loan_status"), path)
    return _score_facts(_saved_scorer(spark, *_fit(spark, sf, "scoring")).score(
        read_loans_csv(spark, path), THRESHOLD))


@register("model_roundtrip", duckdb_with("definitive") + f"SELECT {_N_TEST} AS n_rows, 0::BIGINT AS n_differ")
def q_model_roundtrip(spark, sf):
    """Probabilities before and after save -> load (S6, S7): rows, and rows that differ."""
    rows = _test_rows(spark, sf)
    mdl, plan = _fit(spark, sf, "scoring")
    before = _scores_of(mdl, rows).select("id", F.col("score").alias("p_before"))
    after = _saved_scorer(spark, mdl, plan).score(rows).select("id", F.col("probability").alias("p_after"))
    return before.join(after, "id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~F.col("p_before").eqNullSafe(F.col("p_after"))).alias("n_differ"))


def queries() -> dict[str, Query]:
    """Every registered query, doubles rounded to 6 dp (oracle convention)."""
    def wrap(fn: Query) -> Query:
        return lambda spark, sf: rounded(fn(spark, sf))
    return {k: wrap(v) for k, v in Q.items()}


_COLUMN_WORD = re.compile(r"(?<![\w'\"])column(?![\w'\"])")


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per key (``column`` is a keyword there, so it is quoted)."""
    return {k: _COLUMN_WORD.sub('"column"', v) for k, v in ORACLE.items()}
