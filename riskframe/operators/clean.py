"""Cleaning: date parsing, labelling, definitive outcomes, missingness, drops, types.

(P1-P7, P10, A3, A4.) The only driver action here is the missing-count pass
(one aggregate, one row back) because it decides a projection.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import MONTH_YEAR, month_start, parse_month
from ..functions.scalar import status_label
from ..schema import (BAD_STATUSES, DATE_COLUMNS, GOOD_STATUSES, LEAKAGE_COLUMNS,
                      MISSING_THRESHOLD_PCT, PROTECTED_COLUMNS)


def issue_year_col() -> Column:
    return F.col("issue_year")


@dataclass(frozen=True)
class DateParseReport:
    parsed: list[str]
    absent: list[str]


def parse_dates(df: DataFrame, columns=DATE_COLUMNS, formats=(MONTH_YEAR,),
                add_issue_parts: bool = True) -> DataFrame:
    """Parse listed text date columns in place (bad text -> NULL); absent ones skipped.

    Adds ``issue_year`` (F2) and ``issue_month_yr`` (F3, first day of month)
    when ``issue_d`` is present.
    """
    present = [c for c in columns if c in df.columns]
    out = df.withColumns({c: parse_month(c, tuple(formats)) for c in present}) if present else df
    if add_issue_parts and "issue_d" in out.columns:
        out = out.withColumns({"issue_year": F.year("issue_d"),
                               "issue_month_yr": month_start("issue_d")})
    return out


def date_parse_report(df: DataFrame, columns=DATE_COLUMNS) -> DateParseReport:
    return DateParseReport([c for c in columns if c in df.columns],
                           [c for c in columns if c not in df.columns])


def date_parse_counts(df: DataFrame, columns=DATE_COLUMNS, formats=(MONTH_YEAR,)) -> DataFrame:
    """(column, n_text, n_parsed, n_failed) per present date column of the raw frame.

    One long-form aggregate: text that is present but does not parse counts as failed.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame(
            [], "column string, n_text bigint, n_parsed bigint, n_failed bigint")
    long = (df.select(*[F.col(c).cast("string").alias(c) for c in present])
            .unpivot([], present, "column", "text"))
    parsed = parse_month(F.col("text"), tuple(formats))
    return (long.groupBy("column")
            .agg(F.count("text").alias("n_text"), F.count(parsed).alias("n_parsed"))
            .withColumn("n_failed", F.col("n_text") - F.col("n_parsed")))


def label_loans(df: DataFrame, status_col: str = "loan_status", bad=BAD_STATUSES,
                good=GOOD_STATUSES) -> DataFrame:
    """Attach ``is_bad``: 1 bad, 0 good, -1 otherwise."""
    return df.withColumn("is_bad", status_label(status_col, bad, good))


def definitive_outcomes(df: DataFrame, status_col: str = "loan_status", bad=BAD_STATUSES,
                        good=GOOD_STATUSES) -> DataFrame:
    """Keep loans with a final outcome.

    Filtering on the status column (an ``IN`` list) instead of ``is_bad != -1``
    lets the predicate reach the scan (``PushedFilters: In(...)``).
    """
    return df.filter(F.col(status_col).isin(*(list(bad) + list(good))))


def outcome_counts(df: DataFrame, status_col: str = "loan_status", bad=BAD_STATUSES,
                   good=GOOD_STATUSES) -> DataFrame:
    """One row: rows before, rows kept, rows removed (one aggregate for all three)."""
    keep = F.col(status_col).isin(*(list(bad) + list(good)))
    return df.agg(F.count(F.lit(1)).alias("rows_before"),
                  F.count_if(keep).alias("rows_after")) \
        .withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def missing_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Long table (column, missing_count, n_rows) from ONE aggregate over all columns."""
    cols = columns or df.columns
    flags = df.select(*[F.col(c).isNull().cast("int").alias(c) for c in cols])
    long = flags.unpivot([], cols, "column", "is_null")
    return long.groupBy("column").agg(F.count(F.lit(1)).alias("n_rows"),
                                      F.sum("is_null").cast("bigint").alias("missing_count"))


def missing_table(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Columns with missing values: count and percent, percent desc (A3, O2)."""
    m = missing_counts(df, columns)
    return (m.filter(F.col("missing_count") > 0)
            .select("column", "missing_count",
                    (F.col("missing_count") * F.lit(100.0) / F.col("n_rows")).alias("missing_pct"))
            .orderBy(F.col("missing_pct").desc(), F.col("column")))


def high_missing_columns(df: DataFrame, threshold_pct: float = MISSING_THRESHOLD_PCT) -> list[str]:
    """Names whose missing percent is strictly above the threshold (one action, ≤ n_cols names)."""
    rows = (missing_counts(df)
            .filter(F.col("missing_count") * F.lit(100.0) / F.col("n_rows") > F.lit(float(threshold_pct)))
            .select("column").collect())
    return [r["column"] for r in rows]


def drop_high_missing(df: DataFrame, threshold_pct: float = MISSING_THRESHOLD_PCT,
                      protected=PROTECTED_COLUMNS) -> DataFrame:
    """Drop columns with missing % > threshold."""
    names = [c for c in high_missing_columns(df, threshold_pct) if c not in protected]
    return df.drop(*names)


def leakage_drop_list(df: DataFrame, high_missing: list[str] | None = None,
                      static=LEAKAGE_COLUMNS, protected=PROTECTED_COLUMNS) -> list[str]:
    """Union of the measured and the static drop lists, present and not protected (P5)."""
    names = set(static) | set(high_missing or [])
    return [c for c in df.columns if c in names and c not in protected]


def drop_leakage(df: DataFrame, threshold_pct: float | None = MISSING_THRESHOLD_PCT,
                 static=LEAKAGE_COLUMNS, protected=PROTECTED_COLUMNS) -> DataFrame:
    """Drop the static leakage list plus (optionally) the high-missing columns (P4 + P5)."""
    measured = high_missing_columns(df, threshold_pct) if threshold_pct is not None else []
    return df.drop(*leakage_drop_list(df, measured, static, protected))


def column_kind(dt: T.DataType) -> str:
    if isinstance(dt, T.NumericType):
        return "numeric"
    if isinstance(dt, T.StringType):
        return "categorical"
    return "other"


def column_types(df: DataFrame) -> dict[str, list[str]]:
    """Schema walk: numeric / categorical / other (dates fall in neither)."""
    out: dict[str, list[str]] = {"numeric": [], "categorical": [], "other": []}
    for f in df.schema.fields:
        out[column_kind(f.dataType)].append(f.name)
    return out


def column_types_frame(df: DataFrame) -> DataFrame:
    """(column, dtype, kind) for every column, as a DataFrame."""
    spark = df.sparkSession
    rows = [(f.name, f.dataType.simpleString(), column_kind(f.dataType)) for f in df.schema.fields]
    return spark.createDataFrame(rows, "column string, dtype string, kind string")


def nominal_columns(categorical: list[str], ordinal: list[str]) -> list[str]:
    """Categorical minus ordinal (P10)."""
    return [c for c in categorical if c not in ordinal]


def select_present(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Keep the requested columns that exist, in the requested order."""
    have = set(df.columns)
    return df.select(*[c for c in wanted if c in have])


def impute_plan(df: DataFrame, exclude: list[str] | None = None) -> DataFrame:
    """Remaining missing columns with the imputation they get: median / most_frequent (A4)."""
    kinds = {f.name: column_kind(f.dataType) for f in df.schema.fields}
    skip = set(exclude or [])
    m = missing_table(df, [c for c in df.columns if c not in skip])
    strategy = F.create_map(*[F.lit(x) for name, kind in kinds.items() if kind != "other"
                              for x in (name, "median" if kind == "numeric" else "most_frequent")])
    kind_map = F.create_map(*[F.lit(x) for name, kind in kinds.items() for x in (name, kind)])
    return (m.select("column", F.try_element_at(kind_map, F.col("column")).alias("kind"),
                     "missing_count", "missing_pct",
                     F.try_element_at(strategy, F.col("column")).alias("strategy"))
            .orderBy(F.col("missing_pct").desc(), F.col("column")))


def table_info(df: DataFrame) -> DataFrame:
    """(column, dtype, non_null, n_rows): one aggregate, unpivoted."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    m = missing_counts(df)
    dtype = F.create_map(*[F.lit(x) for kv in types.items() for x in kv])
    return m.select("column", F.try_element_at(dtype, F.col("column")).alias("dtype"),
                    (F.col("n_rows") - F.col("missing_count")).alias("non_null"), "n_rows")


def preview_head(df: DataFrame, n: int = 5, order_by: str = "id") -> DataFrame:
    """First n rows in a deterministic order (S4, O1): a top-k, no full sort."""
    return df.orderBy(order_by).limit(n)
