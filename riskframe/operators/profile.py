"""Profiling aggregates (A1, A2, A5-A10, A17-A25) and the time split.

Statistics over many columns are projections of one state per column, made in one
scan (``column_state``). Quantiles and modes go through distributed distinct-value
tables, never a single-task ``percentile``/``mode``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import EDA_SKEW_THRESHOLD, NEAR_ZERO_STD, PLAN_SKEW_THRESHOLD
from . import column_state
from .ordered import exact_quantiles, pct_name, quantiles_wide


def _share(count_col: str, total: int) -> Column:
    return (F.col(count_col) * F.lit(100.0) / F.lit(float(total))) if total else F.lit(None).cast("double")


def value_distribution(df: DataFrame, col: str) -> DataFrame:
    """(value, count, pct) of a column; NULL excluded; count desc (A1, A2)."""
    from ..session import cut_lineage
    # One scan: the grouped counts are written once to the shared checkpoint
    # folder; the total is summed from that small table, not from the input.
    counts = cut_lineage(df.filter(F.col(col).isNotNull()).groupBy(col)
                         .agg(F.count(F.lit(1)).alias("count")))
    total = counts.agg(F.sum("count")).first()[0] or 0
    return counts.withColumn("pct", _share("count", total)) \
        .orderBy(F.col("count").desc(), F.col(col))


def status_distribution(df: DataFrame, col: str = "loan_status") -> DataFrame:
    """Raw loan_status counts and percentages (A1)."""
    return value_distribution(df, col)


def class_balance(df: DataFrame, label: str = "is_bad") -> DataFrame:
    """Label counts and percentages after filtering (A2)."""
    return value_distribution(df, label)


def moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """Bias-adjusted skewness G1 and excess kurtosis G2 per column.

    Constant column -> 0; n < 3 (G1) / n < 4 (G2) -> NULL.
    """
    return column_state.moments_of(column_state.column_state(df, columns))


def high_skew(df: DataFrame, columns: list[str], threshold: float = EDA_SKEW_THRESHOLD) -> DataFrame:
    """Columns with |G1| > threshold, by |G1| desc."""
    return column_state.high_skew_of(column_state.column_state(df, columns), threshold)


def skew_partition(df: DataFrame, columns: list[str],
                   threshold: float = PLAN_SKEW_THRESHOLD) -> DataFrame:
    """Population skew g1 (NULLs dropped); |g1| > threshold -> 'skewed' else 'standard' (A8)."""
    return column_state.skew_partition_of(column_state.column_state(df, columns), threshold)


def describe_numeric(df: DataFrame, columns: list[str], exact: bool = True) -> DataFrame:
    """count, mean, std (ddof 1), min, 25/50/75 %, max per column.

    Exact quantiles (linear interpolation) by default, unlike ``df.summary()``;
    ``exact=False`` uses one approximate sketch pass instead.
    """
    basic = column_state.basics_of(column_state.column_state(df, columns))
    q = quantiles_wide(df, columns, [0.25, 0.5, 0.75], exact=exact)
    return (basic.join(q, "column", "left")
            .select("column", "count", "mean", "std", "min",
                    F.col(pct_name(0.25)).alias("p25"), F.col(pct_name(0.5)).alias("p50"),
                    F.col(pct_name(0.75)).alias("p75"), "max")
            .orderBy("column"))


def near_zero_variance(df: DataFrame, columns: list[str], threshold: float = NEAR_ZERO_STD
                       ) -> DataFrame:
    """Columns whose sample std is below the threshold (A10)."""
    return column_state.near_zero_of(column_state.column_state(df, columns), threshold)


def category_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, count) for all categorical columns at once, count desc."""
    long = (df.select(*[F.col(c).cast("string").alias(c) for c in columns])
            .unpivot([], columns, "column", "value").filter(F.col("value").isNotNull()))
    return (long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
            .orderBy("column", F.col("count").desc(), "value"))


def bad_rate(df: DataFrame, columns: list[str], label: str = "is_bad") -> DataFrame:
    """Mean label per category value, NULL keys dropped, ascending."""
    long = (df.select(F.col(label).cast("double").alias("__y"),
                      *[F.col(c).cast("string").alias(c) for c in columns])
            .unpivot(["__y"], columns, "column", "value").filter(F.col("value").isNotNull()))
    return (long.groupBy("column", "value")
            .agg(F.avg("__y").alias("bad_rate"), F.count(F.lit(1)).alias("n_loans"))
            .orderBy("column", "bad_rate", "value"))


# --- fixed values: yearly trend measures (output name, source column) --------
YEARLY_MEASURES = [("avg_loan_amnt", "loan_amnt"), ("avg_int_rate", "int_rate"),
                   ("avg_fico_low", "fico_range_low"), ("avg_dti", "dti")]


def yearly_stats(df: DataFrame, year_col: str = "issue_year", id_col: str = "id",
                 label: str = "is_bad") -> DataFrame:
    """Per issue year: non-null id count, mean amount/rate/FICO/DTI (if present), bad rate."""
    aggs = [F.count(id_col).alias("loan_count")]
    aggs += [F.avg(F.col(src).cast("double")).alias(name) for name, src in YEARLY_MEASURES
             if src in df.columns]
    aggs.append(F.avg(F.col(label).cast("double")).alias("bad_rate"))
    return df.filter(F.col(year_col).isNotNull()).groupBy(year_col).agg(*aggs).orderBy(year_col)


def year_range(df: DataFrame, year_col: str = "issue_year") -> DataFrame:
    """First and last issue year."""
    return df.agg(F.min(year_col).alias("min_year"), F.max(year_col).alias("max_year"))


def ordinal_levels(df: DataFrame, columns=("grade", "sub_grade")) -> DataFrame:
    """Sorted distinct levels: ``grade`` lexical, ``sub_grade`` by (letter, number).

    Returns (column, level, rank) with rank starting at 0 (= ordinal code).
    The level table is bounded by the vocabulary, so one window per column is fine.
    """
    long = (df.select(*[F.col(c).cast("string").alias(c) for c in columns])
            .unpivot([], list(columns), "column", "level").filter(F.col("level").isNotNull())
            .distinct())
    letter = F.substring("level", 1, 1)
    number = F.expr("substring(level, 2)").try_cast("int")
    w = Window.partitionBy("column").orderBy(
        F.when(F.col("column") == "sub_grade", letter).otherwise(F.col("level")),
        F.when(F.col("column") == "sub_grade", number), F.col("level"))
    return long.withColumn("rank", F.row_number().over(w) - 1).orderBy("column", "rank")


def impute_median(df: DataFrame, columns: list[str], exact: bool = True) -> DataFrame:
    """(column, median): exact median, mean of the middle two for even n.

    ``exact=False``: approximate median from one sketch pass.
    """
    from .ordered import approx_quantiles
    q = exact_quantiles(df, columns, [0.5]) if exact else approx_quantiles(df, columns, [0.5])
    return q.select("column", F.col("value").alias("median")).orderBy("column")


def impute_mode(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, mode, count): most frequent non-null value, smallest on ties.

    Counts per distinct (column, value), then one aggregate that keeps the best of
    (count, value): no join, so values that tie share no key.
    """
    long = (df.select(*[F.col(c).cast("string").alias(c) for c in columns])
            .unpivot([], columns, "column", "value").filter(F.col("value").isNotNull()))
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    return (counts.groupBy("column")
            .agg(F.min(F.struct((-F.col("count")).alias("neg"), "value")).alias("top"))
            .select("column", F.col("top.value").alias("mode"), (-F.col("top.neg")).alias("count"))
            .orderBy("column"))


def time_split(df: DataFrame, split_year: int, year_col: str = "issue_year") -> DataFrame:
    """Add ``side``: train when year < split_year, test when >=; NULL year in neither."""
    y = F.col(year_col)
    side = F.when(y < split_year, "train").when(y >= split_year, "test")
    return df.withColumn("side", side).filter(F.col("side").isNotNull())


def split_frames(df: DataFrame, split_year: int, year_col: str = "issue_year"
                 ) -> tuple[DataFrame, DataFrame]:
    """(train, test) as two filters; the year predicate prunes partitioned data."""
    y = F.col(year_col)
    return df.filter(y < split_year), df.filter(y >= split_year)


def split_report(df: DataFrame, split_year: int, label: str = "is_bad",
                 year_col: str = "issue_year",
                 feature_exclude=("is_bad", "loan_status", "issue_year", "issue_month_yr")
                 ) -> DataFrame:
    """Per side: rows, feature-column count, bad rate %."""
    n_features = len([c for c in df.columns if c not in set(feature_exclude)])
    return (time_split(df, split_year, year_col).groupBy("side")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 (F.avg(F.col(label).cast("double")) * F.lit(100.0)).alias("bad_rate_pct"))
            .withColumn("n_features", F.lit(n_features))
            .orderBy(F.col("side").desc()))


def class_weight(df: DataFrame, label: str = "is_bad") -> DataFrame:
    """neg / pos ratio for positive-class weighting; 1 if there are no positives."""
    y = F.col(label)
    agg = df.agg(F.count_if(y == 0).alias("n_neg"), F.count_if(y == 1).alias("n_pos"))
    return agg.withColumn("scale_pos_weight",
                          F.when(F.col("n_pos") > 0, F.col("n_neg") / F.col("n_pos"))
                          .otherwise(F.lit(1.0)))


def no_skill(df: DataFrame, label: str = "label") -> DataFrame:
    """Label mean: the precision of a random classifier."""
    return df.agg(F.avg(F.col(label).cast("double")).alias("no_skill"))

