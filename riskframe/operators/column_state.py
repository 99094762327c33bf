"""One mergeable profile of all columns, from one scan.

A *state* has a row per column (and group): rows, nulls, values, least and greatest value, mean
and the sums of the second to fourth power of the distance to it, and the same with the label over
the rows that have both. States of parts merge into the state of the whole, so increments are
scanned once when they come, saved, and never again. Every statistic of the profile is a
projection of the state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import EDA_SKEW_THRESHOLD, NEAR_ZERO_STD, PLAN_SKEW_THRESHOLD

NUMBERS = ["n_rows", "n_missing", "n", "mn", "mx", "mean", "m2", "m3", "m4",
           "pairs", "mean_x", "mean_y", "m2_x", "m2_y", "c_xy", "mn_x", "mx_x", "mn_y", "mx_y"]


def column_state(df: DataFrame, columns: list[str] | None = None, label: str | None = None,
                 group_cols: tuple[str, ...] = ()) -> DataFrame:
    """(group..., column, dtype, state) in one scan: every value meets one map-side aggregate.

    Numbers (NaN is no value) have moments, other columns rows and nulls alone. ``label`` adds
    the pairs of each column with it.
    """
    columns = [c for c in columns or df.columns if c not in group_cols]
    y = F.col(f"`{label}`").cast("double") if label else F.lit(None).cast("double")

    def value(c: str) -> Column:
        if not isinstance(df.schema[c].dataType, T.NumericType):
            return F.lit(None).cast("double")
        v = F.col(f"`{c}`").cast("double")
        return F.when(~F.isnan(v), v)

    long = df.select(*group_cols, F.when(~F.isnan(y), y).alias("__y"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"),
                 F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
                 F.col(f"`{c}`").isNull().cast("int").alias("missing"), value(c).alias("x"))
        for c in columns])))
    x, n = F.col("x"), F.count("x").cast("double")
    both = F.col("x").isNotNull() & F.col("__y").isNotNull()
    px, py, pairs = F.when(both, x), F.when(both, F.col("__y")), F.count(F.when(both, x))
    m2 = F.var_pop(x) * n
    # Powers of the spread back from the standardised moments, which are NULL without spread.
    aggregates = {
        "n_rows": F.count(F.lit(1)), "n_missing": F.sum("missing").cast("bigint"),
        "n": F.count(x), "mn": F.min(x), "mx": F.max(x), "mean": F.avg(x), "m2": m2,
        "m3": F.coalesce(F.skewness(x) * F.pow(m2, F.lit(1.5)) / F.sqrt(n), F.lit(0.0)),
        "m4": F.coalesce(F.try_divide((F.kurtosis(x) + 3) * m2 * m2, n), F.lit(0.0))}
    none = F.max(F.lit(None).cast("double"))
    aggregates |= {
        "pairs": pairs, "mean_x": F.avg(px), "mean_y": F.avg(py), "m2_x": F.var_pop(px) * pairs,
        "m2_y": F.var_pop(py) * pairs, "c_xy": F.covar_pop(px, py) * pairs,
        "mn_x": F.min(px), "mx_x": F.max(px), "mn_y": F.min(py), "mx_y": F.max(py),
    } if label else {c: F.lit(0).cast("bigint") if c == "pairs" else none for c in NUMBERS[9:]}
    return long.groupBy(*group_cols, "column", "dtype").agg(
        *[e.alias(c) for c, e in aggregates.items()])


def merge_states(states: DataFrame, group_cols: tuple[str, ...] = ()) -> DataFrame:
    """The state of the whole from states of its parts (rows per column of any number).

    Exact in real numbers: each part's sums are moved from its own mean to the common one.
    """
    keys = [*group_cols, "column", "dtype"]
    part = Window.partitionBy(*keys)

    def common(mean: str, count: str) -> Column:
        # Relative to one of the parts' means, so that large equal means do not round.
        base = F.min(mean).over(part)
        away = F.sum(F.col(count) * (F.col(mean) - base)).over(part)
        return base + F.try_divide(away, F.sum(F.when(F.col(mean).isNotNull(), F.col(count)))
                                   .over(part))

    moved = states.select(*keys, *NUMBERS, common("mean", "n").alias("mu"),
                          common("mean_x", "pairs").alias("mu_x"),
                          common("mean_y", "pairs").alias("mu_y"))
    d, dx, dy = (F.col(a) - F.col(b) for a, b in (("mean", "mu"), ("mean_x", "mu_x"),
                                                  ("mean_y", "mu_y")))
    n, m2, m3 = F.col("n").cast("double"), F.col("m2"), F.col("m3")
    pairs = F.col("pairs").cast("double")
    sums = {"m2": m2 + n * d * d, "m3": m3 + 3 * d * m2 + n * d * d * d,
            "m4": F.col("m4") + 4 * d * m3 + 6 * d * d * m2 + n * d * d * d * d,
            "m2_x": F.col("m2_x") + pairs * dx * dx, "m2_y": F.col("m2_y") + pairs * dy * dy,
            "c_xy": F.col("c_xy") + pairs * dx * dy}
    out = {c: F.sum(c) for c in ("n_rows", "n_missing", "n", "pairs")}
    out |= {c: F.min(c) for c in ("mn", "mn_x", "mn_y")}
    out |= {c: F.max(c) for c in ("mx", "mx_x", "mx_y")}
    out |= {"mean": F.first("mu"), "mean_x": F.first("mu_x"), "mean_y": F.first("mu_y")}
    out |= {c: F.coalesce(F.sum(e), F.lit(0.0)) if c in ("m3", "m4") else F.sum(e)
            for c, e in sums.items()}
    return moved.groupBy(*keys).agg(*[out[c].alias(c) for c in NUMBERS])


def save_state(state: DataFrame, path: str) -> None:
    """Add the state of an increment to a folder of states."""
    state.write.mode("append").parquet(path)


def load_state(spark: SparkSession, path: str) -> DataFrame:
    """The state of all increments saved so far."""
    return merge_states(spark.read.parquet(path))


# --- statistics of a state ----------------------------------------------------------------

def info_of(state: DataFrame) -> DataFrame:
    """(column, dtype, non_null, n_rows)."""
    return state.select("column", "dtype", (F.col("n_rows") - F.col("n_missing")).alias("non_null"),
                        "n_rows")


def _missing_pct() -> Column:
    return F.col("n_missing") * F.lit(100.0) / F.col("n_rows")


def missing_of(state: DataFrame) -> DataFrame:
    """(column, missing_count, missing_pct) of columns with nulls, percent desc (A3, O2)."""
    return (state.filter(F.col("n_missing") > 0)
            .select("column", F.col("n_missing").alias("missing_count"),
                    _missing_pct().alias("missing_pct"))
            .orderBy(F.col("missing_pct").desc(), F.col("column")))


def high_missing_of(state: DataFrame, threshold_pct: float) -> list[str]:
    """Names whose missing percent is strictly above the threshold (at most one per column)."""
    return [r["column"] for r in state.filter(_missing_pct() > F.lit(float(threshold_pct)))
            .select("column").collect()]


def _g1() -> Column:
    n = F.col("n").cast("double")
    return F.try_divide(F.sqrt(n) * F.col("m3"), F.pow(F.col("m2"), F.lit(1.5)))


def moments_of(state: DataFrame) -> DataFrame:
    """(column, skewness, kurtosis): bias-adjusted G1 and excess G2 of numeric columns.

    Constant column -> 0; n < 3 (G1) / n < 4 (G2) -> NULL.
    """
    n = F.col("n").cast("double")
    g2 = F.try_divide(n * F.col("m4"), F.col("m2") * F.col("m2")) - 3
    constant = F.col("mn") == F.col("mx")
    none = F.lit(None).cast("double")
    skew = (F.when(F.col("n") < 3, none).when(constant, F.lit(0.0))
            .otherwise(_g1() * F.sqrt(n * (n - 1)) / (n - 2)))
    kurt = (F.when(F.col("n") < 4, none).when(constant, F.lit(0.0))
            .otherwise((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)))
    return state.select("column", skew.alias("skewness"), kurt.alias("kurtosis"))


def high_skew_of(state: DataFrame, threshold: float = EDA_SKEW_THRESHOLD) -> DataFrame:
    """Columns with |G1| > threshold, by |G1| desc."""
    return (moments_of(state).filter(F.abs("skewness") > F.lit(float(threshold)))
            .orderBy(F.abs("skewness").desc(), F.col("column")))


def skew_partition_of(state: DataFrame, threshold: float = PLAN_SKEW_THRESHOLD) -> DataFrame:
    """(column, skew, group): population g1; |g1| > threshold -> 'skewed' else 'standard' (A8)."""
    skew = F.when(F.col("mn") < F.col("mx"), _g1())
    group = F.when(F.abs("skew") > F.lit(float(threshold)), "skewed").otherwise("standard")
    return (state.select("column", skew.alias("skew")).select("column", "skew",
                                                              group.alias("group"))
            .orderBy(F.col("skew").desc_nulls_last(), F.col("column")))


def _std() -> Column:
    return F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))


def basics_of(state: DataFrame) -> DataFrame:
    """(column, count, mean, std (ddof 1), min, max): what describe needs beside quantiles."""
    return state.select("column", F.col("n").alias("count"), "mean", _std().alias("std"),
                        F.col("mn").alias("min"), F.col("mx").alias("max"))


def near_zero_of(state: DataFrame, threshold: float = NEAR_ZERO_STD) -> DataFrame:
    """Columns whose sample std is below the threshold (A10)."""
    return (state.select("column", _std().alias("std"))
            .filter(F.col("std") < F.lit(float(threshold))).orderBy("column"))


def corr_target_of(state: DataFrame) -> DataFrame:
    """(column, corr) with the label, descending; NULL where either side is constant."""
    constant = (F.col("mn_x") == F.col("mx_x")) | (F.col("mn_y") == F.col("mx_y"))
    r = F.try_divide(F.col("c_xy"), F.sqrt(F.col("m2_x")) * F.sqrt(F.col("m2_y")))
    corr = F.when(constant | (F.col("pairs") < 2), F.lit(None).cast("double")).otherwise(r)
    return state.select("column", corr.alias("corr")).orderBy(
        F.col("corr").desc_nulls_last(), F.col("column"))
