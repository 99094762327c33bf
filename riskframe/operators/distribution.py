"""Distribution shapes per numeric column.

Histogram bin widths follow the 'auto' rule of numpy 2.3: the Freedman–Diaconis
width, but at least half the square-root rule's, and at most Sturges'; so a column
has at most about 2·√n bins. The KDE is a Gaussian kernel with Scott's factor on a
200-point grid by a fast Gauss transform: values become series of cells, map-side, and
cells add to the grid points within ``KDE_REACH`` bandwidths.
Box statistics use exact grouped quartiles.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import bounded_broadcast, pct_name, quantiles_wide, unpivot_values

KDE_GRID_POINTS = 200
KDE_REACH = 9.0   # exp(-9²/2) < 3e-18: what lies farther is below rounding
KDE_CELL = 0.5    # width of a cell in bandwidths
KDE_TERMS = 16    # terms of the kernel's series per cell


def histogram_edges(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n, lo, hi, n_bins): numpy 'auto' bin count per column (one pass + quartiles)."""
    long = unpivot_values(df, columns)
    basic = long.groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("mn"),
                                       F.max("value").alias("mx"))
    q = quantiles_wide(df, columns, [0.25, 0.75])
    n = F.col("n").cast("double")
    ptp = F.col("mx") - F.col("mn")
    iqr = F.col(pct_name(0.75)) - F.col(pct_name(0.25))
    fd = F.lit(2.0) * iqr * F.pow(n, F.lit(-1.0 / 3.0))
    sturges = ptp / (F.log2(n) + F.lit(1.0))
    half_sqrt = ptp / F.sqrt(n) / F.lit(2.0)
    width = F.least(F.greatest(fd, half_sqrt), sturges)
    n_bins = F.when(ptp == 0, F.lit(1)).otherwise(
        F.greatest(F.lit(1), F.ceil(ptp / width).cast("int")))
    lo = F.when(ptp == 0, F.col("mn") - F.lit(0.5)).otherwise(F.col("mn"))
    hi = F.when(ptp == 0, F.col("mx") + F.lit(0.5)).otherwise(F.col("mx"))
    return basic.join(q, "column").select("column", "n", lo.alias("lo"), hi.alias("hi"),
                                          n_bins.alias("n_bins"))


def histogram(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, bin, lower, upper, count) incl. empty bins; the last bin is closed."""
    # A row per column, computed once: used for the counts and for the empty bins.
    edges = _local(histogram_edges(df, columns))
    long = unpivot_values(df, columns)
    j = long.join(bounded_broadcast(edges, len(columns)), "column")
    b = F.least(F.floor((F.col("value") - F.col("lo")) * F.col("n_bins")
                        / (F.col("hi") - F.col("lo"))).cast("int"), F.col("n_bins") - 1)
    counts = j.groupBy("column", b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    # Every bin of every column, so empty bins show as 0 (bounded by the bin counts).
    grid = edges.select("column", "lo", "hi", "n_bins",
                        F.explode(F.sequence(F.lit(0), F.col("n_bins") - 1)).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / F.col("n_bins")
    return (grid.join(counts, ["column", "bin"], "left")
            .select("column", "bin", (F.col("lo") + F.col("bin") * width).alias("lower"),
                    (F.col("lo") + (F.col("bin") + 1) * width).alias("upper"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"))
            .orderBy("column", "bin"))


def _local(df: DataFrame) -> DataFrame:
    """A table of one row per column as a local frame, so that its plan runs once."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def _powers(t: Column, n: int) -> list[Column]:
    """t^0 .. t^(n - 1) as products of halves, which code generation shares."""
    out = [F.lit(1.0), t]
    for k in range(2, n):
        out.append(out[k // 2] * out[k - k // 2])
    return out[:n]


def kde_cells(df: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Per column n, range and bandwidth; per non-empty cell the sums of the powers of the
    distance to its centre in bandwidths. Both are small: no value is exploded."""
    long = unpivot_values(df, columns)
    st = _local(long.groupBy("column").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("mn"), F.max("value").alias("mx"),
        F.stddev_samp("value").alias("sd"))
        .withColumn("h", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
        # Merging the moments of parts can leave a constant column a spread of rounding.
        .filter("mn < mx AND h > 0"))
    width = F.lit(KDE_CELL) * F.col("h")
    placed = (long.join(bounded_broadcast(st.select("column", "mn", "h"), len(columns)), "column")
              .withColumn("cell", F.floor((F.col("value") - F.col("mn")) / width))
              .withColumn("t", (F.col("value") - F.col("mn") - (F.col("cell") + 0.5) * width)
                          / F.col("h")))
    cells = placed.groupBy("column", "cell").agg(F.array(*[
        F.sum(p / F.lit(float(math.factorial(k))))
        for k, p in enumerate(_powers(F.col("t"), KDE_TERMS))]).alias("sums"))
    return st, cells


def kde_curve(df: DataFrame, columns: list[str], grid_points: int = KDE_GRID_POINTS) -> DataFrame:
    """(column, point, x, density): Gaussian KDE with Scott's bandwidth on [min, max].

    A fast Gauss transform: values are summed into cells of ``KDE_CELL`` bandwidths as the first
    ``KDE_TERMS`` terms of the kernel's Hermite series around the cell's centre, and every cell
    adds its series to the grid points within ``KDE_REACH`` bandwidths. With c = KDE_CELL / 2
    and p = KDE_TERMS a value's kernel, 1 at most, is off by at most 1.09 c^p / sqrt(p!),
    below 1e-16 here. A constant column has no density and gives no rows; grid points that no
    kernel reaches have density 0.
    """
    st, cells = kde_cells(df, columns)
    h, mn = F.col("h"), F.col("mn")
    step = (F.col("mx") - mn) / F.lit(float(grid_points - 1))
    last = F.lit(grid_points - 1)
    centre = (F.col("cell") + 0.5) * F.lit(KDE_CELL) * h   # from the least value
    reach = F.lit(KDE_REACH + KDE_CELL) * h
    near = (cells.join(bounded_broadcast(st, len(columns)), "column")
            .withColumns({"lo": F.greatest(F.lit(0), F.ceil((centre - reach) / step).cast("int")),
                          "hi": F.least(last, F.floor((centre + reach) / step).cast("int"))})
            .filter("lo <= hi")
            .select("column", "sums", F.explode(F.sequence("lo", "hi")).alias("point"),
                    step.alias("step"), centre.alias("centre"), "h")
            .withColumn("u", (F.col("point") * F.col("step") - F.col("centre")) / h))
    # He(k + 1) = u He(k) - k He(k - 1), summed with the cell's terms.
    series = F.aggregate(
        F.transform("sums", lambda s, k: F.struct(k.cast("double").alias("k"), s.alias("s"))),
        F.struct(F.lit(1.0).alias("he"), F.lit(0.0).alias("before"), F.lit(0.0).alias("sum")),
        lambda a, z: F.struct((F.col("u") * a["he"] - z["k"] * a["before"]).alias("he"),
                              a["he"].alias("before"), (a["sum"] + a["he"] * z["s"]).alias("sum")),
        lambda a: a["sum"])
    kernel = F.greatest(series, F.lit(0.0)) * F.exp(F.lit(-0.5) * F.col("u") * F.col("u"))
    sums = near.groupBy("column", "point").agg(F.sum(kernel).alias("k"))
    norm = F.lit(1.0 / math.sqrt(2 * math.pi)) / (F.col("n").cast("double") * h)
    grid = st.select("column", "n", "h", "mn", step.alias("step"),
                     F.explode(F.sequence(F.lit(0), last)).alias("point"))
    return (grid.join(sums, ["column", "point"], "left")
            .select("column", "point", (mn + F.col("point") * F.col("step")).alias("x"),
                    (F.coalesce("k", F.lit(0.0)) * norm).alias("density"))
            .orderBy("column", "point"))


def box_stats(df: DataFrame, columns: list[str], by: str = "is_bad") -> DataFrame:
    """Per (class, column): quartiles, whiskers (extreme points within 1.5·IQR), outliers."""
    q = quantiles_wide(df, columns, [0.25, 0.5, 0.75], [by])
    iqr = F.col(pct_name(0.75)) - F.col(pct_name(0.25))
    q = q.select(by, "column", F.col(pct_name(0.25)).alias("q1"), F.col(pct_name(0.5)).alias("median"),
                 F.col(pct_name(0.75)).alias("q3"),
                 (F.col(pct_name(0.25)) - F.lit(1.5) * iqr).alias("lo_fence"),
                 (F.col(pct_name(0.75)) + F.lit(1.5) * iqr).alias("hi_fence"))
    long = unpivot_values(df.filter(F.col(by).isNotNull()), columns, [by])
    v = F.col("value")
    inside = (v >= F.col("lo_fence")) & (v <= F.col("hi_fence"))
    # One row per (class, column), computed once and joined back to every value: broadcast
    # behind a check of its size, so the few join keys never meet in single tasks.
    q = _local(q)
    return (long.join(bounded_broadcast(q, len(columns) * q.select(by).distinct().count()),
                      [by, "column"])
            .groupBy(by, "column")
            .agg(F.first("q1").alias("q1"), F.first("median").alias("median"),
                 F.first("q3").alias("q3"),
                 F.min(F.when(inside, v)).alias("whisker_lo"),
                 F.max(F.when(inside, v)).alias("whisker_hi"),
                 F.count_if(~inside).alias("n_outliers"), F.count(F.lit(1)).alias("n"))
            .orderBy("column", by))
