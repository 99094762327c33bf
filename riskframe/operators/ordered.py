"""Ordered statistics without a single-task funnel: prefix sums and exact quantiles.

``Window.orderBy`` without a partition key and the ``percentile`` aggregate both
end in ONE task holding every distinct value. At 100 TB that task is the job.

Prefix sums (:func:`cumulative_sums`):

1. aggregate to distinct ``(group, value)`` rows (map-side combine first);
2. cut the order column into contiguous buckets of about ``rows_per_bucket`` rows at
   approximate quantiles (``percentile_approx``: a bounded, mergeable sketch): the first
   level over all rows (``Bucketizer``, a JVM binary search), further levels inside each
   bucket, until the buckets are small enough for one task;
3. per-bucket totals form a small table (groups x buckets); their running offsets come
   from a window over that small table;
4. a window partitioned by ``(group, bucket)`` adds the offset to the in-bucket running sum.

A hot value is a single distinct row, so skew cannot overload a bucket. The
results are exact; the sketch only decides where buckets are cut.

Quantiles (:func:`exact_quantiles`) do not shuffle all distinct values: a sketch gives for
every wanted rank a bracket of values around it; one more pass counts the values below each
bracket and groups those inside it, about one in a hundred; prefix sums pick the rank.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Broadcast guard: tables built here (cut points, per-bucket offsets, quantile
# targets) are broadcast only when their row count, known by construction, is
# below this bound; above it they are joined with a shuffle.
MAX_BROADCAST_ROWS = 2_000_000
DEFAULT_ROWS_PER_BUCKET = 1_000_000


def bounded_broadcast(df: DataFrame, bound_rows: int) -> DataFrame:
    """Broadcast a side whose row count is bounded by construction (checked)."""
    return F.broadcast(df) if bound_rows <= MAX_BROADCAST_ROWS else df


# Cuts of the first level of buckets, and of each further level.
FIRST_FAN = 1024
NEXT_FAN = 64


def _clean_cuts(cuts) -> list[float]:
    return sorted({float(c) for c in (cuts or []) if c is not None and not math.isnan(c)})


def _probs(fan: int) -> list[float]:
    return [i / fan for i in range(1, fan)]


def add_buckets(df: DataFrame, order_col: str, n_buckets: int, bucket_col: str = "__bucket",
                first_fan: int = FIRST_FAN, next_fan: int = NEXT_FAN) -> DataFrame:
    """Order-contiguous bucket index from approximate quantile cut points, in levels.

    The cut points are taken over all rows, whatever the grouping: every bucket
    then holds about N / n_buckets rows in total, so each group's share of a
    bucket is bounded as well, and each group's values stay contiguous.
    """
    fan = max(1, min(first_fan, n_buckets))
    b = df.withColumn(bucket_col, F.lit(0).cast("bigint"))
    if fan > 1:
        cuts = _clean_cuts(df.agg(F.percentile_approx(order_col, _probs(fan),
                                                      max(10_000, 20 * fan)).alias("c")).first()["c"])
        splits = Bucketizer(splits=[-math.inf] + cuts + [math.inf], inputCol=order_col,
                            outputCol=bucket_col, handleInvalid="keep")
        b = splits.transform(df).withColumn(bucket_col, F.col(bucket_col).cast("bigint"))
    made = fan
    while made < n_buckets:
        fan = min(next_fan, math.ceil(n_buckets / made))
        # A row per bucket: broadcast only up to the checked bound, else joined by shuffle.
        inner = b.groupBy(bucket_col).agg(
            F.percentile_approx(order_col, _probs(fan), 100 * fan).alias("__cuts"))
        b = (b.join(bounded_broadcast(inner, made), bucket_col)
             .withColumn(bucket_col, F.col(bucket_col) * fan + F.size(
                 F.filter("__cuts", lambda c: c <= F.col(order_col))))
             .drop("__cuts"))
        made *= fan
    return b


def cumulative_sums(df: DataFrame, order_col: str, sum_cols: list[str],
                    group_cols: list[str] | None = None, descending: bool = False,
                    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET, n_rows: int | None = None,
                    first_fan: int = FIRST_FAN) -> DataFrame:
    """Inclusive running sums of ``sum_cols`` in ``order_col`` order, per group.

    ``df`` must hold one row per distinct ``(group, order_col)`` with non-null
    order values (aggregate first). Adds ``cum_<c>`` for every ``c``.
    """
    group_cols = list(group_cols or [])
    n = df.count() if n_rows is None else n_rows
    b = add_buckets(df, order_col, max(1, math.ceil(n / max(1, rows_per_bucket))),
                    first_fan=first_fan)
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    if descending:
        b = b.withColumn("__bucket", -F.col("__bucket"))
    keys = group_cols + ["__bucket"]
    totals = b.groupBy(*keys).agg(*[F.sum(c).alias(f"__t_{c}") for c in sum_cols])
    part = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy(F.lit(0))
    w_off = part.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    # At most n_groups × n_buckets rows (≤ n_buckets per window partition). The
    # join back is left to AQE, which broadcasts it after measuring its size.
    offsets = totals.select(*keys, *[F.coalesce(F.sum(f"__t_{c}").over(w_off), F.lit(0))
                                     .alias(f"__o_{c}") for c in sum_cols])
    with_off = b.join(offsets, keys, "inner")
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return with_off.select(
        *df.columns,
        *[(F.sum(c).over(w) + F.col(f"__o_{c}")).alias(f"cum_{c}") for c in sum_cols])


def with_next(df: DataFrame, order_col: str, cols: list[str], group_cols: list[str] | None = None,
              descending: bool = False, rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
              n_rows: int | None = None) -> DataFrame:
    """Adds ``next_<c>``: the values of the row that follows in order within the group (NULL for
    the last). ``df`` is as for :func:`cumulative_sums`; rows are ordered inside buckets, and the
    first row of every bucket (a small table) is carried to the bucket before it.
    """
    group_cols = list(group_cols or [])
    n = df.count() if n_rows is None else n_rows
    b = add_buckets(df, order_col, max(1, math.ceil(n / max(1, rows_per_bucket))))
    if descending:
        b = b.withColumn("__bucket", -F.col("__bucket"))
    keys = group_cols + ["__bucket"]
    first = F.max_by if descending else F.min_by
    heads = b.groupBy(*keys).agg(first(F.struct(*cols), order_col).alias("__head"))
    part = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy(F.lit(0))
    heads = heads.select(*keys, F.lead("__head").over(part.orderBy("__bucket")).alias("__after"))
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    inside = F.lead(F.struct(*cols)).over(Window.partitionBy(*keys).orderBy(order))
    got = b.join(heads, keys).withColumn("__next", F.coalesce(inside, F.col("__after")))
    return got.select(*df.columns, *[F.col("__next").getField(c).alias(f"next_{c}") for c in cols])


def unpivot_values(df: DataFrame, columns: list[str], group_cols: list[str] | None = None,
                   drop_nulls: bool = True) -> DataFrame:
    """Long ``(group..., column, value double)``; NULL and NaN removed unless asked to keep.

    Per-column statistics are computed as ``groupBy(column)`` over this long
    form: a few aggregate functions in generated code instead of one per
    column, with map-side partial aggregation (one row per column and task).
    """
    group_cols = list(group_cols or [])
    casted = df.select(*group_cols, *[F.col(c).cast("double").alias(c) for c in columns])
    long = casted.unpivot(group_cols, columns, "column", "value")
    if not drop_nulls:
        return long.withColumn("value", F.when(~F.isnan("value"), F.col("value")))
    return long.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def approx_quantiles(df: DataFrame, columns: list[str], probs: list[float],
                     group_cols: list[str] | None = None, accuracy: int = 10_000) -> DataFrame:
    """Opt-in approximate quantiles: one ``percentile_approx`` sketch pass per (group, column).

    Values are data points within rank error 1/accuracy (no interpolation);
    there is no distinct-value shuffle, so high-cardinality columns stay cheap.
    """
    group_cols = list(group_cols or [])
    keys = group_cols + ["column"]
    ps = [float(p) for p in probs]
    return (unpivot_values(df, columns, group_cols).groupBy(*keys)
            .agg(F.percentile_approx("value", ps, accuracy).alias("qs"))
            .select(*keys, F.posexplode("qs").alias("i", "value"))
            .select(*keys, F.element_at(F.array(*[F.lit(p) for p in ps]), F.col("i") + 1)
                    .alias("prob"), "value"))


# Half the width of a bracket in ranks, as a share of the rows; the sketch's own error is a
# fifth of it. Groups of fewer rows than BRACKET_ALL are bracketed by their range.
BRACKET = 0.005
BRACKET_ALL = 1_000


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float],
                    group_cols: list[str] | None = None,
                    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET) -> DataFrame:
    """Exact linear-interpolated quantiles (numpy default, SQL ``quantile_cont``).

    Returns ``(group..., column, prob, value)``; NULLs are ignored. Two passes over the
    input: a sketch per (group, column), then counts below and inside the brackets; only
    values inside a bracket are shuffled. A rank outside its bracket (the sketch failed)
    is looked for again in the whole range. All tables between the passes are written to
    the shared checkpoint folder; nothing that grows with groups or rows reaches the driver.
    """
    from ..session import cut_lineage
    group_cols = list(group_cols or [])
    keys = group_cols + ["column"]
    ps = [float(p) for p in probs]
    long = unpivot_values(df, columns, group_cols)
    ends = sorted({min(1.0, max(0.0, p + d)) for p in ps for d in (-BRACKET, BRACKET)})
    at = {e: i for i, e in enumerate(ends)}
    n, sketch = F.col("n"), F.col("sketch")
    few = n < BRACKET_ALL
    lows = [F.when(few | F.lit(p <= BRACKET), F.col("mn")).otherwise(
        sketch[at[max(0.0, p - BRACKET)]]) for p in ps]
    highs = [F.when(few | F.lit(p >= 1 - BRACKET), F.col("mx")).otherwise(
        sketch[at[min(1.0, p + BRACKET)]]) for p in ps]
    brackets = cut_lineage(long.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("mn"), F.max("value").alias("mx"),
        F.percentile_approx("value", ends, int(5 / BRACKET)).alias("sketch"))
        .select(*keys, "n", "mn", "mx", F.array(*lows).alias("lows"),
                F.array(*highs).alias("highs")))
    found = _ranks_inside(long, brackets, keys, ps, rows_per_bucket)
    missing = cut_lineage(brackets.join(
        found.groupBy(*keys).agg(F.count(F.lit(1)).alias("got")).filter(
            F.col("got") == len(ps)), keys, "left_anti"))
    if not missing.isEmpty():
        whole = missing.select(*keys, "n", "mn", "mx",
                               F.transform("lows", lambda _: F.col("mn")).alias("lows"),
                               F.transform("highs", lambda _: F.col("mx")).alias("highs"))
        found = found.join(missing.select(*keys), keys, "left_anti").unionByName(
            _ranks_inside(long, whole, keys, ps, rows_per_bucket))
    return found


def bracket_counts(long: DataFrame, brackets: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, i, value, cnt): rows of value inside bracket i, and below it with a NULL value."""
    size = brackets.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("lows")).alias("k")).first()
    # Plain comparisons per bracket: a lambda over arrays would cost each value some microseconds.
    hits = [F.when(F.col("value") <= F.col("highs")[i], F.struct(
        F.lit(i).alias("i"), F.when(F.col("value") >= F.col("lows")[i], F.col("value")).alias("value")))
        for i in range(max(1, size["k"] or 0))]
    return (long.join(bounded_broadcast(brackets.select(*keys, "lows", "highs"), size["n"]), keys)
            .select(*keys, (hits[0] if len(hits) == 1 else F.explode(F.array(*hits))).alias("hit"))
            .filter(F.col("hit").isNotNull())
            .groupBy(*keys, F.col("hit.i").alias("i"), F.col("hit.value").alias("value"))
            .agg(F.count(F.lit(1)).alias("cnt")))


def _ranks_inside(long: DataFrame, brackets: DataFrame, keys: list[str], ps: list[float],
                  rows_per_bucket: int) -> DataFrame:
    """(keys, prob, value) of the ranks that lie inside their brackets."""
    from ..session import cut_lineage
    counts = cut_lineage(bracket_counts(long, brackets, keys))
    inside = counts.filter("value IS NOT NULL")
    slot = [*keys, "i"]
    cum = cumulative_sums(inside, "value", ["cnt"], slot, rows_per_bucket=rows_per_bucket)
    below = counts.filter("value IS NULL").select(*slot, F.col("cnt").alias("below"))
    pos = (F.col("n") - 1).cast("double") * F.element_at(F.array(*[F.lit(p) for p in ps]),
                                                         F.col("i") + 1)
    targets = (brackets.select(*keys, "n", F.explode(F.sequence(F.lit(0), F.lit(len(ps) - 1)))
                               .alias("i")).join(below, slot, "left")
               .select(*slot, (pos - F.floor(pos)).alias("frac"),
                       (F.floor(pos).cast("bigint") - F.coalesce("below", F.lit(0))).alias("lo"),
                       (F.ceil(pos).cast("bigint") - F.coalesce("below", F.lit(0))).alias("hi")))
    first, last = F.col("cum_cnt") - F.col("cnt"), F.col("cum_cnt")
    is_lo = (first <= F.col("lo")) & (F.col("lo") < last)
    is_hi = (first <= F.col("hi")) & (F.col("hi") < last)
    picked = (cum.join(targets, slot).filter(is_lo | is_hi).groupBy(*slot).agg(
        F.first("frac").alias("frac"), F.max(F.when(is_lo, F.col("value"))).alias("lo_v"),
        F.max(F.when(is_hi, F.col("value"))).alias("hi_v"))
        .filter("lo_v IS NOT NULL AND hi_v IS NOT NULL"))
    return cut_lineage(picked.select(
        *keys, F.element_at(F.array(*[F.lit(p) for p in ps]), F.col("i") + 1).alias("prob"),
        (F.col("lo_v") + (F.col("hi_v") - F.col("lo_v")) * F.col("frac")).alias("value")))


def pct_name(p: float) -> str:
    return "q" + f"{p * 100:g}".replace(".", "_")


def quantiles_wide(df: DataFrame, columns: list[str], probs: list[float],
                   group_cols: list[str] | None = None, exact: bool = True) -> DataFrame:
    """Quantiles pivoted: one row per (group, column) with q25, q50, ... columns."""
    group_cols = list(group_cols or [])
    q = (exact_quantiles(df, columns, probs, group_cols) if exact
         else approx_quantiles(df, columns, probs, group_cols))
    return q.groupBy(*group_cols, "column").agg(
        *[F.max(F.when(F.col("prob") == F.lit(float(p)), F.col("value"))).alias(pct_name(p))
          for p in probs])
