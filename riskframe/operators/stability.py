"""Population stability index.

Steps (quantile edges of the expected side, widened to both sides' range,
``[a, b)`` bins, shares including values in no bin, zero share -> 1e-5,
Σ (a − e)·ln(a/e)). Work: one exact-quantile job for the edges and both sides'
ranges (probabilities 0 and 1), one grouped count per (side, bin). Nothing but
edges and bin counts reaches the driver.
"""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import psi_band
from .ordered import exact_quantiles

ZERO_SHARE = 1e-5
LAST_EDGE_PAD = 1e-8


def psi_edges(df: DataFrame, bins: int = 10, side: str = "side", value: str = "value",
              expected: str = "expected", actual: str = "actual",
              null_edges: str = "quantile") -> list[float] | None:
    """Final bin edges, or None when PSI is undefined (constant expected, < 2 bins)."""
    probs = [i / bins for i in range(bins + 1)]
    both = df.filter(F.col(side).isin(expected, actual)).select(
        F.col(side).alias("__side"), F.col(value).alias("v"))
    got = {(r["__side"], r["prob"]): float(r["value"]) for r in exact_quantiles(
        both, ["v"], probs, ["__side"]).collect()}
    e_min, e_max = got.get((expected, 0.0)), got.get((expected, 1.0))
    if e_min is None or e_min == e_max:
        return None
    has_null = null_edges == "equal_width" and not both.filter(
        (F.col("__side") == expected) & F.col("v").isNull()).isEmpty()
    edges = sorted({got[expected, p] for p in probs})
    if has_null or len(edges) < 2:
        # numpy quantiles of data holding NaN collapse to one edge -> equal width.
        edges = list(np.linspace(e_min, e_max, bins + 1))
    lo, hi = (f(e, got.get((actual, p), e)) for f, e, p in ((min, e_min, 0.0), (max, e_max, 1.0)))
    final = np.unique(np.concatenate(([lo], np.asarray(edges, dtype=float), [hi])))
    final[-1] += LAST_EDGE_PAD
    if len(final) < 3:
        return None
    return [float(x) for x in final]


def bin_index(x: Column, edges: list[float]) -> Column:
    """Index i of [edges[i], edges[i+1]); NULL outside every bin or for NULL x."""
    expr = F.when(x.isNull() | (x < F.lit(edges[0])), F.lit(None).cast("int"))
    for i in range(1, len(edges)):
        expr = expr.when(x < F.lit(edges[i]), F.lit(i - 1))
    return expr.otherwise(F.lit(None).cast("int"))


def psi_table(df: DataFrame, bins: int = 10, side: str = "side", value: str = "value",
              expected: str = "expected", actual: str = "actual",
              null_edges: str = "quantile") -> DataFrame:
    """(bin, lower, upper, expected_share, actual_share, component); bin NULL = no bin.

    No rows when PSI is undefined (see :func:`psi_edges`).
    """
    edges = psi_edges(df, bins, side, value, expected, actual, null_edges)
    if edges is None:
        return df.sparkSession.createDataFrame(
            [], "bin int, lower double, upper double, expected_share double, "
                "actual_share double, component double")
    s = F.col(side)
    b = df.filter(s.isin(expected, actual)).select(
        s.alias("__side"), bin_index(F.col(value).cast("double"), edges).alias("bin"))
    counted = b.groupBy("bin").agg(F.count_if(F.col("__side") == expected).alias("e_cnt"),
                                   F.count_if(F.col("__side") == actual).alias("a_cnt"))
    rows = counted.collect()                     # a row per bin
    e_tot, a_tot = (float(sum(r[c] for r in rows)) for c in ("e_cnt", "a_cnt"))
    counts = df.sparkSession.createDataFrame(rows, counted.schema)

    def share(c: str, tot: float) -> Column:
        raw = F.col(c) / F.lit(tot) if tot > 0 else F.lit(0.0)
        return F.when(raw == 0, F.lit(ZERO_SHARE)).otherwise(raw)

    edge_arr = F.array(*[F.lit(e) for e in edges])
    out = counts.select(
        "bin",
        F.when(F.col("bin").isNotNull(), F.element_at(edge_arr, F.col("bin") + 1)).alias("lower"),
        F.when(F.col("bin").isNotNull(), F.element_at(edge_arr, F.col("bin") + 2)).alias("upper"),
        share("e_cnt", e_tot).alias("expected_share"), share("a_cnt", a_tot).alias("actual_share"))
    comp = (F.col("actual_share") - F.col("expected_share")) * F.log(
        F.col("actual_share") / F.col("expected_share"))
    return out.withColumn("component", comp).orderBy(F.col("bin").asc_nulls_last())


def psi(df: DataFrame, bins: int = 10, side: str = "side", value: str = "value",
        expected: str = "expected", actual: str = "actual",
        null_edges: str = "quantile") -> DataFrame:
    """One row: psi, number of bins used, band (E8 + F14)."""
    t = psi_table(df, bins, side, value, expected, actual, null_edges)
    return (t.agg(F.sum("component").alias("psi"),
                  F.count_if(F.col("bin").isNotNull()).cast("int").alias("n_bins"))
            .withColumn("band", psi_band("psi")))


def score_psi(scores: DataFrame, side: str = "side", score: str = "score",
              train: str = "train", test: str = "test", bins: int = 10) -> DataFrame:
    """PSI of train vs test model scores with its band."""
    frame = scores.select(
        F.when(F.col(side) == train, "expected").when(F.col(side) == test, "actual").alias("side"),
        F.col(score).cast("double").alias("value"))
    return psi(frame, bins)


def psi_value(df: DataFrame, **kw) -> float | None:
    r = psi(df, **kw).first()
    v = r["psi"]
    return None if v is None or (isinstance(v, float) and math.isnan(v)) else float(v)


# --- a kept baseline ------------------------------------------------------------------------

class PsiBaseline:
    """Quantile edges and counts of the expected side, kept so that later batches are compared
    without its rows, with the result of the two-sided :func:`psi`.

    Cells are finer than bins: ``0 .. m - 1`` between the m + 1 edges, ``m`` the largest expected
    value itself, ``m + 1`` above and ``-2`` below all edges, ``-1`` NULL and NaN. Where a batch
    reaches beyond the edges, the two-sided form has one bin more on that side; the largest
    expected value then belongs to the upper one. Counts of batches add up, so a month is the sum
    of its days.
    """

    BELOW, NULL = -2, -1

    def __init__(self, edges: list[float], counts: dict[int, int]):
        self.edges = [float(e) for e in edges]
        self.counts = {int(k): int(v) for k, v in counts.items()}

    @classmethod
    def fit(cls, df: DataFrame, value: str = "value", bins: int = 10) -> PsiBaseline | None:
        """Edges by exact quantiles of the values there are; None for a constant or no value."""
        values = df.select(F.col(value).cast("double").alias("v"))
        got = exact_quantiles(values, ["v"], [i / bins for i in range(bins + 1)]).collect()
        edges = sorted({float(r["value"]) for r in got})
        if len(edges) < 2:
            return None
        counts = cls(edges, {}).counts_of(values, "v").collect()  # a row per cell
        return cls(edges, {r["cell"]: r["n"] for r in counts})

    def counts_of(self, df: DataFrame, value: str = "value", group_cols: tuple[str, ...] = ()
                  ) -> DataFrame:
        """(group..., cell, n) of a batch: one aggregate, and the part that is kept and added."""
        x, m = F.col(value).cast("double"), len(self.edges) - 1
        cell = F.when(x.isNull() | F.isnan(x), self.NULL).when(x < F.lit(self.edges[0]), self.BELOW)
        for i, e in enumerate(self.edges[1:]):
            cell = cell.when(x < F.lit(e), i)
        cell = cell.when(x == F.lit(self.edges[-1]), m).otherwise(m + 1)
        return df.select(*group_cols, cell.cast("int").alias("cell")).groupBy(
            *group_cols, "cell").agg(F.count(F.lit(1)).alias("n"))

    def compare(self, counts: DataFrame, group_cols: tuple[str, ...] = ()) -> DataFrame:
        """(group..., psi, n_bins, n_rows, band) per group of a table of counts."""
        m, total = len(self.edges) - 1, sum(self.counts.values())
        wide = counts.groupBy(*group_cols).agg(*[
            F.coalesce(F.sum(F.when(F.col("cell") == c, F.col("n"))), F.lit(0)).alias(f"__{i}")
            for i, c in enumerate([self.NULL, self.BELOW, *range(m + 2)])],
            F.sum("n").alias("n_rows"))
        a = {c: F.col(f"__{i}") for i, c in enumerate([self.NULL, self.BELOW, *range(m + 2)])}
        e = {c: self.counts.get(c, 0) for c in a}
        top, over = a[m + 1] > 0, [F.lit(e[c]) for c in (m - 1, m)]
        # (expected, actual) per bin; a bin that neither side has adds nothing.
        pairs = [(F.lit(e[c]), a[c]) for c in (self.NULL, self.BELOW, *range(m - 1))]
        pairs += [(F.when(top, over[0]).otherwise(over[0] + over[1]),
                   F.when(top, a[m - 1]).otherwise(a[m - 1] + a[m])),
                  (F.when(top, over[1]).otherwise(F.lit(0)),
                   F.when(top, a[m] + a[m + 1]).otherwise(F.lit(0)))]

        def share(n: Column, of: Column) -> Column:
            return F.when(n == 0, F.lit(ZERO_SHARE)).otherwise(n / of)

        psi_sum = F.lit(0.0)
        for ex, ac in pairs:
            es, as_ = share(ex, F.lit(float(total))), share(ac, F.col("n_rows"))
            psi_sum = psi_sum + F.when((ex == 0) & (ac == 0), F.lit(0.0)).otherwise(
                (as_ - es) * F.log(as_ / es))
        n_bins = F.lit(m) + top.cast("int") + (a[self.BELOW] > 0).cast("int")
        filled = [((ex > 0) | (ac > 0)).cast("int") for ex, ac in pairs[1:]]
        used = F.lit(0)
        for f in filled:
            used = used + f
        return wide.select(*group_cols, F.when(n_bins > 1, psi_sum).alias("psi"),
                           F.when(n_bins > 1, used).otherwise(F.lit(0)).alias("n_bins"),
                           "n_rows").withColumn("band", psi_band("psi"))

    def save(self, spark, path: str) -> None:
        """Written as a small text folder, beside a saved Scorer for instance."""
        text = json.dumps({"edges": self.edges, "counts": self.counts})
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode(
            "overwrite").text(path)

    @classmethod
    def load(cls, spark, path: str) -> PsiBaseline:
        return cls(**json.loads(spark.read.text(path).first()["value"]))
