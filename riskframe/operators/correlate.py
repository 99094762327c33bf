"""Pearson correlations, pairwise-complete.

``corr_target``: pairs of every column with the target in one scan (``column_state``).
``corr_matrix``: one pass for the Gram matrix of masks, centred values and squares, summed
in the JVM by a tree of tasks; k columns cost (3k)² / 2 accumulators regardless of rows.
Undefined correlations (a constant column over the pairs) are NULL, never NaN
and never an ANSI divide-by-zero error.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import HIGH_CORR_THRESHOLD
from .column_state import column_state, corr_target_of

#: Pairs whose ranges are looked at in one aggregate.
PAIRS_PER_SCAN = 200


def safe_corr(a: Column | str, b: Column | str) -> Column:
    """Pairwise-complete Pearson r; NULL when either side is constant over the pairs."""
    x = F.col(a) if isinstance(a, str) else a
    y = F.col(b) if isinstance(b, str) else b
    x, y = x.cast("double"), y.cast("double")
    both = x.isNotNull() & y.isNotNull()
    xp, yp = F.when(both, x), F.when(both, y)
    sx, sy = F.stddev_pop(xp), F.stddev_pop(yp)
    constant = (F.min(xp) == F.max(xp)) | (F.min(yp) == F.max(yp))
    r = F.try_divide(F.covar_pop(xp, yp), sx * sy)
    return F.when(constant | (F.count(xp) < 2), F.lit(None).cast("double")).otherwise(r)


def corr_target(df: DataFrame, columns: list[str], target: str = "is_bad") -> DataFrame:
    """(column, corr) of each numeric column with the target, descending."""
    return corr_target_of(column_state(df, columns, target))


def gram_sums(src: DataFrame, columns: list[str], shift: list[float]) -> np.ndarray:
    """Gram matrix of (present, value, square) of every column, 3k x 3k, summed in the JVM.

    Its blocks are all sums over the pairs that both columns have: counts, sums, squares and
    products. ``RowMatrix`` adds packed triangles by a tree of tasks; only the sum, whose size
    depends on the columns alone, reaches the driver.
    """
    from pyspark.ml.functions import array_to_vector
    from pyspark.mllib.linalg.distributed import RowMatrix
    from pyspark.mllib.util import MLUtils
    present = [F.col(c).isNotNull().cast("double") for c in columns]
    value = [F.coalesce(F.col(c) - F.lit(m), F.lit(0.0)) for c, m in zip(columns, shift)]
    rows = src.select(array_to_vector(F.array(*present, *value, *[v * v for v in value])).alias("v"))
    return RowMatrix(MLUtils.convertVectorColumnsFromML(rows, "v"), 0, 3 * len(columns)) \
        .computeGramianMatrix().toArray()


def _constant_pairs(src: DataFrame, columns: list[str], doubtful: np.ndarray) -> set[tuple[int, int]]:
    """Of the doubtful pairs (i, j): those where column i has one value over the rows with j."""
    pairs = [(int(i), int(j)) for i, j in zip(*np.nonzero(doubtful))]
    out = set()
    for at in range(0, len(pairs), PAIRS_PER_SCAN):
        part = pairs[at:at + PAIRS_PER_SCAN]
        both = [F.when(F.col(columns[j]).isNotNull(), F.col(columns[i])) for i, j in part]
        r = src.agg(*[(F.min(x) >= F.max(x)).alias(str(n)) for n, x in enumerate(both)]).first()
        out |= {pair for n, pair in enumerate(part) if r[n]}
    return out


def corr_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Long (col_x, col_y, corr) over all ordered pairs, pairwise-complete.

    One scan for means and ranges, one for the Gram matrix of centred values; pairs whose
    variance drowns in the rounding of their squares are looked at once more for their range.
    """
    k = len(columns)
    src = df.select(*[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias(
        f"c{i}") for i, c in enumerate(columns)])
    names = [f"c{i}" for i in range(k)]
    # Centre by the mean (a constant column by its value, so that it becomes exactly 0).
    st = {r["column"]: r for r in column_state(src, names).select("column", "mean", "mn", "mx")
          .collect()}
    shift = [0.0 if c not in st or st[c]["mean"] is None else
             st[c]["mn"] if st[c]["mn"] == st[c]["mx"] else st[c]["mean"] for c in names]
    g = gram_sums(src, names, shift) if k else np.zeros((0, 0))
    n, sx, sxx, sxy = g[:k, :k], g[k:2 * k, :k], g[2 * k:, :k], g[k:2 * k, k:2 * k]
    vx = n * sxx - sx * sx
    drowned = (n > 1) & (vx <= 1e-9 * n * sxx) & (sxx > 0)
    constant = (vx <= 0) | (n < 2)
    for i, j in _constant_pairs(src, names, drowned):
        constant[i, j] = True
    cov = n * sxy - sx * sx.T
    rows = []
    for i in range(k):
        for j in range(k):
            bad = constant[i, j] or constant[j, i]
            r = None if bad else cov[i, j] / (np.sqrt(vx[i, j]) * np.sqrt(vx[j, i]))
            rows.append((columns[i], columns[j], None if r is None else float(np.clip(r, -1, 1))))
    return df.sparkSession.createDataFrame(
        rows, "col_x string, col_y string, corr double").orderBy("col_x", "col_y")


def high_corr_pairs(df: DataFrame, columns: list[str], threshold: float = HIGH_CORR_THRESHOLD
                    ) -> DataFrame:
    """Unordered pairs with |r| > threshold, sorted by name."""
    m = corr_matrix(df, columns)
    return (m.filter((F.col("col_x") < F.col("col_y")) & (F.abs("corr") > F.lit(float(threshold))))
            .orderBy("col_x", "col_y"))
