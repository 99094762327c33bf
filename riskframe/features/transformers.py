"""Feature steps as Spark ML stages (X1-X8), persistable with the pipeline.

Every stage is a native-expression projection; fitting is one or a few
aggregates whose results (medians, λ, means, levels) become literals of the
fitted model. Scoring never recomputes statistics.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import MONTH_YEAR, history_years, parse_month
from ..functions.scalar import lookup, positive_flag, standardize, yeo_johnson
from ..operators.ordered import exact_quantiles
from ..schema import COUNT_BINARY_COLUMNS, EMP_LENGTH_YEARS


class _Stage(DefaultParamsReadable, DefaultParamsWritable):
    pass


class EmpLengthConverter(Transformer, _Stage):
    """emp_length text -> emp_length_num (0-10), unknown/NULL -> NULL; drops the source."""

    inputCol = Param(Params._dummy(), "inputCol", "employment length column",
                     TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "numeric output column",
                      TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCol: str = "emp_length", outputCol: str = "emp_length_num"):
        super().__init__()
        self._setDefault(inputCol="emp_length", outputCol="emp_length_num")
        self._set(**self._input_kwargs)

    def output_columns(self, cols: list[str]) -> list[str]:
        src, dst = self.getOrDefault("inputCol"), self.getOrDefault("outputCol")
        return [c for c in cols if c != src] + [dst] if src in cols else list(cols)

    def _transform(self, df: DataFrame) -> DataFrame:
        src, dst = self.getOrDefault("inputCol"), self.getOrDefault("outputCol")
        if src not in df.columns:
            return df
        return df.withColumn(dst, lookup(src, EMP_LENGTH_YEARS, "double")).drop(src)


class CreditHistoryCalculator(Transformer, _Stage):
    """Years between the earliest credit line and the issue date.

    Text dates are parsed with the given formats (strict ``MMM-yyyy`` by
    default); DATE columns pass through. Negative -> 0, NULL -> 0. Both sources
    dropped. If either column is absent: constant 0 and nothing dropped.
    """

    issueCol = Param(Params._dummy(), "issueCol", "issue date column", TypeConverters.toString)
    earliestCol = Param(Params._dummy(), "earliestCol", "earliest credit line column",
                        TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "output column", TypeConverters.toString)
    dateFormats = Param(Params._dummy(), "dateFormats", "formats tried in order",
                        TypeConverters.toListString)

    @keyword_only
    def __init__(self, issueCol: str = "issue_d", earliestCol: str = "earliest_cr_line",
                 outputCol: str = "credit_hist_years", dateFormats: list[str] | None = None):
        super().__init__()
        self._setDefault(issueCol="issue_d", earliestCol="earliest_cr_line",
                         outputCol="credit_hist_years", dateFormats=[MONTH_YEAR])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def output_columns(self, cols: list[str]) -> list[str]:
        a, b, out = (self.getOrDefault(p) for p in ("issueCol", "earliestCol", "outputCol"))
        kept = [c for c in cols if not (a in cols and b in cols and c in (a, b))]
        return kept + ([out] if out not in kept else [])

    def _transform(self, df: DataFrame) -> DataFrame:
        a, b, out = (self.getOrDefault(p) for p in ("issueCol", "earliestCol", "outputCol"))
        if a not in df.columns or b not in df.columns:
            return df.withColumn(out, F.lit(0.0))
        fmts = tuple(self.getOrDefault("dateFormats"))

        def as_date(c: str):
            t = df.schema[c].dataType.simpleString()
            return F.col(c).cast("date") if t in ("date", "timestamp", "timestamp_ntz") \
                else parse_month(c, fmts)

        issue, earliest = as_date(a), as_date(b)
        if any("yyyy" not in f and "yy" in f for f in fmts):
            # Two-digit years pivot into 2000-2099: a first credit line dated after
            # the issue date belongs to the previous century (Feb-88 -> 1988).
            earliest = F.when(earliest > issue, F.add_months(earliest, -1200)).otherwise(earliest)
        return df.withColumn(out, history_years(issue, earliest)).drop(a, b)


class CountBinarizer(Transformer, _Stage):
    """``{c}_binary`` = 1 when c parses as a number > 0 else 0; drops c; absent c -> 0."""

    columns = Param(Params._dummy(), "columns", "count columns", TypeConverters.toListString)

    @keyword_only
    def __init__(self, columns: list[str] | None = None):
        super().__init__()
        self._setDefault(columns=list(COUNT_BINARY_COLUMNS))
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def output_columns(self, cols: list[str]) -> list[str]:
        out = list(cols)
        for c in self.getOrDefault("columns"):
            if c in out:
                out.remove(c)
            if f"{c}_binary" not in out:
                out.append(f"{c}_binary")
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        present = [c for c in self.getOrDefault("columns") if c in df.columns]
        new = {f"{c}_binary": (positive_flag(c) if c in present else F.lit(0))
               for c in self.getOrDefault("columns")}
        return df.withColumns(new).drop(*present)


def feature_names_out(stages: list, input_cols: list[str]) -> list[str]:
    """Output column names after the engineering stages, in order."""
    cols = list(input_cols)
    for s in stages:
        cols = s.output_columns(cols)
    return cols


# --- fitted numeric scalers ---------------------------------------------------
class _ColsParams(Params):
    inputCols = Param(Params._dummy(), "inputCols", "columns", TypeConverters.toListString)

    def cols(self) -> list[str]:
        return list(self.getOrDefault("inputCols"))


class _NumericModel(Model, _ColsParams, _Stage):
    """Applies median fill -> optional Yeo-Johnson(λ) -> (x - mean) / std, in place."""

    medians = Param(Params._dummy(), "medians", "fill values", TypeConverters.toListFloat)
    lambdas = Param(Params._dummy(), "lambdas", "Yeo-Johnson λ per column (empty: none)",
                    TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "centres", TypeConverters.toListFloat)
    stds = Param(Params._dummy(), "stds", "population std", TypeConverters.toListFloat)

    def __init__(self):
        super().__init__()
        self._setDefault(inputCols=[], medians=[], lambdas=[], means=[], stds=[])

    def expressions(self) -> dict:
        cols = self.cols()
        med, lam = self.getOrDefault("medians"), self.getOrDefault("lambdas")
        mu, sd = self.getOrDefault("means"), self.getOrDefault("stds")
        out = {}
        for i, c in enumerate(cols):
            x = F.coalesce(F.col(c).cast("double"), F.lit(float(med[i])))
            if lam:
                x = yeo_johnson(x, lam[i])
            out[c] = standardize(x, mu[i], sd[i])
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(self.expressions())


def _nan_to_zero(v) -> float:
    return 0.0 if v is None or (isinstance(v, float) and math.isnan(v)) else float(v)


def fit_medians(df: DataFrame, cols: list[str]) -> list[float]:
    """Exact medians (all columns in one distributed job); all-NULL column -> 0."""
    if not cols:
        return []
    got = {r["column"]: r["value"] for r in exact_quantiles(df, cols, [0.5]).collect()}
    return [_nan_to_zero(got.get(c)) for c in cols]


def _moments_after(df: DataFrame, exprs: dict) -> tuple[list[float], list[float]]:
    """Mean and population std of each expression, as one long-form grouped aggregate."""
    from ..operators.ordered import unpivot_values
    cols = list(exprs)
    if not cols:
        return [], []
    names = [f"__e{i}" for i in range(len(cols))]
    long = unpivot_values(df.select(*[e.alias(n) for n, e in zip(names, exprs.values())]), names,
                          drop_nulls=False)
    got = {r["column"]: r for r in long.groupBy("column").agg(
        F.avg("value").alias("m"), F.stddev_pop("value").alias("s")).collect()}
    return ([_nan_to_zero(got[n]["m"]) if n in got else 0.0 for n in names],
            [_nan_to_zero(got[n]["s"]) if n in got else 0.0 for n in names])


class StandardNumericScaler(Estimator, _ColsParams, _Stage):
    """Median imputation then standardisation with the population std."""

    @keyword_only
    def __init__(self, inputCols: list[str] | None = None):
        super().__init__()
        self._setDefault(inputCols=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> "NumericScalerModel":
        cols = self.cols()
        med = fit_medians(df, cols)
        filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in zip(cols, med)}
        mu, sd = _moments_after(df, filled)
        return NumericScalerModel()._set(inputCols=cols, medians=med, lambdas=[], means=mu,
                                         stds=sd)


class NumericScalerModel(_NumericModel):
    pass


# Yeo-Johnson λ search: points of the first scan and precision.
YJ_FIRST = tuple(-2.0 + 0.5 * k for k in range(9))
YJ_TOLERANCE = 1e-5
# Spreads below this share of the mean are rounding errors of the map, not data.
YJ_ROUNDING = 1e-10
# Cells of a column's sign(x) ln(1 + |x|), and the powers of the distance to a cell's centre that
# are summed. With |λ| (or |2 − λ|) times a cell's width up to YJ_REACH the terms left out are
# below 1 / 17! of what is summed.
YJ_CELLS = 512
YJ_POWERS = 16
YJ_REACH = 1.0


def fit_yeo_johnson_lambdas(df: DataFrame, cols: list[str],
                            tolerance: float = YJ_TOLERANCE) -> list[float]:
    """Maximum-likelihood λ per column, all columns per scan (X5); see :func:`search_lambdas`."""
    return search_lambdas(df, cols, tolerance)[0]


def search_lambdas(df: DataFrame, cols: list[str],
                   tolerance: float = YJ_TOLERANCE) -> tuple[list[float], int]:
    """(λ per column, number of scans): Newton steps kept inside a bracket.

    log L(λ) = −n/2·ln(var_pop(y_λ)) + (λ−1)·Σ sign(x)·ln(1+|x|). Two scans sum every column
    into cells (:func:`_power_cells`), from which it and its derivatives follow at any λ within
    the cells' reach; a column with a λ beyond it is scanned at that step. The first step looks at
    [-2, 2]; a column whose best point is an end goes outwards by doubling steps, whose unit is
    one over the spread of its ln(1 + |x|), so that no λ is too far. Once the slope changes
    sign between two points, the next ones lie around the Newton (or secant) point between them.
    In both directions the likelihood falls, or the map overflows or loses its spread, which
    scores −inf. A column without spread keeps λ = 1.
    """
    if not cols:
        return [], 0
    # Several scans: persist only the columns involved (spills to disk if needed; recomputed
    # from lineage if an executor is lost).
    df = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).persist()
    try:
        best = {c: 1.0 for c in cols}
        points = {c: list(YJ_FIRST) for c in cols}
        seen: dict[str, list[_Likelihood]] = {c: [] for c in cols}
        cells = _power_cells(df, cols)
        scans, second = 2, False
        while points:
            got = {c: cells[c].slopes(p) for c, p in points.items()
                   if c in cells and cells[c].reaches(p)}
            far = {c: p for c, p in points.items() if c not in got}
            if far:
                scans += 1
                got |= {r["column"]: r for r in _slopes(df, far, second).collect()}
            for c in list(points):
                found = _evaluated(got.get(c), points[c], second)
                seen[c] = sorted(seen[c] + found, key=lambda p: p.lam)
                best[c], points[c] = _next_points(
                    seen[c], got[c]["s"] if c in got else None, tolerance)
                if not points[c]:
                    del points[c]
            second = True
        return [best[c] for c in cols], scans
    finally:
        df.unpersist()


class _Likelihood:
    """Value, slope and (where known) curvature of the log-likelihood at one λ."""

    def __init__(self, lam: float, value: float, slope: float | None, curve: float | None):
        self.lam, self.value, self.slope, self.curve = lam, value, slope, curve

    @property
    def newton(self) -> float | None:
        if self.slope is None or self.curve is None or self.curve >= 0:
            return None
        return self.lam - self.slope / self.curve


def _power_cells(df: DataFrame, cols: list[str]) -> dict[str, "_PowerCells"]:
    """Columns summed into cells of s = sign(x) ln(1 + |x|), by two scans.

    Per column at most ``YJ_CELLS`` cells of equal width over its range, apart for negative x, with
    the sums of the powers of the distance to the cell's centre in widths. A column without
    values or with an infinite one has none.
    """
    from ..operators.ordered import bounded_broadcast, unpivot_values
    x = F.col("value")
    long = unpivot_values(df, cols).withColumn("s", F.signum(x) * F.log1p(F.abs(x)))
    ranges = [r for r in long.groupBy("column").agg(
        F.min("s").alias("lo"), F.max("s").alias("hi")).collect()
        if math.isfinite(r["lo"]) and math.isfinite(r["hi"])]
    if not ranges:
        return {}
    # A constant is in one cell without width.
    width = {r["column"]: max((r["hi"] - r["lo"]) / YJ_CELLS, 1e-300) for r in ranges}
    edges = df.sparkSession.createDataFrame(
        [(r["column"], r["lo"], width[r["column"]]) for r in ranges],
        "column string, lo double, width double")
    away = (F.col("s") - F.col("lo")) / F.col("width")
    powers = [F.col("t")]
    for k in range(2, YJ_POWERS + 1):  # products of halves, which code generation shares
        powers.append(powers[k // 2 - 1] * powers[k - k // 2 - 1])
    sums = (long.join(bounded_broadcast(edges, len(ranges)), "column")
            .withColumn("cell", F.least(F.floor(away), F.lit(YJ_CELLS - 1)))
            .withColumn("t", away - F.col("cell") - 0.5)
            .groupBy("column", "cell", (x < 0).alias("negative"))
            .agg(F.array(F.count(F.lit(1)).cast("double"), *[F.sum(p) for p in powers]).alias("m")))
    rows: dict[str, list] = {r["column"]: [] for r in ranges}
    for r in sums.collect():
        rows[r["column"]].append(r)
    return {r["column"]: _PowerCells(r["lo"], width[r["column"]], rows[r["column"]])
            for r in ranges}


class _PowerCells:
    """Mean and spread of a column's mapped values, at any λ in reach, from its cells.

    Within a cell of centre c the map and its derivatives by λ are power series of t = L − c with
    L = ln(1 + |x|): their derivatives by L are e^{κL}, L e^{κL} and L² e^{κL}, κ = λ (2 − λ for
    x < 0). Distances to the centre are summed apart from the centres' own, so nothing cancels.
    """

    def __init__(self, lo: float, width: float, rows: list):
        rows = sorted(rows, key=lambda r: (r["negative"], r["cell"]))  # sums in one order
        self.width = width
        self.sign = np.array([-1.0 if r["negative"] else 1.0 for r in rows])
        centre = lo + (np.array([r["cell"] for r in rows]) + 0.5) * width
        self.c = self.sign * centre
        # Powers of t, which runs against s for negative x.
        self.m = np.array([r["m"] for r in rows]).T
        self.m[1::2] *= self.sign
        self.n = self.m[0].sum()
        mean, var, _ = self._together(*[(centre, [self.sign * width])] * 2)
        self.t, self.s = mean * self.n, math.sqrt(max(var, 0.0))

    def reaches(self, lams: list[float]) -> bool:
        return max(max(abs(v), abs(2.0 - v)) if (self.sign < 0).any() else abs(v)
                   for v in lams) * self.width <= YJ_REACH

    def slopes(self, lams: list[float]) -> dict:
        """What :func:`_slopes` returns of the column."""
        with np.errstate(all="ignore"):  # a map that overflows has no likelihood
            return {"n": int(self.n), "t": self.t, "s": self.s, "at": [self._at(v) for v in lams]}

    def _at(self, lam: float) -> dict:
        y, y1, y2 = self._series(lam)
        mean, var, _ = self._together(y, y)
        return {"mean": mean, "var": var, "c1": self._together(y, y1)[2],
                "v1": self._together(y1, y1)[1], "c2": self._together(y, y2)[2]}

    def _series(self, lam: float) -> list[tuple]:
        """(value at the centre, coefficients of t, t², ... in widths) of the map and its two
        derivatives, per cell."""
        c, sign = self.c, self.sign
        kappa = np.where(sign > 0, lam, 2.0 - lam)
        z = kappa * c
        near, e = np.abs(z) < 0.1, np.exp(z)
        safe = np.where(near, 1.0, z)

        def closed(first: int, far):
            p = np.zeros(len(c))
            for j in range(8, -1, -1):
                p = p * z + 1.0 / (math.factorial(j) * (j + first))
            return np.where(near, p, far)

        at = [sign * c * closed(1, np.expm1(z) / safe),
              c * c * closed(2, (e * (z - 1.0) + 1.0) / (safe * safe)),
              sign * c ** 3 * closed(3, (e * (z * z - 2.0 * z + 2.0) - 2.0) / safe ** 3)]
        power = [kappa ** k / math.factorial(k) for k in range(YJ_POWERS)]
        before = [0.0, 0.0, *power]  # shifted by two
        slopes = [[sign * p for p in power],
                  [c * power[k] + before[k + 1] for k in range(YJ_POWERS)],
                  [sign * (c * c * power[k] + 2.0 * c * before[k + 1] + before[k])
                   for k in range(YJ_POWERS)]]
        return [(a, [e * p[k] * self.width ** (k + 1) / (k + 1) for k in range(YJ_POWERS)])
                for a, p in zip(at, slopes)]

    def _together(self, a: tuple, b: tuple) -> tuple[float, float, float]:
        """(mean of a, variance of a, covariance of a and b)."""
        n, m = self.n, self.m

        def sums(p):  # of the distances to the mean of the centres' values
            base = (m[0] * p[0]).sum() / n
            d = p[0] - base
            inner = sum(q * m[k] for k, q in enumerate(p[1], 1))
            return base, d, inner, (m[0] * d + inner).sum() / n

        def product(p, q, dp, dq, ip, iq):
            inner = sum(x * y * m[j + k] for j, x in enumerate(p[1], 1)
                        for k, y in enumerate(q[1], 1) if j + k <= YJ_POWERS)
            return (m[0] * dp * dq + dp * iq + dq * ip + inner).sum() / n

        base, d, inner, off = sums(a)
        var = product(a, a, d, d, inner, inner) - off * off
        if a is b:
            return base + off, var, var
        _, d2, inner2, off2 = sums(b)
        return base + off, var, product(a, b, d, d2, inner, inner2) - off * off2


def _map_terms(x: Column, lam: Column) -> tuple[Column, Column, Column]:
    """The Yeo-Johnson map and its first two derivatives by λ.

    With L = ln(1 + |x|) and z = λL (or (2 − λ)L for x < 0) they are ±L f(z), L² f'(z) and
    ±L³ f''(z) of f(z) = (e^z − 1) / z; near 0 by their power series.
    """
    length = F.log1p(F.abs(x))
    z = F.when(x >= 0, lam).otherwise(F.lit(2.0) - lam) * length
    sign, e, near = F.when(x >= 0, 1.0).otherwise(-1.0), F.exp(z), F.abs(z) < 0.1

    def series(first: int) -> Column:
        out = F.lit(0.0)
        for j in range(8, -1, -1):  # sum of z^j / (j! (j + first))
            out = out * z + F.lit(1.0 / (math.factorial(j) * (j + first)))
        return out

    f0 = F.when(near, series(1)).otherwise((e - 1.0) / z)
    f1 = F.when(near, series(2)).otherwise((e * (z - 1.0) + 1.0) / (z * z))
    f2 = F.when(near, series(3)).otherwise((e * (z * z - 2.0 * z + 2.0) - 2.0) / (z * z * z))
    return sign * length * f0, length * length * f1, sign * length * length * length * f2


def _slopes(df: DataFrame, points: dict[str, list[float]], second: bool) -> DataFrame:
    """(column, n, t, s, at): per λ of its points the mean and variance of the mapped values and
    their covariances with the derivatives. Every value carries its column's points."""
    width = max(len(p) for p in points.values())
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("value"),
                 F.array(*[F.lit(float(v)) for v in p + p[-1:] * (width - len(p))]).alias("lams"))
        for c, p in points.items()]))).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    x = F.col("value")
    ln = F.signum(x) * F.log1p(F.abs(x))
    at = []
    for k in range(width):
        y, y1, y2 = _map_terms(x, F.get("lams", F.lit(k)))
        at.append(F.struct(
            F.avg(y).alias("mean"), F.var_pop(y).alias("var"), F.covar_pop(y, y1).alias("c1"),
            *([F.var_pop(y1).alias("v1"), F.covar_pop(y, y2).alias("c2")] if second else [])))
    return long.groupBy("column").agg(F.count(x).alias("n"), F.sum(ln).alias("t"),
                                      F.stddev_pop(ln).alias("s"), F.array(*at).alias("at"))


def _evaluated(row, lams: list[float], second: bool) -> list[_Likelihood]:
    out = []
    for i, lam in enumerate(lams):
        at = row["at"][i] if row and row["n"] > 1 else None
        var = at["var"] if at else None
        if var is None or not math.isfinite(var) or not math.isfinite(at["mean"]) \
                or var <= (YJ_ROUNDING * at["mean"]) ** 2:
            out.append(_Likelihood(lam, -math.inf, None, None))
            continue
        n = row["n"]
        slope = -n * at["c1"] / var + row["t"]
        curve = None
        if second and math.isfinite(at["v1"]) and math.isfinite(at["c2"]):
            curve = -n * ((at["v1"] + at["c2"]) / var - 2.0 * (at["c1"] / var) ** 2)
        out.append(_Likelihood(lam, -n / 2.0 * math.log(var) + (lam - 1.0) * row["t"],
                               slope if math.isfinite(slope) else None, curve))
    return out


def _next_points(seen: list[_Likelihood], spread: float | None, tolerance: float
                 ) -> tuple[float, list[float]]:
    """(best λ so far, points of the next scan; none: done) from all points in order of λ."""
    k = max(range(len(seen)), key=lambda i: (seen[i].value, -abs(seen[i].lam - 1.0)))
    top = seen[k]
    if top.value == -math.inf:
        return 1.0, []
    enough = tolerance * max(1.0, abs(top.lam))
    up = top.slope is not None and top.slope > 0
    if k == (len(seen) - 1 if up else 0) and top.slope:
        # The likelihood still rises at the end: outwards, in units of the column's own scale.
        unit = max(1.0 / spread if spread else 1.0, seen[-1].lam - seen[0].lam)
        return top.lam, [top.lam + (1 if up else -1) * unit * 2.0 ** j for j in range(-4, 4)]
    other = seen[k + 1] if up else seen[k - 1]
    lo, hi = min(top.lam, other.lam), max(top.lam, other.lam)
    guess = top.newton
    if guess is not None and lo <= guess <= hi and abs(guess - top.lam) <= enough:
        return guess, []
    if hi - lo <= enough or top.slope == 0:
        return top.lam, []
    if guess is None or not lo < guess < hi:
        guess = lo + (hi - lo) / 2
        if top.slope is not None and other.slope is not None and top.slope * other.slope < 0:
            guess = top.lam + (other.lam - top.lam) * top.slope / (top.slope - other.slope)
    wide = hi - lo
    near = [guess + wide * f for f in (-1 / 8, -1 / 100, 0, 1 / 100, 1 / 8)]
    inside = sorted({p for p in near if lo < p < hi})
    return top.lam, inside or [lo + wide / 2]


def yeo_johnson_likelihoods(df: DataFrame, lams: dict[str, list[float]]) -> DataFrame:
    """(column, n, t, v): per column, the variances ``v`` after the map at each λ of its grid.

    Long form: every value carries its column's grid as an array, so one grouped
    aggregate with as many variances as grid points serves any number of columns.
    """
    grid = len(next(iter(lams.values())))
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"),
                 F.array(*[F.lit(float(v)) for v in ls]).alias("lams"))
        for c, ls in lams.items()]))).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    x = F.col("value")
    return long.groupBy("column").agg(
        F.count(x).alias("n"), F.sum(F.signum(x) * F.log1p(F.abs(x))).alias("t"),
        F.array(*[_spread(yeo_johnson(x, F.get("lams", F.lit(k)))) for k in range(grid)])
        .alias("v"))


def _spread(y) -> Column:
    """Population variance; 0 where it drowns in the rounding of nearly equal values."""
    var, mean = F.var_pop(y), F.avg(y)
    return F.when(var > F.pow(F.lit(YJ_ROUNDING) * mean, F.lit(2.0)), var).otherwise(F.lit(0.0))


class SkewedNumericScaler(Estimator, _ColsParams, _Stage):
    """Median imputation -> Yeo-Johnson (λ by max likelihood) -> standardisation."""

    @keyword_only
    def __init__(self, inputCols: list[str] | None = None):
        super().__init__()
        self._setDefault(inputCols=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> NumericScalerModel:
        cols = self.cols()
        med = fit_medians(df, cols)
        filled = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m))
                                 for c, m in zip(cols, med)})
        lams = fit_yeo_johnson_lambdas(filled, cols)
        mu, sd = _moments_after(filled, {c: yeo_johnson(c, lam) for c, lam in zip(cols, lams)})
        return NumericScalerModel()._set(inputCols=cols, medians=med, lambdas=lams, means=mu,
                                         stds=sd)


# --- categorical --------------------------------------------------------------
def fit_modes(df: DataFrame, cols: list[str]) -> list[str | None]:
    """Most frequent value per column, smallest on ties (distributed, see profile.impute_mode)."""
    from ..operators.profile import impute_mode
    if not cols:
        return []
    got = {r["column"]: r["mode"] for r in impute_mode(df, cols).collect()}
    return [got.get(c) for c in cols]


class ModeImputer(Estimator, _ColsParams, _Stage):
    """Fill NULL text with the training mode (categorical SimpleImputer)."""

    @keyword_only
    def __init__(self, inputCols: list[str] | None = None):
        super().__init__()
        self._setDefault(inputCols=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> "ModeImputerModel":
        cols = self.cols()
        return ModeImputerModel()._set(inputCols=cols,
                                       modes=[m if m is not None else "" for m in fit_modes(df, cols)])


class ModeImputerModel(Model, _ColsParams, _Stage):
    modes = Param(Params._dummy(), "modes", "fill values", TypeConverters.toListString)

    def __init__(self):
        super().__init__()
        self._setDefault(inputCols=[], modes=[])

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(m))
                               for c, m in zip(self.cols(), self.getOrDefault("modes"))})


class OrdinalLevelEncoder(Estimator, _ColsParams, _Stage):
    """Mode fill, then the index of the value in the ordered training levels; unknown -1."""

    @keyword_only
    def __init__(self, inputCols: list[str] | None = None):
        super().__init__()
        self._setDefault(inputCols=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> "OrdinalLevelModel":
        from ..operators.profile import ordinal_levels
        cols = self.cols()
        lv = ordinal_levels(df, cols).collect()     # bounded by the vocabulary
        levels = [[r["level"] for r in lv if r["column"] == c] for c in cols]
        modes = [m if m is not None else "" for m in fit_modes(df, cols)]
        return OrdinalLevelModel()._set(inputCols=cols, modes=modes,
                                        levels=["\u0001".join(x) for x in levels])


class OrdinalLevelModel(Model, _ColsParams, _Stage):
    modes = Param(Params._dummy(), "modes", "fill values", TypeConverters.toListString)
    levels = Param(Params._dummy(), "levels", "ordered levels per column (\\x01-joined)",
                   TypeConverters.toListString)

    def __init__(self):
        super().__init__()
        self._setDefault(inputCols=[], modes=[], levels=[])

    def level_lists(self) -> list[list[str]]:
        return [s.split("\u0001") if s else [] for s in self.getOrDefault("levels")]

    def _transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c, m, lv in zip(self.cols(), self.getOrDefault("modes"), self.level_lists()):
            filled = F.coalesce(F.col(c).cast("string"), F.lit(m))
            code = lookup(filled, {v: float(i) for i, v in enumerate(lv)}, "double")
            out[c] = F.coalesce(code, F.lit(-1.0))
        return df.withColumns(out)


def one_hot_stages(cols: list[str]) -> list:
    """Mode fill -> StringIndexer(alphabetical, keep) -> OneHotEncoder(dropLast): unknown -> zeros."""
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    if not cols:
        return []
    idx = [f"{c}__idx" for c in cols]
    vec = [f"{c}__ohe" for c in cols]
    return [ModeImputer(inputCols=cols),
            StringIndexer(inputCols=cols, outputCols=idx, stringOrderType="alphabetAsc",
                          handleInvalid="keep"),
            # The indexer's metadata already lists the unknown slot last; dropLast
            # removes exactly that slot, so unseen levels encode as all zeros.
            OneHotEncoder(inputCols=idx, outputCols=vec, dropLast=True, handleInvalid="error")]
