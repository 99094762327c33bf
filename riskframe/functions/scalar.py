"""Scalar expression builders (P2, P11, F6, F7, F9-F14). Native Spark expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import BAD_STATUSES, GOOD_STATUSES, PSI_MINOR, PSI_STABLE


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def status_label(status: Column | str, bad=BAD_STATUSES, good=GOOD_STATUSES) -> Column:
    """loan_status -> 1 bad / 0 good / -1 anything else, NULL included."""
    s = _c(status)
    return (F.when(s.isin(*bad), F.lit(1)).when(s.isin(*good), F.lit(0))
            .otherwise(F.lit(-1)).cast("int"))


def to_number(c: Column | str) -> Column:
    """Text or number -> DOUBLE; unparsable -> NULL (F6; never raises under ANSI)."""
    return _c(c).cast("string").try_cast("double")


def positive_flag(c: Column | str) -> Column:
    """1 when the value parses as a number > 0, else 0; NULL -> 0."""
    return F.coalesce((to_number(c) > 0).cast("int"), F.lit(0))


def at_threshold(score: Column | str, threshold: float) -> Column:
    """Predicted class: score >= threshold."""
    return (_c(score) >= F.lit(float(threshold))).cast("int")


def lookup(c: Column | str, mapping: Mapping, value_type: str) -> Column:
    """Dictionary lookup, unknown or NULL key -> NULL."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    key = _c(c)
    return F.when(key.isNull(), F.lit(None)).otherwise(F.try_element_at(m, key)).cast(value_type)


def safe_div(a: Column, b: Column) -> Column:
    """a / b with NULL (not an error, not NaN) when b is 0 or NULL."""
    return F.try_divide(a, b)


def yeo_johnson(c: Column | str, lmbda: float | Column) -> Column:
    """Forward Yeo-Johnson map (F10); ``lmbda`` is a number or a per-row Column."""
    x = _c(c).cast("double")
    if not isinstance(lmbda, Column):
        lam = float(lmbda)
        eps = 1e-12
        pos = F.log1p(x) if abs(lam) < eps else \
            (F.pow(x + F.lit(1.0), F.lit(lam)) - F.lit(1.0)) / F.lit(lam)
        neg = -F.log1p(-x) if abs(lam - 2.0) < eps else \
            -(F.pow(F.lit(1.0) - x, F.lit(2.0 - lam)) - F.lit(1.0)) / F.lit(2.0 - lam)
        return F.when(x >= 0, pos).otherwise(neg)
    lam = lmbda.cast("double")
    pos = F.when(F.abs(lam) < 1e-12, F.log1p(x)).otherwise(
        (F.pow(x + F.lit(1.0), lam) - F.lit(1.0)) / lam)
    neg = F.when(F.abs(lam - F.lit(2.0)) < 1e-12, -F.log1p(-x)).otherwise(
        -(F.pow(F.lit(1.0) - x, F.lit(2.0) - lam) - F.lit(1.0)) / (F.lit(2.0) - lam))
    return F.when(x >= 0, pos).otherwise(neg)


def standardize(c: Column | str, mean: float, std: float) -> Column:
    """(x - mean) / std with population std; std 0 or undefined -> divide by 1."""
    scale = 1.0 if (std is None or std == 0.0 or std != std) else float(std)
    centre = 0.0 if (mean is None or mean != mean) else float(mean)
    return (_c(c).cast("double") - F.lit(centre)) / F.lit(scale)


def psi_band(psi: Column | str) -> Column:
    """<0.1 stable, <0.25 minor shift, else major shift; NULL/NaN -> NULL."""
    p = _c(psi)
    return (F.when(p.isNull() | F.isnan(p), F.lit(None).cast("string"))
            .when(p < PSI_STABLE, "stable").when(p < PSI_MINOR, "minor shift")
            .otherwise("major shift"))


def nan_to_null(c: Column | str) -> Column:
    """NaN -> NULL, so NULL is the single missing marker (1.2)."""
    x = _c(c)
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)
