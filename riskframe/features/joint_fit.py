"""All preprocessing statistics in a few shared scans (X5-X9), as fitted stages.

The stages of a FeaturePlan fitted one by one scan the training rows again and again: medians per
scaler, means per scaler, modes and levels per encoder. Here one exact-quantile job gives all
medians; counts, means and spreads before imputation come from one column state and are moved to
what they are after it; one table of counts gives the modes and levels of all categories; the λ
search and the moments of the mapped columns are the only further scans.
"""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import yeo_johnson
from ..operators.column_state import column_state
from ..operators.profile import category_counts
from ..plans.feature_plan import FEATURES_COL, FeaturePlan
from .transformers import (ModeImputerModel, NumericScalerModel, OrdinalLevelModel, _moments_after,
                           fit_medians, fit_yeo_johnson_lambdas, one_hot_stages)

#: More levels than this make no indicator columns: the fit raises and names the column.
MOST_LEVELS = 100_000


def moments_after_filling(df: DataFrame, medians: dict[str, float]) -> dict[str, tuple[float, float]]:
    """Mean and population std of every column once its nulls are the median, from the state of
    the values there are: the filled rows move mean and spread by closed formulas."""
    out = {c: (m, 0.0) for c, m in medians.items()}  # a column without values
    for r in column_state(df, list(medians)).collect():
        n, med = r["n"], medians[r["column"]]
        filled = r["n_rows"] - n
        if not n:
            continue
        mean = r["mean"] + filled * (med - r["mean"]) / r["n_rows"]
        spread = (r["m2"] + n * (r["mean"] - mean) ** 2 + filled * (med - mean) ** 2) / r["n_rows"]
        out[r["column"]] = (mean, math.sqrt(spread))
    return out


def _level_order(column: str, level: str) -> tuple:
    if column != "sub_grade":
        return (level,)
    try:
        return level[:1], True, int(level[1:]), level
    except ValueError:
        return level[:1], False, 0, level


def categories(df: DataFrame, columns: list[str]) -> dict[str, tuple[str, list[str]]]:
    """Mode (the smallest on ties; empty text without values) and sorted levels per column, from
    one table of counts."""
    counts = category_counts(df, columns) if columns else None
    rows = counts.limit(len(columns) * MOST_LEVELS + 1).collect() if columns else []
    found: dict[str, list[tuple[int, str]]] = {c: [] for c in columns}
    for r in rows:
        found[r["column"]].append((-r["count"], r["value"]))
    most = max(found, key=lambda c: len(found[c]), default=None)
    if len(rows) > len(columns) * MOST_LEVELS or (most and len(found[most]) > MOST_LEVELS):
        raise ValueError(f"{most}: too many levels for encoding (at most {MOST_LEVELS})")
    return {c: (min(v)[1] if v else "", sorted((x for _, x in v),
                                               key=lambda x, c=c: _level_order(c, x)))
            for c, v in found.items()}


def fit_preprocessing(train: DataFrame, plan: FeaturePlan) -> list:
    """The fitted stages of ``plan``, engineering and preprocessing, equal to fitting them in turn.

    ``train`` should be persisted by the caller.
    """
    engineering = plan.engineering_stages()
    df = PipelineModel(engineering).transform(train)
    numeric = plan.skewed + plan.standard
    medians = dict(zip(numeric, fit_medians(df, numeric)))
    stages: list = []
    if plan.skewed:
        filled = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(medians[c])).alias(c)
                             for c in plan.skewed])
        lams = fit_yeo_johnson_lambdas(filled, plan.skewed)
        mu, sd = _moments_after(filled, {c: yeo_johnson(c, lam)
                                         for c, lam in zip(plan.skewed, lams)})
        stages.append(NumericScalerModel()._set(
            inputCols=plan.skewed, medians=[medians[c] for c in plan.skewed], lambdas=lams,
            means=mu, stds=sd))
    if plan.standard:
        got = moments_after_filling(df, {c: medians[c] for c in plan.standard})
        stages.append(NumericScalerModel()._set(
            inputCols=plan.standard, medians=[medians[c] for c in plan.standard], lambdas=[],
            means=[got[c][0] for c in plan.standard], stds=[got[c][1] for c in plan.standard]))
    known = categories(df, plan.ordinal + plan.one_hot)
    if plan.ordinal:
        stages.append(OrdinalLevelModel()._set(
            inputCols=plan.ordinal, modes=[known[c][0] for c in plan.ordinal],
            levels=["\u0001".join(known[c][1]) for c in plan.ordinal]))
    if plan.one_hot:
        # The indexer and encoder learn from a table of the levels, not from the rows.
        levels = [known[c][1] or [""] for c in plan.one_hot]
        table = df.sparkSession.createDataFrame(
            [tuple(v[i] if i < len(v) else v[0] for v in levels)
             for i in range(max(map(len, levels)))],
            ", ".join(f"`{c}` string" for c in plan.one_hot))
        filler = ModeImputerModel()._set(inputCols=plan.one_hot,
                                         modes=[known[c][0] for c in plan.one_hot])
        stages += [filler, *Pipeline(stages=one_hot_stages(plan.one_hot)[1:]).fit(table).stages]
    assembled = numeric + plan.ordinal + [f"{c}__ohe" for c in plan.one_hot]
    return [*engineering, *stages, VectorAssembler(
        inputCols=assembled, outputCol=FEATURES_COL, handleInvalid="keep")]
