"""Binary-classifier evaluation on a ``(label, score)`` frame.

All curves come from one table: distinct scores with their positive/negative
counts, and running TP/FP in descending score order. The running sums use the
bucketed prefix sum (``ordered.cumulative_sums``), so no task ever holds all
distinct scores. AUCs are plain sums over that table; the trapezoid's previous
point is derived algebraically (cum − own) instead of with ``lag``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .ordered import DEFAULT_ROWS_PER_BUCKET, cumulative_sums


@dataclass(frozen=True)
class Totals:
    pos: int
    neg: int


class UnscoredRows(ValueError):
    """Raised when labelled rows have no score: metrics of the others would mislead."""


def score_counts(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(score, pos, neg): one row per distinct score (partial aggregation first).

    Rows without a label are left out; labelled rows without a score count under NULL.
    """
    y = F.col(label)
    return (df.filter(y.isNotNull())
            .groupBy(F.col(score).cast("double").alias("score"))
            .agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")))


def curve_table(df: DataFrame, label: str = "label", score: str = "score",
                rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET) -> tuple[DataFrame, Totals]:
    """(score, pos, neg, tp, fp) with tp/fp counted at score >= threshold."""
    # The distinct-score table feeds the totals, the bucket sizing, the cut
    # points and the running sums: write it once to the shared checkpoint
    # folder (survives executor loss, no recomputation of the scoring plan).
    counts = cut_lineage(score_counts(df, label, score))
    r = counts.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"),
                   F.count(F.lit(1)).alias("rows"),
                   F.sum(F.when(F.col("score").isNull(), F.col("pos") + F.col("neg")))
                   .alias("unscored")).first()
    if r["unscored"]:
        raise UnscoredRows(f"{r['unscored']} labelled rows have no score")
    cum = cumulative_sums(counts, "score", ["pos", "neg"], descending=True,
                          rows_per_bucket=rows_per_bucket, n_rows=r["rows"])
    return (cum.withColumnsRenamed({"cum_pos": "tp", "cum_neg": "fp"}),
            Totals(int(r["p"] or 0), int(r["n"] or 0)))


def _lit(x) -> Column:
    return F.lit(float(x))


def _precision() -> Column:
    return F.col("tp") / (F.col("tp") + F.col("fp"))


def _recall(tot: Totals) -> Column:
    # No positives at all: recall is 1 everywhere (library convention).
    return F.col("tp") / _lit(tot.pos) if tot.pos > 0 else F.lit(1.0)


def pr_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(threshold, precision, recall) per distinct score, plus the (recall 0, precision 1) anchor."""
    cum, tot = curve_table(df, label, score)
    pts = cum.select(F.col("score").alias("threshold"), _precision().alias("precision"),
                     _recall(tot).alias("recall"))
    anchor = df.sparkSession.createDataFrame([(None, 1.0, 0.0)],
                                             "threshold double, precision double, recall double")
    return pts.unionByName(anchor).orderBy(F.col("threshold").asc_nulls_last())


def roc_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, plus the (0, 0) anchor."""
    cum, tot = curve_table(df, label, score)
    fpr = F.col("fp") / _lit(tot.neg) if tot.neg > 0 else F.lit(None).cast("double")
    tpr = F.col("tp") / _lit(tot.pos) if tot.pos > 0 else F.lit(None).cast("double")
    pts = cum.select(F.col("score").alias("threshold"), fpr.alias("fpr"), tpr.alias("tpr"))
    anchor = df.sparkSession.createDataFrame([(None, 0.0, 0.0)],
                                             "threshold double, fpr double, tpr double")
    return pts.unionByName(anchor).orderBy(F.col("threshold").desc_nulls_first())


def _f1_expr(tot: Totals) -> Column:
    # 2·P·R/(P+R) = 2·TP/(TP+FP+Pos); 0/0 -> 0.
    return F.coalesce(F.try_divide(F.lit(2.0) * F.col("tp"), F.col("tp") + F.col("fp") + _lit(tot.pos)),
                      F.lit(0.0))


def f1_by_threshold(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(threshold, precision, recall, f1) for every distinct score."""
    cum, tot = curve_table(df, label, score)
    p, r = _precision(), _recall(tot)
    f1 = F.coalesce(F.try_divide(F.lit(2.0) * p * r, p + r), F.lit(0.0))
    return cum.select(F.col("score").alias("threshold"), p.alias("precision"), r.alias("recall"),
                      f1.alias("f1")).orderBy("threshold")


def curve_metrics(df: DataFrame, label: str = "label", score: str = "score",
                  rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET) -> DataFrame:
    """One row: roc_auc (ties ½), pr_auc (trapezoid over the PR curve), best F1 threshold.

    ROC AUC = Σ (n·(TP−p) + ½·p·n) / (P·N).
    PR AUC  = Σ (p/P)·(prec + prev)/2, prev = precision one distinct score up (1 at the top).
    Best F1: max of struct(f1, −threshold) -> lowest threshold on ties (E1, E2/W4, E6).
    """
    cum, tot = curve_table(df, label, score, rows_per_bucket)
    tp, fp, p, n = F.col("tp"), F.col("fp"), F.col("pos"), F.col("neg")
    prec = tp / (tp + fp)
    prev = F.coalesce(F.try_divide(tp - p, tp - p + fp - n), F.lit(1.0))
    prev = F.when(tp - p + fp - n == 0, F.lit(1.0)).otherwise(prev)
    roc = (F.sum(n * (tp - p) + F.lit(0.5) * p * n) / (_lit(tot.pos) * _lit(tot.neg))
           if tot.pos > 0 and tot.neg > 0 else F.lit(None).cast("double"))
    pr = (F.sum(p / _lit(tot.pos) * (prec + prev) / F.lit(2.0)) if tot.pos > 0
          else F.lit(None).cast("double"))
    best = F.max(F.struct(_f1_expr(tot).alias("f1"), (-F.col("score")).alias("neg_t")))
    return (cum.agg(roc.alias("roc_auc"), pr.alias("pr_auc"), best.alias("best"))
            .select("roc_auc", "pr_auc", F.col("best.f1").alias("best_f1"),
                    (-F.col("best.neg_t")).alias("best_threshold"))
            .withColumns({"n_pos": F.lit(tot.pos).cast("bigint"),
                          "n_neg": F.lit(tot.neg).cast("bigint")}))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """ROC AUC with ties worth ½; NULL for a one-class label."""
    return curve_metrics(df, label, score).select("roc_auc")


def pr_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Trapezoid area under the PR curve incl. the (0, 1) anchor."""
    return curve_metrics(df, label, score).select("pr_auc")


def confusion_counts(df: DataFrame, threshold: float, label: str = "label",
                     score: str = "score") -> DataFrame:
    """One row: tn, fp, fn, tp at ``score >= threshold``; fails on labelled rows without a score."""
    y = F.col(label)
    yhat = F.col(score) >= _lit(threshold)
    cells = {"tn": (y == 0) & ~yhat, "fp": (y == 0) & yhat, "fn": (y == 1) & ~yhat,
             "tp": (y == 1) & yhat}
    counted = df.filter(y.isNotNull()).agg(
        F.count_if(F.col(score).isNull()).alias("unscored"),
        *[F.count_if(c).alias(n) for n, c in cells.items()])
    whole = F.col("unscored") == 0
    fail = F.raise_error(F.concat(F.col("unscored").cast("string"),
                                  F.lit(" labelled rows have no score"))).cast("bigint")
    return counted.select(*[F.when(whole, F.col(n)).otherwise(fail).alias(n) for n in cells])


def confusion_matrix(df: DataFrame, threshold: float = 0.5, label: str = "label",
                     score: str = "score") -> DataFrame:
    """(actual, predicted, count): all four cells, empty ones as 0 (E5)."""
    c = confusion_counts(df, threshold, label, score)
    return c.selectExpr("stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) AS (actual, predicted, count)")


def f1_bad(df: DataFrame, threshold: float = 0.5, label: str = "label", score: str = "score"
           ) -> DataFrame:
    """F1 of class 1 at a threshold; 0 when undefined."""
    c = confusion_counts(df, threshold, label, score)
    f1 = F.coalesce(F.try_divide(F.lit(2.0) * F.col("tp"),
                                 F.lit(2.0) * F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0))
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fn")), F.lit(0.0))
    return c.select(prec.alias("precision"), rec.alias("recall"), f1.alias("f1"))


# --- fixed values: class-report row names ------------------------------------
CLASS_NAMES = ("Good Loan (0)", "Bad Loan (1)")


def classification_report(df: DataFrame, threshold: float = 0.5, label: str = "label",
                          score: str = "score", names=CLASS_NAMES) -> DataFrame:
    """Per class precision/recall/F1/support, accuracy, macro and weighted averages."""
    c = confusion_counts(df, threshold, label, score)

    def div(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    tn, fp, fn, tp = F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp")
    p0, r0 = div(tn, tn + fn), div(tn, tn + fp)
    p1, r1 = div(tp, tp + fp), div(tp, tp + fn)
    f0 = div(F.lit(2.0) * p0 * r0, p0 + r0)
    f1 = div(F.lit(2.0) * p1 * r1, p1 + r1)
    s0, s1 = tn + fp, fn + tp
    n = s0 + s1
    rows = F.array(
        F.struct(F.lit(names[0]).alias("row"), p0.alias("precision"), r0.alias("recall"),
                 f0.alias("f1"), s0.alias("support")),
        F.struct(F.lit(names[1]).alias("row"), p1.alias("precision"), r1.alias("recall"),
                 f1.alias("f1"), s1.alias("support")),
        F.struct(F.lit("accuracy").alias("row"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), div(tn + tp, n).alias("f1"),
                 n.alias("support")),
        F.struct(F.lit("macro avg").alias("row"), ((p0 + p1) / 2).alias("precision"),
                 ((r0 + r1) / 2).alias("recall"), ((f0 + f1) / 2).alias("f1"), n.alias("support")),
        F.struct(F.lit("weighted avg").alias("row"), div(p0 * s0 + p1 * s1, n).alias("precision"),
                 div(r0 * s0 + r1 * s1, n).alias("recall"), div(f0 * s0 + f1 * s1, n).alias("f1"),
                 n.alias("support")))
    return c.select(F.inline(rows))


def optimal_threshold(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Threshold with the highest F1 (lowest one on ties) and the report at it."""
    m = curve_metrics(df, label, score).first()
    t = m["best_threshold"]
    if t is None:
        return df.sparkSession.createDataFrame(
            [], "threshold double, best_f1 double, precision double, recall double, f1 double")
    return (f1_bad(df, t, label, score)
            .select(F.lit(float(t)).alias("threshold"), F.lit(float(m["best_f1"])).alias("best_f1"),
                    "precision", "recall", "f1"))


def optimal_report(df: DataFrame, label: str = "label", score: str = "score",
                   names=CLASS_NAMES) -> DataFrame:
    """The full class report at the threshold with the highest F1."""
    return classification_report(df, _best_threshold(df, label, score), label, score, names)


def optimal_confusion(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """The confusion matrix at the threshold with the highest F1."""
    return confusion_matrix(df, _best_threshold(df, label, score), label, score)


def _best_threshold(df: DataFrame, label: str, score: str) -> float:
    # No score at all: nothing is predicted as class 1.
    t = curve_metrics(df, label, score).first()["best_threshold"]
    return math.inf if t is None else float(t)


def model_comparison(scored: dict[str, DataFrame], threshold: float = 0.5, label: str = "label",
                     score: str = "score") -> DataFrame:
    """One row per model: ROC AUC, PR AUC, F1 of class 1 at the threshold.

    The models' scores are one table (model, label, score) and one set of jobs, however many
    models there are.
    """
    from functools import reduce
    from .group_curves import metrics_by
    rows = reduce(DataFrame.unionByName, [
        df.select(F.lit(name).alias("model"), F.col(label).alias("label"),
                  F.col(score).cast("double").alias("score")) for name, df in scored.items()])
    return metrics_by(rows, ["model"], threshold).select(
        "model", "roc_auc", "pr_auc", F.col("f1").alias("f1_bad"))
