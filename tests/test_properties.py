"""Properties: symmetry of AUC, PSI(x,x)=0, confusion totals, partition-count invariance."""

import pytest
from pyspark.sql import functions as F

from riskframe.operators import evaluate, stability
from riskframe.sources import fixture

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def scored(spark):
    return fixture.scored(spark, SF_SMALL).cache()


def test_auc_of_negated_score(scored):
    a = evaluate.curve_metrics(scored).first()["roc_auc"]
    b = evaluate.curve_metrics(scored.withColumn("score", -F.col("score"))).first()["roc_auc"]
    assert a + b == pytest.approx(1.0)


def test_bucketing_does_not_change_metrics(scored):
    a = evaluate.curve_metrics(scored).first()
    b = evaluate.curve_metrics(scored, rows_per_bucket=3).first()
    assert a == b


def test_psi_self_zero(scored):
    s = scored.select(F.lit("expected").alias("side"), F.col("score").alias("value")).unionByName(
        scored.select(F.lit("actual").alias("side"), F.col("score").alias("value")))
    assert stability.psi_value(s) == pytest.approx(0.0, abs=1e-12)


def test_confusion_sums_to_n(scored):
    n = scored.count()
    total = sum(r["count"] for r in evaluate.confusion_matrix(scored, 0.5).collect())
    assert total == n


def test_shuffle_partitions_invariance(spark, scored):
    from riskframe.operators.profile import describe_numeric
    d = fixture.definitive_loans(spark, SF_SMALL)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        a = sorted(describe_numeric(d, ["loan_amnt", "annual_inc"]).collect())
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        b = sorted(describe_numeric(d, ["loan_amnt", "annual_inc"]).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    for ra, rb in zip(a, b):
        for x, y in zip(ra, rb):
            assert x == (pytest.approx(y, rel=1e-12) if isinstance(y, float) else y)


def test_hot_score_value_exact_against_brute_force(spark):
    """One score holds a third of all rows; many buckets; results equal a brute-force pass."""
    import numpy as np
    rng = np.random.default_rng(3)
    n = 3000
    scores = np.where(np.arange(n) % 3 == 0, 0.5, rng.integers(0, 400, n) / 400.0)
    labels = (rng.random(n) < 0.2 + 0.6 * scores).astype(int)
    df = spark.createDataFrame([(int(y), float(s)) for y, s in zip(labels, scores)],
                               "label int, score double")
    m = evaluate.curve_metrics(df, rows_per_bucket=25).first()
    P, N = labels.sum(), n - labels.sum()
    # brute force over distinct thresholds, descending
    ts = np.unique(scores)[::-1]
    tp = np.array([((scores >= t) & (labels == 1)).sum() for t in ts])
    fp = np.array([((scores >= t) & (labels == 0)).sum() for t in ts])
    pos = np.diff(np.concatenate([[0], tp]))
    neg = np.diff(np.concatenate([[0], fp]))
    roc = np.sum(neg * (tp - pos) + 0.5 * pos * neg) / (P * N)
    prec = tp / (tp + fp)
    rec = tp / P
    prev_p = np.concatenate([[1.0], prec[:-1]])
    prev_r = np.concatenate([[0.0], rec[:-1]])
    pr = np.sum((rec - prev_r) * (prec + prev_p) / 2)
    f1 = 2 * tp / (tp + fp + P)
    best = max(range(len(ts)), key=lambda i: (f1[i], -ts[i]))
    assert m["roc_auc"] == pytest.approx(roc, rel=1e-12)
    assert m["pr_auc"] == pytest.approx(pr, rel=1e-12)
    assert m["best_threshold"] == ts[best] and m["best_f1"] == pytest.approx(f1[best], rel=1e-12)
