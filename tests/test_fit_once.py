"""Fits on large tables: what is shared, and the booster's sums per node, feature and bin."""

import threading

import numpy as np
import pyarrow as pa

from riskframe import boosting as B
from riskframe import model as M
from riskframe.operators import ordered
from riskframe.plans import catalog
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler

from conftest import SF_SMALL


def test_two_learners_share_one_preprocessing(spark, monkeypatch):
    calls, whole = [], M.fit_preprocessing
    monkeypatch.setattr(M, "fit_preprocessing", lambda *a: calls.append(1) or whole(*a))
    train, _ = catalog._train_test(spark, SF_SMALL)
    def learner(n):
        return LogisticRegression(featuresCol="features", labelCol=M.LABEL_COL,
                                  weightCol=M.WEIGHT_COL, maxIter=n)
    models, plan = M.fit_pipelines(train, {"a": learner(1), "b": learner(2)})
    assert calls == [1] and set(models) == {"a", "b"} and plan.raw_inputs
    assert models["a"].stages[0] is models["b"].stages[0]
    assert models["a"].stages[-1].coefficients != models["b"].stages[-1].coefficients


def test_learners_run_side_by_side_on_rows_without_lineage(spark):
    both, plans = threading.Barrier(2, timeout=120), []

    class Learner(LogisticRegression):
        def fit(self, df):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            both.wait()   # breaks unless the other learner is at work
            return super().fit(df)

    train, _ = catalog._train_test(spark, SF_SMALL)
    learner = {k: Learner(featuresCol="features", labelCol=M.LABEL_COL, weightCol=M.WEIGHT_COL,
                          maxIter=n) for k, n in (("a", 1), ("b", 2))}
    models, _ = M.fit_pipelines(train, learner)
    assert models["a"].stages[-1].coefficients != models["b"].stages[-1].coefficients
    assert len(plans) == 2 and not any("Join" in p or "InMemory" in p for p in plans)


def test_loans_are_joined_once_and_let_go(spark):
    rows = catalog._test_rows(spark, SF_SMALL)
    def joins():
        return rows.select("id")._jdf.queryExecution().withCachedData().toString()
    with catalog._joined_once(spark, SF_SMALL):
        assert "InMemoryRelation" in joins() and catalog._definitive(spark, SF_SMALL).is_cached
    assert not catalog._definitive(spark, SF_SMALL).is_cached


def test_bracket_counts_use_no_lambda(spark):
    long = spark.createDataFrame([("a", float(i)) for i in range(10)], "column string, value double")
    brackets = spark.createDataFrame([("a", 10, [2.0, 6.0], [4.0, 7.0])],
                                     "column string, n int, lows array<double>, highs array<double>")
    got = ordered.bracket_counts(long, brackets, ["column"])
    assert "lambda" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(((r.i, r.value, r.cnt) for r in got.collect()), key=str) == sorted(
        [(0, None, 2), (0, 2.0, 1), (0, 3.0, 1), (0, 4.0, 1), (1, None, 6), (1, 6.0, 1),
         (1, 7.0, 1)], key=str)


def test_sums_per_node_feature_and_bin():
    r = np.random.default_rng(3)
    x, g, h = r.integers(0, 4, (2, 500)).astype(np.uint8), r.normal(size=500), r.random(500)
    batch = pa.RecordBatch.from_arrays([pa.array([v.tobytes()]) for v in (x, g, h)], ["part", "g", "h"])
    nodes = ([0, -1, -1], [1, 0, 0], [1, -1, -1], [2, -1, -1])
    (out,) = B._histograms(nodes, [2], 2, 4, np.uint8)(iter([batch, batch]))
    right = x[0] > 1
    for f, got_g, got_h in zip(*(out.column(k).to_pylist() for k in ("feature", "g", "h"))):
        for b in range(4):
            s = right & (x[f] == b)
            assert np.allclose([got_g[b], got_h[b]], [2 * g[s].sum(), 2 * h[s].sum()])


def test_cuts_come_from_all_learnt_rows(spark):
    rows = [(float(i % 3), float(i), i % 4 == 0) for i in range(4000)] + [(9.0, -5.0, True)]
    df = VectorAssembler(inputCols=["a", "b"], outputCol="x").transform(
        spark.createDataFrame(rows, "a double, b double, held boolean").selectExpr("*", "1 AS y"))
    booster = B.NewtonBooster(featuresCol="x", labelCol="y", validationIndicatorCol="held", maxBins=8)
    few, many = booster._cuts(booster._rows(df))
    assert few.tolist() == [0.5, 1.5]
    want = np.quantile([b for _, b, held in rows if not held], np.arange(1, 8) / 8)
    assert len(many) == 7 and np.abs(many - want).max() < 10
