"""The joint fit gives the stages that fitting in turn gives, in fewer jobs."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskframe.features import joint_fit as J
from riskframe.operators import clean, profile
from riskframe.plans.feature_plan import fit_plan
from riskframe.sources import fixture

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def train(spark):
    d = clean.drop_leakage(fixture.definitive_loans(spark, SF_SMALL))
    return profile.split_frames(d, fixture.SPLIT_YEAR)[0].cache()


def jobs_of(spark, run):
    sc = spark.sparkContext
    group = f"count-{id(run)}"
    sc.setJobGroup(group, "counted")
    try:
        out = run()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return out, len(sc.statusTracker().getJobIdsForGroup(group))


def test_equal_to_fitting_in_turn(spark, train):
    plan = fit_plan(train)
    assert plan.skewed and plan.standard and plan.ordinal and plan.one_hot
    stages, few = jobs_of(spark, lambda: J.fit_preprocessing(train, plan))
    inturn, many = jobs_of(spark, lambda: Pipeline(
        stages=plan.engineering_stages() + plan.preprocessing_stages()).fit(train))
    assert few < 0.7 * many
    assert [type(s) for s in stages] == [type(s) for s in inturn.stages]
    for a, b in zip(stages, inturn.stages):
        for name in ("medians", "lambdas", "means", "stds"):
            if a.hasParam(name):
                assert a.getOrDefault(name) == pytest.approx(b.getOrDefault(name), rel=1e-6, abs=1e-9)
        for name in ("modes", "levels"):
            if a.hasParam(name):
                assert a.getOrDefault(name) == b.getOrDefault(name)

    def vectors(all_stages):
        df = train
        for s in all_stages:
            df = s.transform(df)
        return sorted(tuple(r.v) for r in df.select(vector_to_array("features").alias("v")).collect())

    for x, y in zip(vectors(stages), vectors(inturn.stages)):
        assert x == pytest.approx(y, rel=1e-5, abs=1e-6)


def test_moments_after_filling(spark):
    df = spark.createDataFrame([(1.0, None, 4.0), (None, None, 4.0), (5.0, None, 4.0),
                                (None, None, 4.0)], "a double, b double, c double")
    got = J.moments_after_filling(df, {"a": 3.0, "b": 0.0, "c": 4.0})
    assert got["a"] == pytest.approx((3.0, 2 ** 0.5)) and got["b"] == (0.0, 0.0)
    assert got["c"] == (4.0, 0.0)


def test_categories_and_too_many_levels(spark, monkeypatch):
    df = spark.createDataFrame([("b", "B2"), ("a", "A10"), (None, "A2"), ("a", "Ax"), ("b", None)],
                               "x string, sub_grade string")
    got = J.categories(df.withColumn("none", F.lit(None).cast("string")), ["x", "sub_grade", "none"])
    assert got == {"x": ("a", ["a", "b"]), "sub_grade": ("A10", ["Ax", "A2", "A10", "B2"]),
                   "none": ("", [])}
    monkeypatch.setattr(J, "MOST_LEVELS", 2)
    with pytest.raises(ValueError, match="sub_grade"):
        J.categories(df, ["x", "sub_grade"])
