"""Pipeline fit, scoring, persistence and the fixture facts."""

import pytest
from pyspark.sql import functions as F

from riskframe import model as M
from riskframe.operators import clean, evaluate, profile
from riskframe.score import MissingFeatures, Scorer
from riskframe.session import checkpoint_dir
from riskframe.sources import fixture

from conftest import SF_MID, SF_SMALL


def test_fixture_facts_sf001(spark):
    d = fixture.definitive_loans(spark, SF_MID)
    r = d.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("annual_inc").isNull()).alias("ai"),
              F.count_if(F.col("mths_since_last_delinq").isNull()).alias("md")).first()
    assert (r["n"], r["ai"], r["md"]) == (10021, 920, 5054)
    auc = evaluate.curve_metrics(fixture.scored(spark, SF_MID)).first()["roc_auc"]
    assert auc == pytest.approx(0.604792, abs=1e-6)


@pytest.fixture(scope="module")
def fitted(spark):
    d = clean.drop_leakage(fixture.definitive_loans(spark, SF_SMALL))
    train, _ = profile.split_frames(d, fixture.SPLIT_YEAR)
    return M.fit_pipeline(train, M.baseline_booster(max_iter=8))


def test_pipeline_learns_and_roundtrips(spark, fitted):
    mdl, plan = fitted
    rows = fixture.definitive_loans(spark, SF_SMALL).filter(F.col("issue_year") >= fixture.SPLIT_YEAR)
    s = M.predict_proba(mdl, rows, keep=["id", "is_bad"]).select(
        "id", F.col("is_bad").alias("label"), F.col("probability").alias("score"))
    assert evaluate.curve_metrics(s).first()["roc_auc"] > 0.9
    path = checkpoint_dir(spark).rstrip("/") + "/test-scorer"
    Scorer(mdl, plan).save(path)
    loaded = Scorer.load(path, spark)
    a = sorted(tuple(r) for r in Scorer(mdl, plan).score(rows).collect())
    b = sorted(tuple(r) for r in loaded.score(rows).collect())
    assert a == b and len(a) == rows.count()


def test_scorer_reports_missing_columns(spark, fitted):
    mdl, plan = fitted
    rows = fixture.definitive_loans(spark, SF_SMALL).drop("int_rate", "issue_d")
    with pytest.raises(MissingFeatures) as e:
        Scorer(mdl, plan).score(rows)
    assert "int_rate" in str(e.value) and "issue_d" in str(e.value)


def test_transform_preserves_rows(spark, fitted):
    mdl, _ = fitted
    rows = fixture.definitive_loans(spark, SF_SMALL)
    assert mdl.transform(rows).count() == rows.count()


def test_stream_scores_equal_batch(spark, fitted, tmp_path):
    from riskframe.streaming.scoring import application_stream, start_scoring
    mdl, plan = fitted
    rows = fixture.definitive_loans(spark, SF_SMALL).filter(F.col("issue_year") >= fixture.SPLIT_YEAR)
    src = str(tmp_path / "incoming")
    rows.write.parquet(src)
    stream = application_stream(spark, src, spark.read.parquet(src).schema)
    q = start_scoring(Scorer(mdl, plan), stream, str(tmp_path / "scores"), name="t_stream",
                      checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(300)
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "scores")).collect())
    exp = sorted(tuple(r) for r in Scorer(mdl, plan).score(spark.read.parquet(src)).collect())
    assert got == exp and len(got) == rows.count()


def test_shuffled_label_is_not_learned(spark):
    """A label independent of the features gives a test AUC near 0.5 (sf0.01)."""
    d = clean.drop_leakage(fixture.definitive_loans(spark, SF_MID))
    d = d.withColumn("is_bad", (F.abs(F.xxhash64(F.col("loan_amnt"), F.lit(7))) % 2).cast("int"))
    train, test = profile.split_frames(d, fixture.SPLIT_YEAR)
    mdl, _ = M.fit_pipeline(train, M.baseline_booster(max_iter=8))
    s = M.predict_proba(mdl, test, keep=["is_bad"]).select(
        F.col("is_bad").alias("label"), F.col("probability").alias("score"))
    assert abs(evaluate.curve_metrics(s).first()["roc_auc"] - 0.5) < 0.06


def test_score_records_equal_frame(spark, fitted):
    mdl, plan = fitted
    raw = fixture.loans(spark, SF_SMALL).orderBy("id").limit(5)
    records = [{k: (str(v) if v is not None else None) for k, v in r.asDict().items()}
               for r in raw.collect()]
    sc = Scorer(mdl, plan)
    from_records = sorted(tuple(r) for r in sc.score(records).collect())
    from_frame = sorted(tuple(r) for r in sc.score(raw).collect())
    assert [r[1:] for r in from_records] == [r[1:] for r in from_frame]
    with pytest.raises(TypeError):
        sc.score("not a frame")


def test_learner_gets_rows_in_few_parts(spark):
    """What a join leaves in many small parts must not cost a task per part in every round."""
    from pyspark.ml import Estimator
    parts = []

    class Looking(Estimator):
        def _fit(self, df):
            parts.append((df.rdd.getNumPartitions(), df.count()))
            return M.NewtonBooster(featuresCol=M.FEATURES_COL, labelCol=M.LABEL_COL,
                                   maxIter=1).fit(df)

    train = spark.range(400).selectExpr(
        "id * 1.5 AS a", "id % 7 AS b", "CAST(id % 2 AS int) AS is_bad").repartition(50)
    assert train.rdd.getNumPartitions() == 50
    M.fit_pipeline(train, Looking())
    assert parts == [(1, 400)]
    assert not train.is_cached


def test_rows_per_task_bound_the_parts(spark):
    from riskframe.session import ROWS_PER_TASK, in_few_tasks
    df = spark.range(100).repartition(9)
    got = [in_few_tasks(df, n).rdd.getNumPartitions()
           for n in (0, 100, ROWS_PER_TASK + 1, 10 ** 9)]
    assert got == [1, 1, 2, 9] and in_few_tasks(df, 100).count() == 100
