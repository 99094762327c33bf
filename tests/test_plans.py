"""Physical-plan properties that matter at scale."""

from pyspark.sql import functions as F

from riskframe.operators import evaluate, ordered
from riskframe.sources import fixture

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fixture_scans_are_pruned(spark):
    plan = _plan(fixture.loans(spark, SF_SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string,l_linestatus:string>" in plan
    assert "c_name" not in plan and "l_extendedprice" not in plan


def test_unused_lineitem_branch_is_pruned(spark):
    df = fixture.loans(spark, SF_SMALL).select("id", "loan_amnt")
    assert "lineitem" not in _plan(df)


def test_curve_running_sums_are_bucketed(spark):
    counts = evaluate.score_counts(fixture.scored(spark, SF_SMALL))
    cum = ordered.cumulative_sums(counts, "score", ["pos", "neg"], descending=True, rows_per_bucket=50)
    plan = cum._jdf.queryExecution().optimizedPlan().toString()
    # the running-sum window is partitioned by the bucket, never a single global partition
    assert "windowspecdefinition(__bucket" in plan


def test_quantiles_shuffle_a_small_share_of_the_values(spark):
    df = spark.range(40_000).select((F.col("id") * 7919 % 40_009).cast("double").alias("x"))
    long = ordered.unpivot_values(df, ["x"])
    brackets = long.groupBy("column").agg(
        F.count(F.lit(1)).alias("n"), F.percentile_approx("value", [0.245, 0.495], 1000)
        .alias("lows"), F.percentile_approx("value", [0.255, 0.505], 1000).alias("highs"))
    counts = ordered.bracket_counts(long, brackets, ["column"])
    assert counts.count() < 0.05 * 40_000
    assert "CartesianProduct" not in _plan(counts)
    assert "BroadcastNestedLoopJoin" not in _plan(counts)


def test_corr_matrix_needs_no_python_worker(spark):
    from riskframe.operators import correlate
    d = fixture.definitive_loans(spark, SF_SMALL)
    cols = ["loan_amnt", "int_rate", "annual_inc"]
    g = correlate.gram_sums(d.select(*[F.col(c).cast("double").alias(c) for c in cols]), cols,
                            [0.0] * 3)
    n = d.agg(*[F.count(c) for c in cols], F.sum(F.col("loan_amnt") * F.col("int_rate"))).first()
    assert [g[i, i] for i in range(3)] == list(n[:3]) and abs(g[3, 4] / n[3] - 1) < 1e-12
    plan = _plan(correlate.corr_matrix(d, cols))
    assert "Python" not in plan and "MapInPandas" not in plan


def test_time_split_prunes_year_partitions(spark, tmp_path):
    from riskframe.operators import profile
    from riskframe.sources.loans import scan_parquet, to_parquet
    path = str(tmp_path / "loans_by_year")
    to_parquet(fixture.definitive_loans(spark, SF_SMALL), path)
    train, test = profile.split_frames(scan_parquet(spark, path), fixture.SPLIT_YEAR)
    plan = _plan(train)
    assert "PartitionFilters: [isnotnull(issue_year" in plan and "issue_year#" in plan
    assert train.count() + test.count() == fixture.definitive_loans(spark, SF_SMALL).count()
