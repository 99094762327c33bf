"""Hand-computed micro-cases for the semantics traps."""

import math

import pytest
from pyspark.sql import functions as F

from riskframe.features import transformers as X
from riskframe.functions.dates import parse_month
from riskframe.functions.scalar import psi_band, status_label, yeo_johnson
from riskframe.operators import clean, correlate, evaluate, profile, stability
from riskframe.operators.ordered import cumulative_sums, exact_quantiles


def test_status_label_vocabulary(spark):
    rows = [("Charged Off",), ("Default",), ("Does not meet the credit policy. Status:Charged Off",),
            ("Fully Paid",), ("Current",), ("Something else",), (None,)]
    df = spark.createDataFrame(rows, "loan_status string")
    got = [r[0] for r in df.select(status_label("loan_status")).collect()]
    assert got == [1, 1, 1, 0, -1, -1, -1]
    kept = clean.definitive_outcomes(df).count()
    assert kept == 4


def test_definitive_filter_reaches_scan(spark, tmp_path):
    p = str(tmp_path / "s.parquet")
    spark.createDataFrame([("Fully Paid", 1.0), ("Current", 2.0)], "loan_status string, x double") \
        .write.parquet(p)
    plan = clean.definitive_outcomes(spark.read.parquet(p))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(loan_status" in plan


def test_month_parsing_strict(spark):
    df = spark.createDataFrame([("Dec-2015",), ("Dec-15",), ("dec-2016",), ("bad",), (None,)], "d string")
    got = [r[0] for r in df.select(parse_month("d")).collect()]
    assert str(got[0]) == "2015-12-01"
    assert got[1] is None and got[3] is None and got[4] is None
    assert str(got[2]) == "2016-12-01"


def test_emp_length_all_values(spark):
    vals = ["< 1 year", "1 year"] + [f"{i} years" for i in range(2, 10)] + ["10+ years", "n/a", None]
    df = spark.createDataFrame([(v,) for v in vals], "emp_length string")
    out = X.EmpLengthConverter().transform(df)
    assert "emp_length" not in out.columns
    got = [r[0] for r in out.collect()]
    assert got == [float(i) for i in range(11)] + [None, None]
    # absent column: no-op
    other = spark.createDataFrame([(1,)], "x int")
    assert X.EmpLengthConverter().transform(other).columns == ["x"]


def test_count_binarizer(spark):
    df = spark.createDataFrame([("0",), ("2",), (None,), ("x",)], "pub_rec string")
    out = X.CountBinarizer().transform(df)
    assert out.columns == ["pub_rec_binary", "mort_acc_binary", "pub_rec_bankruptcies_binary"]
    assert [tuple(r) for r in out.collect()] == [(0, 0, 0), (1, 0, 0), (0, 0, 0), (0, 0, 0)]


def test_credit_history(spark):
    df = spark.createDataFrame([("Dec-2016", "Dec-2006"), ("Dec-2016", "Jan-2020"), ("Dec-2016", "bad")],
                               "issue_d string, earliest_cr_line string")
    out = X.CreditHistoryCalculator().transform(df)
    assert out.columns == ["credit_hist_years"]
    got = [r[0] for r in out.collect()]
    assert got[0] == pytest.approx(3653 / 365.25)
    assert got[1] == 0.0 and got[2] == 0.0
    only_one = spark.createDataFrame([("Dec-2016",)], "issue_d string")
    out1 = X.CreditHistoryCalculator().transform(only_one)
    assert out1.columns == ["issue_d", "credit_hist_years"] and out1.first()[1] == 0.0


def test_missing_threshold_strict(spark):
    # a: exactly 40 % missing (kept), b: 60 % (dropped), c: 100 % (dropped)
    rows = [(None, None, None), (None, None, None), (1.0, None, None), (1.0, 1.0, None), (1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    assert sorted(clean.high_missing_columns(df)) == ["b", "c"]
    assert clean.drop_high_missing(df).columns == ["a"]
    mt = {r["column"]: r["missing_pct"] for r in clean.missing_table(df).collect()}
    assert mt == {"a": 40.0, "b": 60.0, "c": 100.0}


def test_moments_constant_and_small(spark):
    df = spark.createDataFrame([(1.0, 5.0, 1.0), (2.0, 5.0, None), (4.0, 5.0, None), (8.0, 5.0, None)],
                               "x double, k double, one double")
    m = {r["column"]: r for r in profile.moments(df, ["x", "k", "one"]).collect()}
    assert m["k"]["skewness"] == 0.0 and m["k"]["kurtosis"] == 0.0
    assert m["one"]["skewness"] is None
    # pandas: Series([1, 2, 4, 8]).skew(), .kurt()
    assert m["x"]["skewness"] == pytest.approx(1.1376243669576889, rel=1e-12)
    assert m["x"]["kurtosis"] == pytest.approx(0.7576559546313799, rel=1e-12)


def test_corr_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, 2.0, 5.0), (3.0, 2.0, None), (4.0, 2.0, 9.0)],
                               "a double, k double, b double")
    t = {r["column"]: r["corr"] for r in correlate.corr_target(df, ["k", "b"], "a").collect()}
    assert t["k"] is None
    assert t["b"] == pytest.approx(1.0)   # pairs (1,3), (2,5), (4,9): b = 2a + 1
    m = {(r["col_x"], r["col_y"]): r["corr"] for r in correlate.corr_matrix(df, ["a", "k", "b"]).collect()}
    assert m[("a", "k")] is None and m[("k", "k")] is None
    assert m[("a", "b")] == pytest.approx(1.0)
    assert m[("a", "a")] == pytest.approx(1.0)


def test_exact_quantiles_even_median_and_nulls(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    q = {r["prob"]: r["value"] for r in exact_quantiles(df, ["x"], [0.0, 0.3, 0.5, 1.0]).collect()}
    assert q == {0.0: 1.0, 0.3: pytest.approx(1.9), 0.5: 2.5, 1.0: 10.0}


def test_exact_quantiles_many_buckets_match_numpy(spark):
    import numpy as np
    vals = [float((i * 7919) % 1000) / 7.0 for i in range(3000)]
    df = spark.createDataFrame([(v, i % 3) for i, v in enumerate(vals)], "x double, g int")
    probs = [0.1, 0.25, 0.5, 0.9]
    got = {r["prob"]: r["value"] for r in exact_quantiles(df, ["x"], probs, rows_per_bucket=37).collect()}
    for p in probs:
        assert got[p] == pytest.approx(np.quantile(vals, p), abs=1e-9)


def test_cumulative_sums_buckets_equal_single(spark):
    df = spark.range(500).select((F.col("id") * 3 % 101).cast("double").alias("v"),
                                 F.lit(1).alias("c")).groupBy("v").agg(F.sum("c").alias("c"))
    a = {r["v"]: r["cum_c"] for r in cumulative_sums(df, "v", ["c"], rows_per_bucket=7).collect()}
    b = {r["v"]: r["cum_c"] for r in cumulative_sums(df, "v", ["c"]).collect()}
    assert a == b and max(a.values()) == 500


def _scores(spark, rows):
    return spark.createDataFrame(rows, "label int, score double")


def test_pr_auc_impure_top_group(spark):
    df = _scores(spark, [(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.1)])
    m = evaluate.curve_metrics(df).first()
    assert m["pr_auc"] == pytest.approx(2 / 3)
    assert m["roc_auc"] == pytest.approx(0.625)


def test_perfect_and_reversed(spark):
    perfect = _scores(spark, [(1, 0.9), (1, 0.8), (0, 0.2), (0, 0.1)])
    rev = perfect.withColumn("score", -F.col("score"))
    assert evaluate.curve_metrics(perfect).first()["roc_auc"] == 1.0
    assert evaluate.curve_metrics(rev).first()["roc_auc"] == 0.0


def test_single_class(spark):
    df = _scores(spark, [(0, 0.9), (0, 0.1)])
    m = evaluate.curve_metrics(df).first()
    assert m["roc_auc"] is None and m["pr_auc"] is None
    f = evaluate.f1_bad(df, 0.5).first()
    assert f["f1"] == 0.0 and f["precision"] == 0.0


def test_confusion_all_cells(spark):
    df = _scores(spark, [(1, 0.9), (1, 0.8)])
    cells = {(r["actual"], r["predicted"]): r["count"] for r in evaluate.confusion_matrix(df, 0.5).collect()}
    assert cells == {(0, 0): 0, (0, 1): 0, (1, 0): 0, (1, 1): 2}


def test_optimal_threshold_lowest_on_ties(spark):
    df = _scores(spark, [(1, 0.9), (0, 0.6), (1, 0.3), (0, 0.1)])
    t = evaluate.optimal_threshold(df).first()
    # thresholds 0.9 and 0.3 both give F1 = 2/3; the lower one wins
    assert t["threshold"] == 0.3 and t["best_f1"] == pytest.approx(0.8)


def _drift(spark, e, a):
    rows = [("expected", v) for v in e] + [("actual", v) for v in a]
    return spark.createDataFrame(rows, "side string, value double")


def test_psi_identical_is_zero(spark):
    vals = [float(i % 37) for i in range(400)]
    assert stability.psi_value(_drift(spark, vals, vals)) == pytest.approx(0.0, abs=1e-12)


def test_psi_constant_expected_is_null(spark):
    r = stability.psi(_drift(spark, [1.0] * 10, [1.0, 2.0])).first()
    assert r["psi"] is None and r["band"] is None


def test_psi_disjoint_and_beyond(spark):
    r = stability.psi(_drift(spark, [float(i) for i in range(100)], [float(i) for i in range(500, 600)])).first()
    assert r["psi"] > 0.25 and r["band"] == "major shift"


def test_psi_null_scores_form_their_own_bin(spark):
    e = [float(i) for i in range(100)] + [None] * 10
    a = [float(i) for i in range(100)] + [None] * 10
    t = stability.psi_table(_drift(spark, e, a))
    rows = {r["bin"]: r for r in t.collect()}
    assert None in rows and rows[None]["expected_share"] == pytest.approx(10 / 110)
    assert stability.psi_value(_drift(spark, e, a)) == pytest.approx(0.0, abs=1e-12)


def test_psi_large_values(spark):
    e = [1e10 + i for i in range(50)]
    a = [1e10 + i + 0.5 for i in range(50)]
    assert stability.psi_value(_drift(spark, e, a)) is not None


def test_psi_band_labels(spark):
    df = spark.createDataFrame([(0.05,), (0.2,), (0.3,), (None,)], "p double")
    assert [r[0] for r in df.select(psi_band("p")).collect()] == ["stable", "minor shift", "major shift", None]


def test_yeo_johnson_branches(spark):
    df = spark.createDataFrame([(3.0,), (-3.0,), (0.0,)], "x double")
    for lam in (0.0, 0.5, 2.0):
        got = [r[0] for r in df.select(yeo_johnson("x", lam)).collect()]
        exp = []
        for x in (3.0, -3.0, 0.0):
            if x >= 0:
                exp.append(math.log1p(x) if lam == 0 else ((x + 1) ** lam - 1) / lam)
            else:
                exp.append(-math.log1p(-x) if lam == 2 else -((1 - x) ** (2 - lam) - 1) / (2 - lam))
        assert got == pytest.approx(exp)


def test_yeo_johnson_lambda_matches_scan(spark):
    import numpy as np
    xs = [float(v) for v in np.random.default_rng(1).lognormal(0, 1, 400) - 0.5]
    df = spark.createDataFrame([(v,) for v in xs], "x double")
    lam = X.fit_yeo_johnson_lambdas(df, ["x"])[0]
    x = np.array(xs)

    def ll(l):
        y = np.where(x >= 0, (np.log1p(x) if l == 0 else ((x + 1) ** l - 1) / l),
                     (-np.log1p(-x) if l == 2 else -((1 - x) ** (2 - l) - 1) / (2 - l)))
        return -len(x) / 2 * np.log(y.var()) + (l - 1) * np.sum(np.sign(x) * np.log1p(np.abs(x)))
    grid = np.linspace(-2, 2, 40001)
    best = grid[np.argmax([ll(g) for g in grid])]
    assert lam == pytest.approx(best, abs=2e-3)


def test_mode_tie_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    r = profile.impute_mode(df, ["c"]).first()
    assert r["mode"] == "a" and r["count"] == 2


def test_median_even(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    assert profile.impute_median(df, ["x"]).first()["median"] == 2.5


def test_ordinal_unknown_and_null(spark):
    train = spark.createDataFrame([("A", "A2"), ("B", "A10"), ("B", "B1"), ("C", "A1")], "grade string, sub_grade string")
    levels = profile.ordinal_levels(train).collect()
    sub = [r["level"] for r in levels if r["column"] == "sub_grade"]
    assert sub == ["A1", "A2", "A10", "B1"]
    m = X.OrdinalLevelEncoder(inputCols=["grade", "sub_grade"]).fit(train)
    new = spark.createDataFrame([("Z", "A10"), (None, None)], "grade string, sub_grade string")
    got = [tuple(r) for r in m.transform(new).collect()]
    assert got == [(-1.0, 2.0), (1.0, 0.0)]   # null -> mode (B for grade, A1 smallest tie)


def test_one_hot_unknown_all_zero(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    train = spark.createDataFrame([("x",), ("y",), ("y",)], "t string")
    m = Pipeline(stages=X.one_hot_stages(["t"])).fit(train)
    new = spark.createDataFrame([("x",), ("y",), ("zzz",), (None,)], "t string")
    got = [r[0] for r in m.transform(new).select(vector_to_array("t__ohe")).collect()]
    assert got == [[1.0, 0.0], [0.0, 1.0], [0.0, 0.0], [0.0, 1.0]]


def test_standard_scaler_population_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,)], "x double")
    m = X.StandardNumericScaler(inputCols=["x"]).fit(df)
    assert m.getOrDefault("medians") == [2.5]
    sd = m.getOrDefault("stds")[0]
    assert sd == pytest.approx(math.sqrt(((1.5**2 + 0.5**2) * 2 + 0) / 5))
    constant = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    out = X.StandardNumericScaler(inputCols=["x"]).fit(constant).transform(constant)
    assert [r[0] for r in out.collect()] == [0.0, 0.0]


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "x double")
    from riskframe.operators.distribution import histogram
    rows = histogram(df, ["x"]).collect()
    assert sum(r["count"] for r in rows) == 11
    assert rows[-1]["upper"] == pytest.approx(10.0)


def test_box_whiskers_are_data_points(spark):
    from riskframe.operators.distribution import box_stats
    vals = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0]
    df = spark.createDataFrame([(0, v) for v in vals], "is_bad int, x double")
    r = box_stats(df, ["x"]).first()
    assert r["whisker_hi"] == 5.0 and r["n_outliers"] == 1 and r["whisker_lo"] == 1.0


def test_two_digit_years_with_century_fix(spark):
    df = spark.createDataFrame([("Dec-15", "Aug-03"), ("Dec-15", "Feb-88")],
                               "issue_d string, earliest_cr_line string")
    strict = [r[0] for r in X.CreditHistoryCalculator().transform(df).collect()]
    assert strict == [0.0, 0.0]      # strict MMM-yyyy: both unparsable -> 0
    loose = X.CreditHistoryCalculator(dateFormats=["MMM-yyyy", "MMM-yy"]).transform(df)
    got = [r[0] for r in loose.collect()]
    assert got[0] == pytest.approx((4505) / 365.25)     # 2003-08-01 .. 2015-12-01
    assert got[1] == pytest.approx(10165 / 365.25)      # 1988-02-01 .. 2015-12-01


def test_date_parse_counts(spark):
    df = spark.createDataFrame([("Dec-2015", "bad"), ("Jan-2016", None)], "issue_d string, earliest_cr_line string")
    got = {r["column"]: (r["n_text"], r["n_parsed"], r["n_failed"]) for r in clean.date_parse_counts(df).collect()}
    assert got == {"issue_d": (2, 2, 0), "earliest_cr_line": (1, 0, 1)}


def test_kde_constant_column_is_empty_not_error(spark):
    from riskframe.operators.distribution import kde_curve
    df = spark.createDataFrame([(1.0, float(i)) for i in range(20)], "k double, x double")
    rows = kde_curve(df, ["k", "x"]).collect()
    assert {r["column"] for r in rows} == {"x"} and len(rows) == 200
    # density integrates to about 1 over the data range for a wide sample
    step = rows[1]["x"] - rows[0]["x"]
    assert 0.8 < sum(r["density"] for r in rows) * step < 1.05


def test_approx_quantiles_close_to_exact(spark):
    from riskframe.operators.ordered import approx_quantiles
    df = spark.range(20000).select(((F.col("id") * 7919) % 10007).cast("double").alias("x"))
    ex = {r["prob"]: r["value"] for r in exact_quantiles(df, ["x"], [0.1, 0.5, 0.9]).collect()}
    ap = {r["prob"]: r["value"] for r in approx_quantiles(df, ["x"], [0.1, 0.5, 0.9]).collect()}
    for p in ex:
        assert abs(ex[p] - ap[p]) <= 10007 * 2e-4 + 1
    m = profile.impute_median(df, ["x"], exact=False).first()["median"]
    assert abs(m - ex[0.5]) <= 10007 * 2e-4 + 1
