"""Rules that once broke on particular data: each test names the data."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskframe.features import transformers as X
from riskframe.operators import correlate, distribution, evaluate, ordered, profile, stability
from riskframe.plans.feature_plan import fit_plan
from riskframe.sources import loans


def frame(spark, **cols):
    return spark.createDataFrame(pd.DataFrame(cols))


def log_likelihood(x, lam):
    with np.errstate(all="ignore"):
        y = np.where(x >= 0, np.log1p(x) if lam == 0 else ((x + 1) ** lam - 1) / lam,
                     -np.log1p(-x) if lam == 2 else -((1 - x) ** (2 - lam) - 1) / (2 - lam))
    return -len(x) / 2 * np.log(y.var()) + (lam - 1) * np.sum(np.sign(x) * np.log1p(np.abs(x)))


@pytest.mark.parametrize("name, low, high", [("left", 15, 35), ("right", -8, -2.7), ("plain", 0, 2)])
def test_lambda_search_leaves_its_first_bracket(spark, name, low, high):
    rng = np.random.default_rng(5)
    x = {"left": 100 - rng.exponential(3, 3000), "plain": rng.normal(10, 2, 3000),
         "right": (1 - 4 * np.clip(rng.normal(0.17, 0.02, 3000), 0.05, 0.24)) ** (-1 / 4) - 1}[name]
    lam = X.fit_yeo_johnson_lambdas(frame(spark, x=x), ["x"])[0]
    assert low < lam < high
    around = lam + np.linspace(-0.02, 0.02, 41)
    best = around[np.argmax([log_likelihood(x, v) for v in around])]
    assert lam == pytest.approx(best, abs=2e-3)


@pytest.mark.parametrize("scale, sign, low, high", [(0.01, 1, 1000, 4000), (0.001, 1, 10_000, 40_000),
                                                   (0.001, -1, -40_000, -10_000)])
def test_lambda_of_small_fractions_is_not_capped(spark, scale, sign, low, high):
    x = sign * scale * (1 - np.random.default_rng(5).exponential(0.03, 3000))
    lam = X.fit_yeo_johnson_lambdas(frame(spark, x=x), ["x"])[0]
    assert low < lam < high
    around = lam * (1 + np.linspace(-0.02, 0.02, 41))
    assert lam == pytest.approx(around[np.argmax([log_likelihood(x, v) for v in around])], rel=2e-3)


def test_lambda_search_ends_where_fractions_drown_in_rounding(spark):
    x = 1e-13 * (1 - np.random.default_rng(5).exponential(0.03, 300))
    lams = X.fit_yeo_johnson_lambdas(frame(spark, x=x, y=x * 1e-200), ["x", "y"])
    assert np.isfinite(lams).all() and lams[1] == 1.0


def test_lambda_of_columns_without_spread_or_values(spark):
    df = spark.createDataFrame([(3.0, None), (3.0, None)], "x double, y double")
    assert X.fit_yeo_johnson_lambdas(df, ["x", "y"]) == [1.0, 1.0]


# --- CSV ------------------------------------------------------------------------
def csv(tmp_path, text):
    path = tmp_path / "loans.csv"
    path.write_text(text)
    return str(path)


def test_csv_quotes_and_line_breaks(spark, tmp_path):
    path = csv(tmp_path, 'id,loan_amnt,term,desc,purpose\n'
                         '1,1000, 36 months,"He said ""car"", then\nmore",car\n'
                         '2,NaN, 60 months,,other\n')
    rows = loans.read_loans_csv(spark, path).select("id", "loan_amnt", "term", "desc",
                                                    "purpose").collect()
    assert [tuple(r) for r in rows] == [
        ("1", 1000.0, " 36 months", 'He said "car", then\nmore', "car"),
        ("2", None, " 60 months", None, "other")]


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    path = csv(tmp_path, "loan_amnt,unknown,id\n1000,x,7\n")
    df = loans.read_loans_csv(spark, path)
    r = df.first()
    assert (r.id, r.loan_amnt, r.int_rate) == ("7", 1000.0, None) and "unknown" not in df.columns
    assert df.columns == [f.name for f in loans.raw_schema().fields]


def test_csv_malformed_numbers_are_counted(spark, tmp_path):
    path = csv(tmp_path, "id,loan_amnt\n1,abc\n2,5\n3,\n")
    df = loans.read_loans_csv(spark, path, corrupt_col="bad").cache()
    assert [r.loan_amnt for r in df.orderBy("id").collect()] == [None, 5.0, None]
    assert tuple(loans.malformed_rows(df, "bad").first()) == (3, 1)


def test_csv_missing_path(spark):
    with pytest.raises(FileNotFoundError):
        loans.read_loans_csv(spark, "/tmp/no-such-loans.csv")


# --- distributions ------------------------------------------------------------------
def test_kde_of_heavy_tails_equals_the_direct_sum(spark):
    rng = np.random.default_rng(1)
    x = np.append(rng.lognormal(11, 0.8, 4000), 1.1e8)
    got = distribution.kde_curve(frame(spark, x=x), ["x"]).collect()
    h = x.std(ddof=1) * len(x) ** -0.2
    for r in got:
        want = np.exp(-0.5 * ((r.x - x) / h) ** 2).sum() / (len(x) * h * math.sqrt(2 * math.pi))
        assert r.density == pytest.approx(want, rel=1e-9, abs=1e-18)


@pytest.mark.parametrize("kind", ["uniform", "two_peaks", "far_from_zero", "few"])
def test_kde_series_equals_the_direct_sum(spark, kind):
    rng = np.random.default_rng(4)
    x = {"uniform": rng.random(3000), "two_peaks": np.append(rng.normal(0, 1, 2000), rng.normal(40, .1, 50)),
         "far_from_zero": 1e6 + rng.normal(0, 1, 2000), "few": np.array([1.0, 2.0, 7.0])}[kind]
    df = frame(spark, x=x)
    got = distribution.kde_curve(df, ["x"]).collect()
    h = x.std(ddof=1) * len(x) ** -0.2
    want = [np.exp(-0.5 * ((r.x - x) / h) ** 2).sum() / (len(x) * h * math.sqrt(2 * math.pi))
            for r in got]
    assert len(got) == 200
    assert [r.density for r in got] == pytest.approx(want, rel=1e-9, abs=1e-12 * max(want))
    _, cells = distribution.kde_cells(df, ["x"])
    assert cells.count() < len(x) / (10 if len(x) > 100 else 0.5)
    plan = cells._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" not in plan


def test_kde_of_a_constant_column_whose_merged_spread_is_not_zero(spark):
    # 1/49*49 is not 1: merging moves the mean of the first 49 rows, not that of the others.
    df = spark.range(0, 98, 1, 2).select(F.lit(1.0).alias("k"), F.col("id").cast("double").alias("x"))
    assert df.agg(F.stddev_samp("k")).first()[0] > 0
    got = distribution.kde_curve(df, ["k", "x"]).collect()
    want = distribution.kde_curve(df, ["x"]).collect()
    assert [r[:3] for r in got] == [r[:3] for r in want] and len(got) == 200
    assert [r.density for r in got] == pytest.approx([r.density for r in want], rel=1e-12)
    assert distribution.kde_curve(df, ["k"]).collect() == []


@pytest.mark.parametrize("kind", ["zero_inflated", "heavy", "bell"])
def test_histogram_equals_numpy_auto(spark, kind):
    rng = np.random.default_rng(2)
    x = {"zero_inflated": np.where(rng.random(5000) < 0.85, 0.0, rng.exponential(3, 5000)),
         "heavy": rng.lognormal(0, 2, 5000), "bell": rng.normal(0, 1, 5000)}[kind]
    got = distribution.histogram(frame(spark, x=x), ["x"]).collect()
    edges = np.histogram_bin_edges(x, "auto")
    assert len(got) == len(edges) - 1
    assert [r.lower for r in got] == pytest.approx(edges[:-1].tolist())
    assert sum(r["count"] for r in got) == len(x)


def test_corr_of_a_column_constant_over_the_pairs(spark):
    df = spark.createDataFrame([(v, float(i) if i < 5 else None, 0.1 if i < 5 else float(i))
                                for i, v in enumerate(np.linspace(0, 1, 12).tolist())],
                               "z double, y double, x double")
    got = {(r.col_x, r.col_y): r["corr"] for r in correlate.corr_matrix(df, list("xyz")).collect()}
    assert got["x", "y"] is None and got["y", "x"] is None
    want = df.toPandas().corr()
    for (a, b), r in got.items():
        assert r is None if math.isnan(want[a][b]) else r == pytest.approx(want[a][b])


# --- ordered statistics --------------------------------------------------------------
def test_prefix_sums_with_several_levels_of_buckets(spark):
    df = spark.range(3000).select((F.col("id") * 7919 % 3001).cast("double").alias("v"),
                                  (F.col("id") % 5).alias("w"))
    b = ordered.add_buckets(df, "v", 600, first_fan=8, next_fan=8)
    sizes = [r["count"] for r in b.groupBy("__bucket").count().collect()]
    assert len(sizes) > 300 and max(sizes) < 40
    for down in (False, True):
        got = ordered.cumulative_sums(df, "v", ["w"], descending=down, rows_per_bucket=5,
                                      first_fan=8).toPandas().sort_values("v", ascending=not down)
        assert got.cum_w.tolist() == got.w.cumsum().tolist()


@pytest.mark.parametrize("n", [1, 2, 12, 999, 20_000])
def test_quantiles_equal_numpy_with_hot_values_and_groups(spark, n):
    rng = np.random.default_rng(n)
    x = np.where(rng.random(n) < 0.4, 7.0, rng.lognormal(2, 2, n))
    g = (np.arange(n) % 2).astype(int)
    df = frame(spark, g=g, x=x)
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    for r in ordered.exact_quantiles(df, ["x"], probs, rows_per_bucket=50).collect():
        assert r.value == pytest.approx(np.quantile(x, r.prob), rel=1e-12)
    got = ordered.exact_quantiles(df, ["x"], probs, ["g"]).collect()
    assert len(got) == len(probs) * len(set(g.tolist()))
    for r in got:
        assert r.value == pytest.approx(np.quantile(x[g == r.g], r.prob), rel=1e-12)


# --- evaluation, stability, plan ------------------------------------------------------
def test_rows_without_a_score_are_not_dropped_unseen(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.2), (1, None), (None, None)],
                               "label int, score double")
    with pytest.raises(evaluate.UnscoredRows, match="1 labelled"):
        evaluate.curve_metrics(df)
    with pytest.raises(Exception, match="1 labelled rows have no score"):
        evaluate.confusion_matrix(df).collect()
    whole = df.filter("score is not null")
    assert sum(r["count"] for r in evaluate.confusion_matrix(whole).collect()) == 2


def test_report_at_the_best_threshold(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.4), (0, 0.3), (0, 0.1)], "label int, score double")
    rows = {r.row: r for r in evaluate.optimal_report(df).collect()}
    assert rows["accuracy"].f1 == 1.0 and rows["Good Loan (0)"].support == 2
    cells = {(r.actual, r.predicted): r["count"] for r in evaluate.optimal_confusion(df).collect()}
    assert cells == {(0, 0): 2, (0, 1): 0, (1, 0): 0, (1, 1): 2}


def test_undefined_psi_is_an_empty_table(spark):
    df = spark.createDataFrame([("expected", 1.0), ("expected", 1.0), ("actual", 2.0)],
                               "side string, value double")
    assert stability.psi_table(df).collect() == []
    r = stability.psi(df).first()
    assert (r.psi, r.n_bins, r.band) == (None, 0, None)


def test_plan_routes_only_what_is_there(spark):
    df = spark.createDataFrame([(0, 1.0, 2.0, "Jan-2015")] * 3,
                               "is_bad int, loan_amnt double, pub_rec double, issue_d string")
    plan = fit_plan(df)
    assert set(plan.standard + plan.skewed) == {"loan_amnt", "pub_rec_binary"}
    both = fit_plan(df.withColumn("earliest_cr_line", F.lit("Jan-2001")))
    assert "credit_hist_years" in both.standard
    assert "credit_hist_years" not in fit_plan(df.withColumn("earliest_cr_line", F.lit("Jan-2001")),
                                               use_issue_date=False).standard


def test_mode_ties_of_many_values(spark):
    df = spark.range(3000).select((F.col("id") % 1500).cast("string").alias("c"))
    r = profile.impute_mode(df, ["c"]).first()
    assert (r["mode"], r["count"]) == ("0", 2)


def test_lambdas_of_all_scales_take_few_scans(spark):
    rng = np.random.default_rng(5)
    n = 3000
    x = {"left": 100 - rng.exponential(3, n), "plain": rng.normal(10, 2, n),
         "fractions": 0.001 * (1 - rng.exponential(0.03, n)), "income": rng.lognormal(11, 0.8, n),
         "signed": rng.standard_t(4, n), "counts": rng.poisson(0.3, n).astype(float),
         "negative": -rng.lognormal(2, 1, n), "one": 1 - rng.exponential(0.03, n)}
    lams, scans = X.search_lambdas(frame(spark, **x), list(x))
    assert scans <= 6
    for (name, v), lam in zip(x.items(), lams):
        step = 1e-3 * max(1.0, abs(lam))
        here, below, above = (log_likelihood(v, lam + d) for d in (0, -step, step))
        assert here >= below and here >= above, name
        # The slope at λ, in units of the curvature, is a hundredth of the step.
        assert abs((above - below) / (above - 2 * here + below)) / 2 < 0.02, name


def test_derivatives_of_the_map(spark):
    rows = [(x, lam) for x in (-30.0, -0.5, -1e-9, 0.0, 1e-6, 0.04, 3.0, 900.0)
            for lam in (-2.0, 0.0, 1e-9, 0.3, 1.0, 2.0, 2.0 + 1e-9, 3.5)]
    df = spark.createDataFrame(rows, "x double, lam double")
    for r in df.select("x", "lam", *[c.alias(n) for n, c in zip(
            ("y", "d1", "d2"), X._map_terms(F.col("x"), F.col("lam")))]).collect():
        def y(lam):
            m = math.log1p(abs(r.x)) * (lam if r.x >= 0 else 2 - lam)
            return math.copysign(1, r.x) * math.log1p(abs(r.x)) * (math.expm1(m) / m if m else 1)
        e = 1e-4
        assert r.y == pytest.approx(y(r.lam), rel=1e-12, abs=1e-15)
        assert r.d1 == pytest.approx((y(r.lam + e) - y(r.lam - e)) / (2 * e), rel=1e-5, abs=1e-11)
        assert r.d2 == pytest.approx((y(r.lam + e) - 2 * y(r.lam) + y(r.lam - e)) / e ** 2,
                                     rel=1e-3, abs=1e-6 * max(1, abs(r.y)))


def test_likelihood_from_cells_equals_the_scan(spark):
    """Mean, spread and slopes at any λ follow from the cells, for signs, offsets and gaps."""
    rng = np.random.default_rng(12)
    n = 3000
    x = {"signs": rng.normal(0, 40, n), "heavy": rng.lognormal(8, 1.5, n),
         "far": 1e6 + rng.normal(0, 1, n), "negative": -rng.lognormal(1, 1, n),
         "zeros": np.where(rng.random(n) < 0.8, 0.0, rng.exponential(3, n)),
         "left": 100.0 - 60.0 / (1 + rng.integers(0, 41, n))}
    df = frame(spark, **x)
    cells = X._power_cells(df, list(x))
    points = {c: [-2.0, 0.0, 0.3, 1.0, 2.0, 5.5] for c in x}
    want = {r["column"]: r for r in X._slopes(df, points, True).collect()}
    for c in x:
        got, w = cells[c].slopes(points[c]), want[c]
        assert got["n"] == w["n"] and cells[c].reaches(points[c])
        assert [got["t"], got["s"]] == pytest.approx([w["t"], w["s"]], rel=1e-9)
        for g, a in zip(got["at"], w["at"]):
            assert g["mean"] == pytest.approx(a["mean"], rel=1e-9)
            if a["var"] < (1e-6 * a["mean"]) ** 2:
                continue  # the scan's own sums cancel here
            scale = math.sqrt(a["v1"] * a["var"])
            assert g["var"] == pytest.approx(a["var"], rel=1e-7)
            assert g["v1"] == pytest.approx(a["v1"], rel=1e-7)
            assert g["c1"] == pytest.approx(a["c1"], abs=1e-7 * scale)
            assert g["c2"] == pytest.approx(a["c2"], rel=1e-6)


def test_lambda_search_scans_twice_and_more_only_beyond_the_cells(spark, monkeypatch):
    rng = np.random.default_rng(13)
    n = 2000
    x = {"heavy": rng.lognormal(8, 1.5, n), "left": 100.0 - 60.0 / (1 + rng.integers(0, 41, n)),
         "flat": np.full(n, 7.0)}
    lams, scans = X.search_lambdas(frame(spark, **x), list(x))
    assert scans == 2 and lams[2] == 1.0
    # Most values in one cell: the best λ lies where only scans reach.
    wide = {"x": np.append(rng.exponential(1e-6, n), 1e4)}
    got, scans = X.search_lambdas(frame(spark, **wide), ["x"])
    assert scans > 2
    # An infinite value: no likelihood, as before.
    assert X.search_lambdas(frame(spark, x=np.append(rng.random(50), np.inf)), ["x"])[0] == [1.0]
    monkeypatch.setattr(X, "_power_cells", lambda df, cols: {})  # scans alone
    assert X.search_lambdas(frame(spark, **x), list(x))[0] == pytest.approx(lams, abs=1e-4)
    assert X.search_lambdas(frame(spark, **wide), ["x"])[0] == pytest.approx(got, rel=1e-4)
