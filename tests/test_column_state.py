"""States of parts merge into the state of the whole."""

import math
import random

import pytest
from pyspark.sql import functions as F

from riskframe.operators import column_state as S
from riskframe.operators import clean, correlate, profile
from riskframe.sources import fixture

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(3)
    rows = [(i % 7, None if rng.random() < 0.2 else 1e6 + rng.gauss(0, 1), rng.expovariate(1.0),
             5.0, None if i % 7 else "x", float("nan") if i % 50 == 0 else float(i % 11),
             None if i % 13 == 0 else rng.randint(0, 1)) for i in range(2000)]
    rows += [(9, None, None, 5.0, None, None, None)]  # a part without values
    return spark.createDataFrame(rows, "part int, far double, exp double, same double, "
                                       "text string, nan double, y int").cache()


COLS = ["far", "exp", "same", "text", "nan", "y"]


def table(df):
    return {r.column: r for r in df.collect()}


def close(a, b):
    if a is None or b is None or isinstance(a, str):
        return a == b
    return a == pytest.approx(b, rel=1e-6, abs=1e-6)


def test_merged_parts_equal_the_whole(spark, frame, tmp_path):
    whole = table(S.column_state(frame, COLS, "y"))
    parts = S.column_state(frame, COLS, "y", ("part",))
    path = str(tmp_path / "states")
    for p in (0, 1):
        S.save_state(parts.filter((F.col("part") % 2 == p)), path)
    merged = table(S.load_state(spark, path))
    assert set(whole) == set(merged) == set(COLS)
    for c in COLS:
        for name in S.NUMBERS:
            assert close(whole[c][name], merged[c][name]), (c, name)
    assert whole["text"].n == 0 and whole["text"].n_missing > 0 and whole["nan"].n_missing == 1
    again = S.merge_states(S.merge_states(parts.filter("part < 3"), ()).unionByName(
        parts.filter("part >= 3").drop("part")))
    for c, r in table(again).items():
        assert all(close(whole[c][name], r[name]) for name in S.NUMBERS), c


def test_groups_merge_by_themselves(frame):
    parts = S.column_state(frame, ["exp"], None, ("part", "y"))
    got = {r.part: r for r in S.merge_states(parts, ("part",)).collect()}
    want = {r.part: r for r in S.column_state(frame, ["exp"], None, ("part",)).collect()}
    assert got.keys() == want.keys()
    assert all(close(got[p].m4, want[p].m4) and close(got[p].mean, want[p].mean) for p in got)


def test_statistics_of_a_state(frame):
    s = S.column_state(frame, COLS, "y").cache()
    x = [r.exp for r in frame.collect() if r.exp is not None]
    n, mean = len(x), sum(x) / len(x)
    m2, m3, m4 = (sum((v - mean) ** k for v in x) / n for k in (2, 3, 4))
    m = table(S.moments_of(s))
    assert m["exp"].skewness == pytest.approx(m3 / m2 ** 1.5 * math.sqrt(n * (n - 1)) / (n - 2))
    g2 = m4 / m2 ** 2 - 3
    assert m["exp"].kurtosis == pytest.approx((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))
    assert (m["same"].skewness, m["same"].kurtosis) == (0.0, 0.0)
    assert m["text"].skewness is None
    corr = table(S.corr_target_of(s))
    assert corr["same"]["corr"] is None and corr["y"]["corr"] == pytest.approx(1.0)
    assert corr["exp"]["corr"] == pytest.approx(frame.select(correlate.safe_corr("exp", "y")).first()[0])
    assert [r.column for r in S.near_zero_of(s).collect()] == ["same"]
    assert table(S.info_of(s))["text"].non_null == sum(r.text is not None for r in frame.collect())
    assert "text" in S.high_missing_of(s, 40.0) and "exp" not in S.high_missing_of(s, 40.0)
    assert [tuple(r) for r in S.missing_of(s).collect()] == [
        tuple(r) for r in clean.missing_table(frame, COLS).collect()]


def test_the_profile_reads_the_rows_once(spark):
    d = fixture.definitive_loans(spark, SF_SMALL)
    plan = profile.moments(d, ["loan_amnt", "int_rate"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [column") == 1 and plan.count("Generate inline") == 1


def test_empty_frame(frame):
    assert S.column_state(frame.limit(0), COLS, "y").count() == 0
    assert S.merge_states(S.column_state(frame.limit(0), COLS)).count() == 0
