"""A kept baseline gives the two-sided PSI."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import stability as S


def frame(spark, expected, actual):
    rows = [("expected", None if v is None else float(v)) for v in expected]
    rows += [("actual", None if v is None else float(v)) for v in actual]
    return spark.createDataFrame(rows, "side string, value double")


R = np.random.default_rng(3)
E = R.normal(0, 1, 400).round(2).tolist()


@pytest.mark.parametrize("expected, actual", [
    (E, R.normal(0.3, 1, 300).round(2).tolist()),                       # both ends
    (E, R.uniform(-1, 1, 200).round(2).tolist()),                       # inside
    (E, [max(E)] * 5 + [0.0] * 9), (E, [max(E), max(E) + 1, 0.1]),      # at and above the largest
    (E, [min(E) - 1, 0.0]), (E + [None] * 7, [None, 1.0, float("nan")]),
    (E, [None, 0.5]), ([0.0] * 60 + [1.0] * 40, [0.0, 1.0, 1.0]),       # one bin: undefined
    ([0.0] * 60 + [1.0] * 40, [0.0, 1.0, 2.0]), ([1, 2, 3], [2.0])])
def test_equal_to_the_two_sided_form(spark, expected, actual):
    df = frame(spark, expected, actual)
    want = S.psi(df).first()
    base = S.PsiBaseline.fit(df.filter("side = 'expected'"))
    got = base.compare(base.counts_of(df.filter("side = 'actual'"))).first()
    assert (got.psi is None and want.psi is None) or got.psi == pytest.approx(want.psi)
    assert (got.band, got.n_bins, got.n_rows) == (want.band, want.n_bins, len(actual))


def test_batches_add_up_after_save_and_load(spark, tmp_path):
    df = frame(spark, E, R.normal(0, 2, 200).tolist())
    path = str(tmp_path / "baseline")
    S.PsiBaseline.fit(df.filter("side = 'expected'")).save(spark, path)
    base = S.PsiBaseline.load(spark, path)
    actual = df.filter("side = 'actual'").withColumn("day", (F.abs("value") * 100 % 3).cast("int"))
    by_day = base.counts_of(actual, "value", ("day",))
    assert base.compare(by_day, ("day",)).count() == 3
    assert base.compare(by_day).first().psi == pytest.approx(S.psi(df).first().psi)


def test_constant_or_empty_baseline(spark):
    assert S.PsiBaseline.fit(frame(spark, [2, 2], []).filter("side = 'expected'")) is None
    assert S.PsiBaseline.fit(frame(spark, [None], []).filter("side = 'expected'")) is None
