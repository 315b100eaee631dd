import math

import pytest
from pyspark.sql import functions as F

from evenkeel.functions import statistics as st


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("z", [0.0, 1e-6, 0.1, 0.7, 1.0, 1.96, 3.0, 5.0, 8.0, 20.0])
def test_normal_tail(spark, z):
    expected = math.erfc(z / math.sqrt(2))
    assert value(spark, st.normal_two_sided(F.lit(z))) == pytest.approx(expected, rel=1e-9, abs=1e-15)


@pytest.mark.parametrize("x", [0.01, 1.0, 9.7811, 40.0, 500.0])
@pytest.mark.parametrize("k", [2, 4, 10, 100])
def test_chi_square_even_degrees(spark, x, k):
    """Closed form for even degrees: a Poisson sum."""
    h = x / 2
    expected = math.fsum(math.exp(i * math.log(h) - h - math.lgamma(i + 1)) for i in range(k // 2))
    got = value(spark, st.chi_square_tail(F.lit(x), F.lit(k)))
    assert got == pytest.approx(expected, rel=1e-8, abs=1e-13)


def test_chi_square_many_degrees(spark):
    """A million degrees: the middle of the distribution, by the cube-root normal form."""
    k = 1_000_001
    for x in (k - 2000.0, float(k), k + 3000.0):
        c = 2 / (9 * k)
        expected = 0.5 * math.erfc(((x / k) ** (1 / 3) - (1 - c)) / math.sqrt(c) / math.sqrt(2))
        assert value(spark, st.chi_square_tail(F.lit(x), F.lit(k))) == pytest.approx(expected, abs=1e-5)


def test_chi_square_undefined(spark):
    assert value(spark, st.chi_square_tail(F.lit(1.0), F.lit(0))) is None
    assert value(spark, st.chi_square_tail(F.lit(None).cast("double"), F.lit(3))) is None
    assert value(spark, st.chi_square_tail(F.lit(0.0), F.lit(3))) == 1.0


def test_log_gamma(spark):
    for a in (0.5, 1.0, 1.5, 7.0, 123.5, 1e5):
        assert value(spark, st.log_gamma(F.lit(a))) == pytest.approx(math.lgamma(a), rel=1e-12, abs=1e-11)


def test_kolmogorov_tail(spark):
    assert value(spark, st.kolmogorov_tail(F.lit(0.0), F.lit(10), F.lit(10))) == 1.0
    assert value(spark, st.kolmogorov_tail(F.lit(1.0), F.lit(500), F.lit(500))) < 1e-12
    got = value(spark, st.kolmogorov_tail(F.lit(0.65), F.lit(2), F.lit(2)))
    assert got == pytest.approx(0.7920130315089251, rel=1e-12)
    assert value(spark, st.kolmogorov_tail(F.lit(0.5), F.lit(0), F.lit(0))) is None
