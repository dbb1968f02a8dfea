"""Column helpers with pandas' rules for zero, infinity and missing values."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")
EPS = 1e-8


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def div_inf(a: Column | str, b: Column | str) -> Column:
    """a/b where x/0 is a signed infinity and 0/0 is NULL."""
    a, b = col(a), col(b)
    by_zero = F.when(a > 0, F.lit(INF)).when(a < 0, F.lit(-INF))
    return F.when(b == 0, by_zero).otherwise(F.try_divide(a, b))


def clip(c: Column | str, lo: float, hi: float) -> Column:
    """Bound c to [lo, hi]; NULL stays NULL (least/greatest alone would drop it)."""
    c = col(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(float(lo))), F.lit(float(hi))))


def nan_to_null(c: Column | str) -> Column:
    c = col(c)
    return F.when(~F.isnan(c), c)


def zero_if_not_finite(c: Column | str) -> Column:
    """NULL, NaN and both infinities become 0."""
    if isinstance(c, str):
        # One parsed expression: frames with a hundred columns are built much faster.
        return F.expr(f"CASE WHEN `{c}` IS NULL OR isnan(`{c}`) OR abs(`{c}`) = double('Infinity') THEN 0D ELSE `{c}` END")
    bad = c.isNull() | F.isnan(c) | c.isin(INF, -INF)
    return F.when(bad, F.lit(0.0)).otherwise(c)


def number(c: Column | str) -> Column:
    """Text to double, NULL where the text is no number."""
    return nan_to_null(col(c).try_cast("double"))


def sample_skew(pop_skew: Column, n: Column, lo: Column, hi: Column) -> Column:
    """Bias-corrected skewness from the population form; needs 3 rows, 0 on a flat frame."""
    scaled = pop_skew * F.sqrt(n * (n - 1)) / (n - 2)
    return F.when(n >= 3, F.when(lo == hi, F.lit(0.0)).otherwise(scaled))


def sample_kurt(pop_kurt: Column, n: Column, lo: Column, hi: Column) -> Column:
    """Bias-corrected excess kurtosis; needs 4 rows, -3 on a flat frame."""
    scaled = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * pop_kurt + 6)
    return F.when(n >= 4, F.when(lo == hi, F.lit(-3.0)).otherwise(scaled))


def corr_from_moments(n: Column, sx: Column, sy: Column, sxx: Column, syy: Column, sxy: Column) -> Column:
    """Pearson from sums over rows where both sides are present; NULL when a side is flat."""
    cov = sxy - sx * sy / n
    vx = sxx - sx * sx / n
    vy = syy - sy * sy / n
    return F.when((n > 1) & (vx > 0) & (vy > 0), cov / F.sqrt(vx * vy))


def gamma_half_step(a: Column) -> Column:
    """gamma(a + 1/2) / gamma(a) for a > 0: the asymptotic series at a + 16, brought back by the recurrence."""
    b = a + 16
    series = F.log(b) / 2 - 1 / (8 * b) + 1 / (192 * F.pow(b, 3)) - 1 / (640 * F.pow(b, 5)) + 17 / (14336 * F.pow(b, 7))
    back = F.aggregate(F.sequence(F.lit(0), F.lit(15)), F.lit(1.0), lambda acc, i: acc * (a + i) / (a + i + 0.5))
    return F.exp(series) * back


def correlation_pvalue(r: Column, n: Column, terms: int = 400) -> Column:
    """Two-sided p-value of a correlation r of n pairs under Student's t with n - 2 degrees of freedom.

    It is the regularised incomplete beta function I(1 - r^2; (n - 2) / 2, 1/2): a continued fraction where that
    converges fast, elsewhere one minus the power series of the complement. Missing for n < 3 or a missing r; 0 for |r| = 1.
    """
    a, x = (n.cast("double") - 2) / 2, r * r
    step = gamma_half_step(a) / F.sqrt(F.lit(math.pi))
    left = F.exp(a * F.log1p(-x))  # (1 - r^2)^a
    down = F.sequence(F.lit(terms), F.lit(1), F.lit(-1))

    def coefficient(k: Column) -> Column:
        m = F.floor(k / 2).cast("double")
        even = m * (0.5 - m) / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + 0.5 + m) / ((a + 2 * m) * (a + 2 * m + 1))
        return F.when(k % 2 == 0, even).otherwise(odd) * (1 - x)

    fraction = F.aggregate(down, F.lit(1.0), lambda f, k: 1 + coefficient(k) / f)
    tail = left * F.abs(r) * step / a / fraction
    series = F.aggregate(down, F.lit(1.0), lambda s, k: 1 + (a + k - 0.5) / (k + 0.5) * x * s)
    middle = 1 - 2 * F.abs(r) * left * step * series
    # The power series is summed only where its terms fall.
    small = x <= 1.5 / (a + 2.5)
    inside = F.when(small, middle).otherwise(tail)
    return F.when((n < 3) | r.isNull(), F.lit(None).cast("double")).when(x >= 1, F.lit(0.0)).otherwise(inside)
