"""Statistical kernels as functions of columns; none of them fails on zero counts, they give NULL."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two-sided 95 % normal quantile, and the rounded cut of residual tests.
Z95 = 1.959963984540054
CUT = 1.96


class Interval(NamedTuple):
    low: Column
    high: Column


def ratio(a: Column, b: Column) -> Column:
    """a / b as double; NULL where b is 0."""
    return F.when(b != 0, a.cast("double") / b.cast("double"))


def share(condition: Column) -> Column:
    """Aggregate: the share of all rows for which a condition holds."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def wilson(hits: Column, n: Column) -> Interval:
    """95 % Wilson score interval of a proportion, within [0, 1]."""
    p, size = ratio(hits, n), n.cast("double")
    shrink = 1 + Z95**2 / size
    middle = (p + Z95**2 / (2 * size)) / shrink
    half = Z95 * F.sqrt((p * (1 - p) + Z95**2 / (4 * size)) / size) / shrink
    held = lambda x: F.when(n > 0, F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0)))
    return Interval(held(middle - half), held(middle + half))


def proportion_z(p: Column, expected: Column, n: Column) -> Column:
    """Absolute distance of a proportion from its expectation, in its standard errors."""
    return ratio(F.abs(p - expected), F.sqrt(p * (1 - p) / n.cast("double")))


def margin(ci: Interval, expected: Column) -> Column:
    """Percentage points between an interval and the expectation: positive where the interval excludes it,
    else minus the distance to the nearer end."""
    above, below = ci.low - expected, expected - ci.high
    inside = -F.least(F.abs(above), F.abs(below))
    return 100 * F.when(above > 0, above).when(below > 0, below).otherwise(inside)


def excludes(ci: Interval, expected: Column) -> Column:
    """1 if the interval lies above the expectation, -1 below, 0 if it holds it; NULL without an interval."""
    return F.when(ci.low > expected, 1).when(ci.high < expected, -1).when(ci.low.isNotNull() & ci.high.isNotNull(), 0)


def difference(p1: Column, n1: Column, p2: Column, n2: Column) -> tuple[Column, Column, Interval]:
    """Difference of two proportions, its unpooled standard error and 95 % interval."""
    gap = p1 - p2
    error = F.when((n1 > 0) & (n2 > 0), F.sqrt(p1 * (1 - p1) / n1.cast("double") + p2 * (1 - p2) / n2.cast("double")))
    return gap, error, Interval(gap - Z95 * error, gap + Z95 * error)


def poisson_residual(observed: Column, expected: Column) -> Column:
    """Standardised residual of a count."""
    return F.when(expected > 0, (observed - expected) / F.sqrt(expected))


def pearson(n: Column, x: Column, y: Column, xy: Column, xx: Column, yy: Column) -> Column:
    """Correlation from sums, kept inside (-1, 1) so that it can be transformed; NULL for a constant side."""
    vx, vy = n * xx - x * x, n * yy - y * y
    r = (n * xy - x * y) / F.sqrt(vx * vy)
    return F.when((vx > 0) & (vy > 0), F.greatest(F.least(r, F.lit(0.999999)), F.lit(-0.999999)))


def fisher_interval(r: Column, n: Column) -> Interval:
    """95 % interval of a correlation by Fisher's transformation; NULL for up to 3 pairs."""
    z, error = F.atanh(r), F.when(n > 3, 1 / F.sqrt(n.cast("double") - 3))
    return Interval(F.tanh(z - Z95 * error), F.tanh(z + Z95 * error))


def correlation_t(r: Column, n: Column) -> Column:
    """The t statistic of a correlation."""
    return F.when(n > 2, r * F.sqrt(n.cast("double") - 2) / F.sqrt(1 - r * r))


def clipped_inverse(propensity: Column, low: float = 0.2, high: float = 5.0) -> Column:
    """Inverse propensity, clipped; NULL where the propensity isn't positive."""
    return F.when(propensity > 0, F.greatest(F.least(1 / propensity, F.lit(high)), F.lit(low)))


def effective_n(weight: Column) -> Column:
    """Aggregate: Kish's effective sample size."""
    return ratio(F.sum(weight) * F.sum(weight), F.sum(weight * weight))


def shrunk(rate: Column, n: Column, usual: Column) -> Column:
    """A rate drawn towards one half in proportion to how far n falls short of the usual n."""
    trust = F.when(usual.isNull() | (usual == 0) | (n >= usual), 1.0).otherwise(n / usual)
    return 0.5 + (rate - 0.5) * trust


def decisive_rate(wins: Column, n: Column, draws: Column) -> Column:
    """Wins among results that aren't draws; NULL if all are."""
    return ratio(wins, n - draws)


def half_of(number: Column, last: Column) -> Column:
    """'EARLY' for the first half of the numbers up to ``last``, else 'LATE'."""
    return F.when(2 * number <= last, "EARLY").otherwise("LATE")


def elo(strength: Column) -> Column:
    """Elo-scaled strength; minus infinity for no strength."""
    return F.when(strength > 0, 1500 + 400 * F.log10(strength)).otherwise(F.lit(float("-inf")))
