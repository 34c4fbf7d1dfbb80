"""Means and variances of amounts from exact sums.

A sum of doubles depends on the order of its terms, so two runs can differ in
the last bit and round differently. Amounts are therefore counted in whole
units of 1/10,000 (prices have two decimals): units and squared units are
summed as ``decimal(38,0)``, which is exact in any order and merges over tasks,
stages and streams, and means and variances are derived once at the end.
Amounts with more decimals are rounded to the unit; NaN counts as NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from cartwright.functions.numeric import safe_divide

#: units of an amount of 1
UNITS = 10_000


def units(amount: Column) -> Column:
    """The amount in whole units."""
    return F.round(amount * UNITS).try_cast("decimal(18,0)")


def amount(total: Column) -> Column:
    """The double nearest to a number of units."""
    return total.cast("double") / UNITS


def exact_sum(values: Column) -> Column:
    """The sum of amounts, the same for any order of the rows (NULL without a value)."""
    return amount(F.sum(units(values)))


def sums(values: Column, tag: str) -> list[Column]:
    """Aggregates n, s1 and s2 of amounts, which ``mean`` and ``variance`` read by their tag."""
    u = units(values)
    return [F.count(u).alias(f"n_{tag}"), F.sum(u).alias(f"s1_{tag}"),
            F.sum((u * u).cast("decimal(38,0)")).alias(f"s2_{tag}")]


def merged(tag: str) -> list[Column]:
    """The same aggregates over rows that already are sums."""
    return [F.sum(f"n_{tag}").alias(f"n_{tag}"), F.sum(f"s1_{tag}").cast("decimal(28,0)").alias(f"s1_{tag}"),
            F.sum(f"s2_{tag}").cast("decimal(38,0)").alias(f"s2_{tag}")]


def mean(tag: str) -> Column:
    return safe_divide(F.col(f"s1_{tag}").cast("double"), F.col(f"n_{tag}") * F.lit(float(UNITS)))


def variance(tag: str) -> Column:
    """Sample variance, NULL below two values.

    The squared distances from a whole number near the mean are exact; only
    the small rest is a double, so nothing cancels.
    """
    whole = lambda x: x.cast("decimal(38,0)")
    n, s1, s2 = whole(F.col(f"n_{tag}")), F.col(f"s1_{tag}"), F.col(f"s2_{tag}")
    near = F.floor(safe_divide(s1.cast("double"), n.cast("double"))).cast("decimal(18,0)")
    rest = (whole(s1) - whole(n * near)).cast("double")
    far = whole(s2) - whole(F.lit(2).cast("decimal(1,0)") * near * s1) + whole(whole(near * near) * n)
    count = F.col(f"n_{tag}").cast("double")
    spread = far.cast("double") - safe_divide(rest * rest, count)
    return F.when(count > 1, safe_divide(F.greatest(spread, F.lit(0.0)),
                                         (count - 1) * F.lit(float(UNITS) ** 2)))


def deviation(tag: str) -> Column:
    return F.sqrt(variance(tag))
