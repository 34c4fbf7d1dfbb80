"""Numeric helpers shared by the models."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def safe_divide(num: Column, den: Column) -> Column:
    """NULL when the denominator is 0 or NULL (never raises under ANSI)."""
    return F.try_divide(num, den)


def flag(cond: Column) -> Column:
    """1 when ``cond`` is true, else 0 (NULL conditions give 0, as CASE does)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def sum_flag(cond: Column) -> Column:
    return F.sum(flag(cond)).cast("bigint")
