"""Display formatting (FN14): currency, percent, thousands, signed values.

These produce text columns for display next to (never instead of) the
numeric columns. Numbers are rounded (half up) to the digits shown before they
are formatted, so that every formatter prints the same text.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

CURRENCY = "£"   # fixed value: the reference reports money in pounds


def money(c: Column, digits: int = 2) -> Column:
    return F.format_string(f"{CURRENCY}%.{digits}f", F.round(c, digits))


def percent(c: Column, digits: int = 1) -> Column:
    return F.format_string(f"%.{digits}f%%", F.round(c * 100, digits))


def thousands(c: Column) -> Column:
    return F.format_number(c, 0)


def signed(c: Column, digits: int = 2) -> Column:
    return F.format_string(f"%+.{digits}f", F.round(c, digits))
