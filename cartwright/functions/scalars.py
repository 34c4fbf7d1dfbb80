"""Attach the columns of a one-row aggregate to another frame.

A one-row result (a total, a baseline, a test statistic) is read as a
scalar subquery: Spark runs it once and uses its value in the outer plan,
so no join (and no cross product) is planned for it. The row is packed
into one struct so a single subquery serves all of its columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def with_scalars(df: DataFrame, one_row: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``df`` plus the columns ``cols`` of the one-row frame ``one_row``."""
    cols = list(cols or one_row.columns)
    packed = one_row.select(F.struct(*cols).alias("_row")).scalar()
    return (df.withColumn("_row", packed)
              .select("*", *[F.col("_row")[c].alias(c) for c in cols])
              .drop("_row"))
