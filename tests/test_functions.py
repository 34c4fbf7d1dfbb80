"""Column helpers: formatting, calendar parts, variant key, safe division."""

import datetime as dt

from pyspark.sql import functions as F

from cartwright.functions.formatting import money, percent, signed, thousands
from cartwright.functions.hashing import variant_key, variant_of
from cartwright.functions.numeric import flag, safe_divide
from cartwright.operators.calendar import calendar_parts


def test_formatting(spark):
    r = spark.createDataFrame([(1234567.891, 0.7543, -3712.85)], "m double, r double, d double").select(
        money(F.col("m")).alias("m"), percent(F.col("r")).alias("p"), percent(F.col("r"), 0).alias("p0"),
        thousands(F.col("m")).alias("t"), signed(F.col("d")).alias("s"),
        signed(F.lit(2.5)).alias("s2")).first()
    assert (r.m, r.p, r.p0, r.t, r.s, r.s2) == ("£1234567.89", "75.4%", "75%", "1,234,568", "-3712.85", "+2.50")


def test_calendar_parts(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 29),), (dt.date(2023, 11, 5),)], "d date")
    rows = sorted(df.select(*calendar_parts(F.col("d"))).collect())
    assert [tuple(r) for r in rows] == [(2023, 11, "November", 4, "Qtr 4", 5),
                                       (2024, 2, "February", 1, "Qtr 1", 29)]


def test_variant_key_and_safe_divide(spark):
    df = spark.createDataFrame([(123, 0), (None, 5)], "uid bigint, den int")
    r = df.select(variant_key(F.col("uid")).alias("k"), variant_of(variant_key(F.col("uid"))).alias("v"),
                  safe_divide(F.lit(1), F.col("den")).alias("q"), flag(F.col("den") > 1).alias("f")).collect()
    # md5('123') ends in '0' -> even -> control
    assert (r[0].k, r[0].v, r[0].q, r[0].f) == (0, "control", None, 0)
    assert (r[1].k, r[1].v, r[1].q, r[1].f) == (None, "treatment", 0.2, 1)
