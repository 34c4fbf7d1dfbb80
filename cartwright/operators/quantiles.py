"""Exact quantiles per group by narrowing, in one lazy plan.

Spark's ``percentile``/``median`` keep every value of a group in one
aggregation buffer, and here a group is an experiment variant (about half of
the fact table). This operator gives the same exact, linearly interpolated
quantiles (numpy/pandas default, DuckDB ``quantile_cont``) from a few
aggregates with bounded state, and writes nothing:

1. equal values are collapsed: ``groupBy(g, x).count()`` (map-side combine, so
   a hot value is one row a task); every later step reads this one exchange;
2. per group the number of values and their range give the ranks wanted (for a
   quantile the order statistics below and above it) and a first interval;
3. a pass cuts each interval into ``BINS`` bins, counts their values and notes
   the least and largest one of each, and keeps the bin that holds the rank: its
   own least and largest value are the next interval. Bins follow the values, so
   an outlier costs one pass and not the resolution;
4. after ``PASSES`` passes the values inside the interval (few, as each pass
   divides them by up to ``BINS``) are summed up in order to the rank.

What a pass hands on is one row (a struct for each group and rank), read by the
next one as a scalar subquery: no join, no shuffle of the values by group, and
no job before the result is asked for. The row grows with the number of groups,
which are meant to be few (the variants of a test). Any number of values, equal
values or outliers in a group changes only how many values step 4 sees.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: bins of one pass, and passes
BINS = 4096
PASSES = 2


def _packed(state: DataFrame) -> Column:
    """All rows of a small frame as one array, read as a scalar subquery."""
    return state.agg(F.collect_list(F.struct(*state.columns)).alias("s")).scalar()


def _wanted(distinct: DataFrame, probs: list[float]) -> DataFrame:
    """(group, rank, lo, hi, below): the order statistics wanted and the whole range."""
    ranges = distinct.groupBy("g").agg(F.sum("w").alias("n"), F.min("x").alias("lo"),
                                       F.max("x").alias("hi"))
    upper = [F.least(F.floor(F.lit(p) * (F.col("n") - 1)) + 1, F.col("n") - 1) for p in probs]
    ranks = [F.floor(F.lit(p) * (F.col("n") - 1)) for p in probs] + upper
    return ranges.select("g", "n", "lo", "hi", F.lit(0).cast("long").alias("below"),
                         F.explode(F.array_distinct(F.array(*ranks))).alias("rank"))


def _inside(distinct: DataFrame, state: DataFrame) -> DataFrame:
    """The values within the interval of each wanted rank: (s, x, w)."""
    mine = F.filter("state", lambda s: (s["g"] == F.col("g")) & (F.col("x") >= s["lo"])
                    & (F.col("x") <= s["hi"]))
    return (distinct.withColumn("state", _packed(state))
            .select("g", "x", "w", F.explode(mine).alias("s")))


def _narrowed(distinct: DataFrame, state: DataFrame, bins: int) -> DataFrame:
    """The bin that holds the rank is the next interval."""
    lo, hi, x = F.col("s.lo"), F.col("s.hi"), F.col("x")
    # without a finite width everything is one bin: still exact
    spot = F.when(hi > lo, F.least(F.floor((x - lo) / (hi - lo) * bins), F.lit(bins - 1))).otherwise(0)
    counted = (_inside(distinct, state)
               .groupBy(F.col("s.g").alias("g"), F.col("s.n").alias("n"),
                        F.col("s.rank").alias("rank"), F.col("s.below").alias("before"),
                        spot.alias("bin"))
               .agg(F.sum("w").alias("w"), F.min("x").alias("lo"), F.max("x").alias("hi")))
    upto = Window.partitionBy("g", "rank").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.withColumn("end", F.col("before") + F.sum("w").over(upto))
    return (placed.withColumn("below", F.col("end") - F.col("w"))
            .where((F.col("rank") >= F.col("below")) & (F.col("rank") < F.col("end")))
            .select("g", "n", "lo", "hi", "below", "rank"))


def _selected(distinct: DataFrame, state: DataFrame) -> DataFrame:
    """(g, n, rank, x): the value at each wanted rank."""
    rows = _inside(distinct, state).select("s.g", "s.n", "s.rank", "s.below", "x", "w")
    upto = Window.partitionBy("g", "rank").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("end", F.col("below") + F.sum("w").over(upto))
    return (placed.where((F.col("rank") >= F.col("end") - F.col("w"))
                         & (F.col("rank") < F.col("end"))).select("g", "n", "rank", "x"))


def exact_quantiles(df: DataFrame, group_cols: list[str], value_col: str,
                    probs: list[float], names: list[str] | None = None,
                    bins: int = BINS, passes: int = PASSES) -> DataFrame:
    """One row per group: ``names[i]`` = exact ``probs[i]`` quantile of ``value_col``.

    Groups with only NULL values are absent (join to the group list when a
    NULL row is wanted), and rows with a NULL group key are ignored, as
    pandas groupby does; so are NaN values.
    """
    names = names or [f"q{int(round(p * 100)):02d}" for p in probs]
    g = list(group_cols)
    x = F.col(value_col).cast("double")
    keep = x.isNotNull() & ~F.isnan(x)
    for c in g:
        keep = keep & F.col(c).isNotNull()
    distinct = (df.where(keep).select(F.struct(*g).alias("g"), x.alias("x"))
                .groupBy("g", "x").agg(F.count(F.lit(1)).alias("w")))
    state = _wanted(distinct, probs)
    for _ in range(passes):
        state = _narrowed(distinct, state, bins)
    found = _selected(distinct, state).groupBy("g", "n").agg(
        F.map_from_entries(F.collect_list(F.struct("rank", "x"))).alias("at"))

    def quantile(p: float) -> Column:
        pos = F.lit(float(p)) * (F.col("n") - 1)
        lo = F.floor(pos)
        a, b = F.col("at")[lo], F.col("at")[F.least(lo + 1, F.col("n") - 1)]
        return F.when(pos == lo, a).otherwise(a + (pos - lo) * (b - a))

    return found.select("g.*", *[quantile(p).alias(n) for n, p in zip(names, probs)])


def approx_quantiles(df: DataFrame, group_cols: list[str], value_col: str,
                     probs: list[float], names: list[str] | None = None,
                     accuracy: int = 10000) -> DataFrame:
    """Same shape as ``exact_quantiles`` from the percentile_approx sketch."""
    names = names or [f"q{int(round(p * 100)):02d}" for p in probs]
    pa = F.percentile_approx(F.col(value_col).cast("double"), [float(p) for p in probs], accuracy)
    out = df.groupBy(*group_cols).agg(pa.alias("_qs"))
    return out.select(*group_cols, *[F.col("_qs")[i].alias(n) for i, n in enumerate(names)])


def quantile_columns(method: str):
    known = {"exact": exact_quantiles, "approx": approx_quantiles}
    if method not in known:
        raise ValueError(f"unknown quantile method {method!r}; use one of {sorted(known)}")
    return known[method]
