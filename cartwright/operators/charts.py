"""Chart and headline data (CD1-CD6, AG12-AG14, SO4-SO7).

Only the data behind each chart is computed; drawing is left to whatever
reads the (small) results. Category and channel frames have one row per
category/channel; the order-value frames have one row per variant and bin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cartwright.functions.numeric import safe_divide
from cartwright.functions.scalars import with_scalars
from cartwright.operators.quantiles import quantile_columns

HIST_BINS = 30          # fixed value: bins per variant in the order-value histogram
WHISKER = 1.5           # fixed value: box-plot whisker reach in IQRs
TOP_N = 10              # fixed value: categories shown in the margin chart


def category_rollup(category_mart: DataFrame) -> DataFrame:
    """Departments summed per category; margin % re-derived; mean return rate.

    The return rate is the unweighted mean of the department rates, as the
    headline block computes it (named ``return_rate_mean``). NULL categories
    are dropped (pandas groupby drops NULL keys).
    """
    return (category_mart.where(F.col("category").isNotNull())
            .groupBy("category")
            .agg(F.sum("gross_revenue").alias("gross_revenue"),
                 F.sum("gross_margin").alias("gross_margin"),
                 F.sum("cost_of_goods").alias("cost_of_goods"),
                 F.avg("return_rate").alias("return_rate_mean"))
            .withColumn("gross_margin_pct", safe_divide(F.col("gross_margin"), F.col("gross_revenue"))))


def category_top10(category_mart: DataFrame, n: int = TOP_N) -> DataFrame:
    """Top categories by gross margin (ties by name); rank 1 = largest margin.

    ``orderBy(..).limit(n)`` plans as a top-k (TakeOrderedAndProject): each
    task keeps its n best rows, no full sort.
    """
    top = (category_rollup(category_mart)
           .orderBy(F.col("gross_margin").desc(), F.col("category").asc())
           .limit(n))
    ranked = top.select(
        "category",
        F.round("gross_revenue", 2).alias("gross_revenue"),
        F.round("cost_of_goods", 2).alias("cost_of_goods"),
        F.round("gross_margin", 2).alias("gross_margin"),
        F.round("gross_margin_pct", 6).alias("gross_margin_pct"),
        F.round("return_rate_mean", 6).alias("return_rate_mean"))
    # rank within the n kept rows (a window over at most n rows)
    w = Window.orderBy(F.col("gross_margin").desc(), F.col("category").asc())
    return ranked.withColumn("rank", F.row_number().over(w))


def headline_figures(category_mart: DataFrame, retention_mart: DataFrame,
                     channel_mart: DataFrame, n: int = TOP_N) -> DataFrame:
    """The headline block as one row.

    Overall repeat rate is a ratio of sums over cohorts; the best channel is
    the highest revenue per customer; best/worst margin and worst returns are
    taken within the top-n categories by margin. Ties go to the name that
    sorts first.
    """
    overall = retention_mart.agg(
        F.round(safe_divide(F.sum("repeat_customers"), F.sum("new_customers")), 6)
        .alias("overall_repeat_rate"))
    chan = channel_mart.where(F.col("traffic_source").isNotNull())
    # NULL keys sort last (as pandas puts NaN last), then ties by name
    best_key = F.struct(F.col("revenue_per_customer").isNull(), -F.col("revenue_per_customer"),
                        F.col("traffic_source"))
    best = chan.agg(
        F.min_by("traffic_source", best_key).alias("best_channel"),
        F.min_by("revenue_per_customer", best_key).alias("best_channel_revenue_per_customer"),
        F.min_by("repeat_purchase_rate", best_key).alias("best_channel_repeat_rate"))
    top = (category_rollup(category_mart)
           .orderBy(F.col("gross_margin").desc(), F.col("category").asc()).limit(n))
    pct, rr = F.col("gross_margin_pct"), F.col("return_rate_mean")
    hi = F.struct(pct.isNull(), -pct, F.col("category"))
    lo = F.struct(pct.isNull(), pct, F.col("category"))
    ret = F.struct(rr.isNull(), -rr, F.col("category"))
    cats = top.agg(
        F.min_by("category", hi).alias("best_margin_category"),
        F.round(F.min_by("gross_margin_pct", hi), 6).alias("best_margin_pct"),
        F.min_by("category", lo).alias("worst_margin_category"),
        F.round(F.min_by("gross_margin_pct", lo), 6).alias("worst_margin_pct"),
        F.min_by("category", ret).alias("worst_returns_category"),
        F.round(F.min_by("return_rate_mean", ret), 6).alias("worst_returns_rate"))
    return with_scalars(with_scalars(overall, best), cats)


def retention_line(retention_mart: DataFrame) -> DataFrame:
    return (retention_mart.select("cohort_month", "new_customers", "repeat_purchase_rate")
            .orderBy("cohort_month"))


def channel_bars(channel_mart: DataFrame) -> DataFrame:
    return (channel_mart.select("traffic_source", "revenue_per_customer", "repeat_purchase_rate")
            .orderBy(F.col("revenue_per_customer").asc(), F.col("traffic_source").asc()))


def order_value_histogram(fct: DataFrame, bins: int = HIST_BINS) -> DataFrame:
    """Per variant: counts in ``bins`` equal-width bins over the variant's range.

    Bins are [lo + i w, lo + (i+1) w) with the last one closed, as numpy
    does; a variant with a single value gets the range value +- 0.5. Empty
    bins are kept (count 0). The per-variant ranges are a tiny aggregate
    (one row per variant) broadcast back to the rows.
    """
    f = fct.where(F.col("variant").isNotNull() & F.col("order_value").isNotNull())
    rng = (f.groupBy("variant").agg(F.min("order_value").alias("_mn"), F.max("order_value").alias("_mx"))
           .select("variant",
                   F.when(F.col("_mn") == F.col("_mx"), F.col("_mn") - 0.5).otherwise(F.col("_mn")).alias("lo"),
                   F.when(F.col("_mn") == F.col("_mx"), F.col("_mx") + 0.5).otherwise(F.col("_mx")).alias("hi")))
    idx = F.least(F.floor((F.col("order_value") - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))),
                  F.lit(bins - 1)).cast("int")
    counts = (f.join(rng, "variant")
              .groupBy("variant", idx.alias("bin")).agg(F.count(F.lit(1)).alias("orders")))
    grid = rng.select("variant", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / bins
    return (grid.join(counts, ["variant", "bin"], "left")
            .select("variant", "bin",
                    F.round(F.col("lo") + F.col("bin") * width, 6).alias("bin_low"),
                    F.round(F.col("lo") + (F.col("bin") + 1) * width, 6).alias("bin_high"),
                    F.coalesce(F.col("orders"), F.lit(0).cast("bigint")).alias("orders")))


def order_value_boxplot(fct: DataFrame, method: str = "exact") -> DataFrame:
    """Per variant: quartiles, IQR, whiskers at 1.5 IQR and the outlier count.

    Whiskers are the most extreme values inside the fences, but never end
    inside the box; outliers are the values outside the fences. Quartiles are exact (linear interpolation)
    unless ``method="approx"``.
    """
    f = fct.where(F.col("variant").isNotNull() & F.col("order_value").isNotNull())
    q = quantile_columns(method)(f, ["variant"], "order_value", [0.25, 0.5, 0.75],
                                 names=["q1", "median", "q3"])
    q = (q.withColumn("iqr", F.col("q3") - F.col("q1"))
          .withColumn("fence_low", F.col("q1") - WHISKER * F.col("iqr"))
          .withColumn("fence_high", F.col("q3") + WHISKER * F.col("iqr")))
    x = F.col("order_value")
    inside = (x >= F.col("fence_low")) & (x <= F.col("fence_high"))
    stats = (f.join(q.select("variant", "fence_low", "fence_high"), "variant")
             .groupBy("variant")
             .agg(F.count(F.lit(1)).alias("orders"),
                  F.min(F.when(inside, x)).alias("least_inside"),
                  F.max(F.when(inside, x)).alias("most_inside"),
                  F.count_if(~inside).alias("outliers")))
    j = (q.join(stats, "variant")
         .withColumn("whisker_low", F.least("least_inside", "q1"))
         .withColumn("whisker_high", F.greatest("most_inside", "q3")))
    return j.select("variant", "orders",
                    *[F.round(c, 4).alias(c) for c in ("q1", "median", "q3", "iqr",
                                                       "whisker_low", "whisker_high")],
                    "outliers")


def order_value_outliers(fct: DataFrame, method: str = "exact") -> DataFrame:
    """The outlier points themselves (one row per order), for the box plot."""
    f = fct.where(F.col("variant").isNotNull() & F.col("order_value").isNotNull())
    q = quantile_columns(method)(f, ["variant"], "order_value", [0.25, 0.75], names=["q1", "q3"])
    q = q.select("variant", (F.col("q1") - WHISKER * (F.col("q3") - F.col("q1"))).alias("lo"),
                 (F.col("q3") + WHISKER * (F.col("q3") - F.col("q1"))).alias("hi"))
    return (f.join(q, "variant")
            .where((F.col("order_value") < F.col("lo")) | (F.col("order_value") > F.col("hi")))
            .select("variant", "order_id", "order_value"))


def headline_display(headlines: DataFrame) -> DataFrame:
    """The headline block as labelled text lines (SK3), one row per line."""
    from cartwright.functions.formatting import money, percent
    c = F.col

    def line(i, label, *parts):
        return F.struct(F.lit(i).alias("line"), F.lit(label).alias("label"),
                        F.concat(*parts).alias("value"))
    lines = F.array(
        line(1, "Overall repeat purchase rate", percent(c("overall_repeat_rate"))),
        line(2, "Highest margin category (top 10)", c("best_margin_category"), F.lit(" ("),
             percent(c("best_margin_pct"), 0), F.lit(" margin)")),
        line(3, "Lowest margin category (top 10)", c("worst_margin_category"), F.lit(" ("),
             percent(c("worst_margin_pct"), 0), F.lit(" margin)")),
        line(4, "Highest return rate (top 10)", c("worst_returns_category"), F.lit(" ("),
             percent(c("worst_returns_rate"), 0), F.lit(" of items returned)")),
        line(5, "Best channel by rev/customer", c("best_channel"), F.lit(" ("),
             money(c("best_channel_revenue_per_customer"), 0), F.lit(", "),
             percent(c("best_channel_repeat_rate"), 0), F.lit(" repeat)")))
    return headlines.select(F.explode(lines).alias("l")).select("l.line", "l.label", "l.value")
