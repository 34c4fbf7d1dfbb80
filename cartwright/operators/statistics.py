"""Experiment statistics on the one-row moments frame (SA1-SA13, CD7).

Every test reads ``variant_moments`` (counts, successes, means, variances per
variant, one aggregation pass over the fact) and is then column arithmetic
on that single row. Degenerate inputs (a missing variant, n < 2, zero
variance) give NULL through ``try_divide`` instead of raising.

Sign conventions follow the reference: z and t are control minus treatment;
lifts and the mean difference are treatment minus control.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cartwright.functions.distributions import (
    normal_quantile, normal_two_sided_p, t_quantile_two_sided, t_two_sided_p)
from cartwright.functions.hashing import CONTROL, TREATMENT
from cartwright.functions.numeric import safe_divide
from cartwright.functions.scalars import with_scalars
from cartwright.operators.experiment import DEFAULT, ExperimentConfig

c = F.col


def _wilson(succ: Column, n: Column, crit: float) -> tuple[Column, Column]:
    q = safe_divide(succ.cast("double"), n)
    crit2 = F.lit(crit * crit)
    denom = F.lit(1.0) + safe_divide(crit2, n)
    center = safe_divide(q + safe_divide(crit2, F.lit(2.0) * n), denom)
    dist = safe_divide(F.lit(crit) * F.sqrt(q * (F.lit(1.0) - q) / n + safe_divide(crit2, F.lit(4.0) * n * n)),
                       denom)
    return center - dist, center + dist


def _rounded(frame: DataFrame, digits: dict[str, int]) -> DataFrame:
    """The frame with some columns rounded for display; judge before this, not after."""
    return frame.select(*[F.round(c(n), digits[n]).alias(n) if n in digits else c(n)
                          for n in frame.columns])


def exact_ztest(moments: DataFrame, cfg: ExperimentConfig = DEFAULT,
                beside: tuple[str, ...] = ()) -> DataFrame:
    """Pooled two-proportion z-test on is_completed, Wilson intervals, lift; not rounded.

    ``beside`` names further columns of the row that are carried along.
    """
    crit = normal_quantile(1 - cfg.alpha / 2)
    p_c = safe_divide(c("conv_c").cast("double"), c("n_c"))
    p_t = safe_divide(c("conv_t").cast("double"), c("n_t"))
    pooled = safe_divide((c("conv_c") + c("conv_t")).cast("double"), c("n_c") + c("n_t"))
    var = pooled * (F.lit(1.0) - pooled) * (safe_divide(F.lit(1.0), c("n_c")) + safe_divide(F.lit(1.0), c("n_t")))
    z = safe_divide(p_c - p_t, F.sqrt(var))
    lo_c, hi_c = _wilson(c("conv_c"), c("n_c"), crit)
    lo_t, hi_t = _wilson(c("conv_t"), c("n_t"), crit)
    s = moments.select(
        c("n_c").alias("n_control"), c("n_t").alias("n_treatment"),
        c("conv_c").alias("completed_control"), c("conv_t").alias("completed_treatment"),
        p_c.alias("rate_control"), p_t.alias("rate_treatment"),
        lo_c.alias("ci_low_control"), hi_c.alias("ci_high_control"),
        lo_t.alias("ci_low_treatment"), hi_t.alias("ci_high_treatment"),
        (p_t - p_c).alias("absolute_lift"), z.alias("z_stat"), *beside)
    s = s.withColumn("p_value", normal_two_sided_p(c("z_stat")))
    return s.withColumn("significant", c("p_value") < cfg.alpha)


def conversion_ztest(moments: DataFrame, cfg: ExperimentConfig = DEFAULT) -> DataFrame:
    """``exact_ztest`` for display."""
    return _rounded(exact_ztest(moments, cfg), dict.fromkeys((
        "rate_control", "rate_treatment", "ci_low_control", "ci_high_control",
        "ci_low_treatment", "ci_high_treatment", "absolute_lift", "z_stat", "p_value"), 6))


def _welch_columns() -> dict[str, Column]:
    vn_c = safe_divide(c("var_c"), c("n_c"))
    vn_t = safe_divide(c("var_t"), c("n_t"))
    se2 = vn_c + vn_t
    df = safe_divide(se2 * se2, safe_divide(vn_c * vn_c, c("n_c") - 1) + safe_divide(vn_t * vn_t, c("n_t") - 1))
    return {
        "mean_control": c("mean_c"), "mean_treatment": c("mean_t"),
        "sd_control": F.sqrt(c("var_c")), "sd_treatment": F.sqrt(c("var_t")),
        "mean_diff": c("mean_t") - c("mean_c"),
        "se_diff": F.sqrt(se2),
        "t_stat": safe_divide(c("mean_c") - c("mean_t"), F.sqrt(se2)),
        "df_welch": df,
        "relative_lift": safe_divide(c("mean_t") - c("mean_c"), c("mean_c")),
    }


def exact_welch(moments: DataFrame, cfg: ExperimentConfig = DEFAULT,
                beside: tuple[str, ...] = ()) -> DataFrame:
    """Welch t-test on order value with a CI on the mean difference; not rounded."""
    cols = _welch_columns()
    s = moments.select(c("n_c").alias("n_control"), c("n_t").alias("n_treatment"),
                       *[v.alias(k) for k, v in cols.items()], *beside)
    s = (s.withColumn("p_value", t_two_sided_p(c("t_stat"), c("df_welch")))
          .withColumn("t_crit", t_quantile_two_sided(cfg.alpha, c("df_welch"))))
    s = (s.withColumn("ci_low", c("mean_diff") - c("t_crit") * c("se_diff"))
          .withColumn("ci_high", c("mean_diff") + c("t_crit") * c("se_diff")))
    return s.withColumn("significant", c("p_value") < cfg.alpha)


def aov_welch(moments: DataFrame, cfg: ExperimentConfig = DEFAULT) -> DataFrame:
    """``exact_welch`` for display: money to 4 digits, statistics to 6."""
    money = ["mean_control", "mean_treatment", "sd_control", "sd_treatment", "mean_diff",
             "se_diff", "ci_low", "ci_high"]
    stat = ["t_stat", "p_value", "t_crit", "relative_lift"]
    shown = exact_welch(moments, cfg).select(
        "n_control", "n_treatment", *money, *stat, "df_welch", "significant")
    return _rounded(shown, dict.fromkeys([*money, "df_welch"], 4) | dict.fromkeys(stat, 6))


def exact_guardrail(moments: DataFrame, cfg: ExperimentConfig = DEFAULT,
                    beside: tuple[str, ...] = ()) -> DataFrame:
    """Treatment return rate minus control's against the guardrail threshold; not rounded."""
    r_c = safe_divide(c("ret_c").cast("double"), c("n_c"))
    r_t = safe_divide(c("ret_t").cast("double"), c("n_t"))
    diff = r_t - r_c
    return moments.select(
        c("ret_c").alias("returned_control"), c("ret_t").alias("returned_treatment"),
        r_c.alias("return_rate_control"),
        r_t.alias("return_rate_treatment"),
        diff.alias("return_rate_diff"),
        F.lit(cfg.guardrail).alias("threshold"),
        (diff > F.lit(cfg.guardrail)).alias("breached"), *beside)


def return_guardrail(moments: DataFrame, cfg: ExperimentConfig = DEFAULT) -> DataFrame:
    """``exact_guardrail`` for display."""
    return _rounded(exact_guardrail(moments, cfg), dict.fromkeys(
        ("return_rate_control", "return_rate_treatment", "return_rate_diff"), 6))


def all_tests(moments: DataFrame, cfg: ExperimentConfig = DEFAULT) -> DataFrame:
    """One row with the structs m, z, w and g: moments, z-test, Welch test and guardrail.

    All of it is one projection over the one aggregate, so the fact is read once.
    """
    names = [x for x in moments.columns]
    row = moments.withColumn("m", F.struct(*names))
    for tag, test in (("z", exact_ztest), ("w", exact_welch), ("g", exact_guardrail)):
        kept = [x for x in ("m", "z", "w", "g") if x in row.columns]
        found = test(row, cfg, tuple(kept))
        own = [x for x in found.columns if x not in kept]
        row = found.select(*kept, F.struct(*own).alias(tag)).select("*", "m.*")
    return row.select("m", "z", "w", "g")


DECISIONS = {
    # label -> what to do next
    "guardrail_breach": "Returns rose too much: stop and find out why first",
    "loss": "Keep the control; the change lowers order value",
    "win": "Ship the change to everybody",
    "significant_below_mde": "Keep the control; the gain is real but too small",
    "inconclusive": "No verdict yet; collect more orders",
}


def _joined(**frames: DataFrame) -> DataFrame:
    """One-row frames as one row of structs, for tests that were computed apart."""
    packed = [df.select(F.struct("*").alias(tag)) for tag, df in frames.items()]
    out = packed[0]
    for df in packed[1:]:
        out = with_scalars(out, df)
    return out


def experiment_decision(welch: DataFrame, guardrail: DataFrame, sizing: DataFrame,
                        cfg: ExperimentConfig = DEFAULT) -> DataFrame:
    """``decision`` from an unrounded ``exact_welch`` and ``exact_guardrail``."""
    return decision(_joined(w=welch, g=guardrail), sizing, cfg)


def decision(tests: DataFrame, sizing: DataFrame, cfg: ExperimentConfig = DEFAULT) -> DataFrame:
    """One decision row: breach, loss, win, below-MDE, inconclusive (that order).

    Reads the unrounded row of ``all_tests``; rounding is the last step.

    Also reports captured vs required orders; ``share_of_required`` is the
    share of the required sample that was captured (not a power).
    """
    j = with_scalars(tests.select("w.*", "g.return_rate_diff", "g.breached"),
                     sizing, ["n_per_variant", "n_total"])
    sig = c("p_value") < cfg.alpha
    label = (F.when(c("breached"), "guardrail_breach")
             .when(sig & (c("mean_diff") < 0), "loss")
             .when(sig & (c("mean_diff") > 0) & (c("relative_lift") >= cfg.mde_relative), "win")
             .when(sig, "significant_below_mde")
             .otherwise("inconclusive"))
    rec = F.create_map(*[x for k, v in DECISIONS.items() for x in (F.lit(k), F.lit(v))])
    captured = c("n_control") + c("n_treatment")
    return (j.select(label.alias("decision"), F.round("p_value", 6).alias("p_value"),
                     F.round("mean_diff", 4).alias("mean_diff"),
                     F.round("relative_lift", 6).alias("relative_lift"),
                     F.round("return_rate_diff", 6).alias("return_rate_diff"), "breached",
                     captured.alias("captured_orders"), c("n_total").alias("required_orders"),
                     F.round(safe_divide(captured.cast("double"), c("n_total")), 6).alias("share_of_required"),
                     ((c("n_control") >= c("n_per_variant")) & (c("n_treatment") >= c("n_per_variant")))
                     .alias("sample_sufficient"))
             .withColumn("recommendation", rec[c("decision")]))


def interval_chart(moments: DataFrame, ztest: DataFrame, welch: DataFrame,
                   cfg: ExperimentConfig = DEFAULT) -> DataFrame:
    """``intervals`` from moments and the unrounded ``exact_ztest`` and ``exact_welch``."""
    return intervals(_joined(m=moments, z=ztest, w=welch), cfg)


def intervals(tests: DataFrame, cfg: ExperimentConfig = DEFAULT) -> DataFrame:
    """Bar-and-error data: per metric and variant the value and its own 95% CI.

    Conversion uses each variant's Wilson interval; order value each
    variant's own t interval (mean +- t(n-1) sd/sqrt(n)). The reference drew
    half the difference CI around each mean instead; its p-values are kept.
    Reads the unrounded row of ``all_tests``.
    """
    moments = tests.select("m.*", "z", "w")
    crit_t_c = t_quantile_two_sided(cfg.alpha, (c("n_c") - 1).cast("double"))
    crit_t_t = t_quantile_two_sided(cfg.alpha, (c("n_t") - 1).cast("double"))
    j = moments.select(
        c("mean_c"), c("mean_t"),
        *[c("z")[x].alias(x) for x in ("rate_control", "rate_treatment", "ci_low_control",
                                       "ci_high_control", "ci_low_treatment", "ci_high_treatment")],
        c("z")["p_value"].alias("p_conv"), c("w")["p_value"].alias("p_aov"),
        (crit_t_c * F.sqrt(safe_divide(c("var_c"), c("n_c")))).alias("half_c"),
        (crit_t_t * F.sqrt(safe_divide(c("var_t"), c("n_t")))).alias("half_t"))

    def row(metric, variant, value, lo, hi, p):
        return F.struct(F.lit(metric).alias("metric"), F.lit(variant).alias("variant"),
                        value.alias("value"), lo.alias("ci_low"), hi.alias("ci_high"),
                        p.alias("p_value"))

    rows = F.array(
        row("conversion_rate", CONTROL, c("rate_control"), c("ci_low_control"), c("ci_high_control"), c("p_conv")),
        row("conversion_rate", TREATMENT, c("rate_treatment"), c("ci_low_treatment"), c("ci_high_treatment"), c("p_conv")),
        row("average_order_value", CONTROL, c("mean_c"), c("mean_c") - c("half_c"), c("mean_c") + c("half_c"), c("p_aov")),
        row("average_order_value", TREATMENT, c("mean_t"), c("mean_t") - c("half_t"), c("mean_t") + c("half_t"), c("p_aov")))
    e = j.select(F.explode(rows).alias("r")).select("r.*")
    err = F.abs(c("ci_high") - c("ci_low")) / 2
    return e.select("metric", "variant",
                    F.round("value", 6).alias("value"),
                    F.round("ci_low", 6).alias("ci_low"), F.round("ci_high", 6).alias("ci_high"),
                    F.round(err, 6).alias("error"),
                    F.round("p_value", 6).alias("p_value"),
                    (c("p_value") < cfg.alpha).alias("significant"))


def experiment_report_display(balance: DataFrame, tests: DataFrame) -> DataFrame:
    """The printed read-out of the analysis notebooks as text lines (FN14).

    Counts with thousands separators, rates as percents, money in pounds,
    differences with an explicit sign. One row per line; the numbers come
    from the (one-row or per-variant) statistics frames.
    """
    from cartwright.functions.formatting import money as pounds, percent, signed, thousands
    total = balance.agg(F.sum("orders").alias("rows_loaded"))
    flat = tests.select(
        "z.*", *[c("w")[x].alias(x) for x in ("mean_control", "mean_treatment", "sd_control",
                                              "sd_treatment", "mean_diff", "ci_low", "ci_high")],
        c("w")["t_stat"].alias("t"), c("w")["p_value"].alias("p_aov"),
        *[c("g")[x].alias(x) for x in ("return_rate_control", "return_rate_treatment",
                                       "return_rate_diff", "breached")])
    # the figures as they are shown elsewhere, rounded before they are printed
    money = ("mean_control", "mean_treatment", "sd_control", "sd_treatment", "mean_diff",
             "ci_low", "ci_high")
    six = [n for n in flat.columns if n not in money and flat.schema[n].dataType.typeName() == "double"]
    j = with_scalars(_rounded(flat, dict.fromkeys(money, 4) | dict.fromkeys(six, 6)), total)

    def line(i, label, value):
        return F.struct(F.lit(i).alias("line"), F.lit(label).alias("label"), value.alias("value"))

    pct_signed = lambda x: F.concat(F.when(x >= 0, F.lit("+")).otherwise(F.lit("")),
                                    percent(x))
    lines = F.array(
        line(1, "Rows loaded", thousands(c("rows_loaded"))),
        line(2, "Conversion control", F.concat(percent(c("rate_control")), F.lit(" (95% CI: "),
             percent(c("ci_low_control")), F.lit(" to "), percent(c("ci_high_control")), F.lit(")"))),
        line(3, "Conversion treatment", F.concat(percent(c("rate_treatment")), F.lit(" (95% CI: "),
             percent(c("ci_low_treatment")), F.lit(" to "), percent(c("ci_high_treatment")), F.lit(")"))),
        line(4, "Absolute lift", pct_signed(c("absolute_lift"))),
        line(5, "Z-statistic", F.format_string("%.4f", F.round("z_stat", 4))),
        line(6, "P-value (conversion)", F.format_string("%.4f", F.round("p_value", 4))),
        line(7, "Control mean", F.concat(pounds(c("mean_control")), F.lit(" (SD: "),
             pounds(c("sd_control")), F.lit(")"))),
        line(8, "Treatment mean", F.concat(pounds(c("mean_treatment")), F.lit(" (SD: "),
             pounds(c("sd_treatment")), F.lit(")"))),
        line(9, "Absolute difference", F.concat(F.lit("£"), signed(c("mean_diff")))),
        line(10, "95% CI on difference", F.concat(pounds(c("ci_low")), F.lit(" to "), pounds(c("ci_high")))),
        line(11, "T-statistic", F.format_string("%.4f", F.round("t", 4))),
        line(12, "P-value (AOV)", F.format_string("%.4f", F.round("p_aov", 4))),
        line(13, "Return rate control", percent(c("return_rate_control"))),
        line(14, "Return rate treatment", percent(c("return_rate_treatment"))),
        line(15, "Return rate difference", pct_signed(c("return_rate_diff"))),
        line(16, "Guardrail breached", c("breached").cast("string")))
    return j.select(F.explode(lines).alias("l")).select("l.line", "l.label", "l.value")
