"""Oracle SQL (DuckDB dialect) for every registered query.

Each statement runs against the raw TPC-H views (region, nation, customer,
part, orders, lineitem, ...). It restates the fixture mapping and the
reference models as plain SQL, written straight from the reference's
semantics (no pre-aggregation tricks), so it is an independent check of the
Spark plans. Column names and types match the Spark output: counts and
integer sums are BIGINT, money and rates DOUBLE, days DATE, times TIMESTAMP.
"""

from __future__ import annotations

# -- fixture adapter: TPC-H -> shop source tables ---------------------------
ADAPTER = """
src_users AS (
    SELECT cu.id, cu.c_name AS first_name, cu.c_name AS last_name,
           cu.c_name || '@example.com' AS email,
           18 + cu.id % 60 AS age,
           CASE WHEN cu.id % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
           n.n_name AS city, n.n_name AS state, n.n_name AS country,
           cu.c_mktsegment AS traffic_source,
           TIMESTAMP '1995-01-01 00:00:00' AS created_at
    FROM (SELECT c.*, c.c_custkey * 10 + r.range AS id
          FROM customer c CROSS JOIN range(10) r) cu
    LEFT JOIN nation n ON cu.c_nationkey = n.n_nationkey
),
src_orders_1 AS (
    SELECT h.o_orderkey AS order_id,
           h.o_custkey * 10 + h.o_orderkey % 10 AS user_id,
           CASE WHEN h.o_orderstatus = 'F' THEN if(h.o_orderpriority = '1-URGENT', 'Returned', 'Complete')
                WHEN h.o_orderstatus = 'O' THEN if(h.o_orderpriority = '5-LOW', 'Cancelled', 'Shipped')
                ELSE 'Processing' END AS status,
           h.o_orderdate AS created_at,
           (SELECT count(*) FROM lineitem l WHERE l.l_orderkey = h.o_orderkey) AS num_of_item
    FROM orders h
),
src_orders AS (
    SELECT order_id, user_id, status,
           CASE WHEN user_id % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
           created_at,
           CASE WHEN status = 'Returned' THEN created_at + INTERVAL 14 DAY END AS returned_at,
           CASE WHEN status IN ('Shipped', 'Complete', 'Returned') THEN created_at + INTERVAL 1 DAY END AS shipped_at,
           CASE WHEN status IN ('Complete', 'Returned') THEN created_at + INTERVAL 4 DAY END AS delivered_at,
           CAST(num_of_item AS BIGINT) AS num_of_item
    FROM src_orders_1
),
src_order_items AS (
    SELECT concat_ws('|', CAST(l.l_orderkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR),
                     CAST(l.l_partkey AS VARCHAR), CAST(l.l_suppkey AS VARCHAR),
                     CAST(CAST(round(l.l_extendedprice * 100) AS BIGINT) AS VARCHAR)) AS id,
           l.l_orderkey AS order_id,
           h.o_custkey * 10 + h.o_orderkey % 10 AS user_id,
           l.l_partkey AS product_id,
           CASE WHEN l.l_linenumber = 7 AND l.l_linestatus = 'O' THEN 'Cancelled'
                WHEN l.l_returnflag = 'R' THEN 'Returned'
                WHEN l.l_linestatus = 'F' THEN 'Complete'
                WHEN l.l_returnflag = 'A' THEN 'Shipped'
                ELSE 'Processing' END AS status,
           h.o_orderdate AS created_at,
           l.l_shipdate AS shipped_at,
           l.l_shipdate + INTERVAL 3 DAY AS delivered_at,
           CASE WHEN l.l_returnflag = 'R' THEN l.l_shipdate END AS returned_at,
           l.l_extendedprice AS sale_price
    FROM lineitem l LEFT JOIN orders h ON l.l_orderkey = h.o_orderkey
),
src_products AS (
    SELECT p_partkey AS id, p_name AS name, p_brand AS brand, p_brand AS category,
           CASE WHEN p_size % 2 = 0 THEN 'Men' ELSE 'Women' END AS department,
           p_retailprice * 25 AS cost, p_retailprice * 50 AS retail_price
    FROM part
)"""

# variant key: parity of the last hex digit of md5(id as text); NULL id -> NULL
VARIANT_KEY_SQL = "CAST(('0x' || right(md5(CAST(id AS VARCHAR)), 1)) AS INTEGER) % 2"

# -- staging and star schema, as in the reference models -------------------
MODELS = """
stg_users AS (
    SELECT id AS user_id, first_name, last_name, email, age, gender, city, state, country,
           traffic_source, created_at AS user_created_at
    FROM src_users
),
stg_orders AS (
    SELECT order_id, user_id, status, gender, created_at, returned_at, shipped_at,
           delivered_at, num_of_item
    FROM src_orders
),
stg_order_items AS (
    SELECT id AS order_item_id, order_id, user_id, product_id, status, created_at,
           shipped_at, delivered_at, returned_at, sale_price
    FROM src_order_items
),
stg_products AS (
    SELECT id AS product_id, name AS product_name, brand, category, department, cost,
           retail_price
    FROM src_products
),
stg_experiment_assignments AS (
    SELECT id AS user_id, created_at AS user_created_at, country, age, gender,
           CASE WHEN {key} = 0 THEN 'control' ELSE 'treatment' END AS variant,
           {key} AS variant_key
    FROM src_users
),
dim_users AS (
    SELECT user_id, first_name, last_name, age, gender, city, state, country,
           traffic_source, user_created_at
    FROM stg_users
),
dim_orders AS (
    SELECT order_id, user_id, status, gender, created_at AS order_created_at, returned_at,
           shipped_at, delivered_at, num_of_item
    FROM stg_orders
),
dim_products AS (
    SELECT product_id, product_name, brand, category, department, cost, retail_price
    FROM stg_products
),
fct_order_items AS (
    SELECT oi.order_item_id, oi.order_id, oi.user_id, oi.product_id, oi.status,
           oi.created_at, oi.shipped_at, oi.delivered_at, oi.returned_at, oi.sale_price,
           o.num_of_item
    FROM stg_order_items oi LEFT JOIN stg_orders o ON oi.order_id = o.order_id
)""".replace("{key}", VARIANT_KEY_SQL)

# -- analytics marts, from the raw tables --------------------------------------
# Stated from the column contracts: amounts in whole cents, one grouped pass per
# question. An item line is cancelled when it is the seventh of an open order; an
# order when it is open and of low priority.
MARTS = """
line_cents AS (
    SELECT l_orderkey, l_partkey, l_linenumber = 7 AND l_linestatus = 'O' AS cancelled,
           l_returnflag = 'R' AS came_back, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents
    FROM lineitem
),
brand_totals AS (
    SELECT p_brand AS category, if(p_size % 2 = 0, 'Men', 'Women') AS department,
           count(*) AS lines, count(*) FILTER (NOT cancelled) AS sold,
           count(*) FILTER (came_back) AS back,
           coalesce(sum(cents) FILTER (NOT cancelled), 0) AS revenue,
           coalesce(sum(CAST(round(p_retailprice * 100) AS BIGINT) * 25) FILTER (NOT cancelled), 0) AS cost
    FROM part JOIN line_cents ON l_partkey = p_partkey
    GROUP BY ALL
),
mart_category_performance AS (
    SELECT category, department, lines AS items_ordered, sold AS items_sold, back AS items_returned,
           round(revenue / 100, 2) AS gross_revenue, round(cost / 100, 2) AS cost_of_goods,
           round((revenue - cost) / 100, 2) AS gross_margin,
           round((revenue - cost) / nullif(revenue, 0), 4) AS gross_margin_pct,
           round(back / nullif(sold, 0), 4) AS return_rate
    FROM brand_totals
),
placed AS (
    SELECT o_custkey, o_custkey * 10 + o_orderkey % 10 AS buyer, o_orderkey, o_orderdate,
           o_orderstatus = 'O' AND o_orderpriority = '5-LOW' AS called_off
    FROM orders
),
cohorts AS (
    SELECT strftime(first_order, '%Y-%m-01')::DATE AS month, n_orders
    FROM (SELECT min(o_orderdate) AS first_order, count(DISTINCT o_orderkey) AS n_orders
          FROM placed WHERE called_off IS NOT TRUE GROUP BY buyer)
),
mart_customer_retention AS (
    SELECT month AS cohort_month, count(*) AS new_customers,
           count(*) FILTER (n_orders > 1) AS repeat_customers,
           round(count(*) FILTER (n_orders > 1) / count(*), 4) AS repeat_purchase_rate
    FROM cohorts GROUP BY month
),
order_cents AS (
    SELECT l_orderkey, sum(cents) AS cents FROM line_cents WHERE NOT cancelled GROUP BY l_orderkey
),
buyer_cents AS (
    SELECT o_custkey, buyer, count(DISTINCT o_orderkey) AS n_orders, sum(cents) AS cents
    FROM placed JOIN order_cents ON l_orderkey = o_orderkey GROUP BY o_custkey, buyer
),
customer_cents AS (
    SELECT o_custkey, sum(n_orders) AS n_orders, sum(cents) AS cents,
           count(*) FILTER (n_orders > 1) AS repeaters
    FROM buyer_cents GROUP BY o_custkey
),
segment_totals AS (
    SELECT c_mktsegment, 10 * count(*) AS people, coalesce(sum(n_orders), 0) AS n_orders,
           coalesce(sum(cents), 0) / 100 AS revenue, coalesce(sum(repeaters), 0) AS repeaters
    FROM customer LEFT JOIN customer_cents ON o_custkey = c_custkey GROUP BY c_mktsegment
),
mart_channel_performance AS (
    SELECT c_mktsegment AS traffic_source, people AS customers,
           CAST(n_orders AS BIGINT) AS total_orders, round(revenue, 2) AS total_revenue,
           round(revenue / people, 2) AS revenue_per_customer,
           round(n_orders / people, 2) AS orders_per_customer,
           round(repeaters / people, 4) AS repeat_purchase_rate
    FROM segment_totals
)"""

_BLOCKS = [ADAPTER, MODELS, MARTS]


def with_models(body: str, extra_ctes: str = "") -> str:
    """Prefix a query body with the adapter, model and mart CTEs."""
    ctes = ",\n".join(b.strip("\n") for b in _BLOCKS)
    if extra_ctes:
        ctes += ",\n" + extra_ctes.strip("\n")
    return "WITH\n" + ctes + "\n" + body


def _select_all(name: str, order: str = "") -> str:
    return with_models(f"SELECT * FROM {name}" + (f" ORDER BY {order}" if order else ""))


ORACLE: dict[str, str] = {
    "stg_users": _select_all("stg_users"),
    "stg_orders": _select_all("stg_orders"),
    "stg_order_items": _select_all("stg_order_items"),
    "stg_products": _select_all("stg_products"),
    "stg_experiment_assignments": _select_all("stg_experiment_assignments"),
    "dim_users": _select_all("dim_users"),
    "dim_orders": _select_all("dim_orders"),
    "dim_products": _select_all("dim_products"),
    "fct_order_items": _select_all("fct_order_items"),
    "mart_category_performance": _select_all("mart_category_performance", "gross_margin DESC"),
    "mart_customer_retention": _select_all("mart_customer_retention", "cohort_month"),
    "mart_channel_performance": _select_all("mart_channel_performance", "total_revenue DESC"),
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


# -- experiment models --------------------------------------------------------
from cartwright.functions.distributions import (  # noqa: E402
    NEWTON_STEPS, NORMAL_SPAN, STEPS, T_SPAN, normal_quantile)
from cartwright.operators.experiment import DEFAULT as _CFG  # noqa: E402


def dbl(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def simpson_sql(f, a: str, b: str) -> str:
    """Composite Simpson over [a, b] with the engine's step count."""
    h = f"((({b}) - ({a})) / {dbl(STEPS)})"
    w = f"(CASE WHEN k = 0 OR k = {STEPS} THEN 1.0 WHEN k % 2 = 1 THEN 4.0 ELSE 2.0 END)"
    return (f"(list_sum(list_transform(range(0, {STEPS + 1}), "
            f"lambda k: {w} * {f(f'(({a}) + k * {h})')})) * {h} / 3.0)")


def simpson_end_sql(f, a: str, b: str) -> str:
    """Simpson in s with theta = b - (b - a)(1 - s)^3 (nodes cluster at b)."""
    w = f"(CASE WHEN k = 0 OR k = {STEPS} THEN 1.0 WHEN k % 2 = 1 THEN 4.0 ELSE 2.0 END)"
    rest = f"(1.0 - k / {dbl(STEPS)})"
    theta = f"(({b}) - (({b}) - ({a})) * {rest} * {rest} * {rest})"
    jac = f"(3.0 * (({b}) - ({a})) * {rest} * {rest})"
    return (f"(list_sum(list_transform(range(0, {STEPS + 1}), "
            f"lambda k: {w} * {f(theta)} * {jac})) / {dbl(3.0 * STEPS)})")


def t_p_sql(t: str, nu: str) -> str:
    up = f"least(pi() / 2, {dbl(T_SPAN)} / sqrt({nu}))"
    lo = f"least(atan(abs({t}) / sqrt({nu})), {up})"
    f = lambda x: f"pow(cos({x}), {nu} - 1.0)"
    return (f"(CASE WHEN {t} IS NOT NULL AND {nu} >= 1 THEN "
            f"least(1.0, {simpson_end_sql(f, lo, up)} / {simpson_end_sql(f, '0.0', up)}) END)")


def t_quantile_sql(alpha: float, nu: str) -> str:
    up = f"least(pi() / 2, {dbl(T_SPAN)} / sqrt({nu}))"
    f = lambda x: f"pow(cos({x}), {nu} - 1.0)"
    target = f"({dbl(1.0 - alpha)} * {simpson_end_sql(f, '0.0', up)})"
    step = f"th - ({simpson_end_sql(f, '0.0', 'th')} - {target}) / {f('th')}"
    start = f"atan({dbl(normal_quantile(1.0 - alpha / 2))} / sqrt({nu}))"
    theta = f"list_reduce(range(1, {NEWTON_STEPS + 1}), lambda th, i: {step}, {start})"
    return f"(CASE WHEN {nu} >= 1 THEN sqrt({nu}) * tan({theta}) END)"


def normal_p_sql(z: str) -> str:
    a = f"abs({z})"
    f = lambda x: f"exp(-({x} * {x}) / 2.0)"
    return (f"(CASE WHEN {z} IS NOT NULL THEN least(1.0, {dbl((2.0 / 3.141592653589793) ** 0.5)} * "
            f"{simpson_sql(f, a, f'{a} + {dbl(NORMAL_SPAN)}')}) END)")


# -- amounts: whole cents are added, so no result depends on the order of rows
def cents(x: str) -> str:
    return f"CAST(round({x} * 100) AS BIGINT)"


def exact_avg(x: str, when: str = "") -> str:
    f = f" FILTER (WHERE {when})" if when else ""
    return f"(sum({cents(x)}){f} / nullif(100 * count({x}){f}, 0))"


def exact_var(x: str, when: str = "") -> str:
    f = f" FILTER (WHERE {when})" if when else ""
    n, u = f"count({x}){f}", cents(x)
    return (f"(({n} * sum({u} * {u}){f} - sum({u}){f} * sum({u}){f}) / nullif({n} * ({n} - 1), 0)"
            f" / 10000)")


def _experiment_ctes(cfg=_CFG) -> str:
    statuses = ", ".join(f"'{s}'" for s in cfg.statuses)
    vc, vt = cfg.variants

    def m(tag, v):
        return f"""
           count(*) FILTER (WHERE variant = '{v}') AS n_{tag},
           CAST(sum(is_completed) FILTER (WHERE variant = '{v}') AS BIGINT) AS conv_{tag},
           CAST(sum(is_returned) FILTER (WHERE variant = '{v}') AS BIGINT) AS ret_{tag},
           {exact_avg('order_value', f"variant = '{v}'")} AS mean_{tag},
           {exact_var('order_value', f"variant = '{v}'")} AS var_{tag}"""
    return f"""
fct_experiment_results AS (
    SELECT o_orderkey AS order_id, o_custkey * 10 + o_orderkey % 10 AS user_id,
           ['{vc}', '{vt}'][1 + {VARIANT_KEY_SQL.replace("id AS", "o_custkey * 10 + o_orderkey % 10 AS")}] AS variant,
           st AS order_status, o_orderdate AS order_created_at, order_value, item_count,
           CAST(st = 'Complete' AS INTEGER) AS is_completed,
           CAST(st = 'Returned' AS INTEGER) AS is_returned
    FROM (SELECT *, CASE o_orderstatus WHEN 'F' THEN if(o_orderpriority = '1-URGENT', 'Returned', 'Complete')
                    WHEN 'O' THEN if(o_orderpriority = '5-LOW', 'Cancelled', 'Shipped')
                    ELSE 'Processing' END AS st
          FROM orders WHERE o_orderdate >= DATE '{cfg.start}'
                        AND o_orderdate < DATE '{cfg.end}' + INTERVAL 1 DAY)
    SEMI JOIN customer ON c_custkey = o_custkey
    JOIN (SELECT l_orderkey, sum({cents('l_extendedprice')}) / 100 AS order_value,
                 count(*) AS item_count
          FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey
    WHERE st IN ({statuses})
),
moments AS (
    SELECT {m('c', vc)},
           {m('t', vt)}
    FROM fct_experiment_results
),
baseline_order_value AS (
    SELECT round({exact_avg('basket')}, 2) AS baseline_aov,
           round(sqrt({exact_var('basket')}), 2) AS aov_stddev, count(*) AS order_count
    FROM (SELECT sum({cents('l_extendedprice')}) / 100 AS basket FROM lineitem
          WHERE l_linestatus = 'F' AND l_returnflag <> 'R' GROUP BY l_orderkey)
),
baseline_return_rate AS (
    SELECT round(avg(CAST(o_orderpriority = '1-URGENT' AS INTEGER)), 4) AS baseline_return_rate,
           count(*) AS total_orders
    FROM orders WHERE o_orderstatus = 'F'
),
baseline_daily_orders AS (
    SELECT count(DISTINCT (CAST(o_orderdate AS DATE), o_orderkey))
           / nullif(count(DISTINCT CAST(o_orderdate AS DATE)), 0) AS avg_daily_orders
    FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT'
),
sample_size_and_duration AS (
    WITH b AS (
        SELECT *, baseline_aov * {dbl(cfg.mde_relative)} AS mde
        FROM baseline_order_value CROSS JOIN baseline_daily_orders
    ), n AS (
        SELECT *, {dbl(2.0)} * aov_stddev * aov_stddev
                  * {dbl((normal_quantile(1 - cfg.alpha / 2) + normal_quantile(cfg.power)) ** 2)}
                  / (mde * mde) AS n_exact
        FROM b
    ), d AS (
        SELECT *, CAST(ceil(n_exact) AS BIGINT) AS n_per_variant,
               CAST(ceil(n_exact) AS BIGINT) / nullif(avg_daily_orders * {dbl(cfg.traffic_share)}, 0) AS days
        FROM n
    )
    SELECT baseline_aov, aov_stddev, round(mde, 6) AS mde_absolute,
           round(mde / nullif(aov_stddev, 0), 6) AS effect_size,
           {dbl(round(normal_quantile(1 - cfg.alpha / 2), 12))} AS z_alpha,
           {dbl(round(normal_quantile(cfg.power), 12))} AS z_beta,
           round(n_exact, 4) AS n_exact, n_per_variant, n_per_variant * 2 AS n_total,
           round(avg_daily_orders, 6) AS avg_daily_orders,
           round(days, 4) AS duration_days, CAST(ceil(days) AS BIGINT) AS duration_days_ceil
    FROM d
)"""


def _ztest_body(cfg=_CFG) -> str:
    crit = normal_quantile(1 - cfg.alpha / 2)
    c2 = dbl(crit * crit)

    def wilson(succ, n):
        q = f"(CAST({succ} AS DOUBLE) / nullif({n}, 0))"
        denom = f"(1.0 + {c2} / nullif({n}, 0))"
        center = f"(({q} + {c2} / nullif(2.0 * {n}, 0)) / {denom})"
        dist = (f"({dbl(crit)} * sqrt({q} * (1.0 - {q}) / {n} + {c2} / nullif(4.0 * {n} * {n}, 0))"
                f" / {denom})")
        return f"{center} - {dist}", f"{center} + {dist}"
    lo_c, hi_c = wilson("conv_c", "n_c")
    lo_t, hi_t = wilson("conv_t", "n_t")
    return f"""
ztest AS (
    WITH s AS (
        SELECT n_c, n_t, conv_c, conv_t,
               CAST(conv_c AS DOUBLE) / nullif(n_c, 0) AS p_c,
               CAST(conv_t AS DOUBLE) / nullif(n_t, 0) AS p_t,
               CAST(conv_c + conv_t AS DOUBLE) / nullif(n_c + n_t, 0) AS pooled,
               {lo_c} AS lo_c, {hi_c} AS hi_c, {lo_t} AS lo_t, {hi_t} AS hi_t
        FROM moments
    ), z AS (
        SELECT *, (p_c - p_t) / nullif(sqrt(pooled * (1.0 - pooled)
                   * (1.0 / nullif(n_c, 0) + 1.0 / nullif(n_t, 0))), 0) AS z_stat
        FROM s
    )
    SELECT n_c AS n_control, n_t AS n_treatment, conv_c AS completed_control,
           conv_t AS completed_treatment,
           round(p_c, 6) AS rate_control, round(p_t, 6) AS rate_treatment,
           round(lo_c, 6) AS ci_low_control, round(hi_c, 6) AS ci_high_control,
           round(lo_t, 6) AS ci_low_treatment, round(hi_t, 6) AS ci_high_treatment,
           round(p_t - p_c, 6) AS absolute_lift, round(z_stat, 6) AS z_stat,
           round({normal_p_sql('z_stat')}, 6) AS p_value,
           {normal_p_sql('z_stat')} < {dbl(cfg.alpha)} AS significant,
           {normal_p_sql('z_stat')} AS exact_p, p_c, p_t, lo_c, hi_c, lo_t, hi_t
    FROM z
)"""


def _welch_body(cfg=_CFG) -> str:
    return f"""
welch AS (
    WITH s AS (
        SELECT n_c, n_t, mean_c, mean_t, var_c, var_t,
               var_c / nullif(n_c, 0) AS vn_c, var_t / nullif(n_t, 0) AS vn_t
        FROM moments
    ), w AS (
        SELECT *, vn_c + vn_t AS se2,
               (vn_c + vn_t) * (vn_c + vn_t)
                 / nullif(vn_c * vn_c / nullif(n_c - 1, 0) + vn_t * vn_t / nullif(n_t - 1, 0), 0) AS df_welch
        FROM s
    ), t AS (
        SELECT *, (mean_c - mean_t) / nullif(sqrt(se2), 0) AS t_stat, sqrt(se2) AS se_diff,
               mean_t - mean_c AS mean_diff
        FROM w
    ), p AS (
        SELECT *, {t_p_sql('t_stat', 'df_welch')} AS p_value,
               {t_quantile_sql(cfg.alpha, 'df_welch')} AS t_crit
        FROM t
    )
    SELECT n_c AS n_control, n_t AS n_treatment,
           round(mean_c, 4) AS mean_control, round(mean_t, 4) AS mean_treatment,
           round(sqrt(var_c), 4) AS sd_control, round(sqrt(var_t), 4) AS sd_treatment,
           round(mean_diff, 4) AS mean_diff, round(se_diff, 4) AS se_diff,
           round(mean_diff - t_crit * se_diff, 4) AS ci_low,
           round(mean_diff + t_crit * se_diff, 4) AS ci_high,
           round(t_stat, 6) AS t_stat, round(p_value, 6) AS p_value, round(t_crit, 6) AS t_crit,
           round((mean_t - mean_c) / nullif(mean_c, 0), 6) AS relative_lift,
           round(df_welch, 4) AS df_welch,
           p_value < {dbl(cfg.alpha)} AS significant, p_value AS exact_p,
           mean_diff AS exact_diff, (mean_t - mean_c) / nullif(mean_c, 0) AS exact_lift
    FROM p
)"""


def _guardrail_body(cfg=_CFG) -> str:
    return f"""
guardrail AS (
    WITH r AS (
        SELECT ret_c, ret_t, CAST(ret_c AS DOUBLE) / nullif(n_c, 0) AS r_c,
               CAST(ret_t AS DOUBLE) / nullif(n_t, 0) AS r_t
        FROM moments
    )
    SELECT ret_c AS returned_control, ret_t AS returned_treatment,
           round(r_c, 6) AS return_rate_control, round(r_t, 6) AS return_rate_treatment,
           round(r_t - r_c, 6) AS return_rate_diff, {dbl(cfg.guardrail)} AS threshold,
           (r_t - r_c) > {dbl(cfg.guardrail)} AS breached
    FROM r
)"""


def _decision_body(cfg=_CFG) -> str:
    advice = {  # fixed values: what the engine prints for each label
        "guardrail_breach": "Returns rose too much: stop and find out why first",
        "loss": "Keep the control; the change lowers order value",
        "win": "Ship the change to everybody",
        "significant_below_mde": "Keep the control; the gain is real but too small",
        "inconclusive": "No verdict yet; collect more orders",
    }
    rec = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in advice.items())
    a = dbl(cfg.alpha)
    return f"""
decision AS (
    WITH j AS (
        SELECT w.*, g.return_rate_diff, g.breached, s.n_per_variant, s.n_total
        FROM welch w CROSS JOIN guardrail g CROSS JOIN sample_size_and_duration s
    ), d AS (
        SELECT *, CASE WHEN breached THEN 'guardrail_breach'
                       WHEN exact_p >= {a} OR exact_p IS NULL THEN 'inconclusive'
                       WHEN exact_diff < 0 THEN 'loss'
                       WHEN exact_diff > 0 AND exact_lift >= {dbl(cfg.mde_relative)} THEN 'win'
                       ELSE 'significant_below_mde' END AS decision
        FROM j
    )
    SELECT decision, p_value, mean_diff, relative_lift, return_rate_diff, breached,
           n_control + n_treatment AS captured_orders, n_total AS required_orders,
           round(CAST(n_control + n_treatment AS DOUBLE) / nullif(n_total, 0), 6) AS share_of_required,
           n_control >= n_per_variant AND n_treatment >= n_per_variant AS sample_sufficient,
           CASE decision {rec} END AS recommendation
    FROM d
)"""


def _interval_body(cfg=_CFG) -> str:
    return f"""
interval_chart AS (
    WITH m AS (
        SELECT mean_c, mean_t,
               {t_quantile_sql(cfg.alpha, 'CAST(n_c - 1 AS DOUBLE)')} * sqrt(var_c / nullif(n_c, 0)) AS half_c,
               {t_quantile_sql(cfg.alpha, 'CAST(n_t - 1 AS DOUBLE)')} * sqrt(var_t / nullif(n_t, 0)) AS half_t
        FROM moments
    ), z AS (SELECT * FROM ztest), w AS (SELECT exact_p AS p_aov FROM welch),
    r AS (
        SELECT 'conversion_rate' AS metric, '{cfg.variants[0]}' AS variant, p_c AS value,
               lo_c AS ci_low, hi_c AS ci_high, z.exact_p AS p_value FROM z
        UNION ALL
        SELECT 'conversion_rate', '{cfg.variants[1]}', p_t, lo_t, hi_t, z.exact_p FROM z
        UNION ALL
        SELECT 'average_order_value', '{cfg.variants[0]}', mean_c, mean_c - half_c, mean_c + half_c, p_aov
        FROM m CROSS JOIN w
        UNION ALL
        SELECT 'average_order_value', '{cfg.variants[1]}', mean_t, mean_t - half_t, mean_t + half_t, p_aov
        FROM m CROSS JOIN w
    )
    SELECT metric, variant, round(value, 6) AS value, round(ci_low, 6) AS ci_low,
           round(ci_high, 6) AS ci_high, round(abs(ci_high - ci_low) / 2, 6) AS error,
           round(p_value, 6) AS p_value, p_value < {dbl(cfg.alpha)} AS significant
    FROM r
)"""


_BLOCKS.append(_experiment_ctes())
_BLOCKS.append(_ztest_body())
_BLOCKS.append(_welch_body())
_BLOCKS.append(_guardrail_body())
_BLOCKS.append(_decision_body())
_BLOCKS.append(_interval_body())

_NULL_PROFILE_COLS = [
    # (column, Spark type name) of fct_experiment_results
    ("order_id", "bigint"), ("user_id", "bigint"), ("variant", "string"),
    ("order_status", "string"), ("order_created_at", "timestamp_ntz"),
    ("order_value", "double"), ("item_count", "bigint"), ("is_completed", "int"),
    ("is_returned", "int"),
]


def _null_profile_sql() -> str:
    parts = [f"SELECT {i} AS column_position, '{c}' AS column_name, '{t}' AS data_type, "
             f"CAST(count_if({c} IS NULL) AS BIGINT) AS null_count, count(*) AS row_count, "
             f"CAST({len(_NULL_PROFILE_COLS)} AS BIGINT) AS column_count FROM fct_experiment_results"
             for i, (c, t) in enumerate(_NULL_PROFILE_COLS)]
    return with_models("\nUNION ALL\n".join(parts))


ORACLE.update({
    "fct_experiment_results": _select_all("fct_experiment_results"),
    "baseline_order_value": _select_all("baseline_order_value"),
    "baseline_return_rate": _select_all("baseline_return_rate"),
    "baseline_daily_orders": _select_all("baseline_daily_orders"),
    "sample_size_and_duration": _select_all("sample_size_and_duration"),
    "conversion_ztest": with_models("SELECT * EXCLUDE (exact_p, p_c, p_t, lo_c, hi_c, lo_t, hi_t) FROM ztest"),
    "aov_welch": with_models("SELECT * EXCLUDE (exact_p, exact_diff, exact_lift) FROM welch"),
    "return_guardrail": _select_all("guardrail"),
    "experiment_decision": _select_all("decision"),
    "interval_chart": _select_all("interval_chart"),
    "variant_balance": with_models("""
SELECT variant, orders, users, round_even(orders / total * 100, 1) AS pct_orders,
       orders / total AS share_orders
FROM (SELECT variant, count(order_id) AS orders, count(DISTINCT user_id) AS users,
             sum(count(order_id)) OVER () AS total
      FROM fct_experiment_results WHERE variant IS NOT NULL GROUP BY variant)"""),
    "variant_summary": with_models(f"""
SELECT variant, count(order_id) AS orders,
       round({exact_avg('order_value')}, 4) AS avg_order_value,
       round(median(order_value), 4) AS median_order_value,
       round(sqrt({exact_var('order_value')}), 4) AS std_order_value,
       round(avg(is_completed), 6) AS conversion_rate,
       round(avg(is_returned), 6) AS return_rate
FROM fct_experiment_results WHERE variant IS NOT NULL GROUP BY variant"""),
    "null_profile": _null_profile_sql(),
    "experiment_preview": with_models("SELECT * FROM fct_experiment_results ORDER BY order_id LIMIT 5"),
})


# -- charts, headlines, calendar, dashboard, data quality --------------------
_CHART_CTES = """
cat_rollup AS (
    SELECT category, sum(gross_revenue) AS gross_revenue, sum(gross_margin) AS gross_margin,
           sum(cost_of_goods) AS cost_of_goods, avg(return_rate) AS return_rate_mean,
           sum(gross_margin) / nullif(sum(gross_revenue), 0) AS gross_margin_pct
    FROM mart_category_performance WHERE category IS NOT NULL GROUP BY category
),
cat_top AS (
    SELECT * FROM cat_rollup ORDER BY gross_margin DESC NULLS LAST, category ASC LIMIT 10
),
fct_known AS (
    SELECT * FROM fct_experiment_results WHERE variant IS NOT NULL AND order_value IS NOT NULL
),
box_q AS (
    SELECT variant, quantile_cont(order_value, 0.25) AS q1, quantile_cont(order_value, 0.5) AS median,
           quantile_cont(order_value, 0.75) AS q3
    FROM fct_known GROUP BY variant
),
box_f AS (
    SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS fence_low, q3 + 1.5 * (q3 - q1) AS fence_high
    FROM box_q
),
rates AS (
    SELECT 'category return_rate' AS metric, category AS grain, return_rate AS value
    FROM mart_category_performance
    UNION ALL SELECT 'category gross_margin_pct', category, gross_margin_pct FROM mart_category_performance
    UNION ALL SELECT 'cohort repeat_purchase_rate', cohort_month::VARCHAR, repeat_purchase_rate
    FROM mart_customer_retention
    UNION ALL SELECT 'channel repeat_purchase_rate', traffic_source, repeat_purchase_rate
    FROM mart_channel_performance
),
rate_rules(metric, least, most) AS (
    VALUES ('category return_rate', 0, 1), ('category gross_margin_pct', -1, 1),
           ('cohort repeat_purchase_rate', 0, 1), ('channel repeat_purchase_rate', 0, 1)
),
rate_bounds AS (
    SELECT metric AS failing_metric, grain, value FROM rates JOIN rate_rules USING (metric)
    WHERE value < least OR value > most
)"""
_BLOCKS.append(_CHART_CTES)

_PARTS = """year(d) AS year, month(d) AS month_no, monthname(d) AS month,
           CAST(floor((month(d) + 2) / 3) AS INTEGER) AS quarter_no,
           'Qtr ' || CAST(CAST(floor((month(d) + 2) / 3) AS INTEGER) AS VARCHAR) AS quarter,
           day(d) AS day"""
_PARTS_TYPED = """CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month_no,
           monthname(d) AS month,
           CAST(floor((month(d) + 2) / 3) AS INTEGER) AS quarter_no,
           'Qtr ' || CAST(CAST(floor((month(d) + 2) / 3) AS INTEGER) AS VARCHAR) AS quarter,
           CAST(day(d) AS INTEGER) AS day"""


# the checks that the suite promises, in its order: test, model, column and what it needs
_CHECKS = """
not_null stg_order_items order_item_id
unique stg_order_items order_item_id
not_null stg_order_items order_id
not_null stg_order_items user_id
not_null stg_order_items product_id
not_null stg_orders order_id
unique stg_orders order_id
not_null stg_orders user_id
not_null stg_users user_id
unique stg_users user_id
not_null stg_products product_id
unique stg_products product_id
not_null dim_users user_id
unique dim_users user_id
not_null dim_products product_id
unique dim_products product_id
not_null dim_orders order_id
unique dim_orders order_id
accepted_values dim_orders status Processing,Shipped,Complete,Returned,Cancelled
not_null fct_order_items order_item_id
unique fct_order_items order_item_id
not_null fct_order_items order_id
relationships fct_order_items order_id dim_orders
not_null fct_order_items user_id
relationships fct_order_items user_id dim_users
not_null fct_order_items product_id
relationships fct_order_items product_id dim_products
not_null mart_category_performance category
not_null mart_category_performance gross_revenue
not_null mart_category_performance gross_margin
unique mart_category_performance category+department
not_null mart_customer_retention cohort_month
unique mart_customer_retention cohort_month
not_null mart_customer_retention repeat_purchase_rate
not_null mart_channel_performance traffic_source
unique mart_channel_performance traffic_source
not_null mart_channel_performance revenue_per_customer
not_null stg_experiment_assignments user_id
unique stg_experiment_assignments user_id
not_null stg_experiment_assignments variant
accepted_values stg_experiment_assignments variant control,treatment
not_null fct_experiment_results order_id
unique fct_experiment_results order_id
accepted_values fct_experiment_results variant control,treatment
not_null stg_experiment_assignments variant_key
accepted_values stg_experiment_assignments variant_key 0,1
not_null fct_experiment_results variant
not_null fct_experiment_results user_id
not_null fct_experiment_results order_value
not_null fct_experiment_results order_status
accepted_values fct_experiment_results order_status Complete,Returned
relationships fct_experiment_results user_id stg_experiment_assignments
"""
_FAILURES = {
    "not_null": "SELECT count(*) FROM {model} WHERE {first} IS NULL",
    "unique": "SELECT count(*) FROM (SELECT {columns} FROM {model} WHERE {known} "
              "GROUP BY {columns} HAVING count(*) > 1)",
    "accepted_values": "SELECT count(DISTINCT {first}) FROM {model} "
                       "WHERE CAST({first} AS VARCHAR) NOT IN ({needs})",
    "relationships": "SELECT count(*) FROM {model} ANTI JOIN {parent} USING ({first}) "
                     "WHERE {first} IS NOT NULL",
}


def _dq_sql() -> str:
    parts = []
    for i, line in enumerate(_CHECKS.split("\n")[1:-1]):
        test, model, column, *needs = line.split(" ")
        columns = column.split("+")
        count = _FAILURES[test].format(
            model=model, first=columns[0], columns=", ".join(columns), parent="".join(needs),
            known=" AND ".join(f"{c} IS NOT NULL" for c in columns),
            needs=", ".join(f"'{v}'" for v in "".join(needs).split(",")))
        parts.append(f"SELECT {i} AS place, '{test}' AS test_name, '{model}' AS model, "
                     f"'{', '.join(columns)}' AS column_name, ({count}) AS failures")
    parts.append("SELECT 1000, 'assert_rates_within_bounds', 'analytics', '', "
                 "(SELECT count(*) FROM rate_bounds)")
    return with_models("SELECT test_name, model, column_name, failures, failures = 0 AS passed "
                       "FROM (" + "\nUNION ALL\n".join(parts) + ") ORDER BY place")


def _cards_sql(cfg=_CFG) -> str:
    cols = []
    for v in cfg.variants:
        cols += [f"CAST(count_if(variant = '{v}') AS BIGINT) AS {v}_orders",
                 f"round({exact_avg('order_value', f"variant = '{v}'")}, 4) AS {v}_aov",
                 f"round(avg(is_completed) FILTER (WHERE variant = '{v}'), 6) AS {v}_conv_rate"]
    return with_models("SELECT " + ",\n       ".join(cols) + "\nFROM fct_experiment_results")


def _drill(level: int) -> str:
    """One level of the date hierarchy as a plain grouping."""
    parts = {"y": "year", "q": "quarter", "m": "month", "d": "day"}
    shown = ", ".join(f"{f}(order_created_at) AS {a}" if i < level else f"0 AS {a}"
                      for i, (a, f) in enumerate(parts.items()))
    groups = ", ".join(f"{f}(order_created_at)" for f in list(parts.values())[:level])
    return (f"SELECT {level} AS level, {shown}, count(*) AS orders, "
            f"{exact_avg('order_value')} AS aov, avg(is_completed) AS conversion_rate "
            f"FROM fct_experiment_results WHERE order_created_at IS NOT NULL"
            + (f" GROUP BY {groups}" if groups else ""))


def _cube_cell(*filtered: int) -> str:
    """The measures grouped by the axes that have a filter."""
    axes = ("variant", "order_status", "strftime(order_created_at, '%Y-%m')")
    names = ("variant", "order_status", "order_month")
    shown = ", ".join(f"{x if on else repr('all')} AS {n}" for x, n, on in zip(axes, names, filtered))
    groups = ", ".join(x for x, on in zip(axes, filtered) if on)
    return (f"SELECT {shown}, count(*) AS orders, round(sum({cents('order_value')}) / 100, 2) AS order_value, "
            f"round({exact_avg('order_value')}, 4) AS aov, round(avg(is_completed), 6) AS conversion_rate, "
            f"round(avg(is_returned), 6) AS return_rate FROM fct_experiment_results "
            f"WHERE variant IS NOT NULL" + (f" GROUP BY {groups}" if groups else ""))


ORACLE.update({
    "category_top10": with_models("""
SELECT *, CAST(row_number() OVER (ORDER BY gross_margin DESC NULLS LAST, category ASC) AS INTEGER) AS rank
FROM (SELECT category, round(gross_revenue, 2) AS gross_revenue,
             round(cost_of_goods, 2) AS cost_of_goods, round(gross_margin, 2) AS gross_margin,
             round(gross_margin_pct, 6) AS gross_margin_pct,
             round(return_rate_mean, 6) AS return_rate_mean
      FROM cat_top)"""),
    "headline_figures": with_models("""
SELECT
  (SELECT round(sum(repeat_customers) / nullif(sum(new_customers), 0), 6)
     FROM mart_customer_retention) AS overall_repeat_rate,
  b.best_channel, b.best_channel_revenue_per_customer, b.best_channel_repeat_rate,
  (SELECT category FROM cat_top ORDER BY gross_margin_pct DESC NULLS LAST, category LIMIT 1) AS best_margin_category,
  (SELECT round(gross_margin_pct, 6) FROM cat_top ORDER BY gross_margin_pct DESC NULLS LAST, category LIMIT 1) AS best_margin_pct,
  (SELECT category FROM cat_top ORDER BY gross_margin_pct ASC NULLS LAST, category LIMIT 1) AS worst_margin_category,
  (SELECT round(gross_margin_pct, 6) FROM cat_top ORDER BY gross_margin_pct ASC NULLS LAST, category LIMIT 1) AS worst_margin_pct,
  (SELECT category FROM cat_top ORDER BY return_rate_mean DESC NULLS LAST, category LIMIT 1) AS worst_returns_category,
  (SELECT round(return_rate_mean, 6) FROM cat_top ORDER BY return_rate_mean DESC NULLS LAST, category LIMIT 1) AS worst_returns_rate
FROM (SELECT traffic_source AS best_channel, revenue_per_customer AS best_channel_revenue_per_customer,
             repeat_purchase_rate AS best_channel_repeat_rate
      FROM mart_channel_performance WHERE traffic_source IS NOT NULL
      ORDER BY revenue_per_customer DESC NULLS LAST, traffic_source LIMIT 1) b"""),
    "retention_line": with_models(
        "SELECT cohort_month, new_customers, repeat_purchase_rate FROM mart_customer_retention "
        "ORDER BY cohort_month"),
    "channel_bars": with_models(
        "SELECT traffic_source, revenue_per_customer, repeat_purchase_rate FROM mart_channel_performance "
        "ORDER BY revenue_per_customer, traffic_source"),
    "order_value_histogram": with_models("""
SELECT g.variant, g.bin, round(g.lo + g.bin * ((g.hi - g.lo) / 30), 6) AS bin_low,
       round(g.lo + (g.bin + 1) * ((g.hi - g.lo) / 30), 6) AS bin_high,
       coalesce(c.orders, 0) AS orders
FROM (SELECT r.*, CAST(b.range AS INTEGER) AS bin FROM rng r CROSS JOIN range(30) b) g
LEFT JOIN (SELECT f.variant,
                  CAST(least(floor((f.order_value - r.lo) * 30 / (r.hi - r.lo)), 29) AS INTEGER) AS bin,
                  count(*) AS orders
           FROM fct_known f JOIN rng r ON f.variant = r.variant GROUP BY 1, 2) c
  ON g.variant = c.variant AND g.bin = c.bin""", extra_ctes="""
rng AS (
    SELECT variant,
           CASE WHEN min(order_value) = max(order_value) THEN min(order_value) - 0.5 ELSE min(order_value) END AS lo,
           CASE WHEN min(order_value) = max(order_value) THEN max(order_value) + 0.5 ELSE max(order_value) END AS hi
    FROM fct_known GROUP BY variant
)"""),
    "order_value_boxplot": with_models("""
SELECT q.variant, s.orders, round(q.q1, 4) AS q1, round(q.median, 4) AS median, round(q.q3, 4) AS q3,
       round(q.iqr, 4) AS iqr, round(least(s.whisker_low, q.q1), 4) AS whisker_low,
       round(greatest(s.whisker_high, q.q3), 4) AS whisker_high, s.outliers
FROM box_f q JOIN (
    SELECT f.variant, count(*) AS orders,
           min(CASE WHEN f.order_value >= b.fence_low AND f.order_value <= b.fence_high THEN f.order_value END) AS whisker_low,
           max(CASE WHEN f.order_value >= b.fence_low AND f.order_value <= b.fence_high THEN f.order_value END) AS whisker_high,
           CAST(count_if(NOT (f.order_value >= b.fence_low AND f.order_value <= b.fence_high)) AS BIGINT) AS outliers
    FROM fct_known f JOIN box_f b ON f.variant = b.variant GROUP BY f.variant) s
  ON q.variant = s.variant"""),
    "order_value_outliers": with_models("""
SELECT f.variant, f.order_id, f.order_value
FROM fct_known f JOIN box_f b ON f.variant = b.variant
WHERE f.order_value < b.q1 - 1.5 * (b.q3 - b.q1) OR f.order_value > b.q3 + 1.5 * (b.q3 - b.q1)"""),
    "date_dimension": with_models(f"""
SELECT d AS date, {_PARTS_TYPED}
FROM (SELECT CAST(unnest(generate_series(make_date(y1, 1, 1), make_date(y2, 12, 31), INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT year(min(order_created_at)) AS y1, year(max(order_created_at)) AS y2
            FROM fct_experiment_results))"""),
    "orders_by_calendar": with_models(f"""
SELECT d AS date, {_PARTS_TYPED}, count(order_id) AS orders,
       round({exact_avg('order_value')}, 4) AS aov, round(avg(is_completed), 6) AS conversion_rate
FROM (SELECT unnest(generate_series(date_trunc('year', min(order_created_at)),
                                    date_trunc('year', max(order_created_at)) + INTERVAL 1 YEAR - INTERVAL 1 DAY,
                                    INTERVAL 1 DAY))::DATE AS d FROM fct_experiment_results)
LEFT JOIN fct_experiment_results ON order_created_at::DATE = d
GROUP BY d"""),
    "dashboard_cards": _cards_sql(),
    "dashboard_by_variant": with_models(f"""
SELECT variant, count(*) AS orders, round({exact_avg('order_value')}, 4) AS aov,
       round(avg(is_completed), 6) AS conversion_rate
FROM fct_experiment_results GROUP BY variant"""),
    "calendar_drilldown": with_models(f"""
SELECT CAST(level AS INTEGER) AS level, CAST(y AS INTEGER) AS year, CAST(q AS INTEGER) AS quarter_no,
       CASE WHEN level > 1 THEN 'Qtr ' || CAST(q AS VARCHAR) END AS quarter,
       CAST(m AS INTEGER) AS month_no,
       CASE WHEN level > 2 THEN monthname(make_date(2000, CAST(m AS INTEGER), 1)) END AS month,
       CAST(d AS INTEGER) AS day, orders, round(aov, 4) AS aov,
       round(conversion_rate, 6) AS conversion_rate
FROM ({" UNION ALL ".join(_drill(level) for level in range(5))})"""),
    "dashboard_cube": with_models(f"""
SELECT * FROM ({" UNION ALL ".join(_cube_cell(v, o, m) for v in (0, 1) for o in (0, 1) for m in (0, 1))})"""),
    "dashboard_filtered_cards": with_models(" UNION ALL ".join(
        f"SELECT '{chosen}' AS variant_filter, " + ", ".join(
            f"CAST(count(*) FILTER ({passes}) AS BIGINT) AS {v}_orders, "
            f"round({exact_avg('order_value', passes)}, 4) AS {v}_aov, "
            f"round(avg(is_completed) FILTER ({passes}), 6) AS {v}_conv_rate"
            for v in _CFG.variants
            for passes in [f"variant = '{v}' AND '{chosen}' IN ('all', variant)"])
        + " FROM fct_experiment_results" for chosen in ("all", *_CFG.variants))),
    "baseline_metrics": with_models("""
SELECT * FROM baseline_order_value CROSS JOIN baseline_return_rate CROSS JOIN baseline_daily_orders"""),
    "dq_bounds_tight": with_models("""
SELECT metric AS failing_metric, grain, value
FROM rates JOIN (VALUES ('category return_rate', 0.345, 0.37), ('category gross_margin_pct', 0.5, 0.555),
                        ('cohort repeat_purchase_rate', 0.05, 0.5),
                        ('channel repeat_purchase_rate', 0.0, 0.25)) AS limits(metric, least, most)
  USING (metric)
WHERE NOT (value >= CAST(least AS DOUBLE) AND value <= CAST(most AS DOUBLE))"""),
    "dq_rate_bounds": with_models("SELECT * FROM rate_bounds"),
    "dq_results": _dq_sql(),
})


# -- display text: round first, then print ------------------------------------
def _money(x: str, digits: int = 2) -> str:
    return f"'£' || format('{{:.{digits}f}}', round({x}, {digits}))"


def _percent(x: str, digits: int = 1, sign: str = "") -> str:
    return f"format('{{:{sign}.{digits}f}}%', round({x} * 100, {digits}))"


def _lines(items: list[tuple[str, str]], frame: str) -> str:
    rows = ", ".join(f"{{'line': {i}, 'label': '{label}', 'value': {value}}}"
                     for i, (label, value) in enumerate(items, 1))
    return f"SELECT CAST(line AS INTEGER) AS line, label, value FROM (SELECT unnest([{rows}], recursive := true) FROM {frame})"


def _share(name: str) -> str:
    return f"{name}_category || ' (' || {_percent(f'{name}_pct', 0)} || ' margin)'"


_HEADLINES = [
    ("Overall repeat purchase rate", _percent("overall_repeat_rate")),
    ("Highest margin category (top 10)", _share("best_margin")),
    ("Lowest margin category (top 10)", _share("worst_margin")),
    ("Highest return rate (top 10)", f"worst_returns_category || ' (' || "
     f"{_percent('worst_returns_rate', 0)} || ' of items returned)'"),
    ("Best channel by rev/customer",
     f"best_channel || ' (' || {_money('best_channel_revenue_per_customer', 0)} || ', ' || "
     f"{_percent('best_channel_repeat_rate', 0)} || ' repeat)'"),
]


def _four(x: str) -> str:
    return f"format('{{:.4f}}', round({x}, 4))"


def _rate_line(v: str) -> tuple[str, str]:
    return (f"Conversion {v}", f"{_percent(f'z.rate_{v}')} || ' (95% CI: ' || {_percent(f'z.ci_low_{v}')} "
            f"|| ' to ' || {_percent(f'z.ci_high_{v}')} || ')'")


def _mean_line(v: str) -> tuple[str, str]:
    return (f"{v.title()} mean", f"{_money(f'w.mean_{v}')} || ' (SD: ' || {_money(f'w.sd_{v}')} || ')'")


_REPORT = [
    ("Rows loaded", "format('{:,}', n.n)"), _rate_line("control"), _rate_line("treatment"),
    ("Absolute lift", _percent("z.absolute_lift", sign="+")),
    ("Z-statistic", _four("z.z_stat")), ("P-value (conversion)", _four("z.p_value")),
    _mean_line("control"), _mean_line("treatment"),
    ("Absolute difference", "'£' || format('{:+.2f}', round(w.mean_diff, 2))"),
    ("95% CI on difference", f"{_money('w.ci_low')} || ' to ' || {_money('w.ci_high')}"),
    ("T-statistic", _four("w.t_stat")), ("P-value (AOV)", _four("w.p_value")),
    ("Return rate control", _percent("g.return_rate_control")),
    ("Return rate treatment", _percent("g.return_rate_treatment")),
    ("Return rate difference", _percent("g.return_rate_diff", sign="+")),
    ("Guardrail breached", "CAST(g.breached AS VARCHAR)"),
]

ORACLE.update({
    "headline_display": _lines(_HEADLINES, f"({ORACLE['headline_figures']})"),
    "variant_summary_display": f"""
SELECT variant, orders, {_money('avg_order_value')} AS avg_order_value,
       {_money('median_order_value')} AS median_order_value,
       {_money('std_order_value')} AS std_order_value,
       {_percent('conversion_rate')} AS conversion_rate, {_percent('return_rate')} AS return_rate
FROM ({ORACLE['variant_summary']})""",
    "experiment_report_display": with_models(_lines(
        _REPORT, "ztest z, welch w, guardrail g, (SELECT count(*) AS n FROM fct_experiment_results "
                 "WHERE variant IS NOT NULL) n")),
})
