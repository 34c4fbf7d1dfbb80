"""Marts and experiment fact as SQL over shop-shaped tables, NULLs included.

The oracle states them over the driver's raw tables; tests that make their own
dirty shop rows compare with these.
"""

MARTS = """
lines AS (
    SELECT category, department, coalesce(status = 'Cancelled', false) AS off,
           returned_at IS NOT NULL AS back, sale_price, cost
    FROM fct_order_items JOIN dim_products USING (product_id)
),
mart_category_performance AS (
    SELECT category, department, count(*) AS items_ordered,
           count(*) FILTER (NOT off) AS items_sold, count(*) FILTER (back) AS items_returned,
           round(sum(if(off, 0, sale_price)), 2) AS gross_revenue,
           round(sum(if(off, 0, cost)), 2) AS cost_of_goods,
           round(sum(if(off, 0, sale_price - cost)), 2) AS gross_margin,
           round(sum(if(off, 0, sale_price - cost)) / nullif(sum(if(off, 0, sale_price)), 0), 4)
               AS gross_margin_pct,
           round(count(*) FILTER (back) / nullif(count(*) FILTER (NOT off), 0), 4) AS return_rate
    FROM lines GROUP BY category, department
),
mart_customer_retention AS (
    SELECT date_trunc('month', first_at)::DATE AS cohort_month, count(*) AS new_customers,
           count(*) FILTER (n > 1) AS repeat_customers,
           round(count(*) FILTER (n > 1) / count(*), 4) AS repeat_purchase_rate
    FROM (SELECT min(order_created_at) AS first_at, count(DISTINCT order_id) AS n
          FROM dim_orders WHERE status <> 'Cancelled' GROUP BY user_id)
    GROUP BY 1
),
spend AS (
    SELECT user_id, count(DISTINCT order_id) AS n, sum(sale_price) AS s
    FROM fct_order_items WHERE status <> 'Cancelled' GROUP BY user_id
),
mart_channel_performance AS (
    SELECT traffic_source, count(*) AS customers, sum(coalesce(n, 0))::BIGINT AS total_orders,
           round(sum(coalesce(s, 0)), 2) AS total_revenue,
           round(sum(coalesce(s, 0)) / count(*), 2) AS revenue_per_customer,
           round(sum(coalesce(n, 0)) / count(*), 2) AS orders_per_customer,
           round(count(*) FILTER (n > 1) / count(*), 4) AS repeat_purchase_rate
    FROM dim_users LEFT JOIN spend USING (user_id) GROUP BY traffic_source
)"""


def experiment_fact(cfg) -> str:
    statuses = ", ".join(f"'{s}'" for s in cfg.statuses)
    return f"""
fct_experiment_results AS (
    SELECT order_id, user_id, variant, status AS order_status, created_at AS order_created_at,
           order_value, item_count, (status = 'Complete')::INTEGER AS is_completed,
           (status = 'Returned')::INTEGER AS is_returned
    FROM stg_orders JOIN stg_experiment_assignments USING (user_id)
    JOIN (SELECT order_id, sum(sale_price) AS order_value, count(*) AS item_count
          FROM stg_order_items GROUP BY order_id) USING (order_id)
    WHERE created_at >= DATE '{cfg.start}' AND created_at < DATE '{cfg.end}' + INTERVAL 1 DAY
      AND status IN ({statuses})
)"""
