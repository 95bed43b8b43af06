"""Registration of the data-quality queries with their DuckDB oracles."""

from __future__ import annotations

from .functions import constants as C
from .operators.quality import check_sql
from .plans import quality_suite as Q
from .registry import Query, register


def _suite_sql(checks) -> str:
    return "\nUNION ALL\n".join(check_sql(c, lambda t: t) for c in checks)


def dq(name: str, fn, sql: str, big=()) -> None:
    register(name, Query(fn, sql, big=big, tags=("quality",)))


dq("dq_staging", Q.dq_staging, _suite_sql(Q.STAGING_CHECKS))
dq("dq_marts", Q.dq_marts, _suite_sql(Q.MART_CHECKS))
dq("dq_inventory_daily", Q.dq_inventory_daily, _suite_sql(Q.INVENTORY_CHECKS))
dq("dq_rules", Q.dq_rules, _suite_sql(Q.RULE_CHECKS))

dq("dq_balance_reconciliation", Q.balance_reconciliation, """
SELECT coalesce(o.w, mv.w) AS warehouse_id, coalesce(o.p, mv.p) AS product_id,
       CAST(coalesce(o.q, 0) AS BIGINT) AS opening_qty, CAST(coalesce(mv.q, 0) AS BIGINT) AS movement_qty,
       CAST(coalesce(o.q, 0) + coalesce(mv.q, 0) AS BIGINT) AS closing_qty
FROM (SELECT warehouse_id AS w, product_id AS p, sum(quantity_on_hand) AS q FROM stg_inventory_snapshot GROUP BY 1, 2) o
FULL OUTER JOIN (SELECT warehouse_id AS w, product_id AS p, sum(quantity) AS q
                 FROM stg_inventory_movements GROUP BY 1, 2) mv ON o.w = mv.w AND o.p = mv.p
WHERE coalesce(o.q, 0) + coalesce(mv.q, 0) < 0
ORDER BY closing_qty, warehouse_id, product_id LIMIT 10""")

dq("dq_orders_before_signup", Q.orders_before_signup, """
SELECT count(*) FILTER (WHERE fs.order_date < dc.customer_since) AS lines_before_signup, count(*) AS total_lines
FROM fact_sales fs LEFT JOIN dim_customer dc ON fs.customer_key = dc.customer_key""")

dq("dq_orders_before_first_signup", Q.orders_before_first_signup, f"""
SELECT count(*) AS customers, count(first_signup) AS signed_up, count(*) FILTER (WHERE first_order < first_signup) AS ordered_before,
       max(date_diff('day', first_order, first_signup)) AS longest_gap_days
FROM (SELECT customer_id, CAST(min(order_date) AS DATE) AS first_order FROM stg_orders GROUP BY 1)
LEFT JOIN (SELECT format('CUST-{{:06d}}', user_id) AS customer_id, CAST(min(ts) - INTERVAL {C.EVENT_YEARS_BACK} YEAR AS DATE) AS first_signup
           FROM events WHERE event_type = 'signup' GROUP BY user_id) USING (customer_id)""", big=("longest_gap_days",))

dq("dq_freshness_all", Q.freshness_of_all, " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS rows, " + (f"CAST(min({date}) AS DATE) AS earliest, CAST(max({date}) AS DATE) AS latest" if date else "CAST(NULL AS DATE) AS earliest, CAST(NULL AS DATE) AS latest") + f" FROM {name}"
    for name, date in {**Q.DATES, "running_totals": "movement_date", "balance_offset": "snapshot_date", "inventory_spine": "balance_date", "ar_spine": "snapshot_date", "fact_inventory_daily": "balance_date", "fact_ar_aging_daily": "snapshot_date"}.items()))

dq("dq_shared_order_quantity", Q.shared_order_quantity, """
SELECT quantity_ordered, count(DISTINCT product_id) AS products, count(*) AS purchase_orders
FROM stg_purchase_orders GROUP BY 1""", big=("quantity_ordered",))

dq("dq_po_vs_sales", Q.po_vs_sales, """
SELECT coalesce(po.p, s.p) AS product_id, CAST(coalesce(po.q, 0) AS BIGINT) AS units_ordered,
       CAST(coalesce(s.q, 0) AS BIGINT) AS units_sold,
       CAST(coalesce(po.q, 0) AS DOUBLE) / nullif(CAST(coalesce(s.q, 0) AS DOUBLE), 0.0) AS order_to_sales_ratio,
       coalesce(po.q, 0) > coalesce(s.q, 0) * 2 AS over_ordered
FROM (SELECT product_id AS p, sum(quantity_ordered) AS q FROM stg_purchase_orders GROUP BY 1) po
FULL OUTER JOIN (SELECT product_id AS p, sum(quantity) AS q FROM stg_order_items GROUP BY 1) s ON po.p = s.p""")

dq("dq_freshness", Q.freshness, """
SELECT 'fact_sales' AS table_name, max(order_date) AS as_of FROM fact_sales
UNION ALL SELECT 'fact_returns', max(return_date) FROM fact_returns
UNION ALL SELECT 'inventory_movements', max(CAST(movement_date AS DATE)) FROM stg_inventory_movements
UNION ALL SELECT 'fact_marketing_spend', max(spend_date) FROM fact_marketing_spend
UNION ALL SELECT 'ar_invoices', max(invoice_date) FROM stg_ar_invoices""")

dq("dq_anchor_check", Q.anchor_check, """
SELECT count(*) AS pairs_checked, count(*) FILTER (WHERE f.quantity_on_hand <> s.quantity_on_hand) AS mismatches
FROM fact_inventory_daily f JOIN stg_inventory_snapshot s
  ON f.warehouse_id = s.warehouse_id AND f.product_id = s.product_id AND f.balance_date = s.snapshot_date""")
