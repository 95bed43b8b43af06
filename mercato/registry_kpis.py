"""Registration of the KPI and summary-mart queries with their DuckDB oracles.

The oracles compute inventory KPIs from the dense daily fact (spine + forward
fill), while the Spark plans use intervals: two different derivations.
"""

from __future__ import annotations

from . import oracle as O
from .functions import constants as C
from .plans import kpis as K
from .registry import REGISTRY, Query, register

P = f"BETWEEN {O.SIM_START} AND {O.SIM_END}"
END = O.SIM_END


def month(c: str) -> str:
    return f"CAST(date_trunc('month', {c}) AS DATE)"


def kpi(name: str, fn, sql: str, dbl=(), big=()) -> None:
    register(name, Query(fn, sql, dbl, big, tags=("kpi",)))


kpi("kpi_net_revenue_waterfall", K.net_revenue_waterfall, f"""
SELECT coalesce(s.m, r.m) AS report_month,
       CAST(coalesce(gross, 0) AS DOUBLE) AS gross_revenue_amount,
       CAST(coalesce(disc, 0) AS DOUBLE) AS discount_amount,
       CAST(coalesce(ref, 0) AS DOUBLE) AS refunded_amount,
       CAST(coalesce(tax, 0) AS DOUBLE) AS tax_amount,
       CAST(coalesce(gross, 0) - coalesce(disc, 0) - coalesce(ref, 0) - coalesce(tax, 0) AS DOUBLE)
           AS kpi_net_revenue_amount
FROM (SELECT {month('order_date')} AS m, sum(gross_revenue_amount) AS gross, sum(discount_amount) AS disc,
             sum(tax_amount) AS tax FROM fact_sales WHERE order_date {P} GROUP BY 1) s
FULL OUTER JOIN (SELECT {month('return_date')} AS m, sum(refunded_amount) AS ref
                 FROM fact_returns WHERE return_date {P} GROUP BY 1) r ON s.m = r.m""")

kpi("kpi_aov_monthly", K.aov_monthly, f"""
SELECT {month('order_date')} AS report_month, sales_channel_code,
       CAST(sum(net_revenue_amount) AS DOUBLE) AS net_revenue_amount,
       count(DISTINCT order_number) FILTER (WHERE fulfillment_status <> 'Cancelled') AS completed_orders,
       CAST(sum(net_revenue_amount) AS DOUBLE) / CAST(nullif(completed_orders, 0) AS DOUBLE) AS average_order_value
FROM fact_sales WHERE order_date {P} GROUP BY 1, 2""")

_STATUS = ("CASE WHEN {x} IS NULL THEN NULL " + " ".join(
    f"WHEN {{x}} >= {lo} THEN '{lab}'" for lo, lab in C.GROSS_MARGIN_STATUS) +
    f" ELSE '{C.GROSS_MARGIN_STATUS_ELSE}' END")
kpi("kpi_gross_margin_monthly", K.gross_margin_monthly, f"""
SELECT report_month, net_revenue_amount, cogs_amount,
       (net_revenue_amount - cogs_amount) / nullif(net_revenue_amount, 0.0) AS gross_margin_pct,
       {_STATUS.format(x='gross_margin_pct')} AS margin_status
FROM (SELECT {month('order_date')} AS report_month, CAST(sum(net_revenue_amount) AS DOUBLE) AS net_revenue_amount,
             CAST(sum(cogs_amount) AS DOUBLE) AS cogs_amount FROM fact_sales WHERE order_date {P} GROUP BY 1)""")

kpi("kpi_return_rate_weekly", K.return_rate_weekly, f"""
SELECT coalesce(s.w, r.w) AS week_start, coalesce(s.cat, r.cat) AS category_name,
       CAST(coalesce(s.u, 0) AS BIGINT) AS sold_units, CAST(coalesce(r.u, 0) AS BIGINT) AS returned_units,
       CAST(coalesce(r.u, 0) AS DOUBLE) / CAST(nullif(coalesce(s.u, 0), 0) AS DOUBLE) AS return_rate
FROM (SELECT CAST(date_trunc('week', fs.order_date) AS DATE) AS w, dp.category_name AS cat, sum(fs.quantity_ordered) AS u
      FROM fact_sales fs JOIN dim_product dp ON fs.product_key = dp.product_key
      WHERE fs.order_date {P} GROUP BY 1, 2) s
FULL OUTER JOIN (SELECT CAST(date_trunc('week', fr.return_date) AS DATE) AS w, dp.category_name AS cat,
                        sum(fr.returned_quantity) AS u
                 FROM fact_returns fr JOIN dim_product dp ON fr.product_key = dp.product_key
                 WHERE fr.return_date {P} GROUP BY 1, 2) r ON s.w = r.w AND s.cat = r.cat""")

_CHANNELS = sorted(set(C.PRIORITY_CHANNEL.values()))
kpi("kpi_margin_matrix", K.margin_matrix, "SELECT dp.category_name, " + ", ".join(
    f"CAST(coalesce(sum(fs.net_revenue_amount) FILTER (WHERE fs.sales_channel_code = '{c}'), 0) AS DOUBLE) AS {c.lower()}"
    for c in _CHANNELS) + f"""
FROM fact_sales fs JOIN dim_product dp ON fs.product_key = dp.product_key
WHERE fs.order_date {P} GROUP BY 1""")

kpi("kpi_finance_rollup", K.finance_rollup, f"""
SELECT dp.category_name, fs.sales_channel_code,
       CAST(GROUPING(dp.category_name, fs.sales_channel_code) AS BIGINT) AS grouping_level,
       CAST(sum(fs.net_revenue_amount) AS DOUBLE) AS net_revenue_amount,
       CAST(sum(fs.cogs_amount) AS DOUBLE) AS cogs_amount, CAST(sum(fs.quantity_ordered) AS BIGINT) AS units
FROM fact_sales fs JOIN dim_product dp ON fs.product_key = dp.product_key
WHERE fs.order_date {P} GROUP BY ROLLUP (dp.category_name, fs.sales_channel_code)""")

kpi("kpi_spend_rollup", K.spend_by_channel_rollup, """
SELECT dc.acquisition_channel_name, CAST(GROUPING(dc.acquisition_channel_name) AS BIGINT) AS grouping_level,
       CAST(sum(f.spend_amount) AS DOUBLE) AS spend_amount
FROM fact_marketing_spend f JOIN dim_campaign dc ON f.campaign_key = dc.campaign_key
GROUP BY ROLLUP (dc.acquisition_channel_name)""")

kpi("kpi_period_over_period", K.period_over_period, f"""
SELECT report_month, sales_channel_code, net_revenue_amount, prev_month_amount, prev_year_amount,
       (net_revenue_amount - prev_month_amount) / nullif(prev_month_amount, 0.0) AS mom_change_pct,
       (net_revenue_amount - prev_year_amount) / nullif(prev_year_amount, 0.0) AS yoy_change_pct
FROM (SELECT g.report_month, g.sales_channel_code, coalesce(CAST(s.rev AS DOUBLE), 0.0) AS net_revenue_amount,
             lag(coalesce(CAST(s.rev AS DOUBLE), 0.0), 1) OVER w AS prev_month_amount,
             lag(coalesce(CAST(s.rev AS DOUBLE), 0.0), 12) OVER w AS prev_year_amount
      FROM (SELECT c.sales_channel_code, CAST(m.range AS DATE) AS report_month
            FROM (SELECT DISTINCT sales_channel_code FROM fact_sales WHERE order_date {P}) c,
                 range({O._d(C.SIM_START.replace(day=1))}, {O._d(C.SIM_END.replace(day=1))} + INTERVAL 1 DAY,
                       INTERVAL 1 MONTH) m) g
      LEFT JOIN (SELECT {month('order_date')} AS m, sales_channel_code, sum(net_revenue_amount) AS rev
                 FROM fact_sales WHERE order_date {P} GROUP BY 1, 2) s
             ON g.report_month = s.m AND g.sales_channel_code = s.sales_channel_code
      WINDOW w AS (PARTITION BY g.sales_channel_code ORDER BY g.report_month))""")

_LTV_STATUS = ("CASE WHEN ltv_to_cac IS NULL THEN NULL " + " ".join(
    f"WHEN ltv_to_cac >= {lo} THEN '{lab}'" for lo, lab in C.LTV_CAC_STATUS) + f" ELSE '{C.LTV_CAC_STATUS_ELSE}' END")
kpi("kpi_ltv_cac_by_channel", K.ltv_cac_by_channel, f"""
SELECT *, {_LTV_STATUS} AS ltv_cac_status
FROM (SELECT *, ltv_per_customer / nullif(cac, 0.0) AS ltv_to_cac
      FROM (SELECT *, total_spend_amount / nullif(CAST(attributed_customers AS DOUBLE), 0.0) AS cac,
                   total_ltv_amount / nullif(CAST(attributed_customers AS DOUBLE), 0.0) AS ltv_per_customer
            FROM ({REGISTRY['q04_ltv_cac_by_channel'].sql}) q04) a) b""")

kpi("kpi_roas_by_channel", K.roas_by_channel, """
SELECT coalesce(s.ch, r.ch) AS acquisition_channel_name, coalesce(CAST(r.rev AS DOUBLE), 0.0) AS attributed_revenue,
       coalesce(CAST(s.spend AS DOUBLE), 0.0) AS spend_amount,
       coalesce(CAST(r.rev AS DOUBLE), 0.0) / nullif(coalesce(CAST(s.spend AS DOUBLE), 0.0), 0.0) AS roas
FROM (SELECT dc.acquisition_channel_name AS ch, sum(f.spend_amount) AS spend
      FROM fact_marketing_spend f JOIN dim_campaign dc ON f.campaign_key = dc.campaign_key
      WHERE dc.campaign_id <> 'NO_CAMPAIGN' GROUP BY 1) s
FULL OUTER JOIN (SELECT camp.acquisition_channel_name AS ch, sum(x.rev) AS rev
                 FROM (SELECT customer_key, sum(net_revenue_amount) AS rev FROM fact_sales GROUP BY 1) x
                 JOIN dim_customer cu ON x.customer_key = cu.customer_key AND cu.customer_id <> 'UNKNOWN'
                 JOIN dim_campaign camp ON cu.acquisition_campaign_key = camp.campaign_key
                      AND camp.campaign_id <> 'NO_CAMPAIGN'
                 GROUP BY 1) r ON s.ch = r.ch""")

_ORD = """(SELECT order_id, customer_id, sales_channel, CAST(order_date AS DATE) AS od
           FROM stg_orders WHERE order_status <> 'Cancelled')"""
_FIRST = """(SELECT customer_id, min(CAST(order_date AS DATE)) AS first_od
             FROM stg_orders WHERE order_status <> 'Cancelled' GROUP BY 1)"""
kpi("kpi_first_purchase_monthly", K.first_purchase_monthly, f"""
SELECT {month('o.od')} AS report_month, o.sales_channel, count(*) AS orders,
       count(*) FILTER (WHERE o.od = f.first_od) AS first_purchase_orders,
       count(DISTINCT o.customer_id) FILTER (WHERE o.od = f.first_od) AS new_customers
FROM {_ORD} o JOIN {_FIRST} f ON o.customer_id = f.customer_id
WHERE o.od {P} GROUP BY 1, 2""")

kpi("kpi_repeat_retention_90d", K.repeat_retention_90d, f"""
SELECT {month('first_od')} AS cohort_month, count(*) AS customers,
       count(*) FILTER (WHERE second_od IS NOT NULL AND date_diff('day', first_od, second_od) <= 90) AS retained_90d,
       CAST(retained_90d AS DOUBLE) / CAST(nullif(customers, 0) AS DOUBLE) AS retention_rate
FROM (SELECT o.customer_id, f.first_od, min(CASE WHEN o.od > f.first_od THEN o.od END) AS second_od
      FROM {_ORD} o JOIN {_FIRST} f ON o.customer_id = f.customer_id GROUP BY 1, 2)
GROUP BY 1""")

kpi("kpi_cohort_grid", K.cohort_grid, f"""
SELECT {month('dc.customer_since')} AS cohort_month,
       date_diff('month', {month('dc.customer_since')}, {month('fs.order_date')}) AS months_since,
       count(DISTINCT fs.customer_key) AS active_customers,
       CAST(sum(fs.net_revenue_amount) - sum(fs.cogs_amount) AS DOUBLE) AS ltv_amount
FROM fact_sales fs JOIN dim_customer dc ON fs.customer_key = dc.customer_key
WHERE fs.customer_key <> -1 AND dc.customer_id <> 'UNKNOWN' GROUP BY 1, 2""", big=("months_since",))

kpi("kpi_marketing_monthly", K.marketing_monthly, f"""
SELECT coalesce(s.m, n.m) AS report_month, coalesce(s.p, n.p) AS marketing_platform,
       coalesce(CAST(s.spend AS DOUBLE), 0.0) AS spend_amount,
       CAST(coalesce(s.imp, 0) AS BIGINT) AS impressions, CAST(coalesce(s.clk, 0) AS BIGINT) AS clicks,
       CAST(coalesce(n.new, 0) AS BIGINT) AS new_customers,
       CAST(s.clk AS DOUBLE) / nullif(CAST(s.imp AS DOUBLE), 0.0) AS click_through_rate,
       coalesce(CAST(s.spend AS DOUBLE), 0.0) / nullif(CAST(s.clk AS DOUBLE), 0.0) AS cost_per_click,
       coalesce(CAST(s.spend AS DOUBLE), 0.0) / nullif(CAST(n.new AS DOUBLE), 0.0) AS cac
FROM (SELECT {month('f.spend_date')} AS m, dc.marketing_platform AS p, sum(f.spend_amount) AS spend,
             sum(f.impressions_count) AS imp, sum(f.clicks_count) AS clk
      FROM fact_marketing_spend f JOIN dim_campaign dc ON f.campaign_key = dc.campaign_key
      WHERE dc.campaign_id <> 'NO_CAMPAIGN' GROUP BY 1, 2) s
FULL OUTER JOIN (SELECT {month('cu.customer_since')} AS m, dc.marketing_platform AS p, count(*) AS new
                 FROM dim_customer cu JOIN dim_campaign dc ON cu.acquisition_campaign_key = dc.campaign_key
                 WHERE cu.customer_id <> 'UNKNOWN' AND dc.campaign_id <> 'NO_CAMPAIGN' GROUP BY 1, 2) n
  ON s.m = n.m AND s.p = n.p""")

kpi("kpi_campaigns_without_customers", K.campaigns_without_customers, """
SELECT c.campaign_id, c.campaign_name, c.acquisition_channel_name, CAST(s.spend AS DOUBLE) AS spend_amount
FROM dim_campaign c JOIN (SELECT campaign_key, sum(spend_amount) AS spend FROM fact_marketing_spend GROUP BY 1) s
  ON c.campaign_key = s.campaign_key
WHERE c.campaign_id <> 'NO_CAMPAIGN'
  AND NOT EXISTS (SELECT 1 FROM dim_customer dc WHERE dc.customer_id <> 'UNKNOWN'
                  AND dc.acquisition_campaign_key = c.campaign_key)""")

kpi("kpi_dso_monthly", K.dso_monthly, f"""
SELECT report_month, avg_daily_ar, credit_net_revenue_amount, days,
       avg_daily_ar / nullif(credit_net_revenue_amount / CAST(days AS DOUBLE), 0.0) AS dso_days
FROM (SELECT {month('ds.report_date')} AS report_month,
             CAST(coalesce(sum(ar.total), 0) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS avg_daily_ar,
             CAST(coalesce(sum(cs.net), 0) AS DOUBLE) AS credit_net_revenue_amount, count(*) AS days
      FROM period_days ds
      LEFT JOIN (SELECT snapshot_date, sum(open_balance_amount) AS total FROM fact_ar_aging_daily GROUP BY 1) ar
             ON ds.report_date = ar.snapshot_date
      LEFT JOIN (SELECT order_date, sum(net_revenue_amount) AS net FROM fact_sales
                 WHERE payment_terms_code <> 'DUE_ON_RECEIPT' GROUP BY 1) cs ON ds.report_date = cs.order_date
      GROUP BY 1)""")

kpi("kpi_ar_accounts_top15", K.ar_accounts_top15, f"""
SELECT customer_id, CAST(sum(open_balance_amount) AS DOUBLE) AS open_ar_amount, count(*) AS open_invoices,
       count(*) FILTER (WHERE days_outstanding > 90) AS invoices_90_plus,
       max(days_outstanding) AS max_days_outstanding, first(payment_terms_code ORDER BY days_outstanding DESC, invoice_number) AS payment_terms_code,
       CASE WHEN max(days_outstanding) > 90 THEN '90+' WHEN max(days_outstanding) > 60 THEN '61-90'
            ELSE 'Current' END AS account_status
FROM fact_ar_aging_daily WHERE snapshot_date = {END}
GROUP BY 1 ORDER BY open_ar_amount DESC, customer_id LIMIT 15""", big=("max_days_outstanding",))

_BUCKETS = ("aging_bucket_0_30_amount", "aging_bucket_31_60_amount", "aging_bucket_61_90_amount",
            "aging_bucket_90_plus_amount")
kpi("kpi_ar_aging_mix_monthly", K.ar_aging_mix_monthly, f"""
SELECT {month('snapshot_date')} AS report_month, {', '.join(f'CAST(sum({b}) AS DOUBLE) / CAST(count(DISTINCT snapshot_date) AS DOUBLE) AS avg_{b}' for b in _BUCKETS)},
       count(DISTINCT snapshot_date) AS days
FROM fact_ar_aging_daily WHERE snapshot_date {P} GROUP BY 1""")

kpi("mart_ar_monthly_by_customer", K.ar_monthly_by_customer, f"""
SELECT {month('snapshot_date')} AS report_month, customer_id, CAST(sum(bal) AS DOUBLE) AS balance_day_sum,
       count(*) AS days_open
FROM (SELECT snapshot_date, customer_id, sum(open_balance_amount) AS bal FROM fact_ar_aging_daily
      WHERE snapshot_date {P} GROUP BY 1, 2)
GROUP BY 1, 2""")

_SCORECARD = """
SELECT ds.supplier_id, count(*) AS po_count, count(po.actual_receipt_date) AS received_count,
       count(*) FILTER (WHERE po.actual_receipt_date IS NOT NULL
                        AND CAST(po.actual_receipt_date AS DATE) <= po.expected_date) AS on_time_count,
       CAST(on_time_count AS DOUBLE) / CAST(nullif(received_count, 0) AS DOUBLE) AS on_time_rate,
       CAST(sum(CASE WHEN po.actual_receipt_date IS NOT NULL
                     THEN date_diff('day', po.po_date, CAST(po.actual_receipt_date AS DATE)) END) AS DOUBLE)
           / CAST(nullif(received_count, 0) AS DOUBLE) AS avg_actual_lead_days,
       CAST(sum(po.purchase_price_variance_amount) AS DOUBLE) AS ppv_amount
FROM fact_purchase_orders po LEFT JOIN dim_supplier ds ON po.supplier_key = ds.supplier_key
GROUP BY po.supplier_key, ds.supplier_id"""
kpi("kpi_supplier_scorecard", K.supplier_scorecard, _SCORECARD)
kpi("kpi_supplier_top15", K.supplier_top15, f"""
SELECT *, CAST(dense_rank() OVER (ORDER BY on_time_rate DESC NULLS LAST) AS BIGINT) AS supplier_rank
FROM ({_SCORECARD} ORDER BY on_time_rate DESC NULLS LAST, ppv_amount, supplier_id LIMIT 15) t""")

kpi("kpi_returns_by_warehouse", K.returns_by_warehouse, "SELECT dw.warehouse_id, " + ", ".join(
    f"CAST(coalesce(sum(fr.returned_quantity) FILTER (WHERE fr.disposition_code = '{d}'), 0) AS BIGINT) AS {d.lower()}_units"
    for d in C.DISPOSITIONS) + """,
       CAST(sum(fr.refunded_amount) AS DOUBLE) AS refunded_amount,
       CAST(sum(fr.restocking_fee_amount) AS DOUBLE) AS restocking_fee_amount,
       CAST(sum(fr.refunded_amount) - sum(fr.restocking_fee_amount) AS DOUBLE) AS margin_erosion_amount
FROM fact_returns fr LEFT JOIN dim_warehouse dw ON fr.warehouse_key = dw.warehouse_key GROUP BY 1""")

kpi("kpi_margin_erosion_top10", K.margin_erosion_top10, """
SELECT dp.sku_code, dp.product_name, CAST(sum(fr.refunded_amount) AS DOUBLE) AS refunded_amount,
       CAST(sum(fr.restocking_fee_amount) AS DOUBLE) AS restocking_fee_amount,
       CAST(sum(fr.refunded_amount) - sum(fr.restocking_fee_amount) AS DOUBLE) AS margin_erosion_amount
FROM fact_returns fr JOIN dim_product dp ON fr.product_key = dp.product_key
GROUP BY fr.product_key, dp.sku_code, dp.product_name
ORDER BY margin_erosion_amount DESC NULLS LAST, sku_code LIMIT 10""")

kpi("kpi_shipping", K.shipping_analysis, """
SELECT carrier, service_level, count(*) AS shipments, count(*) FILTER (WHERE is_cross_border) AS cross_border_shipments,
       CAST(sum(shipping_cost) AS DOUBLE) AS shipping_cost,
       CAST(sum(date_diff('day', CAST(shipped_date AS DATE), CAST(delivered_date AS DATE))) AS DOUBLE)
           / CAST(nullif(count(delivered_date), 0) AS DOUBLE) AS avg_delivery_days,
       CAST(cross_border_shipments AS DOUBLE) / CAST(nullif(shipments, 0) AS DOUBLE) AS cross_border_share
FROM stg_shipments GROUP BY 1, 2""")

kpi("kpi_reorder_quantity", K.reorder_quantities, """
SELECT product_id, pct AS popularity_pct_rank,
       CASE WHEN pct <= 0.5 THEN 'Low' WHEN pct <= 0.8 THEN 'Medium' WHEN pct <= 0.95 THEN 'High'
            WHEN pct <= 1.0 THEN 'Very High' END AS demand_tier,
       CAST(floor(150 + pct * 1050) AS BIGINT) AS reorder_quantity
FROM (SELECT product_id, (rank() OVER (ORDER BY popularity_weight)
                          + (count(*) OVER (PARTITION BY popularity_weight) - 1) / 2.0) / count(*) OVER () AS pct
      FROM stg_products)""")

kpi("kpi_inventory_position", K.inventory_position, """
SELECT coalesce(s.w, p.w) AS warehouse_id, CAST(coalesce(s.oh, 0) AS BIGINT) AS on_hand_qty,
       CAST(coalesce(s.al, 0) AS BIGINT) AS allocated_qty, CAST(coalesce(s.av, 0) AS BIGINT) AS available_qty,
       CAST(coalesce(p.it, 0) AS BIGINT) AS in_transit_qty, coalesce(CAST(s.v AS DOUBLE), 0.0) AS inventory_value
FROM (SELECT warehouse_id AS w, sum(quantity_on_hand) AS oh, sum(quantity_reserved) AS al,
             sum(quantity_available) AS av, sum(inventory_value) AS v FROM stg_inventory_snapshot GROUP BY 1) s
FULL OUTER JOIN (SELECT warehouse_id AS w, sum(quantity_ordered) AS it FROM stg_purchase_orders
                 WHERE po_status = 'In Transit' GROUP BY 1) p ON s.w = p.w""")

kpi("kpi_stockout_days_top15", K.stockout_days_top15, """
SELECT dp.sku_code, dp.category_name, count(*) AS stockout_days
FROM fact_inventory_daily f JOIN dim_product dp ON f.product_id = dp.product_id
WHERE f.quantity_on_hand <= 0 GROUP BY f.product_id, dp.sku_code, dp.category_name
ORDER BY stockout_days DESC, sku_code LIMIT 15""")

kpi("kpi_sell_through", K.sell_through, """
SELECT warehouse_id, product_id, CAST(sum(units_sold_qty) AS BIGINT) AS units_sold,
       CAST(sum(quantity_on_hand) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS avg_on_hand,
       CAST(units_sold AS DOUBLE) / nullif(CAST(units_sold AS DOUBLE) + avg_on_hand, 0.0) AS sell_through_rate
FROM fact_inventory_daily GROUP BY 1, 2""")

kpi("kpi_days_of_supply", K.days_of_supply, """
SELECT warehouse_id, balance_date, quantity_on_hand, units_sold, sold_30d,
       CAST(quantity_on_hand AS DOUBLE) / nullif(sold_30d / 30.0, 0.0) AS days_of_supply
FROM (SELECT warehouse_id, balance_date, CAST(oh AS BIGINT) AS quantity_on_hand, CAST(sold AS BIGINT) AS units_sold,
             CAST(sum(sold) OVER (PARTITION BY warehouse_id ORDER BY balance_date
                                  RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW) AS BIGINT) AS sold_30d
      FROM (SELECT warehouse_id, balance_date, sum(quantity_on_hand) AS oh, sum(units_sold_qty) AS sold
            FROM fact_inventory_daily GROUP BY 1, 2))""")

kpi("kpi_stockout_rate_daily", K.stockout_rate_daily, """
SELECT warehouse_id, balance_date, count(*) AS active_pairs,
       count(*) FILTER (WHERE quantity_on_hand <= 0) AS stockout_pairs,
       CAST(stockout_pairs AS DOUBLE) / CAST(nullif(active_pairs, 0) AS DOUBLE) AS stockout_rate
FROM fact_inventory_daily GROUP BY 1, 2""")

kpi("mart_stockout_by_category_daily", K.stockout_by_category_daily, """
SELECT f.warehouse_id, dp.category_name, f.balance_date, count(*) AS active_pairs,
       count(*) FILTER (WHERE f.quantity_on_hand <= 0) AS stockout_pairs
FROM fact_inventory_daily f JOIN dim_product dp ON f.product_id = dp.product_id GROUP BY 1, 2, 3""")

kpi("kpi_inventory_turnover_monthly", K.inventory_turnover_monthly, f"""
SELECT coalesce(v.w, c.w) AS warehouse_id, coalesce(v.m, c.m) AS report_month,
       coalesce(CAST(c.cogs AS DOUBLE), 0.0) AS cogs_amount,
       CAST(v.value_days AS DOUBLE) / CAST(nullif(v.days, 0) AS DOUBLE) AS avg_inventory_value,
       coalesce(CAST(c.cogs AS DOUBLE), 0.0)
           / nullif(CAST(v.value_days AS DOUBLE) / CAST(nullif(v.days, 0) AS DOUBLE), 0.0) AS inventory_turnover
FROM (SELECT warehouse_id AS w, {month('balance_date')} AS m, sum(val) AS value_days, count(*) AS days
      FROM (SELECT f.warehouse_id, f.balance_date, sum(f.quantity_on_hand * dp.base_cost_sgd) AS val
            FROM fact_inventory_daily f JOIN dim_product dp ON f.product_id = dp.product_id GROUP BY 1, 2)
      GROUP BY 1, 2) v
FULL OUTER JOIN (SELECT dw.warehouse_id AS w, {month('fs.order_date')} AS m, sum(fs.cogs_amount) AS cogs
                 FROM fact_sales fs JOIN dim_warehouse dw ON fs.warehouse_key = dw.warehouse_key
                 WHERE fs.order_date {P} GROUP BY 1, 2) c ON v.w = c.w AND v.m = c.m""")

kpi("mart_executive_daily", K.executive_daily, f"""
SELECT coalesce(s.d, r.d) AS report_date, coalesce(s.ch, r.ch) AS sales_channel_code,
       coalesce(CAST(s.rev AS DOUBLE), 0.0) AS net_revenue_amount, coalesce(CAST(s.cogs AS DOUBLE), 0.0) AS cogs_amount,
       CAST(coalesce(s.units, 0) AS BIGINT) AS sold_units, CAST(coalesce(s.co, 0) AS BIGINT) AS completed_orders,
       CAST(coalesce(r.units, 0) AS BIGINT) AS returned_units
FROM (SELECT order_date AS d, sales_channel_code AS ch, sum(net_revenue_amount) AS rev, sum(cogs_amount) AS cogs,
             sum(quantity_ordered) AS units,
             count(DISTINCT order_number) FILTER (WHERE fulfillment_status <> 'Cancelled') AS co
      FROM fact_sales WHERE order_date {P} GROUP BY 1, 2) s
FULL OUTER JOIN (SELECT fr.return_date AS d, oc.ch, sum(fr.returned_quantity) AS units
                 FROM fact_returns fr
                 JOIN (SELECT DISTINCT order_number, sales_channel_code AS ch FROM fact_sales) oc ON fr.order_number = oc.order_number
                 WHERE fr.return_date {P} GROUP BY 1, 2) r ON s.d = r.d AND s.ch = r.ch""")

kpi("mart_sales_by_region_daily", K.sales_by_region_daily, f"""
SELECT fs.order_date AS report_date, fs.sales_channel_code, dw.warehouse_region,
       CAST(sum(fs.net_revenue_amount) AS DOUBLE) AS net_revenue_amount,
       CAST(sum(fs.quantity_ordered) AS BIGINT) AS sold_units
FROM fact_sales fs JOIN dim_warehouse dw ON fs.warehouse_key = dw.warehouse_key
WHERE fs.order_date {P} GROUP BY 1, 2, 3""")

kpi("mart_po_summary", K.po_summary, """
SELECT ds.supplier_id, dw.warehouse_id, count(*) AS po_count,
       CAST(sum(po.ordered_quantity) AS BIGINT) AS ordered_quantity,
       CAST(sum(po.received_quantity) AS BIGINT) AS received_quantity,
       CAST(sum(po.total_purchase_cost_amount) AS DOUBLE) AS total_purchase_cost_amount,
       CAST(sum(po.purchase_price_variance_amount) AS DOUBLE) AS ppv_amount
FROM fact_purchase_orders po LEFT JOIN dim_supplier ds ON po.supplier_key = ds.supplier_key
LEFT JOIN dim_warehouse dw ON po.destination_warehouse_key = dw.warehouse_key GROUP BY 1, 2""")

kpi("mart_purchase_orders_detail", K.purchase_orders_detail, """
SELECT p.purchase_order_id AS po_number, s.supplier_id, w.warehouse_id, CAST(p.order_date AS DATE) AS po_date,
       p.po_status AS po_status_code, CAST(p.quantity_ordered AS BIGINT) AS ordered_quantity,
       CAST(coalesce(p.quantity_received, 0) AS BIGINT) AS received_quantity,
       CAST(p.quantity_ordered - coalesce(p.quantity_received, 0) AS BIGINT) AS open_quantity,
       CAST(greatest(coalesce(CAST(p.actual_receipt_date AS DATE) - CAST(p.expected_receipt_date AS DATE), 0), 0) AS BIGINT) AS days_late,
       CAST(p.total_cost_sgd AS DOUBLE) AS total_purchase_cost_amount
FROM stg_purchase_orders p LEFT JOIN stg_suppliers s USING (supplier_id) LEFT JOIN stg_warehouses w USING (warehouse_id)""")

kpi("mart_finance_daily", K.finance_daily, f"""
SELECT order_date AS report_date, category_name, sales_channel_code, product_id,
       CAST(sum(net_revenue_amount) AS DOUBLE) AS net_revenue_amount, CAST(sum(cogs_amount) AS DOUBLE) AS cogs_amount,
       CAST(sum(net_revenue_amount - cogs_amount) AS DOUBLE) AS gross_margin_amount,
       CAST(sum(quantity_ordered) AS BIGINT) AS units
FROM fact_sales JOIN dim_product USING (product_key) WHERE order_date {P} GROUP BY ALL""")

kpi("mart_returns_by_channel_daily", K.returns_by_channel_daily, f"""
SELECT r.return_date, o.sales_channel, count(DISTINCT r.order_number) AS returned_orders,
       CAST(sum(r.returned_quantity) AS BIGINT) AS returned_units, CAST(sum(r.refunded_amount) AS DOUBLE) AS refunded_amount
FROM fact_returns r LEFT JOIN stg_orders o ON r.order_number = o.order_id WHERE r.return_date {P} GROUP BY 1, 2""")

kpi("kpi_weekly_spend_and_customers", K.weekly_spend_and_customers, """
SELECT CAST(date_trunc('week', d) AS DATE) AS week_start, CAST(sum(spend) AS DOUBLE) AS spend_amount,
       CAST(sum(n) AS BIGINT) AS new_customers, CAST(sum(paid) AS BIGINT) AS campaign_customers,
       CAST(sum(spend) AS DOUBLE) / CAST(nullif(sum(paid), 0) AS DOUBLE) AS spend_per_campaign_customer
FROM (SELECT spend_date AS d, spend_amount AS spend, 0 AS n, 0 AS paid FROM fact_marketing_spend
      UNION ALL
      SELECT customer_since, 0, 1, CASE WHEN acquisition_campaign_key <> -1 THEN 1 ELSE 0 END FROM dim_customer
      WHERE customer_id <> 'UNKNOWN' AND customer_since IS NOT NULL)
GROUP BY 1""")

kpi("mart_returns_daily", K.returns_daily, f"""
SELECT return_date, product_key, warehouse_key, CAST(sum(returned_quantity) AS BIGINT) AS returned_units,
       CAST(sum(refunded_amount) AS DOUBLE) AS refunded_amount,
       CAST(sum(restocking_fee_amount) AS DOUBLE) AS restocking_fee_amount
FROM fact_returns WHERE return_date {P} GROUP BY 1, 2, 3""")

kpi("mart_spend_daily_by_campaign", K.spend_daily_by_campaign, """
SELECT coalesce(s.d, n.d) AS report_date, coalesce(s.c, n.c) AS campaign_id, coalesce(s.p, n.p) AS marketing_platform,
       coalesce(CAST(s.spend AS DOUBLE), 0.0) AS spend_amount, CAST(coalesce(s.clk, 0) AS BIGINT) AS clicks,
       CAST(coalesce(n.new, 0) AS BIGINT) AS new_customers,
       coalesce(CAST(s.spend AS DOUBLE), 0.0) / nullif(CAST(coalesce(n.new, 0) AS DOUBLE), 0.0) AS cac
FROM (SELECT f.spend_date AS d, dc.campaign_id AS c, dc.marketing_platform AS p, sum(f.spend_amount) AS spend,
             sum(f.clicks_count) AS clk
      FROM fact_marketing_spend f JOIN dim_campaign dc ON f.campaign_key = dc.campaign_key
      WHERE dc.campaign_id <> 'NO_CAMPAIGN' GROUP BY 1, 2, 3) s
FULL OUTER JOIN (SELECT cu.customer_since AS d, dc.campaign_id AS c, dc.marketing_platform AS p, count(*) AS new
                 FROM dim_customer cu JOIN dim_campaign dc ON cu.acquisition_campaign_key = dc.campaign_key
                 WHERE cu.customer_id <> 'UNKNOWN' AND dc.campaign_id <> 'NO_CAMPAIGN' GROUP BY 1, 2, 3) n
  ON s.d = n.d AND s.c = n.c AND s.p = n.p""")

kpi("kpi_frequency_tables", K.frequency_tables, """
SELECT 'order_status' AS attribute, order_status AS value, count(*) AS n FROM stg_orders GROUP BY 2
UNION ALL SELECT 'order_month', strftime(order_date, '%Y-%m'), count(*) FROM stg_orders GROUP BY 2
UNION ALL SELECT 'po_status', po_status, count(*) FROM stg_purchase_orders GROUP BY 2
UNION ALL SELECT 'demand_tier', demand_tier, count(*) FROM stg_purchase_orders GROUP BY 2
UNION ALL SELECT 'invoice_status', invoice_status, count(*) FROM stg_ar_invoices GROUP BY 2
UNION ALL SELECT 'movement_type', movement_type, count(*) FROM stg_inventory_movements GROUP BY 2
UNION ALL SELECT 'lifecycle_status', lifecycle_status, count(*) FROM stg_products GROUP BY 2""")

kpi("order_warehouses", K.order_warehouses, """
SELECT order_id, array_to_string(list_sort(list_distinct(list(warehouse_id))), '|') AS warehouses, count(*) AS lines
FROM stg_order_items GROUP BY 1""")

_MARKETPLACES = ["Shopee", "Lazada"]
kpi("kpi_margin_marketplaces", lambda m: K.margin_filtered(m, {"sales_channel_code": _MARKETPLACES}), f"""
SELECT dp.category_name, fs.sales_channel_code, CAST(sum(fs.net_revenue_amount) AS DOUBLE) AS net_revenue_amount,
       CAST(sum(fs.cogs_amount) AS DOUBLE) AS cogs_amount
FROM fact_sales fs JOIN dim_product dp ON fs.product_key = dp.product_key
JOIN dim_customer dc ON fs.customer_key = dc.customer_key
WHERE fs.order_date {P} AND dp.product_id <> 'UNKNOWN'
  AND fs.sales_channel_code IN ({', '.join(f"'{c}'" for c in _MARKETPLACES)})
GROUP BY 1, 2""")

kpi("dq_sold_outside_lifecycle", K.sold_outside_lifecycle, """
SELECT count(*) FILTER (WHERE fs.order_date < dp.launch_date) AS lines_before_launch,
       count(*) FILTER (WHERE fs.order_date > coalesce(dp.discontinued_date, DATE '9999-12-31')) AS lines_after_discontinued,
       count(*) AS total_lines
FROM fact_sales fs LEFT JOIN dim_product dp ON fs.product_key = dp.product_key""")

kpi("kpi_stockout_with_inbound", K.stockout_with_inbound, """
SELECT l.warehouse_id, l.product_id, l.balance_date AS last_day, l.quantity_on_hand,
       CAST(p.q AS BIGINT) AS in_transit_qty
FROM (SELECT warehouse_id, product_id, balance_date, quantity_on_hand FROM fact_inventory_daily
      QUALIFY row_number() OVER (PARTITION BY warehouse_id, product_id ORDER BY balance_date DESC) = 1) l
JOIN (SELECT warehouse_id, product_id, sum(quantity_ordered) AS q FROM stg_purchase_orders
      WHERE po_status = 'In Transit' GROUP BY 1, 2) p ON l.warehouse_id = p.warehouse_id AND l.product_id = p.product_id
WHERE l.quantity_on_hand <= 0""", big=("quantity_on_hand",))

kpi("dq_campaign_constancy", K.campaign_constancy, """
SELECT count(*) AS campaigns,
       count(*) FILTER (WHERE names > 1 OR channels > 1 OR platforms > 1) AS non_constant_campaigns
FROM (SELECT campaign_id, count(DISTINCT campaign_name) AS names, count(DISTINCT channel) AS channels,
             count(DISTINCT platform) AS platforms FROM stg_marketing_spend GROUP BY 1)""")

kpi("kpi_inventory_valuation_daily", K.inventory_valuation_daily, """
SELECT f.warehouse_id, f.balance_date, count(*) AS active_pairs, CAST(sum(f.quantity_on_hand) AS BIGINT) AS quantity_on_hand,
       CAST(sum(f.quantity_on_hand * dp.base_cost_sgd) AS DOUBLE) AS inventory_value
FROM fact_inventory_daily f JOIN dim_product dp ON f.product_id = dp.product_id GROUP BY 1, 2""")

kpi("kpi_orders_per_customer_by_channel", K.orders_per_customer_by_channel, """
SELECT dc.acquisition_channel, fs.sales_channel_code, count(DISTINCT fs.order_number) AS orders,
       count(DISTINCT fs.customer_key) AS customers,
       CAST(count(DISTINCT fs.order_number) AS DOUBLE) / CAST(nullif(count(DISTINCT fs.customer_key), 0) AS DOUBLE)
           AS orders_per_customer
FROM fact_sales fs JOIN dim_customer dc ON fs.customer_key = dc.customer_key
WHERE fs.fulfillment_status <> 'Cancelled' GROUP BY 1, 2""")

kpi("dq_inventory_delta_check", K.inventory_delta_check, """
SELECT count(*) FILTER (WHERE prev IS NOT NULL
                        AND quantity_on_hand - prev <> units_received_qty + units_returned_qty - units_sold_qty)
           AS mismatches
FROM (SELECT *, lag(quantity_on_hand) OVER (PARTITION BY warehouse_id, product_id ORDER BY balance_date) AS prev
      FROM fact_inventory_daily)""")

kpi("assignment_rule", K.assignment_rule, """
SELECT coalesce(r.warehouse_id, s.warehouse_id) AS warehouse_id, coalesce(r.product_id, s.product_id) AS product_id,
       r.product_id IS NOT NULL AS rule_assigned, s.product_id IS NOT NULL AS has_sales
FROM (SELECT w.warehouse_id, t.product_id
      FROM demand_tiers t CROSS JOIN dim_warehouse w
      WHERE t.demand_tier IN ('High', 'Very High') AND w.warehouse_id <> 'UNKNOWN'
        AND w.warehouse_type <> 'Returns Center') r
FULL OUTER JOIN stg_warehouse_product_assignment s
  ON r.warehouse_id = s.warehouse_id AND r.product_id = s.product_id""")

kpi("kpi_stockout_heatmap", K.stockout_heatmap, """
SELECT f.warehouse_id, dp.category_name, count(*) AS stockout_days
FROM fact_inventory_daily f JOIN dim_product dp ON f.product_id = dp.product_id
WHERE f.quantity_on_hand <= 0 GROUP BY 1, 2""")

kpi("mart_sales_by_acquisition_daily", K.sales_by_acquisition_daily, f"""
SELECT fs.order_date AS report_date, dc.acquisition_channel, CAST(sum(fs.net_revenue_amount) AS DOUBLE) AS net_revenue_amount,
       count(DISTINCT fs.order_number) FILTER (WHERE fs.fulfillment_status <> 'Cancelled') AS completed_orders
FROM fact_sales fs JOIN dim_customer dc ON fs.customer_key = dc.customer_key
WHERE fs.order_date {P} GROUP BY 1, 2""")

kpi("mart_marketing_ltv_monthly", K.marketing_ltv_monthly, f"""
SELECT *, ltv_per_customer / nullif(cac, 0.0) AS ltv_to_cac
FROM (SELECT *, spend_amount / CAST(nullif(new_customers, 0) AS DOUBLE) AS cac,
             total_ltv_amount / CAST(nullif(new_customers, 0) AS DOUBLE) AS ltv_per_customer
      FROM (SELECT coalesce(s.m, n.m) AS report_month, coalesce(s.ch, n.ch) AS acquisition_channel_name,
                   coalesce(CAST(s.spend AS DOUBLE), 0.0) AS spend_amount,
                   CAST(coalesce(n.new, 0) AS BIGINT) AS new_customers,
                   coalesce(CAST(n.ltv AS DOUBLE), 0.0) AS total_ltv_amount
            FROM (SELECT {month('f.spend_date')} AS m, dc.acquisition_channel_name AS ch, sum(f.spend_amount) AS spend
                  FROM fact_marketing_spend f JOIN dim_campaign dc ON f.campaign_key = dc.campaign_key
                  WHERE dc.campaign_id <> 'NO_CAMPAIGN' GROUP BY 1, 2) s
            FULL OUTER JOIN (SELECT {month('cu.customer_since')} AS m, dc.acquisition_channel_name AS ch, count(*) AS new,
                                    sum(coalesce(cl.profit, 0)) AS ltv
                             FROM dim_customer cu JOIN dim_campaign dc ON cu.acquisition_campaign_key = dc.campaign_key
                             LEFT JOIN customer_profit cl ON cu.customer_key = cl.customer_key
                             WHERE cu.customer_id <> 'UNKNOWN' AND dc.campaign_id <> 'NO_CAMPAIGN'
                             GROUP BY 1, 2) n
              ON s.m = n.m AND s.ch = n.ch))""")
