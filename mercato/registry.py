"""Registered queries: Spark plan + independent DuckDB oracle for each.

Outputs are normalised the same way on both sides: DECIMAL -> DOUBLE (after
exact decimal sums), small integers -> BIGINT, arrays -> '|'-joined text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import oracle as O
from .plans import dashboards as D
from .plans.model import Model


@dataclass
class Query:
    spark: Callable[[Model], DataFrame]
    sql: str | None = None          # oracle body over the CTE library
    dbl: tuple[str, ...] = ()       # oracle columns to cast to DOUBLE
    big: tuple[str, ...] = ()       # oracle columns to cast to BIGINT
    note: str = ""
    tags: tuple[str, ...] = field(default_factory=tuple)

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        repl = [f"CAST({c} AS DOUBLE) AS {c}" for c in self.dbl]
        repl += [f"CAST({c} AS BIGINT) AS {c}" for c in self.big]
        body = self.sql if not repl else \
            f"SELECT * REPLACE ({', '.join(repl)}) FROM ({self.sql}) AS q"
        return O.with_ctes(body)


def normalize(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType) or isinstance(f.dataType, T.FloatType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, "|")
        cols.append(c.alias(f.name))
    return df.select(*cols)


REGISTRY: dict[str, Query] = {}


def register(name: str, q: Query) -> None:
    REGISTRY[name] = q


def _stg(name: str, dbl=(), big=(), sql=None) -> Query:
    return Query(lambda m: m.stg(name), sql or f"SELECT * FROM {name}", dbl, big, tags=("staging",))


register("stg_suppliers", _stg("stg_suppliers", big=("lead_time_days",)))
register("stg_products", _stg("stg_products", dbl=("base_cost_sgd", "msrp_sgd"),
                              big=("reorder_point", "reorder_quantity", "lead_time_days")))
register("stg_customers", _stg("stg_customers"))
register("stg_warehouses", _stg(
    "stg_warehouses",
    sql="SELECT * REPLACE (array_to_string(serves_countries, '|') AS serves_countries) FROM stg_warehouses"))
register("stg_warehouse_product_assignment", _stg("stg_warehouse_product_assignment"))
register("stg_inventory_snapshot", _stg(
    "stg_inventory_snapshot", dbl=("inventory_value",),
    big=("quantity_on_hand", "quantity_reserved", "quantity_available", "safety_stock", "reorder_point")))
register("stg_purchase_orders", _stg(
    "stg_purchase_orders", dbl=("unit_cost_sgd", "total_cost_sgd"),
    big=("quantity_ordered", "quantity_received", "expected_lead_time_days")))
register("stg_orders", _stg("stg_orders"))
register("stg_order_items", _stg(
    "stg_order_items", big=("quantity",),
    dbl=("unit_price", "gross_sales", "discount_amount", "net_sales", "tax_amount", "commission_amount")))
register("stg_shipments", _stg("stg_shipments", dbl=("shipping_cost",)))
register("stg_returns", _stg("stg_returns", big=("returned_quantity",)))
register("stg_inventory_movements", _stg("stg_inventory_movements", big=("quantity",)))
register("stg_marketing_spend", _stg("stg_marketing_spend", dbl=("spend_sgd", "cost_per_click_sgd")))
register("stg_acquisition_attribution", _stg("stg_acquisition_attribution"))
register("stg_ar_invoices", _stg("stg_ar_invoices", dbl=("invoice_amount", "amount_paid")))

# -- dimensions ---------------------------------------------------------------

register("dim_date", Query(lambda m: m.dim_date, "SELECT * FROM dim_date",
                           big=("day_of_week_number", "week_number", "calendar_month_number",
                                "calendar_quarter_number", "calendar_year_number", "fiscal_year_number",
                                "fiscal_quarter_number", "fiscal_month_number")))
register("dim_product", Query(lambda m: m.dim_product, "SELECT * FROM dim_product",
                              dbl=("base_cost_sgd", "msrp_sgd")))
register("dim_supplier", Query(lambda m: m.dim_supplier, "SELECT * FROM dim_supplier",
                               big=("lead_time_days",)))
register("dim_warehouse", Query(
    lambda m: m.dim_warehouse,
    "SELECT * REPLACE (array_to_string(serves_countries, '|') AS serves_countries) FROM dim_warehouse"))
register("dim_campaign", Query(lambda m: m.dim_campaign, "SELECT * FROM dim_campaign"))
register("dim_customer", Query(lambda m: m.dim_customer, "SELECT * FROM dim_customer"))

# -- facts ----------------------------------------------------------------------

_SALES_MONEY = ("unit_list_price_amount", "unit_selling_price_amount", "gross_revenue_amount",
                "discount_amount", "tax_amount", "net_revenue_amount", "commission_amount", "cogs_amount")
register("fact_sales", Query(lambda m: m.fact_sales, "SELECT * FROM fact_sales", dbl=_SALES_MONEY,
                             big=("line_item_number", "quantity_ordered")))
register("fact_returns", Query(lambda m: m.fact_returns, "SELECT * FROM fact_returns",
                               dbl=("refunded_amount", "restocking_fee_amount"),
                               big=("returned_quantity",)))
register("fact_purchase_orders", Query(
    lambda m: m.fact_purchase_orders, "SELECT * FROM fact_purchase_orders",
    dbl=("unit_purchase_cost_amount", "total_purchase_cost_amount", "purchase_price_variance_amount"),
    big=("ordered_quantity", "received_quantity", "lead_time_days")))
register("fact_marketing_spend", Query(lambda m: m.fact_marketing_spend,
                                       "SELECT * FROM fact_marketing_spend", dbl=("spend_amount",)))
register("running_totals", Query(lambda m: m.running_totals, "SELECT * FROM running_totals",
                                 big=("quantity", "cumulative_qty_change")))
register("balance_offset", Query(lambda m: m.balance_offset, "SELECT * FROM balance_offset",
                                 big=("snapshot_quantity_on_hand", "cumulative_at_snapshot",
                                      "opening_balance_offset")))
_AR_MONEY = ("invoice_amount", "open_balance_amount", "aging_bucket_0_30_amount", "aging_bucket_31_60_amount",
             "aging_bucket_61_90_amount", "aging_bucket_90_plus_amount")
register("fact_ar_aging_daily", Query(lambda m: m.fact_ar_aging_daily, "SELECT * FROM fact_ar_aging_daily",
                                      dbl=_AR_MONEY, big=("days_outstanding",)))


def _inventory_daily_summary(m: Model) -> DataFrame:
    """Date x warehouse roll-up of the dense daily inventory fact (the fact has
    one row per pair-day; its rows are produced and consumed in one stage)."""
    f = m.fact_inventory_daily
    return (f.groupBy("balance_date", "warehouse_id")
            .agg(F.count(F.lit(1)).alias("active_pairs"),
                 F.sum("quantity_on_hand").alias("quantity_on_hand"),
                 F.count(F.when(F.col("quantity_on_hand") <= 0, 1)).alias("stockout_pairs"),
                 F.sum("units_sold_qty").alias("units_sold_qty"),
                 F.sum("units_returned_qty").alias("units_returned_qty"),
                 F.sum("units_received_qty").alias("units_received_qty"),
                 F.sum(F.col("inventory_fact_key") % 1000003).alias("key_checksum")))


register("inventory_daily_summary", Query(
    _inventory_daily_summary,
    """SELECT balance_date, warehouse_id, count(*) AS active_pairs, sum(quantity_on_hand) AS quantity_on_hand,
              count(*) FILTER (WHERE quantity_on_hand <= 0) AS stockout_pairs,
              sum(units_sold_qty) AS units_sold_qty, sum(units_returned_qty) AS units_returned_qty,
              sum(units_received_qty) AS units_received_qty,
              sum(inventory_fact_key % 1000003) AS key_checksum
       FROM fact_inventory_daily GROUP BY 1, 2""",
    big=("active_pairs", "quantity_on_hand", "stockout_pairs", "units_sold_qty", "units_returned_qty",
         "units_received_qty", "key_checksum")))

# -- dashboards ------------------------------------------------------------------

_CC = O.CHANNEL_CLASS_SQL
_PERIOD = f"BETWEEN {O.SIM_START} AND {O.SIM_END}"

register("q01_overview", Query(D.q01_overview, f"""
SELECT report_date, coalesce(CAST(sum(net) AS DOUBLE), 0.0) AS net_revenue_amount,
       coalesce(CAST(sum(cost) AS DOUBLE), 0.0) AS cogs_amount, coalesce(sum(sold), 0) AS sold_units,
       coalesce(sum(done), 0) AS completed_orders, coalesce(sum(came_back), 0) AS returned_units,
       coalesce(sum(stocked), 0) AS active_skus, coalesce(sum(sold_out), 0) AS stockout_skus
FROM (SELECT full_date AS report_date FROM dim_date
      UNION ALL BY NAME
      SELECT order_date AS report_date, sum(net_revenue_amount) AS net, sum(cogs_amount) AS cost,
             sum(quantity_ordered) AS sold,
             count(DISTINCT CASE WHEN fulfillment_status <> 'Cancelled' THEN order_number END) AS done
      FROM fact_sales GROUP BY 1
      UNION ALL BY NAME
      SELECT return_date AS report_date, sum(returned_quantity) AS came_back FROM fact_returns GROUP BY 1
      UNION ALL BY NAME
      SELECT balance_date AS report_date, count(*) AS stocked, count(*) FILTER (lowest <= 0) AS sold_out
      FROM (SELECT balance_date, min(quantity_on_hand) AS lowest FROM fact_inventory_daily
            GROUP BY balance_date, product_key, warehouse_key)
      GROUP BY 1)
WHERE report_date {_PERIOD} GROUP BY 1""",
    big=("sold_units", "completed_orders", "returned_units", "active_skus", "stockout_skus"),
    tags=("dashboard",)))

register("q02_revenue_by_channel", Query(D.q02_revenue_by_channel, f"""
SELECT dd.full_date AS report_date, fs.sales_channel_code,
       CAST(sum(fs.net_revenue_amount) AS DOUBLE) AS net_revenue_amount,
       count(DISTINCT fs.order_number) FILTER (WHERE fs.fulfillment_status <> 'Cancelled') AS completed_orders
FROM fact_sales fs JOIN dim_date dd ON fs.order_date_key = dd.date_key
WHERE dd.full_date {_PERIOD} GROUP BY 1, 2""", tags=("dashboard",)))

_Q03 = f"""
SELECT dp.product_name, dp.sku_code, dp.category_name, dp.brand_name,
       CAST(sum(fs.net_revenue_amount) AS DOUBLE) AS net_revenue_amount,
       CAST(sum(fs.quantity_ordered) AS BIGINT) AS units_sold,
       CAST(sum(fs.net_revenue_amount) AS DOUBLE) / CAST(nullif(sum(fs.quantity_ordered), 0) AS DOUBLE)
           AS avg_selling_price
FROM fact_sales fs JOIN dim_date dd ON fs.order_date_key = dd.date_key
JOIN dim_product dp ON fs.product_key = dp.product_key
WHERE dd.full_date {_PERIOD} AND dp.product_id <> 'UNKNOWN'
GROUP BY 1, 2, 3, 4"""
register("q03_top_skus", Query(D.q03_top_skus, _Q03, tags=("dashboard",)))
register("q03_top10_skus", Query(D.q03_top10_skus,
                                 f"SELECT * FROM ({_Q03}) ORDER BY net_revenue_amount DESC, sku_code LIMIT 10",
                                 tags=("dashboard",)))

register("q04_ltv_cac_by_channel", Query(D.q04_ltv_cac_by_channel, """
SELECT acquisition_channel_name, marketing_platform, CAST(sum(cost) AS DOUBLE) AS total_spend_amount,
       CAST(sum(people) AS BIGINT) AS attributed_customers, CAST(sum(profit) AS DOUBLE) AS total_ltv_amount
FROM campaign_ledger JOIN dim_campaign USING (campaign_key)
WHERE campaign_id <> 'NO_CAMPAIGN' GROUP BY 1, 2 HAVING sum(people) > 0""", tags=("dashboard",)))

register("q05_dso", Query(D.q05_dso, f"""
SELECT report_date, coalesce(CAST(sum(owed) AS DOUBLE), 0.0) AS daily_total_ar,
       coalesce(CAST(sum(on_credit) AS DOUBLE), 0.0) AS credit_net_revenue_amount
FROM (SELECT full_date AS report_date FROM dim_date
      UNION ALL BY NAME
      SELECT snapshot_date AS report_date, open_balance_amount AS owed FROM fact_ar_aging_daily
      UNION ALL BY NAME
      SELECT order_date AS report_date, net_revenue_amount AS on_credit FROM fact_sales
      WHERE payment_terms_code <> 'DUE_ON_RECEIPT')
WHERE report_date {_PERIOD} GROUP BY 1""", tags=("dashboard",)))

register("q06_margin_category_channel", Query(D.q06_margin_category_channel, f"""
SELECT category_name, sales_channel_code, CAST(sum(net) AS DOUBLE) AS net_revenue_amount, CAST(sum(cost) AS DOUBLE) AS cogs_amount
FROM (SELECT product_key, sales_channel_code, sum(net_revenue_amount) AS net, sum(cogs_amount) AS cost
      FROM fact_sales WHERE order_date {_PERIOD} GROUP BY ALL)
JOIN (SELECT product_key, category_name FROM dim_product WHERE product_key <> -1) USING (product_key)
GROUP BY ALL""", tags=("dashboard",)))

register("q07_margin_country", Query(D.q07_margin_country, f"""
WITH per_customer AS (
  SELECT customer_key, sum(net_revenue_amount) AS net, sum(cogs_amount) AS cost FROM fact_sales
  WHERE customer_key <> -1 AND order_date {_PERIOD} GROUP BY customer_key)
SELECT (SELECT any_value(customer_country) FROM dim_customer known WHERE known.customer_key = per_customer.customer_key) AS customer_country,
       CAST(sum(net) AS DOUBLE) AS net_revenue_amount, CAST(sum(cost) AS DOUBLE) AS cogs_amount
FROM per_customer GROUP BY ALL""", dbl=("net_revenue_amount", "cogs_amount"), tags=("dashboard",)))

register("q08_channel_class_mix", Query(D.q08_channel_class_mix, f"""
SELECT make_date(any_value(year(order_date)), any_value(month(order_date)), 1) AS report_month, channel_class,
       CAST(sum(net_revenue_amount) AS DOUBLE) AS net_revenue_amount
FROM (SELECT order_date, net_revenue_amount, {_CC} AS channel_class FROM fact_sales WHERE order_date {_PERIOD})
GROUP BY strftime(order_date, '%Y%m'), channel_class""", tags=("dashboard",)))

register("q09_aov_return_by_class", Query(D.q09_aov_return_by_class, f"""
SELECT channel_class, CAST(sum(net) AS DOUBLE) AS net_revenue_amount, CAST(sum(sold) AS BIGINT) AS sold_units,
       count(DISTINCT done) AS completed_orders, CAST(coalesce(sum(came_back), 0) AS BIGINT) AS returned_units
FROM (SELECT {_CC} AS channel_class, net_revenue_amount AS net, quantity_ordered AS sold,
             CASE WHEN fulfillment_status <> 'Cancelled' THEN order_number END AS done
      FROM fact_sales WHERE order_date {_PERIOD}
      UNION ALL BY NAME
      SELECT {_CC} AS channel_class, returned_quantity AS came_back
      FROM fact_returns JOIN (SELECT order_id AS order_number, sales_channel AS sales_channel_code FROM stg_orders)
           USING (order_number)
      WHERE return_date {_PERIOD})
GROUP BY 1 HAVING count(sold) > 0""", tags=("dashboard",)))

register("q10_cac_trend", Query(D.q10_cac_trend, """
SELECT CAST(date_trunc('month', happened_on) AS DATE) AS report_month, acquisition_channel_name,
       CAST(sum(cost) AS DOUBLE) AS spend_amount, CAST(sum(people) AS BIGINT) AS new_customers
FROM (SELECT spend_date AS happened_on, campaign_key, spend_amount AS cost, 0 AS people FROM fact_marketing_spend
      UNION ALL
      SELECT customer_since, acquisition_campaign_key, 0, 1 FROM dim_customer WHERE customer_id <> 'UNKNOWN')
JOIN dim_campaign USING (campaign_key) WHERE campaign_id <> 'NO_CAMPAIGN' GROUP BY 1, 2""", tags=("dashboard",)))

register("q11_ltv_by_cohort", Query(D.q11_ltv_by_cohort, """
SELECT CAST(date_trunc('month', customer_since) AS DATE) AS cohort_month, count(*) AS customers,
       CAST(sum(coalesce(profit, 0)) AS DOUBLE) AS total_ltv_amount
FROM dim_customer LEFT JOIN customer_profit USING (customer_key)
WHERE customer_id <> 'UNKNOWN' GROUP BY 1""", tags=("dashboard",)))

register("q12_campaign_triage", Query(D.q12_campaign_triage, """
SELECT campaign_name, acquisition_channel_name, marketing_platform,
       coalesce(CAST(cost AS DOUBLE), 0.0) AS total_spend_amount, coalesce(people, 0) AS new_customers,
       coalesce(CAST(profit AS DOUBLE), 0.0) AS total_ltv_amount,
       total_ltv_amount / nullif(total_spend_amount, 0.0) AS ltv_to_cac
FROM dim_campaign LEFT JOIN campaign_ledger USING (campaign_key)
WHERE campaign_id <> 'NO_CAMPAIGN'""", tags=("dashboard",)))


from . import registry_kpis  # noqa: E402,F401  (registers the KPI and mart queries)
from . import registry_quality  # noqa: E402,F401  (registers the data-quality queries)
from . import registry_more  # noqa: E402,F401  (history, ingest, incremental, streaming)
from . import registry_reports  # noqa: E402,F401  (filtered reports, cubes, fulfilment)
