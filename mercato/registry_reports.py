"""Registration: filtered reports with a comparison period, cubes, fulfilment."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from . import oracle as O
from .functions.exprs import date_key
from .plans import fulfilment as FU
from .plans import reports as R
from .plans.model import Model
from .registry import Query, register

# Chosen values: two aligned half years and one choice for every filter.
NOW, BEFORE = (dt.date(1997, 7, 1), dt.date(1997, 12, 31)), (dt.date(1996, 7, 1), dt.date(1996, 12, 31))
EARLY, EARLIER = (dt.date(1995, 1, 16), dt.date(1995, 1, 30)), (dt.date(1995, 1, 1), dt.date(1995, 1, 15))


def _between(date: str, period) -> str:
    return f"{date} BETWEEN {O._d(period[0])} AND {O._d(period[1])}"


def _scorecard_sql(parts: list[tuple[str, str, dict[str, str]]], now, before, ratios: list[str]) -> str:
    """``parts``: per fact its rows, its date and, by KPI, the aggregate."""
    values = []
    for rows, date, kpis in parts:
        for name, aggregate in kpis.items():
            now_sql, before_sql = (f"(SELECT CAST(coalesce({aggregate}, 0) AS DOUBLE) FROM ({rows}) WHERE {_between(date, p)})" for p in (now, before))
            values.append(f"SELECT '{name}' AS kpi, {now_sql} AS current_value, {before_sql} AS previous_value")
    divided = [f"SELECT '{name}', a.current_value / nullif(b.current_value, 0), a.previous_value / nullif(b.previous_value, 0) "
               f"FROM v a, v b WHERE a.kpi = '{R.RATIOS[name][0]}' AND b.kpi = '{R.RATIOS[name][1]}'" for name in ratios]
    both = " UNION ALL ".join(["SELECT * FROM v", *divided])
    return f"""SELECT *, (current_value - previous_value) / nullif(previous_value, 0) AS change
FROM (WITH v AS ({" UNION ALL ".join(values)}) {both})"""


_SALES = {"net_revenue": "sum(net_revenue_amount)", "cogs": "sum(cogs_amount)", "discounts": "sum(discount_amount)", "units_sold": "sum(quantity_ordered)",
          "completed_orders": "count(DISTINCT order_number) FILTER (WHERE fulfillment_status <> 'Cancelled')"}
_RETURNS = {"refunds": "sum(refunded_amount)", "units_returned": "sum(returned_quantity)"}
_PURCHASES = {"purchase_orders": "count(*)", "units_ordered": "sum(ordered_quantity)", "units_received": "sum(received_quantity)",
              "received_on_time": "count(*) FILTER (WHERE CAST(actual_receipt_date AS DATE) <= expected_date)", "received": "count(actual_receipt_date)",
              "price_variance": "sum(purchase_price_variance_amount)"}
_SPEND = {"spend": "sum(spend_amount)", "impressions": "sum(impressions_count)", "clicks": "sum(clicks_count)"}
_CUSTOMERS = {"new_customers": "count(*)", "attributed_customers": "count(*) FILTER (WHERE acquisition_campaign_key <> -1)"}

EXECUTIVE = {"channel": ["Shopify", "Shopee", "Retail"], "country": lambda c: c.startswith("NATION_1"), "category": lambda c: c.startswith("S")}
_IN_COUNTRY = "SELECT customer_key FROM dim_customer WHERE customer_country LIKE 'NATION@_1%' ESCAPE '@'"
_IN_CATEGORY = "SELECT product_key FROM dim_product WHERE category_name LIKE 'S%'"


def executive(m: Model):
    return R.Report(m, NOW, BEFORE, EXECUTIVE).scorecard(["sales", "returns"])


register("report_executive", Query(executive, _scorecard_sql([
    (f"SELECT * FROM fact_sales WHERE sales_channel_code IN ('Shopify', 'Shopee', 'Retail') AND customer_key IN ({_IN_COUNTRY}) AND product_key IN ({_IN_CATEGORY})", "order_date", _SALES),
    (f"SELECT * FROM fact_returns WHERE order_number IN (SELECT order_id FROM stg_orders WHERE sales_channel IN ('Shopify', 'Shopee', 'Retail')) "
     f"AND customer_key IN ({_IN_COUNTRY}) AND product_key IN ({_IN_CATEGORY})", "return_date", _RETURNS)],
    NOW, BEFORE, ["average_order_value", "cost_share", "return_rate"]), dbl=("current_value", "previous_value", "change"), tags=("report",)))


def supply_chain(m: Model):
    return R.Report(m, NOW, BEFORE, {"warehouse": ["WH-01", "WH-02", "WH-03"], "category": lambda c: c.startswith("S"),
                                     "supplier": lambda c: F.right(c, F.lit(1)).isin("1", "3", "5", "7")}).scorecard(["purchases", "stock"])


_DEPOTS = "SELECT warehouse_key FROM dim_warehouse WHERE warehouse_id IN ('WH-01', 'WH-02', 'WH-03')"
_SUPPLIED = "SELECT product_key FROM dim_product JOIN stg_products USING (product_id) WHERE regexp_matches(supplier_id, '[1357]$')"



register("report_supply_chain", Query(supply_chain, _scorecard_sql([
    (f"SELECT * FROM fact_purchase_orders WHERE destination_warehouse_key IN ({_DEPOTS}) AND product_key IN ({_IN_CATEGORY}) "
     f"AND supplier_key IN (SELECT supplier_key FROM dim_supplier WHERE regexp_matches(supplier_id, '[1357]$'))", "po_date", _PURCHASES),
    (f"SELECT * FROM fact_inventory_daily WHERE warehouse_key IN ({_DEPOTS}) AND product_key IN ({_IN_CATEGORY}) AND product_key IN ({_SUPPLIED})", "balance_date",
     {"pair_days": "count(*)", "stockout_pair_days": "count(*) FILTER (WHERE quantity_on_hand <= 0)"})],
    NOW, BEFORE, ["on_time_rate", "fill_rate", "stockout_rate"]), dbl=("current_value", "previous_value", "change"), tags=("report",)))


def marketing(m: Model):
    return R.Report(m, EARLY, EARLIER, {"acquisition_channel": lambda c: c != "Instagram", "cohort": [dt.date(1995, 1, 1)],
                                        "platform": lambda c: c != "TikTok", "campaign": lambda c: F.right(c, F.lit(1)) != "9"}).scorecard(["spend", "customers", "sales"])


_RUN = """SELECT campaign_key FROM dim_campaign WHERE acquisition_channel_name <> 'Instagram' AND marketing_platform <> 'TikTok' AND campaign_id NOT LIKE '%9'"""
_ACQUIRED = f"SELECT customer_key FROM dim_customer WHERE acquisition_campaign_key IN ({_RUN}) AND date_trunc('month', customer_since) = DATE '1995-01-01'"

register("report_marketing", Query(marketing, _scorecard_sql([
    (f"SELECT * FROM fact_marketing_spend WHERE campaign_key IN ({_RUN})", "spend_date", _SPEND),
    (f"SELECT * FROM dim_customer WHERE customer_id <> 'UNKNOWN' AND customer_key IN ({_ACQUIRED})", "customer_since", _CUSTOMERS),
    (f"SELECT * FROM fact_sales WHERE customer_key IN ({_ACQUIRED})", "order_date", _SALES)],
    EARLY, EARLIER, ["average_order_value", "cost_share", "cost_per_click", "cac"]), dbl=("current_value", "previous_value", "change"), tags=("report",)))

# -- sub-totals ---------------------------------------------------------------------

SETS = [["category_name", "sales_channel_code", "order_month"], ["category_name", "sales_channel_code"], ["sales_channel_code", "order_month"], ["category_name"], ["order_month"], []]

register("kpi_margin_cube", Query(lambda m: R.margin_cube(m, SETS), f"""
SELECT category_name, sales_channel_code, order_month, grouping(category_name, sales_channel_code, order_month) AS grouping_level,
       CAST(sum(net_revenue_amount) AS DOUBLE) AS net_revenue_amount, CAST(sum(cogs_amount) AS DOUBLE) AS cogs_amount, CAST(sum(quantity_ordered) AS BIGINT) AS units
FROM (SELECT category_name, sales_channel_code, CAST(date_trunc('month', order_date) AS DATE) AS order_month, net_revenue_amount, cogs_amount, quantity_ordered
      FROM fact_sales JOIN dim_product USING (product_key) WHERE order_date BETWEEN {O.SIM_START} AND {O.SIM_END})
GROUP BY GROUPING SETS ({", ".join("(" + ", ".join(s) + ")" for s in SETS)})""", big=("grouping_level",), tags=("kpi",)))

# -- fulfilment -----------------------------------------------------------------------

_PLACES = """
WITH ends AS (SELECT n_regionkey, min(n_nationkey) AS lowest, max(n_nationkey) AS highest FROM nation GROUP BY 1),
places AS (
  SELECT format('LOC-{:02d}', n_nationkey) AS location_id, n_name AS country, r_name AS region, n_regionkey, CAST((5 + n_nationkey % 5) / 100.0 AS DECIMAL(4, 2)) AS tax_rate,
         CASE n_nationkey WHEN lowest THEN 'Distribution Center' WHEN highest THEN 'Returns Center' ELSE 'Retail Store' END AS location_type
  FROM nation JOIN ends USING (n_regionkey) LEFT JOIN region ON r_regionkey = n_regionkey),
located AS (
  SELECT order_id, sales_channel, c.customer_country, coalesce(
           (SELECT min(location_id) FROM places p WHERE sales_channel = 'Retail' AND location_type = 'Retail Store' AND p.country = c.customer_country),
           (SELECT min(p.location_id) FROM places p JOIN places home ON home.country = c.customer_country AND home.location_type <> 'Returns Center'
            WHERE p.location_type = 'Distribution Center' AND p.n_regionkey = home.n_regionkey OR p.location_type = 'Retail Store' AND p.country = home.country),
           (SELECT min(location_id) FROM places WHERE location_type <> 'Returns Center')) AS location_id,
         CASE WHEN sales_channel = 'Retail' AND c.customer_country IN (SELECT country FROM places WHERE location_type = 'Retail Store') THEN 1
              WHEN c.customer_country IN (SELECT country FROM places WHERE location_type <> 'Returns Center') THEN 2 ELSE 3 END AS tier
  FROM stg_orders LEFT JOIN (SELECT customer_id, customer_country FROM stg_customers) c USING (customer_id))"""

register("dim_store", Query(FU.dim_store, f"""{_PLACES}
SELECT {O.skey("location_id")} AS store_key, location_id AS store_code, upper(country[1]) || lower(country[2:]) || ' Store' AS store_name, 'Retail Boutique' AS channel_class,
       region AS region_name, country AS country_code, 'SGD' AS local_currency_code, 'Open' AS operating_status
FROM places WHERE location_type = 'Retail Store'
UNION ALL SELECT -1, 'UNKNOWN', 'Unknown Store', 'Unknown', 'Unknown', 'Unknown', NULL, 'Unknown'""", big=("store_key",), tags=("dimension",)))

register("order_fulfilment_locations", Query(FU.order_locations, f"""{_PLACES}
SELECT order_id, sales_channel, customer_country, location_id, tier, tax_rate FROM located JOIN (SELECT location_id, tax_rate FROM places) USING (location_id)""",
    dbl=("tax_rate",), big=("tier",), tags=("fulfilment",)))

register("kpi_fulfilment_tiers", Query(FU.fulfilment_tiers, f"""{_PLACES}
SELECT tier, location_type, sales_channel, count(DISTINCT order_id) AS orders, count(*) AS lines, sum(net_sales) AS net_sales, sum(round(net_sales * tax_rate, 2)) AS tax_amount
FROM stg_order_items JOIN located USING (order_id) JOIN places USING (location_id) GROUP BY 1, 2, 3""", dbl=("net_sales", "tax_amount"), big=("tier",), tags=("fulfilment",)))

register("returns_enriched", Query(FU.returns_enriched, """
SELECT return_id, order_id, s.shipment_id, carrier, service_level, is_cross_border,
       date_diff('day', CAST(delivered_date AS DATE), CAST(return_date AS DATE)) AS days_after_delivery, returned_quantity, return_rate AS product_return_rate
FROM stg_returns r JOIN (SELECT * FROM stg_shipments WHERE shipment_status = 'Delivered') s USING (order_id) LEFT JOIN stg_products USING (product_id)""",
    big=("returned_quantity",), tags=("fulfilment",)))

# -- the daily inventory by month -------------------------------------------------------


def inventory_monthly(m: Model):
    """The dense fact per warehouse and month: sums and a checksum of its keys.
    The dense rows are summed by day, the days by month. Their group is one
    number, the warehouse's place among the ids and the day: to look up a text
    and a day for each dense row takes longer than all the rest."""
    ids = m.inventory_intervals.agg(F.sort_array(F.collect_set("warehouse_id")).alias("ids")).scalar()
    place = F.coalesce(F.array_position(ids, F.col("warehouse_id")), F.lit(0)).cast("bigint")
    sums = ["quantity_on_hand", "units_sold_qty", "units_returned_qty", "units_received_qty", "key_checksum", "dimension_checksum"]
    f = m.inventory_daily(warehouse_place=F.shiftleft(place, 32)).withColumn("key_checksum", F.col("inventory_fact_key") % 1000003).withColumn(
        "dimension_checksum", F.col("product_key") % 10007 + F.col("warehouse_key") % 10007)
    group = (F.col("warehouse_place") + F.unix_date("balance_date")).alias("place_and_day")
    days = f.groupBy(group).agg(F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(c) for c in sums])
    place = F.shiftright(F.col("place_and_day") + (1 << 31), 32)
    days = days.withColumn("warehouse_id", F.get(ids, (place - 1).cast("int"))).withColumn(
        "balance_date", F.date_from_unix_date((F.col("place_and_day") - F.shiftleft(place, 32)).cast("int")))
    days = days.withColumn("dimension_checksum", F.col("dimension_checksum") + F.col("rows") * date_key("balance_date"))
    return days.groupBy("warehouse_id", F.trunc("balance_date", "MM").alias("balance_month")).agg(
        F.sum("rows").alias("rows"), F.min("balance_date").alias("first_day"), F.max("balance_date").alias("last_day"), *[F.sum(c).alias(c) for c in sums])


_SUMS = ("quantity_on_hand", "units_sold_qty", "units_returned_qty", "units_received_qty")
register("fact_inventory_daily", Query(inventory_monthly, f"""
SELECT warehouse_id, CAST(date_trunc('month', balance_date) AS DATE) AS balance_month, count(*) AS rows, min(balance_date) AS first_day, max(balance_date) AS last_day,
       {", ".join(f"sum({c}) AS {c}" for c in _SUMS)}, sum(inventory_fact_key % 1000003) AS key_checksum,
       sum(product_key % 10007 + warehouse_key % 10007 + snapshot_date_key) AS dimension_checksum
FROM fact_inventory_daily GROUP BY 1, 2""", big=(*_SUMS, "key_checksum", "dimension_checksum"), tags=("fact",)))


def stockouts_by_product(m: Model):
    """Months in which a stocked pair ran out: days out of stock and days stocked,
    per warehouse and product, from the intervals cut into months. The intervals
    are dealt by pair, and only months in which the pair has an interval without
    stock are cut out: the other pair-months, by far the most, are never formed."""
    pair = ["warehouse_id", "product_id"]
    iv = m.inventory_intervals.where("valid_from <= valid_to").select(*pair, "valid_from", "valid_to", "quantity_on_hand").withColumn(
        "months", F.sequence(F.trunc("valid_from", "MM"), F.trunc("valid_to", "MM"), F.expr("INTERVAL 1 MONTH")))
    empty = F.array_distinct(F.flatten(F.collect_list(F.when(F.col("quantity_on_hand") <= 0, F.col("months"))).over(Window.partitionBy(*pair))))
    months = iv.withColumn("empty", empty).withColumn("report_month", F.explode(F.array_intersect("months", "empty")))
    days = (F.datediff(F.least("valid_to", F.last_day("report_month")), F.greatest("valid_from", "report_month")) + 1).cast("bigint")
    agg = months.groupBy("report_month", *pair).agg(
        F.sum(days).alias("stocked_days"), F.sum(F.when(F.col("quantity_on_hand") <= 0, days).otherwise(0)).alias("stockout_days"),
        F.sum(days * F.col("quantity_on_hand")).alias("unit_days"))
    return agg.where("stockout_days > 0")


register("mart_stockouts_by_product_monthly", Query(stockouts_by_product, """
SELECT CAST(date_trunc('month', balance_date) AS DATE) AS report_month, warehouse_id, product_id, count(*) AS stocked_days,
       count(*) FILTER (WHERE quantity_on_hand <= 0) AS stockout_days, sum(quantity_on_hand) AS unit_days
FROM fact_inventory_daily GROUP BY 1, 2, 3 HAVING stockout_days > 0""", big=("unit_days",), tags=("mart",)))
