"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written directly in SQL, the way the warehouse models state it (range joins,
QUALIFY, dense spines with ``last_value IGNORE NULLS``), not as a copy of the
Spark plans, which use other strategies (intervals, pre-aggregation, arrays).
Each query is ``WITH <needed CTEs> <final select>``; the CTE library below is
resolved by dependency. Money is DECIMAL until the final cast to DOUBLE;
divisions that get rounded are done in integer cents (DuckDB divides decimals
in floating point).
"""

from __future__ import annotations

import re

from .functions import constants as C


def _d(x) -> str:
    return f"DATE '{x.isoformat()}'"


def _case(col: str, mapping: dict, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {whens} ELSE {default} END"


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


SIM_START, SIM_END = _d(C.SIM_START), _d(C.SIM_END)
AS_OF, SNAP = _d(C.AS_OF), _d(C.SNAPSHOT_DATE)


def skey(expr: str) -> str:
    return f"('0x' || substr(md5(CAST({expr} AS VARCHAR)), 1, 15))::BIGINT"


def daykey(h: str, d: str) -> str:
    """Entity hash moved on by an odd step a day, modulo 2^60."""
    return (f"(({h}) + CAST(date_diff('day', DATE '1970-01-01', {d}) AS BIGINT) * {C.DAY_STEP}) "
            f"& CAST({2 ** 60 - 1} AS BIGINT)")


def member(dim: str, id_col: str, expr: str) -> str:
    """Key of a natural id if the dimension holds it, else the unknown member."""
    return (f"CASE WHEN {expr} IN (SELECT {id_col} FROM {dim} WHERE {id_col} <> 'UNKNOWN') "
            f"THEN {skey(expr)} ELSE -1 END")


def day_member(expr: str) -> str:
    """Date key if the calendar holds the day, else the unknown member."""
    return f"CASE WHEN {expr} IN (SELECT full_date FROM dim_date) THEN {dkey(expr)} ELSE -1 END"


def dkey(expr: str) -> str:
    return f"CAST(strftime(CAST({expr} AS DATE), '%Y%m%d') AS BIGINT)"


def half_up_div(num_cents: str, den: str) -> str:
    """round-half-up(num_cents / den) as DECIMAL(18,2) money (num, den >= 0)."""
    return (f"CAST(CAST((2 * ({num_cents}) + ({den})) // (2 * ({den})) AS DECIMAL(18,0)) * 0.01 "
            f"AS DECIMAL(18,2))")


def cents(expr: str) -> str:
    return f"CAST(({expr}) * 100 AS BIGINT)"


LINE_ID = ("printf('{p}-%d-%d-%d-%d-%s', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
           "strftime(l_shipdate, '%Y%m%d'))")


def line_id(prefix: str) -> str:
    return LINE_ID.format(p=prefix)


CTE: dict[str, str] = {}

# --- landing tables ---------------------------------------------------------

CTE["contacts"] = f"""
SELECT * REPLACE (ts - INTERVAL {C.EVENT_YEARS_BACK} YEAR AS ts) FROM events"""

CTE["supplier_wh"] = """
SELECT s_suppkey, printf('WH-%02d', n_regionkey) AS warehouse_id
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

CTE["lines"] = f"""
SELECT l.*, o_orderdate, o_orderstatus, o_orderpriority, sw.warehouse_id,
       {_case('o_orderpriority', C.PRIORITY_CHANNEL)} AS sales_channel,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS gross_sales,
       CAST(round(gross_sales * CAST(l_discount AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS discount_amount,
       CAST(gross_sales - discount_amount AS DECIMAL(18,2)) AS net_sales,
       CAST(round(net_sales * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS tax_amount,
       CAST(l_quantity AS INTEGER) AS qty,
       {half_up_div(cents('gross_sales'), 'CAST(l_quantity AS INTEGER)')} AS unit_price
FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey
LEFT JOIN supplier_wh sw ON l_suppkey = sw.s_suppkey"""

CTE["part_stats"] = """
SELECT l_partkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship,
       min(l_suppkey) AS main_supp, count(*) AS n_lines,
       sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS n_returned
FROM lineitem GROUP BY l_partkey"""

CTE["products"] = f"""
SELECT printf('PRD-%06d', p_partkey) AS product_id, printf('SKU-%06d', p_partkey) AS sku,
       ' ' || p_name AS product_name, p_type AS category, p_brand AS brand,
       CASE WHEN main_supp IS NOT NULL THEN printf('SUP-%06d', main_supp) END AS supplier_id,
       CAST(round(CAST(p_retailprice AS DECIMAL(18,2)) * CAST({C.PRODUCT_COST_RATIO} AS DECIMAL(4,2)), 2)
            AS DECIMAL(18,2)) AS base_cost_sgd,
       CAST(p_retailprice AS DECIMAL(18,2)) AS msrp_sgd,
       CAST(first_ship AS DATE) AS launch_date,
       CASE WHEN p_size >= {C.DISCONTINUED_MIN_SIZE} THEN 'Discontinued'
            WHEN CAST(first_ship AS DATE) >= {_d(C.NEW_LAUNCH_FROM)} THEN 'New Launch'
            ELSE 'Active' END AS lifecycle_status,
       CASE WHEN p_size >= {C.DISCONTINUED_MIN_SIZE} THEN CAST(last_ship AS DATE) END AS discontinued_date,
       CAST(coalesce(n_lines, 0) AS DOUBLE) AS popularity_weight,
       CAST(n_returned AS DOUBLE) / CAST(nullif(n_lines, 0) AS DOUBLE) AS return_rate,
       CAST(p_size AS INTEGER) AS reorder_point, 14 AS lead_time_days,
       CAST(p_size * 20 AS INTEGER) AS reorder_quantity
FROM part LEFT JOIN part_stats ON p_partkey = l_partkey"""

CTE["demand_tiers"] = """
SELECT product_id,
       (rank() OVER (ORDER BY popularity_weight)
        + (count(*) OVER (PARTITION BY popularity_weight) - 1) / 2.0) / count(*) OVER () AS pct,
       CASE WHEN pct <= 0.5 THEN 'Low' WHEN pct <= 0.8 THEN 'Medium'
            WHEN pct <= 0.95 THEN 'High' WHEN pct <= 1.0 THEN 'Very High' END AS demand_tier
FROM products"""

CTE["suppliers"] = f"""
SELECT printf('SUP-%06d', s_suppkey) AS supplier_id, s_name || ' ' AS supplier_name,
       CASE WHEN s_acctbal >= 7500 THEN 'Strategic' WHEN s_acctbal >= 2500 THEN 'Preferred'
            ELSE 'Transactional' END AS supplier_tier,
       'General' AS category_specialty, n_name AS country, 'SGD' AS currency,
       'NET30' AS payment_terms, CAST(s_nationkey + 7 AS INTEGER) AS lead_time_days,
       s_acctbal / 2000.0 AS quality_rating, s_acctbal > 5000 AS preferred_supplier,
       {_d(C.CALENDAR_START)} AS created_at
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey"""

CTE["per_region"] = """
SELECT n_regionkey, arg_min(n_name, n_nationkey) AS home_nation,
       '[' || string_agg('''' || n_name || '''', ', ' ORDER BY n_name) || ']' AS served
FROM nation GROUP BY n_regionkey"""

CTE["warehouses"] = """
SELECT printf('WH-%02d', r_regionkey) AS warehouse_id,
       ' ' || lower(substr(r_name, 1, 3)) || '-' || CAST(r_regionkey AS VARCHAR) AS warehouse_code,
       ' ' || r_name || ' Distribution Center' AS warehouse_name,
       'Distribution Center' AS warehouse_type, home_nation AS country, r_name AS city,
       r_name AS region, served AS serves_countries
FROM region LEFT JOIN per_region ON r_regionkey = n_regionkey"""

CTE["customers"] = f"""
SELECT printf('CUST-%06d', c_custkey) AS customer_id,
       ' ' || split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
       '  Customer.' || CAST(c_custkey AS VARCHAR) || '@Example.COM ' AS email,
       printf('+65-%08d', c_custkey) AS phone, n_name AS country, 'Unspecified' AS gender,
       {_d(C.CALENDAR_START)} - CAST(c_nationkey * 400 AS INTEGER) AS birth_date,
       least(CAST(fs.first_signup AS DATE), CAST(fo.first_order AS DATE)) AS customer_since,
       CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 2500 THEN 'Bronze'
            WHEN c_acctbal < 5000 THEN 'Silver' WHEN c_acctbal < 7500 THEN 'Gold'
            ELSE 'Platinum' END AS loyalty_tier,
       {_case('c_mktsegment', C.SEGMENT_CHANNEL)} AS acquisition_channel,
       CASE WHEN fo.first_order IS NULL THEN 'Inactive' ELSE 'Active' END AS customer_status
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY 1) fo
       ON c_custkey = fo.o_custkey
LEFT JOIN (SELECT user_id, min(ts) AS first_signup FROM contacts WHERE event_type = 'signup'
           GROUP BY 1) fs ON c_custkey = fs.user_id"""

CTE["fulfil"] = r"""
SELECT o_orderkey, s.serving_wh AS fulfillment_wh, n_name AS customer_country
FROM orders LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN (SELECT served_country, min(warehouse_id) AS serving_wh
           FROM (SELECT warehouse_id,
                        unnest(string_split(regexp_replace(serves_countries, '[\[\]'']', '', 'g'), ', '))
                        AS served_country FROM warehouses)
           GROUP BY 1) s ON n_name = s.served_country"""

CTE["orders_raw"] = f"""
SELECT printf('ORD-%08d', o.o_orderkey) AS order_id, printf('CUST-%06d', o_custkey) AS customer_id,
       o_orderdate AS order_date, {_case('o_orderpriority', C.PRIORITY_CHANNEL)} AS sales_channel,
       {_list(C.PAYMENT_METHODS)}[CAST(o.o_orderkey % {len(C.PAYMENT_METHODS)} + 1 AS INTEGER)] AS payment_method,
       {_case('o_orderstatus', C.ORDER_STATUS)} AS order_status,
       f.fulfillment_wh AS fulfillment_warehouse_id
FROM orders o LEFT JOIN fulfil f ON o.o_orderkey = f.o_orderkey"""

_COMMISSION = ("CAST(CASE " + " ".join(f"WHEN sales_channel = '{k}' THEN {v}" for k, v in C.COMMISSION_RATE.items())
               + " ELSE 0.00 END AS DECIMAL(4,2))")

CTE["order_items"] = f"""
SELECT {line_id('OI')} AS order_item_id, printf('ORD-%08d', l_orderkey) AS order_id,
       printf('PRD-%06d', l_partkey) AS product_id, warehouse_id, qty AS quantity, unit_price,
       l_discount AS discount_pct, gross_sales, discount_amount, net_sales, tax_amount,
       CAST(round(net_sales * {_COMMISSION}, 2) AS DECIMAL(18,2)) AS commission_amount
FROM lines"""

CTE["shipments"] = """
SELECT printf('SHP-%08d', po.l_orderkey) AS shipment_id, printf('ORD-%08d', po.l_orderkey) AS order_id,
       f.fulfillment_wh AS warehouse_id,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'DHL Express' ELSE 'Ninja Van' END AS carrier,
       printf('TRK%010d', po.l_orderkey) AS tracking_number,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Express' ELSE 'Standard' END AS service_level,
       CASE WHEN o_orderstatus = 'F' THEN 'Delivered' ELSE 'In Transit' END AS shipment_status,
       f.customer_country <> w.country AS is_cross_border,
       first_ship AS shipped_date,
       CASE WHEN o_orderstatus = 'F' THEN last_ship + INTERVAL 3 DAY END AS delivered_date,
       CAST(round(CAST(units AS DECIMAL(18,2)) * CAST(0.25 AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS shipping_cost
FROM (SELECT l_orderkey, o_orderstatus, o_orderpriority, min(l_shipdate) AS first_ship,
             max(l_shipdate) AS last_ship, sum(l_quantity) AS units
      FROM lines WHERE o_orderstatus <> 'P' GROUP BY 1, 2, 3) po
LEFT JOIN fulfil f ON po.l_orderkey = f.o_orderkey
LEFT JOIN warehouses w ON f.fulfillment_wh = w.warehouse_id"""

CTE["returns_raw"] = f"""
SELECT {line_id('RET')} AS return_id, printf('ORD-%08d', l_orderkey) AS order_id,
       {line_id('OI')} AS order_item_id, printf('SHP-%08d', l_orderkey) AS shipment_id,
       printf('PRD-%06d', l_partkey) AS product_id, warehouse_id,
       l_shipdate + INTERVAL 10 DAY AS return_date,
       CAST(ceil(l_quantity / 2) AS INTEGER) AS quantity,
       {_list(C.RETURN_REASONS)}[CAST((l_linenumber - 1) % {len(C.RETURN_REASONS)} + 1 AS INTEGER)] AS return_reason,
       {_list(C.DISPOSITIONS)}[CAST((l_linenumber - 1) % {len(C.DISPOSITIONS)} + 1 AS INTEGER)] AS disposition
FROM lines WHERE l_returnflag = 'R'"""

CTE["purchase_orders"] = f"""
SELECT {line_id('PO')} AS purchase_order_id, printf('SUP-%06d', l_suppkey) AS supplier_id,
       printf('PRD-%06d', l_partkey) AS lines_product_id, warehouse_id,
       o_orderdate AS order_date, o_orderdate + INTERVAL {C.PO_LEAD_DAYS} DAY AS expected_receipt_date,
       CASE WHEN CAST(l_shipdate AS DATE) <= {AS_OF} THEN l_shipdate END AS actual_receipt_date,
       qty AS quantity_ordered,
       CASE WHEN CAST(l_shipdate AS DATE) <= {AS_OF} THEN qty ELSE 0 END AS quantity_received,
       CAST(round(unit_price * CAST({C.PO_COST_RATIO} AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS unit_cost_sgd,
       CAST(unit_cost_sgd * qty AS DECIMAL(18,2)) AS total_cost_sgd,
       CASE WHEN CAST(l_shipdate AS DATE) <= {AS_OF} THEN 'Received' ELSE 'In Transit' END AS po_status,
       dt.demand_tier
FROM lines LEFT JOIN demand_tiers dt ON printf('PRD-%06d', l_partkey) = dt.product_id
WHERE l_linestatus = 'O'"""

CTE["assignment"] = """
SELECT DISTINCT warehouse_id, printf('PRD-%06d', l_partkey) AS product_id
FROM lines WHERE warehouse_id IS NOT NULL"""

CTE["inventory_snapshot"] = f"""
SELECT 'SNAP-' || a.warehouse_id || '-' || a.product_id AS inventory_snapshot_id,
       {SNAP} AS snapshot_date, a.warehouse_id, a.product_id,
       CAST(p.reorder_point * 2 + CAST(substr(a.warehouse_id, 4, 2) AS INTEGER) AS INTEGER) AS quantity_on_hand,
       CAST(floor(p.reorder_point / 10) AS INTEGER) AS quantity_reserved,
       quantity_on_hand - quantity_reserved AS quantity_available,
       {C.SAFETY_STOCK} AS safety_stock,
       greatest({2 * C.SAFETY_STOCK}, p.reorder_point) AS reorder_point,
       CAST(quantity_on_hand * p.base_cost_sgd AS DECIMAL(18,2)) AS inventory_value
FROM assignment a JOIN products p ON a.product_id = p.product_id
WHERE p.launch_date <= {SNAP}"""

CTE["inventory_movements"] = f"""
SELECT {line_id('MV-S')} AS movement_id, l_shipdate + INTERVAL 2 HOUR AS movement_date,
       '{C.MOVEMENT_SALE}' AS movement_type, warehouse_id, printf('PRD-%06d', l_partkey) AS product_id,
       -qty AS quantity, 'ORDER' AS reference_type, {line_id('OI')} AS reference_id
FROM lines WHERE o_orderstatus = 'F'
UNION ALL
SELECT 'MV-R-' || return_id, return_date + INTERVAL 1 HOUR, '{C.MOVEMENT_RETURN}', warehouse_id,
       product_id, quantity, 'RETURN', return_id
FROM returns_raw
UNION ALL
SELECT 'MV-P-' || purchase_order_id, actual_receipt_date + INTERVAL 6 HOUR, '{C.MOVEMENT_PURCHASE}',
       warehouse_id, lines_product_id, quantity_received, 'PO', purchase_order_id
FROM purchase_orders WHERE po_status = 'Received'"""

_CH = f"{_list(C.PAID_CHANNELS)}[CAST(slot + 1 AS INTEGER)]"
CTE["marketing_spend"] = f"""
SELECT printf('MS-%06d-%s', campaign_no, strftime(date, '%Y%m%d')) AS marketing_spend_id, date,
       printf('CMP-%06d', campaign_no) AS campaign_id, printf('%s #%06d', {_CH}, campaign_no) AS campaign_name,
       {_CH} AS channel, {_case(_CH, C.CHANNEL_PLATFORM)} AS platform,
       spend_sgd, impressions, clicks,
       CAST(clicks AS DOUBLE) / CAST(nullif(impressions, 0) AS DOUBLE) AS click_through_rate,
       CASE WHEN clicks > 0 THEN {half_up_div(cents('spend_sgd'), 'clicks')} END AS cost_per_click_sgd
FROM (SELECT date, slot,
             CAST(date_diff('day', DATE '1970-01-01', date) // {C.CAMPAIGN_DAYS} * {len(C.PAID_CHANNELS)} + slot AS INTEGER)
                 AS campaign_no,
             CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS spend_sgd,
             CAST(count(*) FILTER (WHERE event_type = 'view') AS BIGINT) AS impressions,
             CAST(count(*) FILTER (WHERE event_type = 'click') AS BIGINT) AS clicks
      FROM (SELECT CAST(ts AS DATE) AS date, event_type, value,
                   coalesce(CAST(json_extract_string(props, '$.k') AS INTEGER), 0) % {len(C.PAID_CHANNELS)} AS slot
            FROM contacts WHERE event_type IN ('view', 'click'))
      GROUP BY 1, 2, 3)"""

CTE["campaign_starts"] = """
SELECT campaign_id, channel, min(date) AS start_date FROM marketing_spend GROUP BY 1, 2"""

CTE["acquisition_attribution"] = """
SELECT cu.customer_id, cs.campaign_id AS acquisition_campaign_id
FROM customers cu LEFT JOIN campaign_starts cs
  ON cs.channel = cu.acquisition_channel AND cs.start_date <= cu.customer_since
QUALIFY row_number() OVER (PARTITION BY cu.customer_id
                           ORDER BY cs.start_date DESC NULLS LAST, cs.campaign_id DESC NULLS LAST) = 1"""

_TERMS = _case("o_orderpriority", C.PRIORITY_TERMS)
_TERM_DAYS = "CASE " + " ".join(f"WHEN {_TERMS} = '{k}' THEN {v}" for k, v in C.PAYMENT_TERMS_DAYS.items()) + " END"
CTE["ar_invoices"] = f"""
SELECT printf('INV-%08d', o_orderkey) AS invoice_id, printf('ORD-%08d', o_orderkey) AS order_id,
       printf('CUST-%06d', o_custkey) AS customer_id, {_TERMS} AS payment_terms_code,
       CAST(o_orderdate AS DATE) + 1 AS invoice_date,
       CAST(o_orderdate AS DATE) + 1 + CAST({_TERM_DAYS} AS INTEGER) AS due_date,
       t.invoice_amount,
       CASE WHEN o_orderstatus = 'O' THEN CAST(0 AS DECIMAL(18,2))
            WHEN o_orderpriority = '5-LOW' THEN CAST(round(t.invoice_amount * CAST(0.50 AS DECIMAL(4,2)), 2) AS DECIMAL(18,2))
            ELSE t.invoice_amount END AS amount_paid,
       CASE WHEN o_orderstatus = 'O' THEN NULL
            WHEN o_orderpriority = '5-LOW' THEN due_date + 15
            WHEN c_acctbal < 0 THEN due_date + 20
            ELSE due_date - 3 END AS payment_date,
       CASE WHEN o_orderstatus = 'O' THEN 'Open' WHEN o_orderpriority = '5-LOW' THEN 'Partially Paid'
            ELSE 'Paid' END AS invoice_status
FROM orders JOIN customer ON o_custkey = c_custkey AND c_mktsegment = '{C.CREDIT_SEGMENT}'
JOIN (SELECT l_orderkey, CAST(sum(net_sales + tax_amount) AS DECIMAL(18,2)) AS invoice_amount
      FROM lines WHERE o_orderstatus <> 'P' GROUP BY 1) t ON o_orderkey = t.l_orderkey
WHERE o_orderstatus <> 'P'"""

# --- staging ----------------------------------------------------------------

CTE["stg_suppliers"] = """
SELECT supplier_id, trim(supplier_name) AS supplier_name, supplier_tier, category_specialty,
       country AS supplier_country, currency AS supplier_currency, payment_terms, lead_time_days,
       quality_rating, preferred_supplier, created_at AS supplier_created_at FROM suppliers"""

CTE["stg_products"] = f"""
SELECT product_id, sku AS sku_code, trim(product_name) AS product_name, category, brand, supplier_id,
       base_cost_sgd, msrp_sgd, launch_date, lifecycle_status, discontinued_date, popularity_weight,
       return_rate, reorder_point, reorder_quantity, lead_time_days,
       CASE WHEN lifecycle_status = 'Discontinued' THEN false WHEN launch_date > {AS_OF} THEN false
            ELSE true END AS is_currently_sellable
FROM products"""

CTE["stg_customers"] = """
SELECT customer_id, trim(first_name) AS first_name, trim(last_name) AS last_name,
       lower(trim(email)) AS email_address, phone AS phone_number, country AS customer_country,
       gender, birth_date, customer_since, loyalty_tier, acquisition_channel, customer_status
FROM customers"""

CTE["stg_warehouses"] = r"""
SELECT warehouse_id, upper(trim(warehouse_code)) AS warehouse_code, trim(warehouse_name) AS warehouse_name,
       warehouse_type, country AS warehouse_country, city AS warehouse_city, region AS warehouse_region,
       string_split(regexp_replace(serves_countries, '[\[\]'']', '', 'g'), ', ') AS serves_countries
FROM warehouses"""

CTE["stg_warehouse_product_assignment"] = "SELECT warehouse_id, product_id FROM assignment"

CTE["stg_inventory_snapshot"] = """
SELECT inventory_snapshot_id, snapshot_date, warehouse_id, product_id, quantity_on_hand,
       quantity_reserved, quantity_available, safety_stock, reorder_point, inventory_value
FROM inventory_snapshot"""

CTE["stg_purchase_orders"] = """
SELECT purchase_order_id, supplier_id, lines_product_id AS product_id, warehouse_id, order_date,
       expected_receipt_date, actual_receipt_date, quantity_ordered, quantity_received, unit_cost_sgd,
       total_cost_sgd, po_status, demand_tier,
       date_diff('day', CAST(order_date AS DATE), CAST(expected_receipt_date AS DATE)) AS expected_lead_time_days
FROM purchase_orders"""

CTE["stg_orders"] = """
SELECT order_id, customer_id, order_date, sales_channel, payment_method, order_status,
       fulfillment_warehouse_id AS warehouse_id FROM orders_raw"""

CTE["stg_order_items"] = """
SELECT order_item_id, order_id, product_id, warehouse_id, quantity, unit_price, discount_pct,
       gross_sales, discount_amount, net_sales, tax_amount, commission_amount FROM order_items"""

CTE["stg_shipments"] = """
SELECT shipment_id, order_id, warehouse_id, carrier, tracking_number, service_level, shipment_status,
       is_cross_border, shipped_date, delivered_date, shipping_cost FROM shipments"""

CTE["stg_returns"] = """
SELECT return_id, order_id, order_item_id, shipment_id, product_id, warehouse_id, return_date,
       quantity AS returned_quantity, return_reason, disposition AS disposition_code FROM returns_raw"""

CTE["stg_inventory_movements"] = """
SELECT movement_id, movement_date, movement_type, warehouse_id, product_id, quantity,
       reference_type, reference_id FROM inventory_movements"""

CTE["stg_marketing_spend"] = """
SELECT marketing_spend_id, date, campaign_id, campaign_name, channel, platform, spend_sgd,
       impressions, clicks, click_through_rate, cost_per_click_sgd FROM marketing_spend"""

CTE["stg_acquisition_attribution"] = "SELECT customer_id, acquisition_campaign_id FROM acquisition_attribution"

CTE["stg_ar_invoices"] = """
SELECT invoice_id, order_id, customer_id, payment_terms_code, invoice_date, due_date, invoice_amount,
       amount_paid, payment_date, invoice_status FROM ar_invoices"""

# --- dimensions -------------------------------------------------------------

CTE["dim_date"] = f"""
SELECT {dkey('d')} AS date_key, d AS full_date, dayofweek(d) + 1 AS day_of_week_number,
       strftime(d, '%A') AS day_name, dayofweek(d) IN (0, 6) AS is_weekend_flag,
       weekofyear(d) AS week_number, month(d) AS calendar_month_number, strftime(d, '%B') AS month_name,
       quarter(d) AS calendar_quarter_number, year(d) AS calendar_year_number,
       year(d) AS fiscal_year_number, quarter(d) AS fiscal_quarter_number, month(d) AS fiscal_month_number,
       ({' OR '.join(f'(month(d) = {m} AND day(d) = {dd})' for m, dd in C.HOLIDAYS)}) AS holiday_flag
FROM (SELECT CAST(unnest(generate_series(CAST(date_trunc('year', lo) - INTERVAL 1 YEAR AS TIMESTAMP),
                                          CAST(date_trunc('year', hi) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS TIMESTAMP),
                                          INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT min(d) AS lo, max(d) AS hi
            FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders
                  UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem
                  UNION ALL SELECT CAST(ts AS DATE) FROM contacts)))"""

CTE["dim_product"] = f"""
SELECT {skey('product_id')} AS product_key, product_id, sku_code, product_name, category AS category_name,
       brand AS brand_name, base_cost_sgd, msrp_sgd, launch_date, lifecycle_status, discontinued_date,
       popularity_weight, return_rate, is_currently_sellable
FROM stg_products
UNION ALL
SELECT -1, 'UNKNOWN', 'UNKNOWN', 'Unknown Product', 'Unknown', 'Unknown', NULL, NULL, NULL, 'Unknown',
       NULL, NULL, NULL, false"""

CTE["dim_supplier"] = f"""
SELECT {skey('supplier_id')} AS supplier_key, supplier_id, supplier_name, supplier_tier, category_specialty,
       supplier_country, supplier_currency, payment_terms, lead_time_days, quality_rating, preferred_supplier
FROM stg_suppliers
UNION ALL
SELECT -1, 'UNKNOWN', 'Unknown Supplier', 'Unknown', 'Unknown', 'Unknown', 'Unknown', NULL, NULL, NULL, NULL"""

CTE["dim_warehouse"] = f"""
SELECT {skey('warehouse_id')} AS warehouse_key, warehouse_id, warehouse_code, warehouse_name, warehouse_type,
       warehouse_country, warehouse_city, warehouse_region, serves_countries
FROM stg_warehouses
UNION ALL
SELECT -1, 'UNKNOWN', 'UNKNOWN', 'Unknown Warehouse', 'Unknown', 'Unknown', NULL, NULL, NULL"""

CTE["dim_campaign"] = f"""
SELECT {skey("coalesce(campaign_id, '-1')")} AS campaign_key, campaign_id, campaign_name, marketing_platform,
       acquisition_channel_name, start_date, end_date
FROM (SELECT campaign_id, min(campaign_name) AS campaign_name, min(channel) AS acquisition_channel_name,
             min(platform) AS marketing_platform, min(date) AS start_date, max(date) AS end_date
      FROM stg_marketing_spend GROUP BY campaign_id)
UNION ALL
SELECT -1, 'NO_CAMPAIGN', 'No Campaign (Organic/Unpaid Channel)', 'N/A', 'N/A', NULL, NULL"""

CTE["dim_customer"] = f"""
SELECT {skey('c.customer_id')} AS customer_key, c.customer_id, first_name, last_name, email_address,
       phone_number, customer_country, gender, birth_date, customer_since, loyalty_tier,
       acquisition_channel, customer_status, coalesce(dc.campaign_key, -1) AS acquisition_campaign_key
FROM stg_customers c
LEFT JOIN stg_acquisition_attribution aa ON c.customer_id = aa.customer_id
LEFT JOIN dim_campaign dc ON aa.acquisition_campaign_id = dc.campaign_id
UNION ALL
SELECT -1, 'UNKNOWN', 'Unknown', 'Unknown', 'unknown@unknown.com', NULL, 'Unknown', NULL, NULL, NULL,
       'Unknown', 'Unknown', 'Unknown', -1"""

# --- facts ------------------------------------------------------------------

CTE["fact_sales"] = f"""
SELECT {skey('order_item_id')} AS sales_fact_key, {day_member('ordered_on')} AS order_date_key,
       {member('dim_customer', 'customer_id', 'buyer')} AS customer_key,
       {member('dim_product', 'product_id', 'product_id')} AS product_key,
       {member('dim_warehouse', 'warehouse_id', 'warehouse_id')} AS warehouse_key,
       order_id AS order_number, line_no AS line_item_number, sales_channel_code, payment_method,
       fulfillment_status,
       coalesce((SELECT max(t.payment_terms_code) FROM stg_ar_invoices t WHERE t.order_id = line.order_id),
                'DUE_ON_RECEIPT') AS payment_terms_code,
       quantity AS quantity_ordered, list_price AS unit_list_price_amount, unit_price AS unit_selling_price_amount,
       gross_sales AS gross_revenue_amount, discount_amount, tax_amount, net_sales AS net_revenue_amount,
       commission_amount, CAST(quantity * unit_cost AS DECIMAL(18,2)) AS cogs_amount, ordered_on AS order_date
FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_item_id) AS line_no
      FROM stg_order_items) line
JOIN (SELECT order_id, customer_id AS buyer, CAST(order_date AS DATE) AS ordered_on,
             sales_channel AS sales_channel_code, payment_method, order_status AS fulfillment_status
      FROM stg_orders) USING (order_id)
LEFT JOIN (SELECT product_id, msrp_sgd AS list_price, base_cost_sgd AS unit_cost FROM stg_products) USING (product_id)"""

CTE["fact_returns"] = f"""
WITH slip AS (
  SELECT return_id, order_id, order_item_id, product_id, warehouse_id, returned_quantity, return_reason,
         disposition_code, CAST(return_date AS DATE) AS back_on
  FROM stg_returns),
paid AS (
  SELECT order_item_id, {cents('net_sales')} AS line_cents, quantity AS line_units
  FROM stg_order_items WHERE quantity > 0)
SELECT {skey('return_id')} AS return_fact_key, {day_member('back_on')} AS return_date_key,
       {day_member('ordered_on')} AS original_order_date_key,
       {member('dim_customer', 'customer_id', 'buyer')} AS customer_key,
       {member('dim_product', 'product_id', 'product_id')} AS product_key,
       {member('dim_warehouse', 'warehouse_id', 'warehouse_id')} AS warehouse_key,
       return_id AS return_authorization_number, order_id AS order_number, disposition_code,
       return_reason AS return_reason_code, returned_quantity,
       {half_up_div('returned_quantity * line_cents', 'line_units')} AS refunded_amount,
       CASE return_reason WHEN '{C.RESTOCKING_FEE_REASON}'
            THEN {half_up_div('returned_quantity * line_cents', '10 * line_units')}
            ELSE CAST(0 AS DECIMAL(18,2)) END AS restocking_fee_amount,
       back_on AS return_date
FROM (SELECT order_id, customer_id AS buyer, CAST(order_date AS DATE) AS ordered_on FROM stg_orders)
JOIN slip USING (order_id) LEFT JOIN paid USING (order_item_id)"""

CTE["fact_purchase_orders"] = f"""
SELECT {skey('purchase_order_id')} AS purchase_order_fact_key, {day_member('placed_on')} AS po_date_key,
       {day_member('due_on')} AS expected_delivery_date_key,
       {member('dim_supplier', 'supplier_id', 'supplier_id')} AS supplier_key,
       {member('dim_product', 'product_id', 'product_id')} AS product_key,
       {member('dim_warehouse', 'warehouse_id', 'warehouse_id')} AS destination_warehouse_key,
       purchase_order_id AS po_number, po_status AS po_status_code, demand_tier,
       quantity_ordered AS ordered_quantity, quantity_received AS received_quantity,
       unit_cost_sgd AS unit_purchase_cost_amount, total_cost_sgd AS total_purchase_cost_amount,
       expected_lead_time_days AS lead_time_days,
       CAST(quantity_ordered * (unit_cost_sgd - standard_cost) AS DECIMAL(18,2)) AS purchase_price_variance_amount,
       actual_receipt_date, placed_on AS po_date, due_on AS expected_date
FROM (SELECT *, CAST(order_date AS DATE) AS placed_on, CAST(expected_receipt_date AS DATE) AS due_on
      FROM stg_purchase_orders)
LEFT JOIN (SELECT product_id, base_cost_sgd AS standard_cost FROM stg_products) USING (product_id)"""

CTE["fact_marketing_spend"] = f"""
SELECT {skey("coalesce(s.marketing_spend_id, '-1')")} AS marketing_spend_key,
       {dkey('s.date')} AS spend_date_key, coalesce(c.campaign_key, -1) AS campaign_key,
       s.spend_sgd AS spend_amount, s.impressions AS impressions_count, s.clicks AS clicks_count,
       CAST(NULL AS BIGINT) AS platform_reported_conversions_count, s.date AS spend_date
FROM stg_marketing_spend s LEFT JOIN dim_campaign c ON s.campaign_id = c.campaign_id"""

# --- inventory chain: the warehouse formulation (range join, QUALIFY, dense
# spine with a forward fill) ---------------------------------------------------

CTE["running_totals"] = """
SELECT movement_id, movement_date, movement_type, warehouse_id, product_id, quantity,
       sum(quantity) OVER (PARTITION BY warehouse_id, product_id ORDER BY movement_date, movement_id
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_qty_change
FROM stg_inventory_movements"""

CTE["ledger_days"] = f"""
SELECT warehouse_id, product_id, CAST(movement_date AS DATE) AS moved_on,
       coalesce(-sum(quantity) FILTER (movement_type = '{C.MOVEMENT_SALE}'), 0) AS sold,
       coalesce(sum(quantity) FILTER (movement_type = '{C.MOVEMENT_RETURN}'), 0) AS came_back,
       coalesce(sum(quantity) FILTER (movement_type = '{C.MOVEMENT_PURCHASE}'), 0) AS delivered,
       sum(sum(quantity)) OVER (PARTITION BY warehouse_id, product_id ORDER BY CAST(movement_date AS DATE)) AS level
FROM stg_inventory_movements GROUP BY 1, 2, 3"""

CTE["balance_offset"] = """
SELECT counted.warehouse_id, counted.product_id, snapshot_date, quantity_on_hand AS snapshot_quantity_on_hand,
       coalesce(level, 0) AS cumulative_at_snapshot,
       snapshot_quantity_on_hand - coalesce(level, 0) AS opening_balance_offset
FROM stg_inventory_snapshot counted ASOF LEFT JOIN ledger_days moved
  ON counted.warehouse_id = moved.warehouse_id AND counted.product_id = moved.product_id
 AND counted.snapshot_date >= moved.moved_on"""

CTE["stock_windows"] = f"""
SELECT warehouse_id, product_id, greatest(launch_date, {SIM_START}) AS first_day,
       least(discontinued_date, {SIM_END}) AS last_day
FROM stg_warehouse_product_assignment JOIN stg_products USING (product_id) WHERE launch_date IS NOT NULL"""

CTE["inventory_spine"] = """
SELECT warehouse_id, product_id,
       CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS balance_date
FROM stock_windows"""

CTE["fact_inventory_daily"] = f"""
WITH steps AS (
  SELECT warehouse_id, product_id, moved_on, sold, came_back, delivered, level
  FROM ledger_days JOIN stock_windows USING (warehouse_id, product_id) WHERE moved_on >= first_day),
held AS (
  SELECT day.warehouse_id, day.product_id, balance_date, moved_on IS NOT DISTINCT FROM balance_date AS moved,
         sold, came_back, delivered, coalesce(level, 0) AS level
  FROM inventory_spine day ASOF LEFT JOIN steps
    ON day.warehouse_id = steps.warehouse_id AND day.product_id = steps.product_id AND balance_date >= moved_on)
SELECT {daykey(skey("warehouse_id || '|' || product_id"), 'balance_date')} AS inventory_fact_key,
       {dkey('balance_date')} AS snapshot_date_key,
       {member('dim_product', 'product_id', 'product_id')} AS product_key,
       {member('dim_warehouse', 'warehouse_id', 'warehouse_id')} AS warehouse_key, balance_date,
       coalesce(opening_balance_offset, 0) + level AS quantity_on_hand,
       if(moved, sold, 0) AS units_sold_qty, if(moved, came_back, 0) AS units_returned_qty,
       if(moved, delivered, 0) AS units_received_qty, warehouse_id, product_id
FROM held LEFT JOIN balance_offset USING (warehouse_id, product_id)"""

# --- receivables chain --------------------------------------------------------

CTE["ar_spine"] = f"""
SELECT i.*, CAST(d.full_date AS DATE) AS snapshot_date
FROM stg_ar_invoices i
JOIN dim_date d ON d.full_date BETWEEN i.invoice_date AND least(coalesce(i.payment_date, {SIM_END}), {SIM_END})"""

CTE["fact_ar_aging_daily"] = f"""
SELECT {daykey(skey('s.invoice_id'), 's.snapshot_date')} AS ar_snapshot_key,
       {dkey('s.snapshot_date')} AS snapshot_date_key, coalesce(dc.customer_key, -1) AS customer_key,
       s.invoice_id AS invoice_number, s.payment_terms_code, s.invoice_amount,
       CAST(CASE WHEN s.payment_date IS NULL OR s.snapshot_date < s.payment_date THEN s.invoice_amount
                 ELSE s.invoice_amount - s.amount_paid END AS DECIMAL(18,2)) AS open_balance_amount,
       date_diff('day', s.invoice_date, s.snapshot_date) AS days_outstanding,
       CASE WHEN days_outstanding BETWEEN 0 AND 30 THEN open_balance_amount ELSE 0 END AS aging_bucket_0_30_amount,
       CASE WHEN days_outstanding BETWEEN 31 AND 60 THEN open_balance_amount ELSE 0 END AS aging_bucket_31_60_amount,
       CASE WHEN days_outstanding BETWEEN 61 AND 90 THEN open_balance_amount ELSE 0 END AS aging_bucket_61_90_amount,
       CASE WHEN days_outstanding > 90 THEN open_balance_amount ELSE 0 END AS aging_bucket_90_plus_amount,
       s.snapshot_date, s.customer_id, s.due_date
FROM ar_spine s
LEFT JOIN (SELECT * FROM dim_customer WHERE customer_id <> 'UNKNOWN') dc ON s.customer_id = dc.customer_id"""

# --- type-2 history ------------------------------------------------------------

CTE["customer_tier_history"] = f"""
SELECT {skey("customer_id || '|' || CAST(valid_from AS VARCHAR)")} AS customer_version_key,
       customer_id, loyalty_tier, valid_from, valid_to, is_current, version_number
FROM (SELECT customer_id, loyalty_tier, year_start AS valid_from,
             coalesce(CAST(lead(year_start) OVER w - 1 AS DATE), DATE '9999-12-31') AS valid_to,
             lead(year_start) OVER w IS NULL AS is_current,
             row_number() OVER w AS version_number
      FROM (SELECT * FROM (SELECT dc.customer_id, make_date(CAST(t.yr AS BIGINT), 1, 1) AS year_start, t.tier AS loyalty_tier,
                                  lag(t.tier) OVER (PARTITION BY dc.customer_id ORDER BY t.yr) AS prev
                           FROM (SELECT customer_key, year(order_date) AS yr,
                                        CASE WHEN sum(net_revenue_amount) >= 400000 THEN 'Platinum'
                                             WHEN sum(net_revenue_amount) >= 250000 THEN 'Gold'
                                             WHEN sum(net_revenue_amount) >= 100000 THEN 'Silver'
                                             ELSE 'Bronze' END AS tier
                                 FROM fact_sales WHERE customer_key <> -1 GROUP BY 1, 2) t
                           JOIN dim_customer dc ON t.customer_key = dc.customer_key)
            WHERE prev IS NULL OR prev <> loyalty_tier)
      WINDOW w AS (PARTITION BY customer_id ORDER BY year_start))"""

CTE["product_lifecycle_history"] = f"""
SELECT {skey("product_id || '|' || CAST(change_date AS VARCHAR)")} AS product_version_key,
       product_id, lifecycle_status, change_date AS valid_from,
       coalesce(CAST(lead(change_date) OVER w - 1 AS DATE), DATE '9999-12-31') AS valid_to,
       lead(change_date) OVER w IS NULL AS is_current, row_number() OVER w AS version_number
FROM (SELECT product_id, d AS change_date, s AS lifecycle_status,
             lag(s) OVER (PARTITION BY product_id ORDER BY d, o) AS prev
      FROM (SELECT product_id, d, o, s,
                   min(d) OVER (PARTITION BY product_id ORDER BY o DESC
                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS later_min
            FROM (SELECT product_id, launch_date AS d, 0 AS o, 'New Launch' AS s FROM dim_product
                  WHERE product_id <> 'UNKNOWN' AND launch_date IS NOT NULL
                  UNION ALL SELECT product_id, CAST(launch_date + INTERVAL 365 DAY AS DATE), 1, 'Active' FROM dim_product
                  WHERE product_id <> 'UNKNOWN' AND launch_date IS NOT NULL
                  UNION ALL SELECT product_id, discontinued_date, 2, 'Discontinued' FROM dim_product
                  WHERE product_id <> 'UNKNOWN' AND launch_date IS NOT NULL AND discontinued_date IS NOT NULL))
      WHERE later_min IS NULL OR d < later_min)
WHERE prev IS NULL OR prev <> lifecycle_status
WINDOW w AS (PARTITION BY product_id ORDER BY change_date)"""

CTE["campaign_mix_history"] = f"""
SELECT {skey("campaign_id || '|' || CAST(min(day) AS VARCHAR)")} AS campaign_version_key, campaign_id, campaign_mix,
       min(day) AS valid_from, max(day) AS valid_to, false AS is_current,
       row_number() OVER (PARTITION BY campaign_id ORDER BY min(day)) AS version_number
FROM (SELECT *, day - CAST(row_number() OVER (PARTITION BY campaign_id, campaign_mix ORDER BY day) AS INTEGER) AS island
      FROM (SELECT campaign_id, CAST(date AS DATE) AS day,
                   CASE sign(clicks - impressions) WHEN 1 THEN 'Click-led' WHEN -1 THEN 'View-led' ELSE 'Balanced' END AS campaign_mix
            FROM stg_marketing_spend))
GROUP BY campaign_id, campaign_mix, island"""

# --- dashboard helpers --------------------------------------------------------

CTE["period_days"] = f"""
SELECT full_date AS report_date, date_key FROM dim_date WHERE full_date BETWEEN {SIM_START} AND {SIM_END}"""

CTE["customer_profit"] = """
SELECT customer_key, sum(net_revenue_amount) - sum(cogs_amount) AS profit
FROM fact_sales GROUP BY ALL HAVING customer_key <> -1"""

CTE["campaign_ledger"] = """
SELECT campaign_key, sum(cost) AS cost, CAST(sum(people) AS BIGINT) AS people, sum(profit) AS profit
FROM (SELECT campaign_key, spend_amount AS cost, 0 AS people, 0 AS profit FROM fact_marketing_spend
      UNION ALL
      SELECT acquisition_campaign_key, 0, 1, coalesce(profit, 0)
      FROM dim_customer LEFT JOIN customer_profit USING (customer_key) WHERE customer_id <> 'UNKNOWN')
GROUP BY campaign_key"""

CHANNEL_CLASS_SQL = _case("sales_channel_code", C.CHANNEL_CLASS, f"'{C.CHANNEL_CLASS_DEFAULT}'")


# --- resolution -------------------------------------------------------------

_NAME = re.compile(r"\b([a-z_][a-z0-9_]*)\b")


def _deps(sql: str) -> list[str]:
    return [n for n in dict.fromkeys(_NAME.findall(sql)) if n in CTE]


def with_ctes(body: str) -> str:
    """``WITH`` clause holding every library CTE ``body`` needs, in order."""
    order: list[str] = []
    seen: set[str] = set()

    def visit(name: str, stack: tuple = ()):
        if name in seen:
            return
        for d in _deps(CTE[name]):
            if d != name and d not in stack:
                visit(d, stack + (name,))
        seen.add(name)
        order.append(name)

    for n in _deps(body):
        visit(n)
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS ({CTE[n]}\n)" for n in order)
    return f"WITH {ctes}\n{body}"
