"""Registration: type-2 history, ingest/sinks, incremental load, partitioned
facts and the streaming jobs, with their DuckDB oracles."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from . import oracle as O

from .plans import scd
from .plans.model import Model
from .registry import Query, register
from .sources import ingest
from .sources.versioned import VersionedTable, load_snapshot
from .streaming import events as S

# -- type-2 history -----------------------------------------------------------------

register("scd2_customer_tier_history", Query(scd.customer_tier_history, "SELECT * FROM customer_tier_history",
                                             big=("version_number",), tags=("scd",)))
register("scd2_sales_by_tier_at_order", Query(scd.sales_by_tier_at_order, """
SELECT year(fs.order_date) AS order_year, coalesce(h.loyalty_tier, 'Unranked') AS loyalty_tier, count(*) AS lines,
       CAST(sum(fs.net_revenue_amount) AS DOUBLE) AS net_revenue_amount
FROM fact_sales fs JOIN dim_customer dc ON fs.customer_key = dc.customer_key
LEFT JOIN customer_tier_history h ON dc.customer_id = h.customer_id
     AND fs.order_date BETWEEN h.valid_from AND h.valid_to
GROUP BY 1, 2""", tags=("scd",)))
register("dq_scd2_one_current_version", Query(scd.one_current_version, """
SELECT count(*) AS customers, count(*) FILTER (WHERE cv <> 1) AS violations
FROM (SELECT customer_id, count(*) FILTER (WHERE is_current) AS cv FROM customer_tier_history GROUP BY 1)""",
    tags=("scd", "quality")))

register("scd2_campaign_mix_history", Query(scd.campaign_mix_history, "SELECT * FROM campaign_mix_history", big=("version_number",), tags=("scd",)))
register("scd2_spend_by_mix_of_the_day_before", Query(scd.spend_by_mix, """
SELECT coalesce(h.campaign_mix, 'No Spend') AS mix_of_the_day_before, count(*) AS days, CAST(sum(s.spend_sgd) AS DOUBLE) AS spend_amount
FROM stg_marketing_spend s LEFT JOIN campaign_mix_history h
  ON h.campaign_id = s.campaign_id AND CAST(s.date AS DATE) - 1 >= h.valid_from AND CAST(s.date AS DATE) - 1 <= h.valid_to
GROUP BY 1""", tags=("scd",)))
register("dq_scd2_histories", Query(scd.history_checks, " UNION ALL ".join(f"""
SELECT '{label}' AS dimension, count(*) AS versions, count(DISTINCT {key}) AS members, count(*) FILTER (WHERE valid_from > before + 1) AS gaps,
       count(*) FILTER (WHERE valid_from <= before) AS overlaps, count(*) FILTER (WHERE valid_from = before + 1 AND {attr} IS NOT DISTINCT FROM said) AS unmerged,
       (SELECT count(*) FROM (SELECT {key} FROM {cte} WHERE is_current GROUP BY 1 HAVING count(*) > 1)) AS several_current,
       count(*) - count(DISTINCT {label}_version_key) AS repeated_keys
FROM (SELECT *, lag(valid_to) OVER w AS before, lag({attr}) OVER w AS said FROM {cte} WINDOW w AS (PARTITION BY {key} ORDER BY valid_from))"""
    for label, cte, key, attr in (("customer", "customer_tier_history", "customer_id", "loyalty_tier"),
                                  ("product", "product_lifecycle_history", "product_id", "lifecycle_status"),
                                  ("campaign", "campaign_mix_history", "campaign_id", "campaign_mix"))), tags=("scd", "quality")))

# -- ingest, sinks, incremental ---------------------------------------------------------

_LANDING_CTE = {"suppliers": "suppliers", "products": "products", "customers": "customers",
                "warehouses": "warehouses", "assignment": "assignment", "inventory_snapshot": "inventory_snapshot",
                "purchase_orders": "purchase_orders", "orders": "orders_raw", "order_items": "order_items",
                "shipments": "shipments", "returns": "returns_raw", "inventory_movements": "inventory_movements",
                "marketing_spend": "marketing_spend", "acquisition_attribution": "acquisition_attribution",
                "ar_invoices": "ar_invoices"}


def _ingest(m: Model):
    return ingest.round_trip_landing(m.raw, list(_LANDING_CTE))


register("ingest_landing_audit", Query(_ingest, "\nUNION ALL\n".join(
    [f"SELECT '{t}' AS table_name, 'loaded' AS status, count(*) AS rows FROM {cte}" for t, cte in _LANDING_CTE.items()]
    + ["SELECT 'missing_example', 'missing', CAST(NULL AS BIGINT)"]), tags=("ingest",)))


def _partitioned(m: Model):
    path = os.path.join(ingest.scratch_dir(m.spark, "fact_sales"), "by_month")
    ingest.write_partitioned_by_month(m.fact_sales, "order_date", path, ["order_number", "line_item_number"])
    back = m.spark.read.parquet(path)
    return (back.groupBy(F.col("month").cast("string").alias("order_month"))
            .agg(F.count(F.lit(1)).alias("lines"),
                 F.sum("net_revenue_amount").cast("double").alias("net_revenue_amount")))


register("fact_sales_partitioned_monthly", Query(_partitioned, """
SELECT strftime(order_date, '%Y-%m') AS order_month, count(*) AS lines,
       CAST(sum(net_revenue_amount) AS DOUBLE) AS net_revenue_amount
FROM fact_sales GROUP BY 1""", tags=("ingest",)))

#: fact -> its date, the key that spreads a hot day, a measure
_BY_MONTH = {"fact_sales": ("order_date", "order_number", "net_revenue_amount"), "fact_returns": ("return_date", "order_number", "refunded_amount"),
             "fact_purchase_orders": ("po_date", "po_number", "total_purchase_cost_amount"), "fact_marketing_spend": ("spend_date", "marketing_spend_key", "spend_amount")}
#: Chosen value: the months that the report reads back (the other folders are not listed).
_MONTHS = ("1995-01", "1997-12")


def _partitioned_facts(m: Model):
    parts = []
    for fact, (date, key, amount) in _BY_MONTH.items():
        path = os.path.join(ingest.scratch_dir(m.spark, fact), "by_month")
        ingest.write_partitioned_by_month(getattr(m, fact), date, path, [key])
        back = m.spark.read.parquet(path).withColumn("month", F.col("month").cast("string")).where(F.col("month").between(*_MONTHS))
        parts.append(back.groupBy(F.lit(fact).alias("fact"), F.col("month").alias("fact_month"))
                     .agg(F.count(F.lit(1)).alias("rows"), F.sum(amount).cast("double").alias("amount")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


register("facts_partitioned_monthly", Query(_partitioned_facts, " UNION ALL ".join(f"""
SELECT '{fact}' AS fact, strftime({date}, '%Y-%m') AS fact_month, count(*) AS rows, CAST(sum({amount}) AS DOUBLE) AS amount
FROM {fact} WHERE strftime({date}, '%Y-%m') BETWEEN '{_MONTHS[0]}' AND '{_MONTHS[1]}' GROUP BY ALL""" for fact, (date, _, amount) in _BY_MONTH.items()), tags=("ingest",)))

CUTOFF = dt.date(2000, 6, 30)
_PRODUCT_ATTRS = ["sku_code", "product_name", "category", "brand", "supplier_id", "base_cost_sgd", "msrp_sgd",
                  "launch_date", "lifecycle_status", "discontinued_date", "popularity_weight", "return_rate",
                  "reorder_point", "reorder_quantity", "lead_time_days", "is_currently_sellable"]


def _incremental(m: Model):
    new = m.stg("stg_products")
    old = ingest.catalog_as_of(new, CUTOFF)
    return ingest.incremental_changes(old, new, "product_id", _PRODUCT_ATTRS)


register("incremental_product_changes", Query(_incremental, f"""
SELECT product_id, CASE WHEN launch_date > {O._d(CUTOFF)} THEN 'insert' ELSE 'update' END AS change_type
FROM stg_products
WHERE launch_date > {O._d(CUTOFF)} OR discontinued_date > {O._d(CUTOFF)}""", tags=("ingest",)))

# A feed as it stood at three loads; a product leaves it a year after its end.
LOADS = [dt.date(1995, 2, 28), dt.date(2001, 11, 15), dt.date(2002, 10, 31)]


def _loaded(m: Model):
    products = m.stg("stg_products").select("product_id", *_PRODUCT_ATTRS)
    table = VersionedTable(m.spark, ingest.scratch_dir(m.spark, "products"), products.schema, ["product_id"])
    audits = [load_snapshot(table, ingest.catalog_feed(products, cutoff)).withColumn("load_number", F.lit(n).cast("bigint"))
              for n, cutoff in enumerate(LOADS, 1)]
    return table, audits


def _applied(m: Model):
    return _loaded(m)[0].read(changed_in="load_number").select("product_id", "lifecycle_status", "discontinued_date", "is_currently_sellable", "load_number")


def _apply_audit(m: Model):
    _, audits = _loaded(m)
    return audits[0].unionByName(audits[1]).unionByName(audits[2]).select("load_number", "change_type", "rows")


_FEEDS = f"""
WITH loads(load_number, cutoff) AS (VALUES {", ".join(f"({n}, {O._d(c)})" for n, c in enumerate(LOADS, 1))}),
feeds AS (
  SELECT product_id, load_number,
         coalesce(launch_date <= cutoff, true) AND coalesce(discontinued_date + 365 > cutoff, true) AS present,
         CASE WHEN discontinued_date > cutoff THEN 'Active' ELSE lifecycle_status END AS lifecycle_status,
         CASE WHEN discontinued_date <= cutoff THEN discontinued_date END AS discontinued_date,
         coalesce(discontinued_date > cutoff, false) OR is_currently_sellable AS is_currently_sellable
  FROM stg_products, loads),
steps AS (
  SELECT *, coalesce(lag(present) OVER w, false) AS was,
         (lifecycle_status, discontinued_date, is_currently_sellable) IS DISTINCT FROM
         lag((lifecycle_status, discontinued_date, is_currently_sellable)) OVER w AS differs
  FROM feeds WINDOW w AS (PARTITION BY product_id ORDER BY load_number)),
changes AS (
  SELECT *, CASE WHEN present AND NOT was THEN 'insert' WHEN was AND NOT present THEN 'delete' WHEN present AND differs THEN 'update' END AS change_type FROM steps)"""

register("incremental_apply_products", Query(_applied, f"""{_FEEDS}
SELECT product_id, lifecycle_status, discontinued_date, is_currently_sellable, load_number
FROM (SELECT product_id, max(load_number) FILTER (WHERE change_type IS NOT NULL) AS load_number FROM changes GROUP BY 1)
JOIN (SELECT * EXCLUDE (load_number) FROM feeds WHERE load_number = {len(LOADS)} AND present) USING (product_id)""", big=("load_number",), tags=("ingest",)))

register("incremental_apply_audit", Query(_apply_audit, f"""{_FEEDS}
SELECT load_number, change_type, count(*) AS rows FROM changes WHERE change_type IS NOT NULL GROUP BY 1, 2""", big=("load_number",), tags=("ingest",)))

# -- streaming --------------------------------------------------------------------------


def _stream(fn):
    return lambda m: fn(m.spark, m.raw.sf_dir)


def _bucket(seconds: int) -> str:
    return f"TIMESTAMP '1970-01-01 00:00:00' + to_seconds(CAST(floor(epoch(ts) / {seconds}) * {seconds} AS BIGINT))"


register("stream_sales_15min", Query(_stream(S.tumbling_sales_15min), f"""
SELECT {_bucket(900)} AS window_start, {_bucket(900)} + INTERVAL 15 MINUTE AS window_end, count(*) AS purchases,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS purchase_value
FROM events WHERE event_type = 'purchase' GROUP BY 1, 2""", tags=("streaming",)))

register("stream_sales_15min_append", Query(_stream(S.tumbling_sales_15min_append), f"""
SELECT window_start, purchases FROM (
  SELECT {_bucket(900)} AS window_start, count(*) AS purchases FROM events WHERE event_type = 'purchase' GROUP BY 1)
WHERE window_start + INTERVAL 15 MINUTE <= (SELECT max(ts) FROM events WHERE event_type = 'purchase') - INTERVAL 1 HOUR""",
    tags=("streaming",)))

_LATE = f"""
WITH arrived AS (
  SELECT *, {_bucket(900)} + INTERVAL 15 MINUTE AS window_end,
         CAST(floor((epoch_us(ts) / 1000000.0 + CAST(json_extract_string(props, '$.k') AS INTEGER) // {S.ARRIVAL_STEP} * {S.ARRIVAL_HOURS} * 3600) / {86400 * S.RUN_DAYS}) AS BIGINT) AS slot
  FROM events),
runs AS (SELECT slot, row_number() OVER (ORDER BY slot) - 1 AS batch,
                max(max(ts)) OVER (ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 1 HOUR AS watermark
         FROM arrived GROUP BY slot),
judged AS (SELECT arrived.*, batch, coalesce(window_end <= watermark, false) AS late FROM arrived JOIN runs USING (slot))"""

register("stream_late_events", Query(_stream(S.late_events), f"""{_LATE}
SELECT window_end - INTERVAL 15 MINUTE AS window_start, count(*) FILTER (WHERE NOT late) AS events, count(*) FILTER (WHERE late) AS late_rows
FROM judged WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR GROUP BY 1""", tags=("streaming",)))

register("stream_late_rows", Query(_stream(S.late_event_rows), f"""{_LATE}
SELECT event_id, user_id, event_type, ts, value, batch FROM judged WHERE late""", tags=("streaming",)))

register("stream_stock_view_4h", Query(_stream(S.stock_view_4h), f"""
SELECT {_bucket(14400)} AS window_start, event_type, count(*) AS events, max(ts) AS as_of
FROM events GROUP BY 1, 2""", tags=("streaming",)))

register("stream_sliding_30d", Query(_stream(S.sliding_30d_purchases), """
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) - to_days(CAST(k AS INTEGER)) AS window_start, count(*) AS purchases,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS purchase_value
FROM events, range(30) r(k) WHERE event_type = 'purchase' GROUP BY 1""", tags=("streaming",)))

register("stream_sessions", Query(_stream(S.sessions), """
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS events
FROM (SELECT user_id, ts, sum(new_session) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
      FROM (SELECT user_id, ts, event_id,
                   CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL
                          OR ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTE
                        THEN 1 ELSE 0 END AS new_session
            FROM events))
GROUP BY user_id, sid""", tags=("streaming",)))

register("stream_dedup_events", Query(_stream(S.dedup_events),
                                      "SELECT event_id, user_id, event_type, ts, value FROM events",
                                      tags=("streaming",)))

register("stream_cdc_upsert", Query(_stream(S.cdc_upsert), """
SELECT user_id, ts AS changed_at, event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS tier_code
FROM events WHERE event_type = 'signup'
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    big=("tier_code",), tags=("streaming",)))

register("stream_cdc_with_deletes", Query(_stream(S.cdc_with_deletes), """
SELECT user_id, ts AS changed_at, event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS tier_code
FROM (SELECT * FROM events WHERE event_type IN ('signup', 'error')
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
WHERE event_type = 'signup'""", big=("tier_code",), tags=("streaming",)))


# -- dictionary cleaning rules and PII masking --------------------------------------------

from .plans import staging as ST  # noqa: E402

register("stg_customers_cleaned", Query(lambda m: ST.cleaned_customers(m.stg("stg_customers")), """
SELECT customer_id,
       upper(substr(trim(first_name), 1, 1)) || lower(substr(trim(first_name), 2)) AS first_name,
       upper(substr(trim(last_name), 1, 1)) || lower(substr(trim(last_name), 2)) AS last_name,
       coalesce(loyalty_tier, 'Bronze') AS loyalty_tier,
       regexp_matches(customer_id, '^CUST-[0-9]+$') AS customer_id_valid
FROM stg_customers""", tags=("staging",)))

register("stg_products_cleaned", Query(lambda m: ST.cleaned_products(m.stg("stg_products")), """
SELECT product_id, upper(trim(sku_code)) AS sku_code, CAST(round(msrp_sgd, 2) AS DOUBLE) AS msrp_sgd
FROM stg_products""", tags=("staging",)))


def _mask(x: str, digit: str = "n") -> str:
    return (f"regexp_replace(regexp_replace(regexp_replace({x}, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), "
            f"'[0-9]', '{digit}', 'g')")


register("pii_masked_customers", Query(lambda m: ST.mask_customers(m.stg("stg_customers")), f"""
SELECT customer_id, {_mask('first_name')} AS first_name, {_mask('last_name')} AS last_name,
       sha256(email_address) AS email_hash, {_mask('phone_number', '#')} AS phone_number, customer_country
FROM stg_customers""", tags=("staging",)))

register("scd2_product_lifecycle_history", Query(scd.product_lifecycle_history,
                                                 "SELECT * FROM product_lifecycle_history",
                                                 big=("version_number",), tags=("scd",)))
register("scd2_sales_by_lifecycle_at_order", Query(scd.sales_by_lifecycle_at_order, """
SELECT coalesce(h.lifecycle_status, 'Before Launch') AS lifecycle_status_at_order, count(*) AS lines,
       CAST(sum(fs.net_revenue_amount) AS DOUBLE) AS net_revenue_amount
FROM fact_sales fs JOIN dim_product dp ON fs.product_key = dp.product_key
LEFT JOIN product_lifecycle_history h ON dp.product_id = h.product_id
     AND fs.order_date BETWEEN h.valid_from AND h.valid_to
GROUP BY 1""", tags=("scd",)))
