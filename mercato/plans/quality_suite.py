"""The declared data tests of the model, plus the reconciliation and
plausibility checks the reference ran by hand."""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions.exprs import date_key, lit_date, surrogate_key
from ..operators.quality import Check, Snapshot, run_checks
from .model import Model

U, NN, AV, AR, REL, EX = "unique", "not_null", "accepted_values", "accepted_range", "relationships", "expression"



def key(model: str, column: str) -> list[Check]:
    return [Check(model, column, U), Check(model, column, NN)]


def refers(model: str, column: str, parent: str, parent_column: str = "") -> Check:
    return Check(model, column, REL, to=(parent, parent_column or column))


STAGING_CHECKS = [
    *key("stg_suppliers", "supplier_id"),
    *key("stg_products", "product_id"), *key("stg_products", "sku_code"),
    refers("stg_products", "supplier_id", "stg_suppliers"),
    Check("stg_products", "lifecycle_status", AV, values=("Active", "Discontinued", "New Launch")),
    *key("stg_customers", "customer_id"), Check("stg_customers", "email_address", NN),
    *key("stg_warehouses", "warehouse_id"),
    Check("stg_warehouses", "warehouse_type", AV, values=("Distribution Center", "Retail Store", "Returns Center")),
    refers("stg_warehouse_product_assignment", "warehouse_id", "stg_warehouses"),
    refers("stg_warehouse_product_assignment", "product_id", "stg_products"),
    *key("stg_inventory_snapshot", "inventory_snapshot_id"),
    Check("stg_inventory_snapshot", "quantity_on_hand", AR, "warn", min_value=0),
    *key("stg_purchase_orders", "purchase_order_id"),
    Check("stg_purchase_orders", "po_status", AV, "warn", values=("Received", "In Transit")),
    *key("stg_orders", "order_id"),
    refers("stg_orders", "customer_id", "stg_customers"),
    Check("stg_orders", "sales_channel", AV, values=("Shopify", "Shopee", "Lazada", "Retail")),
    Check("stg_orders", "order_status", AV,
          values=("Pending", "Processing", "Shipped", "Delivered", "Cancelled")),
    *key("stg_order_items", "order_item_id"),
    refers("stg_order_items", "order_id", "stg_orders"),
    refers("stg_order_items", "product_id", "stg_products"),
    *key("stg_shipments", "shipment_id"),
    *key("stg_returns", "return_id"),
    refers("stg_returns", "order_item_id", "stg_order_items"),
    *key("stg_inventory_movements", "movement_id"),
    Check("stg_inventory_movements", "movement_type", AV,
          values=(C.MOVEMENT_SALE, C.MOVEMENT_RETURN, C.MOVEMENT_PURCHASE)),
    Check("stg_marketing_spend", "marketing_spend_id", U),
    Check("stg_marketing_spend", "spend_sgd", AR, min_value=0),
    *key("stg_acquisition_attribution", "customer_id"),
    *key("stg_ar_invoices", "invoice_id"),
    Check("stg_ar_invoices", "order_id", NN), Check("stg_ar_invoices", "customer_id", NN),
    Check("stg_ar_invoices", "invoice_amount", AR, min_value=0),
    Check("stg_ar_invoices", "amount_paid", AR, min_value=0),
    Check("stg_ar_invoices", "invoice_status", AV, values=("Paid", "Partially Paid", "Open")),
]

MART_CHECKS = [
    *key("dim_date", "date_key"),
    *key("dim_product", "product_key"), *key("dim_product", "product_id"),
    *key("dim_customer", "customer_key"), *key("dim_customer", "customer_id"),
    refers("dim_customer", "acquisition_campaign_key", "dim_campaign", "campaign_key"),
    *key("dim_supplier", "supplier_key"), *key("dim_supplier", "supplier_id"),
    *key("dim_warehouse", "warehouse_key"), *key("dim_warehouse", "warehouse_id"),
    *key("dim_campaign", "campaign_key"), *key("dim_campaign", "campaign_id"),
    Check("dim_campaign", "marketing_platform", NN),
    Check("dim_campaign", "marketing_platform", AV, values=("Meta", "TikTok", "Klaviyo", "N/A")),
    Check("dim_campaign", "acquisition_channel_name", NN),
    Check("dim_campaign", "acquisition_channel_name", AV,
          values=("Facebook Ads", "Instagram", "TikTok", "Email Campaign", "N/A")),
    *key("running_totals", "movement_id"),
    Check("balance_offset", "warehouse_id", NN), Check("balance_offset", "product_id", NN),
    *key("fact_sales", "sales_fact_key"),
    refers("fact_sales", "order_date_key", "dim_date", "date_key"),
    refers("fact_sales", "customer_key", "dim_customer"),
    refers("fact_sales", "product_key", "dim_product"),
    refers("fact_sales", "warehouse_key", "dim_warehouse"),
    Check("fact_sales", "payment_terms_code", AV, values=("DUE_ON_RECEIPT", "NET15", "NET30", "NET60")),
    *key("fact_returns", "return_fact_key"),
    refers("fact_returns", "customer_key", "dim_customer"),
    refers("fact_returns", "product_key", "dim_product"),
    refers("fact_returns", "warehouse_key", "dim_warehouse"),
    *key("fact_purchase_orders", "purchase_order_fact_key"),
    refers("fact_purchase_orders", "supplier_key", "dim_supplier"),
    refers("fact_purchase_orders", "product_key", "dim_product"),
    refers("fact_purchase_orders", "destination_warehouse_key", "dim_warehouse", "warehouse_key"),
    *key("fact_marketing_spend", "marketing_spend_key"),
    Check("fact_marketing_spend", "campaign_key", NN),
    refers("fact_marketing_spend", "campaign_key", "dim_campaign"),
    Check("fact_marketing_spend", "spend_date_key", NN),
    Check("fact_marketing_spend", "spend_amount", NN),
    Check("fact_marketing_spend", "spend_amount", AR, min_value=0),
    *key("fact_ar_aging_daily", "ar_snapshot_key"),
    Check("fact_ar_aging_daily", "customer_key", NN),
    refers("fact_ar_aging_daily", "customer_key", "dim_customer"),
    Check("fact_ar_aging_daily", "snapshot_date_key", NN),
    Check("fact_ar_aging_daily", "open_balance_amount", NN),
    Check("fact_ar_aging_daily", "open_balance_amount", AR, min_value=0),
    Check("fact_ar_aging_daily", "days_outstanding", NN),
    Check("fact_ar_aging_daily", "days_outstanding", AR, min_value=0),
]

INVENTORY_CHECKS = [
    *key("fact_inventory_daily", "inventory_fact_key"),
    refers("fact_inventory_daily", "product_key", "dim_product"),
    refers("fact_inventory_daily", "warehouse_key", "dim_warehouse"),
    refers("fact_inventory_daily", "snapshot_date_key", "dim_date", "date_key"),
]

RULE_CHECKS = [
    Check("fact_sales", "gross_revenue_amount", EX, expr="gross_revenue_amount >= 0", name="non_negative_gross"),
    Check("fact_sales", "discount_amount", EX, expr="discount_amount <= gross_revenue_amount",
          name="discount_within_gross"),
    Check("fact_sales", "net_revenue_amount", EX,
          expr="net_revenue_amount = gross_revenue_amount - discount_amount", name="net_equals_gross_less_discount"),
    Check("fact_sales", "order_date", EX, "warn", expr=f"order_date <= DATE '{C.SIM_END}'", name="no_future_orders"),
    Check("fact_purchase_orders", "received_quantity", EX, expr="received_quantity <= ordered_quantity",
          name="received_within_ordered"),
    Check("fact_returns", "refunded_amount", EX, "warn", expr="refunded_amount >= 0", name="non_negative_refund"),
    Check("fact_ar_aging_daily", "open_balance_amount", EX,
          expr="aging_bucket_0_30_amount + aging_bucket_31_60_amount + aging_bucket_61_90_amount"
               " + aging_bucket_90_plus_amount = open_balance_amount",
          name="aging_buckets_sum_to_open_balance"),
]


def resolver(m: Model):
    def resolve(name: str) -> DataFrame:
        if name.startswith("stg_"):
            return m.stg(name)
        return getattr(m, name)
    return resolve


def dq_staging(m: Model) -> DataFrame:
    return run_checks(resolver(m), STAGING_CHECKS)


def dq_marts(m: Model) -> DataFrame:
    return run_checks(resolver(m), MART_CHECKS, {"fact_ar_aging_daily": receivables_snapshot(m)})


def dq_inventory_daily(m: Model) -> DataFrame:
    """The daily inventory's tests, on its runs of days."""
    return run_checks(resolver(m), INVENTORY_CHECKS, {"fact_inventory_daily": inventory_snapshot(m)})


def receivables_snapshot(m: Model) -> Snapshot:
    spans = m.stg("stg_ar_invoices").select(surrogate_key("invoice_id").alias("entity"),
                                            F.col("invoice_date").alias("first_day"), m._ar_stop().alias("last_day"))
    return Snapshot(spans)


def inventory_snapshot(m: Model) -> Snapshot:
    runs = m.inventory_intervals.filter("valid_from <= valid_to")
    days = m.inventory_levels().select(date_key("balance_date").alias("value"), F.col("active_pairs").alias("n"))
    return Snapshot(
        spans=runs.select(F.col("pair_hash").alias("entity"), F.col("valid_from").alias("first_day"),
                          F.col("valid_to").alias("last_day")),
        rows=runs.select(F.col("pair_hash").alias("inventory_fact_key"), "product_key", "warehouse_key",
                         (F.datediff("valid_to", "valid_from") + 1).cast("bigint").alias("__n")),
        keys={"snapshot_date_key": days})


def dq_rules(m: Model) -> DataFrame:
    return run_checks(resolver(m), RULE_CHECKS)


def balance_reconciliation(m: Model, n: int = 10) -> DataFrame:
    """Opening stock + every movement, per pair (full outer add, missing = 0);
    the worst negative balances."""
    opening = m.stg("stg_inventory_snapshot").groupBy("warehouse_id", "product_id") \
        .agg(F.sum("quantity_on_hand").alias("opening"))
    moves = m.movement_days.groupBy("warehouse_id", "product_id").agg(F.sum("day_qty").alias("movements"))
    j = opening.join(moves, ["warehouse_id", "product_id"], "full_outer")
    bal = F.coalesce("opening", F.lit(0)) + F.coalesce("movements", F.lit(0))
    return (j.select("warehouse_id", "product_id", F.coalesce("opening", F.lit(0)).cast("bigint").alias("opening_qty"),
                     F.coalesce("movements", F.lit(0)).cast("bigint").alias("movement_qty"),
                     bal.cast("bigint").alias("closing_qty"))
            .filter(F.col("closing_qty") < 0)
            .orderBy("closing_qty", "warehouse_id", "product_id").limit(n))


def orders_before_signup(m: Model) -> DataFrame:
    fs = m.fact_sales.select("customer_key", "order_date")
    dc = m.dim_customer.select("customer_key", "customer_since")
    j = fs.join(dc, "customer_key", "left")
    return j.agg(F.count(F.when(F.col("order_date") < F.col("customer_since"), 1)).alias("lines_before_signup"),
                 F.count(F.lit(1)).alias("total_lines"))


def orders_before_first_signup(m: Model) -> DataFrame:
    """Customers whose first order lies before their first sign-up event, as the
    events say (the dimension takes the earlier of the two)."""
    signup = (m.raw.contacts.where(F.col("event_type") == "signup").groupBy(F.format_string("CUST-%06d", "user_id").alias("customer_id"))
              .agg(F.to_date(F.min("ts")).alias("first_signup")))
    first = m.stg("stg_orders").groupBy("customer_id").agg(F.to_date(F.min("order_date")).alias("first_order"))
    return first.join(signup, "customer_id", "left").agg(
        F.count(F.lit(1)).alias("customers"), F.count("first_signup").alias("signed_up"), F.count_if(F.col("first_order") < F.col("first_signup")).alias("ordered_before"),
        F.max(F.datediff("first_signup", "first_order")).alias("longest_gap_days"))


#: Table -> its business date; None: no date. The daily facts are read from the intervals that they unfold from.
DATES = {
    "stg_suppliers": "supplier_created_at", "stg_products": "launch_date", "stg_customers": "customer_since", "stg_warehouses": None, "stg_warehouse_product_assignment": None,
    "stg_inventory_snapshot": "snapshot_date", "stg_purchase_orders": "order_date", "stg_orders": "order_date", "stg_order_items": None, "stg_shipments": "shipped_date",
    "stg_returns": "return_date", "stg_inventory_movements": "movement_date", "stg_marketing_spend": "date", "stg_acquisition_attribution": None, "stg_ar_invoices": "invoice_date",
    "dim_date": "full_date", "dim_product": "launch_date", "dim_supplier": None, "dim_warehouse": None, "dim_customer": "customer_since", "dim_campaign": "start_date",
    "fact_sales": "order_date", "fact_returns": "return_date", "fact_purchase_orders": "po_date", "fact_marketing_spend": "spend_date",
}
PUSHDOWN = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}


@contextlib.contextmanager
def footers(spark: SparkSession):
    """Within it, Parquet tables are read so that counts and the bounds of dates
    come from the files' footers (the scan shows ``PushedAggregation``)."""
    usual = {c: spark.conf.get(c) for c in PUSHDOWN}
    try:
        for c, v in PUSHDOWN.items():
            spark.conf.set(c, v)
        yield
    finally:
        for c, v in usual.items():
            spark.conf.set(c, v)


def span(df: DataFrame, date: str | None) -> DataFrame:
    """One row: rows, earliest, latest. Timestamps have no bounds in the footers;
    such a column is read."""
    bounds = [f(date) if date else F.lit(None) for f in (F.min, F.max)]
    return df.agg(F.count(F.lit(1)).alias("rows"), bounds[0].alias("earliest"), bounds[1].alias("latest"))


def footer_span(spark: SparkSession, path: str, date: str | None) -> tuple:
    """:func:`span` of a written table from its footers. A file whose dates are
    all NULL has no bounds: then the column is read."""
    try:
        with footers(spark):
            return tuple(span(spark.read.parquet(path), date).first())
    except Exception as e:
        if "No min/max found" not in str(e):
            raise
        return tuple(span(spark.read.parquet(path), date).first())


def footer_path(m: Model, name: str) -> str | None:
    """The written table whose footers have the bounds of its dates. Those of a
    dimension with an unknown member have none: its file holds no date."""
    return m.table_path(name) if name == "dim_date" or not name.startswith("dim_") else None


def freshness_of_all(m: Model) -> DataFrame:
    """Rows and the first and last business date of every model. All tables are
    needed, so those not yet written are written several at a time."""
    if m.materialize and hasattr(m.raw, "t"):
        m.build()
    parts = []
    for name, date in DATES.items():
        df = m.stg(name) if name.startswith("stg_") else getattr(m, name)
        path = footer_path(m, name)
        if path:
            parts.append((name, m.spark.createDataFrame([footer_span(m.spark, path, date)], "rows long, earliest date, latest date")))
        else:
            parts.append((name, span(df, date)))
    rows = F.sum(F.datediff("valid_to", "valid_from") + 1)
    iv = m.inventory_intervals.where("valid_from <= valid_to")
    parts += [("running_totals", m.stg("stg_inventory_movements").agg(F.count(F.lit(1)).alias("rows"), F.min(F.to_date("movement_date")).alias("earliest"), F.max(F.to_date("movement_date")).alias("latest"))),
              ("balance_offset", m.stg("stg_inventory_snapshot").agg(F.count(F.lit(1)).alias("rows"), F.min("snapshot_date").alias("earliest"), F.max("snapshot_date").alias("latest"))),
              ("inventory_spine", iv.agg(rows.alias("rows"), F.min("valid_from").alias("earliest"), F.max("valid_to").alias("latest"))),
              ("fact_inventory_daily", iv.agg(rows.alias("rows"), F.min("valid_from").alias("earliest"), F.max("valid_to").alias("latest")))]
    last = F.least(F.coalesce("payment_date", lit_date(m.sim_end)), lit_date(m.sim_end))
    ar = m.stg("stg_ar_invoices").select(F.greatest("invoice_date", F.lit(None).cast("date")).alias("valid_from"), last.alias("valid_to")).where("valid_from <= valid_to")
    parts += [(name, ar.agg(rows.alias("rows"), F.min("valid_from").alias("earliest"), F.max("valid_to").alias("latest"))) for name in ("ar_spine", "fact_ar_aging_daily")]
    out = None
    for name, one in parts:
        row = one.select(F.lit(name).alias("table_name"), F.col("rows").cast("long").alias("rows"), F.to_date("earliest").alias("earliest"), F.to_date("latest").alias("latest"))
        out = row if out is None else out.unionByName(row)
    return out


def shared_order_quantity(m: Model) -> DataFrame:
    """How many products share each purchase-order quantity."""
    po = m.stg("stg_purchase_orders")
    return po.groupBy("quantity_ordered").agg(F.count_distinct("product_id").alias("products"),
                                              F.count(F.lit(1)).alias("purchase_orders"))


def po_vs_sales(m: Model) -> DataFrame:
    """Per product: units ordered from suppliers vs units sold; flagged when
    ordering runs above twice the sales."""
    po = m.stg("stg_purchase_orders").groupBy("product_id").agg(F.sum("quantity_ordered").alias("ordered"))
    sold = m.stg("stg_order_items").groupBy("product_id").agg(F.sum("quantity").alias("sold"))
    j = po.join(sold, "product_id", "full_outer")
    o = F.coalesce("ordered", F.lit(0)).cast("bigint")
    s = F.coalesce("sold", F.lit(0)).cast("bigint")
    return j.select("product_id", o.alias("units_ordered"), s.alias("units_sold"),
                    F.try_divide(o.cast("double"), s.cast("double")).alias("order_to_sales_ratio"),
                    (o > s * 2).alias("over_ordered"))


def freshness(m: Model) -> DataFrame:
    """'As of' caption per table: its latest business date."""
    parts = [
        m.fact_sales.agg(F.max("order_date").alias("as_of")).withColumn("table_name", F.lit("fact_sales")),
        m.fact_returns.agg(F.max("return_date").alias("as_of")).withColumn("table_name", F.lit("fact_returns")),
        m.stg("stg_inventory_movements").agg(F.max(F.to_date("movement_date")).alias("as_of"))
        .withColumn("table_name", F.lit("inventory_movements")),
        m.fact_marketing_spend.agg(F.max("spend_date").alias("as_of"))
        .withColumn("table_name", F.lit("fact_marketing_spend")),
        m.stg("stg_ar_invoices").agg(F.max("invoice_date").alias("as_of")).withColumn("table_name", F.lit("ar_invoices")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("table_name", "as_of")


def anchor_check(m: Model) -> DataFrame:
    """Derived on-hand on the snapshot day equals the counted snapshot."""
    iv = m.inventory_intervals.filter(F.col("valid_from") <= F.col("valid_to"))
    snap = m.stg("stg_inventory_snapshot").select("warehouse_id", "product_id", "snapshot_date",
                                                  F.col("quantity_on_hand").alias("counted"))
    j = (snap.join(iv, ["warehouse_id", "product_id"])
         .filter(F.col("snapshot_date").between(F.col("valid_from"), F.col("valid_to"))))
    return j.agg(F.count(F.lit(1)).alias("pairs_checked"),
                 F.count(F.when(F.col("quantity_on_hand") != F.col("counted"), 1)).alias("mismatches"))

