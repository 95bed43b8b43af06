"""Staging layer: one projection per landing table (rename, trim, case, cast).

1:1 grain, no joins. Each function takes the landing DataFrame.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions.exprs import lit_date, parse_list_text


def stg_suppliers(df: DataFrame) -> DataFrame:
    return df.select("supplier_id", F.trim("supplier_name").alias("supplier_name"),
                     "supplier_tier", "category_specialty",
                     F.col("country").alias("supplier_country"),
                     F.col("currency").alias("supplier_currency"),
                     "payment_terms", "lead_time_days", "quality_rating", "preferred_supplier",
                     F.col("created_at").alias("supplier_created_at"))


def stg_products(df: DataFrame, as_of: dt.date = C.AS_OF) -> DataFrame:
    """``is_currently_sellable`` is evaluated against ``as_of`` (not the wall
    clock), so results are reproducible."""
    sellable = (F.when(F.col("lifecycle_status") == "Discontinued", False)
                .when(F.col("launch_date") > lit_date(as_of), False)
                .otherwise(True))
    return df.select("product_id", F.col("sku").alias("sku_code"),
                     F.trim("product_name").alias("product_name"),
                     "category", "brand", "supplier_id", "base_cost_sgd", "msrp_sgd",
                     "launch_date", "lifecycle_status", "discontinued_date",
                     "popularity_weight", "return_rate", "reorder_point", "reorder_quantity",
                     "lead_time_days", sellable.alias("is_currently_sellable"))


def stg_customers(df: DataFrame) -> DataFrame:
    return df.select("customer_id", F.trim("first_name").alias("first_name"),
                     F.trim("last_name").alias("last_name"),
                     F.lower(F.trim("email")).alias("email_address"),
                     F.col("phone").alias("phone_number"),
                     F.col("country").alias("customer_country"),
                     "gender", "birth_date", "customer_since", "loyalty_tier",
                     "acquisition_channel", "customer_status")


def stg_warehouses(df: DataFrame) -> DataFrame:
    return df.select("warehouse_id", F.upper(F.trim("warehouse_code")).alias("warehouse_code"),
                     F.trim("warehouse_name").alias("warehouse_name"), "warehouse_type",
                     F.col("country").alias("warehouse_country"),
                     F.col("city").alias("warehouse_city"),
                     F.col("region").alias("warehouse_region"),
                     parse_list_text("serves_countries").alias("serves_countries"))


def stg_warehouse_product_assignment(df: DataFrame) -> DataFrame:
    return df.select("warehouse_id", "product_id")


def stg_inventory_snapshot(df: DataFrame) -> DataFrame:
    return df.select("inventory_snapshot_id", "snapshot_date", "warehouse_id", "product_id",
                     "quantity_on_hand", "quantity_reserved", "quantity_available",
                     "safety_stock", "reorder_point", "inventory_value")


def stg_purchase_orders(df: DataFrame) -> DataFrame:
    return df.select("purchase_order_id", "supplier_id", "product_id", "warehouse_id",
                     "order_date", "expected_receipt_date", "actual_receipt_date",
                     "quantity_ordered", "quantity_received", "unit_cost_sgd", "total_cost_sgd",
                     "po_status", "demand_tier",
                     F.datediff(F.to_date("expected_receipt_date"), F.to_date("order_date"))
                     .alias("expected_lead_time_days"))


def stg_orders(df: DataFrame) -> DataFrame:
    return df.select("order_id", "customer_id", "order_date", "sales_channel",
                     "payment_method", "order_status",
                     F.col("fulfillment_warehouse_id").alias("warehouse_id"))


def stg_order_items(df: DataFrame) -> DataFrame:
    return df.select("order_item_id", "order_id", "product_id", "warehouse_id", "quantity",
                     "unit_price", "discount_pct", "gross_sales", "discount_amount",
                     "net_sales", "tax_amount", "commission_amount")


def stg_shipments(df: DataFrame) -> DataFrame:
    return df.select("shipment_id", "order_id", "warehouse_id", "carrier", "tracking_number",
                     "service_level", "shipment_status", "is_cross_border", "shipped_date",
                     "delivered_date", "shipping_cost")


def stg_returns(df: DataFrame) -> DataFrame:
    return df.select("return_id", "order_id", "order_item_id", "shipment_id", "product_id",
                     "warehouse_id", "return_date", F.col("quantity").alias("returned_quantity"),
                     "return_reason", F.col("disposition").alias("disposition_code"))


def stg_inventory_movements(df: DataFrame) -> DataFrame:
    return df.select("movement_id", "movement_date", "movement_type", "warehouse_id",
                     "product_id", "quantity", "reference_type", "reference_id")


def stg_marketing_spend(df: DataFrame) -> DataFrame:
    return df.select("marketing_spend_id", "date", "campaign_id", "campaign_name", "channel",
                     "platform", "spend_sgd", "impressions", "clicks", "click_through_rate",
                     "cost_per_click_sgd")


def stg_acquisition_attribution(df: DataFrame) -> DataFrame:
    return df.select("customer_id", "acquisition_campaign_id")


def stg_ar_invoices(df: DataFrame) -> DataFrame:
    return df.select("invoice_id", "order_id", "customer_id", "payment_terms_code",
                     "invoice_date", "due_date", "invoice_amount", "amount_paid",
                     "payment_date", "invoice_status")


STAGING = {
    "stg_suppliers": ("suppliers", stg_suppliers),
    "stg_products": ("products", stg_products),
    "stg_customers": ("customers", stg_customers),
    "stg_warehouses": ("warehouses", stg_warehouses),
    "stg_warehouse_product_assignment": ("assignment", stg_warehouse_product_assignment),
    "stg_inventory_snapshot": ("inventory_snapshot", stg_inventory_snapshot),
    "stg_purchase_orders": ("purchase_orders", stg_purchase_orders),
    "stg_orders": ("orders", stg_orders),
    "stg_order_items": ("order_items", stg_order_items),
    "stg_shipments": ("shipments", stg_shipments),
    "stg_returns": ("returns", stg_returns),
    "stg_inventory_movements": ("inventory_movements", stg_inventory_movements),
    "stg_marketing_spend": ("marketing_spend", stg_marketing_spend),
    "stg_acquisition_attribution": ("acquisition_attribution", stg_acquisition_attribution),
    "stg_ar_invoices": ("ar_invoices", stg_ar_invoices),
}


def cleaned_customers(df: DataFrame) -> DataFrame:
    """Dictionary cleaning rules that the staging code never applied:
    ``INITCAP(TRIM(name))``, ``COALESCE(tier, 'Bronze')``, id pattern check."""
    return df.select("customer_id",
                     F.initcap(F.trim("first_name")).alias("first_name"),
                     F.initcap(F.trim("last_name")).alias("last_name"),
                     F.coalesce("loyalty_tier", F.lit("Bronze")).alias("loyalty_tier"),
                     F.col("customer_id").rlike("^CUST-[0-9]+$").alias("customer_id_valid"))


def cleaned_products(df: DataFrame) -> DataFrame:
    return df.select("product_id", F.upper(F.trim("sku_code")).alias("sku_code"),
                     F.round(F.col("msrp_sgd").cast("decimal(18,2)"), 2).alias("msrp_sgd"))


def mask_customers(df: DataFrame) -> DataFrame:
    """PII masking of restricted columns outside production (built-in ``mask``
    for names and phone, ``sha2`` for the e-mail so joins on it still work)."""
    return df.select("customer_id",
                     F.mask("first_name").alias("first_name"),
                     F.mask("last_name").alias("last_name"),
                     F.sha2(F.col("email_address"), 256).alias("email_hash"),
                     F.mask("phone_number", digitChar=F.lit("#")).alias("phone_number"),
                     "customer_country")
