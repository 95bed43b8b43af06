"""Hand-written landing tables for edge-case tests (FIXTURES.md §3)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

D = dt.date
TS = dt.datetime

SCHEMAS = {
    "suppliers": "supplier_id string, supplier_name string, supplier_tier string, category_specialty string, "
                 "country string, currency string, payment_terms string, lead_time_days int, "
                 "quality_rating double, preferred_supplier boolean, created_at date",
    "products": "product_id string, sku string, product_name string, category string, brand string, "
                "supplier_id string, base_cost_sgd decimal(18,2), msrp_sgd decimal(18,2), launch_date date, "
                "lifecycle_status string, discontinued_date date, popularity_weight double, return_rate double, "
                "reorder_point int, lead_time_days int, reorder_quantity int",
    "customers": "customer_id string, first_name string, last_name string, email string, phone string, "
                 "country string, gender string, birth_date date, customer_since date, loyalty_tier string, "
                 "acquisition_channel string, customer_status string",
    "warehouses": "warehouse_id string, warehouse_code string, warehouse_name string, warehouse_type string, "
                  "country string, city string, region string, serves_countries string",
    "assignment": "warehouse_id string, product_id string",
    "inventory_snapshot": "inventory_snapshot_id string, snapshot_date date, warehouse_id string, product_id string, "
                          "quantity_on_hand int, quantity_reserved int, quantity_available int, safety_stock int, "
                          "reorder_point int, inventory_value decimal(18,2)",
    "purchase_orders": "purchase_order_id string, supplier_id string, product_id string, warehouse_id string, "
                       "order_date timestamp_ntz, expected_receipt_date timestamp_ntz, "
                       "actual_receipt_date timestamp_ntz, quantity_ordered int, quantity_received int, "
                       "unit_cost_sgd decimal(18,2), total_cost_sgd decimal(18,2), po_status string, "
                       "demand_tier string",
    "orders": "order_id string, customer_id string, order_date timestamp_ntz, sales_channel string, "
              "payment_method string, order_status string, fulfillment_warehouse_id string",
    "order_items": "order_item_id string, order_id string, product_id string, warehouse_id string, quantity int, "
                   "unit_price decimal(18,2), discount_pct double, gross_sales decimal(18,2), "
                   "discount_amount decimal(18,2), net_sales decimal(18,2), tax_amount decimal(18,2), "
                   "commission_amount decimal(18,2)",
    "shipments": "shipment_id string, order_id string, warehouse_id string, carrier string, tracking_number string, "
                 "service_level string, shipment_status string, is_cross_border boolean, "
                 "shipped_date timestamp_ntz, delivered_date timestamp_ntz, shipping_cost decimal(18,2)",
    "returns": "return_id string, order_id string, order_item_id string, shipment_id string, product_id string, "
               "warehouse_id string, return_date timestamp_ntz, quantity int, return_reason string, "
               "disposition string",
    "inventory_movements": "movement_id string, movement_date timestamp_ntz, movement_type string, "
                           "warehouse_id string, product_id string, quantity int, reference_type string, "
                           "reference_id string",
    "marketing_spend": "marketing_spend_id string, date date, campaign_id string, campaign_name string, "
                       "channel string, platform string, spend_sgd decimal(18,2), impressions bigint, "
                       "clicks bigint, click_through_rate double, cost_per_click_sgd decimal(18,2)",
    "acquisition_attribution": "customer_id string, acquisition_campaign_id string",
    "ar_invoices": "invoice_id string, order_id string, customer_id string, payment_terms_code string, "
                   "invoice_date date, due_date date, invoice_amount decimal(18,2), amount_paid decimal(18,2), "
                   "payment_date date, invoice_status string",
}


class FixtureRaw:
    """Stands in for ``RawTables``: landing tables from literal rows."""

    def __init__(self, spark: SparkSession, rows: dict[str, list[tuple]]):
        self.spark = spark
        self.rows = rows

    def raw(self, name: str) -> DataFrame:
        return self.spark.createDataFrame(self.rows.get(name, []), SCHEMAS[name])


def money(x) -> Decimal:
    return Decimal(str(x)).quantize(Decimal("0.01"))


def product(pid, launch, disc=None, cost="10.00", status="Active"):
    return (pid, "SKU-" + pid, " Name " + pid + " ", "Cat", "Brand", "S1", money(cost), money("20.00"),
            launch, status, disc, 1.0, 0.0, 5, 7, 100)
