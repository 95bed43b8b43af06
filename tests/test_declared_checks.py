"""The model's declared data tests are all there, with their severities; a run
stops on a failed one. The set is written out here, apart from the code's own."""

import pytest

from mercato.operators.quality import Check, ChecksFailed, enforce, run_checks
from mercato.plans.quality_suite import INVENTORY_CHECKS, MART_CHECKS, STAGING_CHECKS

KEYS = """
stg_suppliers.supplier_id stg_products.product_id stg_products.sku_code stg_customers.customer_id
stg_warehouses.warehouse_id stg_inventory_snapshot.inventory_snapshot_id stg_purchase_orders.purchase_order_id
stg_orders.order_id stg_order_items.order_item_id stg_shipments.shipment_id stg_returns.return_id
stg_acquisition_attribution.customer_id stg_ar_invoices.invoice_id running_totals.movement_id
dim_date.date_key dim_product.product_key dim_product.product_id dim_customer.customer_key dim_customer.customer_id
dim_warehouse.warehouse_key dim_warehouse.warehouse_id dim_supplier.supplier_key dim_supplier.supplier_id
dim_campaign.campaign_key dim_campaign.campaign_id fact_sales.sales_fact_key
fact_purchase_orders.purchase_order_fact_key fact_returns.return_fact_key fact_inventory_daily.inventory_fact_key
fact_marketing_spend.marketing_spend_key fact_ar_aging_daily.ar_snapshot_key
""".split()
FILLED = """
stg_ar_invoices.order_id stg_ar_invoices.customer_id balance_offset.warehouse_id balance_offset.product_id
dim_campaign.marketing_platform dim_campaign.acquisition_channel_name fact_marketing_spend.campaign_key
fact_marketing_spend.spend_date_key fact_marketing_spend.spend_amount fact_ar_aging_daily.customer_key
fact_ar_aging_daily.snapshot_date_key fact_ar_aging_daily.open_balance_amount fact_ar_aging_daily.days_outstanding
""".split()
REFERENCES = """
stg_warehouse_product_assignment.warehouse_id>stg_warehouses.warehouse_id
stg_warehouse_product_assignment.product_id>stg_products.product_id
stg_order_items.order_id>stg_orders.order_id
fact_sales.product_key>dim_product.product_key fact_sales.customer_key>dim_customer.customer_key
fact_sales.warehouse_key>dim_warehouse.warehouse_key fact_sales.order_date_key>dim_date.date_key
fact_purchase_orders.supplier_key>dim_supplier.supplier_key fact_purchase_orders.product_key>dim_product.product_key
fact_purchase_orders.destination_warehouse_key>dim_warehouse.warehouse_key
fact_returns.customer_key>dim_customer.customer_key fact_returns.product_key>dim_product.product_key
fact_returns.warehouse_key>dim_warehouse.warehouse_key
fact_inventory_daily.product_key>dim_product.product_key
fact_inventory_daily.warehouse_key>dim_warehouse.warehouse_key
fact_inventory_daily.snapshot_date_key>dim_date.date_key
fact_marketing_spend.campaign_key>dim_campaign.campaign_key
fact_ar_aging_daily.customer_key>dim_customer.customer_key
""".split()
VALUES = {
    "stg_warehouses.warehouse_type": {"Distribution Center", "Retail Store", "Returns Center"},
    "stg_purchase_orders.po_status": {"Received", "In Transit"},
    "stg_orders.sales_channel": {"Shopify", "Shopee", "Lazada", "Retail"},
    "dim_campaign.marketing_platform": {"Meta", "TikTok", "Klaviyo", "N/A"},
    "dim_campaign.acquisition_channel_name": {"Facebook Ads", "Instagram", "TikTok", "Email Campaign", "N/A"},
}
NOT_NEGATIVE = ["fact_marketing_spend.spend_amount", "fact_ar_aging_daily.open_balance_amount",
                "fact_ar_aging_daily.days_outstanding"]
WARN_ONLY = {"stg_purchase_orders.po_status"}

CHECKS = STAGING_CHECKS + MART_CHECKS + INVENTORY_CHECKS


def by_test(test):
    return {f"{c.model}.{c.column}": c for c in CHECKS if c.test == test}


def test_every_declared_test_is_there():
    assert set(KEYS) <= set(by_test("unique")) and set(KEYS + FILLED) <= set(by_test("not_null"))
    refers = {f"{c.model}.{c.column}>{c.to[0]}.{c.to[1]}" for c in CHECKS if c.test == "relationships"}
    assert set(REFERENCES) <= refers
    accepted, ranges = by_test("accepted_values"), by_test("accepted_range")
    for name, values in VALUES.items():
        assert set(accepted[name].values) == values
    for name in NOT_NEGATIVE:
        assert ranges[name].min_value == 0 and ranges[name].max_value is None


def test_declared_severities():
    declared = set(KEYS) | set(FILLED) | set(VALUES) | set(NOT_NEGATIVE)
    warns = {f"{c.model}.{c.column}" for c in CHECKS if c.severity == "warn"}
    assert warns & declared == WARN_ONLY


def test_a_failed_check_stops_the_run(spark):
    t = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "id int, v string")
    checks = [Check("t", "id", "unique", "warn"), Check("t", "v", "not_null")]
    rows = {r.check_name: r for r in enforce(run_checks(lambda _: t, checks)).collect()}
    assert rows["unique__t__id"].status == "warn" and rows["unique__t__id"].failing_rows == 1
    with pytest.raises(ChecksFailed, match="not_null__t__id: 1 of 3"):
        enforce(run_checks(lambda _: t, [*checks, Check("t", "id", "not_null")]))


def test_relationships_of_mixed_types_and_empty_tables(spark):
    child = spark.createDataFrame([(1, "x"), (2, "y"), (2, None), (None, "z")], "k bigint, s string")
    a, b = spark.createDataFrame([(1,)], "k bigint"), spark.createDataFrame([("x",), ("x",)], "s string")
    tables = {"child": child, "a": a, "b": b, "none": child.limit(0)}
    checks = [Check(m, c, "relationships", to=to) for m in ("child", "none") for c, to in (("k", ("a", "k")), ("s", ("b", "s")))]
    got = {r.check_name: (r.failing_rows, r.total_rows) for r in run_checks(tables.get, checks).collect()}
    assert got == {"relationships__child__k": (2, 4), "relationships__child__s": (2, 4),
                   "relationships__none__k": (0, 0), "relationships__none__s": (0, 0)}
