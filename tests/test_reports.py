"""Every filter on every fact's KPIs, the comparison period, the cube's levels."""

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from mercato import oracle as O
from mercato.plans import reports as R
from mercato.sources.tables import TEST_TABLES
from paths import SF_SMALL

NOW, BEFORE = (dt.date(1997, 1, 1), dt.date(1997, 12, 31)), (dt.date(1996, 1, 1), dt.date(1996, 12, 31))
WANTED = {"channel": ["Shopify", "Retail"], "country": ["NATION_1", "NATION_7", "NATION_12", "NATION_20"], "cohort": [dt.date(1995, 1, 1)], "warehouse": ["WH-01", "WH-03"],
          "category": lambda c: c.startswith("S"), "supplier": lambda c: F.right(c, F.lit(1)) == "3", "acquisition_channel": ["Instagram", "TikTok"], "platform": ["Meta"],
          "campaign": lambda c: F.right(c, F.lit(1)).isin("1", "2")}
CUSTOMER = {"country": "customer_country IN ('NATION_1', 'NATION_7', 'NATION_12', 'NATION_20')", "cohort": "date_trunc('month', customer_since) = DATE '1995-01-01'"}
CAMPAIGN = {"acquisition_channel": "acquisition_channel_name IN ('Instagram', 'TikTok')", "platform": "marketing_platform = 'Meta'", "campaign": "regexp_matches(campaign_id, '[12]$')"}
GOODS = {"category": "product_key IN (SELECT product_key FROM dim_product WHERE category_name LIKE 'S%')",
         "supplier": "product_key IN (SELECT product_key FROM dim_product JOIN stg_products USING (product_id) WHERE supplier_id LIKE '%3')",
         "warehouse": "warehouse_key IN (SELECT warehouse_key FROM dim_warehouse WHERE warehouse_id IN ('WH-01', 'WH-03'))"}
BUYERS = {n: f"customer_key IN (SELECT customer_key FROM dim_customer WHERE {w})" for n, w in CUSTOMER.items()} | {
    n: f"customer_key IN (SELECT customer_key FROM dim_customer WHERE acquisition_campaign_key IN (SELECT campaign_key FROM dim_campaign WHERE {w}))" for n, w in CAMPAIGN.items()}
SQL = {
    "sales": ("fact_sales", "order_date", {"net_revenue": "sum(net_revenue_amount)", "completed_orders": "count(DISTINCT CASE WHEN fulfillment_status <> 'Cancelled' THEN order_number END)"},
              {"channel": "sales_channel_code IN ('Shopify', 'Retail')", **GOODS, **BUYERS}),
    "returns": ("fact_returns", "return_date", {"refunds": "sum(refunded_amount)", "units_returned": "sum(returned_quantity)"},
                {"channel": "order_number IN (SELECT order_id FROM stg_orders WHERE sales_channel IN ('Shopify', 'Retail'))", **GOODS, **BUYERS}),
    "purchases": ("fact_purchase_orders", "po_date", {"purchase_orders": "count(*)", "units_ordered": "sum(ordered_quantity)", "received": "count(actual_receipt_date)"},
                  {"category": GOODS["category"], "supplier": "supplier_key IN (SELECT supplier_key FROM dim_supplier WHERE supplier_id LIKE '%3')",
                   "warehouse": GOODS["warehouse"].replace("warehouse_key IN", "destination_warehouse_key IN", 1)}),
    "stock": ("fact_inventory_daily", "balance_date", {"pair_days": "count(*)", "stockout_pair_days": "count(CASE WHEN quantity_on_hand <= 0 THEN 1 END)"}, GOODS),
    "spend": ("fact_marketing_spend", "spend_date", {"spend": "sum(spend_amount)", "clicks": "sum(clicks_count)"},
              {n: f"campaign_key IN (SELECT campaign_key FROM dim_campaign WHERE {w})" for n, w in CAMPAIGN.items()}),
    "customers": ("(SELECT * FROM dim_customer WHERE customer_id <> 'UNKNOWN')", "customer_since", {"new_customers": "count(*)"}, BUYERS),
}
EARLY = {"spend", "customers"}    # their days lie in January 1995


@pytest.fixture(scope="module")
def con():
    """The model's tables, each computed once by the oracle."""
    c = duckdb.connect()
    for t in TEST_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for t in ("fact_sales", "fact_returns", "fact_purchase_orders", "fact_marketing_spend", "fact_inventory_daily", "dim_customer", "dim_campaign", "dim_product", "dim_supplier",
              "dim_warehouse", "stg_orders", "stg_products"):
        c.execute(f"CREATE TABLE kept_{t} AS {O.with_ctes(f'SELECT * FROM {t}')}")
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM kept_{t}")
    return c


@pytest.mark.parametrize("fact, name", [(f, n) for f in R.WAYS for n in [None, *R.WAYS[f]]])
def test_each_filter_on_each_kpi(spark, con, fact, name):
    assert set(SQL[fact][3]) == set(R.WAYS[fact]) and set(WANTED) == set(R.FILTERS)
    rows, date, kpis, clauses = SQL[fact]
    now, before = ((dt.date(1995, 1, 11), dt.date(1995, 1, 25)), (dt.date(1995, 1, 1), dt.date(1995, 1, 10))) if fact in EARLY else (NOW, BEFORE)
    report = R.Report(E._model(spark, SF_SMALL), now, before, {name: WANTED[name]} if name else {})
    got = getattr(report, fact)().first()
    clause = clauses[name] if name else "true"
    for kpi, aggregate in kpis.items():
        for period, (a, b) in (("current", now), ("previous", before)):
            want = con.execute(f"SELECT coalesce({aggregate}, 0) FROM {rows} WHERE {clause} AND {date} BETWEEN DATE '{a}' AND DATE '{b}'").fetchone()[0]
            assert (got[f"{kpi}__{period}"] or 0) == want, (kpi, period)
    assert report.scope(fact) == ([name] if name else [])


def test_scorecard_without_comparison_and_unknown_filter(spark):
    m = E._model(spark, SF_SMALL)
    rows = {r.kpi: r for r in R.Report(m, NOW).scorecard(["sales", "returns"]).collect()}
    assert rows["net_revenue"].current_value > 0 and all(r.previous_value is None and r.change is None for r in rows.values())
    assert rows["average_order_value"].current_value == rows["net_revenue"].current_value / rows["completed_orders"].current_value
    nothing = {r.kpi: r.current_value for r in R.Report(m, NOW, filters={"country": []}).scorecard(["sales"]).collect()}
    assert nothing["net_revenue"] == 0 and nothing["average_order_value"] is None
    with pytest.raises(ValueError, match="no such filter: colour"):
        R.Report(m, NOW, filters={"colour": ["red"]})


def test_every_level_of_the_cube_adds_up(spark):
    m = E._model(spark, SF_SMALL)
    columns = ["category_name", "sales_channel_code", "order_month"]
    sets = [[c for i, c in enumerate(columns) if mask >> i & 1] for mask in range(8)]
    levels = {}
    for r in R.margin_cube(m, sets).collect():
        n, units = levels.get(r.grouping_level, (0, 0))
        levels[r.grouping_level] = n + 1, units + r.units
    assert sorted(levels) == list(range(8)) and len({units for _, units in levels.values()}) == 1
    assert levels[7][0] == 1 < levels[3][0] < levels[1][0] < levels[0][0]
