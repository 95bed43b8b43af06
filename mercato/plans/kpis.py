"""KPIs specified by the reference's documents, and the summary marts its
dashboard specs name. Every ratio is computed from summed components and
divided last (``try_divide``), and inventory KPIs read the piecewise-constant
intervals instead of the dense pair x day fact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions.exprs import MONEY, lit_date, status_by_threshold
from ..operators.core import avg_percent_rank, tier, unique_by
from ..operators.intervals import daily_levels
from .dashboards import period_days, q04_ltv_cac_by_channel
from .model import Model

DBL = "double"


def _period(m: Model, c: str) -> Column:
    return F.col(c).between(lit_date(m.sim_start), lit_date(m.sim_end))


def _ratio(a: str | Column, b: str | Column) -> Column:
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.try_divide(a.cast(DBL), b.cast(DBL))


def _apply_filters(df: DataFrame, filters: dict | None) -> DataFrame:
    """Report filters as parameters: {column: value or list of values}."""
    for c, v in (filters or {}).items():
        df = df.filter(F.col(c).isin(*v) if isinstance(v, (list, tuple, set)) else F.col(c) == v)
    return df


# -- revenue and margin ------------------------------------------------------

def net_revenue_waterfall(m: Model) -> DataFrame:
    """KPI net revenue = gross - discounts - refunds - taxes, by month."""
    fs = m.fact_sales.filter(_period(m, "order_date"))
    sales = fs.groupBy(F.trunc("order_date", "MM").alias("report_month")).agg(
        F.sum("gross_revenue_amount").alias("gross"), F.sum("discount_amount").alias("discounts"),
        F.sum("tax_amount").alias("taxes"))
    fr = m.fact_returns.filter(_period(m, "return_date"))
    rets = fr.groupBy(F.trunc("return_date", "MM").alias("report_month")).agg(
        F.sum("refunded_amount").alias("refunds"))
    j = sales.join(rets, "report_month", "full_outer")
    z = F.lit(0).cast(MONEY)
    g, d, t, r = (F.coalesce(F.col(c), z) for c in ("gross", "discounts", "taxes", "refunds"))
    return j.select("report_month", g.cast(DBL).alias("gross_revenue_amount"),
                    d.cast(DBL).alias("discount_amount"), r.cast(DBL).alias("refunded_amount"),
                    t.cast(DBL).alias("tax_amount"), (g - d - r - t).cast(DBL).alias("kpi_net_revenue_amount"))


def aov_monthly(m: Model, filters: dict | None = None) -> DataFrame:
    fs = _apply_filters(m.fact_sales.filter(_period(m, "order_date")), filters)
    agg = fs.groupBy(F.trunc("order_date", "MM").alias("report_month"), "sales_channel_code").agg(
        F.sum("net_revenue_amount").alias("rev"),
        F.count_distinct(F.when(F.col("fulfillment_status") != "Cancelled", F.col("order_number")))
        .alias("completed_orders"))
    return agg.select("report_month", "sales_channel_code", F.col("rev").cast(DBL).alias("net_revenue_amount"),
                      "completed_orders", _ratio("rev", "completed_orders").alias("average_order_value"))


def gross_margin_monthly(m: Model) -> DataFrame:
    fs = m.fact_sales.filter(_period(m, "order_date"))
    agg = fs.groupBy(F.trunc("order_date", "MM").alias("report_month")).agg(
        F.sum("net_revenue_amount").cast(DBL).alias("net_revenue_amount"),
        F.sum("cogs_amount").cast(DBL).alias("cogs_amount"))
    pct = F.try_divide(F.col("net_revenue_amount") - F.col("cogs_amount"), F.col("net_revenue_amount"))
    return agg.withColumn("gross_margin_pct", pct).withColumn(
        "margin_status", status_by_threshold("gross_margin_pct", C.GROSS_MARGIN_STATUS, C.GROSS_MARGIN_STATUS_ELSE))


def return_rate_weekly(m: Model) -> DataFrame:
    """Returned / sold units by ISO week (Monday) x category."""
    dp = m.dim_product.select("product_key", "category_name")
    fs = m.fact_sales.filter(_period(m, "order_date"))
    sold = (fs.join(dp, "product_key")
            .groupBy(F.trunc("order_date", "week").alias("week_start"), "category_name")
            .agg(F.sum("quantity_ordered").alias("sold_units")))
    fr = m.fact_returns.filter(_period(m, "return_date"))
    ret = (fr.join(dp, "product_key")
           .groupBy(F.trunc("return_date", "week").alias("week_start"), "category_name")
           .agg(F.sum("returned_quantity").alias("returned_units")))
    j = sold.join(ret, ["week_start", "category_name"], "full_outer")
    s = F.coalesce("sold_units", F.lit(0)).cast("bigint")
    r = F.coalesce("returned_units", F.lit(0)).cast("bigint")
    return j.select("week_start", "category_name", s.alias("sold_units"), r.alias("returned_units"),
                    _ratio(r, s).alias("return_rate"))


def margin_matrix(m: Model) -> DataFrame:
    """Category x channel revenue matrix (pivot over the known channel list)."""
    fs = m.fact_sales.filter(_period(m, "order_date"))
    dp = m.dim_product.select("product_key", "category_name")
    channels = sorted(set(C.PRIORITY_CHANNEL.values()))
    pv = (fs.join(dp, "product_key").groupBy("category_name")
          .pivot("sales_channel_code", channels).agg(F.sum("net_revenue_amount")))
    return pv.select("category_name", *[F.coalesce(F.col(c), F.lit(0)).cast(DBL).alias(c.lower())
                                        for c in channels])


def finance_rollup(m: Model) -> DataFrame:
    """Sub-totals over category and channel (GROUPING SETS via rollup)."""
    fs = m.fact_sales.filter(_period(m, "order_date"))
    dp = m.dim_product.select("product_key", "category_name")
    return (fs.join(dp, "product_key")
            .rollup("category_name", "sales_channel_code")
            .agg(F.grouping_id().cast("bigint").alias("grouping_level"),
                 F.sum("net_revenue_amount").cast(DBL).alias("net_revenue_amount"),
                 F.sum("cogs_amount").cast(DBL).alias("cogs_amount"),
                 F.sum("quantity_ordered").cast("bigint").alias("units")))


def spend_by_channel_rollup(m: Model) -> DataFrame:
    camp = m.dim_campaign.select("campaign_key", "acquisition_channel_name")
    return (m.fact_marketing_spend.join(camp, "campaign_key")
            .rollup("acquisition_channel_name")
            .agg(F.grouping_id().cast("bigint").alias("grouping_level"),
                 F.sum("spend_amount").cast(DBL).alias("spend_amount")))


def period_over_period(m: Model) -> DataFrame:
    """Monthly revenue per channel on a dense month x channel grid, with the
    previous month and the same month a year earlier (lag over <= months rows
    per channel)."""
    fs = m.fact_sales.filter(_period(m, "order_date"))
    monthly = fs.groupBy(F.trunc("order_date", "MM").alias("report_month"), "sales_channel_code") \
        .agg(F.sum("net_revenue_amount").alias("rev"))
    # Dense month x channel grid: each channel row explodes its months (no join).
    grid = fs.select("sales_channel_code").distinct().select(
        "sales_channel_code",
        F.explode(F.sequence(lit_date(m.sim_start.replace(day=1)), lit_date(m.sim_end.replace(day=1)),
                             F.expr("INTERVAL 1 MONTH"))).alias("report_month"))
    j = grid.join(monthly, ["report_month", "sales_channel_code"], "left")
    w = Window.partitionBy("sales_channel_code").orderBy("report_month")
    rev = F.coalesce(F.col("rev"), F.lit(0)).cast(DBL)
    j = j.withColumn("net_revenue_amount", rev)
    prev = F.lag("net_revenue_amount", 1).over(w)
    yoy = F.lag("net_revenue_amount", 12).over(w)
    return j.select("report_month", "sales_channel_code", "net_revenue_amount",
                    prev.alias("prev_month_amount"), yoy.alias("prev_year_amount")) \
        .withColumn("mom_change_pct", F.try_divide(F.col("net_revenue_amount") - F.col("prev_month_amount"),
                                                   F.col("prev_month_amount"))) \
        .withColumn("yoy_change_pct", F.try_divide(F.col("net_revenue_amount") - F.col("prev_year_amount"),
                                                   F.col("prev_year_amount")))


# -- customers and marketing ---------------------------------------------------

def ltv_cac_by_channel(m: Model) -> DataFrame:
    q = q04_ltv_cac_by_channel(m)
    cac = F.try_divide(F.col("total_spend_amount"), F.col("attributed_customers").cast(DBL))
    ltv_pc = F.try_divide(F.col("total_ltv_amount"), F.col("attributed_customers").cast(DBL))
    out = q.select("acquisition_channel_name", "marketing_platform", "total_spend_amount",
                   "attributed_customers", "total_ltv_amount", cac.alias("cac"),
                   ltv_pc.alias("ltv_per_customer"))
    out = out.withColumn("ltv_to_cac", F.try_divide(F.col("ltv_per_customer"), F.col("cac")))
    return out.withColumn("ltv_cac_status", status_by_threshold("ltv_to_cac", C.LTV_CAC_STATUS,
                                                                C.LTV_CAC_STATUS_ELSE))


def roas_by_channel(m: Model) -> DataFrame:
    """Revenue of attributed customers / spend, by first-touch channel."""
    camp = m.dim_campaign.filter(F.col("campaign_id") != C.NO_CAMPAIGN_ID) \
        .select("campaign_key", "acquisition_channel_name")
    cust = m.dim_customer.filter(F.col("customer_id") != C.UNKNOWN_ID) \
        .select("customer_key", F.col("acquisition_campaign_key").alias("campaign_key"))
    rev = (m.fact_sales.groupBy("customer_key").agg(F.sum("net_revenue_amount").alias("rev"))
           .join(cust, "customer_key").join(camp, "campaign_key")
           .groupBy("acquisition_channel_name").agg(F.sum("rev").alias("attributed_revenue")))
    spend = (m.fact_marketing_spend.join(camp, "campaign_key")
             .groupBy("acquisition_channel_name").agg(F.sum("spend_amount").alias("spend")))
    j = spend.join(rev, "acquisition_channel_name", "full_outer")
    r = F.coalesce(F.col("attributed_revenue").cast(DBL), F.lit(0.0))
    s = F.coalesce(F.col("spend").cast(DBL), F.lit(0.0))
    return j.select("acquisition_channel_name", r.alias("attributed_revenue"), s.alias("spend_amount"),
                    F.try_divide(r, F.when(s != 0, s)).alias("roas"))


def _orders_with_first(m: Model) -> DataFrame:
    """Non-cancelled orders with the customer's first order date: aggregate +
    join (a hot customer is split by AQE's skew join), not a window over the
    customer."""
    o = (m.stg("stg_orders").filter(F.col("order_status") != "Cancelled")
         .select("order_id", "customer_id", "sales_channel", F.to_date("order_date").alias("order_date")))
    first = o.groupBy("customer_id").agg(F.min("order_date").alias("first_order_date"))
    return o.join(first, "customer_id")


def first_purchase_monthly(m: Model) -> DataFrame:
    o = _orders_with_first(m).filter(_period(m, "order_date"))
    first = F.col("order_date") == F.col("first_order_date")
    return (o.groupBy(F.trunc("order_date", "MM").alias("report_month"), "sales_channel")
            .agg(F.count(F.lit(1)).alias("orders"),
                 F.count(F.when(first, 1)).alias("first_purchase_orders"),
                 F.count_distinct(F.when(first, F.col("customer_id"))).alias("new_customers")))


def repeat_retention_90d(m: Model) -> DataFrame:
    """Per first-order cohort month: customers, and those ordering again
    within 90 days after the first order."""
    o = _orders_with_first(m)
    per_cust = o.groupBy("customer_id", "first_order_date").agg(
        F.min(F.when(F.col("order_date") > F.col("first_order_date"), F.col("order_date"))).alias("second"))
    repeat = F.col("second").isNotNull() & (F.datediff("second", "first_order_date") <= 90)
    agg = per_cust.groupBy(F.trunc("first_order_date", "MM").alias("cohort_month")).agg(
        F.count(F.lit(1)).alias("customers"), F.count(F.when(repeat, 1)).alias("retained_90d"))
    return agg.withColumn("retention_rate", _ratio("retained_90d", "customers"))


def cohort_grid(m: Model) -> DataFrame:
    """LTV by sign-up cohort month x months since sign-up (long form)."""
    cust = m.dim_customer.filter(F.col("customer_id") != C.UNKNOWN_ID) \
        .select("customer_key", F.trunc("customer_since", "MM").alias("cohort_month"))
    fs = m.fact_sales.filter(F.col("customer_key") != C.UNKNOWN_KEY)
    j = fs.join(cust, "customer_key").withColumn(
        "months_since", F.floor(F.months_between(F.trunc("order_date", "MM"), F.col("cohort_month"))).cast("bigint"))
    return (j.groupBy("cohort_month", "months_since")
            .agg(F.count_distinct("customer_key").alias("active_customers"),
                 (F.sum("net_revenue_amount") - F.sum("cogs_amount")).cast(DBL).alias("ltv_amount")))


def marketing_monthly(m: Model) -> DataFrame:
    """Month x platform: spend, impressions, clicks, CTR, CPC, new customers."""
    camp = m.dim_campaign.filter(F.col("campaign_id") != C.NO_CAMPAIGN_ID) \
        .select("campaign_key", "marketing_platform")
    spend = (m.fact_marketing_spend.join(camp, "campaign_key")
             .groupBy(F.trunc("spend_date", "MM").alias("report_month"), "marketing_platform")
             .agg(F.sum("spend_amount").alias("spend"), F.sum("impressions_count").alias("impressions"),
                  F.sum("clicks_count").alias("clicks")))
    cust = m.dim_customer.filter(F.col("customer_id") != C.UNKNOWN_ID)
    new = (cust.join(camp, cust.acquisition_campaign_key == camp.campaign_key)
           .groupBy(F.trunc("customer_since", "MM").alias("report_month"), "marketing_platform")
           .agg(F.count(F.lit(1)).alias("new_customers")))
    j = spend.join(new, ["report_month", "marketing_platform"], "full_outer")
    s = F.coalesce(F.col("spend").cast(DBL), F.lit(0.0))
    return j.select("report_month", "marketing_platform", s.alias("spend_amount"),
                    F.coalesce("impressions", F.lit(0)).cast("bigint").alias("impressions"),
                    F.coalesce("clicks", F.lit(0)).cast("bigint").alias("clicks"),
                    F.coalesce("new_customers", F.lit(0)).cast("bigint").alias("new_customers"),
                    _ratio("clicks", "impressions").alias("click_through_rate"),
                    F.try_divide(s, F.col("clicks").cast(DBL)).alias("cost_per_click"),
                    F.try_divide(s, F.col("new_customers").cast(DBL)).alias("cac"))


def campaigns_without_customers(m: Model) -> DataFrame:
    """Campaigns with spend but no attributed customer (anti join)."""
    spend = m.fact_marketing_spend.groupBy("campaign_key").agg(F.sum("spend_amount").alias("spend"))
    cust = m.dim_customer.filter(F.col("customer_id") != C.UNKNOWN_ID) \
        .select(F.col("acquisition_campaign_key").alias("campaign_key"))
    camp = m.dim_campaign.filter(F.col("campaign_id") != C.NO_CAMPAIGN_ID)
    return (camp.join(spend, "campaign_key").join(cust, "campaign_key", "left_anti")
            .select("campaign_id", "campaign_name", "acquisition_channel_name",
                    F.col("spend").cast(DBL).alias("spend_amount")))


# -- receivables -----------------------------------------------------------------

def dso_monthly(m: Model) -> DataFrame:
    """DSO = average daily AR / (credit sales / days), per month (semi-additive:
    daily totals are averaged over the days, never summed over time). Sums stay
    exact decimals until the final division."""
    ds = period_days(m)
    ar = m.ar_balance_levels().select(F.col("snapshot_date").alias("report_date"), "open_balance_amount")
    credit = (m.fact_sales.filter(F.col("payment_terms_code") != C.DEFAULT_PAYMENT_TERMS)
              .groupBy(F.col("order_date").alias("report_date"))
              .agg(F.sum("net_revenue_amount").alias("credit")))
    agg = (ds.join(ar, "report_date", "left").join(credit, "report_date", "left")
           .groupBy(F.trunc("report_date", "MM").alias("report_month"))
           .agg(F.sum("open_balance_amount").alias("ar_days"), F.sum("credit").alias("credit"),
                F.count(F.lit(1)).alias("days")))
    avg_ar = F.coalesce(F.col("ar_days"), F.lit(0)).cast(DBL) / F.col("days").cast(DBL)
    credit_d = F.coalesce(F.col("credit"), F.lit(0)).cast(DBL)
    return agg.select("report_month", avg_ar.alias("avg_daily_ar"), credit_d.alias("credit_net_revenue_amount"),
                      "days").withColumn(
        "dso_days", F.try_divide(F.col("avg_daily_ar"),
                                 F.try_divide(F.col("credit_net_revenue_amount"), F.col("days").cast(DBL))))


def ar_position_at(m: Model, day=None) -> DataFrame:
    """Open balance and age of every invoice open on ``day`` (default: the
    last report day), straight from the invoices: no daily spine."""
    day = lit_date(day or m.sim_end)
    inv = m.stg("stg_ar_invoices")
    stop = F.least(F.coalesce("payment_date", day), day)
    covered = (F.col("invoice_date") <= day) & (stop >= day)
    paid_before = F.col("payment_date").isNull() | (day < F.col("payment_date"))
    bal = F.when(paid_before, F.col("invoice_amount")).otherwise(F.col("invoice_amount") - F.col("amount_paid"))
    age = F.datediff(day, F.col("invoice_date"))
    return inv.filter(covered).select("invoice_id", "customer_id", "payment_terms_code", bal.cast(MONEY).alias("open_balance_amount"),
                                      age.alias("days_outstanding"),
                                      F.when(age > 90, "90+").when(age > 60, "61-90").otherwise("Current")
                                      .alias("ar_status"))


def ar_accounts_top15(m: Model, n: int = 15) -> DataFrame:
    """Accounts by open balance, for collection: the age and the payment terms
    are those of the oldest open invoice."""
    pos = ar_position_at(m)
    agg = pos.groupBy("customer_id").agg(
        F.sum("open_balance_amount").alias("open_ar"), F.count(F.lit(1)).alias("open_invoices"),
        F.count(F.when(F.col("days_outstanding") > 90, 1)).alias("invoices_90_plus"),
        F.max("days_outstanding").alias("max_days_outstanding"),
        F.min_by("payment_terms_code", F.struct(-F.col("days_outstanding"), F.col("invoice_id"))).alias("payment_terms_code"))
    agg = agg.withColumn("account_status", F.when(F.col("max_days_outstanding") > 90, "90+")
                         .when(F.col("max_days_outstanding") > 60, "61-90").otherwise("Current"))
    return (agg.select("customer_id", F.col("open_ar").cast(DBL).alias("open_ar_amount"), "open_invoices",
                       "invoices_90_plus", "max_days_outstanding", "payment_terms_code", "account_status")
            .orderBy(F.desc("open_ar_amount"), "customer_id").limit(n))


def ar_aging_mix_monthly(m: Model) -> DataFrame:
    """Aging-bucket mix by month: average daily amount of each bucket over the
    days with open invoices (balances don't add up over time)."""
    lv = m.ar_bucket_levels()
    b = [name for name, _, _ in m.AGING_BUCKETS]
    return (lv.filter(F.col("open_rows") > 0)
            .groupBy(F.trunc("snapshot_date", "MM").alias("report_month"))
            .agg(*[(F.sum(c).cast(DBL) / F.count(F.lit(1)).cast(DBL)).alias(f"avg_{c}") for c in b],
                 F.count(F.lit(1)).alias("days")))


def ar_monthly_by_customer(m: Model) -> DataFrame:
    """AR summary month x customer: average daily open balance (sweep)."""
    lv = m.ar_balance_levels(by=("customer_id",))
    return (lv.groupBy(F.trunc("snapshot_date", "MM").alias("report_month"), "customer_id")
            .agg(F.sum("open_balance_amount").alias("sum_balance"), F.count(F.lit(1)).alias("days_open"))
            .select("report_month", "customer_id", F.col("sum_balance").cast(DBL).alias("balance_day_sum"),
                    "days_open"))


# -- supply chain ------------------------------------------------------------------

def supplier_scorecard(m: Model) -> DataFrame:
    po = m.fact_purchase_orders
    received = F.col("actual_receipt_date").isNotNull()
    on_time = received & (F.to_date("actual_receipt_date") <= F.col("expected_date"))
    ds = m.dim_supplier.select("supplier_key", "supplier_id")
    agg = po.groupBy("supplier_key").agg(
        F.count(F.lit(1)).alias("po_count"), F.count(F.when(received, 1)).alias("received_count"),
        F.count(F.when(on_time, 1)).alias("on_time_count"),
        F.sum(F.when(received, F.datediff(F.to_date("actual_receipt_date"), F.col("po_date")))).alias("lead_days"),
        F.sum("purchase_price_variance_amount").alias("ppv"))
    return agg.join(ds, "supplier_key", "left").select(
        "supplier_id", "po_count", "received_count", "on_time_count",
        _ratio("on_time_count", "received_count").alias("on_time_rate"),
        _ratio("lead_days", "received_count").alias("avg_actual_lead_days"),
        F.col("ppv").cast(DBL).alias("ppv_amount"))


def supplier_top15(m: Model, n: int = 15) -> DataFrame:
    top = supplier_scorecard(m).orderBy(F.desc_nulls_last("on_time_rate"), "ppv_amount", "supplier_id").limit(n)
    w = Window.orderBy(F.desc_nulls_last("on_time_rate"))   # over the N rows only
    return top.withColumn("supplier_rank", F.dense_rank().over(w).cast("bigint"))


def returns_by_warehouse(m: Model) -> DataFrame:
    """Disposition mix (pivot) plus refunds and fees per warehouse."""
    fr = m.fact_returns
    dw = m.dim_warehouse.select("warehouse_key", "warehouse_id")
    base = fr.join(dw, "warehouse_key", "left")
    pv = base.groupBy("warehouse_id").pivot("disposition_code", C.DISPOSITIONS).agg(F.sum("returned_quantity"))
    money = base.groupBy("warehouse_id").agg(F.sum("refunded_amount").alias("refunds"),
                                             F.sum("restocking_fee_amount").alias("fees"))
    return pv.join(money, "warehouse_id").select(
        "warehouse_id", *[F.coalesce(F.col(d), F.lit(0)).cast("bigint").alias(d.lower() + "_units")
                          for d in C.DISPOSITIONS],
        F.col("refunds").cast(DBL).alias("refunded_amount"), F.col("fees").cast(DBL).alias("restocking_fee_amount"),
        (F.col("refunds") - F.col("fees")).cast(DBL).alias("margin_erosion_amount"))


def margin_erosion_top10(m: Model, n: int = 10) -> DataFrame:
    fr = m.fact_returns
    dp = m.dim_product.select("product_key", "sku_code", "product_name")
    agg = fr.groupBy("product_key").agg(F.sum("refunded_amount").alias("refunds"),
                                        F.sum("restocking_fee_amount").alias("fees"))
    return (agg.join(dp, "product_key")
            .select("sku_code", "product_name", F.col("refunds").cast(DBL).alias("refunded_amount"),
                    F.col("fees").cast(DBL).alias("restocking_fee_amount"),
                    (F.col("refunds") - F.col("fees")).cast(DBL).alias("margin_erosion_amount"))
            .orderBy(F.desc("margin_erosion_amount"), "sku_code").limit(n))


def shipping_analysis(m: Model) -> DataFrame:
    s = m.stg("stg_shipments")
    days = F.datediff(F.to_date("delivered_date"), F.to_date("shipped_date"))
    return s.groupBy("carrier", "service_level").agg(
        F.count(F.lit(1)).alias("shipments"),
        F.count(F.when(F.col("is_cross_border"), 1)).alias("cross_border_shipments"),
        F.sum("shipping_cost").cast(DBL).alias("shipping_cost"),
        F.avg(days).alias("avg_delivery_days")).withColumn(
        "cross_border_share", _ratio("cross_border_shipments", "shipments"))


def reorder_quantities(m: Model) -> DataFrame:
    """Demand tier and demand-scaled reorder quantity = 150 + rank x 1050."""
    p = m.stg("stg_products").select("product_id", "popularity_weight")
    r = avg_percent_rank(p, "popularity_weight", "popularity_pct_rank")
    return r.select("product_id", "popularity_pct_rank", tier("popularity_pct_rank").alias("demand_tier"),
                    F.floor(F.lit(150) + F.col("popularity_pct_rank") * 1050).cast("bigint")
                    .alias("reorder_quantity"))


def inventory_position(m: Model) -> DataFrame:
    """Per warehouse: snapshot on hand, allocated (reserved), available, value,
    and quantity in transit (open purchase orders)."""
    s = m.stg("stg_inventory_snapshot").groupBy("warehouse_id").agg(
        F.sum("quantity_on_hand").alias("on_hand"), F.sum("quantity_reserved").alias("allocated"),
        F.sum("quantity_available").alias("available"), F.sum("inventory_value").alias("value"))
    po = (m.stg("stg_purchase_orders").filter(F.col("po_status") == "In Transit")
          .groupBy("warehouse_id").agg(F.sum("quantity_ordered").alias("in_transit")))
    return s.join(po, "warehouse_id", "full_outer").select(
        "warehouse_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c + "_qty")
                          for c in ("on_hand", "allocated", "available", "in_transit")],
        F.coalesce(F.col("value").cast(DBL), F.lit(0.0)).alias("inventory_value"))


def _interval_days(m: Model) -> DataFrame:
    iv = m.inventory_intervals.filter(F.col("valid_from") <= F.col("valid_to"))
    return iv.withColumn("__days", F.datediff("valid_to", "valid_from") + 1)


def stockout_days_top15(m: Model, n: int = 15) -> DataFrame:
    """Top products by pair-days out of stock (interval lengths, no spine)."""
    iv = _interval_days(m).filter(F.col("quantity_on_hand") <= 0)
    dp = m.dim_product.select("product_id", "sku_code", "category_name")
    agg = iv.groupBy("product_id").agg(F.sum("__days").cast("bigint").alias("stockout_days"))
    return (agg.join(dp, "product_id").select("sku_code", "category_name", "stockout_days")
            .orderBy(F.desc("stockout_days"), "sku_code").limit(n))


def sell_through(m: Model) -> DataFrame:
    """Per pair: units sold in the window / (sold + time-weighted average on hand)."""
    iv = _interval_days(m)
    in_window = F.col("day").isNotNull() & (F.col("day") == F.col("valid_from"))
    agg = iv.groupBy("warehouse_id", "product_id").agg(
        F.sum(F.when(in_window, F.col("units_sold_qty")).otherwise(0)).alias("sold"),
        F.sum(F.col("quantity_on_hand") * F.col("__days")).alias("on_hand_days"),
        F.sum("__days").alias("days"))
    avg_on_hand = F.try_divide(F.col("on_hand_days").cast(DBL), F.col("days").cast(DBL))
    return agg.select("warehouse_id", "product_id", F.col("sold").cast("bigint").alias("units_sold"),
                      avg_on_hand.alias("avg_on_hand")).withColumn(
        "sell_through_rate", F.try_divide(F.col("units_sold").cast(DBL),
                                          F.col("units_sold").cast(DBL) + F.col("avg_on_hand")))


def _daily_sold_by(m: Model, by: Sequence[str]) -> DataFrame:
    iv = m.inventory_intervals
    change_in_window = F.col("day").isNotNull() & (F.col("day") == F.col("valid_from")) & \
        (F.col("valid_from") <= F.col("valid_to"))
    return (iv.filter(change_in_window).groupBy(*by, F.col("day").alias("balance_date"))
            .agg(F.sum("units_sold_qty").alias("units_sold")))


def days_of_supply(m: Model) -> DataFrame:
    """Warehouse x day: on hand, trailing 30-day units sold, days of supply."""
    lv = m.inventory_levels(by=("warehouse_id",))
    sold = _daily_sold_by(m, ["warehouse_id"])
    j = lv.join(sold, ["warehouse_id", "balance_date"], "left").withColumn(
        "units_sold", F.coalesce("units_sold", F.lit(0)).cast("bigint"))
    dn = F.datediff("balance_date", F.lit("1970-01-01").cast("date"))
    w = Window.partitionBy("warehouse_id").orderBy(dn).rangeBetween(-29, 0)
    j = j.withColumn("sold_30d", F.sum("units_sold").over(w).cast("bigint"))
    return j.select("warehouse_id", "balance_date", "quantity_on_hand", "units_sold", "sold_30d",
                    F.try_divide(F.col("quantity_on_hand").cast(DBL), F.col("sold_30d") / 30.0)
                    .alias("days_of_supply"))


def stockout_rate_daily(m: Model) -> DataFrame:
    lv = m.inventory_levels(by=("warehouse_id",))
    return lv.select("warehouse_id", "balance_date", "active_pairs", "stockout_pairs",
                     _ratio("stockout_pairs", "active_pairs").alias("stockout_rate"))


def stockout_by_category_daily(m: Model) -> DataFrame:
    """Stockout summary mart: date x warehouse x category."""
    iv = m.inventory_intervals.join(m.dim_product.select("product_id", "category_name"), "product_id")
    return daily_levels(
        iv, ["warehouse_id", "category_name"], "valid_from", "valid_to",
        {"active_pairs": F.lit(1).cast("bigint"),
         "stockout_pairs": F.when(F.col("quantity_on_hand") <= 0, 1).otherwise(0).cast("bigint")},
        m.sim_start, m.sim_end, day="balance_date")


def inventory_turnover_monthly(m: Model) -> DataFrame:
    """Month x warehouse: COGS / average daily inventory value (value = on hand
    x current unit cost, from intervals)."""
    iv = m.inventory_intervals.join(m.dim_product.select("product_id", "base_cost_sgd"), "product_id")
    val = daily_levels(iv, ["warehouse_id"], "valid_from", "valid_to",
                       {"inventory_value": (F.col("quantity_on_hand") * F.col("base_cost_sgd")).cast("decimal(28,2)"),
                        "active_pairs": F.lit(1).cast("bigint")},
                       m.sim_start, m.sim_end, day="balance_date")
    avg_val = val.groupBy("warehouse_id", F.trunc("balance_date", "MM").alias("report_month")).agg(
        F.sum("inventory_value").alias("value_days"), F.count(F.lit(1)).alias("days"))
    dw = m.dim_warehouse.select("warehouse_key", "warehouse_id")
    cogs = (m.fact_sales.filter(_period(m, "order_date")).join(dw, "warehouse_key")
            .groupBy("warehouse_id", F.trunc("order_date", "MM").alias("report_month"))
            .agg(F.sum("cogs_amount").alias("cogs")))
    j = avg_val.join(cogs, ["warehouse_id", "report_month"], "full_outer")
    avg_value = F.try_divide(F.col("value_days").cast(DBL), F.col("days").cast(DBL))
    c = F.coalesce(F.col("cogs").cast(DBL), F.lit(0.0))
    return j.select("warehouse_id", "report_month", c.alias("cogs_amount"), avg_value.alias("avg_inventory_value"),
                    F.try_divide(c, avg_value).alias("inventory_turnover"))


# -- summary marts ---------------------------------------------------------------

def executive_daily(m: Model) -> DataFrame:
    """Executive KPI mart: date x channel."""
    fs = m.fact_sales.filter(_period(m, "order_date"))
    sales = fs.groupBy(F.col("order_date").alias("report_date"), "sales_channel_code").agg(
        F.sum("net_revenue_amount").alias("rev"), F.sum("cogs_amount").alias("cogs"),
        F.sum("quantity_ordered").alias("units"),
        F.count_distinct(F.when(F.col("fulfillment_status") != "Cancelled", F.col("order_number")))
        .alias("completed_orders"))
    # a return's order may lie outside the period: its channel comes from all sales
    oc = m.fact_sales.select(F.col("order_number").alias("order_id"), "sales_channel_code").distinct()
    fr = m.fact_returns.filter(_period(m, "return_date"))
    rets = (fr.join(oc, fr.order_number == oc.order_id)
            .groupBy(F.col("return_date").alias("report_date"), "sales_channel_code")
            .agg(F.sum("returned_quantity").alias("returned")))
    j = sales.join(rets, ["report_date", "sales_channel_code"], "full_outer")
    return j.select("report_date", "sales_channel_code",
                    F.coalesce(F.col("rev").cast(DBL), F.lit(0.0)).alias("net_revenue_amount"),
                    F.coalesce(F.col("cogs").cast(DBL), F.lit(0.0)).alias("cogs_amount"),
                    F.coalesce("units", F.lit(0)).cast("bigint").alias("sold_units"),
                    F.coalesce("completed_orders", F.lit(0)).cast("bigint").alias("completed_orders"),
                    F.coalesce("returned", F.lit(0)).cast("bigint").alias("returned_units"))


def sales_by_region_daily(m: Model) -> DataFrame:
    fs = m.fact_sales.filter(_period(m, "order_date"))
    dw = m.dim_warehouse.select("warehouse_key", "warehouse_region")
    return (fs.join(dw, "warehouse_key")
            .groupBy(F.col("order_date").alias("report_date"), "sales_channel_code", "warehouse_region")
            .agg(F.sum("net_revenue_amount").cast(DBL).alias("net_revenue_amount"),
                 F.sum("quantity_ordered").cast("bigint").alias("sold_units")))


def po_summary(m: Model) -> DataFrame:
    po = m.fact_purchase_orders
    ds = m.dim_supplier.select("supplier_key", "supplier_id")
    dw = m.dim_warehouse.select(F.col("warehouse_key").alias("destination_warehouse_key"), "warehouse_id")
    return (po.join(ds, "supplier_key", "left").join(dw, "destination_warehouse_key", "left")
            .groupBy("supplier_id", "warehouse_id")
            .agg(F.count(F.lit(1)).alias("po_count"),
                 F.sum("ordered_quantity").cast("bigint").alias("ordered_quantity"),
                 F.sum("received_quantity").cast("bigint").alias("received_quantity"),
                 F.sum("total_purchase_cost_amount").cast(DBL).alias("total_purchase_cost_amount"),
                 F.sum("purchase_price_variance_amount").cast(DBL).alias("ppv_amount")))


def purchase_orders_detail(m: Model) -> DataFrame:
    """Purchase order x supplier x warehouse: what is still to come, and whether it came late."""
    ds = m.dim_supplier.select("supplier_key", "supplier_id")
    dw = m.dim_warehouse.select(F.col("warehouse_key").alias("destination_warehouse_key"), "warehouse_id")
    late = F.datediff(F.to_date("actual_receipt_date"), "expected_date")
    return (m.fact_purchase_orders.join(ds, "supplier_key", "left").join(dw, "destination_warehouse_key", "left")
            .select("po_number", "supplier_id", "warehouse_id", "po_date", "po_status_code",
                    F.col("ordered_quantity").cast("bigint").alias("ordered_quantity"),
                    F.coalesce("received_quantity", F.lit(0)).cast("bigint").alias("received_quantity"),
                    (F.col("ordered_quantity") - F.coalesce("received_quantity", F.lit(0))).cast("bigint").alias("open_quantity"),
                    F.greatest(late, F.lit(0)).cast("bigint").alias("days_late"),
                    F.col("total_purchase_cost_amount").cast(DBL).alias("total_purchase_cost_amount")))


def finance_daily(m: Model, filters: dict | None = None) -> DataFrame:
    """Date x category x channel x product: revenue, cost and margin."""
    dp = m.dim_product.select("product_key", "product_id", "category_name")
    sold = m.fact_sales.filter(_period(m, "order_date")).groupBy("order_date", "product_key", "sales_channel_code").agg(
        F.sum("net_revenue_amount").alias("net"), F.sum("cogs_amount").alias("cogs"),
        F.sum("quantity_ordered").cast("bigint").alias("units"))
    return (_apply_filters(sold.join(dp, "product_key"), filters)
            .select(F.col("order_date").alias("report_date"), "category_name", "sales_channel_code", "product_id",
                    F.col("net").cast(DBL).alias("net_revenue_amount"), F.col("cogs").cast(DBL).alias("cogs_amount"),
                    (F.col("net") - F.col("cogs")).cast(DBL).alias("gross_margin_amount"), "units"))


def returns_by_channel_daily(m: Model) -> DataFrame:
    """Returns by day and by the channel of the order they belong to; returned
    orders are summed before they meet their channel."""
    fr = (m.fact_returns.filter(_period(m, "return_date")).groupBy("return_date", F.col("order_number").alias("order_id"))
          .agg(F.sum("returned_quantity").alias("units"), F.sum("refunded_amount").alias("refunds")))
    o = unique_by(m.stg("stg_orders"), "order_id", ["sales_channel"])
    return (fr.join(o, "order_id", "left").groupBy("return_date", "sales_channel")
            .agg(F.count(F.lit(1)).alias("returned_orders"), F.sum("units").cast("bigint").alias("returned_units"),
                 F.sum("refunds").cast(DBL).alias("refunded_amount")))


def weekly_spend_and_customers(m: Model) -> DataFrame:
    """Campaign spend and the customers who signed up, week by week (from Monday)."""
    spend = (m.fact_marketing_spend.groupBy(F.trunc("spend_date", "WEEK").alias("week_start"))
             .agg(F.sum("spend_amount").alias("spend")))
    new = (m.dim_customer.filter((F.col("customer_id") != C.UNKNOWN_ID) & F.col("customer_since").isNotNull())
           .groupBy(F.trunc("customer_since", "WEEK").alias("week_start"))
           .agg(F.count(F.lit(1)).alias("all_new"),
                F.count(F.when(F.col("acquisition_campaign_key") != C.UNKNOWN_KEY, 1)).alias("paid_new")))
    paid = F.coalesce("paid_new", F.lit(0))
    return spend.join(new, "week_start", "full_outer").select(
        "week_start", F.coalesce(F.col("spend").cast(DBL), F.lit(0.0)).alias("spend_amount"),
        F.coalesce("all_new", F.lit(0)).alias("new_customers"), paid.alias("campaign_customers"),
        F.try_divide(F.coalesce(F.col("spend").cast(DBL), F.lit(0.0)), paid.cast(DBL)).alias("spend_per_campaign_customer"))


def returns_daily(m: Model) -> DataFrame:
    fr = m.fact_returns.filter(_period(m, "return_date"))
    return (fr.groupBy("return_date", "product_key", "warehouse_key")
            .agg(F.sum("returned_quantity").cast("bigint").alias("returned_units"),
                 F.sum("refunded_amount").cast(DBL).alias("refunded_amount"),
                 F.sum("restocking_fee_amount").cast(DBL).alias("restocking_fee_amount")))


def spend_daily_by_campaign(m: Model) -> DataFrame:
    """Spend and CAC mart: date x campaign x platform, with customers who
    signed up that day attributed to the campaign."""
    camp = m.dim_campaign.filter(F.col("campaign_id") != C.NO_CAMPAIGN_ID) \
        .select("campaign_key", "campaign_id", "marketing_platform")
    spend = (m.fact_marketing_spend.join(camp, "campaign_key")
             .groupBy(F.col("spend_date").alias("report_date"), "campaign_id", "marketing_platform")
             .agg(F.sum("spend_amount").alias("spend"), F.sum("clicks_count").alias("clicks")))
    cust = m.dim_customer.filter(F.col("customer_id") != C.UNKNOWN_ID)
    new = (cust.join(camp, cust.acquisition_campaign_key == camp.campaign_key)
           .groupBy(F.col("customer_since").alias("report_date"), "campaign_id", "marketing_platform")
           .agg(F.count(F.lit(1)).alias("new_customers")))
    j = spend.join(new, ["report_date", "campaign_id", "marketing_platform"], "full_outer")
    s = F.coalesce(F.col("spend").cast(DBL), F.lit(0.0))
    n = F.coalesce("new_customers", F.lit(0)).cast("bigint")
    return j.select("report_date", "campaign_id", "marketing_platform", s.alias("spend_amount"),
                    F.coalesce("clicks", F.lit(0)).cast("bigint").alias("clicks"), n.alias("new_customers"),
                    F.try_divide(s, n.cast(DBL)).alias("cac"))


def frequency_tables(m: Model) -> DataFrame:
    """Value counts of the main categorical columns (one long table)."""
    parts = [
        m.stg("stg_orders").groupBy(F.lit("order_status").alias("attribute"),
                                    F.col("order_status").alias("value")).count(),
        m.stg("stg_orders").groupBy(F.lit("order_month").alias("attribute"),
                                    F.date_format("order_date", "yyyy-MM").alias("value")).count(),
        m.stg("stg_purchase_orders").groupBy(F.lit("po_status").alias("attribute"),
                                             F.col("po_status").alias("value")).count(),
        m.stg("stg_purchase_orders").groupBy(F.lit("demand_tier").alias("attribute"),
                                             F.col("demand_tier").alias("value")).count(),
        m.stg("stg_ar_invoices").groupBy(F.lit("invoice_status").alias("attribute"),
                                         F.col("invoice_status").alias("value")).count(),
        m.stg("stg_inventory_movements").groupBy(F.lit("movement_type").alias("attribute"),
                                                 F.col("movement_type").alias("value")).count(),
        m.stg("stg_products").groupBy(F.lit("lifecycle_status").alias("attribute"),
                                      F.col("lifecycle_status").alias("value")).count(),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("attribute", "value", F.col("count").cast("bigint").alias("n"))


def order_warehouses(m: Model) -> DataFrame:
    """Warehouses that fulfil each order, as a sorted set. The set is bounded
    by the warehouse dimension whatever the size of the order (a per-order set
    of products would not be: one order may hold a third of all lines)."""
    oi = m.stg("stg_order_items")
    return oi.groupBy("order_id").agg(
        F.array_join(F.array_sort(F.collect_set("warehouse_id")), "|").alias("warehouses"),
        F.count(F.lit(1)).alias("lines"))


def margin_filtered(m: Model, filters: dict | None = None) -> DataFrame:
    """Q06 parts with report filters (channel, country, category, ...)."""
    fs = m.fact_sales.filter(_period(m, "order_date"))
    dp = m.dim_product.filter(F.col("product_id") != C.UNKNOWN_ID).select("product_key", "category_name")
    dc = m.dim_customer.select("customer_key", "customer_country")
    j = _apply_filters(fs.join(dp, "product_key").join(dc, "customer_key"), filters)
    return (j.groupBy("category_name", "sales_channel_code")
            .agg(F.sum("net_revenue_amount").cast(DBL).alias("net_revenue_amount"),
                 F.sum("cogs_amount").cast(DBL).alias("cogs_amount")))



# -- specified without source data: fixture-tested functions --------------------------

def manufacturing_kpis(batches: DataFrame) -> DataFrame:
    """Per (supplier, product): defect rate, QA pass rate, unit batch cost and
    data completeness. ``batches``: batch_id, supplier_id, product_id,
    units_produced, units_defective, qa_passed (bool), batch_cost."""
    fields = ["units_produced", "units_defective", "qa_passed", "batch_cost"]
    complete = F.lit(True)
    for c in fields:
        complete = complete & F.col(c).isNotNull()
    agg = batches.groupBy("supplier_id", "product_id").agg(
        F.count(F.lit(1)).alias("batches"), F.sum("units_produced").alias("units_produced"),
        F.sum("units_defective").alias("units_defective"),
        F.count(F.when(F.col("qa_passed"), 1)).alias("qa_passed_batches"),
        F.count(F.when(F.col("qa_passed").isNotNull(), 1)).alias("qa_checked_batches"),
        F.sum("batch_cost").alias("batch_cost"), F.count(F.when(complete, 1)).alias("complete_batches"))
    return agg.select(
        "supplier_id", "product_id", "batches",
        _ratio("units_defective", "units_produced").alias("defect_rate"),
        _ratio("qa_passed_batches", "qa_checked_batches").alias("qa_pass_rate"),
        _ratio("batch_cost", "units_produced").alias("unit_batch_cost"),
        _ratio("complete_batches", "batches").alias("data_completeness"))


# Chosen values (not from the reference): variance status bands (absolute %).
VARIANCE_BANDS = [(0.02, "Reconciled"), (0.05, "Review")]
VARIANCE_ELSE = "Investigate"


def source_variance(a: DataFrame, b: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Variance between two sources of one measure (e.g. marketplace
    preliminary vs reconciled revenue, platform-reported vs first-party
    conversions): full outer join on the keys, missing side = 0."""
    j = (a.select(*keys, F.col(measure).alias("source_a"))
         .join(b.select(*keys, F.col(measure).alias("source_b")), list(keys), "full_outer"))
    sa = F.coalesce(F.col("source_a").cast(DBL), F.lit(0.0))
    sb = F.coalesce(F.col("source_b").cast(DBL), F.lit(0.0))
    pct = F.try_divide(sb - sa, F.when(sa != 0, sa))
    expr = F.when(pct.isNull(), F.when(sb == sa, "Reconciled").otherwise(VARIANCE_ELSE))
    for hi, label in VARIANCE_BANDS:
        expr = expr.when(F.abs(pct) <= hi, label)
    return j.select(*keys, sa.alias("source_a"), sb.alias("source_b"), (sb - sa).alias("variance"),
                    pct.alias("variance_pct"), expr.otherwise(VARIANCE_ELSE).alias("variance_status"))


# -- further specified checks and KPIs ------------------------------------------------

def sold_outside_lifecycle(m: Model) -> DataFrame:
    """Temporal validity: lines ordered before the product's launch or after
    its discontinuation (open end = far future)."""
    dp = m.dim_product.select("product_key", "launch_date", "discontinued_date")
    j = m.fact_sales.select("product_key", "order_date").join(dp, "product_key", "left")
    end = F.coalesce(F.col("discontinued_date"), F.lit("9999-12-31").cast("date"))
    return j.agg(F.count(F.when(F.col("order_date") < F.col("launch_date"), 1)).alias("lines_before_launch"),
                 F.count(F.when(F.col("order_date") > end, 1)).alias("lines_after_discontinued"),
                 F.count(F.lit(1)).alias("total_lines"))


def stockout_with_inbound(m: Model) -> DataFrame:
    """Pairs at zero (or below) on their last day with stock in transit."""
    iv = m.inventory_intervals.filter(F.col("valid_from") <= F.col("valid_to"))
    last = iv.groupBy("warehouse_id", "product_id").agg(
        F.max("valid_to").alias("last_day"), F.max_by("quantity_on_hand", "valid_to").alias("quantity_on_hand"))
    inbound = (m.stg("stg_purchase_orders").filter(F.col("po_status") == "In Transit")
               .groupBy("warehouse_id", "product_id").agg(F.sum("quantity_ordered").alias("in_transit_qty")))
    return (last.filter(F.col("quantity_on_hand") <= 0).join(inbound, ["warehouse_id", "product_id"])
            .select("warehouse_id", "product_id", "last_day", F.col("quantity_on_hand").cast("bigint"),
                    F.col("in_transit_qty").cast("bigint")))


def campaign_constancy(m: Model) -> DataFrame:
    """``any_value`` is only safe when the attribute is constant per campaign."""
    ms = m.stg("stg_marketing_spend")
    per = ms.groupBy("campaign_id").agg(F.count_distinct("campaign_name").alias("names"),
                                        F.count_distinct("channel").alias("channels"),
                                        F.count_distinct("platform").alias("platforms"))
    varying = (F.col("names") > 1) | (F.col("channels") > 1) | (F.col("platforms") > 1)
    return per.agg(F.count(F.lit(1)).alias("campaigns"), F.count(F.when(varying, 1)).alias("non_constant_campaigns"))


def inventory_valuation_daily(m: Model) -> DataFrame:
    """Warehouse x day: pairs, units and value on hand (current unit cost)."""
    iv = m.inventory_intervals.join(m.dim_product.select("product_id", "base_cost_sgd"), "product_id")
    lv = daily_levels(iv, ["warehouse_id"], "valid_from", "valid_to",
                      {"active_pairs": F.lit(1).cast("bigint"),
                       "quantity_on_hand": F.col("quantity_on_hand").cast("bigint"),
                       "inventory_value": (F.col("quantity_on_hand") * F.col("base_cost_sgd")).cast("decimal(28,2)")},
                      m.sim_start, m.sim_end, day="balance_date")
    return lv.select("warehouse_id", "balance_date", "active_pairs", "quantity_on_hand",
                     F.col("inventory_value").cast(DBL).alias("inventory_value"))


def orders_per_customer_by_channel(m: Model) -> DataFrame:
    dc = m.dim_customer.select("customer_key", "acquisition_channel")
    fs = m.fact_sales.filter(F.col("fulfillment_status") != "Cancelled")
    agg = (fs.join(dc, "customer_key").groupBy("acquisition_channel", "sales_channel_code")
           .agg(F.count_distinct("order_number").alias("orders"),
                F.count_distinct("customer_key").alias("customers")))
    return agg.withColumn("orders_per_customer", _ratio("orders", "customers"))


def inventory_delta_check(m: Model) -> DataFrame:
    """Day-over-day change of on-hand equals the day's received + returned -
    sold, at every change day inside a pair's window."""
    iv = m.inventory_intervals.filter(F.col("valid_from") <= F.col("valid_to"))
    w = Window.partitionBy("warehouse_id", "product_id").orderBy("valid_from")
    j = iv.withColumn("__prev", F.lag("quantity_on_hand").over(w))
    change = F.col("day").isNotNull() & (F.col("day") == F.col("valid_from")) & F.col("__prev").isNotNull()
    flows = F.col("units_received_qty") + F.col("units_returned_qty") - F.col("units_sold_qty")
    bad = change & ((F.col("quantity_on_hand") - F.col("__prev")) != flows)
    return j.agg(F.count(F.when(bad, 1)).alias("mismatches"))


def assignment_rule(m: Model) -> DataFrame:
    """Deterministic part of the warehouse-product assignment: High and Very
    High demand products are stocked in every warehouse (Returns Centers carry
    nothing). The warehouse list is one bounded array (a scalar subquery over
    the warehouse dimension) that each such product explodes: no join, no
    cross product. Compared with the pairs that actually sold."""
    wh = (m.dim_warehouse.filter((F.col("warehouse_id") != C.UNKNOWN_ID)
                                 & (F.col("warehouse_type") != "Returns Center"))
          .agg(F.array_sort(F.collect_list("warehouse_id"))).scalar())
    tiers = reorder_quantities(m).filter(F.col("demand_tier").isin("High", "Very High"))
    rule = tiers.select("product_id", F.explode(wh).alias("warehouse_id")).withColumn("rule_assigned", F.lit(True))
    sold = m.stg("stg_warehouse_product_assignment").withColumn("has_sales", F.lit(True))
    j = rule.join(sold, ["warehouse_id", "product_id"], "full_outer")
    return j.select("warehouse_id", "product_id",
                    F.coalesce("rule_assigned", F.lit(False)).alias("rule_assigned"),
                    F.coalesce("has_sales", F.lit(False)).alias("has_sales"))


def stockout_heatmap(m: Model) -> DataFrame:
    """Warehouse x category heat map of stocked-out pair-days, one row a cell,
    so its columns don't depend on the data."""
    iv = _interval_days(m).filter(F.col("quantity_on_hand") <= 0)
    cat = m.dim_product.select("product_id", "category_name")
    return (iv.join(cat, "product_id").groupBy("warehouse_id", "category_name")
            .agg(F.sum("__days").cast("bigint").alias("stockout_days")))


def sales_by_acquisition_daily(m: Model) -> DataFrame:
    """Sales summary by date x the customer's acquisition channel."""
    fs = m.fact_sales.filter(_period(m, "order_date"))
    dc = m.dim_customer.select("customer_key", "acquisition_channel")
    return (fs.join(dc, "customer_key")
            .groupBy(F.col("order_date").alias("report_date"), "acquisition_channel")
            .agg(F.sum("net_revenue_amount").cast(DBL).alias("net_revenue_amount"),
                 F.count_distinct(F.when(F.col("fulfillment_status") != "Cancelled", F.col("order_number")))
                 .alias("completed_orders")))


def marketing_ltv_monthly(m: Model) -> DataFrame:
    """Marketing summary: sign-up month x acquisition channel with spend, new
    customers, their lifetime value, CAC and LTV:CAC (components summed first,
    divided last)."""
    from .dashboards import customer_profit
    camp = m.dim_campaign.filter(F.col("campaign_id") != C.NO_CAMPAIGN_ID) \
        .select("campaign_key", "acquisition_channel_name")
    cust = m.dim_customer.filter(F.col("customer_id") != C.UNKNOWN_ID)
    new = (cust.join(camp, cust.acquisition_campaign_key == camp.campaign_key)
           .join(customer_profit(m), "customer_key", "left")
           .groupBy(F.trunc("customer_since", "MM").alias("report_month"), "acquisition_channel_name")
           .agg(F.count(F.lit(1)).alias("new_customers"),
                F.sum(F.coalesce("ltv_amount", F.lit(0))).alias("ltv")))
    spend = (m.fact_marketing_spend.join(camp, "campaign_key")
             .groupBy(F.trunc("spend_date", "MM").alias("report_month"), "acquisition_channel_name")
             .agg(F.sum("spend_amount").alias("spend")))
    j = spend.join(new, ["report_month", "acquisition_channel_name"], "full_outer")
    s = F.coalesce(F.col("spend").cast(DBL), F.lit(0.0))
    n = F.coalesce("new_customers", F.lit(0)).cast("bigint")
    ltv = F.coalesce(F.col("ltv").cast(DBL), F.lit(0.0))
    out = j.select("report_month", "acquisition_channel_name", s.alias("spend_amount"), n.alias("new_customers"),
                   ltv.alias("total_ltv_amount"))
    cac = F.try_divide(F.col("spend_amount"), F.when(F.col("new_customers") > 0, F.col("new_customers").cast(DBL)))
    ltv_pc = F.try_divide(F.col("total_ltv_amount"),
                          F.when(F.col("new_customers") > 0, F.col("new_customers").cast(DBL)))
    return (out.withColumn("cac", cac).withColumn("ltv_per_customer", ltv_pc)
            .withColumn("ltv_to_cac", F.try_divide(F.col("ltv_per_customer"), F.when(F.col("cac") != 0, F.col("cac")))))
