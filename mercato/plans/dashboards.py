"""The twelve dashboard queries (components only; ratios are divided last).

Each returns numerators and denominators, never a pre-divided ratio, so a
report can re-aggregate them. Money is summed exactly as DECIMAL and cast to
DOUBLE at the very end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions.exprs import channel_class, date_key, lit_date
from .model import Model


def _dbl(c: str) -> F.Column:
    return F.col(c).cast("double").alias(c)


def _in_period(m: Model, c: str) -> F.Column:
    return F.col(c).between(lit_date(m.sim_start), lit_date(m.sim_end))


def period_days(m: Model) -> DataFrame:
    return (m.dim_date.filter(_in_period(m, "full_date"))
            .select(F.col("full_date").alias("report_date"), "date_key"))


def completed_orders() -> F.Column:
    return F.count_distinct(F.when(F.col("fulfillment_status") != "Cancelled", F.col("order_number")))


def customer_profit(m: Model) -> DataFrame:
    """LTV per customer = revenue - COGS, aggregated before any join."""
    return (m.fact_sales.filter(F.col("customer_key") != C.UNKNOWN_KEY)
            .groupBy("customer_key")
            .agg((F.sum("net_revenue_amount") - F.sum("cogs_amount")).alias("ltv_amount")))


def q01_overview(m: Model) -> DataFrame:
    """Daily revenue, COGS, units, completed orders, returned units, active and
    stocked-out pairs; one row per day, empty days zero-filled.

    The inventory fact holds exactly one row per (pair, day) and its keys are
    one-to-one with the pair, so the distinct count of the composite key per
    day is the number of pairs whose interval covers the day: computed by the
    interval sweep, without producing the dense pair x day rows.
    """
    sales = (m.fact_sales.groupBy("order_date_key")
             .agg(F.sum("net_revenue_amount").alias("net_revenue_amount"),
                  F.sum("cogs_amount").alias("cogs_amount"),
                  F.sum("quantity_ordered").alias("sold_units"),
                  completed_orders().alias("completed_orders")))
    rets = (m.fact_returns.groupBy("return_date_key")
            .agg(F.sum("returned_quantity").alias("returned_units")))
    inv = m.inventory_levels().select(
        date_key("balance_date").alias("snapshot_date_key"),
        F.col("active_pairs").alias("active_skus"), F.col("stockout_pairs").alias("stockout_skus"))
    ds = period_days(m)
    j = (ds.join(sales, ds.date_key == sales.order_date_key, "left")
         .join(rets, ds.date_key == rets.return_date_key, "left")
         .join(inv, ds.date_key == inv.snapshot_date_key, "left"))
    zero = F.lit(0)
    return j.select(
        "report_date",
        F.coalesce(F.col("net_revenue_amount").cast("double"), zero.cast("double")).alias("net_revenue_amount"),
        F.coalesce(F.col("cogs_amount").cast("double"), zero.cast("double")).alias("cogs_amount"),
        F.coalesce("sold_units", zero).cast("bigint").alias("sold_units"),
        F.coalesce("completed_orders", zero).cast("bigint").alias("completed_orders"),
        F.coalesce("returned_units", zero).cast("bigint").alias("returned_units"),
        F.coalesce("active_skus", zero).cast("bigint").alias("active_skus"),
        F.coalesce("stockout_skus", zero).cast("bigint").alias("stockout_skus"),
    ).orderBy("report_date")


def q02_revenue_by_channel(m: Model) -> DataFrame:
    fs = m.fact_sales.filter(_in_period(m, "order_date"))
    return (fs.groupBy(F.col("order_date").alias("report_date"), "sales_channel_code")
            .agg(F.sum("net_revenue_amount").cast("double").alias("net_revenue_amount"),
                 completed_orders().alias("completed_orders"))
            .orderBy("report_date", "sales_channel_code"))


def q03_top_skus(m: Model) -> DataFrame:
    fs = m.fact_sales.filter(_in_period(m, "order_date"))
    dp = m.dim_product.filter(F.col("product_id") != C.UNKNOWN_ID)
    agg = (fs.join(dp, "product_key")
           .groupBy("product_name", "sku_code", "category_name", "brand_name")
           .agg(F.sum("net_revenue_amount").alias("net_revenue_amount"),
                F.sum("quantity_ordered").cast("bigint").alias("units_sold")))
    return agg.select(
        "product_name", "sku_code", "category_name", "brand_name",
        F.col("net_revenue_amount").cast("double").alias("net_revenue_amount"), "units_sold",
        F.try_divide(F.col("net_revenue_amount").cast("double"), F.col("units_sold").cast("double"))
        .alias("avg_selling_price"),
    ).orderBy(F.desc("net_revenue_amount"), "sku_code")


def q03_top10_skus(m: Model, n: int = 10) -> DataFrame:
    """The top-N report the BI layer shows (N=10), with a full tie-breaker."""
    return q03_top_skus(m).limit(n)


def q04_ltv_cac_by_channel(m: Model) -> DataFrame:
    camp = m.dim_campaign.filter(F.col("campaign_id") != C.NO_CAMPAIGN_ID)
    cust = m.dim_customer.filter(F.col("customer_id") != C.UNKNOWN_ID)
    attributed = (cust.join(camp, cust.acquisition_campaign_key == camp.campaign_key)
                  .join(customer_profit(m), "customer_key", "left")
                  .select("customer_key", "acquisition_channel_name", "marketing_platform",
                          F.coalesce("ltv_amount", F.lit(0).cast("decimal(38,2)")).alias("ltv_amount")))
    ltv = (attributed.groupBy("acquisition_channel_name", "marketing_platform")
           .agg(F.count_distinct("customer_key").alias("attributed_customers"),
                F.sum("ltv_amount").alias("total_ltv_amount")))
    spend = (m.fact_marketing_spend.join(camp, "campaign_key")
             .groupBy("acquisition_channel_name", "marketing_platform")
             .agg(F.sum("spend_amount").alias("total_spend_amount")))
    return (ltv.join(spend, ["acquisition_channel_name", "marketing_platform"], "left")
            .select("acquisition_channel_name", "marketing_platform",
                    F.coalesce(F.col("total_spend_amount").cast("double"), F.lit(0.0)).alias("total_spend_amount"),
                    "attributed_customers",
                    F.col("total_ltv_amount").cast("double").alias("total_ltv_amount"))
            .orderBy(F.desc("total_ltv_amount"), "acquisition_channel_name", "marketing_platform"))


def q05_dso(m: Model) -> DataFrame:
    ar = m.ar_balance_levels().select(date_key("snapshot_date").alias("snapshot_date_key"),
                                      F.col("open_balance_amount").alias("daily_total_ar"))
    credit = (m.fact_sales.filter(F.col("payment_terms_code") != C.DEFAULT_PAYMENT_TERMS)
              .groupBy("order_date_key")
              .agg(F.sum("net_revenue_amount").alias("credit_net_revenue_amount")))
    ds = period_days(m)
    return (ds.join(ar, ds.date_key == ar.snapshot_date_key, "left")
            .join(credit, ds.date_key == credit.order_date_key, "left")
            .select("report_date",
                    F.coalesce(F.col("daily_total_ar").cast("double"), F.lit(0.0)).alias("daily_total_ar"),
                    F.coalesce(F.col("credit_net_revenue_amount").cast("double"), F.lit(0.0))
                    .alias("credit_net_revenue_amount"))
            .orderBy("report_date"))


def q06_margin_category_channel(m: Model) -> DataFrame:
    fs = m.fact_sales.filter(_in_period(m, "order_date"))
    dp = m.dim_product.filter(F.col("product_id") != C.UNKNOWN_ID).select("product_key", "category_name")
    return (fs.join(dp, "product_key")
            .groupBy("category_name", "sales_channel_code")
            .agg(F.sum("net_revenue_amount").cast("double").alias("net_revenue_amount"),
                 F.sum("cogs_amount").cast("double").alias("cogs_amount")))


def q07_margin_country(m: Model) -> DataFrame:
    fs = m.fact_sales.filter(_in_period(m, "order_date"))
    dc = m.dim_customer.filter(F.col("customer_id") != C.UNKNOWN_ID).select("customer_key", "customer_country")
    return (fs.join(dc, "customer_key")
            .groupBy("customer_country")
            .agg(F.sum("net_revenue_amount").cast("double").alias("net_revenue_amount"),
                 F.sum("cogs_amount").cast("double").alias("cogs_amount")))


def q08_channel_class_mix(m: Model) -> DataFrame:
    fs = m.fact_sales.filter(_in_period(m, "order_date"))
    return (fs.groupBy(F.trunc("order_date", "MM").alias("report_month"),
                       channel_class("sales_channel_code").alias("channel_class"))
            .agg(F.sum("net_revenue_amount").cast("double").alias("net_revenue_amount"))
            .orderBy("report_month", "channel_class"))


def q09_aov_return_by_class(m: Model) -> DataFrame:
    """Each sales row carries its channel; only returns look theirs up, by order."""
    sales = (m.fact_sales.filter(_in_period(m, "order_date"))
             .groupBy(channel_class("sales_channel_code").alias("channel_class"))
             .agg(F.sum("net_revenue_amount").alias("net_revenue_amount"),
                  F.sum("quantity_ordered").alias("sold_units"),
                  completed_orders().alias("completed_orders")))
    channels = m.stg("stg_orders").select(F.col("order_id").alias("order_number"),
                                          channel_class("sales_channel").alias("channel_class"))
    rets = (m.fact_returns.filter(_in_period(m, "return_date")).join(channels, "order_number")
            .groupBy("channel_class").agg(F.sum("returned_quantity").alias("returned_units")))
    return (sales.join(rets, "channel_class", "left")
            .select("channel_class", F.col("net_revenue_amount").cast("double").alias("net_revenue_amount"),
                    F.col("sold_units").cast("bigint").alias("sold_units"), "completed_orders",
                    F.coalesce("returned_units", F.lit(0)).cast("bigint").alias("returned_units")))


def q10_cac_trend(m: Model) -> DataFrame:
    camp = (m.dim_campaign.filter(F.col("campaign_id") != C.NO_CAMPAIGN_ID)
            .select("campaign_key", "acquisition_channel_name", "marketing_platform"))
    spend = (m.fact_marketing_spend.join(camp, "campaign_key")
             .groupBy(F.trunc("spend_date", "MM").alias("report_month"), "acquisition_channel_name")
             .agg(F.sum("spend_amount").alias("spend_amount")))
    cust = m.dim_customer.filter(F.col("customer_id") != C.UNKNOWN_ID)
    new = (cust.join(camp, cust.acquisition_campaign_key == camp.campaign_key)
           .groupBy(F.trunc("customer_since", "MM").alias("report_month"), "acquisition_channel_name")
           .agg(F.count_distinct("customer_key").alias("new_customers")))
    return (spend.join(new, ["report_month", "acquisition_channel_name"], "full_outer")
            .select("report_month", "acquisition_channel_name",
                    F.coalesce(F.col("spend_amount").cast("double"), F.lit(0.0)).alias("spend_amount"),
                    F.coalesce("new_customers", F.lit(0)).cast("bigint").alias("new_customers"))
            .orderBy("report_month", "acquisition_channel_name"))


def q11_ltv_by_cohort(m: Model) -> DataFrame:
    cust = m.dim_customer.filter(F.col("customer_id") != C.UNKNOWN_ID)
    return (cust.join(customer_profit(m), "customer_key", "left")
            .groupBy(F.trunc("customer_since", "MM").alias("cohort_month"))
            .agg(F.count_distinct("customer_key").alias("customers"),
                 F.sum(F.coalesce("ltv_amount", F.lit(0))).cast("double").alias("total_ltv_amount"))
            .orderBy("cohort_month"))


def q12_campaign_triage(m: Model) -> DataFrame:
    cust = m.dim_customer.filter(F.col("customer_id") != C.UNKNOWN_ID)
    per_campaign = (cust.join(customer_profit(m), "customer_key", "left")
                    .groupBy(F.col("acquisition_campaign_key").alias("campaign_key"))
                    .agg(F.count_distinct("customer_key").alias("new_customers"),
                         F.sum(F.coalesce("ltv_amount", F.lit(0))).alias("total_ltv_amount")))
    spend = m.fact_marketing_spend.groupBy("campaign_key").agg(F.sum("spend_amount").alias("total_spend_amount"))
    camp = m.dim_campaign.filter(F.col("campaign_id") != C.NO_CAMPAIGN_ID)
    j = camp.join(spend, "campaign_key", "left").join(per_campaign, "campaign_key", "left")
    spend_c = F.coalesce(F.col("total_spend_amount").cast("double"), F.lit(0.0))
    ltv_c = F.coalesce(F.col("total_ltv_amount").cast("double"), F.lit(0.0))
    return (j.select("campaign_name", "acquisition_channel_name", "marketing_platform",
                     spend_c.alias("total_spend_amount"),
                     F.coalesce("new_customers", F.lit(0)).cast("bigint").alias("new_customers"),
                     ltv_c.alias("total_ltv_amount"),
                     F.try_divide(ltv_c, F.when(spend_c != 0, spend_c)).alias("ltv_to_cac"))
            .orderBy(F.col("ltv_to_cac").asc_nulls_first(), "campaign_name"))


DASHBOARDS = {
    "q01_overview": q01_overview,
    "q02_revenue_by_channel": q02_revenue_by_channel,
    "q03_top_skus": q03_top_skus,
    "q03_top10_skus": q03_top10_skus,
    "q04_ltv_cac_by_channel": q04_ltv_cac_by_channel,
    "q05_dso": q05_dso,
    "q06_margin_category_channel": q06_margin_category_channel,
    "q07_margin_country": q07_margin_country,
    "q08_channel_class_mix": q08_channel_class_mix,
    "q09_aov_return_by_class": q09_aov_return_by_class,
    "q10_cac_trend": q10_cac_trend,
    "q11_ltv_by_cohort": q11_ltv_by_cohort,
    "q12_campaign_triage": q12_campaign_triage,
}
