"""Fulfilment by ranked candidates, stores, tax at the point of sale, and returns
joined to their deliveries.

Every nation has one location (a mapping choice): its region's lowest-numbered
nation a distribution centre, the highest-numbered one a returns centre, the
others a store. A centre serves its region but for the returns centre's country,
a store its own country, a returns centre nobody. An order goes to the best
candidate by (tier, location):

1. retail orders: a store in the customer's country;
2. any location that serves the customer's country;
3. any location that fulfils orders.

The candidates are resolved per country and channel type, a table bounded by the
nations, and the orders look theirs up: no order meets more than one candidate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions.exprs import MONEY, RATE, channel_class, round_money, surrogate_key
from ..operators.core import unique_by, with_member
from .model import Model

STORE, CENTRE, RETURNS = "Retail Store", "Distribution Center", "Returns Center"


def locations(m: Model) -> DataFrame:
    """One location per nation with its tax rate: 5 % and one more for every
    step of the nation's number up to 4 (chosen values)."""
    n = m.raw.t("nation").select("n_nationkey", "n_name", "n_regionkey")
    r = m.raw.t("region").select("r_regionkey", "r_name")
    ends = n.groupBy("n_regionkey").agg(F.min("n_nationkey").alias("lowest"), F.max("n_nationkey").alias("highest"))
    kind = F.when(F.col("n_nationkey") == F.col("lowest"), CENTRE).when(F.col("n_nationkey") == F.col("highest"), RETURNS).otherwise(STORE)
    return (n.join(ends, "n_regionkey").join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .select(F.format_string("LOC-%02d", "n_nationkey").alias("location_id"), kind.alias("location_type"), F.col("n_name").alias("country"),
                    F.col("r_name").alias("region"), "n_regionkey", ((F.lit(5) + F.col("n_nationkey") % 5) / F.lit(100)).cast(RATE).alias("tax_rate")))


def dim_store(m: Model) -> DataFrame:
    """Stores with the unknown member; what a store sells is of class Retail."""
    s = locations(m).where(F.col("location_type") == STORE)
    real = s.select(surrogate_key("location_id").alias("store_key"), F.col("location_id").alias("store_code"),
                    F.concat(F.initcap(F.lower("country")), F.lit(" Store")).alias("store_name"), channel_class(F.lit("Retail")).alias("channel_class"),
                    F.col("region").alias("region_name"), F.col("country").alias("country_code"), F.lit("SGD").alias("local_currency_code"), F.lit("Open").alias("operating_status"))
    return with_member(real, {"store_key": C.UNKNOWN_KEY, "store_code": C.UNKNOWN_ID, "store_name": "Unknown Store", "channel_class": "Unknown",
                              "region_name": "Unknown", "country_code": "Unknown", "operating_status": "Unknown"})


def best_candidates(places: DataFrame) -> DataFrame:
    """(customer_country, retail, tier, location_id): the best of the candidates
    that a country has."""
    fulfils = places.where(F.col("location_type") != RETURNS)
    pick = F.struct(F.col("tier"), F.col("location_id"))
    in_country = places.where(F.col("location_type") == STORE).select(F.col("country").alias("customer_country"), F.lit(True).alias("retail"), F.lit(1).alias("tier"), "location_id")
    region = places.where(F.col("location_type") != RETURNS).select(F.col("country").alias("customer_country"), "n_regionkey")
    by_centre = fulfils.where(F.col("location_type") == CENTRE).select("n_regionkey", "location_id").join(region, "n_regionkey")
    by_store = fulfils.where(F.col("location_type") == STORE).select(F.col("country").alias("customer_country"), "location_id")
    serves = by_centre.select("customer_country", "location_id").unionByName(by_store).select(
        "customer_country", F.explode(F.array(F.lit(True), F.lit(False))).alias("retail"), F.lit(2).alias("tier"), "location_id")
    return in_country.unionByName(serves).groupBy("customer_country", "retail").agg(F.min(pick).alias("best")).select("customer_country", "retail", "best.*")


def order_locations(m: Model) -> DataFrame:
    """(order_id, sales_channel, customer_country, location_id, tier, tax_rate)."""
    places = locations(m)
    fallback = places.where(F.col("location_type") != RETURNS).agg(F.min("location_id").alias("any_location"))     # one row
    country = unique_by(m.stg("stg_customers"), "customer_id", ["customer_country"])
    o = m.stg("stg_orders").select("order_id", "customer_id", "sales_channel", (F.col("sales_channel") == "Retail").alias("retail")).join(country, "customer_id", "left")
    found = o.join(best_candidates(places), ["customer_country", "retail"], "left").crossJoin(F.broadcast(fallback)).select(
        "order_id", "sales_channel", "customer_country", F.coalesce("location_id", "any_location").alias("location_id"), F.coalesce("tier", F.lit(3)).alias("tier"))
    return found.join(unique_by(places, "location_id", ["tax_rate"]), "location_id", "left").select(
        "order_id", "sales_channel", "customer_country", "location_id", "tier", "tax_rate")


def fulfilment_tiers(m: Model) -> DataFrame:
    """Orders, net sales and the tax of the fulfilling country, by tier, type of
    location and channel. Tax is rounded by line."""
    at = order_locations(m)
    kinds = unique_by(locations(m), "location_id", ["location_type"])
    lines = m.stg("stg_order_items").select("order_id", "net_sales")
    j = lines.join(at, "order_id").join(kinds, "location_id", "left").withColumn("tax", round_money(F.col("net_sales") * F.col("tax_rate")))
    return (j.groupBy("tier", "location_type", "sales_channel")
            .agg(F.count_distinct("order_id").alias("orders"), F.count(F.lit(1)).alias("lines"), F.sum("net_sales").cast("double").alias("net_sales"), F.sum("tax").cast("double").alias("tax_amount")))


def returns_enriched(m: Model) -> DataFrame:
    """Returns of delivered shipments with carrier, days from delivery to return
    and the product's usual return rate."""
    s = unique_by(m.stg("stg_shipments").where(F.col("shipment_status") == "Delivered"), "order_id", ["shipment_id", "carrier", "service_level", "delivered_date", "is_cross_border"])
    p = unique_by(m.stg("stg_products"), "product_id", ["return_rate"]).withColumnRenamed("return_rate", "product_return_rate")
    r = m.stg("stg_returns").select("return_id", "order_id", "product_id", "return_date", "returned_quantity")
    return (r.join(s.where(F.col("shipment_id").isNotNull()), "order_id").join(p, "product_id", "left")
            .select("return_id", "order_id", "shipment_id", "carrier", "service_level", "is_cross_border",
                    F.datediff(F.to_date("return_date"), F.to_date("delivered_date")).alias("days_after_delivery"), "returned_quantity", "product_return_rate"))
