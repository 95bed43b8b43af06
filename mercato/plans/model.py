"""The dimensional model: staging -> dimensions -> facts -> intermediates.

``Model`` builds every table lazily as a DataFrame (nothing runs until an
action), so a dashboard query compiles into one Catalyst plan from the parquet
scans up. Tables are cached per ``Model`` instance as plan objects, not data.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import functools
import os
import threading
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions.exprs import (MONEY, RATE, composite, date_key, day_key, holiday_flag, lit_date,
                               round_money, strict_greatest, strict_least, surrogate_key)
from ..operators.core import explode_days, fits, lookup_key, unique_by, with_member
from ..operators.intervals import daily_levels
from ..operators.ranking import running_within
from ..session import shuffles_removed, start_partitions
from ..sources.domain import RawTables
from . import staging as S


MARTS = ("dim_date", "dim_product", "dim_supplier", "dim_warehouse", "dim_campaign", "dim_customer",
         "fact_sales", "fact_returns", "fact_purchase_orders", "fact_marketing_spend",
         "movement_days", "inventory_intervals")

# Build waves: every table depends only on tables of earlier waves, so the
# tables of one wave can be written concurrently (no table is built twice).
BUILD_WAVES = (
    ("raw", ("lines", "suppliers", "products", "warehouses", "customers", "marketing_spend")),
    ("raw", ("orders", "order_items", "shipments", "returns", "purchase_orders", "assignment",
             "acquisition_attribution", "ar_invoices")),
    ("raw", ("inventory_snapshot", "inventory_movements")),
    ("mart", ("dim_date", "dim_product", "dim_supplier", "dim_warehouse", "dim_campaign")),
    ("mart", ("dim_customer", "movement_days", "fact_marketing_spend", "fact_purchase_orders")),
    ("mart", ("fact_sales", "fact_returns", "inventory_intervals")),
)

# Tables whose jobs shuffle or write every line. Beyond LARGE_LINES each of them
# fills the cluster by itself; several at once would only add up their shuffles on disk.
HEAVY = frozenset(("lines", "shipments", "purchase_orders", "movement_days", "fact_purchase_orders",
                   "fact_sales", "fact_returns", "inventory_intervals"))
LARGE_LINES = 10_000_000


def mart(fn=None, *, cluster: tuple[str, ...] = ()):
    """A model table that is written once as a parquet table (when the model
    materialises) and read back by every consumer: a 'table'
    materialisation of the model layer. It also cuts the lineage, so a lost executor recomputes
    from the table, not from the raw files. ``cluster``: columns each file is
    sorted by, so min/max statistics let filters on them skip row groups and
    pages (e.g. a reporting period on a date); one date column is sorted by its
    value alone, without comparing rows. The rows stay in the partitions
    that the last join left them in: a range shuffle of a whole fact costs more
    than reading a stretch of every file."""
    def wrap(f):
        @functools.wraps(f)
        def get(self):
            return self._persist(f.__name__, f(self), cluster)
        return cached_property(get)
    return wrap(fn) if fn is not None else wrap


def dim_date_frame(spark: SparkSession, start: dt.date = C.CALENDAR_START,
                   end: dt.date = C.CALENDAR_END) -> DataFrame:
    """Calendar dimension over a fixed date range (used for fixtures)."""
    days = spark.range(1).select(
        F.explode(F.sequence(lit_date(start), lit_date(end), F.expr("INTERVAL 1 DAY")))
        .alias("full_date"))
    return calendar_attributes(days)


def data_calendar(dates: DataFrame) -> DataFrame:
    """Calendar spanning whole years around the business dates in ``dates``
    (column ``d``): from 1 January of the year before the earliest date to
    31 December of the year of the latest. A partial min/max aggregate, then
    one explode of a bounded range of days."""
    b = dates.agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    start = F.add_months(F.trunc("lo", "year"), -12)
    end = F.date_sub(F.add_months(F.trunc("hi", "year"), 12), 1)
    days = b.select(F.explode(F.sequence(start, end, F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    return calendar_attributes(days)


def calendar_attributes(days: DataFrame) -> DataFrame:
    d = F.col("full_date")
    return days.select(
        date_key(d).alias("date_key"), d,
        F.dayofweek(d).alias("day_of_week_number"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend_flag"),
        F.weekofyear(d).alias("week_number"),
        F.month(d).alias("calendar_month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("calendar_quarter_number"),
        F.year(d).alias("calendar_year_number"),
        F.year(d).alias("fiscal_year_number"),
        F.quarter(d).alias("fiscal_quarter_number"),
        F.month(d).alias("fiscal_month_number"),
        holiday_flag(d).alias("holiday_flag"))


class Model:
    """All staging, dimension, fact and intermediate tables for one input."""

    def __init__(self, spark: SparkSession, sf_dir: str | None = None,
                 raw: RawTables | None = None, as_of: dt.date = C.AS_OF,
                 sim_start: dt.date | None = None, sim_end: dt.date | None = None,
                 keep_partial_payments: bool = False, carry_earlier_stock: bool = False,
                 materialize: bool = False):
        self.spark = spark
        self.materialize = materialize
        self._store: str | None = None
        self._store_lock = threading.Lock()
        self.raw = raw if raw is not None else RawTables(spark, sf_dir, materialize=materialize)
        self.as_of = as_of
        self._period = sim_start, sim_end
        self.keep_partial_payments = keep_partial_payments
        # Movements before a product's window: by default its first days start
        # from the offset alone, as the daily fill sees the window only.
        self.carry_earlier_stock = carry_earlier_stock
        self._lines = 0
        if materialize and hasattr(self.raw, "t"):
            self._lines = self.raw.t("lineitem").count()
            start_partitions(spark, self._lines)

    def _persist(self, name: str, df: DataFrame, cluster: tuple[str, ...] = ()) -> DataFrame:
        if not self.materialize:
            return df
        if cluster:
            df = df.sortWithinPartitions(*cluster)
        with self._store_lock:
            if self._store is None:
                from ..sources.ingest import scratch_dir
                self._store = scratch_dir(self.spark, "marts")
        path = os.path.join(self._store, name)
        with shuffles_removed(self.spark):
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.parquet(path)

    def table_path(self, name: str) -> str | None:
        """Where a mart is written; None if the model doesn't write it."""
        return os.path.join(self._store, name) if self._store and any(name in names for layer, names in BUILD_WAVES if layer == "mart") else None

    def build(self, threads: int = 4) -> None:
        """Materialise the landing tables, then every mart, wave by wave with
        up to ``threads`` tables written at once (like a model runner with
        4 threads): concurrent jobs fill the cluster while small stages of
        one table would leave it idle. Of the heavy tables of a large input one
        is written at a time."""
        from concurrent.futures import ThreadPoolExecutor
        alone = threading.Lock()

        def table(owner, name):
            with alone if name in HEAVY and self._lines > LARGE_LINES else contextlib.nullcontext():
                getattr(owner, name)

        with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
            for layer, names in BUILD_WAVES:
                owner = self.raw if layer == "raw" else self
                list(pool.map(functools.partial(table, owner), names))

    @cached_property
    def _order_years(self) -> tuple[dt.date, dt.date]:
        """Whole years around the orders' dates; fixtures without driver tables
        use the fixed period."""
        if not hasattr(self.raw, "t"):
            return C.SIM_START, C.SIM_END
        lo, hi = self.raw.t("orders").agg(F.year(F.min("o_orderdate")), F.year(F.max("o_orderdate"))).first()
        return (dt.date(lo, 1, 1), dt.date(hi, 12, 31)) if lo else (C.SIM_START, C.SIM_END)

    @property
    def sim_start(self) -> dt.date:
        """First day of the reporting period (default: of the orders' first year)."""
        return self._period[0] or self._order_years[0]

    @property
    def sim_end(self) -> dt.date:
        return self._period[1] or self._order_years[1]

    def calendar_key(self, c: str | Column) -> Column:
        """Key of a date that the calendar holds, else the unknown member. The
        calendar has every day between its first and its last."""
        first, last = (self.dim_date.select(f("full_date")).scalar() for f in (F.min, F.max))
        d = F.col(c) if isinstance(c, str) else c
        return F.when(d.between(first, last), date_key(d)).otherwise(F.lit(C.UNKNOWN_KEY).cast("bigint"))

    # -- staging -------------------------------------------------------------

    def stg(self, name: str) -> DataFrame:
        src, fn = S.STAGING[name]
        if name == "stg_products":
            return fn(self.raw.raw(src), self.as_of)
        return fn(self.raw.raw(src))

    # -- dimensions ----------------------------------------------------------

    @mart
    def dim_date(self) -> DataFrame:
        """Calendar over the years the data covers (orders, shipments and
        events); fixtures without driver tables use the fixed range."""
        if not hasattr(self.raw, "t"):
            return dim_date_frame(self.spark)
        t = self.raw.t
        dates = (t("orders").select(F.to_date("o_orderdate").alias("d"))
                 .unionByName(t("lineitem").select(F.to_date("l_shipdate").alias("d")))
                 .unionByName(self.raw.contacts.select(F.to_date("ts").alias("d"))))
        return data_calendar(dates)

    @mart
    def dim_product(self) -> DataFrame:
        p = self.stg("stg_products")
        real = p.select(surrogate_key("product_id").alias("product_key"), "product_id", "sku_code",
                        "product_name", F.col("category").alias("category_name"),
                        F.col("brand").alias("brand_name"), "base_cost_sgd", "msrp_sgd",
                        "launch_date", "lifecycle_status", "discontinued_date",
                        "popularity_weight", "return_rate", "is_currently_sellable")
        return with_member(real, {
            "product_key": C.UNKNOWN_KEY, "product_id": C.UNKNOWN_ID, "sku_code": C.UNKNOWN_ID,
            "product_name": "Unknown Product", "category_name": "Unknown",
            "brand_name": "Unknown", "lifecycle_status": "Unknown",
            "is_currently_sellable": False})

    @mart
    def dim_supplier(self) -> DataFrame:
        s = self.stg("stg_suppliers")
        real = s.select(surrogate_key("supplier_id").alias("supplier_key"), "supplier_id",
                        "supplier_name", "supplier_tier", "category_specialty", "supplier_country",
                        "supplier_currency", "payment_terms", "lead_time_days", "quality_rating",
                        "preferred_supplier")
        return with_member(real, {
            "supplier_key": C.UNKNOWN_KEY, "supplier_id": C.UNKNOWN_ID,
            "supplier_name": "Unknown Supplier", "supplier_tier": "Unknown",
            "category_specialty": "Unknown", "supplier_country": "Unknown",
            "supplier_currency": "Unknown"})

    @mart
    def dim_warehouse(self) -> DataFrame:
        w = self.stg("stg_warehouses")
        real = w.select(surrogate_key("warehouse_id").alias("warehouse_key"), "warehouse_id",
                        "warehouse_code", "warehouse_name", "warehouse_type", "warehouse_country",
                        "warehouse_city", "warehouse_region", "serves_countries")
        return with_member(real, {
            "warehouse_key": C.UNKNOWN_KEY, "warehouse_id": C.UNKNOWN_ID,
            "warehouse_code": C.UNKNOWN_ID, "warehouse_name": "Unknown Warehouse",
            "warehouse_type": "Unknown", "warehouse_country": "Unknown"})

    @mart
    def dim_campaign(self) -> DataFrame:
        """Campaign grain derived from spend; attributes constant per campaign
        are taken with ``min`` (deterministic ``any_value``)."""
        ms = self.stg("stg_marketing_spend")
        grain = ms.groupBy("campaign_id").agg(
            F.min("campaign_name").alias("campaign_name"),
            F.min("channel").alias("acquisition_channel_name"),
            F.min("platform").alias("marketing_platform"),
            F.min("date").alias("start_date"), F.max("date").alias("end_date"))
        real = grain.select(surrogate_key(F.coalesce("campaign_id", F.lit("-1"))).alias("campaign_key"),
                            "campaign_id", "campaign_name", "marketing_platform",
                            "acquisition_channel_name", "start_date", "end_date")
        return with_member(real, {
            "campaign_key": C.UNKNOWN_KEY, "campaign_id": C.NO_CAMPAIGN_ID,
            "campaign_name": "No Campaign (Organic/Unpaid Channel)",
            "marketing_platform": "N/A", "acquisition_channel_name": "N/A"})

    @mart
    def dim_customer(self) -> DataFrame:
        c = self.stg("stg_customers")
        aa = self.stg("stg_acquisition_attribution")
        camp = self.dim_campaign.select("campaign_id", "campaign_key")
        joined = (c.join(aa, "customer_id", "left")
                  .join(camp, F.col("acquisition_campaign_id") == F.col("campaign_id"), "left"))
        real = joined.select(surrogate_key("customer_id").alias("customer_key"), "customer_id",
                             "first_name", "last_name", "email_address", "phone_number",
                             "customer_country", "gender", "birth_date", "customer_since",
                             "loyalty_tier", "acquisition_channel", "customer_status",
                             F.coalesce("campaign_key", F.lit(C.UNKNOWN_KEY).cast("bigint"))
                             .alias("acquisition_campaign_key"))
        return with_member(real, {
            "customer_key": C.UNKNOWN_KEY, "customer_id": C.UNKNOWN_ID,
            "first_name": "Unknown", "last_name": "Unknown",
            "email_address": "unknown@unknown.com", "customer_country": "Unknown",
            "loyalty_tier": "Unknown", "acquisition_channel": "Unknown",
            "customer_status": "Unknown", "acquisition_campaign_key": C.UNKNOWN_KEY})

    # -- transaction facts ---------------------------------------------------

    def _product(self, cols: list[str]) -> DataFrame:
        """The product's columns by its id, at most one row. Where the dimension
        is written its size is summed first, and lines meet it without a shuffle
        as long as it can be broadcast."""
        prod = unique_by(self.dim_product, "product_id", cols)
        return F.broadcast(prod) if self.materialize and fits(self.dim_product, ["product_id", *cols]) else prod

    @mart(cluster=("order_date",))
    def fact_sales(self) -> DataFrame:
        """Line grain. Inner join line -> header, at most one invoice per order
        (left join on the unique invoice key), COGS at the current unit cost."""
        # Line numbers per order, taken before the joins (none of them splits an
        # order); an order with a huge number of lines is numbered in slices.
        oi = running_within(self.stg("stg_order_items"), ["order_id"], ["order_item_id"], rank="line_item_number")
        # Where the products are too many to broadcast, the lines are shuffled for
        # them, and carry the key's eight bytes instead of the id it comes from.
        oi = oi.withColumn("sales_fact_key", surrogate_key("order_item_id")).drop("order_item_id")
        o = self.stg("stg_orders").select(
            "order_id", "customer_id", F.to_date("order_date").alias("order_date"),
            "sales_channel", "payment_method", F.col("order_status").alias("fulfillment_status"))
        # The customer is a header attribute: resolve its key at order grain,
        # before the header meets its lines (a shuffle of orders, not of lines).
        o = lookup_key(o, self.dim_customer, "customer_id", "customer_id", "customer_key", "customer_key")
        # At most one invoice per order: the lookup side is unique by order. It and
        # the calendar meet the header too, so the lines pass one join for them all.
        inv = unique_by(self.stg("stg_ar_invoices"), "order_id", ["payment_terms_code"])
        o = o.join(inv, "order_id", "left").withColumn("order_date_key", self.calendar_key("order_date"))
        prod = self._product(["product_key", "msrp_sgd", "base_cost_sgd"])
        j = oi.join(o, "order_id").join(prod, "product_id", "left")
        j = lookup_key(j, self.dim_warehouse, "warehouse_id", "warehouse_id", "warehouse_key",
                       "warehouse_key", bounded=True)
        return j.select(
            "sales_fact_key", "order_date_key", "customer_key",
            F.coalesce("product_key", F.lit(C.UNKNOWN_KEY).cast("bigint")).alias("product_key"),
            "warehouse_key",
            F.col("order_id").alias("order_number"), "line_item_number",
            F.col("sales_channel").alias("sales_channel_code"), "payment_method",
            "fulfillment_status",
            F.coalesce("payment_terms_code", F.lit(C.DEFAULT_PAYMENT_TERMS)).alias("payment_terms_code"),
            F.col("quantity").alias("quantity_ordered"),
            F.col("msrp_sgd").alias("unit_list_price_amount"),
            F.col("unit_price").alias("unit_selling_price_amount"),
            F.col("gross_sales").alias("gross_revenue_amount"), "discount_amount", "tax_amount",
            F.col("net_sales").alias("net_revenue_amount"), "commission_amount",
            (F.col("quantity") * F.col("base_cost_sgd")).cast(MONEY).alias("cogs_amount"),
            "order_date")

    @mart(cluster=("return_date",))
    def fact_returns(self) -> DataFrame:
        """Refund = returned qty x net/qty (NULL-safe), rounded to cents; a 10%
        restocking fee only for Customer Remorse, on the unrounded refund."""
        r = self.stg("stg_returns")
        o = self.stg("stg_orders").select("order_id", "customer_id",
                                          F.col("order_date").alias("original_order_date"))
        o = lookup_key(o, self.dim_customer, "customer_id", "customer_id", "customer_key", "customer_key")
        oi = unique_by(self.stg("stg_order_items"), "order_item_id", ["net_sales", "quantity"]) \
            .select("order_item_id", F.col("net_sales").alias("_net"), F.col("quantity").alias("_qty"))
        refund = F.try_divide(F.col("returned_quantity") * F.col("_net"), F.col("_qty").cast("decimal(10,0)"))
        j = (r.join(o, "order_id").join(oi, "order_item_id", "left")
             .withColumn("_refund", refund))
        j = lookup_key(j, self.dim_product, "product_id", "product_id", "product_key", "product_key",
                       measured=self.materialize)
        j = lookup_key(j, self.dim_warehouse, "warehouse_id", "warehouse_id", "warehouse_key",
                       "warehouse_key", bounded=True)
        fee = (F.when(F.col("return_reason") == C.RESTOCKING_FEE_REASON,
                      round_money(F.col("_refund") * F.lit(C.RESTOCKING_FEE_RATE).cast(RATE)))
               .otherwise(F.lit(0).cast(MONEY)))
        return j.select(
            surrogate_key("return_id").alias("return_fact_key"),
            self.calendar_key(F.to_date("return_date")).alias("return_date_key"),
            self.calendar_key(F.to_date("original_order_date")).alias("original_order_date_key"),
            "customer_key", "product_key", "warehouse_key",
            F.col("return_id").alias("return_authorization_number"),
            F.col("order_id").alias("order_number"), "disposition_code",
            F.col("return_reason").alias("return_reason_code"), "returned_quantity",
            round_money("_refund").alias("refunded_amount"),
            fee.alias("restocking_fee_amount"),
            F.to_date("return_date").alias("return_date"))

    @mart
    def fact_purchase_orders(self) -> DataFrame:
        po = self.stg("stg_purchase_orders")
        prod = self._product(["product_key", "base_cost_sgd"])
        j = po.join(prod, "product_id", "left")
        j = lookup_key(j, self.dim_supplier, "supplier_id", "supplier_id", "supplier_key", "supplier_key",
                       measured=self.materialize)
        j = lookup_key(j, self.dim_warehouse, "warehouse_id", "warehouse_id", "warehouse_key",
                       "destination_warehouse_key", bounded=True)
        return j.select(
            surrogate_key("purchase_order_id").alias("purchase_order_fact_key"),
            self.calendar_key(F.to_date("order_date")).alias("po_date_key"),
            self.calendar_key(F.to_date("expected_receipt_date")).alias("expected_delivery_date_key"),
            "supplier_key",
            F.coalesce("product_key", F.lit(C.UNKNOWN_KEY).cast("bigint")).alias("product_key"),
            "destination_warehouse_key",
            F.col("purchase_order_id").alias("po_number"), F.col("po_status").alias("po_status_code"),
            "demand_tier", F.col("quantity_ordered").alias("ordered_quantity"),
            F.col("quantity_received").alias("received_quantity"),
            F.col("unit_cost_sgd").alias("unit_purchase_cost_amount"),
            F.col("total_cost_sgd").alias("total_purchase_cost_amount"),
            F.col("expected_lead_time_days").alias("lead_time_days"),
            ((F.col("unit_cost_sgd") - F.col("base_cost_sgd")) * F.col("quantity_ordered"))
            .cast(MONEY).alias("purchase_price_variance_amount"),
            "actual_receipt_date",
            F.to_date("order_date").alias("po_date"),
            F.to_date("expected_receipt_date").alias("expected_date"))

    @mart
    def fact_marketing_spend(self) -> DataFrame:
        s = self.stg("stg_marketing_spend")
        j = lookup_key(s, self.dim_campaign, "campaign_id", "campaign_id", "campaign_key", "campaign_key")
        return j.select(
            surrogate_key(F.coalesce("marketing_spend_id", F.lit("-1"))).alias("marketing_spend_key"),
            date_key("date").alias("spend_date_key"), "campaign_key",
            F.col("spend_sgd").alias("spend_amount"),
            F.col("impressions").alias("impressions_count"),
            F.col("clicks").alias("clicks_count"),
            F.lit(None).cast("bigint").alias("platform_reported_conversions_count"),
            F.col("date").alias("spend_date"))

    # -- inventory chain -----------------------------------------------------

    @mart
    def movement_days(self) -> DataFrame:
        """(warehouse, product, day) pre-aggregate of the ledger: net change and
        sold / returned / received units. Partial aggregation happens before the
        shuffle, and every later window runs over at most one row per pair-day,
        so a hot pair is bounded by the calendar, not by its movement count."""
        m = self.stg("stg_inventory_movements")
        t = F.col("movement_type")
        return (m.groupBy("warehouse_id", "product_id", F.to_date("movement_date").alias("day"))
                .agg(F.sum("quantity").alias("day_qty"),
                     F.sum(F.when(t == C.MOVEMENT_SALE, -F.col("quantity")).otherwise(0)).alias("units_sold_qty"),
                     F.sum(F.when(t == C.MOVEMENT_RETURN, F.col("quantity")).otherwise(0)).alias("units_returned_qty"),
                     F.sum(F.when(t == C.MOVEMENT_PURCHASE, F.col("quantity")).otherwise(0)).alias("units_received_qty")))

    @cached_property
    def running_totals(self) -> DataFrame:
        """Cumulative quantity per (warehouse, product) ordered by (time, id).
        A pair holding a large share of the ledger is summed in ordered slices
        with carried-in offsets (``running_within``), never in one task."""
        m = self.stg("stg_inventory_movements")
        r = running_within(m, ["warehouse_id", "product_id"], ["movement_date", "movement_id"],
                           sums={"cumulative_qty_change": "quantity"})
        return r.select("movement_id", "movement_date", "movement_type", "warehouse_id", "product_id",
                        "quantity", F.col("cumulative_qty_change").cast("bigint").alias("cumulative_qty_change"))

    @cached_property
    def balance_offset(self) -> DataFrame:
        """snapshot on hand - cumulative change up to and including the snapshot
        day (0 when no movement precedes it). The latest cumulative at or before
        the day is the sum of all changes up to it, so the range join + latest
        row becomes one conditional aggregate over pair-days."""
        s = self.stg("stg_inventory_snapshot").select(
            "warehouse_id", "product_id", "snapshot_date",
            F.col("quantity_on_hand").alias("snapshot_quantity_on_hand"))
        md = self.movement_days.select("warehouse_id", "product_id", "day", "day_qty")
        cum = (s.join(md, ["warehouse_id", "product_id"], "left")
               .groupBy("warehouse_id", "product_id", "snapshot_date", "snapshot_quantity_on_hand")
               .agg(F.sum(F.when(F.col("day") <= F.col("snapshot_date"), F.col("day_qty")))
                    .alias("cum")))
        return cum.select("warehouse_id", "product_id", "snapshot_date", "snapshot_quantity_on_hand",
                          F.coalesce("cum", F.lit(0)).cast("bigint").alias("cumulative_at_snapshot"),
                          (F.col("snapshot_quantity_on_hand") - F.coalesce("cum", F.lit(0)))
                          .cast("bigint").alias("opening_balance_offset"))

    @cached_property
    def spine_pairs(self) -> DataFrame:
        """Stocked pairs with their product's window [max(launch, start),
        min(discontinued or end, end)]; a NULL launch gives no window (the
        warehouse GREATEST is NULL-propagating)."""
        a = self.stg("stg_warehouse_product_assignment")
        p = (self.dim_product.filter(F.col("product_id") != C.UNKNOWN_ID)
             .select("product_id", "product_key",
                     strict_greatest("launch_date", lit_date(self.sim_start)).alias("window_start"),
                     strict_least(F.coalesce("discontinued_date", lit_date(self.sim_end)),
                                  lit_date(self.sim_end)).alias("window_end")))
        return a.join(p, "product_id")

    @mart
    def inventory_intervals(self) -> DataFrame:
        """Piecewise-constant on-hand per pair: one row per change day (plus an
        opening row) valid until the next change day, clipped to the window.

        Every window here runs over pair-days (sparse); the dense pair x day
        grain is produced only by the final narrow ``explode``.
        """
        pairs = self.spine_pairs.filter(F.col("window_start") <= F.col("window_end"))
        pairs = lookup_key(pairs, self.dim_warehouse, "warehouse_id", "warehouse_id",
                           "warehouse_key", "warehouse_key", bounded=True)
        off = self.balance_offset.select("warehouse_id", "product_id", "opening_balance_offset")
        pairs = pairs.join(off, ["warehouse_id", "product_id"], "left").withColumn(
            "opening_balance_offset", F.coalesce("opening_balance_offset", F.lit(0).cast("bigint"))) \
            .withColumn("pair_hash", surrogate_key(composite("warehouse_id", "product_id")))
        # One shuffle for both windows: a pair's opening row (no day, first in its
        # order, no change) joins its days before the running sum.
        flows = ("units_sold_qty", "units_returned_qty", "units_received_qty")
        opening = pairs.select("warehouse_id", "product_id").distinct().select(
            "warehouse_id", "product_id", F.lit(None).cast("date").alias("day"), F.lit(None).cast("bigint").alias("day_qty"),
            *[F.lit(0).cast("bigint").alias(c) for c in flows], F.lit(True).alias("__opens"))
        w = Window.partitionBy("warehouse_id", "product_id").orderBy("day")
        changes = (self.movement_days.select("warehouse_id", "product_id", "day", "day_qty", *flows, F.lit(False).alias("__opens"))
                   .unionByName(opening)
                   .withColumn("__change", F.sum("day_qty").over(w.rowsBetween(Window.unboundedPreceding, 0)))
                   .withColumn("day_end_cumulative", F.when(F.col("__opens"), F.lit(0)).otherwise(F.col("__change"))))
        changes = changes.join(pairs.select("warehouse_id", "product_id", "window_start"),
                               ["warehouse_id", "product_id"])
        if not self.carry_earlier_stock:
            changes = changes.filter(F.col("__opens") | (F.col("day") >= F.col("window_start")))
        steps = changes.drop("window_start").withColumn("next_day", F.lead("day").over(w))
        lo = F.greatest(F.coalesce("day", F.col("window_start")), F.col("window_start"))
        hi = F.least(F.coalesce(F.date_sub("next_day", 1), F.col("window_end")), F.col("window_end"))
        return (steps.join(pairs, ["warehouse_id", "product_id"])
                .select("warehouse_id", "product_id", "product_key", "warehouse_key", "pair_hash", "day",
                        lo.alias("valid_from"), hi.alias("valid_to"),
                        (F.col("opening_balance_offset") + F.col("day_end_cumulative"))
                        .alias("quantity_on_hand"),
                        "units_sold_qty", "units_returned_qty", "units_received_qty"))

    @cached_property
    def fact_inventory_daily(self) -> DataFrame:
        """Periodic snapshot: one row per stocked pair per day of its window.
        On hand = offset + forward-filled day-end cumulative; flows zero-filled."""
        return self.inventory_daily()

    def inventory_daily(self, **carried: Column) -> DataFrame:
        """The rows of ``fact_inventory_daily`` with more columns, each an
        expression over the intervals: formed once per interval, before its days."""
        iv = self.inventory_intervals.withColumns(carried) if carried else self.inventory_intervals
        iv = explode_days(iv, "valid_from", "valid_to", "balance_date")
        on_day = F.col("balance_date") == F.col("day")
        zero = F.lit(0).cast("bigint")
        return iv.select(
            day_key("pair_hash", "balance_date").alias("inventory_fact_key"),
            date_key("balance_date").alias("snapshot_date_key"),
            "product_key", "warehouse_key", "balance_date",
            F.col("quantity_on_hand").cast("bigint").alias("quantity_on_hand"),
            F.when(on_day, F.col("units_sold_qty")).otherwise(zero).alias("units_sold_qty"),
            F.when(on_day, F.col("units_returned_qty")).otherwise(zero).alias("units_returned_qty"),
            F.when(on_day, F.col("units_received_qty")).otherwise(zero).alias("units_received_qty"),
            "warehouse_id", "product_id", *carried)

    def inventory_levels(self, by: tuple[str, ...] = ()) -> DataFrame:
        """Per (by, day): active pairs, stocked-out pairs (on hand <= 0) and
        total on hand, from the intervals (no dense pair x day rows)."""
        iv = self.inventory_intervals
        return daily_levels(
            iv, by, "valid_from", "valid_to",
            {"active_pairs": F.lit(1).cast("bigint"),
             "stockout_pairs": F.when(F.col("quantity_on_hand") <= 0, 1).otherwise(0).cast("bigint"),
             "quantity_on_hand": F.col("quantity_on_hand").cast("bigint")},
            self.sim_start, self.sim_end, day="balance_date")

    # -- receivables chain ---------------------------------------------------

    @cached_property
    def ar_spine(self) -> DataFrame:
        """Invoice x day from the invoice date to payment (or the end), guarded:
        an invoice dated after the end yields no rows."""
        return self._ar_days(self.stg("stg_ar_invoices"))

    def _ar_days(self, inv: DataFrame) -> DataFrame:
        """Each invoice unfolded into its days. The invoices, few against their
        days, are first dealt to as many tasks as a shuffle has: a handful of
        small files would leave all days to a handful of tasks."""
        bounded = (inv.withColumn("window_start", F.col("invoice_date")).withColumn("window_end", self._ar_stop())
                   .withColumn("invoice_hash", surrogate_key("invoice_id")))
        if self.materialize:
            bounded = bounded.repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")), "invoice_hash")
        return explode_days(bounded, "window_start", "window_end", "snapshot_date") \
            .drop("window_start", "window_end")

    @property
    def _ar_customers(self) -> DataFrame:
        """The invoices with their customer's key, resolved at invoice grain: a
        shuffle of invoices, not of their days."""
        cust = self.dim_customer.filter(F.col("customer_id") != C.UNKNOWN_ID)
        return lookup_key(self.stg("stg_ar_invoices"), cust, "customer_id", "customer_id", "customer_key", "customer_key")

    def _ar_stop(self) -> F.Column:
        end = lit_date(self.sim_end)
        stop = F.least(F.coalesce("payment_date", end), end)
        if self.keep_partial_payments:
            stop = F.when(F.col("invoice_status") == "Partially Paid", end).otherwise(stop)
        return stop

    def ar_balance_pieces(self, by: tuple[str, ...] = ()) -> DataFrame:
        """Per invoice, the piecewise-constant open balance: the full amount
        before the payment day, the unpaid rest from it on (``__from``,
        ``__to``, ``__bal``, plus ``invoice_date``)."""
        inv = self.stg("stg_ar_invoices").withColumn("__stop", self._ar_stop())
        before = inv.select(*by, "invoice_date", F.col("invoice_date").alias("__from"),
                            F.when(F.col("payment_date").isNull(), F.col("__stop"))
                            .otherwise(F.least("__stop", F.date_sub("payment_date", 1))).alias("__to"),
                            F.col("invoice_amount").alias("__bal"))
        after = inv.filter(F.col("payment_date").isNotNull()).select(
            *by, "invoice_date", F.greatest("invoice_date", "payment_date").alias("__from"),
            F.col("__stop").alias("__to"),
            (F.col("invoice_amount") - F.col("amount_paid")).cast(MONEY).alias("__bal"))
        return before.unionByName(after)

    # Aging buckets by days since the invoice date (inclusive).
    AGING_BUCKETS = (("aging_bucket_0_30_amount", 0, 30), ("aging_bucket_31_60_amount", 31, 60),
                     ("aging_bucket_61_90_amount", 61, 90), ("aging_bucket_90_plus_amount", 91, None))

    def ar_bucket_levels(self, by: tuple[str, ...] = ()) -> DataFrame:
        """Per (by, day): open balance in each aging bucket and the number of
        open invoice rows, from the balance pieces cut at the bucket edges
        (at most 8 intervals per invoice, no invoice x day rows)."""
        pieces = self.ar_balance_pieces(by)
        parts = []
        for name, lo, hi in self.AGING_BUCKETS:
            frm = F.greatest(F.col("__from"), F.date_add("invoice_date", lo))
            to = F.col("__to") if hi is None else F.least(F.col("__to"), F.date_add("invoice_date", hi))
            parts.append(F.struct(F.lit(name).alias("__bucket"), frm.alias("__bf"), to.alias("__bt")))
        cut = pieces.select(*by, "__bal", F.explode(F.array(*parts)).alias("__p")).select(*by, "__bal", "__p.*")
        measures = {name: F.when(F.col("__bucket") == name, F.col("__bal")).otherwise(F.lit(0).cast(MONEY))
                    for name, _, _ in self.AGING_BUCKETS}
        measures["open_rows"] = F.lit(1).cast("bigint")
        return daily_levels(cut, by, "__bf", "__bt", measures, self.sim_start, self.sim_end, day="snapshot_date")

    def ar_balance_levels(self, by: tuple[str, ...] = ()) -> DataFrame:
        """Per (by, day): total open balance, from two intervals per invoice
        (full amount before the payment day, the unpaid rest from it on)."""
        pieces = self.ar_balance_pieces(by)
        return daily_levels(pieces, by, "__from", "__to",
                            {"open_balance_amount": F.col("__bal")},
                            self.sim_start, self.sim_end, day="snapshot_date")

    @cached_property
    def fact_ar_aging_daily(self) -> DataFrame:
        s = self._ar_days(self._ar_customers)
        paid_before = F.col("payment_date").isNull() | (F.col("snapshot_date") < F.col("payment_date"))
        open_bal = F.when(paid_before, F.col("invoice_amount")) \
            .otherwise(F.col("invoice_amount") - F.col("amount_paid")).cast(MONEY)
        s = (s.withColumn("open_balance_amount", open_bal)
             .withColumn("days_outstanding", F.datediff("snapshot_date", "invoice_date")))
        d = F.col("days_outstanding")
        zero = F.lit(0).cast(MONEY)
        bucket = lambda cond: F.when(cond, F.col("open_balance_amount")).otherwise(zero)
        return s.select(
            day_key("invoice_hash", "snapshot_date").alias("ar_snapshot_key"),
            date_key("snapshot_date").alias("snapshot_date_key"), "customer_key",
            F.col("invoice_id").alias("invoice_number"), "payment_terms_code", "invoice_amount",
            "open_balance_amount", "days_outstanding",
            bucket(d.between(0, 30)).alias("aging_bucket_0_30_amount"),
            bucket(d.between(31, 60)).alias("aging_bucket_31_60_amount"),
            bucket(d.between(61, 90)).alias("aging_bucket_61_90_amount"),
            bucket(d > 90).alias("aging_bucket_90_plus_amount"),
            "snapshot_date", "customer_id", "due_date")
