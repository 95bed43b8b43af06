"""The 15 raw retail tables, derived from the driver's test tables.

This is the landing layer of the model: each method returns the DataFrame a
CSV/parquet landing table would hold. Everything is derived by Spark from the
driver's tables (joins and aggregates whose work grows with them); nothing is
sampled or capped. The SQL mirror used by the oracle lives in
``mercato.oracle``.

Mapping (SURVEY §7.1):

- products = ``part``; launch = first ship date of the part, discontinued =
  last ship date for sizes >= 48; unit cost = 60% of list price.
- suppliers = ``supplier`` + ``nation``.
- warehouses = one distribution centre per ``region``, located in the region's
  lowest-numbered nation, serving all nations of the region.
- customers = ``customer``; sign-up = first ``signup`` event of the user with
  the same id, else the first order; acquisition channel from the segment.
- orders = ``orders``; channel from the priority, status F/O/P ->
  Delivered/Shipped/Cancelled; fulfilled by the warehouse that serves the
  customer's country.
- order_items = ``lineitem``; the line's warehouse is its supplier's region.
- returns = lines with return flag R; purchase orders = lines with status O
  (receipt after the as-of day -> In Transit).
- inventory_movements = delivered sales (-), returns (+), received POs (+).
- inventory_snapshot = every stocked pair whose product launched by the
  snapshot day.
- marketing_spend = every view/click event per (day, campaign), on the clock
  of the orders; acquisition_attribution = as-of join of customers to campaigns.
- ar_invoices = non-cancelled orders of credit-segment customers.
"""

from __future__ import annotations

import functools
import os
import re
import threading
import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions.exprs import MONEY, RATE, lit_date, map_values, round_money
from ..operators.asof import asof_join
from ..operators.core import avg_percent_rank, broadcast_if_small, fits, tier, unique_by
from ..session import shuffles_removed, start_buckets
from .tables import read_table


def landing(fn):
    """A landing table: written once as parquet when the adapter materialises
    (the raw tables of the warehouse exist as files), read back by every user.
    Tables that are other columns of ``lines`` row by row are not written again:
    their users read ``lines`` and form only the columns they use."""
    @functools.wraps(fn)
    def get(self):
        return self._persist(fn.__name__, fn(self))
    return cached_property(get)


def _id(fmt: str, c: str) -> F.Column:
    """``format_string(fmt, c)`` for a prefix and a zero-padded number (``SUP-%06d``).
    Numbers that fit the width are padded and longer ones written as they are; the
    formatter, many times slower, is left for the others (negative, NULL)."""
    prefix, width = re.fullmatch(r"([^%]*)%0(\d+)d", fmt).groups()
    text = F.col(c).cast("string")
    return F.when(F.col(c).between(0, 10 ** int(width) - 1), F.concat(F.lit(prefix), F.lpad(text, int(width), "0"))) \
        .when(F.col(c) >= 10 ** int(width), F.concat(F.lit(prefix), text)) \
        .otherwise(F.format_string(fmt, F.col(c)))


def line_id(prefix: str) -> F.Column:
    """Unique line id: (order, line number, part, supplier, ship date). A missing
    part is written as null."""
    parts = [F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    parts.append(F.date_format("l_shipdate", "yyyyMMdd"))
    return F.concat_ws("-", F.lit(prefix), *[F.coalesce(p, F.lit("null")) for p in parts])


class RawTables:
    """Lazily derived landing tables for one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = False):
        self.spark = spark
        self.sf_dir = sf_dir
        self.materialize = materialize
        self._store: str | None = None
        self._store_lock = threading.Lock()

    def _persist(self, name: str, df: DataFrame) -> DataFrame:
        if not self.materialize:
            return df
        path = self._path(name)
        with shuffles_removed(self.spark):
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.parquet(path)

    def _path(self, name: str) -> str:
        with self._store_lock:
            if self._store is None:
                from .ingest import scratch_dir
                self._store = scratch_dir(self.spark, "landing")
        return os.path.join(self._store, name)

    def _persist_buckets(self, name: str, df: DataFrame, key: str) -> DataFrame:
        """:meth:`_persist` in buckets by ``key``: who joins or groups by it reads
        them without a shuffle. The catalog is needed only to find the buckets;
        its entry is dropped, the files stay."""
        table = f"mercato_{name}_{uuid.uuid4().hex[:12]}"
        with shuffles_removed(self.spark):
            (df.write.format("parquet").option("compression", "zstd").option("path", self._path(name))
             .bucketBy(start_buckets(self.spark), key).sortBy(key).saveAsTable(table))
        out = self.spark.table(table)
        self.spark.sql(f"DROP TABLE {table}")
        return out

    def t(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    # -- helpers shared by several landing tables ---------------------------

    @cached_property
    def supplier_warehouse(self) -> DataFrame:
        """s_suppkey -> warehouse (region) of the supplier."""
        n = self.t("nation").select("n_nationkey", "n_regionkey")
        return (self.t("supplier").select("s_suppkey", "s_nationkey")
                .join(F.broadcast(n), F.col("s_nationkey") == F.col("n_nationkey"))
                .select("s_suppkey", _id("WH-%02d", "n_regionkey").alias("warehouse_id")))

    @cached_property
    def lines(self) -> DataFrame:
        """lineitem joined to its order header (channel, status, date). The
        channel and the amounts, which follow from a row's own columns, are formed
        by its readers and not written. Where the headers are too large to be sent
        to every executor, both sides are dealt by ``order_id`` and the table is
        written in those buckets."""
        li = self.t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                       "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                                       "l_returnflag", "l_linestatus", "l_shipdate")
        o = self.t("orders").select("o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
        home = unique_by(self.supplier_warehouse, "s_suppkey", ["warehouse_id"])
        if self.materialize and fits(self.supplier_warehouse, self.supplier_warehouse.columns):
            home = F.broadcast(home)            # one row per supplier; the lines stay where they are
        columns = [*li.columns, "o_orderdate", "o_orderstatus", "o_orderpriority", "warehouse_id"]
        dealt = self.materialize and not fits(o, o.columns)
        if dealt:
            li = li.where("l_orderkey IS NOT NULL").withColumn("order_id", _id("ORD-%08d", "l_orderkey"))
            o = o.where("o_orderkey IS NOT NULL").withColumn("order_id", _id("ORD-%08d", "o_orderkey")).drop("o_orderkey")
            joined = li.join(o, "order_id")
            columns.append("order_id")
        else:
            joined = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
        joined = joined.join(home, F.col("l_suppkey") == F.col("s_suppkey"), "left").select(*columns)
        stored = self._persist_buckets("lines", joined, "order_id") if dealt else self._persist("lines", joined)
        return (stored.withColumn("sales_channel", map_values("o_orderpriority", C.PRIORITY_CHANNEL))
                .withColumn("gross_sales", F.col("l_extendedprice").cast(MONEY))
                .withColumn("discount_amount",
                            round_money(F.col("gross_sales") * F.col("l_discount").cast(RATE)))
                .withColumn("net_sales", (F.col("gross_sales") - F.col("discount_amount")).cast(MONEY))
                .withColumn("tax_amount",
                            round_money(F.col("net_sales") * F.col("l_tax").cast(RATE))))

    @property
    def _line_order(self) -> F.Column:
        """Order id of a row of ``lines``: written where the table is in buckets by it."""
        return F.col("order_id") if "order_id" in self.lines.columns else _id("ORD-%08d", "l_orderkey").alias("order_id")

    @cached_property
    def part_stats(self) -> DataFrame:
        li = self.t("lineitem")
        return li.groupBy("l_partkey").agg(
            F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"),
            F.min("l_suppkey").alias("main_supp"), F.count(F.lit(1)).alias("n_lines"),
            F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("n_returned"))

    @cached_property
    def demand_tiers(self) -> DataFrame:
        """product_id -> demand tier (percentile rank of popularity, average ties)."""
        pop = self.products.select("product_id", "popularity_weight")
        ranked = avg_percent_rank(pop, "popularity_weight", "popularity_pct_rank")
        return ranked.select("product_id", "popularity_pct_rank",
                             tier("popularity_pct_rank").alias("demand_tier"))

    # -- the 15 landing tables -----------------------------------------------

    @landing
    def suppliers(self) -> DataFrame:
        n = self.t("nation").select("n_nationkey", "n_name")
        s = self.t("supplier")
        return (s.join(F.broadcast(n), F.col("s_nationkey") == F.col("n_nationkey"), "left")
                .select(_id("SUP-%06d", "s_suppkey").alias("supplier_id"),
                        F.concat(F.col("s_name"), F.lit(" ")).alias("supplier_name"),
                        F.when(F.col("s_acctbal") >= 7500, "Strategic")
                         .when(F.col("s_acctbal") >= 2500, "Preferred")
                         .otherwise("Transactional").alias("supplier_tier"),
                        F.lit("General").alias("category_specialty"),
                        F.col("n_name").alias("country"),
                        F.lit("SGD").alias("currency"),
                        F.lit("NET30").alias("payment_terms"),
                        (F.col("s_nationkey") + 7).cast("int").alias("lead_time_days"),
                        (F.col("s_acctbal") / 2000.0).alias("quality_rating"),
                        (F.col("s_acctbal") > 5000).alias("preferred_supplier"),
                        lit_date(C.CALENDAR_START).alias("created_at")))

    @landing
    def products(self) -> DataFrame:
        p = self.t("part")
        st = self.part_stats
        launch = F.to_date("first_ship")
        disc = F.col("p_size") >= C.DISCONTINUED_MIN_SIZE
        list_price = F.col("p_retailprice").cast(MONEY)
        return (p.join(st, F.col("p_partkey") == F.col("l_partkey"), "left")
                .select(_id("PRD-%06d", "p_partkey").alias("product_id"),
                        _id("SKU-%06d", "p_partkey").alias("sku"),
                        F.concat(F.lit(" "), F.col("p_name")).alias("product_name"),
                        F.col("p_type").alias("category"),
                        F.col("p_brand").alias("brand"),
                        F.when(F.col("main_supp").isNotNull(), _id("SUP-%06d", "main_supp"))
                         .alias("supplier_id"),
                        round_money(list_price * F.lit(C.PRODUCT_COST_RATIO).cast(RATE))
                        .alias("base_cost_sgd"),
                        list_price.alias("msrp_sgd"),
                        launch.alias("launch_date"),
                        F.when(disc, "Discontinued")
                         .when(launch >= lit_date(C.NEW_LAUNCH_FROM), "New Launch")
                         .otherwise("Active").alias("lifecycle_status"),
                        F.when(disc, F.to_date("last_ship")).alias("discontinued_date"),
                        F.coalesce(F.col("n_lines"), F.lit(0)).cast("double").alias("popularity_weight"),
                        F.try_divide(F.col("n_returned").cast("double"), F.col("n_lines").cast("double"))
                         .alias("return_rate"),
                        F.col("p_size").cast("int").alias("reorder_point"),
                        F.lit(14).alias("lead_time_days"),
                        (F.col("p_size") * 20).cast("int").alias("reorder_quantity")))

    @landing
    def warehouses(self) -> DataFrame:
        n = self.t("nation")
        r = self.t("region")
        per_region = n.groupBy("n_regionkey").agg(
            F.min_by("n_name", "n_nationkey").alias("home_nation"),
            F.array_sort(F.collect_list(F.concat(F.lit("'"), F.col("n_name"), F.lit("'"))))
             .alias("served"))
        return (r.join(per_region, F.col("r_regionkey") == F.col("n_regionkey"), "left")
                .select(_id("WH-%02d", "r_regionkey").alias("warehouse_id"),
                        F.concat(F.lit(" "), F.lower(F.substring("r_name", 1, 3)), F.lit("-"),
                                 F.col("r_regionkey").cast("string")).alias("warehouse_code"),
                        F.concat(F.lit(" "), F.col("r_name"), F.lit(" Distribution Center"))
                         .alias("warehouse_name"),
                        F.lit("Distribution Center").alias("warehouse_type"),
                        F.col("home_nation").alias("country"),
                        F.col("r_name").alias("city"),
                        F.col("r_name").alias("region"),
                        F.concat(F.lit("["), F.array_join("served", ", "), F.lit("]"))
                         .alias("serves_countries")))

    @cached_property
    def contacts(self) -> DataFrame:
        """The events on the clock of the orders: one shift for all, no row lost."""
        return self.t("events").withColumn("ts", F.col("ts") - F.expr(f"INTERVAL {C.EVENT_YEARS_BACK} YEARS"))

    @landing
    def customers(self) -> DataFrame:
        c = self.t("customer")
        n = self.t("nation").select("n_nationkey", "n_name")
        first_order = self.t("orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"))
        signup = (self.contacts.filter(F.col("event_type") == "signup")
                  .groupBy("user_id").agg(F.min("ts").alias("first_signup")))
        return (c.join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"), "left")
                .join(first_order, F.col("c_custkey") == F.col("o_custkey"), "left")
                .join(signup, F.col("c_custkey") == F.col("user_id"), "left")
                .select(_id("CUST-%06d", "c_custkey").alias("customer_id"),
                        F.concat(F.lit(" "), F.substring_index("c_name", "#", 1)).alias("first_name"),
                        F.substring_index("c_name", "#", -1).alias("last_name"),
                        F.concat(F.lit("  Customer."), F.col("c_custkey").cast("string"),
                                 F.lit("@Example.COM ")).alias("email"),
                        _id("+65-%08d", "c_custkey").alias("phone"),
                        F.col("n_name").alias("country"),
                        F.lit("Unspecified").alias("gender"),
                        F.date_add(lit_date(C.CALENDAR_START), -F.col("c_nationkey") * 400)
                         .alias("birth_date"),
                        F.least(F.to_date("first_signup"), F.to_date("first_order")).alias("customer_since"),
                        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string"))
                         .when(F.col("c_acctbal") < 2500, "Bronze")
                         .when(F.col("c_acctbal") < 5000, "Silver")
                         .when(F.col("c_acctbal") < 7500, "Gold")
                         .otherwise("Platinum").alias("loyalty_tier"),
                        map_values("c_mktsegment", C.SEGMENT_CHANNEL).alias("acquisition_channel"),
                        F.when(F.col("first_order").isNull(), "Inactive").otherwise("Active")
                         .alias("customer_status")))

    @cached_property
    def order_fulfilment(self) -> DataFrame:
        """o_orderkey -> fulfilling warehouse: the lowest-id warehouse serving
        the customer's country (NULL -> unknown member downstream)."""
        served = (self.warehouses
                  .select("warehouse_id", F.explode(F.split(F.regexp_replace(
                      "serves_countries", r"[\[\]']", ""), ", ")).alias("served_country"))
                  .groupBy("served_country").agg(F.min("warehouse_id").alias("serving_wh")))
        c = (self.t("customer").select("c_custkey", "c_nationkey")
             .join(F.broadcast(self.t("nation").select("n_nationkey", "n_name")),
                   F.col("c_nationkey") == F.col("n_nationkey"), "left"))
        o = self.t("orders").select("o_orderkey", "o_custkey")
        return (o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left")
                .join(F.broadcast(served), F.col("n_name") == F.col("served_country"), "left")
                .select("o_orderkey", F.col("serving_wh").alias("fulfillment_wh"),
                        F.col("n_name").alias("customer_country")))

    @landing
    def orders(self) -> DataFrame:
        o = self.t("orders")
        methods = F.array(*[F.lit(m) for m in C.PAYMENT_METHODS])
        return (o.join(unique_by(self.order_fulfilment, "o_orderkey", ["fulfillment_wh"]), "o_orderkey", "left")
                .select(_id("ORD-%08d", "o_orderkey").alias("order_id"),
                        _id("CUST-%06d", "o_custkey").alias("customer_id"),
                        F.col("o_orderdate").alias("order_date"),
                        map_values("o_orderpriority", C.PRIORITY_CHANNEL).alias("sales_channel"),
                        F.element_at(methods, (F.col("o_orderkey") % len(C.PAYMENT_METHODS) + 1).cast("int"))
                         .alias("payment_method"),
                        map_values("o_orderstatus", C.ORDER_STATUS).alias("order_status"),
                        F.col("fulfillment_wh").alias("fulfillment_warehouse_id")))

    @cached_property
    def order_items(self) -> DataFrame:
        li = self.lines
        qty = F.col("l_quantity").cast("int")
        commission = map_values("sales_channel", C.COMMISSION_RATE, "0.00").cast(RATE)
        return li.select(
            line_id("OI").alias("order_item_id"),
            self._line_order,
            _id("PRD-%06d", "l_partkey").alias("product_id"),
            F.col("warehouse_id"),
            qty.alias("quantity"),
            round_money(F.col("gross_sales") / qty).alias("unit_price"),
            F.col("l_discount").alias("discount_pct"),
            F.col("gross_sales"), F.col("discount_amount"), F.col("net_sales"),
            F.col("tax_amount"),
            round_money(F.col("net_sales") * commission).alias("commission_amount"))

    @landing
    def shipments(self) -> DataFrame:
        li = self.lines.filter(F.col("o_orderstatus") != "P")
        per_order = li.groupBy("l_orderkey", "o_orderstatus", "o_orderpriority").agg(
            F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"),
            F.sum("l_quantity").alias("units"))
        wh = self.warehouses.select(F.col("warehouse_id").alias("wh_id"), F.col("country").alias("wh_country"))
        f = self.order_fulfilment
        delivered = F.col("o_orderstatus") == "F"
        express = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
        return (per_order.join(f, F.col("l_orderkey") == F.col("o_orderkey"), "left")
                .join(F.broadcast(wh), F.col("fulfillment_wh") == F.col("wh_id"), "left")
                .select(_id("SHP-%08d", "l_orderkey").alias("shipment_id"),
                        _id("ORD-%08d", "l_orderkey").alias("order_id"),
                        F.col("fulfillment_wh").alias("warehouse_id"),
                        F.when(express, "DHL Express").otherwise("Ninja Van").alias("carrier"),
                        _id("TRK%010d", "l_orderkey").alias("tracking_number"),
                        F.when(express, "Express").otherwise("Standard").alias("service_level"),
                        F.when(delivered, "Delivered").otherwise("In Transit").alias("shipment_status"),
                        (F.col("customer_country") != F.col("wh_country")).alias("is_cross_border"),
                        F.col("first_ship").alias("shipped_date"),
                        F.when(delivered, F.col("last_ship") + F.expr("INTERVAL 3 DAYS"))
                         .alias("delivered_date"),
                        round_money(F.col("units").cast(MONEY) * F.lit("0.25").cast(RATE))
                        .alias("shipping_cost")))

    @cached_property
    def returns(self) -> DataFrame:
        li = self.lines.filter(F.col("l_returnflag") == "R")
        reasons = F.array(*[F.lit(r) for r in C.RETURN_REASONS])
        disp = F.array(*[F.lit(d) for d in C.DISPOSITIONS])
        return li.select(
            line_id("RET").alias("return_id"),
            self._line_order,
            line_id("OI").alias("order_item_id"),
            _id("SHP-%08d", "l_orderkey").alias("shipment_id"),
            _id("PRD-%06d", "l_partkey").alias("product_id"),
            F.col("warehouse_id"),
            (F.col("l_shipdate") + F.expr("INTERVAL 10 DAYS")).alias("return_date"),
            F.ceil(F.col("l_quantity") / 2).cast("int").alias("quantity"),
            F.element_at(reasons, ((F.col("l_linenumber") - 1) % len(C.RETURN_REASONS) + 1).cast("int"))
             .alias("return_reason"),
            F.element_at(disp, ((F.col("l_linenumber") - 1) % len(C.DISPOSITIONS) + 1).cast("int"))
             .alias("disposition"))

    @landing
    def purchase_orders(self) -> DataFrame:
        tiers = self.demand_tiers.select("product_id", "demand_tier")
        if self.materialize:                    # one row per product; the lines stay where they are
            tiers = broadcast_if_small(tiers)
        # Beyond that the lines are shuffled, before their texts are formed.
        li = (self.lines.filter(F.col("l_linestatus") == "O").withColumn("product_id", _id("PRD-%06d", "l_partkey"))
              .join(tiers, "product_id", "left"))
        qty = F.col("l_quantity").cast("int")
        received = F.to_date("l_shipdate") <= lit_date(C.AS_OF)
        unit_cost = round_money(round_money(F.col("gross_sales") / qty) * F.lit(C.PO_COST_RATIO).cast(RATE))
        return li.select(
            line_id("PO").alias("purchase_order_id"),
            _id("SUP-%06d", "l_suppkey").alias("supplier_id"),
            "product_id",
            F.col("warehouse_id"),
            F.col("o_orderdate").alias("order_date"),
            (F.col("o_orderdate") + F.expr(f"INTERVAL {C.PO_LEAD_DAYS} DAYS"))
             .alias("expected_receipt_date"),
            F.when(received, F.col("l_shipdate")).alias("actual_receipt_date"),
            qty.alias("quantity_ordered"),
            F.when(received, qty).otherwise(0).alias("quantity_received"),
            unit_cost.alias("unit_cost_sgd"),
            (unit_cost * qty).cast(MONEY).alias("total_cost_sgd"),
            F.when(received, "Received").otherwise("In Transit").alias("po_status"),
            "demand_tier")

    @landing
    def assignment(self) -> DataFrame:
        """(warehouse, product) pairs stocked: every pair that ever had a line."""
        return (self.lines.select("warehouse_id", _id("PRD-%06d", "l_partkey").alias("product_id"))
                .filter(F.col("warehouse_id").isNotNull()).distinct())

    @landing
    def inventory_snapshot(self) -> DataFrame:
        pairs = self.assignment
        p = self.products.select("product_id", "launch_date", "reorder_point", "base_cost_sgd")
        snap = lit_date(C.SNAPSHOT_DATE)
        wh_no = F.substring("warehouse_id", 4, 2).cast("int")
        on_hand = (F.col("reorder_point") * 2 + wh_no).cast("int")
        reserved = F.floor(F.col("reorder_point") / 10).cast("int")
        return (pairs.join(p, "product_id")
                .filter(F.col("launch_date") <= snap)
                .select(F.concat(F.lit("SNAP-"), F.col("warehouse_id"), F.lit("-"), F.col("product_id"))
                         .alias("inventory_snapshot_id"),
                        snap.alias("snapshot_date"), "warehouse_id", "product_id",
                        on_hand.alias("quantity_on_hand"),
                        reserved.alias("quantity_reserved"),
                        (on_hand - reserved).alias("quantity_available"),
                        F.lit(C.SAFETY_STOCK).alias("safety_stock"),
                        F.greatest(F.lit(2 * C.SAFETY_STOCK), F.col("reorder_point")).alias("reorder_point"),
                        (on_hand * F.col("base_cost_sgd")).cast(MONEY).alias("inventory_value")))

    @cached_property
    def inventory_movements(self) -> DataFrame:
        li = self.lines
        pid = _id("PRD-%06d", "l_partkey")
        qty = F.col("l_quantity").cast("int")
        sales = li.filter(F.col("o_orderstatus") == "F").select(
            line_id("MV-S").alias("movement_id"),
            (F.col("l_shipdate") + F.expr("INTERVAL 2 HOURS")).alias("movement_date"),
            F.lit(C.MOVEMENT_SALE).alias("movement_type"), "warehouse_id", pid.alias("product_id"),
            (-qty).alias("quantity"), F.lit("ORDER").alias("reference_type"),
            line_id("OI").alias("reference_id"))
        rets = self.returns.select(
            F.concat(F.lit("MV-R-"), F.col("return_id")).alias("movement_id"),
            (F.col("return_date") + F.expr("INTERVAL 1 HOURS")).alias("movement_date"),
            F.lit(C.MOVEMENT_RETURN).alias("movement_type"), "warehouse_id", "product_id",
            F.col("quantity"), F.lit("RETURN").alias("reference_type"),
            F.col("return_id").alias("reference_id"))
        pos = self.purchase_orders.filter(F.col("po_status") == "Received").select(
            F.concat(F.lit("MV-P-"), F.col("purchase_order_id")).alias("movement_id"),
            (F.col("actual_receipt_date") + F.expr("INTERVAL 6 HOURS")).alias("movement_date"),
            F.lit(C.MOVEMENT_PURCHASE).alias("movement_type"), "warehouse_id", "product_id",
            F.col("quantity_received").alias("quantity"), F.lit("PO").alias("reference_type"),
            F.col("purchase_order_id").alias("reference_id"))
        return sales.unionByName(rets).unionByName(pos)

    @landing
    def marketing_spend(self) -> DataFrame:
        """Every view and click. The event's k (0 if it has none) picks the
        channel, its day the campaign that the channel runs then."""
        e = self.contacts.filter(F.col("event_type").isin("view", "click"))
        slots = len(C.PAID_CHANNELS)
        slot = F.coalesce(F.get_json_object("props", "$.k").cast("int"), F.lit(0)) % slots
        day = F.to_date("ts")
        block = F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / C.CAMPAIGN_DAYS).cast("int")
        agg = (e.select(day.alias("date"), slot.alias("slot"), (block * slots + slot).alias("campaign_no"),
                        "event_type", F.col("value").cast(MONEY).alias("value"))
               .groupBy("date", "slot", "campaign_no")
               .agg(F.sum("value").cast(MONEY).alias("spend_sgd"),
                    F.count(F.when(F.col("event_type") == "view", 1)).alias("impressions"),
                    F.count(F.when(F.col("event_type") == "click", 1)).alias("clicks")))
        channel = F.element_at(F.array(*[F.lit(c) for c in C.PAID_CHANNELS]), F.col("slot") + 1)
        return agg.select(
            F.format_string("MS-%06d-%s", F.col("campaign_no"), F.date_format("date", "yyyyMMdd"))
             .alias("marketing_spend_id"),
            "date",
            _id("CMP-%06d", "campaign_no").alias("campaign_id"),
            F.format_string("%s #%06d", channel, F.col("campaign_no")).alias("campaign_name"),
            channel.alias("channel"),
            map_values(channel, C.CHANNEL_PLATFORM).alias("platform"),
            "spend_sgd",
            F.col("impressions").cast("bigint").alias("impressions"),
            F.col("clicks").cast("bigint").alias("clicks"),
            F.try_divide(F.col("clicks").cast("double"), F.col("impressions").cast("double"))
             .alias("click_through_rate"),
            round_money(F.try_divide(F.col("spend_sgd"), F.col("clicks").cast(MONEY)))
             .alias("cost_per_click_sgd"))

    @landing
    def acquisition_attribution(self) -> DataFrame:
        """First touch: latest campaign on the customer's channel that started
        on or before sign-up; ties -> greater campaign id; none -> NULL."""
        campaigns = (self.marketing_spend.groupBy("campaign_id", "channel")
                     .agg(F.min("date").alias("start_date")))
        cust = self.customers.select("customer_id", F.col("acquisition_channel").alias("channel"),
                                     "customer_since")
        hit = asof_join(cust, campaigns, by=["channel"], left_time="customer_since",
                        right_time="start_date", values=["campaign_id"], tie=["campaign_id"])
        return hit.select("customer_id", F.col("campaign_id").alias("acquisition_campaign_id"))

    @landing
    def ar_invoices(self) -> DataFrame:
        li = self.lines.filter(F.col("o_orderstatus") != "P")
        totals = li.groupBy("l_orderkey").agg(
            F.sum(F.col("net_sales") + F.col("tax_amount")).cast(MONEY).alias("invoice_amount"))
        o = self.t("orders").filter(F.col("o_orderstatus") != "P")
        c = self.t("customer").filter(F.col("c_mktsegment") == C.CREDIT_SEGMENT) \
            .select("c_custkey", "c_acctbal")
        terms = map_values("o_orderpriority", C.PRIORITY_TERMS)
        days = map_values(terms, C.PAYMENT_TERMS_DAYS).cast("int")
        inv_date = F.date_add(F.to_date("o_orderdate"), 1)
        due = F.date_add(inv_date, days)
        open_ = F.col("o_orderstatus") == "O"
        partial = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW")
        amount = F.col("invoice_amount")
        paid_date = (F.when(open_, F.lit(None).cast("date"))
                     .when(partial, F.date_add(due, 15))
                     .when(F.col("c_acctbal") < 0, F.date_add(due, 20))
                     .otherwise(F.date_add(due, -3)))
        return (o.join(c, F.col("o_custkey") == F.col("c_custkey"))
                .join(totals, F.col("o_orderkey") == F.col("l_orderkey"))
                .select(_id("INV-%08d", "o_orderkey").alias("invoice_id"),
                        _id("ORD-%08d", "o_orderkey").alias("order_id"),
                        _id("CUST-%06d", "o_custkey").alias("customer_id"),
                        terms.alias("payment_terms_code"),
                        inv_date.alias("invoice_date"),
                        due.alias("due_date"),
                        amount.alias("invoice_amount"),
                        F.when(open_, F.lit(0).cast(MONEY))
                         .when(partial, round_money(amount * F.lit("0.50").cast(RATE)))
                         .otherwise(amount).alias("amount_paid"),
                        paid_date.alias("payment_date"),
                        F.when(open_, "Open").when(partial, "Partially Paid").otherwise("Paid")
                         .alias("invoice_status")))

    RAW_TABLES = ("suppliers", "products", "customers", "warehouses", "assignment",
                  "inventory_snapshot", "purchase_orders", "orders", "order_items",
                  "shipments", "returns", "inventory_movements", "marketing_spend",
                  "acquisition_attribution", "ar_invoices")

    def raw(self, name: str) -> DataFrame:
        if name not in self.RAW_TABLES:
            raise KeyError(name)
        return getattr(self, name)
