"""Steps of the shared tables that must not grow faster than the input."""

import datetime as dt
import os
import tempfile
import threading
import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from fixture_raw import FixtureRaw
from mercato import registry_reports
from mercato.plans import model, quality_suite as Q
from mercato.plans.model import Model
from mercato.plans.reports import margin_cube
from mercato.session import REMOVE_SHUFFLES, ROWS_PER_TASK, start_partitions
from mercato.sources import domain
from mercato.sources.domain import RawTables
from mercato.sources.ingest import write_partitioned_by_month

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def own_tables(spark):
    day = dt.datetime(2024, 1, 2)
    line = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    rows = [(1, 1, 10, 1, 2.0, 20.0, 0.1, 0.0, "N", "O", day), (1, 2, 99, 2, 1.0, 10.0, 0.0, 0.0, "R", "F", day), (2, 1, None, 1, 1.0, 10.0, 0.0, 0.0, "N", "F", day)]
    return {"nation": spark.createDataFrame([(1, "N1", 0), (2, "N2", 3)], "n_nationkey int, n_name string, n_regionkey int"),
            "supplier": spark.createDataFrame([(10, 2, 1.0)], "s_suppkey long, s_nationkey int, s_acctbal double"),
            "orders": spark.createDataFrame([(1, 5, "F", 1.0, day, "1-URGENT"), (2, 5, "O", 1.0, day, "5-LOW")], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
            "lineitem": spark.createDataFrame(rows, line)}


def test_lines_are_not_shuffled_for_their_supplier(spark, monkeypatch):
    tables = own_tables(spark)
    monkeypatch.setattr(RawTables, "t", lambda self, name: tables[name])
    monkeypatch.setattr(RawTables, "_persist", lambda self, name, df: df)
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a grouped side too large for the planner's guess
    try:
        lines = RawTables(spark, "unused", materialize=True).lines
        assert "hashpartitioning(l_suppkey" not in lines._jdf.queryExecution().executedPlan().toString()
        found = {(r.l_orderkey, r.l_linenumber): r.warehouse_id for r in lines.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    assert found == {(1, 1): "WH-03", (1, 2): None, (2, 1): None}


def test_shuffles_start_with_more_partitions_for_more_rows(spark):
    usual, given = spark.conf.get(INITIAL, None), int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        assert start_partitions(spark, ROWS_PER_TASK) == given and spark.conf.get(INITIAL, None) == usual
        assert start_partitions(spark, 1000 * ROWS_PER_TASK + 1) == 1001
        assert spark.conf.get(INITIAL) == "1001"
    finally:
        spark.conf.unset(INITIAL) if usual is None else spark.conf.set(INITIAL, usual)


def test_sales_lines_meet_their_header_and_invoice_in_one_join(spark):
    plan = Model(spark, raw=FixtureRaw(spark, {})).fact_sales._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    at = next(i for i, line in enumerate(plan) if line.lstrip(" :+-").startswith("Window"))
    joins, level = [], depth(plan[at])
    for line in reversed(plan[:at]):
        if depth(line) < level:
            level = depth(line)
            joins += [line] if line.lstrip(" :+-").startswith("Join") else []
    assert len(joins) == 3, joins  # header, product, warehouse


def test_freshness_writes_its_tables_together():
    class Built(Exception):
        pass

    def build():
        raise Built
    with pytest.raises(Built):
        Q.freshness_of_all(SimpleNamespace(materialize=True, raw=SimpleNamespace(t=None), build=build))


def test_dimensions_with_an_undated_member_are_not_read_by_footers():
    m = SimpleNamespace(table_path=lambda name: f"/marts/{name}")
    assert {n for n in Q.DATES if not n.startswith("stg_") and not Q.footer_path(m, n)} == {
        "dim_product", "dim_supplier", "dim_warehouse", "dim_customer", "dim_campaign"}


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def left_over(spark, before, seconds=10):
    until = time.time() + seconds
    while (rest := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return rest


def test_shuffles_of_written_tables_are_removed(spark):
    usual = spark.conf.get(REMOVE_SHUFFLES, None)
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s"), F.max(F.lit(dt.date(2024, 1, 5))).alias("d"))
    m = Model(spark, raw=FixtureRaw(spark, {}), materialize=True)
    before = shuffle_files(spark)
    written = m._persist("t", df)
    write_partitioned_by_month(df, "d", os.path.join(tempfile.mkdtemp(prefix="mercato-month-"), "t"), ["k"])
    assert not left_over(spark, before)
    assert written.count() == 7
    assert spark.conf.get(REMOVE_SHUFFLES, None) == (usual or "false")


def odd_lines(spark, monkeypatch):
    """Own rows with a line and a header without a key, an order that comes twice and one longer than its padding."""
    tables, day = own_tables(spark), dt.datetime(2024, 1, 2)
    header, line = tables["orders"], tables["lineitem"]
    tables["orders"] = header.unionByName(spark.createDataFrame(
        [(2, 5, "O", 1.0, day, "5-LOW"), (None, 5, "F", 1.0, day, "5-LOW"), (123456789, 5, "P", 1.0, day, "2-HIGH")], header.schema))
    tables["lineitem"] = line.unionByName(spark.createDataFrame(
        [(None, 1, 10, 1, 2.0, 20.0, 0.1, 0.0, "N", "O", day), (123456789, 1, 10, 1, 2.0, 20.0, 0.1, 0.0, "R", "O", day)], line.schema))
    monkeypatch.setattr(RawTables, "t", lambda self, name: tables[name])


def test_lines_in_buckets_are_the_same_rows(spark, monkeypatch):
    odd_lines(spark, monkeypatch)
    items = []
    for fits in (lambda df, columns, limit=0: True, lambda df, columns, limit=0: False):
        monkeypatch.setattr(domain, "fits", fits)
        raw = RawTables(spark, "unused", materialize=True)
        items.append(raw.order_items)
        stored = spark.read.parquet(os.path.join(raw._store, "lines"))
        assert "l_extendedprice" in stored.columns and not {"gross_sales", "net_sales", "sales_channel"} & set(stored.columns)
    assert items[0].count() == 5 and items[0].exceptAll(items[1]).count() == items[1].exceptAll(items[0]).count() == 0
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for rows, moved in zip(items, (True, False)):
            plan = rows.groupBy("order_id").count()._jdf.queryExecution().executedPlan().toString()
            assert ("Exchange" in plan) == moved, plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("mercato_lines")]


def test_lines_carry_a_key_and_no_long_id_to_their_product(spark):
    plan = Model(spark, raw=FixtureRaw(spark, {})).fact_sales._jdf.queryExecution().optimizedPlan().toString().split("\n")
    product = next(i for i, line in enumerate(plan) if "Join" in line and "product_id" in line)
    assert next(i for i, line in enumerate(plan) if "AS sales_fact_key" in line) > product


def test_purchases_meet_their_tier_before_their_texts(spark, monkeypatch):
    odd_lines(spark, monkeypatch)
    tiers = spark.createDataFrame([("PRD-000001", "High")], "product_id string, demand_tier string")
    monkeypatch.setattr(RawTables, "demand_tiers", tiers)
    monkeypatch.setattr(RawTables, "_persist", lambda self, name, df: df)
    df = RawTables(spark, "unused").purchase_orders
    plan = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
    join = next(i for i, line in enumerate(plan) if "Join LeftOuter" in line and "product_id" in line)
    assert next(i for i, line in enumerate(plan) if "AS purchase_order_id" in line) < join
    assert sorted((r.purchase_order_id, r.demand_tier, r.quantity_ordered) for r in df.collect()) == [
        ("PO-1-1-1-10-20240102", "High", 2), ("PO-123456789-1-1-10-20240102", "High", 2)]


def test_long_ids_are_not_left_to_the_formatter(spark):
    df = spark.createDataFrame([(999_999,), (1_000_000,), (7_200_000,), (-5,), (None,)], "k long")
    assert [r.a for r in df.select(domain._id("PRD-%06d", "k").alias("a")).collect()] == \
        [r.a for r in df.select(F.format_string("PRD-%06d", "k").alias("a")).collect()]
    assert ">= 1000000" in df.select(domain._id("PRD-%06d", "k"))._jdf.queryExecution().optimizedPlan().toString()


def test_a_large_build_writes_its_heavy_tables_one_at_a_time():
    class Tables:
        lock, now, most, seen = threading.Lock(), 0, 0, []

        def __getattr__(self, name):
            if name in model.HEAVY:
                with self.lock:
                    Tables.now += 1
                    Tables.most = max(Tables.most, Tables.now)
                time.sleep(0.02)
                with self.lock:
                    Tables.now -= 1
            self.seen.append(name)

    tables = Tables()
    tables.raw, tables._lines = tables, model.LARGE_LINES + 1
    Model.build(tables)
    assert Tables.most == 1 and set(tables.seen) == {n for _, names in model.BUILD_WAVES for n in names}


def test_the_dense_inventory_is_summed_by_one_number(spark):
    D = dt.date
    rows = [("A", 1, 11, 101, D(1969, 12, 30), D(1969, 12, 30), D(1970, 1, 2), 5, 1, 0, 2), ("B", 1, 12, 102, D(1970, 1, 1), D(1970, 1, 1), D(1970, 2, 1), -3, 0, 1, 0),
            ("A", 2, 11, 103, None, D(1970, 1, 2), D(1970, 1, 2), 7, 0, 0, 0), (None, 3, 13, 104, None, D(1970, 1, 2), D(1970, 1, 3), 1, 0, 0, 0), ("B", 4, 12, 105, None, D(1970, 1, 5), D(1970, 1, 4), 9, 9, 9, 9)]
    iv = spark.createDataFrame(rows, "warehouse_id string, product_key long, warehouse_key long, pair_hash long, day date, valid_from date, valid_to date, quantity_on_hand long, "
                                     "units_sold_qty long, units_returned_qty long, units_received_qty long").withColumn("product_id", F.lit("P"))
    m = Model(spark, raw=FixtureRaw(spark, {}))
    m.__dict__["inventory_intervals"] = iv
    found = registry_reports.inventory_monthly(m)
    dense = m.fact_inventory_daily.groupBy("warehouse_id", F.trunc("balance_date", "MM").alias("balance_month")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("balance_date").alias("first_day"), F.max("balance_date").alias("last_day"),
        *[F.sum(c).alias(c) for c in registry_reports._SUMS], F.sum(F.col("inventory_fact_key") % 1000003).alias("key_checksum"),
        F.sum(F.col("product_key") % 10007 + F.col("warehouse_key") % 10007 + F.col("snapshot_date_key")).alias("dimension_checksum"))
    assert found.count() == 5 and found.columns == dense.columns
    assert found.exceptAll(dense).count() == dense.exceptAll(found).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString().split("\n")
    lowest = [line for line in plan[:next(i for i, line in enumerate(plan) if "Generate explode" in line)] if "HashAggregate" in line][-1]
    keys = lowest.split("keys=[")[1].split("]")[0]
    assert "," not in keys and "warehouse_id" not in keys, lowest


def test_only_months_without_stock_are_cut_out(spark):
    D = dt.date
    rows = [("A", "P", D(2024, 1, 10), D(2024, 6, 9), 4), ("A", "P", D(2024, 6, 10), D(2024, 7, 5), 0), ("A", "P", D(2024, 7, 6), D(2024, 12, 31), 9),
            ("A", "Q", D(2024, 1, 1), D(2024, 12, 31), 3), ("B", "P", D(2024, 2, 1), D(2024, 3, 31), 5), ("B", "P", D(2024, 3, 30), D(2024, 4, 2), -2),
            ("B", "P", D(2024, 5, 2), D(2024, 5, 1), 0), (None, "P", D(2024, 2, 1), D(2024, 2, 2), 0), ("B", "R", D(2024, 1, 1), D(2024, 1, 2), None)]
    m = SimpleNamespace(inventory_intervals=spark.createDataFrame(rows, "warehouse_id string, product_id string, valid_from date, valid_to date, quantity_on_hand long"))
    found = registry_reports.stockouts_by_product(m)
    assert sorted(map(tuple, found.collect()), key=str) == sorted([
        (D(2024, 6, 1), "A", "P", 30, 21, 36), (D(2024, 7, 1), "A", "P", 31, 5, 234), (D(2024, 3, 1), "B", "P", 33, 2, 151),
        (D(2024, 4, 1), "B", "P", 2, 2, -4), (D(2024, 2, 1), None, "P", 2, 2, 0)], key=str)
    plan = found._jdf.queryExecution().executedPlan().toString().split("\n")
    shuffles = [line for line in plan if "Exchange" in line]
    assert shuffles and not [line for line in shuffles if "report_month" in line], plan


def test_the_cube_shuffles_no_cells_by_product(spark):
    tables = {"fact_sales": spark.createDataFrame([(1, "Shopee", dt.date(1996, 5, 3), 10, 4, 2), (1, "Shopee", dt.date(1996, 5, 9), 1, 1, 1), (2, "Retail", dt.date(1996, 6, 1), 5, 2, 1),
                                                   (1, "Shopee", dt.date(1990, 5, 9), 1, 1, 1), (9, "Shopee", dt.date(1996, 5, 9), 1, 1, 1)],
                                                  "product_key long, sales_channel_code string, order_date date, net_revenue_amount int, cogs_amount int, quantity_ordered int"),
              "dim_product": spark.createDataFrame([(1, "S"), (2, "S")], "product_key long, category_name string")}
    cube = margin_cube(SimpleNamespace(**tables, sim_start=dt.date(1995, 1, 1), sim_end=dt.date(2001, 12, 31)), [["category_name"], ["order_month"]])
    assert {tuple(r) for r in cube.collect()} == {("S", None, None, 3, 16.0, 7.0, 4), (None, None, dt.date(1996, 5, 1), 6, 11.0, 5.0, 3), (None, None, dt.date(1996, 6, 1), 6, 5.0, 2.0, 1)}
    plan = cube._jdf.queryExecution().optimizedPlan().toString().split("\n")
    join = next(i for i, line in enumerate(plan) if "Join" in line)
    assert not [line for line in plan[join:] if "Aggregate" in line], plan
