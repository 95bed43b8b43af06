"""Asserted uniqueness of lookups, and facts written by month."""

import contextlib
import glob
import io
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from mercato.operators.core import lookup_key, unique_by
from mercato.sources.ingest import write_partitioned_by_month
from paths import SF_SMALL


def _plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_a_second_row_of_a_key_fails_with_the_key(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, order_id string")
    good = spark.createDataFrame([("a", "NET30"), (None, "x"), (None, "y")], "order_id string, terms string")
    rows = facts.join(unique_by(good, "order_id", ["terms"]), "order_id", "left").select("id", "terms").collect()
    assert sorted((r.id, r.terms) for r in rows) == [(1, "NET30"), (2, None), (3, None)]
    twice = spark.createDataFrame([("a", "NET30"), ("b", "NET60"), ("b", "NET30")], "order_id string, terms string")
    joined = facts.join(unique_by(twice, "order_id", ["terms"]), "order_id", "left")
    with pytest.raises(Exception, match="more than one row for order_id b"):
        joined.select("id", "terms").collect()
    dim = twice.select("order_id", F.lit(7).cast("bigint").alias("sk"))
    with pytest.raises(Exception, match="more than one row for __nk b"):
        lookup_key(facts, dim, "order_id", "order_id", "sk", "order_key").collect()


def test_an_unused_lookup_is_removed_with_its_assertion(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b")], "id int, order_id string")
    twice = spark.createDataFrame([("b", "NET60"), ("b", "NET30")], "order_id string, terms string")
    unused = facts.join(unique_by(twice, "order_id", ["terms"]), "order_id", "left").select("id")
    assert "Join" not in _plan(unused) and unused.count() == 2


def test_a_hot_day_spreads_and_months_prune(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="mercato-month-"), "t")
    hot = spark.range(40_000).selectExpr("id", "DATE'2024-03-05' AS d").unionByName(
        spark.range(300).selectExpr("id + 100000 AS id", "DATE'2024-01-01' + CAST(id AS INT) AS d")).unionByName(spark.sql("SELECT -1L AS id, CAST(NULL AS DATE) AS d"))
    write_partitioned_by_month(hot, "d", path, ["id"], rows_per_file=4_000)
    files = glob.glob(f"{path}/month=2024-03/*.parquet")
    assert len(files) >= 10                                     # bounded files, written by several tasks
    assert len({os.path.basename(f).split("-")[1] for f in files}) >= 3
    back = spark.read.parquet(path)
    assert back.count() == 40_301
    march = back.where("month = '2024-03'")
    assert march.count() == 40_031 and "PartitionFilters: [isnotnull(month" in _plan(march)


def test_dates_outside_the_calendar_get_the_unknown_member(spark):
    import datetime as dt
    from mercato.plans.model import Model
    m = Model(spark, SF_SMALL)
    df = spark.createDataFrame([(dt.date(1980, 5, 1),), (dt.date(1997, 5, 1),), (None,), (dt.date(2150, 1, 1),)], "d date")
    assert [r.k for r in df.select(m.calendar_key("d").alias("k")).collect()] == [-1, 19970501, -1, -1]
    assert (m.sim_start, m.sim_end) == (dt.date(1995, 1, 1), dt.date(2001, 12, 31))      # the orders' years
    assert Model(spark, SF_SMALL, sim_end=dt.date(1999, 6, 30)).sim_end == dt.date(1999, 6, 30)


def test_spans_come_from_the_footers(spark):
    from mercato.plans.quality_suite import footers, span
    path = os.path.join(tempfile.mkdtemp(prefix="mercato-footer-"), "t")
    spark.range(1000).selectExpr("DATE'2024-01-01' + CAST(id % 90 AS INT) AS d", "id").write.parquet(path)
    with footers(spark):
        df = span(spark.read.parquet(path), "d")
        assert "PushedAggregation: [COUNT(*), MIN(d), MAX(d)]" in _plan(df)
        row = df.first()
    assert (row["rows"], str(row.earliest), str(row.latest)) == (1000, "2024-01-01", "2024-03-30")
    from mercato.plans.quality_suite import footer_span
    spark.sql("SELECT CAST(NULL AS DATE) AS d, 1L AS id").write.mode("append").parquet(path)
    assert tuple(map(str, footer_span(spark, path, "d"))) == ("1001", "2024-01-01", "2024-03-30")
    assert "PushedAggregation" not in _plan(span(spark.read.parquet(path), "d"))


def test_materialised_facts_are_sorted_files_without_a_range_shuffle(spark, monkeypatch):
    """Each file of a fact is sorted by its date, and no range partitioning moves its rows."""
    import pyarrow.parquet as pq
    from pyspark.sql import DataFrame

    from mercato.plans.model import Model

    monkeypatch.setattr(DataFrame, "repartitionByRange", lambda *a, **k: (_ for _ in ()).throw(AssertionError("range shuffle")))
    m = Model(spark, SF_SMALL, materialize=True)
    assert m.fact_sales.count() == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    files = glob.glob(os.path.join(m.table_path("fact_sales"), "*.parquet"))
    assert files
    for f in files:
        dates = pq.read_table(f, columns=["order_date"])["order_date"].to_pylist()
        assert dates == sorted(dates)
        assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression} == {"ZSTD"}


def test_ids_are_those_of_the_formatter(spark):
    from mercato.sources.domain import _id, line_id
    df = spark.createDataFrame([(7, 1, 2, 3, "1997-03-04"), (1_000_000, 1, 2, 3, None), (-5, None, None, 0, "2001-12-31"), (None, 1, 2, 3, "1997-03-04")],
                               "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, d string").withColumn("l_shipdate", F.to_date("d"))
    old = F.format_string("OI-%d-%d-%d-%d-%s", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.date_format("l_shipdate", "yyyyMMdd"))
    for r in df.select(_id("PRD-%06d", "l_orderkey").alias("a"), F.format_string("PRD-%06d", "l_orderkey").alias("b"), line_id("OI").alias("c"), old.alias("d")).collect():
        assert (r.a, r.c) == (r.b, r.d)
    assert df.select(_id("+65-%08d", "l_orderkey").alias("a")).first().a == "+65-00000007"
    assert "format_string" not in _plan(df.select(line_id("OI")))


def test_columns_of_lines_are_not_written_again(spark):
    from mercato.plans.model import Model
    m = Model(spark, SF_SMALL, materialize=True)
    n = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert m.stg("stg_order_items").count() == n and m.stg("stg_inventory_movements").count() > 0
    written = set(os.listdir(m.raw._store.removeprefix("file://").removeprefix("file:")))
    assert {"lines", "purchase_orders"} <= written and not {"order_items", "returns", "inventory_movements"} & written


def test_receivables_find_their_customer_before_they_unfold(spark):
    from mercato.plans.model import Model
    plan = Model(spark, SF_SMALL).fact_ar_aging_daily._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Join")          # the join lies below the unfolding


def test_intervals_shuffle_their_days_once(spark):
    from mercato.plans.model import Model
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = Model(spark, SF_SMALL, materialize=True)
        plan.movement_days, plan.balance_offset, plan.dim_product
        plan.materialize = False
        text = plan.inventory_intervals._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    lines = text.splitlines()
    at = [i for i, line in enumerate(lines) if "- Window [" in line]
    assert len(at) == 2                                         # next day above running sum
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    path, low = [], depth[at[1]]                                # the operators from the lower window up
    for i in range(at[1] - 1, at[0], -1):
        if depth[i] < low:
            path.append(lines[i])
            low = depth[i]
    assert not [line for line in path if "Exchange" in line]


def test_a_measured_lookup_is_broadcast(spark):
    from mercato.operators.core import broadcast_if_small
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts, dim = spark.range(100).select(F.col("id").cast("string").alias("nk")), spark.range(50).select(F.col("id").cast("string").alias("k"), "id")
        assert "BroadcastHashJoin" in _plan(lookup_key(facts, dim, "nk", "k", "id", "key", measured=True))
        assert "SortMergeJoin" in _plan(lookup_key(facts, dim, "nk", "k", "id", "key"))
        assert "BroadcastHashJoin" in _plan(facts.join(broadcast_if_small(dim), facts.nk == dim.k, "left"))
        assert "SortMergeJoin" in _plan(facts.join(broadcast_if_small(dim, limit=100), facts.nk == dim.k, "left"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
