"""Unit tests of the reusable operators against brute force on small inputs."""

import datetime as dt
import random

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from mercato.functions.exprs import parse_list_text, strict_greatest, surrogate_key
from mercato.operators.asof import asof_join
from mercato.operators.core import avg_percent_rank, explode_days, lookup_key, tier, with_member
from mercato.operators.intervals import daily_levels
from mercato.plans.model import dim_date_frame

D = dt.date


def test_lookup_key_unknown_member(spark):
    fact = spark.createDataFrame([("a", 1), ("zz", 2), (None, 3)], "nk string, v int")
    dim = spark.createDataFrame([("a", 11)], "id string, k bigint")
    out = {r.v: r.sk for r in lookup_key(fact, dim, "nk", "id", "k", "sk").collect()}
    assert out == {1: 11, 2: -1, 3: -1}


def test_with_member_types(spark):
    dim = spark.createDataFrame([(5, "x", D(2024, 1, 1))], "k bigint, name string, d date")
    out = with_member(dim, {"k": -1, "name": "Unknown"})
    assert out.schema == dim.schema
    assert sorted(r.k for r in out.collect()) == [-1, 5]


def test_explode_days_guarded(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 1), D(2024, 1, 3)), (2, D(2024, 1, 5), D(2024, 1, 4)),
                                (3, None, D(2024, 1, 4))], "id int, s date, e date")
    rows = explode_days(df, "s", "e", "day").collect()
    assert sorted((r.id, r.day) for r in rows) == [(1, D(2024, 1, d)) for d in (1, 2, 3)]


def test_avg_percent_rank_matches_pandas(spark):
    vals = [1, 1, 2, 3, 3, 3, 7, 9, 9, 10]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "id int, v double")
    got = {r.id: r.p for r in avg_percent_rank(df, "v", "p").collect()}
    want = pd.Series(vals).rank(method="average", pct=True)
    for i, w in enumerate(want):
        assert abs(got[i] - w) < 1e-12


def test_avg_percent_rank_in_slices(spark):
    """Slices, partition keys, ties and NULL values: the cuts never show in the ranks."""
    rows = [(i, "ab"[i % 3 == 0], None if i % 17 == 0 else float((i * 37) % 53)) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, g string, v double")
    pdf = pd.DataFrame(rows, columns=["id", "g", "v"]).set_index("id")
    filled = pdf["v"].fillna(-1.0)
    for parts, want in (((), filled.rank(pct=True)), (("g",), filled.groupby(pdf["g"]).rank(pct=True))):
        for slices in (3, 256):
            for r in avg_percent_rank(df, "v", "p", parts, slices).collect():
                if r.v is None:
                    assert r.p is None
                else:
                    assert abs(r.p - want[r.id]) < 1e-12
    assert avg_percent_rank(df.limit(0), "v", "p").count() == 0


def test_tier_right_closed(spark):
    df = spark.createDataFrame([(0.5,), (0.5000001,), (0.8,), (0.95,), (1.0,)], "p double")
    got = [r.t for r in df.select(tier("p").alias("t")).collect()]
    assert got == ["Low", "Medium", "Medium", "High", "Very High"]


def test_strict_greatest_null_propagates(spark):
    df = spark.createDataFrame([(None, D(2024, 1, 1)), (D(2024, 2, 1), D(2024, 1, 1))], "a date, b date")
    got = [r.g for r in df.select(strict_greatest("a", "b").alias("g")).collect()]
    assert got == [None, D(2024, 2, 1)]


def test_parse_list_text(spark):
    df = spark.createDataFrame([("['Singapore', 'Malaysia']",), ("[]",)], "s string")
    got = [r.a for r in df.select(parse_list_text("s").alias("a")).collect()]
    assert got == [["Singapore", "Malaysia"], []]


def test_surrogate_key_matches_duckdb(spark):
    keys = ["PRD-000001", "CUST-000042", "x"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = {r.k: r.h for r in df.select("k", surrogate_key("k").alias("h")).collect()}
    con = duckdb.connect()
    for k in keys:
        want = con.execute(f"SELECT ('0x' || substr(md5('{k}'), 1, 15))::BIGINT").fetchone()[0]
        assert got[k] == want and got[k] > 0


def test_dim_date_flags(spark):
    dd = {r.full_date: r for r in dim_date_frame(spark, D(2024, 1, 1), D(2024, 12, 31)).collect()}
    assert dd[D(2024, 12, 30)].week_number == 1            # ISO week
    assert dd[D(2024, 1, 7)].day_of_week_number == 1        # Sunday = 1
    assert dd[D(2024, 1, 7)].is_weekend_flag and dd[D(2024, 1, 6)].is_weekend_flag
    assert not dd[D(2024, 1, 8)].is_weekend_flag
    assert dd[D(2024, 11, 11)].holiday_flag and dd[D(2024, 1, 1)].holiday_flag
    assert not dd[D(2024, 11, 12)].holiday_flag
    assert dd[D(2024, 1, 5)].date_key == 20240105 and dd[D(2024, 1, 5)].day_name == "Friday"
    assert len(dd) == 366


def _asof_brute(left, right):
    out = {}
    for lid, ch, t in left:
        cands = [(s, cid) for cid, rch, s in right if rch == ch and s <= t]
        out[lid] = max(cands)[1] if cands else None
    return out


def test_asof_join_both_plans_match_brute_force(spark):
    rnd = random.Random(7)
    base = D(2024, 1, 1)
    right = [(f"C{i:02d}", rnd.choice("ab"), base + dt.timedelta(days=rnd.randint(0, 80))) for i in range(30)]
    right.append(("C99", "a", right[0][2]))  # same start as another campaign of maybe the same channel
    left = [(i, rnd.choice("abc"), base + dt.timedelta(days=rnd.randint(-5, 90))) for i in range(300)]
    ldf = spark.createDataFrame(left, "id int, ch string, t date")
    rdf = spark.createDataFrame(right, "cid string, ch string, s date")
    want = _asof_brute(left, right)
    for plan in ("broadcast", "bucketed"):
        got = asof_join(ldf, rdf, ["ch"], "t", "s", ["cid"], tie=["cid"], force=plan)
        assert {r.id: r.cid for r in got.collect()} == want, plan


def test_daily_levels_matches_dense(spark):
    rnd = random.Random(3)
    base = D(2024, 1, 1)
    rows = []
    for i in range(200):
        s = base + dt.timedelta(days=rnd.randint(0, 60))
        e = s + dt.timedelta(days=rnd.randint(-3, 30))
        rows.append((rnd.choice("xy"), s, e, rnd.randint(-5, 5)))
    df = spark.createDataFrame(rows, "k string, s date, e date, m int")
    lo, hi = D(2024, 1, 10), D(2024, 2, 20)
    got = {(r.k, r.day): (r.n, r.total) for r in daily_levels(
        df, ["k"], "s", "e", {"n": F.lit(1), "total": F.col("m")}, lo, hi).collect()}
    want = {}
    for k, s, e, m in rows:
        d = max(s, lo)
        while d <= min(e, hi):
            n, t = want.get((k, d), (0, 0))
            want[(k, d)] = (n + 1, t + m)
            d += dt.timedelta(days=1)
    assert got == want


def test_row_number_within_hot_group_matches_window(spark):
    from pyspark.sql import Window
    from mercato.operators.ranking import row_number_within
    rows = [("hot", f"i{i:05d}") for i in range(3000)] + [(f"k{j}", f"i{i:05d}") for j in range(50) for i in range(7)]
    df = spark.createDataFrame(rows, "k string, o string").repartition(7)
    got = {(r.k, r.o): r.rn for r in row_number_within(df, "k", ["o"], "rn", max_group_rows=100, sample_fraction=1.0).collect()}
    want = {(r.k, r.o): r.rn for r in df.withColumn(
        "rn", F.row_number().over(Window.partitionBy("k").orderBy("o"))).collect()}
    assert got == want and len(got) == 3350


def test_running_within_hot_pair_sums(spark):
    from pyspark.sql import Window
    from mercato.operators.ranking import running_within
    rnd = random.Random(11)
    rows = [("w1", "p1", i, rnd.randint(-5, 9)) for i in range(2500)] + \
           [("w1", f"p{j}", i, rnd.randint(-5, 9)) for j in range(2, 30) for i in range(5)]
    df = spark.createDataFrame(rows, "w string, p string, t int, q int").repartition(5)
    got = {(r.w, r.p, r.t): (r.rk, r.cum) for r in running_within(
        df, ["w", "p"], ["t"], rank="rk", sums={"cum": "q"}, max_group_rows=50, sample_fraction=1.0).collect()}
    w = Window.partitionBy("w", "p").orderBy("t")
    want = {(r.w, r.p, r.t): (r.rk, r.cum) for r in df.select(
        "w", "p", "t", F.row_number().over(w).alias("rk"),
        F.sum("q").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum")).collect()}
    assert got == want


def test_asof_bucketed_hot_bucket_matches_brute_force(spark):
    rnd = random.Random(5)
    base = D(2024, 1, 1)
    right = [(f"C{i:02d}", "a", base + dt.timedelta(days=rnd.randint(0, 25))) for i in range(12)]
    left = [(i, "a", base + dt.timedelta(days=rnd.randint(0, 27))) for i in range(600)]
    ldf = spark.createDataFrame(left, "id int, ch string, t date")
    rdf = spark.createDataFrame(right, "cid string, ch string, s date")
    got = asof_join(ldf, rdf, ["ch"], "t", "s", ["cid"], tie=["cid"], force="bucketed", max_group_rows=40,
                    sample_fraction=1.0)
    assert {r.id: r.cid for r in got.collect()} == _asof_brute(left, right)


def test_sampled_hot_detection_finds_hot_group_and_stays_exact(spark):
    from pyspark.sql import Window
    from mercato.operators.ranking import running_within
    rows = [("hot", i) for i in range(20000)] + [(f"k{j}", i) for j in range(200) for i in range(3)]
    df = spark.createDataFrame(rows, "k string, o int")
    got = running_within(df, ["k"], ["o"], rank="rn", max_group_rows=1000, sample_fraction=0.05)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("o")))
    assert got.exceptAll(want.select(*got.columns)).count() == 0 and got.count() == want.count()


def test_asof_binary_search_over_many_candidates(spark):
    """Thousands of candidates of one key, ties, times before the first and NULL."""
    from mercato.operators.asof import asof_join, broadcast_limit
    rdf = spark.range(5000).selectExpr("'k' AS ch", "DATE'2000-01-01' + CAST(3 * (id div 2) AS INT) AS s", "format_string('R%05d', id) AS cid")
    ldf = spark.range(0, 8000, 7).selectExpr("id", "'k' AS ch", "CASE WHEN id % 5 = 0 THEN NULL ELSE DATE'1999-12-30' + CAST(id AS INT) END AS t")
    got = {p: {r.id: r.cid for r in asof_join(ldf, rdf, ["ch"], "t", "s", ["cid"], tie=["cid"], force=p).collect()} for p in ("broadcast", "bucketed")}
    want = {i: None if i % 5 == 0 or i < 2 else f"R{min(4999, 2 * ((i - 2) // 3) + 1):05d}" for i in range(0, 8000, 7)}
    assert got["broadcast"] == got["bucketed"] == want
    assert broadcast_limit(spark) == 10 << 20
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert broadcast_limit(spark) == 0
        plan = asof_join(ldf, rdf, ["ch"], "t", "s", ["cid"], tie=["cid"])
        assert {r.id: r.cid for r in plan.collect()} == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
