"""Property tests: operators against brute force on random small inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mercato.functions import constants as C
from mercato.functions.exprs import day_key
from mercato.operators.asof import asof_join
from mercato.operators.core import explode_days
from mercato.operators.intervals import daily_levels
from mercato.operators.quality import repeated_day_keys

D0 = dt.date(2024, 1, 1)
day = st.integers(min_value=0, max_value=40).map(lambda k: D0 + dt.timedelta(days=k))
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(left=st.lists(st.tuples(st.sampled_from("abc"), day), min_size=1, max_size=25),
       right=st.lists(st.tuples(st.sampled_from("ab"), day), max_size=12))
def test_asof_plans_equal_brute_force(spark, left, right):
    lrows = [(i, ch, t) for i, (ch, t) in enumerate(left)]
    rrows = [(f"R{i:02d}", ch, s) for i, (ch, s) in enumerate(right)]
    want = {}
    for i, ch, t in lrows:
        cands = [(s, rid) for rid, rch, s in rrows if rch == ch and s <= t]
        want[i] = max(cands)[1] if cands else None
    ldf = spark.createDataFrame(lrows, "id int, ch string, t date")
    rdf = spark.createDataFrame(rrows or [("X", "z", D0)], "rid string, ch string, s date")
    if not rrows:
        rdf = rdf.filter(F.lit(False))
    for plan in ("broadcast", "bucketed"):
        got = asof_join(ldf, rdf, ["ch"], "t", "s", ["rid"], tie=["rid"], force=plan, max_group_rows=5,
                         sample_fraction=1.0)
        assert {r.id: r.rid for r in got.collect()} == want, plan


@SETTINGS
@given(st.lists(st.tuples(day, st.integers(min_value=-3, max_value=20), st.integers(min_value=-4, max_value=4)),
                min_size=1, max_size=20))
def test_sweep_equals_dense(spark, ivs):
    rows = [(s, s + dt.timedelta(days=n), m) for s, n, m in ivs]
    df = spark.createDataFrame(rows, "s date, e date, m int")
    lo, hi = D0 + dt.timedelta(days=3), D0 + dt.timedelta(days=35)
    got = {r.day: (r.n, r.total) for r in daily_levels(
        df, [], "s", "e", {"n": F.lit(1), "total": F.col("m")}, lo, hi).collect()}
    want = {}
    for s, e, m in rows:
        d = max(s, lo)
        while d <= min(e, hi):
            n, t = want.get(d, (0, 0))
            want[d] = (n + 1, t + m)
            d += dt.timedelta(days=1)
    assert got == {d: v for d, v in want.items()}


def test_sliced_running_sum_equals_plain_window_with_nulls_and_ties(spark):
    from mercato.operators.ranking import running_within

    rows = [(i % 2, i // 3, i, None if i < 40 or i % 5 == 0 else float(i % 7)) for i in range(400)] + [(9, 0, 1000 + i, None) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, day int, id int, v double")
    args = {"keys": ["k"], "order": ["day", "id"], "rank": "n", "sums": {"s": "v"}, "maxes": {"m": "v"}, "sample_fraction": 1.0}
    plain = running_within(df, max_group_rows=10_000, **args).select("k", "id", "n", "s", "m").collect()
    sliced = running_within(df, max_group_rows=100, **args).select("k", "id", "n", "s", "m").collect()
    assert sorted(map(tuple, plain), key=repr) == sorted(map(tuple, sliced), key=repr)
    assert any(r.s is None for r in plain)


def test_events_table_may_be_a_folder_of_part_files(spark, tmp_path):
    from mercato.streaming.events import event_stream

    src = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    src.repartition(5).write.parquet(str(tmp_path / "events.parquet"))
    q = (event_stream(spark, str(tmp_path), files_per_trigger=2).writeStream.format("memory").queryName("folder_events")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.table("folder_events").count() == src.count()


@SETTINGS
@given(spans=st.lists(st.tuples(st.integers(0, 3), st.integers(-9, 9), day, st.integers(-1, 30)), max_size=12),
       base=st.sampled_from([0, 5 << 40, (1 << 60) - 1]))
def test_repeated_day_keys_equal_the_unfolded_count(spark, spans, base):
    """Entities whose hashes lie a few steps apart, so that days of different ones do collide."""
    rows = [((base + e * 3 + shift * C.DAY_STEP) % (1 << 60), d, d + dt.timedelta(days=n)) for e, shift, d, n in spans]
    df = spark.createDataFrame(rows, "entity bigint, first_day date, last_day date")
    dense = explode_days(df, "first_day", "last_day", "d").groupBy(day_key("entity", "d").alias("k")).count()
    assert repeated_day_keys(df).first()[0] == dense.filter("count > 1").count()
