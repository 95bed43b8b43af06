"""Streaming semantics on small hand-written event files."""

import datetime as dt
import os
import tempfile

from mercato.streaming.events import late_rows_report

TS = dt.datetime
SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _batches_dir(spark, batches, names=None):
    """One parquet file per micro-batch, ordered by modification time."""
    flat = tempfile.mkdtemp(prefix="mercato-late-")
    for i, rows in enumerate(batches):
        sub = tempfile.mkdtemp(prefix="mercato-late-src-")
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(os.path.join(sub, "o"))
        src = [f for f in os.listdir(os.path.join(sub, "o")) if f.endswith(".parquet")][0]
        dst = os.path.join(flat, names[i] if names else f"part-{i}.parquet")
        os.link(os.path.join(sub, "o", src), dst)
        os.utime(dst, (1_700_000_000 + i * 100,) * 2)
    return flat


def test_late_rows_are_dropped_and_counted(spark):
    # Spark filters late rows with the watermark of the previous batch, so
    # the late event arrives in the third batch (watermark 12:05 - 1h = 11:05).
    batches = [[(1, TS(2024, 1, 1, 10, 0), 1, "purchase", 5.0, "{}"), (2, TS(2024, 1, 1, 12, 5), 1, "purchase", 5.0, "{}")],
               [(3, TS(2024, 1, 1, 13, 30), 2, "purchase", 7.0, "{}")],
               [(4, TS(2024, 1, 1, 9, 0), 2, "refund", -7.0, "{}"), (5, TS(2024, 1, 1, 13, 40), 3, "purchase", 1.0, "{}")]]
    windows, dropped = late_rows_report(spark, _batches_dir(spark, batches))
    starts = {r.window_start: r.events for r in windows.collect()}
    assert dropped == 1                                   # the 09:00 refund came after the watermark
    assert TS(2024, 1, 1, 9, 0) not in starts
    assert starts == {TS(2024, 1, 1, 10, 0): 1, TS(2024, 1, 1, 12, 0): 1}   # closed windows only


def test_dedup_within_watermark_and_cdc_latest(spark):
    from mercato.streaming.events import cdc_upsert, dedup_events
    rows = [(1, TS(2024, 1, 1, 10, 0), 7, "signup", 1.0, '{"k": 3}'),
            (1, TS(2024, 1, 1, 10, 0), 7, "signup", 1.0, '{"k": 3}'),     # repeated delivery
            (2, TS(2024, 1, 2, 9, 0), 7, "signup", 1.0, '{"k": 5}'),      # later change wins
            (3, TS(2024, 1, 2, 9, 0), 8, "signup", 1.0, '{"k": 9}')]
    flat = _batches_dir(spark, [rows], names=["events.parquet"])
    ids = sorted(r.event_id for r in dedup_events(spark, flat).collect())
    assert ids == [1, 2, 3]
    latest = {r.user_id: (r.event_id, r.tier_code) for r in cdc_upsert(spark, flat).collect()}
    assert latest == {7: (2, 5), 8: (3, 9)}


def test_cdc_upsert_merges_across_batches(spark):
    from mercato.streaming.events import cdc_upsert
    b1 = [(1, TS(2024, 1, 1, 10, 0), 7, "signup", 1.0, '{"k": 3}'),
          (2, TS(2024, 1, 3, 10, 0), 8, "signup", 1.0, '{"k": 4}')]
    b2 = [(3, TS(2024, 1, 5, 9, 0), 7, "signup", 1.0, '{"k": 6}'),      # newer: replaces
          (4, TS(2024, 1, 2, 9, 0), 8, "signup", 1.0, '{"k": 1}'),      # older: ignored
          (5, TS(2024, 1, 4, 9, 0), 9, "signup", 1.0, '{"k": 2}')]      # new key
    flat = _batches_dir(spark, [b1, b2], names=["e1.parquet", "e2.parquet"])
    latest = {r.user_id: (r.event_id, r.tier_code) for r in cdc_upsert(spark, flat, glob="e*.parquet").collect()}
    assert latest == {7: (3, 6), 8: (2, 4), 9: (5, 2)}


# -- update mode, deletions, late rows over many micro-batches ---------------------------


def _event(i, minute, user, kind="purchase", k=1):
    return i, TS(2024, 1, 1) + dt.timedelta(minutes=minute), user, kind, float(i % 7), f'{{"k": {k}}}'


def _stream(spark, flat):
    from pyspark.sql import functions as F
    schema = spark.read.parquet(flat).schema
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(flat).withColumn("ts", F.col("ts").cast("timestamp")))


def _many_batches(spark, n, rows_of):
    """``n`` micro-batches written by one job, one file each, in order of time."""
    rows = [r + (b,) for b in range(n) for r in rows_of(b)]
    flat, out = tempfile.mkdtemp(prefix="mercato-many-"), os.path.join(tempfile.mkdtemp(prefix="mercato-many-src-"), "o")
    spark.createDataFrame(rows, SCHEMA + ", b int").repartition(1).write.partitionBy("b").parquet(out)
    for b in range(n):
        src = [f for f in os.listdir(f"{out}/b={b}") if f.endswith(".parquet")][0]
        os.link(f"{out}/b={b}/{src}", f"{flat}/part-{b:04d}.parquet")
        os.utime(f"{flat}/part-{b:04d}.parquet", (1_700_000_000 + b * 100,) * 2)
    return flat, [r[:-1] for r in rows]


MICRO_BATCHES = int(os.environ.get("MERCATO_MICRO_BATCHES", "60"))   # README: also run with 200


def test_state_stays_bounded_over_many_micro_batches(spark):
    """Update mode: windows leave the state once the watermark has passed them,
    and the batches' last words per window add up to the batch result."""
    from pyspark.sql import functions as F
    from mercato.streaming.events import WATERMARK
    flat, rows = _many_batches(spark, MICRO_BATCHES, lambda b: [_event(4 * b + i, 30 * b + 11 * i, i) for i in range(4)])
    agg = _stream(spark, flat).withWatermark("ts", WATERMARK).groupBy(F.window("ts", "15 minutes")).agg(F.count(F.lit(1)).alias("n"))
    usual = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.streaming.numRecentProgressUpdates")}
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "300")
    held = {}
    try:
        q = (agg.writeStream.outputMode("update").trigger(availableNow=True).option("checkpointLocation", tempfile.mkdtemp(prefix="mercato-ck-"))
             .foreachBatch(lambda batch, i: held.update({r.window.start: r.n for r in batch.collect()})).start())
        q.awaitTermination()
        state = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    finally:
        for c, v in usual.items():
            spark.conf.set(c, v)
    assert len(state) >= MICRO_BATCHES and max(state) < 12 < MICRO_BATCHES < len(held)
    want = {}
    for r in rows:
        start = r[1] - dt.timedelta(minutes=r[1].minute % 15)
        want[start] = want.get(start, 0) + 1
    assert held == want


def test_window_totals_over_batches_equal_the_whole(spark):
    """Windows that several batches touch, and a target that keeps closed days' files."""
    from pyspark.sql import functions as F
    from mercato.streaming.events import BY_DAY, WATERMARK, window_totals
    flat, rows = _many_batches(spark, 6, lambda b: [_event(9 * b + i, 600 * b + 7 * i, i) for i in range(9)] + ([_event(100 + b, 600 * b - 20, 1)] if b else []))
    stream = _stream(spark, flat).withWatermark("ts", WATERMARK)
    table = window_totals(stream, F.window("ts", "15 minutes"), "t", [F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last")])
    want = {}
    for i, ts, *_ in rows:
        start = ts - dt.timedelta(minutes=ts.minute % 15)
        n, last = want.get(start, (0, -1))
        want[start] = n + 1, max(last, i)
    got = {r.window_start: (r.n, r["last"]) for r in table.read().select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n", "last").collect()}
    assert got == want and table.spread == BY_DAY and len(table.versions()) >= 6


def test_sessions_across_batches_and_late_joins(spark):
    from pyspark.sql import functions as F
    from mercato.streaming.events import WATERMARK, run_updates, session_changes, session_table
    batches = [[_event(1, 0, 1), _event(2, 50, 1), _event(3, 10, 2)],
               [_event(4, 25, 1)],                        # joins 00:00 and 00:50 of user 1
               [_event(5, 8, 2), _event(6, 300, 1)],      # begins user 2's session earlier
               [_event(7, 329, 1), _event(8, 600, 3)],
               [_event(9, 605, 3), _event(10, 635, 3)]]   # the gap itself begins a new session
    flat = _batches_dir(spark, batches)
    changes = session_changes(_stream(spark, flat).withWatermark("ts", WATERMARK), "30 minutes")
    table = run_updates(changes, "sessions-test", lambda at: session_table(spark, at))
    got = sorted((r.user_id, int(r.a), int(r.b), r.events) for r in table.read().select(
        "user_id", "events", ((F.unix_seconds("session_start") - 1704067200) / 60).alias("a"), ((F.unix_seconds("session_end") - 1704067200) / 60).alias("b")).collect())
    assert got == [(1, 0, 80, 3), (1, 300, 359, 2), (2, 8, 40, 2), (3, 600, 635, 2), (3, 635, 665, 1)]


def test_cdc_deletes_reinserts_replay_and_schema(spark):
    import pytest
    from mercato.sources.versioned import VersionedTable
    from mercato.streaming.events import apply_changes, profile_changes, profile_table
    batches = [[_event(1, 0, 7, "signup", 3), _event(2, 1, 8, "signup", 4), _event(3, 2, 9, "signup", 5)],
               [_event(4, 10, 7, "error"), _event(5, 10, 8, "error")],
               [_event(6, 5, 7, "signup", 6), _event(7, 20, 8, "signup", 9)],   # 7: older than its deletion; 8: again
               [_event(8, 30, 9, "error"), _event(9, 29, 9, "signup", 1)]]
    flat = _batches_dir(spark, batches)
    root = tempfile.mkdtemp(prefix="mercato-cdc-")
    table = profile_table(spark, os.path.join(root, "target"))
    apply_changes(profile_changes(_stream(spark, flat), ["error"]), table, root)
    latest = lambda: {r.user_id: (r.event_id, r.tier_code) for r in table.read().collect()}
    assert latest() == {8: (7, 9)}
    versions = table.versions()
    # the checkpoint is lost: every batch comes again, none is applied again
    apply_changes(profile_changes(_stream(spark, flat), ["error"]), table, tempfile.mkdtemp(prefix="mercato-cdc-"))
    assert latest() == {8: (7, 9)} and table.versions() == versions
    wrong = VersionedTable(spark, table.root, "user_id long, tier_code int", ["user_id"])
    with pytest.raises(Exception, match="holds user_id"):
        apply_changes(profile_changes(_stream(spark, flat)), wrong, tempfile.mkdtemp(prefix="mercato-cdc-"))
    assert latest() == {8: (7, 9)}


def test_late_split_keeps_the_rows_and_repeats_batches_alike(spark):
    from pyspark.sql import functions as F
    from mercato.streaming.events import LateSplit
    batches = [[_event(1, 600, 1), _event(2, 725, 1)], [_event(3, 540, 2, "refund"), _event(4, 662, 2), _event(5, 810, 3)], [_event(6, 720, 4), _event(7, 811, 4)]]
    split = LateSplit(spark, tempfile.mkdtemp(prefix="mercato-latesplit-"))
    frames = [spark.createDataFrame(b, SCHEMA).withColumn("ts", F.col("ts").cast("timestamp")) for b in batches]
    for number, frame in enumerate(frames):
        split.take(frame, number)
    late = lambda: sorted((r.event_id, r.batch) for r in split.late().collect())
    windows = lambda: {(r.window_start.hour, r.window_start.minute): r.events for r in split.closed().collect()}
    assert late() == [(3, 1), (6, 2)]                     # watermarks: 11:05 for batch 1, 12:30 for batch 2
    assert windows() == {(10, 0): 1, (11, 0): 1, (12, 0): 1}
    split.take(frames[1], 1)
    split.take(frames[2], 2)
    assert late() == [(3, 1), (6, 2)] and windows() == {(10, 0): 1, (11, 0): 1, (12, 0): 1}
    assert split.totals.read().agg(F.sum("events")).first()[0] == 5
