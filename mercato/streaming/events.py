"""Structured Streaming jobs over the ``events`` table.

The reference states refresh cadences (15-minute sales batches, late refunds,
dedup before reporting, a 4-hourly stock view, CDC upserts, trailing 30-day
units); these jobs implement them with watermarks, windows, keyed session
state, ``dropDuplicatesWithinWatermark`` and ``foreachBatch``. Results that change
are kept in a :class:`~mercato.sources.versioned.VersionedTable`: a micro-batch
upserts what it changed, and only the buckets it touches are rewritten.

Each job reads the events parquet as a stream, runs with
``trigger(availableNow=True)`` (process everything present, then stop) and
writes to a fresh folder under the shared checkpoint directory, with its
checkpoint beside it, so a lost executor or a restarted driver resumes from
the committed offsets. The result is read back as a batch DataFrame.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..sources.ingest import scratch_dir
from ..sources.versioned import VersionedTable

WATERMARK = "1 hour"


def event_stream(spark: SparkSession, sf_dir: str, name: str = "events.parquet",
                 files_per_trigger: int = 1000) -> DataFrame:
    """The events table as a stream: one file of that name, or a folder of
    part files, ``files_per_trigger`` of them a micro-batch."""
    found = spark.read.parquet(f"{sf_dir}/{name}")
    s = spark.readStream.schema(found.schema).option("maxFilesPerTrigger", files_per_trigger)
    if all(f.endswith(f"/{name}") for f in found.inputFiles()):
        s = s.option("pathGlobFilter", name).parquet(sf_dir)
    else:
        s = s.parquet(f"{sf_dir}/{name}")
    # Event-time operators need TIMESTAMP (the file holds TIMESTAMP_NTZ).
    return s.withColumn("ts", F.col("ts").cast("timestamp"))


def _run(df: DataFrame, name: str, batch_fn=None, mode: str = "append", root: str | None = None) -> str:
    """Process everything present and stop; returns the job's folder. A job that
    is started again in the same ``root`` goes on after its committed offsets."""
    root = root or scratch_dir(df.sparkSession, f"stream-{name}")
    out, ckpt = os.path.join(root, "out"), os.path.join(root, "checkpoint")
    w = df.writeStream.option("checkpointLocation", ckpt).trigger(availableNow=True).outputMode(mode)
    q = w.format("parquet").option("path", out).start() if batch_fn is None else w.foreachBatch(batch_fn).start()
    q.awaitTermination()
    return root


def run_updates(df: DataFrame, name: str, target: Callable[[str], VersionedTable], root: str | None = None) -> VersionedTable:
    """Update mode: a micro-batch brings only the rows it changed, and these
    replace the target's rows of the same key. State that the watermark has
    passed leaves the state store; what it said stays in the target. The target
    knows the batches it holds, so a batch repeated after a failure changes
    nothing."""
    root = root or scratch_dir(df.sparkSession, f"stream-{name}")
    table = target(os.path.join(root, "target"))

    def upsert(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            table.apply(batch, batch=number)
        finally:
            batch.unpersist()

    _run(df, name, upsert, "update", root)
    return table


def _ntz(c: str) -> F.Column:
    return F.col(c).cast("timestamp_ntz")


def _purchases(stream: DataFrame) -> DataFrame:
    return stream.filter(F.col("event_type") == "purchase").withWatermark("ts", WATERMARK)


def _sales() -> list[F.Column]:
    return [F.count(F.lit(1)).alias("purchases"), F.sum(F.col("value").cast("decimal(18,2)")).alias("purchase_value")]


#: Windows of one day share a bucket, so days that are over are not rewritten.
BY_DAY = ["date_trunc('day', window_start)"]


def window_totals(stream: DataFrame, window: F.Column, name: str, totals: Sequence[F.Column], by: Sequence[str] = (),
                  root: str | None = None) -> VersionedTable:
    """Totals per time window (and ``by``) of a watermarked stream, kept up to
    date in a table of (window_start, window_end, ...)."""
    agg = stream.groupBy(window.alias("window"), *by).agg(*totals)
    flat = agg.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *agg.columns[1:])
    return run_updates(flat, name, lambda at: VersionedTable(stream.sparkSession, at, flat.schema, ["window_start", "window_end", *by], spread=BY_DAY), root)


def tumbling_sales_15min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """15-minute tumbling totals of purchase events: every window, the open ones
    with what has arrived."""
    table = window_totals(_purchases(event_stream(spark, sf_dir)), F.window("ts", "15 minutes"), "tumbling", _sales())
    return table.read().select(_ntz("window_start").alias("window_start"), _ntz("window_end").alias("window_end"), "purchases",
                               F.col("purchase_value").cast("double").alias("purchase_value"))


def tumbling_sales_15min_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append mode: a window is emitted once the watermark passes its end, so
    windows ending after max(ts) - delay stay open; late rows are dropped."""
    agg = _purchases(event_stream(spark, sf_dir)).groupBy(F.window("ts", "15 minutes")).agg(F.count(F.lit(1)).alias("purchases"))
    out = os.path.join(_run(agg, "tumbling-append"), "out")
    return spark.read.parquet(out).select(_ntz("window.start").alias("window_start"), "purchases")


def stock_view_4h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """4-hourly view with its 'as of' time (latest event in the window)."""
    table = window_totals(event_stream(spark, sf_dir).withWatermark("ts", WATERMARK), F.window("ts", "4 hours"), "stock4h",
                          [F.count(F.lit(1)).alias("events"), F.max("ts").alias("as_of")], by=["event_type"])
    return table.read().select(_ntz("window_start").alias("window_start"), "event_type", "events", _ntz("as_of").alias("as_of"))


def sliding_30d_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trailing 30-day purchase value, sliding by one day."""
    table = window_totals(_purchases(event_stream(spark, sf_dir)), F.window("ts", "30 days", "1 day"), "sliding", _sales())
    return table.read().select(_ntz("window_start").alias("window_start"), "purchases", F.col("purchase_value").cast("double").alias("purchase_value"))


SESSION = "user_id long, session_start timestamp, session_end timestamp, events long, deleted boolean"


def session_changes(stream: DataFrame, gap: str) -> DataFrame:
    """Changes of sessions per user (update mode): events closer than ``gap``
    share a session. The state holds the sessions that can still grow; one that
    the watermark has passed is dropped from it. A late event may join two
    sessions or begin one earlier: the row it replaces is marked deleted."""
    width = int(pd.Timedelta(gap) / pd.Timedelta(microseconds=1))

    def step(key, parts, state):
        if state.exists:
            opened = [list(s) for s in zip(*state.get, strict=True)]
        else:
            opened = []
        before = {tuple(s) for s in opened}
        merged: list[list[int]] = []
        times = [] if state.hasTimedOut else np.concatenate([p["ts"].to_numpy().astype("datetime64[us]").astype(np.int64) for p in parts]).tolist()
        for start, end, n in sorted([*opened, *([t, t + width, 1] for t in times)]):
            if merged and start < merged[-1][1]:
                merged[-1][1:] = max(merged[-1][1], end), merged[-1][2] + n
            else:
                merged.append([start, end, n])
        changed = [(s, False) for s in merged if tuple(s) not in before]
        starts = {s[0] for s in merged}
        changed += [(s, True) for s in opened if s[0] not in starts]
        passed = state.getCurrentWatermarkMs()
        held = [s for s in merged if s[1] > passed * 1000]
        if held:
            state.update(tuple(list(c) for c in zip(*held, strict=True)))
            state.setTimeoutTimestamp(max(passed + 1, -(-min(s[1] for s in held) // 1000)))
        else:
            state.remove()
        if changed:
            at = [pd.Series([s[i] for s, _ in changed]).astype("datetime64[us]") for i in (0, 1)]
            yield pd.DataFrame({"user_id": [key[0]] * len(changed), "session_start": at[0], "session_end": at[1], "events": [s[2] for s, _ in changed], "deleted": [gone for _, gone in changed]})

    return stream.select("user_id", "ts").groupBy("user_id").applyInPandasWithState(
        step, SESSION, "starts array<long>, ends array<long>, events array<long>", "update", GroupStateTimeout.EventTimeTimeout)


def sessions(spark: SparkSession, sf_dir: str, gap: str = "30 minutes") -> DataFrame:
    """Sessions per user, open ones included."""
    changes = session_changes(event_stream(spark, sf_dir).withWatermark("ts", WATERMARK), gap)
    table = run_updates(changes, "sessions", lambda at: session_table(spark, at))
    return table.read().select("user_id", _ntz("session_start").alias("session_start"), _ntz("session_end").alias("session_end"), "events")


def session_table(spark: SparkSession, at: str) -> VersionedTable:
    return VersionedTable(spark, at, SESSION.replace(", deleted boolean", ""), ["user_id", "session_start"], spread=["user_id"])


def dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop repeated deliveries of the same event id within the watermark."""
    e = event_stream(spark, sf_dir).withWatermark("ts", WATERMARK)
    d = e.dropDuplicatesWithinWatermark(["event_id"])
    out = os.path.join(_run(d.select("event_id", "user_id", "event_type", "ts", "value"), "dedup"), "out")
    return spark.read.parquet(out).select("event_id", "user_id", "event_type", _ntz("ts").alias("ts"), "value")


# -- arrivals: the events in the order in which they come in ----------------------------

# Chosen values: an event is up to 12 hours under way (by its ``k``), and the job runs every fifteen days.
ARRIVAL_HOURS, ARRIVAL_STEP, RUN_DAYS = 3, 20, 15


def arrivals(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The events as they arrive: each one up to some hours late, cut into the
    runs of a job that is started every ``RUN_DAYS`` days."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    late = F.coalesce(F.floor(F.get_json_object("props", "$.k").cast("int") / ARRIVAL_STEP), F.lit(0)) * ARRIVAL_HOURS
    run = F.floor((F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000 + late * 3600) / (86_400 * RUN_DAYS))
    runs = [r.run for r in e.select(run.alias("run")).distinct().orderBy("run").collect()]  # one per calendar step
    return [e.where(run == n) for n in runs]


def run_arrivals(spark: SparkSession, sf_dir: str, name: str, job: Callable[[DataFrame, str], None]) -> str:
    """Land one run's files after another and start ``job(stream, root)`` after
    each: the stream goes on where its checkpoint ends."""
    root = scratch_dir(spark, f"stream-{name}")
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    for number, part in enumerate(arrivals(spark, sf_dir)):
        part.write.parquet(os.path.join(root, "landed", f"run-{number:05d}"))
        stream = spark.readStream.schema(schema).parquet(os.path.join(root, "landed", "*"))
        job(stream.withColumn("ts", F.col("ts").cast("timestamp")), root)
    return root


# -- change data capture ------------------------------------------------------------------

PROFILE = "user_id long, ts timestamp, event_id long, tier_code int"


def profile_table(spark: SparkSession, at: str) -> VersionedTable:
    """Latest profile per user; the latest change wins (by time, then id)
    whatever the order of arrival."""
    return VersionedTable(spark, at, PROFILE, ["user_id"], order=["ts", "event_id"])


def profile_changes(stream: DataFrame, closing: Sequence[str] = ()) -> DataFrame:
    """Sign-ups set the profile's code; an event of a ``closing`` type deletes it."""
    return (stream.filter(F.col("event_type").isin("signup", *closing))
            .select("user_id", "ts", "event_id", F.get_json_object("props", "$.k").cast("int").alias("tier_code"),
                    F.col("event_type").isin(*closing).alias("deleted") if closing else F.lit(False).alias("deleted")))


def apply_changes(changes: DataFrame, target: VersionedTable, root: str | None = None) -> None:
    """Merge a stream of changes into ``target``, one version a micro-batch."""
    _run(changes, "cdc", lambda batch, number: target.apply(batch, batch=number) and None, root=root)


def _profiles(table: VersionedTable) -> DataFrame:
    return table.read().select("user_id", _ntz("ts").alias("changed_at"), "event_id", "tier_code")


def cdc_upsert(spark: SparkSession, sf_dir: str, glob: str = "events.parquet") -> DataFrame:
    """CDC of a customer attribute: sign-up events carry a profile code; the
    target keeps the latest code per user."""
    table = profile_table(spark, os.path.join(scratch_dir(spark, "stream-cdc"), "target"))
    apply_changes(profile_changes(event_stream(spark, sf_dir, glob)), table)
    return _profiles(table)


def cdc_with_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over the arrivals, where an ``error`` event closes a profile and
    the next sign-up opens it again: changes come out of order, a tombstone keeps
    an earlier sign-up from bringing a closed profile back."""
    root = run_arrivals(spark, sf_dir, "cdc-deletes", lambda stream, at: apply_changes(
        profile_changes(stream, ["error"]), profile_table(spark, os.path.join(at, "target")), at))
    return _profiles(profile_table(spark, os.path.join(root, "target")))


# -- late rows ----------------------------------------------------------------------------


class LateSplit:
    """15-minute totals of the rows that are in time, and a side table of the
    rows that are not: their window had ended, by the largest time of all earlier
    batches less ``delay``, before their batch came. Everything is kept per batch
    (the rows, the batch's largest time) or knows its batch (the totals), so a
    repeated batch gives the same."""

    def __init__(self, spark: SparkSession, root: str, delay: str = WATERMARK):
        self.spark, self.root, self.delay = spark, root, delay
        self.totals = VersionedTable(spark, f"{root}/totals", "window_start timestamp, window_end timestamp, events long", ["window_start", "window_end"], spread=BY_DAY)

    def _seen(self) -> DataFrame:
        return self.spark.read.schema("max_ts timestamp, batch long").parquet(f"{self.root}/seen")

    def watermark(self, before: int | None = None) -> DataFrame:
        """One row: the watermark that held ``before`` a batch (default: now)."""
        seen = self._seen() if before is None else self._seen().where(F.col("batch") < before)
        return seen.agg((F.max("max_ts") - F.expr(f"INTERVAL {self.delay}")).alias("watermark"))

    def take(self, batch: DataFrame, number: int) -> None:
        largest = batch.agg(F.max("ts").alias("max_ts"))
        mark = self.watermark(number).select(F.unix_micros("watermark")).first()[0] if number else None
        window = batch.withColumn("window", F.window("ts", "15 minutes"))
        late = F.unix_micros("window.end") <= F.lit(mark) if mark is not None else F.lit(False)
        window.where(late).drop("window").write.mode("overwrite").parquet(f"{self.root}/late/batch={number}")
        fresh = (window.where(~late).groupBy(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"))
                 .agg(F.count(F.lit(1)).alias("events")))
        keys = ["window_start", "window_end"]
        known = self.totals.read().withColumnRenamed("events", "_events")
        self.totals.apply(fresh.join(known, keys, "left").select(*keys, (F.col("events") + F.coalesce("_events", F.lit(0))).alias("events")), batch=number)
        largest.write.mode("overwrite").parquet(f"{self.root}/seen/batch={number}")

    def run(self, stream: DataFrame) -> None:
        _run(stream, "late", self.take, root=self.root)

    def closed(self) -> DataFrame:
        """Totals of the windows that nothing can reach any more."""
        return self.totals.read().crossJoin(F.broadcast(self.watermark())).where("window_end <= watermark").select(_ntz("window_start").alias("window_start"), "events")

    def late(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/late")


def late_rows_report(spark: SparkSession, events_dir: str, glob: str = "*.parquet",
                     delay: str = WATERMARK) -> tuple[DataFrame, int]:
    """Closed windows and the number of late rows over the files of
    ``events_dir``, one file per micro-batch."""
    schema = spark.read.parquet(events_dir).schema
    e = (spark.readStream.schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", 1)
         .parquet(events_dir).withColumn("ts", F.col("ts").cast("timestamp")))
    split = LateSplit(spark, scratch_dir(spark, "stream-late"), delay)
    split.run(e)
    return split.closed(), split.late().count()


def _late_split(spark: SparkSession, sf_dir: str) -> LateSplit:
    return LateSplit(spark, run_arrivals(spark, sf_dir, "late", lambda stream, root: LateSplit(spark, root).run(stream)))


def late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """15-minute totals of the arrivals that the watermark has closed, with the
    number of rows that came too late for their window."""
    split = _late_split(spark, sf_dir)
    missed = split.late().groupBy(F.window("ts", "15 minutes").alias("window")).agg(F.count(F.lit(1)).alias("late_rows")) \
        .select(_ntz("window.start").alias("window_start"), "late_rows")
    return (split.closed().join(missed, "window_start", "full")
            .select("window_start", F.coalesce("events", F.lit(0)).alias("events"), F.coalesce("late_rows", F.lit(0)).alias("late_rows")))


def late_event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The late rows themselves, with the number of the run they came in."""
    return _late_split(spark, sf_dir).late().select("event_id", "user_id", "event_type", _ntz("ts").alias("ts"), "value", F.col("batch").cast("bigint").alias("batch"))
