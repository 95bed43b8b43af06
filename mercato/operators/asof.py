"""As-of join: for each left row, the latest right row of the same key whose
time is <= the left time (ties broken by the right tie columns, greatest wins).

Two exact plans:

* **bounded right side** (a campaign calendar, a price list): the right rows of
  each key are packed into one sorted array and broadcast; each left row finds
  the last element not after its time by binary search, so its work grows with
  the logarithm of the key's rows. Narrow: no shuffle of the left side. The
  right side's bytes are summed first; the plan is used only below the session's
  broadcast threshold (``max_broadcast_bytes`` overrides it).
* **large right side**: both sides are cut into (key, month) buckets. Inside a
  bucket a running ``max`` over the union of both sides finds the latest right
  row; the latest right row of all earlier months is carried in from a small
  per-(key, month) table. No key is ever processed in one task as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .core import row_bytes
from .ranking import running_within


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str],
              left_time: str, right_time: str, values: Sequence[str],
              tie: Sequence[str] = (), max_broadcast_bytes: int | None = None,
              force: str | None = None, max_group_rows: int = 2_000_000,
              sample_fraction: float = 0.01) -> DataFrame:
    """Left rows plus ``values`` of the matched right row (NULL when none)."""
    by = list(by)
    plan = force
    if plan is None:
        limit = broadcast_limit(right.sparkSession) if max_broadcast_bytes is None else max_broadcast_bytes
        size = right.agg(F.sum(row_bytes(right, [*by, right_time, *tie, *values]))).first()[0] or 0
        plan = "broadcast" if size <= limit else "bucketed"
    if plan == "broadcast":
        return _asof_broadcast(left, right, by, left_time, right_time, values, tie)
    return _asof_bucketed(left, right, by, left_time, right_time, values, tie, max_group_rows,
                          sample_fraction)


def broadcast_limit(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes; 0 if it is off."""
    said = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    unit = {"k": 10, "m": 20, "g": 30, "t": 40}
    number = said.rstrip("b")
    return max(0, int(number[:-1]) << unit[number[-1]] if number[-1:] in unit else int(number))


def last_not_after(cands: Column, time: Column) -> Column:
    """The last element of a sorted array of structs whose ``__t`` is not after
    ``time``, by binary search (NULL if there is none)."""
    steps = F.ceil(F.log2(F.size(cands) + 1)).cast("int")

    def halve(s, _):
        middle = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        fits = F.try_element_at(cands, middle + 1)["__t"] <= time
        low = F.when((s["lo"] < s["hi"]) & fits, middle + 1).otherwise(s["lo"])
        high = F.when((s["lo"] < s["hi"]) & ~F.coalesce(fits, F.lit(False)), middle).otherwise(s["hi"])
        return F.struct(low.alias("lo"), high.alias("hi"))

    found = F.aggregate(F.sequence(F.lit(1), steps), F.struct(F.lit(0).alias("lo"), F.size(cands).alias("hi")), halve)["lo"]
    return F.when(found > 0, F.try_element_at(cands, found))


def _cand_struct(right_time: str, tie: Sequence[str], values: Sequence[str]):
    # Field order = comparison order: time, then tie-breakers, then payload.
    fields = [F.col(right_time).alias("__t")]
    fields += [F.col(t).alias(f"__tie{i}") for i, t in enumerate(tie)]
    fields += [F.col(v).alias(f"__v_{v}") for v in values]
    return F.struct(*fields)


def _asof_broadcast(left, right, by, left_time, right_time, values, tie):
    cands = (right.filter(F.col(right_time).isNotNull())
             .groupBy(*by)
             .agg(F.array_sort(F.collect_list(_cand_struct(right_time, tie, values)))
                  .alias("__cands")))
    joined = left.join(F.broadcast(cands), by, "left")
    out = joined.withColumn("__hit", last_not_after(F.col("__cands"), F.col(left_time)))
    for v in values:
        out = out.withColumn(v, F.col("__hit")[f"__v_{v}"])
    return out.drop("__cands", "__hit")


def _asof_bucketed(left, right, by, left_time, right_time, values, tie, max_group_rows=2_000_000,
                   sample_fraction=0.01):
    bucket = lambda c: F.trunc(F.col(c).cast("date"), "MM")
    r = (right.filter(F.col(right_time).isNotNull())
         .select(*by, bucket(right_time).alias("__b"),
                 _cand_struct(right_time, tie, values).alias("__c")))
    lcols = left.columns
    lt = left.withColumn("__b", bucket(left_time))
    # Latest right row per (key, month), then carried forward to later months.
    per_bucket = r.groupBy(*by, "__b").agg(F.max("__c").alias("__last"))
    months = (lt.select(*by, "__b").distinct()
              .unionByName(per_bucket.select(*by, "__b")).distinct()
              .join(per_bucket, [*by, "__b"], "left"))
    w_prev = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carry = months.withColumn("__carry", F.max("__last").over(w_prev)).select(*by, "__b", "__carry")
    # Inside a bucket: right rows sort before left rows at an equal time.
    lside = lt.select(*lcols, "__b",
                      F.col(left_time).alias("__t"), F.lit(1).alias("__side"),
                      F.lit(None).cast(r.schema["__c"].dataType).alias("__c"))
    rside = r.select(*[F.lit(None).cast(left.schema[c].dataType).alias(c) if c not in by else F.col(c)
                       for c in lcols],
                     "__b",
                     F.col("__c")["__t"].alias("__t"), F.lit(0).alias("__side"), "__c")
    # Running max of the right rows inside each (key, month); a hot bucket is
    # processed in ordered slices (running_within), not in one task.
    both = running_within(lside.unionByName(rside), [*by, "__b"], ["__t", "__side"],
                          maxes={"__in": "__c"}, max_group_rows=max_group_rows,
                          sample_fraction=sample_fraction)
    hits = (both.filter(F.col("__side") == 1)
            .join(carry, [*by, "__b"], "left")
            .withColumn("__hit", F.greatest("__in", "__carry")))
    out = hits
    for v in values:
        out = out.withColumn(v, F.col("__hit")[f"__v_{v}"])
    return out.select(*lcols, *[v for v in values if v not in lcols])
