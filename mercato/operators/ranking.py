"""Row numbers and running sums within a group that stay balanced when one
group is huge.

``row_number()`` / ``sum() OVER (PARTITION BY key ORDER BY ...)`` sorts a whole
group in one task. Here the groups are first counted on a sample (a partial aggregate); groups
estimated above half of ``max_group_rows`` are hot, and there can be at most
about 2 x total/max_group_rows of them, so their key list is small enough to
broadcast.
Normal groups use the plain window. Hot groups are range-partitioned on
(key, order), which spreads one group over many tasks in order; each task
numbers and sums its slice, and the counts and sums of the earlier slices (one
row per (slice, hot key)) give the offsets. The slice of every hot row is fixed
by a reliable checkpoint before it is used twice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_within(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   rank: str | None = None, sums: Mapping[str, str] | None = None,
                   maxes: Mapping[str, str] | None = None,
                   max_group_rows: int = 2_000_000, sample_fraction: float = 0.01) -> DataFrame:
    """``df`` plus ``rank`` (1-based position in the group by ``order``) and,
    for each ``out: col`` of ``sums`` / ``maxes``, the running sum / max of
    ``col`` up to and including the row. ``order`` must be unique within a
    group when ``rank`` is asked for.

    Hot groups are found on a seeded sample (``sample_fraction`` of the rows,
    estimate > half the threshold): the detection only chooses the plan, and
    both plans are exact, so a sample keeps the results exact while the
    counting shuffle shrinks to the sample."""
    keys, sums, maxes = list(keys), dict(sums or {}), dict(maxes or {})
    src = df if sample_fraction >= 1.0 else df.sample(fraction=sample_fraction, seed=17)
    counts = src.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    limit = max_group_rows if sample_fraction >= 1.0 else max_group_rows * sample_fraction / 2
    hot = counts.filter(F.col("__n") > limit).select(*keys)
    if hot.limit(1).count() == 0:          # the common case: no hot group
        return _windowed(df, keys, order, rank, sums, maxes)
    cold = _windowed(df.join(F.broadcast(hot), keys, "left_anti"), keys, order, rank, sums, maxes)
    return cold.unionByName(_sliced(df.join(F.broadcast(hot), keys, "left_semi"), keys, order, rank, sums, maxes))


def row_number_within(df: DataFrame, key: str, order: Sequence[str], out: str,
                      max_group_rows: int = 2_000_000, sample_fraction: float = 0.01) -> DataFrame:
    return running_within(df, [key], order, rank=out, max_group_rows=max_group_rows,
                          sample_fraction=sample_fraction)


def _windowed(df, keys, order, rank, sums, maxes, extra=()):
    w = Window.partitionBy(*extra, *keys).orderBy(*order)
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    out = df
    if rank:
        out = out.withColumn(rank, F.row_number().over(w))
    for name, c in sums.items():
        out = out.withColumn(name, F.sum(c).over(run))
    for name, c in maxes.items():
        out = out.withColumn(name, F.max(c).over(run))
    return out


def _sliced(h: DataFrame, keys, order, rank, sums, maxes) -> DataFrame:
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(h.sparkSession)          # the session's shared folder; set only if unset
    n = int(h.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = (h.repartitionByRange(n, *keys, *order).withColumn("__slice", F.spark_partition_id())
              .checkpoint(eager=True))
    local = _windowed(sliced, keys, order, rank, sums, maxes, extra=("__slice",))
    per = sliced.groupBy("__slice", *keys).agg(
        F.count(F.lit(1)).alias("__c"), *[F.sum(c).alias(f"__s_{name}") for name, c in sums.items()],
        *[F.max(c).alias(f"__m_{name}") for name, c in maxes.items()])
    before = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select("__slice", *keys, F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__off"),
                         *[F.sum(f"__s_{name}").over(before).alias(f"__o_{name}") for name in sums],
                         *[F.max(f"__m_{name}").over(before).alias(f"__p_{name}") for name in maxes])
    # offsets: one row per (slice, hot key) <= slices + hot keys: broadcast.
    out = local.join(F.broadcast(offsets), ["__slice", *keys])
    if rank:
        out = out.withColumn(rank, (F.col("__off") + F.col(rank)).cast("int"))
    for name in sums:
        # NULL only while no earlier row has a value, as the plain window
        carried, own = F.col(f"__o_{name}"), F.col(name)
        out = out.withColumn(name, F.coalesce(carried + own, carried, own))
    for name in maxes:
        out = out.withColumn(name, F.greatest(F.col(f"__p_{name}"), F.col(name)))
    return out.drop("__slice", "__off", *[f"__o_{name}" for name in sums], *[f"__p_{name}" for name in maxes])
