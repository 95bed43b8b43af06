"""Reusable relational operators built from DataFrame primitives.

- ``lookup_key``: left join to a dimension + unknown-member key (-1).
- ``with_member``: append a literal member row (unknown / no-campaign).
- ``explode_days``: range join entity-window x calendar, written as a guarded
  ``sequence`` + ``explode`` (no join, no nested-loop plan).
- ``avg_percent_rank``: pandas-style ``rank(pct=True)`` (average ties), in slices.
- ``tier``: right-closed bins over a rank.
- ``top_n``: ordered limit with a full tie-breaker.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions.exprs import col


def lookup_key(fact: DataFrame, dim: DataFrame, fact_col: str, dim_col: str,
               key_col: str, out_col: str, bounded: bool = False, measured: bool = False) -> DataFrame:
    """Left join ``fact`` to ``dim`` on a natural key; missing -> -1.

    ``bounded=True`` marks dimensions whose size is fixed by construction
    (warehouses): those are broadcast explicitly. ``measured=True`` sums the
    bytes of a written dimension first and broadcasts it up to
    ``BROADCAST_BYTES``. All
    others are left to the planner, whose broadcast decision is checked against
    ``spark.sql.autoBroadcastJoinThreshold`` (and re-checked at runtime by AQE),
    falling back to a shuffle join when the dimension is large.
    """
    # Grouping by the natural key makes the dimension side provably unique:
    # the lookup can never fan the fact out, and Catalyst drops the whole join
    # from plans that never read the looked-up key.
    d = unique_by(dim.select(F.col(dim_col).alias("__nk"), F.col(key_col).alias("__sk")), "__nk", ["__sk"])
    if bounded:
        d = F.broadcast(d)
    elif measured and fits(dim, [dim_col, key_col]):
        d = F.broadcast(d)
    out = fact.join(d, fact[fact_col] == d["__nk"], "left")
    return out.withColumn(out_col, F.coalesce(F.col("__sk"), F.lit(C.UNKNOWN_KEY).cast("bigint"))) \
              .drop("__nk", "__sk")


#: Up to this size, as Spark holds the rows, a lookup side is sent to every executor.
BROADCAST_BYTES = 64 << 20


def row_bytes(df: DataFrame, columns: Sequence[str]) -> Column:
    """About the bytes of a row of ``columns`` as Spark holds it: eight a column
    and the text itself."""
    texts = [c for c in columns if df.schema[c].dataType.simpleString() in ("string", "binary")]
    size = F.lit(8 * len(columns) + 16).cast("long")
    for c in texts:
        size = size + F.coalesce(F.octet_length(F.col(c)), F.lit(0))
    return size


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if its rows, summed first, take at most
    ``limit`` bytes; else ``df``. The planner only guesses the size of a side
    that was grouped or joined, and shuffles the large side before it knows."""
    return F.broadcast(df) if fits(df, df.columns, limit) else df


def fits(df: DataFrame, columns: Sequence[str], limit: int = BROADCAST_BYTES) -> bool:
    """Whether the rows of ``columns``, summed, take at most ``limit`` bytes."""
    return (df.agg(F.sum(row_bytes(df, columns))).first()[0] or 0) <= limit


def with_member(dim: DataFrame, member: Mapping[str, object]) -> DataFrame:
    """``dim UNION ALL <one literal row>``; the row is typed from ``dim``'s schema."""
    spark = dim.sparkSession
    types = {f.name: f.dataType for f in dim.schema.fields}
    row = spark.range(1).select(*[
        F.lit(member.get(name)).cast(types[name]).alias(name) for name in dim.columns
    ])
    return dim.unionByName(row)


def explode_days(df: DataFrame, start: str | Column, end: str | Column, name: str) -> DataFrame:
    """One row per day in [start, end]; no row when start > end or either is NULL.

    ``sequence`` throws on a reversed range, so the guard is required.
    """
    s, e = col(start), col(end)
    days = F.when(s.isNotNull() & e.isNotNull() & (s <= e),
                  F.sequence(s, e, F.expr("INTERVAL 1 DAY")))
    return df.withColumn(name, F.explode(days))


def avg_percent_rank(df: DataFrame, value: str, out: str,
                     partition: Sequence[str] = (), slices: int = 256) -> DataFrame:
    """Average rank of ``value`` (ties share the mean of their ranks) / n.

    Computed on the distinct values and their counts, not on the rows, and in
    ``slices`` of the value range, cut at approximate percentiles of the
    distinct values: each slice is ranked on its own, and the rows below it come
    from the slices' totals (at most ``slices`` rows per partition key), so no
    task holds all values. The cuts choose the plan only; ranks are exact. Equal
    to pandas ``rank(method='average', pct=True)``. NULL values get no rank but
    count as rows, below every value.
    """
    parts = list(partition)
    counts = df.groupBy(*parts, value).agg(F.count(F.lit(1)).alias("__ties"))
    cuts = counts.select(F.percentile_approx(value, [i / slices for i in range(1, slices)])).scalar()
    place = F.array_position(F.sort_array(F.array_append(cuts, F.col(value))), F.col(value))
    sliced = counts.withColumn("__slice", F.coalesce(place, F.lit(0)))
    w_all = Window.partitionBy(*parts)
    w_slice = w_all.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = (sliced.groupBy(*parts, "__slice").agg(F.sum("__ties").alias("__in"))
              .select(*parts, "__slice", F.coalesce(F.sum("__in").over(w_slice), F.lit(0)).alias("__before"),
                      F.sum("__in").over(w_all).alias("__n")))
    w_own = Window.partitionBy(*parts, "__slice").orderBy(F.col(value).asc()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    ranked = (sliced.withColumn("__below", F.coalesce(F.sum("__ties").over(w_own), F.lit(0)))
              .join(totals, [*parts, "__slice"])
              .withColumn(out, (F.col("__before") + F.col("__below") + (F.col("__ties") + 1) / 2.0) / F.col("__n"))
              .select(*parts, value, out))
    return df.join(ranked, [*parts, value], "left")


def tier(rank: str | Column, bands=C.DEMAND_TIERS) -> Column:
    """Right-closed bins: first band whose upper edge is >= rank."""
    expr = None
    for hi, label in bands:
        cond = col(rank) <= hi
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def top_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """Top-N report rows; ``order`` must end with a unique tie-breaker."""
    return df.orderBy(*order).limit(n)


def unique_by(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """The row of each ``key``, so a left join on ``key`` cannot fan out and is
    removable when unused. That a key has one row is asserted, lazily: a second
    one fails the query that reads the columns, with the key. Rows without a key
    match nothing and are left out."""
    rows = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__rows"), *[F.max(c).alias(c) for c in cols])
    twice = F.raise_error(F.concat(F.lit(f"more than one row for {key} "), F.col(key).cast("string")))
    return rows.select(key, *[F.when(F.col("__rows") == 1, F.col(c)).otherwise(twice).alias(c) for c in cols])
