"""Daily levels of piecewise-constant measures, without a dense spine.

An interval [start, end] carrying measure m contributes +m from ``start`` and
-m from ``end + 1``. Summing these deltas per (key, change day) is a partial
aggregate; a running sum over change days gives the level, which holds until
the next change day. Only then are days generated, one per (key, day) of the
*result* (e.g. date x warehouse), never per (entity, day).

Work is O(intervals) + O(result). With no key the running sum runs over the
distinct change days, which are bounded by the calendar.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import col, lit_date
from .core import explode_days


def daily_levels(df: DataFrame, by: Sequence[str], start: str | Column, end: str | Column,
                 measures: Mapping[str, Column], lo: dt.date, hi: dt.date,
                 day: str = "day") -> DataFrame:
    """Per (by, day) in [lo, hi]: sum of each measure over the intervals that
    cover the day. A day that intervals cover is present even if every sum is
    0; days covered by no interval are absent."""
    by = list(by)
    names = list(measures)
    s, e = col(start), col(end)
    valid = df.filter(s.isNotNull() & e.isNotNull() & (s <= e))
    opening = F.struct(s.alias("__d"), F.lit(1).alias("__n"), *[measures[n].alias(n) for n in names])
    closing = F.struct(F.date_add(e, 1).alias("__d"), F.lit(-1).alias("__n"), *[(-measures[n]).alias(n) for n in names])
    ev = (valid.select(*by, F.explode(F.array(opening, closing)).alias("__e"))
          .select(*by, "__e.*"))
    deltas = ev.groupBy(*by, "__d").agg(*[F.sum(n).alias(n) for n in ["__n", *names]])
    w = Window.partitionBy(*by).orderBy("__d")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    levels = deltas.select(*by, "__d", *[F.sum(n).over(run).alias(n) for n in ["__n", *names]],
                           F.lead("__d").over(w).alias("__next"))
    levels = levels.filter(F.col("__n") > 0)
    lo_c, hi_c = lit_date(lo), lit_date(hi)
    frm = F.greatest(F.col("__d"), lo_c)
    to = F.least(F.coalesce(F.date_sub("__next", 1), hi_c), hi_c)
    return explode_days(levels, frm, to, day).select(*by, day, *names)
