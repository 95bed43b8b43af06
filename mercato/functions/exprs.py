"""Scalar expressions shared by the plans (all JVM-side built-ins)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as C

MONEY = "decimal(18,2)"
RATE = "decimal(4,2)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(c: str | Column) -> Column:
    """64-bit surrogate key: the first 15 hex digits of md5 as a BIGINT.

    60 bits, never negative and so never the reserved -1. DuckDB twin:
    ``('0x' || substr(md5(x), 1, 15))::BIGINT``.
    """
    return F.conv(F.substring(F.md5(col(c).cast("string")), 1, 15), 16, 10).cast("bigint")


def day_key(entity_hash: str | Column, d: str | Column) -> Column:
    """Key of an (entity, day) row of a periodic snapshot: the entity's 60-bit
    surrogate key moved on by an odd step for each day since 1970, modulo 2^60.

    The days of one entity never collide, keys of different entities are as
    unlikely to as full hashes, any date has a key (never -1), and the md5 is
    computed once per entity, not once per entity-day. NULL if either part is."""
    days = F.datediff(col(d), F.lit("1970-01-01").cast("date")).cast("bigint")
    return (col(entity_hash) + days * F.lit(C.DAY_STEP)).bitwiseAND(F.lit((1 << 60) - 1))


def composite(*parts: str | Column, sep: str = "|") -> Column:
    """Concatenate parts with a separator; NULL if any part is NULL (like concat)."""
    cols: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit(sep))
        cols.append(col(p).cast("string"))
    return F.concat(*cols)


def date_key(c: str | Column) -> Column:
    """yyyyMMdd integer key of a date."""
    return F.date_format(col(c), "yyyyMMdd").cast("bigint")


def lit_date(d: dt.date) -> Column:
    return F.lit(d).cast("date")


def money(c: str | Column) -> Column:
    return col(c).cast(MONEY)


def map_values(c: str | Column, mapping: Mapping[str, object], default=None) -> Column:
    """Simple CASE over a fixed mapping."""
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col(c) == k, F.lit(v)) if expr is None
                else expr.when(col(c) == k, F.lit(v)))
    return expr.otherwise(F.lit(default))


def channel_class(c: str | Column) -> Column:
    return map_values(c, C.CHANNEL_CLASS, C.CHANNEL_CLASS_DEFAULT)


def safe_divide(a: str | Column, b: str | Column) -> Column:
    """NULL when the divisor is 0 or NULL (``safe_divide``)."""
    return F.try_divide(col(a), col(b))


def round_money(c: str | Column) -> Column:
    """Round to cents. Only ever applied to decimals (doubles round differently)."""
    return F.round(col(c), 2).cast(MONEY)


def holiday_flag(d: str | Column) -> Column:
    m, dd = F.month(col(d)), F.dayofmonth(col(d))
    expr = F.lit(False)
    for mm, day in C.HOLIDAYS:
        expr = expr | ((m == mm) & (dd == day))
    return expr


def status_by_threshold(ratio: str | Column, bands, otherwise: str) -> Column:
    expr = None
    for lo, label in bands:
        cond = col(ratio) >= lo
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return F.when(col(ratio).isNull(), F.lit(None)).otherwise(expr.otherwise(otherwise))


def strict_greatest(*cols: str | Column) -> Column:
    """GREATEST that is NULL when any input is NULL (warehouse semantics).

    Spark's ``greatest`` skips NULLs; the reference warehouse does not.
    """
    cs = [col(c) for c in cols]
    any_null = cs[0].isNull()
    for c in cs[1:]:
        any_null = any_null | c.isNull()
    return F.when(any_null, F.lit(None)).otherwise(F.greatest(*cs))


def strict_least(*cols: str | Column) -> Column:
    cs = [col(c) for c in cols]
    any_null = cs[0].isNull()
    for c in cs[1:]:
        any_null = any_null | c.isNull()
    return F.when(any_null, F.lit(None)).otherwise(F.least(*cs))


def parse_list_text(c: str | Column) -> Column:
    """``"['A', 'B']"`` (a Python list printed as text) -> array<string>."""
    stripped = F.regexp_replace(col(c), r"[\[\]']", "")
    return F.when(F.trim(stripped) == "", F.array().cast("array<string>")) \
        .otherwise(F.split(stripped, ", "))
