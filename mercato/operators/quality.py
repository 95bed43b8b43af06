"""Data-quality checks as Spark jobs.

A check is declarative (model, column, test, parameters, severity). All
row-level tests of one model (not_null, accepted_values, accepted_range,
expression) are one aggregate pass whose single row is unfolded into a row per
check; all ``relationships`` of one model are one pass over its keys, counted
per distinct key before they meet the parents; ``unique`` is one ``groupBy`` per
column (partial aggregation before the shuffle). A periodic snapshot is checked
on the runs of days it is unfolded from (``Snapshot``), so its dense rows are
never grouped. The result is one row per check: failing rows, total rows, and a
status that depends on the severity; ``enforce`` raises where a check of
severity ``error`` failed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as C

ROW_LEVEL = ("not_null", "accepted_values", "accepted_range", "expression")


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str                      # unique | not_null | accepted_values | accepted_range | relationships | expression
    severity: str = "error"
    values: tuple = ()             # accepted_values
    min_value: float | None = None  # accepted_range (inclusive)
    max_value: float | None = None
    to: tuple[str, str] | None = None  # relationships: (parent model, parent column)
    expr: str | None = None        # expression: SQL predicate that must hold
    name: str = field(default="")

    @property
    def check_name(self) -> str:
        return self.name or f"{self.test}__{self.model}__{self.column}"


def _failing(c: Check) -> Column:
    """Predicate of a failing row, for the single-pass row-level tests."""
    x = F.col(c.column)
    if c.test == "not_null":
        return x.isNull()
    if c.test == "accepted_values":
        return x.isNotNull() & ~x.isin(*c.values)
    if c.test == "accepted_range":
        cond = F.lit(False)
        if c.min_value is not None:
            cond = cond | (x < F.lit(c.min_value))
        if c.max_value is not None:
            cond = cond | (x > F.lit(c.max_value))
        return x.isNotNull() & cond
    if c.test == "expression":
        return ~F.coalesce(F.expr(c.expr), F.lit(False))
    raise ValueError(c.test)


@dataclass(frozen=True)
class Snapshot:
    """What stands for a model with one row per entity and day.

    ``spans``: (entity, first_day, last_day) whose unfolding gives the keys
    ``day_key(entity, day)``. ``rows``: rows that each stand for ``__n`` rows of
    the model (None: read the model). ``keys``: (value, n) of a key column."""

    spans: DataFrame
    rows: DataFrame | None = None
    keys: dict[str, DataFrame] = field(default_factory=dict)


def repeated_day_keys(spans: DataFrame) -> DataFrame:
    """One row, ``__fail``: how many day keys the spans give more than once.

    ``day_key`` adds a fixed odd step a day, so multiplying by the step's
    inverse puts the days of a span side by side on a circle of 2^60 places:
    keys repeat exactly where spans overlap there. The circle is cut into
    buckets, and each one is swept on its own."""
    ring, cut_at = 1 << 60, 40
    width = 1 << cut_at
    inverse = F.lit(Decimal(pow(C.DAY_STEP, -1, ring))).cast("decimal(19,0)")
    days = F.datediff("first_day", F.lit("1970-01-01").cast("date"))
    turned = F.pmod(F.col("entity").cast("decimal(19,0)") * inverse, F.lit(Decimal(ring)).cast("decimal(38,0)"))
    placed = (spans.where("entity IS NOT NULL AND first_day <= last_day")
              .select(F.pmod(turned.cast("bigint") + days, F.lit(ring)).alias("lo"),
                      F.datediff("last_day", "first_day").alias("n"))
              .select("lo", (F.col("lo") + F.col("n") + 1).alias("hi")))
    bucket = F.sequence(F.shiftright("lo", cut_at), F.shiftright(F.col("hi") - 1, cut_at))
    cut = (placed.select("lo", "hi", F.explode(bucket).alias("b"))
           .select(F.pmod("b", F.lit(ring // width)).alias("bucket"),
                   (F.greatest("lo", F.col("b") * width) - F.col("b") * width).alias("lo"),
                   (F.least("hi", (F.col("b") + 1) * width) - F.col("b") * width).alias("hi")))
    steps = (cut.select("bucket", F.explode(F.array(
                F.struct(F.col("lo").alias("at"), F.lit(1).alias("d")),
                F.struct(F.col("hi").alias("at"), F.lit(-1).alias("d")))).alias("e"))
             .groupBy("bucket", F.col("e.at").alias("at")).agg(F.sum("e.d").alias("d")))
    w = Window.partitionBy("bucket").orderBy("at")
    level = steps.select(F.sum("d").over(w).alias("level"), (F.lead("at").over(w) - F.col("at")).alias("run"))
    return level.agg(F.coalesce(F.sum(F.when(F.col("level") > 1, F.col("run"))), F.lit(0)).alias("__fail"))


def _orphans(df: DataFrame, n: Column, rel: list[tuple[int, Check]], snap: Snapshot | None,
             resolve: Callable[[str], DataFrame]) -> list[DataFrame]:
    """(id, failing) of a model's relationships; the keys of one type share a pass."""
    types = dict(df.dtypes)
    parts: list[DataFrame] = []
    by_type: dict[str, list[tuple[int, Check]]] = {}
    for i, c in rel:
        if snap and c.column in snap.keys:
            parent = resolve(c.to[0]).select(F.col(c.to[1]).alias("value")).distinct()
            lost = snap.keys[c.column].where("value IS NOT NULL").join(parent, "value", "left_anti")
            parts.append(lost.agg(F.lit(i).alias("id"), F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("failing")))
        else:
            by_type.setdefault(types[c.column], []).append((i, c))
    for members in by_type.values():
        keys = F.explode(F.array(*[F.struct(F.lit(i).alias("id"), F.col(c.column).alias("value")) for i, c in members]))
        child = (df.select(n.alias("n"), keys.alias("k")).select("k.*", "n").where("value IS NOT NULL")
                 .groupBy("id", "value").agg(F.sum("n").alias("n")))
        parents = None
        for i, c in members:
            one = resolve(c.to[0]).select(F.lit(i).alias("id"), F.col(c.to[1]).alias("value"))
            parents = one if parents is None else parents.union(one)
        lost = child.join(parents.distinct(), ["id", "value"], "left_anti").groupBy("id").agg(F.sum("n").cast("bigint").alias("failing"))
        parts.append(lost)
    return parts


def run_checks(resolve: Callable[[str], DataFrame], checks: Sequence[Check],
               snapshots: Mapping[str, Snapshot] | None = None) -> DataFrame:
    """Evaluate ``checks``; ``resolve(model)`` returns the model's DataFrame."""
    found: list[DataFrame] = []
    by_model: dict[str, list[tuple[int, Check]]] = {}
    for i, c in enumerate(checks):
        by_model.setdefault(c.model, []).append((i, c))
    for model, members in by_model.items():
        snap = (snapshots or {}).get(model)
        df = snap.rows if snap and snap.rows is not None else resolve(model)
        n = F.col("__n") if "__n" in df.columns else F.lit(1).cast("bigint")
        count = lambda cond: F.coalesce(F.sum(F.when(cond, n)), F.lit(0)).cast("bigint")
        row_level = {i for i, c in members if c.test in ROW_LEVEL}
        one = df.agg(F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("total"),
                     *[count(_failing(c)).alias(f"f{i}") for i, c in members if i in row_level])
        found.append(one.select(F.explode(F.array(*[
            F.struct(F.lit(i).alias("id"), (F.col(f"f{i}") if i in row_level else F.lit(0).cast("bigint")).alias("failing"),
                     F.col("total")) for i, _ in members])).alias("r")).select("r.*"))
        no_total = F.lit(None).cast("bigint").alias("total")
        for i, c in members:
            if c.test == "unique":
                if snap:
                    dup = repeated_day_keys(snap.spans)
                else:
                    dup = (df.filter(F.col(c.column).isNotNull()).groupBy(c.column).count()
                           .filter(F.col("count") > 1).agg(F.count(F.lit(1)).alias("__fail")))
                found.append(dup.select(F.lit(i).alias("id"), F.col("__fail").cast("bigint").alias("failing"), no_total))
        rel = [(i, c) for i, c in members if c.test == "relationships"]
        found += [p.select("id", "failing", no_total) for p in _orphans(df, n, rel, snap, resolve)]
    out = found[0]
    for p in found[1:]:
        out = out.unionByName(p)
    about = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in (
        ("check_name", c.check_name), ("model_name", c.model), ("column_name", c.column),
        ("test_type", c.test), ("severity", c.severity))]) for c in checks])
    status = (F.when(F.col("failing_rows") == 0, "pass")
              .when(F.col("severity") == "warn", "warn").otherwise("fail"))
    return (out.groupBy("id").agg(F.max("failing").alias("failing_rows"), F.max("total").alias("total_rows"))
            .select(F.get(about, F.col("id")).alias("c"), "failing_rows", "total_rows")
            .select("c.*", "failing_rows", "total_rows").withColumn("status", status))


class ChecksFailed(Exception):
    """A check of severity ``error`` found failing rows."""


def enforce(results: DataFrame) -> DataFrame:
    """``results`` if no check failed, else raise with the failed ones (one row
    per check, so what is collected is bounded by the declaration)."""
    failed = results.filter("status = 'fail'").orderBy("check_name").collect()
    if failed:
        raise ChecksFailed("; ".join(f"{r.check_name}: {r.failing_rows} of {r.total_rows}" for r in failed))
    return results


def check_sql(c: Check, table_sql: Callable[[str], str]) -> str:
    """The same check as one DuckDB SELECT (oracle)."""
    t = table_sql(c.model)
    head = (f"SELECT '{c.check_name}' AS check_name, '{c.model}' AS model_name, '{c.column}' AS column_name, "
            f"'{c.test}' AS test_type, '{c.severity}' AS severity, ")
    total = f"(SELECT count(*) FROM {t})"
    col = c.column
    if c.test == "not_null":
        fail = f"(SELECT count(*) FROM {t} WHERE {col} IS NULL)"
    elif c.test == "accepted_values":
        vals = ", ".join(f"'{v}'" for v in c.values)
        fail = f"(SELECT count(*) FROM {t} WHERE {col} IS NOT NULL AND {col} NOT IN ({vals}))"
    elif c.test == "accepted_range":
        conds = []
        if c.min_value is not None:
            conds.append(f"{col} < {c.min_value}")
        if c.max_value is not None:
            conds.append(f"{col} > {c.max_value}")
        fail = f"(SELECT count(*) FROM {t} WHERE {col} IS NOT NULL AND ({' OR '.join(conds)}))"
    elif c.test == "expression":
        fail = f"(SELECT count(*) FROM {t} WHERE NOT coalesce({c.expr}, false))"
    elif c.test == "unique":
        fail = (f"(SELECT count(*) FROM (SELECT {col} FROM {t} WHERE {col} IS NOT NULL "
                f"GROUP BY {col} HAVING count(*) > 1))")
    elif c.test == "relationships":
        p = table_sql(c.to[0])
        fail = (f"(SELECT count(*) FROM {t} ch WHERE ch.{col} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {p} pa WHERE pa.{c.to[1]} = ch.{col}))")
    else:
        raise ValueError(c.test)
    status = f"CASE WHEN failing_rows = 0 THEN 'pass' WHEN '{c.severity}' = 'warn' THEN 'warn' ELSE 'fail' END"
    counts = f"SELECT CAST({fail} AS BIGINT) AS failing_rows, CAST({total} AS BIGINT) AS total_rows"
    return f"{head}failing_rows, total_rows, {status} AS status FROM ({counts})"
