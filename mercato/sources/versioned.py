"""A keyed Parquet table that changes by buckets and switches versions at once.

Rows lie in hash buckets of their key. A change reads, merges and rewrites the
buckets it touches into a new folder; a *manifest* (one small Parquet file per
version) then names the folder of every bucket. The manifest's job commit is
the switch: before it readers see the old version, after it the new one, and a
crash in between leaves files that no manifest names. Readers stay on the
version they took, until :meth:`VersionedTable.vacuum` removes it.

Buckets follow the table's size: a bucket is (modulus, remainder) of the key's
hash, and one that outgrows ``bucket_rows`` is split when it is next rewritten,
into as many as its rows need, by doubling its modulus. The others keep theirs.

The newest row of a key wins, by ``order`` (columns) if given, else by version.
A deletion is a row too (a tombstone), so a change that arrives late cannot
bring a deleted key back. One writer at a time; a second one for the same
version fails on the manifest. A writer that numbers its batches may repeat one:
a batch that is in the table already changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET_ROWS = 2_000_000
MANIFEST = "modulus long, remainder long, folder string, rows long, batch long, schema string"


@dataclass(frozen=True)
class Bucket:
    modulus: int
    remainder: int
    folder: str | None
    rows: int


@dataclass(frozen=True)
class Version:
    number: int
    batch: int | None
    buckets: tuple[Bucket, ...]


class VersionedTable:
    """``schema``: the table's columns; ``keys``: those that name a row;
    ``spread``: SQL expressions over the keys whose hash picks the bucket
    (default: the keys themselves). Fewer values keep related keys together, so
    a change touches fewer buckets; one value's rows share a bucket."""

    def __init__(self, spark: SparkSession, root: str, schema: str | T.StructType, keys: Sequence[str],
                 spread: Sequence[str] = (), order: Sequence[str] = (), bucket_rows: int = BUCKET_ROWS):
        self.spark, self.root = spark, root.rstrip("/")
        self.schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        self.keys, self.order, self.bucket_rows = list(keys), list(order), bucket_rows
        self._read: dict[int, Version] = {}  # versions never change
        self.spread = list(spread) or [f"`{k}`" for k in keys]
        self.stored = T.StructType([*self.schema.fields, T.StructField("_deleted", T.BooleanType()), T.StructField("_seq", T.LongType())])

    # -- versions ----------------------------------------------------------

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _names(self, pattern: str) -> list[str]:
        fs, at = self._fs(pattern)
        return [s.getPath().toString() for s in fs.globStatus(at) or []]

    def versions(self) -> list[int]:
        """Committed versions in order."""
        return sorted(int(p.split("version=")[1].split("/")[0]) for p in self._names(f"{self.root}/manifest/version=*/_SUCCESS"))

    def version(self, number: int | None = None) -> Version | None:
        """One version (default: the newest); None if the table has none yet. A
        table of other columns is an error, not a table without versions."""
        known = self.versions()
        if not known and number is None:
            return None
        if number is None:
            number = known[-1]
        elif number not in known:
            raise ValueError(f"{self.root} has no version {number}")
        if number in self._read:
            return self._read[number]
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest/version={number}").collect()
        if rows[0].schema != self._signature():
            raise ValueError(f"{self.root} holds {rows[0].schema}, not {self._signature()}")
        self._read[number] = Version(number, rows[0].batch, tuple(Bucket(r.modulus, r.remainder, r.folder, r["rows"]) for r in rows))
        return self._read[number]

    def _signature(self) -> str:
        return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in self.schema.fields)

    # -- reading -------------------------------------------------------------

    def _rows(self, buckets: Sequence[Bucket]) -> DataFrame:
        paths = [f"{b.folder}/modulus={b.modulus}/remainder={b.remainder}" for b in buckets if b.folder]
        reader = self.spark.read.schema(self.stored)
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], self.stored)

    def read(self, number: int | None = None, changed_in: str | None = None) -> DataFrame:
        """The rows of a version; ``changed_in`` names a column for the version
        (or batch) that last changed each row."""
        at = self.version(number)
        rows = self._rows(at.buckets if at else ()).where("NOT _deleted")
        return rows.select(*self.schema.names, *([F.col("_seq").alias(changed_in)] if changed_in else []))

    # -- writing -------------------------------------------------------------

    def _routed(self, df: DataFrame, buckets: Sequence[Bucket]) -> DataFrame:
        """``df`` with the bucket of each row. The buckets part the hash's range,
        so of the moduli in use exactly one names a bucket that exists."""
        moduli = sorted({b.modulus for b in buckets})
        if moduli == [1]:
            return df.withColumns({"modulus": F.lit(1).cast("long"), "remainder": F.lit(0).cast("long")})
        known = self.spark.createDataFrame([(b.modulus, b.remainder) for b in buckets], "modulus long, remainder long")
        hashed = df.withColumn("_hash", F.xxhash64(*[F.expr(e) for e in self.spread]))
        tried = hashed.withColumn("modulus", F.explode(F.array(*[F.lit(m).cast("long") for m in moduli])))
        return tried.withColumn("remainder", F.pmod("_hash", "modulus")).drop("_hash").join(known, ["modulus", "remainder"])

    def _newest(self, rows: DataFrame, seq: int) -> DataFrame:
        """The newest row of each key. Without ``order`` two changes of one key
        in one batch have no newest one: that fails, with the key."""
        whole = F.struct(*[F.col(f"`{n}`") for n in self.stored.names])
        rank = F.struct(*[F.col(f"`{c}`") for c in self.order], F.col("_seq"), whole)
        best = rows.groupBy(*self.keys).agg(F.max_by(whole, rank).alias("_row"), F.count_if(F.col("_seq") == seq).alias("_new"))
        if not self.order:
            twice = F.raise_error(F.concat(F.lit("changed more than once in a batch: "), F.to_json(F.struct(*self.keys))))
            best = best.withColumn("_row", F.when(F.col("_new") <= 1, F.col("_row")).otherwise(twice))
        return best.select("_row.*")

    def apply(self, changes: DataFrame, batch: int | None = None) -> int:
        """Merge ``changes`` (the table's columns, optionally ``deleted``) and
        switch to the new version; returns its number. ``changes`` is read three
        times, so it should be a table or cheap to compute."""
        now = self.version()
        if now and batch is not None and now.batch is not None and batch <= now.batch:
            return now.number
        number = now.number + 1 if now else 1
        seq = number if batch is None else batch
        old = now.buckets if now else (Bucket(1, 0, None, 0),)
        gone = F.coalesce(F.col("deleted"), F.lit(False)) if "deleted" in changes.columns else F.lit(False)
        fresh = changes.select(*self.schema.names, gone.alias("_deleted"), F.lit(seq).cast("long").alias("_seq"))
        incoming = {(r.modulus, r.remainder): r["count"] for r in self._routed(fresh, old).groupBy("modulus", "remainder").count().collect()}
        touched = [b for b in old if (b.modulus, b.remainder) in incoming]
        targets = [Bucket(b.modulus * k, b.remainder + i * b.modulus, None, 0)
                   for b in touched for k in [self._parts(b.rows + incoming[b.modulus, b.remainder])] for i in range(k)]
        made: list[Bucket] = []
        if touched:
            merged = self._newest(self._rows(touched).unionByName(fresh), seq)
            folder = f"{self.root}/data/{number}-{uuid.uuid4().hex}"
            made = self._write(self._routed(merged, targets), folder, targets)
        self._commit(number, seq if batch is not None else (now.batch if now else None), [b for b in old if b not in touched] + made)
        return number

    def _parts(self, rows: int) -> int:
        parts = 1
        while parts * self.bucket_rows < rows:
            parts *= 2
        return parts

    def _write(self, rows: DataFrame, folder: str, targets: Sequence[Bucket]) -> list[Bucket]:
        rows.repartition("modulus", "remainder").write.partitionBy("modulus", "remainder").parquet(folder)
        kind = T.StructType([*self.stored.fields, T.StructField("modulus", T.LongType()), T.StructField("remainder", T.LongType())])
        count = {(r.modulus, r.remainder): r["count"] for r in self.spark.read.schema(kind).parquet(folder).groupBy("modulus", "remainder").count().collect()}
        return [Bucket(t.modulus, t.remainder, folder if n else None, n) for t in targets for n in [count.get((t.modulus, t.remainder), 0)]]

    def _commit(self, number: int, batch: int | None, buckets: Sequence[Bucket]) -> None:
        rows = [(b.modulus, b.remainder, b.folder, b.rows, batch, self._signature()) for b in buckets]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("error").parquet(f"{self.root}/manifest/version={number}")

    def vacuum(self, keep: int = 1) -> list[str]:
        """Remove the files that the newest ``keep`` versions don't use, those of
        interrupted writers included (none may be at work); returns the folders."""
        kept = self.versions()[-keep:]
        used = {b.folder for n in kept for b in self.version(n).buckets}
        names = {f.rsplit("/", 1)[1] for f in used if f}
        dead = [p for p in self._names(f"{self.root}/data/*") if p.rsplit("/", 1)[1] not in names]
        dead += [p for p in self._names(f"{self.root}/manifest/version=*") if int(p.split("version=")[1]) not in kept]
        for p in dead:
            fs, at = self._fs(p)
            fs.delete(at, True)
        return dead


def changes_between(now: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What makes ``now`` equal ``source``, a whole snapshot with the same columns:
    the new or changed rows, and the deleted keys, with ``deleted`` and
    ``change_type``. Keys are matched null-safely, values compared as a whole."""
    columns = list(now.columns)
    old = now.select(F.struct(*columns).alias("_old"))
    new = source.select(F.struct(*columns).alias("_new"))
    same = [F.col(f"_old.{k}").eqNullSafe(F.col(f"_new.{k}")) for k in keys]
    on = same[0]
    for s in same[1:]:
        on = on & s
    both = old.join(new, on, "full").where(~F.col("_old").eqNullSafe(F.col("_new")))
    kind = F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull(), "delete").otherwise("update")
    return (both.select(F.coalesce("_new", "_old").alias("r"), F.col("_new").isNull().alias("deleted"), kind.alias("change_type"))
            .select("r.*", "deleted", "change_type"))


def load_snapshot(table: VersionedTable, source: DataFrame) -> DataFrame:
    """Bring ``table`` to ``source`` and return the load's (change_type, rows)."""
    changes = changes_between(table.read(), source, table.keys).checkpoint()
    table.apply(changes)
    return changes.groupBy("change_type").agg(F.count(F.lit(1)).alias("rows"))
