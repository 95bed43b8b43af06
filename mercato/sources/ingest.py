"""Landing-file ingest and sinks.

- CSV sink, one folder per table, header, no index (the generator's output),
  compressed; a table's CSV is removed once it is loaded, so at most as many are
  on disk as are loaded at once.
- CSV scan with an explicit schema per table (no inference) in FAILFAST mode.
- Idempotent full replace of each landing table (``mode("overwrite")``).
- Missing inputs are skipped with a notice; per-table row counts are returned
  as an audit DataFrame.
- Facts written partitioned by month (partition pruning on read).
- Incremental load: only new or changed rows, by key + attribute hash.

All paths live under the cluster's shared ``spark.checkpoint.dir`` unless given.
"""

from __future__ import annotations

import os
import uuid
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from ..session import ensure_checkpoint_dir, shuffles_removed


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def write_csv(df: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Compressed files can't be split on reading, hence their bound of rows."""
    (df.write.mode("overwrite").option("header", True).option("compression", "gzip")
     .option("maxRecordsPerFile", rows_per_file).csv(path))


def remove_folder(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
            .csv(path))


def _load_one(spark: SparkSession, table: str, path: str, schema: T.StructType, target: str) -> DataFrame:
    try:
        df = read_csv(spark, path, schema)
    except AnalysisException:          # path not found: skip with a notice
        return spark.range(1).select(F.lit(table).alias("table_name"), F.lit("missing").alias("status"),
                                     F.lit(None).cast("bigint").alias("rows"))
    out = os.path.join(target, table)
    df.write.mode("overwrite").option("compression", "zstd").parquet(out)
    return (spark.read.parquet(out).agg(F.count(F.lit(1)).alias("rows"))
            .select(F.lit(table).alias("table_name"), F.lit("loaded").alias("status"), "rows"))


def load_tables(spark: SparkSession, sources: dict[str, tuple[str, T.StructType]], target: str,
                threads: int = 4, sink=None) -> DataFrame:
    """CSV folders -> parquet tables (full replace), up to ``threads`` tables
    at once. Returns the load audit: table, status, rows. Missing inputs get
    status 'missing' and no rows. ``sink(name)``, if given, writes a table's CSV
    just before it is loaded; that CSV is removed afterwards."""
    def load(item):
        name, (path, schema) = item
        if sink is not None:
            sink(name)
        audit = _load_one(spark, name, path, schema, target)
        if sink is not None:
            remove_folder(spark, path)
        return audit

    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        parts = list(pool.map(load, sources.items()))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def round_trip_landing(raw, names: Sequence[str], threads: int = 4) -> DataFrame:
    """Write each landing table as CSV, load it back through the explicit
    schema into parquet, and return the audit (tables in parallel)."""
    spark = raw.spark
    root = scratch_dir(spark, "landing")
    frames = {name: raw.raw(name) for name in names}   # plans only; shared inputs built once
    sources = {name: (os.path.join(root, "csv", name), frames[name].schema) for name in names}
    sources["missing_example"] = (os.path.join(root, "csv", "does_not_exist"),
                                  T.StructType([T.StructField("x", T.StringType())]))
    return load_tables(spark, sources, os.path.join(root, "parquet"), threads,
                       sink=lambda name: write_csv(frames[name], sources[name][0]) if name in frames else None)


def write_partitioned_by_month(df: DataFrame, date_col: str, path: str, keys: Sequence[str] = (),
                               rows_per_file: int = 5_000_000) -> None:
    """Facts partitioned by month of their business date. Range partitioning on
    (date, ``keys``) gives each task a contiguous slice: few month folders per
    task, balanced sizes even when one month or one day is hot (with ``keys``
    that tell its rows apart). Rows sorted by the date inside each file let
    min/max statistics prune row groups, and no file outgrows ``rows_per_file``.
    Rows without a date go to the partition of that name."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    with shuffles_removed(df.sparkSession):
        (df.withColumn("month", F.date_format(date_col, "yyyy-MM"))
           .repartitionByRange(n, date_col, *keys).sortWithinPartitions(date_col, *keys)
           .write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", rows_per_file)
           .partitionBy("month").parquet(path))


def incremental_changes(old: DataFrame, new: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """Rows of ``new`` that are absent from ``old`` (insert) or whose
    attributes changed (update): anti join on the key plus a hash compare."""
    def hashed(df):
        cols = [F.coalesce(F.col(a).cast("string"), F.lit("\u0000")) for a in attrs]
        return df.select(key, F.sha2(F.concat_ws("\u0001", *cols), 256).alias("__h"))
    o, n = hashed(old), hashed(new)
    inserts = n.join(o, key, "left_anti").select(key, F.lit("insert").alias("change_type"))
    updates = (n.join(o.withColumnRenamed("__h", "__old"), key)
               .filter(F.col("__h") != F.col("__old")).select(key, F.lit("update").alias("change_type")))
    return inserts.unionByName(updates)


def catalog_as_of(products: DataFrame, cutoff) -> DataFrame:
    """The staged product catalog as it stood on ``cutoff``: products launched
    later do not exist yet, and a discontinuation after the cutoff is unknown."""
    from ..functions.exprs import lit_date
    c = lit_date(cutoff)
    later = F.col("discontinued_date") > c
    return (products.filter(F.col("launch_date").isNull() | (F.col("launch_date") <= c))
            .withColumn("lifecycle_status", F.when(later, F.lit("Active")).otherwise(F.col("lifecycle_status")))
            .withColumn("is_currently_sellable",
                        F.when(later, F.lit(True)).otherwise(F.col("is_currently_sellable")))
            .withColumn("discontinued_date", F.when(later, F.lit(None).cast("date"))
                        .otherwise(F.col("discontinued_date"))))


def catalog_feed(products: DataFrame, cutoff) -> DataFrame:
    """What the source system delivers on ``cutoff``: the catalog as of that day
    without the products that ended a year ago or earlier."""
    from ..functions.exprs import lit_date
    ended = F.coalesce(F.date_add("discontinued_date", 365) <= lit_date(cutoff), F.lit(False))
    return catalog_as_of(products.where(~ended), cutoff)
