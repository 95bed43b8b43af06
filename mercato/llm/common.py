"""Helpers shared by the text operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.session import ensure_checkpoint_dir

#: Rows handed to a Python worker at a time. Whole texts travel in these
#: batches, so the number is small enough for texts of some megabytes each.
BATCH_ROWS = 512

_SHIPPED: set[str] = set()


class Made(threading.local):
    """Folders that ``written`` made in this thread and ``discard`` has not removed."""

    def __init__(self):
        self.paths: list[str] = []


_MADE = Made()


def prepare(spark: SparkSession) -> SparkSession:
    """Make this package importable on the executors and bound Arrow batches."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    ensure_checkpoint_dir(spark)
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="mercato-py-"), "mercato_package.zip")
        with zipfile.ZipFile(path, "w") as out:
            for folder, _, names in sorted(os.walk(root)):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        out.write(full, os.path.relpath(full, os.path.dirname(root)))
        spark.sparkContext.addPyFile(path)  # Spark's file server hands it to every executor
        _SHIPPED.add(app)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage: what follows reads files that every executor can reach,
    and a lost executor costs no recomputation.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _MADE.paths.append(path)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def intermediates() -> list[str]:
    """The tables that operators wrote in this thread and that still exist, oldest first."""
    return list(_MADE.paths)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Remove tables that ``written`` made, once nothing reads them any more.

    Results of the operators are lazy, so write them first. Paths that are not
    among ``intermediates()`` are left alone.
    """
    for path in set(paths) & set(_MADE.paths):
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        _MADE.paths.remove(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` bears it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null counts as the empty text."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def by_batch(fn: Callable[[pa.RecordBatch], pa.RecordBatch]):
    """mapInArrow function that applies ``fn`` to every non-empty batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return run


def remainder(doc_id, modulus: int):
    """crc32 of the id as text, modulo ``modulus`` (a null id counts as '')."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def row_key(id_column: str, text_column: str):
    """64-bit key of a row's content; equal rows share it, which is harmless
    wherever equal rows get equal results."""
    return F.xxhash64(F.col(id_column), F.col(text_column))


class Memo(dict):
    """Bounded memo: ``memo[key]`` computes a missing entry; when full it
    starts again, so memory stays bounded and results never change."""

    def __init__(self, fn: Callable, entries: int, longest: int = 64):
        super().__init__()
        self.fn, self.entries, self.longest = fn, entries, longest

    def __missing__(self, key):
        value = self.fn(key)
        if len(key) <= self.longest:
            if len(self) >= self.entries:
                self.clear()
            self[key] = value
        return value
