"""Landing ingest: explicit schemas, FAILFAST, missing inputs, incremental rows."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import types as T

from mercato.sources.ingest import catalog_as_of, incremental_changes, load_tables

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("qty", T.IntegerType())])


def _csv(text: str) -> str:
    d = tempfile.mkdtemp(prefix="mercato-csv-")
    with open(os.path.join(d, "part-0.csv"), "w") as f:
        f.write(text)
    return d


def test_load_audit_and_missing_input(spark):
    good = _csv("id,qty\na,1\nb,2\n")
    target = tempfile.mkdtemp(prefix="mercato-landing-")
    audit = {r.table_name: (r.status, r.rows) for r in load_tables(
        spark, {"t": (good, SCHEMA), "gone": (os.path.join(good, "nope"), SCHEMA)}, target).collect()}
    assert audit == {"t": ("loaded", 2), "gone": ("missing", None)}


def test_failfast_rejects_malformed_rows(spark):
    bad = _csv("id,qty\na,1\nb,not-a-number\n")
    with pytest.raises(Exception):
        load_tables(spark, {"t": (bad, SCHEMA)}, tempfile.mkdtemp(prefix="mercato-landing-"))


def test_incremental_changes_inserts_and_updates(spark):
    cols = "product_id string, launch_date date, discontinued_date date, lifecycle_status string, " \
           "is_currently_sellable boolean"
    new = spark.createDataFrame([("P1", dt.date(1999, 1, 1), None, "Active", True),
                                 ("P2", dt.date(1999, 1, 1), dt.date(2001, 1, 1), "Discontinued", False),
                                 ("P3", dt.date(2001, 3, 1), None, "New Launch", True)], cols)
    old = catalog_as_of(new, dt.date(2000, 6, 30))
    got = {r.product_id: r.change_type for r in incremental_changes(
        old, new, "product_id", ["lifecycle_status", "discontinued_date", "is_currently_sellable"]).collect()}
    assert got == {"P2": "update", "P3": "insert"}


def test_round_trip_compresses_the_csv_and_keeps_none(spark, monkeypatch):
    from mercato.sources import ingest

    class Raw:
        def __init__(self):
            self.spark = spark

        def raw(self, name):
            return spark.createDataFrame([(f"{name}-{i}", i) for i in range(5)], SCHEMA)

    root, seen = tempfile.mkdtemp(prefix="mercato-landing-"), []
    load = ingest._load_one
    monkeypatch.setattr(ingest, "scratch_dir", lambda *_: root)
    monkeypatch.setattr(ingest, "_load_one", lambda s, table, path, *a: (seen.extend(os.listdir(path) if os.path.isdir(path) else []), load(s, table, path, *a))[1])
    audit = {r.table_name: (r.status, r.rows) for r in ingest.round_trip_landing(Raw(), ["a", "b"]).collect()}
    assert audit == {"a": ("loaded", 5), "b": ("loaded", 5), "missing_example": ("missing", None)}
    data = [f for f in seen if f.startswith("part-")]
    assert data and all(f.endswith(".csv.gz") for f in data)
    assert not os.path.isdir(os.path.join(root, "csv")) or os.listdir(os.path.join(root, "csv")) == []
    assert spark.read.parquet(os.path.join(root, "parquet", "a")).count() == 5
