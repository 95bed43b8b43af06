"""The versioned table: buckets, switch, pinned readers, crashes, replays, splits."""

import random
import tempfile

import pytest

from mercato.sources.versioned import VersionedTable, changes_between, load_snapshot

SCHEMA = "k string, n long, x string"


@pytest.fixture
def table(spark):
    def make(**options):
        return VersionedTable(spark, tempfile.mkdtemp(prefix="mercato-versioned-"), SCHEMA, ["k"], **options)
    return make


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def change(spark, data):
    return spark.createDataFrame(data, SCHEMA + ", deleted boolean")


def test_inserts_updates_deletes_and_pinned_readers(spark, table):
    t = table()
    assert t.version() is None and rows(t.read()) == []
    t.apply(change(spark, [("a", 1, "x", False), ("b", 2, None, None), (None, 3, "z", False)]))
    first = t.read()
    t.apply(change(spark, [("a", 5, "y", False), ("b", 2, None, True), ("c", 9, "c", False)]))
    assert rows(t.read()) == [("a", 5, "y"), ("c", 9, "c"), (None, 3, "z")]
    assert rows(first) == rows(t.read(1)) == [("a", 1, "x"), ("b", 2, None), (None, 3, "z")]
    assert rows(t.read(changed_in="v")) == [("a", 5, "y", 2), ("c", 9, "c", 2), (None, 3, "z", 1)]
    t.apply(change(spark, [("b", 7, "again", False)]))          # re-insert after a deletion
    assert ("b", 7, "again") in rows(t.read())
    with pytest.raises(ValueError):
        t.read(9)


def test_crash_between_write_and_switch(spark, table, monkeypatch):
    t = table()
    t.apply(change(spark, [("a", 1, "x", False)]))
    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost driver")))
        with pytest.raises(RuntimeError):
            t.apply(change(spark, [("a", 2, "lost", False), ("b", 2, "lost", False)]))
    assert t.versions() == [1] and rows(t.read()) == [("a", 1, "x")]
    t.apply(change(spark, [("b", 3, "y", False)]))
    assert t.versions() == [1, 2] and rows(t.read()) == [("a", 1, "x"), ("b", 3, "y")]
    removed = t.vacuum()
    assert len([p for p in removed if "/data/" in p]) == 2 and rows(t.read()) == [("a", 1, "x"), ("b", 3, "y")]


def test_buckets_split_as_the_table_grows_and_untouched_ones_keep_their_files(spark, table):
    t = table(bucket_rows=16)
    model = {}
    random.seed(4)
    moduli = []
    for _ in range(5):
        keys = random.sample(range(400), 60)
        batch = [(f"k{i}", random.randrange(9), "v", random.random() < 0.2) for i in keys]
        t.apply(change(spark, batch))
        for k, n, x, gone in batch:
            model[k] = None if gone else (k, n, x)
        at = t.version()
        moduli.append(max(b.modulus for b in at.buckets))
        assert rows(t.read()) == sorted((v for v in model.values() if v), key=repr)
        assert sum(2**20 // b.modulus for b in at.buckets) == 2**20   # the buckets part the hash range
        assert all(b.rows <= 32 for b in at.buckets)
    assert moduli[0] < moduli[-1]
    before = {(b.modulus, b.remainder): b.folder for b in t.version().buckets}
    t.apply(change(spark, [("k1", 77, "one", False)]))
    after = {(b.modulus, b.remainder): b.folder for b in t.version().buckets}
    assert sum(before.get(k) != f for k, f in after.items()) <= 2 < len(after)


def test_order_decides_and_a_replayed_batch_changes_nothing(spark, table):
    t = table(order=["n"])
    t.apply(change(spark, [("a", 5, "new", False), ("a", 3, "old", False), ("b", 4, "gone", True)]), batch=0)
    t.apply(change(spark, [("a", 4, "late", False), ("b", 2, "older than its deletion", False)]), batch=1)
    assert rows(t.read()) == [("a", 5, "new")]
    number = t.apply(change(spark, [("z", 1, "replayed", False)]), batch=1)
    assert number == 2 == t.version().number and rows(t.read()) == [("a", 5, "new")]
    t.apply(change(spark, [("b", 6, "back", False)]), batch=2)
    assert rows(t.read()) == [("a", 5, "new"), ("b", 6, "back")]


def test_errors(spark, table):
    t = table()
    t.apply(change(spark, [("a", 1, "x", False)]))
    with pytest.raises(Exception, match="changed more than once"):
        t.apply(change(spark, [("b", 1, "x", False), ("b", 1, "y", False)]))
    with pytest.raises(ValueError, match="holds k string"):
        VersionedTable(spark, t.root, "k string, n int", ["k"]).read()
    with pytest.raises(Exception):
        t._commit(1, None, t.version().buckets)                  # a second writer of one version
    assert rows(t.read()) == [("a", 1, "x")]


def test_empty_changes_and_snapshot_loads(spark, table):
    t = table(bucket_rows=2)
    t.apply(change(spark, []))
    assert rows(t.read()) == [] and t.versions() == [1]
    one = spark.createDataFrame([("a", 1, "x"), ("b", None, None), (None, 1, "n")], SCHEMA)
    two = spark.createDataFrame([("a", 1, "x"), ("b", 2, None), ("c", 1, "c")], SCHEMA)
    assert rows(load_snapshot(t, one)) == [("insert", 3)]
    assert rows(load_snapshot(t, two)) == [("delete", 1), ("insert", 1), ("update", 1)]
    assert rows(t.read()) == rows(two) and changes_between(t.read(), two, ["k"]).isEmpty()
