import hashlib

import duckdb
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mercato.llm import line_dedup as d
from mercato.llm.queries import ORACLES, op12_line_dedup

LONG = "A line that is long enough to be looked at, as it has over forty characters"


def lower(x):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in x)


def plain(rows, shortest, least):
    """(kept, n_lines, dropped) of every (id, text), by dictionaries."""
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key := lower(line.strip(d.BLANKS))) >= shortest:
                holders.setdefault(key, set()).add(i)
    order = lambda i: (i is not None, i or 0)
    keeper = {k: max(v, key=order) for k, v in holders.items() if len(v) >= least}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        gone = [n for n, x in enumerate(lines) if (k := lower(x.strip(d.BLANKS))) in keeper and keeper[k] != i]
        out.append((i, "\n".join(x for n, x in enumerate(lines) if n not in gone), len(lines), gone))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.kept, r.n_lines, list(r.dropped)) for r in df.select("doc_id", "kept", "n_lines", "dropped").collect()), key=repr)


@pytest.mark.parametrize("most_broadcast", [0, 1000])
def test_odd_rows(llm, make_docs, odd_texts, most_broadcast):
    shared = [f"{LONG} {i}" for i in range(4)]
    texts = [*odd_texts, *("\n".join([f"only {i}", f" \t{shared[0]}\r", shared[1].upper(), shared[0]] + shared[2:2 + i % 3]) for i in range(9)),
             f"{LONG} 0\x1c", f"\n{LONG} 0\n\n", "é" * 40, "É" * 40, *["é" * 39] * 6, *[f"x\n{'é' * 40}"] * 5]
    ids = [None, *range(1, len(texts) - 3), 5, 5, None]
    docs = make_docs(texts, ids)
    extra = docs.withColumns({"Kept": F.lit(1), "_lines": F.lit(2), "hi": F.lit(3), "own": F.lit(4)})
    out = d.drop_repeated_lines(extra, most_broadcast=most_broadcast)
    assert {"_lines", "hi", "own", "kept", "source"} <= set(out.columns) and "Kept" not in out.columns
    assert found(out) == plain(list(zip(ids, texts, strict=True)), 40, 5)
    assert any(r.dropped for r in out.collect())


@pytest.mark.parametrize("most_broadcast", [0, 1000])
def test_saturated_filter_and_small_limits_change_nothing(llm, make_docs, monkeypatch, most_broadcast):
    """With hardly a bit free everything is a suspect; suspects leave a task in many pieces."""
    monkeypatch.setattr(d, "HELD_KEYS", 3)
    rng = np.random.default_rng(3)
    texts = ["\n".join(f"l{k}" for k in rng.integers(0, 40, 12)) for _ in range(60)]
    want = plain(list(enumerate(texts)), 2, 3)
    assert found(d.drop_repeated_lines(make_docs(texts), shortest=2, least=3, most_bits=1 << 11, most_broadcast=most_broadcast)) == want
    assert found(d.drop_repeated_lines(make_docs(texts).repartition(7), shortest=2, least=3, most_broadcast=most_broadcast)) == want


def test_clashing_digests_are_noticed(make_docs):
    def digest(key, seed):
        return xxhash.xxh3_128_digest(key[:1] if seed < 2 else key, seed=seed)

    texts = [f"{LONG} {i % 3}" for i in range(12)]
    assert found(d.drop_repeated_lines(make_docs(texts), least=4, digest=digest)) == plain(list(enumerate(texts)), 40, 4)


def test_empty_table(llm, make_docs):
    assert d.drop_repeated_lines(make_docs([])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 30), max_size=30), min_size=1, max_size=6))
def test_merged_filters_miss_nothing(tasks):
    """A key of two documents, of one task or of two, is in the merged filter."""
    keys = np.random.default_rng(1).integers(0, 2**63, (31, 2)).astype(np.uint64)
    once, twice = np.zeros(1 << 10, np.uint8), np.zeros(1 << 10, np.uint8)
    seen, again = set(), set()
    for task in tasks:
        a, ta = np.zeros(1 << 10, np.uint8), np.zeros(1 << 10, np.uint8)
        for i in range(0, len(task), 10):
            part = task[i:i + 10]
            d.add(a, ta, np.zeros(len(part), np.int64), keys[part].reshape(-1, 2))
            again |= seen & set(part)
            seen |= set(part)
        twice |= ta | (once & a)
        once |= a
    if again:
        assert d.holds(twice, d.places(keys[sorted(again)], 1 << 13)).all()


def test_query_equals_plain_lines_and_sql(llm):
    folder = "/root/testdata/sf0.001"
    docs = llm.read.parquet(f"{folder}/documents.parquet").collect()
    rows = sorted(tuple(r) for r in op12_line_dedup(llm, folder).collect())
    want = plain([(r.doc_id, r.text) for r in docs], 40, 5)
    assert rows == sorted((i, n, len(gone), hashlib.sha256(kept.encode()).hexdigest()) for i, kept, n, gone in want)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    assert sorted(con.execute(ORACLES["op12_line_dedup"]).fetchall()) == rows
