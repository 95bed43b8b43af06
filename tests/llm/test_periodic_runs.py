import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mercato.llm import periodic_runs as p
from mercato.llm.queries import ORACLES, op13_runs


def plain(words, least, exponent):
    """Runs by comparing all places at every distance."""
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            begin = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i - begin + q >= max(least, exponent * q):
                found.setdefault((begin, i - begin + q), q)  # the smallest period comes first
            i += 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def left(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


periodic = st.tuples(st.lists(st.integers(0, 3), max_size=6), st.lists(st.integers(0, 3), min_size=1, max_size=5), st.integers(0, 6), st.lists(st.integers(0, 3), max_size=6)).map(lambda t: t[0] + t[1] * t[2] + t[3])
texts = st.lists(st.integers(0, 1), max_size=40) | st.lists(periodic, max_size=4).map(lambda x: sum(x, []))


@settings(max_examples=500, deadline=None)
@given(texts)
def test_lyndon_lengths_are_next_smaller_suffixes(a):
    want = [next((j for j in range(i + 1, len(a)) if a[j:] < a[i:]), len(a)) - i for i in range(len(a))]
    assert p.lyndon_lengths(a, 4) == want


@settings(max_examples=500, deadline=None)
@given(texts, st.sampled_from([(6, 4), (2, 2), (1, 2), (5, 3), (10, 2), (3, 6)]))
def test_runs_equal_brute_force(a, limits):
    words = [b"%d" % x for x in a]
    runs = p.runs_of_words(words, *limits)
    assert runs == plain(words, *limits)
    assert p.collapse(words, runs) == left(words, runs)


@pytest.mark.parametrize("words", [[b"a"] * 100_000, [b"a", b"b"] * 50_000, [b"%d" % (i % 777) for i in range(100_000)], [b"%d" % i for i in range(100_000)]])
def test_long_texts(words):
    runs = p.runs_of_words(words)
    period = len(set(words))
    assert runs == ([(0, len(words), period)] if period < len(words) else [])


def test_odd_rows(make_docs, odd_texts):
    texts = [*odd_texts, "x " * 5, "x " * 6, "a b\n" * 4, "A a " * 4, "é é é é é é"]
    extra = make_docs(texts).withColumns({"Runs": F.lit(1), "n_words": F.lit(2), "start": F.lit(3)})
    rows = p.find_runs(extra).collect()
    assert len(rows) == len(texts) and rows[0].start == 3
    for r in rows:
        words = (r.text or "").encode().split()
        runs = plain(words, 6, 4) if len(words) < 1000 else []
        assert ([tuple(x) for x in r.runs], r.n_words, r.collapsed) == (runs, len(words), b" ".join(left(words, runs)).decode())
    assert p.find_runs(make_docs([])).count() == 0


def expected(key, text):
    words, h = (text or "").encode().split(), zlib.crc32(b"" if key is None else str(key).encode())
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        words = [words[a + (i - a) % (1 + (n - a) // (3 + g % 8))] if i >= a else words[i] for i in range(n)]
    runs = plain(words, 6, 4)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return (key, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha("".join("%d,%d,%d\n" % r for r in runs).encode()), sha(b" ".join(left(words, runs))))


def test_query_equals_plain_runs_and_sql(llm, make_docs, folder):
    place = "/root/testdata/sf0.001"
    rows = sorted(tuple(r) for r in op13_runs(llm, place).collect())
    docs = llm.read.parquet(f"{place}/documents.parquet").collect()
    short = {d.doc_id: expected(d.doc_id, d.text) for d in docs if len(d.text.split()) < 1500}
    assert all(r == short[r[0]] for r in rows if r[0] in short) and sum(r[1] > 0 for r in rows) > 5
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{place}/documents.parquet'")
    assert sorted(con.execute(ORACLES["op13_runs"]).fetchall()) == rows
    odd = [None, "", " \n", "a b c d e f g h i j k l m n o p q r s t"] * 8
    ids = [None, *range(1, len(odd) - 2), 7, 7]
    got = op13_runs(llm, folder(documents=make_docs(odd, ids))).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(expected(i, t)) for i, t in zip(ids, odd, strict=True))


def test_stretches_hold_every_run():
    rng = np.random.default_rng(5)
    for _ in range(200):
        words = [b"%d" % x for x in rng.integers(0, 3, 200)]
        assert p.runs_of_words(words, 6, 3) == plain(words, 6, 3)
