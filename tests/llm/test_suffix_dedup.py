import hashlib
import random

import numpy as np
import pytest

from mercato.llm import suffix_dedup as s
from mercato.llm.queries import op7_suffix_dedup
from pyspark.sql import functions as F


def plain(texts, length=200):
    data = [(t or "").encode() for t in texts]
    seen = {}
    for d in data:
        for i in range(len(d) - length + 1):
            w = d[i:i + length]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, np.int64)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = 1
        out.append((len(d), int(gone.sum()), int((np.diff(gone, prepend=0) == 1).sum()), hashlib.sha256(bytes(b for b, g in zip(d, gone, strict=False) if not g)).hexdigest()))
    return out


def compare(rows, ids, texts):
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows)
    assert got == sorted((str(i), *w) for i, w in zip(ids, plain(texts), strict=True))


def mixed_texts():
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdéß日") for _ in range(draw.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(n) for n in (40, 55, 60, 90, 200)]
    texts = [prose(draw.randint(0, 30)) + draw.choice(["", " "]) + draw.choice(passages) + prose(draw.randint(0, 30)) for _ in range(60)]
    texts += [t[:len(t) // 2] + "#" + t[len(t) // 2:] for t in texts[:20]]  # near copies
    texts += ["ab" * 400, "x" * 1000, "x" * 199, "x" * 200, "y" * 201, passages[4] * 3, passages[3][1:] + passages[3][:-1], texts[3], texts[3]]
    return texts


def test_query_equals_brute_force(llm):
    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    compare(op7_suffix_dedup(llm, "/root/testdata/sf0.001").collect(), [d.doc_id for d in docs], [d.text for d in docs])


@pytest.mark.parametrize(("hot", "piece"), [(20_000, 1 << 20), (3, 1 << 20), (20_000, 300)])
def test_mixed_texts(llm, make_docs, folder, monkeypatch, hot, piece):
    """Also with all frequent anchors counted, and with texts hashed in pieces."""
    monkeypatch.setattr(s, "PIECE", piece)
    texts = mixed_texts()
    cut = s.remove_repeats(make_docs(texts).select("doc_id", "text"), hot=hot)
    rows = cut.select("doc_id", F.octet_length("_text").alias("n_bytes"), F.expr("aggregate(removed, 0L, (n, x) -> n + x.end - x.begin)").alias("n_removed"),
                      F.size("removed").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")).collect()
    compare(rows, range(len(texts)), texts)


def test_odd_rows(llm, make_docs, odd_texts, folder):
    texts = [*odd_texts[:8], "A" * 5000, "B" * 300, "B" * 300]
    ids = [None, *range(1, 9), 4, 4]
    docs = make_docs(texts, ids).withColumn("rid", F.lit(1)).withColumn("kept", F.lit("x"))
    compare(op7_suffix_dedup(llm, folder(documents=docs)).collect(), ids, texts)
    assert op7_suffix_dedup(llm, folder(documents=make_docs([]))).count() == 0
    out = s.remove_repeats(docs)
    assert len(out.columns) == len(set(out.columns)) and out.count() == len(texts)


def test_mergesort_by_hashes_sorts_like_bytes():
    draw = random.Random(3)
    contexts = [bytes(draw.choice(b"ab") for _ in range(draw.randint(0, 12))) + b"|anchor|" + bytes(draw.choice(b"ab") for _ in range(draw.randint(0, 12))) for _ in range(500)]
    group = np.sort(np.array([draw.randint(0, 9) for _ in contexts]))
    anchor = np.array([c.index(b"|") for c in contexts])
    c = s.Contexts(group, anchor, contexts, 200)
    for back in (False, True):
        order = s.suffix_order(c.first, c.count, c.less(back))
        keys = [(group[i], contexts[i][:anchor[i]][::-1] if back else contexts[i][anchor[i]:], i) for i in order]
        assert keys == sorted(keys)


def test_hash_collisions_are_caught(llm, make_docs, monkeypatch):
    """With a hash that sees only lengths everything seems equal; the bytes decide."""
    draw = random.Random(9)
    texts = [bytes(draw.choice(b"abc") for _ in range(260)) for _ in range(12)]
    texts += [texts[0][:230] + b"z" * 30, texts[1][20:] + b"q" * 20]
    monkeypatch.setattr(s.Hashes, "of", lambda self, start, size: np.asarray(size, np.uint64) + np.zeros(len(np.atleast_1d(start)), np.uint64))
    c = s.Contexts(np.zeros(len(texts), np.int64), np.full(len(texts), 100), texts, 200)
    gone = {(int(m), b) for m, lo, hi in c.repeated() for b in range(lo, hi)}
    want = {(m, b) for m, t in enumerate(texts) for i in range(len(t) - 199) for b in range(i, i + 200) if any(t[i:i + 200] == u[i:i + 200] for n, u in enumerate(texts) if n != m)
            } | {(m, b) for m, t in enumerate(texts) for i in range(len(t) - 199) if sum(t[i:i + 200] in u for u in texts) > 1 for b in range(i, i + 200)}
    assert gone == want


def test_extensions_equal_the_common_bytes():
    draw = random.Random(4)
    contexts = [bytes(draw.choice(b"ab") for _ in range(draw.randint(0, 9))) + b"|" + bytes(draw.choice(b"ab") for _ in range(draw.randint(0, 9))) for _ in range(200)]
    anchor = np.array([c.index(b"|") for c in contexts])
    c = s.Contexts(np.zeros(len(contexts), np.int64), anchor, contexts, 200)
    i, j = (np.array([draw.randrange(len(contexts)) for _ in range(2000)]) for _ in range(2))
    common = lambda x, y: next((k for k, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))
    assert c.extension(i, j, False).tolist() == [common(contexts[x][anchor[x]:], contexts[y][anchor[y]:]) for x, y in zip(i, j, strict=True)]
    assert c.extension(i, j, True).tolist() == [common(contexts[x][:anchor[x]][::-1], contexts[y][:anchor[y]][::-1]) for x, y in zip(i, j, strict=True)]


def test_anchors_take_little_memory():
    """Whatever the texts' lengths: 10 MB as measured (141 MB with buffers of 2 MB)."""
    import tracemalloc

    draw = np.random.default_rng(2)
    texts = [draw.integers(97, 123, n, np.uint8).tobytes() for n in (3_000_000, 500_000, 500_000, 199, 0)]
    s.powers(1)
    tracemalloc.start()
    try:
        found = s.anchors(texts, 200)
        peak = tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()
    assert peak < 40
    windows = found["first"] - found["last"] + 1
    assert int(windows.sum()) == sum(max(0, len(t) - 199) for t in texts)


def test_lengths_above_a_buffer():
    """Strings longer than a usual buffer have an anchor too."""
    text = np.random.default_rng(3).integers(97, 123, 400_000, np.uint8).tobytes()
    found = s.anchors([text, text], 150_000)
    assert int((found["first"] - found["last"] + 1).sum()) == 2 * (400_000 - 150_000 + 1)
    assert {(a, c) for r, a, c in zip(found["row"], found["a"], found["c"], strict=True) if r == 0} == {(a, c) for r, a, c in zip(found["row"], found["a"], found["c"], strict=True) if r == 1}
