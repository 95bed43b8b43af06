"""Toxicity, quality and the language model: held-out accuracy, brute force, odd rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from mercato.llm import interpolated_lm, quality, toxicity
from mercato.llm.queries import op1_toxicity, op5_quality, op9_interpolated_lm
from pyspark.sql import functions as F

MEDIUM = "/root/testdata/sf0.01"


def crc(doc_id, m):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % m


@pytest.mark.parametrize(("query", "label", "modulus", "left", "least"), [(op1_toxicity, "toxic", 5, 0, 0.9), (op5_quality, "quality", 3, 1, 0.97)])
def test_held_out_accuracy(llm, query, label, modulus, left, least):
    labels = {r.doc_id: r[label] for r in llm.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    rows = query(llm, MEDIUM).collect()
    assert len(rows) == llm.read.parquet(f"{MEDIUM}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (crc(r.doc_id, modulus) == left) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) >= least


@pytest.mark.parametrize("query", [op1_toxicity, op5_quality])
def test_odd_tables(llm, make_docs, odd_texts, folder, query):
    schema = "doc_id long, quality int, toxic int"
    docs = make_docs(odd_texts, [None, *range(1, len(odd_texts))]).withColumn("score", F.lit("x")).withColumn("toxicity", F.lit(1))
    for labels in ([], [(1, None, None), (None, 1, 1), (2, 1, 1), (2, 0, 0)], [(i, i % 2, i % 2) for i in range(9)]):
        rows = query(llm, folder(documents=docs, labels=llm.createDataFrame(labels, schema))).collect()
        assert len(rows) == len(odd_texts) and all(0 <= r.score <= 1 for r in rows)
    assert query(llm, folder(documents=make_docs([]), labels=llm.createDataFrame([], schema))).count() == 0


def test_offending_sentence_is_located(llm, make_docs, folder):
    texts = [f"all is well with number {i}. " + ("you vile creature! " if i % 3 == 0 else "a fine day! ") + "the end." for i in range(120)]
    docs = make_docs(texts)
    model = toxicity.train(docs, llm.createDataFrame([(i, int(i % 3 == 0)) for i in range(120)], "doc_id long, toxic int"), lambda _: F.lit(True))
    for r in toxicity.score(docs, model).collect():
        found = [r.text.encode()[x.begin:x.end] for x in r.offending]
        assert found == ([b"you vile creature!"] if r.doc_id % 3 == 0 else [])


def test_language_model_base_and_probabilities(llm):
    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    words = {d.doc_id: d.text.encode().lower().split() + [None] for d in docs}
    count = Counter(w for i, ws in words.items() if crc(i, 5) != 1 for w in ws)
    n, v = sum(count.values()), len(count)
    rows = op9_interpolated_lm(llm, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(docs)
    for r in rows:
        ws = words[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (crc(r.doc_id, 5) == 1, len(ws), sum(count[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), rel=1e-9)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_language_model_equals_plain_interpolation(llm, make_docs, monkeypatch):
    """The same weights applied to plain counts give the same scores, whatever the blocks."""
    monkeypatch.setattr(interpolated_lm, "BLOCK_TOKENS", 30)
    weights = np.tile([0.6, 0.3, 0.1], (interpolated_lm.BUCKETS, 1))
    weights[0] = [0, 0.7, 0.3]
    monkeypatch.setattr(interpolated_lm, "learn_weights", lambda *a: weights)
    texts = [" ".join("abcdefg"[(i * j) % 7] for j in range(i % 9)) for i in range(80)] + [None, ""]
    rows = interpolated_lm.score(make_docs(texts)).collect()
    learned = [(t or "").split() for i, t in enumerate(texts) if crc(i, 5) != 1]
    single = Counter(w for ws in learned for w in [*ws, "$"])
    pair = Counter(p for ws in learned for p in zip(["^", *ws], [*ws, "$"], strict=True))
    n, v = sum(single.values()), len(single)
    assert len(rows) == len(texts)
    for r in rows:
        ws = (texts[r.doc_id] or "").split()
        total = 0
        for a, b in zip(["^", *ws], [*ws, "$"], strict=True):
            context = single["$"] if a == "^" else single[a]
            w = weights[int(context > 0)]
            total += math.log10(w[0] * pair[a, b] / max(context, 1) + w[1] * single[b] / n + w[2] / (v + 1))
        assert r.score == pytest.approx(total, rel=1e-9)


def test_language_model_odd_rows(llm, make_docs, odd_texts, folder):
    docs = make_docs(odd_texts, [None, 1, 1, *range(3, len(odd_texts))]).withColumn("role", F.lit("x")).withColumn("block", F.lit(1))
    assert op9_interpolated_lm(llm, folder(documents=docs)).count() == len(odd_texts)
    assert op9_interpolated_lm(llm, folder(documents=make_docs([]))).count() == 0
    one = next(i for i in range(99) if crc(i, 5) == 1)
    row = op9_interpolated_lm(llm, folder(documents=make_docs(["only held out"], [one]))).first()
    assert row.n_known == 0 and row.train_tokens == 0 and math.isfinite(row.score)


def test_models_learn_from_every_labelled_document(llm, make_docs, monkeypatch):
    """The telling word is only in documents past the 12,000 smallest id hashes."""
    order = [r.id for r in llm.range(12_400).orderBy(F.xxhash64("id")).collect()]
    late = set(order[12_000:])
    docs = make_docs([f"a plain text {i % 7}. " + ("you vile thing." if i in late else "all is well.") for i in range(12_400)])
    labels = llm.createDataFrame([(i, int(i in late)) for i in range(12_400)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "GROUP", 4_000)  # three groups
    model = toxicity.train(docs, labels, lambda _: F.lit(True))
    assert model.weight(b"vile") > 1
    assert {r.doc_id for r in toxicity.score(docs, model).where("toxicity >= 0.5").select("doc_id").collect()} == late


def test_quality_groups_hold_every_labelled_document(llm, make_docs, monkeypatch):
    texts = ["Good prose, with marks. " * (2 + i % 5) if i % 40 else "zzz 111 !!! " * (3 + i % 7) for i in range(400)]
    docs, labels = make_docs(texts), llm.createDataFrame([(i, int(i % 40 > 0)) for i in range(400)], "doc_id long, quality int")
    monkeypatch.setattr(quality, "GROUP", 100)
    monkeypatch.setattr(quality, "RARE", 4)
    groups, real = [], quality.dealt
    monkeypatch.setattr(quality, "dealt", lambda *a: (groups.extend(real(*a).collect()), real(*a))[1])
    model = quality.train(docs, labels, lambda _: F.lit(True))
    held = [np.frombuffer(r["rows"], "<f8").reshape(r.n, -1)[:, 0] for r in groups]
    assert len(held) == 4 and sum((y == 1).sum() for y in held) == 390 and all(2 <= (y == 0).sum() <= 10 for y in held)
    predicted = {r.doc_id for r in quality.score(docs, model).where("quality_score < 0.5").select("doc_id").collect()}
    assert predicted == set(range(0, 400, 40))
