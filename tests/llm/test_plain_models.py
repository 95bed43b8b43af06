"""The models against plain versions of their formulas; the decontamination
against a join of windows without hashes; the pipeline's stages on odd rows."""

import math
import os
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest

from mercato.llm import decontaminate as dc
from mercato.llm import interpolated_lm as lm
from mercato.llm import quality, toxicity
from mercato.llm.common import discard, intermediates
from test_scores import crc

RNG = np.random.default_rng(11)
VOCABULARY = [f"w{i}" for i in range(40)]


def sigmoid(z):
    return 1 / (1 + math.exp(-z))


def test_noisy_or_of_sentences(make_docs):
    weights = dict(zip(VOCABULARY, RNG.normal(0, 2, len(VOCABULARY)), strict=True))
    keyed = sorted((toxicity.word_key(w.encode()), x) for w, x in weights.items())
    model = toxicity.Model(np.array([k for k, _ in keyed], np.uint32), np.array([x for _, x in keyed]), -1.5, -3.0)
    texts = [". ".join(" ".join(RNG.choice([*VOCABULARY, "unknown"], RNG.integers(1, 6))) for _ in range(RNG.integers(1, 5))) + ".\n" for _ in range(60)] + ["", None, " \n "]
    for r in toxicity.score(make_docs(texts), model).collect():
        bags = [s.strip(". \n").split() for s in (texts[r.doc_id] or "").replace("\n", ". ").split(". ") if s.strip(". \n")]
        p = [sigmoid(-1.5 + sum(weights.get(w, 0.0) for w in bag)) for bag in bags]
        assert r.toxicity == pytest.approx(1 - (1 - sigmoid(-3.0)) * math.prod(1 - x for x in p), abs=1e-9)
        assert [x.p for x in r.offending] == pytest.approx([x for x in p if x >= 0.5] or ([max(p)] if p and r.toxicity >= 0.5 else []), abs=1e-9)


def bag_likelihood(x, rows):
    """Penalised mean log likelihood of the documents' labels."""
    total = 0.0
    for y, sizes, places in rows:
        clean, at = math.log1p(-sigmoid(x[-1])), 0
        for n in sizes:
            clean += math.log1p(-sigmoid(x[-2] + sum(x[i] for i in places[at:at + n])))
            at += n
        total += math.log(-math.expm1(clean)) if y else clean
    return total / len(rows) - toxicity.PENALTY / 2 * float((np.asarray(x[:-2]) ** 2).sum())


def test_multiple_instance_fit_follows_the_likelihood(monkeypatch):
    rows = []
    for d in range(40):
        sizes = RNG.integers(0, 5, RNG.integers(1, 4)).astype("<u4")
        rows.append((int(d % 3 == 0), sizes, RNG.integers(0, 6, sizes.sum()).astype("<u4")))
    keys = np.arange(6, dtype=np.uint32)
    as_vector = lambda m: np.array([*m.weights, m.bias, m.leak])
    monkeypatch.setattr(toxicity, "STEPS", 0)
    start = as_vector(toxicity.fit(keys, rows))
    monkeypatch.setattr(toxicity, "STEPS", 1)
    step = as_vector(toxicity.fit(keys, rows)) - start
    slope = [(bag_likelihood(start + h, rows) - bag_likelihood(start - h, rows)) / 2e-6 for h in np.eye(8) * 1e-6]
    assert np.abs(slope).min() > 1e-5 and np.array_equal(np.sign(step), np.sign(slope))
    monkeypatch.setattr(toxicity, "STEPS", 150)
    assert bag_likelihood(as_vector(toxicity.fit(keys, rows)), rows) > bag_likelihood(start, rows) + 0.02


def test_bradley_terry_fit_follows_the_pairs(llm, make_docs, monkeypatch):
    from pyspark.sql import functions as F
    texts = [("Good prose, with marks. " if i % 2 else "zzz 111 !!! ") * (3 + i % 7) + f"number {i}" for i in range(80)]
    docs, labels = make_docs(texts), llm.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, quality int")
    raw = np.array([quality.features(t.encode()) for t in texts])
    fit = lambda steps: (monkeypatch.setattr(quality, "STEPS", steps), quality.train(docs, labels, lambda _: F.lit(True), pairs=600))[1]

    def loss(m):
        x = m.expand(raw) @ m.weights
        return float(np.mean([math.log1p(math.exp(-(x[g] - x[p]))) for g in range(1, 80, 2) for p in range(0, 80, 2)]))

    one, all_steps = fit(1), fit(300)
    assert loss(one) < math.log(2) and loss(all_steps) < loss(one) and loss(all_steps) < 0.05
    for r in quality.score(docs, all_steps).collect():
        x = float(all_steps.expand(raw[r.doc_id:r.doc_id + 1])[0] @ all_steps.weights)
        assert r.quality_score == pytest.approx(sigmoid(max(-60, min(60, x - all_steps.cut))), abs=1e-9) and (r.quality_score >= 0.5) == bool(r.doc_id % 2)


def test_interpolation_weights_equal_plain_expectation_maximisation(make_docs, monkeypatch):
    texts = [" ".join(np.random.default_rng(i).choice(VOCABULARY[:12], i % 15, p=np.arange(12, 0, -1) / 78)) for i in range(160)]
    learned = {}
    real = lm.learn_weights
    monkeypatch.setattr(lm, "learn_weights", lambda *a: learned.setdefault("weights", real(*a)))
    lm.score(make_docs(texts)).count()
    bigrams = lambda t: list(zip(["^", *t.split()], [*t.split(), "$"], strict=True))
    kept = [t for i, t in enumerate(texts) if crc(i, 5) not in (1, 4)]
    single, pair = Counter(b for t in kept for _, b in bigrams(t)), Counter(p for t in kept for p in bigrams(t))
    n, v = sum(single.values()), len(single)
    rounded = lambda f: 2.0 ** (round(4 * math.log2(f)) / 4) if f else 0.0
    cells = []
    for t in (t for i, t in enumerate(texts) if crc(i, 5) == 4):
        for a, b in bigrams(t):
            context = single["$"] if a == "^" else single[a]
            cells.append((int(math.log2(context)) + 1 if context else 0, rounded(pair[a, b] / max(context, 1)), rounded(single[b] / n), 1 / (v + 1)))
    weights = {b: [0.5, 0.4, 0.1] for b, *_ in cells}
    for _ in range(60):
        mass = {b: [1e-3 * x for x in w] for b, w in weights.items()}
        for b, *f in cells:
            parts = [w * x for w, x in zip(weights[b], f, strict=True)]
            for i in range(3):
                mass[b][i] += parts[i] / sum(parts)
        weights = {b: [x / sum(m) for x in m] for b, m in mass.items()}
    assert len(weights) >= 3
    for b, w in weights.items():
        w = np.maximum([0.0 if b == 0 else w[0], w[1], w[2]], [0, 1e-9, 1e-9])
        assert learned["weights"][b] == pytest.approx(w / w.sum(), rel=1e-6, abs=1e-9)


# -- decontamination: windows joined by their words ------------------------------------


def plain_words(text):
    """(lower-case core, kind, opens a sentence, joined to the word before)."""
    out, opens, marks = [], True, True
    for word in (text or "").encode().split():
        core = word.strip(dc.EDGE)
        kind = dc.read_word(word)[1] & 7
        before = word[:1] in [bytes([c]) for c in dc.EDGE] and len(core) < len(word)
        after = word[-1:] in [bytes([c]) for c in dc.EDGE] and len(core) < len(word)
        out.append((core.decode().lower(), kind, opens, bool(out) and not marks and not before))
        opens, marks = len(core) < len(word) and word.endswith(dc.ENDS), after
    return out


def plain_tokens(words, kinds):
    """Slots for runs of names and of numbers: (token, slot value, first word, word after)."""
    tokens = []
    for i, ((core, *_, joined), kind) in enumerate(zip(words, kinds, strict=True)):
        if tokens and joined and kind in (dc.NAME, dc.NUM) and kinds[i - 1] == kind:
            _, value, first, _ = tokens[-1]
            tokens[-1] = (f"<{kind}>", (*value, core), first, i + 1)
        else:
            tokens.append((core if kind == dc.LITERAL else f"<{kind}>", (core,), i, i + 1))
    return tokens


def plain_windows(words, item, width=None):
    """{(form, key tokens, first word, word after, slots)} of a text."""
    kinds = [k for _, k, *_ in words]
    opening = [dc.LITERAL if k == dc.NAME and o else k for _, k, o, _ in words]
    nameless = [dc.LITERAL if k == dc.NAME else k for k in kinds]
    found = set()
    wide = min(dc.WINDOW, len(words)) if width is None else width
    for i in range(len(words) - wide + 1):
        found.add((False, tuple(w[0] for w in words[i:i + wide]), i, i + wide, ()))
    if len(words) < dc.WINDOW:
        return found
    for reading in [kinds, opening, *([nameless] if item else [])]:
        tokens = plain_tokens(words, reading)
        plain = [t[0][0] != "<" for t in tokens]
        least = min(dc.WINDOW, len(tokens))
        spans = set()
        for i in range(len(tokens) - least + 1):
            end = i + least
            while end < len(tokens) and sum(plain[i:end]) < dc.LITERALS:
                end += 1
            if sum(plain[i:end]) >= dc.LITERALS:
                spans.add((i, end))
            begin, end = i, i + least
            while begin and sum(plain[begin:end]) < dc.LITERALS:
                begin -= 1
            if sum(plain[begin:end]) >= dc.LITERALS:
                spans.add((begin, end))
        for a, b in spans:
            if not all(plain[a:b]):
                found.add((True, tuple(t[0] for t in tokens[a:b]), tokens[a][2], tokens[b - 1][3], tuple(t[1] for t, p in zip(tokens[a:b], plain[a:b], strict=True) if not p)))
    return found


def test_shared_windows_equal_a_plain_join(llm, make_docs):
    filler = [*"the red old house stands near a wide river and many small boats pass by under its stone bridge each day".split(), "Anna", "Boris", "Rome", "12", "seven", "km", "5", "Carl"]
    rng = np.random.default_rng(3)
    make = lambda n: " ".join(w + (("," if rng.random() < 0.1 else ".") if rng.random() < 0.15 else "") for w in rng.choice(filler, n))
    items = {i: make(int(rng.integers(8, 26))) for i in range(30)}
    texts = []
    for i in range(150):
        words = items[i % 30].split()
        a, b = sorted(rng.integers(0, len(words) + 1, 2))
        part = [{"Anna": "Otto", "12": "40", "Rome": "Oslo"}.get(w, w) if i % 2 else w for w in words[a:b]]
        texts.append(" ".join([make(6), *part, make(5)]))
    got = {(r.doc_id, r.item_id): r for r in dc.find_leaks(make_docs(texts), llm.createDataFrame(list(items.items()), "item_id long, text string")).collect()}
    shared = {}
    for item, text in items.items():
        mine = {}
        for form, key, at, to, slots in plain_windows(plain_words(text), True):
            mine.setdefault((form, key, len(slots)), []).append((at, to))
        for doc, other in enumerate(texts):
            for form, key, place, _, slots in plain_windows(plain_words(other), False, dc.WINDOW if len(text.split()) >= dc.WINDOW else None):
                for at, _ in mine.get((form, key, len(slots)), []):
                    shared.setdefault((doc, item), set()).add((place, at))
    assert set(got) == set(shared) and len(got) > 20
    for pair, hits in shared.items():
        assert got[pair].begin in {place for place, _ in hits} and 1 <= got[pair].windows <= len({at for _, at in hits})


# -- the pipeline's stages on odd rows -------------------------------------------------


def test_stages_on_odd_rows_and_empty_tables(llm, make_docs, odd_texts, folder):
    texts = [*odd_texts, *["a copied benchmark item of more than eight words in a row, indeed"] * 2]
    ids = [None, 1, 1, *range(3, len(texts) - 1), None]
    labels = llm.createDataFrame([], "doc_id long, quality int, toxic int")
    items = llm.createDataFrame([(1, texts[-1]), (None, None)], "item_id long, text string")
    place = folder(documents=make_docs(texts, ids), labels=labels, benchmark=items)
    frame = llm.read.parquet(f"{place}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(llm, frame, place)
        assert frame.columns == corpus_pipeline.COLUMNS, name
        left = [r.text or "" for r in frame.collect()]
        assert any(not t.strip() for t in left), name
    assert len(left) < len(texts) and texts[-1] not in left and odd_texts[6] in left
    before = intermediates()
    result = corpus_pipeline.run(llm, place)
    *kept, last = intermediates()  # of all that the run wrote only what its last stage reads is left
    assert kept == before and "pipeline-benchmark_decontamination" in last
    done = result.collect()
    assert len(done) == len(left) and min(r.n_tokens for r in done) == 0
    discard(llm, [last, place])
    assert intermediates() == before and not os.path.exists(last) and os.path.exists(place)
    empty = folder(documents=make_docs([]), labels=labels, benchmark=items.limit(0))
    assert corpus_pipeline.run(llm, empty).count() == 0
