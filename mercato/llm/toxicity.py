"""Toxicity by multiple-instance learning.

A document is a bag of sentences; only documents are labelled. Sentence ``s``
is toxic with p_s = sigmoid(bias + sum of its words' weights), and a document
is toxic unless no sentence is (noisy-or with a leak):

    P(toxic) = 1 - (1 - p_leak) * prod(1 - p_s)

Weights, bias and leak are fitted by gradient steps on the documents' log
likelihood; the same p_s then locate the offending sentences. Words are
compared by a 32-bit hash of their letters, so a model is two small arrays.

The fit uses every labelled document's whole text: the documents are dealt by
id hash into groups of about ``GROUP``, each group takes its steps from the
shared weights in a task of its own, and their results are averaged by documents
``ROUNDS`` times. Scoring reads every whole text.

Defined results: null or empty text has no sentence and gets the leak alone;
labels that are null don't count, of a document's several labels the largest
does; without usable labels every score is the prior 0; null ids and repeated
rows are scored like any other; an empty table gives an empty one; all columns
are kept but for those named like a result.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.llm.common import Memo, by_batch, discard, intermediates, utf8, written

GROUP = 8_000  #: labelled documents that one task fits on
ROUNDS = 10  #: times that the groups' weights are averaged
#: Labelled ids (some 30 bytes each) that are sent to every executor, so that no
#: text is shuffled; more of them meet the texts by a shuffle join.
SENT_IDS = 4_000_000
MIN_DOCUMENTS = 5  #: labelled documents that a word must occur in
WORDS = 300  #: words with weights, the most telling ones
STEPS = 150
PENALTY = 2e-5

#: Sentences end after . ! ? before white space, and at line ends.
END = re.compile(rb"(?<=[.!?])[ \t\r\x0b\x0c]+|\n+")
EDGE = b".,;:!?\"'()[]{}<>*%$#&|-_~`/\\+=@^"


def word_key(word: bytes) -> int:
    return zlib.crc32(word.strip(EDGE))


def sentences(text: bytes) -> list[tuple[int, int]]:
    """[begin, end) of each sentence, in bytes."""
    out, at = [], 0
    for m in END.finditer(text):
        out.append((at, m.start()))
        at = m.end()
    out.append((at, len(text)))
    return [(b, e) for b, e in out if text[b:e].strip()]


@dataclass
class Model:
    keys: np.ndarray  # uint32, sorted
    weights: np.ndarray
    bias: float
    leak: float

    def weight(self, word: bytes) -> float:
        key = word_key(word)
        i = int(np.searchsorted(self.keys, key))
        return float(self.weights[i]) if i < len(self.keys) and self.keys[i] == key else 0.0


def softplus(z):
    return np.logaddexp(0, z)


def labelled(docs: DataFrame, labels: DataFrame, label: str, learn) -> DataFrame:
    """(key, text, y) of every labelled document for which ``learn`` (a function
    of the id column's name) holds; ``key`` is a hash of the id."""
    ids = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).where(learn("doc_id"))
           .groupBy("doc_id").agg(F.max(label).cast("int").alias("_y")))
    if labels.count() <= SENT_IDS:
        ids = F.broadcast(ids)
    return docs.select("doc_id", "text").join(ids, "doc_id").select(F.xxhash64("doc_id").alias("key"), "text", F.col("_y").alias("y"))


def telling_words(sample: DataFrame, limit: int) -> tuple[np.ndarray, float]:
    """The ``limit`` words that fall most unevenly on the two labels (squared
    standard score of their documents' labels), and the share of label 1."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        memo, found = Memo(word_key, 100_000), [set() for _ in range(batch.num_rows)]
        for own, text in zip(found, utf8(batch.column(1)), strict=True):
            own.update(memo[w] for w in text.lower().split())
        y = np.repeat(np.array(batch.column(2).to_pylist(), np.int32), [len(f) for f in found])
        return pa.RecordBatch.from_arrays([pa.array(y), pa.array([k for f in found for k in f], pa.int64())], ["y", "key"])

    count, positive = sample.agg(F.count("y"), F.sum("y")).first()
    if not count or positive in (0, count):
        return np.zeros(0, np.uint32), (positive or 0) / max(1, count)
    rate = positive / count
    per = sample.mapInArrow(by_batch(run), "y int, key long").groupBy("key").agg(F.count("*").alias("n"), F.sum("y").alias("hits")).where(F.col("n") >= MIN_DOCUMENTS)
    score = F.pow(F.col("hits") - F.col("n") * rate, 2) / (F.col("n") * (rate * (1 - rate)))
    return np.sort(np.array([r.key for r in per.orderBy(score.desc(), "key").limit(limit).collect()], np.uint32)), rate


def bags(sample: DataFrame, keys: np.ndarray) -> DataFrame:
    """Label, known words of each sentence and their numbers, per labelled
    document (without those that have no sentence)."""
    number = {int(k): i for i, k in enumerate(keys)}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        memo, sizes, places = Memo(lambda w: number.get(word_key(w), -1), 100_000), [], []
        for text in utf8(batch.column(1)):
            words = [[i for i in map(memo.__getitem__, text[b:e].lower().split()) if i >= 0] for b, e in sentences(text)]
            sizes.append(np.array([len(w) for w in words], "<u4").tobytes())
            places.append(np.array([k for w in words for k in w], "<u4").tobytes())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(sizes, pa.binary()), pa.array(places, pa.binary())], ["key", "y", "sizes", "places"])

    return sample.mapInArrow(by_batch(run), "key long, y int, sizes binary, places binary").where(F.length("sizes") > 0)


def train(docs: DataFrame, labels: DataFrame, learn, label: str = "toxic") -> Model:
    """Fit on every labelled document; ``learn`` says which ids may be used."""
    sample = labelled(docs, labels, label, learn)
    keys, rate = telling_words(sample, WORDS)
    empty = Model(np.zeros(0, np.uint32), np.zeros(0), -50.0, 50.0 if rate == 1 else -50.0)
    if not 0 < rate < 1:
        return empty
    before = intermediates()
    found = written(bags(sample, keys), "bags")
    n, toxic, n_sentences = found.agg(F.count("y"), F.sum("y"), F.sum(F.length("sizes") / 4)).first()
    if not n:
        return empty
    groups = max(1, n // GROUP)
    dealt = written(found.groupBy(F.pmod("key", F.lit(groups)).alias("part")).applyInArrow(packed, "n long, bags binary"), "bag_groups")
    state = (start(len(keys), toxic / n, n_sentences / n), np.zeros(len(keys) + 2), np.zeros(len(keys) + 2))
    for begin, end in rounds(STEPS, ROUNDS):
        state = averaged(dealt, lambda data, now, b=begin, e=end: climb(now, unpacked(data), b, e), "bags", state)
    discard(docs.sparkSession, [p for p in intermediates() if p not in before])
    x = state[0]
    return Model(keys, x[:-2], float(x[-2]), float(x[-1]))


def packed(table: pa.Table) -> pa.Table:
    """A group's bags as one row."""
    rows = sorted(zip(table["y"].to_pylist(), table["sizes"].to_pylist(), table["places"].to_pylist(), strict=True))
    data = pa.table({"y": pa.array([r[0] for r in rows], pa.int32()), "sizes": pa.array([r[1] for r in rows], pa.large_binary()), "places": pa.array([r[2] for r in rows], pa.large_binary())})
    return pa.table({"n": pa.array([len(rows)], pa.int64()), "bags": pa.array([to_bytes(data)], pa.binary())})


def unpacked(data: bytes) -> list[tuple[int, np.ndarray, np.ndarray]]:
    t = from_bytes(data)
    return [(y, np.frombuffer(s, "<u4"), np.frombuffer(p, "<u4")) for y, s, p in zip(t["y"].to_pylist(), t["sizes"].to_pylist(), t["places"].to_pylist(), strict=True)]


def to_bytes(data: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, data.schema) as stream:
        stream.write_table(data)
    return out.getvalue().to_pybytes()


def from_bytes(data: bytes) -> pa.Table:
    with pa.ipc.open_stream(data) as stream:
        return stream.read_all()


def rounds(steps: int, most: int) -> list[tuple[int, int]]:
    """Steps 1 to ``steps`` in at most ``most`` stretches [begin, end)."""
    cuts = [1 + steps * i // min(most, steps) for i in range(min(most, steps) + 1)] if steps else []
    return list(zip(cuts, cuts[1:], strict=False))


def averaged(groups: DataFrame, fit_group, column: str, state: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """The mean, weighted by ``n``, of what ``fit_group`` (a group's data,
    state) makes of ``state`` in each row of ``groups``. Only the mean of each
    number comes to the driver."""
    flat, shape = np.concatenate(state), len(state)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        total, weight = np.zeros_like(flat), 0
        for n, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            total, weight = total + n * np.concatenate(fit_group(data, tuple(np.split(flat, shape)))), weight + n
        return pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int32()), pa.array(total), pa.array([weight] * len(flat), pa.int64())], ["place", "total", "n"])

    rows = groups.select("n", column).mapInArrow(by_batch(run), "place int, total double, n long").groupBy("place").agg((F.sum("total") / F.sum("n")).alias("mean")).collect()
    out = flat.copy()
    for r in rows:
        out[r.place] = r["mean"]
    return tuple(np.split(out, shape))


def start(n_keys: int, rate: float, sentences_each: float) -> np.ndarray:
    """Weights, bias and leak before the first step."""
    rate = float(np.clip(rate, 1e-6, 1 - 1e-6))
    x = np.zeros(n_keys + 2)
    x[-2:] = np.log(rate / 2 / (1 - rate / 2)) - np.log(sentences_each), np.log(rate / 2 / (1 - rate / 2))
    return x


def climb(state: tuple[np.ndarray, ...], rows: list[tuple[int, np.ndarray, np.ndarray]], begin: int, end: int) -> tuple[np.ndarray, ...]:
    """Gradient steps ``begin`` to ``end`` (without it) on the likelihood of ``rows``."""
    x, first, second = state
    n_keys = len(x) - 2
    y = np.array([r[0] for r in rows], np.float64)
    place = np.concatenate([r[2] for r in rows]).astype(np.int64)
    sizes = np.concatenate([r[1] for r in rows]).astype(np.int64)
    sentence = np.repeat(np.arange(len(sizes)), sizes)
    document = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    for step in range(begin, end):
        z = x[-2] + np.bincount(sentence, x[place], len(sizes))
        clean = -np.bincount(document, softplus(z), len(rows)) - softplus(x[-1])  # log P(no sentence is toxic)
        p = -np.expm1(clean)
        # d log likelihood / dz = p_s * (1-P)/P for toxic documents, -p_s for others
        pull = np.where(y > 0, np.exp(clean) / np.maximum(p, 1e-12), -1.0)
        by_sentence = pull[document] / (1 + np.exp(-np.clip(z, -60, 60)))
        gradient = np.concatenate([np.bincount(place, by_sentence[sentence], n_keys), [by_sentence.sum(), (pull / (1 + np.exp(-x[-1]))).sum()]]) / len(rows)
        gradient[:-2] -= PENALTY * x[:-2]
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient ** 2
        x = x + 0.1 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    return x, first, second


def fit(keys: np.ndarray, rows: list[tuple[int, np.ndarray, np.ndarray]]) -> Model:
    """The fit on one group alone."""
    x = start(len(keys), float(np.mean([r[0] for r in rows])), sum(len(r[1]) for r in rows) / len(rows))
    x = climb((x, np.zeros_like(x), np.zeros_like(x)), rows, 1, STEPS + 1)[0]
    return Model(keys, x[:-2], float(x[-2]), float(x[-1]))


def score(df: DataFrame, model: Model, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """``df`` with ``toxicity`` (0 to 1) and ``offending``: the sentences whose
    own probability reaches ``threshold``, or the likeliest one of a document
    that reaches it, as [begin, end) bytes with their probability."""
    kept = [c for c in df.columns if c.lower() not in ("toxicity", "offending")]
    plain = df.select(*(f"`{c}`" for c in kept))
    span = T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType()), T.StructField("p", T.DoubleType())])
    out = T.StructType([*plain.schema.fields, T.StructField("toxicity", T.DoubleType()), T.StructField("offending", T.ArrayType(span))])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        weight, scores, found = Memo(model.weight, 200_000).__getitem__, [], []
        for data in utf8(batch.column(batch.schema.get_field_index(text))):
            spans = sentences(data)
            z = model.bias + np.array([sum(map(weight, data[b:e].lower().split())) for b, e in spans], np.float64)
            total = float(-np.expm1(-softplus(z).sum() - softplus(model.leak)))
            p = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
            hit = np.flatnonzero(p >= threshold).tolist()
            if not hit and total >= threshold and len(p):
                hit = [int(p.argmax())]
            scores.append(total)
            found.append([{"begin": spans[i][0], "end": spans[i][1], "p": float(p[i])} for i in hit])
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64()), pa.array(found, kind)], [f.name for f in out.fields])

    return plain.mapInArrow(by_batch(run), out)
