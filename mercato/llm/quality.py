"""Document quality by Bradley-Terry pairwise ranking.

A preference pair is a good and a poor document. Bradley-Terry says that the
good one wins with probability sigmoid(w . (x_good - x_poor)); w is fitted by
logistic loss on the feature differences of pairs. A document's rank score is
w . x. The cut is a quantile of the labelled documents' rank scores, at the share
of poor ones; the reported score is sigmoid(rank score - cut), so 0.5 is the cut.

Features are counts and ratios of the whole text (lengths, letter cases,
symbols, repetition of words, lines and word pairs), each also as membership
in the labelled documents' quantile bins, so that a linear score can bend.

The fit uses every labelled document. They are dealt by id hash into groups of
about ``GROUP``, each with at least ``RARE`` of the rarer label where there are
more groups than it can fill (its documents are then in several). In a group
every document is in a pair; the groups' weights are averaged by documents
``ROUNDS`` times. Bins and cut are quantiles of all labelled documents (Spark's
summary of them, off by at most 1/``ACCURACY`` of the ranks). Scoring reads every
whole text.

Defined results: null or empty text has the features of the empty text; null
labels don't count, of several labels of a document the largest does; without
both kinds of labels every score is 0.5; null ids and repeated rows are scored
like any other; an empty table gives an empty one; all columns are kept but for
one named like the result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.llm.common import by_batch, discard, intermediates, utf8, written
from mercato.llm.toxicity import averaged, labelled, rounds

GROUP = 8_000  #: labelled documents that one task fits on
RARE = 64
ROUNDS = 10
ACCURACY = 100_000
PAIRS = 40_000  #: pairs of a group, at most (more if a document were in none)
BINS = 12
STEPS = 300
PENALTY = 1e-4

#: Byte classes whose shares are features.
CLASSES = {
    "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "digit": bytes(range(48, 58)), "blank": b" \t\r\x0b\x0c",
    "line": b"\n", "stop": b".", "comma": b",;:", "cry": b"!?", "bar": b"|", "odd": b"*%$#&@^~=+<>{}[]\\_", "rest": b"'\"()-/`",
}
URL = re.compile(rb"https?://|www\.|@[a-z]")


def features(text: bytes) -> list[float]:
    size = max(1, len(text))
    shares = [(len(text) - len(text.translate(None, chars))) / size for chars in CLASSES.values()]
    words = text.split()
    n = max(1, len(words))
    lines = [x for x in text.split(b"\n") if x.strip()]
    lowered = text.lower().split()
    kinds = len(set(lowered))
    pairs = len(set(zip(lowered, lowered[1:], strict=False)))
    same = sum(a == b for a, b in zip(lowered, lowered[1:], strict=False))
    longest = max(map(len, words), default=0)
    return [
        *shares, sum(shares[:2]), np.log1p(len(text)), np.log1p(len(words)), size / n, longest, kinds / n, kinds / n ** 0.8,
        pairs / max(1, len(words) - 1), same / n, len(set(lines)) / max(1, len(lines)), n / max(1, len(lines)), len(lines),
        sum(len(w) > 10 for w in words) / n, sum(len(w) < 4 for w in words) / n, sum(w[-1:] in b".!?" for w in words) / n,
        len(URL.findall(text)) / n, sum(w.isupper() for w in words) / n, shares[0] / max(1e-9, shares[0] + shares[1]),
    ]


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    edges: list[np.ndarray]
    weights: np.ndarray
    cut: float

    def expand(self, raw: np.ndarray) -> np.ndarray:
        """Standardised features and their quantile bins."""
        bins = [np.eye(len(e) + 1)[np.searchsorted(e, raw[:, i])] for i, e in enumerate(self.edges)]
        return np.concatenate([np.clip((raw - self.mean) / self.scale, -5, 5), *bins], 1)

    def rank(self, raw: np.ndarray) -> np.ndarray:
        return self.expand(raw) @ self.weights


def feature_rows(sample: DataFrame) -> DataFrame:
    """key, y and features of each labelled document."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [features(t) for t in utf8(batch.column(1))]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(rows, pa.list_(pa.float64()))], ["key", "y", "x"])

    return sample.mapInArrow(by_batch(run), "key long, y int, x array<double>")


def dealt(found: DataFrame, groups: int, rarer: int, n_rarer: int) -> DataFrame:
    """One row a group: its documents' number and their (label, features) rows
    as doubles; the ``rarer`` label's documents come in as many groups as it takes."""
    copies = min(groups, -(-RARE * groups // n_rarer)) if groups > 1 else 1
    times = F.when(F.col("y") == rarer, F.sequence(F.lit(0), F.lit(copies - 1))).otherwise(F.array(F.lit(0)))
    spread = found.select("*", F.explode(times).alias("copy")).withColumn("part", F.pmod(F.col("key") + F.col("copy"), F.lit(groups)))

    def pack(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["y"].to_pylist(), table["x"].to_pylist(), strict=True))
        data = np.array([[y, *x] for y, x in rows], "<f8").tobytes()
        return pa.table({"n": pa.array([len(rows)], pa.int64()), "rows": pa.array([data], pa.binary())})

    return spread.groupBy("part").applyInArrow(pack, "n long, rows binary")


def climb(state: tuple[np.ndarray, ...], model: Model, data: bytes, begin: int, end: int, pairs: int) -> tuple[np.ndarray, ...]:
    """Gradient steps ``begin`` to ``end`` (without it) on a group's pairs."""
    rows = np.frombuffer(data, "<f8").reshape(-1, len(model.mean) + 1)
    good, poor = np.flatnonzero(rows[:, 0] == 1), np.flatnonzero(rows[:, 0] == 0)
    if not len(good) or not len(poor):
        return state
    x, draw, n = model.expand(rows[:, 1:]), np.random.default_rng(7), max(min(pairs, 5 * len(rows)), len(good), len(poor))
    i, j = (np.concatenate([draw.permutation(side) for _ in range(-(-n // len(side)))])[:n] for side in (good, poor))
    w, first, second = state
    for step in range(begin, end):
        part = slice(step % 6, None, 6)
        difference = x[i[part]] - x[j[part]]
        gradient = difference.T @ (1 / (1 + np.exp(np.clip(difference @ w, -60, 60)))) / max(1, len(difference)) - PENALTY * w
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient ** 2
        w = w + 0.05 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    return w, first, second


def cut_at(found: DataFrame, model: Model, share: float) -> float:
    """Middle between the rank scores around the quantile ``share`` of ``found``."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(model.rank(np.array(batch.column(0).to_pylist(), np.float64)))], ["rank"])

    ranks = found.select("x").mapInArrow(by_batch(run), "rank double")
    low = ranks.agg(F.percentile_approx("rank", share, ACCURACY)).first()[0]
    high = ranks.where(F.col("rank") > low).agg(F.min("rank")).first()[0]
    return low if high is None else (low + high) / 2


def train(docs: DataFrame, labels: DataFrame, learn, label: str = "quality", pairs: int = PAIRS) -> Model:
    """Fit on every labelled document; ``learn`` says which ids may be used."""
    before = intermediates()
    found = written(feature_rows(labelled(docs, labels, label, learn)), "features")
    width = len(features(b""))
    x = [F.element_at("x", i + 1) for i in range(width)]
    n, good, poor = found.agg(F.count("y"), F.count_if(F.col("y") == 1), F.count_if(F.col("y") == 0)).first()
    if not good or not poor:
        return Model(np.zeros(width), np.ones(width), [np.zeros(0)] * width, np.zeros(2 * width), 0.0)
    at = [i / BINS for i in range(1, BINS)]
    said = found.agg(*[F.avg(c) for c in x], *[F.stddev_pop(c) for c in x], *[F.percentile_approx(c, at, ACCURACY) for c in x]).first()
    edges = [np.unique(said[2 * width + i]) for i in range(width)]
    model = Model(np.array(said[:width]), np.array(said[width:2 * width]) + 1e-9, edges, np.zeros(0), 0.0)
    groups = written(dealt(found, max(1, n // GROUP), int(good < poor), min(good, poor)), "feature_groups")
    size = width + sum(len(e) + 1 for e in edges)
    state = (np.zeros(size),) * 3
    for begin, end in rounds(STEPS, ROUNDS):
        state = averaged(groups, lambda data, now, b=begin, e=end: climb(now, model, data, b, e, pairs), "rows", state)
    model.weights = state[0]
    model.cut = cut_at(found, model, poor / n)
    discard(docs.sparkSession, [p for p in intermediates() if p not in before])
    return model


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with ``quality_score`` (0 to 1; the cut is at 0.5)."""
    plain = df.select(*(f"`{c}`" for c in df.columns if c.lower() != "quality_score"))
    out = T.StructType([*plain.schema.fields, T.StructField("quality_score", T.DoubleType())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw = np.array([features(t) for t in utf8(batch.column(batch.schema.get_field_index(text)))])
        made = 1 / (1 + np.exp(-np.clip(model.rank(raw) - model.cut, -60, 60)))
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(made)], [f.name for f in out.fields])

    return plain.mapInArrow(by_batch(run), out)
