"""Runs: maximal stretches of words that repeat with a period.

Baier's grouping, the first phase of his suffix sorter, takes the suffixes'
groups from the greatest to the smallest; a group's members hand their context
to the nearest earlier position that is still in a smaller group. A position
leaves with the longest Lyndon word that starts there, so the phase by itself
yields the Lyndon array, without a suffix array. It is done under an order of
the words and under its reverse: by the runs theorem every run has, under one
of the two, a root among these Lyndon words. Each word is a candidate period;
longest common extensions to both sides (galloping comparisons of the id
arrays, so they are exact) make it a run or not.

A document is one unit of work. Before the grouping it is cut into the
stretches in which a run can lie at all: inside a run of the wanted length and
exponent each window of :func:`window` words occurs again, so words that no
repeated window covers belong to no run and separate stretches. That loses
nothing; a text without repetition has no stretch left.

Defined results: null, empty or blank text -> no words, no runs, an empty
collapsed text; rows are independent, so repeated rows give repeated results
and any column may be null; other columns are kept unless they bear the name of
a result (in any case), which is replaced; an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from mercato.llm.common import by_batch, utf8

Run = tuple[int, int, int]  #: start, length, period

RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")]), False)


def lyndon_lengths(ranks: list[int], symbols: int) -> list[int]:
    """Length of the longest Lyndon word at each position of ``ranks`` (numbers
    below ``symbols``), by Baier's grouping."""
    n = len(ranks)
    out = [0] * n
    members: list[list[int]] = [[] for _ in range(symbols)]
    for i, x in enumerate(ranks):
        members[x].append(i)
    group = list(ranks)
    below, above = list(range(-1, symbols - 1)), [*range(1, symbols), -1]
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))  # positions that still wait, as a linked list
    g = symbols - 1
    while g >= 0:
        waiting = [i for i in members[g] if group[i] == g]
        handed: dict[tuple[int, int], list[int]] = {}
        at, end = 0, len(waiting)
        while at < end:
            # a chain of members that follow each other, and the position before it
            i = waiting[at]
            before, count = left[i], 0
            while True:
                after = right[i]
                out[i] = after - i
                count += 1
                at += 1
                if at == end or waiting[at] != after:
                    break
                i = after
            if after < n:
                left[after] = before
            if before >= 0:
                right[before] = after
                key = (group[before], count)
                if key in handed:
                    handed[key].append(before)
                else:
                    handed[key] = [before]
        # the more copies of the context it takes, the higher its new group above the old one
        for key in sorted(handed, key=lambda key: -key[1]) if len(handed) > 1 else handed:
            old, new, moved = key[0], len(members), handed[key]
            up = above[old]
            members.append(moved)
            for i in moved:
                group[i] = new
            below.append(old)
            above.append(up)
            below[up] = new
            above[old] = new
        g = below[g]
    return out


def window(least_words: int, least_exponent: int) -> int:
    """Most words of a window that occurs again wherever it lies in a run: a run
    of period q has max(least_words, least_exponent * q) words or more, and a
    window has a copy q words before or after if these are 2q + window - 1."""
    return max(1, min(max(least_words, least_exponent * q) - 2 * q + 1 for q in range(1, least_words + 2)))


def stretches(ids: np.ndarray, least_words: int, width: int) -> list[tuple[int, int]]:
    """The [begin, end) in which a run can lie."""
    if len(ids) < max(least_words, width + 1):
        return []
    keys = np.zeros(len(ids) - width + 1, np.uint64)
    for i in range(width):
        keys = keys * np.uint64(0x9E3779B97F4A7C15) + ids[i:len(ids) - width + 1 + i].astype(np.uint64) + np.uint64(1)
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    again = np.zeros(len(keys) + 2, bool)
    again[1 + order[1:][same]] = True
    again[1 + order[:-1][same]] = True
    edges = np.flatnonzero(again[1:] != again[:-1]).reshape(-1, 2)
    found = [(b, e + width - 1) for b, e in edges.tolist() if e + width - 1 - b >= least_words]
    if 2 * sum(e - b for b, e in found) > len(ids):
        return found
    # windows may repeat in another stretch only: look again, in at most half the words
    return [(b + c, b + d) for b, e in found for c, d in stretches(ids[b:e], least_words, width)]


def extension(data: bytes, i: int, j: int, most: int) -> int:
    """Equal words from i and from j on, ``most`` at most (four bytes a word)."""
    done, step = 0, 1
    while done + step <= most and data[4 * (i + done):4 * (i + done + step)] == data[4 * (j + done):4 * (j + done + step)]:
        done, step = done + step, 2 * step
    while step:
        if done + step <= most and data[4 * (i + done):4 * (i + done + step)] == data[4 * (j + done):4 * (j + done + step)]:
            done += step
        step //= 2
    return done


def extension_back(data: bytes, i: int, j: int, most: int) -> int:
    """Equal words before i and before j, ``most`` at most."""
    done, step = 0, 1
    while done + step <= most and data[4 * (i - done - step):4 * (i - done)] == data[4 * (j - done - step):4 * (j - done)]:
        done, step = done + step, 2 * step
    while step:
        if done + step <= most and data[4 * (i - done - step):4 * (i - done)] == data[4 * (j - done - step):4 * (j - done)]:
            done += step
        step //= 2
    return done


def runs_of(ids: np.ndarray, least_words: int, least_exponent: int) -> set[Run]:
    """All runs of a stretch."""
    n, data = len(ids), np.ascontiguousarray(ids, "<i4").tobytes()
    values, ranks = np.unique(ids, return_inverse=True)
    found: set[Run] = set()
    for order in (ranks, len(values) - 1 - ranks):
        periods = np.array(lyndon_lengths(order.tolist(), len(values)))
        start = np.flatnonzero(periods * least_exponent <= n)
        after, before = start + periods[start], start - 1
        likely = (after < n) & (ids[np.minimum(after, n - 1)] == ids[start]) | (before >= 0) & (ids[after - 1] == ids[before])
        known: dict[int, tuple[int, int]] = {}  # period -> the last stretch that has it
        for i, p in zip(start[likely].tolist(), periods[start[likely]].tolist(), strict=True):
            b, e = known.get(p, (0, 0))
            if b <= i and i + p <= e:
                continue
            b, e = i - extension_back(data, i, i + p, i), i + p + extension(data, i, i + p, n - i - p)
            known[p] = b, e
            if e - b >= max(least_words, least_exponent * p):
                found.add((b, e - b, p))
    return found


def runs_of_words(words: list[bytes], least_words: int = 6, least_exponent: int = 4) -> list[Run]:
    """All runs by start, then period; ``least_exponent`` is 2 or more."""
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int32)
    cuts = stretches(ids, least_words, window(least_words, least_exponent))
    return sorted(((b + s, length, p) for b, e in cuts for s, length, p in runs_of(ids[b:e], least_words, least_exponent)), key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]


def find_runs(df: DataFrame, text: str = "text", least_words: int = 6, least_exponent: int = 4) -> DataFrame:
    """``df`` with ``n_words``, ``runs`` (start and length in words, period; by
    start, then period) of at least ``least_words`` words and ``least_exponent``
    periods, and ``collapsed``: the words that are left, joined by one space."""
    made = [T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())]
    kept = [f for f in df.schema.fields if f.name.lower() not in {m.name for m in made}]
    plain = df.select(*(f"`{f.name}`" for f in kept), *([] if any(f.name == text for f in kept) else [f"`{text}`"]))
    at = next(i for i, name in enumerate(plain.columns) if name == text)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, runs, left = [], [], []
        for data in utf8(batch.column(at)):
            words = data.split()
            own = runs_of_words(words, least_words, least_exponent)
            counts.append(len(words))
            runs.append([{"start": s, "length": n, "period": p} for s, n, p in own])
            left.append(b" ".join(collapse(words, own)))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        return pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], pa.array(counts, pa.int64()), pa.array(runs, kind), pa.array(left, pa.binary()).cast(pa.string())],
                                          [*batch.schema.names[:len(kept)], *(m.name for m in made)])

    return plain.mapInArrow(by_batch(run), T.StructType([*kept, *made]))
