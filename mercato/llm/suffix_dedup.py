"""Removal of repeated byte strings by hash-compared suffix sorting.

A byte goes if some ``length``-byte string that covers it starts anywhere else
in the corpus too. Strings never cross documents and are judged on the input.

1. Anchors. Every ``length``-byte window has an anchor: of the ``GRAM``-byte
   grams inside it, the one with the smallest hash (ties: the first). Equal
   windows have equal anchors at equal offsets, so a string can only repeat
   between occurrences of one anchor. There is about one anchor for 85 bytes.
2. Anchors that occur once are dropped by a count (combined before the
   shuffle). Where all occurrences of an anchor have the same *context* (all
   windows that it anchors), every one of those windows repeats.
3. The other occurrences meet by anchor, with their contexts' bytes. Prefix
   polynomial hashes give the common extension of two suffixes by binary
   search, so a comparison takes a logarithmic number of steps; a mergesort
   with these comparisons sorts the suffixes that start at the anchors, and
   another one the reversed prefixes that end there. Neighbours give the
   longest extension either way, which bounds the windows that can repeat, and
   the pairs of neighbours prove most of them. What is left between proof and
   bound is settled by sorting those windows' hashes. Every match is verified
   on the bytes; a group with a false one is done again on bytes alone.
4. Anchors with more than ``HOT`` occurrences and unlike contexts never meet in
   one task: each of their windows is counted by a 128-bit digest instead,
   which Spark combines before the shuffle.
5. The spans go back to their documents.

Defined results: null or empty text -> nothing to remove; texts under
``length`` bytes stay; repeated rows are documents of their own (so they repeat
each other); null doc_ids are kept; an empty table gives an empty one; columns
other than the named ones are passed through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.llm.common import by_batch, row_key, utf8, written

#: Bytes of the grams whose hashes choose anchors.
GRAM = 32

#: Occurrences of one anchor that a task sorts at most.
HOT = 20_000

#: Bytes of text hashed at once, few enough that the arrays over them stay in a
#: core's cache; longer texts are hashed in overlapping pieces.
BUFFER_BITS = 17
PIECE = 1 << 16

#: Contexts sorted at once (groups are never cut).
CHUNK = 4096

#: Bytes compared at once when matches are verified.
COMPARED = 500_000

BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64, for i up to ``size`` at least."""
    if not _POWERS or len(_POWERS[0]) <= size:
        made = []
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            table = np.full((1 << max(BUFFER_BITS, size.bit_length())) + 1, base, np.uint64)
            table[0] = 1
            made.append(np.multiply.accumulate(table))
        _POWERS[:] = made
    return _POWERS[0], _POWERS[1]


def buffer_bits(length: int) -> int:
    """A buffer has room for one piece at least."""
    return max(BUFFER_BITS, (PIECE + length).bit_length())


class Hashes:
    """Polynomial hashes of every substring of a buffer in constant time.
    ``place``: where each byte is in its own string, if the buffer holds
    several; substrings lie within one."""

    def __init__(self, data: np.ndarray, place: np.ndarray | None = None):
        up, self.down = powers(len(data) if place is None else int(place.max(initial=0)))
        self.place = place
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * (up[:len(data)] if place is None else up[place[:-1]]), out=self.prefix[1:])

    def of(self, start, size):
        return (self.prefix[start + size] - self.prefix[start]) * self.down[start if self.place is None else self.place[start]]


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours (block-wise prefix and suffix minima)."""
    padded = np.concatenate([values, np.full(-len(values) % width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, 1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:len(values) - width + 1], ahead[width - 1:len(values)])


def pieces(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Buffers of (row, offset, bytes); pieces of one text share length - 1 bytes."""
    held, size, most = [], 0, 1 << buffer_bits(length)
    for row, text in enumerate(texts):
        for at in range(0, len(text) - length + 1, PIECE):
            part = text[at:at + PIECE + length - 1]
            if held and size + len(part) >= most:
                yield held
                held, size = [], 0
            held.append((row, at, part))
            size += len(part)
    if held:
        yield held


def anchors(texts: list[bytes], length: int) -> dict[str, np.ndarray]:
    """row, pos (in the text), before/after (offset of the anchor in its first
    and last window), a (hash of the gram), c (hash of the context)."""
    out: dict[str, list[np.ndarray]] = {k: [] for k in ("row", "pos", "first", "last", "a", "c")}
    width = length - GRAM + 1
    for buffer in pieces(texts, length):
        data = np.frombuffer(b"".join(x[2] for x in buffer), np.uint8)
        sizes = np.array([len(x[2]) for x in buffer])
        starts = np.cumsum(sizes) - sizes
        hashes = Hashes(data)
        grams = mixed((hashes.prefix[GRAM:] - hashes.prefix[:-GRAM]) * hashes.down[:len(data) - GRAM + 1])
        low = np.uint64((1 << buffer_bits(length)) - 1)
        keys = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        least = (sliding_least(keys, width) & low).astype(np.int64)  # anchor of the window at each start
        inside = np.ones(len(least), bool)
        for end in (starts + sizes)[:-1]:
            inside[end - length + 1:end] = False
        windows = np.flatnonzero(inside)
        at = least[windows]
        new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (windows[1:] != windows[:-1] + 1)]))
        last = np.concatenate([new[1:], [len(at)]]) - 1
        pos, lo, hi = at[new], windows[new], windows[last]
        piece = np.searchsorted(starts, lo, "right") - 1
        out["row"].append(np.array([x[0] for x in buffer])[piece])
        out["pos"].append(pos - starts[piece] + np.array([x[1] for x in buffer])[piece])
        out["first"].append(pos - lo)
        out["last"].append(pos - hi)
        out["a"].append(grams[pos])
        out["c"].append(mixed(hashes.of(lo, hi - lo + length) + ((pos - lo) * 1009 + hi - lo).astype(np.uint64) * np.uint64(0x94D049BB133111EB)))
    return {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in out.items()}


def suffix_order(first: np.ndarray, size: np.ndarray, less) -> np.ndarray:
    """Mergesort inside groups, all groups and runs of a level at once: an
    element's place in the merged run is its place in its own run plus its
    rank in the sibling run, found by binary search. ``first`` and ``size``:
    start and size of the group at each place."""
    order, width, most = np.arange(len(first)), 1, size.max(initial=0)
    while width < most:
        place = np.flatnonzero(size > width)
        group, end = first[place], first[place] + size[place]
        run = (place - group) // width
        lo = np.minimum(group + (run ^ 1) * width, end)
        hi, base, x = np.minimum(lo + width, end), lo.copy(), order[place]
        while len(undone := np.flatnonzero(lo < hi)):
            mid = (lo[undone] + hi[undone]) // 2
            smaller = less(order[mid], x[undone])
            lo[undone] = np.where(smaller, mid + 1, lo[undone])
            hi[undone] = np.where(smaller, hi[undone], mid)
        merged = order.copy()
        merged[group + (run & ~1) * width + (place - group) % width + lo - base] = x
        order, width = merged, width * 2
    return order


def distinct(rows: np.ndarray) -> np.ndarray:
    """The distinct rows in order (``np.unique`` sorts rows as raw bytes, many
    times slower than by their columns)."""
    if not len(rows):
        return rows
    rows = rows[np.lexsort(rows.T[::-1])]
    return rows[np.concatenate([[True], (rows[1:] != rows[:-1]).any(1)])]


class Contexts:
    """Contexts of a few anchors, side by side. ``group`` is non-decreasing."""

    def __init__(self, group: np.ndarray, anchor: np.ndarray, contexts: list[bytes], length: int):
        self.contexts, self.length, self.group = contexts, length, group
        self.size = np.array([len(c) for c in contexts], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(contexts), np.uint8)
        place = np.zeros(len(self.data) + 1, np.int32)
        place[:-1] = np.arange(len(self.data)) - np.repeat(self.start, self.size)
        self.hashes = Hashes(self.data, place)
        self.at, self.left, self.right = self.start + anchor, anchor, self.size - anchor
        self.before, self.scale = self.hashes.prefix[self.at], self.hashes.down[anchor]
        new = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        counts = np.diff(np.concatenate([new, [len(group)]]))
        self.first, self.count = np.repeat(new, counts), np.repeat(counts, counts)

    def extension(self, i: np.ndarray, j: np.ndarray, back: bool) -> np.ndarray:
        """Common bytes of contexts i and j from the anchor on, or before it.
        Many agree as far as they go. For the others, hashes of strings that
        start or end at the anchors are compared as if they started there: both
        differ from ``Hashes.of`` by one odd factor, so they are equal alike."""
        side = self.left if back else self.right
        out = np.minimum(side[i], side[j])
        shift = out if back else 0
        less = np.flatnonzero(self.hashes.of(self.at[i] - shift, out) != self.hashes.of(self.at[j] - shift, out))
        i, j, prefix = i[less], j[less], self.hashes.prefix
        x, y, x0, y0, sx, sy = self.at[i], self.at[j], self.before[i], self.before[j], self.scale[i], self.scale[j]
        lo, hi = np.zeros(len(less), np.int64), out[less] - 1
        while (lo < hi).any():
            mid = (lo + hi + 1) >> 1
            step = -mid if back else mid
            same = (prefix[x + step] - x0) * sx == (prefix[y + step] - y0) * sy
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        out[less] = lo
        return out

    def less(self, back: bool):
        side = self.left if back else self.right

        def compare(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            e = self.extension(i, j, back)
            ended = (e == side[i]) | (e == side[j])
            step = -e - 1 if back else e
            top = len(self.data) - 1
            x, y = self.data[np.clip(self.at[i] + step, 0, top)], self.data[np.clip(self.at[j] + step, 0, top)]
            tie = np.where(side[i] != side[j], side[i] < side[j], i < j)
            return np.where(ended, tie, x < y)

        return compare

    def same_bytes(self, x: np.ndarray, y: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether data[x:x+size] and data[y:y+size] are equal (sizes above 0)."""
        out = np.zeros(len(x), bool)
        for part in np.array_split(np.arange(len(x)), int(size.sum()) // COMPARED + 1) if len(x) else []:
            if len(part):
                many, a, b = size[part], x[part], y[part]
                begin = np.cumsum(many) - many
                step = np.arange(many.sum()) - np.repeat(begin, many)
                out[part] = np.logical_and.reduceat(self.data[np.repeat(a, many) + step] == self.data[np.repeat(b, many) + step], begin)
        return out

    def repeated(self) -> np.ndarray:
        """(context, from, to) rows whose union is every byte that a repeated
        window covers."""
        n, length = len(self.size), self.length
        pairs, most = [], {}
        for back in (False, True):
            order = suffix_order(self.first, self.count, self.less(back))
            t = np.flatnonzero(self.first[1:] == self.first[:-1])
            i, j = order[t], order[t + 1]
            reach = [self.extension(i, j, b) for b in (False, True)]
            most[back] = np.zeros(n, np.int64)
            np.maximum.at(most[back], i, reach[back])
            np.maximum.at(most[back], j, reach[back])
            pairs.append(np.stack([i, j, *reach]))
        i, j, right, left = np.concatenate(pairs, 1)
        full = right + left >= length
        i, j, right, left = (v[full] for v in (i, j, right, left))
        true = self.same_bytes(self.at[i] - left, self.at[j] - left, right + left)
        wrong = set(self.group[i[~true]].tolist())
        who, lo, hi = np.concatenate([i, j]), np.tile(length - right, 2), np.tile(left, 2)  # offsets of proven windows
        spans = [np.stack([who, self.left[who] - hi, self.left[who] - lo + length], 1)]
        # between what neighbours prove and what they allow
        least, top = length - most[False], most[True]
        proven = np.zeros(n, bool)
        proven[who[(lo <= least[who]) & (hi >= top[who])]] = True
        for part in np.array_split(open_ := np.flatnonzero((least <= top) & ~proven), max(1, len(open_) // 4096)):
            offsets = np.arange(length + 1)
            left_open = (offsets >= least[part][:, None]) & (offsets <= top[part][:, None])
            index = np.full(n, -1)
            index[part] = np.arange(len(part))
            for w, a, b in zip(*(v[index[who] >= 0] for v in (who, lo, hi)), strict=True):
                left_open[index[w], a:b + 1] = False
            row, offset = np.nonzero(left_open)
            wanted = distinct(np.stack([self.first[part[row]], offset], 1))
            for piece in np.array_split(wanted, max(1, int(self.count[wanted[:, 0]].sum()) // 200_000)) if len(wanted) else []:
                found, bad = self.equal_windows(piece)
                spans.append(found)
                wrong |= bad
        out = np.concatenate(spans)
        if wrong:
            again = np.isin(self.group, list(wrong))
            out = np.concatenate([out[~again[out[:, 0]]], self.by_bytes(np.flatnonzero(again))])
        return distinct(out)

    def equal_windows(self, wanted: np.ndarray) -> tuple[np.ndarray, set]:
        """Repeated windows among (group start, offset) pairs, and the groups
        in which equal hashes had unequal bytes."""
        counts = self.count[wanted[:, 0]]
        member = np.repeat(wanted[:, 0], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        which, offset = np.repeat(np.arange(len(wanted)), counts), np.repeat(wanted[:, 1], counts)
        valid = (offset <= self.left[member]) & (self.length - offset <= self.right[member])
        member, which, offset = member[valid], which[valid], offset[valid]
        begin = self.at[member] - offset
        key = self.hashes.of(begin, self.length)
        order = np.lexsort((key, which))
        equal = np.flatnonzero((key[order[1:]] == key[order[:-1]]) & (which[order[1:]] == which[order[:-1]]))
        x, y = order[equal], order[equal + 1]
        true = self.same_bytes(begin[x], begin[y], np.full(len(x), self.length))
        hit = np.unique(np.concatenate([x, y]))
        start = begin[hit] - self.start[member[hit]]
        return np.stack([member[hit], start, start + self.length], 1), set(self.group[member[x[~true]]].tolist())

    def by_bytes(self, members: np.ndarray) -> np.ndarray:
        seen: dict[tuple, list] = {}
        for m in members.tolist():
            for s in range(int(self.size[m]) - self.length + 1):
                seen.setdefault((self.group[m], self.contexts[m][s:s + self.length]), []).append((m, s, s + self.length))
        return np.array([x for found in seen.values() if len(found) > 1 for x in found], np.int64).reshape(-1, 3)


ANCHORS = "rid long, pos long, first int, last int, a long, c long"
CONTEXTS = "a long, rid long, begin long, anchor int, context binary"
SPANS = "rid long, begin long, end long"


def find_anchors(rows: DataFrame, length: int) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rid, found = batch.column(0).to_numpy(), anchors(utf8(batch.column(1)), length)
        return pa.RecordBatch.from_arrays(
            [pa.array(rid[found["row"].astype(np.int64)]), pa.array(found["pos"]), pa.array(found["first"].astype(np.int32)), pa.array(found["last"].astype(np.int32)),
             pa.array(found["a"].view(np.int64)), pa.array(found["c"].view(np.int64))], ["rid", "pos", "first", "last", "a", "c"])

    return rows.select("rid", "text").mapInArrow(by_batch(run), ANCHORS)


def cut_contexts(rows: DataFrame, occurrences: DataFrame, length: int) -> DataFrame:
    """The bytes of all windows of each occurrence."""
    lists = occurrences.groupBy("rid").agg(F.collect_set(F.struct("pos", "first", "last", "a")).alias("at"))
    joined = rows.join(lists.hint("shuffle_hash"), "rid").select(*rows.columns, "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            names = batch.schema.names
            for rid, text, at in zip(batch.column(names.index("rid")).to_pylist(), utf8(batch.column(names.index("text"))), batch.column(names.index("at")).to_pylist(), strict=True):
                made += [(x["a"], rid, x["pos"] - x["first"], x["first"], text[x["pos"] - x["first"]:x["pos"] - x["last"] + length]) for x in at]
                if len(made) > 4096:
                    yield rows_batch(made, kinds)
                    made = []
            if made:
                yield rows_batch(made, kinds)

    kinds = pa.schema([("a", pa.int64()), ("rid", pa.int64()), ("begin", pa.int64()), ("anchor", pa.int32()), ("context", pa.binary())])
    return joined.mapInArrow(run, CONTEXTS)


def rows_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def sorted_spans(contexts: DataFrame, length: int) -> DataFrame:
    """Spans from suffix-sorting the contexts of each anchor."""

    def spans(held: list[tuple]) -> pa.RecordBatch:
        a, rid, begin, anchor, data = zip(*held, strict=True)
        found = Contexts(np.array(a), np.array(anchor, np.int64), list(data), length).repeated()
        rid, begin = np.array(rid), np.array(begin)
        return pa.RecordBatch.from_arrays([pa.array(rid[found[:, 0]]), pa.array(begin[found[:, 0]] + found[:, 1]), pa.array(begin[found[:, 0]] + found[:, 2])], ["rid", "begin", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if len(held) >= CHUNK and held[-1][0] != row[0]:
                    yield spans(held)
                    held = []
                held.append(row)
        if held:
            yield spans(held)

    parts = int(contexts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return contexts.repartition(parts, "a").sortWithinPartitions("a").mapInArrow(run, SPANS)


def counted_spans(contexts: DataFrame, length: int) -> DataFrame:
    """The same by counting windows, for anchors too frequent to be sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rid, begin, data in zip(*(batch.column(i).to_pylist() for i in (1, 2, 4)), strict=True):
                n = len(data) - length + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([hashlib.blake2b(data[i:i + length], digest_size=16).digest() for i in range(n)], pa.binary()),
                     pa.array([rid] * n, pa.int64()), pa.array(range(begin, begin + n), pa.int64())], ["digest", "rid", "begin"])

    windows = contexts.mapInArrow(run, "digest binary, rid long, begin long")
    twice = windows.groupBy("digest").count().where("count > 1").select("digest")
    return windows.join(twice, "digest").select("rid", "begin", (F.col("begin") + length).alias("end"))


def remove_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 200, hot: int = HOT, as_text: bool = False) -> DataFrame:
    """``df`` (text as ``_text``; null: empty) with ``kept`` (the remaining
    bytes) and ``removed`` (maximal removed runs, [begin, end) in bytes). With
    ``as_text``, ``kept`` is a string without the characters that a run cuts."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    others = [c for c in df.columns if c.lower() not in (text.lower(), "rid", "text", "_text", "kept", "removed", "at")]
    plain = df.select(row_key(doc_id, text).alias("rid"), F.coalesce(F.col(text), F.lit("")).alias("text"), *(f"`{c}`" for c in others))
    found = find_anchors(plain, length)
    # written, so that both sides of the join are plain exchanges and Spark may split a hot anchor
    twice = written(found.groupBy("a").agg(F.count("*").alias("n"), F.min("c").alias("least"), F.max("c").alias("most")).where("n > 1"), "repeated")
    occurrences = written(found.join(twice, "a").select("rid", "pos", "first", "last", "a", (F.col("least") != F.col("most")).alias("unlike"), "n"), "anchors")
    rows = plain.repartition(parts, "rid")
    alike = occurrences.where("NOT unlike").select("rid", (F.col("pos") - F.col("first")).alias("begin"), (F.col("pos") - F.col("last") + length).alias("end"))
    spans = alike.union(sorted_spans(cut_contexts(rows, occurrences.where(f"unlike AND n <= {hot}"), length), length))
    if not occurrences.where(f"unlike AND n > {hot}").isEmpty():
        spans = spans.union(counted_spans(cut_contexts(rows, occurrences.where(f"unlike AND n > {hot}"), length), length))
    lists = spans.groupBy("rid").agg(F.collect_set(F.struct("begin", "end")).alias("at"))
    out = T.StructType([plain.schema[c] for c in others] + [
        T.StructField("_text", T.StringType()), T.StructField("kept", T.StringType() if as_text else T.BinaryType()),
        T.StructField("removed", T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())])))])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        kept, removed = [], []
        for data, at in zip(utf8(column["text"]), column["at"].to_pylist(), strict=True):
            runs = merge((x["begin"], x["end"]) for x in at or [])
            removed.append([{"begin": b, "end": e} for b, e in runs])
            edges = [0, *(x for r in runs for x in r), len(data)]
            kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        return pa.RecordBatch.from_arrays([*(column[c] for c in others), column["text"], pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()) if as_text else pa.array(kept, pa.binary()), pa.array(removed, kind)], [*others, "_text", "kept", "removed"])

    return rows.join(lists.hint("shuffle_hash"), "rid", "left").select(*rows.columns, "at").mapInArrow(by_batch(run), out)


def merge(spans) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching spans, in order."""
    out: list[list[int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [(b, e) for b, e in out]
