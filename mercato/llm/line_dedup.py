"""Lines that many documents share, found with two Bloom filters.

A line's key is the line without the white space ``[\\x20\\x09-\\x0D]`` at both
ends, with A-Z lowered; keys below ``shortest`` code points are left alone.

1. Every task enters the keys of its documents into a pair of filters: *once*
   holds every key, *twice* every key that *once* held already. Two tasks'
   pairs meet bit by bit: ``once = a | b`` and ``twice = ta | tb | (a & b)``, so
   a key that both have seen has all its bits in *twice*: none is missed. The
   bits travel in compressed segments, merged one row at a time.
2. Only keys that *twice* holds are suspects. Each task reduces its suspects to
   the key's bytes and its ``least`` largest document ids; these few rows are
   shuffled, and merged as a sorted stream: a key is confirmed if ``least``
   different ids are left, the largest one keeps its lines. Nothing is counted
   by hash: a digest that two different keys share is noticed here (all lines
   of one digest are suspects together) and the work begins again with another
   seed.
3. Documents drop the confirmed lines. Up to ``most_broadcast`` confirmed
   digests are broadcast; more meet the documents' suspects by a join.

The filters take at most ``most_bits`` bits each, whatever the input, and that
is what a worker holds and what is broadcast. Beyond about ``most_bits / 4``
lines more and more keys are suspects by chance: the shuffle of step 2 then
nears all long lines, and results stay the same.

Defined results: null or empty text -> one empty line, kept as an empty text;
rows that share a doc_id are one document (a null id is a document of its own,
smaller than all others), so repeated rows count once and are cut alike; a line
that a document has twice goes or stays twice; an empty table gives an empty
one; columns named like a result (in any case) are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import partial
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.llm.common import by_batch, free_name, written

BLANKS = " \t\n\v\f\r"
HASHES = 3  #: bits a key sets in a filter
BITS_PER_LINE = 8
SEGMENTS = 256  #: pieces in which a filter travels
MOST_BITS = 1 << 29
MOST_BROADCAST = 500_000
HELD_KEYS, HELD_BYTES = 100_000, 32 << 20  #: suspects that a task gathers before it hands them on
NULL_ID = float("-inf")  #: a null id orders before all others


Hashed = Callable[[bytes], bytes]  #: key -> 16 bytes


def line_keys(texts: pa.Array, shortest: int, hashed: Hashed) -> tuple[list[list[str]], np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """The lines of each text; of the long ones row, number in the row, digest
    (two uint64 a line) and key."""
    lists = pc.split_pattern(pc.coalesce(texts.cast(pa.string()), pa.scalar("")), "\n")
    lines = lists.flatten()
    keys = pc.ascii_lower(pc.ascii_trim(lines, characters=BLANKS))
    long = np.flatnonzero(np.asarray(pc.greater_equal(pc.utf8_length(keys), shortest)))
    counts = np.asarray(pc.list_value_length(lists), np.int64)
    row = np.repeat(np.arange(len(counts)), counts)
    number = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    held = keys.take(pa.array(long)).cast(pa.binary()).to_pylist()
    digests = np.frombuffer(b"".join([hashed(k) for k in held]), ">u8").astype(np.uint64).reshape(-1, 2)
    return lists, row[long], number[long], digests, held


def places(digests: np.ndarray, bits: int) -> np.ndarray:
    """The ``HASHES`` places of every digest in a filter of ``bits`` (a power of two)."""
    step = digests[:, 1:] | np.uint64(1)
    return ((digests[:, :1] + np.arange(HASHES, dtype=np.uint64) * step) & np.uint64(bits - 1)).astype(np.int64)


def holds(filter_bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((filter_bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(1)


def enter(filter_bits: np.ndarray, at: np.ndarray) -> None:
    np.bitwise_or.at(filter_bits, at.ravel() >> 3, (1 << (at.ravel() & 7)).astype(np.uint8))


def add(once: np.ndarray, twice: np.ndarray, row: np.ndarray, digests: np.ndarray) -> None:
    """Enter the keys of some documents; a key counts once a document."""
    if not len(row):
        return
    own = np.unique(np.column_stack([digests, row.astype(np.uint64)]), axis=0)
    keys, count = np.unique(own[:, :2], axis=0, return_counts=True)
    at = places(keys, 8 * len(once))
    enter(twice, at[(count > 1) | holds(once, at)])
    enter(once, at)


def filter_size(docs: DataFrame, text: str, shortest: int, most_bits: int) -> int:
    """Bits of a filter: a power of two, ``BITS_PER_LINE`` for every line that
    can be long enough, ``most_bits`` at most."""
    size = F.octet_length(F.coalesce(F.col(text), F.lit("")))
    lines = F.least(size - F.octet_length(F.replace(F.coalesce(F.col(text), F.lit("")), F.lit("\n"), F.lit(""))) + 1, F.floor(size / max(1, shortest)) + 1)
    most = docs.agg(F.sum(lines.cast("long"))).first()[0] or 0
    return min(most_bits, 1 << max(13, int(most * BITS_PER_LINE - 1).bit_length()))


def seen_twice(docs: DataFrame, text: str, shortest: int, bits: int, hashed: Hashed) -> np.ndarray:
    """The filter of all keys that two documents or more may hold."""
    width = bits // 8 // SEGMENTS

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            _, row, _, digests, _ = line_keys(batch.column(0), shortest, hashed)
            add(once, twice, row, digests)
        for i in range(SEGMENTS):
            part = slice(i * width, (i + 1) * width)
            if once[part].any():
                yield pa.RecordBatch.from_pydict({"segment": pa.array([i], pa.int32()), "once": pa.array([zlib.compress(once[part], 1)], pa.binary()),
                                                  "twice": pa.array([zlib.compress(twice[part], 1)], pa.binary())})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for segment, group in groupby(rows, key=lambda row: row[0]):
            once, twice = np.zeros(width, np.uint8), np.zeros(width, np.uint8)
            for _, a, b in group:
                a = np.frombuffer(zlib.decompress(a), np.uint8)
                twice |= np.frombuffer(zlib.decompress(b), np.uint8) | (once & a)
                once |= a
            yield pa.RecordBatch.from_pydict({"segment": pa.array([segment], pa.int32()), "twice": pa.array([zlib.compress(twice, 1)], pa.binary())})

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = docs.select(text).mapInArrow(build, "segment int, once binary, twice binary")
    merged = pairs.repartition(parts, "segment").sortWithinPartitions("segment").mapInArrow(merge, "segment int, twice binary")
    out = np.zeros(bits // 8, np.uint8)
    for r in merged.toLocalIterator():
        out[r.segment * width:(r.segment + 1) * width] = np.frombuffer(zlib.decompress(bytes(r.twice)), np.uint8)
    return out


def largest(ids: list, more, least: int) -> list:
    """The ``least`` largest different ids of both, in falling order."""
    return sorted({*ids, *more}, reverse=True)[:least]


def confirm(docs: DataFrame, doc_id: str, text: str, suspect, shortest: int, least: int, hashed: Hashed) -> DataFrame:
    """(hi, lo, keeper, clash): the digests of the keys that ``least``
    documents hold and the largest id of these; ``clash`` if two keys share one."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            both = np.frombuffer(b"".join([hashed(k) for k in held]), ">u8").astype(np.int64).reshape(-1, 2)
            ids = [[None if x == NULL_ID else x for x in v] for v in held.values()]
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(list(held), pa.binary()), pa.array(ids, pa.list_(pa.int64()))],
                                              ["hi", "lo", "key", "ids"])

        for batch in batches:
            names = [NULL_ID if x is None else x for x in batch.column(0).to_pylist()]
            _, row, _, digests, keys = line_keys(batch.column(1), shortest, hashed)
            for i in np.flatnonzero(holds(suspect.value, places(digests, 8 * len(suspect.value)))).tolist():
                key, own = keys[i], names[row[i]]
                ids = held.get(key)
                if ids is None:
                    held[key] = [own]
                    size += len(key)
                elif own not in ids:
                    held[key] = largest(ids, [own], least)
            if len(held) >= HELD_KEYS or size >= HELD_BYTES:
                yield flush()
                held, size = {}, 0
        if held:
            yield flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for (hi, lo), same in groupby(rows, key=lambda row: row[:2]):
            found = []
            for _, group in groupby(same, key=lambda row: row[2]):
                ids: list = []
                for *_, more in group:
                    ids = largest(ids, (NULL_ID if x is None else x for x in more), least)
                found.append(ids)
            if len(found) > 1 or len(found[0]) >= least:
                keeper = found[0][0]
                yield pa.RecordBatch.from_pydict({"hi": pa.array([hi], pa.int64()), "lo": pa.array([lo], pa.int64()),
                                                  "keeper": pa.array([None if keeper == NULL_ID else keeper], pa.int64()), "clash": pa.array([len(found) > 1])})

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    few = docs.select(F.col(doc_id).cast("long"), text).mapInArrow(gather, "hi long, lo long, key binary, ids array<long>")
    return written(few.repartition(parts, "hi", "lo").sortWithinPartitions("hi", "lo", "key").mapInArrow(merge, "hi long, lo long, keeper long, clash boolean"), "repeated-lines")


def drop_repeated_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shortest: int = 40, least: int = 5,
                        most_bits: int = MOST_BITS, most_broadcast: int = MOST_BROADCAST, digest: Callable[..., bytes] = xxhash.xxh3_128_digest) -> DataFrame:
    """``df`` with ``kept`` (the text without the repeated lines), ``n_lines``
    (before) and ``dropped`` (the numbers of the lines that went, from 0).

    ``least`` must be 2 or more, as the filters tell one document from two.
    ``digest`` maps bytes and a ``seed`` to 16 bytes."""
    spark = df.sparkSession
    bits = filter_size(df, text, shortest, most_bits)
    seed = 0
    while True:
        hashed = partial(digest, seed=seed)
        twice = spark.sparkContext.broadcast(seen_twice(df, text, shortest, bits, hashed))
        confirmed = confirm(df, doc_id, text, twice, shortest, least, hashed)
        if confirmed.where("clash").isEmpty():
            break
        seed += 1
    if confirmed.count() <= most_broadcast:
        found = confirmed.select("hi", "lo", "keeper").toArrow()
        order = np.lexsort((np.asarray(found["lo"]), np.asarray(found["hi"])))
        table = spark.sparkContext.broadcast([np.column_stack([np.asarray(found["hi"]), np.asarray(found["lo"])])[order],
                                              [NULL_ID if x is None else x for x in found["keeper"].to_pylist()], order])
        return cut(df.withColumn(free_name(df, "_lines"), F.lit(None).cast("array<struct<hi:long,lo:long>>")), doc_id, text, shortest, hashed, lambda: Listed(*table.value), twice)
    return cut(with_lists(df, confirmed, doc_id, text, shortest, hashed, twice), doc_id, text, shortest, hashed, None, None)


class Listed:
    """Confirmed digests, sorted, and who keeps each."""

    def __init__(self, digests: np.ndarray, keepers: list, order: np.ndarray):
        self.digests, self.keepers = digests, [keepers[i] for i in order]

    def lost(self, digests: np.ndarray, owners: list) -> np.ndarray:
        out = np.zeros(len(digests), bool)
        low = np.searchsorted(self.digests[:, 0], digests[:, 0])
        for i in np.flatnonzero(low < len(self.digests)).tolist():
            at, (hi, lo) = int(low[i]), digests[i]
            while at < len(self.digests) and self.digests[at, 0] == hi:
                if self.digests[at, 1] == lo:
                    out[i] = self.keepers[at] != owners[i]
                at += 1
        return out


def with_lists(df: DataFrame, confirmed: DataFrame, doc_id: str, text: str, shortest: int, hashed: Hashed, suspect) -> DataFrame:
    """``df`` with the digests of the lines that each row loses, by a join of
    its suspects. Rows are known by two 64-bit hashes of id and text; equal
    rows lose the same."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        _, row, _, digests, _ = line_keys(batch.column(3), shortest, hashed)
        hit = np.flatnonzero(holds(suspect.value, places(digests, 8 * len(suspect.value))))
        at, both = pa.array(row[hit]), digests[hit].view(np.int64)
        return pa.RecordBatch.from_arrays([*(batch.column(i).take(at) for i in range(3)), pa.array(both[:, 0]), pa.array(both[:, 1])], ["k1", "k2", "own", "hi", "lo"])

    keys = [F.xxhash64(doc_id, text), F.xxhash64(text, doc_id, F.lit(1))]
    names = [free_name(df, n) for n in ("_k1", "_k2", "_lines")]
    plain = df.select(*(k.alias(n) for k, n in zip(keys, ("k1", "k2"), strict=True)), F.col(doc_id).cast("long").alias("own"), F.col(text).alias("text"))
    occurrences = plain.mapInArrow(by_batch(run), "k1 long, k2 long, own long, hi long, lo long")
    lost = occurrences.join(confirmed, ["hi", "lo"]).where(~F.col("own").eqNullSafe(F.col("keeper")))
    lists = lost.groupBy(F.col("k1").alias(names[0]), F.col("k2").alias(names[1])).agg(F.collect_set(F.struct("hi", "lo")).alias(names[2]))
    return df.withColumns(dict(zip(names[:2], keys, strict=True))).join(lists, names[:2], "left").drop(*names[:2])


def cut(df: DataFrame, doc_id: str, text: str, shortest: int, hashed: Hashed, listed: Callable[[], Listed] | None, suspect) -> DataFrame:
    """Apply the decisions; the last column of ``df`` lists digests unless ``listed`` has them all."""
    lists = df.columns[-1]
    made = T.StructType([T.StructField("kept", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("dropped", T.ArrayType(T.LongType()))])
    kept = [f for f in df.schema.fields[:-1] if f.name.lower() not in {m.name for m in made}]
    wide = df.select(*(f"`{f.name}`" for f in kept), F.col(doc_id).cast("long").alias(free_name(df, "own")), F.col(text).alias(free_name(df, "source")), F.col(lists).alias(free_name(df, "lost")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = listed() if listed else None
        for batch in batches:
            n = len(kept)
            texts = pc.coalesce(batch.column(n + 1).cast(pa.string()), pa.scalar(""))
            lines, row, number, digests, _ = line_keys(texts, shortest, hashed)
            if known:
                near = np.flatnonzero(holds(suspect.value, places(digests, 8 * len(suspect.value))))
                own = [NULL_ID if x is None else x for x in batch.column(n).to_pylist()]
                gone = near[known.lost(digests[near].view(np.int64), [own[i] for i in row[near].tolist()])]
            else:
                lost = [{(x["hi"], x["lo"]) for x in v or ()} for v in batch.column(n + 2).to_pylist()]
                pairs = digests.view(np.int64).tolist()
                gone = np.array([i for i, (r, p) in enumerate(zip(row.tolist(), pairs, strict=True)) if lost[r] and tuple(p) in lost[r]], np.int64)
            dropped: list[list[int]] = [[] for _ in range(batch.num_rows)]
            for r, i in zip(row[gone].tolist(), number[gone].tolist(), strict=True):
                dropped[r].append(i)
            left = texts.to_pylist()
            for r, out in enumerate(dropped):
                if out:
                    out_set = set(out)
                    left[r] = "\n".join(x for i, x in enumerate(lines[r].as_py()) if i not in out_set)
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(left, pa.string()), pc.list_value_length(lines).cast(pa.int64()), pa.array(dropped, pa.list_(pa.int64()))],
                                             [*batch.schema.names[:n], *(m.name for m in made)])

    return wide.mapInArrow(run, T.StructType([*kept, *made.fields]))
