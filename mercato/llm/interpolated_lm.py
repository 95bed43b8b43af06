"""Bigram language model with deleted interpolation, for scoring whole texts.

    p(w | v) = L2(b) c(v,w)/c(v) + L1(b) c(w)/N + L0(b)/(V+1),   b = bucket of c(v)

Maximum-likelihood estimates come from the learning documents; the weights of
each context-frequency bucket (powers of two of c(v)) are found by expectation
maximisation on counts held out from them: a share of the learning documents
(``HELD``) is scored by the counts of the rest. The final estimates use all
learning documents.

Nothing of the corpus' size is broadcast or collected. Texts are packed into
blocks (word hashes and local word numbers). A block sends its distinct
n-grams once, as sorted 64-bit hashes cut into key ranges; each range sums the
counts of all blocks and answers every block in the order it was asked. A
block plus its answers scores its own documents. Only the weights' statistics
(counts per bucket and rounded probabilities, a table of bounded size) and a
few totals reach the driver.

Defined results: null or empty text is the end token alone; null ids count as
the empty id; repeated rows are documents of their own; without learning
documents every word is unknown; an empty table gives an empty one; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import utf8, written

#: Tokens of a block, but for a last document that goes beyond.
BLOCK_TOKENS = 1_500_000

#: Of the learning documents' crc32 remainders (modulo 5), the held-out share.
MODULUS, SCORED, HELD = 5, 1, 4

#: Rounding of log2 probabilities in the statistics for the weights.
STEPS_PER_OCTAVE = 4
BUCKETS = 42

START, END = 0x5157A2, 0xE17D  # hashes of the two marks, apart from any word by their size
BLOCK = "block long, role int, doc_ids binary, doc_nulls binary, words binary, hashes binary, tokens binary"
ASKED = "piece int, block long, kind int, role int, size int, keys binary, counts binary"
ANSWER = "block long, piece int, kind int, size int, total binary, kept binary, n long, v long, kept_n long, kept_v long"
SCORES = "doc_id long, role int, n_tokens long, n_known long, base_score double, score double"


def planes(values: np.ndarray) -> bytes:
    """Unsigned integers byte by byte, lowest bytes first, which compresses well."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def unplaned(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel()


class Numbers(dict):
    """Local word numbers in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def pack(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Blocks of whole texts, apart by role: 0 learn, 1 learn the weights, 2 neither."""
    crc = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % MODULUS
    role = F.when(crc == SCORED, 2).when(crc == HELD, 1).otherwise(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        held = [[] for _ in range(3)]
        numbers = [Numbers() for _ in range(3)]
        size = [0] * 3

        def flush(r: int) -> pa.RecordBatch:
            nonlocal made
            ids, counts, tokens = zip(*held[r], strict=True)
            hashes = np.array([xxhash.xxh64_intdigest(w, 42) for w in numbers[r]], np.uint64)
            row = {"block": (part << 24) + made, "role": r, "doc_ids": np.array([x or 0 for x in ids], "<i8").tobytes(),
                   "doc_nulls": np.array([x is None for x in ids], np.uint8).tobytes(), "words": planes(np.array(counts, np.uint64)),
                   "hashes": hashes.tobytes(), "tokens": planes32(np.concatenate(tokens))}
            made, held[r], numbers[r], size[r] = made + 1, [], Numbers(), 0
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for key, r, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2)), strict=True):
                words = data.lower().split()
                held[r].append((key, len(words), np.fromiter(map(numbers[r].__getitem__, words), np.uint32, len(words))))
                size[r] += len(words) + 1
                if size[r] >= BLOCK_TOKENS:
                    yield flush(r)
        for r in range(3):
            if held[r]:
                yield flush(r)

    schema = pa.schema([("block", pa.int64()), ("role", pa.int32())] + [(c, pa.binary()) for c in ("doc_ids", "doc_nulls", "words", "hashes", "tokens")])
    rows = df.select(F.col(doc_id).cast("long").alias("_id"), role.cast("int").alias("_role"), F.col(text).alias("_text"))
    return written(rows.mapInArrow(run, BLOCK), "lm-blocks")


def planes32(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def unplaned32(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


class Block:
    """Distinct n-grams of a block in hash order, and where each token is among them."""

    def __init__(self, row: dict):
        counts = unplaned(row["words"]).astype(np.int64)
        words = unplaned32(row["tokens"]).astype(np.int64)
        hashes = np.concatenate([np.frombuffer(row["hashes"], "<u8"), np.array([END, START], np.uint64)])
        end, start, n = len(hashes) - 2, len(hashes) - 1, len(words) + len(counts)
        self.ends = np.cumsum(counts + 1) - 1  # places of the end tokens
        self.starts = self.ends - counts
        inner = np.ones(n, bool)
        inner[self.ends] = False
        self.next = np.full(n, end)
        self.next[inner] = words
        self.previous = np.empty(n, np.int64)
        self.previous[1:] = self.next[:-1]
        self.previous[self.starts] = start
        # single words; the start mark stands for the end mark's count (one per document)
        used = np.bincount(self.next, minlength=len(hashes))
        order = np.argsort(hashes[:-1], kind="stable")
        self.place = np.empty(len(hashes), np.int64)
        self.place[order] = np.arange(len(order))
        self.place[start] = self.place[end]
        pair, self.pair_at, pair_used = np.unique(self.previous * len(hashes) + self.next, return_inverse=True, return_counts=True)
        left, right = hashes[pair // len(hashes)], hashes[pair % len(hashes)]
        key = (left * np.uint64(0x9E3779B97F4A7C15)) ^ (left >> np.uint64(31))
        key = (key + right) * np.uint64(0xBF58476D1CE4E5B9)
        key ^= key >> np.uint64(32)
        key = (key + right) * np.uint64(0x94D049BB133111EB)
        key ^= key >> np.uint64(29)
        by_key = np.argsort(key, kind="stable")
        back = np.empty(len(key), np.int64)
        back[by_key] = np.arange(len(key))
        self.pair_at = back[self.pair_at]
        self.keys = [hashes[:-1][order], key[by_key]]
        self.used = [used[:-1][order], pair_used[by_key]]


def cuts(keys: np.ndarray, count: int) -> np.ndarray:
    """Where sorted 64-bit keys pass from one of ``count`` equal ranges to the next."""
    limits = np.array([(i << 64) // count for i in range(1, count)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, limits), [len(keys)]])


def ask(blocks: DataFrame, ranges: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                for kind in (0, 1):
                    keys, used, at = block.keys[kind], block.used[kind], cuts(block.keys[kind], ranges)
                    made = [{"piece": i, "block": row["block"], "kind": kind, "role": row["role"], "size": int(e - b),
                             "keys": planes(np.diff(keys[b:e], prepend=np.uint64(0))), "counts": planes32(used[b:e])}
                            for i, (b, e) in enumerate(zip(at, at[1:], strict=False)) if e > b]
                    yield pa.RecordBatch.from_pylist(made, schema)

    schema = pa.schema([("piece", pa.int32()), ("block", pa.int64()), ("kind", pa.int32()), ("role", pa.int32()), ("size", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
    return blocks.mapInArrow(run, ASKED)


def answer(asked: DataFrame) -> DataFrame:
    """Corpus counts of every key, to each block that asked for it."""
    schema = pa.schema([("block", pa.int64()), ("piece", pa.int32()), ("kind", pa.int32()), ("size", pa.int32()), ("total", pa.binary()), ("kept", pa.binary())]
                       + [(c, pa.int64()) for c in ("n", "v", "kept_n", "kept_v")])

    def sums(rows: list[dict]) -> pa.RecordBatch:
        keys, at = np.unique(np.concatenate([np.cumsum(unplaned(r["keys"]), dtype=np.uint64) for r in rows]), return_inverse=True)
        counts = np.concatenate([unplaned32(r["counts"]) for r in rows]).astype(np.float64)
        role = np.repeat([r["role"] for r in rows], [r["size"] for r in rows])
        total = np.bincount(at, counts * (role < 2), len(keys)).astype(np.uint64)
        kept = np.bincount(at, counts * (role == 0), len(keys)).astype(np.uint64)
        made, begin = [], 0
        for r in rows:
            mine = at[begin:begin + r["size"]]
            begin += r["size"]
            made.append({"block": r["block"], "piece": r["piece"], "kind": r["kind"], "size": r["size"], "total": planes(total[mine]), "kept": planes(kept[mine]) if r["role"] == 1 else b""})
        if rows[0]["kind"] == 0:
            made.append({"block": -1, "piece": rows[0]["piece"], "kind": 0, "size": 0, "total": b"", "kept": b"", "n": int(total.sum()), "v": int((total > 0).sum()),
                         "kept_n": int(kept.sum()), "kept_v": int((kept > 0).sum())})
        return pa.RecordBatch.from_pylist(made, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if rows and (rows[0]["kind"], rows[0]["piece"]) != (row["kind"], row["piece"]):
                    yield sums(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield sums(rows)

    parts = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(asked.repartition(parts, "kind", "piece").sortWithinPartitions("kind", "piece", "block").mapInArrow(run, ANSWER), "lm-counts")


def answered(blocks: DataFrame, answers: DataFrame, fn, schema: str, names: list[str], held_only: bool) -> DataFrame:
    """``fn(row, block, total, kept)`` for every block with its answers; the
    two lists hold the counts of single words and of pairs."""
    wanted = ["block", "piece", "kind", "total", "kept"] if held_only else ["block", "piece", "kind", "total"]
    fields = ["block", "at", "kind", "total", "kept", "role", "doc_ids", "doc_nulls", "words", "hashes", "tokens"]
    left = answers.where("block >= 0")
    if held_only:
        blocks, left = blocks.where("role = 1"), left.where("length(kept) > 0")
    empty = F.lit(b"")
    first = left.select("block", F.col("piece").alias("at"), "kind", "total", F.col("kept") if "kept" in wanted else empty.alias("kept"), F.lit(0).alias("role"),
                        *(empty.alias(c) for c in fields[6:]))
    last = blocks.select("block", F.lit(0).alias("at"), F.lit(2).alias("kind"), empty.alias("total"), empty.alias("kept"), *fields[5:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[list[np.ndarray]] = [[], []]
        kept: list[list[np.ndarray]] = [[], []]
        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] < 2:
                    total[row["kind"]].append(unplaned(row["total"]))
                    if held_only:
                        kept[row["kind"]].append(unplaned(row["kept"]))
                    continue
                yield pa.RecordBatch.from_arrays(fn(row, Block(row), [np.concatenate(x) for x in total], [np.concatenate(x) for x in kept] if held_only else None), names)
                total, kept = [[], []], [[], []]

    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return first.union(last).repartition(parts, "block").sortWithinPartitions("block", "kind", "at").mapInArrow(run, schema)


def bucket(context_counts: np.ndarray) -> np.ndarray:
    return np.where(context_counts > 0, np.minimum(np.log2(np.maximum(context_counts, 1)).astype(np.int64) + 1, BUCKETS - 1), 0)


def estimates(block: Block, counts: list[np.ndarray], n: float, v: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, float, np.ndarray]:
    """Per token: bucket, bigram estimate, word estimate, uniform estimate, word count."""
    single, pair = (c.astype(np.float64) for c in counts)
    context, word = single[block.place[block.previous]], single[block.place[block.next]]
    return bucket(context), pair[block.pair_at] / np.maximum(context, 1), word / max(n, 1), 1 / (v + 1), word


def learn_weights(blocks: DataFrame, answers: DataFrame, kept_n: int, kept_v: int, rounds: int = 60) -> np.ndarray:
    """(bucket, 3): weights of the bigram, word and uniform estimates."""

    def cells(row: dict, block: Block, total, kept) -> list[pa.Array]:
        b, f2, f1, _, _ = estimates(block, kept, kept_n, kept_v)
        rounded = [np.where(f > 0, np.round(STEPS_PER_OCTAVE * np.log2(np.maximum(f, 1e-300))) + 1024, 0).astype(np.int64) for f in (f2, f1)]
        cell, many = np.unique((b << 32) | (rounded[0] << 16) | rounded[1], return_counts=True)
        return [pa.array(cell), pa.array(many)]

    rows = answered(blocks, answers, cells, "cell long, many long", ["cell", "many"], True).groupBy("cell").agg(F.sum("many").alias("many")).collect()
    weights = np.tile([0.5, 0.4, 0.1], (BUCKETS, 1))
    if rows:
        cell, many = np.array([r.cell for r in rows]), np.array([r.many for r in rows], np.float64)
        b = cell >> 32
        f2, f1 = (np.where(c > 0, 2.0 ** ((c - 1024) / STEPS_PER_OCTAVE), 0.0) for c in (cell >> 16 & 0xFFFF, cell & 0xFFFF))
        f = np.stack([f2, f1, np.full(len(f1), 1 / (kept_v + 1))], 1)
        for _ in range(rounds):
            share = weights[b] * f
            share *= (many / share.sum(1))[:, None]
            mass = np.stack([np.bincount(b, share[:, i], BUCKETS) for i in range(3)], 1) + weights * 1e-3
            weights = mass / mass.sum(1, keepdims=True)
    weights[0, 0] = 0.0
    weights = np.maximum(weights, [0, 1e-9, 1e-9])
    return weights / weights.sum(1, keepdims=True)


def score(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)
    per document; documents with crc32 remainder ``SCORED`` are never learned."""
    blocks = pack(df, doc_id, text)
    ranges = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    answers = answer(ask(blocks, ranges))
    sums = answers.where("block = -1").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "v", "kept_n", "kept_v"))).first()
    n, v = sums["n"], sums["v"]
    weights = learn_weights(blocks, answers, sums["kept_n"], sums["kept_v"])

    def of_documents(row: dict, block: Block, total, kept) -> list[pa.Array]:
        b, f2, f1, f0, word = estimates(block, total, n, v)
        w = weights[b]
        model = np.log10(w[:, 0] * f2 + w[:, 1] * f1 + w[:, 2] * f0)
        base = np.log10((word + 0.5) / (n + 0.5 * (v + 1)))
        per = [np.add.reduceat(x, block.starts) for x in ((word > 0).astype(np.int64), base, model)]
        ids = pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=np.frombuffer(row["doc_nulls"], np.uint8).astype(bool))
        return [ids, pa.array(np.full(len(ids), row["role"], np.int32)), pa.array(block.ends - block.starts + 1), *(pa.array(x) for x in per)]

    rows = answered(blocks, answers, of_documents, SCORES, [c.split()[0] for c in SCORES.split(", ")], False)
    return rows.select("doc_id", (F.col("role") == 2).alias("held_out"), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
