"""Trie of the conversations' common beginnings.

A node is a distinct sequence of first turns (role and text). The steps:

1. A turn becomes a 128-bit id (two 64-bit hashes) and its size in bytes; texts
   are not moved. Equal conversations are reduced to one row with their number
   and the digest of their ids, streamed in order (:func:`distinct_sequences`).
2. The distinct sequences are dealt to shards by range of their turn ids. Each
   shard holds padded turn-id matrices, ``WIDTH`` turns at a time, so that long
   conversations don't widen the others' rows. ``np.lexsort`` orders them; the
   mask of changed columns, OR-accumulated along the turns, marks at every depth
   where a node starts, and ``reduceat`` sums its rows (:func:`shard_nodes`).
3. Only nodes on the path of a shard's first or last row can go on in another
   shard. They are taken out of the sums and recombined in shard order with one
   stack of open nodes (:func:`recombine`): two paths a shard, whatever it holds.

A conversation's turn ids are one row, like a document's text. The digest of a
node's ids is one sequential hash by definition, so one task streams the
members of a very common conversation (16 bytes a row, never held).

Defined results: rows without a conv_id belong to no conversation; null role or
text is empty; turns are ordered by turn, null first, ties by their ids, and
repeated rows are turns of their own; a conversation without turns is a member
of the root alone; an empty table gives no nodes, not even a root; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import written

WIDTH = 16  #: turns of a matrix
SHARD_TURNS = 500_000  #: turns of a shard, about
NO_ENDS = hashlib.sha256(b"").hexdigest()
TURNS = "array<struct<hi:long,lo:long,size:long>>"
COUNTS = ["conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
NODE = pa.schema([("shard", pa.int32()), ("slot", pa.int32()), ("parent_slot", pa.int32()), ("last", pa.bool_()), ("hi", pa.int64()), ("lo", pa.int64()), ("size", pa.int64()),
                  ("depth", pa.int64()), ("parent_conv_id", pa.int64()), *((n, pa.int64()) for n in COUNTS), ("ends_sha256", pa.string())])
NODE_SQL = ("shard int, slot int, parent_slot int, last boolean, hi long, lo long, size long, depth long, parent_conv_id long, "
            "conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
JOINED = pa.schema([("shard", pa.int32()), ("slot", pa.int32()), ("id", pa.int64()), ("parent", pa.int64()), ("depth", pa.int64()), *((n, pa.int64()) for n in COUNTS), ("ends_sha256", pa.string())])
JOINED_SQL = ("shard int, slot int, id long, parent long, depth long, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")


def sequences(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): the ids and sizes of each conversation's turns in order."""
    who, what = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    turns = df.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.struct(F.col(turn).alias("turn"), F.xxhash64(who, what).alias("hi"), F.xxhash64(what, who, F.lit(1)).alias("lo"),
                                                               F.octet_length(what).cast("long").alias("size")).alias("t"))
    ordered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return ordered.select("conv_id", F.transform("t", lambda t: F.struct(t["hi"].alias("hi"), t["lo"].alias("lo"), t["size"].alias("size"))).cast(TURNS).alias("turns"))


def distinct_sequences(seqs: DataFrame) -> DataFrame:
    """(conv_id, turns, n, ends): one row for equal sequences, under the smallest
    id; ``ends`` is the SHA-256 of all their decimal ids, ascending, comma-joined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        made: list[tuple[int, int, str]] = []

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))], ["first", "n", "ends"])

        for _, group in groupby(rows, key=lambda row: row[:2]):
            first, n, sha = None, 0, hashlib.sha256()
            for _, _, conv in group:
                sha.update(b",%d" % conv if n else b"%d" % conv)
                first, n = conv if first is None else first, n + 1
            made.append((first, n, sha.hexdigest()))
            if len(made) >= 10_000:
                yield flush()
                made = []
        if made:
            yield flush()

    seqs = written(seqs, "sequences")
    parts = int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = seqs.select(F.xxhash64("turns").alias("k1"), F.xxhash64(F.lit(1), "turns").alias("k2"), "conv_id")
    firsts = keys.repartition(parts, "k1", "k2").sortWithinPartitions("k1", "k2", "conv_id").mapInArrow(run, "first long, n long, ends string")
    return seqs.join(firsts, F.col("conv_id") == F.col("first")).select("conv_id", "turns", "n", "ends")


class Shard:
    """Nodes of one shard, level by level. Rows are distinct sequences:
    ``first[i]:first[i + 1]`` are the turns of row i in the flat arrays."""

    def __init__(self, conv: np.ndarray, n: np.ndarray, length: np.ndarray, hi: np.ndarray, lo: np.ndarray, size: np.ndarray):
        self.conv, self.n, self.length, self.hi, self.lo, self.size = conv, n, length, hi, lo, size
        self.first = np.concatenate([[0], np.cumsum(length)])
        self.order = np.argsort(length > 0, kind="stable")  # a row that ends goes before those that go on
        #: per depth: a row of each node, its parent's number, rows' number and smallest id; the row that ends there or -1
        self.levels: list[dict[str, np.ndarray]] = []
        #: depth -> numbers of the nodes of the first and of the last row
        self.paths: list[tuple[int, int]] = []
        everyone = np.zeros(len(conv), np.int64)
        self.level(0, self.order, np.zeros(1, np.int64), everyone - 1, everyone)
        self.read(everyone)

    def level(self, depth: int, rows: np.ndarray, starts: np.ndarray, above: np.ndarray, node: np.ndarray) -> None:
        """Add a depth: ``rows`` in order, the nodes' ``starts`` in it; ``above``
        and ``node`` are each row's node at the depth before and at this one."""
        ends = np.full(len(starts), -1)
        done = rows[self.length[rows] == depth]
        ends[node[done]] = done
        self.levels.append({"row": rows[starts], "parent": above[rows[starts]], "n": np.add.reduceat(self.n[rows], starts), "conv": np.minimum.reduceat(self.conv[rows], starts), "end": ends})

    def read(self, node: np.ndarray) -> None:
        depth, longest = 0, int(self.length.max())
        while depth < longest:
            at = np.flatnonzero(self.length[self.order] > depth)
            rows = self.order[at]
            width = min(WIDTH, longest - depth)
            here = depth + np.arange(width)
            there = here < self.length[rows][:, None]
            place = np.where(there, self.first[rows][:, None] + here, 0)
            pad = np.iinfo(np.int64).min
            hi, lo = np.where(there, self.hi[place], pad), np.where(there, self.lo[place], pad)
            # primary key: the node so far; then the turns; at last the shorter row first
            keys = [np.minimum(self.length[rows], depth + width + 1)]
            for d in range(width - 1, -1, -1):
                keys += [lo[:, d], hi[:, d]]
            keys.append(node[rows])
            turn = np.lexsort(keys)
            rows, there, hi, lo = rows[turn], there[turn], hi[turn], lo[turn]
            self.order[at] = rows
            changed = np.ones((len(rows), width), bool)
            changed[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
            changed[1:, 0] |= node[rows[1:]] != node[rows[:-1]]
            label = np.cumsum(np.logical_or.accumulate(changed, axis=1), axis=0)
            for d in range(width):
                present = there[:, d]
                own, mark = rows[present], label[present, d]
                begins = np.concatenate([[True], mark[1:] != mark[:-1]])
                below = np.full(len(node), -1)
                below[own] = np.cumsum(begins) - 1
                self.level(depth + d + 1, own, np.flatnonzero(begins), node, below)
                node = below
            depth += width

    def spine(self) -> list[tuple[int, int]]:
        """(depth, node) of the first row's path, then of what the last row's
        path doesn't share with it."""
        def path(row: int) -> list[int]:
            nodes = []
            for depth in range(int(self.length[row]), -1, -1):
                nodes.append(self.find(depth, row) if depth == self.length[row] else int(self.levels[depth + 1]["parent"][nodes[-1]]))
            return nodes[::-1]

        one, other = path(int(self.order[0])), path(int(self.order[-1]))
        shared = next((d for d in range(min(len(one), len(other))) if one[d] != other[d]), min(len(one), len(other)))
        self.branch = len(one)  # slots from here on belong to the last row
        return list(enumerate(one)) + [(d, other[d]) for d in range(shared, len(other))]

    def find(self, depth: int, row: int) -> int:
        return int(np.flatnonzero(self.levels[depth]["end"] == row)[0])

    def nodes(self) -> Iterator[dict[str, np.ndarray]]:
        """The nodes by falling depth. What a spine node has below itself in
        other spine nodes is left out of its sums."""
        slots = [np.full(len(level["row"]), -1) for level in self.levels]
        for slot, (depth, node) in enumerate(self.spine()):
            slots[depth][node] = slot
        children = leaves = saved = None
        for depth in range(len(self.levels) - 1, -1, -1):
            level, slot = self.levels[depth], slots[depth]
            k = len(slot)
            if children is None:
                children, leaves, saved = (np.zeros(k, np.int64) for _ in range(3))
            size = self.size[self.first[level["row"]] + depth - 1] if depth else np.zeros(1, np.int64)
            inner = slot < 0
            leaves = leaves + (inner & (children == 0))
            saved = saved + np.where(inner, (level["n"] - 1) * size, 0)
            up = slots[depth - 1][level["parent"]] if depth else np.full(k, -1)
            ids = self.first[level["row"]] + depth - 1
            yield {"depth": np.full(k, depth), "slot": slot, "parent_slot": up, "last": slot >= self.branch, "size": size, "conv_id": level["conv"], "n_convs": level["n"],
                   "hi": self.hi[ids] if depth else np.zeros(1, np.int64), "lo": self.lo[ids] if depth else np.zeros(1, np.int64),
                   "parent_conv_id": self.levels[depth - 1]["conv"][level["parent"]] if depth else np.zeros(1, np.int64),
                   "n_children": children, "n_leaves": leaves, "saved_tokens": saved, "end": level["end"]}
            if depth:
                sums = np.zeros((3, len(slots[depth - 1])), np.int64)
                for out, values in zip(sums, (np.ones(k, np.int64), leaves, saved), strict=True):
                    np.add.at(out, level["parent"][inner], values[inner])
                children, leaves, saved = sums


def shard_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of one range of (conv_id, turns, n, ends)."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId()
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    whole = pa.Table.from_batches(parts).combine_chunks()
    lists = whole["turns"].chunk(0)
    flat = lists.flatten()
    shard = Shard(np.asarray(whole["conv_id"]), np.asarray(whole["n"]), np.asarray(lists.value_lengths(), np.int64), *(np.asarray(flat.field(i)) for i in range(3)))
    ends = whole["ends"].chunk(0)
    for level in shard.nodes():
        end = level.pop("end")
        level["shard"] = np.full(len(end), number)
        arrays = {name: pa.array(level[name]).cast(NODE.field(name).type) for name in level}
        inner = level["slot"] < 0
        arrays["slot"] = pa.array(level["slot"], pa.int32(), mask=inner)
        arrays["parent_slot"] = pa.array(level["parent_slot"], pa.int32(), mask=level["parent_slot"] < 0)
        arrays["parent_conv_id"] = pa.array(level["parent_conv_id"], pa.int64(), mask=(level["parent_slot"] >= 0) | (level["depth"] == 0))
        arrays["ends_sha256"] = ends.take(pa.array(end, pa.int64(), mask=end < 0)).fill_null(NO_ENDS)
        batch = pa.RecordBatch.from_arrays([arrays[name] for name in NODE.names], schema=NODE)
        yield from (batch.slice(i, 10_000) for i in range(0, batch.num_rows, 10_000))


def recombine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spine nodes of all shards, in (shard, slot) order -> the whole nodes
    (with ``id``) and, per shard and slot, the ``id`` they became part of."""
    rows = (row for batch in batches for row in batch.to_pylist())
    opened: list[dict] = []
    made: list[dict] = []
    fresh = 0

    def close() -> None:
        node = opened.pop()
        node["n_leaves"] += node["n_children"] == 0
        node["saved_tokens"] += (node["n_convs"] - 1) * node["size"]
        if opened:
            up = opened[-1]
            node["parent"] = up["id"]
            up["n_children"] += 1
            up["n_leaves"] += node["n_leaves"]
            up["saved_tokens"] += node["saved_tokens"]
        made.append(node | {"shard": None, "slot": None})

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([m.get(name) for m in made], kind) for name, kind in zip(JOINED.names, JOINED.types, strict=True)], schema=JOINED)

    for _, group in groupby(rows, key=lambda row: row["shard"]):
        matching = True  # still on the path that is open from the shards before
        for row in group:
            depth = row["depth"]
            if row["last"] or not matching or depth >= len(opened) or (opened[depth]["hi"], opened[depth]["lo"]) != (row["hi"], row["lo"]):
                matching = False
                while len(opened) > depth:
                    close()
                opened.append(row | {"id": fresh})
                fresh += 1
            else:
                node = opened[depth]
                for name in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                    node[name] += row[name]
                node["conv_id"] = min(node["conv_id"], row["conv_id"])
                if row["ends_sha256"] != NO_ENDS:
                    node["ends_sha256"] = row["ends_sha256"]
            made.append({"shard": row["shard"], "slot": row["slot"], "id": opened[depth]["id"]})
        if len(made) >= 10_000:
            yield flush()
            made = []
    while opened:
        close()
    if made:
        yield flush()


def prefix_trie(seqs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256) per node of (conv_id, turns); a node's last turn
    is turn ``depth`` of conversation ``conv_id``."""
    spark = seqs.sparkSession
    rows = written(distinct_sequences(seqs), "distinct-sequences")
    turns = rows.agg(F.sum(F.size("turns"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // shard_turns))
    ids = F.flatten(F.transform("turns", lambda t: F.array(t["hi"], t["lo"])))
    nodes = written(rows.repartitionByRange(parts, ids).mapInArrow(shard_nodes, NODE_SQL), "shard-nodes")
    spine = nodes.where("slot IS NOT NULL").repartition(1).sortWithinPartitions("shard", "slot")
    joined = written(spine.mapInArrow(recombine, JOINED_SQL), "spine-nodes")
    whole, links = joined.where("shard IS NULL"), joined.where("shard IS NOT NULL").select("shard", "slot", "id")
    names = whole.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    above = links.join(names.withColumnRenamed("parent", "id"), "id").select("shard", F.col("slot").alias("parent_slot"), F.col("parent_conv_id").alias("found"))
    out = ["conv_id", "depth", "parent_conv_id", *COUNTS[1:], "ends_sha256"]
    inner = nodes.where("slot IS NULL")
    return (inner.where("parent_slot IS NULL").select(*out)
            .union(inner.where("parent_slot IS NOT NULL").drop("parent_conv_id").join(above, ["shard", "parent_slot"]).withColumnRenamed("found", "parent_conv_id").select(*out))
            .union(whole.join(names, "parent", "left").select(*out)))
