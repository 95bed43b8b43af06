"""SimHash near-duplicates with BK-trees.

Fingerprint: a text is lower-cased (A-Z), cut into words at ASCII white space
and into shingles of ``width`` words, repeats included (fewer words: the whole
sequence; none: fingerprint zero). A bit is set if it is set in more than half
of the shingles' XXH64 values (seed 42).

Links: fingerprints that differ in at most ``radius`` bits. The 64 bits are
dealt into ``radius + 1`` blocks or more; two linked fingerprints agree in all
the bits of some choice of ``blocks - radius`` blocks, so each choice and its
bits name a *shard*, and every link lies inside some shard. A shard's distinct
fingerprints form a BK-tree (children keyed by their integer Hamming distance
to the parent); a search follows only edges whose key is within the radius of
the distance to the parent. The trees of all shards grow with the corpus, so
they are not broadcast whole: fingerprints and trees meet by shard key. What
leaves a shard is a star per local component, never all pairs. ``blocks`` grows
with the number of fingerprints to keep shards small; any choice gives the same
links.

A shard above ``TILE`` fingerprints (many texts that lie near each other) is
split by further bits: its members agree in the shard's bits, so linked ones
differ in at most ``radius`` of the free bits. These are dealt into blocks
again, and each choice of them names a smaller shard, for the same reason. This
is done ``DEEPER`` times at most, each time only for the shards still above
``TILE``. A shard that is large even then is cut into tiles, and a pair of
tiles is a unit of work (the tree of one, searched by the other), so no task
holds an unbounded group.

Exact copies share a fingerprint and are collapsed before the search.

Defined results: null text counts as empty; a null doc_id takes part but can't
be the smallest; a component of null ids alone has a null component id; a
repeated row is one more member; empty table -> empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.llm.common import by_batch, row_key, utf8, written
from mercato.llm.graph import components

#: Fingerprints a unit of the search holds at most on either side.
TILE = 4096

#: Mean fingerprints of a shard beyond which more blocks are used.
MEAN_SHARD = 256

#: Times that a large shard is split by further bits, and the blocks its free
#: bits are dealt into beyond the radius.
DEEPER, SPARE = 2, 3


def shingle_hashes(text: bytes, width: int) -> list[int]:
    words = text.lower().split()
    if not words:
        return []
    if len(words) < width:
        return [xxhash.xxh64_intdigest(b" ".join(words), 42)]
    runs = zip(*(words[i:] for i in range(width)), strict=False)
    return [xxhash.xxh64_intdigest(b" ".join(run), 42) for run in runs]


def fingerprints(texts: list[bytes], width: int) -> np.ndarray:
    """One unsigned 64-bit fingerprint per text."""
    hashes = [np.array(shingle_hashes(text, width), np.uint64) for text in texts]
    sizes = np.array([len(h) for h in hashes], np.int64)
    out = np.zeros(len(texts), np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        bits = np.unpackbits(np.concatenate(hashes).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = np.cumsum(sizes[some]) - sizes[some]
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
        out[some] = np.packbits(2 * ones > sizes[some][:, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def with_fingerprint(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, keyed: bool = False) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit integer; if ``keyed``, also the row's key."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = utf8(batch.column(1))
        made = np.concatenate([fingerprints(texts[i:i + 64], width) for i in range(0, len(texts), 64)])
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view(np.int64)), *batch.columns[2:]], ["doc_id", "fp", *["key"] * keyed])

    key = [row_key(doc_id, text).alias("key")] * keyed
    return df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), *key).mapInArrow(by_batch(run), "doc_id long, fp long" + ", key long" * keyed)


class BKTree:
    """Distinct integers by Hamming distance."""

    def __init__(self):
        self.root, self.children = None, {}

    def add(self, value: int) -> None:
        if self.root is None:
            self.root, self.children[value] = value, {}
            return
        node = self.root
        while node != value:
            edges = self.children[node]
            node = edges.setdefault((node ^ value).bit_count(), value)
            if node == value:
                self.children.setdefault(value, {})

    def within(self, value: int, radius: int) -> list[int]:
        found, open_nodes = [], [] if self.root is None else [self.root]
        while open_nodes:
            node = open_nodes.pop()
            distance = (node ^ value).bit_count()
            if distance <= radius:
                found.append(node)
            open_nodes += [child for key, child in self.children[node].items() if abs(key - distance) <= radius]
        return found


def star_edges(tree_of: list[int], searched_by: list[int] | None, radius: int) -> list[tuple[int, int]]:
    """(member, smallest member) for the local components of the links between
    ``tree_of`` and ``searched_by`` (None: inside ``tree_of``)."""
    tree, parent = BKTree(), {}

    def find(x: int) -> int:
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(x: int, y: int) -> None:
        x, y = find(x), find(y)
        if x != y:
            parent[max(x, y)] = min(x, y)

    for value in tree_of:
        if searched_by is None:
            for other in tree.within(value, radius):
                join(value, other)
        tree.add(value)
    for value in searched_by or []:
        for other in tree.within(value, radius):
            join(value, other)
    return [(x, root) for x in parent if (root := find(x)) != x]


def shard_masks(blocks: int, radius: int, within: int = 0) -> list[int]:
    """A bit mask for every choice of ``blocks - radius`` blocks of the bits
    that are free in ``within``, each with the bits of ``within``."""
    free = [1 << i for i in range(64) if not within >> i & 1]
    edges = [round(len(free) * i / blocks) for i in range(blocks + 1)]
    each = [sum(free[lo:hi]) for lo, hi in zip(edges, edges[1:], strict=False)]
    return [within | sum(choice) for choice in combinations(each, blocks - radius)]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def block_count(n: int, radius: int) -> int:
    """Blocks for which a shard of uniform fingerprints has few members."""
    for blocks in range(radius + 1, radius + 4):
        if n <= MEAN_SHARD << (64 * (blocks - radius) // blocks):
            return blocks
    return radius + 4


FINER = T.StructType([T.StructField("mask", T.LongType()), T.StructField("finer", T.LongType())])


def links(prints: DataFrame, radius: int = 3, fp: str = "fp") -> DataFrame:
    """(a, b): star edges whose components are those of all links between the
    distinct fingerprints of ``prints``."""
    spark = prints.sparkSession
    distinct = written(prints.select(F.col(fp).alias("fp")).distinct(), "fingerprints")
    masks = shard_masks(block_count(distinct.count(), radius), radius)
    shards = distinct.select("fp", F.explode(F.array(*(F.lit(signed(m)) for m in masks))).alias("mask"))
    shards = shards.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("bits"), "fp")
    small = []
    for _ in range(DEEPER + 1):
        large = written(shards.groupBy("mask", "bits").count().where(F.col("count") > TILE), "large-shards")
        if large.isEmpty() or len(small) == DEEPER:
            break
        small.append(shards.join(large, ["mask", "bits"], "left_anti"))
        # the masks follow from the blocks alone, so their number is bounded whatever the data
        finer = {m: shard_masks(radius + SPARE, radius, m) for m in masks if m.bit_count() < 64}
        masks = sorted({f for each in finer.values() for f in each})
        table = spark.createDataFrame([(signed(m), signed(f)) for m, each in finer.items() for f in each], FINER)
        shards = (shards.join(large.select("mask", "bits"), ["mask", "bits"]).join(F.broadcast(table), "mask")
                  .select(F.col("finer").alias("mask"), F.col("fp").bitwiseAND(F.col("finer")).alias("bits"), "fp").distinct())
        shards = written(shards, "finer-shards")
    tiles = large.select("mask", "bits", F.ceil(F.col("count") * 1.25 / TILE).cast("int").alias("tiles"))
    tiled = shards.join(tiles, ["mask", "bits"], "left").select("mask", "bits", "fp", F.coalesce("tiles", F.lit(1)).alias("tiles"))
    for part in small:
        tiled = tiled.union(part.select("mask", "bits", "fp", F.lit(1).alias("tiles")))
    tiled = tiled.withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
    units = tiled.select("mask", "bits", "fp", "tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")).select(
        "mask", "bits", F.least("tile", "other").alias("t"), F.greatest("tile", "other").alias("u"), "tile", "fp")
    key = ["mask", "bits", "t", "u"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, sides, made = None, ([], []), []

        def close() -> None:
            if unit is not None and len(sides[0]) + len(sides[1]) > 1:
                made.extend(star_edges(sides[0], None if unit[2] == unit[3] else sides[1], radius))

        for batch in batches:
            for *now, tile, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != unit:
                    close()
                    unit, sides = now, ([], [])
                sides[tile != now[2]].append(value & (1 << 64) - 1)
            if len(made) > 10_000:
                yield edge_batch(made)
                made.clear()
        close()
        if made:
            yield edge_batch(made)

    return (units.repartition(parts, *key).sortWithinPartitions(*key, "tile", "fp")
            .select(*key, "tile", "fp").mapInArrow(run, "a long, b long"))


def edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(edges, np.uint64).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, i])) for i in (0, 1)], ["a", "b"])


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, radius: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``df``."""
    prints = written(with_fingerprint(df, doc_id, text, width), "simhash")
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(prints, radius))
    labelled = least.join(roots, least.fp == roots.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    of_root = labelled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = labelled.join(of_root, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def first_rows(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, radius: int = 3) -> DataFrame:
    """(doc_id, key) of one row of every component: the smallest id (null: after
    all others), then the smallest ``row_key``."""
    prints = written(with_fingerprint(df, doc_id, text, width, keyed=True), "simhash")
    least = prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first"))
    roots = components(links(prints, radius))
    labelled = least.join(roots, least.fp == roots.node, "left").select(F.coalesce("root", "fp").alias("root"), "first")
    return labelled.groupBy("root").agg(F.min("first").alias("first")).select("first.doc_id", "first.key")
