"""Exact top-k inner products with KD-trees per shard.

Vectors become integers, floor(256 * x). A KD split of a bounded sample deals
the vectors to at most ``CELLS`` cells of space, each with its tight bounding
box; a cell with more than ``PIECE`` vectors is cut into pieces by a hash of the
row. A piece is a shard: its tree splits at the median of the widest dimension
and keeps the tight bounding box of every node. For a query q no point of a box
scores above sum(max(q_i * low_i, q_i * high_i)).

A query is searched in its own piece first. The kth score found there, and the
boxes of the cells (a bounded table, broadcast), tell which other cells can hold
anything better; only their pieces get a copy of the query, and the kth score
goes with it. The search visits nodes by falling bound and stops when the best
open bound is below the kth score so far (an equal bound may still hold a tie
with a smaller id). Where a piece gets more than ``BLOCK`` queries, they are cut
into blocks and the piece is copied for each. The sample chooses the cells only;
results are exact.

Defined results: vectors that are null or empty, or hold nulls or non-finite values, and
rows with a null id take no part; vectors of other lengths are no candidates of
a query; a query's own row is left out once, so a repeated row stays a
candidate; equal scores go to the smaller id; fewer candidates than k: all of
them; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import written

SAMPLE = 20_000  #: vectors from which the cells are chosen
CELLS = 1024  #: cells of space, at most
CELL = 2048  #: vectors of a cell, about, while there are fewer cells
PIECE = 65_536  #: vectors of a shard, at most (about: dealt by hash)
BLOCK = 4096  #: queries that a task takes to a shard (about)
LEAF = 128
EXACT = float(1 << 53)


class Cells:
    """A full binary tree of median splits; a leaf is a cell."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth
        self.axis, self.cut = np.zeros((1 << depth) - 1, np.int64), np.full((1 << depth) - 1, np.inf)
        rows = [np.arange(len(sample))]
        for node in range((1 << depth) - 1):
            own = sample[rows[node]]
            left = np.ones(len(own), bool)
            if len(own) > 1:
                self.axis[node] = int((own.max(0) - own.min(0)).argmax())
                values = own[:, self.axis[node]]
                # the greatest value below the maximum, up to the median: both sides get rows if values differ
                lower = values[values < values.max()]
                if len(lower):
                    self.cut[node] = min(np.partition(values, len(own) // 2)[len(own) // 2], lower.max())
                    left = values <= self.cut[node]
            rows += [rows[node][left], rows[node][~left]]

    def of(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (points[np.arange(len(points)), self.axis[node]] > self.cut[node])
        return node - len(self.axis)


class Tree:
    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf: int = LEAF):
        order = np.lexsort((ids,))
        self.low, self.high, self.children, self.span = [], [], [], []
        self.order = order
        self._build(points, 0, len(order), leaf)
        self.ids, self.points = ids[self.order], points[self.order]
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _build(self, points: np.ndarray, begin: int, end: int, leaf: int) -> None:
        open_ = [(begin, end, -1)]
        while open_:
            begin, end, parent = open_.pop()
            own = self.order[begin:end]
            number = len(self.span)
            low, high = points[own].min(0), points[own].max(0)
            self.low.append(low)
            self.high.append(high)
            self.children.append([])
            self.span.append((begin, end))
            if parent >= 0:
                self.children[parent].append(number)
            axis = int((high - low).argmax())
            if end - begin > leaf and high[axis] > low[axis]:
                middle = (end - begin) // 2
                part = np.argpartition(points[own, axis], middle)
                self.order[begin:end] = own[part]
                open_ += [(begin, begin + middle, number), (begin + middle, end, number)]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        return box_bounds(queries, self.low, self.high)


def box_bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """(query, box): no point of the box scores more. Beyond the exact range of
    doubles the bounds are widened by more than their rounding."""
    bounds = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    return bounds + np.abs(bounds) * (0 if np.abs(bounds).max(initial=0) < EXACT / 4 else 1e-9)


def scores(points: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Integer inner products; beyond the exact range of doubles by Python's integers."""
    if len(points) and float((np.abs(points).max(0) * np.abs(query)).sum()) < EXACT:
        return (points @ query).astype(np.int64)
    whole = [int(x) for x in query]
    return np.array([max(-(1 << 63), min((1 << 63) - 1, sum(int(a) * b for a, b in zip(p, whole, strict=True)))) for p in points], np.int64)


def search(tree: Tree, rids: np.ndarray, queries: np.ndarray, own: list[int], least: list[int | None], k: int) -> list[list[tuple[int, int]]]:
    """For each query heaps of (score, -id): its ``k`` best points, those below
    ``least`` left out. ``rids`` are the points' row numbers in the tree's order."""
    found = []
    for query, rid, floor, bound in zip(queries, own, least, tree.bounds(queries).tolist(), strict=True):
        heap: list[tuple[int, int]] = []
        nodes = [(-bound[0], 0)]
        while nodes:
            most, node = heapq.heappop(nodes)
            limit = heap[0][0] if len(heap) == k else floor
            if limit is not None and -most < limit:
                break
            if tree.children[node]:
                for child in tree.children[node]:
                    if limit is None or bound[child] >= limit:
                        heapq.heappush(nodes, (-bound[child], child))
                continue
            begin, end = tree.span[node]
            made = scores(tree.points[begin:end], query)
            near = np.flatnonzero(made >= limit) if limit is not None else np.arange(end - begin)
            for i in near.tolist():
                if rids[begin + i] != rid:
                    entry = (int(made[i]), -int(tree.ids[begin + i]))
                    if len(heap) < k:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
        found.append(heap)
    return found


def usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    ok = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return df.where(F.col(vec_id).isNotNull() & (F.size(vector) > 0)).where(ok).select(
        F.col(vec_id).cast("long").alias("id"), F.size(vector).alias("dim"),
        F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * 256).cast("double")).alias("v"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, dim)


def choose_cells(rows: DataFrame, total: int) -> dict[int, Cells]:
    """Cells for each length of vectors that the sample holds."""
    depth = max(0, min(CELLS.bit_length() - 1, (-(-total // CELL) - 1).bit_length()))
    if not depth:
        return {}
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("dim", "v").collect()
    return {dim: Cells(np.array([r.v for r in sample if r.dim == dim]), depth) for dim in {r.dim for r in sample}}


def deal(rows: DataFrame, cells: dict[int, Cells]) -> DataFrame:
    """(rid, id, dim, v, cell): every row with a number of its own and its cell; written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            cell = np.zeros(len(dims), np.int32)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                if int(dim) in cells:
                    cell[at] = cells[int(dim)].of(matrix(batch.column("v").take(pa.array(at)), int(dim)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], ["rid", "id", "dim", "v", "cell"])

    numbered = rows.select(F.monotonically_increasing_id().alias("rid"), "id", "dim", "v")
    return written(numbered.mapInArrow(run, "rid long, id long, dim int, v array<double>, cell int"), "kd-cells")


def pieces(dealt: DataFrame) -> DataFrame:
    """(dim, cell, parts): into how many pieces each cell is cut."""
    return dealt.groupBy("dim", "cell").agg(F.ceil(F.count("*") / PIECE).cast("int").alias("parts"))


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """Stretches of rows that agree in the first columns, one at a time."""
    now, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = np.stack([np.asarray(batch.column(i)) for i in range(keys)])
        edges = [0, *(np.flatnonzero((columns[:, 1:] != columns[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:], strict=False):
            key = tuple(columns[:, a].tolist())
            if key != now and held:
                yield now, pa.Table.from_batches(held)
                held = []
            now = key
            held.append(batch.slice(a, b - a))
    if held:
        yield now, pa.Table.from_batches(held)


FOUND = "rid long, query_id long, vec_id long, score long"


def candidates(own: list[int], ids: list[int], heaps: list[list[tuple[int, int]]]) -> pa.RecordBatch:
    made = [(rid, i, -other, score) for rid, i, heap in zip(own, ids, heaps, strict=True) for score, other in heap]
    return pa.RecordBatch.from_arrays([pa.array([m[c] for m in made], pa.int64()) for c in range(4)], ["rid", "query_id", "vec_id", "score"])


def search_pieces(points: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Candidates of the ``asked`` (dim, cell, piece, block, rid, id, v, least)
    among the points of their piece."""
    key = ["dim", "cell", "piece", "block"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, rids, of = None, None, None
        for (*piece, role), rows in groups(batches, 5):
            dim, ids, v = piece[0], np.asarray(rows["id"]), matrix(rows["v"].combine_chunks(), piece[0])
            if role == 0:
                tree, of = Tree(ids, v), piece
                rids = np.asarray(rows["rid"])[tree.order]
            elif of == piece:
                own, least = rows["rid"].to_pylist(), rows["least"].to_pylist()
                for i in range(0, len(own), 256):
                    part = slice(i, i + 256)
                    yield candidates(own[part], ids[part].tolist(), search(tree, rids, v[part], own[part], least[part], k))

    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = [*key, "role", "rid", "id", "v", "least"]
    both = (points.select(*key, F.lit(0).alias("role"), "rid", "id", "v", F.lit(None).cast("long").alias("least"))
            .union(asked.select(*key, F.lit(1).alias("role"), "rid", "id", "v", "least")))
    return both.repartition(parts, *key).sortWithinPartitions(*key, "role", "id", "rid").select(*columns).mapInArrow(run, FOUND)


def boxes(dealt: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length of vectors: the cells and their bounding boxes (at most
    ``CELLS`` rows a length)."""
    schema = "dim int, cell int, low array<double>, high array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            dims, cell = np.asarray(batch.column("dim")), np.asarray(batch.column("cell"))
            lows, highs = batch.column(batch.schema.names[2]), batch.column(batch.schema.names[-1])
            for key in set(zip(dims.tolist(), cell.tolist(), strict=True)):
                at = pa.array(np.flatnonzero((dims == key[0]) & (cell == key[1])))
                low, high = matrix(lows.take(at), key[0]).min(0), matrix(highs.take(at), key[0]).max(0)
                if key in held:
                    low, high = np.minimum(low, held[key][0]), np.maximum(high, held[key][1])
                held[key] = low, high
        if held:
            kind = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in held], pa.int32()), pa.array([c for _, c in held], pa.int32()),
                                              pa.array([x.tolist() for x, _ in held.values()], kind), pa.array([x.tolist() for _, x in held.values()], kind)], ["dim", "cell", "low", "high"])

    partial = dealt.select("dim", "cell", "v").mapInArrow(run, schema)
    rows = partial.repartition(int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions")), "dim", "cell").mapInArrow(run, schema).collect()
    out = {}
    for dim in {r.dim for r in rows}:
        own = sorted((r.cell, r.low, r.high) for r in rows if r.dim == dim)
        out[dim] = np.array([c for c, *_ in own], np.int32), np.array([x for _, x, _ in own]), np.array([x for *_, x in own])
    return out


def reachable(asked: DataFrame, box) -> DataFrame:
    """``asked`` (rid, id, dim, v, cell, piece, least) once for every cell whose
    box reaches the kth score, as ``cell``; where it comes from, as ``home``, ``home_piece``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, least = np.asarray(batch.column("dim")), batch.column("least").to_pylist()
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                cells, low, high = box.value[dim]
                for part in np.array_split(at, -(-len(at) // 512)):
                    bounds = box_bounds(matrix(batch.column("v").take(pa.array(part)), dim), low, high)
                    floor = np.array([-np.inf if least[i] is None else least[i] for i in part.tolist()])
                    row, to = np.nonzero(bounds >= floor[:, None])
                    for some in np.array_split(np.arange(len(row)), -(-len(row) // 20_000) or 1):
                        taken = batch.take(pa.array(part[row[some]]))
                        yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(cells[to[some]], pa.int32())], [*taken.schema.names, "cell"])

    columns = asked.select("rid", "id", "dim", "v", F.col("cell").alias("home"), F.col("piece").alias("home_piece"), "least")
    return columns.mapInArrow(run, "rid long, id long, dim int, v array<double>, home int, home_piece int, least long, cell int")


def top_k(df: DataFrame, every: int = 50, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best candidates of every row
    whose id is divisible by ``every``."""
    best = Window.partitionBy("rid").orderBy(F.col("score").desc(), "vec_id")
    found = all_candidates(df, every, k, vec_id, vector)
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def all_candidates(df: DataFrame, every: int, k: int, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """At most ``k`` candidates of each query from each piece that can hold one of its best."""
    spark = df.sparkSession
    rows = usable(df, vec_id, vector)
    total = rows.count()
    cells = choose_cells(rows, total)
    dealt = deal(rows, cells)
    if not cells and total <= PIECE:  # all in one piece
        whole = dealt.select("rid", "id", "dim", "v", "cell", F.lit(0).alias("piece"), F.lit(0).alias("block"))
        return search_pieces(whole, whole.where(F.col("id") % every == 0).withColumn("least", F.lit(None).cast("long")), k)
    cut = pieces(dealt)
    of_row = F.pmod(F.xxhash64("rid"), F.col("parts")).cast("int")
    points = dealt.join(cut, ["dim", "cell"]).withColumn("piece", of_row).drop("parts")
    asked = points.where(F.col("id") % every == 0).withColumn("least", F.lit(None).cast("long"))
    at_home = written(search_pieces(points.withColumn("block", F.lit(0)), asked.withColumn("block", F.lit(0)), k), "kd-home")
    kth = at_home.groupBy("rid").agg(F.when(F.count("*") == k, F.min("score")).alias("least"))
    box = spark.sparkContext.broadcast(boxes(dealt))
    sent = reachable(asked.drop("least").join(kth, "rid", "left"), box).join(cut, ["dim", "cell"])
    sent = written(sent.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).where("NOT (cell = home AND piece = home_piece)").drop("parts"), "kd-sent")
    blocks = sent.groupBy("dim", "cell", "piece").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    wide = points.join(blocks, ["dim", "cell", "piece"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    split = sent.join(blocks, ["dim", "cell", "piece"]).withColumn("block", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))
    return at_home.union(search_pieces(wide, split, k))
