"""Token ids as compact binary segments.

Texts are encoded with the ``tokenizers`` library, an end id closes each
document, and the ids are written in ascending ``doc_id`` order as *segments*:

====================  =======================================================
field                 meaning
====================  =======================================================
part, segment         position in the order: range partition, number in it
n_tokens              ids in the segment (end ids included)
doc_ids, doc_tokens   the documents in order and the ids each has
ranked                the segment's ids by falling frequency (ties: smaller
                      id first), uint32 little endian
control               one byte for four values: two bits each, lowest first,
                      byte length minus one
data                  the values' low bytes, little endian, no padding
====================  =======================================================

A value is the rank of an id in ``ranked``, so the most frequent 256 ids take
one byte. Every segment can be decoded alone; control bytes are kept apart, so
decoding is a numpy table lookup (byte lengths of all 256 control bytes)
followed by one masked scatter. Segments are rows of a Parquet table: Spark's
commit protocol covers lost and repeated tasks, and any store it knows works.

The ids of a document are split from the rest only at white space, where the
tokenizer's own splitting always ends a piece, so each white-space chunk is
encoded once per worker and looked up afterwards.

Defined results: null or empty text -> the end id alone; null ids come first;
rows that share a doc_id are ordered by their text's hash; an empty table gives
an empty one; other columns of the input are ignored.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import Memo, utf8, written

#: Ids a segment holds at most, but for a last document that goes beyond.
SEGMENT_TOKENS = 4_000_000

#: Chunks that a worker remembers (about 110 MB).
MEMO_ENTRIES = 600_000

SEGMENTS = ("part int, segment int, n_tokens long, doc_ids binary, doc_nulls binary, doc_tokens binary, "
            "ranked binary, control binary, data binary")
DOCUMENTS = "doc_id long, part int, segment int, in_segment long, n_tokens long, ids binary"

_CODECS: dict[str, ChunkCodec] = {}

#: Marks at the end of a chunk; the bars and brackets of special tokens are not among them.
MARKS = re.compile(r"[.,;:!?%$#&*]+\Z")

#: Byte lengths of the four values of each control byte.
LENGTHS = np.array([[1 + (c >> s & 3) for s in (0, 2, 4, 6)] for c in range(256)], np.uint8)


class ChunkCodec(Memo):
    """White-space chunk (UTF-8 bytes) -> its ids as uint32 little endian.

    The library encodes whole chunks. Two cuts spare most of that work, as new
    words are costly: ASCII marks after an ASCII letter or digit are always a
    piece of their own for its splitter (other letters may change in number
    when its normaliser lowers them), so word and marks are looked up apart; and a
    word of letters that its normaliser leaves as it is is one piece, so it
    goes to the library's merge model directly.
    """

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        super().__init__(self.encode, MEMO_ENTRIES)
        self.library = Tokenizer.from_file(tokenizer_file)
        self.symbols = Memo(lambda c: self.library.pre_tokenizer.pre_tokenize_str(c)[0][0], 10_000)

    def encode(self, chunk: bytes) -> bytes:
        word = chunk.decode()
        if (marks := MARKS.search(word)) and marks.start() and (before := word[marks.start() - 1]).isascii() and before.isalnum():
            return self[word[:marks.start()].encode()] + self[marks[0].encode()]
        if word.isalpha() and word == word.lower() and is_normalized("NFC", word):
            ids = [t.id for t in self.library.model.tokenize("".join(map(self.symbols.__getitem__, word)))]
        else:
            ids = self.library.encode(word, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)


def chunk_codec(tokenizer_file: str) -> ChunkCodec:
    """One codec per Python worker process."""
    if tokenizer_file not in _CODECS:
        _CODECS[tokenizer_file] = ChunkCodec(tokenizer_file)
    return _CODECS[tokenizer_file]


def encode_text(memo: ChunkCodec, text: bytes, end_id: int) -> np.ndarray:
    if b"<|" not in text:  # the tokenizer lowers letters, but knows its special tokens before that
        text = text.lower()
    return np.frombuffer(b"".join([*map(memo.__getitem__, text.split()), struct.pack("<I", end_id)]), "<u4")


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of non-negative values below 2**32."""
    values = np.ascontiguousarray(values, "<u4")
    extra = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]]
    codes = np.concatenate([extra, np.zeros(-len(extra) % 4, np.uint8)]).reshape(-1, 4)
    return (codes << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8).tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    out = np.zeros((n, 4), np.uint8)
    out[np.arange(4) < lengths[:, None]] = np.frombuffer(data, np.uint8)
    return out.view("<u4").ravel()


def segment_row(part: int, number: int, doc_ids: list, arrays: list[np.ndarray]) -> dict:
    ids = np.concatenate(arrays)
    counts = np.bincount(ids)  # ids are below the vocabulary's size
    ranked = np.argsort(-counts, kind="stable")[:np.count_nonzero(counts)]
    rank = np.zeros(len(counts), np.uint32)
    rank[ranked] = np.arange(len(ranked), dtype=np.uint32)
    control, data = pack(rank[ids])
    return {"part": part, "segment": number, "n_tokens": len(ids),
            "doc_ids": np.array([x or 0 for x in doc_ids], "<i8").tobytes(),
            "doc_nulls": np.array([x is None for x in doc_ids], np.uint8).tobytes(),
            "doc_tokens": np.array([len(a) for a in arrays], "<i8").tobytes(),
            "ranked": ranked.astype("<u4").tobytes(), "control": control, "data": data}


def write_segments(df: DataFrame, tokenizer_file: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every whole text and write the segments; returns them as read back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        memo, doc_ids, arrays, held = chunk_codec(tokenizer_file), [], [], 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([segment_row(part, number, doc_ids, arrays)], schema)

        for batch in batches:
            for key, data in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                doc_ids.append(key)
                arrays.append(encode_text(memo, data, end_id))
                held += len(arrays[-1])
                if held >= SEGMENT_TOKENS:
                    yield flush()
                    number, doc_ids, arrays, held = number + 1, [], [], 0
        if doc_ids:
            yield flush()

    schema = pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("n_tokens", pa.int64())]
                       + [(n, pa.binary()) for n in ("doc_ids", "doc_nulls", "doc_tokens", "ranked", "control", "data")])
    order = [F.col("_id").asc_nulls_first(), F.col("_tie")]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("_text"), F.xxhash64(F.col(text)).alias("_tie"))
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return written(ordered.select("_id", "_text").mapInArrow(run, SEGMENTS), "token-segments", "none")


def read_segments(segments: DataFrame) -> DataFrame:
    """One row per document: its segment, the ids before it there, and its own
    ids (uint32 little endian)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ranked"], "<u4")[unpack(row["control"], row["data"], row["n_tokens"])]
                doc_ids, tokens = np.frombuffer(row["doc_ids"], "<i8"), np.frombuffer(row["doc_tokens"], "<i8")
                gone, ends = np.frombuffer(row["doc_nulls"], np.uint8).astype(bool), np.cumsum(tokens)
                for i in range(0, len(doc_ids), 512):
                    n = len(doc_ids[i:i + 512])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(doc_ids[i:i + n], mask=gone[i:i + n]), pa.array([row["part"]] * n, pa.int32()),
                        pa.array([row["segment"]] * n, pa.int32()), pa.array((ends - tokens)[i:i + n]),
                        pa.array(tokens[i:i + n]),
                        pa.array([ids[e - t:e].tobytes() for e, t in zip(ends[i:i + n], tokens[i:i + n], strict=True)], pa.binary())],
                        ["doc_id", "part", "segment", "in_segment", "n_tokens", "ids"])

    return segments.mapInArrow(run, DOCUMENTS)


def with_starts(documents: DataFrame, segments: DataFrame) -> DataFrame:
    """Adds ``start``, the ids of all documents before each one.

    Two levels of running sums over the segments' totals (over the range
    partitions, one row each, then inside each); drop wide columns of
    ``documents`` first, as its rows are shuffled."""
    total = segments.select("part", "segment", F.col("n_tokens").alias("_total"))
    of_part = total.groupBy("part").agg(F.sum("_total").alias("_part_total"))
    before_part = of_part.select("part", (F.sum("_part_total").over(Window.orderBy("part")) - F.col("_part_total")).alias("_before_part"))
    before = total.join(before_part, "part").select(
        "part", "segment",
        (F.col("_before_part") + F.sum("_total").over(Window.partitionBy("part").orderBy("segment")) - F.col("_total")).alias("_before"))
    return (documents.join(before, ["part", "segment"])
            .withColumn("start", F.col("_before") + F.col("in_segment")).drop("_before"))
