"""Byte-level BPE encoding and decoding with the tiktoken library.

A rank file (base64 token, rank per line) and a split pattern define the
encoding; no special tokens are known, so their strings are ordinary text.

Whole texts are encoded. A text is first cut at *safe* boundaries: between a
character that is no white space and a single space that another such
character follows. Every alternative of the pattern stops at white space and
takes at most one space in front, so a match always ends at such a boundary
and the pieces encode to exactly the ids of the whole text. This keeps the
regex engine and the merge loop off megabyte strings, and lets repeated pieces
be looked up. Pieces without such a boundary are encoded whole, but for long
runs of white space, on which the library's regex engine would overflow its
stack: by the pattern a run is one match without its last character, or as a
whole where the text ends, so that match goes to the library's merge directly.

Defined results: null or empty text -> no ids, empty bytes; ids of any column
may be null and are passed on; repeated rows give repeated results; other
columns of the input are kept by :func:`encode` and :func:`decode` unless they
bear the name of the result column, which is replaced.
"""

from __future__ import annotations

import base64
import re
from itertools import chain

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from mercato.llm.common import Memo, by_batch

#: Between "x" and " y": no match of the pattern spans this point.
SAFE = re.compile(r"(?<=\S)(?= \S)")

#: A run of white space (as the pattern's engine knows it) too long to be left to that engine.
BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}")

#: Entries of the piece memo of one Python worker (about 30 MB).
MEMO_ENTRIES = 100_000

_CODECS: dict[tuple[str, str], Codec] = {}


def safe_pieces(text: str) -> list[str]:
    """Cut ``text`` where every tokenisation by the pattern has a boundary."""
    return SAFE.split(text)


class Codec:
    def __init__(self, rank_file: str, pattern: str):
        with open(rank_file, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}
        self.library = tiktoken.Encoding("local-ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.whole = tiktoken.Encoding("local-ranks-whole", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})  # one match
        self.memo = Memo(self.library.encode_ordinary, MEMO_ENTRIES)

    def encode(self, text: str) -> list[int]:
        ids, at = [], 0
        for run in BLANKS.finditer(text):
            end = run.end() - (run.end() < len(text))  # the last blank goes with what follows
            ids += chain(self.encode_words(text[at:run.start()]), self.whole.encode_ordinary(text[run.start():end]))
            at = end
        return [*ids, *self.encode_words(text[at:])] if ids else self.encode_words(text)

    def encode_words(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.memo.__getitem__, safe_pieces(text)))) if text else []

    def decode(self, ids: list[int]) -> bytes:
        """Raw bytes: a cut through a character stays as it is."""
        return self.library.decode_bytes(ids)


def codec(rank_file: str, pattern: str) -> Codec:
    """One codec per Python worker process."""
    if (rank_file, pattern) not in _CODECS:
        _CODECS[rank_file, pattern] = Codec(rank_file, pattern)
    return _CODECS[rank_file, pattern]


def _with(df: DataFrame, source: str, made: list[tuple[str, T.DataType, pa.DataType]], fn) -> DataFrame:
    """``df`` with the columns that ``fn`` makes of each batch of ``source``."""
    names = {name.lower() for name, _, _ in made}
    plain = df.select(*(f"`{c}`" for c in df.columns if c.lower() not in names or c == source))
    kept = [f for f in plain.schema.fields if f.name.lower() not in names]
    out = T.StructType(kept + [T.StructField(name, kind) for name, kind, _ in made])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = {n: i for i, n in enumerate(batch.schema.names)}
        columns = [pa.array(values, arrow) for values, (_, _, arrow) in zip(fn(batch.column(at[source]).to_pylist()), made, strict=True)]
        return pa.RecordBatch.from_arrays([*(batch.column(at[f.name]) for f in kept), *columns], [f.name for f in out.fields])

    return plain.mapInArrow(by_batch(run), out)


def _ids(name: str) -> tuple[str, T.DataType, pa.DataType]:
    return name, T.ArrayType(T.IntegerType(), False), pa.list_(pa.int32())


def _data(name: str) -> tuple[str, T.DataType, pa.DataType]:
    return name, T.BinaryType(), pa.binary()


def encode(df: DataFrame, rank_file: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the token ids (array<int>) of each whole text."""
    return _with(df, text, [_ids(ids)], lambda texts: [[codec(rank_file, pattern).encode(x or "") for x in texts]])


def decode(df: DataFrame, rank_file: str, pattern: str, ids: str = "ids", data: str = "decoded") -> DataFrame:
    """``df`` with the raw bytes that the ids stand for (null ids: empty)."""
    return _with(df, ids, [_data(data)], lambda rows: [[codec(rank_file, pattern).decode(x or []) for x in rows]])


def round_trip(df: DataFrame, rank_file: str, pattern: str, text: str = "text", ids: str = "ids", data: str = "decoded") -> DataFrame:
    """:func:`encode`, then :func:`decode` of its ids, in one pass."""

    def both(texts: list) -> list[list]:
        own = codec(rank_file, pattern)
        encoded = [own.encode(x or "") for x in texts]
        return [encoded, [own.decode(x) for x in encoded]]

    return _with(df, text, [_ids(ids), _data(data)], both)
