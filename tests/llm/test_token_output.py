import zlib

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from mercato.llm import token_output as t
from mercato.llm.queries import END_ID, WORDS, op10_token_output
from pyspark.sql import functions as F

FILE = P.path(WORDS)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300) | st.integers(60_000, 70_000), max_size=50))
def test_packing_round_trip(values):
    control, data = t.pack(np.array(values, np.uint32))
    assert len(control) == -(-len(values) // 4)
    assert len(data) == sum(max(1, (v.bit_length() + 7) // 8) for v in values)
    assert t.unpack(control, data, len(values)).tolist() == values


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abA1.'st \n\t\r  é́日😀!  <|endoftext|>İŉΣςßﬁẞǅ\u0307\u0308\u0130²٣")), max_size=40))
def test_chunks_encode_like_the_whole(text):
    whole = Tokenizer.from_file(FILE).encode(text, add_special_tokens=False).ids if text else []
    assert t.encode_text(t.chunk_codec(FILE), text.encode(), END_ID).tolist() == whole + [END_ID]


def check(rows, docs):
    tokenizer, at = Tokenizer.from_file(FILE), 0
    rows = sorted(rows, key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((d.doc_id for d in docs), key=lambda x: (x is not None, x))
    left = {}
    for d in docs:
        ids = np.array(tokenizer.encode(d.text or "", add_special_tokens=False).ids + [END_ID], "<u4")
        left.setdefault(d.doc_id, []).append((len(ids), zlib.crc32(ids.tobytes())))
    for r in rows:
        assert r.start == at
        left[r.doc_id].remove((r.n_tokens, r.ids_crc32))
        at += r.n_tokens


def test_query_equals_library_on_documents(llm):
    check(op10_token_output(llm, "/root/testdata/sf0.001").collect(), llm.read.parquet("/root/testdata/sf0.001/documents.parquet").collect())


def test_odd_rows(llm, make_docs, odd_texts, folder, monkeypatch):
    monkeypatch.setattr(t, "SEGMENT_TOKENS", 50)
    docs = make_docs(odd_texts + ["tie one", "tie two"], [None, *range(1, len(odd_texts)), 5, 5]).withColumn("part", F.lit(1)).withColumn("n_tokens", F.lit("x"))
    check(op10_token_output(llm, folder(documents=docs)).collect(), docs.collect())
    assert op10_token_output(llm, folder(documents=make_docs([]))).count() == 0


def test_segment_file_ranks_ids_by_frequency():
    row = t.segment_row(0, 0, [7, None], [np.array([9, 9, 5, 2], np.uint32), np.array([9, 2], np.uint32)])
    assert np.frombuffer(row["ranked"], "<u4").tolist() == [9, 2, 5]
    assert t.unpack(row["control"], row["data"], row["n_tokens"]).tolist() == [0, 0, 2, 1, 0, 1]
