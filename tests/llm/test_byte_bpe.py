import base64
import hashlib

import public_tokenizers as P
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from mercato.llm import byte_bpe
from mercato.llm.queries import RANKS, digests, op2_byte_bpe
from pyspark.sql import functions as F

FILE = P.path(RANKS)


def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(FILE, "rb"))}
    return tiktoken.Encoding("plain", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def expected(text, enc):
    ids = enc.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab A1.'st \n\t  é日😀!  ")), max_size=60))
def test_pieces_encode_like_the_whole(text):
    own = byte_bpe.codec(FILE, P.PATTERN)
    assert "".join(byte_bpe.safe_pieces(text)) == text
    assert own.encode(text) == own.library.encode_ordinary(text)
    assert own.decode(own.encode(text)) == text.encode()


def test_query_equals_library_on_documents(llm):
    rows = {r.doc_id: r for r in op2_byte_bpe(llm, "/root/testdata/sf0.001").collect()}
    enc = library()
    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        r = rows[d.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expected(d.text, enc)


def test_odd_rows_and_clashing_columns(llm, make_docs, odd_texts):
    docs = make_docs(odd_texts, [None, *range(1, len(odd_texts))]).withColumn("ids", F.lit("clash")).withColumn("decoded", F.lit(1)).withColumn("rid", F.lit(2))
    out = byte_bpe.decode(byte_bpe.encode(docs, FILE, P.PATTERN), FILE, P.PATTERN)
    assert {"doc_id", "text", "rid", "ids", "decoded"} <= set(out.columns) and len(out.columns) == len(set(out.columns))
    enc = library()
    for r in out.collect():
        assert r.ids == enc.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    assert byte_bpe.encode(make_docs([]), FILE, P.PATTERN).count() == 0
    null = digests(byte_bpe.round_trip(make_docs([None]), FILE, P.PATTERN)).first()
    assert null.n_tokens == 0 and null.ids_sha256 == hashlib.sha256(b"").hexdigest() == null.decoded_sha256


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["ab", "1", "'s", ".", " ", "  ", "\n", "\t", " ", "\x1c", "　", " " * 1001, "\n" * 1000, " \t" * 700]), max_size=12))
def test_long_blanks_encode_like_the_whole(parts):
    own = byte_bpe.codec(FILE, P.PATTERN)
    assert own.encode("".join(parts)) == own.library.encode_ordinary("".join(parts))


def test_two_million_blanks(llm, make_docs):
    """Longer than the library's regex engine takes: the run is one match, but
    for its last character where a text goes on."""
    own = byte_bpe.codec(FILE, P.PATTERN)
    for unit in (" ", "\n", "\t", " \n\t "):
        run = unit * (2_000_000 // len(unit))
        assert own.encode(run) == own.whole.encode_ordinary(run)
        assert own.encode(f"x{run}y") == own.library.encode_ordinary("x") + own.whole.encode_ordinary(run[:-1]) + own.library.encode_ordinary(run[-1] + "y")
    texts = [" " * 2_000_000, "x" + "\n" * 2_000_000 + "y"]
    rows = byte_bpe.round_trip(make_docs(texts), FILE, P.PATTERN).select("text", F.col("decoded").cast("string").alias("back"))
    assert rows.where("text = back").count() == 2
