"""The registered queries: each operator over its whole table, reduced to the
columns that are compared."""

from __future__ import annotations

import zlib

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm import byte_bpe, decontaminate, html_extract, interpolated_lm, kdtree, line_dedup, periodic_runs, prefix_trie, quality, simhash, suffix_dedup, token_output, toxicity
from mercato.llm.common import by_batch, prepare, remainder, table, utf8

RANKS, WORDS = "byte_bpe_multi_50k.tiktoken", "word_bpe_49k.json"
END_ID = 2


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), lambda c: remainder(c, 5) != 0)
    scored = toxicity.score(docs, model)
    worst = F.expr("array_max(transform(offending, x -> named_struct('p', x.p, 'begin', x.begin, 'end', x.end)))")
    return scored.withColumn("_worst", worst).select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
        F.size("offending").alias("n_offending"), F.col("_worst.begin").alias("worst_begin"), F.col("_worst.end").alias("worst_end"), F.col("_worst.p").alias("worst_p"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    ranks, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    return digests(byte_bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, pattern))


def digests(coded: DataFrame) -> DataFrame:
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("rid")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"), lambda c: remainder(c, 3) != 1)
    return quality.score(docs, model).select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.5).cast("int").alias("predicted"))


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return kdtree.top_k(table(spark, sf_dir, "embeddings"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", F.octet_length("_text").cast("long").alias("n_bytes"), F.expr("aggregate(removed, 0L, (n, x) -> n + x.end - x.begin)").alias("n_removed"),
                      F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_interpolated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return interpolated_lm.score(table(spark, sf_dir, "documents"))


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    segments = token_output.write_segments(table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS), END_ID)
    read = token_output.read_segments(segments).select("doc_id", "part", "segment", "in_segment", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    return token_output.with_starts(read, segments).select("doc_id", "start", "n_tokens", "ids_crc32")


def rebuilt(seqs: DataFrame) -> DataFrame:
    """Every conversation c with its first h = crc32(c) % 9 turns exchanged for
    those of conversation c - c % 5 (all if it has fewer, none if it is absent)."""
    head = seqs.where("conv_id % 5 = 0").select(F.col("conv_id").alias("_base"), F.slice("turns", 1, 8).alias("_head"))
    own = seqs.withColumn("_h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int"))
    return own.join(head, F.expr("conv_id - conv_id % 5 = _base"), "left").select(
        "conv_id", F.expr("concat(slice(coalesce(_head, slice(turns, 1, 0)), 1, _h), slice(turns, _h + 1, size(turns)))").alias("turns"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return prefix_trie.prefix_trie(rebuilt(prefix_trie.sequences(table(spark, sf_dir, "conversations"))))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    left = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_lines", F.size("dropped").cast("long").alias("n_dropped"), F.sha2("kept", 256).alias("kept_sha256"))


def with_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text): a tenth of the texts get a periodic tail, word a + (i - a) % p
    at every place i >= a, where h = crc32 of the id, g = h // 10, a = g % n and
    p = 1 + (n - a) // (3 + g % 8); the others stay as they are."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        for key, data in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
            h = zlib.crc32(b"" if key is None else str(key).encode())
            if h % 10 == 0 and (words := data.split()):
                g, n = h // 10, len(words)
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                data = b" ".join(words[:a] + [words[a + i % p] for i in range(n - a)])
            texts.append(data)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "text"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(by_batch(run), "doc_id long, text string")


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = periodic_runs.find_runs(with_tails(table(spark, sf_dir, "documents").select("doc_id", "text")))
    longest = F.expr("array_max(transform(runs, x -> named_struct('length', x.length, 'start', -x.start, 'period', -x.period)))")
    return found.withColumn("_best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_best.start")).alias("start"), F.col("_best.length").alias("length"), (-F.col("_best.period")).alias("period"),
        F.expr("1000 * _best.length div -_best.period").alias("exponent_milli"),
        F.sha2(F.expr("array_join(transform(runs, x -> concat(x.start, ',', x.length, ',', x.period, '\n')), '')"), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_byte_bpe, op3_simhash, op4_decontamination, op5_quality, op6_top_k, op7_suffix_dedup, op8_html, op9_interpolated_lm, op10_token_output,
    op11_prefix_trie, op12_line_dedup, op13_runs)}



def lowered(x: str) -> str:
    """SQL that lowers A-Z only."""
    return f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


#: crc32 of the id's decimal digits: a table by byte, then one step a digit.
CRC32 = """
steps(b, k, v) AS (
    SELECT b, 0, b FROM range(256) t(b)
    UNION ALL
    SELECT b, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM steps WHERE k < 8
), digits(id, s, k, c) AS (
    SELECT DISTINCT {id}, CAST({id} AS VARCHAR), 0, CAST(4294967295 AS BIGINT) FROM {table}
    UNION ALL
    SELECT d.id, d.s, d.k + 1, xor(d.c // 256, t.v)
    FROM digits d JOIN steps t ON t.k = 8 AND t.b = xor(d.c % 256, ascii(substr(d.s, d.k + 1, 1))) WHERE d.k < length(d.s)
), crc AS (SELECT id, xor(c, 4294967295) AS h FROM digits WHERE k = length(s))"""


ORACLES = {
    "op6_top_k": """
WITH v AS (
    SELECT vec_id, [floor(256 * x::DOUBLE) for x in embedding] AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
    SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id
    WHERE a.vec_id % 50 = 0
), r AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op11_prefix_trie": f"""
WITH RECURSIVE {CRC32.format(id="conv_id", table="conversations")}, told AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS k, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
), held AS (
    SELECT conv_id, count(*) AS turns FROM told GROUP BY conv_id
), convs AS (
    SELECT c.id, c.id - c.id % 5 AS base, h % 9 AS h, least(h % 9, coalesce(turns, 0)) AS taken FROM crc c LEFT JOIN held ON conv_id = c.id - c.id % 5
), rebuilt AS (
    SELECT id, k AS d, role, text FROM convs JOIN told ON conv_id = base AND k <= h
    UNION ALL
    SELECT id, taken + k - h, role, text FROM convs JOIN told ON conv_id = id AND k > h
), paths AS (
    SELECT id, d, strlen(text) AS bytes, string_agg(sha256(strlen(role) || ':' || role || text), '') OVER (PARTITION BY id ORDER BY d ROWS UNBOUNDED PRECEDING) AS path FROM rebuilt
    UNION ALL
    SELECT id, 0, 0, '' FROM convs
), nodes AS (
    SELECT path, d, min(id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes FROM paths GROUP BY path, d
), ends AS (
    SELECT path, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS ids FROM (SELECT * FROM paths QUALIFY row_number() OVER (PARTITION BY id ORDER BY d DESC) = 1) GROUP BY path
), children AS (
    SELECT left(path, 64 * (d - 1)) AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1
), below AS (
    SELECT left(path, 64 * up) AS path, count(*) FILTER (WHERE n IS NULL) AS n_leaves, sum((n_convs - 1) * bytes) AS saved_tokens
    FROM (SELECT nodes.*, n, unnest(range(d + 1)) AS up FROM nodes LEFT JOIN children USING (path)) GROUP BY 1
)
SELECT x.conv_id, x.d AS depth, p.conv_id AS parent_conv_id, x.n_convs, coalesce(n, 0) AS n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes x JOIN below ON below.path = x.path LEFT JOIN children c ON c.path = x.path LEFT JOIN ends e ON e.path = x.path
LEFT JOIN nodes p ON p.d = x.d - 1 AND p.path = left(x.path, 64 * (x.d - 1))
""",
    "op12_line_dedup": f"""
WITH cut AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n FROM documents
), keyed AS (
    SELECT *, {lowered("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM cut
), shared AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
    SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.keeper AS gone FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
""",
    "op13_runs": f"""
WITH RECURSIVE {CRC32.format(id="doc_id", table="documents")}, split AS (
    SELECT doc_id, h % 10 = 0 AS tail, h // 10 AS g, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents JOIN crc ON doc_id = id
), cut AS (
    SELECT *, len(w) AS n, CASE WHEN tail AND len(w) > 0 THEN g % len(w) END AS a FROM split
), periods AS (
    SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM cut
), words AS (
    SELECT doc_id, n, i, w[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END] AS word FROM (SELECT *, unnest(range(n)) AS i FROM periods)
), equal AS (
    SELECT x.doc_id, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), stretches AS (
    SELECT doc_id, q, min(i) AS start, count(*) + q AS length
    FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal) GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)
), runs AS (
    SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY ALL
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
), listed AS (
    SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs FROM runs GROUP BY doc_id
), best AS (
    SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM documents LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
""",
}
