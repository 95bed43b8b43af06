"""Training-data pipeline over ``documents``.

Each stage takes the rows its predecessor kept, calls one operator of
``mercato.llm`` and applies its decision; ``run`` chains them. All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm import byte_bpe, decontaminate, simhash, suffix_dedup, toxicity
from mercato.llm.common import discard, intermediates, prepare, row_key, table, written
from mercato.llm.queries import RANKS, digests

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose noisy-or score stays below 0.5; the model may learn from every label."""
    prepare(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), lambda _: F.lit(True))
    return toxicity.score(docs.select(*COLUMNS), model).where("toxicity < 0.5").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the row with the smallest id (null: after all
    others), of rows that share it the one with the smallest key of its content;
    of equal texts with one id the smallest row."""
    prepare(spark)
    keep = simhash.first_rows(docs).select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"))
    keyed = docs.select(*COLUMNS, row_key("doc_id", "text").alias("key"))
    kept = keyed.join(keep, (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    return kept.groupBy("doc_id", "key").agg(F.min(F.struct(*COLUMNS[1:])).alias("row")).select("doc_id", "row.*").select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 200-byte strings that repeat; a character that a cut
    splits goes with it. Documents stay, even if nothing is left of them."""
    prepare(spark)
    cut = suffix_dedup.remove_repeats(docs.select(*COLUMNS), as_text=True)
    return cut.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, copied or re-parameterised."""
    prepare(spark)
    return decontaminate.without_leaks(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, and proof that they decode to it."""
    prepare(spark)
    ranks, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    return digests(byte_bpe.round_trip(docs.select("doc_id", "text"), ranks, pattern))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_leaks),
    ("byte_level_bpe", encode),
]

#: Trained weights, shingle hashes and merges can't be said in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what each returns is written as Parquet and read again. Once
    that is done the tables that the stage worked with are removed, the one it
    read included, so the shared folder holds one stage's tables at a time. What
    the last stage reads stays; ``intermediates()`` names it."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    others = set(intermediates())
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}", "snappy")
        *worked_with, _ = intermediates()
        discard(spark, [path for path in worked_with if path not in others])
    return STAGES[-1][1](spark, docs, sf_dir)
