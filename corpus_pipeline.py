"""Corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

Columns other than those of ``documents`` are dropped by the first stage. An empty table passes through all stages; null
and blank texts go with the first. What each stage does with ties, repeated rows and long texts is that of its operator.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm import language_spans, odd_minhash, sentencepiece_bpe, source_mix, substring_dedup
from flowlens.session import staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
TOKENIZER = public_tokenizers.path("piece_bpe_32k.model")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their language as found: ``lang`` is what most of the words are labelled with, whatever it was before.
    Documents without text or letters go. If no row has a language, none is known, and ``lang`` stays null."""
    fitted = language_spans.fit(docs, F.col("doc_id"))
    if not fitted[0]:
        return docs.select(*COLUMNS).where(F.col("text").rlike(r"\p{L}"))
    found = language_spans.label(docs.select(*COLUMNS), fitted, out="found").where(F.col("found.lang") != language_spans.UNKNOWN)
    return found.withColumn("lang", F.col("found.lang")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies, one row of it. Rows without an id count as documents
    by their text, with ids behind the others; those without text stay."""
    blank = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    docs = docs.select(*COLUMNS)
    by_text = F.xxhash64("text").bitwiseAND((1 << 62) - 1) + F.lit(1 << 62)
    keyed = docs.where(F.col("doc_id").isNotNull() | ~blank).withColumn("key", F.coalesce("doc_id", by_text))
    found = odd_minhash.near_duplicates(keyed, key="key")
    first = found.where(F.col("key") == F.col("component")).select("key").distinct()
    kept = keyed.join(first, "key", "left_semi").dropDuplicates(["key", "text"]).select(*COLUMNS)
    return kept.unionByName(docs.where(F.col("doc_id").isNull() & blank))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has; texts that lose nothing stay as they are."""
    done = substring_dedup.without_repeats(docs.select(*COLUMNS), carry=("text", "lang", "source", "n_chars"))
    cut = F.col("n_removed") > 0
    return done.select("doc_id", F.when(cut, F.col("kept")).otherwise(F.col("text")).alias("text"), "lang", "source",
                       F.when(cut, F.length("kept").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents as often as the mix takes them."""
    docs = docs.select(*COLUMNS)
    _, _, blocks = source_mix.mix(docs, block_words=None)
    return source_mix.taken_rows(docs, blocks)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and the text that they decode to."""
    done = sentencepiece_bpe.round_trip(docs.select(*COLUMNS), TOKENIZER)
    return done.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language identification", identify_language),
    ("near duplicates", drop_near_duplicates),
    ("repeated passages", drop_repeated_passages),
    ("source mix", mix_sources),
    ("tokens", tokenize),
]

#: Models and tokenisers cannot be written in SQL; a test holds the rows of every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
