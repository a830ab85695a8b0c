"""A training-data pipeline over the documents: each stage works on what the one before has kept.

An empty table passes through all stages; other columns are carried along up to the last, and texts are taken whole at any length.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrimlens.llm.common import written
from scrimlens.llm.exact import drop_copies
from scrimlens.llm.ngram_join import keep_one
from scrimlens.llm.packing import pack
from scrimlens.llm.substrings import drop_repeats
from scrimlens.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the lexicon, learned from the labels of these documents, predicts toxic.

    Null and empty texts are not toxic and stay; without labels all stay. Of rows under one id all go if one of them is toxic.
    """
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest doc_id stays, a null id being the smallest and a null text empty; an id that several texts carry
    keeps those of them that are no copies."""
    return drop_copies(docs, keep="min")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.75 or more over five-word shingles the smallest doc_id stays. Texts without
    words are linked with nothing and stay."""
    return keep_one(docs, size=5, share=75, of=100)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 20 words or more that start earlier elsewhere leave the text; no document leaves. A null text stays null."""
    return drop_repeats(docs, window=20).withColumn("n_chars", F.length("text").cast("long"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens, as one row per piece; a null or empty text is its end token alone."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, capacity=2048)


STAGES = [
    ("toxicity", toxicity), ("exact_dedup", exact_dedup), ("ngram_join", near_dedup), ("substring_dedup", substring_dedup), ("packing", packing),
]

#: Toxicity, the similarity join and tokens have no SQL; the tests run the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each stage is written to the shared folder before the next begins."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
