"""The corpus pipeline: from documents to packed training sequences.

Each stage is written as Parquet below the folder that all executors share and read
again as the next one's documents, so a lost executor never costs a finished stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import jaccard, packing, quality, store, toxicity


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are long enough and not made of repetition."""
    return quality.keep_good(docs)


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, learned from the labels of those at hand, calls not toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_civil(docs, toxicity.fit(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles."""
    return jaccard.keep_one_of_each(docs, words=5, percent=80)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, placed in sequences of 2048.

    The pieces with their ids are kept as a table; only small columns are packed.
    """
    pieces = packing.write_pieces(packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("toxicity", civil),
    ("n-gram Jaccard join", near_duplicates),
    ("best-fit packing", packed),
]

# The classifier and the packing have no SQL form; tests hold the stages against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the rows of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store.written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
