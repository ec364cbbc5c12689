"""From documents to token ids: five stages, each an operator of ``spokeline.llm``."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from spokeline.llm import exact_dedup, mixing, near_dedup, pieces, quality
from spokeline.session import scratch_root


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, from hosts that do."""
    return quality.passing(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the largest doc_id."""
    return exact_dedup.without_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by five-word shingles, the one with the smallest doc_id."""
    return near_dedup.representatives(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, or up to three times."""
    return mixing.mixed(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each text, and whether they decode to it: the training data."""
    coded = pieces.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"), with_ids=True)
    return coded.select("doc_id", "n_pieces", "ids_crc32", "round_trip", "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_duplicates),
    ("near_dedup", near_duplicates),
    ("mixing", mixing_sources),
    ("sentencepiece", sentencepiece),
]

# SentencePiece segmentation and links of near duplicates are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are stored before the next reads them."""
    folder = f"{scratch_root(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
