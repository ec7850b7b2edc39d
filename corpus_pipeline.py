"""A training corpus from raw documents, in five stages.

quality classifier -> exact dedup -> n-gram Jaccard join -> mixing to target
weights -> BPE encoding. ``run`` writes each stage to the shared folder and reads
it back as the next one's documents, so a lost executor costs a stage's tasks at
most. A stage drops the rows it rejects, mixing repeats those it takes more than
once, and the last stage gives token ids, the text decoded from them, the number of tokens
and the digests of ids and text for each row.

Nulls, empty texts, repeated rows and empty tables are handled as the operators'
docstrings say; extra columns of ``documents`` pass through all but the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import bpe, common, exact_dedup, jaccard, mixing, quality
from ledgerline.session import stage

VOCABULARY = "byte_bpe_50k.json"


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_quality(docs, common.table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.prepare(spark)
    return jaccard.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeat_to_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.prepare(spark)
    return bpe.with_digests(bpe.encode_decode(docs, public_tokenizers.path(VOCABULARY)))


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: The discriminant, the join and the encoding have no SQL form; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
