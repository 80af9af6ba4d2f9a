"""From raw documents to packed training sequences, a stage at a time.

Each stage takes all that its predecessor kept. A document that the quality classifier
rejects goes; of documents linked by five-word shingles at a similarity of 0.8 or more the
one with the smallest id stays; documents that hold a window of a benchmark item go; what
is left is cut into pieces and packed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from threadlake.llm import decontaminate, jaccard_join, packing, quality
from threadlake.llm.common import table, written

WORD_BPE = "word_bpe_49k.json"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs, jaccard_join.similar_classes(docs, words=5, percent=80))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"), window=10)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path(WORD_BPE), capacity=2048)


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("best-fit packing", packing_stage),
]

# Trained models, packing and the tokenizer have no SQL; brute-force tests hold each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    *first, (_, last) = STAGES
    for number, (_, stage) in enumerate(first):
        docs = written(stage(spark, docs, sf_dir), f"stage-{number}")
    return last(spark, docs, sf_dir)
