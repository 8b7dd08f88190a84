"""Corpus pipeline: filter, deduplicate, redact, mix and tokenize the documents.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its result is written as Parquet into the
shared checkpoint folder and read again as the next stage's documents. All stages but the last return the columns of
documents; the mix repeats a row as often as it takes the document; the last returns token ids instead of the text.
Nulls, empty texts, repeated rows and empty tables are handled as each operator's module states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from llm import bpe, mixing, near_dup, pii, quality
from llm.common import staged

STAGES = [
    ("quality_classifier", quality.accepted),
    ("minhash_near_dedup", near_dup.keep_one),
    ("pii", pii.redacted),
    ("mix_to_target_weights", mixing.mixed),
    ("byte_bpe", bpe.tokenized),
]

#: Signatures, learned scorers and token merges have no SQL form; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs, name)
    return docs
