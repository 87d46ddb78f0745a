"""Corpus pipeline: toxicity, exact dedup, near dedup, mixing, BPE.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before
kept. All but the last return the columns of ``documents``; the last returns
the token digests of the mixed corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopscope.llm import exact_dedup, mixing, simhash, toxicity
from shopscope.llm.common import stage, table
from shopscope.llm.queries import bpe_digests, fold


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents scored at 0.5 or more go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: one row of each group of equal texts stays."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: one document of each SimHash component stays."""
    return simhash.drop_near_copies(docs, shingle=4, max_bits=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: every document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: ids of every document of the mix, and their decoding."""
    return bpe_digests(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_exact),
    ("simhash", drop_near),
    ("mixing", mix_sources),
    ("bpe", encode_tokens),
]

# A trained classifier and a tokenizer decide the rows; see tests/llm/test_corpus_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
