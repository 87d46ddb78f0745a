"""The registered queries: thin wrappers that apply each operator, with
production parameters, to its whole table and derive the contract's columns."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, exact_dedup, licenses, lexical, lm_score, mixing, phrases, pii, quality, simhash, toxicity, url_filter
from .common import free_name, stage, table


def tokenizer_path() -> str:
    """Tokenizer file: $BPE_TOKENIZER, else the installed public vocabulary."""
    if "BPE_TOKENIZER" in os.environ:
        return os.environ["BPE_TOKENIZER"]
    from public_tokenizers import path
    return path("byte_bpe_50k.json")


def fold(doc_id: str, folds: int):
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds))


# (host, path, verdict): the registered rule set.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.quality_scores(docs, table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)
    return scored.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, url_filter.rule_table(spark, URL_RULES)) \
        .select("page_id", "host", "path", "rule", "verdict")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=4, max_bits=4) \
        .select("doc_id", "fingerprint", "component_id")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ann.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.expr("vec_id % 100 = 0"), k=10)
    return found.select("query_id", "rank", "vec_id", "score")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scan(docs, licenses.train(docs))
    return found.select("doc_id", "paragraphs", F.size("found").cast("bigint").alias("n_found"),
                        F.array_join(F.sort_array(F.array_distinct("found.family")), ",").alias("families"),
                        F.array_join(F.transform("found", lambda x: F.concat_ws(":", x["family"], x["start"],
                                                                                x["end"])), ",").alias("spans"))


def bpe_digests(docs: DataFrame) -> DataFrame:
    path = tokenizer_path()
    return bpe.encode(docs, path, decoded=True).select(
        "doc_id", F.expr("CAST(length(ids) / 4 AS BIGINT)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.toxicity_scores(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = stage(table(spark, sf_dir, "documents")
                  .select("doc_id", "source", mixing.word_count("text").alias("size")), "sizes")
    return mixing.mix(sized).select("doc_id", "size", "source_size", "target", "taken")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.extract(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size("base") - F.size(F.array_remove(kinds, k))).cast("bigint").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"),
                        pii.joined(F.col("spans")).alias("spans"))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lexical.rank_documents(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                   table(spark, sf_dir, "benchmark"), k=20)
    return found.select("item_id", "rank", "doc_id", "score")


def op12_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(fold("doc_id", 5) == 1, F.lit(False))
    scored = lm_score.fit(docs, ~held_out).scores()
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("lang", "text")
    return phrases.collocations(phrases.frequent_phrases(docs, min_count=100, max_words=5),
                                top=2000, contained_percent=100)


QUERIES = {f.__name__: f for f in (op1_quality, op2_url_filter, op3_simhash, op4_exact_dedup, op5_ann, op6_licenses,
                                    op7_bpe, op8_toxicity, op9_mixing, op10_pii, op11_lexical, op12_lm_score, op13_phrases)}
