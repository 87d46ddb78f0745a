"""The corpus pipeline against a brute-force version of every stage."""

import hashlib

import numpy as np

import corpus_pipeline
from shopscope.llm import toxicity
from shopscope.llm.common import stage
from conftest import SMALL
from test_documents import EDGE, SCHEMA, brute_components, library_digests, normal, plain_fingerprint


def run_stages(spark, docs, sf_dir):
    out = [docs]
    for name, step in corpus_pipeline.STAGES:
        out.append(stage(step(spark, out[-1], sf_dir), name))
    return out


def by_row(df):
    return sorted(tuple(r) for r in df.select("doc_id", "text", "lang", "source").collect())


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    raw, clean, exact, near, mixed, tokens = run_stages(spark, docs, SMALL)
    for df in (clean, exact, near, mixed):
        assert df.columns == docs.columns

    scored = toxicity.toxicity_scores(docs, spark.read.parquet(f"{SMALL}/labels.parquet"),
                                      corpus_pipeline.fold("doc_id", 5) != 0).collect()
    assert by_row(clean) == sorted((r["doc_id"], r["text"], r["lang"], r["source"]) for r in scored if r["score"] < 0.5)

    first = {}
    for row in by_row(clean):
        first.setdefault(normal(row[1]), row)
    assert by_row(exact) == sorted(first.values())

    rows = by_row(exact)
    comp = brute_components([plain_fingerprint(r[1]) for r in rows])
    least = {}
    for row, c in zip(rows, comp):
        least.setdefault(c, row)
    assert by_row(near) == sorted(least.values())

    counts = {}
    for r in by_row(mixed):
        counts[r] = counts.get(r, 0) + 1
    assert set(counts) <= set(by_row(near)) and max(counts.values()) <= 3

    want = [(r[0], *d) for r, d in zip(by_row(mixed), library_digests([r[1] for r in by_row(mixed)]))]
    assert sorted(tuple(r) for r in tokens.collect()) == sorted(want)


def test_run_is_repeatable(spark):
    a, b = (sorted(tuple(r) for r in corpus_pipeline.run(spark, SMALL).collect()) for _ in range(2))
    assert a == b and len(a) > 100


def test_stages_on_edge_rows_and_empty_table(spark):
    for rows in (EDGE, []):
        docs = spark.createDataFrame(rows, SCHEMA)
        out = run_stages(spark, docs, SMALL)
        assert out[-1].columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        for row in out[-1].collect():
            assert row["n_tokens"] > 0 or row["decoded_sha256"] == hashlib.sha256(b"").hexdigest()


def test_mixing_stage_comes_near_its_targets(spark):
    from shopscope.llm import mixing
    from conftest import MEDIUM
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    sized = docs.select("doc_id", "source", mixing.word_count("text").alias("size"))
    rows = mixing.mix(sized).groupBy("source").agg({"taken": "sum", "target": "max", "size": "max"}).collect()
    for r in rows:
        assert abs(r["sum(taken)"] - r["max(target)"]) <= max(0.1 * r["max(target)"], 2 * r["max(size)"])
    assert np.isfinite([r["max(target)"] for r in rows]).all()
