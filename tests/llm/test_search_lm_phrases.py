"""Ranked search, LM scoring and phrase mining against plain versions."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopscope.llm import lexical, lm_score, ngrams, phrases
from shopscope.llm.queries import QUERIES, fold

from conftest import SMALL
from test_documents import EDGE, SCHEMA

ITEMS = "item_id bigint, text string"


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


@pytest.fixture(scope="module")
def edge(spark):
    df = spark.createDataFrame(EDGE, SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in ("rank", "score", "n", "item", "tf", "phrase", "Chunk", "k")})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# -- ranked search -------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_ranking(docs, items, k):
    counted = [(i, Counter(TERM.findall(ascii_lower(t or "")))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    total_docs, total_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item_id, text in dict.fromkeys(items):
        query = Counter(TERM.findall(ascii_lower(text or "")))
        scored = []
        for doc_id, c in counted:
            m = 100 - 25 + (25 * sum(c.values()) * total_docs) // total_terms
            s = sum(q * math.floor(1000 * math.log((2 * total_docs + 2) / (2 * df[t] + 1)))
                    * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t, q in query.items() if t in c)
            if s > 0:
                scored.append((-s, doc_id is None, doc_id))
        out += [(item_id, r, d, -s) for r, (s, _, d) in enumerate(sorted(scored)[:k], 1)]
    return out


def ranking(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def test_ranking_is_the_same_for_any_blocks_and_tiles(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    items += [(None, "The THE the of"), (7, None), (8, " .,"), (8, " .,"), items[0], (9, "of " * 400)]
    table = spark.createDataFrame(items, ITEMS).repartition(3)
    want = sorted(plain_ranking([(r[0], r[1]) for r in docs.select("doc_id", "text").collect()], items, 7), key=repr)
    assert ranking(lexical.rank_documents(docs, table, k=7)) == want
    small = lexical.rank_documents(docs.repartition(5), table, k=7, block_items=16, block_bytes=900, tile_terms=5,
                                   tile_docs=13)
    assert ranking(small) == want


def test_search_edge_rows_and_empty_tables(spark, edge, empty):
    items = [(1, "a word3 x7"), (2, "id here café 你好"), (2, "another"), (3, None), (None, "D e")]
    table = spark.createDataFrame(items, ITEMS)
    want = sorted(plain_ranking([(r[0], r[1]) for r in EDGE], items, 3), key=repr)
    assert ranking(lexical.rank_documents(edge, table, k=3)) == want
    assert lexical.rank_documents(empty, table).collect() == []
    assert lexical.rank_documents(edge, table.where("false")).collect() == []


def test_heavy_weights_are_split_below_the_bound():
    block = [(0, Counter({b"a": 7, b"b": 1})), (1, Counter({b"a": 1}))]
    tiles = list(lexical.weight_tiles(block, [10, 3], {b"a": 0, b"b": 1}, 2, bound=16))
    total = np.zeros((2, 2))
    for terms, weights in tiles:
        assert len(terms) <= 2 and weights.sum(axis=1).max() <= 16
        for column, t in enumerate(terms):
            total[:, t] += weights[:, column]
    assert total.tolist() == [[70, 3], [10, 0]]


def test_terms_of_long_texts_in_pieces(monkeypatch):
    text = (" ".join(f"w{i % 91}é" for i in range(3000)) + "z" * 5000 + " A.b").encode()
    whole = lexical.term_counts(text)
    monkeypatch.setattr(lexical, "PIECE", 64)
    assert lexical.term_counts(text) == whole == Counter(
        t.encode() for t in TERM.findall(ascii_lower(text.decode())))


# -- LM scoring -----------------------------------------------------------------

def lm_tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or "")) + [None]


def plain_lm(docs, order, train, deleted):
    """Scores by dictionaries; docs: (id, text); train, deleted: a flag for each."""
    rows = [lm_tokens(t) for _, t in docs]

    def counts(use):
        c = Counter()
        for toks, ok in zip(rows, use):
            if ok:
                for n in range(1, order + 1):
                    c.update((n, *toks[i:i + n]) for i in range(len(toks) - n + 1))
        types = sum(1 for g in c if g[0] == 1)
        return c, types, sum(v for g, v in c.items() if g[0] == 1)

    def levels(toks, i, c, types, total):
        """(order, bucket, estimate) of the orders with a seen context."""
        if total:
            yield 1, 0, c[1, toks[i]] / total
        for n in range(2, order + 1):
            if i >= n - 1:
                context = c[(n - 1, *toks[i - n + 1:i])]
                if context:
                    yield n, min(int(math.log2(context)), 47), c[(n, *toks[i - n + 1:i + 1])] / context

    def prob(toks, i, c, types, total, weights, upto):
        p = 1 / (types + 1)
        for n, b, high in levels(toks, i, c, types, total):
            if n <= upto:
                w = weights[n, b]
                p = w * high + (1 - w) * p
        return p

    kept = counts([t and not d for t, d in zip(train, deleted)])
    weights = defaultdict(lambda: 0.5)
    for n in range(1, order + 1):
        seen = defaultdict(list)
        for toks, t, d in zip(rows, train, deleted):
            if t and d:
                for i in range(len(toks)):
                    for m, b, high in levels(toks, i, *kept):
                        if m == n:
                            seen[n, b].append(high / prob(toks, i, *kept, weights, n - 1))
        for key, ratios in seen.items():
            r = np.array(ratios)
            with np.errstate(divide="ignore"):
                r = np.where(r > 0, np.exp2(np.round(np.log2(r) * 8) / 8), 0.0)
            weights[key] = lm_score.expectation_maximisation(r, np.ones(len(r)))
    full = counts(train)
    c, types, total = full
    out = []
    for toks in rows:
        out.append((len(toks), sum(c[1, t] > 0 for t in toks), total,
                    sum(math.log10((c[1, t] + 0.5) / (total + 0.5 * (types + 1))) for t in toks),
                    sum(math.log10(prob(toks, i, *full, weights, order)) for i in range(len(toks)))))
    return out


@pytest.mark.parametrize("order,chunk_tokens", [(2, 700), (3, 1 << 20)])
def test_lm_scores_equal_the_plain_model(spark, order, chunk_tokens):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").repartition(3)
    train = fold("doc_id", 5) != 1
    deleted = F.pmod(F.xxhash64("doc_id", "text"), F.lit(lm_score.HOLD_OUT)) == 0
    rows = docs.select("doc_id", "text", train.alias("t"), deleted.alias("d")).collect()
    want = sorted(zip([r[0] for r in rows], plain_lm([(r[0], r[1]) for r in rows], order, [r[2] for r in rows],
                                                    [r[3] for r in rows])))
    model = lm_score.fit(docs, train, order=order, chunk_tokens=chunk_tokens)
    got = sorted((r["doc_id"], tuple(r)[1:]) for r in model.scores().collect())
    assert [(i, x[:3]) for i, x in got] == [(i, x[:3]) for i, x in want]
    np.testing.assert_allclose([x[3:] for _, x in got], [x[3:] for _, x in want], rtol=1e-9)
    assert all(((0 < w) & (w < 1)).all() for w in model.weights) and len(model.weights) == order


def test_lm_query_beats_the_base_on_held_out_documents(spark):
    got = QUERIES["op12_lm_score"](spark, "/root/testdata/sf0.01").where("held_out")
    held = got.agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert held["b"] < held["s"] < 0


def test_lm_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([(i, random.Random(i).choice(["x y", "y x x", "x", "y y z"])) for i in range(60)],
                                 "doc_id bigint, text string")
    model = lm_score.fit(docs, F.lit(True))
    types = 4  # x, y, z, the end
    base = [(100, t) for t in ("x x", "x y", "x z", "x", "x q")]  # every next token after x, and an unseen one
    scored = lm_score.fit(docs.union(spark.createDataFrame(base, "doc_id bigint, text string")),
                          F.col("doc_id") < 100)
    assert [a.round(12).tolist() for a in scored.weights] == [a.round(12).tolist() for a in model.weights]
    p = [x for x in scored.placed.collect()]
    assert all(r["stats"][2] == types for r in p)
    counts = [np.concatenate([ngrams.from_planes(r["counts"][n]) for r in p]) for n in range(2)]
    assert counts[0].max() > counts[1].max() > 0


def test_lm_edge_rows_and_empty_table(spark, edge, empty):
    got = lm_score.fit(edge, fold("doc_id", 5) != 1).scores().collect()
    train = [i is not None and __import__("zlib").crc32(str(i).encode()) % 5 != 1 for i, *_ in EDGE]
    total = sum(len(lm_tokens(r[1])) for r, t in zip(EDGE, train) if t)
    assert sorted((r["doc_id"] or 0, r["n_tokens"], r["train_tokens"]) for r in got) == sorted(
        (r[0] or 0, len(lm_tokens(r[1])), total) for r in EDGE)
    assert sum(r["doc_id"] is None for r in got) == 3 and all(math.isfinite(r["score"]) for r in got)
    assert lm_score.fit(empty, F.lit(True)).scores().collect() == []
    untrained = lm_score.fit(edge, F.lit(None).cast("boolean")).scores().collect()
    assert {(r["score"], r["base_score"], r["train_tokens"], r["n_known"]) for r in untrained} == {(0.0, 0.0, 0, 0)}


# -- phrases --------------------------------------------------------------------

def plain_counts(docs, max_words):
    f, n = Counter(), Counter()
    for lang, text in docs:
        for piece in re.split("[.,;:!?\x0A-\x0D]", ascii_lower(text or "")):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            f.update((lang or "und", k, " ".join(w[i:i + k])) for k in range(1, max_words + 1)
                     for i in range(len(w) - k + 1))
    return f, n


def plain_collocations(f, n, min_count, percent):
    f = {key: c for key, c in f.items() if c >= min_count}
    out = []
    for (lang, k, p), a in f.items():
        w = p.split(" ")
        inside = [c for (lg, m, q), c in f.items() if lg == lang and m > k and f" {p} " in f" {q} "]
        if k < 2 or any(100 * c >= percent * a for c in inside):
            continue
        cuts = [(f[lang, j, " ".join(w[:j])], f[lang, k - j, " ".join(w[j:])]) for j in range(1, k)]
        score, _, x, y = min((1000 * a * n[lang] // (x * y), j, x, y) for j, (x, y) in enumerate(cuts))
        out.append((lang, -score, -a, p.encode(), a, x, y, n[lang]))
    ranks = Counter()
    for lang, score, _, p, a, x, y, total in sorted(out):
        ranks[lang] += 1
        yield lang, ranks[lang], p.decode(), a, x, y, total, -score


@pytest.mark.parametrize("shards,slots,chunk_tokens", [(3, 1 << 20, 1500), (5, 64, 400), (1, 1 << 12, 1 << 20)])
def test_phrases_equal_plain_counts(spark, shards, slots, chunk_tokens):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(90).repartition(4)
    rows = [(r["lang"], r["text"]) for r in docs.collect()]
    f, n = plain_counts(rows, 4)
    counts = phrases.frequent_phrases(docs, min_count=6, max_words=4, shards=shards, slots=slots,
                                      chunk_tokens=chunk_tokens)
    got = {(r["lang"], r["k"], r["phrase"]): r["n"] for r in counts.phrases.collect()}
    assert got == {key: c for key, c in f.items() if c >= 6}
    assert counts.steps >= shards
    assert {r["lang"]: r["n"] for r in counts.words.collect()} == n
    for percent in (100, 60):
        found = phrases.collocations(counts, contained_percent=percent).collect()
        assert sorted(map(tuple, found)) == sorted(plain_collocations(f, n, 6, percent))


def test_lengths_are_interleaved(spark):
    """Words that are frequent in the first shard start their phrases in the second."""
    docs = spark.createDataFrame([("en", "a b c d e " * 30)] * 9, "lang string, text string").repartition(9)
    counts = phrases.frequent_phrases(docs, min_count=5, max_words=5, shards=9, chunk_tokens=100)
    assert counts.steps < 2 * 9 and counts.phrases.count() == 25


def test_large_products_are_exact(spark):
    rows = [("en", 1, "x", 9 * 10**15), ("en", 1, "y", 8 * 10**15 + 1), ("en", 2, "x y", 7 * 10**15 + 3)]
    f = spark.createDataFrame(rows, "lang string, k int, phrase string, n bigint")
    words = spark.createDataFrame([("en", 10**17 - 7)], "lang string, n bigint")
    got = phrases.collocations(phrases.Counts(f, words, 0)).collect()
    assert [r["score"] for r in got] == [1000 * (7 * 10**15 + 3) * (10**17 - 7) // (9 * 10**15 * (8 * 10**15 + 1))]


def test_phrase_edge_rows_and_empty_table(spark, edge, empty):
    f, n = plain_counts([(r[2], r[1]) for r in EDGE], 3)
    counts = phrases.frequent_phrases(edge, min_count=2, max_words=3, slots=1 << 16)
    assert {(r["lang"], r["k"], r["phrase"]): r["n"] for r in counts.phrases.collect()} == {
        key: c for key, c in f.items() if c >= 2}
    nothing = phrases.frequent_phrases(empty)
    assert phrases.collocations(nothing, top=5).collect() == [] and nothing.words.count() == 0
    with pytest.raises(ValueError):
        phrases.frequent_phrases(edge, slots=1000)
