"""Document operators: brute-force results and edge rows."""

import hashlib
import random
import re
import string
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shopscope.llm import bpe, exact_dedup, licenses, mixing, pii, quality, simhash, toxicity
from shopscope.llm.queries import QUERIES, bpe_digests, tokenizer_path

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"word{i % 977} x{i}" for i in range(60_000))
EDGE = [
    (1, "a b c d e", "en", "s1", 9), (2, None, None, None, None), (3, "", "en", "s1", 0),
    (4, "a  b\tc d\ne", "en", None, 9), (5, LONG, "en", "s2", len(LONG)), (6, LONG + " ", None, "s2", None),
    (None, "no id here.", "en", "s1", 3), (None, "no id here.", "en", "s1", 3), (None, None, None, None, None),
    (1, "a b c d e", "en", "s1", 9), (7, "Caf\u00e9 \u4f60\u597d <|endoftext|> \U0001f600 it's", "fr", "s2", 1),
    (7, "another text of id seven", "fr", "s2", 1), (8, " \n\t ", "en", "s1", 4),
]


@pytest.fixture(scope="module")
def edge(spark):
    """Edge rows, with extra columns named like outputs and internals."""
    from pyspark.sql import functions as F
    extra = ("size", "target", "copies", "taken", "score", "_row_key", "_before", "root", "digest", "stats", "Kept")
    df = spark.createDataFrame(EDGE, SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in extra})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


# -- exact dedup ------------------------------------------------------------

def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_dedup_edge_rows(edge, empty):
    got = [r.asDict() for r in exact_dedup.exact_dedup(edge).collect()]
    assert len(got) == len(EDGE)
    by_text = {}
    for doc_id, text, *_ in EDGE:
        by_text.setdefault(hashlib.sha256(normal(text).encode()).hexdigest(), []).append(doc_id)
    for r in got:
        group = by_text[r["text_sha256"]]
        ids = [i for i in group if i is not None]
        assert r["group_size"] == len(group) and r["keep_id"] == (min(ids) if ids else None)
    for digest, group in by_text.items():
        assert sum(r["kept"] for r in got if r["text_sha256"] == digest) == 1
    kept = exact_dedup.drop_exact_copies(edge)
    assert kept.columns == edge.columns and kept.count() == len(by_text)
    assert exact_dedup.exact_dedup(empty).count() == 0 == exact_dedup.drop_exact_copies(empty).count()


def test_digest_index_lasts_and_grows(spark, scratch):
    first = spark.createDataFrame([(5, "x y"), (9, "z")], "doc_id bigint, text string")
    second = spark.createDataFrame([(1, "x  y"), (2, "new"), (3, "new")], "doc_id bigint, text string")
    path = scratch + "/index"
    exact_dedup.DigestIndex(spark, path, buckets=4).ingest(first).count()
    again = exact_dedup.DigestIndex(spark, path)
    assert again.buckets == 4
    got = {r["doc_id"]: (r["keep_id"], r["kept"], r["group_size"]) for r in again.ingest(second).collect()}
    assert got == {1: (5, False, 1), 2: (2, True, 2), 3: (2, False, 2)}
    assert again.table().count() == 3
    repeat = again.ingest(second)  # as after a failure: nothing is added twice
    assert not repeat.where("kept").count() and again.table().count() == 3
    assert again.compact().table().count() == 3


def test_rerun_of_a_named_batch_keeps_its_texts_again(spark, scratch):
    """As after a job that ended between the append and the write of its result."""
    index = exact_dedup.DigestIndex(spark, scratch + "/rerun", buckets=4)
    schema = "doc_id bigint, text string"
    index.ingest(spark.createDataFrame([(5, "x y")], schema), batch_id="monday").count()
    rows = [(1, "x  y"), (2, "new"), (3, "new"), (2, "new"), (None, "no id"), (4, "late")]
    batch = spark.createDataFrame(rows, schema).repartition(3)
    # Of the broken-off run, all but one text had reached the index; its result is lost.
    index.ingest(batch.where("text <> 'late'"), batch_id="tuesday")
    again = index.ingest(batch.repartition(2), batch_id="tuesday").collect()
    assert sorted((str(r["doc_id"]), r["keep_id"], r["kept"]) for r in again if r["doc_id"] != 2) \
        == [("1", 5, False), ("3", 2, False), ("4", 4, True), ("None", None, True)]
    assert sorted(r["kept"] for r in again if r["doc_id"] == 2) == [False, True]
    assert index.table().count() == 4
    assert not index.compact().ingest(batch, batch_id="wednesday").where("kept").count()
    assert index.compact().ingest(batch, batch_id="tuesday").where("kept").count() == 3


def test_index_anti_join_reads_buckets(spark, scratch):
    index = exact_dedup.DigestIndex(spark, scratch + "/plan", buckets=4)
    plan = spark.table(index.name).groupBy("digest").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


# -- mixing -----------------------------------------------------------------

def fill(sizes, weights=(1, 2, 3), cap=3):
    """Water filling by rounds."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped = {}
    while True:
        left = sum(sizes.values()) - sum(capped.values())
        free = [s for s in names if s not in capped]
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return {**capped, **share}
        capped |= {s: cap * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 5, None: 3}, {"a": 0, "b": 7}, {"a": 0}, {"x": 4, "y": 4, "z": 4},
    {f"s{i:02}": (i * 37) % 101 for i in range(40)} | {"t": 100_000},
])
def test_targets_fill_up_to_caps(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(fill(sizes))


def test_mixing_is_systematic(spark, edge, empty):
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", None]), rng.randint(0, 50)) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, size bigint")
    got = [r.asDict() for r in mixing.mix(df, rows_per_cell=200).collect()]
    assert len(got) == len(rows)
    again = mixing.mix(df.repartition(7), rows_per_cell=200).collect()
    assert {(r["doc_id"], r["copies"]) for r in got} == {(r["doc_id"], r["copies"]) for r in again}
    for source in ("a", "b", "c", None):
        mine = [r for r in got if r["source"] == source]
        rate = mine[0]["target"] / mine[0]["source_size"]
        assert abs(sum(r["copies"] for r in mine) - rate * len(mine)) <= 1
        assert all(r["copies"] in (int(rate), int(rate) + 1) for r in mine)
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) < 0.05 * mine[0]["target"]
    mixed = mixing.mixed_documents(edge)
    assert mixed.columns == edge.columns and mixed.count() > 0
    assert {r["size"] for r in mixed.collect()} == {"clash"}
    assert mixing.mixed_documents(empty).count() == 0


def test_mixing_without_ids_and_with_shared_ids(spark):
    rows = [(None if i % 2 else i // 40, "a", 7, f"text {i}") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, size bigint, text string")
    both = df.union(spark.createDataFrame([(i, "b", 7, "x") for i in range(1000)], df.schema))
    first = mixing.mix(both.repartition(3), rows_per_cell=100)
    again = mixing.mix(both.repartition(7), rows_per_cell=100)
    # Rows differ in their text alone: a full order takes the same ones.
    taken = sorted((r["text"], r["copies"]) for r in first.where("source = 'a'").collect())
    assert taken == sorted((r["text"], r["copies"]) for r in again.where("source = 'a'").collect())
    assert len({c for _, c in taken}) > 1
    # Rows without an id are in many cells.
    plan_cells = F.pmod(mixing._hash32(F.concat(F.lit("n:"), F.concat_ws("\x1f", "source", "size", "text"))), F.lit(50))
    per = [r["count"] for r in both.where("doc_id is null").groupBy(plan_cells).count().collect()]
    assert len(per) == 50 and max(per) < 150
    mixed = mixing.mixed_documents(both.drop("size"), rows_per_cell=100)
    assert sorted(r["text"] for r in mixed.collect()) == \
        sorted(r["text"] for r in mixing.mixed_documents(both.drop("size").repartition(5), rows_per_cell=100).collect())


def test_repeated_digests_in_an_index_multiply_no_rows(spark, scratch):
    docs = spark.createDataFrame([(1, "a b"), (2, "c"), (3, "a  b")], "doc_id bigint, text string")
    index = exact_dedup.DigestIndex(spark, scratch + "/twice", buckets=4)
    index.ingest(docs, batch_id="m").count()
    # What a second writer at the same time would have appended.
    spark.table(index.name).selectExpr("digest", "keep_id + 100 as keep_id", "'z' as batch").write.insertInto(index.name)
    spark.table(index.name).selectExpr("digest", "keep_id + 200 as keep_id", "'b' as batch").write.insertInto(index.name)
    got = index.ingest(spark.createDataFrame([(7, "a b"), (8, "d"), (9, "a b")], docs.schema), batch_id="n").collect()
    assert sorted((r["doc_id"], r["keep_id"], r["kept"], r["group_size"]) for r in got) == [
        (7, 201, False, 2), (8, 8, True, 1), (9, 201, False, 2)]
    assert index.table().count() == 3 and spark.table(index.name).count() > 3
    assert "Exchange" not in index.table()._jdf.queryExecution().executedPlan().toString()
    small = index.compact()
    assert spark.table(small.name).count() == 3


def test_word_count(spark):
    texts = [None, "", " a\u00a0b \x0b c\x0cd ", "x", " ", "\u2003"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r[0] for r in df.select(mixing.word_count("text")).collect()]
    assert got == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]


# -- SimHash ----------------------------------------------------------------

def plain_fingerprint(text):
    lower = "".join(c.lower() if c in string.ascii_uppercase else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not w:
        return 0
    hashes = [xxhash.xxh64(" ".join(w[i:i + 4]), seed=42).intdigest() for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " ", "One", "one two THREE", "a b c d", "A b c D e f a b c d",
                                  "\u00c9t\u00e9 \u4f60\u597d x y z w", LONG[:5000]])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_golay_code_is_perfect():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 1 << 23, 2000)
    index = simhash.codeword_index(words)
    parity, _ = simhash.golay()
    code = index << 11 | parity[index]
    assert int(np.bitwise_count((code ^ words).astype(np.uint64)).max()) <= 3
    assert (simhash.codeword_index(code) == index).all()


def test_four_bits_always_share_a_key():
    rng = np.random.default_rng(1)
    for _ in range(1500):
        a = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(0, 2))
        b = a
        for bit in rng.choice(64, int(rng.integers(0, 5)), replace=False):
            b ^= 1 << int(bit)
        keys = [set(simhash.golay_keys(np.array([x], np.uint64))[1].tolist()) for x in (a, b)]
        assert keys[0] & keys[1]


def brute_components(fps, max_bits=4):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= max_bits:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("max_run", [8192, 16])
def test_links_connect_what_brute_force_connects(spark, max_run):
    """Dense chains of fingerprints, also with every key overfull."""
    from shopscope.llm.components import components
    rng = random.Random(max_run)
    fps = {0}
    for _ in range(40):
        x = rng.getrandbits(64)
        fps.add(x)
        for _ in range(rng.choice([0, 1, 30])):
            for bit in rng.sample(range(64), rng.randint(1, 5)):
                x ^= 1 << bit
            fps.add(x)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >= 1 << 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    roots = {r["node"]: r["root"] for r in components(simhash.near_links(df, 4, max_run)).collect()}
    got = {}
    for f in signed:
        got.setdefault(roots.get(f, f), set()).add(f)
    want = {}
    for f, r in zip(signed, brute_components(fps)):
        want.setdefault(r, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_simhash_edge_rows(edge, empty):
    got = simhash.simhash_components(edge).collect()
    assert len(got) == len(EDGE)
    texts = [(i, plain_fingerprint(t)) for i, t, *_ in EDGE]
    comp = brute_components([f for _, f in texts])
    want = []
    for (i, f), c in zip(texts, comp):
        ids = [j for (j, _), d in zip(texts, comp) if d == c and j is not None]
        want.append((i, f"{f:016x}", min(ids) if ids else None))
    key = repr
    assert sorted(((r[0], r[1], r[2]) for r in got), key=key) == sorted(want, key=key)
    kept = simhash.drop_near_copies(edge)
    assert kept.columns == edge.columns and kept.count() == len(set(comp))
    assert simhash.drop_near_copies(empty).count() == 0


def test_simhash_query_against_brute_force(spark):
    from conftest import SMALL
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in QUERIES["op3_simhash"](spark, SMALL).collect()}
    fps = [plain_fingerprint(d["text"]) for d in docs]
    comp = brute_components(fps)
    for d, f, c in zip(docs, fps, comp):
        r = got[d["doc_id"]]
        assert r["fingerprint"] == f"{f:016x}"
        assert r["component_id"] == min(x["doc_id"] for x, k in zip(docs, comp) if k == c)


# -- BPE --------------------------------------------------------------------

def library_digests(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path())
    out = []
    for text in texts:
        ids = t.encode(text or "", add_special_tokens=False).ids
        back = t.decode(ids, skip_special_tokens=False)
        out.append((len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                    hashlib.sha256(back.encode()).hexdigest()))
    return out


def test_bpe_edge_rows_match_the_library(spark, edge, empty):
    odd = ["<|endoftext|>", "a<|endoftext|><|endoftext|> b  ", "<|endoftext", "  lead", "trail  ", "\n\n x\n",
           "it's I'll 'S", "1234 5,6", "\u00a0\u2003x", "\u0558 \U0003fc3b!", "\x00\x1c\x85", "e\u0301 \u0939\u093f"]
    rows = [(i, t) for i, t, *_ in EDGE] + [(100 + i, t) for i, t in enumerate(odd)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = sorted((tuple(r) for r in bpe_digests(df).collect()), key=repr)
    assert got == sorted(((i, *d) for (i, _), d in zip(rows, library_digests([t for _, t in rows]))), key=repr)
    assert bpe_digests(edge).count() == len(EDGE) and bpe_digests(empty).count() == 0


def test_bpe_small_chunks_and_query(spark):
    from conftest import SMALL
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    path = tokenizer_path()
    rows = docs.collect()
    want = {r["doc_id"]: d for r, d in zip(rows, library_digests([r["text"] for r in rows]))}
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op7_bpe"](spark, SMALL).collect()}
    assert got == want
    decoded = bpe.decode(bpe.encode(docs, path, chunk_chars=5000), path)
    assert {r["doc_id"]: r["text"] for r in decoded.select("doc_id", "text").collect()} \
        == {r["doc_id"]: r["text"] for r in rows}


def test_bpe_buckets_grow_with_the_bytes_of_few_long_texts(spark, monkeypatch):
    """Few rows of long texts: no task gets the distinct words of all chunks."""
    from pyspark.sql import functions as F
    staged = []
    kept = bpe._staged_by_chunk
    monkeypatch.setattr(bpe, "_staged_by_chunk", lambda rows: staged.append(kept(rows)) or staged[-1])
    texts = [" ".join(f"w{i * 7 + k}" for i in range(1_200_000)) for k in range(4)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    got = sorted(tuple(r) for r in bpe_digests(df).collect())
    assert got == [(i, *d) for i, d in enumerate(library_digests(texts))]
    sizes = {r["bucket"]: r["size"] for r in staged[0].where("bucket >= 0").groupBy("bucket")
             .agg(F.sum(F.length("blob")).alias("size")).collect()}
    assert len(sizes) == -(-sum(map(len, texts)) // (16 << 20)) > 1
    assert max(sizes.values()) < 0.75 * sum(sizes.values())


def test_word_split_agrees_with_the_library_on_every_agreed_character():
    import regex
    pre = bpe._tokenizer(tokenizer_path()).pre_tokenizer.pre_tokenize_str
    words = regex.compile(bpe.PATTERN).findall
    agreed = regex.compile(f"[{bpe.AGREED}]")
    for code in range(0x10000):
        c = chr(code)
        if 0xD800 <= code < 0xE000 or not agreed.match(c):
            continue
        s = f"x{c}1 {c}! {c}{c}\n"
        assert [s[a:b] for _, (a, b) in pre(s)] == words(s), hex(code)


# -- classifiers ------------------------------------------------------------

def synthetic(n, seed=0):
    rng = random.Random(seed)
    plain, bad = [f"w{i}" for i in range(200)], ["scum", "vilely", "wretch"]
    rows = []
    for i in range(n):
        toxic, junk = rng.random() < 0.3, rng.random() < 0.3
        sentences = [rng.choices(plain, k=rng.randint(4, 12)) for _ in range(rng.randint(1, 6))]
        if toxic:
            rng.choice(sentences).insert(1, rng.choice(bad))
        text = ". ".join(" ".join(s) for s in sentences) + "."
        if junk:
            text = text.upper().replace(" ", "!! ")
        rows.append((i, text, int(not junk), int(toxic)))
    return rows


def test_toxicity_learns_and_locates(spark):
    from pyspark.sql import functions as F
    rows = synthetic(900)
    docs = spark.createDataFrame([(i, t) for i, t, *_ in rows], "doc_id bigint, text string")
    labels = labels_of(spark, [(i, q, x) for i, _, q, x in rows])
    train = F.col("doc_id") % 3 != 0
    scored = {r["doc_id"]: r["score"] for r in toxicity.toxicity_scores(docs, labels, train).collect()}
    held = [(scored[i], x) for i, _, _, x in rows if i % 3 == 0]
    assert np.mean([(s >= 0.5) == (x == 1) for s, x in held]) > 0.95
    model = toxicity.train(docs, labels, "toxic")
    spans = toxicity.locate(docs, model).join(docs, "doc_id").collect()
    hits = [re.search("scum|vilely|wretch", r["text"][r["start"]:r["end"]].lower()) for r in spans]
    assert len(spans) > 150 and np.mean([bool(h) for h in hits]) > 0.95


def test_quality_learns_rules(spark):
    from pyspark.sql import functions as F
    rows = synthetic(900, seed=1)
    docs = spark.createDataFrame([(i, t) for i, t, *_ in rows], "doc_id bigint, text string")
    labels = labels_of(spark, [(i, q, x) for i, _, q, x in rows])
    got = {r["doc_id"]: r["score"] for r in quality.quality_scores(docs, labels, F.col("doc_id") % 3 != 0).collect()}
    assert np.mean([(got[i] >= 0.5) == (q == 1) for i, _, q, _ in rows if i % 3 == 0]) > 0.97


@pytest.mark.parametrize("known", [[], [(1, 1, 1)], [(1, 1, None), (4, 0, 1), (7, 1, 0), (None, 1, 1), (1, 0, 0)]])
def test_classifiers_on_edge_rows(spark, edge, empty, known):
    from pyspark.sql import functions as F
    labels = labels_of(spark, known)
    everything = F.lit(True)
    for docs, n in ((edge, len(EDGE)), (empty, 0)):
        scores = [r["score"] for r in toxicity.toxicity_scores(docs, labels, everything).collect()]
        assert len(scores) == n and all(0 <= s <= 1 for s in scores)
        scores = [r["score"] for r in quality.quality_scores(docs, labels, everything).collect()]
        assert len(scores) == n and all(0 <= s <= 1 for s in scores)
        kept = toxicity.drop_toxic(docs, labels, everything)
        assert kept.columns == docs.columns


def test_rules_read_from_a_tree():
    text = ("DecisionTree\n  If (feature 2 <= 0.5)\n   If (feature 0 <= 1.5)\n    Predict: 0.0\n"
            "   Else (feature 0 > 1.5)\n    Predict: 1.0\n  Else (feature 2 > 0.5)\n   Predict: 1.0\n")
    assert quality.tree_rules(text) == {
        ((2, "<=", 0.5),), ((0, "<=", 1.5), (2, "<=", 0.5)), ((0, ">", 1.5), (2, "<=", 0.5)), ((2, ">", 0.5),)}


@pytest.mark.parametrize("query,label,folds,fold", [("op1_quality", "quality", 4, 2), ("op8_toxicity", "toxic", 5, 0)])
def test_held_out_accuracy(spark, query, label, folds, fold):
    import zlib
    from conftest import MEDIUM
    got = QUERIES[query](spark, MEDIUM).join(spark.read.parquet(f"{MEDIUM}/labels.parquet"), "doc_id", "left").collect()
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % folds == fold)
    held = [(r["score"], r["predicted"], r[label]) for r in got if r["held_out"] and r[label] is not None]
    pos, neg = ([s for s, _, y in held if y == v] for v in (1, 0))
    auc = np.mean([[(a > b) + (a == b) / 2 for b in neg] for a in pos])
    assert auc > (0.97 if query == "op1_quality" else 0.6)  # 319 labelled rows only


# -- PII --------------------------------------------------------------------

def brute_spans(text):
    out = []
    for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
                          ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"),
                          ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in m.group() if c in string.digits]
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            if kind == "card":
                twice = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1])]
                if not 12 <= len(digits) <= 19 or sum(twice) % 10:
                    continue
            out.append((m.start(), ("email", "ip", "card", "phone").index(kind), m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


PII_TEXTS = [
    None, "", "a.b@c.de, x@y +1 (555) 123-4567 and 10.0.0.256 or 10.0.0.255.", "4111 1111 1111 1111 4111-1111-1111-1112",
    "\U0001f600 +12345678 +123456789 1.2.3.4.5.6.7.8", "00000000000000000000000255.1.1.1 12345678901234567890",
    "mail me@example.com+15551234567 5500005555555559",
]


def test_base_spans_match_brute_force(spark, edge, empty):
    from pyspark.sql import functions as F
    rows = list(enumerate(PII_TEXTS))
    got = pii.extract(spark.createDataFrame(rows, "doc_id bigint, text string")) \
        .select("doc_id", pii.joined(F.col("base")).alias("base")).collect()
    assert {r["doc_id"]: r["base"] for r in got} == {i: brute_spans(t) for i, t in rows}
    assert pii.extract(edge).count() == len(EDGE) and pii.extract(empty).count() == 0


def test_ip_part_of_more_zeros_than_int_reads():
    for text in ("0" * 5000 + "1.1.1.1", "1.1." + "0" * 5000 + ".255"):
        assert pii.base_spans(text) == [(0, 1, len(text))]
    assert pii.base_spans("1.1.1." + "0" * 5000 + "256") == []


def test_base_patterns_on_random_and_very_long_texts():
    """Equal to the plain patterns on random text, and linear on runs without a match."""
    import random
    import time
    rng = random.Random(5)
    for _ in range(4000):
        text = "".join(rng.choice("ab1.2.@@-+ %5_é(\n") for _ in range(rng.randint(0, 40)))
        got = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in pii.base_spans(text))
        assert got == brute_spans(text), text
    began = time.time()
    for run in ("a", "1", "a@", "@", "1.", "+1", "at", "(at)"):
        text = run * 300_000 + " x@y.z"
        spans = pii.base_spans(text)
        pii.candidates(text, spans)
        assert (len(text) - 5, 0, len(text)) in spans
    assert time.time() - began < 30


def test_patterns_discover_unseen_identifiers(spark):
    """Numbers behind the words that introduce cards are found; others are not."""
    from pyspark.sql import functions as F

    def card(i):
        head = f"4{i:014d}"
        return head + next(str(d) for d in range(10) if pii.luhn(head + str(d)))

    rows = [(i, f"please charge card {card(i)} today") for i in range(60)]
    broken = card(99)[:-1] + str((int(card(99)[-1]) + 1) % 10)
    rows += [(100, f"please charge card {broken} today"), (101, f"part number zz {broken[::-1]} is out of stock")]
    got = {r["doc_id"]: r["spans"] for r in pii.extract(spark.createDataFrame(rows, "doc_id bigint, text string"))
           .select("doc_id", pii.joined(F.col("spans")).alias("spans")).collect()}
    assert got[0] == "card:19:35" and got[100] == "card:19:35" and got[101] == ""


def discovered(spark, instances):
    """{instance: (kind, belief)} from (instance, seed, patterns) of cards."""
    rows = [(i, i, [(0, 1, seed, ["card"], name, patterns)]) for i, (name, seed, patterns) in enumerate(instances)]
    found = spark.createDataFrame(rows, f"doc_id bigint, row_id bigint, mentions {pii.MENTIONS}")
    return {r["instance"]: (r["kind"], r["belief"]) for r in pii.discover(found).collect()}


def test_discovery_follows_long_chains(spark):
    """Level n shares patterns with level n - 1 only, so it takes n rounds."""
    levels = [[f"{n}-{i}" for i in range(10)] for n in range(8)]
    patterns = {name: [] for level in levels for name in level}
    for n, (last, level) in enumerate(zip(levels, levels[1:])):
        for i in range(0, 10, 2):
            for name in last + level[i:i + 2]:
                patterns[name] += [f"{n} {i} {k}" for k in range(4)]
    got = discovered(spark, [(name, "card" if name in levels[0] else None, p) for name, p in patterns.items()])
    assert set(got) == {name for level in levels[1:] for name in level}


def test_rare_patterns_count(spark):
    """13 seeds of 14 instances and 3 of 4: 1 - (1 - 13/16) (1 - 3/6) = 0.906."""
    seeds = [(f"a{i}", "card", ["often"]) for i in range(13)] + [(f"b{i}", "card", ["rare"]) for i in range(3)]
    assert "x" in discovered(spark, [*seeds, ("x", None, ["often", "rare"])])
    assert discovered(spark, [*seeds, ("x", None, ["often"])]) == {}


@pytest.mark.parametrize("steady", ["{v} card {n} {u}", "{v} {u} {n} charged"])
def test_one_steady_word_among_varying_ones_is_a_pattern(spark, steady):
    from pyspark.sql import functions as F
    heads = [f"4{i:014d}" for i in range(61)]
    cards = [h + next(str(d) for d in range(10) if pii.luhn(h + str(d))) for h in heads]
    cards[60] = cards[60][:-1] + str((int(cards[60][-1]) + 1) % 10)  # no base span
    word = lambda i: "".join(string.ascii_lowercase[int(d)] for d in str(i))
    rows = [(i, steady.format(v="v" + word(i), u="u" + word(i), n=n)) for i, n in enumerate(cards)]
    got = {r["doc_id"]: r["spans"] for r in pii.extract(spark.createDataFrame(rows, "doc_id bigint, text string"))
           .select("doc_id", pii.joined(F.col("spans")).alias("spans")).collect()}
    start = rows[60][1].index(cards[60])
    assert got[60] == f"card:{start}:{start + 16}"


def test_contexts_are_whole_words():
    for gap in (" ", " " * 500):
        text = f"Call{gap}line2{gap}[555{gap}please"
        at = text.index("[")
        assert pii.lexical_patterns(text, at, at + 4) == [
            "call line0 _", "line0 _ please", "line0 _", "_ please"]
    word, long = "w" * pii.CONTEXT_WORD, "w" * (pii.CONTEXT_WORD + 1)
    assert pii.lexical_patterns(f"{word} 555 {word}", len(word) + 1, len(word) + 4) == [
        f"{word} _ {word}", f"{word} _", f"_ {word}"]
    assert pii.lexical_patterns(f"a {long} 555 {long}", len(long) + 3, len(long) + 6) == []
    assert pii.lexical_patterns("up\n555\ndown", 3, 6) == []  # words of other lines are none


def test_candidates_avoid_every_base_span():
    rnd = random.Random(5)
    for _ in range(300):
        text = "".join(rnd.choice(["a@b ", "x(at)y.z ", "1.2.3.4", "+49 30 123 456 78", " ", "555-1234 567 ", "a@b.cd"])
                       for _ in range(8))
        taken = pii.base_spans(text)
        apart = [c for c in pii.candidates(text, []) if all(c[1] <= s or c[0] >= e for s, _, e in taken)]
        assert pii.candidates(text, taken) == apart


@pytest.mark.parametrize("unit", ["user12@mail.example.com ", "10.20.30.40,", "a(at)b.cd 555-123-4567 ", "1 "])
def test_identifiers_of_long_texts_in_linear_time(unit):
    text = unit * (5_000_000 // len(unit))
    began = time.monotonic()
    base = pii.base_spans(text)
    for a, b in [(a, b) for a, _, b in base] + [(a, b) for a, b, _ in pii.candidates(text, base)]:
        pii.lexical_patterns(text, a, b)
    assert time.monotonic() - began < 20


def test_pii_query(spark):
    from conftest import SMALL
    got = {r["doc_id"]: r for r in QUERIES["op10_pii"](spark, SMALL).collect()}
    for d in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        r, want = got[d["doc_id"]], brute_spans(d["text"])
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [len(re.findall(k + ":", want)) for k in pii.KINDS]
        assert set(filter(None, want.split(","))) <= set(r["spans"].split(","))


# -- licences ---------------------------------------------------------------

def test_licences_found_and_plain_text_left_alone(spark, edge, empty):
    from conftest import MEDIUM
    phrases = {"Released under the MIT License.": "mit", "Licensed under the Apache License, Version 2.0.": "apache-2.0",
               "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0",
               "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0", "All rights reserved.": "proprietary"}
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    got = {r["doc_id"]: r["families"] for r in QUERIES["op6_licenses"](spark, MEDIUM).collect()}
    for d in docs.collect():
        want = sorted({f for p, f in phrases.items() if p in (d["text"] or "")})
        assert got[d["doc_id"]] == ",".join(want)
    model = licenses.fit(["some ordinary words here", "the license of the driver was lost in the park"])
    assert licenses.classify("the version of the license plate was public", model) is None
    assert licenses.classify("This file is licensed under the Apache License Version 2.0", model)[0] == "apache-2.0"
    assert licenses.scan(edge, model).count() == len(EDGE) and licenses.scan(empty, model).count() == 0
    assert licenses.train(empty)["classes"][0] == "unknown"


def test_wrapped_licences_and_their_qualifiers():
    model = licenses.fit(["some ordinary words here", "the license of the driver was lost in the park"])
    bsd = "# Redistribution and use in source and binary forms, with or without\n" \
          "# modification, are permitted provided that the following conditions\n# are met:"
    gpl = "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU " \
          "General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or"
    text = f"Some plain words.\nCopyright by us\n{bsd}\nmore plain words\n\n{gpl}\n(at your option) any later."
    n, found = licenses.mentions(text, model)
    assert n == 11 - 1 and [(x["family"], text[x["start"]:x["end"]]) for x in found] \
        == [("bsd-3-clause", bsd), ("gpl-3.0", gpl)]
    assert licenses.mentions(bsd.replace("without\n", "without\n\n"), model)[1] == []
    work = "This work is licensed under the GNU {} License, version {}."
    for name, version, family in (("General Public", 3, "gpl-3.0"), ("General Public", 2, "gpl-2.0"),
                                  ("Lesser General Public", 3, "lgpl-3.0"), ("Affero General Public", 3, "agpl-3.0"),
                                  ("General Public", 7, None), ("Library General Public", 3, None)):
        hit = licenses.classify(work.format(name, version), model)
        assert (hit and hit[0]) == family, (name, version, hit)
    work = "This work is licensed under a Creative Commons Attribution{} 4.0 International License."
    for extra, family in (("", "cc-by-4.0"), ("-ShareAlike", "cc-by-sa-4.0"), ("-NonCommercial", "cc-by-nc-4.0"),
                          ("-NoDerivatives", None), ("-NonCommercial-ShareAlike", None)):
        hit = licenses.classify(work.format(extra), model)
        assert (hit and hit[0]) == family, (extra, hit)
    for family, template in licenses.TEMPLATES:
        assert licenses.classify(template, model)[0] == family


def test_licence_sample_is_of_all_whole_paragraphs(spark, monkeypatch):
    seen = []
    learn = licenses.learn
    monkeypatch.setattr(licenses, "learn", lambda unknown, *a: seen.append(unknown) or learn(unknown, *a))
    long = "zz " * 3000 + "redistribute"
    rows = [(i, f"plain{i} notice\n\n{long if i < 3 else 'inner words'}\nMIT licence, see LICENSE") for i in range(300)]
    docs = spark.createDataFrame([*rows, rows[0]], "doc_id bigint, text string").repartition(3)
    model = licenses.train(docs, sample=5000)
    grams = [g for g, _ in seen[0]]
    assert len(grams) == 600 and sum("redistribute" in g for g in grams) == 3  # no footer, no cut, a repeat once
    assert licenses.classify("Released under the MIT License.", model)[0] == "mit"
    licenses.train(docs, sample=100)
    assert 40 <= len(seen[1]) <= 95  # about a third of the sample are footers
    assert any(w[0].startswith("plain") for _, w in seen[1]) and any(w[0] == "inner" for _, w in seen[1])


# -- quality: runs of symbols, column names ------------------------------------

def test_quality_statistics_are_linear_in_the_text():
    import time
    begun = time.time()
    got = dict(zip(quality.STATISTICS, quality.statistics("*" * 10_000_000 + " a** **b !| x")))
    assert time.time() - begun < 10 and got["bad_word_ends"] == 3 / 5


def test_quality_with_clashing_columns(spark):
    from pyspark.sql import functions as F
    docs = spark.createDataFrame([(i, "good words here. " * 3 if i % 2 else "##|| !! **", "a", "b", "c")
                                  for i in range(40)], "doc_id long, text string, label string, Stats string, _id string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    got = quality.quality_scores(docs, labels, F.lit(True))
    assert {c for c in got.columns} == {"doc_id", "label", "_id", "stats", "score"} and got.count() == 40
    assert got.where("(doc_id % 2 = 1) = (score > 0.5)").count() == 40
