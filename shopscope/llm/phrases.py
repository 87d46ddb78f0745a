"""Phrase mining by dynamic itemset counting.

Documents are split at the piece marks into pieces and those into words; a
phrase is 1 to ``max_words`` words in a row within a piece, counted per
language. Frequent phrases are found in a cyclic scan over ``SHARDS`` shards of
the corpus. Words are counted from the first shard on. As soon as both
subphrases of a phrase (all but its last word, all but its first) have reached
the threshold, the phrase becomes active: it is counted from the next shard on,
together with phrases of all other lengths, until it has seen each shard once.
A phrase that completes its cycle below the threshold is dropped. The scan ends
when no phrase is left in its cycle.

In Spark: texts become chunks of word numbers, written once in a folder per
shard. A step reads one shard; each chunk counts its active phrases and sends
them, as hashed keys in key order, to buckets of the keys; a bucket merges them
into its part of the running counts, which is written, and gives the phrases
that have just reached the threshold. These go to the chunks of the next step
as a table of ``SLOTS`` bytes (a fixed size, whatever the corpus holds): the
byte of a phrase's slot is the step from which it counts as reached, and never
changes once set. Phrases that share a slot can only make others active too
early, which costs time and loses nothing. A frequent phrase is one entry per
chunk and step, so no key makes a task large.

A last scan counts, by their texts, all phrases whose subphrases have been
reached; so the counts given are exact. A phrase could be lost only by two
phrases with one 64-bit key.

Cases: a null text holds nothing; a null language is ``und``. Repeated rows
count each time. An empty table gives no rows. Only the two named columns are
read. Memory of a task: one chunk, or the longest document if that is longer.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import drop_staged, new_path, ship, stage, text_or_empty
from .ngrams import (
    LOWER, Numbers, bucket_bits, bucket_slices, from_deltas, from_planes, mix, packed, to_deltas, to_planes, unpacked,
)

MIN_COUNT = 100
MAX_WORDS = 5
SHARDS = 3
SLOTS = 1 << 24
CHUNK_TOKENS = 1 << 20
RANK_SLICES = 16
UNKNOWN_LANG = "und"

# Piece marks become line feeds, tabs spaces, A-Z lower case.
_PIECES = bytes(0x0A if b in b".,;:!?\x0A\x0B\x0C\x0D" else 0x20 if b == 0x09 else b for b in LOWER)
_BREAK = b"\n"

CHUNK_SCHEMA = ("shard int, langs array<string>, lang_words array<bigint>, words binary, word_langs binary, "
                "keys binary, ids binary, tokens bigint")
NAMED_SCHEMA = "bucket bigint, langs array<string>, owners binary, texts binary, counts binary"
COUNT_SCHEMA = "bucket bigint, keys binary, counts binary, starts binary, old boolean, fresh binary"


# ---- chunks --------------------------------------------------------------------

def pieces_of(text: bytes) -> list[bytes]:
    """Words in order, with a line feed at the end of every piece."""
    return [w for w in text.translate(_PIECES).replace(_BREAK, b" \n ").split(b" ") if w] + [_BREAK]


def _chunks(shards: int, chunk_tokens: int):
    def run(batches):
        from pyspark import TaskContext
        number = TaskContext.get().partitionId()
        names: list[bytes] = []
        by_lang: dict[str, Numbers] = {}
        ids: list[np.ndarray] = []
        held = 0

        def flush():
            owner = np.empty(len(names), np.int64)
            langs = list(by_lang)
            for i, lang in enumerate(langs):
                own = np.fromiter(by_lang[lang].values(), np.int64, len(by_lang[lang]))
                owner[own[own >= 0]] = i
            flat = np.concatenate(ids)
            prefix = [lang.encode() + b" " for lang in langs]
            keys = b"".join(blake2b(prefix[i] + w, digest_size=8).digest() for i, w in zip(owner.tolist(), names))
            total = np.bincount(owner[flat[flat >= 0]], minlength=len(langs))
            return pa.RecordBatch.from_pydict({
                "shard": pa.array([number % shards], pa.int32()), "langs": [langs], "lang_words": [total],
                "words": [b" ".join(names)], "word_langs": [to_planes(owner)], "keys": [keys], "ids": [to_planes(flat)],
                "tokens": [len(flat)]})

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = pieces_of(text)
                if held and held + len(words) > chunk_tokens:
                    yield flush()
                    number, held = number + 1, 0
                    names, by_lang, ids = [], {}, []
                if lang not in by_lang:
                    by_lang[lang] = Numbers(names)
                    by_lang[lang][_BREAK] = -1
                ids.append(by_lang[lang].of(words))
                held += len(words)
        if held:
            yield flush()
    return run


# ---- active phrases of a chunk ----------------------------------------------------

def _phrases(row, marks: np.ndarray, max_words: int):
    """For k = 1, 2, ..: places of the phrases whose subphrases were reached,
    their keys and first active steps."""
    shift = np.uint64(64 - (len(marks) - 1).bit_length())
    ids, keys = from_planes(row["ids"]), np.frombuffer(row["keys"], np.uint64)
    at = np.flatnonzero(ids >= 0)
    key = keys[ids[at]]
    start = np.zeros(len(at), np.int64)
    for k in range(1, max_words + 1):
        yield k, at, key, start
        mark = marks[key >> shift].astype(np.int64)
        use = np.flatnonzero(mark)
        reached = np.maximum(mark[use], start[use] + (k > 1))
        at, key = at[use], key[use]
        both = np.flatnonzero(at[1:] == at[:-1] + 1)  # the next place has been reached too
        start = np.maximum(reached[both], reached[both + 1])
        at, key = at[both], mix(key[both], keys[ids[at[both] + k]])


def _count(marks_table, step: int, shards: int, max_words: int, bits: int):
    def run(batches):
        marks = np.frombuffer(unpacked(marks_table.value), np.uint8)
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts, starts = [], [], []
                for _, _, key, start in _phrases(row, marks, max_words):
                    now = np.flatnonzero((start <= step) & (step < start + shards))
                    found, first, many = np.unique(key[now], return_index=True, return_counts=True)
                    keys.append(found)
                    counts.append(many)
                    starts.append(start[now[first]])
                key = np.concatenate(keys)
                rank = np.argsort(key)
                key, many, start = key[rank], np.concatenate(counts)[rank], np.concatenate(starts)[rank]
                cut = bucket_slices(key, bits)
                full = [b for b in range(1 << bits) if cut[b + 1] > cut[b]]
                parts = [slice(cut[b], cut[b + 1]) for b in full]
                yield pa.RecordBatch.from_pydict({
                    "bucket": full, "keys": [to_deltas(key[p]) for p in parts],
                    "counts": [to_planes(many[p]) for p in parts],
                    "starts": [start[p].astype(np.uint8).tobytes() for p in parts],
                    "old": [False] * len(full), "fresh": [None] * len(full)}, schema=pa.schema([
                        ("bucket", pa.int64()), *((c, pa.binary()) for c in ("keys", "counts", "starts")),
                        ("old", pa.bool_()), ("fresh", pa.binary())]))
    return run


def _merge(step: int, shards: int, min_count: int, slots: int):
    """Running counts of a bucket plus those of a step; slots just reached."""
    shift = np.uint64(64 - (slots - 1).bit_length())

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [from_deltas(x) for x in pdf["keys"]]
        key = np.concatenate(parts)
        many = np.concatenate([from_planes(x) for x in pdf["counts"]])
        begun = np.concatenate([np.frombuffer(x, np.uint8) for x in pdf["starts"]])
        before = np.where(np.repeat(pdf["old"].to_numpy(bool), [len(p) for p in parts]), many, 0)
        rank = np.argsort(key, kind="stable")
        key = key[rank]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(new)
        total, was = np.add.reduceat(many[rank], first), np.add.reduceat(before[rank], first)
        begun, key = np.maximum.reduceat(begun[rank], first), key[first]
        fresh = np.unique(key[(total >= min_count) & (was < min_count)] >> shift).astype(np.int64)
        keep = (total >= min_count) | (begun.astype(np.int64) + shards > step + 1)
        return pd.DataFrame({"bucket": pdf["bucket"].iloc[:1], "keys": [to_deltas(key[keep])],
                             "counts": [to_planes(total[keep])], "starts": [begun[keep].tobytes()],
                             "old": [True], "fresh": [fresh.astype(np.int32).tobytes()]})
    return run


def _named(marks_table, max_words: int, bits: int):
    """Texts and counts of a chunk's phrases that were reached, for their buckets."""
    def run(batches):
        marks = np.frombuffer(unpacked(marks_table.value), np.uint8)
        shift = np.uint64(64 - (len(marks) - 1).bit_length())
        for batch in batches:
            for row in batch.to_pylist():
                names = row["words"].split(b" ")
                ids, owner = from_planes(row["ids"]), from_planes(row["word_langs"])
                keys, owners, texts, counts = [], [], [], []
                for k, at, key, _ in _phrases(row, marks, max_words):
                    seen = np.flatnonzero(marks[key >> shift])
                    # Equal texts have equal words: exact whatever the keys are.
                    number = ids[at[seen]]
                    for j in range(1, k):
                        number = np.unique(number * len(names) + ids[at[seen] + j], return_inverse=True)[1]
                    _, first, many = np.unique(number, return_index=True, return_counts=True)
                    where = at[seen[first]]
                    parts = [[names[i] for i in ids[where + j].tolist()] for j in range(k)]
                    keys.append(key[seen[first]])
                    owners.append(owner[ids[where]])
                    texts += map(b" ".join, zip(*parts))
                    counts.append(many)
                key = np.concatenate(keys)
                rank = np.argsort(key)
                owner, many = np.concatenate(owners)[rank], np.concatenate(counts)[rank]
                cut = bucket_slices(key[rank], bits)
                full = [b for b in range(1 << bits) if cut[b + 1] > cut[b]]
                parts = [slice(cut[b], cut[b + 1]) for b in full]
                yield pa.RecordBatch.from_pydict({
                    "bucket": full, "langs": [row["langs"]] * len(full), "owners": [to_planes(owner[p]) for p in parts],
                    "texts": [packed(_BREAK.join([texts[i] for i in rank[p].tolist()])) for p in parts],
                    "counts": [to_planes(many[p]) for p in parts]},
                    schema=pa.schema([("bucket", pa.int64()), ("langs", pa.list_(pa.string())),
                                      *((c, pa.binary()) for c in ("owners", "texts", "counts"))]))
    return run


def _exact(min_count: int):
    """Counts by text of a bucket's phrases: those that reach the threshold."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        total: dict[tuple[str, bytes], int] = {}
        for langs, owners, texts, counts in zip(pdf["langs"], pdf["owners"], pdf["texts"], pdf["counts"]):
            for i, text, n in zip(from_planes(owners).tolist(), unpacked(texts).split(_BREAK),
                                  from_planes(counts).tolist()):
                total[langs[i], text] = total.get((langs[i], text), 0) + n
        rows = [(lang, text.count(b" ") + 1, text, n) for (lang, text), n in total.items() if n >= min_count]
        return pd.DataFrame(rows, columns=["lang", "k", "phrase", "n"])
    return run


# ---- the scan -------------------------------------------------------------------

class Counts:
    """Exact counts of all frequent phrases, and of all words per language."""

    def __init__(self, phrases: DataFrame, words: DataFrame, steps: int):
        self.phrases, self.words, self.steps = phrases, words, steps


def frequent_phrases(docs: DataFrame, lang: str = "lang", text: str = "text", min_count: int = MIN_COUNT,
                     max_words: int = MAX_WORDS, shards: int = SHARDS, slots: int = SLOTS,
                     chunk_tokens: int = CHUNK_TOKENS) -> Counts:
    """``phrases`` (lang, k, phrase, n) with n >= ``min_count`` and ``words`` (lang, n).

    ``slots`` is a power of two; ``shards`` * (``max_words`` + 1) is below 255.
    """
    if slots & (slots - 1) or shards * (max_words + 1) >= 255:
        raise ValueError("slots must be a power of two and shards * (max_words + 1) below 255")
    spark = docs.sparkSession
    ship(spark)
    path = new_path(spark, "phrase-chunks")
    docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"),
                text_or_empty(text).cast("binary").alias("text")) \
        .mapInArrow(_chunks(shards, chunk_tokens), CHUNK_SCHEMA) \
        .write.partitionBy("shard").option("compression", "zstd").parquet(path)
    chunks = spark.read.schema(CHUNK_SCHEMA).parquet(path)
    tokens = chunks.agg(F.sum("tokens")).first()[0] or 0
    bits = bucket_bits(tokens, 2 * chunk_tokens)

    marks = np.zeros(slots, np.uint8)
    state, step, last = None, 0, 0
    while step < last + shards:
        sent = spark.sparkContext.broadcast(packed(marks.tobytes()))
        counted = chunks.where(F.col("shard") == step % shards).select("ids", "keys") \
            .mapInArrow(_count(sent, step, shards, max_words, bits), COUNT_SCHEMA)
        both = counted if state is None else counted.unionByName(state)
        merged = stage(both.groupBy("bucket").applyInPandas(_merge(step, shards, min_count, slots), COUNT_SCHEMA),
                       "phrase-counts")
        if state is not None:
            drop_staged(state)
        state = merged
        # At most one number per slot: a bucket's slots are its own.
        for r in state.where(F.octet_length("fresh") > 0).select("fresh").toLocalIterator():
            slot = np.frombuffer(r["fresh"], np.int32)
            slot = slot[marks[slot] == 0]
            if len(slot):
                marks[slot] = last = step + 1
        sent.destroy()
        step += 1

    sent = spark.sparkContext.broadcast(packed(marks.tobytes()))
    named = chunks.mapInArrow(_named(sent, max_words, bits), NAMED_SCHEMA).groupBy("bucket") \
        .applyInPandas(_exact(min_count), "lang string, k int, phrase binary, n bigint")
    phrases = stage(named.withColumn("phrase", F.col("phrase").cast("string")), "phrases")
    sent.destroy()
    drop_staged(state)
    sizes = chunks.select(F.explode(F.arrays_zip("langs", "lang_words")).alias("x")) \
        .groupBy(F.col("x.langs").alias("lang")).agg(F.sum("x.lang_words").alias("n"))
    return Counts(phrases, stage(sizes, "phrase-langs"), step)


# ---- scores ---------------------------------------------------------------------

def _part(begin: Column, size: Column) -> Column:
    return F.array_join(F.slice("_words", begin, size), " ")


def collocations(counts: Counts, top: int | None = None,
                 contained_percent: int = 100) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the phrases of two or more words.

    A phrase goes when it lies inside a longer one with ``100 f(longer) >=
    contained_percent f(phrase)``. All arithmetic is in 38-digit integers.
    """
    big = "decimal(38,0)"
    f = counts.phrases
    cand = f.where("k >= 2").withColumn("_words", F.split("phrase", " "))
    cuts = cand.withColumn("cut", F.explode(F.expr("sequence(1, k - 1)"))).select(
        "lang", "phrase", F.col("n").alias("a"), "cut", _part(F.lit(1), F.col("cut")).alias("left"),
        _part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right"))
    for side, count in (("left", "l"), ("right", "r")):
        cuts = cuts.join(f.select("lang", F.col("phrase").alias(side), F.col("n").alias(count)), ["lang", side])
    cuts = cuts.join(counts.words, "lang")
    share = F.lit(1000).cast("decimal(4,0)") * F.col("a").cast("decimal(17,0)") * F.col("n").cast("decimal(17,0)")
    product = F.col("l").cast("decimal(19,0)") * F.col("r").cast("decimal(19,0)")
    # Whole division of decimals: the quotient is below 1000 n, so it fits a bigint.
    cuts = cuts.withColumns({"_share": share.cast(big), "_product": product.cast(big)}) \
        .withColumn("score", F.expr("_share div _product"))
    best = cuts.groupBy("lang", "phrase").agg(
        F.min_by(F.struct("a", "l", "r", "n", "score"), F.struct("score", "cut")).alias("x")) \
        .select("lang", "phrase", "x.*")
    inner = cand.where("k >= 3").withColumn("size", F.explode(F.expr("sequence(2, k - 1)"))) \
        .withColumn("begin", F.explode(F.expr("sequence(1, k - size + 1)"))) \
        .groupBy("lang", _part(F.col("begin"), F.col("size")).alias("phrase")).agg(F.max("n").alias("_longer"))
    kept = best.join(inner, ["lang", "phrase"], "left").where(
        F.col("_longer").isNull() | (100 * F.col("_longer") < contained_percent * F.col("a")))
    order = (F.col("score").desc(), F.col("a").desc(), "phrase")
    if top is not None:  # the best of each slice of a language first, so the last window gets few rows
        some = W.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(RANK_SLICES))).orderBy(*order)
        kept = kept.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top)
    ranked = kept.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
