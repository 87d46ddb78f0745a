"""Language-model scoring by deleted interpolation.

An n-gram model whose maximum-likelihood estimates are mixed recursively:

    P_1(w)      = l_1 c(w)/N + (1 - l_1) / (V + 1)
    P_k(w | h)  = l_k[b] c(h w)/c(h) + (1 - l_k[b]) P_{k-1}(w | h')

``b`` is the bucket of the context's frequency c(h), one per power of two; a
context that was never seen leaves P_{k-1}. The weights are learned by
expectation-maximisation on held-out counts: a tenth of the training documents
(``HOLD_OUT``) is left out of the counts, and the weight of each bucket is
fitted to those documents' tokens. The final model uses all training counts.

Data flow, with no cap on words, n-grams or counts:

1. Documents become chunks of about ``CHUNK_TOKENS`` tokens (whole documents),
   written as arrays: one row per chunk.
2. Each chunk sends its distinct n-grams with its own training counts to
   buckets of their keys. A bucket adds up the counts of all chunks and sends
   every chunk the totals of what it asked for. So a frequent n-gram is one
   entry per chunk, however often it occurs, and no key makes a task large.
3. Chunks put the totals at their tokens' places (co-group by chunk).
4. Held-out tokens give a histogram per bucket of the ratio between the higher
   estimate and the lower one (``BINS`` steps per power of two): all that EM
   for a two-way mixture needs. Orders are fitted from low to high.
5. Every token is scored, and documents sum up.

Words are identified by 96 bits of BLAKE2b, longer n-grams by 64 mixed bits,
as in common hashed language models: the base score is exact, and two n-grams
of order 2 or more share a count with a chance of 2^-64 a pair.

Cases: a null text is empty and has one token, the end. A null ``train`` flag
counts as false. Rows with equal ids are documents of their own. A table
without training documents scores 0 for every text; without held-out training
documents the weights stay at one half. Only the id, flag and text columns are
read, so other columns cannot clash. Memory of a task: one chunk, or the
longest document if that is longer.
"""

from __future__ import annotations

import uuid
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_staged, new_path, ship, stage, text_or_empty
from .ngrams import (
    LOWER, Numbers, bucket_bits, bucket_slices, from_deltas, from_planes, mix, to_deltas, to_planes,
)

ORDER = 2
CHUNK_TOKENS = 1 << 21
HOLD_OUT = 10
BINS = 8
WORD_BYTES = 12
BUCKETS = 48  # context-frequency buckets: powers of two

# Scored only; counted; counted, but left out while the weights are learned. NO_ID is added for a null id.
HELD, RETAINED, DELETED, NO_ID = 0, 1, 2, 4

CHUNK_SCHEMA = "chunk bigint, tokens bigint, doc_ids binary, flags binary, lengths binary, ids binary, words binary"
MESSAGE_SCHEMA = "chunk bigint, n int, bucket bigint, high binary, low binary, full binary, less binary"
TALLY_SCHEMA = "chunk bigint, n int, bucket bigint, full binary, less binary, stats array<bigint>"
PLACED_SCHEMA = ("chunk bigint, doc_ids binary, flags binary, lengths binary, counts array<binary>, "
                 "kept array<binary>, stats array<bigint>")


def _kinds(flags: bytes) -> np.ndarray:
    return np.frombuffer(flags, np.uint8) & 3


# ---- 1. chunks ---------------------------------------------------------------

def words_of(text: bytes) -> list[bytes]:
    """Maximal runs of anything but space and U+0009..U+000D, A-Z lower-cased."""
    return text.translate(LOWER).split()


def _chunks(chunk_tokens: int):
    def run(batches):
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32

        def flush():
            words = b"".join(blake2b(w, digest_size=WORD_BYTES).digest() if w else bytes(WORD_BYTES) for w in seen.names)
            return pa.RecordBatch.from_pydict({
                "chunk": [number], "tokens": [held], "doc_ids": [to_planes(np.array(ids, np.int64))],
                "flags": [bytes(flags)], "lengths": [to_planes(np.array(lengths, np.int64))],
                "ids": [to_planes(np.concatenate(tokens))], "words": [words]})

        def fresh():
            seen = Numbers()
            seen.of([b""])  # 0: the end of a document
            return [], [], [], [], seen

        ids, flags, lengths, tokens, seen = fresh()
        held = 0
        for batch in batches:
            for doc_id, flag, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = words_of(text)
                n = len(words) + 1
                if held and held + n > chunk_tokens:
                    yield flush()
                    ids, flags, lengths, tokens, seen = fresh()
                    held, number = 0, number + 1
                tokens.append(seen.of(words))
                tokens.append(np.zeros(1, np.int64))  # the end
                ids.append(doc_id)
                flags.append(flag)
                lengths.append(n)
                held += n
        if held:
            yield flush()
    return run


# ---- n-grams of a chunk --------------------------------------------------------

def _chunk_ngrams(ids: bytes, words: bytes, lengths: np.ndarray, order: int):
    """For each n: key parts of the distinct n-grams in key order, the distinct
    number of every token whose n-gram lies in its document, and those places."""
    ids = from_planes(ids)
    parts = np.frombuffer(words, np.dtype([("high", ">u8"), ("low", ">u4")]))
    high, low = (parts[c].astype(np.uint64) for c in ("high", "low"))
    rank = np.lexsort((low, high))
    where = np.empty(len(rank), np.int64)
    where[rank] = np.arange(len(rank))
    yield high[rank], low[rank], where[ids], np.arange(len(ids))
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(ids)) - np.repeat(starts, lengths)  # place of a token in its document
    single = high[ids]
    keys = single
    for n in range(2, order + 1):
        keys = mix(keys[:-1], single[n - 1:])  # the n-gram that ends at token i is keys[i - n + 1]
        at = np.flatnonzero(place[n - 1:] >= n - 1)
        distinct, which = np.unique(keys[at], return_inverse=True)
        yield distinct, None, which, at + n - 1


# ---- 2. counts by key ------------------------------------------------------------

def _messages(order: int, bits: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                lengths = from_planes(row["lengths"])
                kind = np.repeat(_kinds(row["flags"]), lengths)
                grams = _chunk_ngrams(row["ids"], row["words"], lengths, order)
                for n, (high, low, which, at) in enumerate(grams, 1):
                    less = np.bincount(which[kind[at] == DELETED], minlength=len(high))
                    full = less + np.bincount(which[kind[at] == RETAINED], minlength=len(high))
                    cut = bucket_slices(high, bits)
                    out = {"chunk": [], "n": [], "bucket": [], "high": [], "low": [], "full": [], "less": []}
                    for b in range(1 << bits):
                        lo, hi = cut[b], cut[b + 1]
                        if hi == lo and n > 1:  # words: every bucket answers every chunk, with its totals
                            continue
                        for name, value in (("chunk", row["chunk"]), ("n", n), ("bucket", b),
                                            ("high", to_deltas(high[lo:hi])),
                                            ("low", None if low is None else to_planes(low[lo:hi])),
                                            ("full", to_planes(full[lo:hi])), ("less", to_planes(less[lo:hi]))):
                            out[name].append(value)
                    yield pa.RecordBatch.from_pydict(
                        out, schema=pa.schema([("chunk", pa.int64()), ("n", pa.int32()), ("bucket", pa.int64()),
                                               *((c, pa.binary()) for c in ("high", "low", "full", "less"))]))
    return run


def _tally(pdf: pd.DataFrame) -> pd.DataFrame:
    """Totals of one order's keys in one bucket, for every chunk that has them."""
    highs = [from_deltas(x) for x in pdf["high"]]
    ends = np.cumsum([len(x) for x in highs])
    high = np.concatenate(highs)
    words = pdf["low"].iloc[0] is not None
    low = np.concatenate([from_planes(x, np.uint64) for x in pdf["low"]]) if words else None
    rank = np.lexsort((low, high)) if words else np.argsort(high, kind="stable")
    new = np.empty(len(rank), bool)
    new[:1] = True
    new[1:] = high[rank][1:] != high[rank][:-1]
    if words:
        new[1:] |= low[rank][1:] != low[rank][:-1]
    which = np.empty(len(rank), np.int64)
    which[rank] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    full, less = (np.add.reduceat(np.concatenate([from_planes(x) for x in pdf[c]])[rank], first)
                  if len(first) else np.empty(0, np.int64) for c in ("full", "less"))
    # Types and tokens without and with the held-out part.
    stats = [x for t in (full - less, full) for x in (int((t > 0).sum()), int(t.sum()))]
    parts = np.split(which, ends[:-1])
    return pd.DataFrame({"chunk": pdf["chunk"], "n": pdf["n"], "bucket": pdf["bucket"],
                         "full": [to_planes(full[p]) for p in parts],
                         "less": [to_planes(less[p]) for p in parts],
                         "stats": [stats if words else None] * len(pdf)})


# ---- 3. counts at their places ----------------------------------------------------

def _place(order: int):
    def run(key, chunk: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = chunk.iloc[0]
        lengths = from_planes(row["lengths"])
        kind = np.repeat(_kinds(row["flags"]), lengths)
        answers = answers.sort_values(["n", "bucket"])
        stats = np.sum([s for s in answers["stats"] if s is not None], axis=0)
        counts, kept = [], []
        for n, (_, _, which, at) in enumerate(_chunk_ngrams(row["ids"], row["words"], lengths, order), 1):
            got = answers[answers["n"] == n]
            full, less = (np.concatenate([from_planes(x) for x in got[c]] or [np.empty(0, np.int64)])
                          for c in ("full", "less"))
            here = np.zeros((2, len(kind)), np.int64)
            here[0, at], here[1, at] = full[which], (full - less)[which]
            counts.append(to_planes(here[0]))
            kept.append(to_planes(here[1, kind == DELETED]))
        return pd.DataFrame({"chunk": [key[0]], "doc_ids": [row["doc_ids"]], "flags": [row["flags"]],
                             "lengths": [row["lengths"]], "counts": [counts], "kept": [kept],
                             "stats": [stats.tolist()]})
    return run


# ---- 4. weights ------------------------------------------------------------------

def _context_bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(np.maximum(context, 1).astype(float))[1] - 1, BUCKETS - 1)


def _mixture(counts: list[np.ndarray], inside: np.ndarray, types: int, tokens: int, weights: list[np.ndarray],
             upto: int):
    """P_upto of every token, and for the next order (if any) the bucket and
    maximum-likelihood estimate of the tokens that have a seen context."""
    p = np.full(len(counts[0]), 1.0 / (types + 1))
    for n in range(1, upto + 2):
        if n > len(counts):
            return p, None
        if n == 1:
            at, bucket = np.arange(len(p)), np.zeros(len(p), np.int64)
            high = counts[0] / max(tokens, 1)
            if not tokens:
                at, bucket, high = at[:0], bucket[:0], high[:0]
        else:
            at = np.flatnonzero((inside >= n - 1))
            context = counts[n - 2][at - 1]
            at, context = at[context > 0], context[context > 0]
            bucket, high = _context_bucket(context), counts[n - 1][at] / context
        if n == upto + 1:
            return p, (at, bucket, high)
        weight = weights[n - 1][bucket]
        p[at] = weight * high + (1 - weight) * p[at]


def _places(lengths: np.ndarray) -> np.ndarray:
    return np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _ratios(n: int, weights: list[np.ndarray]):
    """Histogram of log2(higher estimate / P_{n-1}) over held-out tokens."""
    def run(batches):
        sums: dict[tuple[int, int], int] = {}
        for batch in batches:
            for row in batch.to_pylist():
                lengths = from_planes(row["lengths"])[_kinds(row["flags"]) == DELETED]
                types, tokens = row["stats"][:2]
                counts = [from_planes(x) for x in row["kept"]]
                p, (at, bucket, high) = _mixture(counts, _places(lengths), types, tokens, weights, n - 1)
                with np.errstate(divide="ignore"):
                    step = np.round(np.log2(high / p[at]) * BINS)
                step = np.where(np.isfinite(step), step, -1e6).astype(np.int64)
                pairs, many = np.unique(np.stack([bucket, step], 1), axis=0, return_counts=True)
                for pair, c in zip(map(tuple, pairs.tolist()), many.tolist()):
                    sums[pair] = sums.get(pair, 0) + c
        if sums:
            yield pa.RecordBatch.from_pydict({"bucket": [k[0] for k in sums], "step": [k[1] for k in sums],
                                              "n": list(sums.values())})
    return run


def expectation_maximisation(ratio: np.ndarray, count: np.ndarray, rounds: int = 500, tol: float = 1e-9) -> float:
    """Weight w that maximises sum count * log(w * ratio + 1 - w); one event is
    added on each side, so that the weight stays within 0 and 1."""
    w = 0.5
    for _ in range(rounds):
        mine = w * ratio / (w * ratio + 1 - w)
        new = (float(count @ mine) + 1) / (float(count.sum()) + 2)
        if abs(new - w) < tol:
            return new
        w = new
    return w


def learn_weights(placed: DataFrame, order: int) -> list[np.ndarray]:
    """Weights per order and context bucket; orders are fitted from low to high.
    What reaches the driver is at most BUCKETS x some thousand bins."""
    weights: list[np.ndarray] = []
    held = placed.select("lengths", "flags", "stats", "kept")
    for n in range(1, order + 1):
        bins = held.mapInArrow(_ratios(n, weights), "bucket bigint, step bigint, n bigint") \
            .groupBy("bucket", "step").agg(F.sum("n").alias("n")).toPandas()
        fitted = np.full(BUCKETS, 0.5)
        for bucket, part in bins.groupby("bucket"):
            part = part.sort_values("step")
            ratio = np.where(part["step"] <= -10**6, 0.0, np.exp2(part["step"] / BINS))
            fitted[bucket] = expectation_maximisation(ratio, part["n"].to_numpy(float))
        weights.append(fitted)
    return weights


# ---- 5. scores -------------------------------------------------------------------

def _scores(weights: list[np.ndarray]):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                lengths = from_planes(row["lengths"])
                counts = [from_planes(x) for x in row["counts"]]
                types, tokens = row["stats"][2:]
                p, _ = _mixture(counts, _places(lengths), types, tokens, weights, len(counts))
                base = (counts[0] + 0.5) / (tokens + 0.5 * (types + 1))
                starts = np.cumsum(lengths) - lengths
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(from_planes(row["doc_ids"]), mask=np.frombuffer(row["flags"], np.uint8) >= NO_ID),
                    "n_tokens": lengths,
                    "n_known": np.add.reduceat((counts[0] > 0).astype(np.int64), starts),
                    "train_tokens": np.full(len(lengths), tokens, np.int64),
                    "base_score": np.add.reduceat(np.log10(base), starts),
                    "score": np.add.reduceat(np.log10(p), starts)})
    return run


class Model:
    """Mixture weights together with the counts placed at every document's tokens."""

    def __init__(self, placed: DataFrame, weights: list[np.ndarray]):
        self.placed, self.weights = placed, weights

    def scores(self) -> DataFrame:
        """(doc_id, n_tokens, n_known, train_tokens, base_score, score) per document."""
        return self.placed.mapInArrow(_scores(self.weights), "doc_id bigint, n_tokens bigint, n_known bigint, "
                                                             "train_tokens bigint, base_score double, score double")


def fit(docs: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text", order: int = ORDER,
        chunk_tokens: int = CHUNK_TOKENS) -> Model:
    """Count n-grams up to ``order`` of the rows where ``train`` holds and learn the weights."""
    spark = docs.sparkSession
    ship(spark)
    deleted = F.pmod(F.xxhash64(F.col(doc_id), F.col(text)), F.lit(HOLD_OUT)) == 0
    flag = F.when(F.coalesce(train, F.lit(False)), F.when(deleted, DELETED).otherwise(RETAINED)).otherwise(HELD)
    ident = F.col(doc_id).cast("bigint")
    flag = flag + F.when(ident.isNull(), NO_ID).otherwise(0)
    rows = docs.select(F.coalesce(ident, F.lit(0)).alias("doc_id"), flag.cast("int").alias("flag"),
                       text_or_empty(text).cast("binary").alias("text"))
    # Bucketed by chunk, so that the answers come to the chunks and these stay where they are.
    name, path = f"lm_chunks_{uuid.uuid4().hex}", new_path(spark, "lm-chunks")
    buckets = min(int(spark.conf.get("spark.sql.shuffle.partitions")),
                  int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))
    rows.mapInArrow(_chunks(chunk_tokens), CHUNK_SCHEMA).write.option("compression", "zstd").option("path", path) \
        .bucketBy(buckets, "chunk").saveAsTable(name)
    chunks = spark.table(name)
    # Buckets hold about as many n-grams as a chunk has.
    n_tokens = chunks.agg(F.sum("tokens")).first()[0] or 0
    bits = bucket_bits(n_tokens, chunk_tokens)
    answers = chunks.mapInArrow(_messages(order, bits), MESSAGE_SCHEMA) \
        .groupBy("n", "bucket").applyInPandas(_tally, TALLY_SCHEMA)
    placed = stage(chunks.groupBy("chunk").cogroup(answers.groupBy("chunk"))
                   .applyInPandas(_place(order), PLACED_SCHEMA), "lm-placed")
    drop_staged(chunks)
    spark.sql(f"DROP TABLE {name}")
    return Model(placed, learn_weights(placed, order))
