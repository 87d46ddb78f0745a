"""SimHash near-dedup with Golay-code fuzzy hashing.

Fingerprint: the text with A-Z lower-cased is split into words; every run of
``shingle`` words, joined by spaces, is hashed with XXH64 (seed 42); a bit of
the fingerprint is set if more than half of the hashes have it set.

Candidates: the 64 bits are cut into segments of 22, 21 and 21 bits, each read
as a 23-bit word of the perfect Golay code [23,12,7]. Decoding a word and its
one-bit neighbours gives the indices (12 bits) of up to six nearby codewords.
With at most four differing bits, the three segments' errors e1 <= e2 <= e3
are (0,0,x), (0,1,x), (1,1,x) or (0,2,2), so either

* two segments differ in at most one bit each: key (pair, nearby index of the
  one, own index of the other) is shared, as a word's own index is among the
  nearby indices of any word one bit away, or
* one segment is equal: key (segment, its bits) is shared.

Keys that meet are verified on the full fingerprints. All of this runs on
distinct fingerprints, so a group of exact copies is one row. Within one key
only a spanning forest of the verified links is emitted, not all pairs: it
connects the same documents. A key with over ``max_run`` distinct fingerprints
is not taken in one task but cut into blocks, and every pair of blocks is a
task of its own, so no link is lost and memory stays bounded.

Cases: null and empty texts have fingerprint zero and link like any other. A
null doc_id is a row like others; a component with only null ids has a null
component_id. Repeated rows are rows of one component. Other columns are
ignored. An empty table gives no rows.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, free_name, keep_rows, row_key, ship, stage
from .components import components

SHINGLE = 4
MAX_BITS = 4
MAX_RUN = 8192
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # (shift, bits)
_LOWER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}
_words = re.compile(WORD).findall
_HASH_BLOCK = 65536  # hashes held at a time, whatever the text's length


# -- fingerprints -----------------------------------------------------------

def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of one whole text as an unsigned 64-bit integer."""
    from xxhash import xxh64_intdigest
    words = _words((text or "").translate(_LOWER))
    if not words:
        return 0
    joined = " ".join(words).encode("utf-8", "surrogatepass")
    raw = np.frombuffer(joined, np.uint8)
    gaps = np.flatnonzero(raw == 32)
    starts = np.concatenate(([0], gaps + 1))
    ends = np.concatenate((gaps, [len(joined)]))
    n = max(1, len(starts) - shingle + 1)
    starts, ends = starts[:n].tolist(), ends[min(shingle, len(ends)) - 1:].tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, n, _HASH_BLOCK):
        hashes = np.array([xxh64_intdigest(joined[s:e], 42)
                           for s, e in zip(starts[at:at + _HASH_BLOCK], ends[at:at + _HASH_BLOCK])], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little") \
            .sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str, text: str, shingle: int, carry=None) -> DataFrame:
    """(doc_id, fp bigint[, carry]) of every row."""
    ship(docs.sparkSession)
    cols = [F.col(doc_id).alias("doc_id"), F.col(text).alias("text")]
    if carry is not None:
        cols.append(carry.alias("carry"))
    source = docs.select(*cols)
    rest = [c for c in source.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in rest] + [pa.array(fps.view(np.int64))],
                                             names=[*rest, "fp"])

    fields = [source.schema[c] for c in rest]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return source.mapInArrow(run, f"{schema}, fp bigint")


# -- Golay keys -------------------------------------------------------------

@lru_cache(maxsize=1)
def golay() -> tuple[np.ndarray, np.ndarray]:
    """Parity bits by data word, and the error pattern by syndrome (perfect
    code: every syndrome is that of exactly one pattern of at most 3 errors)."""
    generator = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
    parity = np.arange(4096, dtype=np.int64) << 11
    for bit in range(22, 10, -1):
        parity = np.where(parity >> bit & 1, parity ^ (generator << (bit - 11)), parity)
    errors = np.zeros(2048, np.int64)
    for weight in range(1, 4):
        for bits in itertools.combinations(range(23), weight):
            word = sum(1 << b for b in bits)
            errors[parity[word >> 11] ^ (word & 2047)] = word
    return parity, errors


def codeword_index(words: np.ndarray) -> np.ndarray:
    """Index (data bits) of the one codeword within three bits of each 23-bit word."""
    parity, errors = golay()
    return (words ^ errors[parity[words >> 11] ^ (words & 2047)]) >> 11


def golay_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All keys of each fingerprint: (position in fps, key), without repeats."""
    segments = [(fps >> np.uint64(s) & np.uint64((1 << n) - 1)).astype(np.int64) for s, n in SEGMENTS]
    own = [codeword_index(x) for x in segments]
    near = []
    for x, (_, n) in zip(segments, SEGMENTS):
        flips = np.concatenate(([0], 1 << np.arange(n, dtype=np.int64)))
        near.append(codeword_index(x[:, None] ^ flips[None, :]))
    keys = []
    for pair, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        keys.append(pair << 56 | near[i] << 12 | own[j][:, None])
        keys.append(pair << 56 | own[i][:, None] << 12 | near[j])
    for i, x in enumerate(segments):
        keys.append((3 + i << 56 | x)[:, None])
    table = np.sort(np.concatenate(keys, axis=1), axis=1)
    new = np.ones(table.shape, bool)
    new[:, 1:] = table[:, 1:] != table[:, :-1]
    return np.nonzero(new)[0], table[new]


def _emit_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column("fp").to_numpy(zero_copy_only=False)
        for at in range(0, len(fps), 4096):
            part = fps[at:at + 4096]
            row, key = golay_keys(part.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[row])], names=["key", "fp"])


# -- links ------------------------------------------------------------------

def _near(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    return np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)) <= max_bits


def spanning_links(fps: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the graph of fingerprints within max_bits."""
    left, right, rest = [], [], fps
    while rest.size > 1:
        front, rest = rest[:1], rest[1:]
        while front.size and rest.size:
            hit = np.zeros(rest.size, bool)
            parent = np.zeros(rest.size, rest.dtype)
            for at in range(0, front.size, 256):
                near = _near(front[at:at + 256, None], rest[None, :], max_bits)
                found = near.any(axis=0) & ~hit
                parent[found] = front[at:at + 256][near.argmax(axis=0)[found]]
                hit |= found
            left.append(parent[hit])
            right.append(rest[hit])
            front, rest = rest[hit], rest[~hit]
    empty = [np.zeros(0, fps.dtype)]
    return np.concatenate(left or empty), np.concatenate(right or empty)


def _link_sorted(key: np.ndarray, fp: np.ndarray, max_bits: int, max_run: int):
    """Links and overfull keys among whole runs of equal keys."""
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    lengths = np.diff(np.append(starts, len(key)))
    left, right, hot = [], [], key[starts[lengths > max_run]]
    small = np.repeat(lengths <= 8, lengths)
    for step in range(1, 8):
        at = np.flatnonzero((key[step:] == key[:-step]) & small[step:]) if len(key) > step else []
        if not len(at):
            break
        at = at[_near(fp[at], fp[at + step], max_bits)]
        left.append(fp[at])
        right.append(fp[at + step])
    for i in np.flatnonzero((lengths > 8) & (lengths <= max_run)):
        a, b = spanning_links(fp[starts[i]:starts[i] + lengths[i]], max_bits)
        left.append(a)
        right.append(b)
    empty = [np.zeros(0, np.int64)]
    return np.concatenate(left or empty), np.concatenate(right or empty), hot


def _linker(max_bits: int, max_run: int):
    def out(a, b, hot) -> pa.RecordBatch:
        none = pa.nulls(len(hot), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays([pa.array(a), none]), pa.concat_arrays([pa.array(b), none]),
             pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(hot)])], names=["a", "b", "hot"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = fp = np.zeros(0, np.int64)
        overfull = None  # a key whose run went over max_run; its other rows are passed over here
        for batch in batches:
            k = batch.column("key").to_numpy(zero_copy_only=False)
            f = batch.column("fp").to_numpy(zero_copy_only=False)
            if overfull is not None:
                k, f = k[k != overfull], f[k != overfull]
            if not len(k):
                continue
            key, fp = np.concatenate((key, k)), np.concatenate((fp, f))
            last = np.searchsorted(key, key[-1])  # the last run may go on in the next batch
            if last:
                yield out(*_link_sorted(key[:last], fp[:last], max_bits, max_run))
            key, fp = key[last:], fp[last:]
            if len(key) > max_run:
                overfull = key[0]
                yield out(key[:0], fp[:0], key[:1])
                key, fp = key[:0], fp[:0]
        if len(key):
            yield out(*_link_sorted(key, fp, max_bits, max_run))

    return run


def _overfull_links(keys: DataFrame, hot: DataFrame, max_bits: int, max_run: int) -> DataFrame:
    """Links within the overfull keys: every pair of hash blocks is one group."""
    half = max(1, max_run // 2)
    rows = keys.join(hot, "key", "left_semi")
    blocks = rows.groupBy("key").agg(F.ceil(F.count("*") / F.lit(half)).alias("blocks"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    tiles = (stage(rows, "overfull").join(blocks, "key").withColumn("own", own)
             .withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
             .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp"))

    def link(pdf):
        import pandas as pd
        a, b = spanning_links(np.unique(pdf["fp"].to_numpy(np.int64)), max_bits)
        return pd.DataFrame({"a": a, "b": b})

    return tiles.groupBy("key", "i", "j").applyInPandas(link, "a bigint, b bigint")


def near_links(fps: DataFrame, max_bits: int = MAX_BITS, max_run: int = MAX_RUN) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints within max_bits.

    ``fps`` has one bigint column ``fp`` without repeats.
    """
    if max_bits > 4:
        raise ValueError("three Golay segments find at most four differing bits")
    keys = fps.mapInArrow(_emit_keys, "key bigint, fp bigint")
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = stage(keys.repartition(parts, "key").sortWithinPartitions("key", "fp")
                  .mapInArrow(_linker(max_bits, max_run), "a bigint, b bigint, hot bigint"), "links")
    links = found.where("hot is null").select("a", "b")
    hot = found.where("hot is not null").select(F.col("hot").alias("key")).distinct()
    if not hot.isEmpty():
        links = links.union(_overfull_links(keys, hot, max_bits, max_run))
    return links


def _hex(fp: str):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def simhash_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                       max_bits: int = MAX_BITS, max_run: int = MAX_RUN, carry=None) -> DataFrame:
    """Every row's (doc_id, fingerprint, component_id, root[, carry]).

    ``root`` is a fingerprint that names the component, also without ids.
    """
    rows = stage(fingerprints(docs, doc_id, text, shingle, carry), "fingerprints")
    distinct = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fps")
    roots = components(near_links(distinct.select("fp"), max_bits, max_run))
    labelled = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    classes = stage(labelled.join(labelled.groupBy("root").agg(F.min("first_id").alias("component_id")), "root")
                    .select("fp", "component_id", "root"), "classes")
    return rows.join(classes, "fp").select(
        "doc_id", _hex("fp").alias("fingerprint"), "component_id", _hex("root").alias("root"),
        *([F.col("carry")] if carry is not None else []))


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id,
    null ids last, then of the smallest fingerprint and row key."""
    key = free_name(docs, "_row_key")
    found = simhash_components(docs, doc_id, text, carry=row_key(doc_id, text), **options)
    kept = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id",
                                                    "fingerprint", "carry")).alias("least")) \
        .select(F.col("least.carry").alias(key))
    return keep_rows(docs.withColumn(key, row_key(doc_id, text)), kept, key).select(*docs.columns)
