"""Ranked lexical search by dense blocked matrix products.

Every document is scored for every item (a query text) as the sum, over the
item's terms with repeats, of the term's weight times its impact in the
document. All numbers are whole:

    weight(t)    = floor(1000 ln((2N + 2) / (2 df + 1)))
    m(d)         = 75 + 25 n N div L
    impact(t, d) = 10^9 tf div (1000 tf + 12 m(d))

with N documents that hold a term, L their terms, n the document's terms.

Items come in blocks of at most ``BLOCK_ITEMS`` items and ``BLOCK_BYTES`` bytes
of text (or one longer item), so what a block broadcasts is bounded whatever
the item table holds. For a block:

1. One pass over the documents finds the tf of the block's vocabulary in each,
   and n. It is written; N, L and df are sums over it.
2. The vocabulary is cut into tiles. Per batch of documents, a tile's
   items x terms weights (float64) are multiplied by its terms x documents
   impacts, compacted to the terms that occur. An impact is below 10^6, and a
   tile ends before the weights of any item reach 2^53 / 10^6, so no partial
   sum reaches 2^53 and every product is exact; a weight above that bound
   takes part of itself in several tiles. Tiles add up in 64-bit integers.
3. Each task keeps its best k per item (a document that ties with the k-th is
   kept until the ids decide), and a window over these gives the ranking.

Cases: a null or termless text neither counts nor matches. Equal scores rank by
ascending id, null ids last. Repeated documents are ranked each; item rows
equal in id and text are one item. An empty table on either side gives no rows.
Only the id and text columns are read. Memory of a task: one tile, and a
document's terms in pieces of ``PIECE`` bytes.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import drop_staged, ship, stage, text_or_empty

K = 20
BLOCK_ITEMS = 256
BLOCK_BYTES = 4 << 20
TILE_TERMS = 2048
TILE_DOCS = 1024
PIECE = 1 << 20
MAX_IMPACT = 10**6
WEIGHT_BOUND = (2**53 - 1) // MAX_IMPACT
MERGE_SLICES = 64

# Digits, letters (A-Z as a-z) and bytes from 0x80 on are terms; all else is a space.
_TERMS = bytes((b | 0x20 if 0x41 <= b <= 0x5A else b) if chr(b).isalnum() or b >= 0x80 else 0x20 for b in range(256))

TF_SCHEMA = "doc_id bigint, n bigint, terms array<int>, tf array<bigint>"
FOUND_SCHEMA = "item int, doc_id bigint, score bigint"


def term_counts(text: bytes) -> Counter:
    """Terms with their numbers; long texts are read in pieces that end between terms."""
    found: Counter = Counter()
    begin = 0
    while begin < len(text):
        end = begin + PIECE
        piece = text[begin:end].translate(_TERMS)
        while end < len(text) and piece[-1:] != b" ":
            piece += text[end:end + PIECE].translate(_TERMS)
            cut = piece.rfind(b" ")
            if cut >= 0:  # back to the last gap
                piece = piece[:cut + 1]
                end = begin + len(piece)
            else:
                end += PIECE
        found.update(piece.split())
        begin += len(piece)
    return found


# ---- items ---------------------------------------------------------------------

def item_blocks(items: DataFrame, item_id: str, text: str, block_items: int, block_bytes: int):
    """Blocks of (ids, term counts); the driver holds one block and one partition."""
    rows = items.select(F.col(item_id).alias("id"), text_or_empty(text).cast("binary").alias("text")).distinct()
    block, size = [], 0
    for r in rows.toLocalIterator():
        if block and (len(block) == block_items or size + len(r["text"]) > block_bytes):
            yield block
            block, size = [], 0
        terms = term_counts(bytes(r["text"]))
        if terms:
            block.append((r["id"], terms))
            size += len(r["text"])
    if block:
        yield block


def weight_tiles(block, weight: list[int], numbers: dict[bytes, int], tile_terms: int, bound: int = WEIGHT_BOUND):
    """Tiles of (terms, items x terms weights), each item's weights below ``bound``
    in sum: terms in order, and of a weight that does not fit its parts."""
    by_term: list[list[tuple[int, int]]] = [[] for _ in numbers]
    for i, (_, terms) in enumerate(block):
        for t, times in terms.items():
            if weight[numbers[t]]:
                by_term[numbers[t]].append((i, weight[numbers[t]] * times))
    used, terms, cells = [0] * len(block), [], []

    def tile():
        dense = np.zeros((len(block), len(terms)))
        for column, row, value in cells:
            dense[row, column] = value
        return np.array(terms, np.int64), dense

    for t, rows in enumerate(by_term):
        while rows:
            if len(terms) == tile_terms or (terms and any(used[i] == bound for i, _ in rows)):
                yield tile()
                used, terms, cells = [0] * len(block), [], []
            rest = []
            for i, value in rows:
                part = min(value, bound - used[i])
                if part:
                    cells.append((len(terms), i, part))
                    used[i] += part
                if part < value:
                    rest.append((i, value - part))
            terms.append(t)
            rows = rest
    if terms:
        yield tile()


# ---- documents -------------------------------------------------------------------

def _frequencies(vocabulary):
    def run(batches):
        numbers = vocabulary.value
        for batch in batches:
            ids, n, ends, terms, tf = [], [], [0], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = term_counts(text)
                if not counts:
                    continue
                ids.append(doc_id)
                n.append(sum(counts.values()))
                if len(counts) > len(numbers):
                    hits = [(i, counts[t]) for t, i in numbers.items() if t in counts]
                else:
                    hits = [(numbers[t], c) for t, c in counts.items() if t in numbers]
                terms += [i for i, _ in hits]
                tf += [c for _, c in hits]
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(ids, pa.int64()), "n": pa.array(n, pa.int64()),
                "terms": pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                "tf": pa.ListArray.from_arrays(offsets, pa.array(tf, pa.int64()))})
    return run


def _best(tiles, n_items: int, n_terms: int, total_docs: int, total_terms: int, k: int, tile_docs: int):
    def run(batches):
        blocks = tiles.value
        best: list[tuple[np.ndarray, ...]] = []
        floor = np.ones(n_items, np.int64)  # a score below it can't be among the best any more
        held = 0

        def cut():
            item, score, doc, null = (np.concatenate(x) for x in zip(*best))
            rank = np.lexsort((doc, null, -score, item))
            item, score, doc, null = item[rank], score[rank], doc[rank], null[rank]
            begins = np.flatnonzero(np.diff(item, prepend=-1))
            place = np.arange(len(item)) - np.repeat(begins, np.diff(np.append(begins, len(item))))
            last = np.flatnonzero(place == k - 1)
            floor[item[last]] = score[last]
            keep = place < k
            return [(item[keep], score[keep], doc[keep], null[keep])]

        for batch in batches:
            for at in range(0, batch.num_rows, tile_docs):
                part = batch.slice(at, tile_docs)
                doc, null = part.column(0).fill_null(0).to_numpy(), part.column(0).is_null().to_numpy(zero_copy_only=False)
                n = part.column(1).to_numpy()
                terms, tf = (part.column(c).flatten().to_numpy() for c in (2, 3))
                owner = np.repeat(np.arange(len(n)), np.asarray(part.column(2).value_lengths()))
                m = 75 + (25 * n * total_docs) // total_terms
                impact = (10**9 * tf) // (1000 * tf + 12 * m[owner])
                scores = np.zeros((n_items, len(n)), np.int64)
                place = np.full(n_terms, -1, np.int64)
                for tile_terms, weights in blocks:
                    place[tile_terms] = np.arange(len(tile_terms))
                    column = place[terms]
                    hit = np.flatnonzero(column >= 0)
                    used, row = np.unique(column[hit], return_inverse=True)
                    dense = np.zeros((len(used), len(n)))
                    dense[row, owner[hit]] = impact[hit]
                    scores += (weights[:, used] @ dense).astype(np.int64)
                    place[tile_terms] = -1
                item, d = np.nonzero(scores >= floor[:, None])
                if len(item):
                    best.append((item, scores[item, d], doc[d], null[d]))
                    held += len(item)
                if held > 4 * k * n_items:
                    best = cut()
                    held = len(best[0][0])
        if best:
            item, score, doc, null = cut()[0]
            yield pa.RecordBatch.from_pydict({"item": pa.array(item, pa.int32()),
                                              "doc_id": pa.array(doc, pa.int64(), mask=null),
                                              "score": pa.array(score, pa.int64())})
    return run


def _block_best(spark: SparkSession, docs: DataFrame, block, k: int, tile_terms: int, tile_docs: int) -> DataFrame:
    """(item, doc_id, score): the best k documents of every task for a block's items."""
    vocabulary = sorted({t for _, terms in block for t in terms})
    numbers = {t: i for i, t in enumerate(vocabulary)}
    tf = stage(docs.mapInArrow(_frequencies(spark.sparkContext.broadcast(numbers)), TF_SCHEMA), "lexical-tf")
    total_docs, total_terms = tf.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = [0] * len(vocabulary)
    for r in tf.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # at most the vocabulary
        df[r["t"]] = r["count"]
    weight = [math.floor(1000 * math.log((2 * total_docs + 2) / (2 * x + 1))) if x else 0 for x in df]
    tiles = spark.sparkContext.broadcast(list(weight_tiles(block, weight, numbers, tile_terms)))
    found = stage(tf.mapInArrow(_best(tiles, len(block), len(vocabulary), total_docs, max(total_terms, 1), k,
                                      tile_docs), FOUND_SCHEMA), "lexical-best")
    drop_staged(tf)
    return found


def rank_documents(docs: DataFrame, items: DataFrame, k: int = K, doc_id: str = "doc_id", text: str = "text",
                   item_id: str = "item_id", item_text: str = "text", block_items: int = BLOCK_ITEMS,
                   block_bytes: int = BLOCK_BYTES, tile_terms: int = TILE_TERMS,
                   tile_docs: int = TILE_DOCS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` best documents with a score above 0."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).cast("binary").alias("text"))
    id_type = items.schema[item_id].dataType
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    result = spark.createDataFrame([], "rank int, doc_id bigint, score bigint") \
        .select(F.lit(None).cast(id_type).alias("item_id"), "rank", "doc_id", "score")
    for block in item_blocks(items, item_id, item_text, block_items, block_bytes):
        found = _block_best(spark, rows, block, k, tile_terms, tile_docs)
        # Best of slices of the tasks first, so that no window gets k rows of every task.
        some = W.partitionBy("item", F.pmod(F.spark_partition_id(), F.lit(MERGE_SLICES))).orderBy(*order)
        found = found.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= k)
        every = W.partitionBy("item").orderBy(*order)
        found = found.withColumn("rank", F.row_number().over(every)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, ident) for i, (ident, _) in enumerate(block)],
                                      f"item int, item_id {id_type.simpleString()}")
        ranked = found.join(F.broadcast(names), "item")  # one row per item of the block
        result = result.unionByName(ranked.select("item_id", "rank", "doc_id", "score"))
    return result
