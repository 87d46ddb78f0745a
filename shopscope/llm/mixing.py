"""Mix sources to target weights by systematic sampling (DataFrame functions only).

Sources, in code point order with null last, weigh 1, 2, 3, 1, ... and share
all words by weight; a target stops at ``max_copies`` times its source's size
and the excess is shared again by weight (water filling, solved exactly in one
pass over the sources in the order in which their caps bind).

Within a source each document's expected copies are target / source size. The
documents are put in an order, the expected copies are summed up to each one,
one random offset per source is added, and a document is emitted once per
integer boundary its step crosses. The order is: cell, size, doc_id, the other
columns, where a cell is a hash slice of the ids with about ``rows_per_cell``
documents. So the prefix sum is a window within a bounded cell plus the cell's
offset; a source that holds a third of all rows is many cells. Rows without an
id are dealt to cells by their other columns. Rows that share one id, or are
equal in every column, share a cell. Sorting by size within a cell
makes the sample stratified by size, so taken words come near the target.

Cases: a null text has size 0; a source of size 0 gets target 0 and is left
out of the mix. Null sources form one source. Repeated rows are documents of
their own. An empty table gives no rows. Input columns named like an output
column are replaced; all others pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, free_name, stage, text_or_empty

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
ROWS_PER_CELL = 16384
SEED = "mix-1"


def word_count(text: str | Column) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("bigint")


def _hash32(text: Column) -> Column:
    """First 32 bits of the MD5, the same in every SQL engine."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """Targets for (source, source_size): one row per source, so small windows.

    With the sources in order of cap / weight, the sources before the first
    whose share fits under its cap are capped; all others get their share of
    what those leave.
    """
    exact = "decimal(38,0)"
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    ring = F.array(*[F.lit(w) for w in weights])
    s = (sizes.withColumn("_n", F.row_number().over(by_name))
         .withColumn("_w", F.element_at(ring, F.pmod(F.col("_n") - 1, F.lit(len(weights))) + 1).cast("bigint"))
         .withColumn("_cap", F.col("source_size") * F.lit(max_copies)))
    binding = W.orderBy((F.col("_cap") / F.col("_w")), "_n")
    everything = binding.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    s = (s.withColumn("_total", F.sum("source_size").over(everything))
         .withColumn("_left", F.col("_total") - F.coalesce(
             F.sum("_cap").over(binding.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("_w_left", F.sum("_w").over(binding.rowsBetween(W.currentRow, W.unboundedFollowing)))
         .withColumn("_fits", F.col("_left").cast(exact) * F.col("_w").cast("decimal(9,0)")
                     <= F.col("_cap").cast(exact) * F.col("_w_left").cast("decimal(9,0)")))
    share = F.when(F.col("_fits"), F.struct("_left", "_w_left"))
    s = (s.withColumn("_share", F.first(share, ignorenulls=True).over(everything))
         .withColumn("_free", F.max(F.col("_fits").cast("int")).over(
             binding.rowsBetween(W.unboundedPreceding, W.currentRow)) == 1))
    target = F.when(F.col("_free"),
                    (F.col("_w") * F.col("_share._left")).cast("double") / F.col("_share._w_left").cast("double")) \
        .otherwise(F.col("_cap").cast("double"))
    return s.select("source", "source_size", target.alias("target"))


def mix(sized: DataFrame, doc_id: str = "doc_id", source: str = "source", size: str = "size",
        weights=WEIGHTS, max_copies: int = MAX_COPIES, seed: str = SEED,
        rows_per_cell: int = ROWS_PER_CELL) -> DataFrame:
    """``sized`` plus source_size, target, copies and taken, one row per row."""
    slices = max(1, -(-sized.count() // rows_per_cell))
    key, cell, place, rest = (free_name(sized, n) for n in ("_mix_key", "_mix_cell", "_mix_place", "_mix_rest"))
    own = ("source_size", "target", "copies", "taken", "_before", "_rate", "_offset")
    content = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in sized.columns
                                    if c != doc_id and c.lower() not in own])
    rows = (sized.select(*[c for c in sized.columns if c.lower() not in own])
            .withColumn(key, F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n")))
            .withColumn(cell, F.pmod(_hash32(F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("n:"), content))),
                                     F.lit(slices)))
            .withColumn(rest, F.xxhash64(content)))
    cells = stage(rows.groupBy(key, cell).agg(F.count("*").alias("n"), F.sum(size).alias("words"),
                                              F.first(source).alias("source")), "mix-cells")
    sources = cells.groupBy(key).agg(F.sum("words").alias("source_size"), F.first("source").alias("source"))
    targets = source_targets(sources.select("source", "source_size"), weights, max_copies) \
        .withColumn(key, F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")))
    offset = (_hash32(F.concat(F.lit(seed + ":"), F.col(key))) + F.lit(0.5)) / F.lit(4294967296.0)
    before = F.coalesce(F.sum("n").over(W.partitionBy(key).orderBy(cell).rowsBetween(W.unboundedPreceding, -1)),
                        F.lit(0))
    placed = (cells.withColumn("_before", before).drop("source").join(targets, key)
              .select(key, cell, "_before", "source_size", "target",
                      F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                      .otherwise(F.lit(0.0)).alias("_rate"), offset.alias("_offset")))
    order = W.partitionBy(key, cell).orderBy(size, F.col(doc_id).asc_nulls_last(), rest)
    step = F.col("_before") + F.col(place)
    copies = (F.floor(step * F.col("_rate") + F.col("_offset"))
              - F.floor((step - 1) * F.col("_rate") + F.col("_offset")))
    return (rows.withColumn(place, F.row_number().over(order).cast("bigint"))
            .join(placed, [key, cell])
            .withColumn("copies", copies.cast("bigint"))
            .withColumn("taken", (F.col("copies") * F.col(size)).cast("bigint"))
            .drop(key, cell, place, rest, "_before", "_rate", "_offset"))


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", source: str = "source",
                    text: str = "text", **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, columns unchanged."""
    size = free_name(docs, "_mix_size")
    names = {c: free_name(docs, f"_mix_in_{i}") for i, c in enumerate(docs.columns)
             if c.lower() in ("source_size", "target", "copies", "taken", "_before", "_rate", "_offset")}
    sized = docs.withColumn(size, word_count(text)).withColumnsRenamed(names)
    mixed = mix(sized, doc_id, source, size, **options).where("copies > 0")
    return (mixed.withColumn("copies", F.explode(F.expr("sequence(1L, copies)")))
            .select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns]))
