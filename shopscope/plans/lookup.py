"""Physical layout for lookups by several columns, in place of secondary indexes.

A sorted table serves lookups by its leading sort column alone. Here the rows
are ordered by an interleaved key (Z-order): each clustering column is cut into
ranges of about equally many rows, and the bits of the range numbers alternate,
the highest first. A row group then covers a narrow range of every clustering
column, so Parquet min/max statistics skip most groups for any of them. Columns
with many values (ids) get Bloom filters, which say of a single value that a
group does not hold it.

The range borders come from a sample of about ``SAMPLE_ROWS`` rows, whatever
the table's size; the sample decides only where rows lie, never which rows a
query returns. A row's range number is a balanced tree of comparisons in
generated code. Rows of one key (a state with a third of the table) are spread
over files by a hash, so no task writes them all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 20_000
# Bits per clustering column: 2^6 ranges each.
RANGE_BITS = 6


@dataclass(frozen=True)
class Layout:
    """Folders, clustering columns and Bloom filter columns of a written table."""

    cluster: tuple[str, ...] = ()
    bloom: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    options: Mapping[str, str] = field(default_factory=dict)


# The nine indexed lookups of the source: orders by customer, status and time,
# items by product and seller, the fact by time (folders), customer, category
# and state; the fact's product and seller are filtered too.
LAYOUTS = {
    "orders": Layout(cluster=("order_status", "order_purchase_timestamp"), bloom=("customer_id",)),
    "order_items": Layout(cluster=("product_id", "seller_id"), bloom=("product_id", "seller_id")),
    "fact_orders": Layout(
        cluster=("customer_state", "product_category_name_english", "order_purchase_timestamp"),
        bloom=("customer_id", "product_id", "seller_id"), partition_by=("order_year", "order_month")),
}


def range_borders(df: DataFrame, columns: Sequence[str], bits: int = RANGE_BITS,
                  sample_rows: int = SAMPLE_ROWS) -> dict[str, list]:
    """Per column up to 2^bits - 1 borders that cut a sample evenly; a frequent
    value fills several places. A column without values has none."""
    total = df.count()
    picked = df.select(*columns) if total <= sample_rows else \
        df.select(*columns).sample(fraction=sample_rows / total, seed=11)
    rows = picked.collect()
    n = 1 << bits
    out = {}
    for c in columns:
        values = sorted(r[c] for r in rows if r[c] is not None)
        out[c] = [values[len(values) * i // n] for i in range(1, n)] if values else []
    return out


def range_number(col: Column, borders: Sequence) -> Column:
    """How many borders are at or below the value; 0 for null."""
    def number(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        # Equal neighbours: the comparison that decides is the last of them.
        while middle + 1 < high and borders[middle + 1] == borders[middle]:
            middle += 1
        return F.when(col >= F.lit(borders[middle]), number(middle + 1, high)).otherwise(number(low, middle))
    return number(0, len(borders))


def interleaved(numbers: Sequence[Column], bits: int = RANGE_BITS) -> Column:
    """The numbers' bits in turn, the highest of each first, as one bigint."""
    if len(numbers) * bits > 62:
        raise ValueError("an interleaved key has at most 62 bits")
    key, place = F.lit(0).cast("bigint"), len(numbers) * bits
    for bit in reversed(range(bits)):
        for number in numbers:
            place -= 1
            key = key.bitwiseOR(F.shiftleft(F.shiftright(number, bit).bitwiseAND(F.lit(1)).cast("bigint"), place))
    return key


def clustered(df: DataFrame, layout: Layout, partitions: int | None = None) -> DataFrame:
    """``df`` dealt into ranges of (folder, interleaved key) and sorted by it."""
    if not layout.cluster:
        return df
    borders = range_borders(df, layout.cluster)
    # The columns themselves order the rows of one cell.
    order = [F.col(c) for c in layout.partition_by]
    order.append(interleaved([range_number(F.col(c), borders[c]) for c in layout.cluster]))
    spread = F.xxhash64(*df.columns)
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(partitions, *order, spread) \
        .sortWithinPartitions(*order, *layout.cluster)


def write_options(layout: Layout) -> dict[str, str]:
    """Parquet options: a Bloom filter per named column, sized by what a row group holds."""
    options = {f"parquet.bloom.filter.enabled#{c}": "true" for c in layout.bloom}
    if layout.bloom:
        options["parquet.bloom.filter.adaptive.enabled"] = "true"
    return {**options, **layout.options}


def write_layout(df: DataFrame, name: str, layout: Layout, partitions: int | None = None) -> None:
    """Replace a catalog table, its rows laid out for lookups."""
    writer = clustered(df, layout, partitions).write.mode("overwrite").format("parquet") \
        .options(**write_options(layout))
    if layout.partition_by:
        writer = writer.partitionBy(*layout.partition_by)
    writer.saveAsTable(name)
