"""Broadcast hints that are given only behind a checked size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Most bytes of a side that is shipped whole to every task.
BROADCAST_BYTES = 64 * 1024 * 1024
_FIXED_BYTES = 16  # of a value of fixed size, with its share of the row's overhead


def side_bytes(df: DataFrame) -> int:
    """Bytes of all rows in memory, counted: text by its length, other columns
    by a fixed size. Every task sums up its own rows; one row per task is merged."""
    width = F.lit(_FIXED_BYTES * (1 + len(df.columns)))
    for field in df.schema.fields:
        if isinstance(field.dataType, StringType):
            width = width + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
    return int(df.agg(F.sum(width.cast("bigint"))).first()[0] or 0)


def looked_up(rows: DataFrame, side: DataFrame, key: str, home: str, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``rows`` left-joined with ``side`` on ``key``, left where they lie by ``home``.

    A large ``side`` does not move the rows: their distinct (home, key) pairs
    are shuffled to it, and what they find goes back to ``home``. Rows without
    a home, for which that finds nothing, are joined by their key.
    """
    if side_bytes(side) <= max_bytes:
        return rows.join(F.broadcast(side), key, "left")
    pairs = rows.select(home, key).where(F.col(home).isNotNull() & F.col(key).isNotNull()).distinct()
    found = pairs.join(side, key).withColumnsRenamed({home: "_home", key: "_key"})
    # An equality on both columns would move the rows by both, so the key is
    # compared among the few rows of a home.
    out = rows.join(found, (F.col(home) == F.col("_home")) & (F.col(key) >= F.col("_key")) & (F.col(key) <= F.col("_key")),
                    "left").drop("_home", "_key")
    homeless = rows.where(F.col(home).isNull())
    if homeless.isEmpty():
        return out
    return out.where(F.col(home).isNotNull()).unionByName(homeless.join(side, key, "left"))


def bounded_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES,
                      probe: DataFrame | None = None) -> DataFrame:
    """Mark ``df`` for broadcast only when its size is proven small.

    ``probe`` is a cheaper frame whose size bounds that of ``df`` (for example
    the raw scan a deduplicated dimension comes from). Beyond the bound the
    frame is returned unchanged and the planner (with adaptive execution)
    chooses a shuffled join.
    """
    return F.broadcast(df) if side_bytes(probe if probe is not None else df) <= max_bytes else df
