"""Keep one row per key, chosen by an explicit order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """For each key, the row that is smallest under ``order`` (a total order).

    Written as an aggregate (``min_by`` over a row struct) rather than a
    ``row_number`` window: the aggregate combines on the map side, so a key that
    holds a large share of the rows is reduced to one row per task before the
    shuffle instead of being sorted whole in one task. Null keys form one group,
    as pandas ``drop_duplicates`` treats them.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in others])
    picked = df.groupBy(*keys).agg(F.min_by(row, F.struct(*order)).alias("_row"))
    return picked.select(*[F.col(k) for k in keys], *[F.col("_row")[c].alias(c) for c in others]) \
        .select(*df.columns)


def latest_first(ts: str, seq: str = "ingest_seq") -> list[Column]:
    """Order "newest first, missing times last, then by ingest position"."""
    t = F.col(ts)
    return [t.isNull(), -F.unix_micros(t.cast("timestamp")), F.col(seq)]
