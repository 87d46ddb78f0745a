"""Exact global ranking without a single-partition window.

``NTILE(k) OVER (ORDER BY ...)`` with no ``PARTITION BY`` makes Spark move
every row into one task. That is fine for a few hundred months or categories
and impossible for every customer or seller of a large shop.

``exact_tiles`` finds the last row of each tile from counts per key range, for
several orders at once, and then compares every row with these borders: lazy,
without a sort of the whole frame. ``global_row_number`` gives every row its
position by range partitioning and per-task offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopscope.session import shared_dir

_PID, _MID, _POS, _OFF, _N = "_rk_pid", "_rk_mid", "_rk_pos", "_rk_off", "_rk_n"


def global_row_number(df: DataFrame, order: Sequence[Column], name: str = "row_number",
                      total: str | None = None, partitions: int | None = None) -> DataFrame:
    """Add the 1-based position of each row under ``order`` (must be a total order).

    Steps: range-partition on the full order (ties are split because the order
    ends in a unique column, so a value shared by a third of the rows still
    spreads over many tasks), sort inside each partition, record partition id
    and position, and checkpoint so the sampled range bounds are fixed even if
    tasks are re-run. Counts per partition give offsets in a table of at most
    ``partitions`` rows, which is broadcast back.
    """
    spark = df.sparkSession
    shared_dir(spark)  # the reliable checkpoint needs the shared folder
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n_parts, *order)
              .sortWithinPartitions(*order)
              .withColumn(_PID, F.spark_partition_id())
              .withColumn(_MID, F.monotonically_increasing_id())
              .checkpoint(eager=True))
    # monotonically_increasing_id = partition index << 33 | position in partition
    ranged = ranged.withColumn(_POS, F.col(_MID) - F.shiftleft(F.col(_PID).cast("bigint"), 33))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy(_PID).agg(F.count(F.lit(1)).alias("_cnt"))
               .select(_PID,
                       F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias(_OFF),
                       F.sum("_cnt").over(Window.partitionBy()).alias(_N)))
    # At most n_parts rows: a proven bound for the broadcast.
    out = ranged.join(F.broadcast(offsets), _PID).withColumn(name, F.col(_OFF) + F.col(_POS) + 1)
    if total:
        out = out.withColumnRenamed(_N, total)
    return out.drop(_PID, _MID, _POS, _OFF, *([] if total else [_N]))


def ntile_of(position: Column, total: Column, k: int) -> Column:
    """``NTILE(k)`` from a 1-based position and the row count.

    The first ``total % k`` tiles hold one row more than the others.
    """
    base = F.floor(total / k)
    extra = total % k
    big = extra * (base + 1)
    return F.when(position <= big, F.floor((position - 1) / (base + 1)) + 1) \
        .otherwise(extra + F.floor((position - 1 - big) / F.greatest(base, F.lit(1))) + 1) \
        .cast("int")


def distributed_ntile(df: DataFrame, k: int, order: Sequence[Column], name: str = "ntile",
                      partitions: int | None = None) -> DataFrame:
    """Exact ``NTILE(k) OVER (ORDER BY order)`` computed across all tasks."""
    ranked = global_row_number(df, order, name="_rk_rn", total="_rk_total", partitions=partitions)
    return ranked.withColumn(name, ntile_of(F.col("_rk_rn"), F.col("_rk_total"), k)) \
        .drop("_rk_rn", "_rk_total")


# ---- tiles from border rows -------------------------------------------------

TILE_WIDTH = 128  # a power of two; its square is the number of key ranges that are counted


def ascending(value: Column) -> list[Column]:
    """Key columns for ``value ASC NULLS LAST``."""
    return [value.isNull(), value]


def descending(value: Column) -> list[Column]:
    """Key columns for ``value DESC NULLS FIRST`` of a number."""
    return [-value]


def _key_ranges(rows: DataFrame, width: int) -> DataFrame:
    """Add ``bin``, the number of cuts below the row's key. The cuts are a random
    sample of each group's keys: of every residue of the key's hash the row with
    the least hash. They depend on the rows alone, so a rerun task agrees. A row
    meets the first cut of each run of ``width`` cuts, then one run: the joins
    copy their arrays to every row, which the whole list would make dear."""
    h = F.xxhash64("key")
    cuts = rows.groupBy("g", h.bitwiseAND(width * width - 1).alias("residue")).agg(F.min_by("key", h).alias("key")) \
        .groupBy("g").agg(F.sort_array(F.collect_list("key")).alias("cuts"))
    runs = cuts.select("g", F.expr(f"""transform(sequence(0, int(ceil(size(cuts) / {width})) - 1),
                                                 c -> slice(cuts, c * {width} + 1, {width}))""").alias("runs"))
    steps = ", ".join(str(width >> i) for i in range(width.bit_length()))

    def below(cuts: str) -> Column:
        return F.expr(f"aggregate(array({steps}), 0, (p, step) -> IF(get({cuts}, p + step - 1) < key, p + step, p))")

    # width ** 2 keys per group in all: a proven bound for both broadcasts.
    firsts = F.broadcast(runs.select("g", F.expr("transform(runs, x -> x[0])").alias("firsts")))
    inner = F.broadcast(runs.select("g", F.posexplode("runs").alias("c", "cuts")))
    return rows.join(firsts, "g").select("g", "key", F.greatest(below("firsts") - 1, F.lit(0)).alias("c")) \
        .join(inner, ["g", "c"]).select("g", "key", (F.col("c") * width + below("cuts")).alias("bin"))


def _tile_borders(rows: DataFrame, tiles: Sequence[int], width: int) -> DataFrame:
    """(g, key): the last key of every tile but the last, of each order ``g``.

    The counts per key range say which range holds a border and at which place;
    only the rows of those ranges, about one in ``width ** 2``, are sorted.
    """
    binned = _key_ranges(rows, width)
    whole = Window.partitionBy("g")  # at most width ** 2 + 1 rows a group
    n, k, i = F.col("n"), F.col("k"), F.col("i")
    borders = binned.groupBy("g", "bin").agg(F.count(F.lit(1)).alias("cnt")) \
        .withColumn("before", F.sum("cnt").over(whole.orderBy("bin")) - F.col("cnt")) \
        .withColumn("n", F.sum("cnt").over(whole)) \
        .withColumn("k", F.element_at(F.array(*map(F.lit, tiles)), F.col("g") + 1)) \
        .withColumn("i", F.explode(F.sequence(F.lit(1), k - 1))) \
        .withColumn("r", i * F.floor(n / k) + F.least(i.cast("bigint"), n % k) - F.col("before")) \
        .where((F.col("r") > 0) & (F.col("r") <= F.col("cnt"))).select("g", "bin", "i", "r")
    place = F.row_number().over(Window.partitionBy("g", "i").orderBy("key"))
    # One row per border: a proven bound.
    return binned.join(F.broadcast(borders), ["g", "bin"]).withColumn("place", place) \
        .where(F.col("place") == F.col("r")).select("g", "key")


def exact_tiles(df: DataFrame, orders: dict[str, tuple[int, Sequence[Column]]],
                width: int = TILE_WIDTH) -> DataFrame:
    """Add ``NTILE(k) OVER (ORDER BY ...)`` for every ``{name: (k, key columns)}``.

    Key columns compare ascending with nulls first (see ``ascending`` and
    ``descending``) and must be unique together: end them with an id. k is 2 or
    more. Nothing runs before an action and nothing is checkpointed: the passes
    share one shuffled input where the planner can reuse it, their shuffles hold
    counts only, and the borders (a few keys) reach the rows as a subquery value.
    An empty frame gives none.
    """
    wide = {name: [c.alias(f"k{j}_{m}") for m, c in enumerate(cols)]
            for j, (name, (_, cols)) in enumerate(orders.items())}
    types = {name: df.select(*cols).schema.fields for name, cols in wide.items()}

    def key(name: str) -> Column:
        # Each order has its own fields; those of the others are null.
        return F.struct(*[c if other == name else F.lit(None).cast(f.dataType).alias(f.name)
                          for other, cols in wide.items() for c, f in zip(cols, types[other])])

    rows = df.select(F.explode(F.array(*[F.struct(F.lit(j).alias("g"), key(name).alias("key"))
                                         for j, name in enumerate(orders)])).alias("x")).select("x.g", "x.key")
    borders = _tile_borders(rows, [k for k, _ in orders.values()], width)
    found = borders.agg(F.struct(*[F.collect_list(F.when(F.col("g") == j, F.col("key"))).alias(f"b{j}")
                                   for j in range(len(orders))])).scalar()

    def tile(j: int, name: str, k: int) -> Column:
        own = key(name)
        passed = [F.coalesce((F.get(F.col(f"_tile_borders.b{j}"), F.lit(i)) < own).cast("int"), F.lit(0))
                  for i in range(k - 1)]
        return sum(passed, F.lit(1))

    return df.withColumn("_tile_borders", found) \
        .withColumns({name: tile(j, name, k) for j, (name, (k, _)) in enumerate(orders.items())}) \
        .drop("_tile_borders")


def share_of_total(value: Column) -> Column:
    """``100 * value / SUM(value) OVER ()`` for a frame already reduced to a few
    rows (categories, states, tiers); the empty window is one small task."""
    total = F.sum(value).over(Window.partitionBy())
    return F.lit(100.0) * value.cast("double") / F.when(total != 0, total.cast("double"))
