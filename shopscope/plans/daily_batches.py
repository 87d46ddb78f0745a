"""S4/F1 for batches: the daily revenue series as sums that merge.

Each delivered batch is reduced to one row per (series, day) with its revenue
and kept under the batch's id. Sums merge by adding, so the series of any set
of batches is one aggregate over these small rows: days x series x batches, not
the lines. A corrected batch comes again under its id and replaces its rows;
no other batch is read again. An order whose lines are spread over batches, or
a day that several batches bring, adds up the same. The ledger has no entry for
this table: it follows from the batch's fact, which has one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopscope.plans.forecast import daily_revenue
from shopscope.plans.publish import BATCH, write_batch

TABLE = "daily_revenue_batches"
SUM_TYPE = "decimal(38,2)"


def table_name(database: str, series_col: str | None = None) -> str:
    """One table per series column."""
    return f"{database}.{TABLE}" + (f"_{series_col}" if series_col else "")


def add_batch(fact: DataFrame, name: str, batch_id: str, series_col: str | None = None,
              orders: DataFrame | None = None) -> int:
    """Keep a batch's daily sums in the table ``name``, in place of those it
    brought before; returns their number. Arguments as for ``daily_revenue``."""
    sums = daily_revenue(fact, series_col, orders).withColumn("y", F.col("y").cast(SUM_TYPE))
    return write_batch(sums, name, batch_id)


def merged_daily(spark: SparkSession, name: str, batches: list[str] | None = None) -> DataFrame:
    """(series_id, ds, y) of all batches, or of those named; folders of others are not read."""
    sums = spark.table(name)
    if batches is not None:
        sums = sums.where(F.col(BATCH).isin(batches))
    return sums.groupBy("series_id", "ds").agg(F.sum("y").cast(SUM_TYPE).alias("y"))
