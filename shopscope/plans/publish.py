"""Publishing: typed tables, full refresh, append, and the fact's layout.

Load order is dimensions first, then facts (W7). A write is either a full
refresh of its table (W4) or an append of a named batch (W2): each batch is a
partition of its own, which a rerun replaces. So a re-run after a failure gives
the same result either way.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shopscope.plans.lookup import LAYOUTS, write_layout
from shopscope.plans.warehouse import CLEAN_TABLES

# Dimensions before facts.
LOAD_ORDER = ("customers", "sellers", "products", "geolocation", "orders", "order_items",
              "order_payments", "order_payments_aggregated", "order_reviews", "fact_orders")
assert set(LOAD_ORDER) == set(CLEAN_TABLES) | {"fact_orders"}

# JDBC inserts go in batches of this many rows.
JDBC_BATCH_ROWS = 5000


def create_if_absent(spark: SparkSession, name: str, schema: StructType, path: str | None = None) -> None:
    """Create an empty typed Parquet table unless it exists."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet", schema=schema)


def append_table(df: DataFrame, name: str) -> None:
    """Append rows to a catalog table (columns matched by name)."""
    df.select(*df.sparkSession.table(name).columns).write.mode("append").saveAsTable(name)


BATCH = "load_batch"
LEDGER = "load_ledger"
LEDGER_COLUMNS = f"row_count bigint, loaded_at timestamp, table_name string, {BATCH} string"


def create_partitioned(spark: SparkSession, name: str, schema: StructType, partition_by: list[str]) -> None:
    """Create an empty typed, partitioned Parquet table unless it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    keys = ", ".join(f"`{c}`" for c in partition_by)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({keys})")


def _overwrite_partition(df: DataFrame, name: str, partition: dict[str, str]) -> None:
    """Replace one partition of the table with the rows of ``df``, by name; no rows empty it."""
    spark = df.sparkSession
    columns = ", ".join(f"`{c}`" for c in spark.table(name).columns if c not in partition)
    keys = ", ".join(f"`{c}` = '{v}'" for c, v in partition.items())
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({keys}) SELECT {columns} FROM {{rows}}", rows=df)


def write_batch(df: DataFrame, name: str, batch_id: str) -> int:
    """The rows of ``df`` as partition ``batch_id`` of a table, in place of what
    that batch held; returns their number, counted while they are written.

    The table is created, typed, if it is absent. A table without
    ``load_batch`` is refused.
    """
    spark = df.sparkSession
    if any(c.lower() == BATCH for c in df.columns):
        raise ValueError(f"the rows already have a column {BATCH}")
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", batch_id):
        raise ValueError(f"batch id {batch_id!r}: letters, digits, '.', '_' and '-' only, as it names a folder")
    create_partitioned(spark, name, df.withColumn(BATCH, F.lit(batch_id)).schema, [BATCH])
    if BATCH not in spark.table(name).columns:
        raise ValueError(f"{name} is not a table of batches: refresh it, or append under another name")
    seen = Observation()
    _overwrite_partition(df.observe(seen, F.count(F.lit(1)).alias("n")), name, {BATCH: batch_id})
    return int(seen.get["n"])


def append_batch(df: DataFrame, name: str, batch_id: str) -> int:
    """Append ``df`` to the table as batch ``batch_id``; returns its rows.

    Its rows carry ``load_batch``, which partitions the table; a batch that
    comes again replaces its own partition, so a rerun leaves one copy, and an
    empty one leaves none. The ledger of the table's database keeps one row per
    table and batch.
    """
    spark = df.sparkSession
    n = write_batch(df, name, batch_id)
    database, _, table = name.rpartition(".")
    ledger = f"{database}.{LEDGER}" if database else LEDGER
    entry = spark.createDataFrame([(n, dt.datetime.now(dt.timezone.utc), table, batch_id)], LEDGER_COLUMNS).coalesce(1)
    create_partitioned(spark, ledger, entry.schema, ["table_name", BATCH])
    _overwrite_partition(entry, ledger, {"table_name": table, BATCH: batch_id})
    return n


def replace_table(df: DataFrame, name: str) -> None:
    """Replace a catalog table, schema included (a full refresh)."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str],
               mode: str = "append") -> None:
    """W2 to a relational database: batched inserts, one connection per task."""
    props = {"batchsize": str(JDBC_BATCH_ROWS), **properties}
    df.write.mode(mode).jdbc(url, table, properties=props)


def append_all(spark: SparkSession, tables: dict[str, DataFrame], batch_id: str,
               database: str | None = None) -> dict[str, int]:
    """Append every table in load order as one batch; rows by table name."""
    return {full: append_batch(tables[name], full, batch_id) for name in LOAD_ORDER if name in tables
            for full in [f"{database}.{name}" if database else name]}


def publish_all(spark: SparkSession, tables: dict[str, DataFrame], database: str | None = None) -> list[str]:
    """Replace every table in load order, with the layout of its lookups (W6);
    returns the table names written."""
    written = []
    for name in LOAD_ORDER:
        if name not in tables:
            continue
        full = f"{database}.{name}" if database else name
        if name in LAYOUTS:
            write_layout(tables[name], full, LAYOUTS[name])
        else:
            replace_table(tables[name], full)
        written.append(full)
    return written
