"""Reading the fact from a relational database instead of Parquet.

Two reads a Spark user writes against a database: a table split into
parallel range reads on a numeric or date column, and an aggregate query the
database runs itself (only its result crosses the network). Not exercised in
the tests: no database server runs in the test environment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The delivered revenue per purchase day, computed by the database.
DAILY_REVENUE_SQL = """
SELECT CAST(order_purchase_timestamp AS DATE) AS ds, SUM(revenue) AS y
FROM {table}
WHERE order_status = 'delivered' AND order_purchase_timestamp IS NOT NULL
GROUP BY CAST(order_purchase_timestamp AS DATE)
"""


def read_table(spark: SparkSession, url: str, table: str, properties: dict[str, str],
               partition_column: str | None = None, lower: str | int | None = None,
               upper: str | int | None = None, partitions: int = 64, fetch_rows: int = 10000) -> DataFrame:
    """A table read by ``partitions`` parallel range queries on ``partition_column``."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table) \
        .option("fetchsize", fetch_rows).options(**properties)
    if partition_column:
        reader = reader.option("partitionColumn", partition_column).option("lowerBound", lower) \
            .option("upperBound", upper).option("numPartitions", partitions)
    return reader.load()


def read_daily_revenue(spark: SparkSession, url: str, properties: dict[str, str],
                       table: str = "fact_orders") -> DataFrame:
    """The daily series, aggregated inside the database (one row per day comes back)."""
    return spark.read.format("jdbc").option("url", url).option("query", DAILY_REVENUE_SQL.format(table=table)) \
        .options(**properties).load()
