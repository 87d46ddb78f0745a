"""Layout for lookups: interleaved key, Bloom filters, what a lookup reads."""

import pytest
from pyspark.sql import functions as F

from shopscope.plans import lookup, publish
from shopscope.plans.warehouse import open_warehouse

from conftest import MEDIUM, SMALL


def test_range_number_counts_borders(spark):
    borders = ["b", "d", "d", "d", "f", "f", "h"]
    df = spark.createDataFrame([(v,) for v in ["a", "b", "c", "d", "e", "f", "g", "h", "z", None]], "v string") \
        .withColumn("n", lookup.range_number(F.col("v"), borders))
    for r in df.collect():
        assert r["n"] == (0 if r["v"] is None else sum(b <= r["v"] for b in borders)), r["v"]
    assert spark.range(1).select(lookup.range_number(F.lit("x"), []).alias("n")).first()["n"] == 0


def test_bits_alternate_from_the_top(spark):
    pairs = [(a, b) for a in range(8) for b in range(8)]
    df = spark.createDataFrame(pairs, "a int, b int")
    for r in df.withColumn("z", lookup.interleaved([F.col("a"), F.col("b")], 3)).collect():
        a, b = f"{r['a']:03b}", f"{r['b']:03b}"
        assert r["z"] == int("".join(x + y for x, y in zip(a, b)), 2)
    with pytest.raises(ValueError):
        lookup.interleaved([F.col("a")] * 11, 6)


def _rows_read(df):
    df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return scan.metrics().apply("numOutputRows").value()


def test_each_lookup_reads_little(spark):
    fact = open_warehouse(spark, MEDIUM).table("fact_orders")
    layout = lookup.Layout(cluster=("customer_state", "seller_id"), bloom=("customer_id", "product_id", "seller_id"),
                           options={"parquet.block.row.count.limit": "100", "parquet.enable.dictionary": "false"})
    lookup.write_layout(fact, "fact_by_lookup", layout, partitions=8)
    written = spark.table("fact_by_lookup")
    total = written.count()
    assert written.exceptAll(fact.select(*written.columns)).count() == 0 and total == fact.count()
    for column in ("customer_id", "product_id", "seller_id", "customer_state"):
        value = fact.where(F.col(column).isNotNull()).agg(F.max(column)).first()[0]
        hit = written.where(F.col(column) == value)
        assert hit.count() == fact.where(F.col(column) == value).count() > 0
        # Only the lookup's column decides which rows are read.
        assert _rows_read(hit) < total / 10, column
    # The Bloom filters do it: an id inside every group's range, yet in no group.
    absent = fact.agg(F.max("product_id")).first()[0] + "0"
    low = fact.agg(F.min("product_id")).first()[0] + "0"
    assert _rows_read(written.where(F.col("product_id").isin(absent))) < total / 10
    assert _rows_read(written.where(F.col("product_id") == low)) < total / 10


def test_hot_value_and_nulls_spread_over_files(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "SP").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("state"),
        F.col("id").alias("n"))
    got = lookup.clustered(df, lookup.Layout(cluster=("state",)), partitions=12)
    per = got.groupBy(F.spark_partition_id()).count().collect()
    assert got.count() == 20_000 and max(r["count"] for r in per) < 4 * 20_000 / 12
    assert lookup.clustered(df.where("false"), lookup.Layout(cluster=("state",)), partitions=3).count() == 0
    nulls = df.select(F.lit(None).cast("string").alias("state"), "n")
    assert lookup.clustered(nulls, lookup.Layout(cluster=("state",)), partitions=3).count() == 20_000


def test_published_tables_have_their_layout(spark):
    wh = open_warehouse(spark, SMALL)
    spark.sql("CREATE DATABASE IF NOT EXISTS laid")
    publish.publish_all(spark, {n: wh.table(n) for n in lookup.LAYOUTS}, database="laid")
    for name in lookup.LAYOUTS:
        a, b = spark.table(f"laid.{name}"), wh.table(name)
        assert a.count() == b.count() and a.select(*b.columns).exceptAll(b).count() == 0, name
