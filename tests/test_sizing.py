"""Lookups in a side that is too large to broadcast, and the bounds of a task's reading."""

import re

from shopscope.operators.fact import build_fact
from shopscope.operators.sizing import looked_up
from shopscope.plans.registry import raw_key_duplicates
from shopscope.plans.warehouse import open_warehouse
from shopscope.session import apply_required_conf, bucket_count, raise_shuffle_partitions

from conftest import SMALL
from test_plans import plan_text


def test_large_side_finds_what_a_join_finds(spark):
    rows = spark.createDataFrame([("o1", "a", 1), ("o1", "b", 2), ("o1", "a", 3), ("o2", "a", 4), ("o2", None, 5),
                                  (None, "b", 6), (None, None, 7), ("o3", "z", 8), (None, "z", 9)], "home string, k string, n int")
    side = spark.createDataFrame([("a", "A"), ("b", "B1"), ("b", "B2"), (None, "N")], "k string, v string")
    for frame in (rows, rows.where("home IS NOT NULL")):
        want = sorted(map(str, frame.join(side, "k", "left").select("n", "k", "home", "v").collect()))
        for most in (1, 1 << 20):
            assert sorted(map(str, looked_up(frame, side, "k", "home", most).select("n", "k", "home", "v").collect())) == want


def test_fact_of_large_dimensions_shuffles_no_line(spark):
    wh = open_warehouse(spark, SMALL)
    tables = [wh.table(t) for t in ("orders", "order_items", "order_payments_aggregated", "customers", "products", "sellers")]
    fact = build_fact(*tables, broadcast_bytes=1)
    text = plan_text(fact)
    moved = [line for line in text.split("Exchange hashpartitioning(")[1:]]
    assert moved and not any(c in part.split("FileScan")[0].split("SortMergeJoin")[0] for part in moved
                             for c in ("price", "order_status", "total_payment"))
    assert fact.exceptAll(wh.table("fact_orders")).count() == 0 and fact.count() == wh.table("fact_orders").count()


def test_order_keys_are_counted_without_a_shuffle(spark):
    wh = open_warehouse(spark, SMALL)
    for name, keys in (("order_items", ("order_id", "order_item_id")), ("order_payments", ("order_id", "payment_sequential")),
                       ("orders", ("order_id",))):
        assert "Exchange" not in plan_text(wh.table(name).groupBy(*keys).count())


def test_buckets_and_task_reads_are_bounded(spark):
    assert bucket_count(spark, 100) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert bucket_count(spark, 216_000_000) == 824
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = [spark.conf.get(k) for k in keys]
    try:
        spark.conf.set(keys[0], "128MB")
        spark.conf.set(keys[1], "8m")
        apply_required_conf(spark)
        assert [spark.conf.get(k) for k in keys] == [str(32 << 20), "8m"]
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)


def test_raw_keys_are_dealt_out_as_finely_as_the_buckets(spark):
    buckets, key = open_warehouse(spark, SMALL)._bucket_count(), "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    try:
        for own in (2, buckets + 3):
            spark.conf.set(key, str(own))
            df = raw_key_duplicates(spark, SMALL)
            dealt = {int(n) for n in re.findall(r"Exchange hashpartitioning\(\w+#\d+, (\d+)\)", plan_text(df))}
            assert dealt == {max(own, buckets)}
            got = sorted(map(tuple, df.collect()))
            assert got and got == sorted(map(tuple, raw_key_duplicates(spark, SMALL).collect()))
        spark.conf.set(key, "2")
        for least, made in ((5, "5"), (3, "3"), (0, "2")):
            raise_shuffle_partitions(spark, least)
            assert spark.conf.get(key) == made
    finally:
        spark.conf.set(key, before)
