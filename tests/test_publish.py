"""Catalog publishing, full refresh, append, layout, and job failure handling."""

import os

import pytest
from pyspark.sql import functions as F

from shopscope.plans import job, publish
from shopscope.plans.warehouse import open_warehouse
from shopscope.sources import csv_files

from conftest import SMALL


def test_publish_all_in_load_order_with_fact_layout(spark):
    wh = open_warehouse(spark, SMALL)
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    tables = {n: wh.table(n) for n in publish.LOAD_ORDER}
    written = publish.publish_all(spark, tables, database="shop")
    assert written == [f"shop.{n}" for n in publish.LOAD_ORDER]
    fact = spark.table("shop.fact_orders")
    assert fact.count() == wh.table("fact_orders").count()
    # Partition folders per year and month prune a period filter.
    plan = fact.filter("order_year = 1998 AND order_month = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_year" in plan
    # A second run replaces, it does not duplicate.
    publish.publish_all(spark, {"customers": wh.table("customers")}, database="shop")
    assert spark.table("shop.customers").count() == wh.table("customers").count()


def test_create_if_absent_and_append(spark):
    schema = "order_id string, total_payment decimal(18,2)"
    df = spark.createDataFrame([("o1", 1)], "order_id string, total_payment int") \
        .withColumn("total_payment", F.col("total_payment").cast("decimal(18,2)"))
    publish.create_if_absent(spark, "pay_log", df.schema)
    publish.create_if_absent(spark, "pay_log", df.schema)   # no error the second time
    publish.append_table(df, "pay_log")
    publish.append_table(df.select("total_payment", "order_id"), "pay_log")  # matched by name
    assert spark.table("pay_log").count() == 2
    assert spark.table("pay_log").schema.simpleString() == f"struct<{schema.replace(' ', ':').replace(',:', ',')}>"


def test_a_batch_that_comes_twice_leaves_one_copy(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS batches")
    pay = spark.createDataFrame([("o1", 1), ("o2", 2)], "order_id string, cents int")
    assert publish.append_batch(pay, "batches.pay", "2024-01") == 2
    assert publish.append_batch(pay.limit(1), "batches.pay", "2024_02") == 1
    assert publish.append_batch(pay.union(pay), "batches.pay", "2024-01") == 4  # the rerun replaces its batch
    got = spark.table("batches.pay")
    assert got.schema.simpleString() == "struct<order_id:string,cents:int,load_batch:string>"
    assert {r["load_batch"]: r["count"] for r in got.groupBy("load_batch").count().collect()} == {
        "2024-01": 4, "2024_02": 1}
    assert publish.append_batch(pay.where("false"), "batches.pay", "2024_02") == 0  # an empty rerun leaves none
    assert spark.table("batches.pay").count() == 4
    ledger = spark.table("batches.load_ledger").collect()
    assert {(r["table_name"], r["load_batch"], r["row_count"]) for r in ledger} == {
        ("pay", "2024-01", 4), ("pay", "2024_02", 0)}
    publish.replace_table(pay, "batches.whole")
    with pytest.raises(ValueError, match="not a table of batches"):
        publish.append_batch(pay, "batches.whole", "x")
    for odd in ("", "a b", "it's", "a\\b", "x/y"):
        with pytest.raises(ValueError):
            publish.append_batch(pay, "batches.pay", odd)


def test_job_appends_batches(spark, scratch):
    runs = [job.run(spark, SMALL, os.path.join(scratch, f"out{i}"), "driver", with_forecast=False, database="delivered",
                    batch_id=batch) for i, batch in enumerate(("a", "b", "a"))]
    names = [t.removeprefix("delivered.") for s, t, _, _ in runs[0].stages if s == "append"]
    assert names == list(publish.LOAD_ORDER)
    for name in names:
        per = {r["load_batch"]: r["count"] for r in spark.table(f"delivered.{name}").groupBy("load_batch").count().collect()}
        want = [n for s, t, n, _ in runs[0].stages if t == f"delivered.{name}"]
        assert per == ({"a": want[0], "b": want[0]} if want[0] else {})
    assert spark.table("delivered.load_ledger").count() == 2 * len(names)
    with pytest.raises(ValueError):
        job.run(spark, SMALL, os.path.join(scratch, "x"), "driver", batch_id="a")


def test_forecast_failure_only_warns(spark, scratch, monkeypatch):
    def boom(*a, **k):
        raise RuntimeError("model failed")
    monkeypatch.setattr(job.FC, "forecast", boom)
    rep = job.run(spark, SMALL, os.path.join(scratch, "out"), "driver")
    assert rep.forecast_error == "RuntimeError: model failed"
    assert spark.read.parquet(os.path.join(scratch, "out", "fact_orders")).count() > 0


def test_optional_input_is_skipped(spark, scratch):
    folder = os.path.join(scratch, "raw")
    spark.createDataFrame([("c1", "u1", "1", "x", "y")], csv_files.RAW_CSV_SCHEMAS["customers"]) \
        .write.option("header", True).csv(os.path.join(folder, "customers.csv"))
    optional = tuple(n for n in csv_files.RAW_FILES if n != "customers")
    got = csv_files.read_all_raw(spark, folder, optional=optional)
    assert list(got) == ["customers"] and got["customers"].count() == 1
    with pytest.raises(csv_files.MissingInputs):
        csv_files.read_all_raw(spark, folder)
