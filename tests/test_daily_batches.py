"""Daily sums per batch: merging, corrections, and the job's forecast over batches."""

import os

from pyspark.sql import functions as F

from shopscope.plans import daily_batches as B
from shopscope.plans import forecast as FC
from shopscope.plans import job
from shopscope.plans.warehouse import open_warehouse

from conftest import SMALL


def _same(a, b):
    cols = ["series_id", "ds", F.col("y").cast("decimal(38,2)").alias("y")]
    a, b = a.select(*cols), b.select(*cols)
    return a.count() == b.count() > 0 and a.exceptAll(b).count() == 0


def test_three_batches_equal_a_full_recompute(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS daily")
    wh = open_warehouse(spark, SMALL)
    # Lines of one order, and of one day, fall into different batches.
    fact = wh.table("fact_orders").withColumn("part", F.pmod(F.xxhash64("order_id", "order_item_id"), F.lit(3)))
    for series, name in ((None, "daily.total"), ("customer_state", "daily.state"), ("seller_id", "daily.seller")):
        for i in range(3):
            B.add_batch(fact.where(F.col("part") == i).drop("part"), name, f"b{i}", series)
        assert _same(B.merged_daily(spark, name), FC.daily_revenue(fact, series))
        assert _same(B.merged_daily(spark, name, ["b0", "b2"]), FC.daily_revenue(fact.where("part <> 1"), series))
    # A late correction of one batch: other prices, fewer lines.
    fixed = fact.where("part = 1 and order_item_id < 4").withColumn("revenue", (F.col("revenue") * 2).cast("decimal(18,2)"))
    B.add_batch(fixed.drop("part"), "daily.total", "b1")
    assert _same(B.merged_daily(spark, "daily.total"), FC.daily_revenue(fact.where("part <> 1").unionByName(fixed)))
    # An emptied batch takes its days with it; the rows of other batches are not read.
    assert B.add_batch(fact.where("false").drop("part"), "daily.total", "b1") == 0
    assert _same(B.merged_daily(spark, "daily.total"), FC.daily_revenue(fact.where("part <> 1")))
    plan = B.merged_daily(spark, "daily.total", ["b0"])._jdf.queryExecution().executedPlan().toString()
    assert "load_batch" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_a_batch_run_forecasts_from_all_batches(spark, scratch, monkeypatch):
    seen = []

    def spy(daily):
        seen.append({(r["series_id"], r["ds"]): r["y"] for r in daily.collect()})
        raise RuntimeError("far enough")
    monkeypatch.setattr(job.FC, "forecast", spy)
    for i, batch in enumerate(("a", "b", "b")):
        job.run(spark, SMALL, os.path.join(scratch, f"out{i}"), "driver", database="daily_job", batch_id=batch)
    one, two, again = seen
    assert one and two == again == {k: 2 * y for k, y in one.items()}
