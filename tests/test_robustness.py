"""Inputs that once lost data, and runs away from the test session's settings."""

import datetime as dt
import os
import subprocess
import sys
from decimal import Decimal

import pandas as pd
from pyspark.sql import functions as F

from shopscope.functions.scalar import lenient_number
from shopscope.operators import clean, quality
from shopscope.plans import forecast as FC
from shopscope.plans import warehouse
from shopscope.session import bucket_count, partitions_for
from shopscope.sources import csv_files
from shopscope.sources.driver_tables import raw_tables

from conftest import ROOT, SMALL, stage_csv

HEADER = ("review_id,order_id,review_score,review_comment_title,review_comment_message,"
          "review_creation_date,review_answer_timestamp\n")
REVIEWS = [
    'r1,o1,5,"title","line one\nline two, with a comma",2018-01-02 00:00:00,2018-01-03 10:00:00\n',
    'r2,o2,1,,"he said ""no"" twice",2018-01-04 00:00:00,2018-01-05 11:00:00\n',
    'r3,o3,3,"a, b",plain,2018-02-04 00:00:00,2018-02-05 11:00:00\n',
]


def test_quoted_reviews_read_as_pandas_does(spark, scratch):
    os.makedirs(scratch + "/in")
    with open(scratch + "/in/order_reviews.csv", "w") as f:
        f.write(HEADER + "".join(REVIEWS))
    got = clean.clean_reviews(csv_files.read_raw(spark, scratch + "/in", "order_reviews")).orderBy("review_id").collect()
    want = pd.read_csv(scratch + "/in/order_reviews.csv", dtype=str, keep_default_na=False)
    assert [(r["review_id"], r["order_id"], str(r["review_score"]), r["review_comment_title"],
             r["review_comment_message"], str(r["review_creation_date"]), str(r["review_answer_timestamp"]))
            for r in got] == [tuple(x) for x in want.itertuples(index=False)]


def test_ingest_order_follows_the_files(spark, scratch):
    folder = scratch + "/in/order_reviews.csv"
    os.makedirs(folder)
    for i, n in enumerate([1, 40, 3]):
        with open(f"{folder}/part-{i}.csv", "w") as f:
            f.write(HEADER + "".join(f"r{i}-{k:03},o,5,,,2018-01-02 00:00:00,2018-01-02 00:00:00\n" for k in range(n)))
    rows = csv_files.read_raw(spark, scratch + "/in", "order_reviews").orderBy("ingest_seq").collect()
    assert [r["review_id"] for r in rows] == sorted(r["review_id"] for r in rows) and len(rows) == 44


def test_lenient_integers(spark):
    df = spark.createDataFrame([("1.0",), ("1e3",), ("7",), ("x",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(lenient_number("t", "int")).collect()] == [1, 1000, 7, None, None, None]


def test_numbers_that_do_not_fit_are_reported(spark):
    df = spark.createDataFrame([("12345678901234567890.5", "1"), ("3.5", "99999999999"), ("x", "2")],
                               "price string, order_item_id string")
    got = quality.number_rejects({"order_items": (df, {"price": "decimal(18,2)", "order_item_id": "int"})}).collect()
    assert {(r["column_name"], r["violations"]) for r in got} == {("price", 1), ("order_item_id", 1)}


def days(spark, dates, series="s"):
    return spark.createDataFrame([(series, d, Decimal("100.00")) for d in dates],
                                 "series_id string, ds date, y decimal(18,2)")


def test_holt_winters_keeps_every_day_over_a_gap(spark):
    start = dt.date(2018, 1, 1)
    dates = [start + dt.timedelta(days=i) for i in range(150)] + [dt.date(2019, 3, 5)]
    fc = FC.holt_winters(days(spark, dates))
    assert fc.count() == 151 + FC.HORIZON_DAYS and fc.where("yhat is null").count() == 0
    assert fc.where(F.col("ds") > dates[-1]).count() == FC.HORIZON_DAYS


def test_null_series_is_a_series(spark):
    start = dt.date(2018, 1, 1)
    daily = days(spark, [start + dt.timedelta(days=i) for i in range(100)], series=None)
    assert FC.with_min_history(daily).count() == 100
    for fc in (FC.linear_trend(daily), FC.holt_winters(daily), FC.seasonal(daily), FC.forecast(daily)):
        assert fc.count() == 100 + FC.HORIZON_DAYS


def test_seasonal_from_thirty_days_on(spark):
    start = dt.date(2018, 1, 1)
    daily = days(spark, [start + dt.timedelta(days=i) for i in range(30)])
    fc = FC.forecast(daily)
    assert fc.count() == 30 + FC.HORIZON_DAYS and {r[0] for r in fc.select("model").distinct().collect()} == {"seasonal"}


def test_bucket_count_is_legal_at_any_size(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions_for(100 * 10 ** 12, 8000)))
        assert bucket_count(spark) <= 100_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_changed_input_has_another_key(spark, scratch):
    path = scratch + "/t.parquet"
    spark.range(3).write.parquet(path)
    first = warehouse._input_state(spark, scratch)
    assert first == warehouse._input_state(spark, scratch) and first
    spark.range(4).write.mode("overwrite").parquet(path)
    assert warehouse._input_state(spark, scratch) != first
    assert warehouse._input_state(spark, scratch + "/absent") == ""


def test_job_in_a_fresh_process(spark, scratch):
    """No checkpoint folder preset, an absent optional table, a renamed file."""
    raw = raw_tables(spark, SMALL)
    stage_csv({n: df for n, df in raw.items() if n != "geolocation"}, scratch + "/raw")
    os.rename(f"{scratch}/raw/{csv_files.RAW_FILES['customers']}", f"{scratch}/raw/people.csv")
    done = subprocess.run(
        [sys.executable, "-m", "shopscope.plans.job", "--input", scratch + "/raw", "--output", scratch + "/out",
         "--master", "local[4]", "--files", "customers=people.csv"],
        cwd=ROOT, capture_output=True, text=True, timeout=600,
        env=os.environ | {"SHOPSCOPE_DRIVER_MEMORY": "4g", "TMPDIR": scratch})
    assert done.returncode == 0 and "WARNING: forecast failed" not in done.stdout, done.stderr[-2000:]
    assert spark.read.parquet(scratch + "/out/forecast_daily").count() > FC.HORIZON_DAYS
    assert spark.read.parquet(scratch + "/out/number_rejects").count() == 0
    assert spark.read.parquet(scratch + "/out/customers").count() > 0
    assert not os.path.exists(scratch + "/out/geolocation")
