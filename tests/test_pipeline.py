"""The job end to end: CSV inputs give the same tables as the typed inputs."""

import os

import pytest

from shopscope.plans import job
from shopscope.plans.publish import LOAD_ORDER
from shopscope.plans.warehouse import open_warehouse
from shopscope.sources import csv_files
from shopscope.sources.driver_tables import DRIVER_TABLES, raw_tables

from conftest import SMALL, stage_csv


def test_missing_inputs_are_listed(spark, scratch):
    with pytest.raises(csv_files.MissingInputs) as err:
        csv_files.read_all_raw(spark, scratch)
    assert len(err.value.missing) == len(csv_files.RAW_FILES)


def test_csv_job_matches_typed_warehouse(spark, scratch):
    stage_csv(raw_tables(spark, SMALL), os.path.join(scratch, "raw"))
    rep = job.run(spark, os.path.join(scratch, "raw"), os.path.join(scratch, "out"), "csv")
    assert rep.forecast_error is None
    typed = open_warehouse(spark, SMALL)
    for name in ("customers", "orders", "order_reviews", "order_payments_aggregated", "products",
                 "geolocation", "fact_orders"):
        a = spark.read.parquet(os.path.join(scratch, "out", name))
        b = typed.table(name)
        assert a.count() == b.count(), name
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
    metrics = {r["table_name"]: r["row_count"] for r in spark.read.parquet(os.path.join(scratch, "out", "run_metrics")).collect()}
    assert metrics["fact_orders"] == metrics["order_items"]
    assert metrics["forecast_daily"] > 0 and metrics["forecast_monthly"] > 0


def test_job_publishes_and_summarises(spark, scratch):
    rep = job.run(spark, SMALL, os.path.join(scratch, "out"), "driver", database="published")
    assert rep.forecast_error is None
    names = [t.removeprefix("published.") for s, t, _, _ in rep.stages if s == "publish"]
    assert names == list(LOAD_ORDER)
    assert spark.table("published.fact_orders").count() == 6000
    assert spark.read.parquet(os.path.join(scratch, "out", "forecast_summary")).count() == 1


def test_rows_without_a_nation_or_part_stay(spark, scratch):
    for name in DRIVER_TABLES:
        df = spark.read.parquet(f"{SMALL}/{name}.parquet")
        if name in ("nation", "part"):
            df = df.where(f"{'n_nationkey' if name == 'nation' else 'p_partkey'} % 2 = 0")
        df.write.parquet(f"{scratch}/{name}.parquet")
    raw = raw_tables(spark, scratch)
    for name, source in (("customers", "customer"), ("sellers", "supplier"), ("order_items", "lineitem")):
        assert raw[name].count() == spark.read.parquet(f"{SMALL}/{source}.parquet").count()
    assert raw["order_items"].where("freight_value IS NULL").count() > 0


def test_job_without_forecast(spark, scratch):
    rep = job.run(spark, SMALL, os.path.join(scratch, "out"), "driver", with_forecast=False)
    assert [s for s in rep.stages if s[0] == "forecast"] == []


def test_command_line(spark, scratch, capsys):
    job.main(["--input", SMALL, "--output", os.path.join(scratch, "cli"), "--format", "driver", "--no-forecast"])
    out = capsys.readouterr().out
    assert "fact\tfact_orders\t6000" in out
    with pytest.raises(SystemExit):
        job.main(["--input", os.path.join(scratch, "nothing"), "--output", os.path.join(scratch, "x")])
