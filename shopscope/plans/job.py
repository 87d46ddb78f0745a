"""The batch job: clean and load, then forecast (J1), with stage metrics.

    python -m shopscope.plans.job --input DIR --format csv|driver --output DIR [--no-forecast]

Cleaning and loading are fatal on failure; a forecast failure is reported and
the job still succeeds (J1). ``--no-forecast`` skips the forecast (J2). Row
counts and seconds per stage are written as a ``run_metrics`` table (J3).
"""

from __future__ import annotations

import argparse
import logging
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopscope.operators.quality import number_rejects
from shopscope.plans import daily_batches
from shopscope.plans import forecast as FC
from shopscope.plans.publish import LOAD_ORDER, append_all, publish_all
from shopscope.plans.warehouse import ALL_TABLES, Warehouse
from shopscope.sources import csv_files
from shopscope.sources.driver_tables import raw_tables

log = logging.getLogger(__name__)
MONEY = "decimal(18,2)"
OPTIONAL = ("geolocation",)
# Cleaned types of the raw number columns, for the report of values that do not fit.
NUMBERS = {
    "order_items": {"order_item_id": "int", "price": MONEY, "freight_value": MONEY},
    "order_payments": {"payment_sequential": "int", "payment_installments": "int", "payment_value": MONEY},
    "order_reviews": {"review_score": "int"},
    "products": {"product_photos_qty": "int"},
}


@dataclass
class RunReport:
    stages: list[tuple[str, str, int, float]] = field(default_factory=list)  # stage, table, rows, seconds
    forecast_error: str | None = None

    def add(self, stage: str, table: str, rows: int, seconds: float) -> None:
        self.stages.append((stage, table, rows, round(seconds, 3)))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.stages, "stage string, table_name string, row_count bigint, "
                                                  "seconds double")


def run(spark: SparkSession, input_dir: str, output_dir: str, input_format: str = "csv",
        with_forecast: bool = True, series_col: str | None = None,
        files: dict[str, str] | None = None, database: str | None = None,
        batch_id: str | None = None) -> RunReport:
    """Clean, load and forecast; with ``database`` the tables are also published
    there, dimensions first: refreshed whole, the fact in folders per month, or
    with ``batch_id`` appended as that batch, which a rerun replaces. The forecast
    of a batch run starts from the daily sums of all batches so far."""
    if batch_id and not database:
        raise ValueError("a batch is appended to a database: give its name")
    report = RunReport()
    t0 = time.time()
    output_dir = output_dir.rstrip("/")
    if not spark.sparkContext.getCheckpointDir():
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
        spark.sparkContext.setCheckpointDir(configured or f"{output_dir}/_checkpoints")
    raw = (csv_files.read_all_raw(spark, input_dir, files, optional=OPTIONAL) if input_format == "csv"
           else raw_tables(spark, input_dir, stage_dir=f"{output_dir}/_staging"))
    wh = Warehouse(spark, output_dir).build(raw)
    counts = wh.counts()  # observed while the tables were written
    for name in ALL_TABLES:
        if name in counts:
            stage = {"fact_orders": "fact", "order_summary": "order_summary"}.get(name, "clean")
            report.add(stage, name, counts[name], wh.seconds.get(stage, 0.0))
    rejects = number_rejects({n: (raw[n], cols) for n, cols in NUMBERS.items() if n in raw})
    rejects.write.mode("overwrite").parquet(wh.path("number_rejects"))
    if database:
        t1 = time.time()
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        loaded = {n: wh.table(n) for n in LOAD_ORDER if n not in OPTIONAL or n in raw}
        if batch_id:
            for name, rows in append_all(spark, loaded, batch_id, database).items():
                report.add("append", name, rows, time.time() - t1)
            sums = daily_batches.table_name(database, series_col)
            rows = daily_batches.add_batch(wh.table("fact_orders"), sums, batch_id, series_col, wh.table("order_summary"))
            report.add("daily", sums, rows, time.time() - t1)
        else:
            for name in publish_all(spark, loaded, database):
                report.add("publish", name, spark.table(name).count(), time.time() - t1)
    log.info("load done in %.1fs", time.time() - t0)

    if with_forecast:
        t1 = time.time()
        try:
            daily = daily_batches.merged_daily(spark, sums) if database and batch_id else \
                FC.daily_revenue(wh.table("fact_orders"), series_col)
            daily = FC.with_min_history(daily)
            raw_fc = FC.forecast(daily).checkpoint(eager=True)
            # Published as exact cents (the source's NUMERIC(12,2), widened to
            # 18 digits so large shops cannot overflow).
            cents = {c: F.col(c).cast(MONEY) for c in ("yhat", "yhat_lower", "yhat_upper")}
            FC.publishable(raw_fc, daily).withColumns(cents) \
                .write.mode("overwrite").parquet(wh.path("forecast_daily"))
            monthly = FC.monthly_rollup(raw_fc)
            monthly.withColumns({c: F.col(c).cast(MONEY) for c in
                                 ("forecast_revenue", "forecast_lower", "forecast_upper")}) \
                .write.mode("overwrite").parquet(wh.path("forecast_monthly"))
            FC.summary(daily, monthly).write.mode("overwrite").parquet(wh.path("forecast_summary"))
            for name in ("forecast_daily", "forecast_monthly", "forecast_summary"):
                report.add("forecast", name, wh.table(name).count(), time.time() - t1)
        except Exception as exc:  # the forecast is optional: report and go on
            report.forecast_error = f"{type(exc).__name__}: {exc}"
            log.warning("forecast failed, load kept: %s", report.forecast_error)
    report.frame(spark).withColumn("run_at", F.current_timestamp()) \
        .write.mode("overwrite").parquet(wh.path("run_metrics"))
    return report


def main(argv: list[str] | None = None) -> None:
    from shopscope.session import build_session
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--input", required=True)
    ap.add_argument("--output", required=True)
    ap.add_argument("--format", choices=["csv", "driver"], default="csv")
    ap.add_argument("--no-forecast", action="store_true")
    ap.add_argument("--series", default=None, help="column to forecast per value (e.g. customer_state)")
    ap.add_argument("--files", default="", metavar="TABLE=FILE,...", help="file names of raw tables in the input folder")
    ap.add_argument("--database", default=None, help="publish the cleaned tables and the fact to this database too")
    ap.add_argument("--batch", default=None, metavar="ID",
                    help="append to the database as this batch, in place of a refresh; a rerun replaces the batch")
    ap.add_argument("--master", default=None)
    ap.add_argument("--input-bytes", type=int, default=None,
                    help="size of the raw input; sets shuffle partitions to about 256 MB each")
    args = ap.parse_args(argv)
    spark = build_session(args.master)
    if args.input_bytes:
        from shopscope.session import size_shuffles
        size_shuffles(spark, args.input_bytes)
    try:
        rep = run(spark, args.input, args.output, args.format, not args.no_forecast, args.series,
                  dict(pair.split("=", 1) for pair in args.files.split(",") if pair), args.database, args.batch)
    except csv_files.MissingInputs as exc:
        raise SystemExit(f"FATAL: {exc}")
    for stage in rep.stages:
        print("\t".join(map(str, stage)))
    if rep.forecast_error:
        print(f"WARNING: forecast failed ({rep.forecast_error}); load succeeded")


if __name__ == "__main__":
    main()
