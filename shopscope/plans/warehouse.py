"""Build, write and reopen the cleaned tables and the fact.

The marts read the written fact, not the lineage that built it: the write cuts
the lineage (a lost executor re-reads files instead of re-running the joins)
and lets every mart start from a pruned, filter-pushed Parquet scan.
"""

from __future__ import annotations

import hashlib
import threading
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopscope.operators import clean as C
from shopscope.operators import quality as K
from shopscope.operators.fact import build_fact
from shopscope.plans.revenue import order_summary
from shopscope.schemas import NUMERIC_SIZES, PRIMARY_KEYS, VARCHAR_LENGTHS
from shopscope.session import bucket_count, catalog_name, raise_shuffle_partitions, read_bucketed, shared_dir, \
    shuffle_partitions, write_bucketed
from shopscope.sources.driver_tables import raw_tables

CLEAN_TABLES = (
    "customers", "sellers", "products", "geolocation", "orders", "order_items",
    "order_payments", "order_payments_aggregated", "order_reviews",
)
ALL_TABLES = CLEAN_TABLES + ("fact_orders", "order_summary")
# What was measured while the tables were written (``quality.MEASURED``).
CHECKS = "load_checks"


def clean_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The nine cleaning operators over the raw tables (lazy)."""
    payments = C.clean_payments(raw["order_payments"], keep_seq=True)
    tables = {
        "customers": C.clean_customers(raw["customers"]),
        "sellers": C.clean_sellers(raw["sellers"]),
        "products": C.clean_products(raw["products"], raw["category_translation"]),
        "orders": C.clean_orders(raw["orders"]),
        "order_items": C.clean_order_items(raw["order_items"]),
        "order_payments": payments.drop(C.SEQ),
        "order_payments_aggregated": C.payments_by_order(payments),
        "order_reviews": C.clean_reviews(raw["order_reviews"]),
    }
    if "geolocation" in raw:  # the only table that nothing else is built from
        tables["geolocation"] = C.clean_geolocation(raw["geolocation"])
    return tables


def write_table(df: DataFrame, path: str, sort_by: list[str] | None = None) -> None:
    """Overwrite a Parquet table (a full refresh, safe to re-run)."""
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


# Tables written bucketed (key, sort columns within a bucket), all that are
# keyed on an order: the orders, items, payments, reviews, the fact and the
# order summary. An order is never a hot key, while one customer (or the rows
# without one) may hold any share of the orders. All use the same bucket count,
# so the fact is joined, and keys with an order are counted, without a shuffle;
# a customer step combines before its shuffle.
BUCKETED = {
    "orders": ("order_id", ("order_id",)),
    "order_items": ("order_id", ("order_id",)),
    "order_payments": ("order_id", ("order_id",)),
    "order_payments_aggregated": ("order_id", ("order_id",)),
    "fact_orders": ("order_id", ("order_status", "order_purchase_timestamp")),
    "order_reviews": ("order_id", ("order_id",)),
    "order_summary": ("order_id", ("order_id",)),
}


_register_lock = threading.Lock()


@dataclass
class Warehouse:
    """The written tables of one input folder."""

    spark: SparkSession
    root: str
    seconds: dict[str, float] = field(default_factory=dict)
    buckets: int | None = None

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _catalog_name(self, name: str) -> str:
        return catalog_name(self.root, name)

    def _bucket_count(self) -> int:
        if self.buckets is None:
            self.buckets = int(self.spark.read.text(self.path("_buckets")).first()[0])
        return self.buckets

    def table(self, name: str) -> DataFrame:
        if name not in BUCKETED:
            return self.spark.read.parquet(self.path(name))
        with _register_lock:
            return read_bucketed(self.spark, self._catalog_name(name), self.path(name), self._bucket_count(),
                                 *BUCKETED[name])

    def _set_buckets(self, rows: int) -> None:
        """Fix the bucket count of this build, for ``rows`` order lines."""
        self.buckets = self.buckets or bucket_count(self.spark, rows)
        self.spark.createDataFrame([(str(self.buckets),)], "value string").coalesce(1) \
            .write.mode("overwrite").text(self.path("_buckets"))

    def write_table(self, name: str, df: DataFrame) -> list[tuple]:
        """Replace a table; bucketed tables are hash-partitioned on their key
        first (the same hash as the buckets), so each bucket is one file.
        Returns what was measured in the same pass: rows, null keys, overflows
        and text lengths."""
        bucketed = BUCKETED.get(name)
        if bucketed:
            df = df.repartition(self.buckets, bucketed[0])
        df, seen = K.measured(df, name, PRIMARY_KEYS.get(name, ()), NUMERIC_SIZES.get(name), VARCHAR_LENGTHS.get(name))
        if not bucketed:
            write_table(df, self.path(name))
            return seen()
        key, sort = bucketed
        write_bucketed(df, self._catalog_name(name), self.path(name), self.buckets, key, sort)
        return seen()

    def build(self, raw: dict[str, DataFrame], parallel_writes: int = len(CLEAN_TABLES)) -> "Warehouse":
        """Clean and write the nine tables, then build and write the fact.

        The cleaned tables are independent jobs; submitting them from a few
        threads lets the scheduler fill idle cores while one job shuffles.
        """
        # Payments come about as often as lines, and counting them joins nothing.
        self._set_buckets(raw["order_payments"].count())
        with shuffle_partitions(self.spark, self.buckets):
            return self._build(raw, parallel_writes)

    def _build(self, raw: dict[str, DataFrame], parallel_writes: int) -> "Warehouse":
        t0 = time.time()
        cleaned = clean_all(raw)
        with ThreadPoolExecutor(max_workers=parallel_writes) as pool:
            checks = [row for done in [pool.submit(self.write_table, name, df) for name, df in cleaned.items()]
                      for row in done.result()]
        t1 = time.time()
        fact = build_fact(self.table("orders"), self.table("order_items"),
                          self.table("order_payments_aggregated"), self.table("customers"),
                          self.table("products"), self.table("sellers"))
        # Bucketed on order_id; inside a bucket, rows of one status and time
        # range sit together, so Parquet min/max statistics skip row groups for
        # the status filter every mart uses.
        checks += self.write_table("fact_orders", fact)
        t2 = time.time()
        # The delivered orders, one row each with their review: the shared
        # first step of the order- and customer-level marts, computed once.
        checks += self.write_table("order_summary", order_summary(self.table("fact_orders"), self.table("order_reviews")))
        self.spark.createDataFrame(checks, K.MEASURED).coalesce(1).write.mode("overwrite").parquet(self.path(CHECKS))
        self.seconds = {"clean": t1 - t0, "fact": t2 - t1, "order_summary": time.time() - t2}
        return self

    def checks(self) -> DataFrame:
        """What the build measured while it wrote the tables."""
        return self.table(CHECKS)

    def counts(self) -> dict[str, int]:
        """Row count per table, as written."""
        return {r["table_name"]: r["row_count"] for r in self.checks().where("check_name = 'rows'").collect()}


_lock = threading.Lock()
_open: dict[tuple[str, str], Warehouse] = {}
_MARKER = "_COMPLETE"


def _code_version() -> str:
    """Digest of this package's source, so a changed build never reuses old tables."""
    h = hashlib.sha256()
    pkg = Path(__file__).resolve().parent.parent
    for f in sorted(pkg.rglob("*.py")):
        h.update(f.relative_to(pkg).as_posix().encode())
        h.update(f.read_bytes())
    return h.hexdigest()[:16]


def _input_state(spark: SparkSession, folder: str) -> str:
    """Names, sizes and times of the files in ``folder``, as one text."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return ""
    found, walk = [], files.listFiles(path, True)
    while walk.hasNext():
        f = walk.next()
        found.append(f"{f.getPath().toUri().getPath()} {f.getLen()} {f.getModificationTime()}")
    return "\n".join(sorted(found))


def _completed_build(spark: SparkSession, base: str) -> str | None:
    """The folder of a finished build recorded in ``base``, if any."""
    try:
        rows = spark.read.text(f"{base}/{_MARKER}").collect()
    except AnalysisException:
        return None
    return rows[0][0] if rows else None


def open_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse of ``sf_dir``, built on first use.

    Builds live in the shared folder under a key of the input folder, its files'
    names, sizes and times, and the code version. A build writes into its own sub-folder and records it in a
    marker only when every table is written, so a half-written build is never
    read, concurrent builders do not collide, and later runs reuse the result.
    The session then shuffles into as many partitions as the build has buckets,
    unless it was set to more.
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _lock:
        wh = _open.get(key)
        if wh is None:
            digest = hashlib.sha256(f"{sf_dir.rstrip('/')}|{_input_state(spark, sf_dir)}|{_code_version()}".encode()).hexdigest()[:20]
            base = f"{shared_dir(spark).rstrip('/')}/shopscope-warehouse/{digest}"
            done = _completed_build(spark, base)
            if done:
                wh = Warehouse(spark, done)
            else:
                raise_shuffle_partitions(spark, 0)  # a build takes the session's own number
                wh = Warehouse(spark, f"{base}/build-{uuid.uuid4().hex[:12]}")
                wh.build(raw_tables(spark, sf_dir, stage_dir=wh.path("_staging")))
                spark.createDataFrame([(wh.root,)], "value string").coalesce(1) \
                    .write.mode("overwrite").text(f"{base}/{_MARKER}")
            _open[key] = wh
        # Queries deal out their keys as finely as the order lines lie in buckets.
        raise_shuffle_partitions(spark, wh._bucket_count())
        return wh


def fresh_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Build the warehouse of ``sf_dir`` anew (never reused) and serve it to the
    registered queries of this application."""
    raise_shuffle_partitions(spark, 0)
    root = f"{shared_dir(spark).rstrip('/')}/shopscope-warehouse/fresh-{uuid.uuid4().hex[:12]}"
    wh = Warehouse(spark, root)
    wh.build(raw_tables(spark, sf_dir, stage_dir=wh.path("_staging")))
    with _lock:
        _open[(spark.sparkContext.applicationId, sf_dir.rstrip("/"))] = wh
    return wh


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_warehouse(spark, sf_dir).table("fact_orders")


def delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact(spark, sf_dir).filter(F.col("order_status") == "delivered")
