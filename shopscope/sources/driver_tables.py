"""Raw shop tables derived from the TPC-H-like tables of a data folder.

The shop pipeline reads nine raw tables (customers, orders, order items,
payments, reviews, products, category translation, sellers, geolocation).
The test folders hold TPC-H-like tables instead, so this module maps them onto
the raw shop schema with fixed rules. The same rules are written in SQL for the
DuckDB oracle (``oracle/``); both sides must stay in step.

Every raw table carries ``ingest_seq``, the position a row would have in its
source file; keep-first and first-non-null rules use it as the order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from shopscope.operators.sizing import bounded_broadcast, looked_up
from shopscope.session import bucket_count, catalog_name, read_bucketed, shuffle_partitions, write_bucketed

DRIVER_TABLES = ("nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Fixed values of the mapping (they must equal the oracle's).
ORDER_STATUS = {"F": "delivered", "O": "shipped", "P": "processing"}
PAYMENT_TYPE_BY_FLAG = {"A": " Credit_Card ", "N": "boleto"}
PAYMENT_TYPE_UNDEFINED = "not_defined"   # return flag R with line status O
PAYMENT_TYPE_OTHER = "voucher"
CITY_SUFFIX = " d'oeste "
CATEGORY_SUFFIX = "_goods"
TRANSLATED_SUFFIX = "_items"
UNTRANSLATED_TYPE_PREFIX = "PROMO"
NULL_CATEGORY_SIZE = 50
ZIP_MODULUS = 20000


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _key(c: str):
    return F.col(c).cast("string")


_dims: dict[tuple, DataFrame] = {}


def _dimension(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """A small driver table projected to ``cols``, broadcast behind a size probe.

    The probe result is kept per application, so each dimension is probed once.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name, cols)
    if key not in _dims:
        _dims[key] = bounded_broadcast(read_driver_table(spark, sf_dir, name).select(*cols))
    return _dims[key]


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_driver_table(spark, sf_dir, "customer")
    n = _dimension(spark, sf_dir, "nation", "n_nationkey", "n_name")
    person = F.col("c_custkey") - F.when(F.col("c_custkey") % 10 == 1, 1).otherwise(0)
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .select(_key("c_custkey").alias("customer_id"),
                    F.concat(F.lit("u"), person.cast("string")).alias("customer_unique_id"),
                    (F.col("c_custkey") % ZIP_MODULUS).cast("string").alias("customer_zip_code_prefix"),
                    F.lower(F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(CITY_SUFFIX))).alias("customer_city"),
                    F.lower("n_name").alias("customer_state"),
                    F.col("c_custkey").alias("ingest_seq")))


def raw_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_driver_table(spark, sf_dir, "supplier")
    n = _dimension(spark, sf_dir, "nation", "n_nationkey", "n_name")
    return (s.join(n, s.s_nationkey == n.n_nationkey, "left")
            .select(_key("s_suppkey").alias("seller_id"),
                    (F.col("s_suppkey") % ZIP_MODULUS).cast("string").alias("seller_zip_code_prefix"),
                    F.lower("s_name").alias("seller_city"),
                    F.lower("n_name").alias("seller_state"),
                    F.col("s_suppkey").alias("ingest_seq")))


def raw_geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_driver_table(spark, sf_dir, "customer")
    n = _dimension(spark, sf_dir, "nation", "n_nationkey", "n_name")
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .select(F.col("c_nationkey").cast("string").alias("geolocation_zip_code_prefix"),
                    (F.col("c_acctbal") / 1000).alias("geolocation_lat"),
                    (F.col("c_acctbal") / -200).alias("geolocation_lng"),
                    F.lower(F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(CITY_SUFFIX))).alias("geolocation_city"),
                    F.lower("n_name").alias("geolocation_state"),
                    F.col("c_custkey").alias("ingest_seq")))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_driver_table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    mapped = F.when(status == "F", ORDER_STATUS["F"]).when(status == "O", ORDER_STATUS["O"]) \
        .when(status == "P", ORDER_STATUS["P"])
    purchase = F.timestamp_add("SECOND", (F.col("o_orderkey") * 37) % 86400, F.col("o_orderdate"))
    return o.select(
        _key("o_orderkey").alias("order_id"),
        _key("o_custkey").alias("customer_id"),
        mapped.alias("order_status"),
        purchase.alias("order_purchase_timestamp"),
        F.timestamp_add("HOUR", F.lit(1), purchase).alias("order_approved_at"),
        F.when(status.isin("F", "O"), F.timestamp_add("DAY", F.lit(1), purchase)).alias("order_delivered_carrier_date"),
        F.when(status == "F", F.timestamp_add("DAY", 1 + F.col("o_orderkey") % 30, F.col("o_orderdate")))
         .alias("order_delivered_customer_date"),
        F.timestamp_add("DAY", F.lit(20), F.col("o_orderdate")).alias("order_estimated_delivery_date"),
        F.col("o_orderkey").alias("ingest_seq"))


def _numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a per-order line number (the source key repeats).

    The window is partitioned by the order id the fact joins on, so the tables
    made from it can reuse this partitioning. A TPC-H order has at most seven
    lines, so no window partition grows with the data.
    """
    # Dealt by the order id before it is a column, so the shuffle carries the number only.
    li = read_driver_table(spark, sf_dir, "lineitem").repartition(_key("l_orderkey")) \
        .withColumn("order_id", _key("l_orderkey"))
    w = Window.partitionBy("order_id").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice",
        "l_quantity", "l_tax", "l_discount")
    return li.withColumn("line_no", F.row_number().over(w))


def raw_order_items(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    li = lines if lines is not None else _numbered_lines(spark, sf_dir)
    part = read_driver_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    freight = (F.col("l_extendedprice") * F.col("l_tax") * (F.length("p_type") - 4) * 2)
    return (looked_up(li, part, "l_partkey", "order_id")
            .select("order_id",
                    F.col("line_no").alias("order_item_id"),
                    _key("l_partkey").alias("product_id"),
                    _key("l_suppkey").alias("seller_id"),
                    F.col("l_shipdate").alias("shipping_limit_date"),
                    F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
                    F.round(freight.cast("decimal(38,10)"), 2).cast("decimal(18,2)").alias("freight_value"),
                    (F.col("l_orderkey") * 1000 + F.col("line_no")).alias("ingest_seq")))


def raw_order_payments(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    li = lines if lines is not None else _numbered_lines(spark, sf_dir)
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    ptype = (F.when(flag == "A", PAYMENT_TYPE_BY_FLAG["A"])
             .when(flag == "N", PAYMENT_TYPE_BY_FLAG["N"])
             .when((flag == "R") & (status == "O"), PAYMENT_TYPE_UNDEFINED)
             .otherwise(PAYMENT_TYPE_OTHER))
    return li.select("order_id",
                     F.col("line_no").alias("payment_sequential"),
                     ptype.alias("payment_type"),
                     (F.col("l_quantity").cast("int") % 12 + 1).alias("payment_installments"),
                     F.col("l_extendedprice").cast("decimal(18,2)").alias("payment_value"),
                     (F.col("l_orderkey") * 1000 + F.col("line_no")).alias("ingest_seq"))


def raw_order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_driver_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    blank = eid % 3 == 0
    return e.select(
        F.when(eid % 10 == 5, eid - 2).otherwise(eid).cast("string").alias("review_id"),
        F.floor(eid / 2).cast("bigint").cast("string").alias("order_id"),
        (1 + F.floor("value").cast("int") % 5).alias("review_score"),
        F.when(~blank, F.col("event_type")).alias("review_comment_title"),
        F.when(~blank, F.col("props")).alias("review_comment_message"),
        F.col("ts").alias("review_creation_date"),
        F.timestamp_add("DAY", F.lit(1), F.col("ts")).alias("review_answer_timestamp"),
        eid.alias("ingest_seq"))


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_driver_table(spark, sf_dir, "part")
    category = F.when(F.col("p_size") == NULL_CATEGORY_SIZE, F.lit(None).cast("string")) \
        .otherwise(F.concat(F.lower("p_type"), F.lit(CATEGORY_SUFFIX)))
    # The two "lenght" names reproduce the misspelt source header on purpose.
    return p.select(
        _key("p_partkey").alias("product_id"),
        category.alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        F.length("p_brand").alias("product_description_lenght"),
        F.col("p_size").alias("product_photos_qty"),
        F.col("p_retailprice").cast("string").alias("product_weight_g"),
        F.col("p_size").cast("double").alias("product_length_cm"),
        (F.col("p_size") % 7 + 1).cast("double").alias("product_height_cm"),
        (F.col("p_size") % 11 + 1).cast("double").alias("product_width_cm"),
        F.col("p_partkey").alias("ingest_seq"))


def raw_category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_driver_table(spark, sf_dir, "part")
    return (p.filter(~F.col("p_type").startswith(UNTRANSLATED_TYPE_PREFIX))
            .select(F.concat(F.lower("p_type"), F.lit(CATEGORY_SUFFIX)).alias("product_category_name"),
                    F.concat(F.lower("p_type"), F.lit(TRANSLATED_SUFFIX)).alias("product_category_name_english"))
            .distinct()
            .withColumn("ingest_seq", F.lit(0).cast("bigint")))


RAW_BUILDERS = {
    "customers": raw_customers,
    "orders": raw_orders,
    "order_items": raw_order_items,
    "order_payments": raw_order_payments,
    "order_reviews": raw_order_reviews,
    "products": raw_products,
    "category_translation": raw_category_translation,
    "sellers": raw_sellers,
    "geolocation": raw_geolocation,
}


def _staged_lines(spark: SparkSession, sf_dir: str, folder: str, staged: bool) -> DataFrame:
    path, table = f"{folder}/numbered_lines", catalog_name(folder, "numbered_lines")
    if staged:
        buckets = int(spark.read.text(f"{folder}/_buckets").first()[0])
    else:
        buckets = bucket_count(spark, read_driver_table(spark, sf_dir, "lineitem").count())
        spark.createDataFrame([(str(buckets),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/_buckets")
        with shuffle_partitions(spark, buckets):
            write_bucketed(_numbered_lines(spark, sf_dir).drop("l_linenumber", "l_discount"), table, path, buckets,
                           "order_id", ["order_id"])
    return read_bucketed(spark, table, path, buckets, "order_id", ["order_id"])


def raw_tables(spark: SparkSession, sf_dir: str, stage_dir: str | None = None,
               staged: bool = False) -> dict[str, DataFrame]:
    """All nine raw tables as lazy frames.

    With ``stage_dir``, the numbered line items (shared by items and
    payments) are written there once, bucketed on the order, and read back,
    instead of shuffling and sorting the line table once per derived table;
    ``staged=True`` reads an earlier staging from ``stage_dir`` without writing
    it again.
    """
    out = {name: build(spark, sf_dir) for name, build in RAW_BUILDERS.items()
           if name not in ("order_items", "order_payments")}
    lines = None
    if stage_dir:
        lines = _staged_lines(spark, sf_dir, stage_dir.rstrip("/"), staged)
    out["order_items"] = raw_order_items(spark, sf_dir, lines)
    out["order_payments"] = raw_order_payments(spark, sf_dir, lines)
    return out
