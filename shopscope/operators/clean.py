"""Cleaning operators, one per raw table.

Each takes the raw frame (text columns from CSV, or typed columns) and returns
the cleaned frame with the published column layout. Raw frames may carry an
``ingest_seq`` column (file position); when it is missing one is derived from
the scan order, which Spark keeps stable for an unchanged input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopscope.functions.scalar import (
    false_if_null, lenient_number, lenient_timestamp, mean, strip, title_case, whole_days, zero_fill,
)
from shopscope.operators.dedup import first_per_key, latest_first
from shopscope.schemas import CUSTOMER_COLUMNS, ITEM_COLUMNS, ORDER_COLUMNS, PRODUCT_COLUMNS, \
    SELLER_COLUMNS

SEQ = "ingest_seq"
ORDER_TIMESTAMPS = [
    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
]
# Fixed thresholds of the review flags.
POSITIVE_SCORE = 4
NEGATIVE_SCORE = 2


def with_ingest_seq(df: DataFrame) -> DataFrame:
    return df if SEQ in df.columns else df.withColumn(SEQ, F.monotonically_increasing_id())


def _ts(df: DataFrame, name: str) -> Column:
    return lenient_timestamp(name, df.schema[name].dataType)


def _num(df: DataFrame, name: str, target: str) -> Column:
    return lenient_number(name, target, df.schema[name].dataType)


def _place(df: DataFrame, prefix: str, id_col: str) -> DataFrame:
    """Shared rules of customers, sellers and zips: city, state and zip code."""
    return df.withColumns({
        f"{prefix}_city": title_case(strip(f"{prefix}_city")),
        f"{prefix}_state": F.upper(strip(f"{prefix}_state")),
        f"{prefix}_zip_code_prefix": zero_fill(f"{prefix}_zip_code_prefix", 5),
    })


def clean_customers(raw: DataFrame) -> DataFrame:
    df = _place(with_ingest_seq(raw), "customer", "customer_id")
    return first_per_key(df.select(*CUSTOMER_COLUMNS, SEQ), ["customer_id"], [F.col(SEQ)]) \
        .select(*CUSTOMER_COLUMNS)


def clean_sellers(raw: DataFrame) -> DataFrame:
    df = _place(with_ingest_seq(raw), "seller", "seller_id")
    return first_per_key(df.select(*SELLER_COLUMNS, SEQ), ["seller_id"], [F.col(SEQ)]) \
        .select(*SELLER_COLUMNS)


def clean_orders(raw: DataFrame) -> DataFrame:
    df = with_ingest_seq(raw)
    # The first row per order is picked before anything is derived from it, so that less is shuffled.
    df = first_per_key(df.select(*[c for c in ORDER_COLUMNS if c in df.columns], SEQ), ["order_id"], [F.col(SEQ)])
    df = df.withColumns({c: _ts(df, c) for c in ORDER_TIMESTAMPS})
    purchase = F.col("order_purchase_timestamp")
    delivered = F.col("order_delivered_customer_date")
    estimated = F.col("order_estimated_delivery_date")
    df = df.withColumns({
        "delivery_days": F.when(delivered.isNotNull(),
                                whole_days(purchase, delivered, "floor")).cast("int"),
        "is_late_delivery": F.when(delivered.isNotNull() & estimated.isNotNull(),
                                   false_if_null(delivered > estimated)).otherwise(F.lit(False)),
        "order_year": F.year(purchase),
        "order_month": F.month(purchase),
        "order_quarter": F.quarter(purchase),
    })
    return df.select(*ORDER_COLUMNS)


def clean_order_items(raw: DataFrame) -> DataFrame:
    df = raw
    price = F.coalesce(_num(df, "price", "decimal(18,2)"), F.lit(0).cast("decimal(18,2)"))
    freight = F.coalesce(_num(df, "freight_value", "decimal(18,2)"), F.lit(0).cast("decimal(18,2)"))
    df = df.withColumns({
        "order_item_id": _num(df, "order_item_id", "int"),
        "shipping_limit_date": _ts(df, "shipping_limit_date"),
        "price": price,
        "freight_value": freight,
    })
    return df.withColumn("total_item_revenue", (F.col("price") + F.col("freight_value"))
                         .cast("decimal(18,2)")).select(*ITEM_COLUMNS)


PAYMENT_COLUMNS = ["order_id", "payment_sequential", "payment_type", "payment_installments",
                   "payment_value"]


def clean_payments(raw: DataFrame, keep_seq: bool = False) -> DataFrame:
    """Row-level payment cleaning: lenient value (missing -> 0), trimmed lower type."""
    df = with_ingest_seq(raw)
    df = df.withColumns({
        "payment_sequential": _num(df, "payment_sequential", "int"),
        "payment_installments": _num(df, "payment_installments", "int"),
        "payment_value": F.coalesce(_num(df, "payment_value", "decimal(18,2)"),
                                    F.lit(0).cast("decimal(18,2)")),
        "payment_type": F.lower(strip("payment_type")),
    })
    return df.select(*PAYMENT_COLUMNS, *([SEQ] if keep_seq else []))


def payments_by_order(clean: DataFrame) -> DataFrame:
    """One row per order: total paid, most installments, type of the largest payment.

    Ties for the largest payment go to the one that came first in the file.
    Payments without an order id are left out (they cannot join).
    """
    df = with_ingest_seq(clean)
    return (df.filter(F.col("order_id").isNotNull())
            .groupBy("order_id")
            .agg(F.sum("payment_value").cast("decimal(18,2)").alias("total_payment"),
                 F.max("payment_installments").alias("payment_installments"),
                 F.max_by("payment_type", F.struct(F.col("payment_value"), -F.col(SEQ)))
                 .alias("primary_payment_type")))


REVIEW_COLUMNS = [
    "review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
    "review_creation_date", "review_answer_timestamp", "is_positive_review", "is_negative_review",
]


def clean_reviews(raw: DataFrame) -> DataFrame:
    """Parse, flag, then keep the latest review per order and one row per review id.

    The two keep-first passes run in that order (order first, then review id)
    and both use "newest first, then file order".
    """
    df = with_ingest_seq(raw)
    score = _num(df, "review_score", "int")
    df = df.withColumns({
        "review_creation_date": _ts(df, "review_creation_date"),
        "review_answer_timestamp": _ts(df, "review_answer_timestamp"),
        "review_comment_title": F.coalesce(F.col("review_comment_title").cast("string"), F.lit("")),
        "review_comment_message": F.coalesce(F.col("review_comment_message").cast("string"), F.lit("")),
        "review_score": score,
    }).withColumns({
        "is_positive_review": false_if_null(F.col("review_score") >= POSITIVE_SCORE),
        "is_negative_review": false_if_null(F.col("review_score") <= NEGATIVE_SCORE),
    }).select(*REVIEW_COLUMNS, SEQ)
    order = latest_first("review_creation_date")
    df = first_per_key(df, ["order_id"], order)
    df = first_per_key(df, ["review_id"], order)
    return df.select(*REVIEW_COLUMNS)


def clean_products(raw: DataFrame, translation: DataFrame) -> DataFrame:
    """Fix the misspelt columns, translate the category, title-case it, parse numbers."""
    df = with_ingest_seq(raw).withColumnsRenamed({
        "product_name_lenght": "product_name_length",
        "product_description_lenght": "product_description_length",
    })
    tr = with_ingest_seq(translation).select("product_category_name", "product_category_name_english", SEQ)
    tr = first_per_key(tr.filter(F.col("product_category_name").isNotNull()),
                       ["product_category_name"], [F.col(SEQ)]).drop(SEQ)
    # The translation is one row per category. It comes out of an aggregate,
    # so adaptive execution sees its real size and broadcasts it at run time.
    df = df.join(tr, "product_category_name", "left")
    english = F.coalesce(F.col("product_category_name_english"), F.col("product_category_name"))
    df = df.withColumns({
        "product_category_name_english": title_case(strip(F.translate(english, "_", " "))),
        "product_name_length": _num(df, "product_name_length", "int"),
        "product_description_length": _num(df, "product_description_length", "int"),
        "product_photos_qty": F.coalesce(_num(df, "product_photos_qty", "int"), F.lit(0)),
        "product_weight_g": _num(df, "product_weight_g", "double"),
        "product_length_cm": _num(df, "product_length_cm", "double"),
        "product_height_cm": _num(df, "product_height_cm", "double"),
        "product_width_cm": _num(df, "product_width_cm", "double"),
    })
    return first_per_key(df.select(*PRODUCT_COLUMNS, SEQ), ["product_id"], [F.col(SEQ)]) \
        .select(*PRODUCT_COLUMNS)


GEO_COLUMNS = ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
               "geolocation_city", "geolocation_state"]


def clean_geolocation(raw: DataFrame) -> DataFrame:
    """One row per zip: mean coordinates, first non-missing city and state.

    Coordinates are fixed to ``decimal(12,8)`` per row and averaged from exact
    sums, so the mean does not depend on the order rows are added in.
    """
    df = _place(with_ingest_seq(raw), "geolocation", "geolocation_zip_code_prefix")
    lat = _num(df, "geolocation_lat", "decimal(12,8)")
    lng = _num(df, "geolocation_lng", "decimal(12,8)")

    def avg8(c: Column) -> Column:
        return F.round(mean(F.sum(c), F.count(c)).cast("decimal(38,10)"), 8).cast("decimal(12,8)")

    def first_present(name: str) -> Column:
        return F.min_by(F.col(name), F.when(F.col(name).isNotNull(), F.col(SEQ)))

    return (df.withColumns({"_lat": lat, "_lng": lng})
            .groupBy("geolocation_zip_code_prefix")
            .agg(avg8(F.col("_lat")).alias("geolocation_lat"),
                 avg8(F.col("_lng")).alias("geolocation_lng"),
                 first_present("geolocation_city").alias("geolocation_city"),
                 first_present("geolocation_state").alias("geolocation_state"))
            .select(*GEO_COLUMNS))
