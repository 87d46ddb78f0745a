"""Column layouts of the raw, clean and fact tables."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType


def _strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


# Raw files are read as text with these headers (no type inference, so zip
# codes keep their leading zeros); cleaning parses them leniently.
RAW_CSV_SCHEMAS = {
    "customers": _strings("customer_id", "customer_unique_id", "customer_zip_code_prefix",
                          "customer_city", "customer_state"),
    "orders": _strings("order_id", "customer_id", "order_status", "order_purchase_timestamp",
                       "order_approved_at", "order_delivered_carrier_date",
                       "order_delivered_customer_date", "order_estimated_delivery_date"),
    "order_items": _strings("order_id", "order_item_id", "product_id", "seller_id",
                            "shipping_limit_date", "price", "freight_value"),
    "order_payments": _strings("order_id", "payment_sequential", "payment_type",
                               "payment_installments", "payment_value"),
    "order_reviews": _strings("review_id", "order_id", "review_score", "review_comment_title",
                              "review_comment_message", "review_creation_date",
                              "review_answer_timestamp"),
    "products": _strings("product_id", "product_category_name", "product_name_lenght",
                         "product_description_lenght", "product_photos_qty", "product_weight_g",
                         "product_length_cm", "product_height_cm", "product_width_cm"),
    "category_translation": _strings("product_category_name", "product_category_name_english"),
    "sellers": _strings("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
    "geolocation": _strings("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
                            "geolocation_city", "geolocation_state"),
}

ORDER_COLUMNS = [
    "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
    "order_delivered_carrier_date", "order_delivered_customer_date",
    "order_estimated_delivery_date", "delivery_days", "is_late_delivery", "order_year",
    "order_month", "order_quarter",
]
ITEM_COLUMNS = [
    "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price",
    "freight_value", "total_item_revenue",
]
PAYMENT_AGG_COLUMNS = ["order_id", "total_payment", "payment_installments", "primary_payment_type"]
CUSTOMER_COLUMNS = ["customer_id", "customer_unique_id", "customer_zip_code_prefix",
                    "customer_city", "customer_state"]
PRODUCT_COLUMNS = [
    "product_id", "product_category_name", "product_category_name_english",
    "product_name_length", "product_description_length", "product_photos_qty",
    "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
]
SELLER_COLUMNS = ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"]

# The line-item fact: one row per order line, 41 columns.
FACT_COLUMNS = (
    ITEM_COLUMNS
    + ORDER_COLUMNS[1:]
    + PAYMENT_AGG_COLUMNS[1:]
    + CUSTOMER_COLUMNS[1:]
    + PRODUCT_COLUMNS[1:]
    + SELLER_COLUMNS[1:]
    + ["revenue", "total_order_value"]
)
assert len(FACT_COLUMNS) == 41

# The narrower fact of the relational schema (28 columns).
FACT_TABLE_COLUMNS = [
    "order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value",
    "total_item_revenue", "customer_id", "order_status", "order_purchase_timestamp",
    "order_approved_at", "order_delivered_customer_date", "order_estimated_delivery_date",
    "delivery_days", "is_late_delivery", "order_year", "order_month", "order_quarter",
    "total_payment", "primary_payment_type", "customer_unique_id", "customer_city",
    "customer_state", "product_category_name_english", "seller_city", "seller_state",
    "revenue", "total_order_value",
]

# Primary keys of the published tables.
PRIMARY_KEYS = {
    "customers": ["customer_id"],
    "sellers": ["seller_id"],
    "products": ["product_id"],
    "geolocation": ["geolocation_zip_code_prefix"],
    "orders": ["order_id"],
    "order_items": ["order_id", "order_item_id"],
    "order_payments": ["order_id", "payment_sequential"],
    "order_payments_aggregated": ["order_id"],
    "order_reviews": ["review_id"],
    "fact_orders": ["order_id", "order_item_id"],
}

# Foreign keys: (child table, column, parent table, parent column).
FOREIGN_KEYS = [
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("order_items", "seller_id", "sellers", "seller_id"),
]

# Fixed column sizes of the relational schema: VARCHAR lengths and
# NUMERIC(precision, scale) columns.
VARCHAR_LENGTHS = {
    "customers": {"customer_id": 50, "customer_unique_id": 50, "customer_zip_code_prefix": 10,
                  "customer_city": 100, "customer_state": 5},
    "sellers": {"seller_id": 50, "seller_zip_code_prefix": 10, "seller_city": 100,
                "seller_state": 5},
    "products": {"product_id": 50, "product_category_name": 100,
                 "product_category_name_english": 100},
    "geolocation": {"geolocation_zip_code_prefix": 10, "geolocation_city": 100,
                    "geolocation_state": 5},
    "orders": {"order_id": 50, "customer_id": 50, "order_status": 30},
    "order_items": {"order_id": 50, "product_id": 50, "seller_id": 50},
    "order_payments": {"order_id": 50, "payment_type": 30},
    "order_payments_aggregated": {"order_id": 50, "primary_payment_type": 30},
    "order_reviews": {"review_id": 50, "order_id": 50},
}
NUMERIC_SIZES = {
    "geolocation": {"geolocation_lat": (12, 8), "geolocation_lng": (12, 8)},
    "order_items": {"price": (10, 2), "freight_value": (10, 2), "total_item_revenue": (10, 2)},
    "order_payments": {"payment_value": (10, 2)},
    "order_payments_aggregated": {"total_payment": (10, 2)},
    "fact_orders": {"price": (10, 2), "freight_value": (10, 2), "total_item_revenue": (10, 2),
                    "total_payment": (10, 2), "revenue": (10, 2), "total_order_value": (10, 2)},
}
