"""Cleaning operators on hand-written edge rows (text input, as from CSV)."""

import datetime as dt
from decimal import Decimal

from shopscope.operators import clean as C
from shopscope.operators.fact import build_fact
from shopscope.schemas import FACT_COLUMNS

from conftest import rows


def test_customers_trim_title_zip_and_keep_first(spark):
    raw = spark.createDataFrame([
        ("c1", "u1", "42", " são paulo ", " sp ", 0),
        ("c2", "u2", "123456", "\td'oeste", "rj", 1),
        ("c1", "u9", "1", "other", "mg", 2),          # duplicate id: first row wins
        ("c3", "u3", None, "mogi-guaçu", None, 3),
    ], "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
       "customer_city string, customer_state string, ingest_seq long")
    got = sorted(rows(C.clean_customers(raw)))
    assert got == [
        ("c1", "u1", "00042", "São Paulo", "SP"),
        ("c2", "u2", "123456", "D'Oeste", "RJ"),
        ("c3", "u3", None, "Mogi-Guaçu", None),
    ]


def test_orders_dates_delivery_days_and_flags(spark):
    raw = spark.createDataFrame([
        ("o1", "c1", "delivered", "2018-01-02 12:00:00", "2018-01-01 00:00:00", "2017-12-31 00:00:00"),  # -36h
        ("o2", "c1", "delivered", "garbage", "2018-01-05 00:00:00", "2018-01-04 00:00:00"),
        ("o3", "c2", "shipped", "2018-02-01 00:00:00", None, "2018-02-10 00:00:00"),
        ("o4", "c2", "delivered", "2018-03-01 00:00:00", "2018-03-11 06:00:00", None),
    ], "order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
       "order_delivered_customer_date string, order_estimated_delivery_date string") \
        .selectExpr("*", "cast(null as string) as order_approved_at",
                    "cast(null as string) as order_delivered_carrier_date")
    got = {r["order_id"]: r for r in C.clean_orders(raw).collect()}
    assert got["o1"]["delivery_days"] == -2 and got["o1"]["is_late_delivery"] is True
    assert got["o2"]["order_purchase_timestamp"] is None and got["o2"]["delivery_days"] is None
    assert got["o2"]["order_year"] is None and got["o2"]["is_late_delivery"] is True
    assert got["o3"]["delivery_days"] is None and got["o3"]["is_late_delivery"] is False
    assert got["o4"]["delivery_days"] == 10 and got["o4"]["is_late_delivery"] is False
    assert (got["o4"]["order_year"], got["o4"]["order_month"], got["o4"]["order_quarter"]) == (2018, 3, 1)


def test_items_bad_numbers_become_zero(spark):
    raw = spark.createDataFrame([("o1", "1", "p", "s", "2018-01-01 00:00:00", "abc", None),
                                 ("o1", "2", "p", "s", "bad", "10.5", "2.25")],
                                "order_id string, order_item_id string, product_id string, seller_id string, "
                                "shipping_limit_date string, price string, freight_value string")
    got = sorted(rows(C.clean_order_items(raw), "order_item_id", "price", "freight_value", "total_item_revenue",
                      "shipping_limit_date"))
    assert got == [(1, Decimal("0.00"), Decimal("0.00"), Decimal("0.00"), dt.datetime(2018, 1, 1)),
                   (2, Decimal("10.50"), Decimal("2.25"), Decimal("12.75"), None)]


def test_payments_aggregate_ties_go_to_first(spark):
    raw = spark.createDataFrame([
        ("o1", "1", " Credit_Card ", "3", "50.00", 0),
        ("o1", "2", "boleto", "1", "50.00", 1),      # tie for largest: first wins
        ("o1", "3", "voucher", "8", "10.00", 2),
        ("o2", "1", None, "2", "bad", 3),
        (None, "1", "boleto", "1", "99.00", 4),      # no order: left out
    ], "order_id string, payment_sequential string, payment_type string, payment_installments string, "
       "payment_value string, ingest_seq long")
    agg = C.payments_by_order(C.clean_payments(raw, keep_seq=True))
    assert sorted(rows(agg)) == [("o1", Decimal("110.00"), 8, "credit_card"), ("o2", Decimal("0.00"), 2, None)]


def test_reviews_latest_per_order_then_unique_review_id(spark):
    raw = spark.createDataFrame([
        ("r1", "o1", "5", None, None, "2018-01-01 00:00:00", 0),
        ("r2", "o1", "1", "t", "m", "2018-01-05 00:00:00", 1),   # newer: kept for o1
        ("r2", "o2", "3", None, None, "2018-01-06 00:00:00", 2),  # same review id on o2: kept (newer)
        ("r3", "o3", "x", None, None, None, 3),                   # bad score, no date
        ("r4", "o3", "2", None, None, "2018-01-01 00:00:00", 4),  # has a date: wins over null date
    ], "review_id string, order_id string, review_score string, review_comment_title string, "
       "review_comment_message string, review_creation_date string, ingest_seq long") \
        .selectExpr("*", "cast(null as string) as review_answer_timestamp")
    got = sorted(rows(C.clean_reviews(raw), "review_id", "order_id", "review_score", "review_comment_title",
                      "is_positive_review", "is_negative_review"))
    assert got == [("r2", "o2", 3, "", False, False), ("r4", "o3", 2, "", False, True)]


def test_products_translation_fallback_and_title(spark):
    raw = spark.createDataFrame([
        ("p1", "cama_mesa", "10", "20", None, "100", "1", "2", "3", 0),
        ("p2", "sem_traducao", "1", "2", "4", "abc", None, None, None, 1),
        ("p3", None, None, None, None, None, None, None, None, 2),
        ("p1", "outra", "1", "1", "1", "1", "1", "1", "1", 3),
    ], "product_id string, product_category_name string, product_name_lenght string, "
       "product_description_lenght string, product_photos_qty string, product_weight_g string, "
       "product_length_cm string, product_height_cm string, product_width_cm string, ingest_seq long")
    tr = spark.createDataFrame([("cama_mesa", "bed_table")], "product_category_name string, "
                                                             "product_category_name_english string")
    got = {r["product_id"]: r for r in C.clean_products(raw, tr).collect()}
    assert got["p1"]["product_category_name_english"] == "Bed Table"
    assert got["p1"]["product_photos_qty"] == 0 and got["p1"]["product_weight_g"] == 100.0
    assert got["p2"]["product_category_name_english"] == "Sem Traducao" and got["p2"]["product_weight_g"] is None
    assert got["p3"]["product_category_name_english"] is None
    assert got["p1"]["product_name_length"] == 10


def test_geolocation_mean_and_first_present_city(spark):
    raw = spark.createDataFrame([
        ("1001", "-23.5", "-46.6", None, "sp", 0),
        ("1001", "-23.7", "-46.8", "são paulo", "sp", 1),
        ("1001", "-23.6", "-46.7", "other", "rj", 2),
        ("2", "1.0", "2.0", "x", "y", 3),
    ], "geolocation_zip_code_prefix string, geolocation_lat string, geolocation_lng string, "
       "geolocation_city string, geolocation_state string, ingest_seq long")
    got = sorted(rows(C.clean_geolocation(raw)))
    assert got == [("00002", Decimal("1.00000000"), Decimal("2.00000000"), "X", "Y"),
                   ("01001", Decimal("-23.60000000"), Decimal("-46.70000000"), "São Paulo", "SP")]


def test_fact_keeps_every_line_and_falls_back_to_item_revenue(spark):
    orders = spark.createDataFrame([("o1", "c1", "delivered")], "order_id string, customer_id string, "
                                                                "order_status string")
    for c in ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
              "order_delivered_customer_date", "order_estimated_delivery_date"]:
        orders = orders.selectExpr("*", f"cast(null as timestamp_ntz) as {c}")
    orders = orders.selectExpr("*", "cast(null as int) delivery_days", "false is_late_delivery",
                               "cast(null as int) order_year", "cast(null as int) order_month",
                               "cast(null as int) order_quarter")
    items = spark.createDataFrame([("o1", 1, "p1", "s1", Decimal("10.00"), Decimal("1.00")),
                                   ("o9", 1, None, "s1", Decimal("5.00"), Decimal("0.50"))],
                                  "order_id string, order_item_id int, product_id string, seller_id string, "
                                  "price decimal(18,2), freight_value decimal(18,2)") \
        .selectExpr("*", "cast(null as timestamp_ntz) shipping_limit_date",
                    "cast(price + freight_value as decimal(18,2)) total_item_revenue")
    pay = spark.createDataFrame([], "order_id string, total_payment decimal(18,2), payment_installments int, "
                                    "primary_payment_type string")
    cust = spark.createDataFrame([("c1", "u1", "00001", "X", "SP")], "customer_id string, customer_unique_id string, "
                                 "customer_zip_code_prefix string, customer_city string, customer_state string")
    prod = spark.createDataFrame([], "product_id string, product_category_name string, "
                                     "product_category_name_english string, product_name_length int, "
                                     "product_description_length int, product_photos_qty int, product_weight_g double, "
                                     "product_length_cm double, product_height_cm double, product_width_cm double")
    sell = spark.createDataFrame([("s1", "00002", "Y", "RJ")], "seller_id string, seller_zip_code_prefix string, "
                                 "seller_city string, seller_state string")
    fact = build_fact(orders, items, pay, cust, prod, sell)
    assert fact.columns == FACT_COLUMNS
    got = sorted(rows(fact, "order_id", "customer_unique_id", "seller_state", "revenue", "total_order_value"))
    assert got == [("o1", "u1", "RJ", Decimal("10.00"), Decimal("11.00")),
                   ("o9", None, "RJ", Decimal("5.00"), Decimal("5.50"))]
