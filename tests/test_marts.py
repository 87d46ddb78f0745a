"""Marts on hand-written fact rows (edge cases from FIXTURES.md section 6)."""

import datetime as dt
from decimal import Decimal

import pytest

from shopscope.plans import retention as T
from shopscope.plans import revenue as R
from shopscope.schemas import FACT_COLUMNS

AS_OF = "2020-01-01 00:00:00"


def fact_rows(spark, rows):
    """rows: dicts with any fact columns; the rest are null, status delivered."""
    base = {c: None for c in FACT_COLUMNS}
    data = []
    for i, r in enumerate(rows):
        row = {**base, "order_status": "delivered", "order_item_id": 1, "is_late_delivery": False, **r}
        ts = row["order_purchase_timestamp"]
        if ts is not None:
            row.update(order_year=ts.year, order_month=ts.month, order_quarter=(ts.month - 1) // 3 + 1)
        for money in ("price", "freight_value", "revenue", "total_order_value"):
            if row[money] is not None:
                row[money] = Decimal(str(row[money]))
        if row["revenue"] is None and row["price"] is not None:
            row["revenue"] = row["price"]
        data.append(tuple(row[c] for c in FACT_COLUMNS))
    schema = ("order_id string, order_item_id int, product_id string, seller_id string, "
              "shipping_limit_date timestamp_ntz, price decimal(18,2), freight_value decimal(18,2), "
              "total_item_revenue decimal(18,2), customer_id string, order_status string, "
              "order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, "
              "order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz, "
              "order_estimated_delivery_date timestamp_ntz, delivery_days int, is_late_delivery boolean, "
              "order_year int, order_month int, order_quarter int, total_payment decimal(18,2), "
              "payment_installments int, primary_payment_type string, customer_unique_id string, "
              "customer_zip_code_prefix string, customer_city string, customer_state string, "
              "product_category_name string, product_category_name_english string, product_name_length int, "
              "product_description_length int, product_photos_qty int, product_weight_g double, "
              "product_length_cm double, product_height_cm double, product_width_cm double, "
              "seller_zip_code_prefix string, seller_city string, seller_state string, revenue decimal(18,2), "
              "total_order_value decimal(18,2)")
    return spark.createDataFrame(data, schema)


def ts(y, m, d, h=0):
    return dt.datetime(y, m, d, h)


def test_monthly_trend_gap_and_zero_previous_month(spark):
    f = fact_rows(spark, [
        {"order_id": "a", "order_purchase_timestamp": ts(2019, 1, 5), "price": 0},
        {"order_id": "b", "order_purchase_timestamp": ts(2019, 2, 5), "price": 100},
        {"order_id": "c", "order_purchase_timestamp": ts(2019, 4, 5), "price": 150},   # March missing
    ])
    got = {r["order_month"]: r for r in R.monthly_trend(f).collect()}
    assert got[2]["prev_month_revenue"] == 0.0 and got[2]["mom_growth_pct"] is None   # divide by zero -> null
    assert got[4]["prev_month_revenue"] == 100.0 and got[4]["mom_growth_pct"] == 50.0  # previous row, not March
    assert got[4]["cumulative_revenue"] == 250.0


def test_freight_flags_are_strictly_greater(spark):
    f = fact_rows(spark, [
        {"order_id": "1", "product_category_name_english": "A", "price": 100, "freight_value": 15},
        {"order_id": "2", "product_category_name_english": "B", "price": 100, "freight_value": 30},
        {"order_id": "3", "product_category_name_english": "C", "price": 100, "freight_value": 30.01},
        {"order_id": "4", "product_category_name_english": "D", "price": 0, "freight_value": 5},
    ])
    got = {r["category"]: (r["freight_revenue_ratio"], r["leakage_flag"]) for r in R.freight_leakage(f).collect()}
    assert got == {"A": (15.0, "Healthy"), "B": (30.0, "Medium Leakage"), "C": (30.0, "Medium Leakage"),
                   "D": (None, "Healthy")}


def test_churn_boundaries(spark):
    as_of = dt.datetime(2020, 1, 1)
    rows = []
    for days, orders in [(90, 1), (91, 1), (180, 1), (181, 1), (180, 2), (181, 2)]:
        cust = f"u{days}_{orders}"
        for k in range(orders):
            rows.append({"order_id": f"{cust}_{k}", "customer_unique_id": cust, "price": 10,
                         "order_purchase_timestamp": as_of - dt.timedelta(days=days + 2 * k, hours=1)})
    f = fact_rows(spark, rows)
    reviews = spark.createDataFrame([], "order_id string, review_score int")
    got = {r["customer_unique_id"]: (r["days_since_last_order"], r["churn_status"])
           for r in T.churn_status(f, reviews, as_of=AS_OF).collect()}
    assert got == {"u90_1": (90, "Active"), "u91_1": (91, "At Risk"), "u180_1": (180, "At Risk"),
                   "u181_1": (181, "Churned"), "u180_2": (180, "Active"), "u181_2": (181, "Lapsing")}


def test_cohort_month_number_wraps_after_eleven(spark):
    f = fact_rows(spark, [
        {"order_id": "1", "customer_unique_id": "u", "order_purchase_timestamp": ts(2018, 1, 10), "price": 1},
        {"order_id": "2", "customer_unique_id": "u", "order_purchase_timestamp": ts(2019, 5, 3), "price": 1},
    ])
    got = sorted((r["months_total"], r["months_since_first_order"], r["retention_pct"])
                 for r in T.cohort_retention(f).collect())
    assert got == [(0, 0, 100.0), (16, 4, 100.0)]


def test_review_average_is_line_weighted_and_zero_is_missing(spark):
    f = fact_rows(spark, [
        {"order_id": "o1", "customer_unique_id": "u", "order_item_id": 1, "price": 1,
         "order_purchase_timestamp": ts(2019, 12, 1)},
        {"order_id": "o1", "customer_unique_id": "u", "order_item_id": 2, "price": 1,
         "order_purchase_timestamp": ts(2019, 12, 1)},
        {"order_id": "o2", "customer_unique_id": "u", "price": 1, "order_purchase_timestamp": ts(2019, 12, 2)},
        {"order_id": "o3", "customer_unique_id": "u", "price": 1, "order_purchase_timestamp": ts(2019, 12, 3)},
    ])
    reviews = spark.createDataFrame([("o1", 5), ("o2", 2), ("o3", 0)], "order_id string, review_score int")
    r = T.churn_status(f, reviews, as_of=AS_OF).first()
    assert r["total_orders"] == 3 and r["avg_review_score"] == pytest.approx(4.0)   # (5+5+2)/3


def test_seller_quartiles_with_fewer_sellers_than_tiles(spark):
    f = fact_rows(spark, [{"order_id": str(i), "seller_id": f"s{i}", "price": 10 * i} for i in range(1, 4)])
    reviews = spark.createDataFrame([], "order_id string, review_score int")
    got = {r["seller_id"]: (r["revenue_quartile"], r["performance_tier"]) for r in R.seller_tiers(f, reviews).collect()}
    assert got == {"s3": (1, "Top 25%"), "s2": (2, "Upper Mid"), "s1": (3, "Lower Mid")}
