"""Marts behind the dashboard's stated findings (year-over-year growth,
seasonality, concentration, review effects, reorders, churn by state,
installments).

Same conventions as :mod:`shopscope.plans.revenue`: delivered lines, exact
money sums, rounding through decimals, grouping on the map side first.
Windows without ``PARTITION BY`` run only over months, calendar months or
states (a few hundred rows at most).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopscope.functions.scalar import mean, month_start, percent, sql_round, whole_days
from shopscope.operators.ranking import share_of_total
from shopscope.plans.retention import CUSTOMER, as_of_column, churn_label
from shopscope.plans.revenue import _orders, delivered_lines, with_reviews

# Fixed bucket and sentiment labels.
INSTALLMENT_BUCKETS = ("1", "2-5", "6+", "unknown")
SENTIMENTS = ("positive", "neutral", "negative", "no review")


def _monthly(fact: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    return (_orders(fact, orders).filter(F.col("order_purchase_timestamp").isNotNull())
            .groupBy(month_start("order_purchase_timestamp").alias("month_start"))
            .agg(F.sum("rev").alias("m")))


def yoy_growth(fact: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Each month's revenue against the same calendar month a year before."""
    m = _monthly(fact, orders)
    prev = m.select(F.add_months("month_start", 12).cast("timestamp_ntz").alias("month_start"),
                    F.col("m").alias("p"))
    return m.join(prev, "month_start", "left").select(
        "month_start",
        F.col("m").cast("double").alias("monthly_revenue"),
        F.col("p").cast("double").alias("prev_year_revenue"),
        sql_round(percent(F.col("m") - F.col("p"), "p"), 1).alias("yoy_growth_pct"),
    ).orderBy("month_start")


def month_of_year(fact: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Average revenue per calendar month and its index against all months."""
    m = _monthly(fact, orders).withColumn("order_month", F.month("month_start"))
    g = m.groupBy("order_month").agg(F.count(F.lit(1)).alias("months"), F.sum("m").alias("s"))
    avg_month = mean(F.col("s"), F.col("months"))
    overall = mean(F.sum("s").over(Window.partitionBy()), F.sum("months").over(Window.partitionBy()))
    return g.select(
        "order_month", "months",
        sql_round(avg_month, 2).alias("avg_monthly_revenue"),
        sql_round(F.lit(100.0) * avg_month / overall, 1).alias("seasonal_index"),
    ).orderBy("order_month")


def state_concentration(fact: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """D3: states by revenue with their share and the running share of the top n."""
    s = _orders(fact, orders).groupBy("customer_state").agg(F.sum("rev").alias("rev"))
    order = Window.orderBy(F.col("rev").desc_nulls_first(), F.col("customer_state").asc_nulls_last())
    share = share_of_total(F.col("rev"))
    return s.select(
        "customer_state",
        F.row_number().over(order).alias("revenue_rank"),
        F.col("rev").cast("double").alias("total_revenue"),
        sql_round(share, 2).alias("revenue_share_pct"),
        sql_round(F.lit(100.0) * F.sum("rev").over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("double")
                  / F.sum("rev").over(Window.partitionBy()).cast("double"), 2).alias("cumulative_share_pct"),
    ).orderBy("revenue_rank")


def review_score_distribution(reviews: DataFrame) -> DataFrame:
    """Reviews per score and their share."""
    g = reviews.groupBy("review_score").agg(F.count(F.lit(1)).alias("reviews"))
    return g.select("review_score", "reviews", sql_round(share_of_total(F.col("reviews")), 1).alias("pct")) \
        .orderBy("review_score")


def negative_review_heatmap(fact: DataFrame, reviews: DataFrame) -> DataFrame:
    """Share of orders with a negative review per (customer state, category)."""
    lines = delivered_lines(fact).filter(F.col("product_category_name_english").isNotNull()) \
        .select("customer_state", F.col("product_category_name_english").alias("category"), "order_id") \
        .join(reviews.select("order_id", "is_negative_review"), "order_id", "left")
    per_order = lines.groupBy("customer_state", "category", "order_id").agg(
        F.max(F.coalesce("is_negative_review", F.lit(False)).cast("int")).alias("neg"))
    g = per_order.groupBy("customer_state", "category").agg(
        F.count("order_id").alias("orders"), F.sum("neg").alias("negative_orders"))
    return g.withColumn("negative_pct", sql_round(percent("negative_orders", "orders"), 1))


def late_delivery_reviews(fact: DataFrame, reviews: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Review score and negative share for late and on-time orders."""
    o = with_reviews(_orders(fact, orders), reviews)
    g = o.groupBy("is_late_delivery").agg(
        F.count(F.lit(1)).alias("orders"),
        F.count("review_score").alias("reviewed_orders"),
        sql_round(mean(F.sum("review_score"), F.count("review_score")), 2).alias("avg_review_score"),
        sql_round(percent(F.count(F.when(F.col("is_negative_review"), 1)), F.count("review_score")), 1)
        .alias("negative_review_pct"))
    return g.orderBy("is_late_delivery")


def delivery_review_correlation(fact: DataFrame, reviews: DataFrame,
                                orders: DataFrame | None = None) -> DataFrame:
    """Pearson correlation of delivery days and review score over orders."""
    o = with_reviews(_orders(fact, orders), reviews).filter(F.col("has_review").isNotNull())
    return o.agg(F.count(F.lit(1)).alias("orders"),
                 sql_round(F.corr(F.col("delivery_days").cast("double"), F.col("review_score").cast("double")), 4)
                 .alias("correlation"))


def _sentiment(score):
    return (F.when(score >= 4, SENTIMENTS[0]).when(score == 3, SENTIMENTS[1])
            .when(score <= 2, SENTIMENTS[2]).otherwise(SENTIMENTS[3]))


def reorder_by_sentiment(fact: DataFrame, reviews: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Share of customers who ordered again, by the review of their first order."""
    per_order = _orders(fact, orders).filter(F.col(CUSTOMER).isNotNull()) \
        .withColumnRenamed("order_purchase_timestamp", "ts")
    scored = with_reviews(per_order, reviews)
    c = scored.groupBy(CUSTOMER).agg(
        F.count("order_id").alias("orders"),
        F.min_by("review_score", F.struct(F.col("ts").isNull(), F.col("ts"), F.col("order_id"))).alias("review_score"))
    g = c.groupBy(_sentiment(F.col("review_score")).alias("first_review")).agg(
        F.count(F.lit(1)).alias("customers"),
        F.count(F.when(F.col("orders") > 1, 1)).alias("repeat_customers"))
    return g.withColumn("reorder_rate_pct", sql_round(percent("repeat_customers", "customers"), 1)) \
        .orderBy("first_review")


def churn_by_state(fact: DataFrame, as_of=None, orders: DataFrame | None = None) -> DataFrame:
    """Churn status counts per state (the state of the customer's latest order)."""
    per_order = _orders(fact, orders).select(CUSTOMER, "order_id", F.col("order_purchase_timestamp").alias("ts"),
                                             F.col("customer_state").alias("state"))
    cust = per_order.groupBy(CUSTOMER).agg(
        F.count("order_id").alias("total_orders"), F.max("ts").alias("last_order_date"),
        F.max_by("state", F.struct(F.col("ts").isNotNull(), F.col("ts"), F.col("order_id"))).alias("customer_state"))
    days = whole_days("last_order_date", as_of_column(as_of), "trunc")
    g = cust.withColumn("churn_status", churn_label(F.col("total_orders"), days)) \
        .groupBy("customer_state", "churn_status").agg(F.count(F.lit(1)).alias("customers"))
    in_state = F.sum("customers").over(Window.partitionBy("customer_state"))
    return g.withColumn("pct_of_state", sql_round(F.lit(100.0) * F.col("customers").cast("double")
                                                  / in_state.cast("double"), 1)) \
        .orderBy("customer_state", "churn_status")


def installment_buckets(payments: DataFrame) -> DataFrame:
    """Orders and value by number of installments (1, 2-5, 6+)."""
    n = F.col("payment_installments")
    bucket = (F.when(n.isNull(), INSTALLMENT_BUCKETS[3]).when(n <= 1, INSTALLMENT_BUCKETS[0])
              .when(n <= 5, INSTALLMENT_BUCKETS[1]).otherwise(INSTALLMENT_BUCKETS[2]))
    g = payments.groupBy(bucket.alias("installment_bucket")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("total_payment").alias("s"),
        F.count("total_payment").alias("n"))
    return g.select("installment_bucket", "orders", sql_round("s", 2).alias("total_value"),
                    sql_round(mean("s", "n"), 2).alias("avg_order_value"),
                    sql_round(share_of_total(F.col("orders")), 1).alias("pct_of_orders")) \
        .orderBy("installment_bucket")
