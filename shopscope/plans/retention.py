"""Customer retention marts: repeat rate, lifetime value, cohorts, churn, RFM.

A customer is ``customer_unique_id`` (the person), not the per-order
``customer_id``. Customer-level marts first reduce lines to one row per order,
then to one row per customer; both steps combine on the map side, so a
customer with a huge share of the orders never lands whole in one task.
Tiles over all customers use the distributed NTILE.

Recency is measured against ``as_of`` (default: the current time).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopscope.functions.scalar import even_round, mean, month_start, percent, sql_round, whole_days
from shopscope.operators.ranking import ascending, descending, exact_tiles, share_of_total
from shopscope.plans.revenue import _label, _orders, delivered_lines, with_reviews

CUSTOMER = "customer_unique_id"

# Fixed labels and thresholds of the marts.
CLV_TIERS = {1: "Platinum", 2: "Gold", 3: "Silver", 4: "Bronze", 5: "Standard"}
CHURNED, AT_RISK, LAPSING, ACTIVE = "Churned", "At Risk", "Lapsing", "Active"
CHURN_DAYS, AT_RISK_DAYS = 180, 90
MIN_CATEGORY_BUYERS = 50
MIN_CATEGORY_ORDERS = 100
RFM_SEGMENTS = ("Champions", "Loyal Customers", "New Customers", "At Risk High Value", "Lost",
                "Potential")


def as_of_column(as_of: dt.datetime | str | None) -> Column:
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def _customer_orders(fact: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """One row per (customer, order) of delivered lines."""
    o = _orders(fact, orders)
    ts = F.col("order_purchase_timestamp")
    return o.select(CUSTOMER, "order_id", "rev", "tov_sum", "tov_n", "lines",
                    ts.alias("first_ts"), ts.alias("last_ts"))


def customer_base(fact: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Per customer: orders, revenue, order value, first and last purchase."""
    return _customer_orders(fact, orders).groupBy(CUSTOMER).agg(
        F.count("order_id").alias("order_count"),
        F.round(F.sum("rev"), 2).alias("lifetime_revenue"),
        sql_round(mean(F.sum("tov_sum"), F.sum("tov_n")), 2).alias("avg_order_value"),
        F.min("first_ts").alias("first_order"),
        F.max("last_ts").alias("last_order"),
    )


def _clv_order() -> list[Column]:
    return [*descending(F.col("lifetime_revenue")), *ascending(F.col(CUSTOMER))]


def retention_rate(fact: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Customers, repeat and one-time customers, repeat share, orders per customer."""
    k = _customer_orders(fact, orders).groupBy(CUSTOMER).agg(F.count("order_id").alias("k"))
    repeat = F.count(F.when(F.col("k") > 1, 1))
    return k.agg(
        F.count(F.lit(1)).alias("total_customers"),
        repeat.alias("repeat_customers"),
        F.count(F.when(F.col("k") == 1, 1)).alias("one_time_customers"),
        sql_round(percent(repeat, F.count(F.lit(1))), 2).alias("retention_rate_pct"),
        sql_round(mean(F.sum("k"), F.count("k")), 2).alias("avg_orders_per_customer"),
    )


def customer_clv(fact: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Lifetime value per customer with its quintile and tier."""
    base = customer_base(fact, orders).withColumn(
        "customer_lifespan_days", whole_days("first_order", "last_order", "trunc"))
    tiled = exact_tiles(base, {"clv_quintile": (5, _clv_order())})
    return tiled.select(
        CUSTOMER, "order_count",
        F.col("lifetime_revenue").cast("double").alias("lifetime_revenue"),
        "avg_order_value", "first_order", "last_order", "customer_lifespan_days", "clv_quintile",
        _label(F.col("clv_quintile"), CLV_TIERS).alias("customer_tier"),
    ).orderBy(F.col("lifetime_revenue").desc_nulls_first(), F.col(CUSTOMER).asc_nulls_last())


def clv_tiers(fact: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Customers, revenue and orders per lifetime-value quintile."""
    base = customer_base(fact, orders).select(CUSTOMER, "lifetime_revenue", "order_count")
    tiled = exact_tiles(base, {"quintile": (5, _clv_order())})
    g = tiled.groupBy("quintile").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("lifetime_revenue").alias("rev"),
        mean(F.sum("lifetime_revenue"), F.count("lifetime_revenue")).alias("avg_clv"),
        mean(F.sum("order_count"), F.count("order_count")).alias("avg_orders"),
    )
    return g.select(
        _label(F.col("quintile"), CLV_TIERS).alias("customer_tier"),
        "customers",
        sql_round("rev", 2).alias("total_revenue"),
        sql_round("avg_clv", 2).alias("avg_clv"),
        sql_round("avg_orders", 2).alias("avg_orders"),
        sql_round(share_of_total(F.col("rev")), 1).alias("revenue_share_pct"),
        "quintile",
    ).orderBy("quintile").drop("quintile")


def cohort_retention(fact: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """T4: share of each first-purchase month still buying in later months.

    One scan and one customer-wide shuffle: every customer's distinct months
    (bounded by the calendar) are gathered, the first of them is the cohort, and
    a cohort's size is the number of its customers active in that month.
    The month number is the month part of the gap (it restarts after 11);
    ``months_total`` is the full gap.
    """
    o = _orders(fact, orders).filter(F.col(CUSTOMER).isNotNull())
    month = F.struct(month_start("order_purchase_timestamp").alias("month"))
    months = o.groupBy(CUSTOMER).agg(F.collect_set(month).alias("seen"))
    active = (months.select(F.array_min("seen.month").alias("cohort_month"), F.explode("seen.month")
                            .alias("activity_month"))
              .groupBy("cohort_month", "activity_month")
              .agg(F.count(F.lit(1)).alias("active_customers")))
    joined = F.when(F.col("activity_month") == F.col("cohort_month"), F.col("active_customers"))
    gap = F.months_between("activity_month", "cohort_month").cast("int")
    return (active.filter(F.col("cohort_month").isNotNull())
            .withColumn("cohort_customers", F.max(joined).over(W.partitionBy("cohort_month")))
            .select("cohort_month", "cohort_customers", "activity_month",
                    (gap % 12).alias("months_since_first_order"),
                    "active_customers",
                    sql_round(percent("active_customers", "cohort_customers"), 1).alias("retention_pct"),
                    gap.alias("months_total"))
            .orderBy("cohort_month", "activity_month"))


def churn_label(orders: Column, days: Column) -> Column:
    return (F.when((orders == 1) & (days > CHURN_DAYS), CHURNED)
            .when((orders == 1) & (days > AT_RISK_DAYS), AT_RISK)
            .when((orders > 1) & (days > CHURN_DAYS), LAPSING)
            .otherwise(ACTIVE))


def churn_status(fact: DataFrame, reviews: DataFrame, as_of=None,
                 orders: DataFrame | None = None) -> DataFrame:
    """T5: per customer orders, last purchase, spend, mean review score and churn status.

    The review score is averaged over lines (each line carries its order's
    review, so an order counts as many times as it has lines); a score of 0
    counts as missing. The order summary carries each order's review, so no
    join runs here.
    """
    score = F.when(F.col("review_score") != 0, F.col("review_score"))
    o = with_reviews(_orders(fact, orders), reviews)
    per_order = o.select(CUSTOMER, "order_id", "rev", "lines", F.col("order_purchase_timestamp").alias("last_ts"),
                         "review_score") \
        .select(CUSTOMER, "order_id", "rev", "last_ts",
                (score * F.col("lines")).alias("s_sum"),
                F.when(score.isNotNull(), F.col("lines")).otherwise(F.lit(0)).alias("s_n"))
    c = per_order.groupBy(CUSTOMER).agg(
        F.count("order_id").alias("total_orders"),
        F.max("last_ts").alias("last_order_date"),
        sql_round(F.sum("rev"), 2).alias("total_spent"),
        sql_round(mean(F.sum("s_sum"), F.sum("s_n")), 2).alias("avg_review_score"),
    )
    days = whole_days("last_order_date", as_of_column(as_of), "trunc")
    return c.withColumn("days_since_last_order", days) \
        .withColumn("churn_status", churn_label(F.col("total_orders"), F.col("days_since_last_order"))) \
        .orderBy(F.col("days_since_last_order").desc_nulls_first(), F.col(CUSTOMER).asc_nulls_last())


def churn_summary(fact: DataFrame, as_of=None, orders: DataFrame | None = None) -> DataFrame:
    """Customers per churn status and their share."""
    c = _customer_orders(fact, orders).groupBy(CUSTOMER).agg(
        F.count("order_id").alias("total_orders"),
        F.max("last_ts").alias("last_order_date"))
    days = whole_days("last_order_date", as_of_column(as_of), "trunc")
    g = c.withColumn("churn_status", churn_label(F.col("total_orders"), days)) \
        .groupBy("churn_status").agg(F.count(F.lit(1)).alias("customers"))
    return g.select("churn_status", "customers",
                    sql_round(share_of_total(F.col("customers")), 1).alias("pct")) \
        .orderBy(F.col("customers").desc_nulls_first(), "churn_status")


def category_repeat_rate(fact: DataFrame, min_buyers: int = MIN_CATEGORY_BUYERS) -> DataFrame:
    """Share of a category's buyers who bought it in more than one order."""
    lines = delivered_lines(fact).filter(F.col("product_category_name_english").isNotNull())
    cc = lines.groupBy(CUSTOMER, F.col("product_category_name_english").alias("category")) \
        .agg(F.count_distinct("order_id").alias("k"))
    repeat = F.count(F.when(F.col("k") > 1, 1))
    g = cc.groupBy("category").agg(F.count(CUSTOMER).alias("total_buyers"),
                                   repeat.alias("repeat_buyers"))
    return g.filter(F.col("total_buyers") > min_buyers) \
        .withColumn("repeat_rate_pct", sql_round(percent("repeat_buyers", "total_buyers"), 1)) \
        .orderBy(F.col("repeat_rate_pct").desc_nulls_first(), "category")


def _rfm_scored(fact: DataFrame, as_of=None, orders: DataFrame | None = None,
                score_direction: str = "reference") -> DataFrame:
    c = _customer_orders(fact, orders).groupBy(CUSTOMER).agg(
        F.max("last_ts").alias("last_ts"),
        F.count("order_id").alias("frequency"),
        F.round(F.sum("rev"), 2).alias("monetary"))
    c = c.withColumn("recency_days", whole_days("last_ts", as_of_column(as_of), "trunc")).drop("last_ts")
    tie = ascending(F.col(CUSTOMER))
    c = exact_tiles(c, {"r_score": (5, [*ascending(F.col("recency_days")), *tie]),
                        "f_score": (5, [*descending(F.col("frequency")), *tie]),
                        "m_score": (5, [*descending(F.col("monetary")), *tie])})
    if score_direction == "high_is_best":
        # 5 = most recent / most frequent / highest spend, so the segment
        # names match their meaning.
        c = c.withColumns({k: (6 - F.col(k)).cast("int") for k in ("r_score", "f_score", "m_score")})
    elif score_direction != "reference":
        raise ValueError(f"unknown score_direction {score_direction!r}")
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    total = r + f + m
    segment = (F.when(total >= 13, RFM_SEGMENTS[0])
               .when(total >= 10, RFM_SEGMENTS[1])
               .when((r >= 4) & (f <= 2), RFM_SEGMENTS[2])
               .when((r <= 2) & (m >= 4), RFM_SEGMENTS[3])
               .when(r <= 2, RFM_SEGMENTS[4])
               .otherwise(RFM_SEGMENTS[5]))
    return c.withColumns({"rfm_total": total, "rfm_segment": segment})


def rfm_segments(fact: DataFrame, as_of=None, orders: DataFrame | None = None,
                 score_direction: str = "reference") -> DataFrame:
    """Recency, frequency and monetary quintiles and the segment per customer.

    With ``score_direction="reference"`` score 1 is the most recent / most
    frequent / highest spend, as in the source queries; ``"high_is_best"``
    turns the scores round.
    """
    return _rfm_scored(fact, as_of, orders, score_direction).select(
        CUSTOMER, "recency_days", "frequency",
        F.col("monetary").cast("double").alias("monetary"),
        "r_score", "f_score", "m_score", "rfm_total", "rfm_segment",
    ).orderBy(F.col("rfm_total").desc_nulls_first(), F.col(CUSTOMER).asc_nulls_last())


def rfm_summary(fact: DataFrame, as_of=None, orders: DataFrame | None = None,
                score_direction: str = "reference") -> DataFrame:
    """Customers, value, orders and recency per RFM segment."""
    g = _rfm_scored(fact, as_of, orders, score_direction).groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        mean(F.sum("monetary"), F.count("monetary")).alias("avg_clv"),
        mean(F.sum("frequency"), F.count("frequency")).alias("avg_orders"),
        mean(F.sum("recency_days"), F.count("recency_days")).alias("avg_recency"),
        F.sum("monetary").alias("rev"),
    )
    return g.select(
        "rfm_segment", "customers",
        sql_round("avg_clv", 2).alias("avg_clv"),
        sql_round("avg_orders", 2).alias("avg_orders"),
        even_round("avg_recency", 0).alias("avg_recency_days"),
        sql_round("rev", 2).alias("total_revenue"),
        sql_round(share_of_total(F.col("customers")), 1).alias("pct_of_customers"),
    ).orderBy(F.col("total_revenue").desc_nulls_first(), "rfm_segment")


def review_vs_revenue(fact: DataFrame, reviews: DataFrame,
                      min_orders: int = MIN_CATEGORY_ORDERS) -> DataFrame:
    """Review score, revenue and negative-review share per category."""
    lines = delivered_lines(fact).filter(F.col("product_category_name_english").isNotNull()) \
        .select(F.col("product_category_name_english").alias("category"), "order_id", "revenue") \
        .join(reviews.select("order_id", "review_id", "review_score", "is_negative_review"),
              "order_id", "left")
    negative = F.count(F.when(F.col("is_negative_review"), 1))
    g = lines.groupBy("category").agg(
        sql_round(mean(F.sum("review_score"), F.count("review_score")), 2).alias("avg_review_score"),
        sql_round(F.sum("revenue"), 2).alias("total_revenue"),
        F.count_distinct("order_id").alias("orders"),
        negative.alias("negative_reviews"),
        sql_round(percent(negative, F.count("review_id")), 1).alias("negative_review_pct"),
    )
    return g.filter(F.col("orders") > min_orders) \
        .orderBy(F.col("avg_review_score").desc_nulls_first(), "category")
