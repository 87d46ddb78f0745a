"""Revenue marts over the line-item fact.

Every mart reads delivered lines only (the payment mix reads the payment
aggregate). Money stays decimal until the final rounding; averages are exact
sums divided by counts; percentages are computed in double and rounded half
away from zero (see :mod:`shopscope.functions.scalar`).

Where a mart needs several distinct counts, it first reduces the lines to one
row per order (an order fixes its customer, state, year and quarter), so Spark
plans one plain aggregate per level instead of an ``Expand`` that copies every
line once per distinct column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopscope.functions.scalar import day_start, mean, month_start, percent, sql_round
from shopscope.operators.ranking import ascending, descending, exact_tiles, share_of_total
from shopscope.operators.sizing import bounded_broadcast

DELIVERED = "delivered"

# Fixed labels and thresholds of the marts.
SELLER_TIERS = {1: "Top 25%", 2: "Upper Mid", 3: "Lower Mid", 4: "Bottom 25%"}
LEAKAGE_HIGH, LEAKAGE_MEDIUM = 30, 15
LEAKAGE_LABELS = ("High Leakage", "Medium Leakage", "Healthy")
EXCLUDED_PAYMENT_TYPES = ["not_defined"]
ROLLING_ROWS = 30
TOP_PRODUCTS = 20


def delivered_lines(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("order_status") == DELIVERED)


def _label(col, labels: dict):
    out = None
    for key, text in labels.items():
        out = (F.when(col == key, text) if out is None else out.when(col == key, text))
    return out


def _order_grain(lines: DataFrame, *keys: str) -> DataFrame:
    """One row per order with the sums the marts need.

    ``keys`` are columns fixed by the order (customer, state, period); grouping
    on them together with ``order_id`` keeps them without a second lookup.
    """
    return lines.groupBy("order_id", *keys).agg(
        F.sum("revenue").alias("rev"),
        F.sum("total_order_value").alias("tov_sum"),
        F.count("total_order_value").alias("tov_n"),
        F.sum("delivery_days").alias("dd_sum"),
        F.count("delivery_days").alias("dd_n"),
        F.max("delivery_days").alias("delivery_days"),
        F.count(F.lit(1)).alias("lines"),
        F.count(F.when(F.col("is_late_delivery"), 1)).alias("late"),
        F.max("is_late_delivery").alias("is_late_delivery"),
    )


# Columns fixed by the order, kept on the order summary.
ORDER_KEYS = ("customer_unique_id", "customer_state", "order_year", "order_month", "order_quarter",
              "order_purchase_timestamp")


REVIEW_COLUMNS = ("review_id", "review_score", "is_negative_review", "has_review")


def order_summary(fact: DataFrame, reviews: DataFrame | None = None) -> DataFrame:
    """Delivered orders, one row each: the shared first step of the order- and
    customer-level marts. The pipeline writes it once next to the fact, so
    those marts start from a table a few times smaller than the lines and skip
    a full shuffle each. With ``reviews`` (at most one per order after
    cleaning) the order's review is attached once here, so review-based marts
    need no join of their own."""
    o = _order_grain(delivered_lines(fact), *ORDER_KEYS)
    return o if reviews is None else with_reviews(o, reviews)


def with_reviews(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """The order rows with their review columns (joined only when missing)."""
    if all(c in orders.columns for c in REVIEW_COLUMNS):
        return orders
    types = {"review_id": "string", "review_score": "int", "is_negative_review": "boolean"}
    r = reviews.select("order_id", *[F.col(c) if c in reviews.columns else F.lit(None).cast(t).alias(c)
                                     for c, t in types.items()],
                       F.lit(True).alias("has_review"))
    return orders.join(r, "order_id", "left")


def _orders(fact: DataFrame, orders: DataFrame | None) -> DataFrame:
    return orders if orders is not None else order_summary(fact)


def kpi_summary(fact: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Orders, revenue, average order value, delivery days, late share."""
    o = _orders(fact, orders)
    return o.agg(
        F.count("order_id").alias("total_orders"),
        sql_round(F.sum("rev"), 2).alias("total_revenue"),
        sql_round(mean(F.sum("tov_sum"), F.sum("tov_n")), 2).alias("avg_order_value"),
        sql_round(mean(F.sum("dd_sum"), F.sum("dd_n")), 1).alias("avg_delivery_days"),
        sql_round(percent(F.sum("late"), F.sum("lines")), 1).alias("late_delivery_pct"),
    )


def monthly_trend(fact: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """R2: revenue and orders per month, previous month, growth, running total.

    The window runs over one row per month, a calendar-bounded count.
    """
    m = (_orders(fact, orders)
         .groupBy("order_year", "order_month",
                  month_start("order_purchase_timestamp").alias("month_start"))
         .agg(F.round(F.sum("rev"), 2).alias("m"),
              F.count("order_id").alias("order_count")))
    by_month = Window.orderBy(F.col("month_start").asc_nulls_last())
    prev = F.lag("m").over(by_month)
    running = F.sum("m").over(by_month.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return m.select(
        "month_start", "order_year", "order_month",
        F.col("m").cast("double").alias("monthly_revenue"),
        "order_count",
        prev.cast("double").alias("prev_month_revenue"),
        sql_round(percent(F.col("m") - prev, prev), 1).alias("mom_growth_pct"),
        running.cast("double").alias("cumulative_revenue"),
    ).orderBy(F.col("month_start").asc_nulls_last())


def quarterly_breakdown(fact: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Revenue, orders, customers and order value per quarter."""
    o = _orders(fact, orders)
    return (o.groupBy("order_year", "order_quarter")
            .agg(sql_round(F.sum("rev"), 2).alias("quarterly_revenue"),
                 F.count("order_id").alias("orders"),
                 F.count_distinct("customer_unique_id").alias("unique_customers"),
                 sql_round(mean(F.sum("tov_sum"), F.sum("tov_n")), 2).alias("avg_order_value"))
            .orderBy(F.col("order_year").asc_nulls_last(), F.col("order_quarter").asc_nulls_last()))


def _category_totals(fact: DataFrame) -> DataFrame:
    lines = delivered_lines(fact).filter(F.col("product_category_name_english").isNotNull())
    return (lines.groupBy(F.col("product_category_name_english").alias("category"))
            .agg(F.sum("revenue").alias("rev"),
                 F.sum("freight_value").alias("freight"),
                 F.sum("price").alias("price_sum"),
                 F.count("price").alias("price_n"),
                 F.count_distinct("order_id").alias("orders")))


def category_ranking(fact: DataFrame) -> DataFrame:
    """Categories ranked by revenue and by orders, with freight share."""
    c = _category_totals(fact).withColumn("total_revenue", F.round("rev", 2))
    return c.select(
        "category",
        F.col("total_revenue").cast("double").alias("total_revenue"),
        "orders",
        sql_round(mean("price_sum", "price_n"), 2).alias("avg_price"),
        sql_round("freight", 2).alias("total_freight"),
        sql_round(percent("freight", "rev"), 1).alias("freight_pct"),
        F.rank().over(Window.orderBy(F.col("total_revenue").desc_nulls_first())).alias("revenue_rank"),
        F.rank().over(Window.orderBy(F.col("orders").desc_nulls_first())).alias("order_volume_rank"),
        sql_round(share_of_total(F.col("total_revenue")), 2).alias("revenue_share_pct"),
    ).orderBy("revenue_rank", "category")


def state_ranking(fact: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Revenue per customer state, ranked, with share of the total."""
    o = _orders(fact, orders)
    s = (o.groupBy("customer_state")
         .agg(F.sum("rev").alias("rev"),
              F.count("order_id").alias("orders"),
              F.count_distinct("customer_unique_id").alias("customers"),
              mean(F.sum("tov_sum"), F.sum("tov_n")).alias("aov")))
    return s.select(
        "customer_state",
        sql_round("rev", 2).alias("total_revenue"),
        "orders", "customers",
        sql_round("aov", 2).alias("avg_order_value"),
        F.rank().over(Window.orderBy(F.col("rev").desc_nulls_first())).alias("revenue_rank"),
        sql_round(share_of_total(F.col("rev")), 2).alias("revenue_share_pct"),
    ).orderBy(F.col("total_revenue").desc_nulls_first(), "customer_state")


def rolling_revenue(fact: DataFrame, rows: int = ROLLING_ROWS, orders: DataFrame | None = None,
                    calendar: bool = False) -> DataFrame:
    """Revenue per day and the mean of the last ``rows`` day rows.

    By default the frame counts rows (days with sales), as the source report
    does; ``calendar=True`` averages over the last ``rows`` calendar days
    instead (days without sales are absent, not zero). The window runs over one
    row per day.
    """
    d = (_orders(fact, orders)
         .groupBy(day_start("order_purchase_timestamp").alias("day"))
         .agg(F.round(F.sum("rev"), 2).alias("daily")))
    if calendar:
        w = Window.orderBy(F.unix_date(F.to_date("day"))).rangeBetween(-(rows - 1), Window.currentRow)
    else:
        w = Window.orderBy(F.col("day").asc_nulls_last()).rowsBetween(-(rows - 1), Window.currentRow)
    return d.select(
        "day",
        F.col("daily").cast("double").alias("daily_revenue"),
        sql_round(mean(F.sum("daily").over(w), F.count("daily").over(w)), 2).alias("rolling_30d_avg"),
    ).orderBy(F.col("day").asc_nulls_last())


def top_products(fact: DataFrame, products: DataFrame, reviews: DataFrame,
                 limit: int = TOP_PRODUCTS) -> DataFrame:
    """The products in most distinct orders, with revenue, price and review score.

    A distributed top-k: each task keeps its best ``limit`` rows.
    """
    p = products.select("product_id", F.col("product_category_name_english").alias("category"))
    r = reviews.select("order_id", "review_score")
    lines = (delivered_lines(fact).select("product_id", "order_id", "revenue", "price")
             .join(bounded_broadcast(p), "product_id")
             .join(r, "order_id", "left"))
    g = lines.groupBy("product_id", "category").agg(
        F.count_distinct("order_id").alias("times_ordered"),
        sql_round(F.sum("revenue"), 2).alias("total_revenue"),
        sql_round(mean(F.sum("price"), F.count("price")), 2).alias("avg_price"),
        sql_round(mean(F.sum("review_score"), F.count("review_score")), 2).alias("avg_review_score"),
    )
    return g.orderBy(F.col("times_ordered").desc_nulls_first(), F.col("product_id").asc_nulls_last(),
                     F.col("category").asc_nulls_last()).limit(limit)


def freight_leakage(fact: DataFrame) -> DataFrame:
    """Freight as a share of revenue per category, flagged above 15% and 30%."""
    c = _category_totals(fact)
    ratio = sql_round(percent("freight", "rev"), 1)
    out = c.select(
        "category",
        sql_round("rev", 2).alias("total_revenue"),
        sql_round("freight", 2).alias("total_freight"),
        ratio.alias("freight_revenue_ratio"),
        "orders",
    )
    r = F.col("freight_revenue_ratio")
    flag = F.when(r > LEAKAGE_HIGH, LEAKAGE_LABELS[0]).when(r > LEAKAGE_MEDIUM, LEAKAGE_LABELS[1]) \
        .otherwise(LEAKAGE_LABELS[2])
    return out.withColumn("leakage_flag", flag) \
        .orderBy(r.desc_nulls_first(), F.col("category"))


def seller_tiers(fact: DataFrame, reviews: DataFrame) -> DataFrame:
    """Per seller revenue, orders, review score and delivery time, in revenue quartiles.

    Sellers grow with the shop, so the quartile comes from border rows, not from a global window.
    """
    lines = delivered_lines(fact).select("seller_id", "seller_state", "order_id", "revenue",
                                         "delivery_days") \
        .join(reviews.select("order_id", "review_score"), "order_id", "left")
    s = lines.groupBy("seller_id", "seller_state").agg(
        F.round(F.sum("revenue"), 2).alias("rev"),
        F.count_distinct("order_id").alias("total_orders"),
        sql_round(mean(F.sum("review_score"), F.count("review_score")), 2).alias("avg_review_score"),
        sql_round(mean(F.sum("delivery_days"), F.count("delivery_days")), 1).alias("avg_delivery_days"),
    )
    order = [*descending(F.col("rev")), *ascending(F.col("seller_id")), *ascending(F.col("seller_state"))]
    tiled = exact_tiles(s, {"revenue_quartile": (4, order)})
    return tiled.select(
        "seller_id", "seller_state",
        F.col("rev").cast("double").alias("total_revenue"),
        "total_orders", "avg_review_score", "avg_delivery_days", "revenue_quartile",
        _label(F.col("revenue_quartile"), SELLER_TIERS).alias("performance_tier"),
    ).orderBy(F.col("total_revenue").desc_nulls_first(), "seller_id")


def payment_mix(payments: DataFrame) -> DataFrame:
    """Orders and value per primary payment type, with share of orders.

    ``NOT IN`` drops orders without a type as well.
    """
    p = payments.filter(~F.col("primary_payment_type").isin(EXCLUDED_PAYMENT_TYPES))
    g = p.groupBy("primary_payment_type").agg(
        F.count_distinct("order_id").alias("orders"),
        sql_round(F.sum("total_payment"), 2).alias("total_value"),
        sql_round(mean(F.sum("total_payment"), F.count("total_payment")), 2).alias("avg_order_value"),
        sql_round(mean(F.sum("payment_installments"), F.count("payment_installments")), 1)
        .alias("avg_installments"),
        F.count(F.lit(1)).alias("_rows"),
    )
    return g.select(
        "primary_payment_type", "orders", "total_value", "avg_order_value", "avg_installments",
        sql_round(share_of_total(F.col("_rows")), 1).alias("pct_of_orders"),
    ).orderBy(F.col("orders").desc_nulls_first(), "primary_payment_type")
