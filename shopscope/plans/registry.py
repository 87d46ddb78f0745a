"""Every query the package offers, as ``(spark, data_folder) -> DataFrame``.

Each callable reads the data folder's tables (through the written warehouse)
and returns a lazy frame; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopscope.operators import quality as K
from shopscope.plans import forecast as FC
from shopscope.plans import insights as D
from shopscope.plans import retention as T
from shopscope.plans import revenue as R
from shopscope.plans.warehouse import open_warehouse
from shopscope.schemas import FOREIGN_KEYS, PRIMARY_KEYS
from shopscope.sources.driver_tables import raw_tables

# Fixed evaluation time of the recency marts, so results are reproducible.
AS_OF = "2001-08-02 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]


def _table(name: str) -> Query:
    return lambda spark, sf: open_warehouse(spark, sf).table(name)


def _on_fact(fn, *tables: str, **kwargs) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        wh = open_warehouse(spark, sf)
        return fn(wh.table("fact_orders"), *[wh.table(t) for t in tables], **kwargs)
    run.__name__ = fn.__name__
    return run


def _on_orders(fn, *tables: str, **kwargs) -> Query:
    """A mart that starts from the written order summary."""
    def run(spark: SparkSession, sf: str) -> DataFrame:
        wh = open_warehouse(spark, sf)
        return fn(wh.table("fact_orders"), *[wh.table(t) for t in tables],
                  orders=wh.table("order_summary"), **kwargs)
    run.__name__ = fn.__name__
    return run


CLEAN_QUERIES: dict[str, Query] = {
    "clean_customers": _table("customers"),
    "clean_sellers": _table("sellers"),
    "clean_geolocation": _table("geolocation"),
    "clean_orders": _table("orders"),
    "clean_order_items": _table("order_items"),
    "clean_payments": _table("order_payments"),
    "payments_by_order": _table("order_payments_aggregated"),
    "clean_reviews": _table("order_reviews"),
    "clean_products": _table("products"),
    "fact_orders": _table("fact_orders"),
}

REVENUE_QUERIES: dict[str, Query] = {
    "kpi_summary": _on_orders(R.kpi_summary),
    "monthly_trend": _on_orders(R.monthly_trend),
    "quarterly_breakdown": _on_orders(R.quarterly_breakdown),
    "category_ranking": _on_fact(R.category_ranking),
    "state_ranking": _on_orders(R.state_ranking),
    "rolling_revenue": _on_orders(R.rolling_revenue),
    "top_products": _on_fact(R.top_products, "products", "order_reviews"),
    "freight_leakage": _on_fact(R.freight_leakage),
    "seller_tiers": _on_fact(R.seller_tiers, "order_reviews"),
    "payment_mix": lambda spark, sf: R.payment_mix(open_warehouse(spark, sf).table("order_payments_aggregated")),
}

RETENTION_QUERIES: dict[str, Query] = {
    "retention_rate": _on_orders(T.retention_rate),
    "customer_clv": _on_orders(T.customer_clv),
    "clv_tiers": _on_orders(T.clv_tiers),
    "cohort_retention": _on_orders(T.cohort_retention),
    "churn_status": _on_orders(T.churn_status, "order_reviews", as_of=AS_OF),
    "churn_summary": _on_orders(T.churn_summary, as_of=AS_OF),
    "category_repeat_rate": _on_fact(T.category_repeat_rate),
    "rfm_segments": _on_orders(T.rfm_segments, as_of=AS_OF),
    "rfm_summary": _on_orders(T.rfm_summary, as_of=AS_OF),
    "review_vs_revenue": _on_fact(T.review_vs_revenue, "order_reviews"),
}


# ---- data-quality reports ------------------------------------------------


def pk_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Key violations of the loaded tables, all ten of them."""
    wh = open_warehouse(spark, sf)
    return K.pk_violations({t: (wh.table(t), keys) for t, keys in PRIMARY_KEYS.items()})


def raw_key_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """The same report over the raw input, which cleaning deduplicates."""
    wh = open_warehouse(spark, sf)
    raw = raw_tables(spark, sf, stage_dir=wh.path("_staging"), staged=True)
    return K.pk_violations({t: (raw[t], keys) for t, keys in PRIMARY_KEYS.items() if t in raw})


def fk_orphans(spark: SparkSession, sf: str) -> DataFrame:
    wh = open_warehouse(spark, sf)
    return K.fk_orphans([(c, wh.table(c), col, p, wh.table(p), pcol) for c, col, p, pcol in FOREIGN_KEYS])


def scale_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Overflows, measured over every row while the tables were written."""
    return K.violations_of(open_warehouse(spark, sf).checks(), "scale")


def length_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Texts that are too long, measured over every row while the tables were written."""
    return K.violations_of(open_warehouse(spark, sf).checks(), "length")


QUALITY_QUERIES: dict[str, Query] = {
    "pk_violations": pk_violations,
    "raw_key_duplicates": raw_key_duplicates,
    "fk_orphans": fk_orphans,
    "scale_violations": scale_violations,
    "length_violations": length_violations,
}



# ---- forecasts -------------------------------------------------------------



def _daily(spark: SparkSession, sf: str) -> DataFrame:
    wh = open_warehouse(spark, sf)
    return FC.daily_revenue(wh.table("fact_orders"), orders=wh.table("order_summary"))


def daily_revenue(spark: SparkSession, sf: str) -> DataFrame:
    return _daily(spark, sf).withColumn("y", F.col("y").cast("double"))


def _linear(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    daily = FC.with_min_history(_daily(spark, sf))
    return daily, FC.linear_trend(daily)


def linear_forecast(spark: SparkSession, sf: str) -> DataFrame:
    daily, fc = _linear(spark, sf)
    return FC.publishable(fc, daily)


def forecast_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return FC.monthly_rollup(_linear(spark, sf)[1])


def forecast_summary(spark: SparkSession, sf: str) -> DataFrame:
    daily, fc = _linear(spark, sf)
    return FC.summary(daily, FC.monthly_rollup(fc))


def holt_winters_forecast(spark: SparkSession, sf: str) -> DataFrame:
    daily = FC.with_min_history(_daily(spark, sf))
    return FC.publishable(FC.holt_winters(daily), daily)


def seasonal_forecast(spark: SparkSession, sf: str) -> DataFrame:
    daily = FC.with_min_history(_daily(spark, sf))
    return FC.publishable(FC.seasonal(daily), daily)


def revenue_forecast(spark: SparkSession, sf: str) -> DataFrame:
    daily = FC.with_min_history(_daily(spark, sf))
    return FC.publishable(FC.forecast(daily), daily)


def state_forecast(spark: SparkSession, sf: str) -> DataFrame:
    """The cascade run for every customer state at once (one series per state)."""
    wh = open_warehouse(spark, sf)
    daily = FC.with_min_history(FC.daily_revenue(wh.table("fact_orders"), "customer_state",
                                                 orders=wh.table("order_summary")))
    return FC.publishable(FC.forecast(daily), daily)


FORECAST_QUERIES: dict[str, Query] = {
    "daily_revenue": daily_revenue,
    "linear_forecast": linear_forecast,
    "forecast_monthly": forecast_monthly,
    "forecast_summary": forecast_summary,
    "holt_winters_fixed": lambda spark, sf: FC.holt_winters_fixed(FC.with_min_history(_daily(spark, sf))),
    "holt_winters_forecast": holt_winters_forecast,
    "seasonal_forecast": seasonal_forecast,
    "revenue_forecast": revenue_forecast,
    "state_forecast": state_forecast,
}



# ---- dashboard findings --------------------------------------------------------


INSIGHT_QUERIES: dict[str, Query] = {
    "yoy_growth": _on_orders(D.yoy_growth),
    "month_of_year": _on_orders(D.month_of_year),
    "state_concentration": _on_orders(D.state_concentration),
    "review_score_distribution": lambda spark, sf: D.review_score_distribution(
        open_warehouse(spark, sf).table("order_reviews")),
    "negative_review_heatmap": _on_fact(D.negative_review_heatmap, "order_reviews"),
    "late_delivery_reviews": _on_orders(D.late_delivery_reviews, "order_reviews"),
    "delivery_review_correlation": _on_orders(D.delivery_review_correlation, "order_reviews"),
    "reorder_by_sentiment": _on_orders(D.reorder_by_sentiment, "order_reviews"),
    "churn_by_state": _on_orders(D.churn_by_state, as_of=AS_OF),
    "installment_buckets": lambda spark, sf: D.installment_buckets(
        open_warehouse(spark, sf).table("order_payments_aggregated")),
}


def all_queries() -> dict[str, Query]:
    return {**CLEAN_QUERIES, **QUALITY_QUERIES, **REVENUE_QUERIES, **RETENTION_QUERIES,
            **FORECAST_QUERIES, **INSIGHT_QUERIES}
