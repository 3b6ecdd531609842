"""Dashboard roll-ups M9: how the pages reduce the marts, with their top lists and low-volume cuts."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.market import Market
from mercato.operators import cohort, marts

TOP = 10


def _sum(*names: str) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def _avg(*names: str) -> list[Column]:
    return [F.avg(n).alias(n) for n in names]


RATES = ("average_order_value", "average_review_score", "delayed_order_rate_percent", "average_delivery_time_days")


def _since(df: DataFrame, column: str, start: date | None) -> DataFrame:
    return df if start is None else df.where(F.col(column) >= F.lit(start))


def executive_cards(m: Market) -> DataFrame:
    """Ready totals are shown by MAX, ready averages and rates by AVG."""
    totals = [F.max(n).alias(n) for n in ("gmv", "delivered_orders", "unique_customers")]
    return marts.executive_metrics(m).agg(*totals, *_avg(*RATES))


def monthly_rollup(m: Market, start: date | None = None) -> DataFrame:
    return _since(marts.monthly_metrics(m), "month", start).agg(*_sum("gmv", "delivered_orders"), *_avg(*RATES))


def customer_rollup(m: Market, start: date | None = None) -> DataFrame:
    return _since(marts.customer_metrics(m), "month", start).agg(
        *_sum("active_customers", "new_customers", "repeat_customers", "delivered_orders"),
        *_avg("repeat_customer_share_percent", "orders_per_active_customer"),
    )


def retention_by_index(m: Market) -> DataFrame:
    return (
        marts.cohort_retention(m)
        .groupBy("cohort_index")
        .agg(*_sum("active_customers"), *_avg("retention_rate_percent"))
        .orderBy("cohort_index")
    )


def segment_rollup(m: Market) -> DataFrame:
    return (
        marts.rfm_segments(m)
        .groupBy("rfm_segment")
        .agg(
            *_sum("customers_count", "monetary_value"),
            *_avg("average_recency_days", "average_frequency", "average_monetary_value"),
        )
        .orderBy(F.desc("monetary_value"))
    )


def delivery_by_status(m: Market, start: date | None = None) -> DataFrame:
    """On-time against delayed; orders without a delivery date carry no status and stay out."""
    status = F.when(F.col("is_delayed"), "Delayed").otherwise("On Time")
    return (
        _since(marts.delivery_metrics(m), "month", start)
        .where("is_delayed IS NOT NULL")
        .groupBy(status.alias("delivery_status"))
        .agg(
            *_sum("delivered_orders"),
            *_avg("average_delivery_time_days", "average_review_score", "low_review_rate_percent"),
        )
        .orderBy("delivery_status")
    )


def _top(df: DataFrame, measure: str, label: str, size: int, at_least: int = 0) -> DataFrame:
    kept = df.where(F.col("delivered_orders") >= at_least) if at_least else df
    return kept.select(label, "delivered_orders", *({measure} - {"delivered_orders"})).orderBy(
        F.desc_nulls_last(measure), label
    ).limit(size)


def top_categories(m: Market, measure: str, size: int = TOP, at_least: int = 0) -> DataFrame:
    return _top(marts.category_metrics(m), measure, "product_category", size, at_least)


def top_states(m: Market, measure: str, size: int = TOP, at_least: int = 0) -> DataFrame:
    return _top(marts.state_metrics(m), measure, "customer_state", size, at_least)


def since(m: Market) -> date:
    """First complete month of the data."""
    return cohort.complete_months(m)[0]


MIN_ORDERS = 100

PAGES: dict[str, Callable[[Market], DataFrame]] = {
    "m9_executive_cards": executive_cards,
    "m9_monthly_rollup": lambda m: monthly_rollup(m, since(m)),
    "m9_customer_rollup": lambda m: customer_rollup(m, since(m)),
    "m9_retention_by_index": retention_by_index,
    "m9_segment_rollup": segment_rollup,
    "m9_delivery_by_status": lambda m: delivery_by_status(m, since(m)),
    "m9_top_categories_by_sales": lambda m: top_categories(m, "products_value"),
    "m9_top_categories_by_orders": lambda m: top_categories(m, "delivered_orders"),
    "m9_top_rated_categories": lambda m: top_categories(m, "average_review_score", at_least=MIN_ORDERS),
    "m9_top_states_by_gmv": lambda m: top_states(m, "gmv"),
    "m9_most_delayed_states": lambda m: top_states(m, "delayed_order_rate_percent", at_least=MIN_ORDERS),
    "m9_slowest_states": lambda m: top_states(m, "average_delivery_time_days", at_least=MIN_ORDERS),
}
