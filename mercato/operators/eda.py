"""Exploratory queries E1-E16: coverage, statuses, gaps, value and time profiles, reviews, categories, states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions.numbers import mean, mean_days, per, rounded, share_percent, total
from mercato.functions.order_stats import quantiles
from mercato.functions.profile import describe, histogram, trimmed, with_share
from mercato.market import Market

VALUE_COLUMNS = ["products_value", "freight_value", "order_items_value", "payment_value", "items_count"]
FULL_PERCENTILES = (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
UPPER_PERCENTILES = (0.5, 0.75, 0.9, 0.95, 0.99)
MIN_STATE_ORDERS = 100


def _rows() -> Column:
    return F.count(F.lit(1))


def _arrived(m: Market) -> DataFrame:
    """Completed orders with a delivery date."""
    return m.order_metrics.where("order_status = 'delivered' AND delivery_time_days IS NOT NULL")


def _valued(m: Market) -> DataFrame:
    return m.delivered.where("order_items_value IS NOT NULL")


def time_coverage(m: Market) -> DataFrame:
    bought = "order_purchase_timestamp"
    return m.order_metrics.agg(
        F.min(bought).alias("min_order_date"), F.max(bought).alias("max_order_date"), _rows().alias("orders_count")
    )


def orders_per_month(m: Market) -> DataFrame:
    return m.order_metrics.groupBy("order_month").agg(_rows().alias("orders_count")).orderBy("order_month")


def boundary_months(m: Market, size: int = 5) -> DataFrame:
    """The first and the last months, which may be incomplete."""
    months = orders_per_month(m)
    first = months.limit(size).withColumn("edge", F.lit("first"))
    last = months.orderBy(F.desc("order_month")).limit(size).withColumn("edge", F.lit("last"))
    return first.unionByName(last).orderBy("edge", "order_month")


def status_shares(m: Market) -> DataFrame:
    everything = Window.partitionBy()
    return (
        m.order_metrics.groupBy("order_status")
        .agg(_rows().alias("orders_count"))
        .withColumn(
            "share_percent",
            rounded(per(F.col("orders_count") * 100, F.sum("orders_count").over(everything)), 2),
        )
        .orderBy(F.desc("orders_count"), "order_status")
    )


def status_by_year(m: Market) -> DataFrame:
    return (
        m.order_metrics.groupBy(F.year("order_purchase_timestamp").alias("order_year"), "order_status")
        .agg(_rows().alias("orders_count"))
        .orderBy("order_year", F.desc("orders_count"), "order_status")
    )


def value_by_status(m: Market) -> DataFrame:
    return (
        m.order_metrics.groupBy("order_status")
        .agg(
            _rows().alias("orders_count"),
            total(F.col("order_items_value")).alias("total_order_value"),
            rounded(mean(F.col("order_items_value")), 2).alias("average_order_value"),
        )
        .orderBy(F.desc_nulls_last("total_order_value"), "order_status")
    )


def _gaps(frame: DataFrame) -> list[Column]:
    missing = {
        "missing_approved_at": "order_approved_at",
        "missing_carrier_date": "order_delivered_carrier_date",
        "missing_customer_date": "order_delivered_customer_date",
        "missing_payment_value": "payment_value",
        "missing_review_score": "average_review_score",
    }
    return [F.count_if(F.col(c).isNull()).alias(name) for name, c in missing.items() if c in frame.columns]


def missing_summary(m: Market) -> DataFrame:
    """Gaps of two views side by side, turned to one row per variable with a readable label."""
    orders, facts = m.orders_core, m.order_metrics
    dates = orders.agg(_rows().alias("total_orders"), *_gaps(orders))
    related = facts.agg(*_gaps(facts))
    names = dates.columns[1:] + related.columns
    both = dates.withColumns({c: related.select(c).scalar() for c in related.columns})
    long = both.unpivot(["total_orders"], names, "variable", "missing_count")
    return long.select(
        "variable",
        F.initcap(F.replace(F.replace("variable", F.lit("missing_"), F.lit("")), F.lit("_"), F.lit(" "))).alias("label"),
        "missing_count",
        (per(F.col("missing_count"), F.col("total_orders")) * 100).alias("missing_share_percent"),
    )


def missing_by_status(m: Market) -> DataFrame:
    extra = m.order_metrics.select("order_id", "payment_value", "average_review_score")
    both = m.orders_core.join(extra, "order_id")
    return (
        both.groupBy("order_status")
        .agg(_rows().alias("orders_count"), *_gaps(both))
        .orderBy(F.desc("orders_count"), "order_status")
    )


def order_value_describe(m: Market) -> DataFrame:
    return describe(_valued(m), VALUE_COLUMNS, FULL_PERCENTILES)


def largest_orders(m: Market, size: int = 10) -> DataFrame:
    return (
        _valued(m).select("order_id", *VALUE_COLUMNS).orderBy(F.desc("order_items_value"), "order_id").limit(size)
    )


def order_value_limit(m: Market) -> DataFrame:
    return quantiles(_valued(m), (), "order_items_value", {"p99": 0.99})


def order_value_histogram(m: Market) -> DataFrame:
    return histogram(trimmed(_valued(m), ["order_items_value"]), "order_items_value")


def delivery_summary(m: Market) -> DataFrame:
    days = quantiles(_arrived(m), (), "delivery_time_days", {"median": 0.5, "p90": 0.9})
    late = F.count_if(F.col("is_delayed"))
    return _arrived(m).agg(
        _rows().alias("delivered_orders"),
        rounded(mean_days(F.col("delivery_time_days")), 2).alias("average_delivery_days"),
        late.alias("delayed_orders"),
        rounded(per(late * 100, _rows()), 2).alias("delayed_share_percent"),
    ).select(
        "delivered_orders",
        "average_delivery_days",
        rounded(days.select("median").scalar(), 2).alias("median_delivery_days"),
        rounded(days.select("p90").scalar(), 2).alias("delivery_days_90_percentile"),
        "delayed_orders",
        "delayed_share_percent",
    )


def delivery_time_describe(m: Market) -> DataFrame:
    return describe(_arrived(m), ["delivery_time_days"], UPPER_PERCENTILES)


def slowest_deliveries(m: Market, size: int = 10) -> DataFrame:
    return (
        _arrived(m)
        .select("order_id", "delivery_time_days", "is_delayed")
        .orderBy(F.desc("delivery_time_days"), "order_id")
        .limit(size)
    )


def delivery_time_histogram(m: Market) -> DataFrame:
    return histogram(trimmed(_arrived(m), ["delivery_time_days"]), "delivery_time_days")


def delays_by_state(m: Market, at_least: int = MIN_STATE_ORDERS) -> DataFrame:
    orders = _arrived(m).where("customer_state IS NOT NULL")
    groups = (
        orders.groupBy("customer_state")
        .agg(
            _rows().alias("delivered_orders"),
            rounded(mean_days(F.col("delivery_time_days")), 2).alias("average_delivery_days"),
            rounded(share_percent(F.col("is_delayed")), 2).alias("delayed_share_percent"),
        )
        .where(F.col("delivered_orders") >= at_least)
    )
    middle = quantiles(orders, ["customer_state"], "delivery_time_days", {"median": 0.5})
    return (
        groups.join(middle, "customer_state")
        .withColumn("median_delivery_days", rounded(F.col("median"), 2))
        .drop("median")
        .orderBy(F.desc("delayed_share_percent"), "customer_state")
    )


def most_delayed_states(m: Market, size: int = 10, at_least: int = MIN_STATE_ORDERS) -> DataFrame:
    """The worst states, listed from the bottom up."""
    worst = delays_by_state(m, at_least).limit(size)
    return worst.orderBy("delayed_share_percent", F.desc("customer_state"))


def _reviews_of_completed(m: Market) -> DataFrame:
    """Single reviews of completed orders as (order columns, score, n).

    Reviews are first reduced to one row per order and score, so no order multiplies the join.
    """
    scores = m.rows("reviews").groupBy("order_id", "review_score").agg(F.count(F.lit(1)).alias("n"))
    return scores.join(m.delivered.select("order_id", "is_delayed"), "order_id")


def review_distribution(m: Market) -> DataFrame:
    everything = Window.partitionBy()
    return (
        _reviews_of_completed(m)
        .groupBy("review_score")
        .agg(F.sum("n").alias("reviews_count"))
        .withColumn(
            "share_percent",
            rounded(per(F.col("reviews_count") * 100, F.sum("reviews_count").over(everything)), 2),
        )
        .orderBy("review_score")
    )


def review_summary(m: Market) -> DataFrame:
    """Mean, median and number of single reviews; the median walks the at most five score counts."""
    counts = _reviews_of_completed(m).groupBy("review_score").agg(F.sum("n").alias("n"))
    ascending = Window.partitionBy().orderBy("review_score")
    placed = counts.withColumn("upto", F.sum("n").over(ascending)).withColumn(
        "size", F.sum("n").over(Window.partitionBy())
    )
    score, size = F.col("review_score"), F.col("size")

    def at(position: Column) -> Column:
        return F.min(F.when(F.col("upto") > position, score))

    return placed.agg(
        rounded(per(F.sum(score * F.col("n")), F.sum("n")), 2).alias("average_review_score"),
        ((at(F.floor((size - 1) / 2)) + at(F.ceil((size - 1) / 2))) / 2).alias("median_review_score"),
        F.sum("n").alias("reviews_count"),
    )


def reviews_by_delay(m: Market) -> DataFrame:
    n, score = F.col("n"), F.col("review_score")
    return (
        _reviews_of_completed(m)
        .where("is_delayed IS NOT NULL")
        .groupBy("is_delayed")
        .agg(
            F.sum(n).alias("reviewed_orders"),
            rounded(per(F.sum(score * n), F.sum(n)), 2).alias("average_review_score"),
            rounded(per(F.sum(F.when(score <= 2, n).otherwise(0)) * 100, F.sum(n)), 2).alias("low_score_share_percent"),
        )
        .withColumn("delivery_status", F.when(F.col("is_delayed"), "Delayed").otherwise("On Time"))
        .orderBy("is_delayed")
    )


def category_performance(m: Market, size: int | None = None) -> DataFrame:
    """Item-weighted category totals of completed orders, optionally only the largest ones."""
    completed = m.raw("orders").where("order_status = 'delivered'").select("order_id")
    sold = m.rows("order_items").join(completed, "order_id", "left_semi")
    category = m.products.select("product_id", "product_category_name_english")
    # one sum, by category, holds a task's groups once
    baskets = (
        sold.join(category, "product_id")
        .groupBy("order_id", "product_category_name_english")
        .agg(F.count(F.lit(1)).alias("items"), F.sum("price").alias("price"))
    )
    table = (
        baskets.groupBy("product_category_name_english")
        .agg(
            F.sum("items").alias("order_items_count"),
            _rows().alias("orders_count"),
            total(F.col("price")).alias("products_value"),
            rounded(per(F.sum("price"), F.sum("items")), 2).alias("average_item_price"),
        )
        .orderBy(F.desc("products_value"), "product_category_name_english")
    )
    return table if size is None else table.limit(size)


def orders_by_state(m: Market, size: int | None = None) -> DataFrame:
    """Orders per state with the share of all states; ``size`` keeps the largest, smallest first."""
    states = (
        _valued(m)
        .where("customer_state IS NOT NULL")
        .groupBy("customer_state")
        .agg(
            _rows().alias("orders_count"),
            total(F.col("order_items_value")).alias("total_order_value"),
            rounded(mean(F.col("order_items_value")), 2).alias("average_order_value"),
        )
    )
    table = with_share(states, "orders_count", "orders_share_percent").orderBy(F.desc("orders_count"), "customer_state")
    return table if size is None else table.limit(size).orderBy("orders_count", F.desc("customer_state"))
