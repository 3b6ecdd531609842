"""Dashboard marts M1-M8: small aggregates over completed transactions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions.numbers import mean, mean_days, months_apart, per, rate_percent, rounded, share_percent, total
from mercato.functions.order_stats import quantiles
from mercato.market import Market
from mercato.operators.rfm import ntile_scored

def _orders() -> Column:
    """The fact table has one row per order, so no DISTINCT is needed."""
    return F.count(F.lit(1))


def _order_value() -> Column:
    return rounded(per(F.sum("order_items_value"), _orders()), 2)


def _score() -> Column:
    return rounded(mean(F.col("average_review_score")), 2)


def _delayed() -> Column:
    return rounded(rate_percent(F.col("is_delayed")), 2)


def _delivery_days() -> Column:
    return rounded(mean_days(F.col("delivery_time_days")), 2)


def executive_metrics(m: Market) -> DataFrame:
    return m.delivered.agg(
        total(F.col("order_items_value")).alias("gmv"),
        _orders().alias("delivered_orders"),
        F.count_distinct("customer_unique_id").alias("unique_customers"),
        _order_value().alias("average_order_value"),
        _score().alias("average_review_score"),
        _delayed().alias("delayed_order_rate_percent"),
        _delivery_days().alias("average_delivery_time_days"),
    )


def monthly_metrics(m: Market) -> DataFrame:
    return (
        m.delivered.groupBy(F.col("order_month").alias("month"))
        .agg(
            total(F.col("order_items_value")).alias("gmv"),
            _orders().alias("delivered_orders"),
            F.count_distinct("customer_unique_id").alias("active_customers"),
            _order_value().alias("average_order_value"),
            _score().alias("average_review_score"),
            _delayed().alias("delayed_order_rate_percent"),
            _delivery_days().alias("average_delivery_time_days"),
        )
        .orderBy("month")
    )


def delivery_metrics(m: Market) -> DataFrame:
    """Month by delay flag; orders without a delivery date keep their own NULL group, listed last.

    An order without a review counts as not low here.
    """
    orders = m.delivered.withColumnRenamed("order_month", "month")
    keys = ["month", "is_delayed"]
    groups = orders.groupBy(*keys).agg(
        _orders().alias("delivered_orders"),
        _delivery_days().alias("average_delivery_time_days"),
        rounded(mean_days(F.col("delivery_delay_days")), 2).alias("average_delivery_delay_days"),
        _score().alias("average_review_score"),
        rounded(share_percent(F.col("average_review_score") <= 2), 2).alias("low_review_rate_percent"),
    )
    # a NULL flag means no delivery time at all, so a plain left join leaves its median NULL
    middle = quantiles(orders, keys, "delivery_time_days", {"median": 0.5})
    return (
        groups.join(middle, keys, "left")
        .select(
            *groups.columns[:4],
            rounded(F.col("median"), 2).alias("median_delivery_time_days"),
            *groups.columns[4:],
        )
        .orderBy("month", F.asc_nulls_last("is_delayed"))
    )


def category_metrics(m: Market) -> DataFrame:
    """Category totals; the averages weigh every (order, category) pair alike."""
    price, freight = F.col("price"), F.col("freight_value")
    # items of other orders go before anything is summed; one sum, by category, holds a task's groups once
    completed = m.raw("orders").where("order_status = 'delivered'").select("order_id")
    sold = m.rows("order_items").join(completed, "order_id", "left_semi")
    category = m.products.select("product_id", F.col("product_category_name_english").alias("product_category"))
    baskets = (
        sold.join(category, "product_id")
        .groupBy("order_id", "product_category")
        .agg(F.count(F.lit(1)).alias("items"), F.sum(price).alias("price"), F.sum(freight).alias("freight"))
    )
    scores = m.delivered.select("order_id", "average_review_score")
    exact = "decimal(24,9)"
    return (
        baskets.join(scores, "order_id")
        .groupBy("product_category")
        .agg(
            _orders().alias("delivered_orders"),
            F.sum("items").alias("items_sold"),
            total(F.col("price")).alias("products_value"),
            total(F.col("freight")).alias("freight_value"),
            rounded(mean(per(F.col("price"), F.col("items")).cast(exact)), 2).alias("average_item_price"),
            rounded(mean(per(F.col("freight"), F.col("items")).cast(exact)), 2).alias("average_freight_value"),
            _score().alias("average_review_score"),
        )
        .orderBy(F.desc("products_value"), "product_category")
    )


def state_metrics(m: Market) -> DataFrame:
    return (
        m.delivered.groupBy("customer_state")
        .agg(
            _orders().alias("delivered_orders"),
            F.count_distinct("customer_unique_id").alias("unique_customers"),
            total(F.col("order_items_value")).alias("gmv"),
            _order_value().alias("average_order_value"),
            _delivery_days().alias("average_delivery_time_days"),
            _delayed().alias("delayed_order_rate_percent"),
            _score().alias("average_review_score"),
        )
        .orderBy(F.desc("gmv"), "customer_state")
    )


def customer_months(orders: DataFrame) -> DataFrame:
    """Customer by month activity with the customer's first month.

    Orders are reduced to one row per customer and month first, so the window over a customer
    holds at most one row per calendar month, however many orders that customer has.
    """
    activity = (
        orders.where(F.col("customer_unique_id").isNotNull())
        .groupBy("customer_unique_id", F.col("order_month").alias("month"))
        .agg(_orders().alias("orders"), F.sum("order_items_value").alias("value"))
    )
    return activity.withColumn("first_month", F.min("month").over(Window.partitionBy("customer_unique_id")))


def customer_metrics(m: Market) -> DataFrame:
    customers = F.count(F.lit(1))
    returning = F.count_if(F.col("month") > F.col("first_month"))
    return (
        customer_months(m.delivered)
        .groupBy("month")
        .agg(
            customers.alias("active_customers"),
            F.count_if(F.col("month") == F.col("first_month")).alias("new_customers"),
            returning.alias("repeat_customers"),
            rounded(per(returning, customers) * 100, 2).alias("repeat_customer_share_percent"),
            F.sum("orders").alias("delivered_orders"),
            total(F.col("value")).alias("gmv"),
            rounded(per(F.sum("orders"), customers), 3).alias("orders_per_active_customer"),
        )
        .orderBy("month")
    )


def cohort_retention(m: Market) -> DataFrame:
    """Long cohort table; a cohort's size is its own index-0 count, taken from the reduced rows."""
    whole_cohort = Window.partitionBy("cohort_month")
    return (
        customer_months(m.delivered)
        .groupBy(
            F.col("first_month").alias("cohort_month"),
            months_apart(F.col("month"), F.col("first_month")).alias("cohort_index"),
        )
        .agg(F.count(F.lit(1)).alias("active_customers"))
        .withColumn(
            "cohort_size", F.max(F.when(F.col("cohort_index") == 0, F.col("active_customers"))).over(whole_cohort)
        )
        .withColumn(
            "retention_rate_percent", rounded(per(F.col("active_customers"), F.col("cohort_size")) * 100, 3)
        )
        .orderBy("cohort_month", "cohort_index")
    )


def rfm_segments(m: Market) -> DataFrame:
    everyone = Window.partitionBy()  # over at most seven segment rows
    customers, money = F.col("customers_count"), F.col("money")
    return (
        ntile_scored(m)
        .groupBy(F.col("segment").alias("rfm_segment"))
        .agg(
            F.count(F.lit(1)).alias("customers_count"),
            F.sum("monetary").alias("money"),
            rounded(mean(F.col("recency")), 2).alias("average_recency_days"),
            rounded(mean(F.col("frequency")), 3).alias("average_frequency"),
            rounded(mean(F.col("monetary")), 2).alias("average_monetary_value"),
        )
        .select(
            "rfm_segment",
            "customers_count",
            rounded(per(customers, F.sum(customers).over(everyone)) * 100, 2).alias("customer_share_percent"),
            money.cast("double").alias("monetary_value"),
            rounded(per(money, F.sum(money).over(everyone)) * 100, 2).alias("monetary_share_percent"),
            "average_recency_days",
            "average_frequency",
            "average_monetary_value",
        )
        .orderBy(F.desc_nulls_last("monetary_value"), "rfm_segment")
    )


MARTS: dict[str, Callable[[Market], DataFrame]] = {
    "executive_metrics": executive_metrics,
    "monthly_metrics": monthly_metrics,
    "delivery_metrics": delivery_metrics,
    "category_metrics": category_metrics,
    "state_metrics": state_metrics,
    "customer_metrics": customer_metrics,
    "cohort_retention": cohort_retention,
    "rfm_segments": rfm_segments,
}
