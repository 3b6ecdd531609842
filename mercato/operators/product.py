"""Product metrics P1-P8 over completed orders with a known value, and the month window."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions.numbers import mean, per, rounded, total
from mercato.functions.profile import all_labels, bin_labels, count_bins, describe, with_share
from mercato.market import Market

UPPER_PERCENTILES = (0.5, 0.75, 0.9, 0.95, 0.99)
Months = tuple[date | Column, date | Column]  # first and last; a column holds one value for all rows


def _valued(m: Market) -> DataFrame:
    return m.delivered.where("order_items_value IS NOT NULL")


def within_months(df: DataFrame, column: str, months: Months | None) -> DataFrame:
    """Cut incomplete boundary months; both ends are inclusive and the cut follows the aggregation."""
    return df if months is None else df.where(F.col(column).between(*[F.lit(m) for m in months]))


def _metrics() -> list[Column]:
    value, items = F.col("order_items_value"), F.col("items_count")
    return [
        F.count(F.lit(1)).alias("orders_count"),
        F.count_distinct("customer_unique_id").alias("customers_count"),
        total(value).alias("gmv"),
        rounded(mean(value), 2).alias("average_order_value"),
        rounded(mean(items), 2).alias("average_items_per_order"),
    ]


def overall_metrics(m: Market) -> DataFrame:
    """Overall figures plus the average order value recomputed from its parts."""
    return _valued(m).agg(*_metrics()).withColumn("calculated_aov", per(F.col("gmv"), F.col("orders_count")))


def monthly_product_metrics(m: Market, months: Months | None = None) -> DataFrame:
    table = _valued(m).groupBy("order_month").agg(*_metrics())
    return within_months(table, "order_month", months).orderBy("order_month")


def customer_orders(m: Market) -> DataFrame:
    return (
        _valued(m)
        .groupBy("customer_unique_id")
        .agg(F.count(F.lit(1)).alias("orders_count"), total(F.col("order_items_value")).alias("customer_gmv"))
    )


def customer_orders_describe(m: Market) -> DataFrame:
    return describe(customer_orders(m), ["orders_count"], UPPER_PERCENTILES)


def repeat_customer_share(m: Market) -> DataFrame:
    repeat = F.count_if(F.col("orders_count") > 1)
    known = customer_orders(m).where("customer_unique_id IS NOT NULL")
    return known.agg(
        F.count(F.lit(1)).alias("customers_count"),
        repeat.alias("repeat_customers_count"),
        (per(repeat, F.count(F.lit(1))) * 100).alias("repeat_customers_share_percent"),
    )


def order_frequency_groups(m: Market) -> DataFrame:
    grouped = (
        customer_orders(m)
        .groupBy(count_bins(F.col("orders_count"), 5, "order", "orders").alias("order_frequency_group"))
        .agg(F.count("customer_unique_id").alias("customers_count"))
    )
    full = all_labels(grouped, bin_labels(5, "order", "orders"), "order_frequency_group", ["customers_count"])
    return with_share(full, "customers_count", "customers_share_percent")


def monthly_customers(m: Market, months: Months | None = None) -> DataFrame:
    table = _valued(m).groupBy("order_month").agg(F.count_distinct("customer_unique_id").alias("customers_count"))
    return within_months(table, "order_month", months).orderBy("order_month")


def customer_types(m: Market, months: Months | None = None) -> DataFrame:
    """New and repeat customers per month, long form."""
    from mercato.operators.marts import customer_months

    kind = F.when(F.col("month") == F.col("first_month"), "New").otherwise("Repeat")
    table = (
        customer_months(_valued(m))
        .groupBy(F.col("month").alias("order_month"), kind.alias("customer_type"))
        .agg(F.count(F.lit(1)).alias("customers_count"))
    )
    return within_months(table, "order_month", months).orderBy("order_month", "customer_type")


def repeat_share_by_month(m: Market, months: Months | None = None) -> DataFrame:
    wide = (
        customer_types(m, months)
        .groupBy("order_month")
        .pivot("customer_type", ["New", "Repeat"])
        .agg(F.sum("customers_count"))
        .na.fill(0)
    )
    everyone = F.col("New") + F.col("Repeat")
    return (
        wide.withColumn("total_customers", everyone)
        .withColumn("repeat_share_percent", per(F.col("Repeat"), everyone) * 100)
        .orderBy("order_month")
    )


def items_per_order_by_month(m: Market, months: Months | None = None) -> DataFrame:
    return monthly_product_metrics(m, months).select("order_month", "average_items_per_order")
