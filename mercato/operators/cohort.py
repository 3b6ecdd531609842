"""Cohort frames C1-C6: activity, sizes, retention matrix, horizons and their summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions.numbers import months_apart, per
from mercato.functions.profile import all_labels
from mercato.market import Market
from mercato.operators.marts import customer_months
from mercato.operators.product import Months, within_months

HORIZONS = (1, 3, 6)


def customer_activity(m: Market) -> DataFrame:
    """One row per customer and active month, with cohort month and index."""
    months = customer_months(m.delivered.where("order_items_value IS NOT NULL"))
    return months.select(
        "customer_unique_id",
        F.col("month").alias("order_month"),
        F.col("first_month").alias("cohort_month"),
        months_apart(F.col("month"), F.col("first_month")).alias("cohort_index"),
    )


def cohort_sizes(m: Market, months: Months | None = None) -> DataFrame:
    sizes = (
        customer_activity(m)
        .where("cohort_index = 0")
        .groupBy("cohort_month")
        .agg(F.count(F.lit(1)).alias("customers_count"))
    )
    return within_months(sizes, "cohort_month", months).orderBy("cohort_month")


def cohort_counts(m: Market) -> DataFrame:
    return (
        customer_activity(m)
        .groupBy("cohort_month", "cohort_index")
        .agg(F.count(F.lit(1)).alias("customers_count"))
        .orderBy("cohort_month", "cohort_index")
    )


def _rates(m: Market, months: Months | None) -> DataFrame:
    whole = Window.partitionBy("cohort_month")
    size = F.max(F.when(F.col("cohort_index") == 0, F.col("customers_count"))).over(whole)
    rates = cohort_counts(m).withColumn("rate", per(F.col("customers_count"), size))
    return within_months(rates, "cohort_month", months)


def _matrix(m: Market, months: Months | None, indexes: Sequence[int], value: str) -> DataFrame:
    # the pivot list is explicit, so no job runs to discover it
    return _rates(m, months).groupBy("cohort_month").pivot("cohort_index", list(indexes)).agg(F.first(value))


def complete_months(m: Market) -> Months:
    """First and last month between the months of the first and the last purchase, which are partial: scalar
    subqueries, so nothing runs until the plan they are put into does."""
    bought = F.trunc("order_purchase_timestamp", "month")
    ends = m.raw("orders").agg(F.add_months(F.min(bought), 1).alias("first"), F.add_months(F.max(bought), -1).alias("last"))
    return ends.select("first").scalar(), ends.select("last").scalar()


def last_index(m: Market) -> int:
    """Largest possible cohort index: months between first and last completed purchase. It decides how many columns the
    matrix has, so this one number is read when the matrix is built."""
    span = m.raw("orders").where("order_status = 'delivered'").agg(
        F.min("order_purchase_timestamp").alias("first"), F.max("order_purchase_timestamp").alias("last")
    )
    row = span.select(months_apart(F.col("last"), F.col("first")).alias("n")).first()
    return int(row["n"] or 0)


def retention_counts(m: Market, months: Months | None = None, last: int | None = None) -> DataFrame:
    """Cohort by index matrix of customer counts, NULL where nothing was observed."""
    last = last_index(m) if last is None else last
    return _matrix(m, months, range(last + 1), "customers_count").orderBy("cohort_month")


def retention_matrix(m: Market, months: Months | None = None, last: int | None = None) -> DataFrame:
    """The same matrix divided by index 0, rows labelled year-month."""
    last = last_index(m) if last is None else last
    wide = _matrix(m, months, range(last + 1), "rate")
    return wide.withColumn("cohort_month", F.date_format("cohort_month", "yyyy-MM")).orderBy("cohort_month")


def horizon_comparison(m: Market, months: Months | None = None, horizons: Sequence[int] = HORIZONS) -> DataFrame:
    wide = _matrix(m, months, horizons, "rate")
    return wide.select("cohort_month", *[F.col(str(h)).alias(f"month_{h}_retention") for h in horizons]).orderBy(
        "cohort_month"
    )


def horizon_long(m: Market, months: Months | None = None, horizons: Sequence[int] = HORIZONS) -> DataFrame:
    names = [f"month_{h}_retention" for h in horizons]
    label = F.initcap(F.replace(F.replace("period", F.lit("_retention"), F.lit("")), F.lit("_"), F.lit(" ")))
    return (
        horizon_comparison(m, months, horizons)
        .unpivot(["cohort_month"], names, "period", "retention_rate")
        .where("retention_rate IS NOT NULL")
        .select(
            "cohort_month",
            label.alias("retention_period"),
            "retention_rate",
            (F.col("retention_rate") * 100).alias("retention_percent"),
        )
    )


def retention_summary(m: Market, months: Months | None = None, horizons: Sequence[int] = HORIZONS) -> DataFrame:
    """Mean, median and number of cohorts per horizon; unobserved horizons keep a row."""
    long = horizon_long(m, months, horizons)
    # one rate per month and horizon: the exact percentile holds no more values than there are months
    table = long.groupBy("retention_period").agg(
        (F.avg("retention_rate") * 100).alias("average_retention_percent"),
        (F.percentile("retention_rate", F.lit(0.5)) * 100).alias("median_retention_percent"),
        F.count(F.lit(1)).alias("cohorts_count"),
    )
    full = all_labels(table, [f"Month {h}" for h in horizons], "retention_period", ["cohorts_count"])
    return full.drop("bin_order")
