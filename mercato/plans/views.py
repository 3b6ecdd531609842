"""The analytics layer: five views at product, ZIP, order, item and order-fact grain."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions.numbers import days_between, hours_between, month_of, per, rounded
from mercato.functions.order_stats import quantiles
from mercato.functions.profile import melted

if TYPE_CHECKING:
    from mercato.market import Market

# The label of a product without a translated category, and the corrected spellings.
UNKNOWN_CATEGORY = "unknown"
PRODUCT_RENAMES = {
    "product_name_lenght": "product_name_length",
    "product_description_lenght": "product_description_length",
}


def products(m: Market) -> DataFrame:
    """Products with a clean category and its English name.

    The lookup uses the category as stored; only the displayed name is trimmed.
    """
    items = m.raw("products").join(m.raw("category_translation"), "product_category_name", "left")
    clean = F.trim("product_category_name")
    english = F.coalesce("product_category_name_english", F.lit(UNKNOWN_CATEGORY))
    return items.select(
        "product_id",
        F.nullif(clean, F.lit("")).alias("product_category_name"),
        english.alias("product_category_name_english"),
        *[F.col(old).alias(new) for old, new in PRODUCT_RENAMES.items()],
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )


def geolocation(m: Market) -> DataFrame:
    """One row per ZIP prefix: median coordinates and the most frequent place, ties alphabetic."""
    points = m.raw("geolocation").withColumnRenamed("geolocation_zip_code_prefix", "zip_code_prefix")
    place_counts = points.groupBy(
        "zip_code_prefix", F.col("geolocation_city").alias("city"), F.col("geolocation_state").alias("state")
    ).agg((-F.count(F.lit(1))).alias("rarity"))
    places = place_counts.groupBy("zip_code_prefix").agg(F.min(F.struct("rarity", "city", "state")).alias("top"))
    axes = {"geolocation_lat": "latitude", "geolocation_lng": "longitude"}
    medians = quantiles(
        melted(points, list(axes), ["zip_code_prefix"]),
        ["zip_code_prefix", "variable"],
        "value",
        {"median": 0.5},
        unit=1e-4,
    )
    centres = medians.groupBy("zip_code_prefix").agg(
        *[F.max(F.when(F.col("variable") == axis, F.col("median"))).alias(name) for axis, name in axes.items()]
    )
    return places.join(centres, "zip_code_prefix", "left").select(
        "zip_code_prefix", "latitude", "longitude", "top.city", "top.state"
    )


def orders_core(m: Market) -> DataFrame:
    """Orders with customer identity and durations, before any coordinates are looked up."""
    bought, approved = F.col("order_purchase_timestamp"), F.col("order_approved_at")
    handed, arrived = F.col("order_delivered_carrier_date"), F.col("order_delivered_customer_date")
    due = F.col("order_estimated_delivery_date")
    return (
        m.raw("orders")
        .join(m.raw("customers"), "customer_id")
        .withColumns(
            {
                "order_month": month_of(bought),
                "approval_time_hours": hours_between(approved, bought),
                "processing_time_days": days_between(handed, approved),
                "delivery_time_days": days_between(arrived, bought),
                "is_delayed": arrived > due,
                "delivery_delay_days": days_between(arrived, due),
            }
        )
    )


ORDER_COLUMNS = [
    "order_id",
    "customer_id",
    "customer_unique_id",
    "order_status",
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
    "order_month",
    "customer_zip_code_prefix",
    "customer_city",
    "customer_state",
    "customer_latitude",
    "customer_longitude",
    "approval_time_hours",
    "processing_time_days",
    "delivery_time_days",
    "is_delayed",
    "delivery_delay_days",
]


def _located(df: DataFrame, geo: DataFrame, who: str) -> DataFrame:
    spots = geo.select(
        F.col("zip_code_prefix").alias(f"{who}_zip_code_prefix"),
        F.col("latitude").alias(f"{who}_latitude"),
        F.col("longitude").alias(f"{who}_longitude"),
    )
    return df.join(spots, f"{who}_zip_code_prefix", "left")


def orders_enriched(m: Market) -> DataFrame:
    """Orders with customer identity, geography and durations; ``is_delayed`` is NULL until delivery."""
    return _located(m.orders_core, m.geolocation, "customer").select(*ORDER_COLUMNS)


def order_items_enriched(m: Market) -> DataFrame:
    """Items with product attributes and seller geography.

    Sellers are located before items meet them, so items travel by seller, never by the few ZIP prefixes.
    """
    items = m.raw("order_items").withColumn("item_total_value", F.col("price") + F.col("freight_value"))
    sellers = _located(m.raw("sellers"), m.geolocation, "seller")
    return items.join(m.products, "product_id").join(sellers, "seller_id").select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
        "item_total_value",
        *m.products.columns[1:],
        "seller_zip_code_prefix",
        "seller_city",
        "seller_state",
        "seller_latitude",
        "seller_longitude",
    )


def item_totals(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Item sums and distinct products and sellers per order of ``orders``, in one pass over the items.

    Items travel once, to their order: an order has few, so sums on the map side save nothing and only fill memory. The
    distinct counts need no further shuffle there: they count the first item of each product and seller. The join with the
    orders is what spreads a huge order: its partition is split as skewed, and the steps behind it are dealt out by
    order and product or seller. A count that nobody reads is dropped from the plan.
    """
    price, freight = F.col("price"), F.col("freight_value")
    placed = items.join(orders.select("order_id").hint("merge"), "order_id", "left_semi")

    def first_of(name: str) -> Column:
        number = F.row_number().over(Window.partitionBy("order_id", name).orderBy(name))
        return (F.col(name).isNotNull() & (number == 1)).cast("int")

    marked = placed.withColumn("_product", first_of("product_id")).withColumn("_seller", first_of("seller_id"))
    return marked.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("items_count"),
        F.sum(price).alias("products_value"),
        F.sum(freight).alias("freight_value"),
        F.sum(price + freight).alias("order_items_value"),
        F.sum("_product").alias("unique_products_count"),
        F.sum("_seller").alias("sellers_count"),
    )


def payment_totals(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("payments_count"),
        F.sum("payment_value").alias("payment_value"),
        F.max("payment_installments").alias("max_payment_installments"),
    )


def review_totals(reviews: DataFrame) -> DataFrame:
    """Reviews per order; the average is stored with two decimals before any threshold looks at it."""
    score = rounded(per(F.sum("review_score"), F.count("review_score")), 2)
    return reviews.groupBy("order_id").agg(
        score.cast("decimal(4,2)").alias("average_review_score"),
        F.count(F.lit(1)).alias("reviews_count"),
        F.bool_or(F.col("review_comment_title").isNotNull()).alias("has_review_title"),
        F.bool_or(F.col("review_comment_message").isNotNull()).alias("has_review_message"),
    )


def order_metrics(m: Market) -> DataFrame:
    """The order fact table: children are reduced to one row per order before they are joined.

    Absent children give zero counts and FALSE flags; money and score stay NULL.
    """
    facts = (
        m.orders_core
        .join(item_totals(m.rows("order_items"), m.raw("orders")), "order_id", "left")
        .join(payment_totals(m.rows("payments")), "order_id", "left")
        .join(review_totals(m.raw("reviews")), "order_id", "left")
    )

    def count_of(name: str) -> Column:
        return F.coalesce(name, F.lit(0)).alias(name)

    def flag(name: str) -> Column:
        return F.coalesce(name, F.lit(False)).alias(name)

    return facts.select(
        "order_id",
        "customer_id",
        "customer_unique_id",
        "order_status",
        "order_purchase_timestamp",
        "order_month",
        "customer_city",
        "customer_state",
        "delivery_time_days",
        "is_delayed",
        "delivery_delay_days",
        count_of("items_count"),
        count_of("unique_products_count"),
        count_of("sellers_count"),
        "products_value",
        "freight_value",
        "order_items_value",
        count_of("payments_count"),
        "payment_value",
        "max_payment_installments",
        "average_review_score",
        count_of("reviews_count"),
        flag("has_review_title"),
        flag("has_review_message"),
    )
