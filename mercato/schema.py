"""Raw-layer contract: ordered columns, types, keys and value rules.

Fixed values: names, order and types must equal the source files, including
the misspelt ``lenght`` columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TEXT = T.StringType()
INT = T.IntegerType()
MOMENT = T.TimestampNTZType()
MONEY = T.DecimalType(10, 2)
PAYMENT = T.DecimalType(12, 2)
DEGREES = T.DecimalType(10, 7)


@dataclass(frozen=True)
class TableSpec:
    columns: tuple[tuple[str, T.DataType, bool], ...]  # name, type, nullable
    key: tuple[str, ...] = ()
    parents: tuple[tuple[str, str], ...] = ()  # (column, parent table)
    rules: tuple[tuple[str, str], ...] = ()  # (rule name, violation predicate)
    free_text: bool = False  # quoted line breaks may occur

    @property
    def names(self) -> list[str]:
        return [name for name, _, _ in self.columns]

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in self.columns])

    @property
    def required(self) -> list[str]:
        return [name for name, _, nullable in self.columns if not nullable]


# Parents come before children, which is also the load order.
RAW_TABLES: dict[str, TableSpec] = {
    "category_translation": TableSpec(
        (("product_category_name", TEXT, False), ("product_category_name_english", TEXT, False)),
        key=("product_category_name",),
    ),
    "customers": TableSpec(
        (
            ("customer_id", TEXT, False),
            ("customer_unique_id", TEXT, False),
            ("customer_zip_code_prefix", INT, False),
            ("customer_city", TEXT, False),
            ("customer_state", TEXT, False),
        ),
        key=("customer_id",),
    ),
    "sellers": TableSpec(
        (
            ("seller_id", TEXT, False),
            ("seller_zip_code_prefix", INT, False),
            ("seller_city", TEXT, False),
            ("seller_state", TEXT, False),
        ),
        key=("seller_id",),
    ),
    "products": TableSpec(
        (
            ("product_id", TEXT, False),
            ("product_category_name", TEXT, True),
            ("product_name_lenght", INT, True),
            ("product_description_lenght", INT, True),
            ("product_photos_qty", INT, True),
            ("product_weight_g", INT, True),
            ("product_length_cm", INT, True),
            ("product_height_cm", INT, True),
            ("product_width_cm", INT, True),
        ),
        key=("product_id",),
    ),
    "orders": TableSpec(
        (
            ("order_id", TEXT, False),
            ("customer_id", TEXT, False),
            ("order_status", TEXT, False),
            ("order_purchase_timestamp", MOMENT, False),
            ("order_approved_at", MOMENT, True),
            ("order_delivered_carrier_date", MOMENT, True),
            ("order_delivered_customer_date", MOMENT, True),
            ("order_estimated_delivery_date", MOMENT, False),
        ),
        key=("order_id",),
        parents=(("customer_id", "customers"),),
    ),
    "order_items": TableSpec(
        (
            ("order_id", TEXT, False),
            ("order_item_id", INT, False),
            ("product_id", TEXT, False),
            ("seller_id", TEXT, False),
            ("shipping_limit_date", MOMENT, False),
            ("price", MONEY, False),
            ("freight_value", MONEY, False),
        ),
        key=("order_id", "order_item_id"),
        parents=(("order_id", "orders"), ("product_id", "products"), ("seller_id", "sellers")),
        rules=(("price_non_negative", "price < 0"), ("freight_non_negative", "freight_value < 0")),
    ),
    "payments": TableSpec(
        (
            ("order_id", TEXT, False),
            ("payment_sequential", INT, False),
            ("payment_type", TEXT, False),
            ("payment_installments", INT, False),
            ("payment_value", PAYMENT, False),
        ),
        key=("order_id", "payment_sequential"),
        parents=(("order_id", "orders"),),
        rules=(
            ("installments_non_negative", "payment_installments < 0"),
            ("payment_value_non_negative", "payment_value < 0"),
        ),
    ),
    "reviews": TableSpec(
        (
            ("review_id", TEXT, False),
            ("order_id", TEXT, False),
            ("review_score", INT, False),
            ("review_comment_title", TEXT, True),
            ("review_comment_message", TEXT, True),
            ("review_creation_date", MOMENT, False),
            ("review_answer_timestamp", MOMENT, False),
        ),
        key=("review_id", "order_id"),
        parents=(("order_id", "orders"),),
        rules=(("score_between_1_and_5", "review_score < 1 OR review_score > 5"),),
        free_text=True,
    ),
    "geolocation": TableSpec(
        (
            ("geolocation_zip_code_prefix", INT, False),
            ("geolocation_lat", DEGREES, False),
            ("geolocation_lng", DEGREES, False),
            ("geolocation_city", TEXT, False),
            ("geolocation_state", TEXT, False),
        ),
    ),
}
