"""Nine raw marketplace tables derived from a star schema (orders, lineitem, customer, ...).

Every column is a deterministic function of the star's columns; late orders get lower scores.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.functions.order_stats import numbered

# declared, so that opening a table starts no schema-inference job
STAR_SCHEMA = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
}

ITEM_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity", "l_tax"]


def _shift(moment: str, days: str, hours: str) -> Column:
    return F.expr(f"{moment} + make_dt_interval(CAST({days} AS INT), CAST({hours} AS INT))")


class StarSource:
    """Reads one folder of star-schema Parquet files and derives the raw tables lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder

    def _star(self, name: str) -> DataFrame:
        return self._spark.read.schema(STAR_SCHEMA[name]).parquet(f"{self._folder}/{name}.parquet")

    def tables(self) -> dict[str, Callable[[], DataFrame]]:
        return {
            "category_translation": self.category_translation,
            "customers": self.customers,
            "sellers": self.sellers,
            "products": self.products,
            "orders": self.orders,
            "order_items": self.order_items,
            "payments": self.payments,
            "reviews": self.reviews,
            "geolocation": self.geolocation,
            "order_items:rows": self.item_rows,
            "payments:rows": self.payment_rows,
        }

    def customers(self) -> DataFrame:
        nation = self._star("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        people = self._star("customer").join(nation, "c_nationkey")
        bought = self._star("orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
        return bought.join(people, "c_custkey").select(
            F.col("o_orderkey").alias("customer_id"),
            F.col("c_custkey").alias("customer_unique_id"),
            F.col("c_nationkey").alias("customer_zip_code_prefix"),
            F.col("c_mktsegment").alias("customer_city"),
            F.col("n_name").alias("customer_state"),
        )

    def orders(self) -> DataFrame:
        day, key = "o_orderdate", "o_orderkey"
        unapproved = F.expr(f"{key} % 50 = 7")
        status = F.col("o_orderstatus")
        return self._star("orders").select(
            F.col(key).alias("order_id"),
            F.col(key).alias("customer_id"),
            F.when(status == "F", "delivered").when(status == "O", "shipped").otherwise("canceled").alias("order_status"),
            _shift(day, "0", f"{key} % 24").alias("order_purchase_timestamp"),
            F.when(~unapproved, _shift(day, f"{key} % 2", f"24 + {key} % 7")).alias("order_approved_at"),
            F.when(~((status == "P") | unapproved), _shift(day, f"3 + {key} % 5", f"{key} % 11")).alias(
                "order_delivered_carrier_date"
            ),
            F.when(
                (status == "F") & F.expr(f"{key} % 97 <> 5"), _shift(day, f"5 + ({key} * 7) % 31", f"24 + {key} % 13")
            ).alias("order_delivered_customer_date"),
            _shift(day, f"18 + {key} % 11", "0").alias("order_estimated_delivery_date"),
        )

    def _lines(self) -> DataFrame:
        price = F.col("l_extendedprice").cast("decimal(10,2)")
        freight = (price * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(10,2)")
        return self._star("lineitem").withColumns({"price": price, "freight_value": freight})

    def item_rows(self) -> DataFrame:
        """Items without their number; enough for everything at order grain."""
        return self._lines().select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_date"),
            "price",
            "freight_value",
        )

    def _numbered_lines(self) -> DataFrame:
        return numbered(self._lines(), "l_orderkey", ITEM_ORDER, "order_item_id")

    def order_items(self) -> DataFrame:
        return self._numbered_lines().select(
            F.col("l_orderkey").alias("order_id"),
            "order_item_id",
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_date"),
            "price",
            "freight_value",
        )

    @staticmethod
    def _payment_columns(number: list[Column | str]) -> list[Column | str]:
        paid = F.when(F.expr("l_orderkey % 29 = 0"), F.col("price")).otherwise(F.col("price") + F.col("freight_value"))
        flag = F.col("l_returnflag")
        return [
            F.col("l_orderkey").alias("order_id"),
            *number,
            F.when(flag == "A", "credit_card").when(flag == "N", "boleto").otherwise("voucher").alias("payment_type"),
            (F.col("l_linenumber") + 1).alias("payment_installments"),
            paid.cast("decimal(12,2)").alias("payment_value"),
        ]

    def payments(self) -> DataFrame:
        numbers = [F.col("order_item_id").alias("payment_sequential")]
        return self._numbered_lines().where("l_orderkey % 101 <> 4").select(*self._payment_columns(numbers))

    def payment_rows(self) -> DataFrame:
        """Payments without their sequence number."""
        return self._lines().where("l_orderkey % 101 <> 4").select(*self._payment_columns([]))

    def reviews(self) -> DataFrame:
        # a plain row_number <= 2 becomes a map-side group limit, so a hot order never travels whole
        first_two = (
            self._star("lineitem")
            .withColumn("order_item_id", F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*ITEM_ORDER)))
            .where("order_item_id <= 2 AND l_orderkey % 11 <> 3")
        )
        orders = self.orders().select("order_id", "order_delivered_customer_date", "order_estimated_delivery_date")
        joined = first_two.join(orders, F.col("l_orderkey") == F.col("order_id"))
        base = F.ceil(F.col("l_quantity") / 10)
        due = "order_estimated_delivery_date"
        late = F.col("order_delivered_customer_date") > F.col(due)
        return joined.select(
            (F.col("order_id") * 10 + F.col("order_item_id")).alias("review_id"),
            "order_id",
            F.when(late, F.greatest(F.lit(1), base - 2)).otherwise(base).cast("int").alias("review_score"),
            F.when(F.col("l_returnflag") == "R", "title").alias("review_comment_title"),
            F.when(F.col("l_linestatus") == "F", "message").alias("review_comment_message"),
            _shift(due, "1", "0").alias("review_creation_date"),
            _shift(due, "3", "5").alias("review_answer_timestamp"),
        )

    def products(self) -> DataFrame:
        size = F.col("p_size")
        return self._star("part").select(
            F.col("p_partkey").alias("product_id"),
            F.when(F.expr("p_partkey % 50 = 0"), F.lit(None).cast("string"))
            .when(F.expr("p_partkey % 50 = 1"), "")
            .otherwise(F.col("p_type"))
            .alias("product_category_name"),
            F.length("p_name").alias("product_name_lenght"),
            (size * 10).alias("product_description_lenght"),
            (size % 7).alias("product_photos_qty"),
            F.when(F.expr("p_partkey % 40 <> 3"), size * 100).alias("product_weight_g"),
            size.alias("product_length_cm"),
            size.alias("product_height_cm"),
            size.alias("product_width_cm"),
        )

    def category_translation(self) -> DataFrame:
        kinds = self._star("part").where("p_type <> 'STANDARD'").select("p_type").distinct()
        return kinds.select(
            F.col("p_type").alias("product_category_name"),
            F.lower("p_type").alias("product_category_name_english"),
        )

    def sellers(self) -> DataFrame:
        nation = self._star("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
        return self._star("supplier").join(nation, "s_nationkey").select(
            F.col("s_suppkey").alias("seller_id"),
            F.col("s_nationkey").alias("seller_zip_code_prefix"),
            F.col("n_name").alias("seller_city"),
            F.col("n_name").alias("seller_state"),
        )

    def geolocation(self) -> DataFrame:
        nation = self._star("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        balance = F.col("c_acctbal").cast("decimal(10,2)")
        return self._star("customer").where("c_nationkey <> 24").join(nation, "c_nationkey").select(
            F.col("c_nationkey").alias("geolocation_zip_code_prefix"),
            (balance / 1000).cast("decimal(10,7)").alias("geolocation_lat"),
            (balance / -500).cast("decimal(10,7)").alias("geolocation_lng"),
            F.col("c_mktsegment").alias("geolocation_city"),
            F.col("n_name").alias("geolocation_state"),
        )
