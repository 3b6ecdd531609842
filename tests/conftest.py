from __future__ import annotations

import datetime as dt
import sys
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from mercato.market import Market  # noqa: E402
from mercato.schema import RAW_TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("mercato-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def star(spark) -> Market:
    return Market.from_star(spark, SF)


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


@pytest.fixture
def market(spark):
    """Build a market from a few hand-made rows; tables that are not given are empty."""

    def build(**tables) -> Market:
        def frame(name):
            struct = RAW_TABLES[name].struct
            for field in struct.fields:
                field.nullable = True
            rows = [tuple(row.get(n) for n in struct.names) for row in tables.get(name, [])]
            return lambda: spark.createDataFrame(rows, struct)

        return Market(spark, {name: frame(name) for name in RAW_TABLES})

    return build


def order(oid: str, customer: str = "c", bought: str = "2020-01-10 10:00:00", delivered: str | None = "2020-01-15 10:00:00",
          due: str = "2020-01-20 00:00:00", status: str = "delivered", zip_code: int = 1):
    """One order with its own customer row."""
    return (
        {
            "order_id": oid,
            "customer_id": f"id-{oid}",
            "order_status": status,
            "order_purchase_timestamp": at(bought),
            "order_delivered_customer_date": at(delivered) if delivered else None,
            "order_estimated_delivery_date": at(due),
        },
        {
            "customer_id": f"id-{oid}",
            "customer_unique_id": customer,
            "customer_zip_code_prefix": zip_code,
            "customer_city": "town",
            "customer_state": "ST",
        },
    )


def item(oid: str, number: int = 1, product: str = "p", price: str = "10.00", freight: str = "1.00", seller: str = "s"):
    return {
        "order_id": oid,
        "order_item_id": number,
        "product_id": product,
        "seller_id": seller,
        "price": Decimal(price),
        "freight_value": Decimal(freight),
    }


def review(oid: str, score: int, rid: str = "r"):
    return {"review_id": rid, "order_id": oid, "review_score": score}
