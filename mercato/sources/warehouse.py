"""Tables, SQL views and mart files: what the analysis reads from and reports to."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from mercato.market import Market
from mercato.operators.marts import MARTS
from mercato.schema import RAW_TABLES

VIEWS = ("products", "geolocation", "orders_enriched", "order_items_enriched", "order_metrics")
# children share the order key, so equal buckets let the order-grain joins run without a shuffle
BUCKETED = {name: "order_id" for name in ("orders", "order_items", "payments", "reviews")}


def save_tables(m: Market, database: str, buckets: int = 64) -> None:
    """Save the raw tables to the catalog; order-keyed ones are bucketed and sorted by order."""
    m.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in RAW_TABLES:
        writer = m.raw(name).write.mode("overwrite").format("parquet")
        if name in BUCKETED:
            writer = writer.bucketBy(buckets, BUCKETED[name]).sortBy(BUCKETED[name])
        writer.saveAsTable(f"{database}.{name}")


def register_views(m: Market) -> list[str]:
    """Expose raw tables as ``raw_<name>`` and the analytics views by name to ``spark.sql``."""
    for name in RAW_TABLES:
        m.raw(name).createOrReplaceTempView(f"raw_{name}")
    for name in VIEWS:
        getattr(m, name).createOrReplaceTempView(name)
    return [*[f"raw_{n}" for n in RAW_TABLES], *VIEWS]


def export_mart(df: DataFrame, folder: str, name: str) -> None:
    """A typed Parquet copy, then one headed CSV part made from it (marts are small aggregates)."""
    df.write.mode("overwrite").parquet(f"{folder}/{name}")
    stored = read_mart(df.sparkSession, folder, name)
    stored.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder}/{name}.csv")


def export_marts(m: Market, folder: str, names: Iterable[str] = MARTS) -> list[str]:
    """Export marts from one written copy of the order fact table."""
    shared = m.with_written_metrics()
    done = []
    for name in names:
        export_mart(MARTS[name](shared), folder, name)
        done.append(name)
    return done


def read_mart(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}")


def read_mart_csv(spark: SparkSession, folder: str, name: str) -> DataFrame:
    typed = read_mart(spark, folder, name).schema
    return spark.read.option("header", True).schema(typed).csv(f"{folder}/{name}.csv")
