"""One data set: its raw tables and the lazily built analytics views."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from mercato.plans import views
from mercato.schema import RAW_TABLES
from mercato.session import configure, written
from mercato.sources.adapter import StarSource


class Market:
    """Entry point for all operators; every attribute is a lazy DataFrame."""

    def __init__(self, spark: SparkSession, tables: Mapping[str, Callable[[], DataFrame]]):
        self.spark = configure(spark)
        self._sources = dict(tables)
        self._built: dict[str, DataFrame] = {}

    @classmethod
    def from_star(cls, spark: SparkSession, folder: str) -> Market:
        return cls(spark, StarSource(spark, folder).tables())

    @classmethod
    def from_parquet(cls, spark: SparkSession, folder: str) -> Market:
        def reader(name: str) -> Callable[[], DataFrame]:
            return lambda: spark.read.parquet(f"{folder.rstrip('/')}/{name}")

        return cls(spark, {name: reader(name) for name in RAW_TABLES})

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str) -> Market:
        def reader(name: str) -> Callable[[], DataFrame]:
            return lambda: spark.table(f"{database}.{name}")

        return cls(spark, {name: reader(name) for name in RAW_TABLES})

    def raw(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._sources[name]()
        return self._built[name]

    def rows(self, name: str) -> DataFrame:
        """A raw table for use at a coarser grain: a source may leave out sequence numbers here."""
        light = f"{name}:rows"
        return self.raw(light if light in self._sources else name)

    @cached_property
    def products(self) -> DataFrame:
        return views.products(self)

    @cached_property
    def geolocation(self) -> DataFrame:
        return views.geolocation(self)

    @cached_property
    def orders_core(self) -> DataFrame:
        """``orders_enriched`` without coordinates, for queries that never look at them."""
        return views.orders_core(self)

    @cached_property
    def orders_enriched(self) -> DataFrame:
        return views.orders_enriched(self)

    @cached_property
    def order_items_enriched(self) -> DataFrame:
        return views.order_items_enriched(self)

    @cached_property
    def order_metrics(self) -> DataFrame:
        return views.order_metrics(self)

    @property
    def delivered(self) -> DataFrame:
        """Order metrics of completed transactions."""
        return self.order_metrics.where("order_status = 'delivered'")

    def with_written_metrics(self) -> Market:
        """The same market with the order fact table written once, for many reports in a row."""
        twin = Market(self.spark, self._sources)
        twin._built = self._built
        twin.__dict__["order_metrics"] = written(self.order_metrics, "order_metrics")
        return twin
