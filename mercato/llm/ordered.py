"""Places, running sums and successors in an order that no single task has to hold.

Rows are dealt into ranges of the order and written with the number of their range. Inside a range plain windows work;
what goes on from range to range is one row per range that starts inside a group, so fewer than there are ranges:
that bounds the broadcasts below, whatever a group's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.tables import written

#: At most this many keys hold more than 1 / HUBS of all rows.
HUBS = 10_000


def dealt(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """``rows`` in ranges of ``order``, the range as ``__part``; written, so that the ranges stay as they are."""
    return written(rows.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), label)


def _across(ranged: DataFrame, group: list[str], per_range: dict[str, Column]) -> tuple[DataFrame, Window]:
    sums = ranged.groupBy("__part", *group).agg(*[c.alias(n) for n, c in per_range.items()])
    return sums, Window.partitionBy(*group).orderBy("__part")


def _carried(ranged: DataFrame, few: DataFrame, group: list[str]) -> DataFrame:
    """Left join with one row per range and group at most; null is a group like any other."""
    keys = ["__part", *group]
    right = few.withColumnsRenamed({k: f"__of_{k}" for k in keys})
    met = [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys]
    return ranged.join(F.broadcast(right), met, "left").drop(*[f"__of_{k}" for k in keys])


def running(ranged: DataFrame, group: list[str], order: list[str], place: str, sums: dict[str, str]) -> DataFrame:
    """``ranged`` with ``place`` (from 1) in its group and running sums, ``sums`` naming result and source columns."""
    names = [place, *sums]
    totals, onwards = _across(ranged, group, {place: F.count(F.lit(1)), **{n: F.sum(c) for n, c in sums.items()}})
    before = [(F.sum(n).over(onwards) - F.col(n)).alias(f"__{n}") for n in names]
    carried = totals.select("__part", *group, *before).filter(f"__{place} > 0")  # fewer rows than ranges
    inside = Window.partitionBy("__part", *group).orderBy(*order)
    upto = {place: F.row_number().over(inside).cast("bigint")}
    running_rows = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto |= {n: F.sum(c).over(running_rows) for n, c in sums.items()}
    met = _carried(ranged.withColumns(upto), carried, group)
    full = {n: F.col(n) + F.coalesce(f"__{n}", F.lit(0)) for n in names}
    return met.withColumns(full).drop("__part", *[f"__{n}" for n in names])


def with_next(ranged: DataFrame, group: list[str], value: str, name: str) -> DataFrame:
    """``ranged`` with the next larger ``value`` of its group, null after the last; ranges are of group and value."""
    heads, onwards = _across(ranged, group, {"__head": F.min(value)})
    following = heads.select("__part", *group, F.lead("__head").over(onwards).alias("__head")).filter("__head IS NOT NULL")
    inside = Window.partitionBy("__part", *group).orderBy(value)
    met = _carried(ranged.withColumn(name, F.lead(value).over(inside)), following, group)
    return met.withColumn(name, F.coalesce(name, "__head")).drop("__part", "__head")


def looked_up(rows: DataFrame, lookup: DataFrame, key: list[str], weight: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``lookup``, one row per key, whose ``weight`` is how many of ``total`` rows it meets.

    Keys with more than 1 / HUBS of the rows are broadcast, at most HUBS of them; the others meet in a shuffle."""
    hot = F.col(weight) > total / HUBS
    hubs = F.broadcast(lookup.filter(hot).withColumn("__hub", F.lit(True)))
    marked = rows.join(hubs, key, "left")
    at_hubs = marked.filter("__hub").drop("__hub")
    others = marked.filter("__hub IS NULL").select(*rows.columns).join(lookup.filter(~hot), key)
    return at_hubs.unionByName(others)
