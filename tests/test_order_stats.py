"""Distributed order statistics against plain windows and numpy."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from mercato.functions import order_stats


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def tied(spark):
    """Heavy ties, negative values, NULLs and a group that holds most rows."""
    rng = random.Random(7)
    data = []
    for i in range(3000):
        group = "hot" if i % 3 else rng.choice("ab")
        value = None if i % 50 == 0 else float(rng.choice([0, 1, 1, 1, 2, -3, round(rng.gauss(100, 40), 2), 1e6]))
        data.append((i, group, value))
    return spark.createDataFrame(data, "id long, grp string, value double").repartition(7).cache()


def test_quantiles_equal_numpy_per_group(tied):
    got = order_stats.quantiles(tied, ["grp"], "value", {"q0": 0.0, "q1": 0.1, "q5": 0.5, "q99": 0.99, "q100": 1.0})
    values = {}
    for r in tied.where("value IS NOT NULL").collect():
        values.setdefault(r.grp, []).append(r.value)
    for r in got.collect():
        expected = np.quantile(values.pop(r.grp), [0.0, 0.1, 0.5, 0.99, 1.0])
        assert np.allclose([r.q0, r.q1, r.q5, r.q99, r.q100], expected, rtol=1e-12)
    assert not values


def test_quantiles_keep_null_groups(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("x", 5.0)], "g string, v double")
    assert {tuple(r) for r in order_stats.quantiles(df, ["g"], "v", {"m": 0.5}).collect()} == {(None, 2.0), ("x", 5.0)}


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert order_stats.quantiles(df, (), "v", {"m": 0.5}).collect() == []


@pytest.mark.parametrize("tiles", [2, 4, 7])
def test_ntile_equals_window(tied, tiles):
    got = order_stats.ntile(tied, "value", "id", tiles, "tile")
    window = Window.orderBy(F.asc_nulls_last("value"), "id")
    assert rows(got.select("id", "tile")) == rows(tied.select("id", F.ntile(tiles).over(window)))


def test_ntile_with_text_ids_and_few_rows(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", None)], "id string, v double")
    assert rows(order_stats.ntile(df, "v", "id", 4, "t").select("id", "t")) == [("a", 1), ("b", 2), ("c", 3)]


def test_ntiles_of_two_columns_with_ties_among_long_text_ids(spark):
    rng = random.Random(5)
    data = [(f"CÜST-{i:09d}"[: rng.choice([6, 9, 14, 14, 14])] + rng.choice(["", "ß"]) + str(i), rng.choice([0, 1, 1, 1]), None if i % 3 else i % 7) for i in range(2000)]
    df = spark.createDataFrame(data, "id string, v int, w int").repartition(3)
    got = order_stats.ntiles(df, {"a": "v", "b": "w"}, "id", 5)
    tile = lambda c: F.ntile(5).over(Window.orderBy(F.asc_nulls_last(c), "id"))
    assert rows(got.select("id", "a", "b")) == rows(df.select("id", tile("v"), tile("w")))


def test_text_ties_part_behind_their_common_prefix(spark):
    ids = spark.range(20_000).select(F.format_string("CUST-%07d", F.col("id") * 37).alias("id"))
    ends = ids.agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("id").alias("rows"))
    parted = ids.crossJoin(ends).select("id", order_stats._tie_part(ids.schema["id"].dataType, *map(F.col, ("id", "low", "high", "rows"))).alias("part"))
    counts = [r["count"] for r in parted.groupBy("part").count().orderBy("part").collect()]
    assert max(counts) <= 0.01 * sum(counts)
    firsts = [r[0] for r in parted.groupBy("part").agg(F.min("id").alias("i")).orderBy("part").select("i").collect()]
    assert firsts == sorted(firsts)
    shared = lambda a, b: spark.range(1).select(order_stats._shared_bytes(F.encode(F.lit(a), "UTF-8"), F.encode(F.lit(b), "UTF-8"))).first()[0]
    assert [shared("", "a"), shared("", ""), shared("ab", "ab"), shared("ab", "abc"), shared("xa", "xb"), shared("é", "è")] == [0, 0, 2, 2, 1, 1]


def test_values_far_from_zero_are_sorted_in_small_parts(spark):
    """A million values within two millionths of 10^9 meet in parts of under a hundredth of them."""
    far = spark.range(1_000_000).select((F.lit(1e9) + F.col("id") * 2.5 + F.rand(3)).alias("v"))
    slot = order_stats.slot_of(F.col("v")).alias("slot")
    slots = far.groupBy(slot).agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count("v").alias("n"))
    assert slots.count() <= 3
    placed = far.withColumn("slot", slot).join(F.broadcast(slots), "slot")
    part = order_stats._part_of(*map(F.col, ("v", "low", "high", "n"))).alias("part")
    sizes = placed.groupBy("slot", part).agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    found = sizes.orderBy("slot", "part").collect()
    assert max(r["n"] for r in found) <= 10_000
    assert all(a["high"] <= b["low"] for a, b in zip(found, found[1:]))


def test_far_values_equal_plain_order(spark):
    rng = random.Random(9)
    values = [1e9 + rng.choice([rng.uniform(0, 3e6), rng.randrange(40), 1e-3 * rng.randrange(900)]) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    got = order_stats.quantiles(df, (), "v", {f"p{i}": i / 20 for i in range(21)}).first()
    assert list(got) == pytest.approx(list(np.quantile(values, [i / 20 for i in range(21)])), rel=1e-15)
    for descending in (False, True):
        totals = order_stats.running_totals(df, (), "v", {"n": F.count(F.lit(1))}, descending)
        order = sorted(values, reverse=descending)
        upto = {v: i + 1 for i, v in enumerate(order)}
        assert {r["v"]: r["n_upto"] for r in totals.collect()} == upto


def test_running_totals_equal_window(tied):
    got = order_stats.running_totals(tied, ["grp"], "value", {"n": F.count(F.lit(1))}, descending=True)
    counts = tied.where("value IS NOT NULL").groupBy("grp", "value").agg(F.count(F.lit(1)).alias("n"))
    window = Window.partitionBy("grp")
    plain = counts.select(
        "grp", "value", "n", F.sum("n").over(window.orderBy(F.desc("value"))), F.sum("n").over(window)
    )
    assert rows(got) == rows(plain)


def test_mid_ranks_with_ties(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (3,)], "v int")
    assert rows(order_stats.mid_ranks(df, "v").select("v", "rank")) == [(1, 1.0), (2, 2.5), (3, 4.0)]


def test_numbering_splits_a_hot_key(spark):
    rng = random.Random(3)
    data = [("hot" if i % 3 else f"k{i % 40}", rng.randint(1, 4), rng.randint(1, 900), i) for i in range(2000)]
    df = spark.createDataFrame(data, "k string, a int, b int, c int").repartition(5)
    plain = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("a", "b", "c")))
    for limit in (100, 10_000):  # with and without hot keys
        got = order_stats.numbered(df, "k", ["a", "b", "c"], "n", group_limit=limit)
        assert rows(got.select("k", "a", "b", "c", "n")) == rows(plain)


def test_slots_are_monotone(spark):
    values = sorted(random.Random(1).uniform(-1e7, 1e7) for _ in range(500)) + [1e300]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    slots = [r.s for r in df.select("v", order_stats.slot_of(F.col("v")).alias("s")).orderBy("v").collect()]
    assert slots == sorted(slots)


def test_position_by_group_size(spark):
    df = spark.createDataFrame([("a", v) for v in range(10)] + [("b", 7)], "g string, v long")
    got = order_stats.positioned(df, ["g"], "v", lambda n: F.round(n * 0.2) - 1, "cut")
    assert rows(got) == [("a", 1)]  # two of ten; none of one
