"""Physical plans: what must not appear at scale, and what must reach the scan."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from mercato.market import Market
from mercato.operators import cohort, eda, marts, product
from mercato.plans import views
from mercato.schema import RAW_TABLES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


ALL_MARTS = [f for name, f in marts.MARTS.items() if name != "rfm_segments"]


@pytest.mark.parametrize("mart", ALL_MARTS, ids=lambda f: f.__name__)
def test_marts_have_no_cross_join_and_no_python(star, mart):
    text = plan(mart(star))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "Pandas" not in text


@pytest.mark.parametrize(
    "query",
    [
        marts.monthly_metrics,
        marts.delivery_metrics,
        marts.category_metrics,
        marts.customer_metrics,
        product.overall_metrics,
        cohort.cohort_counts,
        eda.status_shares,
        eda.order_value_limit,
    ],
    ids=lambda f: f.__name__,
)
def test_only_grouped_rows_meet_in_one_partition(star, query):
    """Whatever is sent to a single partition has been aggregated just before."""
    lines = plan(query(star)).splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert any("HashAggregate" in below for below in lines[i + 1 : i + 4]), "\n".join(lines[i : i + 4])


def test_unused_children_are_not_computed(star):
    by_month = star.delivered.groupBy("order_month").agg(F.count(F.lit(1)))
    text = plan(by_month)
    assert "lineitem" not in text  # no item, payment or review table is read for a plain count


def test_columns_reach_the_scan(star):
    text = plan(marts.state_metrics(star))
    scans = re.findall(r"FileScan parquet .*?ReadSchema: struct<(.*?)>", text)
    assert scans
    for unused in ("l_discount", "l_linestatus", "o_totalprice", "c_name", "c_acctbal"):
        assert not any(unused in columns for columns in scans)


def test_status_filter_is_pushed_into_stored_tables(spark, star, tmp_path):
    for name in RAW_TABLES:
        star.raw(name).write.parquet(f"{tmp_path}/{name}")
    stored = Market.from_parquet(spark, str(tmp_path))
    text = plan(marts.state_metrics(stored))
    assert "EqualTo(order_status,delivered)" in text
    assert "payment_value" not in text and "review_comment_message" not in text


def test_a_hot_order_is_found_by_a_bounded_broadcast(star):
    text = plan(star.raw("order_items"))
    assert "BroadcastHashJoin" in text and "CartesianProduct" not in text


def test_first_two_reviews_are_limited_before_the_shuffle(star):
    assert "WindowGroupLimit" in plan(star.raw("reviews"))


def scans(df, column: str) -> int:
    """Reads of the star table that has ``column``."""
    return sum("FileScan" in line and column in line for line in plan(df).splitlines())


def test_big_tables_are_read_few_times(star):
    from mercato.operators import quality, statistics

    assert scans(star.order_metrics, "l_orderkey") <= 3  # items, payments, reviews
    assert scans(quality.constraint_violations(star), "l_orderkey") <= 9  # three for each numbering of items and payments
    assert scans(statistics.category_review_summary(star), "l_orderkey") <= 2


def test_bounded_frames_need_few_shuffles(star):
    from mercato.operators import statistics

    def shuffles(df) -> int:
        return len(re.findall(r"(?<!Broadcast)Exchange (?:hash|range|Single)", plan(df)))

    assert shuffles(statistics.category_review_summary(star)) <= 8
    assert shuffles(statistics.category_kruskal(star)) <= 14
    assert shuffles(statistics.delay_review_summary(star)) <= 4


def test_items_meet_sellers_that_are_already_located(star):
    """A join by the few ZIP prefixes holds no items: they would gather in as many tasks."""
    lines = star.order_items_enriched._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = [len(re.match(r"[ :+-]*", line).group()) for line in lines]
    at = next(i for i, line in enumerate(lines) if "Join LeftOuter" in line and "seller_zip_code_prefix" in line)
    below = [i for i in range(at + 1, len(lines)) if depth[i] <= depth[at]]
    under = "\n".join(lines[at : below[0] if below else len(lines)])
    assert "s_suppkey" in under and "l_orderkey" not in under


@pytest.mark.parametrize("query", [marts.category_metrics, eda.category_performance], ids=["m4", "e15"])
def test_baskets_are_summed_once(star, query):
    """Groups by order and product beside those by order and category would double what a task holds."""
    text = query(star)._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Aggregate \[order_id#\d+L?, product_id", text)
    assert re.search(r"Aggregate \[order_id#\d+L?, product_category", text)


def test_items_travel_once_to_their_order(star):
    text = plan(star.order_metrics)
    assert "Expand" not in text  # one row of an item stays one row
    items = [line for line in plan(views.item_totals(star.rows("order_items"), star.raw("orders"))).splitlines() if "Exchange hash" in line]
    assert len(items) == 2  # the items and the ids of the orders


def test_a_huge_order_is_dealt_out(spark):
    settings = {
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        huge = "CASE WHEN id % 10 = 0 THEN id % 500 ELSE 7 END AS order_id"
        items = spark.range(0, 60_000, 1, 8).selectExpr(
            huge, "nullif(id * 7919 % 5003, 11) AS product_id", "id * 31 % 97 AS seller_id",
            "CAST(id % 100 AS DECIMAL(10,2)) AS price", "CAST(id % 7 AS DECIMAL(10,2)) AS freight_value",
        )
        made = views.item_totals(items, spark.range(600).selectExpr("id AS order_id"))
        got = {r.order_id: tuple(r)[1:] for r in made.collect()}
        assert "skew=true" in made._jdf.queryExecution().executedPlan().toString()
        wanted = items.groupBy("order_id").agg(
            F.count("*"), F.sum("price"), F.sum("freight_value"), F.sum(F.col("price") + F.col("freight_value")),
            F.count_distinct("product_id"), F.count_distinct("seller_id"),
        )
        assert got == {r.order_id: tuple(r)[1:] for r in wanted.collect()}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
