"""A sample of the registered queries beside their DuckDB oracles on the smallest data, plus registry hygiene."""

from __future__ import annotations

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as registered
from tools.check import TABLES, table

SAMPLE = [
    "v2_geolocation",
    "v5_order_metrics",
    "m1_executive_metrics",
    "m3_delivery_metrics",
    "m4_category_metrics",
    "m6_customer_metrics",
    "m7_cohort_retention",
    "m8_rfm_segments",
    "dq4_orphan_rows",
    "da14_largest_payment_mismatches",
    "e8_order_value_histogram",
    "e9_delivery_summary",
    "e14_reviews_by_delay",
    "p7_repeat_share_by_month",
    "c5_horizon_long",
    "f4_quantile_scores",
    "t3_delay_mann_whitney",
    "t6_value_time_spearman",
    "x10_repeat_purchases",
    "l4_split",
    "ingest_orders",
]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_oracle(spark, duck, name):
    df = registered.queries()[name](spark, SF)
    result = duck.execute(registered.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert table(df.columns, [tuple(r) for r in df.collect()]) == table(columns, result.fetchall())


def test_every_oracle_has_a_query():
    assert set(registered.oracle_sql()) <= set(registered.queries())


def test_flagship_query_has_rows(spark):
    assert registered.entry(spark).count() > 0
