"""Business rules on hand-made orders."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import item, order, review

from mercato.operators import cohort, eda, marts, product, quality, rfm, statistics


def split(pairs):
    return {"orders": [o for o, _ in pairs], "customers": [c for _, c in pairs]}


def point(zip_code, lat, lng, city, state="ST"):
    return {
        "geolocation_zip_code_prefix": zip_code,
        "geolocation_lat": Decimal(lat),
        "geolocation_lng": Decimal(lng),
        "geolocation_city": city,
        "geolocation_state": state,
    }


def test_place_mode_ties_are_alphabetic_and_medians_interpolate(market):
    points = [point(1, "1", "10", "b"), point(1, "2", "20", "a"), point(1, "3", "30", "b"), point(1, "10", "40", "a", "AA")]
    row = market(geolocation=points).geolocation.first()
    assert (row.city, row.state) == ("b", "ST")
    assert (row.latitude, row.longitude) == (2.5, 25.0)
    tie = market(geolocation=points[:2]).geolocation.first()
    assert tie.city == "a"


def test_category_joins_as_stored_and_shows_trimmed(market):
    m = market(
        products=[{"product_id": i, "product_category_name": c} for i, c in [("1", " x "), ("2", "  "), ("3", "x"), ("4", None)]],
        category_translation=[{"product_category_name": "x", "product_category_name_english": "ex"}],
    )
    got = {r.product_id: (r.product_category_name, r.product_category_name_english) for r in m.products.collect()}
    assert got == {"1": ("x", "unknown"), "2": (None, "unknown"), "3": ("x", "ex"), "4": (None, "unknown")}


def test_missing_children_get_defaults_and_flags_stay_three_valued(market):
    pairs = [order("late", delivered="2020-01-20 00:00:01"), order("due", delivered="2020-01-20 00:00:00"),
             order("open", delivered=None)]
    m = market(**split(pairs), order_items=[item("late"), item("late", 2)])
    rows = {r.order_id: r for r in m.order_metrics.collect()}
    assert [rows[k].is_delayed for k in ("late", "due", "open")] == [True, False, None]
    bare = rows["open"]
    assert (bare.items_count, bare.payments_count, bare.reviews_count) == (0, 0, 0)
    assert (bare.has_review_title, bare.has_review_message) == (False, False)
    assert (bare.order_items_value, bare.payment_value, bare.average_review_score) == (None, None, None)
    assert rows["late"].order_items_value == Decimal("22.00")
    assert rows["late"].unique_products_count == 1


def test_unknown_delivery_is_its_own_group_and_unreviewed_is_not_low(market):
    pairs = [order("a", delivered=None), order("b"), order("c")]
    m = market(**split(pairs), reviews=[review("b", 1)])
    got = {r.is_delayed: r for r in marts.delivery_metrics(m).collect()}
    assert set(got) == {None, False}
    assert got[None].median_delivery_time_days is None
    assert got[False].low_review_rate_percent == 50.0
    assert marts.monthly_metrics(m).first().delivered_orders == 3


def test_score_is_rounded_before_the_threshold(market):
    many = [review("x", 2, f"r{i}") for i in range(249)] + [review("x", 3, "last")]
    m = market(**split([order("x"), order("y")]), reviews=[*many, review("y", 1, "p"), review("y", 4, "q")])
    scores = {r.order_id: r.average_review_score for r in m.order_metrics.collect()}
    assert scores == {"x": Decimal("2.00"), "y": Decimal("2.50")}
    assert marts.delivery_metrics(m).first().low_review_rate_percent == 50.0


def test_an_order_with_two_categories(market):
    m = market(
        **split([order("two"), order("one")]),
        order_items=[item("two", 1, "p"), item("two", 2, "q", "30.00"), item("one", 1, "p"), item("one", 2, "p", "20.00")],
        products=[{"product_id": p, "product_category_name": p} for p in "pq"],
        category_translation=[{"product_category_name": p, "product_category_name_english": p.upper()} for p in "pq"],
        reviews=[review("two", 5), review("one", 3)],
    )
    categories = {r.product_category: r for r in marts.category_metrics(m).collect()}
    assert {k: v.delivered_orders for k, v in categories.items()} == {"P": 2, "Q": 1}
    assert categories["P"].average_item_price == 12.5  # mean of 10 and (10 + 20) / 2
    assert [r.product_category for r in statistics.category_reviews(m).collect()] == ["P"]
    weighted = {r.product_category_name_english: r.average_item_price for r in eda.category_performance(m).collect()}
    assert weighted["P"] == 13.33


def test_two_purchases_in_the_first_month_are_new_not_repeat(market):
    pairs = [order("1"), order("2", bought="2020-01-20 00:00:00"), order("3", bought="2021-02-01 00:00:00")]
    m = market(**split(pairs), order_items=[item(k) for k in "123"])
    got = {r.month: r for r in marts.customer_metrics(m).collect()}
    first = got[dt.date(2020, 1, 1)]
    assert (first.new_customers, first.repeat_customers, first.delivered_orders) == (1, 0, 2)
    assert got[dt.date(2021, 2, 1)].repeat_customer_share_percent == 100.0
    index = [(r.cohort_index, r.retention_rate_percent) for r in marts.cohort_retention(m).collect()]
    assert index == [(0, 100.0), (13, 100.0)]
    assert cohort.last_index(m) == 13
    assert cohort.retention_counts(m).columns == ["cohort_month", *[str(i) for i in range(14)]]


def test_equal_quantile_edges_raise_but_ranks_split(market):
    pairs = [order(str(i), f"c{i}", bought=f"2020-01-{10 + i} 00:00:00") for i in range(8)]
    m = market(**split(pairs), order_items=[item(str(i)) for i in range(8)])
    with pytest.raises(Exception, match="quantile edges must be unique"):
        rfm.quantile_scored(m).collect()
    assert sorted(r.m_score for r in rfm.ntile_scored(m).collect()) == [1, 1, 2, 2, 3, 3, 4, 4]


def test_unvalued_customers_rank_last(market):
    pairs = [order(str(i), f"c{i}") for i in range(4)]
    m = market(**split(pairs), order_items=[item(str(i), price=f"{i + 1}.00") for i in range(3)])
    assert {r.customer_unique_id: r.m_score for r in rfm.ntile_scored(m).collect()}["c3"] == 4


def test_month_window_is_inclusive(market):
    pairs = [order(str(i), bought=f"2020-0{i}-05 00:00:00") for i in range(1, 5)]
    m = market(**split(pairs), order_items=[item(str(i)) for i in range(1, 5)])
    window = (dt.date(2020, 2, 1), dt.date(2020, 3, 1))
    assert [r.order_month for r in product.monthly_product_metrics(m, window).collect()] == list(window)


def test_empty_frequency_groups_are_kept(market):
    m = market(**split([order("1")]), order_items=[item("1")])
    got = [(r.order_frequency_group, r.customers_count) for r in product.order_frequency_groups(m).collect()]
    assert got == [("1 order", 1), ("2 orders", 0), ("3 orders", 0), ("4 orders", 0), ("5+ orders", 0)]


def test_row_count_assertion_lists_every_mismatch(market):
    m = market(**split([order("1")]))
    counts = quality.raw_row_counts(m)
    quality.assert_row_counts(counts, {"orders": 1, "customers": 1})
    with pytest.raises(quality.RowCountError, match="(?s)customers.*orders"):
        quality.assert_row_counts(counts, {"orders": 2, "customers": 5})


def test_constraint_report_finds_planted_violations(market):
    m = market(
        **split([order("1"), order("1")]),
        order_items=[item("1", price="-1.00"), item("ghost")],
        reviews=[review("1", 9)],
    )
    found = {(r.table_name, r.rule): r.violations for r in quality.constraint_violations(m).collect() if r.violations}
    assert found[("order_items", "price_non_negative")] == 1
    assert found[("order_items", "references:order_id")] == 1
    assert found[("orders", "unique:order_id")] == 1
    assert found[("reviews", "score_between_1_and_5")] == 1
    assert found[("order_items", "not_null:shipping_limit_date")] == 2


def test_view_invariants_on_the_star_data(star):
    assert all(r.row_difference == 0 for r in quality.row_preservation(star).collect())
    assert quality.duplicate_view_keys(star).collect() == []
    monthly = sum(r.delivered_orders for r in marts.monthly_metrics(star).collect())
    assert monthly == marts.executive_metrics(star).first().delivered_orders
    assert all(r.retention_rate_percent == 100 for r in marts.cohort_retention(star).where("cohort_index = 0").collect())
    segments = marts.rfm_segments(star).collect()
    assert sum(r.customers_count for r in segments) == marts.executive_metrics(star).first().unique_customers
    assert sum(r.customer_share_percent for r in segments) == pytest.approx(100, abs=0.05)


def test_segments_cover_all_score_triples(spark):
    from itertools import product as triples

    from pyspark.sql import functions as F

    def expected(r, f, m):  # fixed values: the first match counts
        if r == 4 and f >= 3 and m >= 3:
            return "Champions"
        if r >= 3 and f >= 2 and m >= 2:
            return "Loyal Customers"
        if r == 4 and f == 1:
            return "New Customers"
        if r >= 3 and m >= 3:
            return "High-Value Recent"
        if r <= 2 and f >= 2:
            return "At Risk"
        if r == 1 and f == 1:
            return "Lost Customers"
        return "Regular Customers"

    scores = spark.createDataFrame(list(triples(range(1, 5), repeat=3)), "r int, f int, m int")
    for row in scores.withColumn("segment", rfm.segment_of(F.col("r"), F.col("f"), F.col("m"))).collect():
        assert row.segment == expected(row.r, row.f, row.m), row
