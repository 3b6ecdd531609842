"""Integrity checks of the raw tables (DQ) and of the analytics views (DA).

Checks return small frames; they report and never repair. Orphan checks count child keys first, so a
key with very many children still reaches the anti join as a single row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions.profile import missing_counts
from mercato.market import Market
from mercato.schema import RAW_TABLES

CENT = 0.01
VIEW_KEYS: dict[str, tuple[str, ...]] = {
    "geolocation": ("zip_code_prefix",),
    "order_items_enriched": ("order_id", "order_item_id"),
    "order_metrics": ("order_id",),
    "orders_enriched": ("order_id",),
    "products": ("product_id",),
}


def stacked(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _rows() -> Column:
    return F.count(F.lit(1))


def _view(m: Market, name: str) -> DataFrame:
    return getattr(m, name)


def _counts(frames: Mapping[str, DataFrame], label: str) -> DataFrame:
    return stacked(
        [df.agg(_rows().alias("row_count")).withColumn(label, F.lit(name)) for name, df in frames.items()]
    ).orderBy(label)


def _distinct_keys(key: tuple[str, ...]) -> Column:
    # a struct keeps key parts that are NULL, which a plain multi-column distinct count would skip
    return F.count_distinct(F.struct(*key)) if len(key) > 1 else F.count_distinct(key[0])


def _key_report(df: DataFrame, name: str, key: tuple[str, ...], label: str) -> DataFrame:
    return df.agg(_rows().alias("total_rows"), _distinct_keys(key).alias("distinct_keys")).select(
        F.lit(name).alias(label), F.lit("+".join(key)).alias("key"), "total_rows", "distinct_keys"
    )


# ---------------------------------------------------------------- raw tables


def raw_row_counts(m: Market) -> DataFrame:
    """DQ1."""
    return _counts({name: m.rows(name) for name in RAW_TABLES}, "table_name")


# Extra identities that must be reported beside the declared keys.
IDENTITIES = {
    "category_translation": [("product_category_name_english",)],
    "customers": [("customer_unique_id",)],
    "orders": [("customer_id",)],
}


def key_uniqueness(m: Market) -> DataFrame:
    """DQ2: rows against distinct keys, single and composite; all keys of a table in one pass over it."""
    reports = []
    for name, spec in RAW_TABLES.items():
        keys = [key for key in [spec.key, *IDENTITIES.get(name, [])] if key]
        if not keys:
            continue
        distinct = [_distinct_keys(key).alias(f"keys_{i}") for i, key in enumerate(keys)]
        counts = m.raw(name).agg(_rows().alias("total_rows"), *distinct)
        lines = [F.struct(F.lit("+".join(key)).alias("key"), F.col(f"keys_{i}").alias("distinct_keys")) for i, key in enumerate(keys)]
        listed = counts.select("total_rows", F.inline(F.array(*lines)))
        reports.append(listed.select(F.lit(name).alias("table_name"), "key", "total_rows", "distinct_keys"))
    return stacked(reports)


def geolocation_size(m: Market) -> DataFrame:
    """DQ3."""
    return m.raw("geolocation").agg(
        _rows().alias("total_rows"), F.count_distinct("geolocation_zip_code_prefix").alias("unique_zip_code_prefixes")
    )


def _orphans(m: Market, child: str, column: str, parent: str) -> DataFrame:
    keys = m.rows(child).groupBy(column).agg(_rows().alias("n"))
    lost = keys.join(m.rows(parent).select(F.col(RAW_TABLES[parent].key[0]).alias(column)), column, "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphans")).select(
        F.lit(child).alias("child"), F.lit(column).alias("column"), F.lit(parent).alias("parent"), "orphans"
    )


def orphan_rows(m: Market) -> DataFrame:
    """DQ4: children without their parent, for every declared relationship."""
    return stacked([_orphans(m, child, c, p) for child, spec in RAW_TABLES.items() for c, p in spec.parents])


def missing_values(m: Market, table: str) -> DataFrame:
    """DQ5-DQ7: NULL count of every nullable column (and review dates) of a table."""
    spec = RAW_TABLES[table]
    names = [n for n, t, nullable in spec.columns if nullable or (table == "reviews" and t.typeName() == "timestamp_ntz")]
    return missing_counts(m.rows(table), names)


def blank_texts(m: Market) -> DataFrame:
    """DQ8: present but blank text in the nullable text columns."""
    frames = []
    for name in ("products", "reviews"):
        spec = RAW_TABLES[name]
        texts = [n for n, t, nullable in spec.columns if nullable and t.typeName() == "string"]
        counts = m.rows(name).agg(*[F.count_if(F.trim(c) == "").alias(c) for c in texts])
        frames.append(counts.unpivot([], texts, "column", "blank_count"))
    return stacked(frames)


def distribution(m: Market, table: str, column: str, by_count: bool = True) -> DataFrame:
    """DQ9."""
    counts = m.rows(table).groupBy(column).agg(_rows().alias("rows_count"))
    return counts.orderBy(F.desc("rows_count"), column) if by_count else counts.orderBy(column)


def value_ranges(m: Market) -> DataFrame:
    """DQ10: smallest and largest money and installment values, one row per column."""

    def ranges(table: str, columns: list[str]) -> DataFrame:
        ends = m.rows(table).agg(
            *[F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")).alias(c) for c in columns]
        )
        return ends.unpivot([], columns, "column", "ends").select(
            "column", F.col("ends.lo").alias("min_value"), F.col("ends.hi").alias("max_value")
        )

    return stacked(
        [ranges("order_items", ["price", "freight_value"]), ranges("payments", ["payment_installments", "payment_value"])]
    )


def untranslated_categories(m: Market) -> DataFrame:
    """DQ11."""
    used = m.raw("products").where("product_category_name IS NOT NULL").select("product_category_name").distinct()
    return used.join(m.raw("category_translation"), "product_category_name", "left_anti").orderBy("product_category_name")


def customers_with_many_ids(m: Market, size: int = 10) -> DataFrame:
    """DQ12."""
    return (
        m.raw("customers")
        .groupBy("customer_unique_id")
        .agg(_rows().alias("customer_id_count"))
        .where("customer_id_count > 1")
        .orderBy(F.desc("customer_id_count"), "customer_unique_id")
        .limit(size)
    )


def geolocation_duplicates(m: Market) -> DataFrame:
    """DQ13: rows beyond the first of every fully equal group."""
    points = m.raw("geolocation").select(*RAW_TABLES["geolocation"].names)
    groups = points.groupBy(*points.columns).agg(_rows().alias("n")).where("n > 1")
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def _text_parts(columns: Sequence[str], width: int) -> list[Column]:
    """Key parts as text, filled up with NULL; a lone key part and a NULL stay apart from the text 'null'."""
    parts = [F.col(c).cast("string") for c in columns]
    return [*parts, *[F.lit(None).cast("string")] * (width - len(parts))]


def _table_violations(m: Market, name: str) -> DataFrame:
    """All violation counts of one table in one pass over it.

    Every row appears once for its own key, carrying its rule flags, and once for each reference. Counts per value are
    formed on the map side, the parents' keys (one small union) are looked up once, and one line per kind is left.
    """
    spec = RAW_TABLES[name]
    checks = {f"not_null:{c}": F.col(c).isNull() for c in spec.required}
    checks |= {rule: F.coalesce(F.expr(predicate), F.lit(False)) for rule, predicate in spec.rules}
    flags = [f"bad_{i}" for i in range(len(checks))]
    width = max(1, len(spec.key))
    parts = [f"part_{i}" for i in range(width)]

    def entry(kind: str, columns: Sequence[str], own: bool) -> Column:
        values = zip(parts, _text_parts(columns, width), strict=True)
        bad = zip(flags, checks.values(), strict=True)
        return F.struct(
            F.lit(kind).alias("kind"),
            *[v.alias(part) for part, v in values],
            *[(b if own else F.lit(False)).alias(f) for f, b in bad],
        )

    entries = [entry("own", spec.key, True), *[entry(column, [column], False) for column, _ in spec.parents]]
    counted = (
        m.raw(name)
        .select(F.inline(F.array(*entries)))
        .groupBy("kind", *parts)
        .agg(F.count(F.lit(1)).alias("n"), *[F.count_if(f).alias(f) for f in flags])
    )
    if spec.parents:
        keys = [
            m.rows(parent).select(F.lit(column).alias("kind"), F.col(RAW_TABLES[parent].key[0]).cast("string").alias("part_0"))
            for column, parent in spec.parents
        ]
        known = reduce(DataFrame.unionByName, keys).distinct().withColumn("known", F.lit(True))
        counted = counted.join(known, ["kind", "part_0"], "left")
    else:
        counted = counted.withColumn("known", F.lit(None).cast("boolean"))
    # composite keys count NULL parts as values, a single key skips NULL: as SQL's DISTINCT of a tuple and of a column
    distinct = F.count(F.lit(1)) if len(spec.key) > 1 else F.count("part_0")
    kinds = counted.groupBy("kind").agg(
        F.sum("n").alias("total"),
        distinct.alias("keys"),
        F.sum(F.when(F.col("known").isNull(), F.col("n")).otherwise(0)).alias("lost"),
        *[F.sum(f).alias(f) for f in flags],
    )

    def line(rule: str, violations: Column) -> Column:
        return F.struct(F.lit(rule).alias("rule"), F.coalesce(violations, F.lit(0)).cast("bigint").alias("violations"))

    def at(kind: str, value: Column) -> Column:
        return F.max(F.when(F.col("kind") == kind, value))

    lines = [line(rule, at("own", F.col(f))) for rule, f in zip(checks, flags, strict=True)]
    if spec.key:
        lines.append(line(f"unique:{'+'.join(spec.key)}", at("own", F.col("total") - F.col("keys"))))
    lines += [line(f"references:{column}", at(column, F.col("lost"))) for column, _ in spec.parents]
    return kinds.agg(F.array(*lines).alias("lines")).select(F.lit(name).alias("table_name"), F.inline("lines"))


def constraint_violations(m: Market) -> DataFrame:
    """DQ14: NOT NULL, value rules, unique keys and references of every table as violation counts; one pass per table."""
    return stacked([_table_violations(m, name) for name in RAW_TABLES]).select("table_name", "rule", "violations")


class RowCountError(ValueError):
    """Actual row counts differ from the expected ones."""


def compare_row_counts(counts: DataFrame, expected: DataFrame, label: str) -> DataFrame:
    """DQ15: actual against expected row counts, one line per object."""
    both = expected.withColumnRenamed("row_count", "expected_count").join(
        counts.withColumnRenamed("row_count", "actual_count"), label, "left"
    )
    return both.withColumn("matches", F.coalesce(F.col("expected_count") == F.col("actual_count"), F.lit(False)))


def assert_row_counts(counts: DataFrame, expected: Mapping[str, int], label: str = "table_name") -> None:
    """Collect every mismatch, then raise; only the handful of count rows reaches the driver."""
    spark = counts.sparkSession
    wanted = spark.createDataFrame(list(expected.items()), f"{label} string, row_count bigint")
    wrong = compare_row_counts(counts, wanted, label).where("NOT matches").orderBy(label).collect()
    if wrong:
        lines = [f"{r[label]}: expected {r.expected_count:,}, found {r.actual_count}" for r in wrong]
        raise RowCountError("row counts differ:\n" + "\n".join(lines))


def refused_row_counts(m: Market, expected: Mapping[str, DataFrame]) -> DataFrame:
    """DQ15: the lines of the error that stops a run whose tables differ from ``expected`` (one row, row_count, each);
    no lines if they agree."""
    actual = raw_row_counts(m)
    wanted = {name: df.first()["row_count"] for name, df in expected.items()}  # one number per table
    try:
        assert_row_counts(actual, wanted)
        lines = []
    except RowCountError as error:
        lines = str(error).splitlines()[1:]
    rows = list(enumerate(lines, 1))
    return m.spark.createDataFrame(rows, "position int, line string")


def preserved_row_counts(m: Market) -> DataFrame:
    """DQ15 on the views that must keep the rows of a raw table."""
    return compare_row_counts(
        _counts({view: _view(m, view) for view in PRESERVED}, "view_name"),
        _counts({view: m.rows(raw) for view, raw in PRESERVED.items()}, "view_name"),
        "view_name",
    )


# ---------------------------------------------------------------- analytics views

PRESERVED = {
    "products": "products",
    "orders_enriched": "orders",
    "order_items_enriched": "order_items",
    "order_metrics": "orders",
}


def view_row_counts(m: Market) -> DataFrame:
    """DA1."""
    return _counts({view: _view(m, view) for view in VIEW_KEYS}, "view_name")


def view_keys(m: Market) -> DataFrame:
    """DA2."""
    return stacked([_key_report(_view(m, view), view, key, "view_name") for view, key in VIEW_KEYS.items()])


def duplicate_view_keys(m: Market) -> DataFrame:
    """DA3: keys that occur more than once; an empty result is a pass."""
    frames = []
    for view, key in VIEW_KEYS.items():
        groups = _view(m, view).groupBy(*key).agg(_rows().alias("rows_count")).where("rows_count > 1")
        text = F.concat_ws("+", *[F.col(c).cast("string") for c in key])
        frames.append(groups.select(F.lit(view).alias("view_name"), text.alias("key_value"), "rows_count"))
    return stacked(frames)


def row_preservation(m: Market) -> DataFrame:
    """DA4: view rows minus raw rows."""
    return preserved_row_counts(m).select(
        "view_name", (F.col("actual_count") - F.col("expected_count")).alias("row_difference")
    )


def lost_dimensions(m: Market) -> DataFrame:
    """DA5."""
    orders = m.orders_core.agg(F.count_if(F.col("customer_unique_id").isNull()).alias("orders_without_customer"))
    items = m.order_items_enriched.agg(
        F.struct(
            F.count_if(F.col("product_id").isNull()).alias("p"), F.count_if(F.col("seller_id").isNull()).alias("s")
        ).alias("lost")
    )
    return orders.withColumn("lost", items.scalar()).select(
        "orders_without_customer",
        F.col("lost.p").alias("items_without_product"),
        F.col("lost.s").alias("items_without_seller"),
    )


def unknown_categories(m: Market) -> DataFrame:
    """DA6: products without an English category by stored category."""
    return (
        m.products.where("product_category_name_english = 'unknown'")
        .groupBy("product_category_name")
        .agg(_rows().alias("products_count"))
        .orderBy(F.desc("products_count"), F.asc_nulls_last("product_category_name"))
    )


def unknown_category_count(m: Market) -> DataFrame:
    return m.products.agg(
        F.count_if(F.col("product_category_name_english") == "unknown").alias("unknown_products")
    )


def missing_coordinates(m: Market) -> DataFrame:
    """DA7."""
    places = ["customer_latitude", "customer_longitude"], ["seller_latitude", "seller_longitude"]
    return stacked(
        [missing_counts(m.orders_enriched, places[0]), missing_counts(m.order_items_enriched, places[1])]
    )


def negative_durations(m: Market) -> DataFrame:
    """DA8."""
    return m.orders_core.agg(
        F.count_if(F.col("approval_time_hours") < 0).alias("negative_approval_times"),
        F.count_if(F.col("processing_time_days") < 0).alias("negative_processing_times"),
        F.count_if(F.col("delivery_time_days") < 0).alias("negative_delivery_times"),
    )


def delay_flag_consistency(m: Market) -> DataFrame:
    """DA9: the flag must be known exactly when the delivery date is."""
    arrived, flagged = F.col("order_delivered_customer_date").isNotNull(), F.col("is_delayed").isNotNull()
    return m.orders_core.agg(
        F.count_if(flagged & ~arrived).alias("undelivered_orders_with_delay_flag"),
        F.count_if(arrived & ~flagged).alias("delivered_orders_without_delay_flag"),
    )


def inconsistent_counts(m: Market) -> DataFrame:
    """DA10."""
    counts = ["items_count", "unique_products_count", "sellers_count", "payments_count", "reviews_count"]
    return m.order_metrics.agg(
        F.count_if(F.least(*counts) < 0).alias("invalid_counts"),
        F.count_if(F.col("unique_products_count") > F.col("items_count")).alias("inconsistent_unique_products"),
        F.count_if(F.col("sellers_count") > F.col("items_count")).alias("inconsistent_seller_counts"),
    )


def negative_money(m: Market) -> DataFrame:
    """DA11."""
    lowest = F.least("products_value", "freight_value", "order_items_value", "payment_value")
    return m.order_metrics.agg(F.count_if(lowest < 0).alias("negative_order_values"))


def item_total_mismatches(m: Market) -> DataFrame:
    """DA12."""
    gap = F.abs(F.col("order_items_value") - F.col("products_value") - F.col("freight_value"))
    return m.order_metrics.agg(F.count_if(gap > F.lit(CENT).cast("decimal(3,2)")).alias("inconsistent_item_totals"))


def orders_without_children(m: Market) -> DataFrame:
    """DA13."""
    return m.order_metrics.agg(
        *[F.count_if(F.col(f"{c}_count") == 0).alias(f"orders_without_{c}") for c in ("items", "payments", "reviews")]
    )


def _unreconciled(m: Market) -> DataFrame:
    difference = F.col("payment_value") - F.col("order_items_value")
    return m.order_metrics.select("order_id", "order_items_value", "payment_value", difference.alias("difference")).where(
        F.abs("difference") > F.lit(CENT).cast("decimal(3,2)")
    )


def mismatched_payments(m: Market) -> DataFrame:
    """DA14: number of orders whose payments differ from their items."""
    return _unreconciled(m).agg(_rows().alias("mismatched_orders"))


def largest_payment_mismatches(m: Market, size: int = 20) -> DataFrame:
    return _unreconciled(m).orderBy(F.desc(F.abs("difference")), "order_id").limit(size)


def score_range(m: Market) -> DataFrame:
    """DA15."""
    score = F.col("average_review_score")
    return m.order_metrics.agg(
        F.min(score).alias("min_average_review_score"),
        F.max(score).alias("max_average_review_score"),
        F.count_if((score < 1) | (score > 5)).alias("invalid_average_review_scores"),
    )


CHECKS: dict[str, Callable[[Market], DataFrame]] = {
    "dq1_raw_row_counts": raw_row_counts,
    "dq2_key_uniqueness": key_uniqueness,
    "dq3_geolocation_size": geolocation_size,
    "dq4_orphan_rows": orphan_rows,
    "dq5_missing_order_dates": lambda m: missing_values(m, "orders"),
    "dq6_missing_product_attributes": lambda m: missing_values(m, "products"),
    "dq7_missing_review_fields": lambda m: missing_values(m, "reviews"),
    "dq8_blank_texts": blank_texts,
    "dq9_order_status": lambda m: distribution(m, "orders", "order_status"),
    "dq9_review_score": lambda m: distribution(m, "reviews", "review_score", by_count=False),
    "dq9_payment_type": lambda m: distribution(m, "payments", "payment_type"),
    "dq10_value_ranges": value_ranges,
    "dq11_untranslated_categories": untranslated_categories,
    "dq12_customers_with_many_ids": customers_with_many_ids,
    "dq13_geolocation_duplicates": geolocation_duplicates,
    "dq14_constraint_violations": constraint_violations,
    "dq15_preserved_row_counts": preserved_row_counts,
    "da1_view_row_counts": view_row_counts,
    "da2_view_keys": view_keys,
    "da3_duplicate_view_keys": duplicate_view_keys,
    "da4_row_preservation": row_preservation,
    "da5_lost_dimensions": lost_dimensions,
    "da6_unknown_categories": unknown_categories,
    "da6_unknown_category_count": unknown_category_count,
    "da7_missing_coordinates": missing_coordinates,
    "da8_negative_durations": negative_durations,
    "da9_delay_flag_consistency": delay_flag_consistency,
    "da10_inconsistent_counts": inconsistent_counts,
    "da11_negative_money": negative_money,
    "da12_item_total_mismatches": item_total_mismatches,
    "da13_orders_without_children": orders_without_children,
    "da14_mismatched_payments": mismatched_payments,
    "da14_largest_payment_mismatches": largest_payment_mismatches,
    "da15_score_range": score_range,
}
