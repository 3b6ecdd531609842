"""DuckDB oracles for the integrity checks, the ingest round trips and the dashboard roll-ups."""

from __future__ import annotations

from mercato.oracles.base import r6, sql
from mercato.oracles.marts import MARTS

TABLES = {
    "category_translation": ["product_category_name", "product_category_name_english"],
    "customers": ["customer_id", "customer_unique_id"],
    "sellers": ["seller_id"],
    "products": ["product_id"],
    "orders": ["order_id", "customer_id"],
    "order_items": ["order_id, order_item_id"],
    "payments": ["order_id, payment_sequential"],
    "reviews": ["review_id, order_id"],
    "geolocation": [],
}
LINKS = [
    ("orders", "customer_id", "customers"),
    ("order_items", "order_id", "orders"),
    ("order_items", "product_id", "products"),
    ("order_items", "seller_id", "sellers"),
    ("payments", "order_id", "orders"),
    ("reviews", "order_id", "orders"),
]
VIEWS = {
    "geolocation": ("v_geo", "zip_code_prefix"),
    "order_items_enriched": ("v_items", "order_id, order_item_id"),
    "order_metrics": ("v_metrics", "order_id"),
    "orders_enriched": ("v_orders", "order_id"),
    "products": ("v_products", "product_id"),
}
KEPT = {
    "products": "raw_products",
    "orders_enriched": "raw_orders",
    "order_items_enriched": "raw_order_items",
    "order_metrics": "raw_orders",
}
ALL = "\nUNION ALL\n"


def keys(label: str, name: str, source: str, key: str) -> str:
    return f"""SELECT '{name}' AS {label}, '{key.replace(', ', '+')}' AS "key",
        (SELECT COUNT(*) FROM {source}) AS total_rows,
        (SELECT COUNT(*) FROM (SELECT DISTINCT {key} FROM {source})) AS distinct_keys"""


def nulls(source: str, columns: list[str]) -> str:
    return ALL.join(
        f"SELECT '{c}' AS variable, COUNT(*) - COUNT({c}) AS missing_count FROM {source}" for c in columns
    )


def orphan(child: str, column: str, parent: str) -> str:
    return f"(SELECT COUNT(*) FROM raw_{child} WHERE {column} NOT IN (SELECT {column} FROM raw_{parent}))"


def ends(column: str, source: str) -> str:
    return f"""SELECT '{column}' AS "column", CAST(MIN({column}) AS DOUBLE) AS min_value,
        CAST(MAX({column}) AS DOUBLE) AS max_value FROM {source}"""


def how_many(source: str, **conditions: str) -> str:
    counted = ", ".join(f"COUNT(CASE WHEN {c} THEN 1 END) AS {name}" for name, c in conditions.items())
    return sql(f"SELECT {counted} FROM {source}")


REQUIRED = {
    "category_translation": ["product_category_name", "product_category_name_english"],
    "customers": [
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    ],
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    "products": ["product_id"],
    "orders": [
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_estimated_delivery_date",
    ],
    "order_items": ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"],
    "payments": ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
    "reviews": ["review_id", "order_id", "review_score", "review_creation_date", "review_answer_timestamp"],
    "geolocation": [
        "geolocation_zip_code_prefix",
        "geolocation_lat",
        "geolocation_lng",
        "geolocation_city",
        "geolocation_state",
    ],
}
RULES = [
    ("order_items", "price_non_negative", "price < 0"),
    ("order_items", "freight_non_negative", "freight_value < 0"),
    ("payments", "installments_non_negative", "payment_installments < 0"),
    ("payments", "payment_value_non_negative", "payment_value < 0"),
    ("reviews", "score_between_1_and_5", "review_score NOT BETWEEN 1 AND 5"),
]


def violations() -> str:
    parts = [
        f"SELECT '{t}' AS table_name, 'not_null:{c}' AS rule, COUNT(*) - COUNT({c}) AS violations FROM raw_{t}"
        for t, columns in REQUIRED.items()
        for c in columns
    ]
    parts += [
        f"SELECT '{t}', '{rule}', COUNT(CASE WHEN {bad} THEN 1 END) FROM raw_{t}" for t, rule, bad in RULES
    ]
    parts += [
        f"SELECT table_name, 'unique:' || \"key\", total_rows - distinct_keys FROM ({keys('table_name', t, f'raw_{t}', ks[0])})"
        for t, ks in TABLES.items()
        if ks
    ]
    parts += [f"SELECT '{c}', 'references:{k}', {orphan(c, k, p)}" for c, k, p in LINKS]
    return ALL.join(parts)


GAP = "ABS(payment_value - order_items_value) > 0.01"
MISMATCH = f"""SELECT order_id, CAST(order_items_value AS DOUBLE) AS order_items_value,
    CAST(payment_value AS DOUBLE) AS payment_value, CAST(payment_value - order_items_value AS DOUBLE) AS difference
    FROM v_metrics WHERE {GAP} ORDER BY ABS(v_metrics.payment_value - v_metrics.order_items_value) DESC, order_id LIMIT 20"""
COUNTED = ["items_count", "unique_products_count", "sellers_count", "payments_count", "reviews_count"]
MONEY = ["products_value", "freight_value", "order_items_value", "payment_value"]
PRESERVED = ALL.join(
    f"SELECT '{v}' AS view_name, (SELECT COUNT(*) FROM {r}) AS expected_count, (SELECT COUNT(*) FROM {VIEWS[v][0]}) AS actual_count"
    for v, r in KEPT.items()
)

SINCE = "WHERE month >= DATE '1995-02-01'"
RATES = ["average_order_value", "average_review_score", "delayed_order_rate_percent", "average_delivery_time_days"]


def rolled(mart: str, maxes=(), sums=(), means=(), by: str = "", where: str = "") -> str:
    columns = [f"MAX({c}) AS {c}" for c in maxes]
    columns += [
        f"{'CAST(SUM(%s) AS BIGINT)' % c if 'gmv' not in c and 'value' not in c else r6(f'SUM({c})')} AS {c}" for c in sums
    ]
    columns += [f"{r6(f'AVG({c})')} AS {c}" for c in means]
    if by:
        columns.insert(0, by)
    return sql(f"SELECT {', '.join(columns)} FROM ({MARTS[mart]}) {where} {'GROUP BY 1' if by else ''}")


def ranked(mart: str, label: str, measure: str, at_least: int = 0) -> str:
    shown = f"{label}, delivered_orders" + ("" if measure == "delivered_orders" else f", {measure}")
    return sql(
        f"SELECT {shown} FROM ({MARTS[mart]}) WHERE delivered_orders >= {at_least} ORDER BY {measure} DESC, {label} LIMIT 10"
    )


INGESTED = {
    "category_translation": "*",
    "customers": "*",
    "sellers": "*",
    "products": "* REPLACE (NULLIF(product_category_name, '') AS product_category_name)",
    "orders": "*",
    "order_items": "* REPLACE (CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value)",
    "payments": "* REPLACE (CAST(payment_value AS DOUBLE) AS payment_value)",
    "reviews": "*",
    "geolocation": """* REPLACE (ROUND(CAST(geolocation_lat AS DOUBLE), 6) AS geolocation_lat,
        ROUND(CAST(geolocation_lng AS DOUBLE), 6) AS geolocation_lng)""",
}

ORACLES = {
    "dq1_raw_row_counts": sql(
        ALL.join(f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM raw_{t}" for t in TABLES)
    ),
    "dq2_key_uniqueness": sql(
        ALL.join(keys("table_name", t, f"raw_{t}", k) for t, ks in TABLES.items() for k in ks)
    ),
    "dq3_geolocation_size": sql(
        """SELECT COUNT(*) AS total_rows, COUNT(DISTINCT geolocation_zip_code_prefix) AS unique_zip_code_prefixes
        FROM raw_geolocation"""
    ),
    "dq4_orphan_rows": sql(
        ALL.join(
            f"SELECT '{c}' AS child, '{k}' AS \"column\", '{p}' AS parent, {orphan(c, k, p)} AS orphans" for c, k, p in LINKS
        )
    ),
    "dq5_missing_order_dates": sql(
        nulls("raw_orders", ["order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date"])
    ),
    "dq6_missing_product_attributes": sql(
        nulls(
            "raw_products",
            ["product_category_name", "product_name_lenght", "product_description_lenght", "product_photos_qty",
             "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"],
        )
    ),
    "dq7_missing_review_fields": sql(
        nulls(
            "raw_reviews",
            ["review_comment_title", "review_comment_message", "review_creation_date", "review_answer_timestamp"],
        )
    ),
    "dq8_blank_texts": sql(
        ALL.join(
            f"SELECT '{c}' AS \"column\", COUNT(CASE WHEN TRIM({c}) = '' THEN 1 END) AS blank_count FROM raw_{t}"
            for t, c in [
                ("products", "product_category_name"),
                ("reviews", "review_comment_title"),
                ("reviews", "review_comment_message"),
            ]
        )
    ),
    "dq9_order_status": sql("SELECT order_status, COUNT(*) AS rows_count FROM raw_orders GROUP BY 1"),
    "dq9_review_score": sql("SELECT review_score, COUNT(*) AS rows_count FROM raw_reviews GROUP BY 1"),
    "dq9_payment_type": sql("SELECT payment_type, COUNT(*) AS rows_count FROM raw_payments GROUP BY 1"),
    "dq10_value_ranges": sql(
        ALL.join(
            [ends(c, "raw_order_items") for c in ("price", "freight_value")]
            + [ends(c, "raw_payments") for c in ("payment_installments", "payment_value")]
        )
    ),
    "dq11_untranslated_categories": sql(
        """SELECT DISTINCT product_category_name FROM raw_products WHERE product_category_name IS NOT NULL
        AND product_category_name NOT IN (SELECT product_category_name FROM raw_category_translation)"""
    ),
    "dq12_customers_with_many_ids": sql(
        """SELECT * FROM (SELECT customer_unique_id, COUNT(*) AS customer_id_count FROM raw_customers GROUP BY 1)
        WHERE customer_id_count > 1 ORDER BY 2 DESC, 1 LIMIT 10"""
    ),
    "dq13_geolocation_duplicates": sql(
        """SELECT (SELECT COUNT(*) FROM raw_geolocation) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM raw_geolocation))
        AS duplicate_rows"""
    ),
    "dq14_constraint_violations": sql(violations()),
    "dq15_preserved_row_counts": sql(f"SELECT *, expected_count = actual_count AS matches FROM ({PRESERVED})"),
    "da1_view_row_counts": sql(
        ALL.join(f"SELECT '{n}' AS view_name, COUNT(*) AS row_count FROM {v}" for n, (v, _) in VIEWS.items())
    ),
    "da2_view_keys": sql(ALL.join(keys("view_name", n, v, k) for n, (v, k) in VIEWS.items())),
    "da3_duplicate_view_keys": sql(
        ALL.join(
            f"""SELECT '{n}' AS view_name, CONCAT_WS('+', {k}) AS key_value, COUNT(*) AS rows_count
            FROM {v} GROUP BY {k} HAVING COUNT(*) > 1"""
            for n, (v, k) in VIEWS.items()
        )
    ),
    "da4_row_preservation": sql(
        f"SELECT view_name, actual_count - expected_count AS row_difference FROM ({PRESERVED})"
    ),
    "da5_lost_dimensions": sql(
        """SELECT (SELECT COUNT(*) - COUNT(customer_unique_id) FROM v_orders) AS orders_without_customer,
        COUNT(*) - COUNT(product_id) AS items_without_product, COUNT(*) - COUNT(seller_id) AS items_without_seller
        FROM v_items"""
    ),
    "da6_unknown_categories": sql(
        """SELECT product_category_name, COUNT(*) AS products_count FROM v_products
        WHERE product_category_name_english = 'unknown' GROUP BY 1"""
    ),
    "da6_unknown_category_count": how_many("v_products", unknown_products="product_category_name_english = 'unknown'"),
    "da7_missing_coordinates": sql(
        nulls("v_orders", ["customer_latitude", "customer_longitude"])
        + ALL
        + nulls("v_items", ["seller_latitude", "seller_longitude"])
    ),
    "da8_negative_durations": how_many(
        "v_orders",
        negative_approval_times="approval_time_hours < 0",
        negative_processing_times="processing_time_days < 0",
        negative_delivery_times="delivery_time_days < 0",
    ),
    "da9_delay_flag_consistency": how_many(
        "v_orders",
        undelivered_orders_with_delay_flag="order_delivered_customer_date IS NULL AND is_delayed IS NOT NULL",
        delivered_orders_without_delay_flag="order_delivered_customer_date IS NOT NULL AND is_delayed IS NULL",
    ),
    "da10_inconsistent_counts": how_many(
        "v_metrics",
        invalid_counts=" OR ".join(f"{c} < 0" for c in COUNTED),
        inconsistent_unique_products="unique_products_count > items_count",
        inconsistent_seller_counts="sellers_count > items_count",
    ),
    "da11_negative_money": how_many("v_metrics", negative_order_values=" OR ".join(f"{c} < 0" for c in MONEY)),
    "da12_item_total_mismatches": how_many(
        "v_metrics", inconsistent_item_totals="ABS(products_value + freight_value - order_items_value) > 0.01"
    ),
    "da13_orders_without_children": how_many(
        "v_metrics", **{f"orders_without_{c}": f"{c}_count = 0" for c in ("items", "payments", "reviews")}
    ),
    "da14_mismatched_payments": how_many("v_metrics", mismatched_orders=GAP),
    "da14_largest_payment_mismatches": sql(MISMATCH),
    "da15_score_range": sql(
        """SELECT CAST(MIN(average_review_score) AS DOUBLE) AS min_average_review_score,
        CAST(MAX(average_review_score) AS DOUBLE) AS max_average_review_score,
        COUNT(CASE WHEN average_review_score NOT BETWEEN 1 AND 5 THEN 1 END) AS invalid_average_review_scores FROM v_metrics"""
    ),
    **{f"ingest_{t}": sql(f"SELECT {columns} FROM raw_{t}") for t, columns in INGESTED.items()},
    "src5_quarantined_payments": sql(
        """SELECT order_id, "column", value, 'not a value of type ' || type AS reason, COUNT(*) AS rows_count FROM bad
        GROUP BY ALL
        UNION ALL SELECT NULL, '*', NULL, 'loaded', COUNT(*) FROM spoilt WHERE line NOT IN (SELECT line FROM bad)""",
        spoilt="""SELECT ROW_NUMBER() OVER () AS line, order_id,
            CASE order_id % 23 WHEN 1 THEN v || 'x' WHEN 2 THEN v || '7' ELSE v END AS payment_value,
            CASE WHEN order_id % 37 = 5 THEN ' ' WHEN order_id % 29 = 3 THEN '2.5'
                 ELSE payment_installments::VARCHAR END AS payment_installments,
            CASE WHEN order_id % 31 = 4 THEN 'one' ELSE payment_sequential::VARCHAR END AS payment_sequential
            FROM (SELECT *, payment_value::DECIMAL(12,2)::VARCHAR AS v FROM raw_payments)""",
        bad="""SELECT line, order_id, 'payment_value' AS "column", payment_value AS value, 'decimal(12,2)' AS type FROM spoilt
            WHERE TRY_CAST(payment_value AS DECIMAL(38,18)) IS DISTINCT FROM TRY_CAST(payment_value AS DECIMAL(12,2))
               OR TRY_CAST(payment_value AS DOUBLE) IS NULL
            UNION ALL SELECT line, order_id, 'payment_installments', payment_installments, 'int' FROM spoilt
            WHERE TRIM(payment_installments) <> '' AND NOT COALESCE(TRY_CAST(payment_installments AS DOUBLE) % 1 = 0, FALSE)
            UNION ALL SELECT line, order_id, 'payment_sequential', payment_sequential, 'int' FROM spoilt
            WHERE NOT COALESCE(TRY_CAST(payment_sequential AS DOUBLE) % 1 = 0, FALSE)""",
    ),
    "src9_bucketed_orders": sql(
        """SELECT order_status, COUNT(*) AS orders_count, CAST(SUM(n) AS BIGINT) AS items_count,
        CAST(SUM(k) AS BIGINT) AS payments_count, CAST(SUM(price) AS DOUBLE) AS products_value
        FROM raw_orders LEFT JOIN (SELECT order_id, COUNT(*) AS n, SUM(price) AS price FROM raw_order_items GROUP BY 1) USING (order_id)
        LEFT JOIN (SELECT order_id, COUNT(*) AS k FROM raw_payments GROUP BY 1) USING (order_id) GROUP BY 1"""
    ),
    "dq15_refused_row_counts": sql(
        """SELECT ROW_NUMBER() OVER (ORDER BY t) AS position,
        t || ': expected ' || format('{:,}', (SELECT COUNT(*) FROM raw_orders)) || ', found ' || n AS line
        FROM counted WHERE n <> (SELECT COUNT(*) FROM raw_orders)""",
        counted=ALL.join(f"SELECT '{t}' AS t, COUNT(*) AS n FROM raw_{t}" for t in TABLES),
    ),
    "src6_reload_counts": sql(
        ALL.join(f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM raw_{t}" for t in TABLES)
    ),
    "src8_sql_scan": sql(
        """SELECT order_status, COUNT(*) AS orders_count, CAST(SUM(items_count) AS BIGINT) AS items_count
        FROM v_metrics GROUP BY 1"""
    ),
    "src10_exported_marts": sql(
        ALL.join(f"SELECT '{name}' AS mart, COUNT(*) AS row_count FROM ({text})" for name, text in MARTS.items())
    ),
    "m9_executive_cards": rolled(
        "executive_metrics", maxes=["gmv", "delivered_orders", "unique_customers"], means=RATES
    ),
    "m9_monthly_rollup": rolled("monthly_metrics", sums=["gmv", "delivered_orders"], means=RATES, where=SINCE),
    "m9_customer_rollup": rolled(
        "customer_metrics",
        sums=["active_customers", "new_customers", "repeat_customers", "delivered_orders"],
        means=["repeat_customer_share_percent", "orders_per_active_customer"],
        where=SINCE,
    ),
    "m9_retention_by_index": rolled(
        "cohort_retention", sums=["active_customers"], means=["retention_rate_percent"], by="cohort_index"
    ),
    "m9_segment_rollup": rolled(
        "rfm_segments",
        sums=["customers_count", "monetary_value"],
        means=["average_recency_days", "average_frequency", "average_monetary_value"],
        by="rfm_segment",
    ),
    "m9_delivery_by_status": rolled(
        "delivery_metrics",
        sums=["delivered_orders"],
        means=["average_delivery_time_days", "average_review_score", "low_review_rate_percent"],
        by="CASE WHEN is_delayed THEN 'Delayed' ELSE 'On Time' END AS delivery_status",
        where=f"{SINCE} AND is_delayed IS NOT NULL",
    ),
    "m9_top_categories_by_sales": ranked("category_metrics", "product_category", "products_value"),
    "m9_top_categories_by_orders": ranked("category_metrics", "product_category", "delivered_orders"),
    "m9_top_rated_categories": ranked("category_metrics", "product_category", "average_review_score", 100),
    "m9_top_states_by_gmv": ranked("state_metrics", "customer_state", "gmv"),
    "m9_most_delayed_states": ranked("state_metrics", "customer_state", "delayed_order_rate_percent", 100),
    "m9_slowest_states": ranked("state_metrics", "customer_state", "average_delivery_time_days", 100),
}
