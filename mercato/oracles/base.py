"""DuckDB text shared by all oracles: raw tables, views and the exact-arithmetic idioms."""

from __future__ import annotations

import re


def rnd(expr: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(24,9)), {digits}) AS DOUBLE)"


def r6(expr: str) -> str:
    return rnd(expr, 6)


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def avg(x: str) -> str:
    return div(f"SUM({x})", f"COUNT({x})")


def pct(flag: str) -> str:
    return f"({div(f'SUM(CAST({flag} AS INT))', f'COUNT({flag})')} * 100)"


def share(cond: str) -> str:
    return f"({div(f'SUM(CASE WHEN {cond} THEN 1 ELSE 0 END)', 'COUNT(*)')} * 100)"


def avg_days(x: str) -> str:
    micros = f"CAST(ROUND({x} * 86400000000.0) AS HUGEINT)"
    return f"({div(f'SUM({micros})', f'COUNT({x})')} / 86400000000.0)"


def money(x: str) -> str:
    return f"CAST(SUM({x}) AS DOUBLE)"


def quant(x: str, p: float) -> str:
    return f"QUANTILE_CONT(CAST({x} AS DOUBLE), {p})"


def _shift(ts: str, d: str, h: str) -> str:
    return f"({ts} + to_days(CAST({d} AS INT)) + to_hours(CAST({h} AS INT)))"


def _days(a: str, b: str) -> str:
    return f"CAST(epoch_us({a}) - epoch_us({b}) AS DOUBLE) / 86400000000.0"


RAW = {
    "raw_customers": """
        SELECT o_orderkey AS customer_id, o_custkey AS customer_unique_id, c_nationkey AS customer_zip_code_prefix,
               c_mktsegment AS customer_city, n_name AS customer_state
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "raw_orders": f"""
        SELECT o_orderkey AS order_id, o_orderkey AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'canceled' END AS order_status,
               {_shift('o_orderdate', '0', 'o_orderkey % 24')} AS order_purchase_timestamp,
               CASE WHEN o_orderkey % 50 = 7 THEN NULL
                    ELSE {_shift('o_orderdate', 'o_orderkey % 2', '24 + o_orderkey % 7')} END AS order_approved_at,
               CASE WHEN o_orderstatus = 'P' OR o_orderkey % 50 = 7 THEN NULL
                    ELSE {_shift('o_orderdate', '3 + o_orderkey % 5', 'o_orderkey % 11')} END AS order_delivered_carrier_date,
               CASE WHEN o_orderstatus = 'F' AND o_orderkey % 97 <> 5
                    THEN {_shift('o_orderdate', '5 + (o_orderkey * 7) % 31', '24 + o_orderkey % 13')}
                    END AS order_delivered_customer_date,
               {_shift('o_orderdate', '18 + o_orderkey % 11', '0')} AS order_estimated_delivery_date
        FROM orders""",
    "raw_lines": """
        SELECT l_orderkey AS order_id,
               CAST(ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate,
                    l_extendedprice, l_quantity, l_tax) AS INT) AS order_item_id,
               l_partkey AS product_id, l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
               CAST(l_extendedprice AS DECIMAL(10,2)) AS price,
               CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(10,2)) AS freight_value,
               l_quantity, l_returnflag, l_linestatus, l_linenumber
        FROM lineitem""",
    "raw_order_items": """
        SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value FROM raw_lines""",
    "raw_payments": """
        SELECT order_id, order_item_id AS payment_sequential,
               CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto' ELSE 'voucher' END AS payment_type,
               1 + l_linenumber AS payment_installments,
               CAST(CASE WHEN order_id % 29 = 0 THEN price ELSE price + freight_value END AS DECIMAL(12,2)) AS payment_value
        FROM raw_lines WHERE order_id % 101 <> 4""",
    "raw_reviews": f"""
        SELECT i.order_id * 10 + i.order_item_id AS review_id, i.order_id,
               CAST(CASE WHEN o.order_delivered_customer_date > o.order_estimated_delivery_date
                         THEN GREATEST(1, CEIL(i.l_quantity / 10) - 2) ELSE CEIL(i.l_quantity / 10) END AS INT) AS review_score,
               CASE WHEN i.l_returnflag = 'R' THEN 'title' END AS review_comment_title,
               CASE WHEN i.l_linestatus = 'F' THEN 'message' END AS review_comment_message,
               {_shift('o.order_estimated_delivery_date', '1', '0')} AS review_creation_date,
               {_shift('o.order_estimated_delivery_date', '3', '5')} AS review_answer_timestamp
        FROM raw_lines i JOIN raw_orders o ON i.order_id = o.order_id
        WHERE i.order_item_id <= 2 AND i.order_id % 11 <> 3""",
    "raw_products": """
        SELECT p_partkey AS product_id,
               CASE WHEN p_partkey % 50 = 0 THEN NULL WHEN p_partkey % 50 = 1 THEN '' ELSE p_type END AS product_category_name,
               LENGTH(p_name) AS product_name_lenght, p_size * 10 AS product_description_lenght,
               p_size % 7 AS product_photos_qty,
               CASE WHEN p_partkey % 40 = 3 THEN NULL ELSE p_size * 100 END AS product_weight_g,
               p_size AS product_length_cm, p_size AS product_height_cm, p_size AS product_width_cm
        FROM part""",
    "raw_category_translation": """
        SELECT DISTINCT p_type AS product_category_name, LOWER(p_type) AS product_category_name_english
        FROM part WHERE p_type <> 'STANDARD'""",
    "raw_sellers": """
        SELECT s_suppkey AS seller_id, s_nationkey AS seller_zip_code_prefix, n_name AS seller_city, n_name AS seller_state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "raw_geolocation": """
        SELECT c_nationkey AS geolocation_zip_code_prefix,
               CAST(CAST(c_acctbal AS DECIMAL(10,2)) / 1000 AS DECIMAL(10,7)) AS geolocation_lat,
               CAST(CAST(c_acctbal AS DECIMAL(10,2)) / -500 AS DECIMAL(10,7)) AS geolocation_lng,
               c_mktsegment AS geolocation_city, n_name AS geolocation_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_nationkey <> 24""",
}

VIEWS = {
    "v_products": """
        SELECT s.product_id,
               CASE WHEN TRIM(s.product_category_name) <> '' THEN TRIM(s.product_category_name) END AS product_category_name,
               CASE WHEN k.product_category_name_english IS NULL THEN 'unknown'
                    ELSE k.product_category_name_english END AS product_category_name_english,
               s.product_name_lenght AS product_name_length, s.product_description_lenght AS product_description_length,
               s.product_photos_qty, s.product_weight_g, s.product_length_cm, s.product_height_cm, s.product_width_cm
        FROM raw_products s LEFT JOIN raw_category_translation k USING (product_category_name)""",
    "v_geo": f"""
        SELECT z.zip_code_prefix, z.latitude, z.longitude, w.city, w.state
        FROM (SELECT geolocation_zip_code_prefix AS zip_code_prefix, {quant('geolocation_lat', 0.5)} AS latitude,
                     {quant('geolocation_lng', 0.5)} AS longitude
              FROM raw_geolocation GROUP BY 1) z
        JOIN (SELECT zip_code_prefix, city, state
              FROM (SELECT geolocation_zip_code_prefix AS zip_code_prefix, geolocation_city AS city,
                           geolocation_state AS state, COUNT(*) AS hits
                    FROM raw_geolocation GROUP BY 1, 2, 3)
              QUALIFY ROW_NUMBER() OVER (PARTITION BY zip_code_prefix ORDER BY hits DESC, city, state) = 1) w
        USING (zip_code_prefix)""",
    "v_orders": f"""
        SELECT b.order_id, b.customer_id, p.customer_unique_id, b.order_status, b.order_purchase_timestamp,
               b.order_approved_at, b.order_delivered_carrier_date, b.order_delivered_customer_date,
               b.order_estimated_delivery_date, CAST(DATE_TRUNC('month', b.order_purchase_timestamp) AS DATE) AS order_month,
               p.customer_zip_code_prefix, p.customer_city, p.customer_state,
               z.latitude AS customer_latitude, z.longitude AS customer_longitude,
               CAST(epoch_us(b.order_approved_at) - epoch_us(b.order_purchase_timestamp) AS DOUBLE) / 3600000000.0
                   AS approval_time_hours,
               {_days('b.order_delivered_carrier_date', 'b.order_approved_at')} AS processing_time_days,
               {_days('b.order_delivered_customer_date', 'b.order_purchase_timestamp')} AS delivery_time_days,
               b.order_delivered_customer_date > b.order_estimated_delivery_date AS is_delayed,
               {_days('b.order_delivered_customer_date', 'b.order_estimated_delivery_date')} AS delivery_delay_days
        FROM raw_orders b JOIN raw_customers p USING (customer_id)
        LEFT JOIN v_geo z ON z.zip_code_prefix = p.customer_zip_code_prefix""",
    "v_items": """
        SELECT x.order_id, x.order_item_id, x.product_id, x.seller_id, x.shipping_limit_date, x.price, x.freight_value,
               x.price + x.freight_value AS item_total_value, t.* EXCLUDE (product_id),
               y.seller_zip_code_prefix, y.seller_city, y.seller_state,
               z.latitude AS seller_latitude, z.longitude AS seller_longitude
        FROM raw_order_items x JOIN v_products t USING (product_id) JOIN raw_sellers y USING (seller_id)
        LEFT JOIN v_geo z ON z.zip_code_prefix = y.seller_zip_code_prefix""",
    "v_metrics": f"""
        SELECT b.order_id, b.customer_id, b.customer_unique_id, b.order_status, b.order_purchase_timestamp, b.order_month,
               b.customer_city, b.customer_state, b.delivery_time_days, b.is_delayed, b.delivery_delay_days,
               IFNULL(x.n, 0) AS items_count, IFNULL(x.np, 0) AS unique_products_count, IFNULL(x.ns, 0) AS sellers_count,
               x.pv AS products_value, x.fv AS freight_value, x.tv AS order_items_value,
               IFNULL(y.n, 0) AS payments_count, y.v AS payment_value, y.k AS max_payment_installments,
               z.s AS average_review_score, IFNULL(z.n, 0) AS reviews_count,
               IFNULL(z.ht, FALSE) AS has_review_title, IFNULL(z.hm, FALSE) AS has_review_message
        FROM v_orders b
        LEFT JOIN (SELECT order_id, COUNT(*) AS n, COUNT(DISTINCT product_id) AS np, COUNT(DISTINCT seller_id) AS ns,
                          SUM(price) AS pv, SUM(freight_value) AS fv, SUM(price + freight_value) AS tv
                   FROM raw_order_items GROUP BY 1) x USING (order_id)
        LEFT JOIN (SELECT order_id, COUNT(*) AS n, SUM(payment_value) AS v, MAX(payment_installments) AS k
                   FROM raw_payments GROUP BY 1) y USING (order_id)
        LEFT JOIN (SELECT order_id, COUNT(*) AS n,
                          CAST(ROUND(CAST({avg('review_score')} AS DECIMAL(24,9)), 2) AS DECIMAL(4,2)) AS s,
                          BOOL_OR(review_comment_title IS NOT NULL) AS ht, BOOL_OR(review_comment_message IS NOT NULL) AS hm
                   FROM raw_reviews GROUP BY 1) z USING (order_id)""",
    "done": "SELECT * FROM v_metrics WHERE order_status = 'delivered'",
}

COMMON = {**RAW, **VIEWS}


def sql(body: str, **extra: str) -> str:
    """``body`` with exactly the common table expressions it needs in front of it."""
    known = {**COMMON, **extra}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, definition in known.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(definition)
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    ctes = ",\n".join(f"{name} AS ({known[name]})" for name in needed)
    return f"WITH {ctes}\n{body}"
