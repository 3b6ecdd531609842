"""DuckDB oracles for the exploratory queries, product metrics, cohorts and RFM frames."""

from __future__ import annotations

from mercato.oracles.base import avg, avg_days, div, money, quant, r6, rnd, share, sql
from mercato.oracles.marts import CUSTOMER_MONTHS, MONTH_GAP, SEGMENT, customer_frame

FIRST, LAST = "DATE '1995-02-01'", "DATE '2001-07-01'"
VALUED = "(SELECT * FROM done WHERE order_items_value IS NOT NULL)"
ARRIVED = "(SELECT * FROM done WHERE delivery_time_days IS NOT NULL)"


def described(source: str, columns: list[str], percentiles: list[int]) -> str:
    parts = []
    for c in columns:
        x = f"CAST({c} AS DOUBLE)"
        cuts = ", ".join(f"{r6(quant(c, p / 100))} AS p{p:02d}" for p in percentiles)
        parts.append(
            f"""SELECT '{c}' AS variable, COUNT({c}) AS "count", {r6(f'AVG({x})')} AS mean,
            {r6(f'STDDEV_SAMP({x})')} AS std, {r6(f'MIN({x})')} AS "min", {cuts}, {r6(f'MAX({x})')} AS "max"
            FROM {source}"""
        )
    return "\nUNION ALL\n".join(parts)


def histogram(source: str, column: str, bins: int = 50) -> str:
    x = f"CAST({column} AS DOUBLE)"
    return f"""
    SELECT b.bin, {r6('s.lo + (s.hi - s.lo) / %d * b.bin' % bins)} AS bin_start,
           {r6('s.lo + (s.hi - s.lo) / %d * (b.bin + 1)' % bins)} AS bin_end, IFNULL(h.n, 0) AS "count"
    FROM (SELECT UNNEST(RANGE({bins})) AS bin) b
    CROSS JOIN (SELECT MIN(x) AS lo, MAX(x) AS hi FROM kept) s
    LEFT JOIN (SELECT LEAST(CAST(FLOOR((x - lo) / (hi - lo) * {bins}) AS BIGINT), {bins - 1}) AS bin, COUNT(*) AS n
               FROM kept, (SELECT MIN(x) AS lo, MAX(x) AS hi FROM kept) GROUP BY 1) h USING (bin)""", {
        "kept": f"SELECT {x} AS x FROM {source} WHERE {x} <= (SELECT {quant(column, 0.99)} FROM {source})"
    }


def hist(source: str, column: str) -> str:
    body, extra = histogram(source, column)
    return sql(body, **extra)


def part(n: str, over: str = "") -> str:
    return f"{div(n, f'SUM({n}) OVER ({over})')} * 100"


GAPS = """COUNT(*) - COUNT(order_approved_at) AS missing_approved_at,
    COUNT(*) - COUNT(order_delivered_carrier_date) AS missing_carrier_date,
    COUNT(*) - COUNT(order_delivered_customer_date) AS missing_customer_date,
    COUNT(*) - COUNT(payment_value) AS missing_payment_value,
    COUNT(*) - COUNT(average_review_score) AS missing_review_score"""
WIDE = """(SELECT o.*, f.payment_value, f.average_review_score FROM v_orders o JOIN v_metrics f USING (order_id))"""

RATED = """(SELECT r.review_score, o.is_delayed FROM raw_reviews r JOIN v_orders o USING (order_id)
            WHERE o.order_status = 'delivered')"""
SOLD = """(SELECT x.* FROM v_items x JOIN raw_orders o USING (order_id) WHERE o.order_status = 'delivered')"""

STATES = f"""SELECT customer_state, COUNT(*) AS delivered_orders,
    {rnd(avg_days('delivery_time_days'), 2)} AS average_delivery_days,
    {rnd(quant('delivery_time_days', 0.5), 2)} AS median_delivery_days,
    {rnd(share('is_delayed'), 2)} AS delayed_share_percent
    FROM {ARRIVED} WHERE customer_state IS NOT NULL GROUP BY 1 HAVING COUNT(*) >= 100"""
STATE_ORDERS = f"""SELECT *, {r6(part('orders_count'))} AS orders_share_percent FROM (
    SELECT customer_state, COUNT(*) AS orders_count, {money('order_items_value')} AS total_order_value,
    {rnd(avg('order_items_value'), 2)} AS average_order_value FROM {VALUED} WHERE customer_state IS NOT NULL GROUP BY 1)"""
CATEGORIES = f"""SELECT product_category_name_english, COUNT(*) AS order_items_count,
    COUNT(DISTINCT order_id) AS orders_count, {money('price')} AS products_value, {rnd(avg('price'), 2)} AS average_item_price
    FROM {SOLD} GROUP BY 1"""
MONTHS = "SELECT order_month, COUNT(*) AS orders_count FROM v_orders GROUP BY 1"

PRODUCT = f"""COUNT(*) AS orders_count, COUNT(DISTINCT customer_unique_id) AS customers_count,
    {money('order_items_value')} AS gmv, {rnd(avg('order_items_value'), 2)} AS average_order_value,
    {rnd(avg('items_count'), 2)} AS average_items_per_order"""
MONTHLY = f"SELECT order_month, {PRODUCT} FROM {VALUED} GROUP BY 1"
WINDOWED = f"order_month BETWEEN {FIRST} AND {LAST}"
CUSTOMER_ORDERS = f"""(SELECT customer_unique_id, COUNT(*) AS orders_count, {money('order_items_value')} AS customer_gmv
    FROM {VALUED} GROUP BY 1)"""
VALUED_MONTHS = CUSTOMER_MONTHS.replace("FROM done", "FROM done WHERE order_items_value IS NOT NULL")
TYPES = f"""SELECT month AS order_month, CASE WHEN month = first_month THEN 'New' ELSE 'Repeat' END AS customer_type,
    COUNT(*) AS customers_count FROM ({VALUED_MONTHS}) WHERE month BETWEEN {FIRST} AND {LAST} GROUP BY 1, 2"""


def groups(source: str, count: str, name: str) -> str:
    labels = ["1 order", "2 orders", "3 orders", "4 orders", "5+ orders"]
    values = ", ".join(f"({i}, '{label}')" for i, label in enumerate(labels))
    return f"""SELECT l.i AS bin_order, l.label AS {name}, IFNULL(g.n, 0) AS customers_count,
        {r6(part('IFNULL(g.n, 0)'))} AS customers_share_percent
        FROM (VALUES {values}) l(i, label)
        LEFT JOIN (SELECT LEAST({count}, 5) - 1 AS i, COUNT(*) AS n FROM {source} GROUP BY 1) g USING (i)"""


ACTIVITY = f"""(SELECT customer_unique_id, month AS order_month, first_month AS cohort_month, {MONTH_GAP} AS cohort_index
    FROM ({VALUED_MONTHS}))"""
COUNTS = f"""SELECT cohort_month, cohort_index, COUNT(DISTINCT customer_unique_id) AS customers_count
    FROM {ACTIVITY} GROUP BY 1, 2"""
RATES = f"""SELECT cohort_month, cohort_index, customers_count,
    {div('customers_count', 'MAX(CASE WHEN cohort_index = 0 THEN customers_count END) OVER (PARTITION BY cohort_month)')}
    AS rate FROM ({COUNTS})"""
IN_WINDOW = f"cohort_month BETWEEN {FIRST} AND {LAST}"
LAST_INDEX = 78  # of the test data at the scale that is compared; the query takes it from the data


def pivoted(value: str, indexes, name="{i}", wrap=r6) -> str:
    return ", ".join(
        f'{wrap(f"MAX(CASE WHEN cohort_index = {i} THEN {value} END)")} AS "{name.format(i=i)}"' for i in indexes
    )


LONG = f"""SELECT cohort_month, 'Month ' || cohort_index AS retention_period, rate FROM rates
    WHERE {IN_WINDOW} AND cohort_index IN (1, 3, 6)"""

RFM = f"({customer_frame('order_items_value IS NOT NULL')})"
MEASURES = ["recency", "frequency", "monetary"]


def quarter(x: str) -> str:
    cuts = " + ".join(
        f"CASE WHEN CAST({x} AS DOUBLE) > (SELECT {quant(x, p)} FROM rfm) THEN 1 ELSE 0 END" for p in (0.25, 0.5, 0.75)
    )
    return f"1 + {cuts}"


SCORED = {
    "rfm": f"SELECT * FROM {RFM}",
    "scores": f"""SELECT *, 5 - ({quarter('recency')}) AS r_score, LEAST(frequency, 4) AS f_score,
        {quarter('monetary')} AS m_score FROM rfm""",
    "scored": f"""SELECT *, {SEGMENT} AS segment, r_score + f_score + m_score AS rfm_total_score,
        CASE WHEN frequency = 1 THEN '1 order' WHEN frequency >= 5 THEN '5+ orders' ELSE frequency || ' orders' END
        AS frequency_group, CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) || CAST(m_score AS VARCHAR) AS rfm_code
        FROM scores""",
}
SEGMENTS = f"""SELECT segment, customers_count, {r6('rec')} AS average_recency, {r6('frq')} AS average_frequency,
    {r6('mon')} AS average_monetary, CAST(v AS DOUBLE) AS total_monetary,
    {r6(part('customers_count'))} AS customers_share_percent, {r6(part('v'))} AS monetary_share_percent
    FROM (SELECT segment, COUNT(*) AS customers_count, {avg('recency')} AS rec, {avg('frequency')} AS frq,
          {avg('monetary')} AS mon, SUM(monetary) AS v FROM scored GROUP BY 1)"""
DISTRIBUTION = "SELECT {k}, n AS customers_count, {s} AS customers_share_percent FROM (SELECT {k}, COUNT(*) AS n FROM {t} GROUP BY 1)"

ORACLES = {
    "e1_time_coverage": sql(
        """SELECT MIN(order_purchase_timestamp) AS min_order_date, MAX(order_purchase_timestamp) AS max_order_date,
        COUNT(*) AS orders_count FROM v_orders"""
    ),
    "e2_orders_per_month": sql(MONTHS),
    "e2_boundary_months": sql(
        f"""(SELECT *, 'first' AS edge FROM ({MONTHS}) ORDER BY order_month LIMIT 5)
        UNION ALL (SELECT *, 'last' AS edge FROM ({MONTHS}) ORDER BY order_month DESC LIMIT 5)"""
    ),
    "e3_status_shares": sql(
        f"""SELECT order_status, n AS orders_count, {rnd(div('n * 100', 'SUM(n) OVER ()'), 2)} AS share_percent
        FROM (SELECT order_status, COUNT(*) AS n FROM v_orders GROUP BY 1)"""
    ),
    "e4_status_by_year": sql(
        """SELECT YEAR(order_purchase_timestamp) AS order_year, order_status, COUNT(*) AS orders_count
        FROM v_orders GROUP BY 1, 2"""
    ),
    "e5_value_by_status": sql(
        f"""SELECT order_status, COUNT(*) AS orders_count, {money('order_items_value')} AS total_order_value,
        {rnd(avg('order_items_value'), 2)} AS average_order_value FROM v_metrics GROUP BY 1"""
    ),
    "e6_missing_summary": sql(
        "\nUNION ALL\n".join(
            f"""SELECT 'missing_{v}' AS variable, '{label}' AS label, COUNT(*) - COUNT({c}) AS missing_count,
            {r6(div(f'COUNT(*) - COUNT({c})', 'COUNT(*)') + ' * 100')} AS missing_share_percent FROM {WIDE}"""
            for v, label, c in [
                ("approved_at", "Approved At", "order_approved_at"),
                ("carrier_date", "Carrier Date", "order_delivered_carrier_date"),
                ("customer_date", "Customer Date", "order_delivered_customer_date"),
                ("payment_value", "Payment Value", "payment_value"),
                ("review_score", "Review Score", "average_review_score"),
            ]
        )
    ),
    "e7_missing_by_status": sql(f"SELECT order_status, COUNT(*) AS orders_count, {GAPS} FROM {WIDE} GROUP BY 1"),
    "e8_order_value_describe": sql(
        described(
            VALUED,
            ["products_value", "freight_value", "order_items_value", "payment_value", "items_count"],
            [25, 50, 75, 90, 95, 99],
        )
    ),
    "e8_largest_orders": sql(
        f"""SELECT order_id, CAST(products_value AS DOUBLE) AS products_value, CAST(freight_value AS DOUBLE) AS freight_value,
        CAST(order_items_value AS DOUBLE) AS order_items_value, CAST(payment_value AS DOUBLE) AS payment_value, items_count
        FROM {VALUED} t ORDER BY t.order_items_value DESC, t.order_id LIMIT 10"""
    ),
    "e8_order_value_limit": sql(f"SELECT {r6(quant('order_items_value', 0.99))} AS p99 FROM {VALUED}"),
    "e8_order_value_histogram": hist(VALUED, "order_items_value"),
    "e9_delivery_summary": sql(
        f"""SELECT COUNT(*) AS delivered_orders, {rnd(avg_days('delivery_time_days'), 2)} AS average_delivery_days,
        {rnd(quant('delivery_time_days', 0.5), 2)} AS median_delivery_days,
        {rnd(quant('delivery_time_days', 0.9), 2)} AS delivery_days_90_percentile,
        COUNT(CASE WHEN is_delayed THEN 1 END) AS delayed_orders,
        {rnd(div('COUNT(CASE WHEN is_delayed THEN 1 END) * 100', 'COUNT(*)'), 2)} AS delayed_share_percent FROM {ARRIVED}"""
    ),
    "e10_delivery_time_describe": sql(described(ARRIVED, ["delivery_time_days"], [50, 75, 90, 95, 99])),
    "e10_slowest_deliveries": sql(
        f"""SELECT order_id, {r6('delivery_time_days')} AS delivery_time_days, is_delayed FROM {ARRIVED} t
        ORDER BY t.delivery_time_days DESC, order_id LIMIT 10"""
    ),
    "e10_delivery_time_histogram": hist(ARRIVED, "delivery_time_days"),
    "e11_delays_by_state": sql(STATES),
    "e11_most_delayed_states": sql(f"SELECT * FROM ({STATES}) ORDER BY delayed_share_percent DESC, customer_state LIMIT 10"),
    "e12_review_distribution": sql(
        f"""SELECT review_score, n AS reviews_count, {rnd(div('n * 100', 'SUM(n) OVER ()'), 2)} AS share_percent
        FROM (SELECT CAST(review_score AS BIGINT) AS review_score, COUNT(*) AS n FROM {RATED} GROUP BY 1)"""
    ),
    "e13_review_summary": sql(
        f"""SELECT {rnd(avg('review_score'), 2)} AS average_review_score, {quant('review_score', 0.5)} AS median_review_score,
        COUNT(*) AS reviews_count FROM {RATED}"""
    ),
    "e14_reviews_by_delay": sql(
        f"""SELECT is_delayed, COUNT(*) AS reviewed_orders, {rnd(avg('review_score'), 2)} AS average_review_score,
        {rnd(div('SUM(CASE WHEN review_score <= 2 THEN 1 ELSE 0 END) * 100', 'COUNT(*)'), 2)} AS low_score_share_percent,
        CASE WHEN is_delayed THEN 'Delayed' ELSE 'On Time' END AS delivery_status
        FROM {RATED} WHERE is_delayed IS NOT NULL GROUP BY 1"""
    ),
    "e15_category_performance": sql(CATEGORIES),
    "e15_top_categories": sql(
        f"SELECT * FROM ({CATEGORIES}) ORDER BY products_value DESC, product_category_name_english LIMIT 15"
    ),
    "e16_orders_by_state": sql(STATE_ORDERS),
    "e16_top_states": sql(f"SELECT * FROM ({STATE_ORDERS}) ORDER BY orders_count DESC, customer_state LIMIT 10"),
    "p1_overall_metrics": sql(
        f"SELECT *, {r6(div('gmv', 'orders_count'))} AS calculated_aov FROM (SELECT {PRODUCT} FROM {VALUED})"
    ),
    "p2_monthly_product_metrics": sql(f"SELECT * FROM ({MONTHLY}) WHERE {WINDOWED}"),
    "p3_customer_orders": sql(f"SELECT * FROM {CUSTOMER_ORDERS}"),
    "p3_customer_orders_describe": sql(described(CUSTOMER_ORDERS, ["orders_count"], [50, 75, 90, 95, 99])),
    "p4_repeat_customer_share": sql(
        f"""SELECT COUNT(*) AS customers_count, COUNT(CASE WHEN orders_count > 1 THEN 1 END) AS repeat_customers_count,
        {r6(share('orders_count > 1'))} AS repeat_customers_share_percent FROM {CUSTOMER_ORDERS}"""
    ),
    "p5_order_frequency_groups": sql(groups(CUSTOMER_ORDERS, "orders_count", "order_frequency_group")),
    "p6_monthly_customers": sql(f"SELECT order_month, customers_count FROM ({MONTHLY}) WHERE {WINDOWED}"),
    "p7_customer_types": sql(TYPES),
    "p7_repeat_share_by_month": sql(
        f"""SELECT order_month, a AS "New", b AS "Repeat", a + b AS total_customers,
        {r6(div('b', 'a + b') + ' * 100')} AS repeat_share_percent FROM (
          SELECT order_month, CAST(SUM(CASE WHEN customer_type = 'New' THEN customers_count ELSE 0 END) AS BIGINT) AS a,
                 CAST(SUM(CASE WHEN customer_type = 'Repeat' THEN customers_count ELSE 0 END) AS BIGINT) AS b
          FROM ({TYPES}) GROUP BY 1)"""
    ),
    "p8_items_per_order": sql(f"SELECT order_month, average_items_per_order FROM ({MONTHLY}) WHERE {WINDOWED}"),
    "c1_customer_activity": sql(f"SELECT * FROM {ACTIVITY}"),
    "c2_cohort_sizes": sql(
        f"SELECT cohort_month, customers_count FROM ({COUNTS}) WHERE cohort_index = 0 AND {IN_WINDOW}"
    ),
    "c3_cohort_counts": sql(COUNTS),
    "c3_retention_counts": sql(
        f"""SELECT cohort_month, {pivoted('customers_count', range(LAST_INDEX + 1), wrap=lambda x: x)}
        FROM rates WHERE {IN_WINDOW} GROUP BY 1""",
        rates=RATES,
    ),
    "c3_retention_matrix": sql(
        f"""SELECT STRFTIME(cohort_month, '%Y-%m') AS cohort_month, {pivoted('rate', range(LAST_INDEX + 1))}
        FROM rates WHERE {IN_WINDOW} GROUP BY 1""",
        rates=RATES,
    ),
    "c4_horizon_comparison": sql(
        f"""SELECT cohort_month, {pivoted('rate', (1, 3, 6), 'month_{i}_retention')} FROM rates WHERE {IN_WINDOW}
        GROUP BY 1""",
        rates=RATES,
    ),
    "c5_horizon_long": sql(
        f"""SELECT cohort_month, retention_period, {r6('rate')} AS retention_rate, {r6('rate * 100')} AS retention_percent
        FROM ({LONG})""",
        rates=RATES,
    ),
    "c6_retention_summary": sql(
        f"""SELECT retention_period, {r6('AVG(rate) * 100')} AS average_retention_percent,
        {r6(quant('rate', 0.5) + ' * 100')} AS median_retention_percent, COUNT(*) AS cohorts_count
        FROM ({LONG}) GROUP BY 1""",
        rates=RATES,
    ),
    "f1_customer_values": sql(f"SELECT * REPLACE (CAST(monetary AS DOUBLE) AS monetary) FROM {RFM}"),
    "f2_value_profile": sql(described(RFM, MEASURES, [25, 50, 75, 90, 95, 99])),
    "f2_value_missing": sql(
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS variable, COUNT(*) - COUNT({c}) AS missing_count FROM {RFM}"
            for c in ["customer_unique_id", *MEASURES, "last_purchase_date"]
        )
    ),
    "f2_value_shape": sql(f"SELECT COUNT(*) AS rows_count, 5 AS columns_count FROM {RFM}"),
    "f2_recency_histogram": hist(RFM, "recency"),
    "f2_monetary_histogram": hist(RFM, "monetary"),
    "f3_frequency_distribution": sql(DISTRIBUTION.format(k="frequency", s=r6(part("n")), t=RFM)),
    "f3_frequency_groups": sql(groups(RFM, "frequency", "frequency_group")),
    "f4_quantile_scores": sql(
        """SELECT * EXCLUDE (segment) REPLACE (CAST(monetary AS DOUBLE) AS monetary) FROM scored""",
        **SCORED,
    ),
    "f4_score_profile": sql(
        described("scored", ["r_score", "f_score", "m_score", "rfm_total_score"], [25, 50, 75]), **SCORED
    ),
    "f5_total_score_distribution": sql(
        DISTRIBUTION.format(k="rfm_total_score", s=r6(part("n")), t="scored"), **SCORED
    ),
    "f6_segments": sql("SELECT customer_unique_id, segment FROM scored", **SCORED),
    "f7_segment_summary": sql(SEGMENTS, **SCORED),
    "f7_segment_value_comparison": sql(
        f"SELECT * EXCLUDE (customers_count, total_monetary) FROM ({SEGMENTS})", **SCORED
    ),
}
