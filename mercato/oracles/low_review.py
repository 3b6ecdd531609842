"""DuckDB oracles for the low-review frame, its split and the evaluation of a model-free score."""

from __future__ import annotations

from mercato.oracles.base import avg, avg_days, div, quant, r6, sql
from mercato.oracles.eda import described, part

NUMERIC = [
    "order_value",
    "products_value",
    "freight_value",
    "items_count",
    "payment_value",
    "delivery_time_days",
    "delivery_delay_days",
]
GROUP = "CASE is_low_review WHEN 0 THEN 'Score 3–5' ELSE 'Score 1–2' END"
FRAME = {
    "model": """SELECT order_id, order_items_value AS order_value, products_value, freight_value, items_count, payment_value,
        delivery_time_days, delivery_delay_days, is_delayed, customer_state,
        CASE WHEN average_review_score <= 2 THEN 1 ELSE 0 END AS is_low_review
        FROM done WHERE average_review_score IS NOT NULL""",
    "split": """SELECT *, ROW_NUMBER() OVER (PARTITION BY is_low_review ORDER BY k)
              <= ROUND(COUNT(*) OVER (PARTITION BY is_low_review) * 0.2::DOUBLE) AS is_test
        FROM (SELECT *, CAST('0x' || SUBSTR(MD5(order_id || ':42'), 1, 15) AS BIGINT) AS k FROM model)""",
    "train": "SELECT * FROM split WHERE NOT is_test",
    "test": "SELECT * FROM split WHERE is_test",
    "scored": """SELECT order_id, is_low_review AS label, IFNULL(delivery_delay_days, 0.0) AS score,
        CASE WHEN delivery_delay_days > 0 THEN 1 ELSE 0 END AS predicted FROM test""",
    "steps": """SELECT score AS threshold, n, pos, SUM(pos) OVER (ORDER BY score DESC) AS tp,
        SUM(n - pos) OVER (ORDER BY score DESC) AS fp, SUM(pos) OVER () AS positives, SUM(n - pos) OVER () AS negatives
        FROM (SELECT score, COUNT(*) AS n, SUM(label) AS pos FROM scored GROUP BY 1)""",
    "rates": f"""SELECT *, {div('tp', 'tp + fp')} AS precision, {div('tp', 'positives')} AS recall FROM steps""",
    "sweep": """SELECT threshold, precision, recall, precision * recall * 2 / (precision + recall) AS f1_score FROM rates
        WHERE precision + recall > 0""",
    "best": "SELECT * FROM sweep ORDER BY f1_score DESC, threshold LIMIT 1",
    "decided": """SELECT order_id, label, score, CASE WHEN score >= (SELECT threshold FROM best) THEN 1 ELSE 0 END AS predicted
        FROM scored""",
    "errors": """SELECT d.*, t.* EXCLUDE (order_id), CASE WHEN label = 1 AND d.predicted = 1 THEN 'True Positive'
        WHEN label = 1 THEN 'False Negative' WHEN d.predicted = 1 THEN 'False Positive' ELSE 'True Negative' END
        AS prediction_result FROM decided d JOIN test t USING (order_id)""",
}


def low(body: str) -> str:
    return sql(body, **FRAME)


def cell(a: int, p: int) -> str:
    return f"SUM(CASE WHEN label = {a} AND predicted = {p} THEN 1 ELSE 0 END)"


def prf(k: int = 1) -> tuple[str, str, str]:
    hit, wrong, missed = cell(k, k), cell(1 - k, k), cell(k, 1 - k)
    return (
        f"IFNULL({div(hit, f'{hit} + {wrong}')}, 0)",
        f"IFNULL({div(hit, f'{hit} + {missed}')}, 0)",
        f"IFNULL({div(f'2 * {hit}', f'2 * {hit} + {wrong} + {missed}')}, 0)",
    )


P, R, F1 = prf()
AUC = "SUM((n - pos) * (2 * tp - pos) / 2.0) / MAX(CAST(positives AS DOUBLE) * negatives)"
AP = "SUM(CAST(pos AS DOUBLE) / positives * precision)"


def report() -> str:
    both = (prf(0), prf(1))
    n0, n1 = (f"SUM(CASE WHEN label = {k} THEN 1 ELSE 0 END)" for k in (0, 1))
    accuracy = div(f"{cell(0, 0)} + {cell(1, 1)}", "COUNT(*)")
    lines = [
        ("Score 3–5", both[0], n0),
        ("Score 1–2", both[1], n1),
        ("accuracy", (accuracy,) * 3, "COUNT(*)"),
        ("macro avg", tuple(f"({a} + {b}) / 2" for a, b in zip(*both, strict=True)), "COUNT(*)"),
        ("weighted avg", tuple(f"({a} * {n0} + {b} * {n1}) / COUNT(*)" for a, b in zip(*both, strict=True)), "COUNT(*)"),
    ]
    return "\nUNION ALL\n".join(
        f"""SELECT {i} AS position, '{name}' AS "group", {r6(p)} AS precision, {r6(r)} AS recall, {r6(f)} AS f1_score,
        CAST({size} AS BIGINT) AS support FROM scored"""
        for i, (name, (p, r, f), size) in enumerate(lines)
    )


DELAYED = f"({div('SUM(CAST(is_delayed AS INT))', 'COUNT(is_delayed)')})"
SUMMARY = f"""SELECT is_low_review, COUNT(*) AS orders_count, {r6(avg('order_value'))} AS average_order_value,
    {r6(avg('freight_value'))} AS average_freight_value, {r6(avg('items_count'))} AS average_items_count,
    {r6(avg_days('delivery_time_days'))} AS average_delivery_time,
    {r6(avg_days('delivery_delay_days'))} AS average_delivery_delay, {r6(DELAYED)} AS delayed_orders_share,
    {r6(quant('order_value', 0.5))} AS median_order_value, {r6(quant('delivery_time_days', 0.5))} AS median_delivery_time,
    {GROUP} AS review_group, {r6(f'{DELAYED} * 100')} AS delayed_orders_share_percent FROM model GROUP BY 1"""
FILL = "\nUNION ALL\n".join(
    [f"SELECT '{c}' AS variable, CAST({quant(c, 0.5)} AS VARCHAR) AS fill_value FROM train" for c in NUMERIC]
    + [
        f"""(SELECT '{c}' AS variable, CAST({c} AS VARCHAR) AS fill_value FROM train WHERE {c} IS NOT NULL
        GROUP BY {c} ORDER BY COUNT(*) DESC, {c} LIMIT 1)"""
        for c in ("is_delayed", "customer_state")
    ]
)


def filled(source: str) -> str:
    """``source`` with the training medians and most frequent categories in place of missing values, categories as text."""
    numbers = [f"IFNULL({c}, (SELECT {quant(c, 0.5)} FROM train))::DOUBLE AS {c}" for c in NUMERIC]
    texts = [f"IFNULL({c}::VARCHAR, ({COMMON.format(c)})) AS {c}" for c in CATEGORIES]
    return f"SELECT {', '.join(numbers + texts)} FROM {source}"


CATEGORIES = ("is_delayed", "customer_state")
COMMON = "SELECT {0}::VARCHAR FROM train WHERE {0} IS NOT NULL GROUP BY {0} ORDER BY COUNT(*) DESC, {0} LIMIT 1"
LABELS = "\nUNION ALL\n".join(f"SELECT '{c}' AS name, {c} AS label FROM full_train GROUP BY {c}" for c in CATEGORIES)
PREPARED = {"full_train": filled("train"), "full_test": filled("test"), "labels": LABELS}


def prepared(body: str) -> str:
    return sql(body, **FRAME, **PREPARED)


ORACLES = {
    # properties of the fitted models: what has to hold for every right fit, over counts and names from the data
    "l5_scaled_numbers": "\nUNION ALL\n".join(f"SELECT '{c}' AS feature, 0.0::DOUBLE AS mean, 1.0::DOUBLE AS deviation" for c in NUMERIC),
    "l6_category_flags": prepared(
        "\nUNION ALL\n".join(
            f"""SELECT '{c}' AS feature, COUNT(*) FILTER (WHERE {c} IN (SELECT label FROM labels WHERE name = '{c}')) AS one_flag,
            COUNT(*) FILTER (WHERE {c} NOT IN (SELECT label FROM labels WHERE name = '{c}')) AS no_flag, 0::BIGINT AS other
            FROM full_test"""
            for c in CATEGORIES
        )
    ),
    "l7_vector_slots": prepared(
        "\nUNION ALL\n".join(
            [f"SELECT '{c}' AS feature, {r6(f'SUM({c})')} AS total FROM full_test" for c in NUMERIC]
            + [
                f"""SELECT '{c}_' || label AS feature, (SELECT COUNT(*) FROM full_test WHERE {c} = label)::DOUBLE AS total
                FROM labels WHERE name = '{c}'"""
                for c in CATEGORIES
            ]
        )
    ),
    "l9_logistic_gradient": prepared(
        "SELECT '(intercept)' AS feature, 0.0::DOUBLE AS gradient UNION ALL SELECT name || '_' || label, 0.0::DOUBLE FROM labels"
        + "".join(f" UNION ALL SELECT '{c}', 0.0::DOUBLE" for c in NUMERIC)
    ),
    "l10_forest_walk": low("SELECT COUNT(*) AS orders_checked, 0::BIGINT AS wrong_orders FROM test"),
    "l16_importance_check": prepared(
        f"SELECT {len(NUMERIC)} + COUNT(*) AS features_checked, 0::BIGINT AS wrong_features, 1.0::DOUBLE AS importance_sum FROM labels"
    ),
    "l17_cycle_check": low(
        "\nUNION ALL\n".join(
            f"""SELECT '{c}' AS feature, unnest(range(10)) AS repeat, COUNT(*) AS orders_checked, COUNT(*) AS donors,
            0::BIGINT AS own_values FROM test"""
            for c in [*NUMERIC, *CATEGORIES]
        )
    ),
    "l1_model_frame": low(
        f"""SELECT * REPLACE (CAST(order_value AS DOUBLE) AS order_value, CAST(products_value AS DOUBLE) AS products_value,
        CAST(freight_value AS DOUBLE) AS freight_value, CAST(payment_value AS DOUBLE) AS payment_value,
        {r6('delivery_time_days')} AS delivery_time_days, {r6('delivery_delay_days')} AS delivery_delay_days) FROM model"""
    ),
    "l1_missing_features": low(
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS variable, COUNT(*) - COUNT({c}) AS missing_count FROM model"
            for c in ["order_id", *NUMERIC, "is_delayed", "customer_state", "is_low_review"]
        )
    ),
    "l2_target_distribution": low(
        f"""SELECT is_low_review, n AS orders_count, {GROUP} AS review_group, {r6(part('n'))} AS orders_share_percent
        FROM (SELECT is_low_review, COUNT(*) AS n FROM model GROUP BY 1)"""
    ),
    "l3_feature_describe": low(described("model", NUMERIC, [50, 75, 90, 95, 99])),
    "l3_feature_summary": low(SUMMARY),
    "l3_delay_by_review": low(
        f"SELECT is_low_review, delayed_orders_share, review_group, delayed_orders_share_percent FROM ({SUMMARY})"
    ),
    "l4_split": low("SELECT order_id, is_low_review, is_test FROM split"),
    "l4_split_summary": low(
        f"""SELECT CASE WHEN is_test THEN 'Test' ELSE 'Train' END AS dataset, COUNT(*) AS observations_count,
        {r6(avg('is_low_review') + ' * 100')} AS low_review_share_percent FROM split GROUP BY 1"""
    ),
    "l4_split_overlap": low(
        "SELECT COUNT(*) AS shared_orders FROM (SELECT order_id FROM train INTERSECT SELECT order_id FROM test)"
    ),
    "l8_prior_metrics": low(
        f"""SELECT 'Dummy Classifier' AS model, 0.5::DOUBLE AS roc_auc, {r6(avg('label'))} AS pr_auc, {r6(P)} AS precision,
        {r6(R)} AS recall, {r6(F1)} AS f1_score
        FROM (SELECT is_low_review AS label, CASE WHEN (SELECT AVG(is_low_review) FROM train) > 0.5 THEN 1 ELSE 0 END
              AS predicted FROM test)"""
    ),
    "l11_delay_score_metrics": low(
        f"""SELECT 'Delay days' AS model, a.*, b.* FROM (SELECT {r6(AUC)} AS roc_auc, {r6(AP)} AS pr_auc FROM rates) a,
        (SELECT {r6(P)} AS precision, {r6(R)} AS recall, {r6(F1)} AS f1_score FROM scored) b"""
    ),
    "l12_delay_score_report": low(report()),
    "l13_delay_score_curve": low(
        f"""SELECT {r6('threshold')} AS threshold, n, CAST(pos AS BIGINT) AS pos, CAST(tp AS BIGINT) AS tp,
        CAST(fp AS BIGINT) AS fp, {r6(div('fp', 'negatives'))} AS false_positive_rate, {r6('recall')} AS recall,
        {r6('precision')} AS precision, CAST(positives AS BIGINT) AS positives, CAST(negatives AS BIGINT) AS negatives
        FROM rates"""
    ),
    "l14_delay_score_sweep": low(
        f"""SELECT {r6('threshold')} AS threshold, {r6('precision')} AS precision, {r6('recall')} AS recall,
        {r6('f1_score')} AS f1_score FROM sweep"""
    ),
    "l14_delay_score_best": low(
        f"""SELECT {r6('threshold')} AS threshold, {r6('precision')} AS precision, {r6('recall')} AS recall,
        {r6('f1_score')} AS f1_score FROM best"""
    ),
    "l15_delay_score_threshold": low(
        f"""SELECT (SELECT {r6('threshold')} FROM best) AS threshold, {r6(P)} AS precision, {r6(R)} AS recall,
        {r6(F1)} AS f1_score FROM decided"""
    ),
    "l15_delay_score_confusion": low(
        """SELECT a.x AS actual_class, p.x AS predicted_class, COUNT(d.order_id) AS orders_count
        FROM (VALUES (0), (1)) a(x) CROSS JOIN (VALUES (0), (1)) p(x)
        LEFT JOIN decided d ON d.label = a.x AND d.predicted = p.x GROUP BY 1, 2"""
    ),
    "l18_delay_score_error_counts": low("SELECT prediction_result, COUNT(*) AS orders_count FROM errors GROUP BY 1"),
    "l18_delay_score_error_groups": low(
        f"""SELECT prediction_result, COUNT(*) AS orders_count, {r6('AVG(score)')} AS average_predicted_probability,
        {r6(avg_days('delivery_delay_days'))} AS average_delivery_delay,
        {r6(avg_days('delivery_time_days'))} AS average_delivery_time, {r6(DELAYED)} AS delayed_orders_share,
        {r6(avg('items_count'))} AS average_items_count, {r6(avg('order_value'))} AS average_order_value,
        {r6(f'{DELAYED} * 100')} AS delayed_orders_share_percent FROM errors GROUP BY 1"""
    ),
    "l18_delay_score_error_boxes": low(
        f"""SELECT prediction_result, {r6('ANY_VALUE(q1)')} AS q1, {r6('ANY_VALUE(median)')} AS median, {r6('ANY_VALUE(q3)')} AS q3,
        {r6('MIN(score)')} AS whisker_low, {r6('MAX(score)')} AS whisker_high
        FROM errors JOIN (SELECT prediction_result, {quant('score', 0.25)} AS q1, {quant('score', 0.5)} AS median,
                          {quant('score', 0.75)} AS q3 FROM errors GROUP BY 1) USING (prediction_result)
        WHERE score BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) GROUP BY 1"""
    ),
    "l5_fill_values": low(FILL),
}
