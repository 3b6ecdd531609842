"""DuckDB oracles for the hypothesis statistics and the experiment evaluation."""

from __future__ import annotations

from mercato.oracles.base import avg, div, quant, r6, sql
from mercato.oracles.eda import described, part

DELAY = "SELECT order_id, average_review_score AS s, is_delayed FROM done WHERE s IS NOT NULL AND is_delayed IS NOT NULL"
VALUE_TIME = """SELECT order_id, order_items_value AS order_value, delivery_time_days FROM done
    WHERE order_items_value IS NOT NULL AND delivery_time_days IS NOT NULL"""
FREIGHT = """SELECT order_id, items_count, freight_value, CASE WHEN items_count = 1 THEN '1 item'
    WHEN items_count >= 5 THEN '5+ items' ELSE items_count || ' items' END AS items_group FROM done
    WHERE freight_value IS NOT NULL AND items_count > 0"""
SINGLE = """SELECT x.product_category, d.average_review_score AS s
    FROM (SELECT order_id, ANY_VALUE(product_category_name_english) AS product_category FROM v_items GROUP BY 1
          HAVING COUNT(DISTINCT product_category_name_english) = 1) x
    JOIN done d ON d.order_id = x.order_id WHERE d.average_review_score IS NOT NULL"""
CATEGORY = """SELECT * FROM single_orders WHERE product_category IN (
    SELECT product_category FROM single_orders GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 10)"""
FRAMES = {"delay": DELAY, "vt": VALUE_TIME, "freight": FREIGHT, "single_orders": SINGLE, "category": CATEGORY}

STATUS = "CASE WHEN is_delayed THEN 'Delayed' ELSE 'On Time' END"


def score_groups(source: str, label: str, name: str, sizes: str) -> str:
    low = div("SUM(CASE WHEN s <= 2 THEN 1 ELSE 0 END)", "COUNT(*)")
    return f"""SELECT {label} AS {name}, COUNT(*) AS {sizes}, {r6(avg('s'))} AS average_review_score,
        {r6('STDDEV_SAMP(CAST(s AS DOUBLE))')} AS standard_deviation, {r6(low)} AS low_score_share,
        {r6(quant('s', 0.5))} AS median_review_score, {r6(f'{low} * 100')} AS low_score_share_percent FROM {source} GROUP BY 1"""


def moments(source: str, x: str, first: str) -> str:
    parts = []
    for i, cond in (("1", first), ("2", f"NOT ({first})")):
        mine = f"CASE WHEN {cond} THEN CAST({x} AS DOUBLE) END"
        parts.append(f"COUNT({mine}) AS n{i}, AVG({mine}) AS mean{i}, VAR_SAMP({mine}) AS var{i}")
    return f"SELECT {', '.join(parts)} FROM {source}"


def welch(source: str, x: str, first: str, rd=r6) -> str:
    return f"""SELECT n1, n2, {rd('mean1')} AS mean1, {rd('mean2')} AS mean2, {rd('SQRT(var1)')} AS sd1, {rd('SQRT(var2)')} AS sd2,
        {rd('(mean1 - mean2) / SQRT(var1 / n1 + var2 / n2)')} AS t,
        {rd('POWER(var1 / n1 + var2 / n2, 2) / (POWER(var1 / n1, 2) / (n1 - 1) + POWER(var2 / n2, 2) / (n2 - 1))')} AS df
        FROM ({moments(source, x, first)})"""


def mid(x: str, over: str = "") -> str:
    return f"""(RANK() OVER (ORDER BY {x}) + (COUNT(*) OVER (PARTITION BY {x}) - 1) / 2.0)"""


def mann_whitney(source: str, x: str, first: str, tail: str, rd=r6) -> str:
    return f"""SELECT n1, n2, {rd('u')} AS u,
        {rd(f'({tail} - CAST(n1 AS DOUBLE) * n2 / 2 - 0.5) / SQRT(CAST(n1 AS DOUBLE) * n2 / 12 * (n1 + n2 + 1 - ties / (CAST(n1 + n2 AS DOUBLE) * (n1 + n2 - 1))))')} AS z
        FROM (SELECT COUNT(CASE WHEN f THEN 1 END) AS n1, COUNT(CASE WHEN NOT f THEN 1 END) AS n2,
              CAST(SUM(CASE WHEN f THEN r END) AS DOUBLE) - COUNT(CASE WHEN f THEN 1 END) * (COUNT(CASE WHEN f THEN 1 END) + 1) / 2.0 AS u,
              SUM(CAST(k AS DOUBLE) * k - 1) AS ties
              FROM (SELECT {first} AS f, {mid(x)} AS r, COUNT(*) OVER (PARTITION BY {x}) AS k FROM {source}))"""


def correlated(source: str, x: str, y: str, ranks: bool, rd=r6) -> str:
    a, b = (mid(x), mid(y)) if ranks else (f"CAST({x} AS DOUBLE)", f"CAST({y} AS DOUBLE)")
    return f"""SELECT n, {rd('r')} AS r, {rd('r * SQRT((n - 2) / (1 - r * r))')} AS t, CAST(n - 2 AS DOUBLE) AS df
        FROM (SELECT COUNT(*) AS n, CORR(a, b) AS r FROM (SELECT CAST({a} AS DOUBLE) AS a, CAST({b} AS DOUBLE) AS b FROM {source}))"""


def kruskal(source: str, x: str, g: str, rd=r6) -> str:
    return f"""SELECT n, k, {rd('h')} AS h, k - 1 AS df, {rd('(h - k + 1) / (n - k)')} AS epsilon_squared FROM (
        SELECT n, k, (12.0 / (n * (n + 1.0)) * sq - 3 * (n + 1)) / (1 - ties / (CAST(n AS DOUBLE) * n * n - n)) AS h FROM (
          SELECT SUM(m)::BIGINT AS n, COUNT(*) AS k, SUM(rs * rs / m) AS sq, SUM(tt) AS ties FROM (
            SELECT {g} AS g, COUNT(*) AS m, CAST(SUM(r) AS DOUBLE) AS rs, SUM(CAST(k AS DOUBLE) * k - 1) AS tt
            FROM (SELECT {g}, {mid(x)} AS r, COUNT(*) OVER (PARTITION BY {x}) AS k FROM {source}) GROUP BY 1)))"""


REPEAT = """SELECT f.customer_unique_id, f.first_at, n.order_id AS next_order_id, n.order_id IS NOT NULL AS converted,
        n.order_status = 'canceled' AS canceled, CAST(n.order_items_value AS DOUBLE) AS value
    FROM (SELECT customer_unique_id, MIN(order_purchase_timestamp) AS first_at FROM done GROUP BY 1) f
    LEFT JOIN (
        SELECT o.* FROM v_metrics o
        JOIN (SELECT customer_unique_id, MIN(order_purchase_timestamp) AS first_at FROM done GROUP BY 1) s
          USING (customer_unique_id)
        WHERE o.order_purchase_timestamp > s.first_at AND o.order_purchase_timestamp <= s.first_at + INTERVAL 30 DAY
        QUALIFY ROW_NUMBER() OVER (PARTITION BY o.customer_unique_id ORDER BY o.order_purchase_timestamp, o.order_id) = 1) n
      USING (customer_unique_id)"""
EXPERIMENT = {
    "repeats": REPEAT,
    "trial": """SELECT customer_unique_id AS "user", CASE WHEN ('0x' || left(md5(CAST(customer_unique_id AS VARCHAR)), 8))::BIGINT % 2 = 0 THEN 'Control' ELSE 'Treatment' END
        AS "group", CAST(converted AS BIGINT) AS converted, CAST(canceled AS BIGINT) AS canceled, value FROM repeats""",
    "sizes": """SELECT COUNT(CASE WHEN "group" = 'Control' THEN 1 END) AS cn,
        CAST(SUM(CASE WHEN "group" = 'Control' THEN converted ELSE 0 END) AS BIGINT) AS cc,
        CAST(SUM(CASE WHEN "group" = 'Control' AND converted = 1 THEN canceled ELSE 0 END) AS BIGINT) AS cx,
        COUNT(CASE WHEN "group" = 'Treatment' THEN 1 END) AS tn,
        CAST(SUM(CASE WHEN "group" = 'Treatment' THEN converted ELSE 0 END) AS BIGINT) AS tc,
        CAST(SUM(CASE WHEN "group" = 'Treatment' AND converted = 1 THEN canceled ELSE 0 END) AS BIGINT) AS tx FROM trial""",
    "bought": 'SELECT "group", CAST(value AS DECIMAL(12,2)) AS value FROM trial WHERE converted = 1 AND value IS NOT NULL',
}


def trial(body: str) -> str:
    return sql(body, **EXPERIMENT)


def frame(body: str) -> str:
    return sql(body, **FRAMES)


def z_test(x1: str, n1: str, x2: str, n2: str) -> tuple[str, str, str, str]:
    p1, p2 = div(x1, n1), div(x2, n2)
    pool = div(f"{x1} + {x2}", f"{n1} + {n2}")
    own = f"SQRT({p1} * (1 - {p1}) / {n1} + {p2} * (1 - {p2}) / {n2})"
    d = f"({p1} - {p2})"
    return (
        d,
        f"{d} / SQRT({pool} * (1 - {pool}) * (1.0 / {n1} + 1.0 / {n2}))",
        f"{d} - 1.959963984540054 * {own}",
        f"{d} + 1.959963984540054 * {own}",
    )


MAIN = z_test("tc", "tn", "cc", "cn")
CANCEL = z_test("tx", "tc", "cx", "cc")
CR, TR = div("cc", "cn"), div("tc", "tn")
TREATED = "\"group\" = 'Treatment'"

STEPS = 4000  # Simpson intervals; six decimals need far fewer


def integral(density: str, upper: str) -> str:
    """Simpson integral of ``density`` (a text in x) from 0 to ``upper``."""
    return f"""(SELECT SUM(w * ({density})) * ANY_VALUE(h) / 3 FROM (
        SELECT i * ({upper}) / {STEPS}.0 AS x, ({upper}) / {STEPS}.0 AS h,
               CASE WHEN i IN (0, {STEPS}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w
        FROM (SELECT UNNEST(RANGE({STEPS + 1})) AS i)))"""


def exact(expr: str) -> str:
    return f"({expr})"


def normal_upper(z: str) -> str:
    z = f"GREATEST(LEAST({z}, 40), -40)"
    return f"(0.5 - {integral('EXP(-x * x / 2) / SQRT(2 * PI())', z)})"


def t_upper(t: str, df: str) -> str:
    scale = f"EXP(LGAMMA(({df} + 1) / 2.0) - LGAMMA({df} / 2.0)) / SQRT({df} * PI())"
    t = f"GREATEST(LEAST({t}, 40), -40)"
    return f"(0.5 - {scale} * {integral(f'POWER(1 + x * x / {df}, -({df} + 1) / 2.0)', t)})"


def chi2_upper(x: str, df: str) -> str:
    scale = f"EXP(-LGAMMA({df} / 2.0)) / POWER(2, {df} / 2.0)"
    return f"(1 - {scale} * {integral(f'POWER(x, {df} / 2.0 - 1) * EXP(-x / 2)', f'LEAST({x}, 200)')})"


def p(expr: str) -> str:
    return r6(f"LEAST(1, GREATEST(0, {expr}))")


def lines(pairs: dict[str, str], source: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{label.replace(chr(39), chr(39) * 2)}' AS metric, {r6(f'CAST({c} AS DOUBLE)')} AS value FROM {source}"
        for label, c in pairs.items()
    )


D_VALUE = f"""SELECT (mean1 - mean2) / SQRT(((n1 - 1) * var1 + (n2 - 1) * var2) / (n1 + n2 - 2)) AS d
    FROM ({moments('delay', 's', 'is_delayed')})"""
RESULTS = {
    **FRAMES,
    "welch_row": welch("delay", "s", "is_delayed", exact),
    "rank_row": mann_whitney("delay", "s", "is_delayed", "(CAST(n1 AS DOUBLE) * n2 - u)", exact),
    "effect_row": D_VALUE,
    "pearson_row": correlated("vt", "order_value", "delivery_time_days", False, exact),
    "value_rho": correlated("vt", "order_value", "delivery_time_days", True, exact),
    "freight_rho": correlated("freight", "items_count", "freight_value", True, exact),
    "freight_h": kruskal("freight", "freight_value", "items_group", exact),
    "category_h": kruskal("category", "s", "product_category", exact),
    "delays": f"""SELECT mean1, mean2, mean1 - mean2 AS diff, {p(t_upper('-welch_row.t', 'welch_row.df'))} AS wp,
        {p(normal_upper('rank_row.z'))} AS up, d FROM welch_row, rank_row, effect_row""",
    "freights": f"""SELECT r, {p('2 * ' + t_upper('ABS(freight_rho.t)', 'freight_rho.df'))} AS rp, h, {p(chi2_upper('freight_h.h', 'freight_h.df'))} AS hp,
        epsilon_squared FROM freight_rho, freight_h""",
    "categories": f"SELECT h, {p(chi2_upper('category_h.h', 'category_h.df'))} AS hp, epsilon_squared FROM category_h",
    "values_time": f"SELECT r, {p('2 * ' + t_upper('ABS(value_rho.t)', 'value_rho.df'))} AS rp FROM value_rho",
}


def tested(body: str) -> str:
    return sql(body, **RESULTS)


def labelled(measure: str, limits: list[tuple[float, str]], last: str) -> str:
    steps = " ".join(f"WHEN ABS(effect_value) < {x} THEN '{name}'" for x, name in limits)
    return f"WHEN effect_measure = '{measure}' THEN CASE {steps} ELSE '{last}' END"


HYPOTHESES = f"""SELECT *, CASE
    {labelled("Cohen''s d", [(0.2, 'Negligible'), (0.5, 'Small'), (0.8, 'Medium')], 'Large')}
    {labelled('Spearman correlation', [(0.1, 'Negligible'), (0.3, 'Weak'), (0.5, 'Moderate')], 'Strong')}
    {labelled('Epsilon-squared', [(0.01, 'Negligible'), (0.06, 'Small'), (0.14, 'Medium')], 'Large')}
    END AS effect_interpretation, p_value < 0.05 AS statistically_significant FROM (
    SELECT 1 AS position, 'Delayed orders have lower review scores' AS hypothesis, 'Welch t-test, Mann–Whitney U' AS method,
           GREATEST(wp, up) AS p_value, 'Cohen''s d' AS effect_measure, {r6('d')} AS effect_value FROM delays
    UNION ALL SELECT 2, 'Higher-value orders take longer to deliver', 'Pearson and Spearman correlation', rp,
           'Spearman correlation', {r6('r')} FROM values_time
    UNION ALL SELECT 3, 'Orders with more items have higher freight cost', 'Spearman correlation, Kruskal–Wallis', hp,
           'Epsilon-squared', {r6('epsilon_squared')} FROM freights
    UNION ALL SELECT 4, 'Review scores differ across product categories', 'Kruskal–Wallis', hp, 'Epsilon-squared',
           {r6('epsilon_squared')} FROM categories)"""

TRIALS = {
    **EXPERIMENT,
    "main_row": f"""SELECT {CR} AS control, {TR} AS treated, {MAIN[0]} AS diff, {MAIN[0]} / {CR} AS relative, {MAIN[1]} AS z,
        {MAIN[2]} AS lo, {MAIN[3]} AS hi, cn, tn,
        (POWER(cn - (cn + tn) / 2.0, 2) + POWER(tn - (cn + tn) / 2.0, 2)) / ((cn + tn) / 2.0) AS chi FROM sizes""",
    "cancel_row": f"SELECT {CANCEL[0]} AS xd, {CANCEL[1]} AS xz, {CANCEL[2]} AS xlo, {CANCEL[3]} AS xhi FROM sizes",
    "value_welch": welch("bought", "value", TREATED, exact),
    "value_rank": mann_whitney("bought", "value", TREATED, "GREATEST(u, CAST(n1 AS DOUBLE) * n2 - u)", exact),
    "evaluated": f"""SELECT main_row.*, cancel_row.*, {p('2 * ' + normal_upper('SQRT(chi)'))} AS srm_p,
        {p('2 * ' + normal_upper('ABS(main_row.z)'))} AS main_p, {p('2 * ' + normal_upper('ABS(xz)'))} AS cancel_p,
        value_welch.mean1 - value_welch.mean2 AS vd, {p('2 * ' + t_upper('ABS(value_welch.t)', 'value_welch.df'))} AS welch_p,
        {p('2 * ' + normal_upper('value_rank.z'))} AS u_p FROM main_row, cancel_row, value_welch, value_rank""",
}
CRITERIA = {
    "No sample ratio mismatch": "srm_p >= 0.05",
    "Primary metric is statistically significant": "main_p < 0.05",
    "Confidence interval is above zero": "lo > 0",
    "Observed uplift is close to target MDE": "diff >= 0.0045",
    "Cancellation rate does not deteriorate": "cancel_p >= 0.05",
    "Repeat order value does not deteriorate": "welch_p >= 0.05 AND u_p >= 0.05",
}


def evaluated(body: str) -> str:
    return sql(body, **TRIALS)


ORACLES = {
    "t11_delay_test_summary": tested(
        lines(
            {
                "Delayed mean": "mean1",
                "On-time mean": "mean2",
                "Mean difference": "diff",
                "Welch p-value": "wp",
                "Mann–Whitney p-value": "up",
                "Cohen's d": "d",
            },
            "delays",
        )
    ),
    "t11_correlation_summary": tested(
        f"""SELECT 'Pearson' AS method, {r6('r')} AS correlation, {p('2 * ' + t_upper('ABS(pearson_row.t)', 'pearson_row.df'))} AS p_value FROM pearson_row
        UNION ALL SELECT 'Spearman', {r6('r')}, rp FROM values_time"""
    ),
    "t11_freight_test_summary": tested(
        lines(
            {
                "Spearman correlation": "r",
                "Spearman p-value": "rp",
                "Kruskal–Wallis statistic": "h",
                "Kruskal–Wallis p-value": "hp",
                "Epsilon-squared": "epsilon_squared",
            },
            "freights",
        )
    ),
    "t11_category_test_summary": tested(
        lines(
            {
                "Kruskal–Wallis statistic": "h",
                "Kruskal–Wallis p-value": "hp",
                "Epsilon-squared": "epsilon_squared",
            },
            "categories",
        )
    ),
    "t12_hypothesis_table": tested(HYPOTHESES),
    "x2_sample_ratio_summary": evaluated(
        lines(
            {
                "Control customers": "cn",
                "Treatment customers": "tn",
                "Chi-square statistic": "chi",
                "SRM p-value": "srm_p",
            },
            "evaluated",
        )
    ),
    "x4_primary_test_summary": evaluated(
        lines(
            {
                "Control conversion": "control",
                "Treatment conversion": "treated",
                "Absolute uplift": "diff",
                "Relative uplift": "relative",
                "Z-statistic": "z",
                "P-value": "main_p",
                "CI lower bound": "lo",
                "CI upper bound": "hi",
            },
            "evaluated",
        )
    ),
    "x8_guardrail_test_summary": evaluated(
        lines(
            {
                "Cancellation rate difference": "xd",
                "Cancellation z-test p-value": "cancel_p",
                "Cancellation CI lower bound": "xlo",
                "Cancellation CI upper bound": "xhi",
                "Repeat order value difference": "vd",
                "Welch p-value": "welch_p",
                "Mann–Whitney p-value": "u_p",
            },
            "evaluated",
        )
    ),
    "x9_decision_table": evaluated(
        "\nUNION ALL\n".join(
            f"""SELECT '{name}' AS criterion, {check} AS result, CASE WHEN {check} THEN 'Passed' ELSE 'Failed' END AS status
            FROM evaluated"""
            for name, check in CRITERIA.items()
        )
    ),
    "x9_final_decision": evaluated(
        f"""SELECT CASE WHEN {' AND '.join(f'({c})' for c in CRITERIA.values())} THEN 'Recommend rollout'
        ELSE 'Do not recommend rollout' END AS experiment_result, {r6('diff * 100')} AS absolute_uplift_pp,
        {r6('relative * 100')} AS relative_uplift_percent, main_p AS primary_metric_p_value,
        {r6('lo * 100')} AS ci_lower_bound_pp, {r6('hi * 100')} AS ci_upper_bound_pp FROM evaluated"""
    ),
    "t1_group_sizes": frame(f"SELECT {STATUS} AS delivery_status, COUNT(*) AS orders_count FROM delay GROUP BY 1"),
    "t1_delay_review_summary": frame(score_groups("delay", STATUS, "delivery_status", "orders_count")),
    "t1_delay_review_distribution": frame(
        f"""SELECT delivery_status, CAST(s AS DOUBLE) AS review_score, n AS reviews_count,
        {r6(part('n', 'PARTITION BY delivery_status'))} AS share_percent
        FROM (SELECT {STATUS} AS delivery_status, s, COUNT(*) AS n FROM delay GROUP BY 1, 2)"""
    ),
    "t2_delay_welch": frame(welch("delay", "s", "is_delayed")),
    "t3_delay_mann_whitney": frame(mann_whitney("delay", "s", "is_delayed", "(CAST(n1 AS DOUBLE) * n2 - u)")),
    "t4_delay_effect": frame(
        f"""SELECT {r6('d')} AS d, CASE WHEN ABS(d) < 0.2 THEN 'Negligible' WHEN ABS(d) < 0.5 THEN 'Small'
        WHEN ABS(d) < 0.8 THEN 'Medium' ELSE 'Large' END AS label FROM (
          SELECT (mean1 - mean2) / SQRT(((n1 - 1) * var1 + (n2 - 1) * var2) / (n1 + n2 - 2)) AS d
          FROM ({moments('delay', 's', 'is_delayed')}))"""
    ),
    "t5_value_time_pearson": frame(correlated("vt", "order_value", "delivery_time_days", False)),
    "t6_value_time_spearman": frame(correlated("vt", "order_value", "delivery_time_days", True)),
    "t6_items_freight_spearman": frame(correlated("freight", "items_count", "freight_value", True)),
    "t7_items_freight_kruskal": frame(kruskal("freight", "freight_value", "items_group")),
    "t8_category_kruskal": frame(kruskal("category", "s", "product_category")),
    "t9_value_time_describe": frame(described("vt", ["order_value", "delivery_time_days"], [50, 75, 90, 95, 99])),
    "t9_value_time_missing": frame(
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS variable, COUNT(*) - COUNT({c}) AS missing_count FROM vt"
            for c in ("order_id", "order_value", "delivery_time_days")
        )
    ),
    "t9_value_time_line": frame(
        f"""SELECT COUNT(*) AS orders_count, {r6('REGR_SLOPE(delivery_time_days, x)')} AS slope,
        {r6('REGR_INTERCEPT(delivery_time_days, x)')} AS intercept
        FROM (SELECT CAST(order_value AS DOUBLE) AS x, delivery_time_days FROM vt)
        WHERE x <= (SELECT {quant('order_value', 0.99)} FROM vt)
          AND delivery_time_days <= (SELECT {quant('delivery_time_days', 0.99)} FROM (
              SELECT * FROM vt))"""
    ),
    "t9_items_freight_describe": frame(described("freight", ["items_count", "freight_value"], [50, 75, 90, 95, 99])),
    "t9_freight_by_items": frame(
        f"""SELECT l.i AS bin_order, l.label AS items_group, IFNULL(orders_count, 0) AS orders_count,
        average_freight_value, median_freight_value
        FROM (VALUES (0, '1 item'), (1, '2 items'), (2, '3 items'), (3, '4 items'), (4, '5+ items')) l(i, label)
        LEFT JOIN (SELECT items_group AS label, COUNT(*) AS orders_count, {r6(avg('freight_value'))} AS average_freight_value,
                   {r6(quant('freight_value', 0.5))} AS median_freight_value FROM freight GROUP BY 1) USING (label)"""
    ),
    "t10_category_review_summary": frame(
        "SELECT * EXCLUDE (standard_deviation) FROM ("
        + score_groups("category", "product_category", "product_category", "reviews_count")
        + ")"
    ),
    "x1_users_in_several_groups": trial(
        """SELECT COUNT(*) AS users_in_several_groups FROM (
        SELECT "user" FROM trial GROUP BY 1 HAVING COUNT(DISTINCT "group") > 1)"""
    ),
    "x2_sample_ratio": trial(
        f"""SELECT cn AS control_users, tn AS treatment_users,
        {r6('(POWER(cn - (cn + tn) / 2.0, 2) + POWER(tn - (cn + tn) / 2.0, 2)) / ((cn + tn) / 2.0)')} AS chi_square FROM sizes"""
    ),
    "x3_conversion_summary": trial(
        f"""SELECT "group", COUNT(*) AS customers_count, CAST(SUM(converted) AS BIGINT) AS conversions_count,
        {r6(avg('converted'))} AS conversion_rate, {r6(avg('converted') + ' * 100')} AS conversion_rate_percent
        FROM trial GROUP BY 1"""
    ),
    "x3_uplift": trial(
        f"""SELECT {r6(CR)} AS control_rate, {r6(TR)} AS treatment_rate, {r6(MAIN[0])} AS absolute_uplift,
        {r6(f'{MAIN[0]} / {CR}')} AS relative_uplift FROM sizes"""
    ),
    "x4_conversion_z": trial(f"SELECT {r6(MAIN[0])} AS absolute_uplift, {r6(MAIN[1])} AS z FROM sizes"),
    "x5_conversion_interval": trial(f"SELECT {r6(MAIN[2])} AS ci_lower, {r6(MAIN[3])} AS ci_upper FROM sizes"),
    "x6_conversion_effect": trial(f"SELECT {r6(f'2 * (ASIN(SQRT({TR})) - ASIN(SQRT({CR})))')} AS cohens_h FROM sizes"),
    "x7_guardrail_summary": trial(
        f"""SELECT "group", CAST(SUM(converted) AS BIGINT) AS converted_customers, {r6(avg('canceled'))} AS cancellation_rate,
        {r6(avg('CAST(value AS DECIMAL(12,2))'))} AS average_repeat_order_value,
        {r6(quant('value', 0.5))} AS median_repeat_order_value FROM trial GROUP BY 1"""
    ),
    "x8_guardrail_cancellation": trial(
        f"""SELECT {r6(CANCEL[0])} AS difference, {r6(CANCEL[1])} AS z, {r6(CANCEL[2])} AS ci_lower,
        {r6(CANCEL[3])} AS ci_upper FROM sizes"""
    ),
    "x8_guardrail_welch": trial(welch("bought", "value", TREATED)),
    "x8_guardrail_mann_whitney": trial(
        mann_whitney("bought", "value", TREATED, "GREATEST(u, CAST(n1 AS DOUBLE) * n2 - u)")
    ),
    "x10_repeat_purchases": trial("SELECT * FROM repeats"),
}
