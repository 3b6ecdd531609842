"""Experiment evaluation X1-X10 over one table (user, group, converted, canceled, value).

Groups reduce to two rows of sufficient statistics on the cluster; every test works on those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions import hypothesis_tests as tests
from mercato.functions.distributions import chi2_p, normal_p
from mercato.functions.numbers import mean, per
from mercato.functions.order_stats import quantiles
from mercato.market import Market
from mercato.operators.statistics import as_metrics
from mercato.session import written

CONTROL, TREATMENT = "Control", "Treatment"
WINDOW_DAYS = 30
ALPHA = 0.05
# The planned absolute effect and the part of it that counts as close enough.
ABSOLUTE_MDE = 0.005
MDE_SHARE = 0.9


def repeat_purchases(m: Market, days: int = WINDOW_DAYS) -> DataFrame:
    """Per customer the first completed order and the next order within ``days`` of it.

    Both picks are aggregates (smallest struct), so a customer with very many orders is combined
    map-side and never gathered; the join is against one row per customer.
    """
    orders = m.order_metrics.where("customer_unique_id IS NOT NULL").select(
        "customer_unique_id", "order_purchase_timestamp", "order_id", "order_status", "order_items_value"
    )
    first = (
        orders.where("order_status = 'delivered'")
        .groupBy("customer_unique_id")
        .agg(F.min("order_purchase_timestamp").alias("first_at"))
    )
    bought = F.col("order_purchase_timestamp")
    limit = F.col("first_at") + F.make_dt_interval(F.lit(days))
    follow_up = (
        orders.join(first, "customer_unique_id")
        .where((bought > F.col("first_at")) & (bought <= limit))
        .groupBy("customer_unique_id")
        .agg(F.min(F.struct("order_purchase_timestamp", "order_id", "order_status", "order_items_value")).alias("next"))
    )
    return first.join(follow_up, "customer_unique_id", "left").select(
        "customer_unique_id",
        "first_at",
        F.col("next.order_id").alias("next_order_id"),
        F.col("next").isNotNull().alias("converted"),
        (F.col("next.order_status") == "canceled").alias("canceled"),
        F.col("next.order_items_value").alias("value"),
    )


def experiment_frame(m: Market) -> DataFrame:
    """The evaluation table with users assigned by the parity of a hash of their id, numeric or text."""
    digest = F.md5(F.col("customer_unique_id").cast("string").cast("binary"))
    parity = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 2
    group = F.when(parity == 0, CONTROL).otherwise(TREATMENT)
    return repeat_purchases(m).select(
        F.col("customer_unique_id").alias("user"),
        group.alias("group"),
        F.col("converted").cast("int").alias("converted"),
        F.col("canceled").cast("int").alias("canceled"),
        "value",
    )


def users_in_several_groups(df: DataFrame) -> DataFrame:
    """Violations of one unit, one group."""
    groups = df.groupBy("user").agg(F.min("group").alias("low"), F.max("group").alias("high"))
    return groups.agg(F.count_if(F.col("low") != F.col("high")).alias("users_in_several_groups"))


def _of(group: str, value: Column) -> Column:
    return F.when(F.col("group") == group, value)


def two_groups(df: DataFrame) -> DataFrame:
    """Sizes and hits of both groups in one row (``c`` control, ``t`` treatment)."""
    parts = []
    for short, group in (("c", CONTROL), ("t", TREATMENT)):
        parts += [
            F.count(_of(group, F.lit(1))).alias(f"{short}_users"),
            F.coalesce(F.sum(_of(group, F.col("converted"))), F.lit(0)).alias(f"{short}_converted"),
            F.coalesce(F.sum(_of(group, F.when(F.col("converted") == 1, F.col("canceled")))), F.lit(0)).alias(
                f"{short}_canceled"
            ),
        ]
    return df.agg(*parts)


def sample_ratio(df: DataFrame) -> DataFrame:
    """Chi-square of the group sizes against an even split."""
    c, t = F.col("c_users"), F.col("t_users")
    half = (c + t) / 2
    return two_groups(df).select(
        c.alias("control_users"),
        t.alias("treatment_users"),
        per((c - half) * (c - half) + (t - half) * (t - half), half).alias("chi_square"),
    )


def _with_srm_p(result: DataFrame) -> DataFrame:
    return result.withColumn("srm_p", chi2_p(F.col("chi_square"), F.lit(1)))


def conversion_summary(df: DataFrame) -> DataFrame:
    """Users, conversions and rate per group."""
    return (
        df.groupBy("group")
        .agg(
            F.count("user").alias("customers_count"),
            F.sum("converted").alias("conversions_count"),
            mean(F.col("converted")).alias("conversion_rate"),
        )
        .withColumn("conversion_rate_percent", F.col("conversion_rate") * 100)
        .orderBy("group")
    )


def _rates(df: DataFrame) -> DataFrame:
    control, treated = per(F.col("c_converted"), F.col("c_users")), per(F.col("t_converted"), F.col("t_users"))
    tested = tests.proportions(F.col("t_converted"), F.col("t_users"), F.col("c_converted"), F.col("c_users"))
    return two_groups(df).select(
        control.alias("control_rate"),
        treated.alias("treatment_rate"),
        tested["difference"].alias("absolute_uplift"),
        per(tested["difference"], control).alias("relative_uplift"),
        tested["z"].alias("z"),
        tested["ci_lower"].alias("ci_lower"),
        tested["ci_upper"].alias("ci_upper"),
        tests.cohens_h(treated, control).alias("cohens_h"),
    )


def uplift(df: DataFrame) -> DataFrame:
    """Absolute and relative uplift of the treatment."""
    return _rates(df).select("control_rate", "treatment_rate", "absolute_uplift", "relative_uplift")


def conversion_z(df: DataFrame) -> DataFrame:
    """Pooled two-proportion z."""
    return _rates(df).select("absolute_uplift", "z")


def conversion_interval(df: DataFrame) -> DataFrame:
    """95 % Wald interval of the uplift."""
    return _rates(df).select("ci_lower", "ci_upper")


def conversion_effect(df: DataFrame) -> DataFrame:
    """Cohen's h of treatment against control."""
    return _rates(df).select("cohens_h")


def guardrail_summary(df: DataFrame) -> DataFrame:
    """Cancellation rate and repeat-order value among converted users."""
    converted = df.where("converted = 1")
    base = df.groupBy("group").agg(F.sum("converted").alias("converted_customers"))
    values = converted.groupBy("group").agg(
        mean(F.col("canceled")).alias("cancellation_rate"), mean(F.col("value")).alias("average_repeat_order_value")
    )
    middle = quantiles(converted, ["group"], "value", {"median_repeat_order_value": 0.5})
    return base.join(values, "group", "left").join(middle, "group", "left").orderBy("group")


def _converted_values(df: DataFrame) -> DataFrame:
    return df.where("converted = 1 AND value IS NOT NULL")


def guardrail_cancellation(df: DataFrame) -> DataFrame:
    """Difference, z and interval of the cancellation rate among converted users."""
    tested = tests.proportions(F.col("t_canceled"), F.col("t_converted"), F.col("c_canceled"), F.col("c_converted"))
    return two_groups(df).select(*[column.alias(name) for name, column in tested.items()])


def guardrail_welch(df: DataFrame) -> DataFrame:
    return tests.welch(_converted_values(df), "value", F.col("group") == TREATMENT)


def guardrail_mann_whitney(df: DataFrame) -> DataFrame:
    return tests.mann_whitney(_converted_values(df), "value", F.col("group") == TREATMENT)


def _evaluated(df: DataFrame) -> DataFrame:
    """One row with every statistic and p-value that the decision needs; the users are written once."""
    df = written(df, "trial")
    cancel = guardrail_cancellation(df).select(
        F.col("difference").alias("cancel_difference"),
        F.col("z").alias("cancel_z"),
        F.col("ci_lower").alias("cancel_lower"),
        F.col("ci_upper").alias("cancel_upper"),
    )
    welch = tests.with_t_p(guardrail_welch(df), name="welch_p")
    ranks = tests.with_u_p(guardrail_mann_whitney(df), name="u_p")
    srm = _with_srm_p(sample_ratio(df))
    extra = {
        "srm": srm.select(F.struct("control_users", "treatment_users", "chi_square", "srm_p")),
        "cancel": cancel.select(F.struct(*cancel.columns)),
        "welch": welch.select(F.struct((F.col("mean1") - F.col("mean2")).alias("value_difference"), "welch_p")),
        "ranks": ranks.select(F.struct("u_p")),
    }
    row = _rates(df).withColumns({name: frame.scalar() for name, frame in extra.items()})
    flat = row.select("*", "srm.*", "cancel.*", "welch.*", "ranks.*").drop(*extra)
    return flat.withColumn("p_value", normal_p(F.col("z"))).withColumn("cancel_p", normal_p(F.col("cancel_z")))


def sample_ratio_summary(df: DataFrame) -> DataFrame:
    return as_metrics(
        _with_srm_p(sample_ratio(df)),
        {
            "control_users": "Control customers",
            "treatment_users": "Treatment customers",
            "chi_square": "Chi-square statistic",
            "srm_p": "SRM p-value",
        },
    )


def primary_test_summary(df: DataFrame) -> DataFrame:
    return as_metrics(
        _rates(df).withColumn("p_value", normal_p(F.col("z"))),
        {
            "control_rate": "Control conversion",
            "treatment_rate": "Treatment conversion",
            "absolute_uplift": "Absolute uplift",
            "relative_uplift": "Relative uplift",
            "z": "Z-statistic",
            "p_value": "P-value",
            "ci_lower": "CI lower bound",
            "ci_upper": "CI upper bound",
        },
    )


def guardrail_test_summary(df: DataFrame) -> DataFrame:
    return as_metrics(
        _evaluated(df),
        {
            "cancel_difference": "Cancellation rate difference",
            "cancel_p": "Cancellation z-test p-value",
            "cancel_lower": "Cancellation CI lower bound",
            "cancel_upper": "Cancellation CI upper bound",
            "value_difference": "Repeat order value difference",
            "welch_p": "Welch p-value",
            "u_p": "Mann–Whitney p-value",
        },
    )


def _criteria(absolute_mde: float, alpha: float) -> dict[str, Column]:
    return {
        "No sample ratio mismatch": F.col("srm_p") >= alpha,
        "Primary metric is statistically significant": F.col("p_value") < alpha,
        "Confidence interval is above zero": F.col("ci_lower") > 0,
        "Observed uplift is close to target MDE": F.col("absolute_uplift") >= absolute_mde * MDE_SHARE,
        "Cancellation rate does not deteriorate": F.col("cancel_p") >= alpha,
        "Repeat order value does not deteriorate": (F.col("welch_p") >= alpha) & (F.col("u_p") >= alpha),
    }


def decision_table(df: DataFrame, absolute_mde: float = ABSOLUTE_MDE, alpha: float = ALPHA) -> DataFrame:
    """Every criterion with its verdict; an undefined statistic fails its criterion."""
    checks = _criteria(absolute_mde, alpha)
    row = _evaluated(df).select(*[F.coalesce(c, F.lit(False)).alias(name) for name, c in checks.items()])
    status = F.when(F.col("result"), "Passed").otherwise("Failed")
    return row.unpivot([], list(checks), "criterion", "result").withColumn("status", status)


def final_decision(df: DataFrame, absolute_mde: float = ABSOLUTE_MDE, alpha: float = ALPHA) -> DataFrame:
    """The rollout recommendation with its headline numbers."""
    passed = F.lit(True)
    for check in _criteria(absolute_mde, alpha).values():
        passed = passed & F.coalesce(check, F.lit(False))
    return _evaluated(df).select(
        F.when(passed, "Recommend rollout").otherwise("Do not recommend rollout").alias("experiment_result"),
        (F.col("absolute_uplift") * 100).alias("absolute_uplift_pp"),
        (F.col("relative_uplift") * 100).alias("relative_uplift_percent"),
        F.col("p_value").alias("primary_metric_p_value"),
        (F.col("ci_lower") * 100).alias("ci_lower_bound_pp"),
        (F.col("ci_upper") * 100).alias("ci_upper_bound_pp"),
    )
