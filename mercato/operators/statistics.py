"""Hypotheses T1-T12 over completed orders: delays and reviews, value and time, items and freight, categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions import hypothesis_tests as tests
from mercato.functions.numbers import mean, per
from mercato.functions.order_stats import quantiles
from mercato.functions.profile import (
    all_labels,
    bin_labels,
    count_bins,
    describe,
    missing_counts,
    trimmed,
    with_share,
)
from mercato.market import Market
from mercato.session import written

UPPER_PERCENTILES = (0.5, 0.75, 0.9, 0.95, 0.99)
ALPHA = 0.05


def _status() -> Column:
    return F.when(F.col("is_delayed"), "Delayed").otherwise("On Time").alias("delivery_status")


def delay_reviews(m: Market) -> DataFrame:
    """Reviewed, completed orders with a known delay flag."""
    return m.delivered.where("average_review_score IS NOT NULL AND is_delayed IS NOT NULL").select(
        "order_id",
        F.col("average_review_score").alias("review_score"),
        "is_delayed",
        "delivery_time_days",
        "delivery_delay_days",
    )


def value_and_time(m: Market) -> DataFrame:
    return m.delivered.where("order_items_value IS NOT NULL AND delivery_time_days IS NOT NULL").select(
        "order_id", F.col("order_items_value").alias("order_value"), "delivery_time_days"
    )


def items_and_freight(m: Market) -> DataFrame:
    return m.delivered.where("items_count IS NOT NULL AND freight_value IS NOT NULL").select(
        "order_id",
        "items_count",
        "freight_value",
        count_bins(F.col("items_count"), 5, "item", "items").alias("items_group"),
    )


def _single_category_scores(m: Market) -> DataFrame:
    """(product_category, review_score) of every reviewed, completed order with only one category.

    An order has one category when its smallest and largest category agree, which needs no distinct
    set per order.
    """
    lines = m.rows("order_items").select("order_id", "product_id").distinct()
    category = m.products.select("product_id", F.col("product_category_name_english").alias("category"))
    single = (
        lines.join(category, "product_id")
        .groupBy("order_id")
        .agg(F.min("category").alias("product_category"), F.max("category").alias("other"))
        .where("product_category = other")
        .select("order_id", "product_category")
    )
    scores = m.delivered.where("average_review_score IS NOT NULL").select(
        "order_id", F.col("average_review_score").alias("review_score")
    )
    return single.join(scores, "order_id").select("product_category", "review_score")


def _counted(scores: DataFrame) -> DataFrame:
    return scores.groupBy("product_category", "review_score").agg(F.count(F.lit(1)).alias("orders"))


def _top_categories(counts: DataFrame, size: int) -> DataFrame:
    by_orders = counts.groupBy("product_category").agg(F.sum("orders").alias("n"))
    top = by_orders.orderBy(F.desc("n"), "product_category").limit(size)
    return F.broadcast(top.select("product_category"))  # ``size`` rows


def category_score_counts(m: Market, size: int = 10) -> DataFrame:
    """Orders per (category, score) in the categories with most single-category orders.

    A category's scores travel with it as one short list (an average with two decimals has 401 values), so the
    orders are read once for both the ranking and the counts.
    """
    scores = F.collect_list(F.struct("review_score", "orders")).alias("scores")
    counts = _counted(_single_category_scores(m))
    listed = counts.groupBy("product_category").agg(F.sum("orders").alias("n"), scores)
    top = listed.orderBy(F.desc("n"), "product_category").limit(size)
    return top.select("product_category", F.inline("scores"))


def category_reviews(m: Market, size: int = 10) -> DataFrame:
    """The same as one row per order."""
    scores = _single_category_scores(m)
    return scores.join(_top_categories(_counted(scores), size), "product_category", "left_semi")


def _score_groups(df: DataFrame, by: str) -> DataFrame:
    """Size, mean, median, deviation and low share of ``review_score`` per group."""
    score = F.col("review_score")
    moments = df.groupBy(by).agg(
        F.count(score).alias("orders_count"),
        mean(score).alias("average_review_score"),
        F.stddev_samp(score.cast("double")).alias("standard_deviation"),
        per(F.count_if(score <= 2), F.count(F.lit(1))).alias("low_score_share"),
        # exact; its buffer counts distinct averages, of which there are 401 at most
        F.percentile(score, F.lit(0.5)).alias("median_review_score"),
    )
    return moments.where("orders_count > 0").withColumn("low_score_share_percent", F.col("low_score_share") * 100)


def group_sizes(m: Market) -> DataFrame:
    return delay_reviews(m).groupBy(_status()).agg(F.count(F.lit(1)).alias("orders_count")).orderBy("delivery_status")


def delay_review_summary(m: Market) -> DataFrame:
    return _score_groups(delay_reviews(m).withColumn("delivery_status", _status()), "delivery_status")


def delay_review_distribution(m: Market) -> DataFrame:
    counts = delay_reviews(m).groupBy(_status(), "review_score").agg(F.count(F.lit(1)).alias("reviews_count"))
    return with_share(counts, "reviews_count", "share_percent", ["delivery_status"])


def delay_welch(m: Market) -> DataFrame:
    return tests.welch(delay_reviews(m), "review_score", F.col("is_delayed"))


def delay_mann_whitney(m: Market) -> DataFrame:
    return tests.mann_whitney(delay_reviews(m), "review_score", F.col("is_delayed"), "less", few=True)


def delay_effect(m: Market) -> DataFrame:
    return (
        tests.cohens_d(delay_reviews(m), "review_score", F.col("is_delayed"))
        .select("d")
        .withColumn("label", tests.effect_label(F.lit("Cohen's d"), F.col("d")))
    )


def value_time_pearson(m: Market) -> DataFrame:
    return tests.pearson(value_and_time(m), "order_value", "delivery_time_days")


def value_time_spearman(m: Market) -> DataFrame:
    return tests.spearman(value_and_time(m), "order_value", "delivery_time_days")


def items_freight_spearman(m: Market) -> DataFrame:
    return tests.spearman(items_and_freight(m), "items_count", "freight_value")


def items_freight_kruskal(m: Market) -> DataFrame:
    return tests.kruskal(items_and_freight(m), "freight_value", "items_group")


def category_kruskal(m: Market) -> DataFrame:
    return tests.kruskal(category_score_counts(m), "review_score", "product_category", F.sum("orders"), few=True)


def value_time_describe(m: Market) -> DataFrame:
    return describe(value_and_time(m), ["order_value", "delivery_time_days"], UPPER_PERCENTILES)


def items_freight_describe(m: Market) -> DataFrame:
    return describe(items_and_freight(m), ["items_count", "freight_value"], UPPER_PERCENTILES)


def value_time_missing(m: Market) -> DataFrame:
    return missing_counts(value_and_time(m))


def value_time_line(m: Market) -> DataFrame:
    """Regression line of time on value after both are cut at their 99th percentile."""
    kept = trimmed(value_and_time(m), ["order_value", "delivery_time_days"])
    y, x = F.col("delivery_time_days"), F.col("order_value").cast("double")
    return kept.agg(
        F.count(F.lit(1)).alias("orders_count"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
    )


def freight_by_items(m: Market) -> DataFrame:
    orders = items_and_freight(m)
    groups = orders.groupBy("items_group").agg(
        F.count(F.lit(1)).alias("orders_count"), mean(F.col("freight_value")).alias("average_freight_value")
    )
    middle = quantiles(orders, ["items_group"], "freight_value", {"median_freight_value": 0.5})
    return all_labels(
        groups.join(middle, "items_group"), bin_labels(5, "item", "items"), "items_group", ["orders_count"]
    )


def category_review_summary(m: Market) -> DataFrame:
    counts = category_score_counts(m)
    orders, score = F.col("orders"), F.col("review_score")
    groups = counts.groupBy("product_category").agg(
        F.sum(orders).alias("reviews_count"),
        per(F.sum(score * orders), F.sum(orders)).alias("average_review_score"),
        per(F.sum(F.when(score <= 2, orders).otherwise(0)), F.sum(orders)).alias("low_score_share"),
        F.percentile(score, F.lit(0.5), orders).alias("median_review_score"),
    )
    return groups.withColumn("low_score_share_percent", F.col("low_score_share") * 100).orderBy(
        "average_review_score", "product_category"
    )


def as_metrics(one_row: DataFrame, labels: dict[str, str]) -> DataFrame:
    """One row turned into (metric, value) lines."""
    named = one_row.select(*[F.col(c).cast("double").alias(label) for c, label in labels.items()])
    return named.unpivot([], list(labels.values()), "metric", "value")


def _delay_tests(m: Market) -> DataFrame:
    # three statistics over the same rows: the two columns are written once
    reviews = written(delay_reviews(m).select("review_score", "is_delayed"), "delay_reviews")
    ranks = tests.mann_whitney(reviews, "review_score", F.col("is_delayed"), "less", few=True)
    effect = tests.cohens_d(reviews, "review_score", F.col("is_delayed"))
    base = tests.with_t_p(tests.welch(reviews, "review_score", F.col("is_delayed")), "less", "welch_p")
    with_u = tests.with_u_p(ranks, "less", "u_p")
    return base.withColumns(
        {
            "difference": F.col("mean1") - F.col("mean2"),
            "u_p": with_u.select("u_p").scalar(),
            "d": effect.select("d").scalar(),
        }
    )


def delay_test_summary(m: Market) -> DataFrame:
    return as_metrics(
        _delay_tests(m),
        {
            "mean1": "Delayed mean",
            "mean2": "On-time mean",
            "difference": "Mean difference",
            "welch_p": "Welch p-value",
            "u_p": "Mann–Whitney p-value",
            "d": "Cohen's d",
        },
    )


def correlation_summary(m: Market) -> DataFrame:
    def line(method: str, result: DataFrame) -> DataFrame:
        return tests.with_t_p(result).select(
            F.lit(method).alias("method"), F.col("r").alias("correlation"), "p_value"
        )

    return line("Pearson", value_time_pearson(m)).unionByName(line("Spearman", value_time_spearman(m)))


def freight_test_summary(m: Market) -> DataFrame:
    rho = tests.with_t_p(items_freight_spearman(m), name="rho_p").select("r", "rho_p")
    groups = tests.with_chi2_p(items_freight_kruskal(m), name="h_p")
    both = groups.withColumns({c: rho.select(c).scalar() for c in rho.columns})
    return as_metrics(
        both,
        {
            "r": "Spearman correlation",
            "rho_p": "Spearman p-value",
            "h": "Kruskal–Wallis statistic",
            "h_p": "Kruskal–Wallis p-value",
            "epsilon_squared": "Epsilon-squared",
        },
    )


def category_test_summary(m: Market) -> DataFrame:
    return as_metrics(
        tests.with_chi2_p(category_kruskal(m)),
        {
            "h": "Kruskal–Wallis statistic",
            "p_value": "Kruskal–Wallis p-value",
            "epsilon_squared": "Epsilon-squared",
        },
    )


def hypothesis_table(m: Market, alpha: float = ALPHA) -> DataFrame:
    """All hypotheses with the weaker of their p-values, effect size, label and verdict.

    Four questions to the same fact table: it is written once and read four times.
    """
    m = m.with_written_metrics()

    def line(order: int, hypothesis: str, method: str, measure: str, result: DataFrame, p: Column, effect: str):
        return result.select(
            F.lit(order).alias("position"),
            F.lit(hypothesis).alias("hypothesis"),
            F.lit(method).alias("method"),
            p.alias("p_value"),
            F.lit(measure).alias("effect_measure"),
            F.col(effect).alias("effect_value"),
        )

    delays = line(
        1,
        "Delayed orders have lower review scores",
        "Welch t-test, Mann–Whitney U",
        "Cohen's d",
        _delay_tests(m),
        F.greatest("welch_p", "u_p"),
        "d",
    )
    value = line(
        2,
        "Higher-value orders take longer to deliver",
        "Pearson and Spearman correlation",
        "Spearman correlation",
        tests.with_t_p(value_time_spearman(m)),
        F.col("p_value"),
        "r",
    )
    freight = line(
        3,
        "Orders with more items have higher freight cost",
        "Spearman correlation, Kruskal–Wallis",
        "Epsilon-squared",
        tests.with_chi2_p(items_freight_kruskal(m)),
        F.col("p_value"),
        "epsilon_squared",
    )
    category = line(
        4,
        "Review scores differ across product categories",
        "Kruskal–Wallis",
        "Epsilon-squared",
        tests.with_chi2_p(category_kruskal(m)),
        F.col("p_value"),
        "epsilon_squared",
    )
    table = delays.unionByName(value).unionByName(freight).unionByName(category)
    return table.withColumns(
        {
            "effect_interpretation": tests.effect_label(F.col("effect_measure"), F.col("effect_value")),
            "statistically_significant": F.col("p_value") < alpha,
        }
    ).orderBy("position")
