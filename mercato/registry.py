"""Named queries over a star-schema folder, one per operator, ready for an oracle comparison."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.functions.numbers import rounded
from mercato.functions import scoring
from mercato.market import Market
from mercato.operators import cohort, dashboard, eda, experiment, low_review, marts, model_checks, product, quality, rfm, statistics
from mercato.schema import RAW_TABLES
from mercato.session import folder_state, scratch_path
from mercato.sources import csv_ingest, warehouse

Query = Callable[[Market], DataFrame]


def portable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Output types both engines share: BIGINT, DOUBLE with six decimals, text, dates, flags."""

    def cast(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            return column.cast("bigint").alias(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            # beyond 1e14 a double has no sixth decimal to round, and DECIMAL(24,9) no room
            fits = F.abs(column) < 1e14
            return F.when(fits, rounded(F.when(fits, column), digits)).otherwise(column).alias(field.name)
        return column

    return df.select(*[cast(field) for field in df.schema.fields])


# the test data has numeric ids where the file contract has text
NUMERIC_IDS = {
    name: T.LongType()
    for name in ("customer_id", "customer_unique_id", "seller_id", "product_id", "order_id", "review_id")
}


def _ingested(table: str) -> Query:
    """Write a raw table as CSV and load it back through the strict reader."""

    def run(m: Market) -> DataFrame:
        path = csv_ingest.write_csv(m.raw(table), scratch_path(m.spark, f"csv-{table}"))
        return csv_ingest.read_table(m.spark, path, table, NUMERIC_IDS)

    return run


# how the stand-in file of the quarantine query spoils values; (column, every so many orders, remainder, text)
SPOILT = [
    ("payment_value", 23, 1, "concat(payment_value, 'x')"),
    ("payment_value", 23, 2, "concat(payment_value, '7')"),
    ("payment_installments", 29, 3, "'2.5'"),
    ("payment_sequential", 31, 4, "'one'"),
    ("payment_installments", 37, 5, "' '"),
]


def _quarantined(m: Market) -> DataFrame:
    """Payments written as CSV with some spoilt values, loaded in one pass into good and bad rows: every bad value,
    and per column how many rows came through."""
    rows = m.raw("payments").select([F.col(c).cast("string") for c in RAW_TABLES["payments"].names])
    for column, every, rest, text in SPOILT:
        chosen = F.expr(f"CAST(order_id AS BIGINT) % {every} = {rest}")
        rows = rows.withColumn(column, F.when(chosen, F.expr(text)).otherwise(F.col(column)))
    path = csv_ingest.write_csv(rows, scratch_path(m.spark, "csv-spoilt"))
    good, bad = csv_ingest.load_with_quarantine(m.spark, path, "payments", scratch_path(m.spark, "quarantine"), NUMERIC_IDS)
    order = F.get_json_object("row", "$.order_id").cast("bigint").alias("order_id")
    listed = bad.select(order, "column", "value", "reason").groupBy("order_id", "column", "value", "reason")
    counts = listed.agg(F.count(F.lit(1)).alias("rows_count"))
    through = good.agg(F.count(F.lit(1)).alias("rows_count")).select(
        F.lit(None).cast("bigint").alias("order_id"), F.lit("*").alias("column"), F.lit(None).cast("string").alias("value"),
        F.lit("loaded").alias("reason"), "rows_count",
    )
    return counts.unionByName(through)


def _refused(m: Market) -> DataFrame:
    """What a run says that expects the orders' number of every table: the tables with another number of rows."""
    orders = m.raw("orders").agg(F.count(F.lit(1)).alias("row_count"))
    return quality.refused_row_counts(m, {name: orders for name in RAW_TABLES})


def _bucketed(m: Market) -> DataFrame:
    """The tables saved to the catalog, bucketed by order, and read back: items and payments per order status, by joins
    of equal buckets."""
    database = f"layout_{uuid4().hex}"
    warehouse.save_tables(m, database, buckets=8)
    shop = Market.from_catalog(m.spark, database)
    items = shop.raw("order_items").groupBy("order_id").agg(F.count(F.lit(1)).alias("items"), F.sum("price").alias("price"))
    paid = shop.raw("payments").groupBy("order_id").agg(F.count(F.lit(1)).alias("payments"))
    joined = shop.raw("orders").join(items, "order_id", "left").join(paid, "order_id", "left")
    return joined.groupBy("order_status").agg(
        F.count(F.lit(1)).alias("orders_count"),
        F.sum("items").alias("items_count"),
        F.sum("payments").alias("payments_count"),
        F.sum("price").alias("products_value"),
    )


def _reloaded(m: Market) -> DataFrame:
    """Load all CSV tables twice into one place: the second refresh replaces the first."""
    root = scratch_path(m.spark, "reload")
    for table in RAW_TABLES:
        csv_ingest.write_csv(m.raw(table), f"{root}/csv/{table}.csv")
    for _ in range(2):
        csv_ingest.ingest(m.spark, f"{root}/csv", f"{root}/raw")
    return quality.raw_row_counts(Market.from_parquet(m.spark, f"{root}/raw"))


def _sql_scan(m: Market) -> DataFrame:
    warehouse.register_views(m)
    return m.spark.sql(
        "SELECT order_status, COUNT(*) AS orders_count, SUM(items_count) AS items_count "
        "FROM order_metrics GROUP BY order_status"
    )


def _exported(m: Market) -> DataFrame:
    """Export every mart, read the CSV files back and count their rows."""
    folder = scratch_path(m.spark, "marts")
    names = warehouse.export_marts(m, folder)
    return quality.stacked(
        [
            warehouse.read_mart_csv(m.spark, folder, name)
            .agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.lit(name).alias("mart"), "row_count")
            for name in names
        ]
    )


def study_of(m: Market) -> low_review.LowReviewStudy:
    """One study per market, so a model is fitted once for all queries that look at it."""
    if not hasattr(m, "_study"):
        m._study = low_review.LowReviewStudy(m)
    return m._study


def _decided(scores: DataFrame) -> DataFrame:
    return low_review.LowReviewStudy.at_best_threshold(scores)


def _on_trial(evaluate: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda m: evaluate(experiment.experiment_frame(m))


def all_queries() -> dict[str, Query]:
    named: dict[str, Query] = {
        "v1_products": lambda m: m.products,
        "v2_geolocation": lambda m: m.geolocation,
        "v3_orders_enriched": lambda m: m.orders_enriched,
        "v4_order_items_enriched": lambda m: m.order_items_enriched,
        "v5_order_metrics": lambda m: m.order_metrics,
    }
    named |= {f"m{i}_{name}": build for i, (name, build) in enumerate(marts.MARTS.items(), 1)}
    named |= {
        "e1_time_coverage": eda.time_coverage,
        "e2_orders_per_month": eda.orders_per_month,
        "e2_boundary_months": eda.boundary_months,
        "e3_status_shares": eda.status_shares,
        "e4_status_by_year": eda.status_by_year,
        "e5_value_by_status": eda.value_by_status,
        "e6_missing_summary": eda.missing_summary,
        "e7_missing_by_status": eda.missing_by_status,
        "e8_order_value_describe": eda.order_value_describe,
        "e8_largest_orders": eda.largest_orders,
        "e8_order_value_limit": eda.order_value_limit,
        "e8_order_value_histogram": eda.order_value_histogram,
        "e9_delivery_summary": eda.delivery_summary,
        "e10_delivery_time_describe": eda.delivery_time_describe,
        "e10_slowest_deliveries": eda.slowest_deliveries,
        "e10_delivery_time_histogram": eda.delivery_time_histogram,
        "e11_delays_by_state": eda.delays_by_state,
        "e11_most_delayed_states": eda.most_delayed_states,
        "e12_review_distribution": eda.review_distribution,
        "e13_review_summary": eda.review_summary,
        "e14_reviews_by_delay": eda.reviews_by_delay,
        "e15_category_performance": eda.category_performance,
        "e15_top_categories": lambda m: eda.category_performance(m, 15),
        "e16_orders_by_state": eda.orders_by_state,
        "e16_top_states": lambda m: eda.orders_by_state(m, 10),
        "p1_overall_metrics": product.overall_metrics,
        "p2_monthly_product_metrics": lambda m: product.monthly_product_metrics(m, cohort.complete_months(m)),
        "p3_customer_orders": product.customer_orders,
        "p3_customer_orders_describe": product.customer_orders_describe,
        "p4_repeat_customer_share": product.repeat_customer_share,
        "p5_order_frequency_groups": product.order_frequency_groups,
        "p6_monthly_customers": lambda m: product.monthly_customers(m, cohort.complete_months(m)),
        "p7_customer_types": lambda m: product.customer_types(m, cohort.complete_months(m)),
        "p7_repeat_share_by_month": lambda m: product.repeat_share_by_month(m, cohort.complete_months(m)),
        "p8_items_per_order": lambda m: product.items_per_order_by_month(m, cohort.complete_months(m)),
        "c1_customer_activity": cohort.customer_activity,
        "c2_cohort_sizes": lambda m: cohort.cohort_sizes(m, cohort.complete_months(m)),
        "c3_cohort_counts": cohort.cohort_counts,
        "c3_retention_counts": lambda m: cohort.retention_counts(m, cohort.complete_months(m)),
        "c3_retention_matrix": lambda m: cohort.retention_matrix(m, cohort.complete_months(m)),
        "c4_horizon_comparison": lambda m: cohort.horizon_comparison(m, cohort.complete_months(m)),
        "c5_horizon_long": lambda m: cohort.horizon_long(m, cohort.complete_months(m)),
        "c6_retention_summary": lambda m: cohort.retention_summary(m, cohort.complete_months(m)),
        "f1_customer_values": rfm.customer_values,
        "f2_value_profile": rfm.value_profile,
        "f2_value_missing": rfm.value_missing,
        "f2_value_shape": rfm.value_shape,
        "f2_recency_histogram": lambda m: rfm.value_histogram(m, "recency"),
        "f2_monetary_histogram": lambda m: rfm.value_histogram(m, "monetary"),
        "f3_frequency_distribution": rfm.frequency_distribution,
        "f3_frequency_groups": rfm.frequency_groups,
        "f4_quantile_scores": lambda m: rfm.quantile_scored(m).drop("segment"),
        "f4_score_profile": rfm.score_profile,
        "f5_total_score_distribution": rfm.total_score_distribution,
        "f6_segments": lambda m: rfm.quantile_scored(m).select("customer_unique_id", "segment"),
        "f7_segment_summary": rfm.segment_summary,
        "f7_segment_value_comparison": rfm.segment_value_comparison,
    }
    named |= dashboard.PAGES | quality.CHECKS
    named |= {f"ingest_{table}": _ingested(table) for table in RAW_TABLES}
    named |= {"src5_quarantined_payments": _quarantined, "src9_bucketed_orders": _bucketed, "dq15_refused_row_counts": _refused}
    named |= {"src6_reload_counts": _reloaded, "src8_sql_scan": _sql_scan, "src10_exported_marts": _exported}
    named |= {
        "t1_group_sizes": statistics.group_sizes,
        "t1_delay_review_summary": statistics.delay_review_summary,
        "t1_delay_review_distribution": statistics.delay_review_distribution,
        "t2_delay_welch": statistics.delay_welch,
        "t3_delay_mann_whitney": statistics.delay_mann_whitney,
        "t4_delay_effect": statistics.delay_effect,
        "t5_value_time_pearson": statistics.value_time_pearson,
        "t6_value_time_spearman": statistics.value_time_spearman,
        "t6_items_freight_spearman": statistics.items_freight_spearman,
        "t7_items_freight_kruskal": statistics.items_freight_kruskal,
        "t8_category_kruskal": statistics.category_kruskal,
        "t9_value_time_describe": statistics.value_time_describe,
        "t9_value_time_missing": statistics.value_time_missing,
        "t9_value_time_line": statistics.value_time_line,
        "t9_items_freight_describe": statistics.items_freight_describe,
        "t9_freight_by_items": statistics.freight_by_items,
        "t10_category_review_summary": statistics.category_review_summary,
        "t11_delay_test_summary": statistics.delay_test_summary,
        "t11_correlation_summary": statistics.correlation_summary,
        "t11_freight_test_summary": statistics.freight_test_summary,
        "t11_category_test_summary": statistics.category_test_summary,
        "t12_hypothesis_table": statistics.hypothesis_table,
    }
    trials = {
        "x1_users_in_several_groups": experiment.users_in_several_groups,
        "x2_sample_ratio": experiment.sample_ratio,
        "x2_sample_ratio_summary": experiment.sample_ratio_summary,
        "x3_conversion_summary": experiment.conversion_summary,
        "x3_uplift": experiment.uplift,
        "x4_conversion_z": experiment.conversion_z,
        "x4_primary_test_summary": experiment.primary_test_summary,
        "x5_conversion_interval": experiment.conversion_interval,
        "x6_conversion_effect": experiment.conversion_effect,
        "x7_guardrail_summary": experiment.guardrail_summary,
        "x8_guardrail_cancellation": experiment.guardrail_cancellation,
        "x8_guardrail_welch": experiment.guardrail_welch,
        "x8_guardrail_mann_whitney": experiment.guardrail_mann_whitney,
        "x8_guardrail_test_summary": experiment.guardrail_test_summary,
        "x9_decision_table": experiment.decision_table,
        "x9_final_decision": experiment.final_decision,
    }
    named |= {name: _on_trial(evaluate) for name, evaluate in trials.items()}
    named |= {
        "l1_model_frame": low_review.model_frame,
        "l1_missing_features": low_review.missing_features,
        "l2_target_distribution": low_review.target_distribution,
        "l3_feature_describe": low_review.feature_describe,
        "l3_feature_summary": low_review.feature_summary,
        "l3_delay_by_review": low_review.delay_by_review,
        "l4_split": lambda m: study_of(m).frame.select("order_id", "is_low_review", "is_test"),
        "l4_split_summary": lambda m: study_of(m).split_summary(),
        "l4_split_overlap": lambda m: study_of(m).split_overlap(),
        "l5_fill_values": lambda m: study_of(m).fill_values(),
        "l5_scaled_numbers": lambda m: model_checks.scaled_numbers(study_of(m)),
        "l6_category_flags": lambda m: model_checks.category_flags(study_of(m)),
        "l7_vector_slots": lambda m: model_checks.vector_slots(study_of(m)),
        "l9_logistic_gradient": lambda m: model_checks.logistic_gradient(study_of(m)),
        "l10_forest_walk": lambda m: model_checks.forest_walk(study_of(m)),
        "l16_importance_check": lambda m: model_checks.importance_check(study_of(m)),
        "l17_cycle_check": lambda m: model_checks.cycle_check(study_of(m)),
        "l8_prior_metrics": lambda m: study_of(m).prior_metrics(),
        "l9_logistic_metrics": lambda m: study_of(m).comparison([low_review.LOGISTIC]),
        "l10_forest_metrics": lambda m: study_of(m).comparison([low_review.FOREST]),
        "l11_model_comparison": lambda m: study_of(m).comparison(),
        "l11_delay_score_metrics": lambda m: scoring.metrics(study_of(m).delay_scores(), ["model"]),
        "l12_delay_score_report": lambda m: scoring.report(study_of(m).delay_scores(), low_review.CLASS_NAMES),
        "l12_logistic_report": lambda m: scoring.report(study_of(m).logistic_scores, low_review.CLASS_NAMES),
        "l12_forest_report": lambda m: scoring.report(study_of(m).forest_scores, low_review.CLASS_NAMES),
        "l13_delay_score_curve": lambda m: scoring.curve(study_of(m).delay_scores()),
        "l13_forest_curve": lambda m: scoring.curve(study_of(m).forest_scores),
        "l14_delay_score_sweep": lambda m: scoring.sweep(study_of(m).delay_scores()),
        "l14_delay_score_best": lambda m: scoring.best_threshold(study_of(m).delay_scores()),
        "l14_forest_best": lambda m: scoring.best_threshold(study_of(m).forest_scores),
        "l15_delay_score_threshold": lambda m: study_of(m).threshold_metrics(study_of(m).delay_scores()),
        "l15_delay_score_confusion": lambda m: scoring.confusion(_decided(study_of(m).delay_scores())),
        "l15_forest_confusion": lambda m: scoring.confusion(_decided(study_of(m).forest_scores)),
        "l16_feature_importance": lambda m: study_of(m).feature_importance(),
        "l17_permutation_importance": lambda m: study_of(m).permutation_importance(),
        "l18_delay_score_error_counts": lambda m: study_of(m).error_counts(study_of(m).delay_scores()),
        "l18_delay_score_error_groups": lambda m: study_of(m).error_groups(study_of(m).delay_scores()),
        "l18_delay_score_error_boxes": lambda m: study_of(m).error_boxes(study_of(m).delay_scores()),
        "l18_forest_error_groups": lambda m: study_of(m).error_groups(study_of(m).forest_scores),
    }
    named["x10_repeat_purchases"] = experiment.repeat_purchases
    return named


_markets: dict[tuple, Market] = {}


def market_of(spark: SparkSession, folder: str) -> Market:
    """One set of plans per application and state of a folder. The plans hold no data but for the low-review study, whose
    frame and models are made once; a replaced input file makes a new market."""
    key = (spark.sparkContext.applicationId, folder, folder_state(spark, folder))
    if key not in _markets:
        _markets[key] = Market.from_star(spark, folder)
    return _markets[key]


def bound(query: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return portable(query(market_of(spark, folder)))

    return run
