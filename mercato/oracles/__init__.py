"""Independent DuckDB formulations of the registered queries."""

from __future__ import annotations

PRODUCT_SIZES = [
    "product_photos_qty",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
]
# columns that DuckDB types as INTEGER; the registered queries give every whole number as BIGINT
INTEGERS = {
    "dq9_review_score": ["review_score"],
    "ingest_customers": ["customer_zip_code_prefix"],
    "ingest_sellers": ["seller_zip_code_prefix"],
    "ingest_products": ["product_description_lenght", *PRODUCT_SIZES],
    "ingest_order_items": ["order_item_id"],
    "ingest_payments": ["payment_sequential", "payment_installments"],
    "ingest_reviews": ["review_score"],
    "ingest_geolocation": ["geolocation_zip_code_prefix"],
    "v1_products": ["product_description_length", *PRODUCT_SIZES],
    "v2_geolocation": ["zip_code_prefix"],
    "v3_orders_enriched": ["customer_zip_code_prefix"],
    "v4_order_items_enriched": [
        "order_item_id",
        "product_description_length",
        *PRODUCT_SIZES,
        "seller_zip_code_prefix",
    ],
    "v5_order_metrics": ["max_payment_installments"],
    "p5_order_frequency_groups": ["bin_order"],
    "f2_value_shape": ["columns_count"],
    "f3_frequency_groups": ["bin_order"],
    "f4_quantile_scores": ["r_score", "m_score"],
    "t9_freight_by_items": ["bin_order"],
    "t12_hypothesis_table": ["position"],
    "l1_model_frame": ["is_low_review"],
    "l2_target_distribution": ["is_low_review"],
    "l3_feature_summary": ["is_low_review"],
    "l3_delay_by_review": ["is_low_review"],
    "l4_split": ["is_low_review"],
    "l12_delay_score_report": ["position"],
    "l15_delay_score_confusion": ["actual_class", "predicted_class"],
}


def _with_bigints(text: str, columns: list[str]) -> str:
    casts = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in columns)
    return f"SELECT * REPLACE ({casts}) FROM (\n{text}\n) AS result"


def all_oracles() -> dict[str, str]:
    from mercato.oracles import eda, low_review, marts, quality, statistics

    found: dict[str, str] = {}
    for module in (quality, marts, eda, statistics, low_review):
        found |= module.ORACLES
    return {name: _with_bigints(text, INTEGERS[name]) if name in INTEGERS else text for name, text in found.items()}
