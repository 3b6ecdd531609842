"""Classifier metrics on tiny score columns and the fitted study on the small star data."""

from __future__ import annotations

import pytest

from mercato.functions import scoring
from mercato.operators.low_review import CATEGORICAL, FOREST, LOGISTIC, NUMERIC, PRIOR, LowReviewStudy


def scored(spark, pairs):
    rows = [(label, score, int(score > 0.5)) for label, score in pairs]
    return spark.createDataFrame(rows, "label int, score double, predicted int")


def test_constant_scores(spark):
    df = scored(spark, [(1, 0.3), (0, 0.3), (0, 0.3), (0, 0.3)])
    row = scoring.areas(df).first()
    assert (row.roc_auc, row.pr_auc) == (0.5, 0.25)
    assert tuple(scoring.decisions(df).first()) == (0.0, 0.0, 0.0)


def test_areas_by_hand(spark):
    df = scored(spark, [(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1), (1, 0.05)])
    row = scoring.areas(df).first()
    pairs = [(p, n) for p in (0.9, 0.8, 0.05) for n in (0.8, 0.1)]
    assert row.roc_auc == pytest.approx(sum((p > n) + (p == n) / 2 for p, n in pairs) / 6)
    assert row.pr_auc == pytest.approx(1 / 3 * 1 + 1 / 3 * 2 / 3 + 1 / 3 * 3 / 5)


def test_lowest_threshold_wins_a_tie(spark):
    df = scored(spark, [(1, 0.9), (0, 0.8), (0, 0.7), (1, 0.6), (1, 0.5)])
    best = scoring.best_threshold(df).first()
    assert best.threshold == 0.5 and best.f1_score == pytest.approx(0.75)


def test_confusion_cells_and_report(spark):
    df = scored(spark, [(1, 0.9), (0, 0.8), (0, 0.2)])
    cells = {(r.actual_class, r.predicted_class): r.orders_count for r in scoring.confusion(df).collect()}
    assert cells == {(0, 0): 1, (0, 1): 1, (1, 0): 0, (1, 1): 1}
    lines = {r.group: r for r in scoring.report(df, ("no", "yes")).collect()}
    assert lines["yes"].precision == 0.5 and lines["yes"].recall == 1.0
    assert lines["accuracy"].f1_score == pytest.approx(2 / 3)
    assert lines["macro avg"].recall == pytest.approx(0.75)
    assert lines["weighted avg"].support == 3


@pytest.fixture(scope="module")
def study(star):
    return LowReviewStudy(star, trees=10, depth=4, leaf=5)


def test_split_is_stratified_and_disjoint(study):
    counts = {(r.is_low_review, r.is_test): r["count"] for r in study.frame.groupBy("is_low_review", "is_test").count().collect()}
    for label in (0, 1):
        size = counts[(label, True)] + counts[(label, False)]
        assert counts[(label, True)] == int(size * 0.2 + 0.5)
    assert study.split_overlap().first().shared_orders == 0


def test_models_beat_the_prior(study):
    rows = {r.model: r for r in study.comparison().collect()}
    assert rows[PRIOR].roc_auc == pytest.approx(0.5)
    for name in (LOGISTIC, FOREST):
        assert rows[name].pr_auc > rows[PRIOR].pr_auc
    assert sum(r.orders_count for r in scoring.confusion(study.forest_scores).collect()) == study.test.count()


def test_prepared_rows_have_no_gaps(study):
    rows = study.prepared(study.test)
    assert rows.dropna(subset=NUMERIC + CATEGORICAL).count() == study.test.count()


def test_importances(study):
    direct = study.feature_importance(None).collect()
    assert sum(r.importance for r in direct) == pytest.approx(1.0)
    shuffled = {r.feature: r for r in study.permutation_importance(repeats=2).collect()}
    assert set(shuffled) == set(NUMERIC + CATEGORICAL)
    assert max(shuffled.values(), key=lambda r: r.importance_mean).feature in (
        "delivery_delay_days",
        "is_delayed",
        "delivery_time_days",
    )


def test_error_groups_cover_the_test_set(study):
    total = sum(r.orders_count for r in study.error_counts(study.delay_scores()).collect())
    assert total == study.test.count()
