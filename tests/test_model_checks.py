"""Evidence for the fitted models on the small star data, and random cycles over ranges."""

from __future__ import annotations

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from mercato.functions.cycles import donors
from mercato.operators import low_review, model_checks
from mercato.operators.low_review import CATEGORICAL, NUMERIC, LowReviewStudy


@pytest.fixture(scope="module")
def study(star):
    return LowReviewStudy(star, trees=7, depth=5, leaf=5)


@pytest.fixture
def many_ranges(spark):
    """Small tables stay in several ranges."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_every_job_is_one_cycle_through_all_rows(spark, many_ranges):
    sizes = {0: 400, 1: 1, 2: 2, 3: 57}
    rows = [(job, i, f"v{i}") for job, size in sizes.items() for i in range(size)]
    given = donors(spark.createDataFrame(rows, "job int, id long, value string"), "job", "id", ["value"], 5).collect()
    after = {(r["job"], r["id"]): r["donor"] for r in given}
    assert len(after) == len(given) == len(rows)
    assert all(r["value"] == f"v{r['donor']}" for r in given)
    for job, size in sizes.items():
        at, seen = 0, set()
        while at not in seen:
            seen.add(at)
            at = after[job, at]
        assert (at, len(seen)) == (0, size)
    # another job, another order
    assert any(after[0, i] != after[3, i] for i in range(57))


def test_only_job_id_and_value_are_shuffled(study):
    given = donors(study.shuffle_jobs(2), "job", "order_id", ["number", "text"], 1)
    assert set(given.columns) == {"job", "order_id", "donor", "number", "text"}
    assert set(study.shuffle_jobs(2).columns) == {"job", "order_id", "number", "text"}


def test_walked_forest_gives_the_models_probabilities(study):
    row = model_checks.forest_walk(study).first()
    assert (row["orders_checked"], row["wrong_orders"]) == (study.test.count(), 0)


def test_walk_notices_another_forest(study):
    other = LowReviewStudy(study.market, trees=7, depth=5, leaf=5, seed=study.seed)
    other.__dict__ |= {"frame": study.frame, "forest": study.forest}
    other.__dict__["forest_scores"] = study.forest_scores.withColumn("score", F.col("score") + 1e-6)
    row = model_checks.forest_walk(other).first()
    assert row["wrong_orders"] == row["orders_checked"] > 0


def test_importances_are_sums_over_the_nodes(study):
    row = model_checks.importance_check(study).first()
    assert row["features_checked"] == len(model_checks.feature_names(study, study.forest))
    assert row["wrong_features"] == 0
    assert row["importance_sum"] == pytest.approx(1.0)


def test_gradient_vanishes_at_the_fitted_coefficients(study):
    rows = model_checks.logistic_gradient(study).collect()
    assert [r["feature"] for r in rows][: len(NUMERIC) + 1] == ["(intercept)", *NUMERIC]
    assert max(abs(r["gradient"]) for r in rows) < 5e-7


def test_prepared_vectors(study):
    for row in model_checks.scaled_numbers(study).collect():
        assert (row["mean"], row["deviation"]) == (pytest.approx(0.0, abs=1e-9), pytest.approx(1.0))
    size = study.test.count()
    flags = {r["feature"]: r for r in model_checks.category_flags(study).collect()}
    assert set(flags) == set(CATEGORICAL)
    assert all(r["one_flag"] + r["no_flag"] == size and r["other"] == 0 for r in flags.values())
    totals = {r["feature"]: r["total"] for r in model_checks.vector_slots(study).collect()}
    for column in CATEGORICAL:
        assert sum(v for k, v in totals.items() if k.startswith(f"{column}_")) == flags[column]["one_flag"]


def test_checks_of_the_inputs_fit_no_model(star):
    class Unfitted(LowReviewStudy):
        @property
        def forest(self):
            raise AssertionError("a forest for its inputs")

        @property
        def logistic(self):
            raise AssertionError("a regression for its inputs")

    study = Unfitted(star)
    assert {r["feature"] for r in model_checks.category_flags(study).collect()} == set(CATEGORICAL)
    assert model_checks.vector_slots(study).count() > len(NUMERIC)
    assert {r["feature"] for r in model_checks.scaled_numbers(study).collect()} == set(NUMERIC)


def test_forest_keeps_the_nodes_of_its_rows_and_stays_the_same(study):
    forest = study.forest.stages[-1]
    assert forest.getCacheNodeIds()
    rows = study.assembly.transform(study._weighted(study.train))
    walked = RandomForestClassifier(
        featuresCol="features", labelCol="is_low_review", weightCol="weight", numTrees=7, maxDepth=5, minInstancesPerNode=5,
        featureSubsetStrategy="sqrt", seed=study.seed, cacheNodeIds=False,
    ).fit(rows)
    assert forest.toDebugString.splitlines()[1:] == walked.toDebugString.splitlines()[1:]


def test_split_and_areas_look_at_written_tables(star, monkeypatch):
    looked_at, split, areas = [], low_review.with_split, low_review.scoring.areas

    def seen_split(frame, **kwargs):
        looked_at.append(hasattr(frame, "written_to"))
        return split(frame, **kwargs)

    def seen_areas(scores, by=(), *rest):
        if by:
            looked_at.append(hasattr(scores, "written_to"))
        return areas(scores, by, *rest)

    monkeypatch.setattr(low_review, "with_split", seen_split)
    monkeypatch.setattr(low_review.scoring, "areas", seen_areas)
    study = LowReviewStudy(star, trees=2, depth=2, leaf=5)
    assert study.permutation_importance(1).count() == len(NUMERIC + CATEGORICAL)
    assert looked_at == [True, True]
