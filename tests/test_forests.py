"""Flat forests: scores as the model's own, and as those of rows that are walked one by one with their new value."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.ml.functions import vector_to_array

from mercato.functions import forests
from mercato.operators import model_checks
from mercato.operators.low_review import CATEGORICAL, NUMERIC, LowReviewStudy

LABELS = [f"s{i}" for i in range(70)]  # more than a word of codes
SIZE = 2 + len(LABELS)


@pytest.fixture(scope="module")
def study(star):
    return LowReviewStudy(star, trees=7, depth=5, leaf=5)


def _tree(random: np.random.Generator, tree: int, depth: int) -> list[dict]:
    nodes: list[dict] = []

    def grow(level: int) -> int:
        at = len(nodes)
        nodes.append({"tree": tree, "node": at, "stats": random.integers(1, 9, 2) * 1.0, "left": -1, "right": -1, "feature": -1, "cut": [], "categories": -1})
        if level and random.random() < 0.9:
            slot = int(random.integers(0, 2) if random.random() < 0.5 else random.integers(2, SIZE))
            split = {"cut": [float(random.integers(0, 6))]} if slot < 2 else {"cut": [float(random.integers(0, 2))], "categories": 2}
            nodes[at] |= {"feature": slot, "left": grow(level - 1), **split}
            nodes[at]["right"] = grow(level - 1)
        return at

    grow(depth)
    return nodes


def _plain(trees: list[list[dict]], x: np.ndarray) -> float:
    votes = []
    for nodes in trees:
        at = nodes[0]
        while at["left"] >= 0:
            value = x[at["feature"]]
            left = value in at["cut"] if at["categories"] >= 0 else value <= at["cut"][0]
            at = nodes[at["left"] if left else at["right"]]
        votes.append(at["stats"][1] / at["stats"].sum())
    return float(np.mean(votes))


def _vector(first: float, second: float, label: str) -> np.ndarray:
    return np.array([first, second, *(1.0 * (label == other) for other in LABELS)])


def test_exchanged_values_score_as_rows_walked_one_by_one(monkeypatch):
    monkeypatch.setattr(forests, "BLOCK_ROWS", 16)
    monkeypatch.setattr(forests, "BLOCK_UNITS", 7)
    random = np.random.default_rng(5)
    trees = [_tree(random, i, 7) for i in range(21)] + [_tree(random, 21, 0)]  # the last is a leaf
    forest = forests.FlatForest(pd.DataFrame([node for nodes in trees for node in nodes]))
    numbers, labels = random.integers(-1, 8, (50, 2)) / 1.0, random.choice([*LABELS, "unknown"], 50)
    x = np.stack([_vector(*pair, label) for pair, label in zip(numbers, labels, strict=True)])
    assert forest.scores(forest.answers(x)) == pytest.approx([_plain(trees, row) for row in x], abs=1e-12)

    row, column = random.integers(0, 50, 3000), random.integers(0, 3, 3000)
    number = random.integers(-2, 9, 3000) / 1.0
    text = random.choice([*LABELS, "unknown", "other"], 3000)
    given = pa.array(number, mask=column == 2), pa.array(text.tolist(), pa.string(), mask=column != 2)
    found = forests.Exchange(forest, SIZE, {0: 0, 1: 1}, {2: (2, LABELS)}).scores(x, row, column, *given)
    changed = x[row]
    for i, c in enumerate(column):
        changed[i] = _vector(changed[i, 0], changed[i, 1], text[i]) if c == 2 else changed[i]
        if c < 2:
            changed[i, c] = number[i]
    assert found == pytest.approx([_plain(trees, line) for line in changed], abs=1e-12)
    assert np.array_equal(found, forest.scores(forest.answers(changed)))  # to the last bit, so ties stay ties


def test_values_are_not_walked_again_by_trees_that_cannot_tell(monkeypatch):
    random = np.random.default_rng(3)
    forest = forests.FlatForest(pd.DataFrame([node for i in range(8) for node in _tree(random, i, 6)]))
    walked, walk = [], forests.FlatForest.walk

    def counted(self, at, *rest):
        walked.append(len(at))
        return walk(self, at, *rest)

    monkeypatch.setattr(forests.FlatForest, "walk", counted)
    x = np.stack([_vector(3.0, 3.0, "s1")] * 4)
    row, column = np.repeat(np.arange(4), 30), np.tile(np.repeat([0, 1, 2], 10), 4)
    number, text = pa.array(np.tile([3.0, 2.75], 60)), pa.array(["s1", "s5"] * 60)
    forests.Exchange(forest, SIZE, {0: 0, 1: 1}, {2: (2, LABELS)}).scores(x, row, column, number, text)
    # the rows themselves, then at most one label per row; 2.75 and 3.0 have no cut between them
    assert sum(walked) <= 4 * 8 * 2


def test_flat_scores_are_the_models_own(study):
    own = study.forest.transform(study.prepared(study.test)).select("order_id", vector_to_array("probability")[1].alias("own"))
    rows = study.forest_scores.join(own, "order_id").collect()
    assert len(rows) == study.test.count()
    assert max(abs(r["score"] - r["own"]) for r in rows) < 1e-9
    assert {(r["score"] > 0.5) == bool(r["predicted"]) for r in rows} == {True}


def test_permuted_scores_come_from_one_walk_per_order(study, monkeypatch):
    """The model itself scores no permuted row: it would walk all trees again for each of them."""
    study.forest_scores, study.flat_forest  # noqa: B018 - made before the model is out of reach
    monkeypatch.setattr(type(study.forest.stages[-1]), "transform", lambda *_: pytest.fail("scored job by job"))
    rows = study.permutation_importance(2).collect()
    assert {r["feature"] for r in rows} == set(NUMERIC + CATEGORICAL)
    assert all(r["importance_std"] >= 0 for r in rows)


def test_walk_check_takes_no_table_of_rows_and_trees(study):
    plan = model_checks.forest_walk(study)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" not in plan
