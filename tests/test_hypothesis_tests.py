"""Statistics against closed forms and published table values."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.functions import distributions as dist
from mercato.functions import hypothesis_tests as tests


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        (dist.normal_sf(1.959963984540054), 0.025),
        (dist.normal_sf(-1.6448536269514722), 0.95),
        (dist.t_sf(2.2281388519649385, 10), 0.025),
        (dist.t_sf(-1.812461122811676, 10), 0.95),
        (dist.t_sf(12.706204736432095, 1), 0.025),
        (dist.t_sf(1.9623390808264078, 1000), 0.025),
        (dist.chi2_sf(3.841458820694124, 1), 0.05),
        (dist.chi2_sf(9.487729036781154, 4), 0.05),
        (dist.chi2_sf(0.7107230213973241, 4), 0.95),
        (dist.chi2_sf(16.918977604620448, 9), 0.05),
    ],
)
def test_tail_probabilities(value, expected):
    assert value == pytest.approx(expected, rel=1e-9)


def test_tails_at_the_extremes():
    assert dist.normal_sf(60) == 0.0
    assert dist.chi2_sf(0, 3) == 1.0
    assert dist.chi2_sf(5000, 3) == pytest.approx(0.0, abs=1e-300)
    assert dist.t_sf(0, 5) == pytest.approx(0.5)


def two_groups(spark, first, second):
    data = [(float(x), True) for x in first] + [(float(x), False) for x in second]
    return spark.createDataFrame(data, "x double, first boolean")


def test_welch_on_tiny_groups(spark):
    a, b = [1.0, 2.0, 4.0], [2.0, 6.0, 7.0, 9.0]
    row = tests.with_t_p(tests.welch(two_groups(spark, a, b), "x", F.col("first"))).first()
    va, vb = np.var(a, ddof=1) / 3, np.var(b, ddof=1) / 4
    assert row.t == pytest.approx((np.mean(a) - np.mean(b)) / math.sqrt(va + vb))
    assert row.df == pytest.approx((va + vb) ** 2 / (va**2 / 2 + vb**2 / 3))
    assert 0 < row.p_value < 1


def test_welch_sides_add_up(spark):
    base = tests.welch(two_groups(spark, [1, 2, 3, 4], [2, 3, 5, 9]), "x", F.col("first"))
    less = tests.with_t_p(base, "less").first().p_value
    greater = tests.with_t_p(base, "greater").first().p_value
    assert less + greater == pytest.approx(1.0)
    assert tests.with_t_p(base).first().p_value == pytest.approx(2 * min(less, greater))


def test_mann_whitney_brute_force(spark):
    rng = random.Random(5)
    a, b = [rng.randint(1, 6) for _ in range(25)], [rng.randint(2, 7) for _ in range(30)]
    df = two_groups(spark, a, b)
    u1 = sum((x > y) + (x == y) / 2 for x in a for y in b)
    first = tests.mann_whitney(df, "x", F.col("first"), "less").first()
    second = tests.mann_whitney(df, "x", ~F.col("first")).first()
    assert first.u == pytest.approx(u1)
    assert first.u + second.u == pytest.approx(len(a) * len(b))
    counts = np.unique(a + b, return_counts=True)[1].astype(float)
    n = len(a) + len(b)
    spread = math.sqrt(len(a) * len(b) / 12 * (n + 1 - (counts**3 - counts).sum() / (n * (n - 1))))
    assert first.z == pytest.approx((len(a) * len(b) - u1 - len(a) * len(b) / 2 - 0.5) / spread)


def ranks(values):
    order = np.sort(values)
    return np.array([(np.searchsorted(order, v) + np.searchsorted(order, v, side="right") + 1) / 2 for v in values])


def test_kruskal_brute_force(spark):
    rng = random.Random(9)
    data = [(g, float(rng.randint(1, 9) + k)) for k, g in enumerate("abc") for _ in range(20 + k)]
    row = tests.kruskal(spark.createDataFrame(data, "g string, x double"), "x", "g").first()
    values = np.array([x for _, x in data])
    r, n = ranks(values), len(values)
    groups = np.array([g for g, _ in data])
    h = 12 / (n * (n + 1)) * sum(r[groups == g].sum() ** 2 / (groups == g).sum() for g in "abc") - 3 * (n + 1)
    counts = np.unique(values, return_counts=True)[1].astype(float)
    h /= 1 - (counts**3 - counts).sum() / (n**3 - n)
    assert (row.n, row.k, row.df) == (n, 3, 2)
    assert row.h == pytest.approx(h)
    assert row.epsilon_squared == pytest.approx((h - 2) / (n - 3))


def test_correlations(spark):
    rng = random.Random(2)
    data = [(float(x), float(rng.randint(0, 5) + x // 3)) for x in (rng.randint(0, 9) for _ in range(80))]
    df = spark.createDataFrame(data, "x double, y double")
    x, y = np.array(data).T
    assert tests.pearson(df, "x", "y").first().r == pytest.approx(np.corrcoef(x, y)[0, 1])
    assert tests.spearman(df, "x", "y").first().r == pytest.approx(np.corrcoef(ranks(x), ranks(y))[0, 1])
    assert tests.spearman(df, "x", "x").first().r == pytest.approx(1.0)


def test_effects(spark):
    df = two_groups(spark, [1, 2, 3], [3, 4, 8])
    d = tests.cohens_d(df, "x", F.col("first")).first().d
    assert d == pytest.approx((2 - 5) / math.sqrt((2 * 1 + 2 * 7) / 4))
    labels = spark.createDataFrame(
        [
            ("Cohen's d", -0.19, "Negligible"),
            ("Cohen's d", 0.2, "Small"),
            ("Cohen's d", -1.4, "Large"),
            ("Spearman correlation", 0.3, "Moderate"),
            ("Epsilon-squared", 0.06, "Medium"),
            ("Other", 1.0, "Not classified"),
        ],
        "m string, v double, expected string",
    )
    for r in labels.withColumn("got", tests.effect_label(F.col("m"), F.col("v"))).collect():
        assert r.got == r.expected, r


def test_zero_conversions_give_no_number(spark):
    one = spark.range(1)
    tested = tests.proportions(F.lit(0), F.lit(10), F.lit(0), F.lit(12))
    row = one.select(*[c.alias(n) for n, c in tested.items()]).first()
    assert row.difference == 0 and row.z is None


def test_t_tail_keeps_its_digits_at_large_samples():
    from mercato.functions.distributions import normal_sf, t_sf

    for df in (1e9, 1e10, 1e11):
        for t in (0.01, 0.5, 2.0):
            assert abs(t_sf(t, df) - normal_sf(t)) < 1e-9
    assert abs(t_sf(2.0, 5.0) - 0.05096973941492917) < 1e-12
    assert abs(t_sf(1.0, 1.0) - 0.25) < 1e-12


def test_groups_by_text_ids(spark):
    from types import SimpleNamespace

    import mercato.operators.experiment as experiment

    rows = [(f"{i:032x}", True, False, 1.0) for i in range(200)]
    frame = spark.createDataFrame(rows, "customer_unique_id string, converted boolean, canceled boolean, value double")
    original = experiment.repeat_purchases
    experiment.repeat_purchases = lambda m: frame
    try:
        groups = {r.group for r in experiment.experiment_frame(SimpleNamespace()).collect()}
    finally:
        experiment.repeat_purchases = original
    assert groups == {experiment.CONTROL, experiment.TREATMENT}


def test_kruskal_is_exact_at_ten_billion_rows(spark):
    """Counts of rows instead of rows: H and its tie correction against fractions."""
    from fractions import Fraction

    cells = {("a", 1): 2_000_000_011, ("a", 2): 1_333_333_333, ("b", 1): 1_999_999_999, ("b", 2): 1_333_333_357}
    cells |= {("c", 1): 2_000_000_003, ("c", 2): 1_333_333_297, ("c", 3): 7}
    rows = [(g, v, n) for (g, v), n in cells.items()]
    for few in (False, True):
        df = spark.createDataFrame(rows, "g string, v int, n long")
        got = tests.kruskal(df, "v", "g", F.sum("n"), few=few).first()
        total = sum(cells.values())
        below, rank, ties = 0, {}, 0
        for value in (1, 2, 3):
            size = sum(n for (_, v), n in cells.items() if v == value)
            rank[value], ties, below = below + Fraction(size + 1, 2), ties + size**3 - size, below + size
        h = Fraction(0)
        for group in "abc":
            own = {v: n for (g, v), n in cells.items() if g == group}
            size = sum(own.values())
            mean = sum(rank[v] * n for v, n in own.items()) / Fraction(size) - Fraction(total + 1, 2)
            h += size * mean * mean
        h = h * 12 / (total * (total + 1)) / (1 - Fraction(ties, total**3 - total))
        assert (got["n"], got["k"], got["df"]) == (total, 3, 2)
        assert got["h"] == pytest.approx(float(h), rel=1e-9)
