"""Classifier evaluation from running totals over distinct scores: curves, areas, thresholds, reports.

Input frames are (label 0/1, score, ...). ``by`` evaluates many score columns or models in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions.numbers import per
from mercato.functions.order_stats import running_totals


def _c(name: str) -> Column:
    return F.col(name)


def curve(df: DataFrame, by: Sequence[str] = (), unit: float = 1e-6) -> DataFrame:
    """Per distinct score, as threshold ``>= score``: tp, fp, rates, precision and recall."""
    totals = running_totals(
        df, by, "score", {"n": F.count(F.lit(1)), "pos": F.sum("label")}, descending=True, unit=unit
    )
    tp, fp = _c("pos_upto"), _c("n_upto") - _c("pos_upto")
    return totals.select(
        *by,
        _c("score").alias("threshold"),
        "n",
        "pos",
        tp.alias("tp"),
        fp.alias("fp"),
        per(fp, _c("n_total") - _c("pos_total")).alias("false_positive_rate"),
        per(tp, _c("pos_total")).alias("recall"),
        per(tp, _c("n_upto")).alias("precision"),
        _c("pos_total").alias("positives"),
        (_c("n_total") - _c("pos_total")).alias("negatives"),
    )


def areas(df: DataFrame, by: Sequence[str] = (), unit: float = 1e-6) -> DataFrame:
    """ROC area (trapezoids) and average precision, the step sum of recall gains times precision."""
    # as doubles: the product of two counts leaves the range of BIGINT
    strip = (_c("n") - _c("pos")).cast("double") * (_c("tp") * 2 - _c("pos")).cast("double") / 2
    return (
        curve(df, by, unit)
        .groupBy(*by)
        .agg(
            per(F.sum(strip), F.max(_c("positives").cast("double") * _c("negatives"))).alias("roc_auc"),
            F.sum(per(_c("pos"), _c("positives")) * _c("precision")).alias("pr_auc"),
        )
    )


def _safe(numerator: Column, denominator: Column) -> Column:
    """Ratio that is 0 where nothing was predicted or nothing is there."""
    return F.coalesce(per(numerator, denominator), F.lit(0.0))


def _hits(label: int, predicted: int) -> Column:
    return F.count_if((_c("label") == label) & (_c("predicted") == predicted))


def decisions(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and F1 of the positive class for a ``predicted`` column."""
    tp, fp, fn = _hits(1, 1), _hits(0, 1), _hits(1, 0)
    return df.groupBy(*by).agg(
        _safe(tp, tp + fp).alias("precision"),
        _safe(tp, tp + fn).alias("recall"),
        _safe(tp * 2, tp * 2 + fp + fn).alias("f1_score"),
    )


def metrics(df: DataFrame, by: Sequence[str], unit: float = 1e-6) -> DataFrame:
    return areas(df, by, unit).join(decisions(df, by), list(by))


def sweep(df: DataFrame, unit: float = 1e-6) -> DataFrame:
    """Precision, recall and F1 for every threshold; undefined F1 rows are left out."""
    p, r = _c("precision"), _c("recall")
    return (
        curve(df, unit=unit)
        .select("threshold", "precision", "recall", per(p * r * 2, p + r).alias("f1_score"))
        .where("f1_score IS NOT NULL")
    )


def best_threshold(df: DataFrame, unit: float = 1e-6) -> DataFrame:
    """The sweep row with the largest F1; the lowest threshold wins a tie."""
    row = F.struct("f1_score", (-_c("threshold")).alias("low"), "threshold", "precision", "recall")
    return sweep(df, unit).agg(F.max(row).alias("best")).select("best.threshold", "best.precision", "best.recall", "best.f1_score")


def confusion(df: DataFrame) -> DataFrame:
    """All four cells, also the empty ones."""
    cells = df.agg(*[_hits(a, p).alias(f"{a}{p}") for a in (0, 1) for p in (0, 1)])
    long = cells.unpivot([], cells.columns, "cell", "orders_count")
    return long.select(
        F.substring("cell", 1, 1).cast("int").alias("actual_class"),
        F.substring("cell", 2, 1).cast("int").alias("predicted_class"),
        "orders_count",
    )


def report(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages."""
    cells = df.agg(*[_hits(a, p).alias(f"c{a}{p}") for a in (0, 1) for p in (0, 1)])

    def measures(k: int) -> list[Column]:
        hit, wrong, missed = _c(f"c{k}{k}"), _c(f"c{1 - k}{k}"), _c(f"c{k}{1 - k}")
        return [_safe(hit, hit + wrong), _safe(hit, hit + missed), _safe(hit * 2, hit * 2 + wrong + missed)]

    support = [_c("c00") + _c("c01"), _c("c10") + _c("c11")]
    n = support[0] + support[1]
    zero, one = measures(0), measures(1)
    accuracy = _safe(_c("c00") + _c("c11"), n)
    lines = [
        (names[0], zero, support[0]),
        (names[1], one, support[1]),
        ("accuracy", [accuracy] * 3, n),
        ("macro avg", [(a + b) / 2 for a, b in zip(zero, one, strict=True)], n),
        ("weighted avg", [_safe(a * support[0] + b * support[1], n) for a, b in zip(zero, one, strict=True)], n),
    ]
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("group"),
            p.alias("precision"),
            r.alias("recall"),
            f.alias("f1_score"),
            size.alias("support"),
        )
        for i, (name, (p, r, f), size) in enumerate(lines)
    ]
    return cells.select(F.inline(F.array(*rows)))
