"""Hypothesis tests and effect sizes as one-row frames of sufficient statistics.

Rows are reduced on the cluster to moments or to counts per distinct value; ranks come from running
totals over those counts, so no test sorts its rows in one task. Statistics follow the usual
large-sample definitions: asymptotic Mann-Whitney with tie and 1/2 continuity correction,
tie-corrected Kruskal-Wallis, Welch with Satterthwaite degrees of freedom.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions.distributions import Z_95, chi2_p, normal_p, t_p
from mercato.functions.numbers import per
from mercato.functions.order_stats import mid_ranks


def _c(name: str) -> Column:
    return F.col(name)


def two_samples(df: DataFrame, value: str, first: Column) -> DataFrame:
    """Size, mean and sample variance of the first group (condition TRUE) and of the rest."""
    x = _c(value).cast("double")
    parts = []
    for suffix, inside in (("1", first), ("2", ~first)):
        mine = F.when(inside, x)
        parts += [
            F.count(mine).alias(f"n{suffix}"),
            F.avg(mine).alias(f"mean{suffix}"),
            F.var_samp(mine).alias(f"var{suffix}"),
        ]
    return df.agg(*parts)


def welch(df: DataFrame, value: str, first: Column) -> DataFrame:
    """t statistic and degrees of freedom of mean(first) - mean(rest), unequal variances."""
    a, b = per(_c("var1"), _c("n1")), per(_c("var2"), _c("n2"))
    return two_samples(df, value, first).select(
        *[_c(f"{name}{group}") for group in "12" for name in ("n", "mean")],
        *[F.sqrt(f"var{group}").alias(f"sd{group}") for group in "12"],
        per(_c("mean1") - _c("mean2"), F.sqrt(a + b)).alias("t"),
        per((a + b) * (a + b), per(a * a, _c("n1") - 1) + per(b * b, _c("n2") - 1)).alias("df"),
    )


def with_t_p(result: DataFrame, alternative: str = "two-sided", name: str = "p_value") -> DataFrame:
    return result.withColumn(name, t_p(_c("t"), _c("df"), alternative))


def cohens_d(df: DataFrame, value: str, first: Column) -> DataFrame:
    """Mean difference over the pooled standard deviation."""
    n1, n2 = _c("n1") - 1, _c("n2") - 1
    pooled = per(n1 * _c("var1") + n2 * _c("var2"), n1 + n2)
    return two_samples(df, value, first).withColumn("d", per(_c("mean1") - _c("mean2"), F.sqrt(pooled)))


def mann_whitney(
    df: DataFrame, value: str, first: Column, alternative: str = "two-sided", few: bool = False
) -> DataFrame:
    """U of the first group and the z score of the tail that the alternative names; ``few`` as in ``mid_ranks``."""
    ranked = mid_ranks(df, value, {"own": F.count_if(first)}, few=few)
    ties = F.col("n").cast("double")
    sums = ranked.agg(
        F.sum("own").alias("n1"),
        (F.sum("n") - F.sum("own")).alias("n2"),
        F.sum(_c("own") * _c("rank")).alias("rank_sum"),
        F.sum(ties * ties * ties - ties).alias("ties"),
    )
    n1, n2 = _c("n1").cast("double"), _c("n2").cast("double")
    n = n1 + n2
    u1 = _c("rank_sum") - n1 * (n1 + 1) / 2
    spread = F.sqrt(n1 * n2 / 12 * ((n + 1) - per(_c("ties"), n * (n - 1))))
    tested = {"greater": u1, "less": n1 * n2 - u1, "two-sided": F.greatest(u1, n1 * n2 - u1)}[alternative]
    return sums.select("n1", "n2", u1.alias("u"), per(tested - n1 * n2 / 2 - 0.5, spread).alias("z"))


def with_u_p(result: DataFrame, alternative: str = "two-sided", name: str = "p_value") -> DataFrame:
    tail = normal_p(_c("z"), "greater")  # z already points at the tested tail
    return result.withColumn(name, F.least(F.lit(1.0), tail * 2) if alternative == "two-sided" else tail)


def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    """Correlation with its t statistic on n - 2 degrees of freedom."""
    both = df.where(_c(x).isNotNull() & _c(y).isNotNull())
    r = F.corr(_c(x).cast("double"), _c(y).cast("double"))
    return _with_t(both.agg(F.count(F.lit(1)).alias("n"), r.alias("r")))


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson correlation of mid-ranks.

    Pairs are counted first; each distinct pair then looks up its two ranks.
    """
    pairs = (
        df.where(_c(x).isNotNull() & _c(y).isNotNull())
        .groupBy(_c(x).alias("x"), _c(y).alias("y"))
        .agg(F.count(F.lit(1)).alias("pairs"))
    )

    def ranks(column: str) -> DataFrame:
        counted = mid_ranks(pairs, column, count=F.sum("pairs"))
        centred = _c("rank") - (_c("n_total") + 1) / 2
        return counted.select(column, centred.alias(f"rank_{column}"))

    joined = pairs.join(ranks("x"), "x").join(ranks("y"), "y")
    w, a, b = _c("pairs"), _c("rank_x"), _c("rank_y")
    sums = joined.agg(
        F.sum(w).alias("n"),
        F.sum(w * a * b).alias("ab"),
        F.sum(w * a * a).alias("aa"),
        F.sum(w * b * b).alias("bb"),
    )
    return _with_t(sums.select("n", per(_c("ab"), F.sqrt(_c("aa") * _c("bb"))).alias("r")))


def _with_t(result: DataFrame) -> DataFrame:
    r, free = _c("r"), (_c("n") - 2).cast("double")
    left = F.greatest(F.lit(0.0), 1 - r * r)
    t = F.when(left == 0, F.signum(r) * F.lit(float("inf"))).otherwise(r * F.sqrt(per(free, left)))
    return result.select("n", "r", t.alias("t"), free.alias("df"))


def kruskal(df: DataFrame, value: str, group: str, count: Column | None = None, few: bool = False) -> DataFrame:
    """Tie-corrected H over the groups, its degrees of freedom and epsilon squared.

    Everything follows from the counts per (group, value); ``count`` replaces the row count when rows already carry
    multiplicities. Ranks count from the middle and doubled, so they and their sums are whole numbers, as is the
    correction for ties, and H is no difference of large numbers.
    """
    cells = (
        df.where(_c(value).isNotNull() & _c(group).isNotNull())
        .groupBy(_c(group).alias("g"), _c(value).alias("v"))
        .agg((F.count(F.lit(1)) if count is None else count).alias("cell"))
    )
    whole = lambda c: _c(c).cast("decimal(19,0)")
    ranked = mid_ranks(cells, "v", count=F.sum("cell"), few=few)
    ranked = ranked.select("v", (2 * _c("n_upto") - _c("n") - _c("n_total")).alias("place"), _c("n").alias("t"))
    groups = (
        cells.join(ranked, "v")
        .groupBy("g")
        .agg(
            F.sum(whole("cell") * whole("place")).alias("place_sum"),
            F.sum("cell").alias("size"),
            F.sum(_cubed(_c("cell"), _c("t"))).alias("tied"),  # adds up to the sum of t^3 - t
        )
    )
    sums = groups.agg(
        F.sum("size").alias("n"),
        F.count(F.lit(1)).alias("k"),
        F.sum(_c("place_sum").cast("double") * _c("place_sum").cast("double") / _c("size")).alias("squares"),
        F.sum("tied").alias("ties"),
    )
    n = _c("n").cast("double")
    untied = (_cubed(_c("n"), _c("n")) - _c("ties")).cast("double") / _cubed(_c("n"), _c("n")).cast("double")
    h = per(3 / (n * (n + 1)) * _c("squares"), untied)
    return sums.select("n", "k", h.alias("h"), (_c("k") - 1).alias("df")).withColumn(
        "epsilon_squared", per(_c("h") - _c("k") + 1, _c("n") - _c("k"))
    )


def _cubed(part: Column, size: Column) -> Column:
    """part * (size^2 - 1) as a whole number: exact up to 10^12 rows."""
    part, size = part.cast("decimal(12,0)"), size.cast("decimal(12,0)")
    return (part * (size * size - 1).cast("decimal(24,0)")).cast("decimal(38,0)")


def with_chi2_p(result: DataFrame, statistic: str = "h", name: str = "p_value") -> DataFrame:
    return result.withColumn(name, chi2_p(_c(statistic), _c("df")))


def proportions(hits1: Column, n1: Column, hits2: Column, n2: Column) -> dict[str, Column]:
    """Pooled two-proportion z and the 95 % Wald interval of the difference."""
    p1, p2 = per(hits1, n1), per(hits2, n2)
    pooled = per(hits1 + hits2, n1 + n2)
    shared = F.sqrt(pooled * (1 - pooled) * (per(F.lit(1), n1) + per(F.lit(1), n2)))
    own = F.sqrt(per(p1 * (1 - p1), n1) + per(p2 * (1 - p2), n2))
    return {
        "difference": p1 - p2,
        "z": per(p1 - p2, shared),
        "ci_lower": p1 - p2 - Z_95 * own,
        "ci_upper": p1 - p2 + Z_95 * own,
    }


def cohens_h(p1: Column, p2: Column) -> Column:
    return (F.asin(F.sqrt(p1)) - F.asin(F.sqrt(p2))) * 2


# Limits below which an absolute effect has the label; the last label is open-ended.
EFFECT_LIMITS = {
    "Cohen's d": ((0.2, "Negligible"), (0.5, "Small"), (0.8, "Medium"), (None, "Large")),
    "Spearman correlation": ((0.1, "Negligible"), (0.3, "Weak"), (0.5, "Moderate"), (None, "Strong")),
    "Epsilon-squared": ((0.01, "Negligible"), (0.06, "Small"), (0.14, "Medium"), (None, "Large")),
}


def effect_label(measure: Column, value: Column) -> Column:
    size = F.abs(value)
    label = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, limits in EFFECT_LIMITS.items():
        for limit, text in limits:
            label = label.when((measure == name) & (F.lit(True) if limit is None else size < limit), text)
    return label.otherwise("Not classified")
