"""Frame-level summaries: describe, shares, binning, histograms, box plots, missing values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions.numbers import per
from mercato.functions.order_stats import quantiles


def melted(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Long form (by..., variable, value as double)."""
    wide = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot(list(by), list(columns), "variable", "value")


def describe(
    df: DataFrame, columns: Sequence[str], percentiles: Sequence[float] = (0.25, 0.5, 0.75), unit: float = 1.0
) -> DataFrame:
    """One row per variable: count, mean, sample deviation, min, exact percentiles, max.

    All variables go through one long frame, so the source is read once for the moments and once
    for the percentiles, not once per column.
    """
    long = melted(df, columns)
    probs = {f"p{round(p * 100):02d}": p for p in percentiles}
    moments = long.groupBy("variable").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    cuts = quantiles(long, ["variable"], "value", probs, unit)
    return moments.join(cuts, "variable", "left").select("variable", "count", "mean", "std", "min", *probs, "max")


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(variable, missing_count) for every column."""
    names = list(columns or df.columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    return counts.unpivot([], names, "variable", "missing_count")


def shape(df: DataFrame) -> DataFrame:
    """Row and column count."""
    return df.agg(F.count(F.lit(1)).alias("rows_count")).withColumn("columns_count", F.lit(len(df.columns)))


def with_share(df: DataFrame, count: str, name: str, within: Sequence[str] = ()) -> DataFrame:
    """Percent of the total (or of the group's total); meant for small, already grouped frames."""
    return df.withColumn(name, per(F.col(count), F.sum(count).over(Window.partitionBy(*within))) * 100)


def count_bins(value: Column, last: int, one: str, many: str) -> Column:
    """Right-closed bins 1, 2, ... with a final open one: '1 order', '2 orders', ..., '5+ orders'."""
    label = F.when(value == 1, f"1 {one}")
    for size in range(2, last):
        label = label.when(value == size, f"{size} {many}")
    return label.when(value >= last, f"{last}+ {many}")


def bin_labels(last: int, one: str, many: str) -> list[str]:
    return [f"1 {one}", *[f"{k} {many}" for k in range(2, last)], f"{last}+ {many}"]


def all_labels(df: DataFrame, labels: Sequence[str], name: str, zeros: Sequence[str]) -> DataFrame:
    """Keep empty categories: every label appears once, in order, with zero counts where unseen."""
    order = F.posexplode(F.array(*[F.lit(label) for label in labels])).alias("bin_order", name)
    wanted = df.sparkSession.range(1).select(order)
    return wanted.join(df, name, "left").na.fill(0, list(zeros)).orderBy("bin_order")


def quantile_edges(df: DataFrame, columns: Sequence[str], parts: int) -> DataFrame:
    """One row with the ``parts + 1`` quantile edges of each column as ``<column>_edges``."""
    probs = {f"q{i}": i / parts for i in range(parts + 1)}
    edges = quantiles(melted(df, columns), ["variable"], "value", probs)
    return edges.agg(
        *[F.max(F.when(F.col("variable") == c, F.array(*probs))).alias(f"{c}_edges") for c in columns]
    )


def quantile_bin(value: Column, edges: Column, parts: int) -> Column:
    """1-based, right-closed quantile bin; equal neighbouring edges are an error."""
    clash = F.lit(False)
    for i in range(parts):
        clash = clash | (edges[i] == edges[i + 1])
    place = F.lit(1)
    for i in range(1, parts):
        place = place + (value.cast("double") > edges[i]).cast("int")
    return F.when(clash, F.raise_error(F.lit("quantile edges must be unique")).cast("int")).when(value.isNotNull(), place)


def trimmed(df: DataFrame, columns: Sequence[str], prob: float = 0.99) -> DataFrame:
    """Rows at or below the given quantile in every listed column."""
    limits = quantiles(melted(df, columns), ["variable"], "value", {"limit": prob})
    for c in columns:
        limit = limits.where(F.col("variable") == c).agg(F.max("limit").alias("limit"))
        df = df.where(F.col(c).cast("double") <= limit.scalar())
    return df


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between minimum and maximum; empty bins are kept."""
    x = F.col(column).cast("double")
    bounds = df.agg(F.min(x).alias("low"), F.max(x).alias("high"))
    span = bounds.select(F.struct("low", "high").alias("span"))
    place = F.floor((x - F.col("span.low")) / (F.col("span.high") - F.col("span.low")) * bins)
    counts = (
        df.where(F.col(column).isNotNull())
        .withColumn("span", span.scalar())
        .withColumn("bin", F.when(F.col("span.low") == F.col("span.high"), 0).otherwise(F.least(place, F.lit(bins - 1))))
        .groupBy(F.col("bin").cast("long").alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    width = (F.col("high") - F.col("low")) / bins
    frame = bounds.where("low IS NOT NULL").select(
        "low", "high", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long"))).alias("bin")
    )
    return frame.join(counts, "bin", "left").select(
        "bin",
        (F.col("low") + width * F.col("bin")).alias("bin_start"),
        (F.col("low") + width * (F.col("bin") + 1)).alias("bin_end"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def box_summary(df: DataFrame, by: Sequence[str], value: str, unit: float = 1.0) -> DataFrame:
    """Quartiles and 1.5 IQR whiskers per group, outliers left out of the whiskers."""
    box = quantiles(df, by, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, unit)
    reach = (F.col("q3") - F.col("q1")) * 1.5
    x = F.col(value)
    inside = df.join(box, list(by)).where((x >= F.col("q1") - reach) & (x <= F.col("q3") + reach))
    whiskers = inside.groupBy(*by).agg(F.min(x).alias("whisker_low"), F.max(x).alias("whisker_high"))
    return box.join(whiskers, list(by), "left")
