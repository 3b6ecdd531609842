"""Mixing sources to target weights: repetition rates from word counts, hash-seeded copies.

Sources are ranked by code point with null last, and the weights repeat along that rank. The mix has
``budget`` times all words. Each source gets a share by weight but no more than ``cap`` times its own
words; what is over goes to the others by weight. The level where this settles has a closed form over
the sources in order of cap / weight, so one small window replaces the rounds. A document is emitted
floor(rate) times, and once more when the hash of its doc_id falls below the rate's fraction.

Nulls: a null text has size 0, a null source is a source, a null doc_id draws the coin of the word null.
Repeated rows are drawn alike. A source without words has rate 0. Empty table: empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.tables import attach, written

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
CAP = 2.0
SEED = 17


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def coin(doc_id: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) from 52 bits of the MD5 of the id and the seed."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def source_rates(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, cap: float = CAP
) -> DataFrame:
    """source, source_size, target, rate: one row per source."""
    sizes = docs.groupBy("source").agg(F.sum(word_count(F.col("text"))).alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (rank % len(weights)).cast("int"))
    ranked = sizes.withColumns({"weight": weight, "limit": cap * F.col("source_size")})
    # one row per source from here on
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(everything)
    levels = ranked.withColumn("level", (budget * total - before) / left)
    target = F.least("limit", F.col("weight") * F.max("level").over(everything))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return levels.withColumn("target", target).select("source", "source_size", "target", rate.alias("rate"))


def with_copies(docs: DataFrame, seed: int = SEED, **settings) -> DataFrame:
    """``docs`` with source_size, target and copies."""
    rates = written(source_rates(docs, **settings), "source-rates")
    fraction = F.col("rate") - F.floor("rate")
    copies = F.floor("rate") + (coin(F.col("doc_id"), seed) < fraction).cast("bigint")
    return attach(docs, rates, "source", F.col("doc_id")).withColumn("copies", copies).drop("rate")


def taken(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, size, source_size, target, taken: what the mix takes of each document."""
    mixed = with_copies(docs.select("doc_id", "source", "text"), **settings)
    sized = mixed.withColumn("size", word_count(F.col("text")))
    words = (F.col("size") * F.col("copies")).alias("taken")
    return sized.select("doc_id", "size", "source_size", "target", words)


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its own columns."""
    plain = docs.select("doc_id", "source", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    repeated = with_copies(plain, **settings).withColumn(
        "__copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    )
    return repeated.select("__row.*")
