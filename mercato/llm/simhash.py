"""Document fingerprints: 128-bit SimHash and search within a Hamming radius. DataFrame functions only.

Terms are pairs of adjacent lower-cased words (the last word stands alone); every occurrence votes, so a
term weighs as often as it occurs. Two 64-bit hashes give 128 bits. Bit j and bit j + 32 are counted in
the halves of one sum, so a document needs 64 sums, not 128, and its terms meet in one partial aggregate.

For the edited text every row needs its successor in descending doc_id. The ids are cut at their own
percentiles into ranges; each range gets the first row of the next one appended, and a window over a
range finds successors without a global sort. Text is shuffled once, by range, and all that follows
(window, votes, comparison) stays in that partitioning.

The radius follows from the similarity to be found: two texts of 5-word Jaccard similarity 0.8 differ in a
change every 45 words, that is in 4.4 % of their word pairs, which turns 12 of 128 bits with a deviation of 3.3.
A radius of 20 is 2.5 deviations above; unrelated texts are about 64 bits apart.

Search: 128 bits are cut into ``BLOCKS`` blocks, each with a tolerance; tolerances + 1 add up to the radius + 1. So
fingerprints within the radius are within the tolerance in one block at least. Every block is a table keyed by its
value; a query asks it for all values within the tolerance. All pairs within the radius are found, each is taken in
its first table only. Equal fingerprints are one class with a count, named by its smallest doc_id, so copies are
never paired with each other.

Nulls: a null text is empty (fingerprint zero), null doc_ids come last. Ties of doc_id are ordered by the
text's digest; repeated rows follow each other. A single row is its own successor. Empty table: empty result.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.session import discard, written

BITS = 128
RADIUS = 20
#: More blocks: fewer questions of a query (1,206 for 7 blocks and radius 20), but more unrelated entries in the answers.
BLOCKS = 7
#: Rows that a range of ids holds on average, and the most ranges there are.
RANGE_ROWS = 500
MOST_RANGES = 16384
LANES = 0x0000000100000001


def terms(text: Column) -> Column:
    """Hashes of adjacent word pairs, repeats included."""
    words = F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.xxhash64(a, b))


def _lanes(term: Column, name: str) -> list[Column]:
    lane = F.lit(LANES)
    return [F.sum(F.shiftrightunsigned(term, j).bitwiseAND(lane)).alias(f"{name}{j}") for j in range(32)]


def _signed(name: str) -> Column:
    """64 bits from 32 pairs of counts: a bit is set if more than half of the terms have it."""

    def bit(j: int) -> Column:
        packed = F.coalesce(F.col(f"{name}{j % 32}"), F.lit(0))
        ones = F.shiftrightunsigned(packed, 32) if j >= 32 else packed.bitwiseAND(F.lit(0xFFFFFFFF))
        return F.shiftleft((ones * 2 > F.col("terms")).cast("bigint"), j)

    return reduce(Column.bitwiseOR, [bit(j) for j in range(64)])


def votes(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys`` with the fingerprint (hi, lo) of ``text``; rows that agree in all keys share their votes."""
    exploded = rows.withColumn("hash", F.explode_outer(terms(F.col(text)))).select(
        *keys, "hash", F.when(F.col("hash").isNotNull(), F.xxhash64("hash", F.lit(1))).alias("hash2")
    )
    counted = exploded.groupBy(*keys).agg(
        F.count("hash").alias("terms"), *_lanes(F.col("hash"), "a"), *_lanes(F.col("hash2"), "b")
    )
    return counted.select(*keys, _signed("a").alias("hi"), _signed("b").alias("lo"))


def hexadecimal(hi: Column, lo: Column) -> Column:
    return F.lower(F.concat(*[F.lpad(F.hex(x), 16, "0") for x in (hi, lo)]))


def distance(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    return sum((F.bit_count(x.bitwiseXOR(y)) for x, y in zip(a, b, strict=True)), F.lit(0))


def likeness(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    return 1 - distance(a, b) / BITS


def _ranged(docs: DataFrame) -> DataFrame:
    """``docs`` with a range of ids; higher ranges hold higher ids, the range of nulls is the lowest."""
    count = docs.count()
    cuts = min(MOST_RANGES, count // RANGE_ROWS + 1)
    shares = [i / cuts for i in range(1, cuts)]
    found = docs.agg(F.percentile_approx("doc_id", shares, max(10_000, 4 * cuts))).first()[0] if shares else None
    splits = [float("-inf"), *sorted({float(x) for x in found or []}), float("inf")]
    if len(splits) == 2:
        splits.insert(1, 0.0)
    cutter = Bucketizer(splits=splits, inputCol="__id", outputCol="__range", handleInvalid="keep")
    placed = cutter.transform(docs.withColumn("__id", F.col("doc_id").cast("double")))
    span = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(F.col("__range").cast("int"))
    return placed.withColumn("range", span).drop("__id", "__range")


def _with_next_heads(rows: DataFrame) -> DataFrame:
    """``rows`` and, in every range, the first row of the following one (after the last range: of the first)."""
    head = F.min(F.struct(F.bitwise_not("doc_id").alias("order"), "sha")).alias("head")
    heads = rows.groupBy("range").agg(head).select("range", F.bitwise_not("head.order").alias("id"), "head.sha")
    downwards = Window.orderBy(F.col("range").desc())  # at most MOST_RANGES + 1 rows
    whole = downwards.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    target = F.coalesce(F.lag("range").over(downwards), F.last("range").over(whole))
    links = F.broadcast(heads.select(target.alias("into"), F.col("id"), F.col("sha").alias("head_sha")))
    met = rows["doc_id"].eqNullSafe(links["id"]) & (rows["sha"] == links["head_sha"])
    tails = rows.join(links, met).withColumn("range", F.col("into")).select(*rows.columns)
    return rows.withColumn("tail", F.lit(False)).unionByName(tails.withColumn("tail", F.lit(True)))


def edited(docs: DataFrame) -> DataFrame:
    """Range, place in it, doc_id, text and edited text; the last rows of a range (tail) only serve as successors."""
    text = F.coalesce("text", F.lit(""))
    rows = _ranged(docs.select("doc_id", text.alias("text"))).withColumns(
        {"sha": F.unhex(F.sha2(F.col("text").cast("binary"), 256)), "n_chars": F.char_length("text").cast("bigint")}
    )
    order = Window.partitionBy("range").orderBy("tail", F.col("doc_id").desc_nulls_last(), "sha")
    placed = _with_next_heads(rows).withColumns(
        {"place": F.row_number().over(order), "next": F.coalesce(F.lead("text").over(order), F.lit(""))}
    )
    half = F.floor(F.col("n_chars") / 2).cast("int")
    mixed = F.concat(F.substr("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substr("next", F.lit(1), half))
    return placed.withColumn("edited", mixed).drop("next", "sha")


def compared(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, both fingerprints as (hi, lo) and (edited_hi, edited_lo), near_edited, near_next."""
    rows = edited(docs).withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    keys = ["range", "tail", "place", "doc_id", "n_chars", "edited_sha256"]
    both = F.explode(F.array(*[F.struct(F.lit(i).alias("version"), F.col(c).alias("body")) for i, c in enumerate(["text", "edited"])]))
    voted = votes(rows.select(*keys, both.alias("v")).select(*keys, "v.*"), [*keys, "version"], "body")
    pick = lambda c, v: F.max(F.when(F.col("version") == v, F.col(c)))
    joined = voted.groupBy(*keys).agg(
        pick("hi", 0).alias("hi"), pick("lo", 0).alias("lo"), pick("hi", 1).alias("edited_hi"), pick("lo", 1).alias("edited_lo")
    )
    order = Window.partitionBy("range").orderBy("place")
    own = (F.col("hi"), F.col("lo"))
    following = (F.col("next_hi"), F.col("next_lo"))
    lined = joined.withColumns({"next_hi": F.lead("hi").over(order), "next_lo": F.lead("lo").over(order)})
    return lined.filter(~F.col("tail")).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        *("hi", "lo", "edited_hi", "edited_lo"),
        likeness(own, (F.col("edited_hi"), F.col("edited_lo"))).alias("near_edited"),
        likeness(own, following).alias("near_next"),
    )


def _tables(radius: int) -> list[tuple[int, int, int]]:
    """First bit, end and tolerance of every block."""
    blocks = min(BLOCKS, radius + 1)
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    more, rest = divmod(radius + 1, blocks)
    found = [(a, b, more - (i >= rest)) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
    # a radius below the number of blocks makes blocks wider than 64 bits; part of a block's bits is enough as key
    return [(a, min(b, a + 63), tolerance) for a, b, tolerance in found]


def _block(hi: Column, lo: Column, a: int, b: int) -> Column:
    """Bits a..b-1; bits from 64 on are those of ``hi``."""
    mask = F.lit((1 << b - a) - 1)
    if a >= 64:
        return F.shiftrightunsigned(hi, a - 64).bitwiseAND(mask)
    low = F.shiftrightunsigned(lo, a)
    return (low if b <= 64 else low.bitwiseOR(F.shiftleft(hi, 64 - a))).bitwiseAND(mask)


def _flips(width: int, tolerance: int) -> Column:
    """All numbers of ``width`` bits with up to ``tolerance`` of them set."""
    chosen = [sum(1 << j for j in c) for n in range(tolerance + 1) for c in combinations(range(width), n)]
    return F.array(*[F.lit(x).cast("bigint") for x in chosen])


def neighbours(fingerprints: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """All (hi, lo) of ``queries`` with every entry (near_hi, near_lo, rows, distance) within ``radius`` bits.

    ``fingerprints`` (hi, lo) may repeat; ``rows`` says how often an entry occurs. A query finds itself too.
    """
    entries = fingerprints.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("rows"))
    return _near(entries, queries.select("hi", "lo").distinct(), radius)


def _near(entries: DataFrame, queries: DataFrame, radius: int) -> DataFrame:
    """``queries`` (hi, lo; no repeats) with the ``entries`` (hi, lo, others; no repeats) within the radius and their distance."""
    tables = _tables(radius)
    hi, lo = F.col("hi"), F.col("lo")
    own = [F.struct(F.lit(t).alias("t"), _block(hi, lo, a, b).alias("k")) for t, (a, b, _) in enumerate(tables)]
    right = entries.select("*", F.inline(F.array(*own))).withColumnsRenamed({"hi": "near_hi", "lo": "near_lo"})

    def values(t: int, a: int, b: int, tolerance: int) -> Column:
        return F.transform(
            _flips(b - a, tolerance), lambda x: F.struct(F.lit(t).alias("t"), _block(hi, lo, a, b).bitwiseXOR(x).alias("k"))
        )

    left = queries.select("hi", "lo", F.inline(F.concat(*[values(t, *block) for t, block in enumerate(tables)])))
    apart = distance((hi, lo), (F.col("near_hi"), F.col("near_lo")))
    differ = hi.bitwiseXOR(F.col("near_hi")), lo.bitwiseXOR(F.col("near_lo"))
    first = F.coalesce(*[F.when(F.bit_count(_block(*differ, a, b)) <= n, F.lit(t)) for t, (a, b, n) in enumerate(tables)])
    met = (left["t"] == right["t"]) & (left["k"] == right["k"])
    pairs = left.join(right, met & (apart <= radius) & (first == left["t"]))
    return pairs.select("hi", "lo", *[c for c in right.columns if c not in ("t", "k")], apart.alias("distance"))


def fingerprinted(docs: DataFrame, radius: int = RADIUS, every: int = 100) -> DataFrame:
    """The full report: ``compared`` with hexadecimal fingerprints; class_id, the smallest doc_id with the same
    fingerprint; and, for ids divisible by ``every``, the number of other rows within the radius (n_near) and the
    class_id of every other class there, ascending (near_ids; both null for other rows)."""
    rows = written(compared(docs), "fingerprints")
    asked = F.col("doc_id") % every == 0
    entries = rows.groupBy("hi", "lo").agg(
        F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("class_id"), F.max(F.coalesce(asked, F.lit(False))).alias("asked")
    )
    entries = written(entries, "fingerprint-classes")  # a join of plain shuffles: a hot key can be dealt out
    near = _near(entries.select("hi", "lo", "rows", "class_id"), entries.filter("asked").select("hi", "lo"), radius)
    found = near.groupBy("hi", "lo").agg(
        (F.sum("rows") - 1).alias("n_near"),
        F.array_sort(F.collect_set(F.when(F.col("distance") > 0, F.col("class_id")))).alias("near_ids"),
    )
    classes = entries.select("hi", "lo", "class_id").join(found, ["hi", "lo"], "left")
    classes = written(classes, "fingerprint-neighbours")
    discard(entries)
    return rows.join(classes, ["hi", "lo"], "left").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        hexadecimal(F.col("hi"), F.col("lo")).alias("fingerprint"),
        hexadecimal(F.col("edited_hi"), F.col("edited_lo")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        F.when(asked, F.col("n_near")).alias("n_near"),
        "class_id",
        F.when(asked, F.col("near_ids")).alias("near_ids"),
    )
