"""Exact duplicates by an extendible-hash index on shared files. DataFrame functions only.

Texts are equal when they are identical without white space. A first pass over the texts writes every row's hash, digest
and length. The directory starts at the depth that the number of distinct hashes asks for and doubles (one more bit
of the hash) until no slot is overfull or all bits are used; a bucket is the shortest prefix that still fits. A second
pass sends every text to its bucket through the directory; inside a bucket rows are grouped by hash, digest and the bytes
of the normalised text, so equal bytes are compared, not only digests, and copies collapse on the map side: the index
holds one entry per distinct text, however many rows share it. Entries whose hashes collide form a chain of their
bucket. The index is written in hash order by range tasks. Every row of the first pass then looks its bucket up in the
directory and its entry in the bucket by hash and digest.

Nulls: a null text counts as empty; a null doc_id is a value that comes after all others.
Ties: of rows that agree in text, length and doc_id exactly one stays.
Empty table: empty index, empty result. Other columns are ignored (``deduplicated`` keeps them).
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.tables import attach
from mercato.session import discard, written

#: Entries that a bucket holds before it splits.
CAPACITY = 4096
KEY_BITS = 64


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def _keyed(docs: DataFrame, key_bits: int) -> DataFrame:
    """``docs`` with the normalised text, its key (the upper bits count), its digest and the text's length."""
    mask = -1 << (64 - key_bits)
    return docs.withColumns(
        {"__plain": normalised(F.col("text")), "__length": F.char_length(F.coalesce("text", F.lit("")))}
    ).withColumns(
        {
            "__hash": F.xxhash64("__plain").bitwiseAND(F.lit(mask)),
            "__sha": F.unhex(F.sha2(F.col("__plain").cast("binary"), 256)),
        }
    )


def _prefix(key: Column, depth: int) -> Column:
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("bigint")


def hashed(docs: DataFrame, key_bits: int = KEY_BITS) -> DataFrame:
    """doc_id, hash, digest and length of every row, written."""
    return written(_keyed(docs.select("doc_id", "text"), key_bits).select("doc_id", "__hash", "__sha", "__length"), "dedup-rows")


def directory(rows: DataFrame, capacity: int, key_bits: int) -> tuple[DataFrame, int]:
    """The slots of the directory over the hashes of ``rows`` with the bucket each belongs to, written, and their depth.

    A bucket is the shortest prefix, from the first depth on, with no more than ``capacity`` distinct hashes. If all
    bits are used, what is left overfull are equal hashes: they stay together as chains.
    """
    hashes = written(rows.select("__hash").distinct(), "dedup-hashes")
    ideal = log2(max(1, hashes.count()) / capacity)
    first = last = min(key_bits, max(0, ceil(ideal)))
    while True:
        slots = hashes.groupBy(_prefix(F.col("__hash"), last).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
        if last == key_bits or (slots.agg(F.max("n")).first()[0] or 0) <= capacity:
            break
        last += 1  # the directory doubles
    bucket = F.struct(F.lit(last).alias("depth"), F.col("slot").alias("prefix"))
    for depth in range(last, first - 1, -1):  # the shallowest depth that fits is set last
        prefix = F.shiftrightunsigned("slot", last - depth)
        fits = F.sum("n").over(Window.partitionBy(prefix)) <= capacity
        bucket = F.when(fits, F.struct(F.lit(depth).alias("depth"), prefix.alias("prefix"))).otherwise(bucket)
    made = written(slots.select("slot", bucket.alias("bucket")), "dedup-directory")
    discard(hashes)
    return made, last


def routed(rows: DataFrame, slots: DataFrame, depth: int) -> DataFrame:
    """``rows`` (with __hash and doc_id) and the bucket that the directory names for each."""
    return attach(rows.withColumn("slot", _prefix(F.col("__hash"), depth)), slots, "slot", F.col("doc_id")).drop("slot")


def build_index(docs: DataFrame, slots: DataFrame, depth: int, key_bits: int = KEY_BITS) -> DataFrame:
    """The index as a table in the shared folder: bucket, hash, chain, digest, the row that stays, group size."""
    best = F.max(F.struct("__length", F.bitwise_not("doc_id").alias("order"))).alias("best")
    chains = Window.partitionBy("bucket", "__hash")
    twins = F.count(F.lit(1)).over(Window.partitionBy("bucket", "__hash", "__sha"))
    entries = (
        routed(_keyed(docs.select("doc_id", "text"), key_bits).drop("text"), slots, depth)
        .groupBy("bucket", "__hash", "__sha", "__plain")
        .agg(best, F.count(F.lit(1)).alias("group_size"))
        .select(
            "bucket",
            "__hash",
            "__sha",
            F.bitwise_not("best.order").alias("keep_id"),
            F.col("best.__length").alias("keep_length"),
            "group_size",
            F.row_number().over(chains.orderBy("__sha")).alias("chain"),
            F.when(twins > 1, F.raise_error(F.lit("different texts with one SHA-256"))).alias("clash"),
        )
        .filter(F.col("clash").isNull())
        .drop("clash")
    )
    return written(entries.repartitionByRange("__hash").sortWithinPartitions("__hash", "chain"), "dedup-index")


def _stays() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("__length") == F.col("keep_length"))


ENTRY = ["bucket", "__hash", "__sha"]


def exact_duplicates(docs: DataFrame, capacity: int = CAPACITY, key_bits: int = KEY_BITS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, bucket: one row per row of ``docs``."""
    rows = hashed(docs, key_bits)
    slots, depth = directory(rows, capacity, key_bits)
    index = build_index(docs, slots, depth, key_bits)
    # rows that tie in everything are numbered before the join, which then may deal a large group out
    same = Window.partitionBy("__hash", "__sha", "doc_id", "__length").orderBy("doc_id")
    numbered = routed(rows.withColumn("__first", F.row_number().over(same) == 1), slots, depth)
    return numbered.join(index, ENTRY).select(
        "doc_id",
        "keep_id",
        "group_size",
        (_stays() & F.col("__first")).alias("kept"),
        F.lower(F.hex("__sha")).alias("text_sha256"),
        F.concat_ws(":", "bucket.depth", "bucket.prefix").alias("bucket"),
    )


def deduplicated(docs: DataFrame, capacity: int = CAPACITY, key_bits: int = KEY_BITS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rows = hashed(docs, key_bits)
    slots, depth = directory(rows, capacity, key_bits)
    discard(rows)
    index = build_index(docs, slots, depth, key_bits)
    # the id as a struct: a null id equals a null id
    kept = index.select(*ENTRY, F.struct(F.col("keep_id").alias("id")).alias("__id"), F.col("keep_length").alias("__length"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    own = F.struct(*columns).alias("__row")  # columns of any name, out of the way of the joins
    whole = _keyed(docs, key_bits).select("doc_id", "__hash", "__sha", "__length", F.struct(F.col("doc_id").alias("id")).alias("__id"), own)
    keys = [*ENTRY, "__id", "__length"]
    return routed(whole, slots, depth).join(kept, keys).dropDuplicates(keys).select("__row.*")
