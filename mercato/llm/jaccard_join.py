"""Documents linked by 5-word shingles: exact Jaccard join by T-occurrence search with DivideSkip.

Documents with the same shingle set are one class, represented by its smallest doc_id, so copies never meet.
Two classes that link at 80 % differ in at most a fifth of either, so each shows its lowest shingle
hashes: a fifth, one more, and ``EXTRA`` for pruning. Of two linked classes, the one whose prefix ends
first finds all its shared prefix hashes in the other's prefix. So every linked class has a minimum number
of prefix hashes that others show, too; classes below it (texts that share only a passage, nearly all
texts) are out before any pair is looked at. The hashes left connect classes into candidate groups.

Groups go to tasks: small ones share a task, large ones are cut into blocks of bounded size, by size band
and hash, and every two blocks that can hold a link meet in a task. A task builds inverted lists of whole
shingle sets and searches each set: sorted runs of the short lists are merged and counted, candidates with
enough occurrences are looked up in the long lists, and exact overlap decides. Two sets meet in one task only, so
every link is verified once; a task counts it for both sets, weighted by the documents of the other one, and
returns these sums and a spanning forest, not all pairs. So output is linear also in a group where everything is
alike. Components of the forests and totals of the sums are the result.

Candidates are looked up in a long list by binary search if they are few beside it. If they are many, as in a group
where everything is alike, the list is marked and each candidate reads its mark.

The short lists are merged by a stable sort of their concatenation, which detects the sorted runs; a heap of
Python objects gives the same order some fifty times slower.

Nulls: a null or blank text has no shingles and links with nothing, its component is its own doc_id. A null
doc_id never represents a class unless all of the class are null, and neither has nor is a link. A doc_id is a whole
number and names one text: repeated rows have the same result and count once; rows of one doc_id with different texts
are not told apart. Empty table: empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.components import components
from mercato.llm.tables import tidy
from mercato.llm.words import WordHashes, shingles
from mercato.session import discard, written

WIDTH = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Share of a set that its prefix holds beyond what a link needs, in percent.
EXTRA = 10
#: Shingles of one task's block; twice as many meet in a task.
BLOCK = 1_000_000
#: Cost of a binary search beside a merge step in DivideSkip's choice of long lists.
MU = 0.02
#: Candidates are searched for in a list that is longer than this many times their number.
SEARCHED = 20


def distinct_shingles(text: bytes, hashes: WordHashes) -> np.ndarray:
    return np.unique(shingles(hashes.of(text), WIDTH))


def prefix_size(count: int) -> int:
    return count - (PERCENT * count + 99) // 100 + 1 + (EXTRA * count + 99) // 100


def least_shared(count: Column) -> Column:
    """Prefix hashes that a linked set of ``count`` shingles shares at least, its partner's prefix being
    the shorter: 1 + EXTRA of the smallest partner."""
    return 1 + F.floor(count * (EXTRA * PERCENT) / 10_000)


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, digest of the set (null if empty), prefix: one row per row of ``docs``, written."""
    plain = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    names = ["doc_id", "n_shingles", "digest", "prefix"]

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sizes, digests, prefixes = [], [], []
            for text in batch.column("text").to_pylist():
                own = distinct_shingles(text, hashes)
                sizes.append(len(own))
                digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                # 48 bits tell prefix hashes apart; a collision only adds a candidate
                prefixes.append((own[: prefix_size(len(own))] >> np.uint64(16)).astype(np.int64))
            ends = pa.array(np.cumsum([0, *map(len, prefixes)]), pa.int32())
            prefix = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([*prefixes, np.zeros(0, np.int64)])))
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), prefix]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id bigint, n_shingles bigint, digest binary, prefix array<bigint>"
    return written(plain.mapInArrow(tidy(sketch), schema), "jaccard-sketches")


def candidate_groups(shown: DataFrame) -> DataFrame:
    """From sketches: class, size, group: the classes that may have links, and which of them may be connected."""
    classes = shown.filter("doc_id IS NOT NULL AND digest IS NOT NULL").groupBy("digest").agg(
        F.min("doc_id").alias("class"), F.first("n_shingles").alias("size"), F.first("prefix").alias("prefix")
    )
    postings = classes.select("class", "size", F.explode("prefix").alias("token"))
    common = postings.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("token")
    common = written(common, "jaccard-common")  # a join of two plain shuffles: a hot token can be dealt out
    shared = written(postings.join(common, "token"), "jaccard-shared")
    enough = shared.groupBy("class", "size").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_shared(F.col("size")))
    left = written(shared.join(enough.select("class"), "class"), "jaccard-left")
    centre = written(left.groupBy("token").agg(F.min("class").alias("b")), "jaccard-centre")
    edges = left.join(centre, "token").select(F.col("class").alias("a"), "b")
    groups = components(edges).select(F.col("node").alias("class"), F.col("component").alias("group"))
    found = written(groups.join(enough.select("class", "size"), "class"), "jaccard-groups")
    discard(common, shared, left, centre)
    return found


def _band(size: Column) -> Column:
    """Sets that link differ in size by at most the percentage, so they are in one band or in neighbouring ones."""
    return F.floor(F.log(size) / F.log(F.lit(100 / PERCENT)) + 1e-9)


def tasks_of(groups: DataFrame, block: int = BLOCK) -> DataFrame:
    """class, size, side, task: where every class goes. Side 1 is searched for in side 0, side 2 in itself."""
    totals = groups.groupBy("group").agg(F.sum("size").alias("total"))
    small = totals.filter(F.col("total") <= block)
    bins = max(1, ceil((small.agg(F.sum("total")).first()[0] or 0) / block))
    own = F.concat(F.lit("s"), F.pmod(F.xxhash64("group"), F.lit(bins)))
    packed = groups.join(small, "group").select("class", "size", F.lit(2).alias("side"), own.alias("task"))
    banded = groups.join(totals.filter(F.col("total") > block), "group").withColumn("band", _band(F.col("size")))
    blocks = banded.groupBy("group", "band").agg(F.ceil(F.sum("size") / block).alias("cuts"))

    def cuts(step: int) -> DataFrame:
        return blocks.select("group", (F.col("band") - step).alias("band"), F.col("cuts").alias(f"cuts{step}"))

    wide = banded.join(cuts(0), ["group", "band"]).join(cuts(1), ["group", "band"], "left").join(cuts(-1), ["group", "band"], "left")
    part = F.pmod(F.xxhash64("class"), F.col("cuts0"))

    def meeting(low_band, low, high_band, high) -> Column:
        return F.concat_ws(":", F.lit("b"), "group", low_band, low, high_band, high)

    band, each = F.col("band"), lambda n: F.sequence(F.lit(0).cast("bigint"), n - 1)
    same = F.transform(
        each(F.col("cuts0")),
        lambda j: F.struct(
            meeting(band, F.least(F.col("part"), j), band, F.greatest(F.col("part"), j)).alias("task"),
            F.when(j == F.col("part"), 2).when(j > F.col("part"), 0).otherwise(1).alias("side"),
        ),
    )
    above = F.transform(each(F.col("cuts1")), lambda j: F.struct(meeting(band, F.col("part"), band + 1, j).alias("task"), F.lit(0).alias("side")))
    below = F.transform(each(F.col("cuts-1")), lambda j: F.struct(meeting(band - 1, j, band, F.col("part")).alias("task"), F.lit(1).alias("side")))
    none = F.expr("array()").cast("array<struct<task:string,side:int>>")
    places = F.explode(F.concat(same, F.coalesce(above, none), F.coalesce(below, none)))
    cut = wide.withColumn("part", part).select("class", "size", places.alias("p")).select("class", "size", "p.side", "p.task")
    return packed.unionByName(cut)


def counted_links(
    names: np.ndarray, sides: np.ndarray, copies: np.ndarray, sets: list[np.ndarray]
) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Of the links among the sets of a task, by T-occurrence search: names, the copies that each one's
    partners stand for, and a spanning forest."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    names, sides, copies, sets = names[order], sides[order], copies[order], [sets[i] for i in order]
    sizes = np.array([len(s) for s in sets])
    ends = np.cumsum(sizes)
    tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    by_token = np.argsort(tokens, kind="stable")
    runs = np.concatenate([[True], tokens[by_token][1:] != tokens[by_token][:-1]])
    list_starts = np.flatnonzero(runs)
    list_ends = np.append(list_starts[1:], len(tokens))
    list_of = np.empty(len(tokens), dtype=np.int64)
    list_of[by_token] = np.cumsum(runs) - 1
    members = owner[by_token]  # ascending within a list
    group = np.arange(len(sets))  # connected so far
    totals = np.zeros(len(sets), dtype=np.int64)
    marked = np.zeros(len(sets), dtype=bool)
    links = []
    for x in range(len(sets)):
        if sides[x] == 0:
            continue
        need = (PERCENT * sizes[x] + 99) // 100  # overlap with any partner that is not larger
        lists = list_of[ends[x] - sizes[x] : ends[x]]
        lists = lists[list_ends[lists] - list_starts[lists] > 1]
        if len(lists) < need:
            continue
        smallest = np.searchsorted(sizes, need)
        # sets before x that are large enough; on equal sizes the order decides who asks whom
        spans = [members[a:b] for a, b in zip(list_starts[lists], list_ends[lists], strict=True)]
        if sides[x] == 2:
            spans = [m[np.searchsorted(m, smallest) : np.searchsorted(m, x)] for m in spans]
        spans = sorted((m for m in spans if len(m)), key=len)
        if len(spans) < need:
            continue
        long = min(int(need / (MU * log2(len(spans[-1]) + 1) + 1)), int(need) - 1, len(spans) - 1)
        short, long_lists = spans[: len(spans) - long], spans[len(spans) - long :]
        merged = np.sort(np.concatenate(short), kind="stable")
        at = np.flatnonzero(np.concatenate([[True], merged[1:] != merged[:-1]]))
        found, counts = merged[at], np.diff(np.append(at, len(merged)))
        keep = counts >= need - long
        if sides[x] == 1:
            keep &= sides[found] == 0
        found, counts = found[keep], counts[keep]
        for done, probed in enumerate(long_lists, 1):
            if not len(found):
                break
            if len(found) * SEARCHED < len(probed):
                place = np.minimum(np.searchsorted(probed, found), len(probed) - 1)
                counts = counts + (probed[place] == found)
            else:
                marked[probed] = True
                counts = counts + marked[found]
                marked[probed] = False
            # a partner larger than x (other block) needs more, which the last test sees to
            keep = counts + (len(long_lists) - done) >= need
            found, counts = found[keep], counts[keep]
        linked = found[100 * counts >= PERCENT * (sizes[x] + sizes[found] - counts)]
        totals[x] += copies[linked].sum()
        totals[linked] += copies[x]
        for y in linked[group[linked] != group[x]]:
            if group[y] != group[x]:
                links.append((int(names[x]), int(names[y])))
                group[group == group[y]] = group[x]
    return names, totals, links


def links(docs: DataFrame, shown: DataFrame, classes: DataFrame, block: int = BLOCK) -> DataFrame:
    """From documents, their sketches and ``classes`` (class, copies): a, b, n, written.

    Links (a, b) between classes, n null, that connect all classes connected by links; and per class a, b null, the
    documents n of other classes that link with it, in parts.
    """
    places = tasks_of(candidate_groups(shown), block)
    asked = places.groupBy("class").agg(F.collect_list(F.struct("task", "side")).alias("places"))
    asked = asked.join(classes.select("class", "copies"), "class")
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    rows = text.join(asked, text["doc_id"] == asked["class"]).select("class", "copies", "text", "places")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            made = [distinct_shingles(t, hashes).tobytes() for t in batch.column("text").to_pylist()]
            columns = [batch.column("class"), batch.column("copies"), pa.array(made, pa.binary()), batch.column("places")]
            yield pa.RecordBatch.from_arrays(columns, names=["class", "copies", "shingles", "places"])

    place = "array<struct<task:string,side:int>>"
    dealt = rows.mapInArrow(tidy(sets), f"class bigint, copies bigint, shingles binary, places {place}")
    dealt = dealt.select("class", "copies", "shingles", F.explode("places").alias("p"))
    dealt = dealt.select("class", "copies", "shingles", "p.task", "p.side")

    def search(block: pd.DataFrame) -> pd.DataFrame:
        block = block.drop_duplicates("class")  # a doc_id that stands in several rows
        own = [np.frombuffer(s, dtype=np.uint64) for s in block["shingles"]]
        names, totals, forest = counted_links(*(block[c].to_numpy() for c in ("class", "side", "copies")), own)
        counts = pd.DataFrame({"a": names, "b": None, "n": totals})[totals > 0]
        edges = pd.DataFrame(forest, columns=["a", "b"]).assign(n=None)
        return pd.concat([x.astype("Int64") for x in (counts, edges)])

    return written(dealt.groupBy("task").applyInPandas(search, "a bigint, b bigint, n bigint"), "jaccard-links")


def linked_documents(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id, class_id, n_links: one row per row of ``docs``.

    class_id is the smallest doc_id with the same shingles, n_links the number of other documents that link.
    """
    shown = sketches(docs)
    rows = shown.drop("prefix")
    classes = rows.filter("digest IS NOT NULL").groupBy("digest").agg(
        F.min("doc_id").alias("class"), F.count_distinct("doc_id").alias("copies")
    )
    classes = written(classes, "jaccard-classes")
    found = links(docs, shown, classes, block)
    connected = components(found.filter("b IS NOT NULL")).withColumnRenamed("node", "class")
    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("n"))
    named = classes.join(connected, "class", "left").join(counts, "class", "left").select(
        "digest",
        F.coalesce("component", "class").alias("component_id"),
        F.col("class").alias("class_id"),
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    joined = rows.join(named, "digest", "left")
    return joined.select(
        "doc_id",
        "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.when(F.col("doc_id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("bigint").alias("n_links"),
    )
