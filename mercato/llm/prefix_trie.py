"""The prefix trie of conversations, summed over subtrees by the Euler-tour technique.

A node is a distinct sequence of first turns. Its key is the sum of the hashes of its turns, each with its place, in
two numbers of 61 bits, so keys are running sums and a conversation of any length is spread over tasks. A node's
smallest member and depth name it, and in that order nodes are numbered. Every node has an arc that enters it and one
that leaves it: enter goes on to the first child's enter, else to its own exit; exit to the next sibling's enter, else
to the parent's exit. ``list_ranking`` ranks that tour with three weights: steps, leaves and saved tokens. A subtree is the
stretch between a node's arcs, so its leaves and savings are differences of the sums there. Because children come by
smallest member, the tour mostly runs through neighbouring numbers.

No step holds the children of a node or the turns of a conversation in one task: order is kept by ranges
(``ordered``), parents with very many children meet them in a broadcast of bounded size. A node's digest of ended
conversations streams through its task in parts of DIGEST_IDS ids, in memory for one part.

Rows without a conversation id belong to no conversation and are left out. Null turns come first, null roles and texts
are empty; turns of equal number come by role, then digest of the text; repeated rows are turns of their own. Other
columns may have any name. A conversation without turns ends at the root. Empty table: no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm import ordered
from mercato.llm.list_ranking import ranked
from mercato.llm.tables import written
from mercato.session import discard

#: Conversation ids of one part of a digest.
DIGEST_IDS = 10_000
PRIME = (1 << 61) - 1
WEIGHTS = ["steps", "leaves", "saved"]


def numbered_turns(rows: DataFrame) -> DataFrame:
    """conv_id, place (from 1, by turn), digest of role and text, and the text's UTF-8 bytes; written."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.char_length(role), F.lit(":"), role, text).cast("binary")
    turns = rows.filter("conv_id IS NOT NULL").select(
        "conv_id",
        "turn",
        role.alias("role"),
        F.sha2(text.cast("binary"), 256).alias("text_sha"),
        F.unhex(F.sha2(whole, 256)).alias("digest"),
        F.octet_length(text).cast("bigint").alias("bytes"),
        F.monotonically_increasing_id().alias("__row"),  # deals repeated rows out
    )
    order = ["turn", "role", "text_sha", "__row"]
    ranges = ordered.dealt(turns, ["conv_id", *order], "trie-turns")
    placed = ordered.running(ranges, ["conv_id"], order, "place", {})
    made = written(placed.select("conv_id", "place", "digest", "bytes"), "trie-turns")
    discard(ranges)
    return made


def prefixes(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """Every conversation's node at every depth, the root included, and whether the conversation ends there; written.

    ``turns``: conv_id, place (from 1 without gaps), digest, bytes. ``conversations``: conv_id, n_turns."""
    hashed = turns.select("conv_id", "place", "bytes", *[
        F.xxhash64(F.lit(seed), "place", "digest").cast("decimal(38,0)").alias(name) for seed, name in ((1, "a"), (2, "b"))
    ])
    ranges = ordered.dealt(hashed, ["conv_id", "place"], "trie-hashes")
    summed = ordered.running(ranges, ["conv_id"], ["place"], "__place", {"upto_a": "a", "upto_b": "b"})
    key = lambda c: F.pmod(c, F.lit(PRIME).cast("decimal(38,0)")).cast("bigint")
    sizes = conversations.select("conv_id", "n_turns")
    total = turns.count()
    ended = ordered.looked_up(summed, sizes, ["conv_id"], "n_turns", total)
    zero = F.lit(0).cast("bigint")
    nodes = ended.select(
        "conv_id",
        F.col("place").cast("bigint").alias("depth"),
        key(F.col("upto_a")).alias("k1"),
        key(F.col("upto_b")).alias("k2"),
        key(F.col("upto_a") - F.col("a")).alias("p1"),
        key(F.col("upto_b") - F.col("b")).alias("p2"),
        "bytes",
        (F.col("place") == F.col("n_turns")).alias("ends"),
    )
    roots = sizes.select(
        "conv_id", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), F.lit(None).cast("bigint").alias("p1"),
        F.lit(None).cast("bigint").alias("p2"), zero.alias("bytes"), (F.col("n_turns") == 0).alias("ends"),
    )
    made = written(nodes.unionByName(roots), "trie-prefixes")
    discard(ranges)
    return made


def _digests(paths: DataFrame) -> DataFrame:
    """k1, k2, depth and the digest of the ids of the conversations that end there, ascending, joined by commas."""
    key = ["k1", "k2", "depth"]
    ranges = ordered.dealt(paths.filter("ends").select(*key, "conv_id"), [*key, "conv_id"], "trie-ends")
    placed = ordered.running(ranges, key, ["conv_id"], "place", {})
    part = F.floor((F.col("place") - 1) / DIGEST_IDS)
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda i: i.cast("string")), ",")
    parts = placed.groupBy(*key, part.alias("part")).agg(ids.alias("ids"))
    streams = parts.repartition(*key).sortWithinPartitions(*key, "part")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        names = [*key, "ends_sha256"]
        for batch in batches:
            done = []
            for *node, ids in zip(*[batch.column(n).to_pylist() for n in [*key, "ids"]], strict=True):
                if node != current:
                    if current:
                        done.append((*current, state.hexdigest()))
                    current, state = node, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=names)
        if current:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*current, state.hexdigest())], names=names)

    return streams.mapInArrow(digest, "k1 long, k2 long, depth long, ends_sha256 string")


def _numbered(paths: DataFrame) -> DataFrame:
    """The nodes: node (from 0, by smallest member and depth), its key and its parent's, members, saving; written."""
    nodes = paths.groupBy("depth", "k1", "k2").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("p1").alias("p1"), F.max("p2").alias("p2"),
        F.max("bytes").alias("bytes"),
    )
    ranges = ordered.dealt(nodes, ["conv_id", "depth"], "trie-nodes")
    placed = ordered.running(ranges, [], ["conv_id", "depth"], "place", {})
    made = written(placed.withColumn("node", F.col("place") - 1).drop("place"), "trie-nodes")
    discard(ranges)
    return made


def tour(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes with parent, parent_conv_id and n_children, written; and the arcs: id (2 * node enters, 2 * node + 1 leaves), next, weights."""
    above = nodes.filter("depth > 0").groupBy("p1", "p2", "depth").agg(F.count(F.lit(1)).alias("n_children"), F.min("node").alias("first"))
    keyed = above.select(F.col("p1").alias("k1"), F.col("p2").alias("k2"), (F.col("depth") - 1).alias("depth"), "n_children", "first")
    parents = written(nodes.join(keyed, ["k1", "k2", "depth"], "left").fillna(0, ["n_children"]), "trie-parents")
    lookup = parents.filter("n_children > 0").select(
        F.col("k1").alias("p1"), F.col("k2").alias("p2"), (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"),
        F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("siblings"),
    )
    total = parents.count()
    below = ordered.looked_up(parents.filter("depth > 0"), lookup, ["p1", "p2", "depth"], "siblings", total).drop("siblings")
    root = parents.filter("depth = 0").withColumn("parent", F.lit(None).cast("bigint")).withColumn("parent_conv_id", F.lit(None).cast("bigint"))
    ranges = ordered.dealt(below.unionByName(root), ["parent", "node"], "trie-siblings")
    made = written(ordered.with_next(ranges, ["parent"], "node", "sibling"), "trie-tree")
    discard(parents, ranges)
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    leaf = (F.col("n_children") == 0).cast("bigint")
    saved = (F.col("n_convs") - 1) * F.col("bytes")
    enter = F.struct(
        (F.col("node") * 2).alias("id"), F.coalesce(F.col("first") * 2, F.col("node") * 2 + 1).alias("next"),
        one.alias("steps"), leaf.alias("leaves"), saved.alias("saved"),
    )
    leave = F.struct(
        (F.col("node") * 2 + 1).alias("id"), F.coalesce(F.col("sibling") * 2, F.col("parent") * 2 + 1).alias("next"),
        one.alias("steps"), none.alias("leaves"), none.alias("saved"),
    )
    return made, made.select(F.inline(F.array(enter, leave)))


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and
    enter and exit, the places of its arcs in the tour. Arguments as of ``prefixes``."""
    paths = prefixes(turns, conversations)
    nodes, arcs = tour(_numbered(paths))
    places = ranked(arcs, WEIGHTS)
    sides = places.withColumns({"node": F.floor(F.col("id") / 2), "leaving": F.col("id") % 2 == 1})
    at = lambda name, side: F.max(F.when(side, F.col(name)))
    out, into = F.col("leaving"), ~F.col("leaving")
    within = sides.groupBy("node").agg(
        at("steps", into).alias("enter"),
        at("steps", out).alias("exit"),
        (at("leaves", out) - at("leaves", into)).alias("n_leaves"),
        (at("saved", out) - at("saved", into)).alias("saved_tokens"),
    )
    key = ["k1", "k2", "depth"]
    whole = nodes.join(within, "node").join(_digests(paths), key, "left")
    nobody = hashlib.sha256(b"").hexdigest()
    return whole.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(nobody)).alias("ends_sha256"), "enter", "exit",
    )


def shared_starts(turns: DataFrame, lengths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations put together of another one's first turns and the rest of their own, as (turns, conversations).

    ``lengths``: conv_id, base (the other conversation) and head (turns taken from it, all if it has fewer, none if it
    is not there). Turns of a conversation behind its first ``head`` follow those of its base."""
    sizes = written(turns.groupBy("conv_id").agg(F.max("place").alias("size")), "trie-sizes")
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("size").alias("base_size"))
    plan = lengths.join(sizes, "conv_id").join(bases, "base", "left")
    shared = F.least("head", F.coalesce("base_size", F.lit(0)))
    plan = plan.withColumn("shared", shared).withColumn("n_turns", shared + F.greatest(F.col("size") - F.col("head"), F.lit(0)))
    plan = written(plan.select("conv_id", "base", "head", "shared", "size", "n_turns"), "trie-plan")
    taken = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("shared").cast("bigint"))).alias("place")
    wanted = plan.filter("shared > 0").select(F.col("base").alias("conv_id"), F.col("conv_id").alias("__conv"), taken)
    heads = turns.join(wanted, ["conv_id", "place"]).select(F.col("__conv").alias("conv_id"), "place", "digest", "bytes")
    own = ordered.looked_up(turns, plan.select("conv_id", "head", "shared", "size"), ["conv_id"], "size", turns.count())
    tails = own.filter("place > head").select("conv_id", (F.col("place") - F.col("head") + F.col("shared")).alias("place"), "digest", "bytes")
    return heads.unionByName(tails), plan.select("conv_id", "n_turns")
