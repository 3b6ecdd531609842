"""The trie against a plain recursion, list ranking against a walk, and order across ranges."""

from __future__ import annotations

import hashlib
import math
import random
from collections import defaultdict
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from mercato.llm import list_ranking, ordered, prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string, depth string, node string, place string"


@pytest.fixture
def many_ranges(spark):
    """Small tables stay in several ranges."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def plain_trie(rows) -> dict[tuple, tuple]:
    """(conv_id, depth) to the node's other columns, by dictionaries of whole prefixes."""
    turns = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            text = text or ""
            order = (turn is not None, turn or 0, role or "", hashlib.sha256(text.encode()).hexdigest())
            turns[conv].append((order, (role or "", text)))
    own = {c: [t for _, t in sorted(ts, key=lambda x: x[0])] for c, ts in turns.items()}
    members = defaultdict(list)
    for conv, sequence in own.items():
        head = crc32(str(conv).encode()) % 9
        base = conv - int(math.fmod(conv, 5))  # SQL's remainder has the sign of the id
        rebuilt = own.get(base, [])[:head] + sequence[head:]
        for depth in range(len(rebuilt) + 1):
            members[tuple(rebuilt[:depth])].append((conv, depth == len(rebuilt)))
    children = defaultdict(list)
    for prefix in members:
        if prefix:
            children[prefix[:-1]].append(prefix)

    def below(prefix):
        text = prefix[-1][1] if prefix else ""
        saved = (len(members[prefix]) - 1) * len(text.encode())
        found = [below(child) for child in children[prefix]] or [(1, 0)]
        return sum(n for n, _ in found), saved + sum(s for _, s in found)

    nodes = {}
    for prefix, own_members in members.items():
        ends = ",".join(str(c) for c, ended in sorted(own_members) if ended)
        parent = min(c for c, _ in members[prefix[:-1]]) if prefix else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        name = min(c for c, _ in own_members), len(prefix)
        nodes[name] = (parent, len(own_members), len(children[prefix]), *below(prefix), digest)
    return nodes


def table_of(spark, monkeypatch, rows) -> dict[tuple, tuple]:
    made = spark.createDataFrame(rows, SCHEMA).repartition(3)
    monkeypatch.setattr(queries, "table", lambda *_: made)
    found = queries.conversation_trie(spark, "")
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    collected = found.collect()
    nodes = {(r["conv_id"], r["depth"]): tuple(r)[2:] for r in collected}
    assert len(nodes) == len(collected)
    return nodes


def drawn(conversations: int) -> list[tuple]:
    """Conversations over few texts, in which prefixes are shared, a hot first turn and one long conversation."""
    draw, rows = random.Random(11), []
    for conv in range(conversations):
        for turn in range(draw.choice([0, 1, 2, 4, 9, 12])):
            text = "hello" if turn == 0 and draw.random() < 0.6 else draw.choice(["a", "é", "bb", "", None])
            rows.append((conv * 2 - 20, turn, ("user", "assistant")[turn % 2], text, "d", "n", "p"))
    rows += [(7, turn, "user", "long", "d", "n", "p") for turn in range(400)]
    return rows


@pytest.mark.parametrize("piece,hubs", [(100_000, 10_000), (20, 4)])
def test_trie_equals_plain_recursion(spark, monkeypatch, many_ranges, piece, hubs):
    monkeypatch.setattr(list_ranking, "PIECE", piece)  # several rounds, with splices
    monkeypatch.setattr(ordered, "HUBS", hubs)  # parents and conversations on both ways
    monkeypatch.setattr(prefix_trie, "DIGEST_IDS", 3)
    rows = drawn(60)
    assert table_of(spark, monkeypatch, rows) == plain_trie(rows)


def test_odd_rows(spark, monkeypatch):
    rows = [
        (0, None, "user", "first", "", "", ""), (0, 0, None, None, "", "", ""), (0, 0, "user", "tie", "", "", ""),
        (0, 0, "assistant", "tie", "", "", ""), (1, 5, "user", "again", "", "", ""), (1, 5, "user", "again", "", "", ""),
        (-3, 1, "user", "x" * 200_000, "", "", ""), (None, 1, "user", "nobody's", "", "", ""), (4, None, None, None, None, None, None),
    ]
    assert table_of(spark, monkeypatch, rows) == plain_trie(rows)
    assert table_of(spark, monkeypatch, [(None, 1, "user", "nobody's", "", "", "")]) == {}


def test_list_ranking_equals_a_walk(spark, monkeypatch):
    monkeypatch.setattr(list_ranking, "PIECE", 16)
    draw = random.Random(2)
    for size in (0, 1, 2, 300):
        order = list(range(size))
        draw.shuffle(order)  # neighbours of the list lie anywhere
        weights = [(1, draw.randrange(9)) for _ in order]
        after = {a: b for a, b in zip(order, order[1:])}
        links = [(i, after.get(i), *weights[i]) for i in order]
        found = list_ranking.ranked(spark.createDataFrame(links, "id long, next long, steps long, extra long"), ["steps", "extra"])
        steps = extra = 0
        wanted = set()
        for i in order:
            wanted.add((i, steps, extra))
            steps, extra = steps + weights[i][0], extra + weights[i][1]
        assert {tuple(r) for r in found.collect()} == wanted


def test_places_sums_and_successors_across_ranges(spark, many_ranges):
    draw = random.Random(4)
    rows = [(draw.choice([1, 1, 1, 2, None]), i, draw.randrange(5)) for i in range(200)]
    frame = spark.createDataFrame(rows, "k long, v long, w long")
    ranges = ordered.dealt(frame, ["k", "v"], "test")
    assert ranges.select("__part").distinct().count() > 1
    found = ordered.running(ranges, ["k"], ["v"], "place", {"upto": "w"})
    nexts = {(r["k"], r["v"]): r["n"] for r in ordered.with_next(ranges, ["k"], "v", "n").collect()}
    for row in found.collect():
        own = [(v, w) for k, v, w in rows if k == row["k"]]
        before = [(v, w) for v, w in own if v <= row["v"]]
        assert (row["place"], row["upto"]) == (len(before), sum(w for _, w in before))
        assert nexts[row["k"], row["v"]] == min((v for v, _ in own if v > row["v"]), default=None)
    counted = frame.filter("k IS NOT NULL")
    sizes = counted.groupBy("k").agg(F.count("*").alias("n"))
    assert ordered.looked_up(counted, sizes, ["k"], "n", counted.count()).count() == counted.count()
