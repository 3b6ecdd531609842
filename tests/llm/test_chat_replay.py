"""Logs replayed event by event against the folded result."""

from __future__ import annotations

import random
from collections import defaultdict

from mercato.llm import chat, queries

LOG = "conv_id long, seq long, turn long, kind string, role string, text string"
LAST = (1 << 63) - 1


def replayed(rows) -> dict[tuple, str]:
    """Final texts by (conv_id, turn): events one after the other, as the docstring says."""
    logs = defaultdict(lambda: defaultdict(list))
    for conv, seq, turn, kind, _, text in rows:
        rank = chat.KINDS.index(kind) if kind in chat.KINDS else len(chat.KINDS) - 1
        logs[conv][turn].append((LAST if seq is None else seq, rank, text or ""))
    final = {}
    for conv, turns in logs.items():
        cleared = None
        for turn in sorted(turns, key=lambda t: (t is None, t)):
            text, alive = "", False
            for seq, rank, part in sorted(turns[turn]):
                if cleared is not None and seq <= cleared:
                    continue
                alive = True
                text = text + part if rank == 3 else part
            if alive:
                final[conv, turn] = text
            redone = [seq for seq, rank, _ in turns[turn] if rank == 2]
            cleared = max([*redone, *([] if cleared is None else [cleared])], default=None)
    return final


def folded(spark, rows) -> dict[tuple, str]:
    got = chat.folded(spark.createDataFrame(rows, LOG)).collect()
    assert len({(r.conv_id, r.turn) for r in got}) == len(got)
    return {(r.conv_id, r.turn): r.text for r in got}


def test_removed_text_does_not_come_back(spark):
    rows = [(1, 1, 1, "message", "user", "hi"), (1, 2, 2, "message", "assistant", "one")]
    rows += [(1, 5, 3, "message", "user", "dropped"), (1, 6, 2, "regenerate", None, None), (1, 9, 3, "delta", None, "x")]
    assert folded(spark, rows) == {(1, 1): "hi", (1, 2): "", (1, 3): "x"}


def test_events_of_one_seq(spark):
    rows = [(1, 1, 1, "delta", None, " there"), (1, 1, 1, "message", "user", "hi")]
    rows += [(1, 2, 2, "delta", None, "c"), (1, 2, 2, "edit", None, "b"), (1, 2, 2, "message", "user", "a")]
    rows += [(2, 3, 2, "message", "user", "same seq"), (2, 3, 1, "regenerate", None, None)]
    assert folded(spark, rows) == {(1, 1): "hi there", (1, 2): "bc", (2, 1): ""}


def test_random_logs_equal_a_replay(spark):
    draw = random.Random(6)
    rows = []
    for conv in [None, *range(60)]:
        for _ in range(draw.randrange(1, 25)):
            kind = draw.choice(["message", "delta", "delta", "edit", "regenerate", "odd", None])
            text = None if kind == "regenerate" else draw.choice(["a", "bé", "", None, "cc"])
            rows.append((conv, draw.choice([None, *range(12)]), draw.choice([None, 1, 2, 3]), kind, draw.choice([None, "user"]), text))
    assert folded(spark, rows) == replayed(rows)


def test_finished_turns_come_back_from_their_log(spark):
    texts = ["", None, "x", "xy", "ünï 漢字!", "long " * 2000]
    rows = [(c, t, "assistant" if t % 2 else "user", text) for c in (1, None) for t, text in enumerate(texts)]
    log = chat.events_of(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert {r.kind for r in log.select("kind").distinct().collect()} == set(chat.KINDS)
    final = sorted((r.text for r in chat.folded(log).filter("conv_id = 1").collect()), key=len)
    assert final == sorted((t or "" for t in texts), key=len)
    assert "op7_chat_format" in queries.QUERIES
