"""Periodic runs against a scan over all periods, and odd rows."""

from __future__ import annotations

import random

import numpy as np

from mercato.llm import periodic_runs

SCHEMA = "doc_id long, text string, runs string, extra string"


def scanned(words: list) -> list[tuple[int, int, int]]:
    """All runs by comparing every word with the one q words on, for every q."""
    found = []
    for q in range(1, len(words) // periodic_runs.MIN_PERIODS + 1):
        start = 0
        while start + q < len(words):
            end = start
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            length = end - start + q
            if length >= max(periodic_runs.MIN_LENGTH, periodic_runs.MIN_PERIODS * q):
                stretch = words[start : start + length]
                if not any(stretch[:-p] == stretch[p:] for p in range(1, q)):
                    found.append((start, length, q))
            start = max(end, start + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def drawn(draw: random.Random) -> list[int]:
    """Stretches of repeated blocks over small and large vocabularies, with noise between and copies of themselves."""
    words: list[int] = []
    for _ in range(draw.randint(0, 6)):
        block = [draw.randrange(draw.choice([1, 2, 2, 3, 60])) for _ in range(draw.choice([1, 2, 3, 5, 8, 13, 30]))]
        words += (block * draw.randint(1, 40))[: draw.randint(1, 160)]
    return words + words[:50] if draw.random() < 0.3 else words


def test_runs_equal_a_scan_over_all_periods():
    draw = random.Random(7)
    for _ in range(150):
        documents = [drawn(draw) for _ in range(draw.randint(1, 4))]
        words = np.array([w for d in documents for w in d], dtype=np.int32)
        owner = np.repeat(np.arange(len(documents), dtype=np.int32), [len(d) for d in documents])
        starts = np.cumsum([0, *map(len, documents)])
        wanted = [(starts[i] + s, length, q) for i, d in enumerate(documents) for s, length, q in scanned(d)]
        found = sorted(periodic_runs.runs_of(words, owner), key=lambda r: (r[0], r[2]))
        assert [tuple(map(int, r)) for r in found] == [tuple(map(int, r)) for r in wanted]


def test_operator_with_odd_rows(spark):
    draw = random.Random(3)
    texts = [None, "", " \t\n", "one two", "na " * 30, " ".join(map(str, drawn(draw) + [1, 2] * 40)), "x " * 150_000]
    rows = [(i, t, "own", "e") for i, t in enumerate(texts)] + [(4, texts[4], "own", "e"), (None, "na na " * 24, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(2)
    found = periodic_runs.periodic_runs(docs)
    assert found.columns == ["doc_id", "text", "extra", "n_words", "runs", "collapsed"]
    judged = found.collect()
    assert len(judged) == len(rows)
    for row in judged:
        words = (row["text"] or "").encode().split()
        runs = [tuple(r) for r in row["runs"]]
        assert row["n_words"] == len(words)
        assert runs == (scanned(words) if len(words) < 10_000 else [(0, 150_000, 1)])
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        assert row["collapsed"] == b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0


def test_documents_are_worked_on_in_bounded_slices(monkeypatch):
    monkeypatch.setattr(periodic_runs, "WORDS", 100)
    texts = [b"a " * 20, b"", b"b " * 500, b"c", b"d " * 90]
    slices = list(periodic_runs._slices(texts))
    assert [t for a, b in slices for t in texts[a:b]] == texts
    assert (2, 3) in slices
