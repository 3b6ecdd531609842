"""Fitted and hashed operators against plain versions: all labellings of short texts, all 128 bits of a fingerprint."""

from __future__ import annotations

import itertools
import random
import re
import struct

import numpy as np
import xxhash

from mercato.llm import language_id, queries

SCHEMA = "doc_id long, text string, lang string"


def test_viterbi_is_the_best_of_all_labellings():
    draw = np.random.default_rng(4)
    for case in range(60):
        langs, known = int(draw.integers(1, 4)), int(draw.integers(1, 6))
        # eighths: sums are exact in 32 bits, so equal values are ties in both
        scores = (draw.integers(-40, 1, size=(known, langs)) / 8).astype(np.float32)
        switch = float(draw.integers(0, 24)) / 8
        numbers = [draw.integers(0, known, size=int(draw.integers(0, 7))) for _ in range(5)]
        for own, labels in zip(numbers, language_id.viterbi(numbers, scores, switch), strict=True):
            assert len(labels) == len(own)

            def worth(chosen) -> float:
                total = sum(float(scores[n, c]) for n, c in zip(own, chosen, strict=True))
                return total - switch * sum(a != b for a, b in zip(chosen, chosen[1:]))

            best = max((worth(c) for c in itertools.product(range(langs), repeat=len(own))), default=0.0)
            assert worth(labels.tolist()) == best, case


def plain_print(text: str) -> int:
    """128 bits by majority of the terms' hashes, counted bit by bit; Spark's xxhash64 seeds one value with the last."""

    def of(data: bytes, seed: int) -> int:
        return xxhash.xxh64_intdigest(data, seed=seed)

    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w]
    low = [0] * 64
    high = [0] * 64
    for a, b in itertools.zip_longest(words, words[1:]):
        first = of(a.encode(), 42)
        if b is not None:
            first = of(b.encode(), first)
        second = of(struct.pack("<i", 1), of(struct.pack("<Q", first), 42))
        for j in range(64):
            high[j] += first >> j & 1
            low[j] += second >> j & 1
    bits = lambda counts: sum((2 * n > len(words)) << j for j, n in enumerate(counts))
    return bits(high) << 64 | bits(low)


def test_fingerprints_equal_a_plain_vote(spark, monkeypatch):
    draw = random.Random(2)
    vocabulary = ["".join(draw.choices("abcdeé", k=4)) for _ in range(300)]
    rows = [(3 * i, " ".join(draw.choices(vocabulary, k=draw.randrange(1, 80))), "en") for i in range(60)]
    rows += [(7, None, None), (10, "", None), (13, "One", None), (16, rows[5][1], "x")]
    monkeypatch.setattr(queries, "table", lambda *_: spark.createDataFrame(rows, SCHEMA).repartition(3))
    got = {r.doc_id: r for r in queries.fingerprints(spark, "").collect()}
    texts = {i: t or "" for i, t, _ in rows}
    order = sorted(texts, reverse=True)
    for i, following in zip(order, [*order[1:], order[0]], strict=True):
        text, half = texts[i], len(texts[i]) // 2
        edited = text[: len(text) - half] + texts[following][:half]
        own, other, after = plain_print(text), plain_print(edited), plain_print(texts[following])
        assert got[i].fingerprint == f"{own:032x}" and got[i].edited_fingerprint == f"{other:032x}"
        assert got[i].near_edited == 1 - (own ^ other).bit_count() / 128
        assert got[i].near_next == 1 - (own ^ after).bit_count() / 128
        assert got[i].n_chars == len(text)
