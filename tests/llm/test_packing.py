"""Packed sequences against the tokenizer, the rules of a sequence, and odd rows."""

from __future__ import annotations

import random
import struct
from collections import defaultdict

import pytest
import public_tokenizers
from conftest import SF
from tokenizers import Tokenizer

from mercato.llm import packing

SCHEMA = "doc_id long, text string, start string, task string"


@pytest.fixture(scope="module")
def model():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as lines:
        return lines.read()


def numbers(raw: bytes) -> list[int]:
    return list(struct.unpack(f"<{len(raw) // 4}I", raw))


def check(rows, documents: list[list[int]], capacity: int) -> int:
    """Every document's ids lie in its parts once, sequences are gapless; returns the padding."""
    by_sequence, ids_of = defaultdict(list), defaultdict(list)
    for row in rows:
        assert len(row["tokens"]) == 4 * row["length"] > 0
        by_sequence[row["sequence_id"]].append((row["offset"], row["length"]))
        ids_of[row["doc_id"]].append((row["start"], row["doc_tokens"], numbers(row["tokens"])))
    padding = 0
    for members in by_sequence.values():
        filled = 0
        for offset, length in sorted(members):
            assert offset == filled
            filled += length
        assert filled <= capacity
        padding += 0 if filled.bit_count() == 1 else capacity - filled
    made = []
    for parts in ids_of.values():
        ids, total = [], 0
        for start, total, part in sorted(parts):
            assert start == len(ids)
            ids += part
        assert len(ids) == total
        made.append(ids)
    assert sorted(made) == sorted(documents)
    return padding


def test_parts_of_every_length():
    for length in range(1, 5000):
        cut = packing.parts(length)
        assert sum(part for part, _ in cut) == length
        assert all(0 < part * fits <= packing.CAPACITY for part, fits in cut)
        assert all(part * fits > packing.CAPACITY * (1 - 1 / packing.TIGHT) - fits for part, fits in cut)
        assert len(cut) <= length // packing.CAPACITY + 5


@pytest.mark.parametrize("capacity,fan_in", [(2048, 64), (64, 2)])
def test_whole_table(spark, model, monkeypatch, capacity, fan_in):
    monkeypatch.setattr(packing, "FAN_IN", fan_in)  # several levels of groups
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(7)
    tokenizer = Tokenizer.from_str(model)
    tokenizer.encode_special_tokens = True
    texts = [row["text"] or "" for row in docs.select("text").collect()]
    documents = [[*e.ids, packing.END] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    made = packing.packed(docs, model, capacity)
    rows = made.collect()
    padding = check(rows, documents, capacity)
    assert padding <= 0.02 * sum(map(len, documents))
    whole = {r["sequence_id"]: r for r in packing.sequences(made, capacity).collect()}
    assert sum(r["length"] for r in whole.values()) == sum(map(len, documents))
    for row in rows:
        sequence = whole[row["sequence_id"]]["tokens"]
        assert sequence[4 * row["offset"] : 4 * (row["offset"] + row["length"])] == row["tokens"]
    assert sum(r["padded_length"] - r["length"] for r in whole.values()) == padding


def test_odd_rows(spark, model):
    draw = random.Random(1)
    odd = [
        None, "", " \n", "One  two\x0bthree", "<|startoftext|> x<|endoftext|>", "é ́a  b\x1cc  d ﬁ ΑΣ Σ ΣΑΣ.",
        "x" * 5000, " ".join(str(draw.random()) for _ in range(4000)), "漢字 かな ١٢ don't it's  ''s",
    ]
    rows = [(i, t, "s", "t") for i, t in enumerate(odd)] + [(None, "no id", None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    tokenizer = Tokenizer.from_str(model)
    tokenizer.encode_special_tokens = True
    documents = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, packing.END] for _, t, *_ in rows]
    check(packing.packed(docs, model).collect(), documents, packing.CAPACITY)
    assert packing.packed(docs.limit(0), model).count() == 0
    twice = packing.packed(docs.unionAll(docs), model).collect()  # repeated rows are documents of their own
    assert sum(r["length"] for r in twice) == 2 * sum(map(len, documents))
