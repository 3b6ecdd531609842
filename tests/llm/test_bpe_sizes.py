"""Encoding and decoding of many, long and unspaced pieces: bounded memory, ids of the public library."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from conftest import SF

from mercato.llm import bpe, queries


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.tokenizer(public_tokenizers.path(queries.VOCABULARY)))


@pytest.fixture(scope="module")
def reference(codec):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def drawn(seed: int, letters: str, length: int, count: int) -> list[str]:
    draw = random.Random(seed)
    return ["".join(draw.choices(letters, k=length)) for _ in range(count)]


HAN = "".join(chr(0x4E00 + 7 * i) for i in range(500))
LATIN = "abcdefghijklmnopqrstuvwxyzéèü"


@pytest.mark.parametrize(
    "letters,length,count", [(HAN, 60, 3000), (HAN, 160, 600), (HAN, 30, 6000), (LATIN, 200, 1500), (LATIN, 9, 40_000), ("ab", 4000, 2)]
)
def test_many_distinct_pieces(codec, reference, letters, length, count):
    codec.forget()
    texts = drawn(length, letters, length, count)
    ids = codec.encode(texts)
    assert ids.to_pylist() == [reference.encode_ordinary(t) for t in texts]
    assert codec.decode(ids).to_pylist() == [t.encode() for t in texts]


def test_many_and_long_token_lists(codec):
    draw = random.Random(8)
    known = list(codec.ranks.items())
    picked = [[draw.choice(known) for _ in range(20_000)] for _ in range(100)]  # two million ids
    ids = pa.array([[rank for _, rank in some] for some in picked] + [None, []], pa.list_(pa.int32()))
    decoded = codec.decode(ids).to_pylist()
    assert decoded == [b"".join(token for token, _ in some) for some in picked] + [b"", b""]


def test_pieces_are_forgotten_and_learnt_again(codec, reference, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    monkeypatch.setattr(bpe, "TEXT_BYTES", 300)
    codec.forget()
    texts = [" ".join(drawn(i, LATIN, 7, 20)) for i in range(40)] + ["", "x" * 1000]
    for _ in range(2):
        assert codec.encode(texts).to_pylist() == [reference.encode_ordinary(t) for t in texts]
    assert len(codec.pieces) < 2000


def test_registered_query_gives_the_librarys_hashes(spark, reference):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.byte_bpe(spark, SF).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = reference.encode_ordinary(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()
