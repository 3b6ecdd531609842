"""The extendible-hash directory: buckets are prefixes that fit, rows and entries meet through it."""

from __future__ import annotations

from collections import defaultdict

import pytest
from conftest import SF
from pyspark.sql import functions as F

from mercato.llm import exact_dedup


@pytest.mark.parametrize("capacity,bits", [(4, 64), (3, 5), (1000, 64)])
def test_buckets_are_prefixes_that_fit(spark, capacity, bits):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = exact_dedup.hashed(docs, bits)
    slots, depth = exact_dedup.directory(rows, capacity, bits)
    routed = exact_dedup.routed(rows, slots, depth).collect()
    assert len(routed) == docs.count()
    held = defaultdict(set)
    for row in routed:
        shown = row["__hash"] & (1 << 64) - 1
        assert shown >> (64 - row["bucket"]["depth"]) == row["bucket"]["prefix"] if row["bucket"]["depth"] else row["bucket"]["prefix"] == 0
        held[tuple(row["bucket"])].add(shown)
    for (deep, prefix), hashes in held.items():
        assert len(hashes) <= capacity or deep == bits
        for other, start in held:  # no bucket lies in another
            assert (other, start) == (deep, prefix) or other < deep or start >> (other - deep) != prefix
    if capacity < 10:
        assert len(held) > 1


def test_rows_find_their_entry_only_through_the_directory(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = exact_dedup.exact_duplicates(docs, 4).count()
    assert whole == docs.count()
    real = exact_dedup.directory

    def without_a_slot(*args):
        slots, depth = real(*args)
        lost = slots.orderBy("slot").limit(1).select("slot")
        return slots.join(lost, "slot", "left_anti"), depth

    monkeypatch.setattr(exact_dedup, "directory", without_a_slot)
    assert exact_dedup.exact_duplicates(docs, 4).count() < whole


def test_colliding_hashes_chain_in_their_bucket(spark):
    docs = spark.createDataFrame([(i, f"text {i % 20}") for i in range(60)], "doc_id long, text string")
    rows = exact_dedup.hashed(docs, 2)
    slots, depth = exact_dedup.directory(rows, 1, 2)
    index = exact_dedup.build_index(docs, slots, depth, 2)
    chains = {(r["__hash"], r["n"], r["last"]) for r in index.groupBy("__hash").agg(F.count("*").alias("n"), F.max("chain").alias("last")).collect()}
    assert all(n == last for _, n, last in chains) and sum(n for _, n, _ in chains) == 20
    assert max(n for _, n, _ in chains) > 1
