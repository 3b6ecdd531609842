"""Reading the corpus tables and joining small per-key tables to them."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.session import written

#: Below this many rows a per-key table is broadcast; above, it is replicated over salts and shuffled.
BROADCAST_ROWS = 100_000
SALTS = 32
BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python workers ``BATCH_ROWS`` at a time: both sides keep the buffers of the largest batch."""
    if int(spark.conf.get(BATCH)) > BATCH_ROWS:
        spark.conf.set(BATCH, BATCH_ROWS)


def tidy[Batch, Made](run: Callable[[Iterator[Batch]], Iterator[Made]]) -> Callable[[Iterator[Batch]], Iterator[Made]]:
    """``run`` for the batches of a task, after which the worker, which waits for its next task, keeps no freed memory."""

    def tidied(batches: Iterator[Batch]) -> Iterator[Made]:
        yield from run(batches)  # its locals go with it
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim:
            trim(0)

    return tidied


def attach(rows: DataFrame, lookup: DataFrame, key: str, salt: Column) -> DataFrame:
    """Inner join of ``rows`` with a written ``lookup`` of one row per ``key`` (null is a key like any other).

    The lookup's rows are counted first. A small one is broadcast, so a key that holds a third of all
    rows costs nothing. A large one is copied to every salt, and ``salt`` deals the rows of a key out.
    """
    size = lookup.count()
    right = lookup.withColumnRenamed(key, "__key")
    if size <= BROADCAST_ROWS:
        return rows.join(F.broadcast(right), rows[key].eqNullSafe(right["__key"])).drop("__key")
    left = rows.withColumn("__salt", F.pmod(F.xxhash64(salt), F.lit(SALTS)))
    right = right.withColumn("__salts", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = left[key].eqNullSafe(right["__key"]) & (left["__salt"] == right["__salts"])
    return left.join(right, met).drop("__key", "__salt", "__salts")


__all__ = ["BROADCAST_ROWS", "SALTS", "attach", "small_batches", "table", "tidy", "written"]
