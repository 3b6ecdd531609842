"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import re
from contextlib import suppress
from uuid import uuid4

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a split hot partition is worth one more shuffle below a following aggregate
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
# what a task that reads may hold: a sort or an aggregate below a shuffle then fits its memory, whatever the size of the input
SPLIT, SPLIT_BYTES = "spark.sql.files.maxPartitionBytes", 32 << 20
# call sites for error messages cost several JVM round trips per column expression
OPTIONAL_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def _bytes(size: str) -> int:
    """A size as settings write it: 16777216b, 16384k, 16mb or 16777216."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if _bytes(spark.conf.get(SPLIT)) > SPLIT_BYTES:
        spark.conf.set(SPLIT, f"{SPLIT_BYTES}b")
    for key, value in OPTIONAL_SETTINGS.items():
        with suppress(PySparkException):  # static in some deployments
            spark.conf.set(key, value)
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder that the cluster shares: ``spark.checkpoint.dir``, else the SQL warehouse.

    An unset warehouse is a folder of the driver's machine, which executors elsewhere do not see: that is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir")
        unset = root.startswith("file:") and root.rstrip("/").endswith("/spark-warehouse")
        if unset and not spark.conf.get("spark.master", "local").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{root.rstrip('/')}/mercato/{label}-{uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.sc().hadoopConfiguration()), place


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: the lineage ends there,
    and a lost executor costs a re-read, not a recomputation. The table goes when its owner discards it, at the
    latest when the application ends."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    files, place = _file_system(spark, path)
    files.deleteOnExit(place)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete written tables that no plan reads any more."""
    for table in tables:
        files, place = _file_system(table.sparkSession, table.written_to)
        files.delete(place, True)
        files.cancelDeleteOnExit(place)


def folder_state(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of what lies in a folder; it changes when a table there is replaced."""
    files, place = _file_system(spark, folder)
    found = files.listStatus(place)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in found))
