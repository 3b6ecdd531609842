"""Written tables: their place, their end, and inputs that change under the same path."""

from __future__ import annotations

import shutil
from pathlib import Path

import pytest

from mercato import registry
from mercato.session import discard, folder_state, scratch_path, written


class _Session:
    def __init__(self, **settings):
        self.conf = type("Conf", (), {"get": lambda _, key, *default: settings.get(key, *default)})()


def test_a_machine_local_folder_is_refused_on_a_cluster():
    here = {"spark.sql.warehouse.dir": "file:/home/me/spark-warehouse"}
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(_Session(**here, **{"spark.master": "spark://host:7077"}), "x")
    assert scratch_path(_Session(**here, **{"spark.master": "local[4]"}), "x").startswith("file:/home/me/")
    shared = {"spark.checkpoint.dir": "hdfs:///shared", "spark.master": "yarn"}
    assert scratch_path(_Session(**here, **shared), "x").startswith("hdfs:///shared/mercato/x-")


def test_discarded_tables_are_gone(spark):
    table = written(spark.range(10), "test")
    place = Path(table.written_to.removeprefix("file:"))
    assert place.exists() and table.count() == 10
    discard(table)
    assert not place.exists()


def test_replaced_input_is_seen(spark, tmp_path):
    for name in ("a", "b"):
        spark.range(3).write.parquet(f"{tmp_path}/{name}.parquet")
    before = folder_state(spark, str(tmp_path))
    assert before == folder_state(spark, str(tmp_path))
    first = registry.market_of(spark, str(tmp_path))
    assert registry.market_of(spark, str(tmp_path)) is first
    shutil.rmtree(tmp_path / "b.parquet")
    spark.range(4).write.parquet(f"{tmp_path}/b.parquet")
    assert folder_state(spark, str(tmp_path)) != before
    assert registry.market_of(spark, str(tmp_path)) is not first


def test_a_reading_task_holds_little_whatever_the_session_says(spark):
    from mercato.session import SPLIT, SPLIT_BYTES, configure

    before = spark.conf.get(SPLIT)
    try:
        for given, wanted in (("128m", f"{SPLIT_BYTES}b"), ("1g", f"{SPLIT_BYTES}b"), ("134217728", f"{SPLIT_BYTES}b"), ("16MB", "16MB"), ("64k", "64k")):
            spark.conf.set(SPLIT, given)
            assert configure(spark).conf.get(SPLIT) == wanted
    finally:
        spark.conf.set(SPLIT, before)
