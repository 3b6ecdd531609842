"""CSV contract: strict headers, missing tokens, loud errors, repeatable refresh, marts and catalog."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from mercato.market import Market
from mercato.schema import RAW_TABLES
from mercato.session import scratch_path
from mercato.sources import csv_ingest, warehouse

REVIEW_HEADER = ",".join(RAW_TABLES["reviews"].names)


def save(tmp_path, name, *lines):
    path = tmp_path / f"{name}.csv"
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_quotes_line_breaks_and_blanks(spark, tmp_path):
    path = save(
        tmp_path, "reviews", REVIEW_HEADER,
        'r1,o1,5,"said ""hi""","two\nlines",2020-01-01 00:00:00,2020-01-02 03:04:05',
        'r2,o2,1.0,   ,NaN,2020-01-01 00:00:00,2020-01-02 00:00:00',
    )
    one, two = csv_ingest.read_table(spark, path, "reviews").orderBy("review_id").collect()
    assert (one.review_comment_title, one.review_comment_message) == ('said "hi"', "two\nlines")
    assert one.review_answer_timestamp == dt.datetime(2020, 1, 2, 3, 4, 5)
    assert (two.review_score, two.review_comment_title, two.review_comment_message) == (1, None, None)


def test_swapped_header_is_refused(spark, tmp_path):
    path = save(tmp_path, "sellers", "seller_zip_code_prefix,seller_id,seller_city,seller_state", "1,s,c,ST")
    with pytest.raises(csv_ingest.HeaderMismatch, match="sellers"):
        csv_ingest.read_table(spark, path, "sellers")


def test_every_file_of_a_folder_proves_its_header(spark, tmp_path):
    folder = tmp_path / "sellers"
    folder.mkdir()
    save(folder, "a", ",".join(RAW_TABLES["sellers"].names), "s,1,c,ST")
    save(folder, "b", "seller_id,seller_city,seller_zip_code_prefix,seller_state", "s,c,1,ST")
    with pytest.raises(Exception, match="(?i)header"):
        csv_ingest.read_table(spark, str(folder), "sellers").collect()


def test_missing_file_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        csv_ingest.read_table(spark, str(tmp_path / "none.csv"), "sellers")


@pytest.mark.parametrize("bad", ["2020-13-01 00:00:00", "yesterday"])
def test_malformed_timestamp_stops_the_load(spark, tmp_path, bad):
    path = save(tmp_path, "reviews", REVIEW_HEADER, f"r,o,5,,,{bad},2020-01-01 00:00:00")
    with pytest.raises(Exception, match="bad value in reviews.review_creation_date"):
        csv_ingest.read_table(spark, path, "reviews").collect()
    spec = RAW_TABLES["reviews"]
    strings = csv_ingest.read_strings(spark, path, spec, "reviews")
    assert csv_ingest.quarantined(strings, spec).count() == 1


def test_full_refresh_replaces_and_marts_survive_the_round_trip(spark, star, tmp_path):
    root = str(tmp_path)
    small = {name: star.raw(name) for name in RAW_TABLES}
    for name, df in small.items():
        csv_ingest.write_csv(df, f"{root}/csv/{name}.csv")
    for _ in range(2):
        loaded = csv_ingest.ingest(spark, f"{root}/csv", f"{root}/raw")
    for name, df in loaded.items():
        assert df.count() == small[name].count(), name
        assert [f.dataType for f in df.schema] == [t for _, t, _ in RAW_TABLES[name].columns]
    again = Market.from_parquet(spark, f"{root}/raw")
    names = ["executive_metrics", "state_metrics"]
    warehouse.export_marts(again, f"{root}/marts", names)
    for name in names:
        stored = warehouse.read_mart(spark, f"{root}/marts", name).collect()
        from_csv = warehouse.read_mart_csv(spark, f"{root}/marts", name).collect()
        assert sorted(stored) == sorted(from_csv) == sorted(warehouse.MARTS[name](star).collect())


def test_bucketed_tables_join_without_a_shuffle(spark, star):
    warehouse.save_tables(star, "shop", buckets=4)
    m = Market.from_catalog(spark, "shop")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = m.raw("orders").join(m.raw("order_items"), "order_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert m.order_metrics.count() == star.order_metrics.count()


def test_views_answer_sql(spark, star):
    assert set(warehouse.register_views(star)) >= {"order_metrics", "raw_orders"}
    assert spark.sql("SELECT COUNT(*) FROM order_metrics").first()[0] == star.raw("orders").count()


class _Session:
    """What ``scratch_path`` asks of a session."""

    def __init__(self, **settings):
        self.conf = type("Conf", (), {"get": lambda _, key, *default: settings.get(key, *default)})()


def test_scratch_is_in_the_shared_folder_or_the_warehouse():
    place = {"spark.sql.warehouse.dir": "hdfs:///warehouse"}
    shared = _Session(**place, **{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert scratch_path(shared, "x").startswith("hdfs:///shared/mercato/x-")
    assert scratch_path(shared, "x") != scratch_path(shared, "x")
    assert scratch_path(_Session(**place), "x").startswith("hdfs:///warehouse/mercato/x-")


def test_values_that_would_be_cut_stop_the_load(spark):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from mercato.sources.csv_ingest import _parsed

    cases = [
        (T.IntegerType(), ["7", "7.0"], ["7.9", "x"]),
        (T.TimestampNTZType(), ["2017-01-01 10:00:00", "2017-01-01T10:00:00.5"], ["2017", "2017-01-01T10:00:00+05:00"]),
        (T.DecimalType(12, 2), ["12.3", "12.30"], ["12.345"]),
    ]
    for target, good, bad in cases:
        rows = spark.createDataFrame([(v,) for v in good + bad], "v string")
        fine = {r.v for r in rows.filter(_parsed(F.col("v"), target).isNotNull()).collect()}
        assert fine == set(good)


def test_free_text_files_are_read_in_splits(spark, tmp_path):
    """Records with line breaks and quotes across the borders of many small splits, against the reader that cannot split."""
    import random

    draw = random.Random(4)
    parts = ["", " ", '"', '""', ",", "\n", "\n\n", '"\n"', "ü", "text, more", "a" * 300, "\r\n"]
    folder = tmp_path / "reviews"
    folder.mkdir()
    for name in ("a", "b"):
        lines = [REVIEW_HEADER]
        for i in range(400):
            title, message = ("".join(draw.choices(parts, k=draw.randrange(5))) for _ in range(2))
            quoted = ['"' + t.replace('"', '""') + '"' if t else "" for t in (title, message)]
            lines.append(f"{name}{i},o{i},5,{quoted[0]},{quoted[1]},2020-01-01 00:00:00,2020-01-02 00:00:00")
            lines += [""] * (i % 50 == 0)
        (folder / f"{name}.csv").write_bytes("\n".join(lines).encode())
    spec = RAW_TABLES["reviews"]
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": True}
    wanted = spark.read.options(**options).schema(", ".join(f"{n} string" for n in spec.names)).csv(str(folder)).collect()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        split = csv_ingest.read_strings(spark, str(folder), spec, "reviews")
        assert spark.read.text(str(folder)).rdd.getNumPartitions() > 20
        found = split.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(found) == len(wanted) == 800
    assert sorted(map(str, found)) == sorted(map(str, wanted))


def test_every_free_text_file_proves_its_header(spark, tmp_path):
    folder = tmp_path / "reviews"
    folder.mkdir()
    good = "r,o,5,,,2020-01-01 00:00:00,2020-01-01 00:00:00"
    save(folder, "a", REVIEW_HEADER, good)
    save(folder, "b", REVIEW_HEADER.replace("review_score", "score"), good)
    with pytest.raises(Exception, match="(?i)header"):
        csv_ingest.read_table(spark, str(folder), "reviews").collect()


def test_bad_values_go_to_quarantine_in_one_pass(spark, tmp_path):
    path = save(
        tmp_path, "payments", ",".join(RAW_TABLES["payments"].names),
        "o1,1,card,2,10.50", "o2,1.0,card, ,1.2", "o3,x,card,2.5,9.999", "o4,2,,1,NaN",
    )
    good, bad = csv_ingest.load_with_quarantine(spark, path, "payments", str(tmp_path / "out"))
    assert sorted(r.order_id for r in good.collect()) == ["o1", "o2", "o4"]
    assert [f.dataType for f in good.schema] == [t for _, t, _ in RAW_TABLES["payments"].columns]
    found = {(r["column"], r["value"], r["reason"]) for r in bad.collect()}
    kind = "not a value of type "
    assert found == {("payment_sequential", "x", f"{kind}int"), ("payment_installments", "2.5", f"{kind}int"), ("payment_value", "9.999", f"{kind}decimal(12,2)")}
    assert all('"order_id":"o3"' in r["row"] for r in bad.collect())
    assert (tmp_path / "out" / "quarantined=true").exists() and (tmp_path / "out" / "quarantined=false").exists()


def test_a_value_is_parsed_once(spark, tmp_path):
    spec = RAW_TABLES["payments"]
    strings = spark.createDataFrame([tuple("1" for _ in spec.names)], [f"{n}" for n in spec.names])
    text = csv_ingest.typed(strings, spec, "payments")._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("RLIKE") == len(spec.names)


def test_blank_values_are_those_of_the_pattern(spark):
    values = ["", " ", "\t\n\x0b\f\r ", "\x85", "  ", "\x85\x85", "\xa0", " a ", "\x1c", "x\n", "\r\n\x85", " \n"]
    rows = spark.createDataFrame([(v,) for v in values], "v string")
    plain = F.when(~F.col("v").isin(csv_ingest.MISSING_TOKENS) & ~F.col("v").rlike(r"^\s*$"), F.col("v"))
    assert rows.where(~csv_ingest._present(F.col("v")).eqNullSafe(plain)).count() == 0
