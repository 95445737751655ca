"""One row, cell, value or line holds a third of everything: results stay right and the work stays split."""

import hashlib

import pytest
from conftest import cell_set, log_frame, visible_cells
from pyspark.sql import functions as F

from colonnade.functions.keys import with_content_key
from colonnade.operators.cells import wide_to_cells
from colonnade.operators.filters import ColumnValue, apply_filter
from colonnade.operators.index import build_index
from colonnade.operators.mutations import resolve_latest
from colonnade.operators.scan import get_rows
from colonnade.sources.tables import bulk_load, bulk_load_records


def executed(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def small_thresholds(conf):
    """Treat partitions of a few kilobytes the way a cluster treats hundreds of megabytes."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__maxShuffledHashJoinLocalMapThreshold="0",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="4KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="2KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="12",
    )


def hot_log():
    """A third of the puts in one wide row, a third in one cell, the rest spread; deletes over all of them."""
    entries = []
    for seq in range(9000):
        kind = seq % 3
        noise = hashlib.sha256(str(seq).encode()).hexdigest()
        row = ("wide", "tall", f"row{seq % 500}")[kind]
        qualifier = (f"q{seq}", "only", f"q{seq % 4}")[kind]
        entries.append((row, "ab"[seq % 2], qualifier, seq // 7, seq, "put", f"value{seq}{noise}"))
    for seq in range(9000, 9400):
        row = f"row{seq % 500}"
        if seq % 2:
            entries.append((row, "a", None, seq % 1200, seq, "delete_family", None))
        else:
            entries.append((row, None, None, seq % 1200, seq, "delete_row", None))
    entries.append(("wide", "a", None, 600, 9400, "delete_family", None))
    entries.append(("tall", "b", "only", 5000, 9401, "delete_column", None))
    return entries


def test_resolve_splits_a_hot_row(spark, small_thresholds):
    entries = hot_log()
    shown = resolve_latest(log_frame(spark, entries).repartition(8))
    assert "skew=true" in executed(shown)
    assert cell_set(shown) == visible_cells(entries)


def test_resolve_sends_one_line_per_task_for_a_hot_cell(spark):
    log = log_frame(spark, [("r", "f", "q", n, n, "put", f"v{n}") for n in range(5000)]).repartition(4)
    shown = resolve_latest(log)
    assert cell_set(shown) == [("r", "f", "q", "v4999")]


def test_row_filter_splits_a_hot_row(spark, small_thresholds):
    rows = [(f"row{n % 700}" if n % 3 else "wide", f"q{n}", str(n)) for n in range(9000)]
    rows += [(key, "mark", "yes" if i % 2 else "no") for i, key in enumerate(["wide", *[f"row{n}" for n in range(600)]])]
    frame = spark.createDataFrame(rows, "k string, q string, v string").repartition(8)
    cells = frame.selectExpr("k row_key", "'f' family", "q qualifier", "0L ts", "0L seq", "v value")
    passing = {key for key, q, v in rows if q == "mark" and v == "yes"}
    strict = apply_filter(cells, ColumnValue("f:mark", "EQUAL", "yes", filter_if_missing=True))
    assert strict.count() == sum(key in passing for key, _, _ in rows)
    failing = {key for key, q, v in rows if q == "mark" and v == "no"}
    default = apply_filter(cells, ColumnValue("f:mark", "EQUAL", "yes"))
    assert "skew=true" in executed(default)
    assert default.count() == sum(key not in failing for key, _, _ in rows)


def test_keys_asked_for_very_often_are_sent_once(spark, small_thresholds):
    cells = wide_to_cells(spark.range(2000), F.col("id").cast("string"), {"f:q": F.lit("v")})
    keys = spark.range(6000).selectExpr("if(id % 3 = 0, '7', cast(id % 1000 AS string)) row_key")
    assert get_rows(cells, keys).count() == 1000


def biggest_share(spark, path):
    counts = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
    return max(r["count"] for r in counts) / sum(r["count"] for r in counts), len(counts)


def test_sorted_load_splits_a_hot_row_and_a_hot_cell(spark, tmp_path):
    log = log_frame(spark, [e for e in hot_log() if e[5] == "put"])
    bulk_load(log, str(tmp_path / "log"), partitions=12)
    share, files = biggest_share(spark, str(tmp_path / "log"))
    assert files >= 10 and share < 0.2


def test_record_load_splits_a_hot_key(spark, tmp_path):
    records = spark.range(9000).selectExpr("if(id % 3 = 0, 'hot', cast(id AS string)) k", "id", "cast(id AS string) v")
    path = str(tmp_path / "records")
    bulk_load_records(records, F.col("k"), {"f:a": F.col("v"), "f:b": F.col("v")}, path, ts=F.col("id"), partitions=12)
    share, files = biggest_share(spark, path)
    assert files >= 10 and share < 0.2
    assert spark.read.parquet(path).count() == 18000


def test_index_splits_a_frequent_value(spark, tmp_path):
    records = spark.range(9000).selectExpr("cast(id AS string) row_key", "if(id % 3 = 0, 'hot', concat('v', id)) colour")
    build_index(records, str(tmp_path / "index"), ["colour"], [], partitions=12)
    share, files = biggest_share(spark, str(tmp_path / "index"))
    assert files >= 10 and share < 0.2


def test_copies_of_a_hot_line_go_to_many_tasks(spark, conf):
    conf(spark__sql__shuffle__partitions="8", spark__sql__adaptive__coalescePartitions__enabled="false")
    records = spark.range(6000).selectExpr("if(id % 3 = 0, 'hot', concat('line', id)) line")
    keyed = with_content_key(records, ["line"], copies_per_row=100)
    assert keyed.count() == 6000 and keyed.select("row_key").distinct().count() == 6000
    tasks = keyed.filter("line = 'hot'").groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) >= 5 and max(r["count"] for r in tasks) <= 1000
