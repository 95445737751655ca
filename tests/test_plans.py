"""What the physical plans must look like: pushdown, pruning, shuffles and the absence of slow paths."""

import re

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

import __spark_entry__ as entry
from colonnade.model import LOG_SCHEMA
from colonnade.operators.filters import ColumnPrefix, ColumnValue, KeyPrefix, KeyRegex
from colonnade.operators.index import build_index, lookup_covered
from colonnade.operators.mutations import newest_versions, put, resolve_latest
from colonnade.operators.scan import get_row, get_rows, scan
from colonnade.plans import inputs
from colonnade.plans.queries import QUERIES
from colonnade.sources.tables import bulk_load, in_key_order, read_log_files

SF_DIR = f"{TESTDATA}/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def pushed(frame):
    """The filters handed to the file reader, which the formatted plan lists in full."""
    session = frame.sparkSession
    text = session._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "formatted")
    return " ".join(re.findall(r"PushedFilters: \[(.*)\]", text))


def read_columns(frame):
    return [re.findall(r"(\w+):", s) for s in re.findall(r"ReadSchema: struct<(.*?)>(?:\n|$)", plan(frame))]


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "log")
    bulk_load(inputs.event_log(inputs.load(spark, SF_DIR, "events")), path, partitions=4)
    return read_log_files(spark, path)


def test_key_range_reaches_the_files_below_resolve(log):
    wanted = scan(log, "3".zfill(19), "9".zfill(19))
    assert f"GreaterThanOrEqual(row_key,{'3'.zfill(19)})" in pushed(wanted)
    assert f"LessThan(row_key,{'9'.zfill(19)})" in pushed(wanted)
    assert f"EqualTo(row_key,{'3'.zfill(19)})" in pushed(get_row(log, "3".zfill(19)))


def test_key_filters_reach_the_files_below_resolve(log):
    assert "StringStartsWith(row_key,00000)" in pushed(scan(log, where=KeyRegex("^00000")))
    assert "StringStartsWith(row_key,00000)" in pushed(scan(log, where=KeyPrefix("00000")))


@pytest.mark.parametrize("name, filters, columns", [
    ("scan_range", ["GreaterThanOrEqual(row_key,4)", "LessThan(row_key,c)"], None),
    ("get_row", [f"EqualTo(row_key,{'42'.zfill(19)})"], None),
    ("scan_family", ["EqualTo(family,info)"], ["row_key", "family", "qualifier", "value"]),
    ("scan_column", ["EqualTo(family,info)", "EqualTo(qualifier,name)"], ["row_key", "family", "qualifier", "value"]),
    ("filter_key_prefix", ["StringStartsWith(row_key,a)"], None),
    ("filter_key_literal", ["StringStartsWith(row_key,b)"], None),
    ("filter_key_compare", ["GreaterThanOrEqual(row_key,5)", "LessThan(row_key,9)"], None),
])
def test_registered_scans_prune_a_stored_table(spark, name, filters, columns):
    found = entry.queries()[name](spark, SF_DIR)
    assert all(f in pushed(found) for f in filters)
    assert "Exchange" not in plan(found)
    if columns:
        assert read_columns(found) == [columns]


def test_multi_get_selects_below_resolve(spark, log, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    wanted = spark.createDataFrame([("3".zfill(19),), ("5".zfill(19),)], "row_key string")
    found = get_rows(log, wanted)
    text = plan(found)
    # In a plan the lower operator comes later: every read of the log has its semi-join above it, below the aggregate.
    assert text.count("LeftSemi") == 2
    for part in text.split("LeftSemi")[1:]:
        assert "partial_max" not in part.split("FileScan")[0]
    assert f"GreaterThanOrEqual(row_key,{'3'.zfill(19)})" in pushed(found)
    assert f"LessThanOrEqual(row_key,{'5'.zfill(19)})" in pushed(found)


def test_index_lookup_selects_below_resolve(spark):
    assert "GreaterThanOrEqual(row_key" in pushed(entry.queries()["index_join_back"](spark, SF_DIR))
    assert "GreaterThanOrEqual(row_key" in pushed(entry.queries()["get_rows"](spark, SF_DIR))


def test_column_filters_keep_the_markers(log):
    found = pushed(scan(log, columns=["ev:view"]))
    assert "EqualTo(qualifier,view)" in found and "EqualTo(op,delete_row)" in found
    assert "In(family, [ev])" in found or "EqualTo(family,ev)" in found


def test_values_are_compared_above_resolve(log):
    where = ColumnValue("ev:view", "EQUAL", "x", filter_if_missing=True)
    assert "value" not in pushed(scan(log, where=where))


def test_markers_are_read_without_values(log):
    columns = read_columns(resolve_latest(log))
    assert len(columns) == 2
    assert sum("value" in c for c in columns) == 1


def test_resolve_reduces_before_every_shuffle(log, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    text = plan(resolve_latest(log))
    assert "Window" not in text and "SinglePartition" not in text
    assert text.count("Exchange hashpartitioning") == 5
    # Both join sides have a shuffle of their own, so either can be split by adaptive execution.
    assert len(re.findall(r"Exchange hashpartitioning\(row_key#\d+, part#\d+", text)) == 2
    assert text.count("partial_max(struct(ts") == 2
    lone = plan(newest_versions(log))
    assert lone.count("Exchange") == 1 and lone.index("partial_max") > lone.index("Exchange")


def test_cells_are_cut_without_a_shuffle(spark):
    assert "Exchange" not in plan(inputs.customer_cells(spark, SF_DIR))


def test_only_needed_columns_are_read(spark):
    assert read_columns(entry.queries()["word_count"](spark, SF_DIR)) == [["text"]]
    assert read_columns(entry.queries()["key_salt"](spark, SF_DIR)) == [["o_orderkey"]]


def test_row_filter_tests_only_its_column(log, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    cells = put(newest_versions(log)).drop("op")
    strict = plan(scan(cells, where=ColumnValue("ev:view", "EQUAL", "x", filter_if_missing=True)))
    assert "Inner" in strict and "Window" not in strict
    assert "EqualTo(qualifier,view)" in strict
    assert "Exchange" not in plan(scan(log.drop("op"), where=ColumnPrefix("na")))


def test_key_order_uses_every_sort_column_as_boundary(spark):
    text = plan(in_key_order(inputs.lineitem_cells(spark, SF_DIR).withColumn("family", F.col("value"))))
    order = r"row_key#\d+ ASC NULLS FIRST, family#\d+ ASC NULLS FIRST, qualifier#\d+ ASC NULLS FIRST, ts#\d+L ASC"
    assert re.search(rf"Exchange rangepartitioning\({order}", text)
    assert text.count("Exchange") == 1


def test_sorted_table_skips_row_groups(spark, tmp_path):
    path = str(tmp_path / "sorted")
    bulk_load(put(inputs.customer_cells(spark, SF_DIR, salted=True)), path, partitions=8)
    narrow = spark.read.schema(LOG_SCHEMA).parquet(path).filter("row_key >= '4' AND row_key < '5'")
    files = narrow.select("row_key", F.col("_metadata.file_name").alias("file"))
    assert files.select("file").distinct().count() <= 3


def test_covered_lookup_reads_the_index_alone(spark, tmp_path):
    records = inputs.event_records(inputs.load(spark, SF_DIR, "events"))
    build_index(records, str(tmp_path / "i"), ["keyWord"], ["url"], row_key="ranking")
    found = lookup_covered(spark.read.parquet(str(tmp_path / "i")), F.col("keyWord") == "view", ["url"])
    assert "EqualTo(keyWord,view)" in pushed(found) and "Exchange" not in plan(found)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_slow_paths(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    for operator in ("NestedLoopJoin", "CartesianProduct", "EvalPython", "InPandas", "SinglePartition", "CollectLimit"):
        assert operator not in text
