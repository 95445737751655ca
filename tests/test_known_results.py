"""Figures known beforehand for sf0.01, on cells and a log defined by ids instead of balances."""

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from colonnade.functions.keys import epoch_micros
from colonnade.model import LOG_COLUMNS
from colonnade.operators.cells import join_values, wide_to_cells
from colonnade.operators.filters import AllOf, AnyOf, ColumnPrefix, ColumnValue, KeyRegex, apply_filter
from colonnade.operators.mutations import newest_versions, resolve_latest
from colonnade.operators.scan import scan
from colonnade.operators.word_count import word_count
from colonnade.plans.inputs import document_cells, load

SF_DIR = f"{TESTDATA}/sf0.01"
GOLD = ColumnValue("acct:tier", "EQUAL", "gold", filter_if_missing=True)


@pytest.fixture(scope="module")
def cells(spark):
    key = F.lpad(F.col("c_custkey").cast("string"), 10, "0")
    tier = F.when(F.col("c_custkey") % 2 == 0, "gold").otherwise("silver")
    return wide_to_cells(load(spark, SF_DIR, "customer"), key, {
        "info:name": F.col("c_name"), "info:segment": F.col("c_mktsegment"),
        "geo:nation": F.col("c_nationkey").cast("string"),
        "acct:tier": F.when(F.col("c_custkey") % 3 == 0, tier)})


@pytest.fixture(scope="module")
def log(spark):
    kind, odd = F.col("event_type"), F.col("event_id") % 2 == 1
    put = kind.isin("click", "view", "purchase")
    return load(spark, SF_DIR, "events").select(
        F.lpad(F.col("user_id").cast("string"), 6, "0").alias("row_key"),
        F.when(kind == "purchase", "buy").when((kind != "error") | odd, "ev").alias("family"),
        F.when(kind == "purchase", "last").when(kind == "signup", "view").when(put, kind).alias("qualifier"),
        epoch_micros(F.col("ts")).alias("ts"), F.col("event_id").alias("seq"),
        F.when(put, F.col("props")).alias("value"),
        F.when(put, "put").when(kind == "signup", "delete_column").when(odd, "delete_family")
        .otherwise("delete_row").alias("op"),
    ).select(*LOG_COLUMNS)


def size(found):
    return found.count(), found.select("row_key").distinct().count()


def test_log_resolves_to_known_counts(log):
    ops = {r["op"]: r["count"] for r in log.groupBy("op").count().collect()}
    assert ops == {"put": 5969, "delete_column": 2017, "delete_row": 1010, "delete_family": 1004}
    shown = resolve_latest(log)
    assert shown.count() == 231
    assert shown.filter("family = 'ev'").count() == 133
    assert scan(log, columns=["ev"]).count() == 133
    assert scan(log, columns=["ev:view"]).count() == 58
    assert newest_versions(log.filter("op = 'put'")).count() == 450


def test_filters_give_known_counts(cells):
    default = ColumnValue("acct:tier", "EQUAL", "gold")
    assert size(apply_filter(cells, default)) == (4000, 1250)
    assert size(apply_filter(cells, GOLD)) == (1000, 250)
    assert size(apply_filter(cells, AllOf(GOLD, ColumnPrefix("na")))) == (500, 250)
    assert size(apply_filter(cells, AnyOf(GOLD, KeyRegex("7$")))) == (1500, 400)


def test_joined_row(cells):
    joined = join_values(scan(cells), "_").filter("row_key = '0000000000'").first()["value"]
    assert joined == "gold_2_Customer#000000000_HOUSEHOLD"


def test_word_count(spark):
    assert word_count(document_cells(spark, SF_DIR)).count() == 95039
