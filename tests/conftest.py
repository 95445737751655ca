import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from colonnade.session import tune  # noqa: E402

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("colonnade-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def change(**options):
        for key, value in options.items():
            name = key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def log_frame(spark, entries):
    """A mutation log from (row, family, qualifier, ts, seq, op, value) tuples."""
    from colonnade.model import LOG_COLUMNS

    schema = "row_key string, family string, qualifier string, ts bigint, seq bigint, op string, value string"
    return spark.createDataFrame(entries, schema).select(*LOG_COLUMNS)


def cell_set(cells):
    return sorted(tuple(r) for r in cells.select("row_key", "family", "qualifier", "value").collect())


def visible_cells(entries):
    """What a log shows, worked out entry by entry: the model the Spark jobs are tested against."""
    newest, row_marks, family_marks, column_marks = {}, {}, {}, {}
    for row, family, qualifier, ts, seq, op, value in entries:
        version = (ts, seq)
        if op == "put":
            cell = (row, family, qualifier)
            if cell not in newest or version > newest[cell][0]:
                newest[cell] = (version, value)
        else:
            marks, key = {
                "delete_row": (row_marks, row),
                "delete_family": (family_marks, (row, family)),
                "delete_column": (column_marks, (row, family, qualifier)),
            }[op]
            marks[key] = max(marks.get(key, version), version)
    shown = []
    for (row, family, qualifier), (version, value) in newest.items():
        marks = (row_marks.get(row), family_marks.get((row, family)), column_marks.get((row, family, qualifier)))
        if all(mark is None or version >= mark for mark in marks):
            shown.append((row, family, qualifier, value))
    return sorted(shown)
