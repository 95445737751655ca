"""Upserts by file: which files are rewritten, what readers see in between, how failures show."""

import os

import pytest
from pyspark.sql import functions as F

from colonnade.sources import file_upserts as fu

SCHEMA = "k bigint, name string, level string, ts bigint, seq bigint"


def rows_of(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def content(spark, path, schema):
    return sorted((r.k, r.name, r.level) for r in fu.read_keyed_table(spark, path, schema).collect())


def stamps(files):
    return {f: os.stat(f.removeprefix("file://").removeprefix("file:")).st_mtime_ns for f in files}


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "table")
    base = rows_of(spark, [(k, f"n{k}", "low", 0, 0) for k in range(1000)])
    fu.create_keyed_table(base, path, "k", rows_per_file=100)
    return path, base.schema


def test_untouched_files_keep_name_and_stamp(spark, table):
    path, schema = table
    version, before = fu.live_files(spark, path)
    old = stamps(before)
    assert version == 0 and len(before) >= 10
    changes = rows_of(spark, [(5, None, "high", 1, 0), (5, "newer", None, 2, 0), (7, None, "old", -1, 0), (5000, "new", None, 1, 0)])
    touched, all_files = fu.upsert_files(changes, path, "k", schema, rows_per_file=100)
    assert touched == 1 and all_files == len(before)
    version, after = fu.live_files(spark, path)
    kept = set(before) & set(after)
    assert version == 1 and len(kept) == len(before) - 1 and stamps(kept) == {f: old[f] for f in kept}
    want = {k: (f"n{k}", "low") for k in range(1000)} | {5: ("newer", "high"), 5000: ("new", None)}
    assert content(spark, path, schema) == sorted((k, *v) for k, v in want.items())
    # A column keeps a value that is newer than the change, also over two upserts.
    fu.upsert_files(rows_of(spark, [(7, "late", None, 3, 0)]), path, "k", schema)
    assert (7, "late", "low") in content(spark, path, schema)


def test_untouched_files_are_not_read_beyond_their_keys(spark, table):
    path, schema = table
    _, files = fu.live_files(spark, path)
    far = spark.read.schema(schema).parquet(*files).filter("k >= 800").select(fu.FILE).distinct()
    for name in [r[0] for r in far.collect()]:
        place = name.removeprefix("file://").removeprefix("file:")
        with open(place, "r+b") as file:  # the footer stays, the rows are gone
            file.write(b"\0" * 60)
        crc = os.path.join(os.path.dirname(place), f".{os.path.basename(place)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    assert fu.upsert_files(rows_of(spark, [(5, None, "high", 1, 0)]), path, "k", schema)[0] == 1


def test_a_failed_upsert_shows_nothing(spark, table, monkeypatch):
    path, schema = table
    before = content(spark, path, schema)
    changes = rows_of(spark, [(5, None, "high", 1, 0)])

    def lost(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(fu, "_publish", lost)
    with pytest.raises(RuntimeError):
        fu.upsert_files(changes, path, "k", schema)
    monkeypatch.undo()
    assert content(spark, path, schema) == before and fu.live_files(spark, path)[0] == 0
    fu.upsert_files(changes, path, "k", schema)
    assert (5, "n5", "high") in content(spark, path, schema)


def test_two_at_once_no_changes_null_keys_and_empty_tables(spark, table, tmp_path):
    path, schema = table
    change = rows_of(spark, [(1, None, "x", 1, 0)])
    assert fu.upsert_files(change.limit(0), path, "k", schema)[0] == 0 and fu.live_files(spark, path)[0] == 0
    fu._publish(spark, path, 1, fu.live_files(spark, path)[1])
    with pytest.raises(Exception, match="(?i)exist"):
        fu._publish(spark, path, 1, [])
    with pytest.raises(Exception, match="null"):
        fu.upsert_files(change.withColumn("k", F.lit(None).cast("bigint")), path, "k", schema)
    empty = str(tmp_path / "empty")
    fu.create_keyed_table(change.limit(0), empty, "k")
    assert content(spark, empty, schema) == []
    assert fu.upsert_files(change, empty, "k", schema) == (0, 0)
    assert content(spark, empty, schema) == [(1, None, "x")]
