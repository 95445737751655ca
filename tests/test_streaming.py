"""Streams over a file source: restart, replay, late and duplicate records."""

import pytest
from conftest import cell_set, log_frame
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from colonnade.model import LOG_SCHEMA
from colonnade.operators.cells import cells_from_maps, wide_to_cells
from colonnade.operators.mutations import delete_column, newest_versions, put, resolve_latest
from colonnade.sources.tables import (
    append_cells,
    append_log,
    bulk_load,
    compact_table,
    drop_table,
    table_batches,
    table_families,
)
from colonnade.streaming import sinks

SCHEMA = "value string, ts bigint, seq bigint"
COLUMNS = ["cf1:name", "cf1:age"]


class Feed:
    """A folder of record files and the stream that reads one file per micro-batch."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.files = spark, folder, 0
        folder.mkdir()

    def add(self, *records):
        path = str(self.folder / f"part{self.files}")
        self.files += 1
        self.spark.createDataFrame(list(records), SCHEMA).coalesce(1).write.parquet(path)

    def stream(self):
        reader = self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
        return reader.parquet(str(self.folder / "part*"))


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "feed")


def run(feed, tmp_path):
    sinks.upsert_stream(
        feed.stream(), COLUMNS, str(tmp_path / "out"), str(tmp_path / "offsets"), interval=None
    ).awaitTermination()
    return cell_set(resolve_latest(sinks.read_upserts(feed.spark, str(tmp_path / "out"))))


def test_late_records_never_replace_newer_ones(feed, tmp_path):
    feed.add(("1,ann,30", 20, 1), ("2,bob,40", 20, 2))
    feed.add(("1,old,29", 10, 3), ("2,bea,41", 30, 4))
    assert run(feed, tmp_path) == [
        ("1", "cf1", "age", "30"), ("1", "cf1", "name", "ann"), ("2", "cf1", "age", "41"), ("2", "cf1", "name", "bea")]


def test_restart_continues_and_duplicates_change_nothing(spark, feed, tmp_path):
    feed.add(("1,ann,30", 1, 1))
    first = run(feed, tmp_path)
    feed.add(("1,ann,30", 1, 1), ("3,cy,5,extra", 2, 2))
    second = run(feed, tmp_path)
    assert second == first + [("3", "cf1", "age", "5"), ("3", "cf1", "name", "cy")]
    assert run(feed, tmp_path) == second
    assert spark.read.parquet(str(tmp_path / "out")).select("batch_id").distinct().count() == 2


def test_bad_lines_are_kept_aside(spark, feed, tmp_path):
    feed.add(("1,ann,30", 1, 1), ("2,bob", 1, 2), (",x,y", 1, 3), ("", 1, 4))
    assert len(run(feed, tmp_path)) == 2
    rejects = sinks.read_rejects(spark, str(tmp_path / "out"))
    assert sorted((r["line"], r["reject"]) for r in rejects.collect()) == [
        ("", "too few fields"), (",x,y", "empty key"), ("2,bob", "too few fields")]


def test_failed_batch_is_replaced_on_replay(spark, feed, tmp_path):
    """A sink that dies after writing leaves the batch uncommitted; the restart writes it again, once."""
    feed.add(("a", 1, 1), ("b", 2, 2))
    out, offsets = str(tmp_path / "raw"), str(tmp_path / "raw-offsets")

    def start(fail):
        def write(batch, batch_id):
            sinks._write_batch(batch, out, batch_id)
            if fail:
                raise RuntimeError("lost after the write")

        return sinks._start(feed.stream(), write, offsets, interval=None)

    with pytest.raises(StreamingQueryException):
        start(True).awaitTermination()
    start(False).awaitTermination()
    assert sorted(r["value"] for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_raw_records_of_one_millisecond_stay_apart(spark, feed, tmp_path):
    feed.add(("x", 5, 1), ("y", 5, 2), ("x", 5, 3))
    records = feed.stream().select("value", F.col("ts").alias("millis"), F.col("seq").alias("tiebreak"))
    out = str(tmp_path / "raw")
    sinks.raw_append_stream(records, out, str(tmp_path / "offsets"), interval=None).awaitTermination()
    cells = cell_set(sinks.read_batches(spark, out))
    assert [c[3] for c in cells] == ["x", "y", "x"] and len({c[0] for c in cells}) == 3


def test_raw_stream_creates_its_table_once(spark, feed, tmp_path):
    feed.add(("x", 5, 1))
    out, offsets, name = str(tmp_path / "raw"), str(tmp_path / "offsets"), "raw_records"

    def go():
        records = feed.stream().select("value", F.col("ts").alias("millis"), F.col("seq").alias("tiebreak"))
        sinks.raw_append_stream(records, out, offsets, interval=None, table=name).awaitTermination()
        return cell_set(spark.table(name))

    assert len(go()) == 1 and table_families(spark, name) == ["cf1"]
    feed.add(("y", 6, 1), ("z", 7, 1))
    assert [c[3] for c in go()] == ["x", "y", "z"]
    assert cell_set(resolve_latest(spark.table(name).drop("batch"))) == go()
    drop_table(spark, name)


def test_batches_after_a_compaction_appear(spark, feed, tmp_path):
    out, offsets, name = str(tmp_path / "raw"), str(tmp_path / "offsets"), "raw_compacted"

    def go():
        records = feed.stream().select("value", F.col("ts").alias("millis"), F.col("seq").alias("tiebreak"))
        sinks.raw_append_stream(records, out, offsets, interval=None, table=name).awaitTermination()

    feed.add(*((f"a{i}", i, 1) for i in range(1000)))
    go()
    compact_table(spark, name)
    assert spark.table(name).count() == 1000 and len(table_batches(spark, name)) == 1
    feed.add(*((f"b{i}", i, 2) for i in range(1000)))
    go()
    assert spark.table(name).count() == 2000
    compact_table(spark, name)
    assert spark.table(name).count() == 2000 and len(table_batches(spark, name)) == 1
    drop_table(spark, name)


def test_streams_and_batch_jobs_share_a_table(spark, feed, tmp_path):
    name = "shared_cells"

    def go():
        sinks.upsert_stream(feed.stream(), COLUMNS, str(tmp_path / "out"), str(tmp_path / "offsets"), interval=None,
                            table=name).awaitTermination()
        return cell_set(resolve_latest(spark.table(name)))

    feed.add(("1,ann,30", 1, 1), ("broken", 1, 2))
    feed.add(("only", 1, 3), ("rejects", 1, 4))
    assert go() == [("1", "cf1", "age", "30"), ("1", "cf1", "name", "ann")]
    rows = [{"rowKey": "2", "columnFamily": "cf1", "columnName": "name", "columnValue": "bo"}]
    append_cells(cells_from_maps(spark, rows), name)
    one = spark.createDataFrame([("1", 9, 9)], "row_key string, ts bigint, seq bigint")
    append_log(delete_column(one, "cf1", "age"), name)
    shown = [("1", "cf1", "name", "ann"), ("2", "cf1", "name", "bo")]
    assert cell_set(resolve_latest(spark.table(name))) == shown
    compact_table(spark, name)
    assert cell_set(spark.table(name)) == shown
    feed.add(("1,ann,31", 10, 1))
    assert go() == [("1", "cf1", "age", "31"), *shown]
    rejects = sinks.read_rejects(spark, str(tmp_path / "out"))
    assert sorted(r["line"] for r in rejects.collect()) == ["broken", "only", "rejects"]
    drop_table(spark, name)


def test_topic_partitions_do_not_mix(spark, tmp_path):
    """Two partitions share offsets and milliseconds; no record is lost on the way into a raw table."""
    messages = spark.range(40).selectExpr(
        "cast(concat('m', id) as binary) AS value", "timestamp_millis(1700000000000 + id % 2) AS timestamp",
        "cast(id % 4 as int) AS partition", "id div 4 AS offset")
    messages.write.parquet(str(tmp_path / "topic"))
    stream = sinks.topic_records(spark.readStream.schema(messages.schema).parquet(str(tmp_path / "topic")))
    out = str(tmp_path / "out")
    sinks.raw_append_stream(stream, out, str(tmp_path / "offsets"), interval=None).awaitTermination()
    cells = cell_set(newest_versions(sinks.read_batches(spark, out)))
    assert sorted(c[3] for c in cells) == sorted(f"m{i}" for i in range(40))


def test_running_newest_value(spark, feed, tmp_path):
    feed.add(("k1,a", 10, 1), ("k2,a", 10, 2))
    feed.add(("k1,late", 5, 3), ("k2,b", 11, 4))
    feed.add(("k3,c", 1, 5))
    parts = F.split("value", ",")
    key, value = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    puts = wide_to_cells(feed.stream(), key, {"f:q": value}, F.col("ts"), F.col("seq"))
    out = str(tmp_path / "latest")
    sinks.latest_stream(puts, out, str(tmp_path / "offsets"), interval=None).awaitTermination()
    changes = sinks.read_batches(spark, out)
    assert cell_set(newest_versions(changes)) == [
        ("k1", "f", "q", "a"), ("k2", "f", "q", "b"), ("k3", "f", "q", "c")]


def test_running_newest_value_keeps_deletes(spark, tmp_path):
    log = log_frame(spark, [
        ("r1", "a", "x", 1, 0, "put", "v"), ("r1", "a", "x", 2, 1, "delete_column", None),
        ("r1", "b", "x", 1, 2, "put", "w"), ("r2", "a", "x", 1, 3, "put", "u"), ("r2", None, None, 5, 4, "delete_row", None),
        ("r3", "a", "x", 7, 5, "put", "t"), ("r3", "a", None, 6, 6, "delete_family", None)])
    log.write.parquet(str(tmp_path / "log"))
    stream = spark.readStream.schema(LOG_SCHEMA).parquet(str(tmp_path / "log"))
    out = str(tmp_path / "latest")
    sinks.latest_stream(stream, out, str(tmp_path / "offsets"), interval=None).awaitTermination()
    changes = sinks.read_batches(spark, out)
    assert changes.filter("op = 'put' AND value IS NULL").count() == 0
    assert cell_set(resolve_latest(changes)) == [("r1", "b", "x", "w"), ("r3", "a", "x", "t")]


def test_table_range_as_stream(spark, tmp_path):
    rows = [{"rowKey": k, "columnFamily": "cf1", "columnName": c, "columnValue": f"{c}{k}"}
            for k in ("100", "103", "106", "107", "203") for c in ("name", "age")]
    table, out = str(tmp_path / "table"), str(tmp_path / "out")
    bulk_load(put(cells_from_maps(spark, rows)), table, partitions=3)

    def emitted(**options):
        path = f"{out}-{len(options)}"
        sinks.scan_stream(
            spark, table, LOG_SCHEMA, path, f"{path}-offsets", "-", columns=["cf1"], **options
        ).awaitTermination()
        return sorted(map(tuple, sinks.read_batches(spark, path, sinks.JOINED_SCHEMA).collect()))

    assert emitted(start="100", stop="107") == [(k, f"age{k}-name{k}") for k in ("100", "103", "106")]
    assert [k for k, _ in emitted(start="100", stop="300", prefix="10")] == ["100", "103", "106", "107"]


def test_range_of_a_stream_reaches_the_files(spark, tmp_path):
    """The micro-batch reads the range's files alone, and reads them once."""
    cells = spark.range(20_000).selectExpr("lpad(id, 6, '0') AS row_key", "'f' AS family", "'q' AS qualifier",
                                           "0L AS ts", "0L AS seq", "'v' AS value")
    table, out = str(tmp_path / "table"), str(tmp_path / "out")
    bulk_load(put(cells), table, partitions=8)
    query = sinks.scan_stream(spark, table, LOG_SCHEMA, out, f"{out}-offsets", start="000100", stop="000120")
    query.awaitTermination()
    ran = query._jsq.streamingQuery().lastExecution()
    text = spark._jvm.PythonSQLUtils.explainString(ran, "formatted")
    pushed = [line for line in text.splitlines() if "PushedFilters" in line]
    assert any("GreaterThanOrEqual(row_key,000100)" in line and "LessThan(row_key,000120)" in line for line in pushed)
    assert sum(p["numInputRows"] for p in query.recentProgress) < 5000
    assert sinks.read_batches(spark, out, sinks.JOINED_SCHEMA).count() == 20


def test_topic_source_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        sinks.topic_stream(spark, "nowhere:1", "records")
