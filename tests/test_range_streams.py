"""Range streams and the ledger sink: whole rows, restarts in the middle, new checkpoints, failures between two writes."""

import os

import pytest
from conftest import log_frame, visible_cells
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from colonnade.model import LOG_SCHEMA
from colonnade.sources.tables import bulk_load_aligned
from colonnade.streaming import ledger, range_stream, sinks

STARTS = ["c", "f", "m", "t", "é"]


def entries(keys):
    """Two columns of each row, in two versions, and deletes of some rows and columns."""
    log = []
    for i, key in enumerate(keys):
        for ts in (1, 2):
            log += [(key, "f", q, ts, 0, "put", f"{q}{ts}{i}") for q in "xy"] + [(key, "g", "z", ts, 0, "put", "other")]
        if i % 3 == 0:
            log.append((key, "f", "x", 2, 1, "delete_column", None))
        if i % 7 == 0:
            log.append((key, None, None, 3, 0, "delete_row", None))
    return log


def joined(log, low, high, family="f"):
    rows = {}
    for row, fam, _, value in visible_cells(log):
        if fam == family and row.encode() >= low.encode() and (not high or row.encode() < high.encode()):
            rows.setdefault(row, []).append(value)
    return {row: "_".join(values) for row, values in rows.items()}


@pytest.fixture
def table(spark, tmp_path):
    log = entries([f"{c}{i}" for c in "abcefmntyzé" for i in range(12)] + ["c", "f", "m"])
    path = str(tmp_path / "table")
    bulk_load_aligned(log_frame(spark, log).repartition(3), path, STARTS)
    return log, path


def test_bounds_are_clipped_and_listed_a_file_each(spark, tmp_path):
    for low, high, want in (
        ("", "", [(0, "", "c"), (1, "c", "f"), (2, "f", "m"), (3, "m", "t"), (4, "t", "é"), (5, "é", "")]),
        ("d", "m", [(1, "d", "f"), (2, "f", "m")]),
        ("é", "", [(5, "é", "")]),
        ("x", "d", []),
    ):
        path = str(tmp_path / f"listed-{low}-{high}")
        assert range_stream.list_ranges(spark, STARTS, path, low, high) == len(want)
        assert sorted(map(tuple, spark.read.schema(range_stream.RANGES_SCHEMA).parquet(path).collect())) == want
        assert sum(f.endswith(".parquet") for f in os.listdir(path)) == max(len(want), 1)


@pytest.mark.parametrize("low, high, prefix", [("", "", ""), ("b5", "n3", ""), ("m", "zz", "y1"), ("x", "d", "")])
def test_ranges_give_the_rows_of_one_scan(spark, tmp_path, table, low, high, prefix):
    log, path = table
    range_stream.list_ranges(spark, STARTS, str(tmp_path / "listed"), low, high)
    out = str(tmp_path / "out")
    range_stream.scan_ranges_stream(spark, path, str(tmp_path / "listed"), out, str(tmp_path / "offsets"), "_", ["f"],
                                    prefix, ranges_per_batch=2).awaitTermination()
    want = joined(log, low, high) if low != "x" else {}
    want = {row: value for row, value in want.items() if row.startswith(prefix)}
    if not os.path.isdir(out):
        assert not want
        return
    found = sinks.read_batches(spark, out, sinks.JOINED_SCHEMA).collect()
    assert len(found) == len(want) and {r.row_key: r.value for r in found} == want


def test_only_folders_of_listed_ranges_are_opened(spark, tmp_path, table):
    log, path = table
    for number in (0, 3, 4, 5):  # what is not asked for can't even be read
        for file in os.listdir(f"{path}/range={number}"):
            if file.endswith(".parquet"):
                with open(f"{path}/range={number}/{file}", "wb") as spoiled:
                    spoiled.write(b"no parquet")
                if os.path.exists(f"{path}/range={number}/.{file}.crc"):
                    os.remove(f"{path}/range={number}/.{file}.crc")
    range_stream.list_ranges(spark, STARTS, str(tmp_path / "listed"), "d", "m")
    out = str(tmp_path / "out")
    range_stream.scan_ranges_stream(spark, path, str(tmp_path / "listed"), out, str(tmp_path / "offsets"), "_", ["f"],
                                    ranges_per_batch=1).awaitTermination()
    found = sinks.read_batches(spark, out, sinks.JOINED_SCHEMA).collect()
    assert {r.row_key: r.value for r in found} == joined(log, "d", "m")


def test_restart_in_the_middle_loses_and_repeats_nothing(spark, tmp_path, table, monkeypatch):
    log, path = table
    listed, out, offsets = (str(tmp_path / name) for name in ("listed", "out", "offsets"))
    range_stream.list_ranges(spark, STARTS, listed)
    written, write = [], sinks._write_batch

    def fail_once(batch, folder, batch_id):
        if batch_id == 2 and 2 not in written:
            written.append(2)
            raise RuntimeError("lost")
        written.append(batch_id)
        write(batch, folder, batch_id)

    monkeypatch.setattr(range_stream, "_write_batch", fail_once)
    run = lambda: range_stream.scan_ranges_stream(spark, path, listed, out, offsets, "_", ["f"], ranges_per_batch=1)
    with pytest.raises(StreamingQueryException):
        run().awaitTermination()
    assert sorted(f for f in os.listdir(out) if f.startswith("batch_id")) == ["batch_id=0", "batch_id=1"]
    run().awaitTermination()
    assert written == [0, 1, 2, 2, 3, 4, 5]
    found = sinks.read_batches(spark, out, sinks.JOINED_SCHEMA).collect()
    assert len(found) == len({r.row_key for r in found}) and {r.row_key: r.value for r in found} == joined(log, "", "")
    run().awaitTermination()
    assert written == [0, 1, 2, 2, 3, 4, 5]


# ---- ledger ----------------------------------------------------------------------------------------------


def placed(spark, records):
    """Log entries with their place, from (part, position, key)."""
    log = log_frame(spark, [(key, "f", "q", position, 0, "put", "v") for _, position, key in records])
    if not records:
        return log.withColumns({"part": F.lit("p"), "position": F.lit(1).cast("bigint")})
    part = F.element_at(F.create_map(*(F.lit(x) for p, _, key in records for x in (key, p))), F.col("row_key"))
    return log.withColumns({"part": part, "position": F.col("ts")})


def keys_in(spark, path):
    return sorted(r.row_key for r in ledger.read_ledger(spark, path).collect())


def test_positions_decide_not_batch_numbers(spark, tmp_path):
    path = str(tmp_path / "sink")
    assert keys_in(spark, path) == []
    assert ledger.append_once(placed(spark, []), path, "s") is None
    assert keys_in(spark, path) == []
    assert ledger.append_once(placed(spark, [("p0", 1, "a"), ("p0", 2, "b"), ("p1", 1, "c")]), path, "s")
    assert ledger.append_once(placed(spark, [("p0", 1, "a"), ("p0", 2, "b")]), path, "s") is None
    assert ledger.append_once(placed(spark, [("p0", 2, "b"), ("p0", 3, "d"), ("p2", 1, "e")]), path, "s")
    assert keys_in(spark, path) == list("abcde")
    assert {tuple(r) for r in ledger.written_positions(spark, path, "s").collect()} == {("p0", 3), ("p1", 1), ("p2", 1)}
    assert ledger.append_once(placed(spark, [("p0", 1, "a")]), path, "other")  # a name of its own
    assert keys_in(spark, path) == list("aabcde")


def test_a_record_without_place_fails(spark, tmp_path):
    for name in ("part", "position"):
        bad = placed(spark, [("p", 1, "a")])
        bad = bad.withColumn(name, F.lit(None).cast(bad.schema[name].dataType))
        with pytest.raises(Exception, match="must have a part"):
            ledger.append_once(bad, str(tmp_path / name), "s")


def test_new_checkpoints_and_lost_ledger_lines_repeat_nothing(spark, tmp_path, monkeypatch):
    feed, path = tmp_path / "feed", str(tmp_path / "sink")

    def add(*keys):
        log_frame(spark, [(k, "f", "q", 1, 0, "put", "v") for k in keys]).coalesce(1).write.mode("append").parquet(str(feed))

    def run(checkpoint):
        files = spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(feed))
        stream = files.select("*", F.col("_metadata.file_path").alias("part"), F.lit(0).cast("bigint").alias("position"))
        ledger.ledger_stream(stream, path, str(tmp_path / checkpoint), "s", interval=None).awaitTermination()

    add("a", "a", "b")
    run("one")
    add("c")
    # The batch is written, the line that names it is not: nobody sees it, and the next attempt writes it anew.
    isEmpty = type(spark.range(1)).isEmpty

    def lost(frame):
        if "stream" in frame.columns:
            raise RuntimeError("lost")
        return isEmpty(frame)

    monkeypatch.setattr(type(spark.range(1)), "isEmpty", lost)
    with pytest.raises(StreamingQueryException):
        run("one")
    monkeypatch.undo()
    assert len([f for f in os.listdir(f"{path}/data") if f.startswith("batch=")]) == 2
    assert keys_in(spark, path) == ["a", "a", "b"]
    run("one")
    assert keys_in(spark, path) == ["a", "a", "b", "c"]
    add("d")
    run("two")  # reads all files again
    assert keys_in(spark, path) == ["a", "a", "b", "c", "d"]
