"""Loads into existing key ranges: what the files hold, how a large range is cut, what a reader opens."""

import os

import pyarrow.parquet as pq
import pytest
from conftest import cell_set
from pyspark.sql import functions as F

from colonnade.model import CELL_COLUMNS, CELL_SCHEMA
from colonnade.sources.tables import (
    bulk_load_aligned,
    in_ranges,
    range_number,
    read_aligned,
    store_boundaries,
    stored_boundaries,
)


def cells_of(spark, keys):
    return spark.createDataFrame([(k, "f", "q", i, 0, f"v{i}") for i, k in enumerate(keys)], CELL_SCHEMA)


def files_of(path):
    """Range number, least and largest key, and the keys in order, of every file."""
    found = []
    for folder in sorted(os.listdir(path)):
        if folder.startswith("range="):
            for file in os.listdir(f"{path}/{folder}"):
                if file.endswith(".parquet"):
                    keys = pq.ParquetFile(f"{path}/{folder}/{file}").read(["row_key"]).column(0).to_pylist()
                    found.append((int(folder[6:]), keys))
    return found


def test_loads_share_the_stored_boundaries(spark, tmp_path):
    starts = store_boundaries(spark, ["m", "f", "", "é", "f", "t"], str(tmp_path / "bounds"))
    assert starts == ["f", "m", "t", "é"] == stored_boundaries(spark, str(tmp_path / "bounds"))
    path = str(tmp_path / "table")
    first = [f"{c}{i}" for c in "aeflmnt" for i in range(20)] + ["f", "m", "é", "éa", "zz"]
    second = [f"{c}x" for c in "abmz"] + ["", "t"]
    bulk_load_aligned(cells_of(spark, first).repartition(5), path, starts)
    bulk_load_aligned(cells_of(spark, second), path, starts, append=True)
    files = files_of(path)
    assert sorted(k for _, keys in files for k in keys) == sorted(first + second)
    for number, keys in files:
        assert keys == sorted(keys, key=str.encode)
        assert {sum(s.encode() <= k.encode() for s in starts) for k in keys} == {number}
    for low, high in (("", ""), ("f", "m"), ("a3", "n"), ("m", ""), ("", "é"), ("zzz", "é")):
        want = [k for k in first + second if k.encode() >= low.encode() and (not high or k.encode() < high.encode())]
        assert sorted(r.row_key for r in read_aligned(spark, path, starts, low, high).collect()) == sorted(want)


def test_a_large_range_is_cut_and_small_ones_are_not(spark, tmp_path):
    path = str(tmp_path / "table")
    hot = [("m", i) for i in range(6000)] + [(f"n{i}", 0) for i in range(3000)] + [("a", 0), ("z", 0)]
    cells = spark.createDataFrame([(k, "f", "q", ts, 0, "v") for k, ts in hot], CELL_SCHEMA).repartition(4)
    bulk_load_aligned(cells, path, ["b", "y"], most_rows=1000)
    files = files_of(path)
    sizes = {n: [len(keys) for number, keys in files if number == n] for n in (0, 1, 2)}
    assert sizes[0] == sizes[2] == [1] and sum(sizes[1]) == 9000
    assert len(sizes[1]) >= 7 and max(sizes[1]) <= 2500  # one row holds two thirds of them
    assert read_aligned(spark, path, ["b", "y"]).count() == 9002


def test_no_sampling_and_few_folders_opened(spark, tmp_path, capsys):
    starts = [f"{i:03d}" for i in range(1, 200)]
    path = str(tmp_path / "table")
    keys = spark.range(4000).select(
        F.concat(F.lpad((F.col("id") % 200).cast("string"), 3, "0"), F.lit("-"), F.col("id")).alias("row_key"))
    cells = keys.select("row_key", *(F.lit(x).alias(n) for x, n in (("f", "family"), ("q", "qualifier"))),
                        F.lit(1).cast("long").alias("ts"), F.lit(0).cast("long").alias("seq"), F.lit("v").alias("value"))
    bulk_load_aligned(cells.select(CELL_COLUMNS), path, starts)
    assert len(files_of(path)) == 200
    wanted = keys.filter(F.substring("row_key", 1, 3).isin("007", "090", "199")).limit(50)
    found = read_aligned(spark, path, starts, keys=wanted.union(wanted).union(spark.sql("SELECT CAST(NULL AS string)")))
    assert sorted(r.row_key for r in found.collect()) == sorted(r.row_key for r in wanted.collect())
    found.explain("formatted")
    assert "PartitionFilters" in capsys.readouterr().out
    files = read_aligned(spark, path, starts, "050", "053").select(F.input_file_name()).distinct()
    assert files.count() == 3
    placed = cells.withColumn("range", range_number(starts, F.col("row_key")).cast("int"))
    plan = in_ranges(placed, 200)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


def test_no_keys_no_rows_and_bad_rows(spark, tmp_path):
    path = str(tmp_path / "table")
    cells = cells_of(spark, ["a", "b"])
    bulk_load_aligned(cells, path, [])
    assert len(cell_set(read_aligned(spark, path, []))) == 2
    assert read_aligned(spark, path, [], keys=cells.limit(0)).count() == 0
    with pytest.raises(Exception, match="null"):
        bulk_load_aligned(cells.withColumn("row_key", F.lit(None).cast("string")), str(tmp_path / "bad"), ["b"])
    bulk_load_aligned(cells.limit(0), path, ["b"], most_rows=1)
    assert read_aligned(spark, path, ["b"]).count() == 0
