"""A maintained index against one that is built anew."""

import random
import re

import pytest
from conftest import log_frame

from colonnade.operators.cells import read_wide
from colonnade.operators.index import index_changes, read_index

INDEXED, COVERED = ["info:a", "info:b"], ["info:c"]
COLUMNS = dict.fromkeys([*INDEXED, *COVERED], "string")


def random_changes(rng, step):
    rows = []
    for seq in range(rng.randrange(1, 12)):
        row, kind = f"r{rng.randrange(6)}", rng.random()
        if kind < 0.75:
            rows.append((row, "info", rng.choice("abc"), step, seq, "put", rng.choice(["x", "xy", "", "é"])))
        elif kind < 0.85:
            rows.append((row, "info", rng.choice("abc"), step, seq, "delete_column", None))
        elif kind < 0.92:
            rows.append((row, "info", None, step, seq, "delete_family", None))
        else:
            rows.append((row, None, None, step, seq, "delete_row", None))
    return rows


def test_index_follows_changes(spark):
    rng = random.Random(6)
    table, index = [], log_frame(spark, [])
    for step in range(1, 7):
        changes = random_changes(rng, step)
        told = index_changes(log_frame(spark, table), log_frame(spark, changes), INDEXED, COVERED, step)
        index = index.unionByName(spark.createDataFrame(told.collect(), index.schema))
        table += changes
        rebuilt = read_wide(log_frame(spark, table), COLUMNS).dropna(subset=["a", "b"])
        want = sorted(map(tuple, rebuilt.select("row_key", "a", "b", "c").collect()), key=repr)
        assert sorted(map(tuple, read_index(index, INDEXED, COVERED).collect()), key=repr) == want
        some = [r for r in want if r[1] == "x"]
        assert sorted(map(tuple, read_index(index, INDEXED, COVERED, ["x"]).collect()), key=repr) == some
    assert index_changes(log_frame(spark, table), log_frame(spark, []), INDEXED, COVERED, 9).count() == 0


def test_entries_that_stay_are_not_written(spark):
    table = [("r1", "info", q, 1, i, "put", "v") for i, q in enumerate("abc")]
    again = [("r1", "info", "a", 2, 0, "put", "v")]
    told = index_changes(log_frame(spark, table), log_frame(spark, again), INDEXED, COVERED, 2)
    assert told.count() == 0


def test_only_changed_keys_are_read(spark, tmp_path):
    path = str(tmp_path / "log")
    log_frame(spark, [(f"r{i:03d}", "info", q, 1, i, "put", "v") for i in range(300) for q in "abc"]).write.parquet(path)
    change = log_frame(spark, [("r150", "info", "a", 2, 0, "put", "w")])
    told = index_changes(spark.read.parquet(path), change, INDEXED, COVERED, 2)
    assert sorted(r.op for r in told.collect()) == ["delete_row", "put", "put", "put", "put"]
    plan = told._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(row_key,r150)" in plan and "LessThanOrEqual(row_key,r150)" in plan


def above_scans(plan):
    """For each file scan in a plan, the names of the operators above it, nearest first."""
    nodes = [re.match(r"([\s:+-]*)(?:\*\(\d+\) )?(\w+)(.*)", line).groups() for line in plan.splitlines() if line]
    for at, (indent, name, rest) in enumerate(nodes):
        if name == "FileScan":
            depth, path = len(indent), []
            for i, n, r in reversed(nodes[:at]):
                if len(i) < depth:
                    depth = len(i)
                    path.append(n + r)
            yield path


def test_no_task_sorts_the_whole_file_it_reads(spark, tmp_path):
    """One task reads each log, here of one file: its entries are dealt to others before any sort."""
    old = [(f"r{i}", "info", q, 1, i, "put", "v") for i in range(40) for q in "abc"]
    new = [(f"r{i}", "info", "a", 2, i, "put", "w") for i in range(20)] + [(None, "info", "a", 2, 0, "put", "w")]
    for name, rows in (("old", old), ("new", new * 2)):
        log_frame(spark, rows).coalesce(1).write.parquet(str(tmp_path / name))
    before, changes = (spark.read.parquet(str(tmp_path / name)) for name in ("old", "new"))
    told = index_changes(before, changes, INDEXED, COVERED, 2)
    paths = list(above_scans(told._jdf.queryExecution().executedPlan().toString()))
    assert len(paths) >= 3 and any("SortAggregate" in node for path in paths for node in path)
    for path in paths:
        assert re.match("Exchange|BroadcastExchange", next(n for n in path if re.match("Sort|.*Exchange", n)))
    entries = told.collect()
    assert sorted(r.row_key for r in entries if r.op == "delete_row") == sorted(f"v\0v\0r{i}" for i in range(20))
    assert sorted(r.value for r in entries if r.qualifier == "key") == sorted(f"r{i}" for i in range(20))


def test_values_with_the_parting_character_fail(spark):
    bad = [("r1", "info", "a", 1, 0, "put", "x\u0000y"), ("r1", "info", "b", 1, 1, "put", "z")]
    with pytest.raises(Exception, match="zero character"):
        index_changes(log_frame(spark, []), log_frame(spark, bad), INDEXED, COVERED, 1).collect()
