"""Deletes of the newest version only: against a stack kept entry by entry, on ties, repeats and hot cells."""

import random

import pytest
from conftest import cell_set, log_frame
from pyspark.sql import functions as F

from colonnade.model import COORDINATES
from colonnade.operators.mutations import delete_newest, put, resolve_latest, resolve_stacked
from colonnade.operators.scan import get_row, get_rows, scan
from colonnade.sources import tables


def stacked_cells(entries):
    """Replay a log in the order of its versions, one stack per cell. Of equal versions the put comes last."""
    stacks = {}
    for row, family, qualifier, _, _, op, value in sorted(
        set(entries), key=lambda e: (e[3], e[4], e[5] == "put", str(e[6]))
    ):
        for cell, stack in stacks.items():
            same = (op == "delete_row" and cell[0] == row, op == "delete_family" and cell[:2] == (row, family),
                    op == "delete_column" and cell == (row, family, qualifier))
            if any(same):
                stack.clear()
        stack = stacks.setdefault((row, family, qualifier), [])
        if op == "put":
            stack.append(value)
        elif op == "delete_newest" and stack:
            stack.pop()
    return sorted((*cell, stack[-1]) for cell, stack in stacks.items() if stack)


def random_log(seed, size=500, span=1000):
    rng = random.Random(seed)
    entries = []
    for seq in range(size):
        op = rng.choices(["put", "delete_newest", "delete_column", "delete_family", "delete_row"], [12, 9, 1, 1, 1])[0]
        row, family, qualifier = f"r{rng.randrange(6)}", rng.choice("ab"), rng.choice("xy")
        entries.append((
            row, None if op == "delete_row" else family, None if op in ("delete_row", "delete_family") else qualifier,
            rng.randrange(span), seq, op, f"v{seq}" if op == "put" else None))
    rng.shuffle(entries)
    return entries


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("block", [3, 100_000])
def test_stacks_of_random_logs(spark, seed, block):
    entries = random_log(seed, span=(1000, 5, 1, 60)[seed])
    log = log_frame(spark, entries + entries[::7])  # a part is written twice
    assert cell_set(resolve_stacked(log, block)) == stacked_cells(entries)


def test_each_marker_takes_one_version(spark):
    a, b, c = (("r", "f", "q", i, 0, "put", f"v{i}") for i in (1, 3, 5))
    undo = lambda ts: ("r", "f", "q", ts, 0, "delete_newest", None)
    shown = lambda *entries: [x[3] for x in cell_set(resolve_stacked(log_frame(spark, list(entries))))]
    assert shown(a, b, c, undo(6)) == ["v3"]
    assert shown(a, b, c, undo(6), undo(7)) == ["v1"]
    assert shown(a, b, c, undo(6), undo(6)) == ["v3"]  # one entry, written twice
    assert shown(a, b, c, undo(6), undo(7), undo(8), undo(9)) == []
    assert shown(undo(0), undo(2), a, b) == ["v3"]  # the marker at 2 took version 1, the one at 0 found nothing
    assert shown(a, b, undo(3)) == ["v3"]  # of equal versions the put came later
    assert shown(a, b, undo(4), ("r", "f", "q", 2, 0, "delete_column", None)) == []
    assert shown(a, b, undo(4), ("r", "f", None, 0, 5, "delete_family", None)) == ["v1"]
    assert shown(a, ("r", "f", None, 1, 0, "delete_newest", None)) == ["v1"]  # names no cell


def test_logs_with_such_markers_are_not_misread(spark):
    cells = log_frame(spark, [("r", "f", "q", i, 0, "put", str(i)) for i in range(3)]).drop("op")
    keys = spark.createDataFrame([("r", 9, 0)], "row_key string, ts long, seq long")
    log = put(cells).unionByName(delete_newest(keys, "f", "q"))
    with pytest.raises(Exception, match="resolve_stacked"):
        resolve_latest(log).collect()
    want = [("r", "f", "q", "1")]
    assert cell_set(scan(log, columns=["f:q"], resolve=resolve_stacked)) == want
    assert cell_set(get_row(log, "r", resolve_stacked)) == want
    assert cell_set(get_rows(log, keys, resolve_stacked)) == want
    assert cell_set(resolve_stacked(log.limit(0))) == []


def test_named_table_keeps_and_compacts_them(spark):
    name = "undone_cells"
    tables.drop_table(spark, name)
    tables.create_table(spark, name, ["f"])
    tables.append_cells(log_frame(spark, [("r", "f", "q", i, 0, "put", str(i)) for i in range(3)]).drop("op"), name)
    keys = spark.createDataFrame([("r", 9, 0)], "row_key string, ts long, seq long")
    tables.append_log(delete_newest(keys, "f", "q"), name)
    tables.compact_table(spark, name, resolve=resolve_stacked)
    assert cell_set(resolve_latest(spark.table(name).drop("batch"))) == [("r", "f", "q", "1")]
    tables.drop_table(spark, name)


def test_hot_cell_is_counted_in_many_groups(spark, conf):
    """A third of the log in one cell; its versions are put into groups of some 500, none much larger."""
    conf(spark__sql__shuffle__partitions="8")
    n = 20_000
    hot = spark.range(n).select(
        F.lit("hot").alias("row_key"), F.lit("f").alias("family"), F.lit("q").alias("qualifier"),
        F.col("id").alias("ts"), F.lit(0).cast("long").alias("seq"), F.col("id").cast("string").alias("value"),
        F.when(F.col("id") % 5 > 2, "delete_newest").otherwise("put").alias("op"))
    cold = spark.range(n).select(
        F.concat(F.lit("c"), F.col("id") % 4000).alias("row_key"), F.lit("f").alias("family"), F.lit("q").alias("qualifier"),
        F.col("id").alias("ts"), F.lit(0).cast("long").alias("seq"), F.col("id").cast("string").alias("value"), F.lit("put").alias("op"))
    log = hot.unionByName(cold)
    got = {r.row_key: r.value for r in resolve_stacked(log, block=500).select(*COORDINATES, "value").collect()}
    stack = []
    for i in range(n):
        stack.pop() if i % 5 > 2 else stack.append(str(i))
    assert got.pop("hot") == stack[-1]
    assert got == {f"c{i}": str(i + 16_000) for i in range(4000)}
    plan = resolve_stacked(log, block=500)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    # Versions are windowed by cell and group; only totals of groups are windowed by cell.
    assert len(windows) == 2 and sum("put#" in line for line in windows) == 0
    assert any("block" in line.split("], [")[1] for line in windows)
