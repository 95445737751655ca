"""Laws that hold for any log, checked on seeded random ones."""

import random

import pytest
from conftest import cell_set, log_frame, visible_cells

from colonnade.functions.keys import with_content_key
from colonnade.operators.cells import cells_from_maps
from colonnade.operators.filters import AllOf, ColumnPrefix, ColumnValue, apply_filter
from colonnade.operators.mutations import put, resolve_latest
from colonnade.operators.scan import scan
from colonnade.sources.tables import bulk_load, read_log_files


def random_log(seed, size=400):
    """Few rows, families and versions, so that puts and deletes meet often. Versions are distinct."""
    rng = random.Random(seed)
    entries = []
    for seq in range(size):
        row, family, qualifier = f"r{rng.randrange(8)}", rng.choice("ab"), rng.choice("xyz")
        op = rng.choices(["put", "delete_column", "delete_family", "delete_row"], [12, 3, 2, 1])[0]
        entries.append((
            row,
            None if op == "delete_row" else family,
            qualifier if op in ("put", "delete_column") else None,
            rng.randrange(60), seq, op, f"v{seq}" if op == "put" else None))
    rng.shuffle(entries)
    return entries


@pytest.mark.parametrize("seed", range(6))
def test_resolve_shows_what_the_model_shows(spark, seed):
    entries = random_log(seed)
    log = log_frame(spark, entries)
    shown = visible_cells(entries)
    assert cell_set(resolve_latest(log)) == shown
    assert cell_set(scan(log, columns=["a"])) == [c for c in shown if c[1] == "a"]
    assert cell_set(scan(log, columns=["a:x", "b:z"])) == [c for c in shown if c[1:3] in (("a", "x"), ("b", "z"))]
    assert cell_set(scan(log, "r2", "r6")) == [c for c in shown if "r2" <= c[0] < "r6"]


def test_resolve_does_not_depend_on_order_or_files(spark, tmp_path):
    entries = random_log(99)
    expected = visible_cells(entries)
    for i, parts in enumerate((1, 5)):
        path = str(tmp_path / f"log{i}")
        random.Random(i).shuffle(entries)
        log_frame(spark, entries).repartition(parts).write.parquet(path)
        assert cell_set(resolve_latest(read_log_files(spark, path))) == expected


def test_resolving_twice_changes_nothing(spark):
    once = resolve_latest(log_frame(spark, random_log(7)))
    assert cell_set(resolve_latest(put(once))) == cell_set(once)


def test_adjacent_ranges_make_up_the_full_scan(spark):
    log = log_frame(spark, random_log(3))
    cuts = ["", "r1", "r3", "r33", "r6", ""]
    parts = [cell_set(scan(log, low, high)) for low, high in zip(cuts, cuts[1:])]
    assert sorted(sum(parts, [])) == cell_set(scan(log))


def test_all_of_narrows_each_member(spark):
    cells = resolve_latest(log_frame(spark, random_log(5)))
    value = ColumnValue("a:x", "GREATER", "v2")
    both = set(cell_set(apply_filter(cells, AllOf(value, ColumnPrefix("x")))))
    assert both <= set(cell_set(apply_filter(cells, value)))
    assert both <= set(cell_set(apply_filter(cells, ColumnPrefix("x"))))


def test_filter_on_a_log_sees_only_the_newest_value(spark):
    log = log_frame(spark, [
        ("r", "a", "x", 1, 0, "put", "old"), ("r", "a", "x", 2, 0, "put", "new"), ("r", "b", "y", 1, 0, "put", "v")])
    assert cell_set(scan(log, where=ColumnValue("a:x", "EQUAL", "old", filter_if_missing=True))) == []
    assert len(cell_set(scan(log, where=ColumnValue("a:x", "EQUAL", "new", filter_if_missing=True)))) == 2
    # The tested column is read although only another family is asked for.
    only_b = scan(log, columns=["b"], where=ColumnValue("a:x", "EQUAL", "new", filter_if_missing=True))
    assert cell_set(only_b) == [("r", "b", "y", "v")]


def test_sorted_load_keeps_every_entry_in_order(spark, tmp_path):
    log = log_frame(spark, random_log(11))
    path = str(tmp_path / "sorted")
    bulk_load(log, path, partitions=4)
    files = sorted(f for f in (tmp_path / "sorted").iterdir() if f.suffix == ".parquet")
    seen = []
    for file in files:
        rows = spark.read.parquet(str(file)).coalesce(1).collect()
        seen += [(r["row_key"], r["family"] or "", r["qualifier"] or "", r["ts"], r["seq"]) for r in rows]
    assert len(seen) == 400 and seen == sorted(seen)


@pytest.mark.parametrize("copies_per_row", [1, 3, 100_000])
def test_content_keys_number_equal_records(spark, copies_per_row):
    lines = [("a", "1")] * 7 + [("b", "1")] * 2 + [("c", "")]
    records = spark.createDataFrame(lines, "x string, y string").repartition(3)
    keyed = [tuple(r) for r in with_content_key(records, ["x", "y"], copies_per_row=copies_per_row).collect()]
    again = [tuple(r) for r in with_content_key(records, ["x", "y"], copies_per_row=copies_per_row).collect()]
    assert sorted(keyed) == sorted(again)
    assert sorted(k[1:] for k in keyed) == sorted(lines)
    assert len({k[0] for k in keyed}) == len(lines)
    numbers = sorted(int(k[0].split("-")[1]) for k in keyed if k[1] == "a")
    assert numbers == [1, 2, 3, 4, 5, 6, 7]


def test_later_maps_are_newer(spark):
    rows = [{"rowKey": 1, "columnFamily": "f", "columnName": "q", "columnValue": v} for v in (3, 2)]
    assert cell_set(resolve_latest(put(cells_from_maps(spark, rows)))) == [("1", "f", "q", "2")]
