"""Small tables with results worked out by hand."""

import hashlib

import pytest
from conftest import cell_set, log_frame
from pyspark.sql import functions as F

from colonnade.functions import codecs, keys
from colonnade.functions.text import parse_lines, split_fields
from colonnade.operators import mutations as mut
from colonnade.operators.cells import cells_from_maps, join_values, read_wide, render_cells, wide_to_cells
from colonnade.operators.filters import (
    AllOf,
    AnyOf,
    ColumnPrefix,
    ColumnValue,
    KeyCompare,
    KeyPrefix,
    KeyRegex,
    apply_filter,
)
from colonnade.operators.ranges import clip_ranges, key_range_stats
from colonnade.operators.scan import get_row, get_rows, scan
from colonnade.operators.word_count import word_count, word_count_cells
from colonnade.plans import inputs


def rows(*cells):
    return [dict(zip(("rowKey", "columnFamily", "columnName", "columnValue"), c)) for c in cells]


# Harbours: three rows of unequal width, two families.
HARBOURS = rows(
    ("aarhus", "place", "country", "DK"),
    ("aarhus", "place", "berths", "31"),
    ("aarhus", "tide", "low", "-2"),
    ("bergen", "place", "country", "NO"),
    ("bergen", "place", "pilot", "yes"),
    ("bergen", "place", "berths", "18"),
    ("bergen", "tide", "low", "-9"),
    ("bergen", "tide", "high", "11"),
    ("cork", "tide", "high", "23"),
    ("cork", "tide", "place_of_gauge", "pier"),
)


def harbours(spark):
    return cells_from_maps(spark, HARBOURS)


def keys_of(cells):
    return sorted({r[0] for r in cells.select("row_key").collect()})


# ---- filters ---------------------------------------------------------------------------------------------


def test_column_value_keeps_the_whole_row(spark):
    where = ColumnValue("place:pilot", "EQUAL", "yes", filter_if_missing=True)
    assert cell_set(apply_filter(harbours(spark), where)) == [
        ("bergen", "place", "berths", "18"), ("bergen", "place", "country", "NO"), ("bergen", "place", "pilot", "yes"),
        ("bergen", "tide", "high", "11"), ("bergen", "tide", "low", "-9")]


def test_row_without_the_column_passes_unless_strict(spark):
    where = ColumnValue("place:country", "EQUAL", "NO")
    assert keys_of(apply_filter(harbours(spark), where)) == ["bergen", "cork"]
    strict = ColumnValue("place:country", "EQUAL", "NO", filter_if_missing=True)
    assert keys_of(apply_filter(harbours(spark), strict)) == ["bergen"]


def test_column_prefix_is_a_cell_filter(spark):
    found = apply_filter(harbours(spark), ColumnPrefix("pl"))
    assert cell_set(found) == [("cork", "tide", "place_of_gauge", "pier")]
    assert len(cell_set(apply_filter(harbours(spark), ColumnPrefix("")))) == len(HARBOURS)


def test_all_of_and_any_of(spark):
    deep = ColumnValue("tide:low", "EQUAL", "-9", filter_if_missing=True)
    both = apply_filter(harbours(spark), AllOf(deep, ColumnPrefix("b")))
    assert cell_set(both) == [("bergen", "place", "berths", "18")]
    either = apply_filter(harbours(spark), AnyOf(deep, KeyRegex("k$")))
    assert keys_of(either) == ["bergen", "cork"]
    # A cell filter in an OR list lets single cells of other rows through.
    either = cell_set(apply_filter(harbours(spark), AnyOf(deep, ColumnPrefix("co"))))
    assert either[0] == ("aarhus", "place", "country", "DK") and len(either) == 6


def test_two_tested_columns_in_one_list(spark):
    where = AllOf(
        ColumnValue("tide:high", "NOT_EQUAL", "11"),
        ColumnValue("place:berths", "EQUAL", "31", filter_if_missing=True),
    )
    assert keys_of(apply_filter(harbours(spark), where)) == ["aarhus"]
    nobody = AllOf(where, ColumnValue("tide:low", "EQUAL", "0", filter_if_missing=True))
    assert keys_of(apply_filter(harbours(spark), nobody)) == []


def test_row_flag_is_read_before_the_projection(spark):
    found = scan(harbours(spark), columns=["tide"], where=ColumnValue("place:berths", "LESS", 20, type_name="int"))
    assert len(cell_set(found)) == 4 and keys_of(found) == ["bergen", "cork"]


def test_key_patterns_find_anywhere(spark):
    names = [f"{row}{seat}" for row in "klmn" for seat in range(7, 13)]
    cells = cells_from_maps(spark, rows(*[(name, "seat", "free", "y") for name in names]))
    assert keys_of(apply_filter(cells, KeyRegex("^z"))) == []
    assert keys_of(apply_filter(cells, KeyRegex("^l1"))) == ["l10", "l11", "l12"]
    assert len(keys_of(apply_filter(cells, KeyRegex("[02]$")))) == 8
    assert len(keys_of(apply_filter(cells, KeyRegex("^m", op="NOT_EQUAL")))) == 18
    assert keys_of(apply_filter(cells, KeyRegex("[kn]8"))) == ["k8", "n8"]
    assert len(keys_of(apply_filter(cells, KeyPrefix("n")))) == 6
    assert keys_of(apply_filter(cells, KeyCompare("GREATER_OR_EQUAL", "n8"))) == ["n8", "n9"]
    assert keys_of(apply_filter(cells, KeyCompare("NO_OP", ""))) == []


def test_a_pattern_with_quantifier_is_no_literal_prefix(spark):
    cells = cells_from_maps(spark, rows(("ab", "f", "q", "1"), ("abbb", "f", "q", "1"), ("a", "f", "q", "1")))
    assert keys_of(apply_filter(cells, KeyRegex("^ab*"))) == ["a", "ab", "abbb"]
    assert keys_of(apply_filter(cells, KeyRegex("^ab+$"))) == ["ab", "abbb"]


def test_text_and_integer_comparison(spark):
    cells = cells_from_maps(spark, rows(("r1", "f", "n", "9"), ("r2", "f", "n", "10"), ("r3", "f", "n", "x")))
    assert keys_of(apply_filter(cells, ColumnValue("f:n", "GREATER", "10"))) == ["r1", "r3"]
    assert keys_of(apply_filter(cells, ColumnValue("f:n", "GREATER_OR_EQUAL", 10, type_name="int"))) == ["r2"]


def test_binary_values(spark):
    numbers = spark.createDataFrame([(f"d{n}", n) for n in (-40, 0, 260, 70_000)], "k string, n int")
    cells = wide_to_cells(numbers, F.col("k"), {"sea:depth": codecs.encode_int(F.col("n"))})
    deep = ColumnValue("sea:depth", "GREATER", 259, type_name="int")
    assert keys_of(apply_filter(cells, deep)) == ["d260", "d70000"]
    # Bytewise, an encoded negative number sorts after every positive one.
    raw = ColumnValue("sea:depth", "GREATER", (260).to_bytes(4, "big"))
    assert keys_of(apply_filter(cells, raw)) == ["d-40", "d70000"]
    wide = read_wide(cells, {"sea:depth": "int"})
    assert sorted(r["depth"] for r in wide.collect()) == [-40, 0, 260, 70_000]


# ---- scans and rows --------------------------------------------------------------------------------------


def cargo(spark):
    """Four loads, keyed by the reversed number of their crate."""
    lines = ["2041,tea,7", "2052,salt,130", "2063,rope,15", "2074,tar,88"]
    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    records = parse_lines(frame, ["crate", "goods", "tons"])
    key = keys.reverse_key(F.col("crate"))
    return wide_to_cells(records, key, {"load:tons": F.col("tons"), "load:goods": F.col("goods")})


def test_range_is_inclusive_then_exclusive(spark):
    assert keys_of(scan(cargo(spark), "1402", "3602")) == ["1402", "2502"]
    assert keys_of(scan(cargo(spark), "", "2502")) == ["1402"]
    assert keys_of(scan(cargo(spark), "2502", "")) == ["2502", "3602", "4702"]
    assert keys_of(scan(cargo(spark))) == ["1402", "2502", "3602", "4702"]


def test_joined_rows(spark):
    joined = join_values(scan(cargo(spark), "2", "4", columns=["load"]), "/")
    assert sorted(map(tuple, joined.collect())) == [("2502", "salt/130"), ("3602", "rope/15")]
    assert [r[0] for r in joined.filter(F.col("value").startswith("ro")).collect()] == ["3602"]


def test_gets(spark):
    assert get_row(cargo(spark), "4702").count() == 2
    assert get_row(cargo(spark), "47").count() == 0
    wanted = spark.createDataFrame([("1402",), ("4702",), ("1402",), ("none",), (None,)], "row_key string")
    assert keys_of(get_rows(cargo(spark), wanted)) == ["1402", "4702"]
    assert get_rows(cargo(spark), wanted.limit(0)).count() == 0


def test_multi_get_of_a_log_applies_deletes(spark):
    log = mut.put(cargo(spark))
    gone = spark.createDataFrame([("1402", 1, 0), ("2502", 1, 0)], "row_key string, ts bigint, seq bigint")
    log = log.unionByName(mut.delete_rows(gone)).unionByName(mut.delete_column(gone, "load", "tons"))
    wanted = spark.createDataFrame([("1402",), ("3602",)], "row_key string")
    assert cell_set(get_rows(log, wanted)) == [("3602", "load", "goods", "rope"), ("3602", "load", "tons", "15")]


def test_ordered_scan(spark):
    order = [tuple(r) for r in scan(harbours(spark), ordered=True).select("row_key", "family", "qualifier").collect()]
    assert order == sorted(order)


def test_render(spark):
    cells = get_row(harbours(spark), "cork")
    assert sorted(r["cell"] for r in render_cells(cells).collect()) == [
        "tide::high::23", "tide::place_of_gauge::pier"]
    assert sorted(r["cell"] for r in render_cells(cells, with_family=False).collect()) == [
        "high::23", "place_of_gauge::pier"]


def test_absent_columns_read_as_null(spark):
    columns = {"place:country": "string", "place:berths": "int", "tide:high": "bigint"}
    wide = [tuple(r) for r in read_wide(harbours(spark), columns).orderBy("row_key").collect()]
    assert wide == [("aarhus", "DK", 31, None), ("bergen", "NO", 18, 11), ("cork", None, None, 23)]
    named = read_wide(harbours(spark), {"place:berths": "int"}, {"place:berths": "room"})
    assert named.columns == ["row_key", "room"]


def test_read_wide_applies_the_deletes_of_a_log(spark):
    one = spark.createDataFrame([("bergen", 5, 0)], "row_key string, ts bigint, seq bigint")
    log = mut.put(harbours(spark)).unionByName(mut.delete_family(one, "tide"))
    wide = read_wide(log, {"place:berths": "int", "tide:high": "int"})
    assert sorted(map(tuple, wide.collect())) == [("aarhus", 31, None), ("bergen", 18, None), ("cork", None, 23)]


def test_read_wide_takes_the_newest_version(spark):
    cells = cells_from_maps(spark, rows(("r", "f", "q", "old"), ("r", "f", "q", "new"), ("r", "f", "n", "seven")))
    assert [tuple(r) for r in read_wide(cells, {"f:q": "string", "f:n": "int"}).collect()] == [("r", "new", None)]


def test_byte_order_of_keys(spark):
    cells = cells_from_maps(spark, rows(*[(k, "f", "q", "1") for k in ("a", "B", "\U0001F600", "�")]))
    order = [r[0] for r in scan(cells, ordered=True).collect()]
    assert order == ["B", "a", "�", "\U0001F600"]


# ---- keys and codecs -------------------------------------------------------------------------------------


def test_integers_survive_encoding(spark):
    values = [0, 1, -1, 1234, -5, 2**31 - 1, -(2**31)]
    frame = spark.createDataFrame([(v,) for v in values], "v int")
    back = frame.select("v", codecs.decode_int(codecs.encode_int(F.col("v"))).alias("b"))
    assert all(r["v"] == r["b"] for r in back.collect())
    big = spark.createDataFrame([(v,) for v in [*values, 2**63 - 1, -(2**63)]], "v bigint")
    back = big.select("v", codecs.decode_bigint(codecs.encode_bigint(F.col("v"))).alias("b"))
    assert all(r["v"] == r["b"] for r in back.collect())
    one = frame.filter("v = 1234").select(codecs.encode_int(F.col("v"))).first()[0]
    assert bytes(one) == (1234).to_bytes(4, "big")


def test_values_that_do_not_fit_read_as_null(spark):
    frame = spark.createDataFrame([("x", bytearray(b"\x01")), ("7", bytearray(b"\xff\xfe"))], "t string, b binary")
    read = frame.select(
        codecs.decode_value(F.col("t"), "int").alias("i"), codecs.decode_int(F.col("b")).alias("n"),
        codecs.decode_bigint(F.col("b")).alias("l"), codecs.decode_text(F.col("b")).alias("s"))
    got = [tuple(r) for r in read.collect()]
    assert got[0] == (None, None, None, "\x01")
    assert got[1][:3] == (7, None, None) and "�" in got[1][3]


def test_numbers_that_do_not_fit_are_not_cut(spark):
    frame = spark.createDataFrame([(5,), (2**32 + 5,), (2**40 + 5,), (-(2**31) - 1,), (None,)], "v bigint")
    for number in (2**32 + 5, -(2**31) - 1):
        with pytest.raises(Exception, match="does not fit in 4"):
            frame.filter(F.col("v") == number).select(codecs.encode_int(F.col("v"))).collect()
    with pytest.raises(Exception, match="does not fit in 1"):
        frame.filter("v = 4294967301").select(codecs.encode_byte(F.col("v"))).collect()
    lenient = [r[0] for r in frame.select(codecs.encode_int(F.col("v"), strict=False)).collect()]
    assert [x and bytes(x) for x in lenient] == [(5).to_bytes(4, "big"), None, None, None, None]
    parts = frame.filter("v > 0").select(F.lit(1).alias("s"), F.col("v").alias("a"), F.lit(9).alias("t"))
    wide = parts.select(keys.composite_key(F.col("s"), F.col("a"), F.col("t"), F.col("a"), wide=True).alias("k"))
    assert wide.distinct().count() == 3


def test_salt(spark):
    frame = spark.createDataFrame([("tea",), ("rope",)], "k string")
    salted = {r[0]: r[1] for r in frame.select("k", keys.salt_key(F.col("k"))).collect()}
    assert salted == {k: hashlib.md5(k.encode()).hexdigest()[:3] + k for k in ("tea", "rope")}
    back = frame.select("k", keys.unsalt_key(keys.salt_key(F.col("k"))).alias("b"))
    assert all(r["k"] == r["b"] for r in back.collect())


def test_content_keys_tell_nulls_and_separators_apart(spark):
    lines = [("a", None, "b"), ("a", "b", None), ("a\tb", "c", "d"), ("a", "b\tc", "d"), ("a", "b\tc", "d")]
    frame = spark.createDataFrame(lines, "x string, y string, z string")
    keyed = keys.with_content_key(frame, ["x", "y", "z"])
    found = [r["row_key"] for r in keyed.collect()]
    assert len(set(found)) == 5 and len({k.split("-")[0] for k in found}) == 4
    assert all(len(k.split("-")[0]) == 64 for k in found)
    assert sorted(found) == sorted(r["row_key"] for r in keys.with_content_key(frame, ["x", "y", "z"]).collect())


def test_copies_are_numbered_in_blocks(spark):
    frame = spark.range(25).select(F.lit("same").alias("x"))
    blocks = keys.copy_blocks(frame, ["x"], copies_per_row=10)
    assert sorted((r["first"], r["last"]) for r in blocks.collect()) == [(1, 10), (11, 20), (21, 25)]
    assert keys.numbered_copies(blocks, ["x"]).distinct().count() == 25


def test_composite_key_layout(spark):
    frame = spark.createDataFrame([(3, 77, 1_700_000_000, 5)], "s int, a bigint, t bigint, b bigint")
    key = bytes(frame.select(keys.composite_key(*map(F.col, "satb"))).first()[0])
    numbers = (77, 1_700_000_000, 5)
    assert key == b"\x03" + b"".join(n.to_bytes(4, "big") for n in numbers)


def test_time_keys_tell_records_of_one_millisecond_apart(spark):
    frame = spark.createDataFrame([(5, 1), (5, 2), (4, 9)], "ms bigint, n bigint")
    for build in (keys.time_key, keys.time_key_text):
        found = [r["n"] for r in frame.withColumn("k", build(F.col("ms"), F.col("n"))).orderBy("k").collect()]
        assert found == [9, 1, 2]


def test_time_key_text_sorts_times_before_1970(spark):
    times = [-(2**63), -2000, -1999, -1, 0, 5, 10**12, 2**63 - 1]
    frame = spark.createDataFrame([(t,) for t in reversed(times)], "ms bigint")
    ordered = frame.withColumn("k", keys.time_key_text(F.col("ms"), F.lit(0))).orderBy("k")
    assert [r["ms"] for r in ordered.collect()] == times


def test_ids_of_any_length_keep_their_order(spark):
    ids = [7, 10**12, 10**12 + 1, 10**13, 2**63 - 1]
    padded = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "n bigint").select(inputs.padded("n")).collect()]
    assert padded == sorted(padded) and len(set(padded)) == len(ids)


def test_binary_keys_scan_in_byte_order(spark):
    frame = spark.createDataFrame([(n,) for n in (0, 1, 255, 256, 70_000, -1)], "n bigint")
    cells = wide_to_cells(frame, codecs.encode_bigint(F.col("n")), {"f:n": F.col("n").cast("string")})
    low, high = (1).to_bytes(8, "big"), (256).to_bytes(8, "big")
    assert sorted(r["value"] for r in scan(cells, low, high).collect()) == ["1", "255"]
    assert [r["value"] for r in scan(cells, high, ordered=True).collect()] == ["256", "70000", "-1"]
    assert [r["value"] for r in get_row(cells, low).collect()] == ["1"]
    assert scan(mut.put(cells), low).count() == 5


def test_random_keys_are_distinct(spark):
    assert spark.range(1000).select(keys.random_key().alias("k")).distinct().count() == 1000


def test_epoch_micros(spark):
    frame = spark.sql("""SELECT timestamp_ntz'1970-01-02 00:00:00.000001' a, timestamp_ntz'1969-12-31 23:59:59.999999' b,
        timestamp_ntz'2024-03-10 02:30:00.5' c""")
    got = frame.select(*[keys.epoch_micros(F.col(c)) for c in "abc"], keys.epoch_millis(F.col("b"))).first()
    assert tuple(got) == (86_400_000_001, -1, 1_710_037_800_500_000, -1)


# ---- delimited lines and words ---------------------------------------------------------------------------


def test_split_drops_empty_fields_at_the_end_only(spark):
    lines = spark.createDataFrame([("a,b,c",), ("a,,c",), ("a,b,,",), (",b,c",), ("",)], "l string")
    got = [r[0] for r in lines.select(split_fields(F.col("l"), ",")).collect()]
    assert got == [["a", "b", "c"], ["a", "", "c"], ["a", "b"], ["", "b", "c"], [""]]


def test_separators_of_several_characters(spark):
    lines = spark.createDataFrame([("k::b:",), ("k::b::",), ("k::::b",), ("::",)], "l string")
    got = [r[0] for r in lines.select(split_fields(F.col("l"), "::")).collect()]
    assert got == [["k", "b:"], ["k", "b"], ["k", "", "b"], [""]]


def test_short_and_long_lines(spark):
    lines = spark.createDataFrame([("1,a,b",), ("2,a",), ("3,a,b,c",), (",a,b",), (None,)], "value string")
    lenient = {r["value"]: r["reject"] for r in parse_lines(lines, ["k", "n", "a"]).collect()}
    assert lenient == {"1,a,b": None, "2,a": "too few fields", "3,a,b,c": None, ",a,b": "empty key", None: "no line"}
    strict = {r["value"]: r["reject"] for r in parse_lines(lines, ["k", "n", "a"], strict=True).collect()}
    assert strict["3,a,b,c"] == "too many fields" and strict["1,a,b"] is None


def test_word_count_splits_on_single_spaces(spark):
    texts = ["the cat  sat", "The cat ", "   ", "", "line\nbreak the"]
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    cells = wide_to_cells(frame, F.col("id").cast("string"), {"content:info": F.col("t"), "other:info": F.lit("no")})
    counts = {r["word"]: r["n"] for r in word_count(cells).collect()}
    assert counts == {"the": 2, "cat": 2, "sat": 1, "The": 1, "line\nbreak": 1}
    assert ("the", "content", "info", "2") in cell_set(word_count_cells(cells))


# ---- mutations -------------------------------------------------------------------------------------------


def test_resolve_example(spark):
    log = log_frame(spark, [
        ("r1", "a", "x", 1, 0, "put", "v1"), ("r1", "a", "y", 1, 1, "put", "v2"), ("r1", "b", "x", 1, 2, "put", "v3"),
        ("r1", "a", None, 2, 3, "delete_family", None), ("r1", "a", "x", 3, 4, "put", "v5"),
        ("r2", "a", "x", 1, 5, "put", "w1"), ("r2", None, None, 2, 6, "delete_row", None),
        ("r3", "a", "x", 1, 7, "put", "z1"), ("r3", "a", "y", 1, 8, "put", "z2"),
        ("r3", "a", "y", 2, 9, "delete_column", None)])
    shown = [("r1", "a", "x", "v5"), ("r1", "b", "x", "v3"), ("r3", "a", "x", "z1")]
    assert cell_set(mut.resolve_latest(log)) == shown
    assert cell_set(scan(log, columns=["a:x"])) == [shown[0], shown[2]]
    assert cell_set(get_row(log, "r2")) == []


def test_equal_versions_leave_the_put(spark):
    log = log_frame(spark, [
        ("r", "a", "x", 1, 1, "put", "v"), ("r", "a", "x", 1, 1, "delete_column", None),
        ("r", None, None, 1, 1, "delete_row", None), ("r", "a", None, 1, 1, "delete_family", None)])
    assert cell_set(mut.resolve_latest(log)) == [("r", "a", "x", "v")]


def test_sequence_breaks_ties_of_time(spark):
    log = log_frame(spark, [("r", "a", "x", 1, 2, "put", "b"), ("r", "a", "x", 1, 1, "put", "z"),
                            ("r", "a", "y", 1, 3, "put", "c"), ("r", "a", "y", 1, 4, "delete_column", None)])
    assert cell_set(mut.resolve_latest(log)) == [("r", "a", "x", "b")]


def test_deletes_of_every_scope(spark):
    base = mut.put(harbours(spark))
    one = spark.createDataFrame([("bergen", 1, 0)], "row_key string, ts bigint, seq bigint")

    def left(marker):
        return cell_set(mut.resolve_latest(base.unionByName(marker)))

    assert [c[0] for c in left(mut.delete_rows(one))] == ["aarhus"] * 3 + ["cork"] * 2
    assert [c[2] for c in left(mut.delete_family(one, "place"))] == [
        "berths", "country", "low", "high", "low", "high", "place_of_gauge"]
    assert len(left(mut.delete_columns(one, "place", ["country", "pilot"]))) == 8
    assert len(left(mut.delete_column(one, "tide", "berths"))) == 10
    assert len(left(mut.delete_column(one, "tide", "low"))) == 9


def test_a_family_marker_without_family_hides_nothing(spark):
    log = log_frame(spark, [("r", "a", "x", 1, 0, "put", "v"), ("r", "b", "x", 1, 1, "put", "w"),
                            ("r", None, None, 2, 2, "delete_family", None)])
    assert len(cell_set(mut.resolve_latest(log))) == 2


def test_update_replaces_one_cell(spark):
    change = cells_from_maps(spark, rows(("cork", "tide", "high", "24")), ts=1)
    shown = cell_set(mut.resolve_latest(mut.put(harbours(spark)).unionByName(mut.put(change))))
    assert ("cork", "tide", "high", "24") in shown and len(shown) == 10


# ---- key ranges ------------------------------------------------------------------------------------------


def test_ranges_are_clipped(spark):
    regions = [("", "200"), ("200", "400"), ("400", "")]
    assert clip_ranges(regions, "100", "300") == [("100", "200"), ("200", "300")]
    assert clip_ranges(regions) == regions
    assert clip_ranges(regions, "400", "") == [("400", "")]
    assert clip_ranges(regions, "", "200") == [("", "200")]
    assert clip_ranges(regions, "450", "460") == [("450", "460")]


def test_range_statistics_count_every_key_once(spark):
    cells = cells_from_maps(spark, rows(*[(f"{i:03d}", "f", f"q{j}", "v") for i in range(0, 500, 7) for j in range(1 + i % 3)]))
    regions = [("", "100"), ("100", "101"), ("200", "400"), ("400", "")]
    got = sorted(map(tuple, key_range_stats(spark, cells, regions, "050", "460").collect()))
    for low, high, n_rows, n_cells, longest in got:
        inside = [i for i in range(0, 500, 7) if low <= f"{i:03d}" < high]
        assert (n_rows, n_cells) == (len(inside), sum(1 + i % 3 for i in inside))
        assert longest == max((1 + i % 3 for i in inside), default=0)
    assert [g[:2] for g in got] == [("050", "100"), ("100", "101"), ("200", "400"), ("400", "460")]
    assert key_range_stats(spark, cells, regions, "150", "160").count() == 0


def test_range_statistics_of_a_log_count_what_it_shows(spark):
    log = log_frame(spark, [
        ("a", "f", "q", 1, 0, "put", "1"), ("b", "f", "q", 1, 1, "put", "2"), ("b", None, None, 2, 2, "delete_row", None),
        ("c", "f", None, 2, 3, "delete_family", None)])
    assert [tuple(r) for r in key_range_stats(spark, log, [("", "")]).collect()] == [("", "", 1, 1, 1)]
