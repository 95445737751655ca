"""Puts and deletes as an append-only log, and the newest visible value per cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colonnade.model import (
    CELL_COLUMNS,
    COORDINATES,
    DELETE_COLUMN,
    DELETE_FAMILY,
    DELETE_NEWEST,
    DELETE_ROW,
    LOG_COLUMNS,
    PUT,
)
from colonnade.operators.rows import PARTS, group_by_key, join_rows

#: Versions of one cell that are counted in one place when ``delete_newest`` markers are applied.
BLOCK = 100_000


def put(cells: DataFrame) -> DataFrame:
    """Log entries writing these cells; an update of a cell is a put with a larger version."""
    return cells.withColumn("op", F.lit(PUT)).select(*LOG_COLUMNS)


def _marker(keys: DataFrame, op: str, family: Column, qualifier: Column) -> DataFrame:
    return keys.select(
        "row_key",
        family.cast("string").alias("family"),
        qualifier.cast("string").alias("qualifier"),
        F.col("ts").cast("bigint").alias("ts"),
        F.col("seq").cast("bigint").alias("seq"),
        F.lit(None).cast("string").alias("value"),
        F.lit(op).alias("op"),
    )


def delete_rows(keys: DataFrame) -> DataFrame:
    """Markers for whole rows. ``keys`` has ``row_key, ts, seq``, one line or a set of any size."""
    return _marker(keys, DELETE_ROW, F.lit(None), F.lit(None))


def delete_family(keys: DataFrame, family: str) -> DataFrame:
    return _marker(keys, DELETE_FAMILY, F.lit(family), F.lit(None))


def delete_column(keys: DataFrame, family: str, qualifier: str) -> DataFrame:
    return _marker(keys, DELETE_COLUMN, F.lit(family), F.lit(qualifier))


def delete_columns(keys: DataFrame, family: str, qualifiers: list[str]) -> DataFrame:
    names = F.explode(F.array(*[F.lit(q) for q in qualifiers]))
    return _marker(keys.withColumn("name", names), DELETE_COLUMN, F.lit(family), F.col("name"))


def delete_newest(keys: DataFrame, family: str, qualifier: str) -> DataFrame:
    """Markers that each take back one version of a cell, the newest there is then; the one before shows again.

    Logs that hold such markers are read with ``resolve_stacked``.
    """
    return _marker(keys, DELETE_NEWEST, F.lit(family), F.lit(qualifier))


def newest_versions(cells: DataFrame) -> DataFrame:
    """The newest version of every cell, for cells without deletes.

    Each task first keeps one version per cell, so a cell written a billion times sends one row per task.
    """
    newest = F.max(F.struct("ts", "seq", "value")).alias("newest")
    return group_by_key(cells, *COORDINATES).agg(newest).select(
        "row_key", "family", "qualifier", "newest.ts", "newest.seq", "newest.value"
    )


def _newest_markers(log: DataFrame) -> DataFrame:
    """Per row key: the newest row marker, and the newest marker of each family as a map."""
    # A null family means the row only where the entry says so; a family marker without a family hides nothing.
    markers = log.filter((F.col("op") == DELETE_ROW) | ((F.col("op") == DELETE_FAMILY) & F.col("family").isNotNull()))
    markers = markers.withColumn("family", F.when(F.col("op") == DELETE_FAMILY, F.col("family")))
    per_family = group_by_key(markers, "row_key", "family").agg(F.max(F.struct("ts", "seq")).alias("marker"))
    family_marker = F.when(F.col("family").isNotNull(), F.struct("family", "marker"))
    return per_family.groupBy("row_key").agg(
        F.max(F.when(F.col("family").isNull(), F.col("marker"))).alias("row_marker"),
        F.map_from_entries(F.collect_list(family_marker)).alias("family_markers"),
    )


def resolve_latest(log: DataFrame) -> DataFrame:
    """Visible cells of a log: the newest put of each cell unless a newer delete covers it.

    Puts and column deletes meet in one aggregate: a cell is visible only if its newest entry is a put. The
    row and family markers, reduced to one line per row key, are then joined to the surviving cells. Nothing
    is windowed over a row key: a hot cell shrinks to one line per task before the shuffle, and the cells of
    a hot row are spread (``join_rows``). A put and a delete with the same ``(ts, seq)`` leave the put visible.
    """
    return _uncovered(_newest_entries(log, F.raise_error(F.lit("delete_newest entries need resolve_stacked"))), log)


def _newest_entries(log: DataFrame, undone: Column) -> DataFrame:
    """The newest entry of each cell, where that is a put. ``undone`` replaces the value of cells with newest-deletes."""
    # "put" sorts after "delete_column", which settles equal versions in favour of the put.
    newest = F.expr(f"max(struct(ts, seq, op, value)) FILTER (WHERE op <> '{DELETE_NEWEST}')").alias("newest")
    entries = group_by_key(log.filter(F.col("op").isin(PUT, DELETE_COLUMN, DELETE_NEWEST)), *COORDINATES)
    seen = entries.agg(newest, F.bool_or(F.col("op") == DELETE_NEWEST).alias("undone"))
    shown = F.when(F.col("undone"), undone).otherwise(F.col("newest.op") == PUT)
    return seen.filter(shown).select("row_key", "family", "qualifier", "newest.ts", "newest.seq", "newest.value")


def _uncovered(cells: DataFrame, log: DataFrame) -> DataFrame:
    """The cells that no newer row or family marker of the log hides."""
    written = F.struct("ts", "seq")
    hidden = (F.col("row_marker") > written) | (F.try_element_at("family_markers", F.col("family")) > written)
    return (
        join_rows(cells, _newest_markers(log), "left")
        .filter(~F.coalesce(hidden, F.lit(False)))
        .select(*CELL_COLUMNS)
    )


def resolve_stacked(log: DataFrame, block: int = BLOCK) -> DataFrame:
    """Visible cells of a log with ``delete_newest`` markers: each takes back one put, and the next older shows.

    The versions of a cell form a stack in the order of ``(ts, seq)``: a put lays one on top, a marker takes the top
    one off (or nothing, if there is none), every other delete clears what is older. Entries with one version count
    once, so a log may be written twice; of a put and a marker with one version the put came later and stays.
    Deletes of other kinds work as in ``resolve_latest``, and so do cells without such markers: one line a task.

    What shows is the newest put that, counted from the newest entry down, makes puts outnumber markers. That count
    is taken for cells with markers alone. Their versions go to groups of about ``block`` by their place between the
    cell's oldest and newest, so a cell of any size is counted in many tasks: totals of the groups first, then
    the one group where the count is reached. Versions that crowd in a small part of that span make larger groups.
    """
    plain = _newest_entries(log, F.lit(False))
    return _uncovered(plain.unionByName(_stack_tops(log, block)), log)


def _stack_tops(log: DataFrame, block: int) -> DataFrame:
    """The put on top of each cell that has ``delete_newest`` markers, unless a column delete is newer."""
    marked = log.filter((F.col("op") == DELETE_NEWEST) & F.col("family").isNotNull() & F.col("qualifier").isNotNull())
    entries = log.filter(F.col("op").isin(PUT, DELETE_COLUMN, DELETE_NEWEST))
    entries = _join_versions(entries, marked.select(*COORDINATES).distinct(), "left_semi")
    is_put, is_undo, is_clear = (F.col("op") == op for op in (PUT, DELETE_NEWEST, DELETE_COLUMN))
    # By version, so that a cell with very many is spread, and repeated entries are one.
    versions = group_by_key(entries, *COORDINATES, "ts", "seq").agg(
        F.max(F.when(is_put, F.struct("value"))).alias("put"),
        F.bool_or(is_undo).cast("int").alias("undo"),
        F.bool_or(is_clear).alias("clear"),
    ).withColumn("n", F.col("put").isNotNull().cast("int"))
    at = F.struct("ts", "seq")
    spans = group_by_key(versions, *COORDINATES).agg(
        F.min(at).alias("low"), F.max(at).alias("high"), F.count(F.lit(1)).alias("entries"),
        F.max(F.when(F.col("clear"), at)).alias("cleared"),
    )
    low, high = F.col("low"), F.col("high")
    by_seq = low["ts"] == high["ts"]
    number = lambda whole: F.when(by_seq, whole["seq"]).otherwise(whole["ts"]).cast("double")
    groups = F.ceil(F.col("entries") / F.lit(block))
    share = (number(at) - number(low)) / F.greatest(number(high) - number(low), F.lit(1.0))
    versions = _join_versions(versions, spans, "inner").withColumn("block", F.least(F.floor(share * groups), groups - 1))
    versions = versions.select(*COORDINATES, "block", "ts", "seq", "put", "undo", "n", "cleared")

    change = F.sum(F.col("n") - F.col("undo"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    totals = versions.groupBy(*COORDINATES, "block").agg(change.alias("change"))
    totals = totals.withColumn("after", F.coalesce(F.sum("change").over(later.partitionBy(*COORDINATES)), F.lit(0)))
    newer = Window.partitionBy(*COORDINATES, "block").orderBy(F.desc("ts"), F.desc("seq"))
    inside = F.coalesce(change.over(newer.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("n")
    counted = versions.withColumn("inside", inside).filter("n = 1")
    counted = counted.join(totals.drop("change"), [*COORDINATES, "block"]).filter("after + inside >= 1")
    tops = group_by_key(counted, *COORDINATES).agg(
        F.max(F.struct("ts", "seq", "put")).alias("top"), F.first("cleared").alias("cleared")
    )
    tops = tops.filter(F.col("cleared").isNull() | (F.struct("top.ts", "top.seq") >= F.col("cleared")))
    return tops.select(*COORDINATES, "top.ts", "top.seq", "top.put.value")


def _join_versions(entries: DataFrame, per_cell: DataFrame, how: str) -> DataFrame:
    """Join one line per cell to the cell's versions, which go to several shuffle groups (see ``join_rows``)."""
    part = F.pmod(F.xxhash64("ts", "seq"), F.lit(PARTS)).cast("int")
    copies = per_cell.withColumn("part", F.explode(F.array(*[F.lit(i) for i in range(PARTS)])))
    return entries.withColumn("part", part).join(copies, [*COORDINATES, "part"], how).drop("part")
