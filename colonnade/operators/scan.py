"""Scans: full, key range, point, family and column, over cell tables and mutation logs alike."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colonnade.model import COORDINATES, DELETE_FAMILY, DELETE_ROW, is_column, split_column
from colonnade.operators.filters import KeyPrefix, apply_filter, value_filters
from colonnade.operators.mutations import resolve_latest
from colonnade.operators.rows import join_rows

#: From a log to its visible cells: ``resolve_latest``, or ``resolve_stacked`` where newest versions are deleted.
Resolve = Callable[[DataFrame], DataFrame]


def key_between(start: str | bytes = "", stop: str | bytes = "") -> Column:
    """``start <= row_key < stop`` in byte order; an empty bound is open."""
    inside = F.lit(True)
    if start:
        inside = inside & (F.col("row_key") >= F.lit(start))
    if stop:
        inside = inside & (F.col("row_key") < F.lit(stop))
    return inside


def _covers(columns: list[str]) -> Column:
    return reduce(or_, [is_column(name) for name in columns])


def _covers_with_markers(columns: list[str]) -> Column:
    """The selected columns of a log plus every delete marker that can hide them."""
    families = sorted({split_column(name)[0] for name in columns})
    family_marker = (F.col("op") == DELETE_FAMILY) & F.col("family").isin(families)
    return _covers(columns) | family_marker | (F.col("op") == DELETE_ROW)


def entries_for(table: DataFrame, start: str | bytes = "", stop: str | bytes = "", columns: list[str] | None = None,
                where=None) -> DataFrame:
    """The cells, or the entries of a log, that ``scan`` needs: key bounds, key filters and the column selection.

    Only predicates that a file reader can take; a log keeps the delete markers that can hide what is selected.
    """
    near = table.filter(key_between(start, stop))
    if isinstance(where, KeyPrefix):
        near = near.filter(where.predicate({}))
    if not columns:
        return near
    needed = [*columns, *(leaf.column for leaf in value_filters(where))]
    return near.filter(_covers_with_markers(needed) if "op" in table.columns else _covers(needed))


def scan(table: DataFrame, start: str | bytes = "", stop: str | bytes = "", columns: list[str] | None = None,
         where=None, ordered: bool = False, resolve: Resolve = resolve_latest) -> DataFrame:
    """Read cells of a cell table or, with deletes applied by ``resolve``, of a mutation log.

    ``columns`` lists families (``'info'``) or columns (``'info:name'``); ``where`` is a filter of
    ``operators.filters``. Key bounds and the column selection are put below the resolve step; values are
    only ever compared above it, because an older value of a cell must not surface.
    """
    columns = list(columns or [])
    needed = columns and [*columns, *(leaf.column for leaf in value_filters(where))]
    cells = table.filter(key_between(start, stop))
    if "op" in table.columns:
        cells = resolve(cells.filter(_covers_with_markers(needed)) if needed else cells)
    if needed:
        cells = cells.filter(_covers(needed))
    if where is not None:
        cells = apply_filter(cells, where)
        if columns:
            cells = cells.filter(_covers(columns))
    return cells.orderBy(*COORDINATES) if ordered else cells


def get_row(table: DataFrame, row_key: str | bytes, resolve: Resolve = resolve_latest) -> DataFrame:
    """All cells of one row; no row, no cells."""
    only = table.filter(F.col("row_key") == F.lit(row_key))
    return resolve(only) if "op" in table.columns else only


def get_rows(table: DataFrame, keys: DataFrame, resolve: Resolve = resolve_latest) -> DataFrame:
    """All cells of the rows whose keys are listed in ``keys.row_key``, a set of any size.

    The least and the largest key are looked up first (two values), as bounds that reach the files. The keys then
    select log entries, cells and markers alike, so only wanted rows are resolved. Repeated keys are dropped before
    the shuffle, so a key listed very often costs one line per task.
    """
    wanted = keys.select("row_key").filter(F.col("row_key").isNotNull())
    low, high = wanted.agg(F.min("row_key"), F.max("row_key")).first()
    if low is None:
        return get_row(table, "", resolve).limit(0)
    near = table.filter((F.col("row_key") >= F.lit(low)) & (F.col("row_key") <= F.lit(high)))
    chosen = join_rows(near, wanted.distinct(), "left_semi")
    return resolve(chosen) if "op" in table.columns else chosen
