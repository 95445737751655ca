"""Between flat records, cells and whole rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.functions.codecs import decode_value
from colonnade.functions.text import render_cell
from colonnade.model import is_column, split_column, version
from colonnade.operators.rows import group_by_key
from colonnade.operators.scan import scan


def wide_to_cells(records: DataFrame, row_key: Column, columns: dict[str, Column],
                  ts: Column | None = None, seq: Column | None = None) -> DataFrame:
    """One record becomes one cell per non-null value; ``columns`` maps ``family:qualifier`` to its value.

    Cells of a record come out in column order. No shuffle: every record is exploded where it is read.
    """
    structs = []
    for name in sorted(columns, key=split_column):
        family, qualifier = split_column(name)
        if not qualifier:
            raise ValueError(f"column {name!r} names no qualifier")
        value = columns[name].alias("value")
        structs.append(F.struct(F.lit(family).alias("family"), F.lit(qualifier).alias("qualifier"), value))
    zero = F.lit(0)
    return (
        records.select(
            row_key.alias("row_key"),
            (zero if ts is None else ts).cast("bigint").alias("ts"),
            (zero if seq is None else seq).cast("bigint").alias("seq"),
            F.explode(F.array(*structs)).alias("cell"),
        )
        .filter(F.col("cell.value").isNotNull())
        .select("row_key", "cell.family", "cell.qualifier", "ts", "seq", "cell.value")
    )


def cells_from_maps(spark: SparkSession, rows: list[dict], ts: int = 0) -> DataFrame:
    """A client's list of ``rowKey, columnFamily, columnName, columnValue`` maps; values become text.

    Later list entries count as newer, as they would when put one after another.
    """
    cells = [
        (str(r["rowKey"]), str(r["columnFamily"]), str(r["columnName"]), ts, i, str(r["columnValue"]))
        for i, r in enumerate(rows)
    ]
    schema = "row_key string, family string, qualifier string, ts bigint, seq bigint, value string"
    return spark.createDataFrame(cells, schema)


def cells_from_records(records: DataFrame, ts: Column, seq: Column) -> DataFrame:
    """The same four fields as columns of a DataFrame of any size and value type."""
    return records.select(
        F.col("rowKey").cast("string").alias("row_key"),
        F.col("columnFamily").cast("string").alias("family"),
        F.col("columnName").cast("string").alias("qualifier"),
        ts.cast("bigint").alias("ts"),
        seq.cast("bigint").alias("seq"),
        F.col("columnValue").cast("string").alias("value"),
    )


def read_wide(cells: DataFrame, columns: dict[str, str], names: dict[str, str] | None = None) -> DataFrame:
    """One row per row key with a typed column per declared ``family:qualifier`` (null where absent).

    ``columns`` maps each column to ``string``, ``int`` or ``bigint``; ``names`` renames the outputs, which
    are otherwise called by qualifier. The newest version of each cell is taken; a log has its deletes applied
    first. Only declared cells are shuffled, one partial row per key and task.
    """
    names = names or {}
    if "op" in cells.columns:
        cells = scan(cells, columns=list(columns))
    binary = dict(cells.dtypes)["value"] == "binary"
    wanted = [is_column(name) for name in columns]
    anything = wanted[0]
    for predicate in wanted[1:]:
        anything = anything | predicate
    picked = [
        F.max_by("value", F.when(predicate, version())).alias(f"c{i}") for i, predicate in enumerate(wanted)
    ]
    newest = group_by_key(cells.filter(anything), "row_key").agg(*picked)
    return newest.select(
        "row_key",
        *[
            decode_value(F.col(f"c{i}"), type_name, binary).alias(names.get(name, split_column(name)[1]))
            for i, (name, type_name) in enumerate(columns.items())
        ],
    )


def join_values(cells: DataFrame, separator: str) -> DataFrame:
    """``(row_key, value)`` with all values of a row in (family, qualifier) order, joined by a separator.

    The result holds a whole row in one string, so resolve versions and project columns first.
    """
    ordered = F.array_sort(F.collect_list(F.struct("family", "qualifier", "value")))
    values = F.transform(ordered, lambda cell: cell["value"])
    joined = group_by_key(cells, "row_key").agg(F.array_join(values, separator).alias("value"))
    return joined.select("row_key", "value")


def render_cells(cells: DataFrame, with_family: bool = True) -> DataFrame:
    return cells.select("row_key", render_cell(with_family).alias("cell"))
