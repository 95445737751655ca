"""Covering secondary indexes, kept as ordinary sorted tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colonnade.model import DELETE_ROW, LOG_COLUMNS, PUT, split_column
from colonnade.operators.cells import read_wide
from colonnade.operators.rows import deal_versions
from colonnade.operators.scan import get_rows, scan

#: Family of a maintained index, the column that names the indexed row, and what parts indexed values in entry keys.
INDEX, INDEXED_KEY, PART = "index", "key", "\u0000"


def index_rows(records: DataFrame, indexed: list[str], covered: list[str], row_key: str = "row_key",
               partitions: int | None = None) -> DataFrame:
    """``(indexed..., row_key, covered...)`` in index order.

    The row key is part of the range boundaries, so one frequent indexed value spreads over many partitions.
    """
    entries = records.select(*indexed, row_key, *covered)
    order = [*indexed, row_key]
    ranged = entries.repartitionByRange(*([partitions] if partitions else []), *order)
    return ranged.sortWithinPartitions(*order)


def build_index(records: DataFrame, path: str, indexed: list[str], covered: list[str],
                row_key: str = "row_key", partitions: int | None = None) -> None:
    index_rows(records, indexed, covered, row_key, partitions).write.mode("overwrite").parquet(path)


def lookup_covered(index: DataFrame, condition: Column, columns: list[str]) -> DataFrame:
    """Answer from the index alone; the condition reaches its sorted Parquet files."""
    return index.filter(condition).select(*columns)


def lookup_rows(index: DataFrame, condition: Column, table: DataFrame) -> DataFrame:
    """Answer from the main table: the row keys found in the index select its rows."""
    return get_rows(table, index.filter(condition))


def entry_key(values: list[Column]) -> Column:
    """The key of an index entry: its values and the row key, in byte order of the first value, then the next.

    Values must not hold the zero character that parts them; such a job fails rather than mix up entries.
    """
    whole = F.concat_ws(PART, *values)
    clear = F.length(whole) - F.length(F.replace(whole, F.lit(PART), F.lit(""))) == len(values) - 1
    return F.when(clear, whole).otherwise(F.raise_error(F.lit("an indexed value holds the zero character")))


def index_changes(before: DataFrame, changes: DataFrame, indexed: list[str], covered: list[str],
                  ts: int, seq: int = 0) -> DataFrame:
    """What a batch of changes to a table does to its index, as entries of the index's own log.

    ``before`` is the log the index stands for, ``changes`` the entries appended to it (puts and deletes of any
    kind), ``(ts, seq)`` the version of this step: larger than that of the step before. Only rows whose keys occur
    in ``changes`` are read. An entry that is no longer true gets a row delete, a new one puts: a row that moves to
    another value does both. Rows without one of the indexed values have no entry. Entries that stay are not written.
    Append the result to the index's log, in any order with other steps; starting from an empty log with
    ``before.limit(0)`` and the whole table as changes builds it. Both logs are dealt anew before they are resolved, so
    that no task sorts a whole table, however few files hold it.
    """
    names = [*indexed, *covered]
    fields = {name: f"f{i}" for i, name in enumerate(names)}
    columns = dict.fromkeys(names, "string")
    keys = changes.select("row_key").distinct()
    near = deal_versions(get_rows(before, keys, resolve=lambda chosen: chosen))
    # Every change is of a changed row: nothing to look up.
    added = deal_versions(changes.filter(F.col("row_key").isNotNull()))

    def entries(log: DataFrame, alias: str) -> DataFrame:
        rows = read_wide(log, columns, fields).dropna(subset=[fields[name] for name in indexed])
        return rows.select("row_key", F.struct(*fields.values()).alias(alias))

    # Of two rows with one key at most: both sides are reduced to one line per changed row.
    met = entries(near, "old").join(entries(near.unionByName(added), "new"), "row_key", "full")
    met = met.filter(~F.col("old").eqNullSafe(F.col("new")))

    def key(side: str) -> Column:
        return entry_key([F.col(side)[fields[name]] for name in indexed] + [F.col("row_key")])

    def written(side: str, op: str, qualifier: str | None, value: Column | None) -> Column:
        parts = {
            "row_key": key(side), "family": F.lit(INDEX if qualifier else None).cast("string"),
            "qualifier": F.lit(qualifier).cast("string"), "ts": F.lit(ts).cast("bigint"), "seq": F.lit(seq).cast("bigint"),
            "value": (F.lit(None) if value is None else value).cast("string"), "op": F.lit(op),
        }
        return F.struct(*(parts[name].alias(name) for name in LOG_COLUMNS))

    puts = [written("new", PUT, INDEXED_KEY, F.col("row_key"))]
    puts += [written("new", PUT, name.replace(":", "."), F.col("new")[fields[name]]) for name in names]
    gone = F.when(F.col("old").isNotNull(), F.array(written("old", DELETE_ROW, None, None)))
    come = F.when(F.col("new").isNotNull(), F.array(*puts))
    told = F.concat(F.coalesce(gone, F.array()), F.coalesce(come, F.array()))
    return met.select(F.explode(told).alias("e")).select("e.*").filter("op <> 'put' OR value IS NOT NULL")


def read_index(index_log: DataFrame, indexed: list[str], covered: list[str], values: list[str] | None = None) -> DataFrame:
    """``row_key`` and the indexed and covered columns, named by qualifier, of the entries in force.

    ``values`` fixes the first indexed columns; they become key bounds that reach the files of the log.
    """
    names = [*indexed, *covered]
    start = "".join(value + PART for value in values or [])
    stop = start[:-1] + chr(ord(PART) + 1) if start else ""
    cells = scan(index_log, start, stop)
    columns = {f"{INDEX}:{INDEXED_KEY}": "string", **{f"{INDEX}:{name.replace(':', '.')}": "string" for name in names}}
    outputs = {f"{INDEX}:{name.replace(':', '.')}": split_column(name)[1] for name in names}
    found = read_wide(cells, columns, outputs | {f"{INDEX}:{INDEXED_KEY}": "indexed_row_key"})
    return found.select(F.col("indexed_row_key").alias("row_key"), *outputs.values())
