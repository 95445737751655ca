"""Stored tables: sorted loads into files, and the named tables of Spark's catalog.

A named table is a Parquet mutation log registered in the catalog with its column families as a table
property. It is partitioned by ``batch``: every append, micro-batch and compaction writes one folder and then
enters it in the catalog with its place. Streams and batch jobs so share a table; a batch that is replayed
replaces its own folder, and files being read are never overwritten.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colonnade.model import (
    CELL_SCHEMA,
    COORDINATES,
    DELETE_COLUMN,
    DELETE_FAMILY,
    DELETE_NEWEST,
    DELETE_ROW,
    LOG_COLUMNS,
    LOG_SCHEMA,
    PUT,
)
from colonnade.operators.cells import wide_to_cells
from colonnade.operators.mutations import put, resolve_latest
from colonnade.operators.ranges import count_not_above
from colonnade.operators.scan import get_rows, key_between


def in_key_order(cells: DataFrame, partitions: int | None = None) -> DataFrame:
    """Range-partition and sort by row key, family, qualifier and version.

    All sort columns are range boundaries: one huge row, or one cell with very many versions, is cut into
    several partitions and the order over all files still holds. Without ``partitions`` the session's
    shuffle settings decide.
    """
    order = [c for c in [*COORDINATES, "ts", "seq"] if c in cells.columns]
    ranged = cells.repartitionByRange(*([partitions] if partitions else []), *order)
    return ranged.sortWithinPartitions(*order)


def bulk_load(cells: DataFrame, path: str, partitions: int | None = None,
              max_records_per_file: int | None = None) -> None:
    """Write cells (or a log) as sorted Parquet, replacing what the path held.

    Sorted files give narrow row-key statistics, so key-range scans skip most row groups.
    """
    writer = in_key_order(cells, partitions).write.mode("overwrite")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)


def bulk_load_records(records: DataFrame, row_key: Column, columns: dict[str, Column], path: str,
                      ts: Column | None = None, seq: Column | None = None, partitions: int | None = None) -> None:
    """Sorted load straight from flat records: sort the records by row key, then cut each into cells.

    Only one row per record is shuffled, and only the columns that become cells. The cells of a record are
    written in column order; records that share a row key follow one another by version.
    """
    versions = {name: value for name, value in (("ts", ts), ("seq", seq)) if value is not None}
    values = {name: f"value{i}" for i, name in enumerate(columns)}
    keyed = records.select(
        row_key.alias("row_key"),
        *[value.alias(name) for name, value in versions.items()],
        *[columns[name].alias(alias) for name, alias in values.items()],
    )
    order = ["row_key", *versions]
    ranged = keyed.repartitionByRange(*([partitions] if partitions else []), *order)
    cells = wide_to_cells(
        ranged.sortWithinPartitions(*order),
        F.col("row_key"),
        {name: F.col(alias) for name, alias in values.items()},
        *[F.col(name) if name in versions else None for name in ("ts", "seq")],
    )
    cells.write.mode("overwrite").parquet(path)


# ---- loads aligned to key ranges -------------------------------------------------------------------------


def store_boundaries(spark: SparkSession, starts: list[str], path: str) -> list[str]:
    """Keep where the ranges of a table start: one line per range but the first, in byte order, without repeats."""
    ordered = sorted({s for s in starts if s}, key=str.encode)
    spark.createDataFrame([(s,) for s in ordered], "range_start string").coalesce(1).write.mode("overwrite").parquet(path)
    return ordered


def stored_boundaries(spark: SparkSession, path: str) -> list[str]:
    rows = spark.read.schema("range_start string").parquet(path).collect()
    return sorted((row[0] for row in rows), key=str.encode)


def range_number(starts: list[str], key: Column) -> Column:
    """0 below the first start, 1 from there on, and so forth."""
    return count_not_above(starts, key) if starts else F.lit(0)


def in_ranges(placed: DataFrame, ranges: int) -> DataFrame:
    """One shuffle partition for each number in ``range``, which needs no look at the keys beforehand."""
    return placed.repartitionById(ranges, F.col("range"))


def bulk_load_aligned(cells: DataFrame, path: str, starts: list[str], most_rows: int | None = None,
                      append: bool = False) -> None:
    """Sorted load into the ranges a table has: folder ``range=N`` holds the keys of range N and no others.

    The range of a cell is looked up in ``starts`` (``stored_boundaries``) and is its shuffle partition, so no
    sample of the keys is taken, and loads at different times share all boundaries. With ``most_rows`` the rows of
    each range are counted first; ranges with more are cut further by boundaries of their own, on all sort columns, so
    one huge row or cell fills several sorted files of its range. These ranges are written by a second job: load into a
    fresh folder, or append batches a reader is told of afterwards, where half a load must not be seen.
    A null row key fails the load. An empty load leaves an empty table.
    """
    order = ["range", *(c for c in [*COORDINATES, "ts", "seq"] if c in cells.columns)]
    missing = F.raise_error(F.lit("a row key must not be null"))
    number = F.when(F.col("row_key").isNull(), missing).otherwise(range_number(starts, F.col("row_key")))
    placed = cells.withColumn("range", number.cast("int"))
    large = {}
    if most_rows:
        counted = placed.groupBy("range").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most_rows)
        large = {row["range"]: -(-row["n"] // most_rows) for row in counted.collect()}
    is_large = F.col("range").isin(list(large))
    small = placed.filter(~is_large) if large else placed
    small = in_ranges(small, len(starts) + 1).sortWithinPartitions(*order)
    small.write.mode("append" if append else "overwrite").partitionBy("range").parquet(path)
    if large:
        cut = placed.filter(is_large).repartitionByRange(sum(large.values()), *order).sortWithinPartitions(*order)
        cut.write.mode("append").partitionBy("range").parquet(path)


def _with_range(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("range", T.IntegerType())])).parquet(path)


def read_range_folders(spark: SparkSession, path: str, numbers: list[int], schema: T.StructType = LOG_SCHEMA) -> DataFrame:
    """The cells, or the log, of the ranges with these numbers; no other folder is read."""
    return _with_range(spark, path, schema).filter(F.col("range").isin(list(numbers))).drop("range")


def read_aligned(spark: SparkSession, path: str, starts: list[str], start: str = "", stop: str = "",
                 keys: DataFrame | None = None, schema: T.StructType = CELL_SCHEMA) -> DataFrame:
    """Cells of an aligned load with ``start <= row_key < stop``, or of the rows whose keys are in ``keys.row_key``.

    Only folders of ranges that can hold them are listed and read, scattered keys included: of a set of keys of any
    size the distinct range numbers are looked up first, at most as many as there are ranges.
    """
    place = lambda bound: sum(s.encode() <= bound.encode() for s in starts)
    table = _with_range(spark, path, schema)
    if start:
        table = table.filter(F.col("range") >= place(start))
    if stop:
        # A range that begins at the stop itself is outside.
        table = table.filter(F.col("range") <= sum(s.encode() < stop.encode() for s in starts))
    table = table.filter(key_between(start, stop))
    if keys is not None:
        known = keys.filter(F.col("row_key").isNotNull())
        numbers = known.select(range_number(starts, F.col("row_key")).alias("n")).distinct().collect()
        table = get_rows(table.filter(F.col("range").isin([row["n"] for row in numbers])), known)
    return table.drop("range")


def read_log_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(path).select(*LOG_COLUMNS)


# ---- named tables ----------------------------------------------------------------------------------------

OPERATIONS = [PUT, DELETE_ROW, DELETE_FAMILY, DELETE_COLUMN, DELETE_NEWEST]


def create_table(spark: SparkSession, name: str, families: list[str], path: str | None = None) -> bool:
    """Create a table with fixed families and free columns; False if it is there already.

    With ``path`` the files outlive a drop; without, they belong to the catalog and go with the table.
    """
    if not families or any(not f or "," in f or ":" in f or "'" in f for f in families):
        raise ValueError(f"bad column families {families!r}")
    if spark.catalog.tableExists(name):
        return False
    columns = [f"{f.name} {f.dataType.simpleString()}" for f in LOG_SCHEMA.fields]
    location = f"LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}, batch STRING) USING parquet "
              f"PARTITIONED BY (batch) {location} TBLPROPERTIES ('families' = '{','.join(families)}')")
    return True


def table_location(spark: SparkSession, name: str) -> str:
    details = spark.sql(f"DESCRIBE FORMATTED {name}")
    return details.filter("col_name = 'Location'").first()["data_type"].rstrip("/")


def table_batches(spark: SparkSession, name: str) -> list[str]:
    """Names of the table's batches: one line for each append or micro-batch since the last compaction."""
    return [row[0].partition("=")[2] for row in spark.sql(f"SHOW PARTITIONS {name}").collect()]


def publish_batch(spark: SparkSession, name: str, batch: str, folder: str) -> None:
    """Make a written folder of log files visible as a batch of the table; repeating it changes nothing."""
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (batch = '{batch}') LOCATION '{folder}'")
    spark.catalog.refreshTable(name)


def drop_table(spark: SparkSession, name: str) -> bool:
    existed = spark.catalog.tableExists(name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return existed


def recreate_table(spark: SparkSession, name: str, families: list[str], path: str | None = None) -> str:
    """Drop this one table if it exists and create it empty; returns where it now lies.

    With ``path`` that is a fresh folder below it, so files that lie there already do not come back.
    """
    drop_table(spark, name)
    create_table(spark, name, families, path and f"{path.rstrip('/')}/v-{uuid.uuid4().hex}")
    return table_location(spark, name)


def table_families(spark: SparkSession, name: str) -> list[str]:
    properties = {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return properties["families"].split(",")


def checked(log: DataFrame, families: list[str]) -> DataFrame:
    """The same log, failing the write at the first entry that names too little or something unknown.

    Puts, column deletes and newest-deletes need a family and a qualifier, family deletes a family, all a row key and a known
    operation; families must be declared.
    """
    family, qualifier, op = F.col("family"), F.col("qualifier"), F.coalesce(F.col("op"), F.lit(""))
    needs_column = op.isin(PUT, DELETE_COLUMN, DELETE_NEWEST)
    said = lambda *parts: F.raise_error(F.concat(*parts))
    found = F.when(~op.isin(OPERATIONS), said(F.lit("unknown operation: "), op)).when(
        F.coalesce(F.col("row_key"), F.lit("")) == "", said(F.lit("a row key must not be empty"))
    ).when(
        (needs_column | (op == DELETE_FAMILY)) & family.isNull(), said(op, F.lit(" needs a column family"))
    ).when(
        needs_column & qualifier.isNull(), said(op, F.lit(" needs a qualifier"))
    ).when(
        family.isNotNull() & ~family.isin(families), said(F.lit("no such column family: "), family)
    )
    return log.withColumn("row_key", found.otherwise(F.col("row_key")))


def append_log(log: DataFrame, name: str) -> None:
    """Append puts and delete markers to a named table as a batch of its own; nothing is read or rewritten."""
    spark = log.sparkSession
    families = table_families(spark, name)
    batch = f"append-{uuid.uuid4().hex}"
    folder = f"{table_location(spark, name)}/batch={batch}"
    checked(log, families).select(*LOG_COLUMNS).write.parquet(folder)
    publish_batch(spark, name, batch, folder)


def append_cells(cells: DataFrame, name: str) -> None:
    append_log(put(cells), name)


def compact_table(spark: SparkSession, name: str, partitions: int | None = None,
                  resolve: Callable[[DataFrame], DataFrame] = resolve_latest) -> str:
    """Rewrite the batches a table has now as its visible cells, sorted, in one new batch; returns its folder.

    The new batch is entered before the old ones are taken out. A reader in between sees cells twice, in the same
    version, and shows them once. Batches that are added meanwhile stay. What arrives later with a version older
    than a delete that was compacted away shows again, and a later ``delete_newest`` finds no older version. Files of a table with a path stay for readers of the old
    batches, until the caller removes them.
    """
    old = table_batches(spark, name)
    batch = f"v-{uuid.uuid4().hex}"
    folder = f"{table_location(spark, name)}/batch={batch}"
    log = spark.table(name).filter(F.col("batch").isin(old)).select(*LOG_COLUMNS)
    bulk_load(put(resolve(log)), folder, partitions)
    publish_batch(spark, name, batch, folder)
    if old:
        specs = ", ".join(f"PARTITION (batch = '{one}')" for one in old)
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {specs}")
        spark.catalog.refreshTable(name)
    return folder


# ---- SQL tables and other connectors ---------------------------------------------------------------------


def jdbc_options(url: str, table: str, column: str | None = None, lower: int | None = None,
                 upper: int | None = None, partitions: int | None = None, **more: str) -> dict[str, str]:
    """Options for the ``jdbc`` format. With a numeric column and bounds the read is split into that many
    concurrent queries; without, one task reads the whole table."""
    options = {"url": url, "dbtable": table, **more}
    split = {"partitionColumn": column, "lowerBound": lower, "upperBound": upper, "numPartitions": partitions}
    given = {key: str(value) for key, value in split.items() if value is not None}
    if given and len(given) < len(split):
        raise ValueError("a partitioned read needs column, lower, upper and partitions together")
    return options | given


def read_table(spark: SparkSession, fmt: str, options: dict[str, str]) -> DataFrame:
    """Any DataFrame connector by name; filters and column selections are handed down by Spark."""
    return spark.read.format(fmt).options(**options).load()


def write_table(records: DataFrame, fmt: str, options: dict[str, str], mode: str = "overwrite") -> None:
    """Write through a connector. An overwritten SQL table keeps its definition (``truncate``)."""
    keep = {"truncate": "true"} if fmt == "jdbc" and mode == "overwrite" else {}
    records.write.format(fmt).options(**(keep | options)).mode(mode).save()


def upsert(base: DataFrame, changes: DataFrame, key: str, ts: str = "ts", seq: str = "seq",
           versions: bool = False) -> DataFrame:
    """Upsert by primary key: per column the newest value that was set; null in ``changes`` means "not set".

    Both sides carry the version columns. With ``versions`` the result has the newest version of each row too and
    can be the base of the next upsert; a later change must then be newer than the whole row. One shuffle on the
    key, one partial row per key and task before it.
    """
    columns = [c for c in base.columns if c not in (key, ts, seq)]
    both = base.unionByName(changes, allowMissingColumns=True)
    version = F.struct(F.col(ts).alias(ts), F.col(seq).alias(seq))
    newest = [F.max_by(c, F.when(F.col(c).isNotNull(), version)).alias(c) for c in columns]
    done = both.groupBy(key).agg(*newest, F.max(version).alias("_version"))
    if not versions:
        return done.drop("_version")
    return done.select(key, *columns, *[F.col("_version")[name].alias(name) for name in (ts, seq)])
