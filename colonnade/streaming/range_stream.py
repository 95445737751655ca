"""A stored table as a stream of its key ranges: whole rows in several micro-batches, restarted in the middle.

What is streamed is the list of ranges, one small file for each. A micro-batch is some of them; the folders of these
ranges are then read as any other files. A row lies in one range, so none is cut in two, and nothing is held in memory
between two steps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from colonnade.model import LOG_SCHEMA
from colonnade.operators.cells import join_values
from colonnade.operators.filters import KeyPrefix
from colonnade.operators.mutations import resolve_latest
from colonnade.operators.ranges import clip_ranges
from colonnade.operators.scan import Resolve, scan
from colonnade.sources.tables import read_range_folders
from colonnade.streaming.sinks import _start, _write_batch

RANGES_SCHEMA = "range int, range_start string, range_stop string"


def list_ranges(spark: SparkSession, starts: list[str], path: str, start: str = "", stop: str = "") -> int:
    """Write a file for each range of a table that ``start <= row_key < stop`` touches, its bounds clipped to these.

    ``starts`` are the table's stored boundaries. Returns the number of ranges; 0 leaves an empty folder.
    """
    limits = ["", *starts, ""]
    rows = [
        (number, *clipped)
        for number, bounds in enumerate(zip(limits[:-1], limits[1:], strict=True))
        for clipped in clip_ranges([bounds], start, stop)
    ]
    places = spark.createDataFrame(rows, RANGES_SCHEMA)
    if rows:
        places = places.repartitionById(rows[-1][0] - rows[0][0] + 1, places["range"] - rows[0][0])
    places.write.mode("overwrite").parquet(path)
    return len(rows)


def scan_ranges_stream(spark: SparkSession, table_path: str, ranges_path: str, path: str, checkpoint: str,
                       separator: str = ",", columns: list[str] | None = None, prefix: str = "",
                       ranges_per_batch: int = 16, schema: T.StructType = LOG_SCHEMA,
                       resolve: Resolve = resolve_latest) -> StreamingQuery:
    """Emit the ranges listed in ``ranges_path`` as ``(row_key, joined values)``, some ranges a micro-batch, and stop.

    ``table_path`` holds an aligned load (``bulk_load_aligned``), cells or a log. A stopped stream goes on, with its
    checkpoint, at the first range it has not finished; a batch that is repeated replaces its own folder. The table
    must not be loaded into meanwhile, or a row shows what was there when its range was read.
    """
    where = KeyPrefix(prefix) if prefix else None
    listed = spark.readStream.schema(RANGES_SCHEMA).option("maxFilesPerTrigger", ranges_per_batch).parquet(ranges_path)

    def write(batch: DataFrame, batch_id: int) -> None:
        places = sorted(batch.collect())  # as many as ranges_per_batch
        if not places:
            return
        # Only the first and the last range of the whole list are clipped: the span of a batch's own ranges is enough.
        low, high = places[0]["range_start"], places[-1]["range_stop"]
        near = read_range_folders(batch.sparkSession, table_path, [p["range"] for p in places], schema)
        joined = join_values(scan(near, low, high, columns, where, resolve=resolve), separator)
        _write_batch(joined, path, batch_id)

    return _start(listed, write, checkpoint, interval=None)
