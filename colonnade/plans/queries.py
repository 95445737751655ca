"""One registered query per operator; each takes (spark, sf_dir) and reads its tables whole."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.functions import codecs, keys
from colonnade.functions.text import render_cell
from colonnade.model import LOG_SCHEMA, PUT
from colonnade.operators import cells as cell_ops
from colonnade.operators import mutations as mut
from colonnade.operators import ranges
from colonnade.operators import scan as scans
from colonnade.operators import word_count as counting
from colonnade.operators.filters import (
    COMPARISONS,
    AllOf,
    AnyOf,
    ColumnPrefix,
    ColumnValue,
    KeyCompare,
    KeyPrefix,
    KeyRegex,
    compare,
)
from colonnade.operators.index import build_index, index_changes, lookup_covered, lookup_rows, read_index
from colonnade.plans import inputs
from colonnade.session import scratch_dir
from colonnade.sources import file_upserts, tables
from colonnade.sources.text import LOG_FIELDS, bulk_load_log, read_delimited, read_log
from colonnade.streaming import ledger, range_stream, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

GOLD = ColumnValue("acct:tier", "EQUAL", "gold", filter_if_missing=True)

#: Rows of a range from which an aligned load cuts it into more files.
ROWS_PER_FILE = 5_000_000


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def plain(cells: DataFrame) -> DataFrame:
    return cells.select("row_key", "family", "qualifier", "value")


# ---- scans -----------------------------------------------------------------------------------------------


@query
def scan_full(spark, sf_dir):
    return plain(scans.scan(inputs.customer_cells(spark, sf_dir)))


@query
def scan_range(spark, sf_dir):
    return plain(scans.scan(inputs.stored_customers(spark, sf_dir, salted=True), start="4", stop="c"))


@query
def get_row(spark, sf_dir):
    return plain(scans.get_row(inputs.stored_customers(spark, sf_dir), "42".zfill(19)))


def _customer_log(spark, sf_dir):
    """The stored cells with deletes of one segment's names: a log whose rows lie in sorted files."""
    puts = mut.put(inputs.stored_customers(spark, sf_dir))
    return puts.unionByName(mut.delete_column(inputs.customer_keys(spark, sf_dir), "info", "name"))


@query
def get_rows(spark, sf_dir):
    urgent = inputs.load(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    wanted = urgent.select(inputs.padded("o_custkey").alias("row_key"))
    return plain(scans.get_rows(_customer_log(spark, sf_dir), wanted))


@query
def scan_family(spark, sf_dir):
    return plain(scans.scan(inputs.stored_customers(spark, sf_dir), columns=["info"]))


@query
def scan_column(spark, sf_dir):
    return plain(scans.scan(inputs.stored_customers(spark, sf_dir), columns=["info:name"]))


@query
def scan_log_columns(spark, sf_dir):
    """Selected columns of a log with deletes: markers go through the selection, values do not."""
    log = inputs.event_log(inputs.load(spark, sf_dir, "events"))
    return plain(scans.scan(log, columns=["ev:view", "buy"]))


@query
def key_range_stats(spark, sf_dir):
    regions = [("", "4"), ("4", "8"), ("8", "c"), ("c", "")]
    return ranges.key_range_stats(spark, inputs.customer_cells(spark, sf_dir, salted=True), regions, "2", "e")


@query
def key_range_stats_log(spark, sf_dir):
    """The same figures of a log: markers and deleted cells do not count."""
    bounds = [("", "100".zfill(19)), ("100".zfill(19), "400".zfill(19)), ("400".zfill(19), "")]
    log = inputs.event_log(inputs.load(spark, sf_dir, "events"))
    return ranges.key_range_stats(spark, log, bounds, "5".zfill(19), "")


# ---- rows, codecs, keys ----------------------------------------------------------------------------------


@query
def read_wide(spark, sf_dir):
    columns = {"info:name": "string", "info:segment": "string", "geo:nation": "int", "acct:tier": "string"}
    return cell_ops.read_wide(inputs.customer_cells(spark, sf_dir), columns)


@query
def read_wide_bytes(spark, sf_dir):
    columns = {"info:name": "string", "info:number": "int", "info:large": "bigint"}
    return cell_ops.read_wide(inputs.customer_byte_cells(spark, sf_dir), columns)


@query
def wide_to_cells(spark, sf_dir):
    columns = {
        "o:status": F.col("o_orderstatus"),
        "o:priority": F.col("o_orderpriority"),
        "o:customer": F.col("o_custkey").cast("string"),
        "o:open": F.when(F.col("o_orderstatus") != "F", F.lit("yes")),
    }
    return plain(cell_ops.wide_to_cells(inputs.load(spark, sf_dir, "orders"), inputs.padded("o_orderkey"), columns))


@query
def render_cells(spark, sf_dir):
    return inputs.customer_cells(spark, sf_dir).select(
        "row_key", render_cell().alias("scanned"), render_cell(with_family=False).alias("got")
    )


@query
def scan_joined(spark, sf_dir):
    return cell_ops.join_values(scans.scan(inputs.customer_cells(spark, sf_dir)), "_")


@query
def filter_joined_prefix(spark, sf_dir):
    joined = cell_ops.join_values(scans.scan(inputs.customer_cells(spark, sf_dir), columns=["acct", "info"]), "-")
    return joined.filter(F.col("value").startswith("gold-"))


@query
def codec_roundtrip(spark, sf_dir):
    number = F.col("c_custkey") - 750
    large = number * 3_000_000_019
    encoded = inputs.load(spark, sf_dir, "customer").select(
        "c_custkey",
        codecs.encode_int(number).alias("i"),
        codecs.encode_bigint(large).alias("l"),
        codecs.encode_text(F.col("c_name")).alias("t"),
    )
    return encoded.select(
        "c_custkey",
        F.hex("i").alias("int_hex"),
        codecs.decode_int(F.col("i")).alias("int_back"),
        F.hex("l").alias("bigint_hex"),
        codecs.decode_bigint(F.col("l")).alias("bigint_back"),
        F.hex("t").alias("text_hex"),
        codecs.decode_text(F.col("t")).alias("text_back"),
    )


@query
def key_reverse(spark, sf_dir):
    key = F.col("o_orderkey").cast("string")
    return inputs.load(spark, sf_dir, "orders").select("o_orderkey", keys.reverse_key(key).alias("row_key"))


@query
def key_salt(spark, sf_dir):
    salted = keys.salt_key(F.col("o_orderkey").cast("string"))
    rows = inputs.load(spark, sf_dir, "orders").select("o_orderkey", salted.alias("row_key"))
    return rows.withColumn("unsalted", keys.unsalt_key(F.col("row_key")))


@query
def key_time(spark, sf_dir):
    millis = keys.epoch_millis(F.col("ts"))
    return inputs.load(spark, sf_dir, "events").select(
        "event_id",
        F.hex(keys.time_key(millis, F.col("event_id"))).alias("key_hex"),
        keys.time_key_text(millis, F.col("event_id")).alias("key_text"),
    )


@query
def key_composite(spark, sf_dir):
    seconds = F.floor(keys.epoch_millis(F.col("ts")) / 1000)
    key = keys.composite_key(F.pmod("user_id", F.lit(16)), F.col("user_id"), seconds, F.col("event_id"), wide=True)
    return inputs.load(spark, sf_dir, "events").select("event_id", F.hex(key).alias("key_hex"))


# ---- filters ---------------------------------------------------------------------------------------------


@query
def filter_key_prefix(spark, sf_dir):
    return plain(scans.scan(inputs.stored_customers(spark, sf_dir, salted=True), where=KeyPrefix("a")))


@query
def filter_key_regex(spark, sf_dir):
    return plain(scans.scan(inputs.stored_customers(spark, sf_dir), where=KeyRegex("7$")))


@query
def filter_key_literal(spark, sf_dir):
    """A pattern that is a literal prefix, which the file reader can check."""
    return plain(scans.scan(inputs.stored_customers(spark, sf_dir, salted=True), where=KeyRegex("^b")))


@query
def filter_key_compare(spark, sf_dir):
    where = AllOf(KeyCompare("GREATER_OR_EQUAL", "5"), KeyCompare("LESS", "9"))
    return plain(scans.scan(inputs.stored_customers(spark, sf_dir, salted=True), where=where))


@query
def filter_column_prefix(spark, sf_dir):
    return plain(scans.scan(inputs.customer_cells(spark, sf_dir), where=ColumnPrefix("na")))


@query
def filter_column_value(spark, sf_dir):
    return plain(scans.scan(inputs.customer_cells(spark, sf_dir), where=ColumnValue("acct:tier", "EQUAL", "gold")))


@query
def filter_column_value_strict(spark, sf_dir):
    return plain(scans.scan(inputs.customer_cells(spark, sf_dir), where=GOLD))


@query
def filter_bytes_typed(spark, sf_dir):
    """An integer comparison on encoded values, where the bytes of negative numbers sort last."""
    negative = ColumnValue("info:number", "LESS", 0, type_name="int", filter_if_missing=True)
    found = scans.scan(inputs.customer_byte_cells(spark, sf_dir), columns=["info:name", "info:number"], where=negative)
    return found.select("row_key", "qualifier", F.hex("value").alias("value_hex"))


@query
def filter_any(spark, sf_dir):
    return plain(scans.scan(inputs.customer_cells(spark, sf_dir), where=AnyOf(KeyRegex("7$"), GOLD)))


@query
def filter_all(spark, sf_dir):
    return plain(scans.scan(inputs.customer_cells(spark, sf_dir), where=AllOf(GOLD, ColumnPrefix("na"))))


@query
def filter_nested(spark, sf_dir):
    """A list inside a list, with a projection that leaves out the tested columns."""
    low_nation = ColumnValue("geo:nation", "LESS", 10, type_name="int", filter_if_missing=True)
    where = AllOf(AnyOf(GOLD, low_nation), KeyRegex("[02468]$"))
    return plain(scans.scan(inputs.customer_cells(spark, sf_dir), columns=["info:name"], where=where))


@query
def filter_compare_ops(spark, sf_dir):
    """Every comparison on one column, on the stored text and on its integer value."""
    nation = scans.scan(inputs.customer_cells(spark, sf_dir), columns=["geo:nation"])
    value = F.col("value")
    flags = [compare(value, op, "9").alias(f"raw_{op.lower()}") for op in COMPARISONS]
    flags += [compare(value, op, 9, "int").alias(f"typed_{op.lower()}") for op in COMPARISONS]
    return nation.select("row_key", "value", *flags)


# ---- mutations -------------------------------------------------------------------------------------------


@query
def resolve_latest(spark, sf_dir):
    log = inputs.event_log(inputs.load(spark, sf_dir, "events"))
    return mut.resolve_latest(log).select("row_key", "family", "qualifier", "ts", "seq", "value")


@query
def resolve_versions(spark, sf_dir):
    newest = mut.newest_versions(inputs.lineitem_cells(spark, sf_dir))
    return newest.select("row_key", "family", "qualifier", "ts", "seq", "value")


@query
def put_batch(spark, sf_dir):
    """A batch of (row, family, column, value) records and one of deletes, appended to a log and read back."""
    log = inputs.event_log(inputs.load(spark, sf_dir, "events"))
    records = log.filter(F.col("op") == PUT).select(
        "ts", "seq", F.col("row_key").alias("rowKey"), F.col("family").alias("columnFamily"),
        F.col("qualifier").alias("columnName"), F.col("value").alias("columnValue"),
    )
    path = scratch_dir(spark, "put-batch")
    mut.put(cell_ops.cells_from_records(records, F.col("ts"), F.col("seq"))).write.mode("append").parquet(path)
    log.filter(F.col("op") != PUT).write.mode("append").parquet(path)
    return plain(mut.resolve_latest(tables.read_log_files(spark, path)))


@query
def put_update(spark, sf_dir):
    base = mut.put(inputs.customer_cells(spark, sf_dir))
    rich = inputs.load(spark, sf_dir, "customer").filter(F.col("c_acctbal") >= 9000)
    change = cell_ops.wide_to_cells(rich, inputs.padded("c_custkey"), {"info:segment": F.lit("VIP")}, ts=F.lit(1))
    return plain(mut.resolve_latest(base.unionByName(mut.put(change))))


def _after_delete(spark, sf_dir, delete):
    base = mut.put(inputs.customer_cells(spark, sf_dir))
    return plain(mut.resolve_latest(base.unionByName(delete(inputs.customer_keys(spark, sf_dir)))))


@query
def delete_row(spark, sf_dir):
    return _after_delete(spark, sf_dir, mut.delete_rows)


@query
def delete_family(spark, sf_dir):
    return _after_delete(spark, sf_dir, lambda keyed: mut.delete_family(keyed, "info"))


@query
def delete_column(spark, sf_dir):
    return _after_delete(spark, sf_dir, lambda keyed: mut.delete_column(keyed, "info", "name"))


@query
def delete_columns(spark, sf_dir):
    return _after_delete(spark, sf_dir, lambda keyed: mut.delete_columns(keyed, "info", ["name", "segment"]))


@query
def delete_newest(spark, sf_dir):
    """Every signup takes back its user's newest view; the view before shows again, if no other delete hides it."""
    log = inputs.event_log(inputs.load(spark, sf_dir, "events"), newest_only=True)
    return mut.resolve_stacked(log).select("row_key", "family", "qualifier", "ts", "seq", "value")


@query
def table_lifecycle(spark, sf_dir):
    """Create, create again (no effect), fill, drop and recreate empty, fill with one family."""
    name = f"cells_{uuid.uuid4().hex}"
    cells = inputs.customer_cells(spark, sf_dir)
    families = ["acct", "geo", "info"]
    tables.create_table(spark, name, families, scratch_dir(spark, "table"))
    tables.append_cells(cells, name)
    if tables.create_table(spark, name, families):
        raise RuntimeError("an existing table was created again")
    path = tables.recreate_table(spark, name, families, tables.table_location(spark, name))
    tables.append_cells(cells.filter(F.col("family") == "info"), name)
    tables.drop_table(spark, name)
    return plain(mut.resolve_latest(tables.read_log_files(spark, path)))


@query
def table_compaction(spark, sf_dir):
    """A log table rewritten as its visible cells; resolving the result changes nothing more."""
    name = f"cells_{uuid.uuid4().hex}"
    tables.create_table(spark, name, ["ev", "buy"], scratch_dir(spark, "table"))
    tables.append_log(inputs.event_log(inputs.load(spark, sf_dir, "events")), name)
    path = tables.compact_table(spark, name)
    tables.drop_table(spark, name)
    return plain(mut.resolve_latest(tables.read_log_files(spark, path)))


@query
def sql_upsert(spark, sf_dir):
    """Upsert by primary key, then plain SQL over the result. Columns a change does not set stay."""
    customer = inputs.load(spark, sf_dir, "customer")
    base = customer.select(
        "c_custkey", "c_name", "c_mktsegment", F.lit(0).alias("ts"), F.lit(0).alias("seq")
    )
    changes = customer.filter(F.col("c_acctbal") < 0).select(
        "c_custkey", F.lit("DEBT").alias("c_mktsegment"), F.lit(1).alias("ts"), F.lit(0).alias("seq")
    )
    later = customer.filter(F.col("c_acctbal") < -500).select(
        "c_custkey", F.lit("STOP").alias("c_mktsegment"), F.lit(2).alias("ts"), F.lit(0).alias("seq")
    )
    once = tables.upsert(base, changes, "c_custkey", versions=True)
    view = f"upserted_{uuid.uuid4().hex}"
    tables.upsert(once, later, "c_custkey").createOrReplaceTempView(view)
    result = spark.sql(f"SELECT * FROM {view}")
    spark.catalog.dropTempView(view)
    return result


@query
def sql_upsert_files(spark, sf_dir):
    """The same two upserts on a stored table: files without a changed key are neither read nor written again."""
    path = scratch_dir(spark, "keyed")
    customer = inputs.load(spark, sf_dir, "customer")
    number = [F.lit(0).cast("bigint").alias("seq")]
    base = customer.select("c_custkey", "c_name", "c_mktsegment", F.lit(0).cast("bigint").alias("ts"), *number)
    file_upserts.create_keyed_table(base, path, "c_custkey", ROWS_PER_FILE)
    for ts, limit, segment in ((1, 0, "DEBT"), (2, -500, "STOP")):
        changes = customer.filter(F.col("c_acctbal") < limit).select(
            "c_custkey", F.lit(segment).alias("c_mktsegment"), F.lit(ts).cast("bigint").alias("ts"), *number
        )
        file_upserts.upsert_files(changes, path, "c_custkey", base.schema, ROWS_PER_FILE)
    return file_upserts.read_keyed_table(spark, path, base.schema).select("c_custkey", "c_name", "c_mktsegment")


# ---- aggregation -----------------------------------------------------------------------------------------


@query
def word_count(spark, sf_dir):
    return counting.word_count(inputs.document_cells(spark, sf_dir))


@query
def word_count_cells(spark, sf_dir):
    return plain(counting.word_count_cells(inputs.document_cells(spark, sf_dir)))


# ---- sources and sinks -----------------------------------------------------------------------------------


def _delimited(spark, sf_dir, strict):
    path = scratch_dir(spark, "lines")
    inputs.event_lines(inputs.load(spark, sf_dir, "events")).select("value").write.text(path)
    good, bad = read_delimited(spark, path, ["key", "name", "age"], strict=strict)
    return good.unionByName(bad, allowMissingColumns=True)


@query
def csv_source(spark, sf_dir):
    return _delimited(spark, sf_dir, strict=False)


@query
def csv_source_strict(spark, sf_dir):
    return _delimited(spark, sf_dir, strict=True)


@query
def log_bulk_load(spark, sf_dir):
    """Tab-separated log -> content keys -> five cells per line -> sorted files -> read back."""
    lines, path = scratch_dir(spark, "log"), scratch_dir(spark, "log-cells")
    records = inputs.event_records(inputs.load(spark, sf_dir, "events"))
    records.select(F.concat_ws("\t", *LOG_FIELDS)).write.text(lines)
    good, _ = read_log(spark, lines)
    bulk_load_log(good, path)
    return plain(spark.read.parquet(path))


@query
def bulk_load_single(spark, sf_dir):
    path = scratch_dir(spark, "bulk")
    key = keys.salt_key(F.col("c_custkey").cast("string"))
    customer = inputs.load(spark, sf_dir, "customer")
    tables.bulk_load_records(customer, key, {"cf1:name": F.col("c_name")}, path)
    return plain(spark.read.parquet(path))


def _aligned(spark, sf_dir):
    """Two loads at different times into one table's ranges; where they start is read from its stored list."""
    bounds, path = scratch_dir(spark, "boundaries"), scratch_dir(spark, "aligned")
    tables.store_boundaries(spark, list("123456789abcdef"), bounds)
    cells = inputs.customer_cells(spark, sf_dir, salted=True)
    for part in ("info", "geo acct"):
        starts = tables.stored_boundaries(spark, bounds)
        some = cells.filter(F.col("family").isin(part.split()))
        tables.bulk_load_aligned(some, path, starts, most_rows=ROWS_PER_FILE, append=part != "info")
    return path, starts


@query
def bulk_load_aligned(spark, sf_dir):
    return plain(tables.read_aligned(spark, *_aligned(spark, sf_dir), start="4", stop="c"))


@query
def get_rows_aligned(spark, sf_dir):
    """Scattered keys of a table in ranges: those of customers with urgent orders."""
    urgent = inputs.load(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    wanted = urgent.select(keys.salt_key(F.col("o_custkey").cast("string")).alias("row_key"))
    return plain(tables.read_aligned(spark, *_aligned(spark, sf_dir), keys=wanted))


@query
def bulk_load_multi(spark, sf_dir):
    path = scratch_dir(spark, "bulk")
    key = keys.salt_key(F.col("o_orderkey").cast("string"))
    columns = {"cf1:status": F.col("o_orderstatus"), "cf1:priority": F.col("o_orderpriority")}
    tables.bulk_load_records(inputs.load(spark, sf_dir, "orders"), key, columns, path)
    return plain(spark.read.parquet(path))


@query
def upsert_write(spark, sf_dir):
    """Two appends to one log under reversed keys; the second wins where both wrote a cell."""
    path = scratch_dir(spark, "upserts")
    customer = inputs.load(spark, sf_dir, "customer")
    key = keys.reverse_key(inputs.padded("c_custkey"))
    first = {"cf1:name": F.col("c_name"), "cf1:segment": F.col("c_mktsegment")}
    mut.put(cell_ops.wide_to_cells(customer, key, first)).write.mode("append").parquet(path)
    indebted = customer.filter(F.col("c_acctbal") < 0)
    second = cell_ops.wide_to_cells(indebted, key, {"cf1:segment": F.lit("DEBT")}, ts=F.lit(1))
    mut.put(second).write.mode("append").parquet(path)
    return plain(mut.resolve_latest(tables.read_log_files(spark, path)))


@query
def connector_roundtrip(spark, sf_dir):
    """Overwrite through a connector chosen by name, then read through it."""
    options = {"path": scratch_dir(spark, "connector")}
    customer = inputs.load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    tables.write_table(customer, "orc", options)
    return tables.read_table(spark, "orc", options)


# ---- streams ---------------------------------------------------------------------------------------------


@query
def stream_upsert(spark, sf_dir):
    path = scratch_dir(spark, "stream")
    lines = inputs.event_lines(inputs.load_stream(spark, sf_dir, "events"))
    columns = ["cf1:name", "cf1:age"]
    sinks.upsert_stream(lines, columns, path, scratch_dir(spark, "offsets"), interval=None).awaitTermination()
    return plain(mut.resolve_latest(sinks.read_upserts(spark, path)))


@query
def stream_rejects(spark, sf_dir):
    path = scratch_dir(spark, "stream")
    lines = inputs.event_lines(inputs.load_stream(spark, sf_dir, "events"))
    offsets = scratch_dir(spark, "offsets")
    sinks.upsert_stream(lines, ["cf1:name", "cf1:age"], path, offsets, interval=None).awaitTermination()
    return sinks.read_rejects(spark, path)


@query
def stream_latest(spark, sf_dir):
    path = scratch_dir(spark, "stream")
    log = inputs.event_log(inputs.load_stream(spark, sf_dir, "events"))
    sinks.latest_stream(log, path, scratch_dir(spark, "offsets"), interval=None).awaitTermination()
    return plain(mut.resolve_latest(sinks.read_batches(spark, path)))


@query
def stream_table(spark, sf_dir):
    """One table: made by a stream, appended to by a batch job, compacted, filled by a second stream, read."""
    name = f"cells_{uuid.uuid4().hex}"
    lines = inputs.event_lines(inputs.load_stream(spark, sf_dir, "events"))
    columns = ["cf1:name", "cf1:age"]

    def fill(some):
        path, offsets = scratch_dir(spark, "stream"), scratch_dir(spark, "offsets")
        sinks.upsert_stream(some, columns, path, offsets, interval=None, table=name).awaitTermination()

    fill(lines.filter(F.col("seq") % 2 == 0))
    customers = inputs.load(spark, sf_dir, "customer")
    key = F.concat(F.lit("c"), inputs.padded("c_custkey"))
    tables.append_cells(cell_ops.wide_to_cells(customers, key, {"cf1:name": F.col("c_name")}), name)
    tables.compact_table(spark, name)
    fill(lines.filter(F.col("seq") % 2 == 1))
    location = scratch_dir(spark, "table")
    mut.put(mut.resolve_latest(spark.table(name))).write.parquet(location)
    tables.drop_table(spark, name)
    return plain(tables.read_log_files(spark, location))


@query
def stream_raw_append(spark, sf_dir):
    path = scratch_dir(spark, "stream")
    records = inputs.load_stream(spark, sf_dir, "events").select(
        F.col("props").alias("value"), keys.epoch_millis(F.col("ts")).alias("millis"),
        F.col("event_id").alias("tiebreak"),
    )
    offsets = scratch_dir(spark, "offsets")
    sinks.raw_append_stream(records, path, offsets, rebalance=True, interval=None).awaitTermination()
    return plain(sinks.read_batches(spark, path))


@query
def stream_scan(spark, sf_dir):
    table, path = scratch_dir(spark, "table"), scratch_dir(spark, "stream")
    tables.bulk_load(mut.put(inputs.customer_cells(spark, sf_dir, salted=True)), table)
    sinks.scan_stream(
        spark, table, LOG_SCHEMA, path, scratch_dir(spark, "offsets"), "_", "4", "c", ["acct", "info"]
    ).awaitTermination()
    return sinks.read_batches(spark, path, sinks.JOINED_SCHEMA)


@query
def stream_scan_ranges(spark, sf_dir):
    """The same rows range by range: each micro-batch is two whole ranges of an aligned table."""
    table, listed, path = (scratch_dir(spark, label) for label in ("aligned", "ranges", "stream"))
    starts = tables.store_boundaries(spark, list("123456789abcdef"), scratch_dir(spark, "boundaries"))
    tables.bulk_load_aligned(mut.put(inputs.customer_cells(spark, sf_dir, salted=True)), table, starts,
                             most_rows=ROWS_PER_FILE)
    range_stream.list_ranges(spark, starts, listed, "4", "c")
    range_stream.scan_ranges_stream(spark, table, listed, path, scratch_dir(spark, "offsets"), "_", ["acct", "info"],
                                    ranges_per_batch=2).awaitTermination()
    return sinks.read_batches(spark, path, sinks.JOINED_SCHEMA)


@query
def stream_ledger(spark, sf_dir):
    """Every entry once, though a second run, with a checkpoint of its own, is sent the first one's files again."""
    feed, path = scratch_dir(spark, "feed"), scratch_dir(spark, "ledger")
    log = inputs.event_log(inputs.load(spark, sf_dir, "events"))
    for rest in (0, 1):
        log.filter(F.col("seq") % 2 == rest).write.mode("append").parquet(feed)
        files = spark.readStream.schema(LOG_SCHEMA).parquet(feed)
        placed = files.select("*", F.col("_metadata.file_path").alias("part"), F.lit(0).cast("bigint").alias("position"))
        ledger.ledger_stream(placed, path, scratch_dir(spark, "offsets"), "events", interval=None).awaitTermination()
    return ledger.read_ledger(spark, path).select("row_key", "family", "qualifier", "seq", "op", "value")


# ---- secondary index -------------------------------------------------------------------------------------


@query
def covering_index_lookup(spark, sf_dir):
    path = scratch_dir(spark, "index")
    records = inputs.event_records(inputs.load(spark, sf_dir, "events"))
    build_index(records, path, ["keyWord"], ["url"], row_key="ranking")
    return lookup_covered(spark.read.parquet(path), F.col("keyWord") == "purchase", ["ranking", "url"])


@query
def index_join_back(spark, sf_dir):
    path = scratch_dir(spark, "index")
    log = _customer_log(spark, sf_dir)
    build_index(cell_ops.read_wide(log, {"info:segment": "string"}), path, ["segment"], [])
    return plain(lookup_rows(spark.read.parquet(path), F.col("segment").isin("BUILDING", "MACHINERY"), log))


@query
def index_maintained(spark, sf_dir):
    """An index over segments that covers names follows updates of both and deletes, batch by batch."""
    customers = inputs.load(spark, sf_dir, "customer")
    key, indexed, covered = inputs.padded("c_custkey"), ["info:segment"], ["info:name"]
    rich = customers.filter(F.col("c_acctbal") >= 9000)
    renamed = customers.filter(F.col("c_nationkey") == 5)
    steps = [
        mut.put(inputs.customer_cells(spark, sf_dir)),
        mut.put(cell_ops.wide_to_cells(rich, key, {"info:segment": F.lit("VIP")}, ts=F.lit(1))),
        mut.delete_rows(inputs.customer_keys(spark, sf_dir).withColumn("ts", F.lit(2))),
        mut.put(cell_ops.wide_to_cells(renamed, key, {"info:name": F.concat("c_name", F.lit("*"))}, ts=F.lit(3))),
    ]
    table, index = scratch_dir(spark, "indexed"), scratch_dir(spark, "index-log")
    for number, change in enumerate(steps):
        before = tables.read_log_files(spark, table) if number else change.limit(0)
        index_changes(before, change, indexed, covered, ts=number).write.mode("append").parquet(index)
        change.write.mode("append").parquet(table)
    return read_index(tables.read_log_files(spark, index), indexed, covered)
