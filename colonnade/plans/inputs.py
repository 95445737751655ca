"""Cell tables, logs and streams derived from the given tables, always from all of their rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.functions.codecs import encode_bigint, encode_int, encode_text
from colonnade.functions.keys import epoch_micros, salt_key
from colonnade.model import CELL_SCHEMA, DELETE_COLUMN, DELETE_FAMILY, DELETE_NEWEST, DELETE_ROW, LOG_COLUMNS, PUT
from colonnade.operators.cells import wide_to_cells
from colonnade.session import scratch_dir
from colonnade.sources.tables import bulk_load


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a file stream. The file source wants a folder or a pattern, not one file's path."""
    return spark.readStream.schema(load(spark, sf_dir, name).schema).parquet(f"{sf_dir}/{name}[.]parquet")


def padded(number: str) -> Column:
    """As many digits as the longest number has, so that none is cut."""
    return F.lpad(F.col(number).cast("string"), 19, "0")


def tier() -> Column:
    """Null for many customers, so that rows without the column occur."""
    return F.when(F.col("c_acctbal") >= 7000, "gold").when(F.col("c_acctbal") >= 3000, "silver")


def customer_cells(spark: SparkSession, sf_dir: str, salted: bool = False) -> DataFrame:
    """Three families, four columns, one of them sparse. Keys are padded ids, or salted ids."""
    key = salt_key(F.col("c_custkey").cast("string")) if salted else padded("c_custkey")
    columns = {
        "info:name": F.col("c_name"),
        "info:segment": F.col("c_mktsegment"),
        "geo:nation": F.col("c_nationkey").cast("string"),
        "acct:tier": tier(),
    }
    return wide_to_cells(load(spark, sf_dir, "customer"), key, columns)


STORED: dict[tuple[str, str, bool], str] = {}


def stored_customers(spark: SparkSession, sf_dir: str, salted: bool = False) -> DataFrame:
    """The customer cells as a table sorted by key: written by the first scan of a session, read by the others."""
    key = (spark.sparkContext.applicationId, sf_dir, salted)
    if key not in STORED:
        path = scratch_dir(spark, "customers")
        bulk_load(customer_cells(spark, sf_dir, salted), path)
        STORED[key] = path
    return spark.read.schema(CELL_SCHEMA).parquet(STORED[key])


def customer_byte_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells with encoded values: a string and two integer widths, negative numbers included."""
    number = F.col("c_custkey") - 750
    columns = {
        "info:name": encode_text(F.col("c_name")),
        "info:number": encode_int(number),
        "info:large": encode_bigint(number * 3_000_000_019),
    }
    return wide_to_cells(load(spark, sf_dir, "customer"), padded("c_custkey"), columns)


def customer_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delete requests for one market segment, newer than every customer cell."""
    chosen = load(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "MACHINERY")
    return chosen.select(padded("c_custkey").alias("row_key"), F.lit(1).alias("ts"), F.lit(0).alias("seq"))


def event_log(events: DataFrame, newest_only: bool = False) -> DataFrame:
    """Mutations of one row per user: clicks, views and purchases put, signups and errors delete.

    With ``newest_only`` a signup takes back one version of its column, not all.
    """
    kind = F.col("event_type")
    is_error = kind == "error"
    whole_row = is_error & (F.col("value") >= 40)
    op = (
        F.when(kind == "signup", DELETE_NEWEST if newest_only else DELETE_COLUMN)
        .when(whole_row, DELETE_ROW)
        .when(is_error, DELETE_FAMILY)
        .otherwise(PUT)
    )
    is_put = kind.isin("click", "view", "purchase")
    entries = events.select(
        padded("user_id").alias("row_key"),
        F.when(kind == "purchase", "buy").when(~whole_row, "ev").alias("family"),
        F.when(kind == "purchase", "last").when(kind == "signup", "view").when(is_put, kind).alias("qualifier"),
        epoch_micros(F.col("ts")).alias("ts"),
        F.col("event_id").alias("seq"),
        F.when(is_put, F.col("props")).alias("value"),
        op.alias("op"),
    )
    return entries.select(*LOG_COLUMNS)


def document_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = load(spark, sf_dir, "documents")
    return wide_to_cells(documents, F.col("doc_id").cast("string"), {"content:info": F.col("text")})


def lineitem_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells with many versions: one row per order, one column per line number, versioned by ship date."""
    return load(spark, sf_dir, "lineitem").select(
        padded("l_orderkey").alias("row_key"),
        F.lit("line").alias("family"),
        F.col("l_linenumber").cast("string").alias("qualifier"),
        epoch_micros(F.col("l_shipdate")).alias("ts"),
        F.col("l_partkey").alias("seq"),
        F.concat("l_returnflag", "l_linestatus").alias("value"),
    )


def event_records(events: DataFrame) -> DataFrame:
    """Events as a search log of five text fields."""
    return events.select(
        epoch_micros(F.col("ts")).cast("string").alias("time"),
        F.col("user_id").cast("string").alias("userId"),
        F.col("event_type").alias("keyWord"),
        F.col("event_id").cast("string").alias("ranking"),
        F.col("props").alias("url"),
    )


def event_lines(events: DataFrame) -> DataFrame:
    """Comma lines ``key,name,age`` with the faults real feeds have: short, long and empty-ended lines."""
    kind = F.col("event_type")
    fields = [padded("user_id"), kind]
    number = F.col("event_id").cast("string")
    line = (
        F.when(kind == "error", F.concat_ws(",", *fields))
        .when(kind == "signup", F.concat_ws(",", *fields, number, F.lit("more")))
        .when(kind == "view", F.concat_ws(",", *fields, F.lit("")))
        .otherwise(F.concat_ws(",", *fields, number))
    )
    return events.select(line.alias("value"), epoch_micros(F.col("ts")).alias("ts"), F.col("event_id").alias("seq"))
