"""Row-key design: spreading, time order, composites and content keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colonnade.functions.codecs import encode_bigint, encode_byte, encode_int

SALT_WIDTH = 3
# Copies of one line written out from one shuffled row.
COPIES_PER_ROW = 100_000


def reverse_key(key: Column) -> Column:
    """Spread sequential ids: their fastest-changing digit comes first."""
    return F.reverse(key)


def salt_key(key: Column, width: int = SALT_WIDTH) -> Column:
    """Prefix the key with the first hex digits of its MD5, so the same key always gets the same salt."""
    return F.concat(F.substring(F.md5(key), 1, width), key)


def unsalt_key(key: Column, width: int = SALT_WIDTH) -> Column:
    return F.substr(key, F.lit(width + 1))


def random_key() -> Column:
    """A random UUID per row. A second run draws new keys, so only overwriting loads may be repeated.

    Draw them right above a file scan: the seed belongs to the plan, so a retried task that reads the same
    rows in the same order repeats its keys. Behind a shuffle the order may differ.
    """
    return F.expr("uuid()")


def epoch_micros(timestamp_ntz: Column) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, whatever the session time zone is."""
    days = F.unix_date(timestamp_ntz.cast("date")).cast("bigint")
    minutes = (F.hour(timestamp_ntz) * 60 + F.minute(timestamp_ntz)).cast("bigint")
    seconds = F.extract(F.lit("SECOND"), timestamp_ntz).cast("decimal(8,6)")
    micros = (seconds * F.lit(1_000_000).cast("decimal(7,0)")).cast("bigint")
    return days * 86_400_000_000 + minutes * 60_000_000 + micros


def epoch_millis(timestamp_ntz: Column) -> Column:
    micros = epoch_micros(timestamp_ntz)
    return ((micros - F.pmod(micros, F.lit(1000))) / 1000).cast("bigint")


def time_key(millis: Column, tiebreak: Column) -> Column:
    """16 bytes: event time, then a number that tells records of one millisecond apart."""
    return F.concat(encode_bigint(millis), encode_bigint(tiebreak))


def _sortable(number: Column) -> Column:
    """20 digits that sort like the number: a sign digit, then the distance from zero or from the least number."""
    whole = number.cast("bigint")
    distance = F.when(whole < 0, whole.bitwiseXOR(F.lit(-(1 << 63)))).otherwise(whole)
    padded = F.lpad(distance.cast("string"), 19, "0")
    return F.concat(F.when(whole < 0, "0").otherwise("1"), padded)


def time_key_text(millis: Column, *tiebreaks: Column) -> Column:
    """The same key as sortable text, for tables with string row keys; several numbers may break ties in turn."""
    return F.concat_ws("-", _sortable(millis), *[_sortable(number) for number in tiebreaks])


def composite_key(salt: Column, first: Column, seconds: Column, second: Column, wide: bool = False) -> Column:
    """13 bytes: salt (1), first attribute (4), time in seconds (4), second attribute (4).

    ``wide`` gives the attributes 8 bytes each. A part that does not fit fails the job.
    """
    attribute = encode_bigint if wide else encode_int
    return F.concat(encode_byte(salt), attribute(first), encode_int(seconds), attribute(second))


def content_digest(fields: list[str]) -> Column:
    """SHA-256 over all fields; each goes in with its length, so nulls and separators can't be mistaken."""
    parts = []
    for name in fields:
        text = F.col(name).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat_ws(",", *parts), 256)


def copy_blocks(records: DataFrame, fields: list[str], copies_per_row: int = COPIES_PER_ROW) -> DataFrame:
    """``digest, first, last`` and the fields: every distinct record once for each run of so many copies.

    Equal records are interchangeable, so they are counted (partial counts first) instead of numbered one by one,
    which would gather every copy of one line in one task.
    """
    counted = records.groupBy(*fields).agg(F.count(F.lit(1)).alias("copies"))
    one = F.lit(1).cast("bigint")
    firsts = F.explode(F.sequence(one, F.col("copies"), F.lit(copies_per_row).cast("bigint")))
    blocks = counted.withColumn("first", firsts)
    last = F.least(F.col("first") + (copies_per_row - 1), F.col("copies"))
    return blocks.select(content_digest(fields).alias("digest"), "first", last.alias("last"), *fields)


def numbered_copies(blocks: DataFrame, fields: list[str], key: str = "row_key") -> DataFrame:
    """A row for each copy, keyed by digest and copy number. No shuffle: blocks are written out where they are."""
    copy = F.explode(F.sequence("first", "last")).alias("copy")
    number = F.lpad(F.col("copy").cast("string"), 19, "0")
    return blocks.select("digest", *fields, copy).select(F.concat_ws("-", "digest", number).alias(key), *fields)


def with_content_key(records: DataFrame, fields: list[str], key: str = "row_key",
                     copies_per_row: int = COPIES_PER_ROW) -> DataFrame:
    """Key each record by the digest of its fields plus a copy number, so a repeated load writes the same keys."""
    blocks = copy_blocks(records, fields, copies_per_row).repartition("digest", "first")
    return numbered_copies(blocks, fields, key)
