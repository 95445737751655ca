"""Byte encodings of stored values, as built-in expressions.

Integers are big-endian two's complement, so equal widths compare bytewise (negatives after positives).
A plain cast from integer to binary is refused under ANSI mode, hence the route through hex digits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _in_bytes(number: Column, count: int, least: int, most: int, strict: bool) -> Column:
    """The number in ``count`` bytes. One that does not fit fails the job, or reads as null if not ``strict``."""
    whole = number.cast("bigint")
    digits = F.lpad(F.hex(whole), 16, "0")
    cut = F.unhex(F.substring(digits, 17 - 2 * count, 2 * count))
    if count == 8:
        return cut
    fits = F.when(whole.isNull() | whole.between(least, most), cut)
    if not strict:
        return fits
    message = F.concat(whole.cast("string"), F.lit(f" does not fit in {count} byte(s)"))
    return fits.otherwise(F.raise_error(message).cast("binary"))


def encode_text(text: Column) -> Column:
    return text.cast("binary")


def decode_text(raw: Column) -> Column:
    """UTF-8 bytes to a string; malformed bytes become U+FFFD instead of failing the job."""
    return F.make_valid_utf8(raw.cast("string"))


def encode_byte(number: Column, strict: bool = True) -> Column:
    """0 to 255."""
    return _in_bytes(number, 1, 0, 255, strict)


def encode_int(number: Column, strict: bool = True) -> Column:
    return _in_bytes(number, 4, -(1 << 31), (1 << 31) - 1, strict)


def decode_int(raw: Column) -> Column:
    unsigned = F.conv(F.hex(raw), 16, 10).cast("bigint")
    signed = F.shiftright(F.shiftleft(unsigned, 32), 32).cast("int")
    return F.when(F.octet_length(raw) == 4, signed)


def encode_bigint(number: Column) -> Column:
    return _in_bytes(number, 8, -(1 << 63), (1 << 63) - 1, True)


def decode_bigint(raw: Column) -> Column:
    return F.when(F.octet_length(raw) == 8, F.conv(F.hex(raw), 16, -10).cast("bigint"))


def decode_value(value: Column, type_name: str, binary: bool = False) -> Column:
    """Read a stored value as ``string``, ``int`` or ``bigint``; a value that does not fit reads as null."""
    if type_name not in ("string", "int", "bigint"):
        raise ValueError(f"unknown column type {type_name!r}")
    if not binary:
        return value if type_name == "string" else value.try_cast(type_name)
    return {"string": decode_text, "int": decode_int, "bigint": decode_bigint}[type_name](value)


def encode_value(value: Column, type_name: str) -> Column:
    return {"string": encode_text, "int": encode_int, "bigint": encode_bigint}[type_name](value)
