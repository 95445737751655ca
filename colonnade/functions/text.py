"""Delimited lines, words and rendered cells."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_fields(line: Column, separator: str) -> Column:
    """Fields of a line. Empty fields at the end do not count, empty fields in between do."""
    mark = re.escape(separator)
    return F.split(F.regexp_replace(line, rf"({mark})+\z", ""), mark)


def parse_lines(lines: DataFrame, fields: list[str], separator: str = ",", strict: bool = False,
                line: str = "value") -> DataFrame:
    """Add one column per field and ``reject``: null for a good line, otherwise the reason.

    ``strict`` wants exactly the named fields; otherwise further fields are ignored. A bad line never
    fails the job, and an empty first field is bad because it cannot be a row key.
    """
    parts = split_fields(F.col(line), separator)
    count = F.size(parts)
    reject = (
        F.when(F.col(line).isNull(), "no line")
        .when(count < len(fields), "too few fields")
        .when(F.lit(strict) & (count > len(fields)), "too many fields")
        .when(F.get(parts, F.lit(0)) == "", "empty key")
    )
    named = [F.get(parts, F.lit(i)).alias(name) for i, name in enumerate(fields)]
    return lines.select("*", *named, reject.alias("reject"))


def parsed_lines(lines: DataFrame, fields: list[str], separator: str = ",", strict: bool = False) -> DataFrame:
    """``line``, ``record`` (a struct of the fields) and ``reject``; fields may have any name."""
    numbered = [f"field{i}" for i in range(len(fields))]
    parsed = parse_lines(lines.select("value"), numbered, separator, strict)
    record = F.struct(*[F.col(n).alias(name) for n, name in zip(numbered, fields, strict=True)])
    return parsed.select(F.col("value").alias("line"), record.alias("record"), "reject")


def words(texts: DataFrame, text: str = "value") -> DataFrame:
    """One row ``word`` per word: split on a single space only, empty words dropped."""
    return texts.select(F.explode(F.split(text, " ")).alias("word")).filter(F.col("word") != "")


def render_cell(with_family: bool = True) -> Column:
    """``family::qualifier::value`` as a scan prints it, ``qualifier::value`` as a get does."""
    parts = ["family", "qualifier", "value"] if with_family else ["qualifier", "value"]
    return F.concat_ws("::", *parts)
