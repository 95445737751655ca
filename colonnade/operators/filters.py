"""Row and cell filters, and their AND/OR lists.

A row filter passes or drops a whole row, a cell filter single cells. In a list every member is one flag per
cell; row flags come from the complete row, before any cell filter or projection. Rows left without cells
vanish by themselves, as cell form has no empty rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colonnade.functions.codecs import decode_value
from colonnade.model import is_column
from colonnade.operators.rows import join_rows

# The comparison names of the filter interface; the last one excludes everything.
COMPARISONS: dict[str, Callable[[Column, Column], Column]] = {
    "LESS": lambda a, b: a < b,
    "LESS_OR_EQUAL": lambda a, b: a <= b,
    "EQUAL": lambda a, b: a == b,
    "NOT_EQUAL": lambda a, b: a != b,
    "GREATER_OR_EQUAL": lambda a, b: a >= b,
    "GREATER": lambda a, b: a > b,
    "NO_OP": lambda a, b: F.lit(False),
}

_LITERAL_PREFIX = re.compile(r"\^([A-Za-z0-9_:\-]+)")


def compare(column: Column, op: str, operand, type_name: str | None = None, binary: bool = False) -> Column:
    """``column <op> operand``: bytewise on the stored value, or decoded first when a type is given."""
    if type_name is None:
        operand = operand.encode() if binary and isinstance(operand, str) else operand
        return COMPARISONS[op](column, F.lit(operand))
    return COMPARISONS[op](decode_value(column, type_name, binary), F.lit(operand))


@dataclass(frozen=True)
class KeyRegex:
    """The row key contains a match. ``op`` may be EQUAL or NOT_EQUAL."""

    pattern: str
    op: str = "EQUAL"

    def predicate(self, flags: dict) -> Column:
        key = F.col("row_key")
        found = key.rlike(self.pattern)
        literal = _LITERAL_PREFIX.match(self.pattern)
        if literal and literal.end() == len(self.pattern):
            # A pure literal prefix reaches the Parquet reader as a range check; a regex would not.
            found = key.startswith(literal.group(1))
        if self.op not in ("EQUAL", "NOT_EQUAL"):
            raise ValueError("a pattern can only be compared with EQUAL or NOT_EQUAL")
        return found if self.op == "EQUAL" else ~found


@dataclass(frozen=True)
class KeyPrefix:
    prefix: str

    def predicate(self, flags: dict) -> Column:
        return F.col("row_key").startswith(self.prefix)


@dataclass(frozen=True)
class KeyCompare:
    op: str
    operand: str

    def predicate(self, flags: dict) -> Column:
        return compare(F.col("row_key"), self.op, self.operand)


@dataclass(frozen=True)
class ColumnPrefix:
    """Cell filter: the qualifier starts with the prefix, in any family."""

    prefix: str

    def predicate(self, flags: dict) -> Column:
        return F.col("qualifier").startswith(self.prefix)


@dataclass(frozen=True)
class ColumnValue:
    """Row filter: ``column`` compares true. Rows without the column pass unless ``filter_if_missing``."""

    column: str
    op: str
    operand: object
    type_name: str | None = None
    filter_if_missing: bool = False

    def predicate(self, flags: dict) -> Column:
        return flags[self] if self.filter_if_missing else F.coalesce(flags[self], F.lit(True))


@dataclass(frozen=True)
class AllOf:
    members: tuple

    def __init__(self, *members):
        object.__setattr__(self, "members", members)

    def predicate(self, flags: dict) -> Column:
        return reduce(and_, [m.predicate(flags) for m in self.members])


@dataclass(frozen=True)
class AnyOf:
    members: tuple

    def __init__(self, *members):
        object.__setattr__(self, "members", members)

    def predicate(self, flags: dict) -> Column:
        return reduce(or_, [m.predicate(flags) for m in self.members])


def value_filters(where) -> list[ColumnValue]:
    """The distinct column-value members anywhere in a filter."""
    if isinstance(where, ColumnValue):
        return [where]
    found = [leaf for member in getattr(where, "members", ()) for leaf in value_filters(member)]
    return list(dict.fromkeys(found))


def _row_flags(cells: DataFrame, leaves: list[ColumnValue]) -> DataFrame:
    """One line per row key for which some leaf differs from what it says about an absent column."""
    binary = dict(cells.dtypes)["value"] == "binary"
    tested = reduce(or_, [is_column(name) for name in dict.fromkeys(leaf.column for leaf in leaves)])
    flags = []
    for i, leaf in enumerate(leaves):
        passed = F.coalesce(compare(F.col("value"), leaf.op, leaf.operand, leaf.type_name, binary), F.lit(False))
        flags.append(F.max(F.when(is_column(leaf.column), passed)).alias(f"flag{i}"))
    telling = [F.col(f"flag{i}") == F.lit(leaf.filter_if_missing) for i, leaf in enumerate(leaves)]
    return cells.filter(tested).groupBy("row_key").agg(*flags).filter(reduce(or_, telling))


def apply_filter(cells: DataFrame, where) -> DataFrame:
    """Cells that pass ``where``; ``cells`` must hold one version per cell and complete rows.

    Key and qualifier filters are plain predicates. Column values are read in a scan of the tested columns
    alone, reduced to one line of booleans per row key and joined back (``join_rows``), so a row is never
    gathered in one task and the other columns are shuffled once.
    """
    leaves = value_filters(where)
    if not leaves:
        return cells.filter(where.predicate({}))
    flags = {leaf: F.col(f"flag{i}") for i, leaf in enumerate(leaves)}
    joined = join_rows(cells, _row_flags(cells, leaves), "left")
    return joined.filter(where.predicate(flags)).select(*cells.columns)
