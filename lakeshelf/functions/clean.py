"""Dirty text to typed columns, as ``Column -> Column`` functions.

All of them return NULL for text they cannot read; none raises under ANSI.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(text: Column, precision: int = 12, scale: int = 2) -> Column:
    """``1.621,00`` to decimal: dots group thousands, the comma is the point."""
    # translate drops the characters that have no counterpart: here the dots.
    return F.translate(F.trim(text), ",.", ".").try_cast(f"decimal({precision},{scale})")


def day(text: Column, pattern: str = "dd/MM/yyyy") -> Column:
    return F.try_to_date(F.trim(text), pattern)


def whole_number(text: Column) -> Column:
    """``87`` and ``87.0`` to int."""
    return text.try_cast("double").try_cast("int")


def sentinel_null(text: Column, sentinels: Sequence[str]) -> Column:
    return F.when(text.isin(list(sentinels)), F.lit(None)).otherwise(text)


def code_and_name(text: Column) -> tuple[Column, Column]:
    """``<digits>-<name>``: the int code, and the name with its own dashes kept."""
    code = F.get(F.split(text, "-", 2), F.lit(0)).try_cast("int")
    return code, F.regexp_replace(text, r"^\d+-", "")


def place(text: Column) -> tuple[Column, Column, Column]:
    """``<digits>-<letters>-<name>``: code text, upper-cased state, name."""
    parts = F.split(text, "-", 3)
    name = F.regexp_replace(text, r"^\d+-[A-Za-z]+-", "")
    return F.get(parts, F.lit(0)), F.upper(F.get(parts, F.lit(1))), name


def map_lookup(key: Column, pairs: Mapping[str, str]) -> Column:
    """Value of a literal map; an unknown key gives NULL."""
    literal = F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs.items())])
    return literal[key]


def map_struct_lookup(
    key: Column, pairs: Mapping[str, Sequence[str]], fields: Sequence[str]
) -> list[Column]:
    """One column per field of a literal map of structs."""
    entries = []
    for name, values in pairs.items():
        entries.append(F.lit(name))
        entries.append(F.struct(*[F.lit(v).alias(f) for f, v in zip(fields, values)]))
    found = F.create_map(*entries)[key]
    return [found[f] for f in fields]


def code_group(code: Column, groups: Mapping[str, Sequence], other: str) -> Column:
    """CASE over code lists."""
    result: Column | None = None
    for name, codes in groups.items():
        hit = code.isin(list(codes))
        result = F.when(hit, name) if result is None else result.when(hit, name)
    return F.lit(other) if result is None else result.otherwise(other)


def non_positive(value: Column) -> Column:
    return F.coalesce(value <= 0, F.lit(False))
