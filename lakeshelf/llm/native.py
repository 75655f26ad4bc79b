"""Column expressions the native operators share: bindings, running sums, located matches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK = 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def upto(last: Column, make: Callable[[Column], Column], step: int = 1) -> Column:
    """``make(i)`` for i = 0, step, ... up to ``last``; an empty array if ``last`` < 0."""
    return F.transform(F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0)), F.lit(step)), lambda i: i <= last), make)


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def sums_before(values: Column) -> Column:
    """For each element of a bigint array the sum of those before it.

    Sums of blocks first, so a long array costs far less than its length squared.
    """

    def with_blocks(v: Column, blocks: Column) -> Column:
        starts = upto(F.size(blocks) - 1, lambda b: total(F.slice(blocks, F.lit(1), b)))

        def one(s: Column, i: Column) -> Column:
            block = F.floor(i / _BLOCK).cast("int")
            return F.get(s, block) + total(F.slice(v, block * _BLOCK + 1, i - block * _BLOCK))

        return let(starts, lambda s: upto(F.size(v) - 1, lambda i: one(s, i)))

    def with_values(v: Column) -> Column:
        count = F.floor((F.size(v) - 1) / _BLOCK).cast("int")
        return let(upto(count, lambda b: total(F.slice(v, b * _BLOCK + 1, F.lit(_BLOCK)))), lambda blocks: with_blocks(v, blocks))

    return let(values, with_values)


def located(text: Column, regex: str, group: int = 0) -> Column:
    """All leftmost matches: array of (start, end, value), code points, end exclusive, value of ``group``.

    Spark gives the texts of all matches but not where they are.  The pieces that
    ``split`` leaves between them do: lengths of pieces and matches add up.
    """
    gaps = F.transform(F.split(text, regex, -1), lambda x: F.length(x).cast("long"))
    sizes = F.transform(F.regexp_extract_all(text, F.lit(regex), F.lit(0)), lambda x: F.length(x).cast("long"))
    parts = F.struct(gaps.alias("g"), sizes.alias("m"), F.regexp_extract_all(text, F.lit(regex), F.lit(group)).alias("v"))

    def place(p: Column, before: Column, i: Column) -> Column:
        start = F.get(before, i) + F.get(p["g"], i)
        return F.struct(start.alias("start"), (start + F.get(p["m"], i)).alias("end"), F.get(p["v"], i).alias("value"))

    def rows(p: Column) -> Column:
        steps = upto(F.size(p["m"]) - 1, lambda i: F.get(p["g"], i) + F.get(p["m"], i))
        return let(sums_before(steps), lambda before: upto(F.size(p["m"]) - 1, lambda i: place(p, before, i)))

    return let(parts, rows)
