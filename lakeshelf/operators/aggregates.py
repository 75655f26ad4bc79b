"""Grouped reports: salted sums, frequencies, lists in bounded parts, profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshelf.operators.quantiles import discrete_quantiles
from lakeshelf.operators.windows import GROUP_ROWS, add_windows


def salted_mean(df: DataFrame, keys: Sequence[str], value: str, spread: Column, salts: int = 32) -> DataFrame:
    """Rows, sum and mean per key in two stages.

    ``spread`` is hashed into the salt, so a re-run of a task gives each row the
    same one.  Sum and count travel together; a mean of means would be wrong.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
    partial = salted.groupBy(*keys, "_salt").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum(value).alias("_sum"),
        F.count(value).alias("_n"),
    )
    return partial.groupBy(*keys).agg(
        F.sum("_rows").alias("total"),
        F.sum("_sum").alias("soma"),
        F.try_divide(F.sum("_sum").cast("double"), F.sum("_n").cast("double")).alias("media"),
    )


def frequency(df: DataFrame, *columns: str, name: str = "count") -> DataFrame:
    """Rows per value, most frequent first."""
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name))
    return counts.orderBy(F.col(name).desc(), *columns)


def total_of(counts: DataFrame, name: str = "count") -> DataFrame:
    """The row total from an existing frequency table, without another scan."""
    return counts.agg(F.sum(name).alias("total"))


def lists_in_parts(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    tie: Sequence[str],
    part_items: int = 10_000,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Values of each key as sorted lists of at most ``part_items``.

    (keys, part, items, values): a key with more items gets several parts, all of
    them kept, so no list outgrows a task.  NULL values are left out.  ``tie``
    tells equal values apart, so that a value with very many rows is split too.
    """
    numbered = add_windows(
        df.where(F.col(value).isNotNull()), keys, [value], tie, row_number="_rn", group_rows=group_rows
    ).withColumn("part", F.floor((F.col("_rn") - 1) / F.lit(part_items)).cast("long"))
    pairs = F.sort_array(F.collect_list(F.struct("_rn", F.col(value).alias("v"))))
    return numbered.groupBy(*keys, "part").agg(
        F.count(F.lit(1)).alias("items"), F.transform(pairs, lambda p: p["v"]).alias("values")
    )


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, stddev, min, exact quartiles and max per numeric column.

    Three passes over the columns: one for the moments, two in which the quartiles are selected.
    """
    entries = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("double").alias("value")) for c in columns]
    )
    long = df.select(F.inline(entries))
    value = F.col("value")
    moments = long.groupBy("column_name").agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("stddev"),
        F.min(value).alias("min"), F.max(value).alias("max"),
    )
    quartiles = discrete_quantiles(long, ["column_name"], "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    both = moments.join(quartiles, "column_name", "left")
    return both.select("column_name", "n", "mean", "stddev", "min", "p25", "p50", "p75", "max")
