"""Aggregate expressions shared by reports and gold tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pct_of_rows(condition: Column) -> Column:
    """Percentage of rows where the condition holds, two decimals; NULL counts as no."""
    return F.round(F.lit(100.0) * F.count_if(condition) / F.count(F.lit(1)), 2)


def mean_of(value: Column) -> Column:
    """Mean as exact decimal sum over count, so the result has no summing order."""
    return F.try_divide(F.sum(value).cast("double"), F.count(value).cast("double"))


def share(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``, two decimals."""
    return F.round(F.try_divide(part * F.lit(100.0), whole), 2)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows and NULLs per column, in long form, from one scan."""
    names = list(columns or df.columns)
    one_row = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(names)],
    )
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("nulls"))
            for i, c in enumerate(names)
        ]
    )
    long = one_row.select("_rows", F.explode(entries).alias("e"))
    return long.select(
        F.col("e.column_name").alias("column_name"),
        F.col("e.nulls").alias("nulls"),
        F.col("_rows").alias("rows"),
        F.coalesce(F.round(F.try_divide(F.lit(100.0) * F.col("e.nulls"), F.col("_rows")), 2), F.lit(0.0))
        .alias("pct"),
    )
