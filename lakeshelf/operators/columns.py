"""Column-level helpers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bands(value: Column, steps: Sequence[tuple[float, str]], top: str, missing: str | None = None) -> Column:
    """Label of the first step whose upper bound lies above the value, else ``top``.

    Without ``missing`` a NULL value falls through every comparison into ``top``.
    """
    result = F.when(value.isNull(), missing) if missing is not None else None
    for bound, label in steps:
        below = value < bound
        result = F.when(below, label) if result is None else result.when(below, label)
    return F.lit(top) if result is None else result.otherwise(top)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by map; names the frame does not have are ignored."""
    return df.withColumnsRenamed(dict(names))


def min_max_scaled(df: DataFrame, column: str, name: str) -> DataFrame:
    """(x - min) / (max - min) over the whole column, 0 when all values are equal.

    The two bounds are one aggregate row, put into the plan as literals.
    """
    bounds = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    low, high = F.lit(bounds["lo"]), F.lit(bounds["hi"])
    scaled = (F.col(column) - low).cast("double") / F.nullif(high - low, F.lit(0)).cast("double")
    return df.withColumn(
        name, F.when(F.col(column).isNotNull(), F.coalesce(scaled, F.lit(0.0)))
    )
