"""Distinct rows and one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "first") -> DataFrame:
    """The first (or last) row of each key by ``order``; full ties by the other columns.

    An aggregate and not a window: duplicates meet in the map-side combine, so a
    key with very many copies sends one row per task.
    """
    rest = [c for c in df.columns if c not in order and c not in keys]
    # One struct in rank order is both the rank and the row, so a column is shuffled once.
    rank = F.struct(*[F.col(c) for c in [*order, *rest]])
    chosen = F.min(rank) if keep == "first" else F.max(rank)
    found = df.groupBy(*keys).agg(chosen.alias("_row"))
    return found.select(*[F.col(c) if c in keys and c not in order else F.col(f"_row.{c}") for c in df.columns])
