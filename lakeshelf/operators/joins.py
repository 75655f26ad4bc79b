"""Join helpers: checked broadcast, null-safe join back to an aggregate, full join with hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of a frame; no job is run."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_checked(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint for a side estimated to fit.

    Without the hint the join is the same; AQE still broadcasts a side that turns out small.
    """
    return F.broadcast(df) if estimated_bytes(df) <= max_bytes else df


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where NULL equals NULL; each key appears once, from the left."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_right_{k}"]) for k in keys]
    )
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in keys])


def full_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join on equal keys: the keys once, the other columns of the left, those of the right.

    Spark splits no hot key of a full join, and rows with a NULL key, which match nothing, would all
    meet in one task.  So those rows go by without a shuffle, and the rest is a left join and the
    rows of the right that it leaves over; AQE splits a hot key in both.
    """
    others = {c for c in left.columns if c not in keys} & {c for c in right.columns if c not in keys}
    if others:
        raise ValueError(f"both sides have {sorted(others)}")
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    near, far = left.where(whole), right.where(whole)
    parts = [
        near.join(far, list(keys), "left"), far.join(near.select(*keys), list(keys), "left_anti"),
        left.where(~whole), right.where(~whole),
    ]
    made = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return made.select(*keys, *[c for c in (*left.columns, *right.columns) if c not in keys])
