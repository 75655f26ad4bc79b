"""Ranks, neighbours and running totals per group, safe for a hot group.

A plain window puts a whole group in one task.  Here the groups with more rows
than one task should take are found first (rows per key, pre-aggregated).  Their
rows are written range-partitioned on key and order, so that one group spans many
pieces; each piece is windowed alone and then shifted by what the earlier pieces
hold.  All other groups use the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, FractionalType

from lakeshelf.operators.joins import join_null_safe
from lakeshelf.session import new_path, store

GROUP_ROWS = 20_000_000
PIECE = "_piece"
SIZE = "_n"


def sort_columns(names: Sequence[str]) -> list[Column]:
    """``"-x"`` sorts x descending, ``"x"`` ascending."""
    return [F.col(n[1:]).desc() if n.startswith("-") else F.col(n).asc() for n in names]


def _bare(names: Sequence[str]) -> list[str]:
    return [n.lstrip("-") for n in names]


def hot_keys(df: DataFrame, keys: Sequence[str], group_rows: int = GROUP_ROWS) -> DataFrame | None:
    """Keys with more than ``group_rows`` rows and their row counts, or None.

    At most total rows / ``group_rows`` keys can be hot, so the collected list is
    small by construction.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(SIZE)).where(F.col(SIZE) > group_rows)
    found = counts.collect()
    return df.sparkSession.createDataFrame(found, counts.schema) if found else None


def add_windows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    tie: Sequence[str] = (),
    row_number: str | None = None,
    rank: str | None = None,
    dense_rank: str | None = None,
    lag: dict[str, str] | None = None,
    lead: dict[str, str] | None = None,
    running_sum: dict[str, str] | None = None,
    running_count: dict[str, str] | None = None,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Add window columns per ``keys``, ordered by ``order`` and then ``tie``.

    ``row_number``, ``rank`` and ``dense_rank`` name the new column; the dicts map
    new column to source column.  Equal ranks are decided on ``order`` alone;
    ``order`` and ``tie`` together should be unique within a group.  Neither types nor values
    depend on which way a group goes; so running sums are of integers and decimals only (a sum of
    doubles depends on where it starts).
    """
    inexact = [c for c in (running_sum or {}).values() if isinstance(df.schema[c].dataType, FractionalType) and not isinstance(df.schema[c].dataType, DecimalType)]
    if inexact:
        raise TypeError(f"running sum of {inexact}: cast to a decimal first")
    wanted = {
        "row_number": row_number,
        "rank": rank,
        "dense_rank": dense_rank,
        "lag": lag or {},
        "lead": lead or {},
        "running_sum": running_sum or {},
        "running_count": running_count or {},
    }
    if _has_work(df):
        df = store(df.sparkSession, df, "window-input")  # else it would be worked out for the count and again
    hot = hot_keys(df, keys, group_rows)
    if hot is None:
        return _plain(df, keys, order, tie, wanted)
    names = hot.select(*keys)
    rest = join_null_safe(df, F.broadcast(names), keys, "left_anti")
    heavy = join_null_safe(df, F.broadcast(names), keys, "left_semi")
    total = hot.agg(F.sum(SIZE).alias(SIZE)).first()[SIZE]
    pieces = max(2, -(-2 * total // group_rows))
    return _plain(rest, keys, order, tie, wanted).unionByName(
        _pieced(heavy, keys, order, tie, wanted, pieces)
    )


# Plan nodes that cost no more the second time than reading does.
LIGHT_NODES = {
    "Project", "Filter", "LogicalRelation", "Relation", "LocalRelation", "LogicalRDD", "Range", "Union", "InMemoryRelation",
    "DataSourceV2ScanRelation", "OneRowRelation",
}


def _has_work(df: DataFrame) -> bool:
    """Whether more than a scan, a filter and a projection stands behind the frame; Python functions are nodes of their own."""
    todo = [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().split()[0] not in LIGHT_NODES:
            return True
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return False


def _plain(df: DataFrame, keys, order, tie, wanted) -> DataFrame:
    by_order = Window.partitionBy(*keys).orderBy(*sort_columns(order))
    full = Window.partitionBy(*keys).orderBy(*sort_columns([*order, *tie]))
    to_here = full.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    new = {}
    if wanted["row_number"]:
        new[wanted["row_number"]] = F.row_number().over(full).cast("long")
    if wanted["rank"]:
        new[wanted["rank"]] = F.rank().over(by_order).cast("long")
    if wanted["dense_rank"]:
        new[wanted["dense_rank"]] = F.dense_rank().over(by_order).cast("long")
    new |= {n: F.lag(c).over(full) for n, c in wanted["lag"].items()}
    new |= {n: F.lead(c).over(full) for n, c in wanted["lead"].items()}
    new |= {n: F.sum(c).over(to_here) for n, c in wanted["running_sum"].items()}
    new |= {n: F.count(c).over(to_here) for n, c in wanted["running_count"].items()}
    return df.withColumns(new)


def _pieced(df: DataFrame, keys, order, tie, wanted, pieces: int) -> DataFrame:
    spark = df.sparkSession
    path = new_path(spark, "window-pieces")
    # The piece number is written with the row: it must not change between reads.
    (
        df.repartitionByRange(pieces, *[F.col(k) for k in keys], *sort_columns([*order, *tie]))
        .withColumn(PIECE, F.spark_partition_id())
        .write.parquet(path)
    )
    rows = spark.read.parquet(path)
    group = [*keys, PIECE]
    ranked = wanted["rank"] or wanted["dense_rank"]
    number = wanted["row_number"] or "_row_number"
    sums, counts = wanted["running_sum"], wanted["running_count"]
    lags, leads = wanted["lag"], wanted["lead"]
    local = _plain(
        rows, group, order, tie,
        {**wanted, "row_number": number, "rank": None, "dense_rank": None, "running_sum": {}},
    )
    ends = Window.partitionBy(*group)
    backwards = ends.orderBy(*sort_columns([*order, *tie]))
    local = local.withColumns(
        {"_first": F.col(number) == 1, "_last": F.lead(F.lit(1)).over(backwards).isNull()}
    )
    # One row per hot group and piece: at most pieces + number of hot groups rows.
    summary = local.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_size"),
        *[F.sum(c).alias(f"_sum_{n}") for n, c in sums.items()],
        *[F.count(c).alias(f"_count_{n}") for n, c in counts.items()],
        *[F.max(F.when(F.col("_last"), F.col(c))).alias(f"_tail_{n}") for n, c in lags.items()],
        *[F.max(F.when(F.col("_first"), F.col(c))).alias(f"_head_{n}") for n, c in leads.items()],
    )
    in_order = Window.partitionBy(*keys).orderBy(PIECE)
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    shifts = summary.select(
        *group,
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_rows_before"),
        *[F.sum(f"_sum_{n}").over(before).alias(f"_sum_{n}") for n in sums],
        *[F.sum(f"_count_{n}").over(before).alias(f"_count_{n}") for n in counts],
        *[F.lag(f"_tail_{n}").over(in_order).alias(f"_tail_{n}") for n in lags],
        *[F.lead(f"_head_{n}").over(in_order).alias(f"_head_{n}") for n in leads],
    )
    joined = join_null_safe(local, F.broadcast(shifts), group)
    new = {number: F.col(number) + F.col("_rows_before")}
    new |= {n: F.col(n) + F.coalesce(F.col(f"_count_{n}"), F.lit(0)) for n in counts}
    new |= {n: F.when(F.col("_first"), F.col(f"_tail_{n}")).otherwise(F.col(n)) for n in lags}
    new |= {n: F.when(F.col("_last"), F.col(f"_head_{n}")).otherwise(F.col(n)) for n in leads}
    result = joined.withColumns(new)
    if sums:
        only_sums = {k: None if k in ("row_number", "rank", "dense_rank") else {} for k in wanted} | {"running_sum": sums}
        types = {n: _plain(df, keys, order, tie, only_sums).schema[n].dataType for n in sums}
        result = _with_running_sums(result, shifts, group, sort_columns([*order, *tie]), sums, types)
    if ranked:
        result = _with_ranks(result, keys, order, number, wanted, pieces)
    produced = [wanted["row_number"], wanted["rank"], wanted["dense_rank"]]
    kept = [*df.columns, *[p for p in produced if p], *lags, *leads, *sums, *counts]
    return result.select(*kept)


def _with_running_sums(df: DataFrame, shifts: DataFrame, group, by, sums, types) -> DataFrame:
    """Running sums of a piece that start from the sum of the pieces before it.

    That sum goes in as the piece's first row.  Adding it afterwards would make
    a wider decimal, and from 38 digits on a shorter fraction.
    """
    lead = "_lead"
    before = shifts.select(*group, *[F.col(f"_sum_{n}").cast(types[n]).alias(f"_value_{n}") for n in sums], F.lit(0).alias(lead))
    rows = df.withColumns({f"_value_{n}": F.col(c).cast(types[n]) for n, c in sums.items()} | {lead: F.lit(1)})
    window = Window.partitionBy(*group).orderBy(lead, *by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = rows.unionByName(before, allowMissingColumns=True).withColumns(
        {n: F.sum(f"_value_{n}").over(window).cast(types[n]) for n in sums}
    )
    return summed.where(F.col(lead) == 1)


def _with_ranks(df: DataFrame, keys, order, number: str, wanted, pieces: int) -> DataFrame:
    """Ranks from row numbers: the rank of a value is its first row number."""
    value = [*keys, *_bare(order)]
    values = df.groupBy(*value).agg(F.min(number).alias("_rank"))
    if wanted["dense_rank"]:
        numbered = {
            "row_number": "_dense", "rank": None, "dense_rank": None,
            "lag": {}, "lead": {}, "running_sum": {}, "running_count": {},
        }
        values = _pieced(values, keys, order, (), numbered, pieces)
    df = join_null_safe(df, values, value)
    if wanted["rank"]:
        df = df.withColumn(wanted["rank"], F.col("_rank"))
    if wanted["dense_rank"]:
        df = df.withColumn(wanted["dense_rank"], F.col("_dense"))
    return df


def with_group_total(df: DataFrame, keys: Sequence[str], totals: dict[str, Column]) -> DataFrame:
    """Group aggregates beside every row.

    Aggregated first and joined back: the aggregate is combined on the map side
    and AQE splits the rows of a hot key in the join, which a window cannot.
    """
    return join_null_safe(
        df, df.groupBy(*keys).agg(*[c.alias(n) for n, c in totals.items()]), keys
    )
