"""What the operators share: column batches, distributed prefix sums, written tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from lakeshelf.session import new_path

# The word rule of all contracts: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage, survives lost executors."""
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def add_columns(
    df: DataFrame, text: str, added: StructType, rows: Callable[[list[bytes | None]], list[Sequence]], keep: Sequence[str] | None = None
) -> DataFrame:
    """``keep`` (all columns by default) plus what ``rows`` makes of the UTF-8 texts of a batch.

    ``rows`` returns one sequence for each field of ``added``.  A column of ``df``
    that has the name of an added one gives way.
    """
    names = {f.name for f in added}
    kept = [c for c in (df.columns if keep is None else keep) if c not in names]
    schema = StructType([f for f in df.schema if f.name in kept] + list(added))
    kept = [f.name for f in schema][: len(kept)]
    source = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("binary").alias("\x00text"))
    types = [pa_type(f) for f in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = rows(batch.column(len(kept)).to_pylist())
            columns = [batch.column(i) for i in range(len(kept))]
            columns += [pa.array(values, type=t) for values, t in zip(made, types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=kept + [f.name for f in added])

    return source.mapInArrow(run, schema)


def fresh(names: Sequence[str], wanted: str) -> str:
    """``wanted``, with underscores added until no column has that name."""
    taken = {n.lower() for n in names}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def pa_type(field: StructField) -> pa.DataType:
    simple = {
        "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
        "string": pa.string(), "array<int>": pa.list_(pa.int32()),
    }
    return simple[field.dataType.simpleString()]


HOT_LEAST, HOT_MOST = 1000, 10_000


def join_split(big: DataFrame, small: DataFrame, key: str, n: str) -> DataFrame:
    """``big`` joined with ``small``, which has one row for each key and in ``n`` how many rows of ``big`` have it.

    Rows of a hot key (over ``HOT_LEAST`` rows and over 1 / ``HOT_MOST`` of all) are not dealt by key: there are
    fewer than ``HOT_MOST`` such keys, so their rows of ``small`` are broadcast.  All others meet in a shuffle.
    """
    total = small.agg(F.sum(n)).first()[0] or 0
    hot = F.col(n) > max(HOT_LEAST, total // HOT_MOST)
    few = F.broadcast(small.where(hot).drop(n))
    rest = big.join(F.broadcast(small.where(hot).select(key)), key, "left_anti")
    return big.join(few, key).unionByName(rest.join(small.where(~hot).drop(n), key))


def row_key(df: DataFrame) -> Column:
    """128 bits that tell rows apart by all their columns, NULLs by the column they are in.

    Two hashes of 64 bits with seeds of their own: over 10**12 different rows, equal keys of two
    of them are less likely than one in 10**14.
    """
    values = [part for c in df.columns for part in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`").cast("string"))]
    return F.concat_ws("-", *[F.hex(F.xxhash64(F.lit(seed), *values)) for seed in (1, 2)])


def parts_for(spark: SparkSession, rows_hint: int | None = None) -> int:
    """Partitions for a range sort: what the session uses for shuffles, at least one a core."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def ordered_prefix(
    spark: SparkSession,
    df: DataFrame,
    order: Sequence[Column],
    value: str,
    before: str,
    group: str | None = None,
    n: int | None = None,
    name: str = "prefix",
) -> DataFrame:
    """Adds ``before``: the sum of ``value`` over the earlier rows of the same ``group`` in ``order``.

    The rows are range-partitioned on group and order, so a hot group spans many
    tasks; each task keeps a running sum per group, the table is written, and the
    totals of the earlier partitions (one row for each partition and group in it) are added.
    Equal rows are told apart by a row number, so repeated rows spread too.
    """
    tie = "\x00tie"
    keys = ([F.col(group).asc_nulls_last()] if group else []) + [*order, F.col(tie).asc()]
    ranged = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(n or parts_for(spark), *keys)
    ranged = ranged.sortWithinPartitions(*keys).drop(tie)
    schema = StructType([*ranged.schema, StructField(before, LongType()), StructField("_part", IntegerType())])
    names = ranged.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, total = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            values = batch.column(names.index(value)).to_pylist()
            groups = batch.column(names.index(group)).to_pylist() if group else [None] * len(values)
            sums = []
            for g, v in zip(groups, values, strict=True):
                if g != held:
                    held, total = g, 0
                sums.append(total)
                total += v or 0
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sums, pa.int64()), pa.array([part] * len(sums), pa.int32())],
                names=[f.name for f in schema],
            )

    table = written(spark, ranged.mapInArrow(run, schema), name)
    by = [group] if group else []
    totals = table.groupBy("_part", *by).agg(F.sum(value).alias("_sum"))
    window = (Window.partitionBy(group) if group else Window.partitionBy()).orderBy("_part")
    shift = totals.select(
        F.col("_part").alias("_p"), *[F.col(group).alias("_g")] if group else [],
        F.coalesce(F.sum("_sum").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_shift"),
    )
    on = F.col("_part") == F.col("_p")
    if group:
        on = on & F.col(group).eqNullSafe(F.col("_g"))
    else:
        shift = F.broadcast(shift)  # one row for each partition
    return table.join(shift, on, "left").select(
        *[F.col(f"`{c}`") for c in names], (F.col(before) + F.coalesce(F.col("_shift"), F.lit(0))).alias(before)
    )
