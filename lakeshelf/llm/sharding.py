"""Sharding by a two-pass external shuffle.

Pass one scatters the rows over buckets by a seeded hash; a bucket is sized to
fit in memory.  Pass two sorts a bucket (so that its order does not depend on how it
arrived) and shuffles it with Fisher-Yates under a seed of its own, and writes it.
The buckets one after the other are one long random order; dealing it out round
robin gives shards whose counts differ by at most one (law ``rows``).

There are as many buckets as the data need, but at most ``MOST_PARTS`` shuffle partitions: a
partition is a run of buckets that its task takes one after the other from Spark's
sort, which spills, so memory holds one bucket whatever the size of the input.

Defined results: a null text has size 16 (the row's fixed part) and the CRC-32 of
the empty text.  Rows with null or repeated ids scatter like any others: a row
number is part of the hash, so no bucket gets them all.  Fewer rows than shards
leave shards empty.  An empty table gives an empty table.  Columns of the input
named ``shard`` or ``slot`` give way to the new ones.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from lakeshelf.llm.common import fresh
from lakeshelf.session import new_path

SEED = 20_240
BUCKET_BYTES = 32 << 20
ROW_BYTES = 16
MOST_PARTS = 8192
FEW_BUCKETS = 1_000_000  # so many bucket totals (16 MB) may be broadcast


def row_bytes(text: str = "text"):
    return (F.coalesce(F.octet_length(F.col(f"`{text}`").cast("binary")), F.lit(0)) + ROW_BYTES).cast("long")


def shuffled(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED,
             bucket_bytes: int = BUCKET_BYTES, bucket_name: str = "_bucket", place: str = "_place", most_parts: int = MOST_PARTS) -> DataFrame:
    """All columns of ``docs`` plus its bucket and its place there, written bucket by bucket and read back."""
    n, parts = bucket_numbers(spark, docs.agg(F.sum(row_bytes(text))).first()[0] or 0, bucket_bytes, most_parts)
    crc = F.crc32(F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit("").cast("binary")))
    key = F.xxhash64(F.lit(seed), F.col(f"`{doc_id}`"), crc, F.col("`\x00row`"))
    number = F.pmod(F.col("`\x00key`"), F.lit(n)).cast("int")
    part = F.floor(F.col("`\x00bucket`").cast("long") * parts / n).cast("int")
    order = [F.col("`\x00bucket`"), F.col("`\x00key`"), F.col(f"`{doc_id}`"), F.col("`\x00row`")]
    scattered = docs.withColumn("\x00row", F.monotonically_increasing_id()).withColumn("\x00key", key).withColumn("\x00bucket", number)
    scattered = scattered.repartitionById(parts, part).sortWithinPartitions(*order).drop("\x00key", "\x00row")
    schema = StructType([*docs.schema, StructField(bucket_name, IntegerType()), StructField(place, LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in by_bucket(batches):
            order = fisher_yates(rows.num_rows, seed, bucket)
            step = max(1, min(4096, math.ceil(rows.num_rows * (4 << 20) / max(1, rows.nbytes))))
            for i in range(0, rows.num_rows, step):
                taken = rows.take(pa.array(order[i : i + step])).combine_chunks()
                for batch in taken.to_batches():
                    yield pa.RecordBatch.from_arrays(
                        [*batch.columns, pa.array(np.full(batch.num_rows, bucket, np.int32)), pa.array(np.arange(i, i + batch.num_rows))],
                        names=schema.fieldNames(),
                    )

    path = new_path(spark, "shards")
    scattered.mapInArrow(run, schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def bucket_numbers(spark: SparkSession, total: int, bucket_bytes: int, most_parts: int) -> tuple[int, int]:
    """(buckets, shuffle partitions) for so many bytes."""
    cores = min(spark.sparkContext.defaultParallelism, math.ceil(total / (1 << 20)))
    n = max(1, math.ceil(total / bucket_bytes), cores)
    return n, min(n, most_parts)


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """(bucket, its rows) of a task's sorted rows, whose last column is the bucket; one bucket is held at a time."""
    held, now = [], None
    for batch in batches:
        numbers = batch.column(batch.num_columns - 1).to_numpy()
        rows = pa.RecordBatch.from_arrays(batch.columns[:-1], names=batch.schema.names[:-1])
        cuts = np.flatnonzero(np.diff(numbers)) + 1
        for start, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            if start == stop:
                continue
            if held and numbers[start] != now:
                yield now, pa.Table.from_batches(held).combine_chunks()
                held = []
            now = int(numbers[start])
            held.append(rows.slice(start, stop - start))
    if held:
        yield now, pa.Table.from_batches(held).combine_chunks()


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A uniform order of n rows; each step swaps the last open place with a random open one."""
    order, draw = np.arange(n), np.random.Generator(np.random.PCG64([seed, bucket]))
    picks = draw.integers(0, np.arange(n, 0, -1))  # of n, n - 1, ... open places
    places = order.tolist()
    for i, j in zip(range(n - 1, 0, -1), picks.tolist()):
        places[i], places[j] = places[j], places[i]
    return np.array(places, np.int64)


def shards(spark: SparkSession, docs: DataFrame, n_shards: int = 40, doc_id: str = "doc_id", text: str = "text",
           seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, most_parts: int = MOST_PARTS, few_buckets: int = FEW_BUCKETS) -> DataFrame:
    """All columns of ``docs`` plus ``shard`` and ``slot`` (its place in the shard, without gaps)."""
    kept = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    docs = docs.select(*[F.col(f"`{c}`") for c in kept])
    bucket, place = fresh(kept, "_bucket"), fresh(kept, "_place")
    rows = shuffled(spark, docs, doc_id, text, seed, bucket_bytes, bucket, place, most_parts)
    # One row for each bucket.
    counts = rows.groupBy(F.col(f"`{bucket}`").alias("\x00b")).agg(F.count(F.lit(1)).alias("\x00n"))
    window = Window.partitionBy().orderBy("`\x00b`").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("`\x00b`", F.coalesce(F.sum("`\x00n`").over(window), F.lit(0)).alias("\x00start"))
    at = F.col("`\x00start`") + F.col(f"`{place}`")
    if counts.count() <= few_buckets:
        starts = F.broadcast(starts)
    dealt = rows.join(starts, F.col(f"`{bucket}`") == F.col("`\x00b`"))
    return dealt.select(
        *[F.col(f"`{c}`") for c in kept],
        F.pmod(at, F.lit(n_shards)).cast("int").alias("shard"),
        F.floor(at / F.lit(n_shards)).cast("long").alias("slot"),
    )
