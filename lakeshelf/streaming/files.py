"""File streams: read, count, append, upsert."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lakeshelf.operators.joins import join_null_safe
from lakeshelf.operators.layout import held
from lakeshelf.session import folders_in, remove_folder, subfolders
from lakeshelf.sources.sinks import balanced

BATCH = "_batch"
BUCKET = "_bucket"
BUCKETS = 64


def trigger(kind: str = "available", interval: str = "10 seconds") -> dict:
    """Arguments of ``writeStream.trigger``; ``once`` runs as ``available``."""
    kinds = {
        "default": {"processingTime": "0 seconds"},
        "interval": {"processingTime": interval},
        "once": {"availableNow": True},
        "available": {"availableNow": True},
    }
    return kinds[kind]


def json_stream(
    spark: SparkSession, path: str, schema: str, files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def running_counts(stream: DataFrame, *keys: str) -> DataFrame:
    return stream.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def append_parquet(
    stream: DataFrame, path: str, checkpoint: str, kind: str = "available"
) -> StreamingQuery:
    return (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(kind))
        .start()
    )


def _batch_path(path: str, batch_id: int) -> str:
    return f"{path}/{BATCH}={batch_id}"


def _start(
    stream: DataFrame, mode: str, write: Callable[[DataFrame, int], None], checkpoint: str, kind: str
) -> StreamingQuery:
    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(kind))
        .start()
    )


def _forget(spark: SparkSession, path: str, batch_id: int) -> None:
    """Folders before the last one are needed neither by readers nor to repeat a batch."""
    for old in _finished(spark, path):
        if old < batch_id - 1:
            remove_folder(spark, _batch_path(path, old))


def _finished(spark: SparkSession, path: str) -> list[int]:
    names = [n for n in folders_in(spark, path) if n.startswith(f"{BATCH}=")]
    return sorted(int(n.removeprefix(f"{BATCH}=")) for n in names)


def complete_tables(
    counts: DataFrame, path: str, checkpoint: str, kind: str = "available"
) -> StreamingQuery:
    """The whole result of each batch in a directory of its own; the last two stay.

    A batch run again after a failure writes over the same directory.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_batch_path(path, batch_id))
        _forget(batch.sparkSession, path, batch_id)

    return _start(counts, "complete", write, checkpoint, kind)


def upsert_tables(
    counts: DataFrame, keys: Sequence[str], path: str, checkpoint: str, kind: str = "available", buckets: int = BUCKETS
) -> StreamingQuery:
    """Update mode: only changed rows arrive; the buckets of their keys are written again, all others stay as they are.

    A batch's folder holds the buckets that it changed; the table is the newest folder of each
    bucket (``latest_upserts``).  A batch that is repeated starts from the buckets before it and writes over its
    own folder.  The batch is held while it is read twice; grouped rows hold a key once, NULL
    keys included, so that is not checked again.
    """

    def write(changed: DataFrame, batch_id: int) -> None:
        spark = changed.sparkSession
        number = F.pmod(F.hash(*keys), F.lit(buckets))
        with held(changed.withColumn(BUCKET, number)) as (rows,):
            touched = {r[BUCKET] for r in rows.select(BUCKET).distinct().collect()}  # numbers below ``buckets``
            newest = _newest_buckets(spark, path, batch_id)
            old = [newest[b] for b in sorted(touched & newest.keys())]
            table = rows
            if old:
                before = _read_buckets(spark, path, old, rows.schema)
                table = join_null_safe(before, rows.select(*keys), keys, "left_anti").unionByName(rows)
            balanced(table, BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(_batch_path(path, batch_id))
        _forget_buckets(spark, path, batch_id)

    return _start(counts, "update", write, checkpoint, kind)


def _bucket_numbers(spark: SparkSession, path: str, batch: int) -> list[int]:
    names = subfolders(spark, _batch_path(path, batch))
    return [int(n.removeprefix(f"{BUCKET}=")) for n in names if n.startswith(f"{BUCKET}=")]


def _newest_buckets(spark: SparkSession, path: str, below: int | None = None) -> dict[int, str]:
    """The folder of each bucket's last finished batch, of those before ``below``."""
    newest = {}
    for batch in _finished(spark, path):
        if below is None or batch < below:
            newest |= {b: f"{_batch_path(path, batch)}/{BUCKET}={b}" for b in _bucket_numbers(spark, path, batch)}
    return newest


def _read_buckets(spark: SparkSession, path: str, folders: Sequence[str], schema: StructType | None = None) -> DataFrame:
    reader = spark.read.option("basePath", path)
    return (reader.schema(schema) if schema else reader).parquet(*folders).drop(BATCH)


def _forget_buckets(spark: SparkSession, path: str, batch_id: int) -> None:
    """Folders that a batch before ``batch_id`` has replaced are needed neither by readers nor to repeat this batch."""
    newest = set(_newest_buckets(spark, path, batch_id).values())
    for batch in _finished(spark, path):
        if batch >= batch_id:
            continue
        folders = [f"{_batch_path(path, batch)}/{BUCKET}={b}" for b in _bucket_numbers(spark, path, batch)]
        kept = [f for f in folders if f in newest]
        for folder in (f for f in folders if f not in newest):
            remove_folder(spark, folder)
        if not kept and batch < batch_id - 1:
            remove_folder(spark, _batch_path(path, batch))


def latest_upserts(spark: SparkSession, path: str) -> DataFrame:
    """The upserted table: of each bucket the rows of the last batch that changed it."""
    newest = _newest_buckets(spark, path)
    if not newest:
        raise ValueError(f"no finished batch with rows below {path}")
    return _read_buckets(spark, path, sorted(newest.values())).drop(BUCKET)


def latest_table(spark: SparkSession, path: str) -> DataFrame:
    """The table of the last finished batch, also of a run that found nothing new."""
    done = _finished(spark, path)
    if not done:
        raise ValueError(f"no finished batch below {path}")
    return spark.read.parquet(_batch_path(path, done[-1]))
