"""Table layout: partition transforms, pruning, compaction, held frames."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from itertools import groupby
from urllib.parse import unquote

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakeshelf.operators.joins import broadcast_checked
from lakeshelf.session import folders_in, remove_folder, rename_file
from lakeshelf.sources.sinks import balanced

TARGET_FILE_BYTES = 128 * 1024 * 1024

TIME_PATTERNS = {
    "year": "yyyy",
    "month": "yyyy-MM",
    "day": "yyyy-MM-dd",
    "hour": "yyyy-MM-dd-HH",
}


def time_transform(moment: Column, unit: str) -> Column:
    """Partition text of a date or timestamp; its order is the order of time."""
    return F.date_format(moment, TIME_PATTERNS[unit])


def bucket(column: Column, buckets: int) -> Column:
    """Stable bucket number from 0 to ``buckets`` - 1; NULL stays NULL."""
    return F.when(column.isNotNull(), F.pmod(F.hash(column), F.lit(buckets)))


def truncate_text(column: Column, width: int) -> Column:
    return F.left(column, F.lit(width))


def truncate_number(column: Column, width: int) -> Column:
    """Lower edge of the ``width``-wide step the number lies in."""
    return column - F.pmod(column, F.lit(width))


def since(df: DataFrame, moment: str, partition: str, unit: str, start: str) -> DataFrame:
    """Rows with ``moment`` >= ``start``, pruned by the derived partition column.

    A plain Parquet table does not know how the partition follows from the base
    column, so the implied predicate is added here.
    """
    bound = F.to_timestamp_ntz(F.lit(start))
    return df.where(
        (F.col(moment) >= bound) & (F.col(partition) >= time_transform(bound, unit))
    )


def partition_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and files per partition value of a table read from files."""
    name = F.col("_metadata.file_path")
    return df.groupBy(*columns).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(name).alias("files")
    )


def file_stats(spark: SparkSession, path: str, pattern: str = "*.parquet") -> tuple[int, int]:
    """(files, bytes) below a path, from the file listing; no content is read."""
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("length")
    )
    row = listing.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")).first()
    return int(row["files"]), int(row["bytes"] or 0)


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    partition_columns: Sequence[str] = (),
    file_bytes: int = TARGET_FILE_BYTES,
) -> tuple[int, int]:
    """Rewrite small files at ``source`` into files of about ``file_bytes`` at ``target``.

    Never in place: a reader of ``source`` is not disturbed and a failed run
    loses nothing.  Partition values stay the text they are in the folder names
    (``007`` does not become 7).  Returns the file counts before and after.
    """
    before, size = file_stats(spark, source)
    found = spark.read.parquet(source).schema
    as_text = StructType([StructField(f.name, StringType()) if f.name in partition_columns else f for f in found])
    rows = spark.read.schema(as_text).parquet(source)
    if partition_columns:
        each = max(1, rows.count() * file_bytes // max(1, size))  # the count comes from the file footers
        writer = balanced(rows, *partition_columns).write.option("maxRecordsPerFile", each)
        writer.partitionBy(*partition_columns).parquet(target)
    else:
        rows.repartition(max(1, -(-size // file_bytes))).write.parquet(target)
    after, _ = file_stats(spark, target)
    return before, after


def write_bucketed(df: DataFrame, name: str, path: str, columns: Sequence[str], buckets: int, sort: Sequence[str] = ()) -> None:
    """``df`` as a catalog table whose rows are dealt to ``buckets`` files by the hash of ``columns``.

    The one shuffle is paid at the write, by the same hash, so a bucket is one file.  Joins
    and aggregates on those columns, with tables of as many buckets, need no shuffle any more.
    """
    dealt = df.repartition(buckets, *columns)
    writer = dealt.write.format("parquet").option("path", path).bucketBy(buckets, *columns)
    (writer.sortBy(*sort) if sort else writer).saveAsTable(name)


# --- compaction in place -------------------------------------------------------------

STAGED = "_compacting"  # readers of a Parquet folder leave out names that begin so
PLAN = "plan"


def pack(sizes: Sequence[tuple[str, int]], most: int) -> list[list[str]]:
    """First fit, the largest first: names in groups of ``most`` bytes at most; groups of one name are left out."""
    groups: list[tuple[int, list[str]]] = []
    for name, size in sorted(sizes, key=lambda s: (-s[1], s[0])):
        for i, (held, names) in enumerate(groups):
            if held + size <= most:
                groups[i] = (held + size, [*names, name])
                break
        else:
            groups.append((size, [name]))
    return [names for _, names in groups if len(names) > 1]


def small_file_groups(spark: SparkSession, path: str, file_bytes: int) -> list[list[str]]:
    """Groups of files below ``path`` to be joined, all of a group from one folder.

    Names and sizes come from the file listing, a folder at a time; no content is read.
    """
    listing = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
        .where(F.col("length") < file_bytes)
        .select(F.col("_metadata.file_path").alias("file"), "length")
        .withColumn("folder", F.regexp_extract("file", "^(.*)/[^/]+$", 1))
    )
    made: list[list[str]] = []
    for _, rows in groupby(listing.orderBy("folder", "file").toLocalIterator(), key=lambda r: r["folder"]):
        made += pack([(r["file"], r["length"]) for r in rows], file_bytes)
    return made


def compact_in_place(
    spark: SparkSession, path: str, schema: StructType, partition_columns: Sequence[str] = (), file_bytes: int = TARGET_FILE_BYTES
) -> tuple[int, int]:
    """Join small files of a table; files of ``file_bytes`` or more are neither read nor renamed.

    The small files of each folder are packed into groups of about ``file_bytes``; a group becomes one
    file, so only rows of small files are shuffled.  The new files are staged in a hidden folder
    and listed in a plan with those they replace; only then are they moved in and the old ones removed.  A run
    that stops on the way is finished by the next.  Between the moves and the removals a reader may see
    rows twice.  ``schema`` has the partition columns as the text they are in the folder names.
    Returns the files replaced and the files made.
    """
    finish_compaction(spark, path)
    groups = small_file_groups(spark, path, file_bytes)
    if not groups:
        return 0, 0
    numbers = spark.createDataFrame([(f, i) for i, names in enumerate(groups) for f in names], "_file string, _group int")
    names = [unquote(f) for group in groups for f in group]
    rows = spark.read.schema(schema).option("basePath", path).parquet(*names).withColumn("_from", F.col("_metadata.file_path"))
    rows = rows.join(broadcast_checked(numbers), F.col("_from") == F.col("_file")).drop("_from", "_file")
    staged = f"{path}/{STAGED}/files"
    remove_folder(spark, staged)
    rows.repartitionById(len(groups), "_group").drop("_group").write.partitionBy(*partition_columns).parquet(staged)
    made = [unquote(r["f"]) for r in _listing(spark, staged).toLocalIterator()]
    plan = [("old", n) for n in names] + [("new", n) for n in made]
    spark.createDataFrame(plan, "kind string, file string").coalesce(1).write.mode("overwrite").json(f"{path}/{STAGED}/{PLAN}")
    finish_compaction(spark, path)
    return len(names), len(made)


def _listing(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    return files.select(F.col("_metadata.file_path").alias("f"))


def finish_compaction(spark: SparkSession, path: str) -> None:
    """Carry out a complete plan, if there is one; each step may have been done before."""
    if PLAN in folders_in(spark, f"{path}/{STAGED}"):
        plan = spark.read.schema("kind string, file string").json(f"{path}/{STAGED}/{PLAN}")
        mark = f"/{STAGED}/files/"
        for row in plan.where("kind = 'new'").toLocalIterator():
            rename_file(spark, row["file"], row["file"].replace(mark, "/"))
        for row in plan.where("kind = 'old'").toLocalIterator():
            remove_folder(spark, row["file"])
    remove_folder(spark, f"{path}/{STAGED}")


@contextmanager
def held(*frames: DataFrame, storage: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[list[DataFrame]]:
    """Keep frames that are used twice or more, and release them at the end.

    A block lost with its executor is computed again from the frame's own plan.
    """
    kept = [df.persist(storage) for df in frames]
    try:
        yield kept
    finally:
        for df in kept:
            df.unpersist()
