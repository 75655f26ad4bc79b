"""UPDATE, DELETE and MERGE as frames in, frames out."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from lakeshelf.operators.joins import join_null_safe
from lakeshelf.session import new_path, remove_folder, subfolders
from lakeshelf.sources.sinks import replace_partitions, write_partitioned


def update(df: DataFrame, where: Column, values: Mapping[str, Column]) -> DataFrame:
    """Rows where the predicate is true get new values; every right side sees the old row."""
    hit = F.coalesce(where, F.lit(False))
    types = {f.name: f.dataType for f in df.schema}
    return df.withColumns(
        {n: F.when(hit, v.cast(types[n])).otherwise(F.col(n)) for n, v in values.items()}
    )


def delete(df: DataFrame, where: Column) -> DataFrame:
    """Rows where the predicate is true go; rows where it is NULL stay."""
    return df.where(~F.coalesce(where, F.lit(False)))


class DuplicateKeys(ValueError):
    """The merge source holds a key more than once."""


def _whole(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def require_unique(df: DataFrame, keys: Sequence[str], nulls_match: bool = False) -> None:
    """Raise when a key occurs twice; one example is shown.  Keys with NULL parts count only with ``nulls_match``."""
    rows = df if nulls_match else df.where(_whole(keys))
    twice = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").first()
    if twice is not None:
        raise DuplicateKeys(f"more than one row of {twice.asDict()}")


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str], checked: bool = False) -> DataFrame:
    """Upsert: matched rows take all source columns, unmatched source rows are added.

    NULL keys match nothing.  The target goes through one anti join, which AQE
    splits for a hot key and broadcasts for a source small enough.  ``checked``
    says that the source is known to hold a key once, as grouped rows do.
    """
    if not checked:
        require_unique(source, keys)
    kept = target.join(source.select(*keys), list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(source.select(*target.columns))


def merge_metrics(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: target rows updated, inserted and deleted, and source rows, as ``merge`` would do it."""
    require_unique(source, keys)
    sides = target.select(*keys, F.lit(1).alias("_t"), F.lit(0).alias("_s")).unionByName(
        source.select(*keys, F.lit(0).alias("_t"), F.lit(1).alias("_s"))
    )
    # Counted per key with a map-side combine: neither a hot key nor all NULL keys meet as rows.
    per_key = sides.groupBy(*keys).agg(F.sum("_t").alias("_t"), F.sum("_s").alias("_s"))
    matched = _whole(keys) & (F.col("_t") > 0) & (F.col("_s") > 0)

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    return per_key.agg(
        total(F.when(matched, F.col("_t")).otherwise(0)).alias("rows_updated"),
        total(F.when(matched, 0).otherwise(F.col("_s"))).alias("rows_inserted"),
        F.lit(0).cast("long").alias("rows_deleted"),
        total(F.col("_s")).alias("source_rows"),
    )


def merge_into(
    spark: SparkSession, path: str, schema: StructType, partition: str, source: DataFrame, keys: Sequence[str]
) -> None:
    """MERGE applied to a partitioned table: only partitions that hold a matched row or take a new one are written again.

    Keys are looked up in the whole table, so a matched row leaves its old partition
    when the source has it in another one.
    """
    require_unique(source, keys)
    rows = source.select(*schema.names)
    target = spark.read.schema(schema).parquet(path)
    matched = target.select(*keys, F.col(partition).alias(PLACE)).join(rows.select(*keys), list(keys), "left_semi").select(PLACE)

    def change(old: DataFrame) -> DataFrame:
        return merge(old, rows, keys, checked=True)

    _rewrite(spark, path, schema, partition, matched, rows.select(partition), change)


def update_table(
    spark: SparkSession, path: str, schema: StructType, partition: str, where: Column, values: Mapping[str, Column]
) -> None:
    """UPDATE applied to a partitioned table: only partitions with a changed row are written again.

    SET may name the partition column: the partitions that take the moved rows are
    written again too, with what they held before.
    """
    target = spark.read.schema(schema).parquet(path)
    hit = target.where(F.coalesce(where, F.lit(False)))
    arriving = update(hit, where, values).select(partition) if partition in values else None

    def change(old: DataFrame) -> DataFrame:
        return update(old, where, values)

    _rewrite(spark, path, schema, partition, hit.select(F.col(partition).alias(PLACE)), arriving, change)


def delete_from(spark: SparkSession, path: str, schema: StructType, partition: str, where: Column) -> None:
    """DELETE applied to a partitioned table: partitions with a deleted row are written again, emptied ones removed."""
    target = spark.read.schema(schema).parquet(path)

    def change(old: DataFrame) -> DataFrame:
        return delete(old, where)

    hit = target.where(F.coalesce(where, F.lit(False)))
    _rewrite(spark, path, schema, partition, hit.select(F.col(partition).alias(PLACE)), None, change)


FOLDER, PLACE = "_folder", "_place"


def _folders(spark: SparkSession, path: str, schema: StructType, partition: str, hit: DataFrame, arriving: DataFrame | None) -> list[str]:
    """Folders that hold a value of the rows hit (``PLACE``) or of ``arriving``.

    They are the names on disk, taken from the files: a value may be escaped there
    (``a:b``), spelt otherwise (``007`` read as 7) or NULL; a value that two folders spell brings both,
    since new rows of it go to one.  One name per partition comes here.
    """
    wanted = hit.select(PLACE).distinct()
    if arriving is not None:
        place = F.col(partition)
        if isinstance(schema[partition].dataType, StringType):
            place = F.nullif(place, F.lit(""))  # both are written to the folder of NULL
        wanted = wanted.union(arriving.select(place.alias(PLACE)).distinct()).distinct()
    # Values of all partitions: read from the paths, no column of the files is.  Names are cut from
    # the paths once a file and not once a row.
    files = spark.read.schema(schema).parquet(path).select(F.col(partition).alias(PLACE), F.col("_metadata.file_path").alias("_file")).distinct()
    folder = F.substring_index(F.substring_index("_file", "/", -2), "/", 1)
    known = files.select(PLACE, folder.alias(FOLDER)).distinct()
    found = join_null_safe(known, wanted, [PLACE], "left_semi").select(FOLDER)
    return sorted(unquote(r[FOLDER]) for r in found.distinct().toLocalIterator())


def _rewrite(
    spark: SparkSession,
    path: str,
    schema: StructType,
    partition: str,
    hit: DataFrame,
    arriving: DataFrame | None,
    change: Callable[[DataFrame], DataFrame],
) -> None:
    """Put ``change`` of the folders in place of those folders.

    The new rows are stored first, split like the table: they are read from the files
    they replace.  Folders that got new rows are replaced, then those left
    without any are removed; a MERGE stopped in between ends right when it is run again.
    """
    folders = _folders(spark, path, schema, partition, hit, arriving)
    if not folders and arriving is None:
        return
    reader = spark.read.schema(schema).option("basePath", path)
    old = reader.parquet(*[f"{path}/{f}" for f in folders]) if folders else spark.createDataFrame([], schema)
    staged = new_path(spark, "rewritten")
    write_partitioned(change(old), staged, [partition])
    made = subfolders(spark, staged)
    if made:
        replace_partitions(spark.read.schema(schema).parquet(staged), path, partition, already_split=True)
    for folder in folders:
        if folder not in made and not remove_folder(spark, f"{path}/{folder}"):
            raise FileNotFoundError(f"no folder {path}/{folder} to remove")
    remove_folder(spark, staged)
