"""Writers: partitioned tables, month replace, external tables."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import nullcontext

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeshelf.session import small_tasks


def balanced(df: DataFrame, *columns: str) -> DataFrame:
    """Bring rows of a partition value together before a partitioned write.

    AQE sizes the result: a hot value is split over several tasks and small
    ones are merged, so neither one slow task nor a file per task and value.
    """
    return df.hint("rebalance", *columns)


def write_partitioned(df: DataFrame, path: str, columns: Sequence[str], mode: str = "errorifexists") -> None:
    balanced(df, *columns).write.mode(mode).partitionBy(*columns).parquet(path)


FOREIGN = "row outside the batch:"


class BatchRejected(ValueError):
    """The batch must not be written."""


def replace_partitions(
    df: DataFrame,
    path: str,
    column: str,
    only: Sequence[str] | None = None,
    file_format: str = "parquet",
    already_split: bool = False,
    **options: str,
) -> None:
    """Overwrite the partitions present in the batch and leave all others.

    Rows of a partition are brought together first, unless there is one value
    only or the input is a table split the same way (``already_split``): then a
    task holds few partitions anyway, and the shuffle would move every row for nothing.
    Such a task is kept small and writes its partitions' files side by side, without sorting wide rows.

    With ``only``, a row of any other value (or NULL) fails the write job, whose
    output is then never committed.  An empty batch changes nothing, since only
    partitions with rows are replaced, and is reported as rejected.  Both are
    seen by the write itself: the batch is computed once.
    """
    batch = df
    if only is not None:
        inside = F.coalesce(F.col(column).isin(list(only)), F.lit(False))
        text = F.concat(F.lit(f"{FOREIGN} {column}="), F.coalesce(F.col(column).cast("string"), F.lit("NULL")))
        kept = F.when(inside, F.col(column)).otherwise(F.raise_error(text).cast(df.schema[column].dataType))
        batch = df.withColumn(column, kept)
    seen = Observation()
    counts = [
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(column) == v).alias(f"v{i}") for i, v in enumerate(only or [])],
    ]
    batch = batch.observe(seen, *counts)
    together = batch if already_split or (only is not None and len(only) == 1) else balanced(batch, column)
    try:
        with small_tasks(df.sparkSession) if already_split else nullcontext():
            (
                together.write.mode("overwrite")
                .format(file_format)
                .option("partitionOverwriteMode", "dynamic")
                .options(**options)
                .partitionBy(column)
                .save(path)
            )
    except Exception as error:
        if FOREIGN in str(error):
            raise BatchRejected(f"rows outside {column} in {list(only or [])}") from error
        raise
    try:
        found = seen.get
    except Py4JJavaError:
        # A plan Spark finds empty loses its observation; counting it costs nothing.
        found = df.agg(*counts).first().asDict()
    if not found["rows"]:
        raise BatchRejected("empty batch")
    missing = [v for i, v in enumerate(only or []) if not found[f"v{i}"]]
    if missing:
        raise BatchRejected(f"no rows for {column} in {missing}; their partitions are as before")


def write_files(df: DataFrame, path: str, files: int, mode: str = "overwrite", heavy: bool = False) -> None:
    """Write at most ``files`` files.

    ``coalesce`` needs no shuffle but also narrows the stage that computes
    ``df``; ``heavy`` keeps that stage wide and shuffles rows once instead.
    """
    out = df.repartition(files) if heavy else df.coalesce(files)
    out.write.mode(mode).parquet(path)


def append_evolving(df: DataFrame, existing: DataFrame | None, path: str) -> None:
    """Append rows whose columns may differ from those already there.

    A column both sides have must keep its type.
    """
    if existing is not None:
        old = {f.name: f.dataType for f in existing.schema}
        changed = [f.name for f in df.schema if old.get(f.name, f.dataType) != f.dataType]
        if changed:
            raise BatchRejected(f"type of {changed} differs from the table")
    df.write.mode("append").parquet(path)


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def register_external(
    spark: SparkSession,
    name: str,
    path: str,
    schema_ddl: str,
    partition_columns: Sequence[str] = (),
) -> DataFrame:
    """Drop and create the catalog entry over existing files; the files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    by = f"PARTITIONED BY ({', '.join(partition_columns)})" if partition_columns else ""
    spark.sql(f"CREATE TABLE {name} ({schema_ddl}) USING parquet {by} LOCATION '{path}'")
    if partition_columns:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def append_table(df: DataFrame, name: str) -> None:
    """Append to a catalog table, columns matched by name."""
    target = df.sparkSession.table(name).columns
    df.select(*target).write.insertInto(name)
