"""Readers for the file formats and catalog tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeshelf.functions.fixed_values import DEFAULT_SEPARATOR, SEPARATORS


def sniff_separator(
    spark: SparkSession,
    path: str,
    candidates: Sequence[str] = SEPARATORS,
    default: str = DEFAULT_SEPARATOR,
) -> str:
    """First candidate found more than twice in the header line.

    Only the first line of one file is read.
    """
    header = spark.read.text(path).first()
    line = header["value"] if header else ""
    return next((s for s in candidates if line.count(s) > 2), default)


def read_delimited(
    spark: SparkSession,
    path: str,
    sep: str | None = None,
    encoding: str = "ISO-8859-1",
    schema: StructType | str | None = None,
    infer: bool = False,
    sampling_ratio: float = 1.0,
) -> DataFrame:
    """Delimited text with a header.

    Without ``schema`` and ``infer`` every column is a string; without ``sep``
    the separator is taken from the header line.  A repeated header name gets
    its column position appended by Spark's reader.  ``infer`` costs one more
    pass over ``sampling_ratio`` of the lines.
    """
    reader = spark.read.options(
        header=True,
        sep=sep or sniff_separator(spark, path),
        encoding=encoding,
        inferSchema=infer,
        samplingRatio=sampling_ratio,
    )
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def unique_names(names: Sequence[str]) -> list[str]:
    """Names with repeats told apart by a counter, for frames made in memory."""
    seen: dict[str, int] = {}
    result = []
    for name in names:
        count = seen.get(name, 0)
        result.append(name if count == 0 else f"{name}_{count}")
        seen[name] = count + 1
    return result


def read_json_lines(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """JSON lines; give a schema to save the inference pass over all files."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_partition(spark: SparkSession, path: str, column: str, value: str, schema: StructType) -> DataFrame:
    """Rows of one partition; the filter prunes directories.

    The schema is given so that a value like ``202601`` stays text.
    """
    return spark.read.schema(schema).parquet(path).where(F.col(column) == value)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    lower: int,
    upper: int,
    partitions: int,
    properties: dict[str, str] | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A database table read in ``partitions`` ranges of a numeric column.

    The bounds only set the stride: rows outside them fall in the end ranges.
    """
    if partitions < 1 or lower >= upper:
        raise ValueError("need at least one partition and lower < upper")
    options = {"fetchsize": str(fetch_size), **(properties or {})}
    return spark.read.jdbc(
        url,
        table,
        column=column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=options,
    )
