"""Sensor readings in three layouts, and what a lookup costs in each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf.functions.measures import mean_of
from lakeshelf.operators.layout import bucket
from lakeshelf.sources.sinks import write_partitioned

BUCKETS = 16
GROUP_ROWS = 1_000_000


def write_as_they_come(readings: DataFrame, path: str, group_rows: int = GROUP_ROWS) -> None:
    """Rows in the order of arrival, without a shuffle; row groups of at most ``group_rows`` carry a Bloom filter on the id.

    Ids lie anywhere, so least and greatest id of a row group exclude nothing; the filter does,
    but for one absent id in a hundred.
    """
    options = {
        "parquet.block.row.count.limit": group_rows,
        "parquet.bloom.filter.enabled#id": "true",
        "parquet.bloom.filter.expected.ndv#id": group_rows,
        "parquet.bloom.filter.fpp#id": "0.01",
        "parquet.bloom.filter.max.bytes": 4 << 20,
    }
    readings.write.options(**{k: str(v) for k, v in options.items()}).parquet(path)


def write_layouts(readings: DataFrame, base: str, buckets: int = BUCKETS) -> dict[str, str]:
    """The same rows flat, sorted by id inside range partitions; as they come, with Bloom filters; and by id bucket.

    One directory per id would give a file per id; a bucket keeps the number of
    directories fixed and still prunes a point lookup.
    """
    paths = {"flat": f"{base}/flat", "arrival": f"{base}/arrival", "bucketed": f"{base}/bucketed"}
    write_as_they_come(readings, paths["arrival"])
    readings.repartitionByRange("id").sortWithinPartitions("id").write.parquet(paths["flat"])
    write_partitioned(
        readings.withColumn("bucket", bucket(F.col("id"), buckets)), paths["bucketed"], ["bucket"]
    )
    return paths


def point_lookup(spark: SparkSession, path: str, reading_id: int, buckets: int | None = None) -> DataFrame:
    """Rows of one id; on the bucketed layout only its directory is read."""
    rows = spark.read.parquet(path)
    wanted = F.lit(reading_id).cast(rows.schema["id"].dataType)  # the hash depends on the type
    rows = rows.where(F.col("id") == wanted)
    if buckets is not None:
        rows = rows.where(F.col("bucket") == bucket(wanted, buckets))
    return rows.select("id", "value", "time")


def mean_between(df: DataFrame, start: str, stop: str) -> DataFrame:
    """Mean value between two moments, compared as timestamps."""
    time = F.col("time")
    inside = df.where((time >= F.to_timestamp(F.lit(start))) & (time <= F.to_timestamp(F.lit(stop))))
    return inside.agg(F.count(F.lit(1)).alias("readings"), mean_of(F.col("value")).alias("mean_value"))
