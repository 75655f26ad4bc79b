"""Device telemetry: JSON lines to bronze, silver and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf.operators.aggregates import frequency
from lakeshelf.operators.dedupe import one_per_key
from lakeshelf.sources.readers import read_json_lines

# Names and order of the telemetry fields.
DEVICE_SCHEMA = (
    "id BIGINT, uid STRING, user_id BIGINT, manufacturer STRING, model STRING, platform STRING, "
    "version STRING, build_number STRING, serial_number STRING, dt_current_timestamp BIGINT"
)


def bronze(spark: SparkSession, json_glob: str, ingested_at: str | None = None) -> DataFrame:
    """Raw telemetry with ingestion time and source format.

    The schema is given, so the files are read once; without ``ingested_at`` the
    clock of the run is used.
    """
    moment = F.current_timestamp() if ingested_at is None else F.to_timestamp(F.lit(ingested_at))
    return read_json_lines(spark, json_glob, DEVICE_SCHEMA).withColumns(
        {"_ingestion_timestamp": moment, "_source_format": F.lit("json")}
    )


def silver(bronze_rows: DataFrame) -> DataFrame:
    """Rows with both ids, the latest one per id, tidy names and a real timestamp."""
    known = bronze_rows.where(F.col("id").isNotNull() & F.col("uid").isNotNull())
    latest = one_per_key(known, ["id"], ["dt_current_timestamp"], keep="last")
    return latest.select(
        F.col("id").alias("device_id"),
        "uid",
        "user_id",
        F.upper(F.trim("manufacturer")).alias("manufacturer"),
        "model",
        F.lower(F.trim("platform")).alias("platform"),
        "version",
        "build_number",
        "serial_number",
        F.timestamp_millis("dt_current_timestamp").alias("event_timestamp"),
        "_ingestion_timestamp",
    )


def device_counts(silver_rows: DataFrame, *by: str) -> DataFrame:
    return frequency(silver_rows, *by, name="total_devices")


def telemetry_text(events: DataFrame) -> DataFrame:
    """Events as telemetry with the faults silver removes.

    Error events lose their id, and every click is reported a second time one
    hour later.
    """
    c = F.col
    kind, millis = c("event_type"), F.unix_millis(c("ts").cast("timestamp"))
    first = events.select(
        F.when(kind != "error", c("event_id")).alias("id"),
        F.concat(F.lit("u-"), c("user_id")).alias("uid"),
        "user_id",
        F.concat(F.lit("  "), F.initcap(kind), F.lit(" ")).alias("manufacturer"),
        F.concat(F.lit("M-"), c("user_id")).alias("model"),
        F.when(c("value") < 10, " Android ").when(c("value") < 50, "IOS ").otherwise(" Web").alias("platform"),
        F.lit("1.0").alias("version"),
        c("props").alias("build_number"),
        F.concat(F.lit("S-"), c("event_id")).alias("serial_number"),
        millis.alias("dt_current_timestamp"),
    )
    again = first.where(F.trim("manufacturer") == "Click").withColumns(
        {"version": F.lit("1.1"), "dt_current_timestamp": c("dt_current_timestamp") + 3_600_000}
    )
    return first.unionByName(again)
