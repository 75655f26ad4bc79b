"""What the query modules share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from lakeshelf.plans import benefits
from lakeshelf.plans.sales_text import landing_text, silver_cte
from lakeshelf.session import store

STAMP = "2026-01-31T00:00:00Z"

SILVER_CTE = silver_cte()


def plain(df: DataFrame) -> DataFrame:
    """Decimals as double, dates and timestamps as text: types both engines print alike."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, (TimestampType, TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text rendered from the sales tables, taken through bronze and silver without files.

    Catalyst prunes the columns a report does not use, down to the scans.
    """
    raw = landing_text(spark, sf_dir)
    return benefits.silver(benefits.bronze(raw, "sales", STAMP), STAMP)


def silver_stored(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    """The named columns, written once: for reports that pass over silver more than once.

    Without it every pass would repeat the joins and the parsing.
    """
    return store(spark, silver_rows(spark, sf_dir).select(*columns), "silver")
