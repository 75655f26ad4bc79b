"""UDF forms of banding, and min-max scaling over a whole column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf.operators.columns import min_max_scaled
from lakeshelf.operators.udfs import price_band, price_band_batch
from lakeshelf.registry import query, table

HOLES_SQL = "SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS saldo FROM customer"


def _holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("saldo")
    )


PRICES_SQL = "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price FROM orders"
BANDS_SQL = f"""SELECT o_orderkey, CASE WHEN price IS NULL THEN 'open' WHEN price < 50000 THEN 'small'
  WHEN price < 150000 THEN 'medium' WHEN price < 300000 THEN 'large' ELSE 'bulk' END AS band FROM ({PRICES_SQL})"""


def _prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return table(spark, sf_dir, "orders").select("o_orderkey", known.alias("price"))


@query("udf_bands_py", BANDS_SQL)
def udf_bands_py(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prices(spark, sf_dir).select("o_orderkey", price_band("price").alias("band"))


@query("udf_bands_pandas", BANDS_SQL)
def udf_bands_pandas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prices(spark, sf_dir).select("o_orderkey", price_band_batch("price").alias("band"))


@query(
    "udf_minmax_norm",
    f"""WITH h AS ({HOLES_SQL}) SELECT c_custkey,
  (saldo - (SELECT min(saldo) FROM h)) / ((SELECT max(saldo) FROM h) - (SELECT min(saldo) FROM h)) AS saldo_norm FROM h""",
)
def udf_minmax_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return min_max_scaled(_holes(spark, sf_dir), "saldo", "saldo_norm").select("c_custkey", "saldo_norm")
