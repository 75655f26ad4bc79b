"""Join kinds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf.operators.joins import broadcast_checked, full_join
from lakeshelf.queries.common import plain
from lakeshelf.registry import query, table


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All customers and all orders, with rows on both sides that match nothing.

    Customers in debt have no key; pending orders name a customer that does not exist.
    """
    customers = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).alias("custkey"), "c_name"
    )
    lost = F.when(F.col("o_orderstatus") == "P", -F.col("o_custkey")).otherwise(F.col("o_custkey"))
    orders = table(spark, sf_dir, "orders").select(lost.alias("custkey"), "o_orderkey", "o_totalprice")
    return customers, orders


SIDES_SQL = """WITH c AS (SELECT CASE WHEN c_acctbal >= 0 THEN c_custkey END AS custkey, c_name FROM customer),
o AS (SELECT CASE WHEN o_orderstatus = 'P' THEN -o_custkey ELSE o_custkey END AS custkey, o_orderkey, o_totalprice FROM orders) """


def _kind_sql(kind: str) -> str:
    return SIDES_SQL + f"SELECT custkey, c_name, o_orderkey, o_totalprice FROM c {kind} JOIN o USING (custkey)"


@query("join_inner", _kind_sql("INNER"))
def join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, orders = _sides(spark, sf_dir)
    return customers.join(orders, "custkey", "inner")


@query("join_left", _kind_sql("LEFT"))
def join_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, orders = _sides(spark, sf_dir)
    return customers.join(orders, "custkey", "left")


@query("join_right", _kind_sql("RIGHT"))
def join_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, orders = _sides(spark, sf_dir)
    return customers.join(orders, "custkey", "right")


@query("join_full", _kind_sql("FULL"))
def join_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return full_join(*_sides(spark, sf_dir), ["custkey"])


@query(
    "join_inner_expr",
    """SELECT s_suppkey, s_name, n_name, r_name FROM supplier
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def join_inner_expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier")
    nations, regions = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        suppliers.join(nations, suppliers.s_nationkey == nations.n_nationkey, "inner")
        .drop("n_nationkey")
        .join(regions, nations.n_regionkey == regions.r_regionkey)
        .select("s_suppkey", "s_name", "n_name", "r_name")
    )


@query(
    "join_anti",
    SIDES_SQL + "SELECT custkey, c_name FROM c WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.custkey = c.custkey)",
)
def join_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, orders = _sides(spark, sf_dir)
    return customers.join(orders, "custkey", "left_anti")


@query(
    "join_semi",
    SIDES_SQL + "SELECT custkey, c_name FROM c WHERE EXISTS (SELECT 1 FROM o WHERE o.custkey = c.custkey)",
)
def join_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, orders = _sides(spark, sf_dir)
    return customers.join(orders, "custkey", "left_semi")


@query(
    "join_broadcast",
    """SELECT n_name, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS total
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name""",
)
def join_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    return plain(
        table(spark, sf_dir, "lineitem")
        .join(broadcast_checked(suppliers), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(broadcast_checked(nations), F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(price).alias("total"))
    )


@query(
    "join_multi_key",
    """SELECT l_orderkey, l_linenumber, c_custkey, s_suppkey FROM lineitem
JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey""",
)
def join_multi_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), c("l_orderkey") == c("o_orderkey"))
        .join(table(spark, sf_dir, "customer"), c("o_custkey") == c("c_custkey"))
        .join(
            table(spark, sf_dir, "supplier"),
            (c("l_suppkey") == c("s_suppkey")) & (c("c_nationkey") == c("s_nationkey")),
        )
        .select("l_orderkey", "l_linenumber", "c_custkey", "s_suppkey")
    )
