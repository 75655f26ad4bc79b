"""Aggregations, pivots, profiles and windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf.functions.measures import mean_of, null_counts, pct_of_rows
from lakeshelf.operators.aggregates import (
    frequency, lists_in_parts, profile, salted_mean, total_of,
)
from lakeshelf.operators.distincts import code_bitmaps, distinct_counts, merged_bitmaps
from lakeshelf.operators.quantiles import (
    RANK_ERROR, discrete_quantiles, merged_sketches, quantile_sketches, rank_errors, sketch_quantiles,
)
from lakeshelf.operators.windows import add_windows, with_group_total
from lakeshelf.queries.common import plain
from lakeshelf.registry import query, table
from lakeshelf.session import new_path
from lakeshelf.sources.sinks import write_partitioned


def money(name: str):
    return F.col(name).cast("decimal(12,2)")


def money_sql(name: str) -> str:
    return f"CAST({name} AS DECIMAL(12,2))"


PRICE_SQL = money_sql("o_totalprice")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("price", money("o_totalprice"))


@query(
    "agg_global",
    f"""SELECT count(*) AS total, count(DISTINCT o_orderpriority) AS prioridades,
  CAST(sum({PRICE_SQL}) AS DOUBLE) / count(*) AS media, min(o_totalprice) AS menor, max(o_totalprice) AS maior,
  CAST(sum({PRICE_SQL}) AS DOUBLE) AS soma FROM orders""",
)
def agg_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(
        _orders(spark, sf_dir).agg(
            F.count(F.lit(1)).alias("total"),
            F.count_distinct("o_orderpriority").alias("prioridades"),
            mean_of(F.col("price")).alias("media"),
            F.min("price").alias("menor"),
            F.max("price").alias("maior"),
            F.sum("price").alias("soma"),
        )
    )


@query(
    "agg_count_distinct",
    """SELECT l_returnflag, count(DISTINCT l_orderkey) AS pedidos, count(DISTINCT l_suppkey) AS fornecedores,
  count(DISTINCT l_partkey) AS produtos FROM lineitem GROUP BY l_returnflag""",
)
def agg_count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.count_distinct("l_orderkey").alias("pedidos"),
        F.count_distinct("l_suppkey").alias("fornecedores"),
        F.count_distinct("l_partkey").alias("produtos"),
    )


@query(
    "agg_stddev",
    """SELECT o_orderpriority, round(stddev_samp(o_totalprice), 4) AS desvio,
  round(var_samp(o_totalprice / 1000), 4) AS variancia FROM orders GROUP BY o_orderpriority""",
)
def agg_stddev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(
        F.round(F.stddev_samp("o_totalprice"), 4).alias("desvio"),
        F.round(F.var_samp(F.col("o_totalprice") / 1000), 4).alias("variancia"),
    )


@query(
    "agg_group",
    f"""SELECT o_orderpriority, count(*) AS total, CAST(sum({PRICE_SQL}) AS DOUBLE) / count(*) AS media,
  min(o_totalprice) AS menor, max(o_totalprice) AS maior, CAST(sum({PRICE_SQL}) AS DOUBLE) AS soma
FROM orders GROUP BY o_orderpriority""",
)
def agg_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = _orders(spark, sf_dir).groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("total"),
        mean_of(F.col("price")).alias("media"),
        F.min("price").alias("menor"),
        F.max("price").alias("maior"),
        F.sum("price").alias("soma"),
    )
    return plain(report.orderBy(F.col("total").desc(), "o_orderpriority"))


@query(
    "agg_group_two_keys",
    f"""SELECT o_orderpriority, o_orderstatus, count(*) AS qtd, CAST(sum({PRICE_SQL}) AS DOUBLE) AS total,
  CAST(sum({PRICE_SQL}) AS DOUBLE) / count(*) AS media FROM orders GROUP BY o_orderpriority, o_orderstatus""",
)
def agg_group_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = _orders(spark, sf_dir).groupBy("o_orderpriority", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("qtd"),
        F.sum("price").alias("total"),
        mean_of(F.col("price")).alias("media"),
    )
    return plain(report.orderBy("o_orderpriority", "o_orderstatus"))


@query(
    "agg_collect_list",
    """SELECT o_custkey, part, count(*) AS items, array_to_string(list(o_orderkey ORDER BY o_orderkey), ',') AS pedidos
FROM (SELECT o_custkey, o_orderkey,
    (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 5 AS part FROM orders)
GROUP BY o_custkey, part""",
)
def agg_collect_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = lists_in_parts(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderkey", ["o_orderdate"], part_items=5)
    return parts.select("o_custkey", "part", "items", F.array_join("values", ",").alias("pedidos"))


@query(
    "agg_pct_condition",
    """SELECT l_linestatus, round(100.0 * sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) / count(*), 2) AS pct_devolvido,
  round(100.0 * sum(CASE WHEN l_discount = 0 THEN 1 ELSE 0 END) / count(*), 2) AS pct_sem_desconto
FROM lineitem GROUP BY l_linestatus""",
)
def agg_pct_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_linestatus").agg(
        pct_of_rows(F.col("l_returnflag") == "R").alias("pct_devolvido"),
        pct_of_rows(F.col("l_discount") == 0).alias("pct_sem_desconto"),
    )


@query(
    "agg_percentiles",
    """SELECT l_returnflag, quantile_disc(l_extendedprice, 0.5) AS mediana, quantile_disc(l_extendedprice, 0.9) AS p90
FROM lineitem GROUP BY l_returnflag""",
)
def agg_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice")
    return discrete_quantiles(lines, ["l_returnflag"], "l_extendedprice", {"mediana": 0.5, "p90": 0.9})


@query(
    "agg_sketch_percentiles",
    """SELECT l_returnflag, count(*) AS linhas, count(DISTINCT strftime(l_shipdate, '%Y%m')) AS meses,
  true AS mediana_certa, true AS p90_certo, true AS p99_certo FROM lineitem GROUP BY l_returnflag""",
)
def agg_sketch_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sketch per month and flag, kept in a table by month and merged; its estimates are held against true ranks."""
    shares = {"mediana": 0.5, "p90": 0.9, "p99": 0.99}
    month = F.date_format("l_shipdate", "yyyyMM").alias("mes")
    lines = table(spark, sf_dir, "lineitem").select(month, "l_returnflag", "l_extendedprice")
    path = new_path(spark, "sketches")
    write_partitioned(quantile_sketches(lines, ["mes", "l_returnflag"], "l_extendedprice"), path, ["mes"])
    kept = spark.read.parquet(path)
    found = sketch_quantiles(merged_sketches(kept, ["l_returnflag"]), ["l_returnflag"], shares)
    off = rank_errors(lines, ["l_returnflag"], "l_extendedprice", found, shares)
    months = kept.groupBy("l_returnflag").agg(F.sum("rows").alias("linhas"), F.count_distinct("mes").alias("meses"))
    return months.join(off, "l_returnflag").select(
        "l_returnflag", "linhas", "meses", (F.col("mediana") <= RANK_ERROR).alias("mediana_certa"),
        (F.col("p90") <= RANK_ERROR).alias("p90_certo"), (F.col("p99") <= RANK_ERROR).alias("p99_certo"),
    )


@query(
    "agg_distinct_rollup",
    """SELECT 'month' AS grain, strftime(l_shipdate, '%Y%m') AS mes, l_returnflag, count(DISTINCT l_suppkey) AS fornecedores,
  count(DISTINCT l_partkey) AS produtos, count(DISTINCT l_orderkey) AS pedidos FROM lineitem GROUP BY 2, 3
UNION ALL SELECT 'flag', NULL, l_returnflag, count(DISTINCT l_suppkey), count(DISTINCT l_partkey), count(DISTINCT l_orderkey)
  FROM lineitem GROUP BY l_returnflag
UNION ALL SELECT 'all', NULL, NULL, count(DISTINCT l_suppkey), count(DISTINCT l_partkey), count(DISTINCT l_orderkey) FROM lineitem""",
)
def agg_distinct_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact distinct codes of three columns at three grains: bitmaps of the finest are kept, and merged upwards."""
    names = {"fornecedores": "l_suppkey", "produtos": "l_partkey", "pedidos": "l_orderkey"}
    month = F.date_format("l_shipdate", "yyyyMM").alias("mes")
    lines = table(spark, sf_dir, "lineitem").select(month, "l_returnflag", *names.values())
    path = new_path(spark, "bitmaps")
    write_partitioned(code_bitmaps(lines, ["mes", "l_returnflag"], names), path, ["mes"])
    kept = spark.read.parquet(path)
    finest = distinct_counts(kept, ["mes", "l_returnflag"], names)
    flags = distinct_counts(merged_bitmaps(kept, ["l_returnflag"]), ["l_returnflag"], names)
    whole = distinct_counts(merged_bitmaps(kept, []), [], names)
    parts = {"month": finest, "flag": flags, "all": whole}
    text = F.lit(None).cast("string")
    tagged = [
        df.select(F.lit(grain).alias("grain"), *[(F.col(k).cast("string") if k in df.columns else text).alias(k) for k in ("mes", "l_returnflag")], *names)
        for grain, df in parts.items()
    ]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


@query(
    "agg_pivot_auto",
    f"""SELECT o_orderpriority, CAST(sum({PRICE_SQL}) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) AS F,
  CAST(sum({PRICE_SQL}) FILTER (WHERE o_orderstatus = 'O') AS DOUBLE) AS O,
  CAST(sum({PRICE_SQL}) FILTER (WHERE o_orderstatus = 'P') AS DOUBLE) AS P FROM orders GROUP BY o_orderpriority""",
)
def agg_pivot_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_orders(spark, sf_dir).groupBy("o_orderpriority").pivot("o_orderstatus").agg(F.sum("price")))


@query(
    "agg_pivot_list",
    """SELECT l_returnflag, CAST(sum(l_quantity) FILTER (WHERE l_linestatus = 'F') AS DOUBLE) AS F,
  CAST(sum(l_quantity) FILTER (WHERE l_linestatus = 'O') AS DOUBLE) AS O FROM lineitem GROUP BY l_returnflag""",
)
def agg_pivot_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.sum(money("l_quantity"))
    return plain(
        table(spark, sf_dir, "lineitem").groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).agg(quantity)
    )


@query(
    "agg_salted",
    f"""SELECT l_returnflag, count(*) AS total, CAST(sum({money_sql('l_extendedprice')}) AS DOUBLE) AS soma,
  CAST(sum({money_sql('l_extendedprice')}) AS DOUBLE) / count(*) AS media FROM lineitem GROUP BY l_returnflag""",
)
def agg_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").withColumn("price", money("l_extendedprice"))
    return plain(salted_mean(rows, ["l_returnflag"], "price", F.col("l_orderkey")))


@query("agg_total_from_groups", "SELECT CAST(count(*) AS BIGINT) AS total FROM orders")
def agg_total_from_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return total_of(frequency(table(spark, sf_dir, "orders"), "o_orderstatus"))


@query("agg_frequency", "SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY ALL")
def agg_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency(table(spark, sf_dir, "customer"), "c_mktsegment", "c_nationkey", name="n")


@query(
    "sql_group_round",
    f"""SELECT o_orderpriority, count(*) AS total,
  round(CAST(sum({PRICE_SQL}) AS DOUBLE) / count(*), 2) AS media, max(o_totalprice) AS maior
FROM orders WHERE o_totalprice IS NOT NULL GROUP BY o_orderpriority""",
)
def sql_group_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "orders").createOrReplaceTempView("pedidos")
    return spark.sql(
        """SELECT o_orderpriority, count(*) AS total,
             round(CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) / count(*), 2) AS media,
             max(o_totalprice) AS maior
           FROM pedidos WHERE o_totalprice IS NOT NULL
           GROUP BY o_orderpriority ORDER BY media DESC"""
    )


# --- profiles --------------------------------------------------------------------


def _holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with NULL where the balance is negative or the segment is HOUSEHOLD."""
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_mktsegment")).alias("segmento"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("saldo"),
    )


HOLES_SQL = """WITH h AS (SELECT c_custkey,
  CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_mktsegment END AS segmento,
  CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS saldo FROM customer) """


@query(
    "dq_null_counts",
    HOLES_SQL
    + ", n AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls, count(*) AS rows FROM h"
        for c in ("c_custkey", "segmento", "saldo")
    )
    + ") SELECT *, round(100.0 * nulls / rows, 2) AS pct FROM n",
)
def dq_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_counts(_holes(spark, sf_dir))


def _profile_sql(column: str) -> str:
    x = f"CAST({column} AS DOUBLE)"
    return f"""SELECT '{column}' AS column_name, count({column}) AS n, round(avg({x}), 6) AS mean,
  round(stddev_samp({x}), 4) AS stddev, min({x}) AS min, quantile_disc({x}, 0.25) AS p25,
  quantile_disc({x}, 0.5) AS p50, quantile_disc({x}, 0.75) AS p75, max({x}) AS max FROM lineitem"""


@query("dq_profile", " UNION ALL ".join(_profile_sql(c) for c in ("l_quantity", "l_extendedprice", "l_partkey")))
def dq_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_partkey"])
    return found.withColumns({"mean": F.round("mean", 6), "stddev": F.round("stddev", 4)})


# --- windows ----------------------------------------------------------------------


def _window_sql(function: str, name: str, order: str) -> str:
    return f"""SELECT o_orderkey, o_orderpriority, o_totalprice,
  {function} OVER (PARTITION BY o_orderpriority ORDER BY {order}) AS {name} FROM orders"""


def _prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")


@query("win_row_number", _window_sql("row_number()", "posicao", "o_totalprice DESC, o_orderkey"))
def win_row_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_windows(
        _prices(spark, sf_dir), ["o_orderpriority"], ["-o_totalprice"], ["o_orderkey"], row_number="posicao"
    )


def _thousands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices in whole thousands, so that ranks have ties."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", F.floor(F.col("o_totalprice") / 1000).alias("o_totalprice")
    )


def _rank_sql(function: str, name: str) -> str:
    return f"""SELECT o_orderkey, o_orderpriority, o_totalprice,
  {function} OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC) AS {name}
FROM (SELECT o_orderkey, o_orderpriority, CAST(floor(o_totalprice / 1000) AS BIGINT) AS o_totalprice FROM orders)"""


@query("win_rank", _rank_sql("rank()", "posicao"))
def win_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_windows(
        _thousands(spark, sf_dir), ["o_orderpriority"], ["-o_totalprice"], ["o_orderkey"], rank="posicao"
    )


@query("win_dense_rank", _rank_sql("dense_rank()", "posicao"))
def win_dense_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_windows(
        _thousands(spark, sf_dir), ["o_orderpriority"], ["-o_totalprice"], ["o_orderkey"], dense_rank="posicao"
    )


def _orders_of_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).select("o_custkey", "o_orderkey", "o_orderdate", "price")


_BY_DATE = "OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey"


@query(
    "win_lag_diff",
    f"""SELECT o_custkey, o_orderkey, CAST(lag(p) {_BY_DATE}) AS DOUBLE) AS anterior,
  CAST(p - lag(p) {_BY_DATE}) AS DOUBLE) AS diferenca FROM (SELECT *, {PRICE_SQL} AS p FROM orders)""",
)
def win_lag_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = add_windows(
        _orders_of_customer(spark, sf_dir), ["o_custkey"], ["o_orderdate"], ["o_orderkey"],
        lag={"anterior": "price"},
    )
    return plain(
        rows.select("o_custkey", "o_orderkey", "anterior", (F.col("price") - F.col("anterior")).alias("diferenca"))
    )


@query(
    "win_lead",
    f"""SELECT o_custkey, o_orderkey, CAST(lead(p) {_BY_DATE}) AS DOUBLE) AS proximo
FROM (SELECT *, {PRICE_SQL} AS p FROM orders)""",
)
def win_lead(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = add_windows(
        _orders_of_customer(spark, sf_dir), ["o_custkey"], ["o_orderdate"], ["o_orderkey"],
        lead={"proximo": "price"},
    )
    return plain(rows.select("o_custkey", "o_orderkey", "proximo"))


@query(
    "win_running",
    f"""SELECT o_custkey, o_orderkey, CAST(sum(p) {_BY_DATE} ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS acumulado,
  CAST(sum(p) {_BY_DATE} ROWS UNBOUNDED PRECEDING) AS DOUBLE)
    / CAST(count(p) {_BY_DATE} ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS media_acum
FROM (SELECT *, {PRICE_SQL} AS p FROM orders)""",
)
def win_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = add_windows(
        _orders_of_customer(spark, sf_dir), ["o_custkey"], ["o_orderdate"], ["o_orderkey"],
        running_sum={"acumulado": "price"}, running_count={"vistos": "price"},
    )
    mean = F.col("acumulado").cast("double") / F.col("vistos").cast("double")
    return plain(rows.select("o_custkey", "o_orderkey", "acumulado", mean.alias("media_acum")))


@query(
    "win_partition_share",
    f"""SELECT o_orderkey, o_custkey, CAST(t AS DOUBLE) AS total, CAST(p AS DOUBLE) / CAST(t AS DOUBLE) * 100 AS pct
FROM (SELECT *, sum(p) OVER (PARTITION BY o_custkey) AS t FROM (SELECT *, {PRICE_SQL} AS p FROM orders))""",
)
def win_partition_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_group_total(
        _orders_of_customer(spark, sf_dir), ["o_custkey"], {"total": F.sum("price")}
    )
    pct = F.col("price").cast("double") / F.col("total").cast("double") * 100
    return plain(rows.select("o_orderkey", "o_custkey", "total", pct.alias("pct")))
