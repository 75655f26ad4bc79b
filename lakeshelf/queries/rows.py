"""Projections, predicates, ordering, duplicates and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf.functions import clean
from lakeshelf.functions.fixed_values import OTHER_SPECIES, SPECIES_GROUPS
from lakeshelf.operators.columns import bands, rename
from lakeshelf.operators.dedupe import one_per_key
from lakeshelf.plans import readings
from lakeshelf.queries.common import plain
from lakeshelf.queries.gold import sql_case
from lakeshelf.registry import query, table
from lakeshelf.session import new_path

MONEY = "decimal(12,2)"


# --- projections -------------------------------------------------------------


@query("prj_select", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def prj_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", F.col("o_custkey"), orders.o_orderstatus)


@query("prj_alias", "SELECT c_name AS cliente, c_acctbal AS saldo, c_mktsegment AS segmento FROM customer")
def prj_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("cliente"),
        F.col("c_acctbal").alias("saldo"),
        F.col("c_mktsegment").alias("segmento"),
    )


@query(
    "prj_select_expr",
    "SELECT c_name, c_acctbal * 12 AS saldo_anual, upper(c_mktsegment) AS segmento FROM customer",
)
def prj_select_expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_name", "c_acctbal * 12 AS saldo_anual", "upper(c_mktsegment) AS segmento"
    )


@query("prj_literal", "SELECT s_suppkey, s_name, 'TableA' AS origem FROM supplier")
def prj_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "supplier").select("s_suppkey", "s_name").withColumn("origem", F.lit("TableA"))
    )


@query(
    "prj_computed",
    """SELECT l_orderkey, l_linenumber, upper(l_returnflag || l_linestatus) AS flags,
  CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) AS net,
  l_extendedprice * 0.1::DOUBLE AS bonus, 2026 - CAST(year(l_shipdate) AS INTEGER) AS age FROM lineitem""",
)
def prj_computed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    net = F.col("l_extendedprice").cast(MONEY) * (1 - F.col("l_discount").cast("decimal(4,2)"))
    return plain(
        rows.withColumns(
            {
                "flags": F.upper(F.concat("l_returnflag", "l_linestatus")),
                "net": net,
                "bonus": F.col("l_extendedprice") * 0.1,
                "age": F.lit(2026) - F.year("l_shipdate"),
            }
        ).select("l_orderkey", "l_linenumber", "flags", "net", "bonus", "age")
    )


@query("prj_rename_map", "SELECT n_nationkey AS id, n_name AS nome, n_regionkey FROM nation")
def prj_rename_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rename(
        table(spark, sf_dir, "nation"), {"n_nationkey": "id", "n_name": "nome", "not_there": "ignored"}
    )


@query("prj_drop", "SELECT p_partkey, p_name, p_brand, p_size FROM part")
def prj_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").drop("p_type", "p_retailprice", "not_there")


BALANCE_STEPS = [(0, "debt"), (2500, "low"), (7500, "fair")]


@query(
    "prj_case_bands",
    """SELECT c_custkey, CASE WHEN b IS NULL THEN 'unknown' WHEN b < 0 THEN 'debt' WHEN b < 2500 THEN 'low'
  WHEN b < 7500 THEN 'fair' ELSE 'good' END AS band,
  CASE WHEN b < 0 THEN 'debt' WHEN b < 2500 THEN 'low' WHEN b < 7500 THEN 'fair' ELSE 'good' END AS band_or_top,
  CASE WHEN b >= 7500 THEN 'yes' WHEN b >= 0 THEN 'ask' ELSE 'no' END AS credit
FROM (SELECT c_custkey, CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_acctbal END AS b FROM customer)""",
)
def prj_case_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_acctbal"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        bands(balance, BALANCE_STEPS, "good", "unknown").alias("band"),
        bands(balance, BALANCE_STEPS, "good").alias("band_or_top"),
        F.when(balance >= 7500, "yes").when(balance >= 0, "ask").otherwise("no").alias("credit"),
    )


@query(
    "prj_code_groups",
    f"SELECT p_partkey, p_size, {sql_case('p_size', SPECIES_GROUPS, OTHER_SPECIES)} AS grupo FROM part",
)
def prj_code_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    group = clean.code_group(F.col("p_size"), SPECIES_GROUPS, OTHER_SPECIES)
    return table(spark, sf_dir, "part").select("p_partkey", "p_size", group.alias("grupo"))


@query(
    "prj_casts",
    """SELECT p_partkey, CAST(p_size AS VARCHAR) AS as_text, CAST(p_size AS DOUBLE) AS as_double,
  CAST(trunc(p_retailprice) AS INTEGER) AS as_int, CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS DOUBLE) AS as_decimal,
  CAST(NULL AS INTEGER) AS bad_text FROM part""",
)
def prj_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return plain(
        table(spark, sf_dir, "part").select(
            "p_partkey",
            c("p_size").cast("string").alias("as_text"),
            c("p_size").cast("double").alias("as_double"),
            c("p_retailprice").cast("int").alias("as_int"),
            c("p_retailprice").cast("decimal(10,2)").alias("as_decimal"),
            c("p_brand").try_cast("int").alias("bad_text"),
        )
    )


@query("prj_clean_schema", "SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer")
def prj_clean_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(F.lit("  "), "c_name").alias("c_name"),
        F.concat("c_mktsegment", F.lit("   ")).alias("c_mktsegment"),
        "c_acctbal",
    )
    return padded.select(
        *[
            (F.trim(f.name) if f.dataType.simpleString() == "string" else F.col(f.name)).alias(f.name)
            for f in padded.schema
        ]
    )


# --- predicates ---------------------------------------------------------------


@query("flt_compare", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 300000")
def flt_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders").where(F.col("o_totalprice") > 300000).select("o_orderkey", "o_totalprice")
    )


@query(
    "flt_sql_string",
    "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity > 30 AND l_discount > 0.05::DOUBLE",
)
def flt_sql_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .where("l_quantity > 30 AND l_discount > 0.05D")
        .select("l_orderkey", "l_linenumber")
    )


@query(
    "flt_boolean",
    """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE ((o_orderstatus = 'F' AND o_totalprice > 100000) OR o_orderpriority = '5-LOW')
  AND NOT (o_orderstatus = 'P')""",
)
def flt_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return (
        table(spark, sf_dir, "orders")
        .where(
            (((c("o_orderstatus") == "F") & (c("o_totalprice") > 100000)) | (c("o_orderpriority") == "5-LOW"))
            & ~(c("o_orderstatus") == "P")
        )
        .select("o_orderkey", "o_orderstatus", "o_orderpriority")
    )


@query("flt_in", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def flt_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
        .select("c_custkey", "c_mktsegment")
    )


@query(
    "flt_string_match",
    """SELECT p_partkey, p_name FROM part
WHERE starts_with(p_name, 's') OR contains(p_name, 'wid') OR ends_with(p_name, 'g')""",
)
def flt_string_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("p_name")
    return (
        table(spark, sf_dir, "part")
        .where(name.startswith("s") | name.contains("wid") | name.endswith("g"))
        .select("p_partkey", "p_name")
    )


@query(
    "flt_like_rlike",
    """SELECT p_partkey, p_name, p_brand FROM part
WHERE p_name LIKE '%ring%' OR regexp_matches(p_brand, '^Brand#1[0-4]$')""",
)
def flt_like_rlike(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "part")
        .where(F.col("p_name").like("%ring%") | F.col("p_brand").rlike("^Brand#1[0-4]$"))
        .select("p_partkey", "p_name", "p_brand")
    )


@query(
    "flt_between",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 60000 AND 80000",
)
def flt_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .where(F.col("o_totalprice").between(60000, 80000))
        .select("o_orderkey", "o_totalprice")
    )


@query(
    "flt_null",
    """SELECT c_custkey, o_orderkey IS NULL AS without_order FROM customer
LEFT JOIN (SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders GROUP BY 1) o
  ON c_custkey = o_custkey AND c_acctbal >= 1000
WHERE o_orderkey IS NULL OR c_name IS NULL""",
)
def flt_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers whom no order is joined to; those of a small balance are joined to none."""
    first = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderkey").alias("o_orderkey"))
    match = (F.col("c_custkey") == F.col("o_custkey")) & (F.col("c_acctbal") >= 1000)
    rows = table(spark, sf_dir, "customer").join(first, match, "left")
    return rows.where(F.col("o_orderkey").isNull() | ~F.col("c_name").isNotNull()).select(
        "c_custkey", F.col("o_orderkey").isNull().alias("without_order")
    )


@query(
    "sql_scalar_subquery",
    """SELECT o_orderkey, o_totalprice FROM orders
WHERE CAST(o_totalprice AS DECIMAL(12,2)) > (SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) / count(*) FROM orders)""",
)
def sql_scalar_subquery(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders_view")
    return spark.sql(
        """SELECT o_orderkey, o_totalprice FROM orders_view
           WHERE CAST(o_totalprice AS DECIMAL(12,2)) >
             (SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) / count(*) FROM orders_view)
           ORDER BY o_totalprice DESC"""
    )


@query(
    "flt_point_lookup",
    """SELECT layout, o_orderkey AS id, o_totalprice AS value FROM orders
JOIN (VALUES ('flat'), ('arrival'), ('bucketed')) t(layout) ON o_orderkey = 712""",
)
def flt_point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("value"), F.col("o_orderdate").alias("time")
    )
    paths = readings.write_layouts(orders, new_path(spark, "layouts"))
    found = [
        readings.point_lookup(spark, path, 712, readings.BUCKETS if layout == "bucketed" else None)
        .select(F.lit(layout).alias("layout"), "id", "value")
        for layout, path in paths.items()
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query(
    "flt_time_range_avg",
    """SELECT count(*) AS n, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) / count(*) AS mean_value FROM events
WHERE ts >= TIMESTAMP '2024-01-05 12:19:00' AND ts <= TIMESTAMP '2024-01-20 13:01:20'""",
)
def flt_time_range_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    start = F.to_timestamp_ntz(F.lit("2024-01-05 12:19:00"))
    stop = F.to_timestamp_ntz(F.lit("2024-01-20 13:01:20"))
    value = F.col("value").cast(MONEY)
    return (
        table(spark, sf_dir, "events")
        .where((ts >= start) & (ts <= stop))
        .agg(
            F.count(F.lit(1)).alias("n"),
            (F.sum(value).cast("double") / F.count(F.lit(1))).alias("mean_value"),
        )
    )


# --- order, limit, sample -------------------------------------------------------


@query("ord_multi", "SELECT c_mktsegment, c_acctbal, c_custkey FROM customer")
def ord_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .select("c_mktsegment", "c_acctbal", "c_custkey")
        .orderBy(F.col("c_mktsegment").asc(), F.col("c_acctbal").desc(), "c_custkey")
    )


@query("ord_limit", "SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 20")
def ord_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus").orderBy("o_orderkey").limit(20)


@query("ord_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def ord_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_totalprice")
        .orderBy(F.col("o_totalprice").desc(), "o_orderkey")
        .limit(10)
    )


@query(
    "ord_sample",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 4) < '8000'",
)
def ord_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the orders by a hash threshold: the same ones however the table is split."""
    lot = F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 4)
    return table(spark, sf_dir, "orders").where(lot < "8000").select("o_orderkey", "o_orderstatus")


# --- duplicates and unions --------------------------------------------------------


@query("set_distinct", "SELECT DISTINCT md5(text) AS text_md5, lang FROM documents")
def set_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.md5("text").alias("text_md5"), "lang")
    return docs.distinct()


@query("set_drop_dup_rows", "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def set_drop_dup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag").dropDuplicates()


@query("set_dedupe_key", "SELECT l_orderkey, l_partkey, true AS de_uma_linha FROM lineitem GROUP BY l_orderkey, l_partkey")
def set_dedupe_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row of each key; which one is open, but its columns belong together: the hash beside them is its own."""
    own = F.xxhash64("l_linenumber", "l_suppkey", "l_extendedprice")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    survivors = lines.withColumn("marca", own).dropDuplicates(["l_orderkey", "l_partkey"])
    return survivors.select("l_orderkey", "l_partkey", (F.col("marca") == own).alias("de_uma_linha"))


@query(
    "set_dedupe_first",
    """SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate, l_partkey, l_suppkey,
  l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1""",
)
def set_dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("l_shipdate"),
        "l_partkey", "l_suppkey", "l_extendedprice",
    )
    return plain(one_per_key(rows, ["l_orderkey", "l_linenumber"], ["l_shipdate"]))


@query(
    "set_union",
    """SELECT c_custkey AS k, c_name AS nome, c_nationkey AS pais, NULL::VARCHAR AS marca FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey, NULL FROM supplier
UNION ALL SELECT p_partkey, p_name, NULL, p_brand FROM part""",
)
def set_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    customers = table(spark, sf_dir, "customer").select(
        c("c_custkey").alias("k"), c("c_name").alias("nome"), c("c_nationkey").alias("pais")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        c("s_nationkey").alias("pais"), c("s_name").alias("nome"), c("s_suppkey").alias("k")
    )
    parts = table(spark, sf_dir, "part").select(
        c("p_partkey").alias("k"), c("p_name").alias("nome"), c("p_brand").alias("marca")
    )
    return customers.unionByName(suppliers).unionByName(parts, allowMissingColumns=True)
