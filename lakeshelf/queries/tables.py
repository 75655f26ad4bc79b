"""Sources, sinks, row mutation, versions and layout."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf.operators import versions
from lakeshelf.operators.layout import (
    bucket, compact, compact_in_place, file_stats, partition_stats, since, time_transform, truncate_number, truncate_text,
    write_bucketed,
)
from lakeshelf.operators.mutate import (
    delete, delete_from, merge, merge_into, merge_metrics, update, update_table,
)
from lakeshelf.operators.quality import reconcile
from lakeshelf.queries.common import plain
from lakeshelf.registry import query, table
from lakeshelf.session import new_path, store
from lakeshelf.sources.readers import (
    read_delimited, read_json_lines, read_partition,
)
from lakeshelf.sources.sinks import (
    append_evolving, append_table, read_evolved, register_external, replace_partitions, write_files,
    write_partitioned,
)

c = F.col
BUCKETS = 16


def _name(stem: str) -> str:
    """A catalog name of its own for each run, so that runs do not share entries."""
    return f"{stem}_{uuid.uuid4().hex}"


def _without_entry(spark: SparkSession, name: str, rows: DataFrame) -> DataFrame:
    """``rows`` of a table with a location of its own, whose catalog entry is dropped; the files stay."""
    spark.sql(f"DROP TABLE {name}")
    return rows


# --- sources ------------------------------------------------------------------


@query(
    "src_csv_strings",
    """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, 'ção ' || p_name AS p_name, p_brand,
  CAST(p_size AS VARCHAR) AS p_size FROM part""",
)
def src_csv_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "csv")
    parts = table(spark, sf_dir, "part")
    parts.select(
        "p_partkey", F.concat(F.lit("ção "), "p_name").alias("p_name"), "p_brand", "p_size"
    ).write.options(header=True, sep=";", encoding="ISO-8859-1").csv(path)
    return read_delimited(spark, path, sep=";")


@query(
    "src_csv_inferred",
    """SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_orderstatus, o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders""",
)
def src_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "csv")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", c("o_orderdate").cast("date").alias("o_orderdate")
    )
    orders.write.options(header=True, sep=",").csv(path)
    return plain(read_delimited(spark, path, sep=",", encoding="UTF-8", infer=True))


@query(
    "src_csv_sniffed",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment,
  CAST(c_nationkey AS VARCHAR) AS c_nationkey FROM customer""",
)
def src_csv_sniffed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "csv")
    table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", "c_nationkey"
    ).write.options(header=True, sep="|", encoding="ISO-8859-1").csv(path)
    return read_delimited(spark, path)


@query(
    "src_csv_dup_header",
    """SELECT CAST(p_partkey AS VARCHAR) AS chave, p_brand AS tipo1, p_type AS tipo2,
  CAST(p_size AS VARCHAR) AS tamanho FROM part""",
)
def src_csv_dup_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "csv")
    line = F.concat_ws(";", c("p_partkey").cast("string"), "p_brand", "p_type", c("p_size").cast("string"))
    # Every output file starts with the header, as files of one export do.
    first_of_file = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    lines = F.when(first_of_file, F.array(F.lit("chave;tipo;tipo;tamanho"), line)).otherwise(F.array(line))
    table(spark, sf_dir, "part").select(F.explode(lines).alias("value")).write.text(path)
    return read_delimited(spark, path, sep=";", encoding="UTF-8")


EVENT_SCHEMA = "event_id BIGINT, ts STRING, user_id BIGINT, event_type STRING, value DOUBLE"


def _events_as_json(spark: SparkSession, sf_dir: str) -> str:
    """A file for each core, so that a stream has several batches to take."""
    path = new_path(spark, "json")
    table(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "user_id", "event_type", "value"
    ).repartition(spark.sparkContext.defaultParallelism).write.json(path)
    return path


@query(
    "src_json",
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, value FROM events",
)
def src_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_json_lines(spark, _events_as_json(spark, sf_dir) + "/*.json", EVENT_SCHEMA)


@query(
    "src_json_inferred",
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, value FROM events",
)
def src_json_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_json_lines(spark, _events_as_json(spark, sf_dir))


@query("src_parquet", "SELECT l_orderkey, l_suppkey, l_quantity FROM lineitem")
def src_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")


@query("src_orc", "SELECT p_partkey, p_name, p_retailprice FROM part")
def src_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "orc")
    table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice").write.orc(path)
    return spark.read.orc(path)


def _lines_with_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", F.date_format("l_shipdate", "yyyyMM").alias("_ano_mes")
    )


@query(
    "src_partition_pruned",
    """SELECT l_orderkey, l_linenumber, l_quantity, strftime(l_shipdate, '%Y%m') AS _ano_mes FROM lineitem
WHERE strftime(l_shipdate, '%Y%m') = '199706'""",
)
def src_partition_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "months")
    rows = _lines_with_month(spark, sf_dir)
    write_partitioned(rows, path, ["_ano_mes"])
    return read_partition(spark, path, "_ano_mes", "199706", rows.schema)


SEGMENT_LABELS = [("BUILDING", "Obras", 1), ("MACHINERY", "Maquinas", 2), ("FURNITURE", "Moveis", 3)]


@query(
    "src_literal_rows",
    """SELECT rotulo, ordem, count(c_custkey) AS clientes FROM
(VALUES ('BUILDING', 'Obras', 1), ('MACHINERY', 'Maquinas', 2), ('FURNITURE', 'Moveis', 3)) t(seg, rotulo, ordem)
RIGHT JOIN customer ON c_mktsegment = seg GROUP BY rotulo, ordem""",
)
def src_literal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.createDataFrame(SEGMENT_LABELS, "seg STRING, rotulo STRING, ordem INT")
    customers = table(spark, sf_dir, "customer")
    return (
        customers.join(F.broadcast(labels), customers.c_mktsegment == labels.seg, "left")
        .groupBy("rotulo", "ordem")
        .agg(F.count("c_custkey").alias("clientes"))
    )


@query(
    "src_pandas",
    """SELECT o_orderkey, peso FROM orders
LEFT JOIN (VALUES ('1-URGENT', 10.0::DOUBLE), ('2-HIGH', 5.5::DOUBLE)) t(p, peso) ON o_orderpriority = p""",
)
def src_pandas(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = spark.createDataFrame(pd.DataFrame({"p": ["1-URGENT", "2-HIGH"], "peso": [10.0, 5.5]}))
    orders = table(spark, sf_dir, "orders")
    return orders.join(F.broadcast(weights), orders.o_orderpriority == weights.p, "left").select("o_orderkey", "peso")


@query(
    "src_range",
    """SELECT CAST(k AS BIGINT) AS k, count(l_orderkey) AS linhas
FROM range(0, (SELECT max(l_orderkey) + 1 FROM lineitem)) r(k) LEFT JOIN lineitem ON l_orderkey = k GROUP BY k""",
)
def src_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey")
    stop = lines.agg(F.max("l_orderkey").alias("m")).first()["m"] + 1
    per_order = lines.groupBy(c("l_orderkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    keys = spark.range(0, stop).select(c("id").alias("k"))
    return keys.join(per_order, "k", "left").select("k", F.coalesce("n", F.lit(0)).cast("long").alias("linhas"))


@query("src_catalog_table", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def src_catalog_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, name = new_path(spark, "table"), _name("clientes")
    table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal").write.parquet(path)
    register_external(spark, name, path, "c_custkey BIGINT, c_name STRING, c_acctbal DOUBLE")
    return _without_entry(spark, name, spark.table(name))


# --- sinks -----------------------------------------------------------------------


@query("snk_parquet_roundtrip", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def snk_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = new_path(spark, "orders")
    orders.write.parquet(path)
    orders.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@query("snk_append_twice", "SELECT c_mktsegment, 2 * count(*) AS n FROM customer GROUP BY c_mktsegment")
def snk_append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    path = new_path(spark, "customers")
    for _ in range(2):
        customers.write.mode("append").parquet(path)
    return spark.read.parquet(path).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query("snk_mode_ignore", "SELECT s_suppkey, s_name FROM supplier")
def snk_mode_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "suppliers")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    suppliers.write.mode("errorifexists").parquet(path)
    suppliers.withColumn("s_name", F.lit("changed")).write.mode("ignore").parquet(path)
    return spark.read.parquet(path)


@query(
    "snk_partitioned",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
  count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total FROM orders GROUP BY 1, 2""",
)
def snk_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "orders")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", c("o_totalprice").cast("decimal(12,2)").alias("price"),
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
    )
    write_partitioned(orders, path, ["year", "month"])
    written = spark.read.schema(orders.schema).parquet(path)
    return plain(
        written.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("total"))
    )


@query(
    "snk_replace_month",
    """SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y%m') AS _ano_mes,
  CASE WHEN strftime(l_shipdate, '%Y%m') = '199706' THEN l_quantity * 2 ELSE l_quantity END AS l_quantity FROM lineitem""",
)
def snk_replace_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "months")
    rows = _lines_with_month(spark, sf_dir)
    replace_partitions(rows, path, "_ano_mes")
    restated = rows.where("_ano_mes = '199706'").withColumn("l_quantity", c("l_quantity") * 2)
    for _ in range(2):
        replace_partitions(restated, path, "_ano_mes", only=["199706"])
    return spark.read.schema(rows.schema).parquet(path)


@query(
    "snk_coalesced",
    "SELECT l_returnflag, count(*) AS n, true AS few_files FROM lineitem GROUP BY l_returnflag",
)
def snk_coalesced(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "lines")
    most = max(1, spark.sparkContext.defaultParallelism // 2)
    write_files(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag"), path, most)
    few = file_stats(spark, path)[0] <= most
    return (
        spark.read.parquet(path)
        .groupBy("l_returnflag")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("few_files", F.lit(few))
    )


@query(
    "snk_merge_schema",
    """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS prioridade FROM orders""",
)
def snk_merge_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "orders")
    orders = table(spark, sf_dir, "orders")
    append_evolving(orders.where("o_orderstatus <> 'P'").select("o_orderkey", "o_orderstatus"), None, path)
    wider = orders.where("o_orderstatus = 'P'").select(
        "o_orderkey", "o_orderstatus", c("o_orderpriority").alias("prioridade")
    )
    append_evolving(wider, spark.read.parquet(path), path)
    return read_evolved(spark, path)


@query("snk_table_append", "SELECT k, nome FROM (SELECT c_custkey AS k, c_name AS nome FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier)")
def snk_table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _name("nomes")
    spark.sql(f"CREATE TABLE {name} (k BIGINT, nome STRING) USING parquet LOCATION '{new_path(spark, 'names')}'")
    customers = table(spark, sf_dir, "customer").select(c("c_name").alias("nome"), c("c_custkey").alias("k"))
    suppliers = table(spark, sf_dir, "supplier").select(c("s_suppkey").alias("k"), c("s_name").alias("nome"))
    append_table(customers, name)
    append_table(suppliers, name)
    return _without_entry(spark, name, spark.table(name))


@query(
    "snk_external_table",
    """SELECT strftime(l_shipdate, '%Y%m') AS _ano_mes, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS quantidade
FROM lineitem GROUP BY 1""",
)
def snk_external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, name = new_path(spark, "months"), _name("linhas")
    rows = _lines_with_month(spark, sf_dir)
    write_partitioned(rows, path, ["_ano_mes"])
    ddl = "l_orderkey BIGINT, l_linenumber INT, l_quantity DOUBLE, _ano_mes STRING"
    for _ in range(2):
        register_external(spark, name, path, ddl, ["_ano_mes"])
    report = spark.sql(
        f"""SELECT _ano_mes, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS quantidade
            FROM {name} GROUP BY _ano_mes"""
    )
    return _without_entry(spark, name, store(spark, report, "report"))


@query(
    "dq_row_reconcile",
    """SELECT CAST(count(*) AS BIGINT) AS source_rows, CAST(count(*) AS BIGINT) AS written_rows,
  CAST(0 AS BIGINT) AS removed, true AS passed FROM lineitem""",
)
def dq_row_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "months")
    rows = _lines_with_month(spark, sf_dir)
    write_partitioned(rows, path, ["_ano_mes"])
    return reconcile(rows, spark.read.schema(rows.schema).parquet(path))


# --- mutation ----------------------------------------------------------------------


@query(
    "mut_update",
    """SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN p_retailprice * 1.1::DOUBLE ELSE p_retailprice END AS p_retailprice,
  CASE WHEN p_type = 'ECONOMY' THEN CAST(floor(p_retailprice) AS INTEGER) - 5 ELSE p_size END AS p_size FROM part""",
)
def mut_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = {"p_retailprice": c("p_retailprice") * 1.1, "p_size": F.floor("p_retailprice").cast("int") - 5}
    changed = update(table(spark, sf_dir, "part"), c("p_type") == "ECONOMY", new)
    return changed.select("p_partkey", "p_retailprice", "p_size")


@query(
    "mut_delete",
    """SELECT c_custkey, saldo FROM (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS saldo FROM customer)
WHERE NOT coalesce(saldo < 3000, false)""",
)
def mut_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(c("c_acctbal") >= 0, c("c_acctbal")).alias("saldo")
    )
    return delete(rows, c("saldo") < 3000)


def _balances(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers of four segments as target; BUILDING and HOUSEHOLD customers, new balance, as source."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    target = customers.where("c_mktsegment <> 'HOUSEHOLD'")
    source = customers.where("c_mktsegment IN ('BUILDING', 'HOUSEHOLD')").withColumn(
        "c_acctbal", c("c_acctbal") + 1000
    )
    return target, source


MERGED_SQL = """SELECT c_custkey, c_mktsegment, CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD')
  THEN c_acctbal + 1000 ELSE c_acctbal END AS c_acctbal FROM customer"""


@query("mut_merge", MERGED_SQL)
def mut_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge(*_balances(spark, sf_dir), ["c_custkey"])


@query(
    "mut_merge_metrics",
    """SELECT count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS rows_updated,
  count(*) FILTER (WHERE c_mktsegment = 'HOUSEHOLD') AS rows_inserted, CAST(0 AS BIGINT) AS rows_deleted,
  count(*) FILTER (WHERE c_mktsegment IN ('BUILDING', 'HOUSEHOLD')) AS source_rows FROM customer""",
)
def mut_merge_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_metrics(*_balances(spark, sf_dir), ["c_custkey"])


def _versioned(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers in three snapshots (without HOUSEHOLD, merged, without BUILDING) and their commits."""
    target, source = _balances(spark, sf_dir)
    merged = merge(target, source, ["c_custkey"])
    without = delete(merged, c("c_mktsegment") == "BUILDING")
    rows = versions.stamped(target, 0)
    for number, snapshot in enumerate((merged, without), 1):
        rows = rows.unionByName(versions.stamped(snapshot, number))
    path = new_path(spark, "snapshots")
    write_partitioned(rows, path, [versions.SNAPSHOT])
    log = versions.commits(spark, [
        (0, 0, "2026-01-01T00:00:00Z", "WRITE"), (1, 1, "2026-01-02T00:00:00Z", "MERGE"),
        (2, 2, "2026-01-03T00:00:00Z", "DELETE"),
    ])
    return spark.read.schema(rows.schema).parquet(path), log


@query(
    "mut_as_of",
    f"""SELECT 'version 0' AS leitura, c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'
UNION ALL SELECT 'as of day 2', * FROM ({MERGED_SQL})
UNION ALL SELECT 'latest', * FROM ({MERGED_SQL}) WHERE c_mktsegment <> 'BUILDING'""",
)
def mut_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, log = _versioned(spark, sf_dir)
    reads = {
        "version 0": versions.as_of(rows, log, version=0),
        "as of day 2": versions.as_of(rows, log, moment="2026-01-02T12:00:00Z"),
        "latest": versions.as_of(rows, log),
    }
    tagged = [df.select(F.lit(name).alias("leitura"), "*") for name, df in reads.items()]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


@query(
    "mut_version_diff",
    """SELECT c_custkey, CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'added' ELSE 'changed' END AS change,
  CASE c_mktsegment WHEN 'BUILDING' THEN c_acctbal END AS antes, c_acctbal + 1000 AS depois
FROM customer WHERE c_mktsegment IN ('HOUSEHOLD', 'BUILDING')""",
)
def mut_version_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, log = _versioned(spark, sf_dir)
    changes = versions.diff(versions.as_of(rows, log, 0), versions.as_of(rows, log, 1), ["c_custkey"])
    return changes.select(
        "c_custkey", "change", c("_before.c_acctbal").alias("antes"), c("_after.c_acctbal").alias("depois")
    )


@query(
    "mut_history",
    """WITH n AS (SELECT count(*) AS a, count(*) FILTER (WHERE c_mktsegment <> 'HOUSEHOLD') AS b,
  count(*) FILTER (WHERE c_mktsegment <> 'BUILDING') AS d FROM customer)
SELECT CAST(0 AS INTEGER) AS version, '2026-01-01T00:00:00Z' AS committed_at, 'WRITE' AS operation, b AS rows FROM n
UNION ALL SELECT 1, '2026-01-02T00:00:00Z', 'MERGE', a FROM n
UNION ALL SELECT 2, '2026-01-03T00:00:00Z', 'DELETE', d FROM n
UNION ALL SELECT 3, '2026-01-04T00:00:00Z', 'RESTORE', b FROM n""",
)
def mut_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, log = _versioned(spark, sf_dir)
    return versions.change_log(rows, versions.restored(log, 0, "2026-01-04T00:00:00Z"))


@query(
    "mut_history_summary",
    """SELECT how, CAST(0 AS INTEGER) AS min_version, CAST(3 AS INTEGER) AS max_version, CAST(4 AS BIGINT) AS versions,
  'RESTORE' AS last_operation, CAST(2 AS BIGINT) AS first_two,
  (SELECT count(*) FROM customer WHERE c_mktsegment <> 'HOUSEHOLD') AS rows_of_last
FROM (VALUES ('name'), ('path')) t(how)""",
)
def mut_history_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of a table, kept as files and as a catalog table: its summary by either, and the rows of the last version."""
    rows, log = _versioned(spark, sf_dir)
    path, name = new_path(spark, "commits"), _name("commits")
    versions.restored(log, 0, "2026-01-04T00:00:00Z").write.parquet(path)
    register_external(spark, name, path, versions.COMMITS)
    logs = {"path": versions.commit_log(spark, path=path), "name": _without_entry(spark, name, versions.commit_log(spark, name=name))}
    found = []
    for how, kept in logs.items():
        first_two = versions.listed(kept, 2).agg(F.count(F.lit(1)).alias("first_two"))
        last = versions.as_of(rows, kept).agg(F.count(F.lit(1)).alias("rows_of_last"))
        parts = [df.withColumn("how", F.lit(how)) for df in (versions.summary(kept), first_two, last)]
        found.append(parts[0].join(parts[1], "how").join(parts[2], "how"))
    return found[0].unionByName(found[1])


@query("mut_restore", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'")
def mut_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, log = _versioned(spark, sf_dir)
    return versions.as_of(rows, versions.restored(log, 0, "2026-01-04T00:00:00Z"))


def _order_table(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Orders as a table split by a status whose text is escaped in folder names; NULL for status O."""
    status = F.when(c("o_orderstatus") != "O", F.concat("o_orderstatus", F.lit(": 100%/day")))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", status.alias("status"))
    path = new_path(spark, "ordertable")
    write_partitioned(orders, path, ["status"])
    return path, orders


ORDER_TABLE_SQL = """(SELECT o_orderkey, o_totalprice,
  CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus || ': 100%/day' END AS status FROM orders)"""


@query(
    "mut_update_table",
    f"""SELECT o_orderkey, CASE WHEN o_totalprice < 100000 THEN 0.0 ELSE o_totalprice END AS o_totalprice,
  CASE WHEN o_totalprice >= 100000 THEN status WHEN status IS NULL THEN 'F: 100%/day' WHEN status LIKE 'P%' THEN 'new'
  END AS status FROM {ORDER_TABLE_SQL}""",
)
def mut_update_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheap orders move: those without a status to F, those of P to a new one, those of F to none."""
    path, orders = _order_table(spark, sf_dir)
    moved = F.when(c("status").isNull(), "F: 100%/day").when(c("status").startswith("P"), "new")
    update_table(spark, path, orders.schema, "status", c("o_totalprice") < 100000, {"o_totalprice": F.lit(0.0), "status": moved})
    return spark.read.schema(orders.schema).parquet(path)


@query(
    "mut_delete_table",
    f"""SELECT o_orderkey, o_totalprice, status FROM {ORDER_TABLE_SQL}
WHERE NOT coalesce(status LIKE 'P%' OR (status LIKE 'F%' AND o_totalprice < 100000), false)""",
)
def mut_delete_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders of P go, so its folder does; cheap ones of F go."""
    path, orders = _order_table(spark, sf_dir)
    gone = c("status").startswith("P") | (c("status").startswith("F") & (c("o_totalprice") < 100000))
    delete_from(spark, path, orders.schema, "status", gone)
    return spark.read.schema(orders.schema).parquet(path)


@query(
    "mut_merge_table",
    f"""SELECT o_orderkey, CASE WHEN status LIKE 'P%' THEN -o_totalprice ELSE o_totalprice END AS o_totalprice,
  CASE WHEN status LIKE 'P%' AND o_totalprice < 100000 THEN 'F: 100%/day' WHEN status NOT LIKE 'P%' THEN status END AS status
FROM {ORDER_TABLE_SQL}
UNION ALL SELECT -1 - o_orderkey, -o_totalprice, 'new: 1/2' FROM {ORDER_TABLE_SQL} WHERE status LIKE 'P%'""",
)
def mut_merge_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of P move to F or to no status; as many new keys come in a partition of their own."""
    path, orders = _order_table(spark, sf_dir)
    changed = orders.where(c("status").startswith("P")).withColumn("o_totalprice", -c("o_totalprice"))
    moved = changed.withColumn("status", F.when(c("o_totalprice") > -100000, "F: 100%/day"))
    added = changed.withColumns({"o_orderkey": -1 - c("o_orderkey"), "status": F.lit("new: 1/2")})
    merge_into(spark, path, orders.schema, "status", moved.unionByName(added), ["o_orderkey"])
    return spark.read.schema(orders.schema).parquet(path)


@query(
    "mut_add_column",
    """SELECT p_partkey, p_name, CASE WHEN p_type = 'PROMO' THEN p_retailprice END AS peso,
  CASE WHEN p_type = 'PROMO' THEN true END AS ativo FROM part""",
)
def mut_add_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _name("produtos")
    spark.sql(
        f"CREATE TABLE {name} (p_partkey BIGINT, p_name STRING) USING parquet LOCATION '{new_path(spark, 'parts')}'"
    )
    parts = table(spark, sf_dir, "part")
    append_table(parts.where("p_type <> 'PROMO'"), name)
    spark.sql(f"ALTER TABLE {name} ADD COLUMNS (peso DOUBLE, ativo BOOLEAN)")
    promo = parts.where("p_type = 'PROMO'").withColumns({"peso": c("p_retailprice"), "ativo": F.lit(True)})
    append_table(promo, name)
    return _without_entry(spark, name, spark.table(name))


@query("mut_rename_drop", "SELECT p_partkey, p_retailprice AS preco_unitario, p_size FROM part")
def mut_rename_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice", "p_size")
    stored = store(spark, parts, "parts")
    evolved = stored.withColumnRenamed("p_retailprice", "preco_unitario").drop("p_name")
    return store(spark, evolved, "parts")


# --- layout ---------------------------------------------------------------------------


@query(
    "lay_time_transforms",
    """SELECT event_id, strftime(ts, '%Y') AS y, strftime(ts, '%Y-%m') AS m, strftime(ts, '%Y-%m-%d') AS d,
  strftime(ts, '%Y-%m-%d-%H') AS h FROM events""",
)
def lay_time_transforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = {"y": "year", "m": "month", "d": "day", "h": "hour"}
    return table(spark, sf_dir, "events").select(
        "event_id", *[time_transform(c("ts"), unit).alias(name) for name, unit in units.items()]
    )


@query(
    "lay_truncate",
    """SELECT p_partkey, substr(p_name, 1, 3) AS nome3, p_size - ((p_size % 10) + 10) % 10 AS passo FROM part""",
)
def lay_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", truncate_text(c("p_name"), 3).alias("nome3"), truncate_number(c("p_size"), 10).alias("passo")
    )


@query(
    "lay_bucket",
    "SELECT count(*) AS rows, count(DISTINCT o_custkey) AS keys, true AS in_range, true AS spread FROM orders",
)
def lay_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of buckets: all rows, a key in one bucket only, every bucket in use."""
    buckets = (
        table(spark, sf_dir, "orders")
        .groupBy(bucket(c("o_custkey"), 16).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("o_custkey").alias("keys"))
    )
    return buckets.agg(
        F.sum("rows").alias("rows"), F.sum("keys").alias("keys"), F.every(c("bucket").between(0, 15)).alias("in_range"),
        (F.count("bucket") == 16).alias("spread"),
    )


@query(
    "lay_pruned_revenue",
    """SELECT l_suppkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_quantity AS DECIMAL(6,2))) AS DOUBLE) AS total
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-02-10 00:00:00' GROUP BY l_suppkey""",
)
def lay_pruned_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "sales")
    rows = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_shipdate",
        c("l_extendedprice").cast("decimal(12,2)").alias("price"),
        c("l_quantity").cast("decimal(6,2)").alias("quantity"),
        time_transform(c("l_shipdate"), "month").alias("ship_month"),
    )
    write_partitioned(rows, path, ["ship_month"])
    written = spark.read.schema(rows.schema).parquet(path)
    recent = since(written, "l_shipdate", "ship_month", "month", "1999-02-10 00:00:00")
    return plain(recent.groupBy("l_suppkey").agg(F.sum(c("price") * c("quantity")).alias("total")))


@query(
    "lay_partition_stats",
    "SELECT strftime(l_shipdate, '%Y%m') AS _ano_mes, count(*) AS rows, true AS has_files FROM lineitem GROUP BY 1",
)
def lay_partition_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "months")
    rows = _lines_with_month(spark, sf_dir)
    write_partitioned(rows, path, ["_ano_mes"])
    stats = partition_stats(spark.read.schema(rows.schema).parquet(path), ["_ano_mes"])
    return stats.select("_ano_mes", "rows", (c("files") >= 1).alias("has_files"))


@query("lay_compact", "SELECT o_orderkey, o_custkey, true AS fewer FROM orders")
def lay_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    small, target = new_path(spark, "small-files"), new_path(spark, "compacted")
    table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").repartition(5 * spark.sparkContext.defaultParallelism).write.parquet(small)
    before, after = compact(spark, small, target)
    return spark.read.parquet(target).withColumn("fewer", F.lit(after < before))


@query(
    "lay_compact_in_place",
    """SELECT status, count(*) AS linhas, CAST(sum(o_orderkey) AS BIGINT) AS soma, true AS menos_arquivos, true AS grandes_ficam
FROM (SELECT o_orderkey, o_orderstatus || ': 1/2' AS status FROM orders) GROUP BY status""",
)
def lay_compact_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One large file and many small ones for each status; the small ones are joined, the large ones stay."""
    path, cores = new_path(spark, "orderfiles"), spark.sparkContext.defaultParallelism
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.concat("o_orderstatus", F.lit(": 1/2")).alias("status"))
    late = c("o_orderkey") % 5 == 0
    orders.where(~late).repartition("status").write.partitionBy("status").parquet(path)
    large, size = file_stats(spark, path)
    orders.where(late).repartition(4 * cores).write.mode("append").partitionBy("status").parquet(path)

    def files() -> DataFrame:
        return spark.read.schema(orders.schema).parquet(path).groupBy("status").agg(
            F.count(F.lit(1)).alias("linhas"), F.sum("o_orderkey").alias("soma"), F.collect_set("_metadata.file_name").alias("nomes")
        )

    before = store(spark, files(), "filenames")
    compact_in_place(spark, path, orders.schema, ["status"], file_bytes=max(1, 2 * size // large // 3))
    now = files().select(c("status").alias("s"), "linhas", "soma", c("nomes").alias("agora"))
    both = now.join(before.select("status", "nomes"), now["s"].eqNullSafe(c("status")))
    return both.select(
        "status", "linhas", "soma", (F.size("agora") < F.size("nomes")).alias("menos_arquivos"),
        (F.size(F.array_intersect("agora", "nomes")) >= 1).alias("grandes_ficam"),
    )


@query(
    "lay_bucketed_join",
    """SELECT o_orderkey, o_orderstatus, count(*) AS linhas, CAST(sum(CAST(l_quantity AS DECIMAL(6,2))) AS DOUBLE) AS quantidade
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_orderstatus""",
)
def lay_bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and lines as tables bucketed by the order: joined and grouped by it without a shuffle."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", c("l_quantity").cast("decimal(6,2)").alias("l_quantity"))
    sides = []
    for df, key in ((orders, "o_orderkey"), (lines, "l_orderkey")):
        name = _name("bucketed")
        write_bucketed(df, name, new_path(spark, "bucketed"), [key], BUCKETS, [key])
        sides.append(_without_entry(spark, name, spark.table(name)))
    both = sides[0].join(sides[1].hint("merge"), c("o_orderkey") == c("l_orderkey"))
    return plain(both.groupBy("o_orderkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("linhas"), F.sum("l_quantity").alias("quantidade")))


@query("lay_repartition", "SELECT 'by number' AS forma, o_orderkey FROM orders UNION ALL SELECT 'by key', o_orderkey FROM orders UNION ALL SELECT 'fewer', o_orderkey FROM orders")
def lay_repartition(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cores = spark.sparkContext.defaultParallelism
    shapes = {
        "by number": orders.repartition(cores),
        "by key": orders.repartition("o_custkey"),
        "fewer": orders.repartition(cores).coalesce(max(1, cores // 2)),
    }
    tagged = [df.select(F.lit(name).alias("forma"), "o_orderkey") for name, df in shapes.items()]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])
