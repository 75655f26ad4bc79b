"""Whole layered runs over files, devices, readings and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf.functions.fixed_values import LANDING_COLUMNS
from lakeshelf.operators.aggregates import total_of
from lakeshelf.operators.quality import row_counts
from lakeshelf.plans import benefits, devices, readings
from lakeshelf.plans.sales_text import landing_text
from lakeshelf.queries.common import SILVER_CTE, STAMP, plain
from lakeshelf.queries.tables import EVENT_SCHEMA, _events_as_json
from lakeshelf.registry import ORACLES, query, table
from lakeshelf.session import new_path, small_tasks, store
from lakeshelf.sources.sinks import replace_partitions
from lakeshelf.streaming import files as streams

MONTH = benefits.MONTH


def _csv(spark: SparkSession, sf_dir: str) -> str:
    # Packed as exports are; a packed file is read by one task, and the balanced shuffle keeps files small.
    path = new_path(spark, "export")
    replace_partitions(
        landing_text(spark, sf_dir, by_month=True), path, MONTH, file_format="csv", already_split=True,
        header="true", sep=";", encoding="ISO-8859-1", compression="gzip",
        ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
    )
    return path


def _landed(spark: SparkSession, sf_dir: str) -> str:
    path = new_path(spark, "landing")
    replace_partitions(landing_text(spark, sf_dir, by_month=True), path, MONTH, already_split=True)
    return path


@query(
    "pipe_landing",
    f"""{SILVER_CTE} SELECT uf || '  ' AS "UF", count(*) AS "count" FROM silver GROUP BY uf""",
)
def pipe_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benefits.land(spark, _csv(spark, sf_dir), new_path(spark, "landing"))


@query("pipe_landing_total", f"{SILVER_CTE} SELECT count(*) AS total FROM silver")
def pipe_landing_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return total_of(benefits.land(spark, _csv(spark, sf_dir), new_path(spark, "landing")))


def _place_sql(kind: str) -> str:
    state = f"{kind}_sg_uf"
    return f"""{kind}_codigo || '-' || substr({state}, 1, 1) || lower(substr({state}, 2)) || '-' || {kind}_nome || '  ' AS {kind}"""


@query(
    "pipe_bronze",
    f"""{SILVER_CTE} SELECT coalesce(despacho, 'Nao Informado') || '  ' AS despacho, coalesce(sexo, '{{ñ class}}') || '  ' AS sexo,
  coalesce(clientela, '{{ñ class}}') || '  ' AS clientela, tipo_beneficio || '  ' AS tipo_beneficio, uf || '  ' AS uf,
  CASE meio_pag_codigo WHEN 'CCF' THEN 'Ccf - Conta' WHEN 'CCL' THEN 'Ccl - Loterica' WHEN 'CMG' THEN 'Cmg  -  Cartao'
    ELSE 'Out - Outro' END || '  ' AS meio_pagamento,
  CAST(banco_codigo AS VARCHAR) || '-' || banco_nome || '  ' AS banco, {_place_sql("mun_pagto")}, {_place_sql("mun_resid")},
  CAST(vl_liquido AS DOUBLE) AS vl_liquido, coalesce(ramo_atividade, '{{ñ class}}') || '  ' AS ramo_atividade,
  strftime(dt_inicio_validade, '%Y-%m-%d') AS dt_inicio_validade, CAST(especie_codigo AS VARCHAR) || '.0  ' AS especie_codigo,
  especie_descricao || '  ' AS especie_descricao, _ano_mes, 'landing' AS _source_path, '{STAMP}' AS _ingestion_ts
FROM silver""",
)
def pipe_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = ", ".join(f"`{h}` STRING" for h in LANDING_COLUMNS) + f", {MONTH} STRING"
    landing = spark.read.schema(text).parquet(_landed(spark, sf_dir))
    rows = benefits.bronze(landing, "landing", STAMP)
    path = new_path(spark, "bronze")
    replace_partitions(rows, path, MONTH, already_split=True)
    return plain(spark.read.schema(rows.schema).parquet(path))


@query(
    "pipe_silver",
    f"""{SILVER_CTE} SELECT * REPLACE (CAST(vl_liquido AS DOUBLE) AS vl_liquido,
  strftime(dt_inicio_validade, '%Y-%m-%d') AS dt_inicio_validade), 'landing' AS _source_path,
  '{STAMP}' AS _ingestion_ts, '{STAMP}' AS _silver_ts FROM silver""",
)
def pipe_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = benefits.bronze(landing_text(spark, sf_dir, by_month=True), "landing", STAMP)
    with small_tasks(spark):
        stored = store(spark, bronze, "bronze")
    rows = benefits.silver(stored, STAMP)
    path = new_path(spark, "silver")
    replace_partitions(rows, path, MONTH, already_split=True)
    return plain(spark.read.schema(rows.schema).parquet(path))


@query("pipe_gold", ORACLES["gold_kpis"])
def pipe_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing to gold through files, all months, with every rule checked before the writes."""
    paths = benefits.run(spark, _landed(spark, sf_dir), new_path(spark, "lake"), STAMP)
    kpis = spark.read.option("basePath", paths["kpis_nacionais"]).parquet(paths["kpis_nacionais"])
    return plain(kpis.withColumn(MONTH, F.col(MONTH).cast("string")))


# --- devices ------------------------------------------------------------------------


def _device_json(spark: SparkSession, sf_dir: str) -> str:
    path = new_path(spark, "telemetry")
    devices.telemetry_text(table(spark, sf_dir, "events")).write.json(path)
    return path + "/*.json"


DEVICE_CTE = """WITH landing AS (
  SELECT CASE WHEN event_type <> 'error' THEN event_id END AS id, 'u-' || user_id AS uid, user_id,
    upper(event_type) AS manufacturer, 'M-' || user_id AS model,
    CASE WHEN value < 10 THEN 'android' WHEN value < 50 THEN 'ios' ELSE 'web' END AS platform,
    CASE WHEN again THEN '1.1' ELSE '1.0' END AS version, props AS build_number, 'S-' || event_id AS serial_number,
    epoch_us(ts) // 1000 + CASE WHEN again THEN 3600000 ELSE 0 END AS ms
  FROM events CROSS JOIN (VALUES (false), (true)) t(again) WHERE NOT again OR event_type = 'click'),
silver AS (SELECT * FROM landing WHERE id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY ms DESC) = 1) """


@query(
    "dev_bronze",
    DEVICE_CTE
    + """SELECT id, uid, user_id, trim(manufacturer) AS manufacturer, version, serial_number,
  CAST(ms AS BIGINT) AS dt_current_timestamp, 'json' AS _source_format, model, platform, build_number,
  '2026-01-31 00:00:00' AS _ingestion_timestamp FROM landing""",
)
def dev_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = store(spark, devices.bronze(spark, _device_json(spark, sf_dir), STAMP), "bronze")
    tidy = {"manufacturer": F.upper(F.trim("manufacturer")), "platform": F.lower(F.trim("platform"))}
    return plain(rows.withColumns(tidy))


def _device_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = store(spark, devices.bronze(spark, _device_json(spark, sf_dir), STAMP), "bronze")
    return devices.silver(bronze)


@query(
    "dev_silver",
    DEVICE_CTE
    + """SELECT id AS device_id, uid, user_id, manufacturer, model, platform, version, build_number, serial_number,
  strftime(make_timestamp_ms(ms), '%Y-%m-%d %H:%M:%S') AS event_timestamp,
  '2026-01-31 00:00:00' AS _ingestion_timestamp FROM silver""",
)
def dev_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_device_silver(spark, sf_dir))


@query("dev_gold_one", DEVICE_CTE + "SELECT manufacturer, count(*) AS total_devices FROM silver GROUP BY 1")
def dev_gold_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return devices.device_counts(_device_silver(spark, sf_dir), "manufacturer")


@query("dev_gold_two", DEVICE_CTE + "SELECT platform, count(*) AS total_devices FROM silver GROUP BY 1")
def dev_gold_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    return devices.device_counts(_device_silver(spark, sf_dir), "platform")


@query(
    "dev_gold_cross",
    DEVICE_CTE + "SELECT manufacturer, platform, count(*) AS total_devices FROM silver GROUP BY 1, 2",
)
def dev_gold_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    return devices.device_counts(_device_silver(spark, sf_dir), "manufacturer", "platform")


@query(
    "srv_devices",
    DEVICE_CTE
    + """SELECT * FROM (SELECT 'total' AS consulta, '' AS chave, count(*) AS n FROM silver
UNION ALL SELECT 'manufacturer', manufacturer, count(*) FROM silver GROUP BY manufacturer
UNION ALL (SELECT 'android', CAST(id AS VARCHAR), 1 FROM silver WHERE platform = 'android' ORDER BY id LIMIT 100))""",
)
def srv_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    store(spark, _device_silver(spark, sf_dir), "silver").createOrReplaceTempView("dispositivos")
    return spark.sql(
        """SELECT 'total' AS consulta, '' AS chave, count(*) AS n FROM dispositivos
           UNION ALL SELECT 'manufacturer', manufacturer, count(*) FROM dispositivos GROUP BY manufacturer
           UNION ALL (SELECT 'android', CAST(device_id AS STRING) AS chave, 1L FROM dispositivos
                      WHERE platform = 'android' ORDER BY device_id LIMIT 100)"""
    )


@query(
    "dq_layer_counts",
    DEVICE_CTE
    + """SELECT layer, CAST(rows AS BIGINT) AS rows FROM (
  SELECT 'landing' AS layer, count(*) AS rows FROM landing UNION ALL SELECT 'bronze', count(*) FROM landing
  UNION ALL SELECT 'silver', count(*) FROM silver
  UNION ALL SELECT 'gold', count(DISTINCT manufacturer) FROM silver)""",
)
def dq_layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _device_json(spark, sf_dir)
    bronze = store(spark, devices.bronze(spark, source, STAMP), "bronze")
    silver = store(spark, devices.silver(bronze), "silver")
    landing = spark.read.schema(devices.DEVICE_SCHEMA).json(source)
    gold = devices.device_counts(silver, "manufacturer")
    return row_counts(landing=landing, bronze=bronze, silver=silver, gold=gold)


# --- sensor layouts --------------------------------------------------------------------


@query(
    "iot_layouts",
    """SELECT layout, 1 AS hits, count(*) AS readings, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) / count(*) AS mean_value
FROM events JOIN (VALUES ('flat'), ('arrival'), ('bucketed')) t(layout)
  ON ts >= TIMESTAMP '2024-01-05 12:19:00' AND ts <= TIMESTAMP '2024-01-20 13:01:20' GROUP BY layout""",
)
def iot_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as readings in all layouts: one id, and a mean over a time range, from each."""
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("value").cast("decimal(12,2)").alias("value"),
        F.col("ts").cast("timestamp").alias("time"),
    )
    paths = readings.write_layouts(events, new_path(spark, "layouts"))
    results = []
    for layout, path in paths.items():
        buckets = readings.BUCKETS if layout == "bucketed" else None
        wanted = spark.read.parquet(path).agg(F.max("id").alias("id")).first()["id"]
        hits = readings.point_lookup(spark, path, wanted, buckets).agg(F.count(F.lit(1)).cast("int").alias("hits"))
        mean = readings.mean_between(spark.read.parquet(path), "2024-01-05 12:19:00", "2024-01-20 13:01:20")
        results.append(row_values(layout, hits, mean))
    return results[0].unionByName(results[1]).unionByName(results[2])


def row_values(layout: str, hits: DataFrame, mean: DataFrame) -> DataFrame:
    """Two one-row aggregates beside each other, matched on the layout name."""
    tag = F.lit(layout).alias("layout")
    return hits.select(tag, "hits").join(mean.select(tag, "readings", "mean_value"), "layout")


# --- streams ------------------------------------------------------------------------------


@query("stm_complete_counts", "SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def stm_complete_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = streams.json_stream(spark, _events_as_json(spark, sf_dir), EVENT_SCHEMA, files_per_trigger=4)
    out = new_path(spark, "counts")
    running = streams.complete_tables(
        streams.running_counts(stream, "event_type"), out, new_path(spark, "offsets")
    )
    running.awaitTermination()
    return streams.latest_table(spark, out)


@query(
    "stm_append_parquet",
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, value FROM events",
)
def stm_append_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = streams.json_stream(spark, _events_as_json(spark, sf_dir), EVENT_SCHEMA, files_per_trigger=4)
    out = new_path(spark, "events")
    streams.append_parquet(stream, out, new_path(spark, "offsets")).awaitTermination()
    return spark.read.schema(EVENT_SCHEMA).parquet(out)


@query("stm_update_upsert", "SELECT user_id, count(*) AS count FROM events GROUP BY user_id")
def stm_update_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = streams.json_stream(spark, _events_as_json(spark, sf_dir), EVENT_SCHEMA, files_per_trigger=4)
    out = new_path(spark, "counts")
    running = streams.upsert_tables(
        streams.running_counts(stream, "user_id"), ["user_id"], out, new_path(spark, "offsets")
    )
    running.awaitTermination()
    return streams.latest_upserts(spark, out)
