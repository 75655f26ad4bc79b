"""Gold tables and the SQL served over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf.functions.fixed_values import (
    OTHER_SPECIES,
    REGIONS,
    SPECIES_GROUPS,
    UNKNOWN_REGION,
)
from lakeshelf.operators.quality import null_report
from lakeshelf.plans import benefits
from lakeshelf.queries.common import SILVER_CTE, STAMP, plain, silver_rows, silver_stored
from lakeshelf.registry import query


def sql_case(column: str, groups: dict, other: str) -> str:
    def text(v) -> str:
        return f"'{v}'" if isinstance(v, str) else str(v)

    whens = " ".join(
        f"WHEN {column} IN ({', '.join(map(text, values))}) THEN '{name}'"
        for name, values in groups.items()
    )
    return f"CASE {whens} ELSE '{other}' END"


GROUP_SQL = sql_case("especie_codigo", SPECIES_GROUPS, OTHER_SPECIES)
REGION_SQL = sql_case("sg_uf", REGIONS, UNKNOWN_REGION)


def pct_sql(condition: str) -> str:
    return f"round(100.0 * count(*) FILTER (WHERE {condition}) / count(*), 2)"


def _state_measures_sql(keys: str) -> str:
    return f"""SELECT {keys}, count(*) AS qtd_beneficios,
    sum(vl_liquido) AS vl_total_d,
    CAST(sum(vl_liquido) AS DOUBLE) / count(*) AS vl_medio,
    CAST(quantile_disc(vl_liquido, 0.5) AS DOUBLE) AS vl_mediano,
    CAST(min(vl_liquido) AS DOUBLE) AS vl_minimo, CAST(max(vl_liquido) AS DOUBLE) AS vl_maximo,
    {pct_sql("sexo = 'Feminino'")} AS pct_feminino,
    {pct_sql("sexo = 'Masculino'")} AS pct_masculino,
    {pct_sql("ramo_atividade = 'Rural'")} AS pct_rural,
    {pct_sql("fl_mesmo_municipio")} AS pct_pagto_mesmo_municipio,
    count(DISTINCT mun_resid_codigo) AS qtd_municipios_atendidos,
    count(DISTINCT banco_codigo) AS qtd_bancos_utilizados"""


RANKS_SQL = """CAST(vl_total_d AS DOUBLE) AS vl_total,
    CAST(dense_rank() OVER (PARTITION BY _ano_mes ORDER BY qtd_beneficios DESC) AS INTEGER) AS rank_qtd,
    CAST(dense_rank() OVER (PARTITION BY _ano_mes ORDER BY vl_total_d DESC) AS INTEGER) AS rank_vl_total,
    round(CAST(qtd_beneficios AS DOUBLE) * 100.0 / CAST(sum(qtd_beneficios) OVER (PARTITION BY _ano_mes) AS DOUBLE), 2) AS pct_nacional_qtd,
    round(CAST(vl_total_d AS DOUBLE) * 100.0 / CAST(sum(vl_total_d) OVER (PARTITION BY _ano_mes) AS DOUBLE), 2) AS pct_nacional_valor"""

STATE_SQL = f"""{SILVER_CTE},
grouped AS (SELECT *, {GROUP_SQL} AS grupo_especie FROM silver),
m AS ({_state_measures_sql("uf, sg_uf, _ano_mes, grupo_especie")}
  FROM grouped GROUP BY uf, sg_uf, _ano_mes, grupo_especie)
SELECT m.* EXCLUDE (vl_total_d), {RANKS_SQL}, '{STAMP}' AS _gold_ts FROM m"""

_TOTAL_CTES = f"""{SILVER_CTE},
grouped AS (SELECT *, {GROUP_SQL} AS grupo_especie FROM silver),
top AS (SELECT uf, sg_uf, _ano_mes, grupo_especie AS grupo_especie_top,
    row_number() OVER (PARTITION BY uf, sg_uf, _ano_mes ORDER BY count(*) DESC, grupo_especie) AS rn
  FROM grouped GROUP BY uf, sg_uf, _ano_mes, grupo_especie),
m AS ({_state_measures_sql("uf, sg_uf, _ano_mes")} FROM grouped GROUP BY uf, sg_uf, _ano_mes)"""

STATE_TOTAL_SQL = f"""{_TOTAL_CTES}
SELECT m.* EXCLUDE (vl_total_d), {RANKS_SQL}, grupo_especie_top, '{STAMP}' AS _gold_ts
FROM m JOIN top USING (uf, sg_uf, _ano_mes) WHERE top.rn = 1"""

_SPECIES_CTES = f"""{SILVER_CTE},
base AS (SELECT *, {GROUP_SQL} AS grupo_especie FROM silver),
top AS (SELECT especie_codigo, _ano_mes, sg_uf,
    row_number() OVER (PARTITION BY especie_codigo, _ano_mes ORDER BY count(*) DESC, sg_uf) AS rn
  FROM base GROUP BY especie_codigo, _ano_mes, sg_uf),
m AS (SELECT especie_codigo, especie_descricao, grupo_especie, _ano_mes,
    count(*) AS qtd_beneficios,
    CAST(sum(vl_liquido) AS DOUBLE) AS vl_total,
    CAST(sum(vl_liquido) AS DOUBLE) / count(*) AS vl_medio,
    CAST(quantile_disc(vl_liquido, 0.5) AS DOUBLE) AS vl_mediano,
    CAST(max(vl_liquido) AS DOUBLE) AS vl_maximo,
    {pct_sql("sexo = 'Feminino'")} AS pct_feminino,
    {pct_sql("ramo_atividade = 'Rural'")} AS pct_rural,
    {pct_sql("clientela = 'Urbano'")} AS pct_urbano,
    {pct_sql("fl_mesmo_municipio")} AS pct_mesmo_municipio,
    count(DISTINCT uf) AS qtd_ufs_atendidas,
    count(*) FILTER (WHERE fl_vl_zero) AS qtd_vl_zero
  FROM base GROUP BY especie_codigo, especie_descricao, grupo_especie, _ano_mes)"""

SPECIES_SQL = f"""{_SPECIES_CTES}
SELECT m.*, top.sg_uf AS uf_com_mais_beneficios,
  CAST(dense_rank() OVER (PARTITION BY m._ano_mes, grupo_especie ORDER BY qtd_beneficios DESC) AS INTEGER) AS rank_no_grupo,
  '{STAMP}' AS _gold_ts
FROM m LEFT JOIN top ON m.especie_codigo = top.especie_codigo AND m._ano_mes = top._ano_mes AND top.rn = 1"""

_BANK_CTES = f"""{SILVER_CTE},
m AS (SELECT banco_codigo, banco_nome, _ano_mes, count(*) AS qtd_beneficios,
    sum(vl_liquido) AS vl_total_d, CAST(sum(vl_liquido) AS DOUBLE) / count(*) AS vl_medio,
    count(DISTINCT uf) AS qtd_ufs_atendidas,
    count(DISTINCT mun_pagto_codigo) AS qtd_municipios_pagadores,
    {pct_sql("meio_pag_codigo = 'CCF'")} AS pct_conta_corrente,
    {pct_sql("meio_pag_codigo = 'CMG'")} AS pct_cartao
  FROM silver GROUP BY banco_codigo, banco_nome, _ano_mes),
banks AS (SELECT m.* EXCLUDE (vl_total_d), CAST(vl_total_d AS DOUBLE) AS vl_total,
    CAST(dense_rank() OVER (PARTITION BY _ano_mes ORDER BY qtd_beneficios DESC) AS INTEGER) AS rank_qtd,
    round(CAST(qtd_beneficios AS DOUBLE) * 100.0 / CAST(sum(qtd_beneficios) OVER (PARTITION BY _ano_mes) AS DOUBLE), 2) AS market_share_pct,
    round(CAST(vl_total_d AS DOUBLE) * 100.0 / CAST(sum(vl_total_d) OVER (PARTITION BY _ano_mes) AS DOUBLE), 2) AS market_share_valor_pct
  FROM m)"""

_KPI_CTES = f"""{SILVER_CTE},
kpis AS (SELECT _ano_mes, count(*) AS total_beneficios,
    count(DISTINCT uf) AS total_ufs_atendidas,
    count(DISTINCT mun_resid_codigo) AS total_municipios_atendidos,
    CAST(sum(vl_liquido) AS DOUBLE) AS vl_total_brasil,
    CAST(sum(vl_liquido) AS DOUBLE) / count(*) AS vl_medio_nacional,
    CAST(max(vl_liquido) AS DOUBLE) AS vl_maximo_nacional,
    {pct_sql("sexo = 'Feminino'")} AS pct_feminino,
    {pct_sql("ramo_atividade = 'Rural'")} AS pct_rural,
    {pct_sql("fl_mesmo_municipio")} AS pct_pagto_mesmo_municipio,
    count(DISTINCT especie_codigo) AS total_especies_ativas,
    count(DISTINCT banco_codigo) AS total_bancos_pagadores,
    count(*) FILTER (WHERE fl_vl_zero) AS qtd_vl_zero,
    count(*) FILTER (WHERE sexo IS NULL) AS qtd_sexo_nulo,
    CAST(quantile_disc(vl_liquido, 0.5) AS DOUBLE) AS vl_mediano_nacional,
    CAST(quantile_disc(vl_liquido, 0.9) AS DOUBLE) AS vl_p90_nacional
  FROM silver GROUP BY _ano_mes)"""


def _state_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_stored(spark, sf_dir, benefits.STATE_COLUMNS)


def _species_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_stored(spark, sf_dir, benefits.SPECIES_COLUMNS)


def _kpi_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_stored(spark, sf_dir, benefits.KPI_COLUMNS)


@query("gold_kpis", f"{_KPI_CTES} SELECT *, '{STAMP}' AS _gold_ts FROM kpis")
def gold_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(benefits.national_kpis(_kpi_rows(spark, sf_dir), STAMP))


@query("gold_state", STATE_SQL)
def gold_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(benefits.state_table(_state_rows(spark, sf_dir), STAMP))


@query("gold_state_total", STATE_TOTAL_SQL)
def gold_state_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(benefits.state_total_table(_state_rows(spark, sf_dir), STAMP))


@query("gold_species", SPECIES_SQL)
def gold_species(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(benefits.species_table(_species_rows(spark, sf_dir), STAMP))


@query("gold_bank", f"{_BANK_CTES} SELECT *, '{STAMP}' AS _gold_ts FROM banks")
def gold_bank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(benefits.bank_table(silver_rows(spark, sf_dir), STAMP))


@query(
    "gold_region_rollup",
    f"""{_TOTAL_CTES}
SELECT {REGION_SQL} AS regiao, _ano_mes, count(DISTINCT sg_uf) AS qtd_ufs,
  CAST(sum(qtd_beneficios) AS BIGINT) AS qtd_beneficios,
  CAST(sum(vl_total_d) AS DOUBLE) AS vl_total,
  CAST(sum(vl_total_d) AS DOUBLE) / CAST(sum(qtd_beneficios) AS DOUBLE) AS vl_medio_regiao,
  CAST(sum(CAST(pct_feminino AS DECIMAL(7,2)) * qtd_beneficios) AS DOUBLE) / CAST(sum(qtd_beneficios) AS DOUBLE) AS pct_feminino_medio,
  CAST(sum(CAST(pct_rural AS DECIMAL(7,2)) * qtd_beneficios) AS DOUBLE) / CAST(sum(qtd_beneficios) AS DOUBLE) AS pct_rural_medio
FROM m GROUP BY regiao, _ano_mes""",
)
def gold_region_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = benefits.state_total_table(_state_rows(spark, sf_dir), STAMP)
    return plain(benefits.region_table(totals))


@query(
    "gold_group_totals",
    f"""{_SPECIES_CTES}
SELECT grupo_especie, CAST(sum(qtd_beneficios) AS BIGINT) AS qtd,
  CAST(sum(CAST(vl_total AS DECIMAL(20,2))) AS DOUBLE) AS vl_total FROM m GROUP BY grupo_especie""",
)
def gold_group_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    species = benefits.species_table(_species_rows(spark, sf_dir), STAMP)
    return plain(benefits.group_totals(species))


# --- served SQL -------------------------------------------------------------


@query(
    "srv_kpis",
    f"""{_KPI_CTES} SELECT _ano_mes, total_beneficios, vl_total_brasil,
  CAST(CAST(vl_medio_nacional AS DECIMAL(10,2)) AS DOUBLE) AS vl_medio,
  vl_mediano_nacional AS vl_mediano, pct_feminino FROM kpis""",
)
def srv_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold_kpis(spark, sf_dir).createOrReplaceTempView("kpis_nacionais")
    return plain(
        spark.sql(
            """SELECT _ano_mes, total_beneficios,
                 CAST(vl_total_brasil AS DECIMAL(18,2)) AS vl_total_brasil,
                 CAST(vl_medio_nacional AS DECIMAL(10,2)) AS vl_medio,
                 CAST(vl_mediano_nacional AS DECIMAL(10,2)) AS vl_mediano,
                 pct_feminino
               FROM kpis_nacionais"""
        )
    )


@query(
    "srv_top_states",
    f"""{SILVER_CTE} SELECT uf, sg_uf, CAST(sum(vl_liquido) AS DOUBLE) AS vl_total
FROM silver GROUP BY uf, sg_uf ORDER BY sum(vl_liquido) DESC, sg_uf LIMIT 5""",
)
def srv_top_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    benefits.state_table(_state_rows(spark, sf_dir), STAMP).createOrReplaceTempView("fat_uf")
    return plain(
        spark.sql(
            """SELECT uf, sg_uf, sum(vl_total) AS vl_total FROM fat_uf
               GROUP BY uf, sg_uf ORDER BY vl_total DESC, sg_uf LIMIT 5"""
        )
    )


@query(
    "srv_top_species",
    f"""{SILVER_CTE} SELECT especie_codigo, especie_descricao, count(*) AS qtd_beneficios,
  CAST(sum(vl_liquido) AS DOUBLE) AS vl_total
FROM silver GROUP BY especie_codigo, especie_descricao
ORDER BY count(*) DESC, especie_codigo LIMIT 10""",
)
def srv_top_species(spark: SparkSession, sf_dir: str) -> DataFrame:
    benefits.species_table(_species_rows(spark, sf_dir), STAMP).createOrReplaceTempView("fat_especie")
    return plain(
        spark.sql(
            """SELECT especie_codigo, especie_descricao, sum(qtd_beneficios) AS qtd_beneficios,
                 sum(vl_total) AS vl_total
               FROM fat_especie GROUP BY especie_codigo, especie_descricao
               ORDER BY qtd_beneficios DESC, especie_codigo LIMIT 10"""
        )
    )


@query(
    "srv_banks",
    f"""{_BANK_CTES} SELECT _ano_mes, rank_qtd, banco_codigo, banco_nome, qtd_beneficios,
  market_share_pct, market_share_valor_pct FROM banks""",
)
def srv_banks(spark: SparkSession, sf_dir: str) -> DataFrame:
    benefits.bank_table(silver_rows(spark, sf_dir), STAMP).createOrReplaceTempView("fat_banco")
    return spark.sql(
        """SELECT _ano_mes, rank_qtd, banco_codigo, banco_nome, qtd_beneficios,
             market_share_pct, market_share_valor_pct
           FROM fat_banco ORDER BY _ano_mes, rank_qtd, banco_codigo"""
    )


@query(
    "srv_one_state",
    f"""{SILVER_CTE} SELECT sg_uf, _ano_mes, count(*) AS qtd_beneficios,
  CAST(sum(vl_liquido) AS DOUBLE) AS vl_total
FROM silver WHERE sg_uf = 'SP' OR sg_uf = 'RJ' GROUP BY sg_uf, _ano_mes""",
)
def srv_one_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    benefits.state_table(_state_rows(spark, sf_dir), STAMP).createOrReplaceTempView("fat_uf")
    return plain(
        spark.sql(
            """SELECT sg_uf, _ano_mes, sum(qtd_beneficios) AS qtd_beneficios, sum(vl_total) AS vl_total
               FROM fat_uf WHERE sg_uf IN ('SP', 'RJ') GROUP BY sg_uf, _ano_mes"""
        )
    )


# --- windows over reports ----------------------------------------------------


@query(
    "win_market_share",
    f"{_BANK_CTES} SELECT _ano_mes, banco_codigo, market_share_pct, market_share_valor_pct FROM banks",
)
def win_market_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    banks = benefits.bank_table(silver_rows(spark, sf_dir), STAMP)
    return banks.select("_ano_mes", "banco_codigo", "market_share_pct", "market_share_valor_pct")


@query("win_two_ranks", f"SELECT uf, _ano_mes, rank_qtd, rank_vl_total FROM ({STATE_TOTAL_SQL})")
def win_two_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = benefits.state_total_ranks(silver_rows(spark, sf_dir))
    return totals.select("uf", "_ano_mes", "rank_qtd", "rank_vl_total")


@query(
    "win_rank_in_group",
    f"SELECT especie_codigo, _ano_mes, grupo_especie, rank_no_grupo FROM ({SPECIES_SQL})",
)
def win_rank_in_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    species = benefits.species_table(_species_rows(spark, sf_dir), STAMP)
    return species.select("especie_codigo", "_ano_mes", "grupo_especie", "rank_no_grupo")


@query(
    "win_top_value",
    f"SELECT especie_codigo, _ano_mes, uf_com_mais_beneficios FROM ({SPECIES_SQL})",
)
def win_top_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    species = benefits.species_table(_species_rows(spark, sf_dir), STAMP)
    return species.select("especie_codigo", "_ano_mes", "uf_com_mais_beneficios")


@query(
    "ord_rank_filter",
    f"""SELECT _ano_mes, rank_vl_total, sg_uf, qtd_beneficios, vl_total, pct_nacional_valor
FROM ({STATE_TOTAL_SQL}) WHERE rank_vl_total <= 5""",
)
def ord_rank_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = benefits.state_total_ranks(silver_rows(spark, sf_dir)).where("rank_vl_total <= 5")
    return plain(
        totals.select(
            "_ano_mes", "rank_vl_total", "sg_uf", "qtd_beneficios", "vl_total", "pct_nacional_valor"
        ).orderBy("_ano_mes", "rank_vl_total", "sg_uf")
    )


# --- checks over gold ---------------------------------------------------------


@query(
    "dq_share_total",
    f"""SELECT 'state shares' AS rule, CAST(max(abs(total - 100)) AS DOUBLE) AS observed,
  CAST(1.0 AS DOUBLE) AS allowed, max(abs(total - 100)) < 1 AS passed
FROM (SELECT _ano_mes, sum(CAST(pct_nacional_qtd AS DECIMAL(7,2))) AS total FROM ({STATE_TOTAL_SQL}) GROUP BY _ano_mes)""",
)
def dq_share_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = benefits.state_total_ranks(silver_rows(spark, sf_dir))
    return benefits.share_rule("state shares", totals)


@query(
    "dq_cross_table",
    f"""{_SPECIES_CTES},
per AS (SELECT _ano_mes, sum(qtd_beneficios) AS n FROM m GROUP BY _ano_mes),
kpi AS (SELECT _ano_mes, count(*) AS total FROM silver GROUP BY _ano_mes)
SELECT 'species rows' AS rule, CAST(max(abs(coalesce(n, 0) - total)) AS DOUBLE) AS observed,
  CAST(10.0 AS DOUBLE) AS allowed, max(abs(coalesce(n, 0) - total)) < 10 AS passed
FROM kpi LEFT JOIN per USING (_ano_mes)""",
)
def dq_cross_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = sorted({*benefits.SPECIES_COLUMNS, *benefits.KPI_COLUMNS})
    rows = silver_stored(spark, sf_dir, columns)
    return benefits.total_rule(
        "species rows", benefits.species_table(rows, STAMP), benefits.national_kpis(rows, STAMP)
    )


_BUSINESS = [
    "despacho", "sexo", "clientela", "tipo_beneficio", "uf", "vl_liquido", "ramo_atividade",
    "dt_inicio_validade", "especie_codigo", "especie_descricao", "banco_codigo", "banco_nome",
    "mun_pagto_codigo", "mun_pagto_sg_uf", "mun_pagto_nome", "mun_resid_codigo",
    "mun_resid_sg_uf", "mun_resid_nome", "sg_uf", "meio_pag_codigo", "meio_pag_descricao",
    "ano_inicio", "mes_inicio", "fl_vl_zero", "fl_mesmo_municipio",
]


@query(
    "dq_null_report",
    SILVER_CTE
    + ", n AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls, count(*) AS rows FROM silver"
        for c in _BUSINESS
    )
    + ") SELECT column_name, nulls, rows, round(100.0 * nulls / rows, 2) AS pct FROM n"
    " ORDER BY nulls DESC, column_name LIMIT 10",
)
def dq_null_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_report(silver_rows(spark, sf_dir), _BUSINESS, 10)


@query(
    "dq_flagged_rows",
    f"""{SILVER_CTE} SELECT despacho, uf, CAST(vl_liquido AS DOUBLE) AS vl_liquido, especie_descricao,
  _ano_mes FROM silver WHERE fl_vl_zero""",
)
def dq_flagged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = silver_rows(spark, sf_dir).where("fl_vl_zero")
    return plain(rows.select("despacho", "uf", "vl_liquido", "especie_descricao", "_ano_mes"))


@query(
    "agg_count_if",
    f"""{SILVER_CTE} SELECT count(*) FILTER (WHERE NOT fl_mesmo_municipio) AS pagto_diferente,
  count(*) FILTER (WHERE fl_mesmo_municipio) AS pagto_mesmo,
  count(*) FILTER (WHERE fl_mesmo_municipio IS NULL) AS pagto_desconhecido FROM silver""",
)
def agg_count_if(spark: SparkSession, sf_dir: str) -> DataFrame:
    same = F.col("fl_mesmo_municipio")
    return silver_rows(spark, sf_dir).agg(
        F.count_if(~same).alias("pagto_diferente"),
        F.count_if(same).alias("pagto_mesmo"),
        F.count_if(same.isNull()).alias("pagto_desconhecido"),
    )
