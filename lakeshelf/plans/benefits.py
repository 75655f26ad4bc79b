"""Monthly layers over a benefits file: landing, bronze, silver, gold."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshelf.functions import clean
from lakeshelf.functions.fixed_values import (
    CATEGORY_COLUMNS,
    LANDING_COLUMNS,
    OTHER_SPECIES,
    PAYMENT_METHODS,
    REGIONS,
    SENTINELS,
    SPECIES_GROUPS,
    STATE_CODES,
    UNKNOWN_REGION,
)
from lakeshelf.functions.measures import share
from lakeshelf.operators.aggregates import frequency
from lakeshelf.operators.distincts import code_bitmaps, distinct_counts, merged_bitmaps
from lakeshelf.operators.joins import join_null_safe
from lakeshelf.operators.layout import held
from lakeshelf.operators.quality import enforce
from lakeshelf.operators.quantiles import discrete_quantiles, value_counts
from lakeshelf.sources.readers import read_delimited
from lakeshelf.sources.sinks import replace_partitions

MONTH = "_ano_mes"

# What each report reads of silver.
STATE_COLUMNS = [
    MONTH, "uf", "sg_uf", "especie_codigo", "vl_liquido", "sexo", "ramo_atividade",
    "fl_mesmo_municipio", "mun_resid_codigo", "banco_codigo",
]
SPECIES_COLUMNS = [
    MONTH, "uf", "sg_uf", "especie_codigo", "especie_descricao", "vl_liquido", "sexo",
    "ramo_atividade", "clientela", "fl_mesmo_municipio", "fl_vl_zero",
]
KPI_COLUMNS = [
    MONTH, "uf", "especie_codigo", "vl_liquido", "sexo", "ramo_atividade", "fl_mesmo_municipio",
    "fl_vl_zero", "mun_resid_codigo", "banco_codigo",
]
BANK_COLUMNS = [
    MONTH, "banco_codigo", "banco_nome", "vl_liquido", "uf", "mun_pagto_codigo", "meio_pag_codigo",
]

# The finest grains the reports share, and the columns whose different codes they count.
STATE_GROUP = [MONTH, "uf", "sg_uf", "grupo_especie"]
CELL = [*STATE_GROUP, "especie_codigo", "especie_descricao"]
CODE_COLUMNS = ["mun_resid_codigo", "banco_codigo", "especie_codigo"]


# --- landing ---------------------------------------------------------------


def land(
    spark: SparkSession, csv_path: str, landing_path: str, month: str | None = None
) -> DataFrame:
    """Raw delimited text to Parquet, everything a string; returns rows per state, most rows first.

    With ``month`` the file is one month's; without it the months are the
    partition directories of ``csv_path``.  Only the months just landed are
    counted; ``total_of`` gives their total from these counts.
    """
    raw = read_delimited(spark, csv_path)
    if month is None:
        raw = raw.withColumn(MONTH, F.col(MONTH).cast("string"))
        replace_partitions(raw, landing_path, MONTH, already_split=True)
    else:
        raw = raw.withColumn(MONTH, F.lit(month))
        replace_partitions(raw, landing_path, MONTH, [month])
    written = spark.read.schema(raw.schema).parquet(landing_path)
    if month is None:
        landed = written.join(raw.select(MONTH).distinct(), MONTH, "left_semi")
    else:
        landed = written.where(F.col(MONTH) == month)
    return frequency(landed, "UF")


# --- bronze ----------------------------------------------------------------


def bronze(landing: DataFrame, source: str, ingested_at: str, month: str | None = None) -> DataFrame:
    """Plain names, typed money and date, three metadata columns; no row is dropped."""
    readers = {"vl_liquido": clean.money, "dt_inicio_validade": clean.day}
    columns = [
        readers.get(name, lambda c: c)(F.col(f"`{header}`")).alias(name)
        for header, name in LANDING_COLUMNS.items()
    ]
    return landing.select(
        *columns,
        (F.col(MONTH) if month is None else F.lit(month)).alias(MONTH),
        F.lit(source).alias("_source_path"),
        F.lit(ingested_at).alias("_ingestion_ts"),
    )


# --- silver ----------------------------------------------------------------


def silver(bronze_rows: DataFrame, stamped_at: str) -> DataFrame:
    """Trimmed text, sentinels as NULL, composites taken apart, flags; row count kept."""

    def text(name: str) -> Column:
        trimmed = F.trim(F.col(name))
        return clean.sentinel_null(trimmed, SENTINELS) if name in CATEGORY_COLUMNS else trimmed

    bank_code, bank_name = clean.code_and_name(text("banco"))
    pay_code, pay_state, pay_name = clean.place(text("mun_pagto"))
    home_code, home_state, home_name = clean.place(text("mun_resid"))
    method = F.get(F.split(text("meio_pagamento"), r"\s+-\s+"), F.lit(0))
    method_code, method_label = clean.map_struct_lookup(method, PAYMENT_METHODS, ["code", "label"])
    value, start = F.col("vl_liquido"), F.col("dt_inicio_validade")
    columns = {
        "despacho": text("despacho"),
        "sexo": text("sexo"),
        "clientela": text("clientela"),
        "tipo_beneficio": text("tipo_beneficio"),
        "uf": text("uf"),
        "vl_liquido": value,
        "ramo_atividade": text("ramo_atividade"),
        "dt_inicio_validade": start,
        "especie_codigo": clean.whole_number(text("especie_codigo")),
        "especie_descricao": text("especie_descricao"),
        MONTH: F.col(MONTH),
        "_source_path": F.col("_source_path"),
        "_ingestion_ts": F.col("_ingestion_ts"),
        "banco_codigo": bank_code,
        "banco_nome": bank_name,
        "mun_pagto_codigo": pay_code,
        "mun_pagto_sg_uf": pay_state,
        "mun_pagto_nome": pay_name,
        "mun_resid_codigo": home_code,
        "mun_resid_sg_uf": home_state,
        "mun_resid_nome": home_name,
        "sg_uf": clean.map_lookup(text("uf"), STATE_CODES),
        "meio_pag_codigo": method_code,
        "meio_pag_descricao": method_label,
        "ano_inicio": F.year(start),
        "mes_inicio": F.month(start),
        "fl_vl_zero": clean.non_positive(value),
        "fl_mesmo_municipio": pay_code == home_code,
        "_silver_ts": F.lit(stamped_at),
    }
    return bronze_rows.select(*[c.alias(n) for n, c in columns.items()])


# --- gold ------------------------------------------------------------------


def species_group() -> Column:
    return clean.code_group(F.col("especie_codigo"), SPECIES_GROUPS, OTHER_SPECIES)


@dataclass(frozen=True)
class Counted:
    """What several reports count of the same rows, at the finest grain any of them needs; coarser ones are merged."""

    cells: DataFrame  # CELL: sums
    values: DataFrame  # STATE_GROUP: rows by coarse bucket of the value
    codes: DataFrame  # STATE_GROUP: bitmaps of the code columns


def counted_once(rows: DataFrame) -> Counted:
    """Three passes over ``rows`` for all reports; each result is bounded by codes, not by rows."""
    grouped = rows.withColumn("grupo_especie", species_group())
    return Counted(
        _cells(grouped, CELL),
        value_counts(grouped, STATE_GROUP, "vl_liquido"),
        code_bitmaps(grouped, STATE_GROUP, {c: c for c in CODE_COLUMNS}),
    )


def _cells(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sums that add up to those of coarser keys; of columns that ``rows`` lacks there are none."""
    value = F.col("vl_liquido")
    conditions = {
        "n_feminino": ("sexo", F.col("sexo") == "Feminino"),
        "n_masculino": ("sexo", F.col("sexo") == "Masculino"),
        "n_sexo_nulo": ("sexo", F.col("sexo").isNull()),
        "n_rural": ("ramo_atividade", F.col("ramo_atividade") == "Rural"),
        "n_urbano": ("clientela", F.col("clientela") == "Urbano"),
        "n_mesmo_municipio": ("fl_mesmo_municipio", F.col("fl_mesmo_municipio")),
        "n_vl_zero": ("fl_vl_zero", F.col("fl_vl_zero")),
        "n_conta": ("meio_pag_codigo", F.col("meio_pag_codigo") == "CCF"),
        "n_cartao": ("meio_pag_codigo", F.col("meio_pag_codigo") == "CMG"),
    }
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(value).alias("total"),
        F.count(value).alias("n_value"),
        F.min(value).alias("lowest"),
        F.max(value).alias("highest"),
        *[F.count_if(c).alias(name) for name, (column, c) in conditions.items() if column in rows.columns],
    )


def _n() -> Column:
    return F.sum("n")


def _total() -> Column:
    # As wide as the sum over the rows themselves.
    return F.sum("total").cast("decimal(22,2)")


def _mean() -> Column:
    """Exact decimal sum over count, so the result has no summing order."""
    return F.try_divide(F.sum("total").cast("double"), F.sum("n_value").cast("double"))


def _pct(name: str) -> Column:
    return F.round(F.lit(100.0) * F.sum(name) / _n(), 2)


def _with_quantiles(
    report: DataFrame, rows: DataFrame, keys: Sequence[str], quantiles: dict[str, float], counted: Counted | None
) -> DataFrame:
    """Exact quantiles of the value beside a report; a key without any value has NULL."""
    found = discrete_quantiles(rows, keys, "vl_liquido", quantiles, counted=counted.values if counted else None)
    return join_null_safe(report, found, keys, "left")


def _with_distincts(
    report: DataFrame, rows: DataFrame, keys: Sequence[str], codes: Mapping[str, str], counted: Counted | None
) -> DataFrame:
    """Exact distinct counts of code columns beside a report, from bitmaps: no row is expanded for each of them."""
    columns = list(codes.values())
    bitmaps = merged_bitmaps(counted.codes, keys) if counted else code_bitmaps(rows, keys, {c: c for c in columns})
    found = distinct_counts(bitmaps, keys, columns).withColumnsRenamed({c: name for name, c in codes.items()})
    return join_null_safe(report, found, keys, "left").fillna(0, list(codes))


def _state_measures(rows: DataFrame, keys: Sequence[str], counted: Counted | None) -> DataFrame:
    cells = counted.cells if counted else _cells(rows, keys)
    report = cells.groupBy(*keys).agg(
        _n().alias("qtd_beneficios"),
        _total().alias("vl_total"),
        _mean().alias("vl_medio"),
        F.min("lowest").alias("vl_minimo"),
        F.max("highest").alias("vl_maximo"),
        _pct("n_feminino").alias("pct_feminino"),
        _pct("n_masculino").alias("pct_masculino"),
        _pct("n_rural").alias("pct_rural"),
        _pct("n_mesmo_municipio").alias("pct_pagto_mesmo_municipio"),
    )
    report = _with_quantiles(report, rows, keys, {"vl_mediano": 0.5}, counted)
    codes = {"qtd_municipios_atendidos": "mun_resid_codigo", "qtd_bancos_utilizados": "banco_codigo"}
    return _with_distincts(report, rows, keys, codes, counted)


def _ranks_and_shares(report: DataFrame) -> DataFrame:
    # One row per state (and group) of a month: the window stays small at any input size.
    month = Window.partitionBy(MONTH)
    return report.withColumns(
        {
            "rank_qtd": F.dense_rank().over(month.orderBy(F.col("qtd_beneficios").desc())),
            "rank_vl_total": F.dense_rank().over(month.orderBy(F.col("vl_total").desc())),
            "pct_nacional_qtd": share(F.col("qtd_beneficios"), F.sum("qtd_beneficios").over(month)),
            "pct_nacional_valor": share(F.col("vl_total"), F.sum("vl_total").over(month)),
        }
    )


def state_table(silver_rows: DataFrame, stamped_at: str, counted: Counted | None = None) -> DataFrame:
    """State x species group x month: measures, ranks and shares of the month."""
    rows = silver_rows.withColumn("grupo_especie", species_group())
    report = _state_measures(rows, ["uf", "sg_uf", MONTH, "grupo_especie"], counted)
    return _ranks_and_shares(report).withColumn("_gold_ts", F.lit(stamped_at))


def state_total_ranks(silver_rows: DataFrame) -> DataFrame:
    """The rows, values, ranks and shares of ``state_total_table`` alone: one pass, without its other measures."""
    cells = silver_rows.groupBy("uf", "sg_uf", MONTH)
    return _ranks_and_shares(cells.agg(F.count(F.lit(1)).alias("qtd_beneficios"), F.sum("vl_liquido").alias("vl_total")))


def state_total_table(silver_rows: DataFrame, stamped_at: str, counted: Counted | None = None) -> DataFrame:
    """State x month, with the species group most rows fall in (ties: first by name)."""
    keys = ["uf", "sg_uf", MONTH]
    rows = silver_rows.withColumn("grupo_especie", species_group())
    cells = counted.cells if counted else rows.groupBy(*keys, "grupo_especie").agg(F.count(F.lit(1)).alias("n"))
    per_group = cells.groupBy(*keys, "grupo_especie").agg(_n().alias("_n"))
    top = per_group.groupBy(*keys).agg(
        F.min_by("grupo_especie", F.struct(-F.col("_n"), F.col("grupo_especie"))).alias("grupo_especie_top")
    )
    report = join_null_safe(_state_measures(rows, keys, counted), top, keys)
    return _ranks_and_shares(report).withColumn("_gold_ts", F.lit(stamped_at))


def species_table(silver_rows: DataFrame, stamped_at: str, counted: Counted | None = None) -> DataFrame:
    """Species x month: measures, the state with most rows, rank inside the group.

    One pass brings the rows down to species x state x month; distinct states
    and the dominant state follow from that small table.
    """
    rows = silver_rows.withColumn("grupo_especie", species_group())
    keys = ["especie_codigo", "especie_descricao", "grupo_especie", MONTH]
    by_state = counted.cells if counted else _cells(rows, CELL)
    exact = by_state.groupBy(*keys).agg(
        _n().alias("qtd_beneficios"),
        F.sum("total").alias("vl_total"),
        _mean().alias("vl_medio"),
        F.max("highest").alias("vl_maximo"),
        *[_pct(f"n_{k}").alias(f"pct_{k}") for k in ("feminino", "rural", "urbano", "mesmo_municipio")],
        F.count_distinct("uf").alias("qtd_ufs_atendidas"),
        F.sum("n_vl_zero").alias("qtd_vl_zero"),
    )
    median = discrete_quantiles(rows, keys, "vl_liquido", {"vl_mediano": 0.5})
    # The dominant state belongs to the code, whatever labels the code carries.
    code = ["especie_codigo", MONTH]
    top = (
        by_state.groupBy(*code, "sg_uf")
        .agg(F.sum("n").alias("n"))
        .groupBy(*code)
        .agg(F.min_by("sg_uf", F.struct(-F.col("n"), F.col("sg_uf"))).alias("uf_com_mais_beneficios"))
    )
    report = join_null_safe(join_null_safe(exact, median, keys, "left"), top, code, "left")
    in_group = Window.partitionBy(MONTH, "grupo_especie").orderBy(F.col("qtd_beneficios").desc())
    return report.withColumns(
        {"rank_no_grupo": F.dense_rank().over(in_group), "_gold_ts": F.lit(stamped_at)}
    )


def bank_table(silver_rows: DataFrame, stamped_at: str) -> DataFrame:
    """Bank x month: reach, payment methods, market shares and rank."""
    keys = ["banco_codigo", "banco_nome", MONTH]
    # Bank x place x month first: only these are expanded for the two distinct counts.
    report = _cells(silver_rows, [*keys, "uf", "mun_pagto_codigo"]).groupBy(*keys).agg(
        _n().alias("qtd_beneficios"),
        _total().alias("vl_total"),
        _mean().alias("vl_medio"),
        F.count_distinct("uf").alias("qtd_ufs_atendidas"),
        F.count_distinct("mun_pagto_codigo").alias("qtd_municipios_pagadores"),
        _pct("n_conta").alias("pct_conta_corrente"),
        _pct("n_cartao").alias("pct_cartao"),
    )
    # One row per bank of a month.
    month = Window.partitionBy(MONTH)
    return report.withColumns(
        {
            "rank_qtd": F.dense_rank().over(month.orderBy(F.col("qtd_beneficios").desc())),
            "market_share_pct": share(F.col("qtd_beneficios"), F.sum("qtd_beneficios").over(month)),
            "market_share_valor_pct": share(F.col("vl_total"), F.sum("vl_total").over(month)),
            "_gold_ts": F.lit(stamped_at),
        }
    )


def national_kpis(silver_rows: DataFrame, stamped_at: str, counted: Counted | None = None) -> DataFrame:
    """One row per month."""
    cells = counted.cells if counted else _cells(silver_rows, [MONTH, "uf"])
    report = cells.groupBy(MONTH).agg(
        _n().alias("total_beneficios"),
        F.count_distinct("uf").alias("total_ufs_atendidas"),
        _total().alias("vl_total_brasil"),
        _mean().alias("vl_medio_nacional"),
        F.max("highest").alias("vl_maximo_nacional"),
        _pct("n_feminino").alias("pct_feminino"),
        _pct("n_rural").alias("pct_rural"),
        _pct("n_mesmo_municipio").alias("pct_pagto_mesmo_municipio"),
        F.sum("n_vl_zero").alias("qtd_vl_zero"),
        F.sum("n_sexo_nulo").alias("qtd_sexo_nulo"),
    )
    report = _with_quantiles(report, silver_rows, [MONTH], {"vl_mediano_nacional": 0.5, "vl_p90_nacional": 0.9}, counted)
    codes = {
        "total_municipios_atendidos": "mun_resid_codigo", "total_especies_ativas": "especie_codigo",
        "total_bancos_pagadores": "banco_codigo",
    }
    return _with_distincts(report, silver_rows, [MONTH], codes, counted).withColumn("_gold_ts", F.lit(stamped_at))


def region_table(state_totals: DataFrame) -> DataFrame:
    """Region x month from the state totals; means weighted by rows."""
    region = clean.code_group(F.col("sg_uf"), REGIONS, UNKNOWN_REGION)
    rows = F.sum("qtd_beneficios").cast("double")

    def weighted(name: str) -> Column:
        return F.sum(F.col(name).cast("decimal(7,2)") * F.col("qtd_beneficios")).cast("double") / rows

    return state_totals.groupBy(region.alias("regiao"), MONTH).agg(
        F.count_distinct("sg_uf").alias("qtd_ufs"),
        F.sum("qtd_beneficios").alias("qtd_beneficios"),
        F.sum("vl_total").alias("vl_total"),
        (F.sum("vl_total").cast("double") / rows).alias("vl_medio_regiao"),
        weighted("pct_feminino").alias("pct_feminino_medio"),
        weighted("pct_rural").alias("pct_rural_medio"),
    )


def group_totals(species: DataFrame) -> DataFrame:
    return species.groupBy("grupo_especie").agg(
        F.sum("qtd_beneficios").alias("qtd"), F.sum("vl_total").alias("vl_total")
    )


# --- checks and the whole run ----------------------------------------------


def share_rule(name: str, report: DataFrame, column: str = "pct_nacional_qtd") -> DataFrame:
    """Worst month of ``report``: the shares of each month add up to 100, give or take 1."""
    months = report.groupBy(MONTH).agg(F.sum(F.col(column).cast("decimal(7,2)")).alias("total"))
    worst = months.agg(F.max(F.abs(F.col("total") - 100)).cast("double").alias("off"))
    return worst.select(
        F.lit(name).alias("rule"),
        F.col("off").alias("observed"),
        F.lit(1.0).alias("allowed"),
        F.coalesce(F.col("off") < 1.0, F.lit(False)).alias("passed"),
    )


def total_rule(name: str, report: DataFrame, kpis: DataFrame) -> DataFrame:
    """Worst month: rows of ``report`` against the KPI total, less than 10 apart."""
    per_month = report.groupBy(MONTH).agg(F.sum("qtd_beneficios").alias("n"))
    both = join_null_safe(kpis.select(MONTH, "total_beneficios"), per_month, [MONTH], "left")
    apart = F.abs(F.coalesce(F.col("n"), F.lit(0)) - F.col("total_beneficios"))
    return both.agg(F.max(apart).cast("double").alias("off")).select(
        F.lit(name).alias("rule"),
        F.col("off").alias("observed"),
        F.lit(10.0).alias("allowed"),
        F.coalesce(F.col("off") < 10.0, F.lit(False)).alias("passed"),
    )


def run(
    spark: SparkSession,
    landing_path: str,
    base: str,
    as_of: str,
    month: str | None = None,
    storage: StorageLevel = StorageLevel.DISK_ONLY,
) -> dict[str, str]:
    """Landing to gold for one month, or for all months in one go; returns the table paths.

    Each layer replaces its months, so a re-run leaves the same tables.  All
    gold rules are evaluated before the first gold table is written.  Silver is
    read once: the reports share the held columns.  The layers are split by month as
    their sources are, so their rows are not shuffled for the write.
    """
    paths = {
        n: f"{base}/{n}"
        for n in ("bronze", "silver", "fat_uf", "fat_uf_total", "fat_especie", "fat_banco",
                  "kpis_nacionais", "fat_regiao")
    }
    only = None if month is None else [month]
    text = ", ".join(f"`{h}` STRING" for h in LANDING_COLUMNS) + f", {MONTH} STRING"
    landing = spark.read.schema(text).parquet(landing_path)
    if month is not None:
        landing = landing.where(F.col(MONTH) == month)
    rows = bronze(landing, landing_path, as_of, month)
    replace_partitions(rows, paths["bronze"], MONTH, only, already_split=True)

    def month_of(name: str, like: DataFrame) -> DataFrame:
        rows = spark.read.schema(like.schema).parquet(paths[name])
        return rows if month is None else rows.where(F.col(MONTH) == month)

    bronze_rows = month_of("bronze", bronze(landing, landing_path, as_of, month))
    replace_partitions(silver(bronze_rows, as_of), paths["silver"], MONTH, only, already_split=True)
    silver_rows = month_of("silver", silver(bronze_rows, as_of))

    used = [*dict.fromkeys([*STATE_COLUMNS, *SPECIES_COLUMNS, *KPI_COLUMNS, *BANK_COLUMNS])]
    with held(silver_rows.select(*used), storage=storage) as (rows,):
        _gold(rows, paths, only, as_of, storage)
    return paths


def _gold(rows: DataFrame, paths: dict[str, str], only: list[str] | None, as_of: str, storage: StorageLevel) -> None:
    """All reports from one held silver and what is counted of it once, their rules, and then their writes."""
    counted = counted_once(rows)
    shared = [counted.cells, counted.values, counted.codes]
    reports = {
        "fat_uf": state_table(rows, as_of, counted),
        "fat_uf_total": state_total_table(rows, as_of, counted),
        "fat_especie": species_table(rows, as_of, counted),
        "fat_banco": bank_table(rows, as_of),
        "kpis_nacionais": national_kpis(rows, as_of, counted),
    }
    with held(*shared, *reports.values(), storage=storage) as kept:
        kept_reports = dict(zip(reports, kept[len(shared):]))
        kpis = kept_reports["kpis_nacionais"]
        enforce(
            share_rule("state shares", kept_reports["fat_uf"])
            .unionByName(share_rule("bank shares", kept_reports["fat_banco"], "market_share_pct"))
            .unionByName(total_rule("species rows", kept_reports["fat_especie"], kpis))
            .unionByName(total_rule("state rows", kept_reports["fat_uf"], kpis))
        )
        kept_reports["fat_regiao"] = region_table(kept_reports["fat_uf_total"])
        # Small independent writes: submitted together, their commits overlap.
        with ThreadPoolExecutor(len(kept_reports)) as pool:
            writes = [
                pool.submit(replace_partitions, report, paths[name], MONTH, only)
                for name, report in kept_reports.items()
            ]
            for write in writes:
                write.result()
