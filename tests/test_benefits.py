"""The layered run on rows worked out by hand, and the plans of its reads."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeshelf.functions.fixed_values import LANDING_COLUMNS
from lakeshelf.operators.aggregates import total_of
from lakeshelf.operators.quality import QualityError
from lakeshelf.plans import benefits
from lakeshelf.queries.common import silver_rows
from lakeshelf.session import new_path
from lakeshelf.sources.sinks import replace_partitions

HEADER = list(LANDING_COLUMNS)
AS_OF = "2026-02-01T00:00:00Z"


def line(sexo="Feminino", uf="São Paulo", banco="104-Caixa-Sul", valor="1.621,00", resid="00012-Sp-Foo-Bar",
         pagto="00012-Sp-Foo-Bar", especie="87.0", ramo="Rural", meio="Ccf - Conta"):
    return ("Normal ", f"{sexo} ", "Urbano", "Tipo", f"{uf}  ", meio, f"{banco} ", pagto, resid, f" {valor}",
            ramo, "30/01/2026", especie, "Amparo ")


def landing(spark, rows, month="202601"):
    df = spark.createDataFrame(rows, ", ".join(f"`{h}` STRING" for h in HEADER))
    return df.withColumn("_ano_mes", F.lit(month))


def silver(spark, rows):
    return benefits.silver(benefits.bronze(landing(spark, rows), "src", AS_OF), AS_OF)


def test_bronze_keeps_rows_and_text(spark):
    got = benefits.bronze(landing(spark, [line(), line(valor="abc")]), "src", AS_OF, "202601")
    assert len(got.columns) == 17
    assert [r["vl_liquido"] for r in got.collect()] == [Decimal("1621.00"), None]
    assert got.first()["uf"] == "São Paulo  "


def test_silver_row(spark):
    df = silver(spark, [line()])
    assert len(df.columns) == 29
    r = df.first()
    assert (r["uf"], r["sg_uf"], r["banco_codigo"], r["banco_nome"]) == ("São Paulo", "SP", 104, "Caixa-Sul")
    assert (r["mun_pagto_codigo"], r["mun_pagto_sg_uf"], r["mun_pagto_nome"]) == ("00012", "SP", "Foo-Bar")
    assert (r["especie_codigo"], r["especie_descricao"]) == (87, "Amparo")
    assert (r["meio_pag_codigo"], r["ano_inicio"], r["mes_inicio"]) == ("CCF", 2026, 1)
    assert (r["fl_vl_zero"], r["fl_mesmo_municipio"]) == (False, True)


def test_silver_faults(spark):
    df = silver(spark, [line(sexo="{ñ class}", uf="Nowhere", valor="0,00", resid=None, meio="Xxx - y", especie="x")])
    r = df.first()
    assert (r["sexo"], r["sg_uf"], r["meio_pag_codigo"], r["especie_codigo"]) == (None, None, None, None)
    assert (r["fl_vl_zero"], r["fl_mesmo_municipio"]) == (True, None)


def test_gold_by_hand(spark):
    rows = silver(
        spark,
        [
            line(valor="100,00"),
            line(valor="300,00", sexo="Masculino"),
            line(valor="0,00", uf="Bahia", especie="1", banco="1-BB"),
            line(valor="200,00", uf="Bahia", especie="1", resid="00099-Ba-X"),
        ],
    )
    kpi = benefits.national_kpis(rows, AS_OF).first()
    assert (kpi["total_beneficios"], kpi["vl_total_brasil"], kpi["vl_medio_nacional"]) == (4, Decimal("600.00"), 150.0)
    assert (kpi["pct_feminino"], kpi["pct_pagto_mesmo_municipio"], kpi["qtd_vl_zero"]) == (75.0, 75.0, 1)
    assert (kpi["total_bancos_pagadores"], kpi["vl_mediano_nacional"]) == (2, Decimal("100.00"))
    states = {(r["sg_uf"], r["grupo_especie"]): r for r in benefits.state_table(rows, AS_OF).collect()}
    sp = states[("SP", "Amparo_BPC")]
    assert (sp["qtd_beneficios"], sp["rank_vl_total"], sp["pct_nacional_valor"]) == (2, 1, 66.67)
    totals = benefits.state_total_table(rows, AS_OF)
    assert {r["sg_uf"]: r["grupo_especie_top"] for r in totals.collect()} == {"SP": "Amparo_BPC", "BA": "Pensao"}
    regions = {r["regiao"]: r["vl_medio_regiao"] for r in benefits.region_table(totals).collect()}
    assert regions == {"Sudeste": 200.0, "Nordeste": 100.0}
    species = {r["especie_codigo"]: r for r in benefits.species_table(rows, AS_OF).collect()}
    assert (species[1]["uf_com_mais_beneficios"], species[1]["qtd_vl_zero"], species[1]["pct_mesmo_municipio"]) == ("BA", 1, 50.0)
    banks = {r["banco_codigo"]: r["market_share_pct"] for r in benefits.bank_table(rows, AS_OF).collect()}
    assert banks == {104: 75.0, 1: 25.0}


def test_top_state_tie_goes_to_the_first_code(spark):
    rows = silver(spark, [line(uf="São Paulo"), line(uf="Bahia")])
    assert benefits.species_table(rows, AS_OF).first()["uf_com_mais_beneficios"] == "BA"


def test_run_twice_and_other_month_untouched(spark):
    source, base = new_path(spark, "landing"), new_path(spark, "lake")
    for month, n in (("202601", 3), ("202602", 2)):
        replace_partitions(landing(spark, [line()] * n, month), source, "_ano_mes", [month])
    for month in ("202601", "202602", "202602"):
        paths = benefits.run(spark, source, base, AS_OF, month)
    for name in ("bronze", "silver"):
        counts = spark.read.parquet(paths[name]).groupBy("_ano_mes").count()
        assert {r["_ano_mes"]: r["count"] for r in counts.collect()} == {202601: 3, 202602: 2}
    kpis = spark.read.parquet(paths["kpis_nacionais"])
    assert {r["_ano_mes"]: r["total_beneficios"] for r in kpis.collect()} == {202601: 3, 202602: 2}


def test_broken_rule_stops_the_run_before_gold(spark, monkeypatch):
    source, base = new_path(spark, "landing"), new_path(spark, "lake")
    replace_partitions(landing(spark, [line()]), source, "_ano_mes")
    monkeypatch.setattr(
        benefits, "total_rule",
        lambda name, *_: benefits.share_rule(name, spark.sql("SELECT 1 _ano_mes, 3.0D pct_nacional_qtd")),
    )
    with pytest.raises(QualityError):
        benefits.run(spark, source, base, AS_OF)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{base}/fat_uf")


def test_landing_of_one_month(spark, tmp_path):
    names = [h if not h.startswith("Espécie") else "Espécie" for h in HEADER]
    text = "\n".join([";".join(names), ";".join(line()), ";".join(line(uf="Bahia"))]) + "\n"
    source, target = tmp_path / "export.csv", new_path(spark, "landing")
    source.write_bytes(text.encode("latin-1"))
    counts = benefits.land(spark, str(source), target, "202601")
    assert {r["UF"]: r["count"] for r in counts.collect()} == {"São Paulo  ": 1, "Bahia  ": 1}
    paths = benefits.run(spark, target, new_path(spark, "lake"), AS_OF, "202601")
    assert spark.read.parquet(paths["silver"]).where("sg_uf = 'BA' AND banco_codigo = 104").count() == 1


def test_landing_counts_only_the_month_landed(spark, tmp_path):
    names = [h if not h.startswith("Espécie") else "Espécie" for h in HEADER]
    target = new_path(spark, "landing")
    for month, states in (("202601", ["Bahia", "Bahia", "Acre"]), ("202602", ["Acre", "Bahia", "Bahia", "Bahia"])):
        source = tmp_path / f"{month}.csv"
        source.write_bytes("\n".join([";".join(names)] + [";".join(line(uf=s)) for s in states] + [""]).encode("latin-1"))
        counts = benefits.land(spark, str(source), target, month)
        want = [("Bahia  ", len(states) - 1), ("Acre  ", 1)]
        assert [tuple(r) for r in counts.collect()] == want
        assert total_of(counts).first()["total"] == len(states)


def test_gold_reads_a_held_silver(spark, monkeypatch):
    source, seen = new_path(spark, "landing"), []
    replace_partitions(landing(spark, [line()] * 3), source, "_ano_mes")
    for name in ("state_table", "state_total_table", "species_table", "bank_table", "national_kpis"):
        made = getattr(benefits, name)
        monkeypatch.setattr(benefits, name, lambda rows, *a, made=made: (seen.append(rows.is_cached), made(rows, *a))[1])
    benefits.run(spark, source, new_path(spark, "lake"), AS_OF)
    assert seen == [True] * 5


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_month_filter_prunes_partitions(spark):
    path = new_path(spark, "t")
    df = landing(spark, [line()])
    replace_partitions(df, path, "_ano_mes")
    text = plan(spark.read.schema(df.schema).parquet(path).where("_ano_mes = '202601'").select("UF"))
    assert "PartitionFilters: [isnotnull(_ano_mes" in text
    assert "ReadSchema: struct<UF:string>" in text


def test_report_reads_only_its_columns(spark):
    banks = benefits.bank_table(silver_rows(spark, "/root/testdata/sf0.001"), AS_OF)
    text = plan(banks)
    assert "l_shipdate" not in text and "o_orderpriority" not in text and "c_mktsegment" not in text


def test_no_python_in_the_layers(spark):
    text = plan(benefits.species_table(silver_rows(spark, "/root/testdata/sf0.001"), AS_OF))
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_distinct_codes_need_no_expand(spark):
    rows = silver_rows(spark, "/root/testdata/sf0.001")
    for report in (benefits.national_kpis(rows, AS_OF), benefits.state_table(rows, AS_OF), benefits.state_total_table(rows, AS_OF)):
        assert "Expand" not in plan(report)


def test_sales_text_is_rendered_after_the_shuffle_by_month(spark):
    from lakeshelf.plans.sales_text import landing_text

    made = landing_text(spark, "/root/testdata/sf0.001", by_month=True)
    above, below = made._jdf.queryExecution().optimizedPlan().toString().split("RebalancePartitions", 1)
    assert "Ccf - Conta" in above and "Especie" in above
    assert "Ccf - Conta" not in below and "Especie" not in below
    assert sorted(made.collect()) == sorted(landing_text(spark, "/root/testdata/sf0.001").collect())


def test_reports_from_what_is_counted_once_are_the_same(spark):
    rows = silver(
        spark,
        [line(valor=f"{v},{v % 7}0", uf=uf, especie=str(v % 5), banco=f"{v % 3}-B", resid=f"000{v % 4}0-Sp-X", ramo="Rural" if v % 2 else "{ñ class}")
         for v in range(40) for uf in ("Bahia", "São Paulo")] + [line(valor="abc", uf="Acre")],
    )
    counted = benefits.counted_once(rows)
    for report in (benefits.state_table, benefits.state_total_table, benefits.species_table, benefits.national_kpis):
        alone, shared = report(rows, AS_OF), report(rows, AS_OF, counted)
        assert alone.schema == shared.schema
        assert sorted(map(str, alone.collect())) == sorted(map(str, shared.collect()))


def test_banks_are_counted_before_rows_are_expanded(spark):
    text = plan(benefits.bank_table(silver_rows(spark, "/root/testdata/sf0.001"), AS_OF))
    assert "HashAggregate" in text.rsplit("Expand", 1)[1]


def test_ranks_alone_take_one_pass_over_the_sales(spark):
    from lakeshelf.queries.gold import ord_rank_filter

    text = plan(ord_rank_filter(spark, "/root/testdata/sf0.001"))
    assert "l_extendedprice" in text and "_low" not in text and "_bits" not in text


def test_a_split_write_takes_small_tasks(spark, monkeypatch):
    monkeypatch.setattr("lakeshelf.session.TASK_BYTES", 1 << 16, raising=False)
    source, target = new_path(spark, "landing"), new_path(spark, "bronze")
    landing(spark, [line()] * 80).repartition(40).write.parquet(source)
    rows = benefits.bronze(spark.read.parquet(source), "src", AS_OF)
    replace_partitions(rows, target, "_ano_mes", already_split=True)
    written = spark.read.parquet(target)
    assert written.count() == 80
    # A file for each task, where tasks of the default size read several of the files.
    assert len(written.inputFiles()) > 20


def test_a_task_of_more_months_than_open_files_writes_all(spark):
    target = new_path(spark, "months")
    rows = spark.range(0, 800, 1, 1).select("id", F.format_string("%06d", F.col("id") % 40 + 200001).alias("_ano_mes"))
    replace_partitions(rows, target, "_ano_mes", already_split=True)
    counts = spark.read.parquet(target).groupBy("_ano_mes").agg(F.count_distinct("id").alias("n")).collect()
    assert [r["n"] for r in counts] == [20] * 40


def test_small_tasks_give_the_settings_back(spark):
    from lakeshelf.session import FILES_CONF, TASK_BYTES, TASK_CONF, small_tasks

    size, split = TASK_CONF
    before = {k: spark.conf.get(k, None) for k in (*TASK_CONF, FILES_CONF)}
    spark.conf.set(split, "1m")
    try:
        with pytest.raises(ValueError), small_tasks(spark):
            assert (spark.conf.get(size), spark.conf.get(split)) == (str(TASK_BYTES), "1m")
            raise ValueError
        assert {k: spark.conf.get(k, None) for k in before} == before | {split: "1m"}
    finally:
        spark.conf.unset(split) if before[split] is None else spark.conf.set(split, before[split])
