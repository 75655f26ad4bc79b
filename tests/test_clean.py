"""Parsers on malformed text: NULL and never an error."""

from decimal import Decimal

from pyspark.sql import functions as F

from lakeshelf.functions import clean
from lakeshelf.functions.fixed_values import PAYMENT_METHODS, SENTINELS, STATE_CODES


def run(spark, texts, *columns):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return [tuple(r) for r in df.select(*columns).collect()]


def test_money(spark):
    got = run(spark, ["1.621,00", " 7,50 ", "abc", "", "1.2.3,4,5", None, "-3,10"], clean.money(F.col("t")))
    assert [r[0] for r in got] == [
        Decimal("1621.00"), Decimal("7.50"), None, None, None, None, Decimal("-3.10"),
    ]


def test_day(spark):
    got = run(spark, ["30/01/2026", "31/02/2026", "xx", None], clean.day(F.col("t")).cast("string"))
    assert [r[0] for r in got] == ["2026-01-30", None, None, None]


def test_whole_number(spark):
    got = run(spark, ["24.0", "24", "x", None], clean.whole_number(F.col("t")))
    assert [r[0] for r in got] == [24, 24, None, None]


def test_code_and_name(spark):
    got = run(spark, ["104-Caixa-Sul", "104", "Caixa", None], *clean.code_and_name(F.col("t")))
    assert got == [(104, "Caixa-Sul"), (104, "104"), (None, "Caixa"), (None, None)]


def test_place_keeps_dashes_and_leading_zeros(spark):
    got = run(spark, ["00012-Na-Foo-Bar", "00012", None], *clean.place(F.col("t")))
    assert got == [("00012", "NA", "Foo-Bar"), ("00012", None, "00012"), (None, None, None)]


def test_sentinels(spark):
    got = run(spark, ["{ñ class}", "Nao Informado", "", "ok", None], clean.sentinel_null(F.col("t"), SENTINELS))
    assert [r[0] for r in got] == [None, None, None, "ok", None]


def test_maps(spark):
    got = run(spark, ["São Paulo", "Nowhere", None], clean.map_lookup(F.col("t"), STATE_CODES))
    assert [r[0] for r in got] == ["SP", None, None]
    fields = clean.map_struct_lookup(F.col("t"), PAYMENT_METHODS, ["code", "label"])
    assert run(spark, ["Cmg", "Xxx"], *fields) == [("CMG", "Cartão Magnético"), (None, None)]


def test_flags(spark):
    df = spark.createDataFrame([(0,), (-1,), (5,), (None,)], "v int")
    assert [r[0] for r in df.select(clean.non_positive(F.col("v"))).collect()] == [True, True, False, False]
