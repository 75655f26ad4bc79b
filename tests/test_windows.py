"""Pieced windows against plain ones, with ties, NULL keys and one hot key."""

import pytest
from pyspark.sql import functions as F

from lakeshelf.operators.aggregates import lists_in_parts, salted_mean
from lakeshelf.operators.dedupe import one_per_key
from lakeshelf.operators.quantiles import discrete_quantiles
from lakeshelf.operators.windows import _has_work, add_windows, hot_keys

ALL = dict(
    row_number="rn",
    rank="rk",
    dense_rank="dr",
    lag={"before": "v", "before_id": "id"},
    lead={"after": "v"},
    running_sum={"acc": "v"},
    running_count={"seen": "v"},
)


@pytest.fixture(scope="module")
def rows(spark):
    # A third of the rows share key 1; NULL is a key; the order column has many ties and NULLs.
    i = F.col("id")
    return spark.range(3000).select(
        i,
        F.when(i < 1000, 1).when(i < 1700, F.lit(None)).otherwise(i % 300).cast("int").alias("k"),
        F.when(i % 13 == 0, F.lit(None)).otherwise(i * 7919 % 40).cast("long").alias("o"),
        F.when(i % 11 == 0, F.lit(None)).otherwise(i % 97).cast("decimal(12,2)").alias("v"),
    )


def as_set(df):
    return sorted(df.collect(), key=lambda r: r["id"])


@pytest.mark.parametrize("order", [["o"], ["-o"], ["-v", "o"]])
def test_pieces_give_what_a_plain_window_gives(rows, order):
    plain = add_windows(rows, ["k"], order, ["id"], **ALL)
    pieced = add_windows(rows, ["k"], order, ["id"], **ALL, group_rows=100)
    assert pieced.columns == plain.columns
    assert as_set(pieced) == as_set(plain)


@pytest.mark.parametrize("kind", ["decimal(12,2)", "decimal(28,10)", "int"])
def test_pieces_have_the_types_of_a_plain_window(rows, kind):
    typed = rows.withColumn("v", (F.col("v") + F.lit(0.25)).cast(kind))
    plain = add_windows(typed, ["k"], ["o"], ["id"], **ALL)
    pieced = add_windows(typed, ["k"], ["o"], ["id"], **ALL, group_rows=100)
    assert pieced.schema.simpleString() == plain.schema.simpleString()
    assert as_set(pieced) == as_set(plain)


@pytest.mark.parametrize("kind", ["double", "float"])
def test_running_sums_of_doubles_are_refused(rows, kind):
    with pytest.raises(TypeError, match="decimal"):
        add_windows(rows.withColumn("v", F.col("v").cast(kind)), ["k"], ["o"], ["id"], running_sum={"acc": "v"})


def test_work_is_told_from_the_plan_not_from_names(spark, rows, tmp_path):
    path = str(tmp_path / "Join Sort Window")
    rows.select(F.col("id").alias("Aggregate")).write.parquet(path)
    read = spark.read.parquet(path)
    assert not _has_work(read.where("Aggregate > 3").select((F.col("Aggregate") + 1).alias("Sort")))
    assert _has_work(read.select(F.udf(lambda x: x, "bigint")("Aggregate"))) and _has_work(read.distinct()) and _has_work(read.orderBy("Aggregate"))


def test_quantiles_against_sorted_values(rows):
    got = discrete_quantiles(rows, ["k"], "v", {"p10": 0.1, "p50": 0.5, "p90": 0.9, "top": 1.0})
    values = {}
    for r in rows.where("v IS NOT NULL").collect():
        values.setdefault(r["k"], []).append(r["v"])
    for r in got.collect():
        v = sorted(values.pop(r["k"]))
        want = [v[max(0, -(-q * len(v) // 10) - 1)] for q in (1, 5, 9, 10)]
        assert [r["p10"], r["p50"], r["p90"], r["top"]] == want
    assert not values


def test_input_with_work_is_computed_once(spark, rows):
    runs = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            runs.add(len(batch))
            yield batch

    add_windows(rows.mapInPandas(seen, rows.schema), ["k"], ["o"], ["id"], row_number="rn", group_rows=100).collect()
    assert runs.value == 3000


def test_equal_values_of_a_hot_key_are_split(spark):
    df = spark.range(1000).select("id", F.lit(1).alias("k"), F.lit("x").alias("v"))
    got = lists_in_parts(df, ["k"], "v", ["id"], part_items=64, group_rows=100).collect()
    assert sum(r["items"] for r in got) == 1000 and max(r["items"] for r in got) <= 64


def test_one_value_fills_a_hot_group(spark):
    df = spark.range(500).select("id", F.lit(1).alias("k"), F.lit(5).alias("o"))
    got = add_windows(df, ["k"], ["o"], ["id"], rank="rk", dense_rank="dr", row_number="rn", group_rows=20)
    assert {(r["rk"], r["dr"]) for r in got.collect()} == {(1, 1)}
    assert sorted(r["rn"] for r in got.collect()) == list(range(1, 501))


def test_hot_keys(rows):
    found = {r["k"]: r["_n"] for r in hot_keys(rows, ["k"], 500).collect()}
    # Key 1 also takes five of the spread rows.
    assert found == {1: 1004, None: 700}
    assert hot_keys(rows, ["k"], 5000) is None


def test_lists_keep_every_item_in_bounded_parts(rows):
    got = lists_in_parts(rows, ["k"], "v", ["id"], part_items=64, group_rows=100).collect()
    assert max(r["items"] for r in got) <= 64
    joined = {}
    for r in sorted(got, key=lambda r: r["part"]):
        joined.setdefault(r["k"], []).extend(r["values"])
    want = {}
    for r in rows.where("v IS NOT NULL").collect():
        want.setdefault(r["k"], []).append(r["v"])
    assert joined == {k: sorted(v) for k, v in want.items()}


def test_salted_equals_unsalted(rows):
    salted = salted_mean(rows, ["k"], "v", F.col("id"), salts=7)
    plain = rows.groupBy("k").agg(
        F.count(F.lit(1)).alias("total"),
        F.sum("v").alias("soma"),
        (F.sum("v").cast("double") / F.count("v")).alias("media"),
    )
    assert salted.exceptAll(plain).isEmpty() and plain.exceptAll(salted).isEmpty()


def test_one_per_key_is_decided_by_order_then_columns(spark):
    df = spark.createDataFrame(
        [(1, 5, "b"), (1, 5, "a"), (1, 9, "c"), (None, 1, "x"), (None, 2, "y")], "k int, o int, t string"
    )
    first = {(r["k"], r["o"], r["t"]) for r in one_per_key(df, ["k"], ["o"]).collect()}
    last = {(r["k"], r["o"], r["t"]) for r in one_per_key(df, ["k"], ["o"], keep="last").collect()}
    assert first == {(1, 5, "a"), (None, 1, "x")}
    assert last == {(1, 9, "c"), (None, 2, "y")}
