"""Selected quantiles against sorted values, sketches against true ranks, bitmaps against sets."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lakeshelf.operators.distincts import code_bitmaps, distinct_counts, merged_bitmaps
from lakeshelf.operators.quantiles import (
    RANK_ERROR, discrete_quantiles, merged_sketches, quantile_sketches, rank_errors, sketch_quantiles,
)

SHARES = {"least": 0.0, "p01": 0.01, "p25": 0.25, "p50": 0.5, "p90": 0.9, "most": 1.0}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def plain(pairs, shares=SHARES):
    values = {}
    for k, v in pairs:
        if v is not None:
            values.setdefault(k, []).append(v)
    out = {}
    for k, v in values.items():
        v = sorted(v, key=lambda x: (x != x, x))
        out[k] = [v[max(0, math.ceil(round(q * len(v), 9)) - 1)] for q in shares.values()]
    return out


def same(a, b):
    return a == b or (a != a and b != b)


@pytest.mark.parametrize("few_keys", [True, False])
@pytest.mark.parametrize("kind", ["double", "decimal(12,2)", "decimal(38,10)", "bigint", "float"])
def test_quantiles_are_those_of_the_sorted_values(spark, kind, few_keys):
    draw = random.Random(kind)
    pairs = []
    for k in (1, 2, None, 4, 5, 6):
        for _ in range(400):
            v = {1: lambda: draw.gauss(0, 100), 2: lambda: draw.choice([7.25, 7.25, -3.0]), None: lambda: 10 ** draw.uniform(-4, 7),
                 4: lambda: -(10 ** draw.uniform(-3, 6)), 5: lambda: None, 6: lambda: 5000 + draw.random() / 50}[k]()
            pairs.append((k, v))
    pairs += [(7, 0.0), (7, -0.0), (8, None), (9, 1e-9), (1, None)]
    df = spark.createDataFrame(pairs, "k int, v double").withColumn("v", F.col("v").cast(kind))
    wanted = plain([(r.k, r.v) for r in df.collect()])
    got = {r.k: list(r)[1:] for r in discrete_quantiles(df, ["k"], "v", SHARES, few_keys=few_keys).collect()}
    assert got == wanted


def test_numbers_that_are_no_numbers(spark):
    values = [float("nan"), float("inf"), float("-inf"), 1.7e308, -1.7e308, 5e-324, -5e-324, 0.0, 1.0, 1.0000000000000002]
    df = spark.createDataFrame([(1, v) for v in values * 3], "k int, v double")
    for share in (0.0, 0.05, 0.15, 0.25, 0.35, 0.45, 0.55, 0.65, 0.75, 0.85, 0.95, 1.0):
        got = discrete_quantiles(df, ["k"], "v", {"q": share}).first()["q"]
        assert same(got, plain([(1, v) for v in values * 3], {"q": share})[1][0]), share


def test_quantiles_plan_sorts_no_values_and_runs_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(20000).selectExpr("id % 3 AS k", "CAST(id * 7919 % 100000 / 100 AS DECIMAL(12,2)) AS v").write.parquet(path)
    df = spark.read.parquet(path)
    before = spark.sparkContext.statusTracker().getJobIdsForGroup()
    got = discrete_quantiles(df, ["k"], "v", {"p50": 0.5, "p90": 0.9})
    assert spark.sparkContext.statusTracker().getJobIdsForGroup() == before  # lazy: no job so far
    rows = {r.k: (float(r.p50), float(r.p90)) for r in got.collect()}
    assert rows == {k: tuple(map(float, v)) for k, v in plain([(r.k, r.v) for r in df.collect()], {"p50": 0.5, "p90": 0.9}).items()}
    text = plan(got)
    assert "SortMergeJoin" not in text and "Cartesian" not in text and "NestedLoop" not in text
    # Values that are single in their step are not counted again: the scan for that branch is gone.
    final = text.split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 2


def test_other_types_are_refused(spark):
    with pytest.raises(TypeError):
        discrete_quantiles(spark.createDataFrame([(1, "x")], "k int, v string"), ["k"], "v", {"q": 0.5})


def test_sketches_are_kept_merged_and_near(spark, tmp_path):
    draw = random.Random(2)
    rows = [(m, k, draw.lognormvariate(5, 2) if k else float(draw.randrange(4))) for m in range(6) for k in (0, 1) for _ in range(3000)]
    rows += [(0, 2, None), (1, None, 3.5)]
    df = spark.createDataFrame(rows, "m int, k int, v double")
    path = str(tmp_path / "sketches")
    quantile_sketches(df, ["m", "k"], "v").write.partitionBy("m").parquet(path)
    kept = spark.read.parquet(path)
    shares = {"p01": 0.01, "p50": 0.5, "p99": 0.99}
    for keys in (["m", "k"], ["k"], []):
        found = sketch_quantiles(merged_sketches(kept, keys), keys, shares) if keys != ["m", "k"] else sketch_quantiles(kept, keys, shares)
        if keys:
            errors = rank_errors(df, keys, "v", found, shares).collect()
            assert all(r[n] <= RANK_ERROR for r in errors for n in shares)
    totals = {r.k: r.rows for r in merged_sketches(kept, ["k"]).collect()}
    assert totals == {0: 18000, 1: 18000, None: 1}  # key 2 has no value
    assert sketch_quantiles(merged_sketches(kept, ["k"]), ["k"], shares).where("k IS NULL").first()["p50"] == 3.5


def test_rank_error_is_measured_from_the_nearer_side(spark):
    df = spark.createDataFrame([(1, float(v)) for v in range(100)], "k int, v double")
    off = rank_errors(df, ["k"], "v", spark.createDataFrame([(1, 49.0, 59.0)], "k int, a double, b double"), {"a": 0.5, "b": 0.5}).first()
    assert off["a"] == 0.0 and abs(off["b"] - 0.09) < 1e-9


def test_bitmaps_count_what_sets_hold_at_every_grain(spark, tmp_path):
    draw = random.Random(5)
    rows = [(draw.randrange(4), draw.choice(["a", "b", None]), draw.randrange(-70000, 70000), draw.choice([1, 5, 2**40, None])) for _ in range(4000)]
    rows.append((9, "c", None, None))
    df = spark.createDataFrame(rows, "m int, s string, x bigint, y bigint")
    kept = str(tmp_path / "bitmaps")
    code_bitmaps(df, ["m", "s"], {"xs": "x", "ys": "y"}).write.parquet(kept)
    bitmaps = spark.read.parquet(kept)
    for keys in (["m", "s"], ["m"], ["s"], []):
        places = [["m", "s"].index(k) for k in keys]
        wanted = {}
        for r in rows:
            held = wanted.setdefault(tuple(r[p] for p in places), (set(), set()))
            for s, v in zip(held, r[2:]):
                if v is not None:
                    s.add(v)
        table = bitmaps if keys == ["m", "s"] else merged_bitmaps(bitmaps, keys)
        got = {tuple(r)[: len(keys)]: (r.xs, r.ys) for r in distinct_counts(table, keys, ["xs", "ys"]).collect()}
        assert got == {k: (len(a), len(b)) for k, (a, b) in wanted.items() if a or b}


def test_bitmaps_need_no_expand(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS x", "id % 7 AS y")
    counted = distinct_counts(code_bitmaps(df, ["k"], {"xs": "x", "ys": "y"}), ["k"], ["xs", "ys"])
    assert "Expand" not in plan(counted) and "Expand" in plan(df.groupBy("k").agg(F.count_distinct("x"), F.count_distinct("y")))


def test_bitmaps_are_plain_hash_aggregates_of_words(spark):
    df = spark.range(-64, 6400).selectExpr("id % 2 AS k", "id AS x", "CAST(NULL AS bigint) AS y")
    bitmaps = code_bitmaps(df, ["k"], {"xs": "x", "ys": "y"})
    assert "SortAggregate" not in plan(bitmaps) and "ObjectHashAggregate" not in plan(bitmaps)
    assert bitmaps.count() == 2 * 101
    assert [tuple(r) for r in distinct_counts(merged_bitmaps(bitmaps, []), [], ["xs", "ys"]).collect()] == [(6464, 0)]
