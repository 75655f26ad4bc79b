import random
from collections import Counter, defaultdict

import pytest
from llm_rows import awkward, prose, table
from pyspark.sql import functions as F

from lakeshelf.llm import mixing
from lakeshelf.llm.common import row_key


def shares(sizes, weights=(5, 2, 1), ceiling=3):
    """Targets by sharing again and again; sizes in source order."""
    total, done = sum(sizes), {}
    while True:
        open_ = [i for i in range(len(sizes)) if i not in done]
        left, weight = total - sum(done.values()), sum(weights[i % 3] for i in open_)
        if not open_:
            return [done[i] for i in range(len(sizes))]
        now = {i: left * weights[i % 3] / weight for i in open_}
        over = {i: ceiling * sizes[i] for i in open_ if now[i] >= ceiling * sizes[i]}
        if not over:
            return [done.get(i, now.get(i)) for i in range(len(sizes))]
        done |= over


@pytest.mark.parametrize("sizes", [[100, 100, 100, 100], [1, 1000, 0, 5, 900], [0, 0], [7], [1, 1, 1, 1, 10_000]])
def test_targets(spark, sizes):
    rows = [(f"s{i}" if i < len(sizes) - 1 else None, n) for i, n in enumerate(sizes)]
    found = mixing.targets(spark, spark.createDataFrame(rows, "source string, source_size long")).collect()
    got = {r.source: r.target for r in found}
    assert [got[s] for s, _ in rows] == pytest.approx(shares(sizes))


def corpus():
    draw = random.Random(6)
    rows = awkward()
    for s, n in (("hot", 900), ("mid", 200), ("small", 60), ("Über", 80)):
        rows += [(1000 * len(s) + i, prose(draw.randrange(10**6), int(draw.paretovariate(1.2) * 10) % 400), s) for i in range(n)]
    return rows


def test_mix(spark):
    rows = corpus()
    docs = table(spark, rows, ["size", "rank", "of", "step", "copies"])
    found = mixing.mix(spark, docs).collect()
    assert len(found) == len(rows)
    size, taken, target = defaultdict(int), defaultdict(int), {}
    for r in found:
        assert 0 <= r.taken <= 3 * r["size"]
        size[r.source] += r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.source_size is not None
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    assert [target[s] for s in order] == pytest.approx(shares([size[s] for s in order]))
    for s in ("hot", "mid", "small", "Über"):
        assert abs(taken[s] - target[s]) <= 0.05 * target[s]
    again = mixing.mix(spark, docs.repartition(3)).collect()
    assert Counter(again) == Counter(found)


def test_mixed_rows_are_the_planned_copies(spark):
    docs = table(spark, corpus(), ["copies", "row"])
    plan = Counter()
    for r in mixing.mix(spark, docs).collect():
        plan[r.source] += r.taken
    got = Counter()
    out = mixing.mixed(spark, docs)
    assert out.columns == docs.columns
    for r in out.collect():
        got[r.source] += len((r.text or "").encode().split())
    for s in ("hot", "mid", "small", "Über"):
        assert got[s] == plan[s]


def test_mixed_takes_each_row_as_planned_whatever_column_is_null(spark):
    """Rows that differ only in which column is NULL or empty are rows of their own; equal ones are taken together."""
    text = prose(1, 30)
    rows = [(1, text, "x", None), (1, text, None, "x"), (1, text, "", "x"), (1, text, "x", ""), (1, None, text, "x"), (None, text, "x", "1"),
            (1, text, "x", "x"), (1, text, "x", "x"), (1, text, "xx", ""), (2, text, "\\N", None), (2, text, None, "\\N")]
    rows += [(10 + i, prose(i, 20 + i % 17), "big", "en") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    # The plan, by row: the mix with the other column along as its id is the same draw for every row.
    plan = mixing._mix(spark, docs.select("*", mixing.n_words().alias("size"), row_key(docs).alias("row")).drop("text").alias("d")
                       .select("doc_id", "source", "size", "row"), mixing.WEIGHTS, mixing.CEILING, mixing.SEED, mixing.DRAWS)
    keys = {r.key: tuple(r)[:4] for r in docs.withColumn("key", row_key(docs)).collect()}
    assert len(keys) == len(set(rows))
    wanted = Counter()
    for r in plan.collect():
        wanted[keys[r.row]] += r.copies
    got = Counter(tuple(r) for r in mixing.mixed(spark, docs).collect())
    assert got == +wanted and sum(got.values()) > 0


def test_empty_table(spark):
    assert mixing.mix(spark, table(spark, [])).count() == 0
    assert mixing.mixed(spark, table(spark, [])).count() == 0


def test_hot_keys_join_beside_the_shuffle(spark, monkeypatch):
    from lakeshelf.llm import common

    monkeypatch.setattr(common, "HOT_LEAST", 5)
    big = spark.createDataFrame([(i % 7 if i > 40 else 1, i) for i in range(100)] + [(None, 1), (99, 2)], "k int, v int")
    small = big.where("k < 99").groupBy("k").count().withColumnRenamed("count", "n").withColumn("x", F.col("k") * 10)
    got = common.join_split(big, small, "k", "n")
    assert Counter(got.collect()) == Counter(big.join(small.drop("n"), "k").collect())
    assert got.columns == ["k", "v", "x"]
