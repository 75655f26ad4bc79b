import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from llm_rows import awkward, prose, table

from lakeshelf.llm import sharding


def rows():
    return awkward() + [(100 + i, prose(i, 30 + i % 50), "s") for i in range(300)]


def test_shards_keep_all_rows_and_the_law(spark):
    docs = table(spark, rows(), ["shard", "_bucket", "_place", "bucket"])
    for n_shards, bucket_bytes in ((7, 20_000), (40, 32 << 20), (1000, 5_000)):
        out = sharding.shards(spark, docs, n_shards, bucket_bytes=bucket_bytes)
        assert out.columns == ["doc_id", "text", "source", "_bucket", "_place", "bucket", "shard", "slot"]
        found = out.collect()
        assert Counter((r.doc_id, r.text, r.source) for r in found) == Counter(rows())
        slots = defaultdict(list)
        for r in found:
            slots[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        counts = [len(slots.get(i, ())) for i in range(n_shards)]
        assert max(counts) - min(counts) <= 1 and sum(counts) == len(rows())


def test_order_is_reshuffled_and_agrees_between_runs(spark):
    docs = table(spark, rows())
    first = sharding.shards(spark, docs, 4, bucket_bytes=20_000).collect()
    assert Counter(sharding.shards(spark, docs, 4, bucket_bytes=20_000).collect()) == Counter(first)
    assert Counter(sharding.shards(spark, docs, 4, seed=1, bucket_bytes=20_000).collect()) != Counter(first)


def hashed(spark, docs, n):
    """(bucket, key, row number) of every row in reading order, by Spark's hash."""
    crc = F.crc32(F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary")))
    rows = docs.withColumn("n", F.monotonically_increasing_id())
    return rows.select("*", F.xxhash64(F.lit(sharding.SEED), "doc_id", crc, "n").alias("key")).selectExpr("*", f"pmod(key, {n}) AS b").collect()


@pytest.mark.parametrize("most_parts", [1, 3, 8192])
def test_order_is_that_of_a_plain_shuffle(spark, most_parts):
    """Bucket by bucket, sorted, then swapped from the end: in plain Python."""
    docs = table(spark, rows()).coalesce(1)
    n, parts = sharding.bucket_numbers(spark, sum(len((t or "").encode()) + 16 for _, t, _ in rows()), 6_000, most_parts)
    assert n > 8 and parts == min(n, most_parts)
    line = []
    for bucket in range(n):
        mine = sorted((r for r in hashed(spark, docs, n) if r.b == bucket), key=lambda r: (r.key, r.doc_id is not None, r.doc_id, r.n))
        draw = np.random.Generator(np.random.PCG64([sharding.SEED, bucket]))
        for last, pick in zip(range(len(mine) - 1, 0, -1), draw.integers(0, np.arange(len(mine), 0, -1)).tolist()):
            mine[last], mine[pick] = mine[pick], mine[last]
        line += [(r.doc_id, r.text, r.source) for r in mine]
    found = sharding.shards(spark, docs, 7, bucket_bytes=6_000, most_parts=most_parts, few_buckets=0 if most_parts == 3 else 100).collect()
    placed = sorted(found, key=lambda r: r.slot * 7 + r.shard)
    assert [(r.doc_id, r.text, r.source) for r in placed] == line


def test_partitions_stay_few_at_any_size(spark):
    assert sharding.bucket_numbers(spark, 10**14, sharding.BUCKET_BYTES, sharding.MOST_PARTS) == (2_980_233, 8192)


def test_fisher_yates():
    orders = Counter(tuple(sharding.fisher_yates(4, 9, bucket).tolist()) for bucket in range(4800))
    assert len(orders) == 24 and all(sorted(o) == [0, 1, 2, 3] for o in orders)
    assert all(130 < n < 280 for n in orders.values())  # 200 each, seven deviations
    assert sharding.fisher_yates(0, 1, 1).size == 0


def test_sizes_of_null_and_non_ascii(spark):
    got = {r[0]: r[1] for r in table(spark, rows()).select("doc_id", sharding.row_bytes("text")).collect() if r[0]}
    for doc, text, _ in rows():
        if doc:
            assert got[doc] == len((text or "").encode()) + 16
    assert zlib.crc32(b"") == 0


def test_empty_table(spark):
    assert sharding.shards(spark, table(spark, [])).count() == 0
