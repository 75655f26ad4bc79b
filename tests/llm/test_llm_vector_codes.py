import random
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql.types import ArrayType, FloatType, IntegerType, LongType, StringType, StructField, StructType

from lakeshelf.llm import vector_codes

SCHEMA = StructType([
    StructField("vec_id", LongType()), StructField("embedding", ArrayType(FloatType())), StructField("label", IntegerType()),
    StructField("code", StringType()), StructField("far", StringType()), StructField("of", StringType()),
])


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def plain(rows, n_parts=8, n_entries=16, rounds=6):
    """Lloyd's rounds in plain integers, every part against every entry."""
    kept = [(i, [int(np.floor(4096 * float(np.float32(x)))) for x in v], y) for i, v, y in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], []
    length = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == length]
    width = -(-length // n_parts)
    cut = lambda v: [(v + [0] * (n_parts * width - length))[p * width : (p + 1) * width] for p in range(n_parts)]
    vectors = [cut(v) for _, v, _ in kept]
    books = [[list(v[p]) for v in vectors[:n_entries]] for p in range(n_parts)]

    def nearest(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(n_parts):
            groups = defaultdict(list)
            for v in vectors:
                groups[nearest(p, v[p])[1]].append(v[p])
            for k, parts in groups.items():
                books[p][k] = [sum(c) // len(parts) for c in zip(*parts, strict=True)]
    out, by_label = [], defaultdict(int)
    for (i, _, y), v in zip(kept, vectors, strict=True):
        found = [nearest(p, v[p]) for p in range(n_parts)]
        error = sum(d for d, _ in found)
        by_label[y] += error
        out.append((i, "".join(f"{k:02x}" for _, k in found), error, y))
    digest = sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return sorted(((i, c, e, by_label[y], digest) for i, c, e, y in out), key=str), books


def check(spark, rows, **shape):
    got = vector_codes.compressed(spark, frame(spark, rows), **shape).collect()
    assert sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in got), key=str) == plain(rows, **shape)[0]


def some(n, length, seed=1, step=None):
    draw = random.Random(seed)
    value = (lambda: draw.choice(step)) if step else (lambda: draw.uniform(-1, 1))
    return [(i * 3, [value() for _ in range(length)], draw.choice([0, 1, None])) for i in range(n)]


def test_rows_are_those_of_plain_rounds(spark):
    bad = [(1, None, 0), (2, [None] + [0.5] * 31, 1), (4, [float("nan")] * 32, 1), (5, [float("inf")] * 32, 1), (7, [], 1), (8, [0.25] * 8, 2)]
    check(spark, some(150, 32) + bad + some(20, 32) + [(None, [0.125] * 32, 7), (None, [0.125] * 32, 7)])


@pytest.mark.parametrize("length", [8, 3, 20])
def test_ties_and_lengths_that_parts_do_not_divide(spark, length):
    check(spark, some(120, length, 2, [0.0, 0.25, 0.5]))


def test_few_rows_and_one_label_join_by_shuffle(spark):
    check(spark, some(5, 16))
    rows = some(60, 16, 4)
    got = vector_codes.compressed(spark, frame(spark, rows), few_labels=0).collect()
    assert sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in got), key=str) == plain(rows)[0]


def test_empty_and_all_dropped(spark):
    assert vector_codes.compressed(spark, frame(spark, [])).count() == 0
    assert vector_codes.compressed(spark, frame(spark, [(1, None, 0), (2, [float("nan")], 0)])).count() == 0


def test_huge_components_are_held(spark):
    got = vector_codes.compressed(spark, frame(spark, [(1, [1e38] * 8, 0), (2, [-1e38] * 8, 0), (3, [0.0] * 8, 0)]), n_entries=1).collect()
    assert all(0 <= r.error <= r.label_error < 2**63 for r in got)


def test_moved_entries_alone_give_what_a_full_look_gives():
    draw = np.random.default_rng(3)
    for trial in range(60):
        books = draw.integers(-3, 4, (2, 5, 2))
        parts = draw.integers(-3, 4, (40, 2, 2))
        codes, far = np.zeros((40, 2), np.int64), np.zeros((40, 2), np.int64)
        vector_codes.assign(parts, books, np.ones((2, 5), bool), codes, far)
        for _ in range(4):
            new = np.where(draw.random((2, 5, 1)) < 0.4, draw.integers(-3, 4, books.shape), books)
            moved, books = (new != books).any(axis=2), new
            vector_codes.assign(parts, books, moved, codes, far)
            for p in range(2):
                found = vector_codes.squared(parts[:, p], books[p])
                assert np.array_equal(codes[:, p], found.argmin(axis=1)), trial
                assert np.array_equal(far[:, p], found.min(axis=1))


def test_tables_of_earlier_rounds_go(spark, tmp_path):
    from lakeshelf.session import shared_folder
    import os

    folder = f"{shared_folder(spark)}/lakeshelf"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    vector_codes.compressed(spark, frame(spark, some(40, 8))).count()
    assert len([n for n in set(os.listdir(folder)) - before if n.startswith("vectors-")]) == 1
