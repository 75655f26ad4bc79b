import random
from collections import Counter

import numpy as np
import xxhash
from llm_rows import awkward, prose, table

from lakeshelf.llm import simhash


def bits(text):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, budget=2):
    """Class number of each fingerprint, by all pairs."""
    root = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= budget:
                a, b = root[i], root[j]
                root = [a if r == b else r for r in root]
    return root


def cloud(n, seed):
    draw = random.Random(seed)
    centres = [draw.getrandbits(64) for _ in range(5)]
    out = set()
    while len(out) < n:
        x = draw.choice(centres) if draw.random() < 0.7 else draw.getrandbits(64)
        for _ in range(draw.randint(0, 5)):
            x ^= 1 << draw.randrange(64)
        out.add(x)
    return sorted(out)


def test_walk_finds_all_pairs_within_the_budget(monkeypatch):
    for front in (1_000_000, 3):
        monkeypatch.setattr(simhash, "FRONT_LIMIT", front)
        left, right = np.array(cloud(120, 1), np.uint64), np.array(cloud(90, 2) + cloud(30, 1), np.uint64)
        right.sort()
        found = {(i, j) for a, b in simhash.walk(left, right, 0, 0, 2) for i, j in zip(a.tolist(), b.tolist())}
        want = {(i, j) for i, x in enumerate(left.tolist()) for j, y in enumerate(right.tolist()) if (x ^ y).bit_count() <= 2}
        assert found == want and want


def test_classes_of_a_dense_cloud(spark):
    prints = cloud(300, 3)
    signed = [x - 2**64 if x >= 2**63 else x for x in prints]
    frame = spark.createDataFrame([(x,) for x in signed], "fp long")
    want = groups(prints)
    for limit in (20, 10_000):  # deep in the top walk, or all in one task
        links = [(r.a, r.b) for r in simhash.links(spark, frame, 2, limit).collect()]
        at = {x: i for i, x in enumerate(signed)}
        root = list(range(len(prints)))
        for a, b in links:
            assert (prints[at[a]] ^ prints[at[b]]).bit_count() <= 2
            x, y = root[at[a]], root[at[b]]
            root = [x if r == y else r for r in root]
        assert [root.index(r) for r in root] == [want.index(r) for r in want]


def test_documents_against_brute_force(spark):
    rows = awkward() + [(30 + i, prose(40, 300 - i), "n") for i in range(6)]
    found = simhash.near_duplicates(spark, table(spark, rows, ["fp", "component_id", "rep", "root"])).collect()
    prints = [bits(t) for _, t, _ in rows]
    root = groups(prints)
    least = {r: min((d for (d, _, _), q in zip(rows, root) if q == r and d is not None), default=None) for r in set(root)}
    want = Counter((d, f"{p:016x}", least[r]) for (d, _, _), p, r in zip(rows, prints, root))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in found) == want


def test_keep_one_of_each_class(spark):
    rows = awkward()
    docs = table(spark, rows, ["w_id", "times", "row"])
    kept = simhash.keep_one(spark, docs)
    assert kept.columns == docs.columns
    root = groups([bits(t) for _, t, _ in rows])
    least = {min(((d is None, d or 0) for (d, _, _), q in zip(rows, root) if q == r)) for r in set(root)}
    assert Counter((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == Counter(least)


def test_empty_table(spark):
    assert simhash.near_duplicates(spark, table(spark, [])).count() == 0
    assert simhash.keep_one(spark, table(spark, [])).count() == 0
