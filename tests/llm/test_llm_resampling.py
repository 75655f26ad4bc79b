import math
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
from llm_rows import awkward, prose, table

from lakeshelf.llm import resampling
from lakeshelf.llm.queries import op13

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_features(text):
    words = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]
    return len(words), [zlib.crc32(r.encode()) % 10_000 for r in runs]


def plain(docs, items):
    """(doc_id, n_features, weight, score, rank) by the contract, one feature at a time."""
    held = [(d, *plain_features(t)) for d, t in docs]
    s, t = Counter(), Counter()
    for _, _, found in held:
        s.update(found)
    for text in items:
        t.update(plain_features(text)[1])
    top, bottom = s.total() + 10_000, t.total() + 10_000
    gain = [math.floor(1000 * math.log((t[b] + 1) * top / ((s[b] + 1) * bottom))) for b in range(10_000)]
    rows = []
    for d, n, found in held:
        h = int(sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        rows.append((d, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    fit = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = fit[: 5 * len(fit) // 100]
    return rows, drawn


def check(spark, docs, items):
    df = table(spark, [(d, t, "s") for d, t in docs], ("rank", "weight", "_one", "bucket", "n_words"))
    target = spark.createDataFrame([(t,) for t in items], "text string")
    got = resampling.resample(spark, df, target).collect()
    rows, drawn = plain(docs, items)
    assert Counter((r.doc_id, r.n_words, r.n_features, r.weight, r.score) for r in got) == Counter(rows)
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r.doc_id, r.n_words, r.n_features, r.weight, r.score) for r in ranked] == drawn


def test_rows_are_those_of_the_plain_rule(spark):
    docs = [(i, prose(i % 37, 15 + i % 30)) for i in range(100, 300)] + [(r[0], r[1]) for r in awkward()]
    docs += [(400, "ÀB é ñ" + " word-Word_word\x00x" * 9), (401, "\x7f\x01- ."), (402, "a" * 5000 + " b c")]
    check(spark, docs, [prose(3, 40), None, "", prose(400, 25)])


def test_no_target_and_repeated_rows(spark):
    check(spark, [(i, prose(1, 30)) for i in range(40)], [])


def test_empty_tables(spark):
    docs = table(spark, [])
    target = spark.createDataFrame([], "text string")
    assert resampling.resample(spark, docs, target).count() == 0


def test_long_texts_in_pieces_give_what_the_whole_gives():
    texts = [prose(9, 700), None, "", "x " * 50, "one" * 400, prose(8, 3), " - " + prose(7, 90) + " . "]
    for most in (1, 7, 64, 500, 1 << 22):
        counts, words = np.zeros((len(texts), 10_000), np.int64), np.zeros(len(texts), np.int64)
        for rows, block, carried in resampling.blocks(pa.array(texts), most):
            for width, (owner, bucket) in enumerate(resampling.runs(block, carried), 1):
                np.add.at(counts, (rows[owner], bucket), 1)
                if width == 1:
                    np.add.at(words, rows[owner], 1)
        for i, text in enumerate(texts):
            n, found = plain_features(text)
            assert words[i] == n
            assert np.array_equal(counts[i], np.bincount(np.array(found, int), minlength=10_000))


def test_same_draw_again_and_larger_share_keeps_the_smaller_draw(spark):
    docs = table(spark, [(i, prose(i, 25), "s") for i in range(120)])
    target = spark.createDataFrame([(prose(5, 40),)], "text string")
    first, again, more = (
        {r.doc_id: r["rank"] for r in resampling.resample(spark, docs, target, share=s).collect() if r["rank"]} for s in ((5, 100), (5, 100), (1, 10))
    )
    assert first == again and len(first) == 6 and first.items() <= more.items()


def test_query_on_the_small_tables(spark, sf_dir="/root/testdata/sf0.001"):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    rows, drawn = plain(docs, items)
    got = op13(spark, sf_dir).collect()
    assert Counter((r.doc_id, r.n_features, r.weight, r.score) for r in got) == Counter((r[0], *r[2:]) for r in rows)
    assert {r.doc_id: r["rank"] for r in got if r["rank"]} == {r[0]: i for i, r in enumerate(drawn, 1)}
