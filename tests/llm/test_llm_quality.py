import base64
import random
import re
from collections import Counter

import zstandard
from llm_rows import awkward, prose, table
from pyspark.sql import functions as F

from lakeshelf.llm import quality
from lakeshelf.llm.toxicity import HELD_OUT, fold

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed,
    )


def test_base_counts_against_brute_force(spark):
    rows = awkward() + [(20, "a b c a b c a b\na b\na b\n \n \n", "x"), (21, "x" * 40_000, "x")]
    found = quality.quality(table(spark, rows, ["kept", "ratio", "n_words"]), keep=["doc_id", "text"]).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(r.text)
        assert not (r.base_failed and r.kept)


def test_verdicts(spark):
    noise = random.Random(1)
    junk = base64.b64encode(noise.randbytes(9000)).decode()
    random_text = " ".join(junk[i : i + 60] for i in range(0, len(junk), 60))
    line = prose(8, 9)
    log = "\n".join(f"{i} {line} {i * 7}" for i in range(300))
    rows = [(1, prose(1, 60), "a"), (2, prose(2, 400), "a"), (3, prose(3, 20_000), "a"), (4, random_text, "a"), (5, log, "a")]
    kept = {r.doc_id: r.kept for r in quality.quality(table(spark, rows)).collect()}
    assert kept == {1: True, 2: True, 3: True, 4: False, 5: False}
    ratio = {r.doc_id: r.ratio for r in quality.quality(table(spark, rows)).collect()}
    assert ratio[4] == len(random_text) / len(zstandard.ZstdCompressor(level=3).compress(random_text.encode()))


def test_long_vocabulary_repeats():
    words = [str(i).encode() for i in range(3000)]
    assert quality.repeat_words(words) == 0
    assert quality.repeat_words(words + words[10:14]) == 8


def test_keep_good_has_only_its_own_columns(spark):
    docs = table(spark, awkward(), ["kept", "n_words"])
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    want = Counter(r for r in docs.collect() if quality.measure((r.text or "").encode(), zstandard.ZstdCompressor(level=3))[-1])
    assert Counter(kept.collect()) == want and want


def test_empty_table(spark):
    assert quality.quality(table(spark, [])).count() == 0


def test_limits_fitted_from_labels_reject_junk(spark):
    draw, marks = random.Random(4), ["###", "$$$", "%%%", "&&&", "***"]
    rows, labels = [], []
    for i in range(400):
        words = prose(1000 + i, draw.randint(400, 1500)).split()
        junk = i % 4 == 0
        if junk:
            words = [w + draw.choice(marks) for w in words]
        rows.append((i, " ".join(words), "s"))
        labels.append((i, int(not junk)))
    rows += awkward()[1:4]
    odd = [(None, 0), (5, None), (100_000, 1)]
    labels = spark.createDataFrame(labels + odd, "doc_id long, quality int")
    docs = table(spark, rows, ["good", "ratio"])
    bands = quality.fitted(spark, docs, labels)
    found = quality.quality(docs, keep=["doc_id"], bands=bands).collect()
    junk_kept = [r.doc_id for r in found if r.doc_id is not None and 4 <= r.doc_id and r.doc_id % 4 == 0 and r.kept]
    clean = [r for r in found if not r.base_failed and r.doc_id % 4]
    assert len(junk_kept) <= 10 and sum(r.kept for r in clean) >= 0.98 * len(clean)
    assert Counter(quality.keep_good(docs, bands=bands).select("doc_id").collect()) == Counter((r.doc_id,) for r in found if r.kept)
    # Labels of held-out rows have no part in it; without labels the wide limits hold.
    held = labels.withColumn("quality", F.when(fold() == HELD_OUT, F.lit(1)).otherwise(F.col("quality")))
    assert quality.fitted(spark, docs, held) == bands
    none = quality.fitted(spark, docs, labels.limit(0))
    assert none[1] == quality.CHUNK_BAND
    for size in (10, 1000, 1024, 2047, 2048, 5000, 32767, 32768, 10**6):
        assert next(b[1:] for b in none[0] if size < b[0]) == next(b[1:] for b in quality.BANDS if size < b[0])


def test_limits_do_not_depend_on_which_of_repeated_rows_comes_first(spark):
    rows = [(i % 120, prose(i, 300 + i), "s") for i in range(360)]
    labels = spark.createDataFrame([(i, 1) for i in range(120)], "doc_id long, quality int")
    made = [quality.fitted(spark, table(spark, x).repartition(n), labels, fit_rows=60) for x, n in ((rows, 1), (rows[::-1], 5))]
    assert made[0] == made[1]


def test_limits_come_from_all_labelled_rows(spark, monkeypatch):
    # A hundred ids of two lengths; the last rows in the order of the ids' hashes are those with the least and greatest ratio.
    texts = {i: " ".join((prose(i, 300) + " ").split()[: 250 + i % 3]) for i in range(100)}
    docs = table(spark, [(i, t, "s") for i, t in texts.items()])
    labels = spark.createDataFrame([(i, 1) for i in texts], "doc_id long, quality int")
    monkeypatch.setattr(quality, "FIT_ROWS", 30, raising=False)
    monkeypatch.setattr(quality.fitted, "__defaults__", tuple(30 if d == 20_000 else d for d in quality.fitted.__defaults__))
    bands, _ = quality.fitted(spark, docs, labels)
    used = {r.doc_id for r in labels.where(fold() != HELD_OUT).collect()}
    packer = zstandard.ZstdCompressor(level=quality.LEVEL)
    ratios: dict = {}
    for i in used:
        t = texts[i].encode()
        end = next(e for e in quality.FIT_ENDS if len(t) < e)
        ratios.setdefault(end, []).append(len(t) / len(packer.compress(t)))
    full = {end: v for end, v in ratios.items() if len(v) >= quality.FIT_LEAST and end > quality.FIT_FROM}
    assert full
    for end, values in full.items():
        low, high = next(b[1:] for b in bands if b[0] == end)
        assert abs(low * quality.FIT_MARGINS[0] - min(values)) < 1e-9 and abs(high / quality.FIT_MARGINS[1] - max(values)) < 1e-9


def test_the_end_of_a_text_is_judged():
    packer = zstandard.ZstdCompressor(level=3)
    clean = prose(3, 20_000).encode()
    noise = base64.b64encode(random.Random(2).randbytes(30_000))
    part = quality.CHUNK_BYTES
    for tail in (3000, 3900, part - 1):
        *_, n_chunks, n_bad, kept = quality.measure(clean[:part] + noise[:tail], packer, chunk_band=(1.9, 2.8))
        assert (n_chunks, n_bad, kept) == (2, 1, False)
    assert quality.measure(clean[:part] + noise[:3900], packer)[-3:] == (2, 1, False)
    assert quality.measure(clean[: part + 3900], packer)[-3:] == (2, 0, True)
    assert [quality.measure(clean[:n], packer)[-3] for n in (part - 1, part, part + 1, 2 * part)] == [0, 1, 2, 2]
    # A fifth of a long text may not be noise either.
    assert not quality.measure(clean[: 8 * part] + noise[: 2 * part] + clean[8 * part : 10 * part], packer)[-1]
