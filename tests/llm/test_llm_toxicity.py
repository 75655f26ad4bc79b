import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_rows import awkward, prose, table

from lakeshelf.llm import toxicity

RUDE = ["grubbler", "snodwit", "vlackish"]


def corpus(n=600):
    draw, rows, labels = random.Random(3), [], []
    for i in range(n):
        words = prose(i, draw.randint(30, 200)).split()
        toxic = i % 5 == 0
        if toxic:
            for _ in range(max(2, len(words) // 40)):
                words.insert(draw.randrange(len(words)), draw.choice(RUDE) + draw.choice(["", "s", "er", "an"]))
        rows.append((i, " ".join(words), "s"))
        if i % 3:
            labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def case(spark):
    rows, labels = corpus()
    return rows, labels, spark.createDataFrame(labels, "doc_id long, toxic int")


def held_out(doc):
    return zlib.crc32(str(doc).encode()) % 4 == 2


def test_held_out_accuracy(spark, case):
    rows, labels, frame = case
    found = {r.doc_id: r for r in toxicity.score(spark, table(spark, rows, ["score", "toxic", "n", "mean"]), frame).collect()}
    assert len(found) == len(rows)
    tested = [(i, i % 5 == 0) for i in found if held_out(i)]
    assert all(found[i].held_out == held_out(i) for i in found)
    right = sum((found[i].score >= 0.3) == toxic for i, toxic in tested)
    assert right >= 0.95 * len(tested)
    assert all(found[i].predicted == int(found[i].score >= 0.3) and 0 <= found[i].score <= 1 for i in found)
    # Labels of held-out rows have no part in it.
    flipped = spark.createDataFrame([(d, 1 - t if held_out(d) else t) for d, t in labels], "doc_id long, toxic int")
    again = {r.doc_id: r.score for r in toxicity.score(spark, table(spark, rows), flipped).collect()}
    assert all(again[i] == pytest.approx(found[i].score) for i in again)


def test_awkward_rows_and_labels(spark, case):
    rows, labels, _ = case
    odd = [(10_000 + i, t, s) for i, (_, t, s) in enumerate(awkward())] + [(None, prose(1, 50), "s"), (7, prose(1, 50), "s")]
    frame = spark.createDataFrame(labels + [(None, 1), (3, None), (4, 0), (4, 1), (99_999, 1)], "doc_id long, toxic int")
    found = toxicity.score(spark, table(spark, rows + odd), frame).collect()
    assert Counter(r.doc_id for r in found) == Counter(d for d, *_ in rows + odd)
    assert all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.n_words == 0}) == 1
    assert [r.held_out for r in found if r.doc_id is None] == [False]


@pytest.mark.parametrize("labels", [[], [(0, 0), (1, 0)], [(i, 1) for i in range(40)]])
def test_without_both_classes(spark, labels):
    rows, _ = corpus(40)
    frame = spark.createDataFrame(labels, "doc_id long, toxic int")
    found = toxicity.score(spark, table(spark, rows), frame).collect()
    assert len(found) == 40 and all(0 <= r.score <= 1 for r in found)


def test_backoff_and_ratios_against_brute_force(spark):
    counts = {"abab": (3, 1), "abc": (0, 4), "ba": (2, 0), "ñab": (1, 1)}
    order, discount = 3, 0.75
    words = spark.createDataFrame([(bytearray(w.encode()), a, b) for w, (a, b) in counts.items()], "word binary, n1 long, n0 long")
    counted = toxicity.events(words, order)
    event = defaultdict(lambda: [0, 0])
    for w, (n1, n0) in counts.items():
        s = f"^{w}$"
        for i in range(1, len(s)):
            g = s[max(0, i - order + 1) : i + 1]
            event[g][1] += n1
            event[g][0] += n0
    assert {r.gram: [r.n0, r.n1] for r in counted.collect()} == dict(event)

    def shared(g):
        m = len(g)
        longer = {e[-m - 1 :] for e in event if len(e) > m}
        c = Counter(x[1:] for x in longer)
        same = {x: n for x, n in c.items() if x[:-1] == g[:-1]}
        if m == 1:
            return c[g] / sum(same.values())
        return (c[g] - discount) / sum(same.values()) + discount * len(same) / sum(same.values()) * shared(g[1:])

    backoff = {r.gram: r.p for r in toxicity.shared_backoff(spark, counted.select("gram"), order, discount).collect()}
    assert backoff == pytest.approx({g: shared(g) for g in backoff})
    singles = sum(p for g, p in backoff.items() if len(g) == 1)
    assert singles == pytest.approx(1)

    def own(g, y):
        same = {e: n[y] for e, n in event.items() if e[:-1] == g[:-1]}
        total, types = sum(same.values()), sum(n > 0 for n in same.values())
        if not total:
            return shared(g[1:])
        return max(event[g][y] - discount, 0) / total + discount * types / total * shared(g[1:])

    seen, unseen = toxicity.model_tables(spark, counted, order, discount)
    got = {r.gram: r.ratio for r in seen.collect()}
    assert got == pytest.approx({g: np.log(own(g, 1) / own(g, 0)) for g in event})
    # The scorer finds the same numbers by code.
    scorer = toxicity.Scorer(toxicity.run_codes(seen, order), toxicity.run_codes(unseen, order), order)
    scorer.learn([b"abab"])
    s = "^abab$"
    assert scorer.known[b"abab"] == pytest.approx(sum(got[s[max(0, i - order + 1) : i + 1]] for i in range(1, len(s))), abs=1e-5)
    # So does the join of words with the events, also for runs and histories never seen.
    words = [b"abab", b"abx", b"zzz", "ñab".encode(), b"b"]
    scorer.learn(words)
    frame = spark.createDataFrame([(bytearray(w),) for w in words], "word binary")
    joined = {bytes(r.word): r.ratio for r in toxicity.word_ratios(frame, seen, unseen, order).collect()}
    assert joined == pytest.approx({w: scorer.known[w] for w in words}, abs=1e-6)


def test_scores_do_not_depend_on_how_the_events_reach_the_words(spark, case):
    """All events shipped, or none of them: no event is left out either way."""
    rows, labels, frame = case
    odd = [(10_000 + i, t, s) for i, (_, t, s) in enumerate(awkward())] + [(None, prose(1, 50), "s"), (7, prose(1, 50), "s")]
    docs = table(spark, rows + odd)
    shipped, joined = (
        sorted(toxicity.score(spark, docs, frame, few_events=few, block_bytes=20_000).collect(), key=str) for few in (10**9, 0)
    )
    assert len(shipped) == len(joined) == len(rows) + len(odd)
    key = lambda r: (str(r.doc_id), r.n_words, round(r.score, 9))
    for a, b in zip(sorted(shipped, key=key), sorted(joined, key=key), strict=True):
        assert (a.doc_id, a.held_out, a.predicted, a.n_words) == (b.doc_id, b.held_out, b.predicted, b.n_words)
        assert a.score == pytest.approx(b.score, abs=1e-6) and a.top1 == pytest.approx(b.top1, abs=1e-5)


def test_repeated_ids_learn_the_same_whatever_the_order(spark, case):
    rows, labels, frame = case
    twice = rows + [(d, prose(d + 5000, 40), s) for d, _, s in rows[:200]]
    first, again = ({(r.doc_id, r.n_words, r.score) for r in toxicity.score(spark, table(spark, x), frame, curve_rows=60).collect()} for x in (twice, twice[::-1]))
    assert first == again


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(spark, table(spark, []), labels).count() == 0
