import random
import zlib

import numpy as np
from llm_rows import awkward, prose, table
from pyspark.sql import functions as F

from lakeshelf.llm import factor_quality
from lakeshelf.llm.queries import op11


def corpus(n=300, junk=0.3):
    """Prose, and prose mixed with marks; quality 1 and 0."""
    draw = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        text, bad = prose(i, 60), draw.random() < junk
        if bad:
            text = " ".join(w if draw.random() < 0.7 else draw.choice(["###", "|", "$$$"]) for w in text.split())
        rows.append((i, text, "s"))
        labels.append((i, int(not bad)))
    return rows, labels


def marks(spark, labels):
    return spark.createDataFrame(labels, "doc_id bigint, quality int")


def test_sum_of_squares_is_the_sum_over_pairs():
    machine = factor_quality.Machine(4, 3)
    draw = np.random.default_rng(1)
    machine.weights, machine.start = draw.normal(size=machine.weights.size), 0.3
    held, values, statistics = factor_quality.measured(b"one two two | three")
    index, value = machine.row(held, values, statistics[:4])
    v = machine.factors[index]
    pairs = sum(value[i] * value[j] * (v[i] @ v[j]) for i in range(index.size) for j in range(i))
    line = 0.3 + value @ machine.weights[index] + pairs
    assert abs(machine.score(index, value) - 1 / (1 + np.exp(-line))) < 1e-12


def test_a_learning_step_lowers_the_loss_along_its_slopes():
    rows, labels = corpus(80)
    features = [(*(m := factor_quality.measured(t.encode()))[:2], m[2]) for _, t, _ in rows]
    good = np.array([y for _, y in labels], float)

    def loss(epochs):
        machine = factor_quality.Machine(len(factor_quality.STATISTICS), 4)
        machine.learn(features, good, epochs)
        p = np.array([machine.score(*machine.row(*f)) for f in features])
        return -np.mean(np.where(good > 0, np.log(p), np.log(1 - p)))

    losses = [loss(e) for e in (0, 1, 4)]
    assert losses[2] < losses[1] < losses[0]


def test_pairs_decide_what_single_words_cannot():
    """Quality is whether two words come together or not at all: only their interaction tells."""
    draw = random.Random(7)
    rows = [(a, b) for a in (0, 1) for b in (0, 1)] * 60
    texts = [" ".join(["left"] * a + ["right"] * b + draw.sample("pad fill rest more some".split(), 2)).encode() for a, b in rows]
    good = np.array([float(a == b) for a, b in rows])
    features = [(*(m := factor_quality.measured(t))[:2], [0.0]) for t in texts]
    machine = factor_quality.Machine(1, 4)
    machine.learn(features, good, 60)
    p = np.array([machine.score(*machine.row(*f)) for f in features])
    assert ((p > 0.5) == (good > 0)).mean() > 0.95


def test_held_out_documents_are_told_apart_and_folds_hold(spark):
    rows, labels = corpus()
    out = factor_quality.score(spark, table(spark, rows), marks(spark, labels)).collect()
    known = dict(labels)
    assert len(out) == len(rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    held = [r for r in out if r.held_out]
    assert sum(r.predicted == known[r.doc_id] for r in held) >= 0.95 * len(held)


def test_labels_of_the_held_out_fold_and_other_columns_change_nothing(spark):
    rows, labels = corpus(120)
    docs = table(spark, rows)
    first = factor_quality.score(spark, docs, marks(spark, labels)).collect()
    turned = [(d, 1 - y if zlib.crc32(str(d).encode()) % 5 == 0 else y) for d, y in labels]
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("elsewhere")).withColumn("score", F.lit("clash")).withColumn("m0", F.lit(3))
    again = factor_quality.score(spark, other.repartition(3), marks(spark, turned)).collect()
    assert {(r.doc_id, r.score) for r in first} == {(r.doc_id, r.score) for r in again}


def test_awkward_rows_are_scored_each(spark):
    rows, labels = corpus(100)
    odd = [(1000 + i if r[0] is None else r[0] + 500, r[1], r[2]) for i, r in enumerate(awkward())] + [(None, "x", "a"), (7, "repeated id", "s")]
    docs = table(spark, rows + odd).withColumn("n_chars", F.when(F.col("doc_id") % 2 == 0, F.length("text")))
    given = [*labels, (3, None), (None, 1), (3, 0), (None, 0)]
    out = factor_quality.score(spark, docs, marks(spark, given)).collect()
    assert len(out) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in out)
    assert all(not r.held_out for r in out if r.doc_id is None)


def test_no_labels_one_class_and_empty(spark):
    docs = table(spark, [(1, prose(1, 50), "a"), (2, None, "a"), (3, "", None)])
    assert {r.score for r in factor_quality.score(spark, docs, marks(spark, [])).collect()} == {0.0}
    assert {r.score for r in factor_quality.score(spark, docs, marks(spark, [(1, 1), (2, 1), (3, 1)])).collect()} == {1.0}
    assert factor_quality.score(spark, table(spark, []), marks(spark, [(1, 1)])).count() == 0


def test_long_texts_are_read_whole_in_pieces(monkeypatch):
    text = (prose(3, 400) + "\n" + prose(3, 30) + " ### ").encode() * 3
    whole = factor_quality.measured(text)
    monkeypatch.setattr(factor_quality.pieces, "__defaults__", (64,))
    parts = factor_quality.measured(text)
    assert np.array_equal(whole[0], parts[0]) and np.allclose(whole[1], parts[1])
    same = [i for i, n in enumerate(factor_quality.STATISTICS) if n != "distinct_words"]
    assert np.allclose(np.array(whole[2])[same], np.array(parts[2])[same])


def test_sample_keeps_to_its_bound_and_reruns_agree(spark):
    rows, labels = corpus(150)
    docs = factor_quality._source(table(spark, rows + rows[:40]), "doc_id", "text", ())
    sample = factor_quality.fit_sample(spark, docs, marks(spark, labels), "quality", 20).collect()
    assert len(sample) == 40 and sum(r.good for r in sample) == 20
    twice = [{(r.doc_id, r.score) for r in factor_quality.score(spark, table(spark, rows), marks(spark, labels), fit_rows=20).collect()} for _ in range(2)]
    assert twice[0] == twice[1]


def test_held_out_accuracy_on_the_small_tables(spark, sf_dir="/root/testdata/sf0.01"):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    out = [r for r in op11(spark, sf_dir).collect() if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in out) >= 0.9 * len(out)
