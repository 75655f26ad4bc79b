import random

from llm_rows import awkward, prose, table

from lakeshelf.llm import decontaminate as d


def nearest(pattern, text):
    """Least edit distance of the pattern to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row[0] = row[0], i
        for j, t in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (p != t))
    return min(row)


def test_bit_parallel_distance_against_the_table():
    draw = random.Random(2)
    for _ in range(300):
        pattern = [draw.randint(1, 4) for _ in range(draw.randint(1, 90))]
        text = [draw.randint(0, 4) for _ in range(draw.randint(0, 120))]
        assert d.search(pattern, text)[0] == min(nearest(pattern, text), len(pattern))


def edited(words, edits, draw):
    words = list(words)
    for _ in range(edits):
        i = draw.randrange(len(words))
        kind = draw.randrange(3)
        if kind == 0:
            words[i] = "zzz"
        elif kind == 1:
            words.insert(i, "yyy")
        elif len(words) > 1:
            del words[i]
    return words


def case():
    draw = random.Random(4)
    items = [(i, prose(100 + i, draw.randint(5, 40))) for i in range(12)] + [(50, None), (51, "too short"), (None, prose(100, 9)), (0, prose(99, 20))]
    docs = awkward()
    for i in range(60):
        words = prose(500 + i, 40).split()
        item = items[draw.randrange(12)][1].split()
        docs.append((1000 + i, " ".join(words[:20] + edited(item, draw.randint(0, 8), draw) + words[20:]).upper(), "x"))
    return docs, items


def brute(docs, items):
    out = []
    for doc, text, _ in docs:
        words = [w.decode() for w in d.words_of((text or "").encode())]
        for key, item in items:
            pattern = [w.decode() for w in d.words_of((item or "").encode())]
            if len(pattern) >= d.MIN_WORDS and (n := nearest(pattern, words)) <= int(len(pattern) * d.ERROR_RATE):
                out.append((doc, key, n))
    return sorted(out, key=str)


def test_matches_against_brute_force(spark):
    docs, items = case()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert any(n > 0 for *_, n in want)
    for block_bytes in (16 << 20, 400):  # one block, and several
        found = d.matches(spark, table(spark, docs, ["item_id", "distance"]), benchmark, block_bytes=block_bytes).collect()
        assert sorted(((r.doc_id, r.item_id, r.distance) for r in found), key=str) == want
    words = {doc: d.words_of((text or "").encode()) for doc, text, _ in docs}
    exact = next(r for r in found if r.distance == 0 and r.item_id is not None and r.item_id > 0)
    assert words[exact.doc_id][exact.start_word : exact.end_word] == d.words_of(dict(items)[exact.item_id].encode())


def test_keep_clean_drops_the_documents_found(spark):
    docs, items = case()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    frame = table(spark, docs, ["hit"])
    kept = d.keep_clean(spark, frame, benchmark, block_bytes=400)
    hit = {doc for doc, *_ in brute(docs, items)}
    assert kept.columns == frame.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(x[0]) for x in docs if x[0] not in hit)


def test_empty_tables(spark):
    docs, items = case()
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame(items, "item_id long, text string")
    assert d.matches(spark, table(spark, docs), none).count() == 0
    assert d.matches(spark, table(spark, []), some).count() == 0
    assert d.keep_clean(spark, table(spark, docs), none).count() == len(docs)
