import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
from llm_rows import awkward, prose, table

from lakeshelf.llm import passages


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def corpus():
    draw = random.Random(21)
    shared = [prose(9000 + i, n) for i, n in enumerate((52, 80, 300))]
    rows = awkward()
    for i in range(80):
        words = prose(i, draw.randint(20, 150)).split()
        if i % 2:
            at = draw.randrange(len(words))
            words[at:at] = shared[i % 3].split()
        rows.append((100 + i, " ".join(words), "s"))
    for i in range(25):  # many near copies of one text, and exact ones
        words = prose(77, 200).split()
        words[draw.randrange(len(words))] = f"changed{i % 20}"
        rows.append((300 + i, " ".join(words), "s"))
    rows.append((400, "x " + " ".join(shared[1].split()[:30] + ["put", "in"] + shared[1].split()[30:60] + shared[1].split()[62:]), "s"))
    return rows


def test_every_repeated_run_is_covered(spark):
    rows = corpus()
    found = passages.repeated_passages(spark, table(spark, rows, ["th", "start", "end", "n", "words"])).collect()
    covered = defaultdict(list)
    for r in found:
        assert r.end_word - r.start_word >= passages.PASSAGE
        covered[r.doc_id].append((r.start_word, r.end_word))
    texts = [(d, passages.word_codes((t or "").encode()).tolist()) for d, t, _ in rows]
    windows = defaultdict(set)
    for n, (_, w) in enumerate(texts):
        for i in range(len(w) - passages.PASSAGE + 1):
            windows[tuple(w[i : i + passages.PASSAGE])].add(n)
    repeated = set()
    for d, w in texts:
        for i in range(len(w) - passages.PASSAGE + 1):
            if len(windows[tuple(w[i : i + passages.PASSAGE])]) > 1:
                repeated.add(d)
                # Two texts may agree for a word or two beyond what both share with the source, as next to an edit of it.
                assert any(a <= i + 2 and i + passages.PASSAGE - 2 <= b for a, b in covered[d]), (d, i, covered[d])
    assert 400 in covered and set(covered) - {400} <= repeated
    firsts = {r.source_doc_id for r in found if not r.first}
    assert firsts <= set(covered)


def test_named_source_holds_the_passage(spark):
    rows = corpus()
    words = {d: (t or "").lower().split() for d, t, _ in rows if d is not None}
    checked = 0
    for r in passages.repeated_passages(spark, table(spark, rows)).collect():
        if not r.first and r.doc_id is not None and r.source_doc_id is not None:
            a = words[r.doc_id][r.start_word : r.end_word]
            b = words[r.source_doc_id][r.source_start : r.source_end]
            if abs(len(a) - len(b)) <= 5:  # one run, not several joined
                assert edit_distance(a, b) <= r.edits + abs(len(a) - len(b))
                checked += 1
    assert checked > 40


def best_chain(links):
    links = sorted(set(links))
    score = []
    for i, (x, y) in enumerate(links):
        gains = [score[j] - passages.GAP_COST * (x - a + y - b) for j, (a, b) in enumerate(links[:i]) if a < x and b < y]
        score.append(1 + max([0, *gains]))
    return max(score)


def test_fenwick_chains_reach_the_best_score():
    draw = random.Random(5)
    for _ in range(60):
        links = [(draw.randrange(60), draw.randrange(60)) for _ in range(draw.randint(1, 40))]
        made = passages.chains(links, max_gap=10**6)
        assert sorted(x for c in made for x in c) == sorted(set(links))
        for c in made:
            assert all(a < x and b < y for (a, b), (x, y) in zip(c, c[1:]))
        gaps = passages.GAP_COST * (made[0][-1][0] - made[0][0][0] + made[0][-1][1] - made[0][0][1])
        assert abs(len(made[0]) - gaps - best_chain(links)) < 1e-9


def test_seeds_cover_every_shared_run():
    draw = random.Random(9)
    for _ in range(50):
        shared = np.array([draw.randrange(50) for _ in range(passages.K)], np.uint32)
        sides = [np.array([draw.randrange(50) for _ in range(draw.randint(0, 40))], np.uint32) for _ in range(4)]
        a, b = np.concatenate((sides[0], shared, sides[1])), np.concatenate((sides[2], shared, sides[3]))
        assert set(passages.seeds(a, keep=1)[1].tolist()) & set(passages.seeds(b, keep=1)[1].tolist())
        # By hash, a run is a seed wherever it comes.
        some = [set(passages.seeds(x)[1].tolist()) for x in (a, b)]
        every = [set(passages.seeds(x, keep=1)[1].tolist()) for x in (a, b)]
        if all(np.unique(x).size == x.size for x in (a, b)):
            assert some[0] & some[1] == {h for h in every[0] & every[1] if h % passages.KEEP == 0}


def test_distance():
    draw = random.Random(1)
    for _ in range(100):
        a, b = ([draw.randrange(3) for _ in range(draw.randrange(9))] for _ in range(2))
        assert passages.distance(np.array(a, int), np.array(b, int)) == edit_distance(a, b)


def test_empty_table(spark):
    assert passages.repeated_passages(spark, table(spark, [])).count() == 0


EDITS = {
    "replaced": lambda w, new: [new],
    "inserted": lambda w, new: [w, new],
    "deleted": lambda w, new: [],
}


def edited_pairs(gap, kind, n=60, text=None):
    """Pairs of documents that share about 60 words, every ``gap``-th of them edited in one."""
    draw, rows = random.Random(gap), []
    for i in range(n):
        words = text(draw) if text else [f"w{draw.randrange(10**6)}" for _ in range(60)]
        start = draw.randrange(gap)
        other = [x for j, w in enumerate(words) for x in (EDITS[kind](w, f"e{draw.randrange(10**6)}") if j % gap == start else [w])]
        for side, held in enumerate((words, other)):
            around = [[f"v{draw.randrange(10**6)}" for _ in range(30)] for _ in range(2)]
            rows.append((2 * i + side, " ".join(around[0] + held + around[1]), "s"))
    return rows


def linked_pairs(spark, rows):
    found = passages.repeated_passages(spark, table(spark, rows)).collect()
    return {r.doc_id // 2 for r in found if not r.first and r.source_doc_id // 2 == r.doc_id // 2}


def test_edited_passages_are_found(spark):
    wanted = {
        "replaced": ((5, 0.9), (6, 0.95), (8, 1.0), (12, 1.0)), "inserted": ((6, 0.9), (8, 0.95), (10, 1.0)),
        "deleted": ((10, 0.95), (12, 1.0)),
    }
    for kind, rates in wanted.items():
        for gap, least in rates:
            pairs = linked_pairs(spark, edited_pairs(gap, kind))
            print(kind, "every", gap, len(pairs), "of 60")
            assert len(pairs) >= least * 60, (kind, gap, len(pairs))
    every = passages.repeated_passages(spark, table(spark, edited_pairs(5, "replaced")), keep=1).collect()
    assert len({r.doc_id // 2 for r in every if not r.first}) == 60


def test_edited_passages_of_real_phrases_are_found(spark):
    """The shared words are runs of the documents' own texts, common phrases included."""
    texts = [r.text.split() for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect() if r.text]
    texts = [t for t in texts if len(t) >= 100]

    def real(draw):
        words = draw.choice(texts)
        at = draw.randrange(len(words) - 60)
        return words[at : at + 60]

    for kind, gap in (("replaced", 6), ("replaced", 10), ("inserted", 10), ("deleted", 10)):
        pairs = linked_pairs(spark, edited_pairs(gap, kind, 40, real))
        print(kind, "every", gap, len(pairs), "of 40")
        assert len(pairs) >= 0.9 * 40, (kind, gap, len(pairs))


def plain_links(texts):
    """{(th, pos, rth, rpos)} from all places of each seed to the first place of its least text."""
    places = defaultdict(list)
    for th, codes in texts.items():
        for at, seed in zip(*(x.tolist() for x in passages.seeds(codes))):
            places[seed].append((th, at))
    return {(*p, *min(held)) for held in places.values() for p in held if p[0] != min(held)[0]}


def test_links_of_one_chunk_are_those_of_all_places(spark):
    rows = [(r[0], r[1]) for r in corpus() if r[1]]
    hashed = passages._hashed(table(spark, [(d, t, "s") for d, t in rows]), "text")
    texts = {r.th: passages.word_codes(bytes(r.t)) for r in hashed.collect()}
    wanted = plain_links(texts)
    one = passages.occurrences(hashed.coalesce(1)).repartition(3, "key").sortWithinPartitions("key", "th", "pos")
    assert {tuple(r) for r in passages.links(one).collect()} == wanted
    # In small chunks and many tasks a place may link to a nearer lead first; what hangs together is the same.
    many = passages.occurrences(hashed.repartition(7), chunk=50).repartition(3, "key").sortWithinPartitions("key", "th", "pos")
    made = {tuple(r) for r in passages.links(many).collect()}

    def joined(links):
        root = {}

        def find(x):
            while root.setdefault(x, x) != x:
                x = root[x]
            return x

        for a, b, c, d in sorted(links):
            root[find((a, b))] = find((c, d))
        return root, find

    root, find = joined(made)
    assert all(find((a, b)) == find((c, d)) for a, b, c, d in wanted if (a, b) in root and (c, d) in root)
    assert {(a, b) for a, b, _, _ in wanted} <= {x for x in root}


def test_a_seed_of_very_many_texts_sends_on_few_rows():
    n = 50_000
    rows = passages.led(np.full(n, 7, np.int64), np.arange(n, dtype=np.int64) % 25_000, np.arange(n, dtype=np.int32))
    assert sum(k == 7 and r is None for k, r in zip(rows.column(0).to_pylist(), rows.column(3).to_pylist())) == 2
    assert rows.num_rows == n


def test_thinned_links_are_those_of_the_rule():
    draw = random.Random(8)
    for _ in range(40):
        links = [(draw.randrange(3), draw.randrange(25), draw.randrange(25)) for _ in range(300)]
        links += [(1, i, i + 4) for i in range(60)] + [(2, i, i) for i in range(30)] * 2
        held = set(links)
        wanted = {(g, x, y) for g, x, y in held if x % passages.THIN == 0 or (g, x - 1, y - 1) not in held or (g, x + 1, y + 1) not in held}
        g, x, y = (np.array(c) for c in zip(*links))
        stay = passages.thinned(g, x, y)
        got = list(zip(g[stay].tolist(), x[stay].tolist(), y[stay].tolist()))
        assert set(got) == wanted and len(got) == len(set(got))


def test_text_pairs_are_cut_between_batches():
    rows = sorted((random.Random(i).randrange(4), 1, random.Random(-i).randrange(2), i) for i in range(50))
    columns = [[r[0] for r in rows], [r[3] for r in rows], [r[2] for r in rows], [r[1] for r in rows]]
    whole = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=list("abcd"))
    for step in (1, 3, 50):
        made = list(passages.pairs_of_texts(whole.slice(i, step) for i in range(0, 50, step)))
        assert [t for part in made for t in zip(*(c.tolist() for c in part))] == [(r[0], r[2], r[3], r[1]) for r in rows]
        pairs = [{(a, b) for a, b in zip(part[0].tolist(), part[1].tolist())} for part in made]
        assert all(not p & q for i, p in enumerate(pairs) for q in pairs[:i])


def test_ends_are_extended_over_words_put_in_or_left_out():
    draw = random.Random(4)
    for _ in range(200):
        shared = [draw.randrange(1000, 10**6) for _ in range(30)]
        other = list(shared)
        for _ in range(draw.randrange(3)):
            at = draw.randrange(5, 25)
            other[at : at + draw.randrange(2)] = [draw.randrange(10**6, 2 * 10**6)][: draw.randrange(2)]
        a, b = np.array(shared + [1, 2, 3], np.uint32), np.array(other + [4, 5, 6], np.uint32)
        n, m, edits = passages.extend(a, b)
        assert n >= 28 and abs(m - len(other)) <= 2 and edit_distance(a[:n].tolist(), b[:m].tolist()) <= edits
    none = np.zeros(0, np.uint16)
    assert passages.extend(none, none) == (0, 0, 0) == passages.extend(np.array([1, 2], np.uint16), np.array([3, 4], np.uint16))


def test_any_fifth_of_a_passage_edited_leaves_a_seed():
    draw = random.Random(2)
    for _ in range(300):
        words = np.array([draw.randrange(2**32) for _ in range(passages.PASSAGE)], np.uint32)
        other = words.copy()
        for i in draw.sample(range(passages.PASSAGE), int(passages.EDITS * passages.PASSAGE)):
            other[i] = draw.randrange(2**32)
        assert set(passages.seeds(words, keep=1)[1].tolist()) & set(passages.seeds(other, keep=1)[1].tolist())


def test_band_ends_where_the_other_run_is_much_shorter():
    a = list(range(passages.BAND + passages.DROP + 40))
    for n in (0, 1, 3, 20):
        assert passages.banded(a, a[:n]) == (n, n, n, 0)
        assert passages.banded(a[:n], a) == (n, n, n, 0)
    # All words the band bears are put in, and the shorter run ends while the score is at its best.
    more = [w for i in range(100) for w in ([-1 - i, i] if i and i % 10 == 0 and i <= 10 * passages.BAND else [i])]
    got = passages.banded(more + [1000, 1001, 1002], list(range(100)))
    assert got == (100 - 2 * passages.BAND, 100 + passages.BAND, 100, passages.BAND)
