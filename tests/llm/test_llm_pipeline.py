from collections import Counter, defaultdict

import duckdb
import zstandard
from test_llm_decontaminate import nearest
from test_llm_simhash import bits, groups

import corpus_pipeline
from lakeshelf.llm import decontaminate, mixing, quality

SF_DIR = "/root/testdata/sf0.001"


def test_stage_names():
    assert len(corpus_pipeline.STAGES) == 5


def test_run_against_brute_force(spark):
    docs = duckdb.sql(f"SELECT doc_id, text, source, lang FROM '{SF_DIR}/documents.parquet' ORDER BY doc_id").fetchall()
    items = [t for (t,) in duckdb.sql(f"SELECT text FROM '{SF_DIR}/benchmark.parquet'").fetchall()]
    packer = zstandard.ZstdCompressor(level=quality.LEVEL)
    good = [d for d in docs if quality.measure((d[1] or "").encode(), packer)[-1]]
    root = groups([bits(d[1]) for d in good])
    one = [d for d, r in zip(good, root) if d[0] == min(e[0] for e, q in zip(good, root) if q == r)]
    patterns = [decontaminate.words_of(t.encode()) for t in items]

    def leaks(text):
        words = decontaminate.words_of(text.encode())
        return any(nearest(p, words) <= int(len(p) * decontaminate.ERROR_RATE) for p in patterns if len(p) >= decontaminate.MIN_WORDS)

    clean = [d for d in one if not leaks(d[1])]
    assert len(docs) > len(good) > len(one) > len(clean) > 0

    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    # Which copies are taken depends on the offset; each is of a clean document, and no source is off its target.
    frame = spark.createDataFrame([(d[0], d[1], d[2]) for d in clean], "doc_id long, text string, source string")
    taken = {r.doc_id: r.copies for r in mixing.mix(spark, frame).collect()}
    assert Counter(r.doc_id for r in rows) == Counter({d: n for d, n in taken.items() if n})
    full = {d[0]: d for d in docs}
    assert all((r.doc_id, r.text, r.source, r.lang) == full[r.doc_id] for r in rows)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(len(slots.get(i, ())) for i in range(40)) <= 1
