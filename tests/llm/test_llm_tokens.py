import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import awkward, prose, table
from tokenizers import Tokenizer

from lakeshelf.llm import token_files
from lakeshelf.session import new_path

PATH = public_tokenizers.path("word_bpe_49k.json")
with open(PATH, encoding="utf-8") as source:
    ENCODER = token_files.Encoder(source.read(), 1)
MODEL = Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def rows():
    odd = "It's. a, b., (c). <|endoftext|> <|ENDOFTEXT|>. café. ι, x y. don't, ΟΔΟΣ. 1.5, e.g., İ., a\x1cb ß"
    return awkward() + [(500 - i, prose(i, 40), "s") for i in range(150)] + [(700, odd, "s"), (701, odd.upper(), "s")]


def ids_of(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [1]


def test_file_holds_every_id_in_order(spark, rows):
    path = new_path(spark, "tokens")
    with open(PATH, encoding="utf-8") as file:
        token_files.write_tokens(spark, table(spark, rows, ["part", "ids"]), file.read(), path, file_bytes=4000)
    found = token_files.read_tokens(spark, path).collect()
    assert len({r.part for r in found}) > 3
    found.sort(key=lambda r: (r.part, r.before))
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in found]
    assert keys == sorted(keys)
    want = sorted((d is not None, d or 0, ids_of(t)) for d, t, _ in rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, list(r.ids)) for r in found) == want
    # The document id is what files and stripes can be skipped by.
    one = token_files.read_tokens(spark, path).where("doc_id = 420")
    assert [list(r.ids) for r in one.collect()] == [ids_of(prose(80, 40))]
    assert "EqualTo(doc_id,420)" in one._jdf.queryExecution().executedPlan().toString()


def test_digests(spark, rows):
    found = token_files.tokenized(spark, table(spark, rows), PATH).collect()
    start = 0
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in found)
    want = []
    for d, t, _ in rows:
        ids = ids_of(t)
        want.append((d is not None, d or 0, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert got == sorted(want)


def encoded(encoder, texts):
    ids, ends = encoder.encode(pa.array([None if t is None else t.encode() for t in texts], pa.binary()))
    return [p.tolist() for p in np.split(ids, ends)[: len(texts)]]


def test_a_full_word_store_changes_nothing(monkeypatch, rows):
    monkeypatch.setattr(token_files, "KEPT_BYTES", 2000)
    with open(PATH, encoding="utf-8") as file:
        encoder = token_files.Encoder(file.read(), 1)
    most = 2 * max(len(token_files.split_words(pa.array([(t or "").encode() for _, t, _ in rows[i : i + 7]]))[0].unique()) for i in range(0, len(rows), 7))
    for i in range(0, len(rows), 7):
        texts = [t for _, t, _ in rows[i : i + 7]]
        assert encoded(encoder, texts) == [ids_of(t) for t in texts]
        # No generation holds more than half of the bound and what two blocks have brought.
        assert len(encoder.young) <= 1000 // token_files.ENTRY_BYTES + most and len(encoder.old) <= 1000 // token_files.ENTRY_BYTES + most


@given(st.lists(st.text(st.sampled_from("aB é'ñ.,!#|<>_-1\u0301\u00a0İßﬁ\n9~"), max_size=14), max_size=6))
@settings(max_examples=300, deadline=None)
def test_words_alone_give_the_ids_of_whole_texts(texts):
    assert encoded(ENCODER, texts) == [[*MODEL.encode(t, add_special_tokens=False).ids, 1] for t in texts]


def test_other_tokenizers_get_whole_texts(rows):
    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as file:
        model = file.read()
    encoder, whole = token_files.Encoder(model, 7), Tokenizer.from_str(model)
    assert not encoder.by_words and ENCODER.by_words
    texts = [t for _, t, _ in rows[:40]]
    assert encoded(encoder, texts) == [[*whole.encode(t or "", add_special_tokens=False).ids, 7] for t in texts]
    assert encoder.encode(pa.array([], pa.binary()))[0].size == 0 and ENCODER.encode(pa.array([], pa.binary()))[0].size == 0


def test_blocks_keep_rows_and_their_bound():
    texts = ["x" * n for n in (0, 5, 50, 3, 3, 3, 200, 1)] + [None]
    batches = [pa.record_batch({"i": list(range(k, k + 3)), "t": pa.array(texts[k : k + 3], pa.string()).cast(pa.binary())}) for k in (0, 3, 6)]
    made = list(token_files.blocks(iter(batches), 1, 20))
    assert [i for b in made for i in b.column(0).to_pylist()] == list(range(9))
    for b in made:
        sizes = [len(t or b"") for t in b.column(1).to_pylist()]
        assert sum(sizes) <= 20 or max(sizes) > 20 and sum(sizes) - max(sizes) == 0


def test_empty_table(spark):
    assert token_files.tokenized(spark, table(spark, []), PATH).count() == 0
