"""Benchmark decontamination: pigeonhole edit matching with Myers' bit-parallel distance.

An item of n words may be matched with up to ``k = int(n * ERROR_RATE)`` word
edits.  Cut in k + 1 pieces, at least one piece must occur unchanged, so documents
are searched for exact pieces; around each hit the whole item is verified with
bit-parallel edit distance over words.  Nothing within the budget is missed.

Documents stream through tasks once for each block of items; a block is bounded
by ``BLOCK_BYTES`` of item text, so what tasks hold does not grow with the benchmark.

Words are runs of letters and digits, lower-cased; other ASCII characters separate.
Defined results: null or empty texts match nothing; items of fewer than
``MIN_WORDS`` words (null texts too) are not searched, they would occur by chance.
Repeated items give a row each, repeated documents too.  Of several equally near
places in a document the first is reported.  Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from lakeshelf.llm.common import add_columns

ERROR_RATE = 0.15
MIN_WORDS = 5
BLOCK_BYTES = 16 << 20

# ASCII but letters and digits separates words.
_APART = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))

PLACE = [StructField(n, IntegerType()) for n in ("distance", "start_word", "end_word")]


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").decode("utf-8", "replace").lower().encode().translate(_APART).split()


def search(pattern: Sequence[int], text: Sequence[int]) -> tuple[int, int]:
    """(least edit distance of ``pattern`` to any part of ``text``, end of the first such part)."""
    return _myers(pattern, text, anchored=False)


def _myers(pattern: Sequence[int], text: Sequence[int], anchored: bool) -> tuple[int, int]:
    """Columns of the edit matrix as vertical +1 / -1 bit vectors; ``anchored``: the part starts at 0."""
    m = len(pattern)
    where: dict[int, int] = {}
    for i, word in enumerate(pattern):
        where[word] = where.get(word, 0) | 1 << i
    full, last = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best, end = full, 0, m, m, 0
    for i, word in enumerate(text, 1):
        equal = where.get(word, 0)
        diagonal = (((equal & plus) + plus) ^ plus) | equal | minus
        up, down = minus | (full & ~(diagonal | plus)), plus & diagonal
        score += bool(up & last) - bool(down & last)
        up, down = (up << 1 | anchored) & full, (down << 1) & full
        vertical = equal | minus
        plus, minus = (down | (full & ~(vertical | up))) & full, up & vertical
        if score < best:
            best, end = score, i
    return best, end


class Items:
    """A block of items, ready to search."""

    def __init__(self, rows: list[tuple[object, bytes | None]], rate: float, min_words: int) -> None:
        by_words: dict[tuple[bytes, ...], list[object]] = {}
        for key, text in rows:
            words = tuple(words_of(text))
            if len(words) >= max(1, min_words):
                by_words.setdefault(words, []).append(key)
        self.keys = list(by_words.values())
        self.vocabulary: dict[bytes, int] = {}
        self.items = [[self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words] for words in by_words]
        self.budgets = [int(len(words) * rate) for words in by_words]
        pieces: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for number, (ids, k) in enumerate(zip(self.items, self.budgets, strict=True)):
            cuts = [round(j * len(ids) / (k + 1)) for j in range(k + 2)]
            for start, end in zip(cuts, cuts[1:]):
                pieces.setdefault(tuple(ids[start:end]), []).append((number, start))
        self.by_length: dict[int, dict[tuple[int, ...], list[tuple[int, int]]]] = {}
        for piece, at in pieces.items():
            self.by_length.setdefault(len(piece), {})[piece] = at

    @classmethod
    def shipped(cls, state: dict) -> Items:
        """From a broadcast ``vars()``, which needs no class on the way."""
        items = cls.__new__(cls)
        items.__dict__.update(state)
        return items

    def candidates(self, ids: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(position, item, offset of the piece in it) for each exact piece in ``ids``."""
        known = ids > 0
        for length, pieces in sorted(self.by_length.items()):
            if ids.size < length:
                continue
            run = known[: ids.size - length + 1].copy()
            for j in range(1, length):
                run &= known[j : ids.size - length + 1 + j]
            at = np.flatnonzero(run)
            if not at.size:
                continue
            codes = np.zeros(at.size, np.uint64)
            mine = np.array(list(pieces), np.uint64).reshape(-1, length)
            wanted = np.zeros(len(mine), np.uint64)
            for j in range(length):  # a rolling product; equal codes are compared word by word below
                codes = codes * np.uint64(0x9E3779B97F4A7C15) + ids[at + j].astype(np.uint64)
                wanted = wanted * np.uint64(0x9E3779B97F4A7C15) + mine[:, j]
            for p in at[np.isin(codes, wanted)].tolist():
                for number, offset in pieces.get(tuple(ids[p : p + length].tolist()), ()):
                    yield p, number, offset

    def matches(self, texts: list[bytes | None]) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, distance, start word, end word) of each text and item within its budget."""
        get, each = self.vocabulary.get, []
        for text in texts:
            words = words_of(text)
            each.append(np.fromiter((get(w, 0) for w in words), np.int64, len(words)))
        gap = np.zeros(1, np.int64)  # no piece spans two texts
        joined = np.concatenate([x for ids in each for x in (ids, gap)]) if each else gap
        begins = np.concatenate(([0], np.cumsum([ids.size + 1 for ids in each])))
        regions: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for p, number, offset in self.candidates(joined):
            text = int(np.searchsorted(begins, p, "right")) - 1
            start, k, n = p - int(begins[text]) - offset, self.budgets[number], len(self.items[number])
            regions.setdefault((text, number), []).append((max(0, start - k), min(each[text].size, start + n + k)))
        for (text, number), spans in sorted(regions.items()):
            pattern, best = self.items[number], None
            for low, high in _merged(spans):
                ids = each[text][low:high].tolist()
                distance, end = search(pattern, ids)
                if distance <= self.budgets[number] and (best is None or distance < best[0]):
                    back = _myers(pattern[::-1], ids[:end][::-1], anchored=True)[1]
                    best = (distance, low + end - back, low + end)
            if best:
                yield text, number, *best


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def item_blocks(
    spark: SparkSession, items: DataFrame, key: str, text: str, rate: float, min_words: int, block_bytes: int
) -> list[Broadcast]:
    """The items in blocks of about ``block_bytes``, each read and shipped alone."""
    rows = items.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").cast("binary").alias("t"))
    total = rows.agg(F.sum(F.octet_length("t") + F.lit(64))).first()[0] or 0
    n = max(1, math.ceil(total / block_bytes))
    block = F.pmod(F.xxhash64("k", "t"), F.lit(n))
    blocks = []
    for i in range(n):
        found = [(r["k"], None if r["t"] is None else bytes(r["t"])) for r in rows.where(block == i).collect()]
        blocks.append(spark.sparkContext.broadcast(vars(Items(found, rate, min_words))))
    return blocks


def matches(
    spark: SparkSession, docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", rate: float = ERROR_RATE, min_words: int = MIN_WORDS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """doc_id, item_id, distance, start_word, end_word: the nearest place of each item in each document."""
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("t"))
    key = next(f for f in items.schema if f.name == item_id)
    schema = StructType([source.schema[0], StructField("item_id", key.dataType), *PLACE])
    out = spark.createDataFrame([], schema)
    key_type = pa.schema(items.select(F.col(f"`{item_id}`")).limit(0).toArrow().schema).field(0).type
    for block in item_blocks(spark, items, item_id, item_text, rate, min_words, block_bytes):

        def run(batches: Iterator[pa.RecordBatch], block: Broadcast = block) -> Iterator[pa.RecordBatch]:
            ready = Items.shipped(block.value)
            for batch in batches:
                rows = [
                    (text, key, *place)
                    for text, number, *place in ready.matches(batch.column(1).to_pylist())
                    for key in ready.keys[number]
                ]
                columns = list(zip(*rows, strict=True)) if rows else [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(columns[0], pa.int64())), pa.array(columns[1], key_type)]
                    + [pa.array(c, pa.int32()) for c in columns[2:]],
                    names=schema.fieldNames(),
                )

        out = out.union(source.mapInArrow(run, schema))
    return out


def keep_clean(
    spark: SparkSession, docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
    item_text: str = "text", rate: float = ERROR_RATE, min_words: int = MIN_WORDS, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with their own columns."""
    flag = StructType([StructField("\x00hit", BooleanType())])
    columns = [F.col(f"`{c}`") for c in docs.columns]
    for block in item_blocks(spark, items, item_id, item_text, rate, min_words, block_bytes):

        def rows(texts: list[bytes | None], block: Broadcast = block) -> list[Sequence]:
            hit = {text for text, *_ in Items.shipped(block.value).matches(texts)}
            return [[i in hit for i in range(len(texts))]]

        docs = add_columns(docs, text, flag, rows).where(~F.col("`\x00hit`")).select(*columns)
    return docs
