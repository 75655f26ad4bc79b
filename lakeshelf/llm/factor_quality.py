"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A document's features are its words (lower-cased, hashed to ``WORD_BUCKETS``; the value is the log
of the count, and all of them together have length one), statistics of its structure (lengths, shares of
kinds of characters, of repeated words and lines) and metadata columns (the log of a number
such as n_chars; whether it is missing).  Every feature has a weight and a vector of
``RANK`` factors; two features' interaction is the product of their vectors.  All pairs are scored
in time linear in the features, by the sum-of-squares identity:

    sum of x_i x_j <v_i, v_j> over pairs  =  1/2 * sum over factors of ((sum x_i v_i)^2 - sum (x_i v_i)^2)

Learning uses the labelled rows outside the held-out fold, at most ``FIT_ROWS`` of each
class (those with the least hashed ids).  Classes weigh alike in it, as many rows as they have; steps are
AdaGrad over seeded blocks.  The sample's features, no texts, come to the driver.  All
documents are then scored in tasks; the model is ``WORD_BUCKETS`` x (``RANK`` + 1) numbers.

Defined results: a null or empty text is scored by its structure and metadata alone.  Without usable
labels of both classes every document gets the share of label 1, or 0 without labels.  A null doc_id
belongs to no fold: not learnt from and not held out.  A document labelled twice has the lesser
quality; null labels do not count.  Of rows with one labelled doc_id the least text is learnt from; all
are scored.  A metadata column that is absent or null counts as missing.  Texts over ``PIECE`` bytes are
read piece by piece, whole.  An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from lakeshelf.llm.common import written

WORD_BUCKETS = 1 << 14
RANK = 8
FOLDS, HELD_OUT = 5, 0
FIT_ROWS = 3_000
EPOCHS = 8
BLOCK = 64
RATE = 0.1
DECAY = 1e-4
SEED = 11
THRESHOLD = 0.3
METADATA = ("n_chars",)
PIECE = 1 << 22
HELD_STD = 4.0  # statistics are held to so many standard deviations

# Kinds of bytes, told apart by a table.
UPPER, LOWER, DIGIT, SPACE, LINE_END, SYMBOL, OTHER, WIDE = range(8)
_SYMBOLS = b"#*$%&|<>"


def _kind(c: int) -> int:
    if c >= 128:
        return WIDE
    if c == 10:
        return LINE_END
    if c in b" \t\x0b\x0c\r":
        return SPACE
    if c in _SYMBOLS:
        return SYMBOL
    text = chr(c)
    return UPPER if text.isupper() else LOWER if text.islower() else DIGIT if text.isdigit() else OTHER


KINDS = np.array([_kind(c) for c in range(256)], np.uint8)
STATISTICS = (
    "bytes", "words", "word_length", "upper", "lower", "digit", "symbol", "other", "wide", "distinct_words",
    "symbol_words", "lines", "repeated_lines", "line_length", "longest_word",
)
_BREAK = re.compile(rb"[\x20\x09-\x0D]")


def pieces(text: bytes, most: int = PIECE) -> Iterator[bytes]:
    start = 0
    while start < len(text):
        stop = _BREAK.search(text, start + most)
        end = stop.start() if stop else len(text)
        yield text[start:end]
        start = end


def measured(text: bytes | None) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """(word buckets, their values, statistics in the order of ``STATISTICS``)."""
    text = text or b""
    buckets = np.zeros(WORD_BUCKETS)
    kinds = np.zeros(8, np.int64)
    n_words = n_distinct = n_marks = longest = 0
    for piece in pieces(text):
        kinds += np.bincount(KINDS[np.frombuffer(piece, np.uint8)], minlength=8)
        counts = Counter(piece.lower().split())
        n = np.fromiter(counts.values(), np.int64, len(counts))
        where = np.fromiter(map(crc32, counts), np.int64, len(counts)) % WORD_BUCKETS
        buckets += np.bincount(where, n, WORD_BUCKETS)
        n_words += int(n.sum())
        n_distinct += len(counts)
        n_marks += sum(k for w, k in counts.items() if w[0] in _SYMBOLS)
        longest = max(longest, max(map(len, counts), default=0))
    lines = [hash(line) for line in text.split(b"\n") if line.strip()]
    held = np.flatnonzero(buckets)
    values = np.log1p(buckets[held])
    size, letters = max(len(text), 1), max(len(text) - int(kinds[SPACE] + kinds[LINE_END]), 1)
    statistics = [
        math.log1p(len(text)), math.log1p(n_words), letters / max(n_words, 1),
        *(float(kinds[k]) / letters for k in (UPPER, LOWER, DIGIT, SYMBOL, OTHER, WIDE)),
        n_distinct / max(n_words, 1), n_marks / max(n_words, 1), math.log1p(len(lines)),
        1 - len(set(lines)) / max(len(lines), 1), math.log1p(size / max(len(lines), 1)), math.log1p(longest),
    ]
    return held, values / max(float(np.sqrt((values**2).sum())), 1e-9), statistics


def metadata_values(numbers: Sequence[float | None]) -> list[float]:
    """For each metadata column the log of its size and whether it is missing."""
    out = []
    for x in numbers:
        known = x is not None and math.isfinite(x)
        out += [math.log1p(abs(x)) if known else 0.0, 0.0 if known else 1.0]
    return out


class Machine:
    """The model: ``weights[i]``, ``factors[i]`` for word buckets, then statistics and metadata; standardised by mean and spread."""

    def __init__(self, n_dense: int, rank: int = RANK, seed: int = SEED) -> None:
        draw = np.random.default_rng(seed)
        size = WORD_BUCKETS + n_dense
        self.start, self.weights, self.factors = 0.0, np.zeros(size), draw.normal(0, 0.05, (size, rank))
        self.mean, self.spread = np.zeros(n_dense), np.ones(n_dense)
        self.draw = draw

    def numbers(self) -> tuple[float, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All that scoring needs, as plain arrays that any task can read."""
        return self.start, self.weights.astype(np.float32), self.factors.astype(np.float32), self.mean, self.spread

    @classmethod
    def of(cls, numbers: tuple[float, np.ndarray, np.ndarray, np.ndarray, np.ndarray]) -> "Machine":
        made = cls.__new__(cls)
        made.start, made.weights, made.factors, made.mean, made.spread = numbers
        return made

    def row(self, held: np.ndarray, values: np.ndarray, dense: Sequence[float]) -> tuple[np.ndarray, np.ndarray]:
        known = np.clip((np.asarray(dense) - self.mean) / self.spread, -HELD_STD, HELD_STD) / HELD_STD
        return np.concatenate((held, np.arange(WORD_BUCKETS, WORD_BUCKETS + known.size))), np.concatenate((values, known))

    def score(self, index: np.ndarray, value: np.ndarray) -> float:
        part = value[:, None] * self.factors[index]
        pairs = 0.5 * float((part.sum(axis=0) ** 2 - (part**2).sum(axis=0)).sum())
        line = self.start + float(value @ self.weights[index]) + pairs
        return 1 / (1 + math.exp(-min(max(line, -30.0), 30.0)))

    def learn(self, rows: list[tuple[np.ndarray, np.ndarray, Sequence[float]]], good: np.ndarray, epochs: int = EPOCHS) -> None:
        dense = np.array([r[2] for r in rows])
        self.mean, self.spread = dense.mean(axis=0), np.maximum(dense.std(axis=0), 1e-6)
        made = [self.row(*r) for r in rows]
        share = np.where(good > 0, 0.5 / max(good.mean(), 1e-9), 0.5 / max(1 - good.mean(), 1e-9))
        seen_w, seen_v, seen_0 = np.full(self.weights.size, 1e-6), np.full(self.factors.shape, 1e-6), 1e-6
        for _ in range(epochs):
            order = self.draw.permutation(len(made))
            for at in range(0, len(made), BLOCK):
                block = order[at : at + BLOCK]
                sizes = np.array([made[i][0].size for i in block])
                index, value = (np.concatenate([made[i][k] for i in block]) for k in (0, 1))
                owner, starts = np.repeat(np.arange(block.size), sizes), np.cumsum(sizes) - sizes
                part = value[:, None] * self.factors[index]
                sums = np.add.reduceat(part, starts)
                line = self.start + np.add.reduceat(value * self.weights[index], starts)
                line += 0.5 * (sums**2 - np.add.reduceat(part**2, starts)).sum(axis=1)
                off = (1 / (1 + np.exp(-np.clip(line, -30, 30))) - good[block]) * share[block] / block.size
                seen_0 += off.sum() ** 2
                self.start -= RATE * off.sum() / math.sqrt(seen_0)
                used, back = np.unique(index, return_inverse=True)
                each = (off[owner] * value)[:, None]
                slope_w = np.bincount(back, each[:, 0]) + DECAY * self.weights[used]
                slope_v = np.stack([np.bincount(back, column) for column in (each * (sums[owner] - part)).T], axis=1)
                slope_v += DECAY * self.factors[used]
                seen_w[used] += slope_w**2
                seen_v[used] += slope_v**2
                self.weights[used] -= RATE * slope_w / np.sqrt(seen_w[used])
                self.factors[used] -= RATE * slope_v / np.sqrt(seen_v[used])


def fold(doc_id: str = "doc_id"):
    """CRC-32 of the id as text, modulo ``FOLDS``; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS))


def _source(docs: DataFrame, doc_id: str, text: str, metadata: Sequence[str]) -> DataFrame:
    """doc_id, text and the metadata as numbers m0, m1, ...; an absent column is null."""
    numbers = [(F.col(f"`{c}`") if c in docs.columns else F.lit(None)).cast("double").alias(f"m{i}") for i, c in enumerate(metadata)]
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"), *numbers)


def _features(batch: pa.RecordBatch, first: int, count: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[float]]]:
    """The features of a batch's rows: text at column ``first``, metadata after it."""
    numbers = [batch.column(first + 1 + i).to_pylist() for i in range(count)]
    texts = batch.column(first).cast(pa.binary())
    for i in range(batch.num_rows):
        held, values, statistics = measured(texts[i].as_py())
        yield held, values, statistics + metadata_values([column[i] for column in numbers])


def fit_sample(spark: SparkSession, source: DataFrame, labels: DataFrame, label: str, fit_rows: int) -> DataFrame:
    """(doc_id, good, text, m0, ...): at most ``fit_rows`` labelled documents of each class, one row each."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    marked = known.groupBy("doc_id").agg((F.min(label) > 0).cast("int").alias("good")).where(fold() != HELD_OUT)
    marked = marked.join(source.where(fold() != HELD_OUT).select("doc_id").distinct(), "doc_id", "left_semi")
    marked = written(spark, marked, "marked")
    lot = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = marked.where("good = 1").orderBy(*lot).limit(fit_rows).union(marked.where("good = 0").orderBy(*lot).limit(fit_rows))
    ids = written(spark, ids, "fitrows")  # at most 2 * fit_rows rows, so it may be broadcast
    rest = [c for c in source.columns if c != "doc_id"]
    least = F.min(F.struct(*rest)).alias("one")
    return source.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "good").agg(least).select("doc_id", "good", "one.*")


def fit(spark: SparkSession, source: DataFrame, labels: DataFrame, label: str = "quality", fit_rows: int = FIT_ROWS,
        rank: int = RANK, epochs: int = EPOCHS, seed: int = SEED) -> tuple[Machine | None, float]:
    """(the machine, share of label 1); no machine without labels of both classes."""
    sample = fit_sample(spark, source, labels, label, fit_rows)
    n_meta = len(source.columns) - 2
    schema = StructType([sample.schema["doc_id"], sample.schema["good"], StructField("held", ArrayType(IntegerType())),
                         StructField("vals", ArrayType(DoubleType())), StructField("dense", ArrayType(DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = list(_features(batch, 2, n_meta))
            lists = [pa.array([m[k].tolist() if k < 2 else m[k] for m in made], t)
                     for k, t in enumerate((pa.list_(pa.int32()), pa.list_(pa.float64()), pa.list_(pa.float64())))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], names=schema.names)

    table = sample.mapInArrow(run, schema).toArrow().sort_by("doc_id")
    good = table.column("good").to_numpy().astype(float)
    share = float(good.mean()) if good.size else 0.0
    if len(set(good.tolist())) < 2:
        return None, share
    columns = [table.column(c) for c in ("held", "vals", "dense")]
    rows = [tuple(c[i].values.to_numpy(zero_copy_only=False) for c in columns) for i in range(table.num_rows)]
    machine = Machine(rows[0][2].size, rank, seed)
    machine.learn(rows, good, epochs)
    return machine, share


def score(spark: SparkSession, docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
          metadata: Sequence[str] = METADATA, fit_rows: int = FIT_ROWS, rank: int = RANK, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """doc_id, held_out, score, predicted: one row for each row of ``docs``."""
    source = _source(docs, doc_id, text, metadata)
    machine, share = fit(spark, source, labels, label, fit_rows, rank, epochs, seed)
    model = spark.sparkContext.broadcast(machine.numbers() if machine else None)
    schema = StructType([source.schema["doc_id"], StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Machine.of(model.value) if model.value else None
        for batch in batches:
            chances = [share] * batch.num_rows if held is None else [held.score(*held.row(*f)) for f in _features(batch, 1, len(metadata))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(chances, pa.float64())], names=schema.names)

    scored = source.mapInArrow(run, schema)
    return scored.select(
        "doc_id", F.coalesce(fold() == HELD_OUT, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
