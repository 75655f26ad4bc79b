"""Importance resampling towards a target corpus, on hashed runs of words.

Features of a text are all runs of one to ``WIDEST`` words, each hashed to a bucket.  What
a bucket is worth (its gain) is the log of how much more often the target texts hold it
than the corpus does; a document's weight is the sum over its features.  A seeded Gumbel
number is added to the weight, and the highest scores are drawn: sampling without
replacement in proportion to exp(weight).

The work on texts is done by Arrow kernels, a block of texts at a time: lower-case, split,
flatten, dictionary-encode.  A run of words is the pair of a shorter run's code and the next
word's code, read by shifting the array of codes; equal pairs are encoded again, so each
distinct run of a block is hashed once, from the CRC of its shorter run.  Buckets and gains are
then taken by code, and summed by document with running sums.

Two passes read the texts: one counts buckets (each task hands on at most one row for each
bucket), one weighs documents.  Only counts and gains of the buckets come to the driver.

Defined results: a null or empty text has no feature and weight 0.  A null doc_id is the
text "" in the hash and comes last among ties; repeated rows are rows like any others, each
drawn for itself.  Documents with fewer than ``LEAST_WORDS`` words are never drawn.  An empty
target or corpus gives the gains that the smoothing alone gives.  A text over ``BLOCK_BYTES`` is
read in pieces that carry the last words along.  An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from lakeshelf.llm.common import ordered_prefix, written

WIDEST = 3
BUCKETS = 10_000
LEAST_WORDS = 20
SHARE = (5, 100)
SEED = 42
SCALE = 1000
BLOCK_BYTES = 1 << 22

BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # what separates words once A-Z are lower-cased
_BREAK = re.compile(rb"[^0-9A-Za-z\x80-\xFF]")
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xFF]+")

Block = tuple[np.ndarray, pa.Array, np.ndarray]


def pieces(text: bytes, most: int, widest: int = WIDEST) -> Iterator[tuple[bytes, int]]:
    """A long text cut between words; each piece starts with the last words before it, whose number comes along."""
    start, tail = 0, []
    while start < len(text):
        stop = _BREAK.search(text, start + most)
        end = stop.start() if stop else len(text)
        piece = text[start:end]
        yield b" ".join([*tail, piece]), len(tail)
        tail = (tail + _WORD.findall(piece))[-(widest - 1) :] if widest > 1 else []
        start = end


def blocks(texts: pa.Array, most: int = BLOCK_BYTES) -> Iterator[Block]:
    """(row numbers, texts, words carried from the piece before) in blocks of about ``most`` bytes."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if held + size > most and row > start:
            yield np.arange(start, row), texts.slice(start, row - start), np.zeros(row - start, np.int64)
            start, held = row, 0
        if size > most:
            for piece, carried in pieces(texts[row].cast(pa.binary()).as_py(), most):
                yield np.array([row]), pa.array([piece], pa.binary()).cast(pa.string()), np.array([carried])
            start = row + 1
        else:
            held += size
    if start < len(texts):
        yield np.arange(start, len(texts)), texts.slice(start), np.zeros(len(texts) - start, np.int64)


def runs(texts: pa.Array, carried: np.ndarray, buckets: int = BUCKETS, widest: int = WIDEST) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each width the text and the bucket of every run, in the order of the texts.

    Runs that end in a carried word belong to the piece before and are left out.
    """
    lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), BETWEEN)
    words = pc.list_flatten(lists)
    full = pc.greater(pc.binary_length(words), 0)
    owner = pc.list_parent_indices(lists).filter(full).to_numpy()
    coded = words.filter(full).dictionary_encode()
    ids = coded.indices.to_numpy().astype(np.int64)
    known = coded.dictionary.cast(pa.binary()).to_pylist()
    spaced = [b" " + w for w in known]
    place = np.arange(ids.size) - np.searchsorted(owner, owner)
    crcs = np.array([crc32(w) for w in known], np.int64)
    code, at = ids, np.arange(ids.size)
    for width in range(1, widest + 1):
        if width > 1:
            last = at + width - 1
            inside = last < ids.size
            inside[inside] = owner[last[inside]] == owner[at[inside]]
            at = at[inside]
            pairs = pa.array(code[inside] * max(len(known), 1) + ids[at + width - 1]).dictionary_encode()
            code = pairs.indices.to_numpy().astype(np.int64)
            left, right = np.divmod(pairs.dictionary.to_numpy(), max(len(known), 1))
            crcs = np.array([crc32(spaced[r], c) for r, c in zip(right.tolist(), crcs.take(left).tolist(), strict=True)], np.int64)
        own = place[at + width - 1] >= carried[owner[at]]
        yield owner[at[own]], (crcs % buckets).take(code[own])


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS, widest: int = WIDEST) -> DataFrame:
    """(bucket, n): how many features of all texts fall in each bucket that has any."""
    schema = StructType([StructField("bucket", IntegerType()), StructField("n", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, block, carried in blocks(batch.column(0)):
                for _, found in runs(block, carried, buckets, widest):
                    total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], names=["bucket", "n"])

    counted = texts.select(F.col(f"`{text}`").cast("string")).mapInArrow(run, schema)
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket from the (bucket, n) tables of both sides, at most ``buckets`` rows each."""
    counts = []
    for table in (corpus, target):
        held = np.zeros(buckets)
        for row in table.collect():
            held[row["bucket"]] = row["n"]
        counts.append(held)
    s, t = counts
    return np.floor(SCALE * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, text: str = "text", widest: int = WIDEST) -> DataFrame:
    """The columns of ``docs`` but its text, plus n_words, n_features and weight."""
    names = [c for c in docs.columns if c != text]
    added = ("n_words", "n_features", "weight")
    schema = StructType([docs.schema[c] for c in names] + [StructField(c, LongType()) for c in added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.zeros((len(added), batch.num_rows), np.int64)
            for rows, block, carried in blocks(batch.column(len(names))):
                for width, (owner, found) in enumerate(runs(block, carried, gain.size, widest), 1):
                    ends = np.searchsorted(owner, np.arange(rows.size + 1))
                    so_far = np.concatenate((np.zeros(1, np.int64), np.cumsum(gain.take(found))))
                    made[0, rows] += np.diff(ends) if width == 1 else 0
                    made[1, rows] += np.diff(ends)
                    made[2, rows] += np.diff(so_far[ends])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(names))), *(pa.array(m) for m in made)], names=[*names, *added]
            )

    return docs.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text}`").cast("string")).mapInArrow(run, schema)


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """A seeded Gumbel number times ``SCALE``, rounded down."""
    head = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8)
    even = (F.conv(head, 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-float(SCALE)) * F.log(-F.log(even)))


def resample(spark: SparkSession, docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text",
             target_text: str = "text", share: tuple[int, int] = SHARE, least_words: int = LEAST_WORDS, seed: int = SEED,
             buckets: int = BUCKETS, widest: int = WIDEST) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank: one row for each row of ``docs``; rank is null for what is not drawn."""
    gain = gains(bucket_counts(docs, text, buckets, widest), bucket_counts(target, target_text, buckets, widest), buckets)
    narrow = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = weighed(narrow, gain, "text", widest).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    rows = written(spark, rows, "weighed")
    fit = rows.where(F.col("n_words") >= least_words)
    drawn = fit.count() * share[0] // share[1]
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").desc(), F.col("weight").desc()]
    ranked = ordered_prefix(spark, fit.withColumn("_one", F.lit(1)), order, "_one", "_before", name="drawn")
    rank = F.when(F.col("_before") < drawn, F.col("_before") + 1)
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    short = rows.where(F.col("n_words") < least_words).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, rank.alias("rank")).unionByName(short)
