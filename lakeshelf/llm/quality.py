"""Quality rules: zstandard compression bands over whole texts and fixed chunks.

Repetitive text compresses too well, random text (keys, encoded binaries) hardly
at all.  How well clean prose compresses depends on its length, so the limits do.

Given labels, the limits come from them: in each range of lengths from ``FIT_FROM``
bytes on, what nearly all texts of quality 1 keep to (``fitted``).  Learning uses all labelled rows outside
the held-out fold, repeated ones too; the limits are exact quantiles of them.
Under ``FIT_FROM`` bytes clean and bad texts overlap, so the wide limits of ``BANDS``
stay there, and in ranges with fewer than ``FIT_LEAST`` clean rows.  A document labelled
twice has the lesser quality; null ids and null labels do not count.

Defined results: a null or empty text has no word, all counts 0, ``base_failed``
true and ``kept`` false.  Repeated rows are each judged alone.  An empty table
gives an empty table.  Very long texts are read whole, chunk by chunk; the
last chunk starts a chunk's length before the end.  The band of its length alone judges a
text shorter than a chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from lakeshelf.llm.common import add_columns, written
from lakeshelf.llm.toxicity import HELD_OUT, fold
from lakeshelf.operators.quantiles import discrete_quantiles

LEVEL = 3
CHUNK_BYTES = 4096
# (bytes below which the band holds, least ratio, greatest ratio); the last has no end.
BANDS: tuple[tuple[float, float, float], ...] = (
    (256, 0.0, 2.6),
    (512, 1.1, 2.4),
    (1024, 1.25, 2.4),
    (2048, 1.4, 2.5),
    (4096, 1.5, 2.65),
    (8192, 1.5, 2.8),
    (32768, 1.6, 3.2),
    (float("inf"), 1.6, 4.0),
)
CHUNK_BAND = (1.4, 6.0)
CHUNK_SHARE = 0.1  # of a text's chunks may leave the chunk band

FIT_FROM = 1024
FIT_ENDS = (1536, 2048, 3072, 4096, 6144, 8192, 12288, 16384, 32768, 65536, 131072, float("inf"))
FIT_LEAST = 20
FIT_SHARE = 0.005  # of the clean rows may lie beyond either end, before the margins
FIT_MARGINS = (1.05, 1.02)  # below and above

Bands = tuple[tuple[tuple[float, float, float], ...], tuple[float, float]]

MEASURES = StructType(
    [StructField(n, LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [StructField("base_failed", BooleanType()), StructField("ratio", DoubleType())]
    + [StructField("n_chunks", LongType()), StructField("n_bad_chunks", LongType()), StructField("kept", BooleanType())]
)

_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"


def repeat_words(words: list[bytes], width: int = 3) -> int:
    """Words inside windows of ``width`` words that occur twice or more."""
    n = len(words)
    if n <= width:
        return 0
    ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
    each = np.fromiter(map(ids.__getitem__, words), np.int64, n)
    # Pairing step by step keeps the codes small enough for any vocabulary.
    codes, base = each[: n - width + 1], len(ids)
    for k in range(1, width):
        if codes.size and (int(codes.max()) + 1) * base >= 2**62:
            codes = np.unique(codes, return_inverse=True)[1]
        codes = codes * base + each[k : n - width + 1 + k]
    ordered = np.sort(codes)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not twice.size:
        return 0
    starts = np.isin(codes, np.unique(twice))
    covered = np.zeros(n, bool)
    for k in range(width):
        covered[k : n - width + 1 + k] |= starts
    return int(covered.sum())


def chunk_ratios(text: bytes, packer: zstandard.ZstdCompressor) -> list[float]:
    """Ratios of the text's chunks, all of full size: the last one ends with the text.  A shorter text has none."""
    starts = list(range(0, len(text) - CHUNK_BYTES + 1, CHUNK_BYTES))
    if starts and len(text) % CHUNK_BYTES:
        starts.append(len(text) - CHUNK_BYTES)
    return [CHUNK_BYTES / len(packer.compress(text[i : i + CHUNK_BYTES])) for i in starts]


def measure(
    text: bytes | None, packer: zstandard.ZstdCompressor, bands: Sequence[tuple[float, float, float]] = BANDS,
    chunk_band: tuple[float, float] = CHUNK_BAND,
) -> tuple:
    """One text's values in the order of ``MEASURES``."""
    text = text or b""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    dup_lines = len(lines) - len(set(lines))
    word_chars = len(text.decode("utf-8", "replace")) - (len(text) - len(text.translate(None, _SPACE)))
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    repeated = repeat_words(words)
    failed = len(words) < 50 or 100 * repeated > 50 * len(words)
    if not text:
        return 0, 0, 0, 0, 0, True, None, 0, 0, False
    ratio = len(text) / len(packer.compress(text))
    chunks = chunk_ratios(text, packer)
    bad = sum(not chunk_band[0] <= r <= chunk_band[1] for r in chunks)
    low, high = next((lo, hi) for end, lo, hi in bands if len(text) < end)
    kept = not failed and low <= ratio <= high and bad <= CHUNK_SHARE * len(chunks)
    return len(words), word_chars, symbols, dup_lines, repeated, failed, ratio, len(chunks), bad, kept


def fitted(spark: SparkSession, docs: DataFrame, labels: DataFrame, text: str = "text", fit_rows: int | None = None) -> Bands:
    """(bands, chunk band) of all labelled rows that pass the base rule; ``fit_rows`` takes so many labelled ids only."""
    marked = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("good"))
    chosen = marked.where(fold() != HELD_OUT)
    if fit_rows is not None:
        chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    names = ("size", "ratio", "least", "most")
    schema = StructType([StructField("size", LongType())] + [StructField(n, DoubleType()) for n in names[1:]])

    def rows(texts: list[bytes | None]) -> list[Sequence]:
        packer = zstandard.ZstdCompressor(level=LEVEL)
        made = []
        for t in texts:
            words = (t or b"").split()
            failed = len(words) < 50 or 100 * repeat_words(words) > 50 * len(words)
            chunks = [] if failed else chunk_ratios(t, packer)
            made.append((len(t or b""), None if failed else len(t) / len(packer.compress(t)), min(chunks, default=None), max(chunks, default=None)))
        return list(zip(*made, strict=True)) if made else [[]] * len(names)

    # Texts are measured where they lie: only their figures meet the labels in a shuffle.
    source = docs.select("doc_id", F.col(f"`{text}`").alias("text"))
    figures = add_columns(source, "text", schema, rows, ["doc_id"]).where("ratio IS NOT NULL")
    clean = figures.join(chosen.where("good > 0").select("doc_id"), "doc_id")
    part = F.lit(None).cast("int")
    for i, end in reversed(list(enumerate(FIT_ENDS))):
        part = F.when(F.col("size") < float(end), F.lit(i)).otherwise(part)
    part = F.when(F.col("size") >= FIT_FROM, part)
    values = [(part, "ratio"), (F.lit(len(FIT_ENDS)), "least"), (F.lit(len(FIT_ENDS) + 1), "most")]
    entries = F.array(*[F.struct(p.alias("part"), F.col(c).alias("value")) for p, c in values])
    every = written(spark, clean.select(F.inline(entries)).where("part IS NOT NULL AND value IS NOT NULL"), "fitvalues")
    ends = discrete_quantiles(every, ["part"], "value", {"low": FIT_SHARE, "high": 1 - FIT_SHARE})
    counts = every.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    # One row for each range of lengths that has values.
    found = {
        r["part"]: (r["low"] / FIT_MARGINS[0], r["high"] * FIT_MARGINS[1])
        for r in ends.join(counts, "part").where(F.col("n") >= FIT_LEAST).collect()
    }
    bands = [b for b in BANDS if b[0] <= FIT_FROM]
    for i, end in enumerate(FIT_ENDS):
        bands.append((end, *found.get(i, next(b[1:] for b in BANDS if end <= b[0]))))
    least, most = found.get(len(FIT_ENDS)), found.get(len(FIT_ENDS) + 1)
    return tuple(bands), (least[0], most[1]) if least and most else CHUNK_BAND


def quality(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None, bands: Bands = (BANDS, CHUNK_BAND)) -> DataFrame:
    """``keep`` (default: all columns) plus ``MEASURES``; one row for each row of ``docs``."""

    def rows(texts: list[bytes | None]) -> list[Sequence]:
        packer = zstandard.ZstdCompressor(level=LEVEL)
        made = [measure(t, packer, *bands) for t in texts]
        return list(zip(*made, strict=True)) if made else [[]] * len(MEASURES)

    return add_columns(docs, text, MEASURES, rows, keep)


def keep_good(docs: DataFrame, text: str = "text", bands: Bands = (BANDS, CHUNK_BAND)) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns only.

    The texts stay in the JVM's columns: the verdict is added under a name of its own.
    """
    flag = StructType([StructField("\x00kept", BooleanType())])

    def rows(texts: list[bytes | None]) -> list[Sequence]:
        packer = zstandard.ZstdCompressor(level=LEVEL)
        return [[measure(t, packer, *bands)[-1] for t in texts]]

    return add_columns(docs, text, flag, rows).where(F.col("`\x00kept`")).select(*[F.col(f"`{c}`") for c in docs.columns])
