"""Exact distinct counts of integer codes, from bitmaps that are kept and merged.

Several ``count(DISTINCT ...)`` in one aggregate make Spark expand every row once for each of
them, and a coarser grain has to count from the rows again.  Here a grain is counted once: the
codes of each key set bits in words of 64 codes each, and coarser grains are the union of those
words.  A word is one long of a hash aggregate with a map-side combine, so a task holds words, not codes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COLUMN, BUCKET, BITS = "_column", "_bucket", "_bits"
WORD = 6  # 2**6 codes in a word


def code_bitmaps(df: DataFrame, keys: Sequence[str], codes: Mapping[str, str]) -> DataFrame:
    """(keys, _column, _bucket, _bits): for each key and name of ``codes`` the codes of that column as bitmaps.

    NULL codes do not count; a key without any code has no row.
    """
    names = F.array(*[F.lit(n) for n in codes])
    entries = F.array(*[F.struct(F.lit(i).alias("_at"), F.col(c).cast("long").alias("_code")) for i, c in enumerate(codes.values())])
    pairs = df.select(*keys, F.inline(entries)).where(F.col("_code").isNotNull())
    place = F.col("_code").bitwiseAND(F.lit(2**WORD - 1)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place)
    words = pairs.groupBy(*keys, "_at", F.shiftright("_code", WORD).alias(BUCKET)).agg(F.bit_or(bit).alias(BITS))
    return words.select(*keys, F.get(names, F.col("_at")).alias(COLUMN), BUCKET, BITS)


def merged_bitmaps(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same at coarser ``keys``."""
    return bitmaps.groupBy(*keys, COLUMN, BUCKET).agg(F.bit_or(BITS).alias(BITS))


def distinct_counts(bitmaps: DataFrame, keys: Sequence[str], names: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """(keys, one count for each name); a name without codes counts 0."""
    count = F.bit_count(BITS)
    return bitmaps.groupBy(*keys).agg(*[F.sum(F.when(F.col(COLUMN) == n, count).otherwise(0)).alias(n) for n in names])
