"""Vector codes: each of a vector's parts is replaced by the nearest entry of that part's codebook.

Vectors become integers (``SCALE`` times a component, rounded down), so distances, sums and
ties are exact.  The codebooks are fitted to all vectors by Lloyd's rounds.  Every part
keeps its entry and the exact distance to it.  After a round it is known which entries moved:

* a part whose entry stayed compares the moved entries alone with its stored distance,
  since all others are as far as they were;
* a part whose entry moved looks at all entries again.

Of equally near entries the one with the lower index wins, in both cases.  The rounds get
cheaper as entries settle, and end early when none moves, which changes no result.

A round is one pass that reads and writes the table of vectors with codes and distances, and
one that sums parts by entry in every task; ``PARTS`` x ``ENTRIES`` entries come to the driver.
The table of the round before is removed once the next is written, so there are two at most.

Defined results: rows whose vector is null, or holds a null or a component that is not
finite, are dropped.  Scaled components are held to +-2**28, so 64 bits suffice.  The length is
that of the vector with the smallest id; vectors of other lengths are dropped.  A length that
the parts do not divide is filled up with zeros.  Repeated ids are rows like any others
(a smaller vector first, null ids last); with fewer than ``ENTRIES`` rows there are as many
entries as rows.  Null labels are one label.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from lakeshelf.session import new_path, remove_folder

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
MOST = 1 << 28
FEW_LABELS = 100_000  # so many label sums (a few MB) may be broadcast
ROWS = 4096  # vectors handled at a time


def whole_numbers(vectors: DataFrame, vec_id: str, vector: str, label: str, scale: int = SCALE) -> DataFrame:
    """vec_id, label, ints of the rows that are kept."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    held = lambda x: F.greatest(F.least(x * scale, F.lit(float(MOST))), F.lit(-float(MOST)))
    rows = vectors.select(
        F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").cast("array<double>").alias("v")
    )
    return rows.where(F.col("v").isNotNull() & finite).select(
        "vec_id", "label", F.transform("v", lambda x: F.floor(held(x)).cast("int")).alias("ints")
    )


def squared(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of (n, width) to (k, width), exact."""
    apart = parts[:, None, :] - entries[None, :, :]
    return np.einsum("nkw,nkw->nk", apart, apart)


def assign(parts: np.ndarray, books: np.ndarray, moved: np.ndarray, codes: np.ndarray, far: np.ndarray) -> None:
    """Brings codes and distances (n, parts) up to date in place, given which entries (parts, entries) moved."""
    for p in range(books.shape[0]):
        lost = moved[p][codes[:, p]]
        for rows, entries in ((np.flatnonzero(~lost), np.flatnonzero(moved[p])), (np.flatnonzero(lost), np.arange(books.shape[1]))):
            if not rows.size or not entries.size:
                continue
            found = squared(parts[rows, p], books[p][entries])
            first = found.argmin(axis=1)  # the lowest index of the nearest
            best, entry = found[np.arange(rows.size), first], entries[first]
            old, was = far[rows, p], codes[rows, p]
            take = lost[rows] | (best < old) | ((best == old) & (entry < was))
            far[rows, p], codes[rows, p] = np.where(take, best, old), np.where(take, entry, was)


def cut(column: pa.Array, rows: int, n_parts: int, width: int) -> np.ndarray:
    """An Arrow column of integer lists as (rows, parts, width), filled up with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(rows, -1)
    return np.pad(flat, ((0, 0), (0, n_parts * width - flat.shape[1]))).reshape(rows, n_parts, width)


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.arange(values.shape[0] + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.reshape(-1), kind))


def assigned(table: DataFrame, books: np.ndarray, moved: np.ndarray | None) -> DataFrame:
    """The table (vec_id, label, ints, codes, far) under new codebooks; without ``moved`` nothing is assigned yet."""
    schema = StructType([*[table.schema[c] for c in ("vec_id", "label", "ints")],
                         StructField("codes", ArrayType(IntegerType())), StructField("far", ArrayType(LongType()))])
    n_parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n = batch.num_rows
            parts = cut(batch.column(2), n, n_parts, width)
            if moved is None:
                codes, far = np.zeros((n, n_parts), np.int64), np.zeros((n, n_parts), np.int64)
                assign(parts, books, np.ones(books.shape[:2], bool), codes, far)
            else:
                codes, far = cut(batch.column(3), n, n_parts, 1)[:, :, 0], cut(batch.column(4), n, n_parts, 1)[:, :, 0]
                assign(parts, books, moved, codes, far)
            made = [_lists(codes, pa.int32()), _lists(far, pa.int64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), *made], names=schema.names)

    return table.mapInArrow(run, schema)


def entry_sums(table: DataFrame, books: np.ndarray) -> DataFrame:
    """(part, entry, place, total, n) over all vectors; a task hands on one row for each component of an entry."""
    names = ("part", "entry", "place", "total", "n")
    schema = StructType([StructField(c, LongType()) for c in names])
    n_parts, n_entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for batch in slices(batches):
            parts = cut(batch.column(0), batch.num_rows, n_parts, width)
            codes = cut(batch.column(1), batch.num_rows, n_parts, 1)[:, :, 0]
            for p in range(n_parts):
                np.add.at(total[p], codes[:, p], parts[:, p])
                count[p] += np.bincount(codes[:, p], minlength=n_entries)
        part, entry, place = (i.reshape(-1) for i in np.indices(books.shape))
        columns = [part, entry, place, total.reshape(-1), np.repeat(count.reshape(-1), width)]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=list(names))

    rows = table.select("ints", "codes").mapInArrow(run, schema).where("n > 0")
    return rows.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def fit(spark: SparkSession, vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
        n_parts: int = PARTS, n_entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, label, ints, codes, far) under the last codebooks, the codebooks as (parts, entries, width))."""

    def step(df: DataFrame, old: str | None) -> tuple[DataFrame, str]:
        path = new_path(spark, "vectors")
        df.write.parquet(path)
        if old is not None:
            remove_folder(spark, old)
        return spark.read.schema(df.schema).parquet(path), path

    kept, path = step(whole_numbers(vectors, vec_id, vector, label, scale), None)
    order = [F.col("vec_id").asc_nulls_last(), F.col("ints").asc()]
    first = kept.orderBy(*order).select(F.size("ints")).first()
    length = first[0] if first else 0
    table = kept.where(F.size("ints") == length)
    seeds = [r["ints"] for r in table.orderBy(*order).limit(n_entries).collect()]
    width = -(-length // n_parts)
    books = np.zeros((len(seeds), n_parts * width), np.int64)
    books[:, :length] = np.array(seeds, np.int64).reshape(len(seeds), length)
    books = books.reshape(len(seeds), n_parts, width).transpose(1, 0, 2).copy()
    moved = None
    for left in range(rounds, -1, -1):
        table, path = step(assigned(table, books, moved), path)
        if left == 0 or not seeds:
            break
        new = books.copy()
        for r in entry_sums(table, books).collect():
            new[r["part"], r["entry"], r["place"]] = r["total"] // r["n"]
        moved, books = (new != books).any(axis=2), new
        if not moved.any():
            break
    return table, books


def books_digest(books: np.ndarray) -> str:
    return sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compressed(spark: SparkSession, vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
               few_labels: int = FEW_LABELS, **shape: int) -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256: one row for each vector that is kept."""
    table, books = fit(spark, vectors, vec_id, vector, label, **shape)
    two = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    rows = table.select("vec_id", "label", two.alias("code"), F.aggregate("far", F.lit(0).cast("long"), lambda a, x: a + x).alias("error"))
    sums = rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    # Label sums are broadcast if they are few; beyond that the join is shuffled and AQE splits a hot label.
    if sums.count() <= few_labels:
        sums = F.broadcast(sums)
    joined = rows.join(sums, F.col("label").eqNullSafe(F.col("of")), "left")
    return joined.select("vec_id", "label", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
