"""Token ids in ORC files: run-length encoded integers, row indexes, Bloom filters on document ids.

Documents are range-sorted by id, so files and the stripes in them are disjoint
id ranges: a look-up skips files and stripes by their statistics and then by
Bloom filter, and stripes are read in parallel.  Each file row holds the ids of one
document, the number of its file (``part``) and the ids before it in that file
(``before``), so a document's place in the whole stream needs only one total per file.

A task takes its rows in blocks of bounded bytes.  Where the tokenizer drops white space and never
joins across it, the different words of a block (runs without ASCII white space) are encoded
once each and put in place by index, so the ids are those of the whole texts; any other tokenizer
gets whole texts.  What a task remembers between blocks is bounded in bytes.

Defined results: a null or empty text has only the end id.  Null doc_ids come
first; equal doc_ids are ordered by a hash of their texts, equal rows are
interchangeable.  An empty table writes no row and reads back empty.
"""

from __future__ import annotations

import json
import math
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType
from tokenizers import Tokenizer

from lakeshelf.llm.common import written
from lakeshelf.session import new_path

END_ID = 1
FILE_BYTES = 32 << 20  # of text in a file
MOST_FILES = 8192  # at any size: tasks of the range sort, which stream their rows
BLOCK_BYTES = 4 << 20  # of text encoded at a time
KEPT_BYTES = 24 << 20  # of words a task remembers from block to block
BATCH_ROWS = 1000  # rows that Spark hands to a task at a time
ENTRY_BYTES = 170  # that a remembered word takes besides its letters and ids
ORC = {
    "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.row.index.stride": "2000",
    "orc.stripe.size": str(32 << 20), "orc.create.index": "true", "compression": "snappy",
}


def by_words(model: str) -> bool:
    """Whether the tokenizer never joins across white space, lower-cases, and marks the ends of words with ``</w>``."""
    held = json.loads(model)
    normal, first = held.get("normalizer") or {}, held.get("pre_tokenizer") or {}
    first = (first.get("pretokenizers") or [first])[0]
    lower = any(n.get("type") == "Lowercase" for n in normal.get("normalizers") or [normal])
    dropped = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
    return lower and dropped and held["model"].get("end_of_word_suffix") == "</w>"


class Encoder:
    """Texts to ids: the different words of a block once each, then all places by index.

    Words are remembered in two generations; when the young one holds half of ``KEPT_BYTES`` it
    becomes the old one, which is forgotten then.  So they hold that and the words of a block at most.  A tokenizer that is not ``by_words`` gets whole texts.
    """

    def __init__(self, model: str, end_id: int) -> None:
        # A task has one core; threads of the library would each keep buffers of their own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.model, self.end = Tokenizer.from_str(model), np.array([end_id], "<i4").tobytes()
        self.by_words = by_words(model)
        self.ends = np.zeros(self.model.get_vocab_size(with_added_tokens=True), bool)
        self.ends[[i for token, i in self.model.get_vocab().items() if token.endswith("</w>")]] = True
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.held = 0

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, where each text's ids end), the end id included; ``texts`` is binary."""
        if not self.by_words:
            whole = [(t or b"").decode("utf-8", "replace") for t in texts.to_pylist()]
            made = [np.array(e.ids + [0], "<i4") for e in self.model.encode_batch_fast(whole, add_special_tokens=False)]
            for ids in made:
                ids[-1:] = np.frombuffer(self.end, "<i4")
            return np.concatenate([*made, np.zeros(0, "<i4")]), np.cumsum([m.size for m in made], dtype=np.int64)
        words, owner = split_words(texts)
        coded = words.dictionary_encode()
        found = self.ids_of(coded.dictionary.to_pylist())
        # The end id is one more word, put in after the last word of each text.
        per_text = np.bincount(owner, minlength=len(texts))
        places = np.insert(coded.indices.to_numpy().astype(np.int64), np.cumsum(per_text), len(found))
        found.append(self.end)
        flat = np.frombuffer(b"".join(found), "<i4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts, lengths = (np.cumsum(sizes) - sizes)[places], sizes[places]
        stops = np.cumsum(lengths)
        at = np.arange(stops[-1] if stops.size else 0, dtype=np.int32)  # a block has far fewer than 2**31 ids
        at += np.repeat((starts - (stops - lengths)).astype(np.int32), lengths)
        return flat[at], stops[np.cumsum(per_text + 1) - 1]

    def ids_of(self, words: list[bytes]) -> list[bytes]:
        """The ids of different words."""
        if self.held > KEPT_BYTES // 2:
            self.old, self.young, self.held = self.young, {}, 0
        young, old = self.young, self.old
        new = [w for w in words if w not in young]
        if old:
            again = [w for w in new if w in old]
            young.update((w, old[w]) for w in again)
            new = [w for w in new if w not in young]
        self.learn(new, young)
        made = list(map(young.__getitem__, words))
        self.held = sum(map(len, young)) + sum(map(len, young.values())) + ENTRY_BYTES * len(young)
        return made

    def learn(self, words: list[bytes], made: dict[bytes, bytes]) -> None:
        """Words of letters alone are one token run each, so many go in one text and are cut at word ends."""
        letters, others = [], []
        for word in words:
            (letters if word.isalpha() or (not word.isascii() and word.decode("utf-8", "replace").isalpha()) else others).append(word)
        groups = [letters[i : i + 64] for i in range(0, len(letters), 64)]
        for i in range(0, len(groups), 32):
            part = groups[i : i + 32]
            texts = [b" ".join(g).decode("utf-8", "replace") for g in part]
            for group, result in zip(part, self.model.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                ids = np.array(result.ids, "<i4")
                cuts = np.flatnonzero(self.ends[ids]) + 1
                if cuts.size != len(group):  # not one run a word after all
                    others += group
                    continue
                data, cuts = ids.tobytes(), (4 * cuts).tolist()
                made.update((w, data[a:b]) for w, a, b in zip(group, [0, *cuts], cuts))
        for i in range(0, len(others), 2000):
            part = others[i : i + 2000]
            results = self.model.encode_batch_fast([w.decode("utf-8", "replace") for w in part], add_special_tokens=False)
            made.update((w, np.array(x.ids, "<i4").tobytes()) for w, x in zip(part, results, strict=True))


# Marks after a letter are a token run of their own, so they may stand alone.  Not so apostrophes, which may
# belong to the word, and marks after capitals, which may become a letter and a mark.
_MARKS = r"([\p{Ll}\p{Lo}])([!-&(-/:-@\[-`{-~]+)(\s|$)"


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words, the text of each): parts that the tokenizer never joins.  It lower-cases anyway, so fewer different ones
    are left to encode; texts that may hold a special token stay as they are."""
    text = pc.cast(pc.fill_null(texts, b""), options=pc.CastOptions(target_type=pa.string(), allow_invalid_utf8=True))
    lower = pc.replace_substring_regex(pc.ascii_lower(text), _MARKS, r"\1 \2\3")
    lists = pc.ascii_split_whitespace(pc.if_else(pc.match_substring(text, "<|"), text, lower))
    words = pc.list_flatten(lists)
    full = pc.greater(pc.binary_length(words), 0)
    binary = pc.cast(words.filter(full), pa.binary())
    return binary, pc.list_parent_indices(lists).filter(full).to_numpy()


def blocks(batches: Iterator[pa.RecordBatch], column: int, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of a task in blocks of about ``most`` bytes of text; a longer text is a block of its own."""
    held, size = [], 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = 0
        for row in range(batch.num_rows):
            if size and size + sizes[row] > most:
                yield pa.concat_batches([*held, batch.slice(start, row - start)])
                held, size, start = [], 0, row
            size += int(sizes[row])
        held.append(batch.slice(start))
    if held:
        yield pa.concat_batches(held)


def write_tokens(spark: SparkSession, docs: DataFrame, model: str, path: str, doc_id: str = "doc_id", text: str = "text",
                 end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> None:
    """One ORC folder at ``path``: doc_id, part, before, ids, ascending by doc_id.

    ``model`` is the content of a tokenizer file.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("t"))
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, math.ceil(total / file_bytes), min(2 * spark.sparkContext.defaultParallelism, math.ceil(total / (1 << 20))))
    n = min(n, MOST_FILES)
    rows = rows.withColumn("h", F.xxhash64("t")).withColumn("row", F.monotonically_increasing_id())
    order = [F.col("doc_id").asc_nulls_first(), F.col("h"), F.col("row")]
    rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select("doc_id", "t")
    schema = StructType(
        [rows.schema[0], StructField("part", IntegerType()), StructField("before", LongType()), StructField("ids", ArrayType(IntegerType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, encoder = TaskContext.get().partitionId(), 0, Encoder(model, end_id)
        for block in blocks(batches, 1, BLOCK_BYTES):
            ids, ends = encoder.encode(block.column(1))
            for i in range(0, block.num_rows, 1024):
                mine = ends[i : i + 1024]
                first = int(ends[i - 1]) if i else 0
                offsets = np.concatenate(([first], mine))
                lists = pa.ListArray.from_arrays(pa.array((offsets - first).astype(np.int32)), pa.array(ids[first : int(mine[-1])]))
                yield pa.RecordBatch.from_arrays(
                    [block.column(0).slice(i, mine.size), pa.array(np.full(mine.size, part, np.int32)), pa.array(before + offsets[:-1]), lists],
                    names=schema.fieldNames(),
                )
            before += int(ends[-1]) if ends.size else 0
            del block, ids, ends, lists
            pa.default_memory_pool().release_unused()

    writer = rows.mapInArrow(run, schema).write
    for key, value in ORC.items():
        writer = writer.option(key, value)
    # Batches of whole texts are held on both sides of the pipe, so they are kept small for this write.
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(name)
    spark.conf.set(name, str(min(BATCH_ROWS, int(old)) if int(old) > 0 else BATCH_ROWS))
    try:
        writer.orc(path)
    finally:
        spark.conf.set(name, old)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, part, before, ids as in the files; filters on doc_id reach stripes and Bloom filters."""
    return spark.read.orc(path)


def digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, from the files."""
    files = read_tokens(spark, path)
    id_field = next(f for f in files.schema if f.name == "doc_id")
    schema = StructType(
        [id_field, StructField("part", IntegerType())]
        + [StructField(n, LongType()) for n in ("before", "n_tokens", "ids_crc32")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(3)
            flat, ends = ids.flatten().to_numpy().astype("<u4", copy=False), ids.offsets.to_numpy() - ids.offsets[0].as_py()
            view = memoryview(np.ascontiguousarray(flat)).cast("B")
            crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(np.diff(ends).astype(np.int64)), pa.array(crc, pa.int64())],
                names=schema.fieldNames(),
            )

    table = written(spark, files.select("doc_id", "part", "before", "ids").mapInArrow(run, schema), "tokendigests")
    # One row for each file.
    window = Window.partitionBy().orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = table.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    shift = totals.select("part", F.coalesce(F.sum("n").over(window), F.lit(0)).alias("shift"))
    return table.join(F.broadcast(shift), "part").select(
        "doc_id", (F.col("before") + F.col("shift")).alias("start"), "n_tokens", "ids_crc32"
    )


def tokenized(spark: SparkSession, docs: DataFrame, model_path: str, doc_id: str = "doc_id", text: str = "text",
              end_id: int = END_ID) -> DataFrame:
    """Writes the files of ``docs`` to the shared folder and returns what they hold, as ``digests``."""
    with open(model_path, encoding="utf-8") as file:  # a file of the installed package, on the driver
        model = file.read()
    path = new_path(spark, "tokens")
    write_tokens(spark, docs, model, path, doc_id, text, end_id)
    return digests(spark, path)
