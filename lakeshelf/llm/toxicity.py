"""Toxicity: class-conditional Kneser-Ney models over the letters of words.

Two letter models, one of toxic and one of ordinary text, share their backoff: the
continuation counts of shorter letter runs, pooled over both classes.  A rare
expression is thus judged by its class only as far as the class has seen it.  A text's
log-likelihoods under both are compared per word: over the whole text, and over the most
telling hundredth and fiftieth of its words, since toxic words are few among many.
These length-normalised differences go through a logistic curve.

Learning uses the labelled rows outside the held-out fold: counts come from all of folds
0 and 1, the curve from at most ``CURVE_ROWS`` rows of fold 3 (those with the least
hashed ids; of rows with one id the least text).  All events take part, whatever their number.  If they are few
enough to ship to tasks, words are looked up there; otherwise the different words of the documents, once
each, are joined with the events, and every block of documents meets the ratios of its words.
Both give the same scores.

Defined results: a null or empty text, or one without a letter or digit, gets the
toxic share of the rows of the curve.  Without usable labels of both classes every text
gets that share, or 0.  A null doc_id belongs to no fold, so it is not learnt from and not
held out.  A document labelled twice is toxic if any label says so; null labels do not
count.  Repeated documents are scored each.  Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, LongType, StructField, StructType

from lakeshelf.llm.common import add_columns, written

ORDER = 6
DISCOUNT = 0.9
TOP_SHARES = (0.01, 0.02)
MOST = 8.0  # what a share's mean counts for at most
FOLDS, HELD_OUT, CURVE_FOLD = 4, 2, 3
CURVE_ROWS = 20_000
FEW_EVENTS = 2_000_000  # so many events and histories (24 MB) are shipped to tasks; more are joined
THRESHOLD = 0.3
TASK_WORDS = 500_000  # distinct words a task gathers before it hands them on
CACHE_WORDS = 400_000
BLOCK_BYTES = 8 << 20  # of text that meets its words' ratios in a task

# ASCII but letters and digits separates words, so "^" and "$" can mark their ends.
_APART = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_FACTOR = 0x9E3779B97F4A7C15


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").decode("utf-8", "replace").lower().encode().translate(_APART).split()


def fold(doc_id: str = "doc_id"):
    """CRC-32 of the id as text, modulo ``FOLDS``; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS))


def word_counts(rows: DataFrame) -> DataFrame:
    """(text, toxic) -> (word, n1, n0): how often toxic and ordinary rows hold a word."""
    schema = StructType([StructField("word", BinaryType()), StructField("n1", LongType()), StructField("n0", LongType())])

    def flush(held: list[dict[bytes, int]]) -> pa.RecordBatch:
        words = list(held[0].keys() | held[1].keys())
        counts = [pa.array([held[y].get(w, 0) for w in words], pa.int64()) for y in (1, 0)]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), *counts], names=["word", "n1", "n0"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[bytes, int]] = [{}, {}]
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                mine = held[1 if toxic else 0]
                for word in words_of(text):
                    mine[word] = mine.get(word, 0) + 1
                if len(held[0]) + len(held[1]) > TASK_WORDS:
                    yield flush(held)
                    held = [{}, {}]
        yield flush(held)

    counted = rows.select(F.col("text").cast("binary"), "toxic").mapInArrow(run, schema)
    return counted.groupBy("word").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def events(words: DataFrame, order: int) -> DataFrame:
    """(gram, n1, n0): every letter with the up to ``order`` - 1 letters before it in the word."""
    marked = words.select(F.concat(F.lit("^"), F.col("word").cast("string"), F.lit("$")).alias("s"), "n1", "n0")
    grams = F.transform(
        F.sequence(F.lit(2), F.length("s")),
        lambda i: F.substring(F.col("s"), F.greatest(F.lit(1), i - (order - 1)), F.least(F.lit(order), i)),
    )
    each = marked.select(F.explode(grams).alias("gram"), "n1", "n0")
    return each.groupBy("gram").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def shared_backoff(spark: SparkSession, grams: DataFrame, order: int, discount: float) -> DataFrame:
    """(gram, p): probability of a run's last letter after the others, from pooled continuation counts."""
    lower: DataFrame | None = None
    tables = []
    for m in range(1, order):
        longer = grams.where(F.length("gram") > m).select(F.expr(f"right(gram, {m + 1})").alias("g")).distinct()
        seen = longer.select(F.substring("g", 2, m).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("c"))
        seen = seen.withColumn("h", F.expr(f"left(gram, {m - 1})"))
        total = seen.groupBy("h").agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("types"))
        joined = seen.join(total, "h")
        if lower is None:
            here = joined.select("gram", (F.col("c") / F.col("total")).alias("p"))
        else:
            shorter = lower.select(F.col("gram").alias("s"), F.col("p").alias("q"))
            p = (F.col("c") - discount) / F.col("total") + discount * F.col("types") / F.col("total") * F.col("q")
            here = joined.join(shorter, F.expr(f"right(gram, {m - 1})") == F.col("s")).select("gram", p.alias("p"))
        lower = written(spark, here, f"backoff{m}")
        tables.append(lower)
    out = tables[0]
    for table in tables[1:]:
        out = out.union(table)
    return out


def model_tables(spark: SparkSession, counted: DataFrame, order: int, discount: float) -> tuple[DataFrame, DataFrame]:
    """((gram, ratio) of seen events, (history, ratio) of a letter not seen after a history)."""
    totals = counted.groupBy(F.expr("left(gram, length(gram) - 1)").alias("h")).agg(
        *[F.sum(f"n{y}").alias(f"c{y}") for y in (0, 1)], *[F.sum((F.col(f"n{y}") > 0).cast("long")).alias(f"t{y}") for y in (0, 1)]
    )
    totals = written(spark, totals, "histories")
    backoff = shared_backoff(spark, counted.select("gram"), order, discount)

    def gamma(y: int):
        return F.when(F.col(f"c{y}") > 0, F.lit(discount) * F.col(f"t{y}") / F.col(f"c{y}")).otherwise(1.0)

    def probability(y: int):
        own = F.when(F.col(f"c{y}") > 0, F.greatest(F.col(f"n{y}") - discount, F.lit(0.0)) / F.col(f"c{y}")).otherwise(0.0)
        return own + gamma(y) * F.col("p")

    suffix = F.expr("right(gram, length(gram) - 1)")
    seen = (
        counted.withColumn("h", F.expr("left(gram, length(gram) - 1)")).join(totals, "h")
        .join(backoff.withColumnRenamed("gram", "s"), suffix == F.col("s"))
        .select("gram", F.log(probability(1) / probability(0)).alias("ratio"))
    )
    unseen = totals.select(F.col("h").alias("gram"), F.log(gamma(1) / gamma(0)).alias("ratio"))
    return seen, unseen


def codes(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every letter but the first of each text: codes of the run that ends there, of the run before it, and its text."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    letters = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
    place = np.arange(letters.size) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    mixed = (letters + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed ^= mixed >> np.uint64(29)

    def ending(width: int) -> np.ndarray:
        total = mixed.copy()
        for back in range(1, min(width, mixed.size)):
            factor = np.uint64(pow(_FACTOR, back, 2**64))
            total[back:] += np.where(place[back:] >= back, mixed[: mixed.size - back] * factor, np.uint64(0))
        return total

    inner = place > 0
    before = np.concatenate((np.zeros(1, np.uint64), ending(order - 1)[:-1])) if letters.size else mixed
    return ending(order)[inner], before[inner], np.repeat(np.arange(len(texts)), sizes)[inner]


def run_codes(table: DataFrame, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The (gram, ratio) rows as sorted codes and their ratios; at most ``FEW_EVENTS`` rows come to the driver."""
    schema = StructType([StructField("code", LongType()), StructField("ratio", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = batch.column(0).to_pylist()
            # Behind a stop letter the run before the last letter is the gram.
            found = codes([g + "$" for g in grams], order + 1)[1]
            last = np.cumsum(np.fromiter(map(len, grams), np.int64, len(grams))) - 1
            yield pa.RecordBatch.from_arrays([pa.array(found[last].view(np.int64)), batch.column(1)], names=["code", "ratio"])

    rows = table.mapInArrow(run, schema).toArrow()
    code, ratio = rows.column(0).to_numpy().view(np.uint64), rows.column(1).to_numpy().astype(np.float32)
    order_ = np.argsort(code)
    return code[order_], ratio[order_]


class Scorer:
    """Log-likelihood ratios of words, remembered for the words of a task."""

    def __init__(self, seen: tuple[np.ndarray, np.ndarray], unseen: tuple[np.ndarray, np.ndarray], order: int) -> None:
        self.seen, self.unseen, self.order = seen, unseen, order
        self.known: dict[bytes, float] = {}

    @staticmethod
    def look_up(table: tuple[np.ndarray, np.ndarray], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        code, ratio = table
        if not code.size:
            return np.zeros(wanted.size, bool), np.zeros(wanted.size, np.float32)
        at = np.minimum(np.searchsorted(code, wanted), code.size - 1)
        return code[at] == wanted, ratio[at]

    def learn(self, words: list[bytes]) -> None:
        run, before, owner = codes(["^" + w.decode("utf-8", "replace") + "$" for w in words], self.order)
        hit, ratio = self.look_up(self.seen, run)
        hit2, ratio2 = self.look_up(self.unseen, before)
        total = np.bincount(owner, np.where(hit, ratio, np.where(hit2, ratio2, 0)), len(words))
        self.known.update(zip(words, total.tolist(), strict=True))

    def features(self, text: bytes | None) -> tuple[int, float, float, float]:
        """(words, mean ratio of a word, means of the highest shares)."""
        words, known = words_of(text), self.known
        if not words:
            return 0, 0.0, 0.0, 0.0
        new = [w for w in dict.fromkeys(words) if w not in known]
        if new:
            if len(known) > CACHE_WORDS:
                known.clear()
                new = list(dict.fromkeys(words))
            self.learn(new)
        ratios = np.fromiter(map(known.__getitem__, words), np.float64, len(words))
        tops = [math.ceil(share * len(words)) for share in TOP_SHARES]
        highest = np.sort(np.partition(ratios, -tops[-1])[-tops[-1] :])[::-1]
        return len(words), float(ratios.mean()), *(min(float(highest[:k].mean()), MOST) for k in tops)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic curve by Newton steps; the constant is not penalised."""
    weights, penalty = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        grad = x.T @ (p - y) + penalty @ weights
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + penalty, grad)
        weights = weights - step
        if np.abs(step).max() < 1e-8:
            break
    return weights


FEATURES = StructType([StructField("n", LongType())] + [StructField(n, DoubleType()) for n in ("mean", "top1", "top2")])
NO_EVENTS = (np.zeros(0, np.uint64), np.zeros(0, np.float32))


def in_blocks(spark: SparkSession, docs: DataFrame, text: str, block_bytes: int) -> DataFrame:
    """``docs``, written, with the number of its block: rows of a task of about ``block_bytes`` together."""
    schema = StructType([*docs.schema, StructField("block", LongType())])
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            numbers = []
            for size in pc.fill_null(pc.binary_length(batch.column(at)), 0).to_pylist():
                if held and held + size > block_bytes:
                    number, held = number + 1, 0
                held += size + 1
                numbers.append(number)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())], names=schema.fieldNames())

    return written(spark, docs.mapInArrow(run, schema), "blocks")


def words_of_blocks(blocks: DataFrame) -> DataFrame:
    """(block, word): the different words of each block."""
    schema = StructType([StructField("block", LongType()), StructField("word", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, set()

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now] * len(held), pa.int64()), pa.array(list(held), pa.binary())], names=schema.fieldNames())

        for batch in batches:
            for block, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if block != now:
                    if held:
                        yield flush()
                    now, held = block, set()
                held.update(words_of(text.as_py()))
        if held:
            yield flush()

    return blocks.select("block", F.col("text").cast("binary")).mapInArrow(run, schema).distinct()


def word_ratios(words: DataFrame, seen: DataFrame, unseen: DataFrame, order: int) -> DataFrame:
    """(word, ratio) of different words, by joining each letter's run, or else its history, with the events."""
    marked = words.select("word", F.concat(F.lit("^"), F.col("word").cast("string"), F.lit("$")).alias("s"))
    runs = F.transform(
        F.sequence(F.lit(2), F.length("s")),
        lambda i: F.substring(F.col("s"), F.greatest(F.lit(1), i - (order - 1)), F.least(F.lit(order), i)),
    )
    each = marked.select("word", F.explode(runs).alias("gram")).withColumn("h", F.expr("left(gram, length(gram) - 1)"))
    # Lighter numbers, as those that are shipped.
    hit = seen.select("gram", F.col("ratio").cast("float").alias("hit"))
    miss = unseen.select(F.col("gram").alias("h"), F.col("ratio").cast("float").alias("miss"))
    joined = each.join(hit, "gram", "left").join(miss, "h", "left")
    return joined.groupBy("word").agg(F.sum(F.coalesce("hit", "miss", F.lit(0.0)).cast("double")).alias("ratio"))


def joined_features(spark: SparkSession, source: DataFrame, tables: tuple[DataFrame, DataFrame], order: int, keep: list[str], block_bytes: int) -> DataFrame:
    """``keep`` and ``FEATURES`` of each row (doc_id, text, ...): blocks of rows meet the ratios of their words."""
    blocks = in_blocks(spark, source.select(*keep, F.col("text")), "text", block_bytes)
    words = written(spark, words_of_blocks(blocks), "blockwords")
    ratios = word_ratios(words.select("word").distinct(), *tables, order)
    known = words.join(ratios, "word")
    schema = StructType([blocks.schema[c] for c in keep] + list(FEATURES))

    def run(rows: pa.Table, held: pa.Table) -> pa.Table:
        scorer = Scorer(NO_EVENTS, NO_EVENTS, order)
        scorer.known = dict(zip(held.column("word").to_pylist(), held.column("ratio").to_pylist(), strict=True))
        made = list(zip(*[scorer.features(None if t is None else t.encode()) for t in rows.column("text").to_pylist()], strict=True))
        columns = [pa.array(c, pa.int64() if f.name == "n" else pa.float64()) for c, f in zip(made, FEATURES, strict=True)]
        return pa.Table.from_arrays([*(rows.column(c) for c in keep), *columns], names=schema.fieldNames())

    return blocks.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(run, schema)


def shipped_features(spark: SparkSession, source: DataFrame, tables: tuple[DataFrame, DataFrame], order: int, keep: list[str]) -> DataFrame:
    """The same, the events shipped to tasks."""
    model = spark.sparkContext.broadcast(tuple(run_codes(t, order) for t in tables))

    def features(texts: list[bytes | None]) -> list:
        scorer = Scorer(*model.value, order)
        return list(zip(*[scorer.features(t) for t in texts], strict=True)) if texts else [[]] * 4

    return add_columns(source, "text", FEATURES, features, keep)


def score(spark: SparkSession, docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          order: int = ORDER, discount: float = DISCOUNT, few_events: int = FEW_EVENTS, curve_rows: int = CURVE_ROWS,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, score, predicted, n_words, mean_ratio, top1, top2: one row for each row of ``docs``."""
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    marked = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counting = marked.where((fold() != HELD_OUT) & (fold() != CURVE_FOLD)).hint("shuffle_hash")
    rows = source.where((fold() != HELD_OUT) & (fold() != CURVE_FOLD)).join(counting, "doc_id").select("text", "toxic")
    counted = written(spark, events(word_counts(rows), order), "events")
    tables = tuple(written(spark, t, "model") for t in model_tables(spark, counted, order, discount))
    few = sum(t.count() for t in tables) <= few_events

    def features(rows: DataFrame, keep: list[str]) -> DataFrame:
        if few:
            return shipped_features(spark, rows, tables, order, keep)
        return joined_features(spark, rows, tables, order, keep, block_bytes)

    sample = marked.where(fold() == CURVE_FOLD).orderBy(F.xxhash64("doc_id"), "doc_id").limit(curve_rows)
    sample = written(spark, sample, "curverows")  # at most curve_rows rows, so it may be broadcast
    one_each = source.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    held = sorted(features(one_each, ["doc_id", "toxic"]).collect())
    share = float(np.mean([r["toxic"] > 0 for r in held])) if held else 0.0
    known = [r for r in held if r["n"] > 0]
    y = np.array([float(r["toxic"] > 0) for r in known])
    if len(set(y.tolist())) == 2:
        x = np.array([(1.0, r["mean"], r["top1"], r["top2"]) for r in known])
        spread = np.maximum(x[:, 1:].std(axis=0), 1e-9)
        fitted = logistic(np.column_stack((x[:, 0], x[:, 1:] / spread)), y)
        weights = [float(fitted[0]), *(fitted[1:] / spread).tolist()]
    else:
        weights = [math.log(max(share, 1e-9) / max(1 - share, 1e-9)), 0.0, 0.0, 0.0]

    line = F.lit(weights[0])
    for weight, name in zip(weights[1:], FEATURES.fieldNames()[1:], strict=True):
        line = line + weight * F.col(name)
    chance = F.when(F.col("n") > 0, 1 / (1 + F.exp(-line))).otherwise(F.lit(share))
    scored = features(source, ["doc_id"])
    return scored.select(
        "doc_id", F.coalesce(fold() == HELD_OUT, F.lit(False)).alias("held_out"), chance.alias("score"),
        (chance >= THRESHOLD).cast("int").alias("predicted"),
        F.col("n").alias("n_words"), F.col("mean").alias("mean_ratio"), "top1", "top2",
    )
