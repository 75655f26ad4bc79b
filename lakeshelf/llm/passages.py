"""Substring dedup: collinear chains of shared word seeds find passages that repeat across documents.

1. Seeds.  Hashed runs of ``K`` words, of all places those whose hash is a multiple of ``KEEP``: the
   same runs in every text.  A passage of 50 words or more of which a fifth is replaced leaves four words
   in a row somewhere; with ``keep=1`` such a run is always a seed, otherwise every second on average.
2. Join.  A seed found in several texts leads from each of them to one place, in the
   text with the least hash among them: links grow with the seeds, not with their pairs.
   Texts of one task meet there, in numpy; what is left meets in one shuffle by seed, sorted, so the first
   place of a seed comes first and the others stream by.  A seed of very many texts sends on a few rows for each task.
3. Chains.  The links of two texts, ordered in both, are chained for the best score
   of links less gap costs; a Fenwick tree over the second text's places gives the best
   link to go on from.
4. Alignment.  Gaps between links are aligned by edit distance, the ends are
   extended by edit distance in a band; runs of ``RUN`` words or more with few edits stay.
5. Passages.  Runs of a text that touch are joined; from ``PASSAGE`` words on they
   count.  One row for each document and passage.

Where two texts agree a little beyond what either shares with the text the seeds lead
to, the passage ends where that sharing ends.

Equal texts are one text in steps 1 to 4 (they share a 64-bit hash, taken as
identity); each of their documents gets the text's passages, and all but the one with
the least doc_id a row for the whole text.

Words are runs of letters and digits, lower-cased.  Defined results: null and empty
texts, and texts shorter than a passage, give no rows.  Repeated rows are equal texts; a
null doc_id is kept, and comes last in choosing the least.  Empty tables give no rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, IntegerType, LongType, StructField, StructType

from lakeshelf.llm.common import join_split, parts_for, written

K = 4
KEEP = 2  # every second run is a seed, by its hash; 1 takes every run
CHUNK = 1 << 21  # occurrences that a task sorts at a time
STRETCH = 10  # a run that comes again within so few words is numbered
THIN = 8  # of links that follow each other word by word, every eighth is chained, and both ends
GAP_COST = 1 / 64  # of a link, for each word skipped in either text
MAX_GAP = 64  # words between neighbours of a chain
EXTEND = 48  # words tried beyond either end; more than seeds can leave out
DROP = 6  # an extension ends when its score falls so far below its best
BAND = 6  # words put in or left out that an extension bears
LEAST_AHEAD = 4  # equal words ahead without which there is nothing to gain
RUN = 20
PASSAGE = 50
EDITS = 0.2  # of a run's words
OUT_ROWS = 100_000  # rows of a batch
PART_BYTES = 32 << 20  # of texts whose seeds meet in a task

_APART = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def word_codes(text: bytes | None) -> np.ndarray:
    """A 32-bit code of each word."""
    words = (text or b"").decode("utf-8", "replace").lower().encode().translate(_APART).split()
    return np.fromiter(map(zlib.crc32, words), np.uint32, len(words))


def seeds(codes: np.ndarray, k: int = K, keep: int = KEEP) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the runs of ``k`` words, those whose hash is a multiple of ``keep``."""
    n = codes.size - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(31)
    run = mixed[:n].copy()
    for j in range(1, k):
        run = run * np.uint64(0xD6E8FEB86659FD93) + mixed[j : n + j]
    run ^= run >> np.uint64(32)
    run *= np.uint64(0xD6E8FEB86659FD93)
    run ^= run >> np.uint64(29)
    at = np.flatnonzero(run % np.uint64(keep) == 0) if keep > 1 else np.arange(n)
    found = run[at]
    # In a stretch of repeated words every ``STRETCH``-th place of a run stays, as itself
    # and with its number in the stretch, so that stretches also link in order.
    order = np.lexsort((at, found))
    at, found = at[order], found[order]
    again = np.concatenate(([False], (found[1:] == found[:-1]) & (np.diff(at) < STRETCH)))
    stretch = np.arange(at.size) - np.maximum.accumulate(np.where(again, 0, np.arange(at.size)))
    stay = stretch % STRETCH == 0
    at, found, stretch = at[stay], found[stay], stretch[stay]
    numbered = stretch > 0
    counted = found[numbered] + stretch[numbered].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return np.concatenate((at, at[numbered])), np.concatenate((found, counted)).view(np.int64)


PLACED = StructType(
    [StructField("key", LongType()), StructField("th", LongType()), StructField("pos", IntegerType()),
     StructField("rth", LongType()), StructField("rpos", IntegerType())]
)
LINK = StructType(PLACED.fields[1:])
WORDS = StructType([StructField("th", LongType()), StructField("words", BinaryType())])


def _hashed(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.xxhash64(F.col(f"`{text}`")).alias("th"), F.col(f"`{text}`").cast("binary").alias("t"))


def led(seed: np.ndarray, th: np.ndarray, pos: np.ndarray) -> pa.RecordBatch:
    """Occurrences of a task as rows of ``PLACED``: what is to meet by seed, and links that need not.

    The least text of each seed leads it here: its places go on under the seed, all other texts
    link to its first place at once.  So a seed in very many texts sends on a row or two for each
    ``CHUNK`` occurrences, not one for each text.
    """
    order = np.lexsort((pos, th, seed))
    seed, th, pos = seed[order], th[order], pos[order]
    new = np.ones(seed.size, bool)
    new[1:] = seed[1:] != seed[:-1]
    lead = np.maximum.accumulate(np.where(new, np.arange(seed.size), 0))
    own = th == th[lead]
    key, rth, rpos = np.where(own, seed, th), th[lead], pos[lead]
    # Text by text again: what neighbours share compresses in the shuffle.
    back = np.lexsort((pos, th))
    key, th, pos, rth, rpos, own = (x[back] for x in (key, th, pos, rth, rpos, own))
    return pa.RecordBatch.from_arrays(
        [pa.array(key), pa.array(th), pa.array(pos), pa.array(rth, mask=own), pa.array(rpos, mask=own)], names=PLACED.fieldNames()
    )


def occurrences(hashed: DataFrame, keep: int = KEEP, chunk: int = CHUNK) -> DataFrame:
    """``PLACED`` rows of all texts; a task takes equal texts once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                rows = led(*(np.concatenate(x) for x in zip(*held, strict=True)))
                held.clear()
                for i in range(0, rows.num_rows, OUT_ROWS):
                    yield rows.slice(i, OUT_ROWS)

        for batch in batches:
            for th, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if th not in done:
                    done.add(th)
                    at, found = seeds(word_codes(text.as_py()), keep=keep)
                    held.append((found, np.full(at.size, th, np.int64), at.astype(np.int32)))
                    size += at.size
                    if size > chunk:
                        yield from flush()
                        size = 0
        yield from flush()

    return hashed.mapInArrow(run, PLACED)


def links(placed: DataFrame) -> DataFrame:
    """(th, pos, rth, rpos): each place beside the first place of its seed's least text, from one shuffle.

    ``placed`` is dealt by key and sorted, so the places of a seed stream by, the first one leading;
    a seed in one text only goes no further.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first = None, (0, 0)  # the seed that the batch before ended in, and its lead
        for batch in batches:
            open_ = pc.is_null(batch.column(3))
            there = batch.filter(pc.invert(open_))
            yield pa.RecordBatch.from_arrays(there.columns[1:], names=LINK.fieldNames())
            rows = batch.filter(open_)
            if not rows.num_rows:
                continue
            seed, th, pos = (rows.column(i).to_numpy() for i in range(3))
            new = np.ones(seed.size, bool)
            new[1:] = seed[1:] != seed[:-1]
            new[0] = seed[0] != now
            lead = np.maximum.accumulate(np.where(new, np.arange(seed.size), -1))
            rth = np.where(lead >= 0, th[lead], first[0])
            rpos = np.where(lead >= 0, pos[lead], first[1]).astype(np.int32)
            now, first = seed[-1], (rth[-1], rpos[-1])
            other = th != rth
            yield pa.RecordBatch.from_arrays([pa.array(x[other]) for x in (th, pos, rth, rpos)], names=LINK.fieldNames())

    return placed.mapInArrow(run, LINK)


def text_words(hashed: DataFrame) -> DataFrame:
    """(th, words): two bytes of each word's code; a task gives equal texts once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in batches:
            ids, held = [], []
            for th, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if th not in done:
                    done.add(th)
                    ids.append(th)
                    held.append((word_codes(text) >> np.uint32(16)).astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(held, pa.binary())], names=["th", "words"])

    return hashed.mapInArrow(run, WORDS)


class Fenwick:
    """Greatest (value, link) over a prefix of places."""

    def __init__(self, n: int) -> None:
        self.best: list[tuple[float, int]] = [(float("-inf"), -1)] * (n + 1)

    def raise_to(self, place: int, value: tuple[float, int]) -> None:
        i = place + 1
        while i < len(self.best):
            if value > self.best[i]:
                self.best[i] = value
            i += i & -i

    def before(self, place: int) -> tuple[float, int]:
        out, i = (float("-inf"), -1), place
        while i > 0:
            out = max(out, self.best[i])
            i -= i & -i
        return out


def chains(links: list[tuple[int, int]], gap_cost: float = GAP_COST, max_gap: int = MAX_GAP) -> list[list[tuple[int, int]]]:
    """Chains of links that ascend in both texts; every link is in one, the best are taken first."""
    links = sorted(set(links))
    rank = {y: i for i, y in enumerate(sorted({y for _, y in links}))}
    tree, score, back = Fenwick(len(rank)), [0.0] * len(links), [-1] * len(links)
    i = 0
    while i < len(links):
        j = i
        while j < len(links) and links[j][0] == links[i][0]:  # links of one place do not follow each other
            x, y = links[j]
            value, before = tree.before(rank[y])
            gain = value - gap_cost * (x + y)
            score[j], back[j] = (1 + gain, before) if gain > 0 else (1.0, -1)
            j += 1
        for n in range(i, j):
            x, y = links[n]
            tree.raise_to(rank[y], (score[n] + gap_cost * (x + y), n))
        i = j
    out, used = [], [False] * len(links)
    for end in sorted(range(len(links)), key=lambda n: (-score[n], n)):
        chain, n = [], end
        while n >= 0 and not used[n]:
            used[n] = True
            if chain and max(chain[-1][0] - links[n][0], chain[-1][1] - links[n][1]) > max_gap:
                out.append(chain[::-1])
                chain = []
            chain.append(links[n])
            n = back[n]
        if chain:
            out.append(chain[::-1])
    return out


def thinned(group: np.ndarray, x: np.ndarray, y: np.ndarray, thin: int = THIN) -> np.ndarray:
    """Which links stay, of all groups at once: not those given twice, nor most of those that lie between two
    neighbours on their diagonal; what they join stays joined."""
    shift = x.astype(np.int64) - y
    order = np.lexsort((x, shift, group))
    g, d, p = group[order], shift[order], x[order]
    same = np.zeros(g.size, bool)
    same[1:] = (g[1:] == g[:-1]) & (d[1:] == d[:-1])
    step = np.zeros(g.size, np.int64)
    step[1:] = np.where(same[1:], np.diff(p), 0)
    twice = same & (step == 0)
    # Neighbours among different links: those given twice are passed over.
    held = np.flatnonzero(~twice)
    follows = np.zeros(g.size, bool)
    follows[held[1:]] = same[held[1:]] & (p[held[1:]] - p[held[:-1]] == 1)
    followed = np.zeros(g.size, bool)
    followed[held[:-1]] = follows[held[1:]]
    stay = np.zeros(g.size, bool)
    stay[order] = ~twice & ((p % thin == 0) | ~follows | ~followed)
    return stay


def distance(a: np.ndarray, b: np.ndarray) -> int:
    """Edit distance of two short word runs."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a.tolist(), 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b.tolist(), 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def extend(a: np.ndarray, b: np.ndarray, wide: bool = True) -> tuple[int, int, int]:
    """(words of a, words of b, edits) of the best pair of beginnings: a word gained for an equal one, two lost for an edit.

    First place by place.  Where that ends before the texts do, and if ``wide``, by edit distance in a band of
    ``BAND`` words, for words put in or left out; only if some words ahead are equal at all.
    """
    n = min(a.size, b.size)
    if not n:
        return 0, 0, 0
    same = a[:n] == b[:n]
    score = np.cumsum(np.where(same, 1, -2))
    low = np.flatnonzero(np.maximum.accumulate(np.maximum(score, 0)) - score > DROP)
    score = score[: low[0]] if low.size else score
    length = int(score.argmax()) + 1 if score.size and score.max() > 0 else 0
    best = (length - 3 * int((~same[:length]).sum()), length, length, int((~same[:length]).sum()))
    ahead = min(a.size, b.size) - length
    if not wide or ahead < LEAST_AHEAD:
        return best[1:]
    x, y = a[length : length + BAND + LEAST_AHEAD], b[length : length + BAND + LEAST_AHEAD]
    if np.isin(x, y).sum() < LEAST_AHEAD:
        return best[1:]
    return max(best, banded(a.tolist(), b.tolist()), key=lambda t: t[0])[1:]


def banded(a: list[int], b: list[int], band: int = BAND, drop: int = DROP) -> tuple[int, int, int, int]:
    """(score, words of a, words of b, edits) of the best pair of beginnings within the band."""
    far = -(10**9)
    row = {j: (-2 * j, j) for j in range(min(band, len(b)) + 1)}  # place in b -> (score, edits)
    best = (0, 0, 0, 0)
    for i, x in enumerate(a, 1):
        made: dict[int, tuple[int, int]] = {}
        for j in range(max(0, i - band), min(len(b), i + band) + 1):
            found = (far, 0)
            if j and j - 1 in row:
                s, e = row[j - 1]
                found = (s + 1, e) if x == b[j - 1] else (s - 2, e + 1)
            for near in (row.get(j), made.get(j - 1)):
                if near is not None and near[0] - 2 > found[0]:
                    found = (near[0] - 2, near[1] + 1)
            if found[0] > far:
                made[j] = found
                if found[0] > best[0]:
                    best = (found[0], i, j, found[1])
        row = made
        # Beyond the end of b by more than the band no place is left.
        if not row or max(s for s, _ in row.values()) < best[0] - drop:
            break
    return best


def align(a: np.ndarray, b: np.ndarray, chain: list[tuple[int, int]], k: int = K) -> tuple[int, int, int, int, int]:
    """(start, end, start, end, edits) in two word runs of the passage around ``chain``."""
    edits = 0
    for (x, y), (x2, y2) in zip(chain, chain[1:]):
        if x2 - x == y2 - y:
            edits += int((a[x:x2] != b[y:y2]).sum())
        else:  # from where the link's own words end, or by the shift if links overlap
            gap_a, gap_b = a[x + k : x2], b[y + k : y2]
            edits += max(distance(gap_a, gap_b), abs((x2 - x) - (y2 - y)))
    (x, y), (x2, y2) = chain[0], chain[-1]
    x2, y2 = x2 + k, y2 + k
    # Beyond a word put in there are seeds again, unless the passage ends there; a chain of one or two links has no such end.
    wide = x2 - x >= RUN // 2
    left_a, left_b, more = extend(a[max(0, x - EXTEND) : x][::-1], b[max(0, y - EXTEND) : y][::-1], wide)
    right_a, right_b, yet = extend(a[x2 : x2 + EXTEND], b[y2 : y2 + EXTEND], wide)
    return x - left_a, x2 + right_a, y - left_b, y2 + right_b, edits + more + yet


CHAIN = StructType(
    [StructField(n, LongType()) for n in ("th", "rth")]
    + [StructField(n, IntegerType()) for n in ("alo", "alen", "blo", "blen")]
    + [StructField("places", BinaryType())]
)


def pairs_of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """(th, rth, pos, rpos) of sorted links, cut between text pairs."""
    held: tuple[np.ndarray, ...] | None = None
    for batch in batches:
        now = tuple(batch.column(i).to_numpy() for i in (0, 2, 1, 3))
        if held is not None:
            now = tuple(np.concatenate(c) for c in zip(held, now, strict=True))
        if not now[0].size:
            continue
        cuts = np.flatnonzero((now[0] != now[0][-1]) | (now[1] != now[1][-1]))
        end = int(cuts[-1]) + 1 if cuts.size else 0
        if end:
            yield tuple(c[:end] for c in now)
        held = tuple(c[end:] for c in now)
    if held is not None and held[0].size:
        yield held


def chained(linked: DataFrame) -> DataFrame:
    """Links sorted by text pair -> one row for each chain: the stretch of either text to align, and the chain's places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for th, rth, pos, rpos in pairs_of_texts(batches):
            new = np.ones(th.size, bool)
            new[1:] = (th[1:] != th[:-1]) | (rth[1:] != rth[:-1])
            stay = thinned(np.cumsum(new), pos, rpos)
            starts = np.flatnonzero(np.concatenate(([True], np.diff(np.cumsum(new)[stay]) > 0)))
            a, b, x, y = (c[stay] for c in (th, rth, pos, rpos))
            places = list(zip(x.tolist(), y.tolist(), strict=True))
            rows = []
            for start, end in zip(starts.tolist(), [*starts[1:].tolist(), x.size], strict=True):
                mine = places[start:end]
                for chain in chains(mine) if len(mine) > 1 else [mine]:
                    (x1, y1), (x2, y2) = chain[0], chain[-1]
                    alo, blo = max(0, x1 - EXTEND), max(0, y1 - EXTEND)
                    inside = np.array([(p - alo, q - blo) for p, q in chain], "<i4").tobytes()
                    rows.append((int(a[start]), int(b[start]), alo, x2 + K + EXTEND - alo, blo, y2 + K + EXTEND - blo, inside))
            types = [pa.int64()] * 2 + [pa.int32()] * 4 + [pa.binary()]
            for i in range(0, len(rows), OUT_ROWS):
                columns = zip(*rows[i : i + OUT_ROWS], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=CHAIN.fieldNames())

    return linked.mapInArrow(run, CHAIN)


ALIGNED = StructType(
    [StructField("th", LongType()), StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("rth", LongType())]
    + [StructField(n, IntegerType()) for n in ("rstart", "rend", "edits")]
)


def aligned(stretches: DataFrame) -> DataFrame:
    """(th, rth, alo, blo, places, a, b) -> runs that are near enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for th, rth, alo, blo, places, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                chain = [tuple(p) for p in np.frombuffer(places, "<i4").reshape(-1, 2).tolist()]
                x, x2, y, y2, edits = align(np.frombuffer(a, "<u2"), np.frombuffer(b, "<u2"), chain)
                if x2 - x >= RUN and edits <= EDITS * (x2 - x):
                    rows.append((th, alo + x, alo + x2, rth, blo + y, blo + y2, edits))
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(ALIGNED)
            types = [pa.int64(), pa.int32(), pa.int32(), pa.int64()] + [pa.int32()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=ALIGNED.fieldNames())

    return stretches.mapInArrow(run, ALIGNED)


PASSAGES = StructType(
    [StructField("th", LongType()), StructField("start_word", IntegerType()), StructField("end_word", IntegerType())]
    + [StructField("first", BooleanType()), StructField("sth", LongType())]
    + [StructField(n, IntegerType()) for n in ("source_start", "source_end", "edits")]
)


def joined_runs(runs: list[dict], touch: int = 2) -> Iterator[tuple]:
    """Runs of one text that touch, joined: (start, end, first, source text, its start and end, edits)."""
    held: list[dict] = []
    for run in [*sorted(runs, key=lambda r: (r["start"], r["end"])), None]:
        if held and (run is None or run["start"] > max(r["end"] for r in held) + touch):
            start, end = held[0]["start"], max(r["end"] for r in held)
            if end - start >= PASSAGE:
                later = [r for r in held if r["rth"] is not None]
                if later:
                    r = max(later, key=lambda r: (r["end"] - r["start"], -r["start"], -r["rth"]))
                    yield start, end, False, r["rth"], r["rstart"], r["rend"], r["edits"]
                else:
                    yield start, end, True, None, start, end, 0
            held = []
        if run is not None:
            held.append(run)


def passages_of_texts(runs: DataFrame) -> DataFrame:
    """(th, runs) -> ``PASSAGES``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(th, *p) for th, held in zip(*(c.to_pylist() for c in batch.columns), strict=True) for p in joined_runs(held)]
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(PASSAGES)
            types = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64()] + [pa.int32()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=PASSAGES.fieldNames())

    return runs.mapInArrow(run, PASSAGES)


def repeated_passages(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: int = KEEP) -> DataFrame:
    """doc_id, start_word, end_word, first, source_doc_id, source_start, source_end, edits.

    ``first`` marks the place that stays; the others name the document and place they repeat.
    """
    hashed = _hashed(docs, text)
    ids = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("th"), F.octet_length(F.col(f"`{text}`")).cast("long").alias("size")
    )
    ids = written(spark, ids, "texthashes")

    size = ids.agg(F.sum("size")).first()[0] or 0
    n = max(parts_for(spark), math.ceil(size / PART_BYTES))
    placed = occurrences(hashed, keep).repartition(n, "key").sortWithinPartitions("key", "th", "pos")
    linked = links(placed).repartition(n, "th", "rth").sortWithinPartitions("th", "rth", "pos", "rpos")
    chain = written(spark, chained(linked), "chains")

    texts = ids.groupBy("th").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    texts = written(spark, texts, "texts")
    copied = texts.where("n > 1")
    wanted = chain.select("th").union(chain.select(F.col("rth").alias("th"))).union(copied.select("th")).distinct()
    words = text_words(hashed).join(wanted, "th").groupBy("th").agg(F.max("words").alias("words"))
    words = written(spark, words, "textwords")

    def stretch(lo: str, n: str):
        return F.substring("words", F.col(lo) * 2 + 1, F.col(n) * 2)

    left = chain.join(words, "th").select("th", "rth", "alo", "blo", "blen", "places", stretch("alo", "alen").alias("a"))
    both = left.join(words.withColumnRenamed("th", "rth"), "rth")
    runs = aligned(both.select("th", "rth", "alo", "blo", "places", "a", stretch("blo", "blen").alias("b")))
    runs = written(spark, runs, "runs")
    # The places that others lead to: one for each start, so no more than the text has words.
    sources = runs.groupBy(F.col("rth").alias("th"), F.col("rstart").alias("start")).agg(F.max("rend").alias("end"))
    none = F.lit(None)
    every = runs.select("th", "start", "end", "rth", "rstart", "rend", "edits").union(
        sources.select("th", "start", "end", none.cast("long"), none.cast("int"), none.cast("int"), none.cast("int"))
    )
    per_text = every.groupBy("th").agg(F.collect_list(F.struct("start", "end", "rth", "rstart", "rend", "edits")).alias("runs"))
    found = written(spark, passages_of_texts(per_text), "passages")

    source = texts.select(F.col("th").alias("sth"), F.col("first_id").alias("source_doc_id"))
    named = found.join(source, "sth", "left")
    # A text's documents get all of its passages: rows of one text that has very many copies are not dealt by it.
    per_th = named.groupBy("th").agg(F.collect_list(F.struct(*[c for c in named.columns if c != "th"])).alias("p"))
    per_th = written(spark, per_th.join(texts.select("th", "n"), "th"), "named")
    parts = join_split(ids.select("doc_id", "th"), per_th, "th", "n").select("doc_id", F.inline("p")).select(
        "doc_id", "start_word", "end_word", "first", F.when(F.col("first"), F.col("doc_id")).otherwise(F.col("source_doc_id")).alias("source_doc_id"),
        "source_start", "source_end", "edits",
    )
    size = (F.octet_length("words") / 2).cast("int")
    whole = copied.join(words, "th").where(size >= PASSAGE).select("th", "first_id", size.alias("words"), "n")
    zero = F.lit(0)
    copies = join_split(ids.select("doc_id", "th"), written(spark, whole, "copied"), "th", "n").select(
        "doc_id", zero.alias("start_word"), F.col("words").alias("end_word"), F.col("doc_id").eqNullSafe(F.col("first_id")).alias("first"),
        F.col("first_id").alias("source_doc_id"), zero.alias("source_start"), F.col("words").alias("source_end"), zero.alias("edits"),
    )
    return parts.union(copies)
