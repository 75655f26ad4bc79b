"""Secret scans: known shapes, and sliding-window Shannon entropy of candidate strings.

All in Spark's own functions.  Known shapes are three patterns.  Candidates are runs
of a character class (hexadecimal digits; base64 letters); a window of fixed width goes
along the run; the counts of its characters are kept, one character enters and one leaves at a step,
and the entropy changes by their terms alone.  Where windows reach the class's threshold there is a span from
the first such window to the last.

The allow-list takes out harmless parts, not runs: a part is what lies between separators, and one
that holds a word such as "example" or an alphabet is left out, so a key behind ``sample_`` or
``/example/`` is still seen.  What remains is harmless as a whole if it is words alone or a UUID.

Defined results: a null or empty text has no span.  A run shorter than the window is no
candidate.  Repeated rows are scanned each.  An empty table gives an empty table.  Whole
texts are scanned; a long run is cut in pieces of ``PIECE`` characters that overlap by a window, so its
characters are never all held at once, and its cost grows with its length.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshelf.llm.native import let, located

KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")
BASE_KINDS = 3

# The three known shapes.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
# A run from its first AKIA, or of digits, is matched whole, so the least length may stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"


class CharClass(NamedTuple):
    kind: str
    letters: str
    window: int
    threshold: float


CLASSES = (CharClass("entropy_hex", "0-9A-Fa-f", 20, 2.9), CharClass("entropy_base64", "A-Za-z0-9+/=_-", 24, 4.0))

SEPARATORS = "/=_-"
# What makes a part harmless, and what makes the whole of a stretch so.
HARMLESS_WORDS = ("example", "sample", "dummy", "placeholder", "changeme", "abcdefghij", "0123456789", "1234567890")
HARMLESS_SHAPES = (
    r"^[a-z/_=-]+$",  # words joined by slashes or dashes
    r"^[A-Z]?[a-z]+$|^[A-Z]+$",  # one long word
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
)
PIECE = 4096


def _spans(kind: str, found: Column) -> Column:
    number = F.lit(KINDS.index(kind)).alias("kind")
    return F.transform(found, lambda x: F.struct(x["start"].alias("start"), number, x["end"].alias("end")))


def _none() -> Column:
    return F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")


def known_shapes(text: Column) -> Column:
    """Spans (start, kind, end) of the three patterns, in order."""
    assign = F.filter(located(text, ASSIGN, 2), lambda x: F.length(x["value"]) >= ASSIGN_LEAST)
    each = [
        F.when(text.rlike(regex), _spans(kind, found)).otherwise(_none())
        for kind, regex, found in (
            ("assign", ASSIGN, assign), ("access", ACCESS, located(text, ACCESS)), ("hex", HEX, located(text, HEX))
        )
    ]
    return F.array_sort(F.concat(*each))


def letters_of(c: CharClass) -> str:
    """The characters of a class, written out."""
    return "".join(x for x in map(chr, range(128)) if re.fullmatch(f"[{c.letters}]", x))


def high_entropy(value: Column, c: CharClass, piece: int = PIECE) -> Column:
    """(first, last): ends of the first and last window whose entropy is the threshold or more; 0 if none.

    For counts n of a window of width w, entropy = log2 w - (sum of n log2 n) / w.
    """
    letters, w = letters_of(c), c.window
    weight = F.array(*[F.lit(n * math.log2(n) if n else 0.0) for n in range(w + 2)])
    number = F.array(*[F.lit(letters.find(chr(i))) for i in range(128)])
    none = F.array_repeat(F.lit(0), F.lit(len(letters)))
    least = math.ceil(2**c.threshold - 1e-9)
    start = F.struct(none.alias("n"), F.lit(0.0).alias("s"), F.lit(0).alias("first"), F.lit(0).alias("last"))

    def scan(codes: Column, f: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            entering, leaving = F.get(codes, i - 1), F.coalesce(F.get(codes, i - (w + 1)), F.lit(-1))

            def state(m: Column) -> Column:
                # The one that leaves had m["out"] places, the one that enters has m["in"] without it.
                gone = F.when(leaving >= 0, F.get(f, m["out"]) - F.get(f, m["out"] - 1)).otherwise(F.lit(0.0))
                now = acc["s"] - gone + F.get(f, m["in"] + 1) - F.get(f, m["in"])
                counts = F.transform(acc["n"], lambda n, k: n + (k == entering).cast("int") - (k == leaving).cast("int"))
                high = (i >= w) & (F.lit(math.log2(w)) - now / w >= c.threshold)
                return F.struct(
                    counts.alias("n"), now.alias("s"), F.when(high & (acc["first"] == 0), i).otherwise(acc["first"]).alias("first"),
                    F.when(high, i).otherwise(acc["last"]).alias("last"),
                )

            out = F.coalesce(F.get(acc["n"], leaving), F.lit(0))
            into = F.get(acc["n"], entering) - (entering == leaving).cast("int")
            return let(F.struct(out.alias("out"), into.alias("in")), state)

        return F.aggregate(F.sequence(F.lit(1), F.size(codes)), start, step, lambda acc: F.struct(acc["first"], acc["last"]))

    def of_piece(pieces: Column, f: Column, table: Column) -> Column:
        def one(text: Column, k: Column) -> Column:
            # Each piece but the first starts with the characters that a window may still need.
            before = F.when(k > 0, F.right(F.get(pieces, k - 1), F.lit(w - 1))).otherwise(F.lit(""))
            codes = F.transform(F.split(F.concat(before, text), ""), lambda x: F.get(table, F.ascii(x)))
            shift = k * piece - F.when(k > 0, F.lit(w - 1)).otherwise(F.lit(0))
            # So many bits take so many different characters: most words and flat runs are settled by that.
            found = let(codes, lambda held: F.when(F.size(F.array_distinct(held)) >= least, scan(held, f)))
            return let(found, lambda x: F.when(x["first"] > 0, F.struct((x["first"] + shift).alias("first"), (x["last"] + shift).alias("last"))))

        return F.filter(F.transform(pieces, one), lambda x: x.isNotNull())

    def ends(found: Column) -> Column:
        first, last = F.transform(found, lambda x: x["first"]), F.transform(found, lambda x: x["last"])
        zero = F.lit(0)
        return F.struct(F.coalesce(F.array_min(first), zero).alias("first"), F.coalesce(F.array_max(last), zero).alias("last"))

    pieces = F.regexp_extract_all(value, F.lit(f"(?s).{{1,{piece}}}"), F.lit(0))
    held = F.struct(pieces.alias("p"), weight.alias("f"), number.alias("t"))
    return let(held, lambda v: let(of_piece(v["p"], v["f"], v["t"]), ends))


def stretches(run: Column, c: CharClass, words: Sequence[str]) -> Column:
    """(start, value) of what is left of a run (start, value) without its harmless parts."""
    whole = F.array(F.struct(run["start"].alias("start"), run["value"].alias("value")))
    if not words:
        return whole
    either = f"(?i:{'|'.join(words)})"
    part = f"[{''.join(x for x in letters_of(c) if x not in SEPARATORS)}]"
    # From the start of a part only, so each part is looked through once.
    harmless = f"(?<!{part}){part}*?{either}{part}*+"

    def gaps(found: Column) -> Column:
        def gap(k: Column) -> Column:
            start = F.coalesce(F.get(found, k - 1)["end"], F.lit(0).cast("long"))
            end = F.coalesce(F.get(found, k)["start"], F.length(run["value"]).cast("long"))
            value = F.substring(run["value"], (start + 1).cast("int"), (end - start).cast("int"))
            return F.struct((run["start"] + start).alias("start"), value.alias("value"))

        return F.transform(F.sequence(F.lit(0), F.size(found)), gap)

    return F.when(run["value"].rlike(either), let(located(run["value"], harmless), gaps)).otherwise(whole)


def entropy_spans(text: Column, classes: Sequence[CharClass], words: Sequence[str], shapes: Sequence[str], piece: int = PIECE) -> Column:
    """Spans (start, kind, end) of high-entropy parts of candidate runs."""
    each = [F.when(text.rlike(_run(c)), _of_class(text, c, words, shapes, piece)).otherwise(_none()) for c in classes]
    return F.concat(*each) if each else _none()


def _run(c: CharClass) -> str:
    return f"[{c.letters}]{{{c.window},}}"


def _of_class(text: Column, c: CharClass, words: Sequence[str], shapes: Sequence[str], piece: int) -> Column:
    number = F.lit(KINDS.index(c.kind)).alias("kind")

    def span(x: Column) -> Column:
        def ends(h: Column) -> Column:
            start, end = x["start"] + h["first"] - c.window, x["start"] + h["last"]
            return F.when(h["first"] > 0, F.struct(start.alias("start"), number, end.alias("end")))

        return let(high_entropy(x["value"], c, piece), ends)

    runs = F.flatten(F.transform(located(text, _run(c)), lambda x: stretches(x, c, words)))
    long = F.filter(runs, lambda x: (F.length(x["value"]) >= c.window) & ~_any(x["value"], shapes))
    return F.filter(F.transform(long, span), lambda x: x.isNotNull())


def _any(value: Column, patterns: Sequence[str]) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | value.rlike(p)
    return out


def secret_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", classes: Sequence[CharClass] = CLASSES,
                 words: Sequence[str] = HARMLESS_WORDS, shapes: Sequence[str] = HARMLESS_SHAPES, piece: int = PIECE) -> DataFrame:
    """doc_id, base and found: arrays of (start, kind, end) of known shapes and of high entropy; a row for each document."""
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    return source.select("doc_id", known_shapes(F.col("text")).alias("base"), entropy_spans(F.col("text"), classes, words, shapes, piece).alias("found"))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == KINDS.index(kind))).cast("long")
