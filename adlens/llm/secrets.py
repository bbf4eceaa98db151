"""Secret scan: fixed patterns, and sliding-window Shannon entropy over candidate strings.

All of it is one projection of built-in functions: no shuffle, no Python on the
executors, whole texts.  Matches come from ``regexp_extract_all``; their places
come from ``split`` by the same pattern, as pieces and matches alternate.

Entropy spans: candidates are runs of key characters.  Each belongs to the first
character class of ``CLASSES`` that holds all of it, and a window slides over it
while an array counts each character of the window: every step adds one count,
takes one off and moves the sum of c*log2(c) by the two changes (whole numbers,
in millionths, so no rounding error gathers).  A window is hot when its entropy
reaches the class's threshold; the span runs from the first hot window to the
last.  The allow-list covers identifiers that are random but public, and words like
"example": a window that holds a covered character is not hot.  A span inside a
pattern's span is not said twice.

Places are running sums, taken in blocks of ``BLOCK`` and then over the blocks, and a span
finds the patterns' spans around it by bisection: a text with many matches costs
little more than its length.

Defined results: null text is empty, with no spans; a null doc_id is carried
through; repeated rows are scanned one by one; only doc_id and text are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import let

# Fixed by the contract: kind, pattern, test of a match.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"  # the same spans as runs of [0-9a-f]+ with 16 or more

KINDS = ["assign", "access", "hex", "entropy"]

WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
COVERED = "~"  # stands for a character that no hot window may hold; in no candidate
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-" + COVERED
# (class, all characters of the candidate, least bits per character in a window).  Random keys reach these
# in nearly all lengths from 32 on; letters and digits count between separators only, as words and numbers joined say nothing.
CLASSES = [("digits", r"^[0-9+/_=-]+$", 2.85), ("letters", r"^[A-Za-z+/_=-]+$", 3.7), ("hex", r"^[0-9A-Fa-f]+$", 3.0),
           ("alnum", r"^[A-Za-z0-9]+$", 3.6), ("base64", r"^[A-Za-z0-9+/_=-]+$", 3.7)]
SEPARATORS = "+/_=-"
# Random-looking but public, or no secret at all.  The first two are covered where they stand, so what lies beside them is still
# found; the others are about a candidate as a whole.
ALLOW_WORDS = ["example", "sample", "dummy", "placeholder", "changeme", "your_key", "your-key", "yourkey", "0123456789", "1234567890", "9876543210"]
ALLOW_UUID = r"(?<![0-9a-fA-F])[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![0-9a-fA-F])"
ALLOW = [
    r"^[A-Za-z]{2,19}(?:[-_/=+][A-Za-z]{2,19}|[-_/=+][0-9]{1,4})+$",  # words and small numbers joined: slugs, paths
    r"^[a-z]{0,19}(?:[A-Z][a-z]{2,18})+$",  # words joined by their capitals
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[0-9T_-]*$",  # dates
]

_SPAN = "array<struct<start:bigint,kind:int,end:bigint,value:string>>"


BLOCK = 256


def _running(values: Column, first: Column, combine) -> Column:
    """For an array of longs, ``combine`` of ``first`` and all values before each place, and last of all values."""
    zero = lambda of: F.struct(of.alias("at"), F.array().cast("array<bigint>").alias("out"))

    def fold(values: Column, of: Column) -> Column:
        return F.aggregate(values, zero(of), lambda acc, v: F.struct(
            combine(acc["at"], v).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))

    def blocks(values: Column) -> Column:
        n = F.size(values)
        starts = F.when(n > 0, F.sequence(F.lit(1), n, F.lit(BLOCK))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: fold(F.slice(values, i, F.lit(BLOCK)), first))

    def join(blocks: Column) -> Column:
        whole = fold(F.transform(blocks, lambda b: b["at"]), first)
        return let(whole, lambda w: F.concat(
            F.flatten(F.zip_with(blocks, w["out"], lambda b, before: F.transform(b["out"], lambda x: combine(before, x)))), F.array(w["at"])))

    return let(let(values, blocks), join)


def _found(text: Column, pattern: str, kind: int, test) -> Column:
    """Spans of the matches that pass ``test``, leftmost and non-overlapping, in order."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def place(m: Column, pieces: Column) -> Column:
        ends = F.zip_with(m, pieces, lambda m, p: (F.length(m) + F.length(p)).cast("long"))
        spans = F.zip_with(m, _running(ends, F.lit(0).cast("long"), lambda a, b: a + b), lambda m, at: F.struct(m.alias("value"), at.alias("at")))
        spans = F.zip_with(F.slice(spans, F.lit(1), F.size(m)), pieces, lambda s, p: let(
            s["at"] + F.length(p), lambda begin: F.struct(begin.alias("start"), F.lit(kind).alias("kind"), (begin + F.length(s["value"])).alias("end"), s["value"].alias("value"))))
        return spans.cast(_SPAN)

    pieces = lambda m: F.slice(F.split(text, pattern, -1), F.lit(1), F.size(m))  # noqa: E731 - one more than matches: they alternate
    spans = let(matches, lambda m: F.when(F.size(m) == 0, F.array().cast(_SPAN)).otherwise(let(pieces(m), lambda p: place(m, p))))
    return F.filter(spans, lambda s: test(s["value"])) if test is not None else spans


def _outside(spans: Column, base: Column) -> Column:
    """The spans that no span of ``base`` (sorted) holds: of those that begin no later, none ends as late."""
    def keep(b: Column) -> Column:
        starts = F.transform(b, lambda s: s["start"])
        furthest = _running(F.transform(b, lambda s: s["end"]), F.lit(-1).cast("long"), lambda x, y: F.greatest(x, y))  # of the first k
        return let(F.struct(starts.alias("starts"), furthest.alias("furthest")), lambda t: F.filter(
            spans, lambda s: t["furthest"][_up_to(t["starts"], s["start"])] < s["end"]))
    return let(base, keep)


def _up_to(sorted_: Column, value: Column) -> Column:
    """How many of a sorted array are at most ``value``, by bisection."""
    start = F.struct(F.lit(0).alias("lo"), F.size(sorted_).alias("hi"))
    middle = lambda acc: F.shiftright(acc["lo"] + acc["hi"], 1)

    def halve(acc: Column, _) -> Column:
        below = sorted_[F.least(middle(acc), F.size(sorted_) - 1)] <= value
        return F.when(acc["lo"] >= acc["hi"], acc).otherwise(F.when(below, F.struct((middle(acc) + 1).alias("lo"), acc["hi"].alias("hi"))).otherwise(
            F.struct(acc["lo"].alias("lo"), middle(acc).alias("hi"))))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(sorted_) + 1.0)).cast("int"))
    return F.when(F.size(sorted_) == 0, F.lit(0)).otherwise(F.aggregate(steps, start, halve, lambda acc: acc["lo"]))


def _weight(count: Column) -> Column:
    """round(1e6 * c * log2(c)) for a count of at most WINDOW, from a table."""
    table = [round(1e6 * c * math.log2(c)) if c else 0 for c in range(WINDOW + 1)]
    return F.array(*[F.lit(x).cast("long") for x in table])[count]


def _covered(value: Column) -> Column:
    """The candidate with what the allow-list covers in place; of letters and of digits alone, separators too."""
    words = "(?i:" + "|".join(ALLOW_WORDS) + ")"
    cover = value
    for word in ALLOW_WORDS:
        cover = F.regexp_replace(cover, f"(?i:{word})", COVERED * len(word))
    uuid = F.regexp_replace(cover, ALLOW_UUID, COVERED * 36)
    plain = CLASSES[0][1], CLASSES[1][1]
    covered = F.when(value.rlike(words) | value.rlike(ALLOW_UUID), uuid).otherwise(value)
    return F.when(value.rlike("|".join(plain)), F.translate(covered, SEPARATORS, COVERED * len(SEPARATORS))).otherwise(covered)


def _hot(candidate: Column) -> Column:
    """struct(first, last): starts of the first and the last hot window of a candidate, null when none is hot."""
    limit = F.lit(None).cast("long")
    for _, pattern, bits in reversed(CLASSES):
        limit = F.when(candidate.rlike(pattern), F.lit(math.floor(1e6 * WINDOW * (math.log2(WINDOW) - bits))).cast("long")).otherwise(limit)
    for pattern in ALLOW:
        limit = F.when(candidate.rlike(pattern), F.lit(None).cast("long")).otherwise(limit)
    return let(limit, lambda most: F.when(most.isNotNull(), let(_covered(candidate), lambda value: _slide(value, most))))


def _slide(value: Column, limit: Column) -> Column:
    """The first and the last window of which the sum of c*log2(c) is at most ``limit``, without a covered character."""
    state = F.struct(F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"), F.lit(0).cast("long").alias("sum"),
                     F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"))
    char = lambda i: F.instr(F.lit(ALPHABET), F.substring(value, i + 1, F.lit(1))) - 1

    def step():
        def one(acc, i):
            enter = char(i)
            leave = F.when(i >= WINDOW, char(i - WINDOW)).otherwise(F.lit(-1))
            n_in, n_out = acc["counts"][enter], F.when(leave >= 0, acc["counts"][F.greatest(leave, F.lit(0))])
            counts = F.when(enter == leave, acc["counts"]).otherwise(F.transform(
                acc["counts"], lambda c, k: c + F.when(k == enter, 1).otherwise(0) - F.when(k == leave, 1).otherwise(0)))
            change = F.when(enter == leave, F.lit(0).cast("long")).otherwise(
                _weight(n_in + 1) - _weight(n_in)
                + F.when(leave >= 0, _weight(n_out - 1) - _weight(n_out)).otherwise(F.lit(0).cast("long")))
            total = acc["sum"] + change
            hot = (i >= WINDOW - 1) & (total <= limit) & (counts[len(ALPHABET) - 1] == 0)
            at = i - (WINDOW - 1)
            return F.struct(counts.alias("counts"), total.alias("sum"),
                            F.when(hot & acc["first"].isNull(), at).otherwise(acc["first"]).alias("first"),
                            F.when(hot, at).otherwise(acc["last"]).alias("last"))
        return one

    return F.aggregate(F.sequence(F.lit(0), F.length(value) - 1), state, step(),
                       lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")))


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: its spans as an array of (start, kind, end, value), pattern spans apart from all spans."""
    text = F.col("t")
    strong = lambda v: F.length(F.regexp_extract(v, ASSIGN, 1)) >= 12
    base = F.concat(_found(text, ASSIGN, 0, strong), _found(text, ACCESS, 1, lambda v: F.length(v) >= 18), _found(text, HEX, 2, None))
    df = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("t"))
    df = df.select("doc_id", F.sort_array(base).alias("base"), _found(text, CANDIDATE, 3, None).alias("candidates"))
    hot = F.transform("candidates", lambda c: F.struct(c.alias("c"), _hot(c["value"]).alias("h")))
    df = df.withColumn("hot", F.filter(hot, lambda x: x["h"]["first"].isNotNull()))
    spans = F.transform("hot", lambda x: F.struct(
        (x["c"]["start"] + x["h"]["first"]).cast("long").alias("start"), F.lit(3).alias("kind"),
        (x["c"]["start"] + x["h"]["last"] + WINDOW).cast("long").alias("end"), x["c"]["value"].alias("value")))
    new = F.when(F.size("hot") > 0, _outside(spans.cast(_SPAN), F.col("base"))).otherwise(F.array().cast(_SPAN))
    return df.select("doc_id", "base", F.sort_array(F.concat("base", new)).alias("spans"))


def _said(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))))


def digest(docs: DataFrame) -> DataFrame:
    """Counts per pattern, a checksum of the pattern spans, and all spans as kind:start:end."""
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return scan(docs).select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                             F.sha2(_said("base"), 256).alias("base_sha256"), _said("spans").alias("spans"), count(3).alias("n_entropy"))
