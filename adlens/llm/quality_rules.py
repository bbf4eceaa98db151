"""Quality rules: a threshold table compiled into one Spark projection.

``THRESHOLDS`` is data: each row names a ratio of two measures and the range it
must stay in.  ``rule_columns`` turns the table into Columns, so any number of
rules runs in one narrow pass over the texts, with built-in functions only (no
user functions, no shuffle).  All comparisons are on whole numbers.

Defined results: a null text has no words, so all counts are 0 and the document
fails; so does an empty text.  A null doc_id is carried through.  Repeated rows
are judged one by one.  Only ``doc_id`` and ``text`` are read, so further
columns of any name are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import WORD, let, words

WINDOW = 8

# Frequent function words of the four corpus languages.
STOP_WORDS = [
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on", "are", "this",
    "der", "die", "das", "und", "zu", "den", "von", "ist", "nicht", "mit", "ein", "eine", "als", "für", "des", "sich",
    "le", "la", "les", "et", "un", "une", "est", "que", "du", "dans", "pour", "qui", "par", "sur", "pas", "avec",
    "el", "los", "las", "y", "en", "del", "se", "una", "por", "con", "su", "al", "para", "no", "de", "des", "lo",
]

# (rule, measure, of measure, at least per mille or None, at most per mille or None)
THRESHOLDS = [
    ("mean_word_length", "word_chars", "n_words", 2_000, 15_000),
    ("symbols_per_word", "n_symbols", "n_words", None, 100),
    ("stop_words", "n_stop", "n_words", 20, None),
    ("duplicate_lines", "n_dup_lines", "n_lines", None, 300),
    ("upper_case_words", "n_upper", "n_words", None, 400),
]


def _repeat_words(w: Column, n: Column) -> Column:
    """Words covered by 8-word windows that occur twice or more in the text.

    One 64-bit hash per window settles the usual text: all hashes differ, so no
    window repeats.  Otherwise the windows themselves are sorted with their
    places, so the count is exact whatever the hashes do.
    """
    last = n - WINDOW
    starts = F.sequence(F.lit(0), last.cast("int"))
    hashes = F.transform(starts, lambda i: F.xxhash64(*[w[i + k] for k in range(WINDOW)]))
    placed = F.sort_array(F.transform(starts, lambda i: F.struct(F.slice(w, i + 1, WINDOW).alias("k"), i.alias("i"))))

    def covered(s: Column) -> Column:
        twice = lambda j: (
            (F.when(j > 0, s[j - 1]["k"] == s[j]["k"]).otherwise(F.lit(False)))
            | (F.when(j < last, s[j + 1]["k"] == s[j]["k"]).otherwise(F.lit(False))))
        places = F.sort_array(F.transform(F.filter(starts, twice), lambda j: s[j]["i"]))
        return let(places, lambda p: F.aggregate(
            F.when(F.size(p) > 0, F.sequence(F.lit(0), F.size(p) - 1)).otherwise(F.array().cast("array<int>")),
            F.lit(0).cast("long"),
            lambda acc, j: acc + F.when(j == F.size(p) - 1, F.lit(WINDOW)).otherwise(
                F.least(F.lit(WINDOW), p[F.least(j + 1, F.size(p) - 1)] - p[j])).cast("long")))

    return (F.when(n < WINDOW, F.lit(0).cast("long"))
            .when(F.size(F.array_distinct(hashes)) == last + 1, F.lit(0).cast("long"))
            .otherwise(let(placed, covered)))


def measures(docs: DataFrame) -> DataFrame:
    """doc_id and the whole-number measures that the thresholds compare."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select("doc_id", text.alias("t"), words(F.col("text")).alias("w"),
                        F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)).alias("lines"))
    w, n = F.col("w"), F.size("w")
    count = lambda test: F.size(F.filter(w, test)).cast("long")
    return split.select(
        "doc_id",
        n.cast("long").alias("n_words"),
        F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
        F.length(F.regexp_replace("t", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(w, n).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        count(lambda x: F.lower(x).isin(STOP_WORDS)).alias("n_stop"),
        count(lambda x: (F.length(x) > 1) & (x == F.upper(x)) & (x != F.lower(x))).alias("n_upper"),
    )


def rule_columns(thresholds=None) -> dict[str, Column]:
    """The threshold table as one boolean Column per rule: true when the rule is broken."""
    out = {}
    for name, part, whole, least, most in THRESHOLDS if thresholds is None else thresholds:
        broken = F.lit(False)
        if least is not None:
            broken = broken | (1000 * F.col(part) < least * F.col(whole))
        if most is not None:
            broken = broken | (1000 * F.col(part) > most * F.col(whole))
        out[name] = broken
    return out


def apply_rules(docs: DataFrame, thresholds=None) -> DataFrame:
    """One row per document: its measures, base_failed, the broken rules and whether it stays."""
    rules = rule_columns(thresholds)
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    failed = F.filter(F.array(*[F.when(c, F.lit(name)) for name, c in rules.items()]), lambda x: x.isNotNull()) \
        if rules else F.array().cast("array<string>")
    return (measures(docs)
            .withColumns({"base_failed": base, "failed_rules": F.concat_ws(",", failed)})
            .withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == "")))


def oracle() -> str:
    """The same rows in DuckDB SQL, the threshold table compiled the same way."""
    stop = ", ".join(f"'{x}'" for x in sorted(set(STOP_WORDS)))
    tests = []
    for name, part, whole, least, most in THRESHOLDS:
        sides = [f"1000 * {part} < {least} * {whole}"] * (least is not None)
        sides += [f"1000 * {part} > {most} * {whole}"] * (most is not None)
        tests.append(f"case when {' or '.join(sides)} then '{name}' end")
    word = WORD
    return f"""
with t as (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
w as (select rid, doc_id, t, regexp_extract_all(t, '{word}') as w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{word}')) as lines from t),
win as (select rid, i, list_slice(w, i, i + {WINDOW - 1}) as k
        from w, lateral (select unnest(range(1, len(w) - {WINDOW - 2})) as i)),
rep as (select rid, i from (select rid, i, count(*) over (partition by rid, k) as c from win) where c > 1),
cov as (select rid, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW}))) as n
        from (select rid, i, lead(i) over (partition by rid order by i) as nxt from rep) group by rid),
m as (select doc_id, cast(len(w) as bigint) as n_words,
             cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
             cast(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) as bigint) as n_symbols,
             cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
             cast(coalesce(cov.n, 0) as bigint) as n_repeat_words,
             cast(len(lines) as bigint) as n_lines,
             cast(len(list_filter(w, lambda x: lower(x) in ({stop}))) as bigint) as n_stop,
             cast(len(list_filter(w, lambda x: length(x) > 1 and x = upper(x) and x <> lower(x))) as bigint) as n_upper
      from w left join cov using (rid)),
v as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
             concat_ws(',', {', '.join(tests)}) as failed_rules from m)
select *, not base_failed and failed_rules = '' as kept from v"""
