"""Benchmark decontamination by typed templates.

1. Canonical text: numbers, names and units become typed placeholders, the rest
   is lower-cased without punctuation.  A question with other numbers or names
   has the same template.  A capital that begins a sentence or a line is read both
   ways, as a name and as a plain word.
2. A window of ``WINDOW`` template words holds a block of half as many that begins
   at a multiple of its length.  Those of the documents are hashed and joined with
   every block of the benchmark's windows.  Only windows around a hit go on.
3. These fetch their words and are joined with the benchmark's windows, all words
   compared.  The equal ones are grouped by (document, item, offset): one group is
   one alignment of the item.
4. Slots of an alignment must agree: each benchmark value stands for one value in
   the document and the other way round.  A group that agrees and covers
   ``MIN_RUN`` windows (or all of a shorter item) marks the document.  So does one
   with clashing slots if ``CLASH_WINDOWS`` of its windows have the item's own
   values or agree with one another, whatever the rest does.

Windows with fewer than ``MIN_LITERALS`` words that are no placeholder, and items
of fewer than ``WINDOW`` template words as a whole, say too little by their
template; they are found by their exact words, values included.

Built-in functions only.  The benchmark's windows and blocks are broadcast only when
the counted number of either is at most ``BROADCAST_WINDOWS``; above that both sides
are shuffled by hash, where Spark splits hot hashes.  Texts are shuffled once, for
documents with hits, by (doc_id, text hash).

Defined results: null and empty texts have no windows and stay; items without
words, or null ones, match nothing; an item of a few words marks every document
that holds them in a row; a null doc_id is a value like any other; repeated rows
share their verdict; an empty benchmark marks nothing; further columns are
ignored or, in ``clean``, kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import SPACE_CHARS, let, text_key, words

WINDOW = 8
MIN_RUN = 6
MIN_LITERALS = 4
CLASH_WINDOWS = WINDOW  # as many windows as one clashing word is in
BROADCAST_WINDOWS = 1_000_000  # of 8-byte hashes

NUMBER, NAME, UNIT = "\u0001", "\u0002", "\u0003"
CAPITAL = "\u0004"  # before a word that may be a name

# Units of measure and money, and number words, as they stand in questions.
UNITS = ["kilometers?", "kilometres?", "km", "meters?", "metres?", "m", "centimeters?", "cm", "millimeters?", "mm", "miles?", "feet",
         "foot", "ft", "inches", "inch", "yards?", "kilograms?", "kg", "grams?", "g", "mg", "pounds?", "lbs?", "ounces?", "oz", "tons?",
         "liters?", "litres?", "l", "ml", "gallons?", "hours?", "hrs?", "h", "minutes?", "mins?", "seconds?", "secs?", "s", "days?",
         "weeks?", "months?", "years?", "dollars?", "cents?", "euros?", "eur", "usd", "percent", "degrees?", "mph", "kmh", "hz", "watts?", "w"]
NUMBER_WORDS = ["zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "thirteen", "fourteen",
                "fifteen", "sixteen", "seventeen", "eighteen", "nineteen", "twenty", "thirty", "forty", "fifty", "sixty", "seventy", "eighty", "ninety", "hundred", "thousand", "million", "billion"]


def _plain(text: Column) -> Column:
    """The text without the characters that stand for placeholders; null is empty."""
    t = F.coalesce(text, F.lit(""))
    return F.when(t.rlike("[\u0001-\u0004]"), F.regexp_replace(t, "[\u0001-\u0004]", "")).otherwise(t)


def _split(text: Column) -> Column:
    """What ``words`` returns, without a pattern: the text is split at one character."""
    for c in SPACE_CHARS[1:]:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def marked(text: Column) -> Column:
    """The template words of a text, with ``CAPITAL`` where a capital may only be due to its place.  They align one to one with ``spoken`` of it."""
    # Each pattern begins with what is cheap and rare to find; look-arounds come after it.
    t = _plain(text)
    firsts = sorted({w[0] for w in NUMBER_WORDS})
    number = "(?:" + "|".join(f"{c}(?:" + "|".join(w[1:] for w in NUMBER_WORDS if w[0] == c) + ")" for c in firsts) + ")"
    first = "".join(firsts + [c.upper() for c in firsts])
    t = F.regexp_replace(t, rf"\b(?=[{first}])(?i:{number}(?:-{number})*)\b", NUMBER)
    # A capitalised word inside a sentence: what stands before it ends no sentence and no line.
    t = F.regexp_replace(t, r"(?=[\p{Lu}])(?<=[^.!?:\s][ \t])[\p{Lu}][\p{Ll}][\p{L}'’-]*", NAME)
    t = F.regexp_replace(t, r"(?=[\p{Lu}][\p{Ll}])(?<![\p{L}\p{M}]|[\p{L}\p{M}]['’-])", CAPITAL)
    t = F.regexp_replace(F.lower(t), r"[0-9]+(?:[.,:/][0-9]+)*", NUMBER)
    t = F.regexp_replace(t, "(\u0001[ -]?)\u0004?(?:" + "|".join(UNITS) + r")\b", "$1" + UNIT)
    return _split(F.regexp_replace(t, "[^a-z\\p{L}\\p{M}\u0001-\u0004\\x20\\x09-\\x0D]+", ""))


def template(marked_words: Column) -> Column:
    """The reading in which words that begin a sentence or a line are no names."""
    return F.transform(marked_words, lambda w: F.replace(w, F.lit(CAPITAL), F.lit("")))


def named(marked_words: Column) -> Column:
    """The reading in which every capitalised word is a name, whatever stands before it."""
    return F.transform(marked_words, lambda w: F.when(w.contains(CAPITAL), F.regexp_replace(w, "\u0004[\\p{L}\\p{M}]+", NAME)).otherwise(w))


def spoken(text: Column) -> Column:
    """The words that ``marked`` has a place for, as they stand in the text."""
    return F.filter(words(_plain(text)), lambda w: w.rlike(r"[a-zA-Z0-9\p{L}\p{M}]"))


def _block(width: int) -> int:
    """The length of a block: every window of ``width`` words holds one that begins at a multiple of its length."""
    return (width + 1) // 2


def _hashes(words_: Column, size: int, step: int) -> Column:
    """The hashes of the runs of ``size`` words that begin at every ``step``-th place."""
    return let(words_, lambda t: F.when(F.size(t) >= size, F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(t) - size, F.lit(0)), F.lit(step)),
        lambda i: F.xxhash64(*[t[i + k] for k in range(size)]))).otherwise(F.array().cast("array<bigint>")))


def _value(word: Column) -> Column:
    """A word as it counts for a value: without case and without punctuation but between figures."""
    return F.regexp_replace(F.lower(word), r"(?<![0-9])[^\p{L}\p{M}0-9]+|[^\p{L}\p{M}0-9]+(?![0-9])", "")


def _placeholder(word: Column) -> Column:
    return word.rlike("[\u0001-\u0003]")


def exact(t: Column, raw: Column) -> Column:
    """The template words with their values back in the places of the placeholders."""
    return F.zip_with(t, raw, lambda t, w: F.when(_placeholder(t), _value(w)).otherwise(t))


def exact_words(text: Column) -> Column:
    """What ``exact`` returns for every reading of a text, from the text as a whole: punctuation stays only as one character between figures."""
    other = r"[^a-z0-9\x20\x09-\x0D\p{L}\p{M}]"
    return _split(F.regexp_replace(F.lower(_plain(text)), rf"{other}(?:{other}++|(?<![0-9]{other})|(?![0-9]))", ""))


def _slots(t: Column, raw: Column) -> Column:
    """(placeholder's place, value) of one window; values lose case and outer punctuation."""
    return F.transform(raw, lambda w, i: F.when(_placeholder(t[i]), _value(w)))


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """One row per reading of a benchmark window: its hash, item, place, width, words, slot values and the item's counts of windows.

    ``n`` and ``n_named`` count the windows that go by their template in either reading.  Where one doesn't, and
    for shorter items as a whole, there is a row of exact words, which have no slots; ``n_all`` counts all windows.
    """
    b = benchmark.select("item_id", marked(F.col("text")).alias("m"), spoken(F.col("text")).alias("raw"))
    b = b.withColumns({"t": template(F.col("m")), "c": named(F.col("m")), "width": F.least(F.size("m"), F.lit(WINDOW))}).filter("width > 0")
    b = b.withColumns({"e": exact(F.col("c"), F.col("raw")), "places": F.sequence(F.lit(0), F.size("m") - F.col("width"))})
    cut = lambda c, p: F.slice(c, p + 1, F.col("width"))
    templated = lambda c, p: (F.col("width") == WINDOW) & (F.size(F.filter(cut(c, p), lambda w: ~_placeholder(w))) >= MIN_LITERALS)
    count = lambda c: F.size(F.filter("places", lambda p: templated(c, p)))
    b = b.select("item_id", "t", "c", "raw", "e", "width", count("t").alias("n"), count("c").alias("n_named"), F.size("places").alias("n_all"),
                 F.explode("places").alias("bpos"))
    p = F.col("bpos")
    b = b.withColumns({"in_t": F.when(templated("t", p), cut("t", p)), "in_c": F.when(templated("c", p), cut("c", p))})
    b = b.withColumn("in_e", F.when(F.col("in_t").isNull() | F.col("in_c").isNull(), cut("e", p)))
    b = b.withColumn("bt", F.explode(F.array_distinct(F.array_compact(F.array("in_t", "in_c", "in_e")))))
    is_ = lambda c: F.col("bt").eqNullSafe(F.col(c))
    return b.select(F.xxhash64("bt").alias("h"), "item_id", "bpos", "width", "n", "n_named", "n_all", is_("in_t").alias("plain"), is_("in_c").alias("named"),
                    is_("in_e").alias("exact"), "bt", _slots(F.col("bt"), cut("raw", p)).alias("bslots"))


def alignments(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per (document, item, offset) with hits: windows matched, of how many, and whether the slots agree."""
    bench = benchmark_windows(benchmark)
    widths = sorted(r.width for r in bench.filter("exact").select("width").distinct().collect())  # WINDOW numbers at most
    of_width = [F.when(F.col("width") == k, _hashes(F.col("bt"), _block(k), 1)) for k in sorted({*widths, WINDOW})]
    blocks = bench.select(F.explode(F.coalesce(*of_width)).alias("h")).distinct()
    small = max(bench.select("h").distinct().count(), blocks.count()) <= BROADCAST_WINDOWS
    near = F.broadcast if small else (lambda df: df)
    d = docs.select("doc_id", text_key(F.col("text")).alias("tk"), "text")

    of = lambda c, k: F.struct(F.lit(k).alias("width"), F.lit(_block(k)).alias("size"), _hashes(c, _block(k), _block(k)).alias("hs"))
    read = d.select("doc_id", "tk", marked(F.col("text")).alias("m"), *([exact_words(F.col("text")).alias("e")] if widths else []))
    sets = F.array(of(template(F.col("m")), WINDOW), of(named(F.col("m")), WINDOW), *[of(F.col("e"), k) for k in widths])
    hits = read.select("doc_id", "tk", F.explode(sets).alias("x")).select("doc_id", "tk", "x.width", "x.size", F.posexplode("x.hs").alias("n", "h"))
    hits = hits.join(near(blocks), "h", "left_semi").select("doc_id", "tk", "width", "size", (F.col("n") * F.col("size")).alias("block"))
    per_doc = hits.distinct().groupBy("doc_id", "tk").agg(F.collect_list(F.struct("width", "size", "block")).alias("hits"))
    per_doc = per_doc.select(F.col("doc_id").alias("_id"), F.col("tk").alias("_tk"), "hits")
    full = d.join(per_doc, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tk") == F.col("_tk")))
    full = full.select("doc_id", "tk", "hits", marked(F.col("text")).alias("m"), spoken(F.col("text")).alias("raw"))
    full = full.withColumns({"t": template(F.col("m")), "c": named(F.col("m"))}).withColumn("e", exact(F.col("c"), F.col("raw")))
    # The windows of which a block is the first; no window has two.
    around = lambda x: F.transform(F.filter(F.sequence(x["block"] - x["size"] + 1, x["block"]), lambda p: (p >= 0) & (p + x["width"] <= F.size("m"))),
                                   lambda p: F.struct(p.alias("pos"), x["width"].alias("width")))
    cut = lambda c, x: F.slice(c, x["pos"] + 1, x["width"])
    of_window = lambda x: F.transform(F.array_distinct(F.array_compact(F.array(
        cut("t", x), cut("c", x), F.when(x["width"].isin(widths), cut("e", x))))), lambda t: F.struct(
        x["pos"].alias("pos"), t.alias("t"), (t == cut("t", x)).alias("as_plain"), _slots(t, cut("raw", x)).alias("slots")))
    found = full.select("doc_id", "tk", F.explode(F.flatten(F.transform(F.flatten(F.transform("hits", around)), of_window))).alias("x"))
    found = found.select("doc_id", "tk", "x.*").withColumn("h", F.xxhash64("t"))
    b_side = near(bench) if small else bench
    pairs = (found.join(b_side, "h").filter(F.col("t") == F.col("bt"))
             .select("doc_id", "tk", "item_id", "n", "n_named", "n_all", (F.col("plain") & F.col("as_plain")).alias("plain"), "named", (F.col("pos") - F.col("bpos")).alias("offset"), "bpos",
                     F.filter(F.arrays_zip("bslots", "slots"), lambda s: s["bslots"].isNotNull()).alias("slots")))
    rows = F.struct("bpos", "plain", "named", "slots")
    found = pairs.groupBy("doc_id", "tk", "item_id", "n", "n_named", "n_all", "offset").agg(F.collect_set(rows).alias("rows"))
    values = lambda rows: F.array_distinct(F.flatten(F.transform(rows, lambda r: r["slots"])))
    found = found.withColumn("values", values("rows"))
    found = found.withColumns({"agree": _one_to_one(F.col("values")),
                               "agree_plain": _one_to_one(values(F.filter("rows", lambda r: r["plain"]))),
                               "agree_named": _one_to_one(values(F.filter("rows", lambda r: r["named"]))),
                               "by_template": _places("rows", lambda r: r["plain"]),
                               "by_names": _places("rows", lambda r: r["named"]),
                               "verbatim": _places("rows", lambda r: F.forall(r["slots"], lambda s: s["bslots"] == s["slots"])),
                               "matched": _places("rows", lambda r: F.lit(True)),
                               "same_values": ~F.exists("values", lambda s: s["bslots"] != s["slots"])})
    main = F.when(~F.col("agree"), _main_values(F.col("rows"), F.col("values")))
    return found.withColumn("main", main).withColumn("consistent", F.when(F.col("agree"), F.col("matched")).otherwise(
        _places("rows", lambda r: F.forall(r["slots"], lambda s: F.array_contains("main", s)))))


def _places(rows: str, test) -> Column:
    """How many windows of the item have a row that passes the test."""
    return F.size(F.array_distinct(F.transform(F.filter(rows, test), lambda r: r["bpos"])))


def _one_to_one(values: Column) -> Column:
    return ((F.size(F.array_distinct(F.transform(values, lambda s: s["bslots"]))) == F.size(values))
            & (F.size(F.array_distinct(F.transform(values, lambda s: s["slots"]))) == F.size(values)))


def _main_values(rows: Column, values: Column) -> Column:
    """The pairs of values that are in more windows than any pair they clash with; a one-to-one map."""
    told = F.transform(values, lambda s: F.struct(
        F.size(F.filter(rows, lambda r: F.array_contains(r["slots"], s))).alias("n"), (s["bslots"] == s["slots"]).alias("same"), s.alias("s")))
    clash = lambda u, v: (u["s"]["bslots"] == v["s"]["bslots"]) | (u["s"]["slots"] == v["s"]["slots"])
    return let(told, lambda all_: F.transform(
        F.filter(all_, lambda v: ~F.exists(all_, lambda u: clash(u, v) & (u > v))), lambda v: v["s"]))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per marked (doc_id, text hash): the items found, and how many only with other values."""
    enough = lambda found, n: (F.col(found) > 0) & (F.col(found) >= F.least(F.lit(MIN_RUN), F.col(n)))
    hit = alignments(docs, benchmark).filter(
        (F.col("agree") & (enough("verbatim", "n_all") | (F.col("matched") >= MIN_RUN)))
        | (F.col("agree_plain") & enough("by_template", "n")) | (F.col("agree_named") & enough("by_names", "n_named"))
        | (F.greatest("verbatim", "consistent") >= CLASH_WINDOWS))
    return hit.groupBy("doc_id", "tk").agg(
        F.count_distinct("item_id").alias("n_items"), F.min("item_id").alias("item_id"), F.max("matched").alias("n_windows"),
        F.count_distinct(F.when(~F.col("same_values"), F.col("item_id"))).alias("n_reparameterised"))


def _marked(docs: DataFrame, marks: DataFrame, how: str) -> DataFrame:
    m = marks.withColumnsRenamed({"doc_id": "_id", "tk": "_tk"})
    return docs.join(m, docs["doc_id"].eqNullSafe(m["_id"]) & text_key(docs["text"]).eqNullSafe(m["_tk"]), how)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: the benchmark items in it and whether it stays."""
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    d = docs.select("doc_id", text_key(F.col("text")).alias("tk"))
    m = contaminated(docs, benchmark).withColumnsRenamed({"doc_id": "_id", "tk": "_tk"})
    return (d.join(m, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tk") == F.col("_tk")), "left")
            .select("doc_id", zero("n_items"), "item_id", zero("n_windows"), zero("n_reparameterised"),
                    F.col("_tk").isNull().alias("kept")))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    return _marked(docs, contaminated(docs, benchmark), "left_anti")
