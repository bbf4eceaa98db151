"""Source divergence audit on run-length columns: how far the word use of a language's sources lies apart.

1. Counts.  Per (lang, source) and term the occurrences and the documents; a task
   adds up its texts before the shuffle, so a frequent term or a hot source
   arrives as one row per task.
2. Vocabulary.  A language keeps the terms of at least ``MIN_DOCUMENTS`` documents.
   Each kept term has its counts in all sources, a sparse row.
3. Reordering.  Terms with one and the same row become one entry with a
   multiplicity, and entries are sorted by their rows: equal counts lie together.
4. Run-length columns.  ``STRIPE`` entries make a stripe; per source it holds the
   ends and the counts of its runs, absent terms included (count 0).  Written.
5. Pairs.  The run boundaries of two sources are intersected; f is evaluated once per
   intersection and multiplied by its length.  Two sources that are both absent from
   a stripe add f of their zeros times its width, the same way with one run.
   Sums of a task, then of all tasks.
6. Terms.  f of a source against its language, evaluated on the sparse rows.

All arithmetic is on whole numbers: 64 bits where the counts allow it, Python's
or Spark's decimals beyond.

A task holds one stripe, and the names and totals of one language's sources;
the pairs of these are the result's own rows.

Defined results: null text, lang and source count as ''; a source without terms
still has pairs; with no kept term every pair's value is 0; a language with one
source has no pairs; repeated rows are documents of their own; doc_id is not read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import stored

MIN_DOCUMENTS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
STRIPE = 4096
ENTRIES = 1 << 19  # terms that a task holds before it passes their counts on
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"  # fixed by the contract: letters, and everything beyond ASCII
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents per (lang, source, term), added up over texts until ENTRIES terms are held."""
    find = re.compile(TERM).findall
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(n), pa.string()), pa.array([source] * len(n), pa.string()), pa.array(list(n), pa.string()),
                 pa.array(list(n.values()), pa.int64()), pa.array(list(map(docs.__getitem__, n)), pa.int64())],
                names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for lang, source, text in zip(*(batch.column(k) for k in range(3))):
            terms = find(text.as_py().translate(_LOWER))
            n, docs = held.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
            size -= len(n)
            n.update(terms)
            docs.update(set(terms))
            size += len(n)
            if size >= ENTRIES:
                yield from rows()
                held.clear()
                size = 0
    yield from rows()


def vocabulary(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """lang, term, total, cols (array of source and n, by source) of the kept terms, stored."""
    counts = (docs.select("lang", "source", "text").mapInArrow(_count, "lang string, source string, term string, n long, docs long")
              .groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    terms = (counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"),
                                                F.array_sort(F.collect_list(F.struct("source", "n"))).alias("cols"))
             .filter(F.col("docs") >= min_documents).drop("docs"))
    return stored(terms, "vocabulary")


def totals(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """One row per language that occurs: its kept terms, their occurrences, and its sources with theirs; stored."""
    groups = docs.select("lang", "source").distinct()
    used = terms.select("lang", F.explode("cols").alias("c")).groupBy("lang", F.col("c.source").alias("source")).agg(F.sum("c.n").alias("n"))
    sources = (groups.join(used, ["lang", "source"], "left").fillna(0, ["n"]).groupBy("lang")
               .agg(F.array_sort(F.collect_list(F.struct("source", "n"))).alias("sources")))
    langs = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("n"))
    return stored(sources.join(langs, "lang", "left").fillna(0, ["v", "n"]), "totals")


def run_length_columns(terms: DataFrame, stripe: int = STRIPE) -> DataFrame:
    """lang, width (terms), columns (per source present: ends and counts of its runs) of each stripe, stored."""
    entries = terms.groupBy("lang", "cols").agg(F.count("*").alias("m"))
    ordered = entries.repartitionByRange("lang", "cols").sortWithinPartitions("lang", "cols")

    def encode(lang: str, m: np.ndarray, cols: pa.ListArray) -> pa.RecordBatch:
        ends, last = np.cumsum(m), len(m) - 1
        items, entry = cols.flatten(), np.repeat(np.arange(len(m)), np.diff(cols.offsets.to_numpy()))
        source, n = items.field("source").dictionary_encode(), items.field("n").to_numpy()
        code, columns = source.indices.to_numpy(), []
        for c, name in enumerate(source.dictionary.to_pylist()):
            counts = np.zeros(len(m), dtype=np.int64)
            counts[entry[code == c]] = n[code == c]
            cut = np.append(np.flatnonzero(np.diff(counts)), last)  # the last entry of each run
            columns.append({"source": name, "ends": ends[cut], "counts": counts[cut]})
        return pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([int(ends[-1])]), pa.array([columns], _COLUMNS)], names=["lang", "width", "columns"])

    def encode_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, held, size = None, [], 0  # of one language, less than a stripe

        def take() -> pa.RecordBatch:
            parts = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            return encode(lang, parts.column("m").to_numpy(), parts.column("cols"))

        for batch in batches:
            names, at = batch.column("lang").to_pylist(), 0
            while at < len(names):
                if held and (names[at] != lang or size == stripe):
                    yield take()
                    held, size = [], 0
                lang = names[at]
                end = min(at + stripe - size, bisect_right(names, lang, at))  # sorted by language
                held.append(batch.slice(at, end - at))
                size, at = size + end - at, end
        if held:
            yield take()

    columns = ordered.mapInArrow(encode_all, "lang string, width long, columns array<struct<source: string, ends: array<long>, counts: array<long>>>")
    return stored(columns, "run-length")


_COLUMNS = pa.list_(pa.struct([("source", pa.string()), ("ends", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))]))


def shares(counts: np.ndarray, n: int, v: int) -> np.ndarray:
    """p of each count: 1 + floor(SCALE * (count + 1) / (n + v))."""
    if len(counts) and SCALE * (int(counts.max()) + 1) >= 1 << 63:
        return np.array([1 + SCALE * (int(c) + 1) // (n + v) for c in counts], dtype=np.int64)
    return 1 + SCALE * (counts + 1) // (n + v)


def intersect(ends_p: np.ndarray, p: np.ndarray, ends_q: np.ndarray, q: np.ndarray) -> tuple[int, int]:
    """The sums of floor((p-q)**2 / q) and floor((q-p)**2 / p) over the terms, once per intersection of runs."""
    ends = np.union1d(ends_p, ends_q)
    p, q = p[np.searchsorted(ends_p, ends)], q[np.searchsorted(ends_q, ends)]
    length, square = np.diff(ends, prepend=0), (p - q) ** 2
    return int(np.sum(square // q * length)), int(np.sum(square // p * length))


def pair_sums(columns: DataFrame, langs: DataFrame) -> DataFrame:
    """lang, source, item, value over all stripes, for every two sources of a language that has kept terms."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for k in range(batch.num_rows):
                lang, width, v, sources = (batch.column(name)[k].as_py() for name in ("lang", "width", "v", "sources"))
                cols = batch.column("columns")[k].values
                known = {name: tuple(cols.field(x)[j].values.to_numpy() for x in ("ends", "counts"))
                         for j, name in enumerate(cols.field("source").to_pylist())}
                absent = np.array([width], np.int64), np.zeros(1, np.int64)
                runs = []
                for s in sources:
                    ends, counts = known.get(s["source"], absent)
                    runs.append((s["source"], ends, shares(counts, s["n"], v)))
                for i, (g, ends_g, p) in enumerate(runs):
                    for h, ends_h, q in runs[:i]:
                        there, back = intersect(ends_g, p, ends_h, q)
                        total[lang, g, h] += there
                        total[lang, h, g] += back
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*total)] + [pa.array(list(total.values()), pa.int64())],
                                             names=["lang", "source", "item", "value"])

    joined = columns.join(langs.select("lang", "v", "sources"), "lang")
    # Stripes are few bytes and much work: dealt by number, which is never merged by size.
    n = int(columns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (joined.repartition(n).mapInArrow(sums, "lang string, source string, item string, value long")
            .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))


def _share(count: Column, n: Column, v: Column) -> Column:
    """``shares`` in Spark: whole numbers of 38 digits, so the product holds; floors are exact."""
    num = (count.cast("decimal(20,0)") + 1) * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", num, (n + v).cast("decimal(20,0)")) + 1


def divergence(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    d = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    terms = vocabulary(d, min_documents)
    langs = totals(d, terms)
    both = (langs.select("lang", "sources", F.explode("sources.source").alias("source"))
            .select("lang", "source", F.explode("sources.source").alias("item")).filter("source <> item"))
    pairs = (both.join(pair_sums(run_length_columns(terms), langs), ["lang", "source", "item"], "left").fillna(0, ["value"])
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
    each = terms.join(langs.select("lang", "v", F.col("n").alias("lang_n"), F.map_from_entries("sources").alias("n_of")), "lang")
    each = each.select("lang", "term", "total", "v", "lang_n", "n_of", F.explode("cols").alias("c"))
    p = _share(F.col("c.n"), F.element_at("n_of", F.col("c.source")), F.col("v"))
    q = _share(F.col("total"), F.col("lang_n"), F.col("v"))
    each = each.select("lang", F.col("c.source").alias("source"), F.col("term").alias("item"), p.alias("p"), q.alias("q")).filter("p > q")
    listed = each.select("lang", "source", F.lit("term").alias("part"), "item", F.expr("(p - q) * (p - q) div q").alias("value"))
    rank = F.expr("row_number() over (partition by lang, source order by value desc, item)")
    return pairs.withColumn("rank", rank).unionByName(listed.withColumn("rank", rank).filter(F.col("rank") <= top_terms))


def oracle(min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS) -> str:
    """DuckDB SQL for ``divergence``."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    p = f"(1 + {SCALE}::hugeint * ({{c}} + 1) // ({{n}} + v))"
    return f"""
with d as (select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
                  regexp_extract_all({lower}, '{TERM}') as found from documents),
w as (select row, lang, source, unnest(found) as term from d),
kept as (select lang, term, count(*)::hugeint as total from w group by all having count(distinct row) >= {min_documents}),
own as (select lang, source, term, count(*)::hugeint as n from w join kept using (lang, term) group by all),
l as (select lang, count(*)::hugeint as v, sum(total)::hugeint as lang_n from kept group by lang),
g as (select a.lang, a.source, coalesce(sum(own.n), 0)::hugeint as n
      from (select distinct lang, source from d) a left join own using (lang, source) group by all),
c as (select g.lang, g.source, kept.term, coalesce(own.n, 0) as n, kept.total, l.v, l.lang_n,
             {p.format(c='coalesce(own.n, 0)', n='g.n')} as p
      from g join kept using (lang) join l using (lang) left join own on own.lang = g.lang and own.source = g.source and own.term = kept.term),
sums as (select x.lang, x.source, y.source as item, sum((x.p - y.p) * (x.p - y.p) // y.p) as value
         from c x join c y on x.lang = y.lang and x.term = y.term and x.source <> y.source group by all),
pairs as (select x.lang, x.source, 'pair' as part, y.source as item, coalesce(s.value, 0)::bigint as value
          from g x join g y on x.lang = y.lang and x.source <> y.source
          left join sums s on s.lang = x.lang and s.source = x.source and s.item = y.source),
terms as (select lang, source, 'term' as part, term as item, ((p - q) * (p - q) // q)::bigint as value
          from (select *, {p.format(c='total', n='lang_n')} as q from c) where n > 0 and p > q),
ranked as (select *, (row_number() over (partition by lang, source, part order by value desc, item))::int as rank
           from (select * from pairs union all select * from terms))
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= {top_terms}"""
