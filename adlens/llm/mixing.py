"""Mixing sources to target weights, by blocks of tokens.

1. Per source, documents are laid end to end in a hashed order and cut into
   blocks of ``block_words`` words (the last one may be short).
2. Target words become a number of block slots per source; each output shard
   draws its source counts from a multinomial, and what is left of each
   source's total bounds the later draws, so the totals come out exactly.
3. Slot j of a source is block ``permutation(epoch, j mod blocks)`` with
   ``epoch = j div blocks``: one keyed pseudorandom permutation per source and
   epoch, so no block comes twice before every block came once.
4. Blocks are joined to their slots by (source, block).

Nothing grows on the driver but one row per source and one count per (shard,
source).  Document offsets come from two levels of sums (per hashed bucket, then
over the buckets), so a source with a third of all rows is split over
``BUCKETS`` windows; the join keys are unique per block and at most twice per
slot, so no key is hot.

Defined results: null text has size 0, and such documents are taken 0 times; a
null source is a source of its own, last; a null doc_id is carried through;
equal rows get places of their own, with the same set of results in every run;
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adlens.llm.common import n_words, stored, text_key
from adlens.llm.rolling import mix

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
BLOCK_WORDS = 64
BUCKETS = 4096
N_SHARDS = 64
SEED = 20_240_501
CHUNK = 1 << 16
SLOTS_PER_TASK = 1 << 18


def targets(sizes: list[int], weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> list[float]:
    """Words to take of each source: shared by weight, what a capped source can't hold goes to the others."""
    weight = [weights[k % len(weights)] for k in range(len(sizes))]
    out: list[float | None] = [None] * len(sizes)
    while None in out:
        left = share * sum(sizes) - sum(x for x in out if x is not None)
        whole = sum(w for w, x in zip(weight, out) if x is None)
        wish = {k: left * weight[k] / whole for k, x in enumerate(out) if x is None}
        over = [k for k, x in wish.items() if x > cap * sizes[k]]
        for k in over or wish:
            out[k] = float(cap * sizes[k]) if over else wish[k]
    return out


def shard_counts(slots: list[int], n_shards: int, seed: int) -> np.ndarray:
    """[shard, source] slot counts: multinomial draws from what each source has left; columns sum to ``slots``."""
    rng = np.random.default_rng(seed)
    left = np.array(slots, dtype=np.int64)
    out = np.zeros((n_shards, len(slots)), dtype=np.int64)
    for k in range(n_shards):
        n = int(left.sum()) // (n_shards - k)
        if k == n_shards - 1:
            out[k] = left
        elif n:
            out[k] = np.minimum(rng.multinomial(n, left / left.sum()), left)
        left -= out[k]
    return out


def permute(index: np.ndarray, domain: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed permutation of 0..domain-1, row by row: a 4-round Feistel network, walked until it lands inside."""
    half = np.maximum(1, np.ceil(np.log2(np.maximum(domain, 2)) / 2)).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo].astype(np.uint64)
        left, right = out[todo] >> h, out[todo] & m
        for r in range(4):
            left, right = right, left ^ (mix(right + k * np.uint64(0x9E3779B97F4A7C15) + np.uint64(r + 1)) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= domain[todo].astype(np.uint64)]
    return out.astype(np.int64)


class Mix:
    """One mixing plan over ``docs``: placed documents, source targets and drawn slots."""

    def __init__(self, docs: DataFrame, block_words: int = BLOCK_WORDS, n_shards: int = N_SHARDS, seed: int = SEED,
                 weights=WEIGHTS, share: float = SHARE, cap: float = CAP):
        self.spark, self.block_words = docs.sparkSession, block_words
        sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), text_key(F.col("text")).alias("tk"))
        sized = sized.withColumn("order", F.xxhash64(F.lit(seed), "doc_id", "tk"))
        sized = stored(sized.withColumn("bucket", F.pmod("order", F.lit(BUCKETS)).cast("int")), "mix-sizes")
        per_bucket = sized.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
        rows = per_bucket.groupBy("source").agg(F.sum("words").alias("words")).collect()  # one row per source
        rows.sort(key=lambda r: (r.source is None, r.source or ""))
        self.sources = [r.source for r in rows]
        self.sizes = [int(r.words) for r in rows]
        self.targets = targets(self.sizes, weights, share, cap)
        self.blocks = [-(-n // block_words) for n in self.sizes]
        self.slots = [round(t * b / n) if n else 0 for t, b, n in zip(self.targets, self.blocks, self.sizes)]
        self.counts = shard_counts(self.slots, n_shards, seed)
        self.seed = seed
        info = self.spark.createDataFrame(
            [(k, s, n, float(t)) for k, (s, n, t) in enumerate(zip(self.sources, self.sizes, self.targets))],
            "sid int, source string, source_size long, target double")
        before = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
        first = per_bucket.select("source", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("first"))
        first = (first.join(info, first["source"].eqNullSafe(info["source"]))
                 .select("sid", first["source"], "bucket", "first", "source_size", "target"))
        inside = W.partitionBy("source", "bucket").orderBy("order", F.col("doc_id").asc_nulls_first(), "tk", "size")
        offset = F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, 0)) - F.col("size")
        d = sized.withColumn("inside", offset).withColumn("copy", F.row_number().over(
            W.partitionBy("source", "bucket", "order", "doc_id", "tk").orderBy("size"))).alias("d")
        f = first.alias("f")
        self.docs = (d.join(f, F.col("d.source").eqNullSafe(F.col("f.source")) & (F.col("d.bucket") == F.col("f.bucket")))
                     .select("d.doc_id", "d.tk", "d.copy", "f.sid", "d.size", "source_size", "target",
                             (F.col("first") + F.col("inside")).alias("start")))

    def drawn(self) -> DataFrame:
        """One row per slot: shard, its place there, source, epoch and block."""
        cells, seen = [], np.zeros(len(self.slots), dtype=np.int64)
        for shard, row in enumerate(self.counts):
            place = 0
            for sid, n in enumerate(row):
                if n:
                    cells.append((shard, place, sid, int(seen[sid]), int(n), self.blocks[sid]))
                seen[sid] += n
                place += int(n)
        df = self.spark.createDataFrame(cells, "shard int, place long, sid int, first long, n long, blocks long")
        chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {CHUNK}")))
        # By number: few small rows become many, which the planner can't see, so it must not merge these partitions.
        df = df.withColumn("chunk", chunk).repartition(int(sum(self.slots)) // SLOTS_PER_TASK + 1, "shard", "sid", "chunk")
        step = F.explode(F.sequence(F.col("chunk") * CHUNK, F.least(F.col("n"), (F.col("chunk") + 1) * CHUNK) - 1))
        df = df.withColumn("j", step).select("shard", (F.col("place") + F.col("j")).alias("slot"), "sid",
                                             (F.col("first") + F.col("j")).alias("index"), "blocks")
        seed = self.seed

        def blocks_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                n, sid = b["blocks"].to_numpy(), b["sid"].to_numpy().astype(np.uint64)
                index = b["index"].to_numpy()
                epoch = index // n
                key = mix(np.uint64(seed) + sid * np.uint64(1 << 20) + epoch.astype(np.uint64))
                yield pd.DataFrame({"shard": b["shard"], "slot": b["slot"], "sid": b["sid"], "epoch": epoch.astype(np.int32),
                                    "block": permute(index % n, n, key)})

        return df.mapInPandas(blocks_of, "shard int, slot long, sid int, epoch int, block long")

    def pieces(self) -> DataFrame:
        """One row per (document, block it reaches into): the words [from_word, to_word) of the document."""
        b = self.block_words
        d = self.docs.filter("size > 0").withColumn(
            "block", F.explode(F.sequence(F.expr(f"start div {b}"), F.expr(f"(start + size - 1) div {b}"))))
        return d.withColumns({"from_word": F.greatest(F.col("block") * b - F.col("start"), F.lit(0)),
                              "to_word": F.least((F.col("block") + 1) * b - F.col("start"), F.col("size"))})

    def taken(self) -> DataFrame:
        """One row per document: the words the mix takes of it, repeats counted."""
        times = self.drawn().groupBy("sid", "block").agg(F.count("*").alias("times"))
        keys = ["doc_id", "sid", "start", "size", "source_size", "target"]
        some = (self.pieces().join(times.hint("merge"), ["sid", "block"], "left").groupBy(*keys)
                .agg(F.sum((F.col("to_word") - F.col("from_word")) * F.coalesce("times", F.lit(0))).alias("taken")))
        none = self.docs.filter("size = 0").select(*keys, F.lit(0).cast("long").alias("taken"))
        return some.unionByName(none).select("doc_id", "size", "source_size", "target", "taken")


def mix_digest(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken for every document."""
    return Mix(docs, **options).taken()


# A word with the white space before it; the first one of a piece drops that space.
_UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"


def mixed_blocks(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: one row per slot (shard, slot, epoch, source, block, text of its words)."""
    plan = Mix(docs, **options)
    spans = plan.pieces().groupBy("doc_id", "tk", "copy", "sid").agg(
        F.sort_array(F.collect_list(F.struct("block", "from_word", "to_word", "start"))).alias("spans"))
    cut = F.transform("spans", lambda s: F.struct(
        s["block"].alias("block"), (s["start"] + s["from_word"]).alias("at"), _words_of("units", s).alias("text")))
    fragments = (_with_rows(docs.select("doc_id", "text", "source"), plan, spans)
                 .withColumn("units", F.regexp_extract_all("text", F.lit(_UNIT), F.lit(0)))
                 .select("sid", F.col("src").alias("source"), F.explode(cut).alias("piece")).select("sid", "source", "piece.block", "piece.at", "piece.text"))
    return (plan.drawn().hint("merge").join(fragments, ["sid", "block"]).groupBy("shard", "slot", "epoch", "source", "block")
            .agg(F.concat_ws("\n", F.transform(F.sort_array(F.collect_list(F.struct("at", "text"))),
                                              lambda x: F.regexp_replace(x["text"], r"^[\x20\x09-\x0D]+", ""))).alias("text")))


def _words_of(units: str, span):
    return F.concat_ws("", F.slice(units, (span["from_word"] + 1).cast("int"), (span["to_word"] - span["from_word"]).cast("int")))


def _with_rows(docs: DataFrame, plan: Mix, spans: DataFrame) -> DataFrame:
    """Each row of ``docs`` (as ``doc``, with its text) joined to what was planned for it; equal rows are told apart by a running number."""
    sources = plan.spark.createDataFrame([(k, s) for k, s in enumerate(plan.sources)], "row_sid int, row_source string")
    text = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("doc"), "text", F.col("doc_id").alias("row_id"), F.col("source").alias("src"),
                       text_key(F.col("text")).alias("row_key"))
    text = text.withColumn("row_no", F.row_number().over(W.partitionBy("row_id", "row_key", "src").orderBy(F.lit(0))))
    text = text.join(F.broadcast(sources), F.col("src").eqNullSafe(F.col("row_source")))  # one row per source
    return text.join(spans, F.col("row_id").eqNullSafe(F.col("doc_id")) & (F.col("row_key") == F.col("tk"))
                     & (F.col("row_no") == F.col("copy")) & (F.col("row_sid") == F.col("sid")))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: per document and epoch, one row with the words taken in that epoch.

    All columns of ``docs`` stay.  A document taken whole keeps its text as it
    is; otherwise the text is its taken words with the white space between them.
    ``n_chars``, where there is such a column, is the length of the new text.
    """
    plan = Mix(docs, **options)
    slots = plan.drawn().select("sid", "block", "epoch")
    spans = (plan.pieces().join(slots.hint("merge"), ["sid", "block"]).groupBy("doc_id", "tk", "copy", "sid", "size", "epoch")
             .agg(F.sort_array(F.collect_list(F.struct("from_word", "to_word"))).alias("spans"),
                  F.sum(F.col("to_word") - F.col("from_word")).alias("n")))
    whole = F.col("n") == F.col("size")
    joined = _with_rows(docs, plan, spans).withColumn("units", F.when(~whole, F.regexp_extract_all("text", F.lit(_UNIT), F.lit(0))))
    part = F.concat_ws("", F.transform("spans", lambda s: _words_of("units", s)))
    joined = joined.withColumn("new", F.when(whole, F.col("text")).otherwise(F.regexp_replace(part, r"^[\x20\x09-\x0D]+", "")))
    cols = {"text": F.col("new"), "n_chars": F.length("new").cast(dict(docs.dtypes).get("n_chars", "long"))}
    return joined.select(*[(cols[c] if c in cols else F.col("doc")[c]).alias(c) for c in docs.columns])
