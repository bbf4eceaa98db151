"""Removal of long repeated byte strings, by threshold-bounded interval expansion on a Burrows-Wheeler transform.

A byte goes when a ``LENGTH``-byte string covering it also starts anywhere else.
Strings are found exactly, in three distributed steps:

1. Anchors.  Each window of ``LENGTH`` bytes names one ``GRAM``-byte string in
   it, the one of least hash (the first of equals).  Equal windows name equal
   anchors at equal places, so windows can only repeat among the occurrences of
   one anchor; neighbouring windows share an anchor, so there are few anchors.
   Anchors are counted over the corpus and those that occur once fall away.
2. Strings.  Each remaining occurrence is the string of bytes its windows span
   (under ``2 * LENGTH`` bytes).  Equal strings are merged and counted.
3. Expansion.  Where an anchor has several strings, those are gathered, whole
   anchors at a time, into pools of about ``POOL_BYTES``.  On the pool's
   Burrows-Wheeler transform, intervals are extended backwards breadth first; a
   suffix boundary gets its common-prefix length when an interval first ends
   there, so lengths come out in increasing order.  The expansion stops at
   ``LENGTH``: boundaries without a value have a common prefix of at least that,
   and the suffixes on both sides start a repeated string.

An anchor with more than ``POOL_STRINGS`` different strings (a passage in very
many contexts) is not pooled: its windows are compared by their 128-bit digest in
one aggregation, with the same result, so no pool grows with the corpus.

With ``passage`` (a number of words) a further column tells of passages that stand
in another document too, word for word, white space aside: the words covered by
windows of that many words which also stand in a different document.  They go
through the same anchors and strings, in words; an anchor's few strings are then
compared window by window.  Nothing is removed for them.

Equal whole texts are counted beforehand; only one of them gives strings.
Positions are bytes, matches never cross documents, long documents are worked
on in overlapping parts.  Texts meet their strings and spans by shuffles, at
every size alike; of anchors, only the hashes of those that occur twice are
broadcast, up to ``BROADCAST_BYTES``, else that join shuffles too.

Defined results: null text is empty; a null doc_id is carried through; repeated
rows repeat each other and lose all bytes from ``LENGTH`` on; texts shorter than
``LENGTH`` lose nothing; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import stored
from adlens.llm.rolling import prefix_hash, span_hash

LENGTH = 400
GRAM = 128
POOL_BYTES = 1 << 20
POOL_STRINGS = 4_000
PART_BYTES = 1 << 19
BROADCAST_BYTES = 32 << 20
PASSAGE_WORDS = 51
PASSAGE_GRAM = 12


def anchors_of(buffer: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, anchor hash) of each anchor occurrence; ``ends`` are the documents' ends in the buffer."""
    if len(buffer) < length:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    at = np.arange(len(buffer) - gram + 1)
    return _least(span_hash(prefix_hash(buffer), at, at + gram), len(buffer), ends, length, gram)


def word_anchors_of(buffer: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same in words, of words with one space between any two; ``ends`` counts words."""
    cut = np.flatnonzero(buffer == 32)
    if len(cut) + 1 < length:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    starts, stops = np.append(0, cut + 1), np.append(cut, len(buffer))
    n = len(starts)
    return _least(span_hash(prefix_hash(buffer), starts[:n - gram + 1], stops[gram - 1:]), n, ends, length, gram)


def _least(grams: np.ndarray, n: int, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    width = length - gram + 1
    at = np.arange(n - gram + 1)
    # The upper 40 bits decide, then the place: the first of equals wins.
    key = (grams & ~np.uint64((1 << 24) - 1)) | at.astype(np.uint64)
    m = len(key)
    padded = np.full(-(-m // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:m] = key
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    right = np.minimum.accumulate(blocks, axis=1).ravel()
    windows = n - length + 1
    place = (np.minimum(left[:windows], right[width - 1:width - 1 + windows]) & np.uint64((1 << 24) - 1)).astype(np.int64)
    owner = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))[:windows]
    inside = np.arange(windows) + length <= ends[owner]
    new = np.ones(windows, dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], windows) - 1
    # Windows of a document stop together, so a run is cut where its document's windows end.
    last = np.minimum(last, ends[owner[first]] - length)
    ok = inside[first]
    return first[ok], last[ok], grams[place[first[ok]]]


def _texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    return [(t or "").encode("utf-8", "replace") for t in batch.column(column).to_pylist()]


def _named(parts: list[tuple[bytes, int, bytes, int]], find, length: int, gram: int, low: int) -> Iterator[pa.RecordBatch]:
    """Anchors of parts (key, offset in the document, bytes, size in windows' units); ``low`` is the hashes' lowest bit."""
    glue = b" " if low else b""
    begin = 0
    while begin < len(parts):
        stop, size = begin, 0
        while stop < len(parts) and (stop == begin or size + len(parts[stop][2]) <= PART_BYTES):
            size += len(parts[stop][2])
            stop += 1
        some = parts[begin:stop]
        ends = np.cumsum([p[3] for p in some])
        first, last, h = find(np.frombuffer(glue.join(p[2] for p in some), np.uint8), ends, length, gram)
        h = (h & ~np.uint64(1)) | np.uint64(low)
        owner = np.searchsorted(ends, first, side="right")
        shift = np.array([p[1] for p in some]) - np.append(0, ends[:-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array([some[k][0] for k in owner], pa.binary()), pa.array(first + shift[owner], pa.int64()),
             pa.array(last + shift[owner], pa.int64()), pa.array(h.view(np.int64))], names=["key", "w1", "w2", "h"])
        begin = stop


def _anchors(length: int, gram: int, passage: int = 0, passage_gram: int = PASSAGE_GRAM):
    """Anchors of byte windows (even hashes) and, with ``passage``, of word windows (odd hashes)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column("key").to_pylist(), _texts(batch, "text")
            parts: list[tuple[bytes, int, bytes, int]] = []
            for key, data in zip(keys, texts):
                for a in range(0, len(data) - length + 1, PART_BYTES):
                    part = data[a:a + PART_BYTES + length - 1]
                    parts.append((key, a, part, len(part)))
            yield from _named(parts, anchors_of, length, gram, 0)
            if passage:
                parts, step = [], max(1, PART_BYTES // 8)
                for key, data in zip(keys, texts):
                    words = data.split()
                    for a in range(0, len(words) - passage + 1, step):
                        some = words[a:a + step + passage - 1]
                        parts.append((key, a, b" ".join(some), len(some)))
                yield from _named(parts, word_anchors_of, passage, passage_gram, 1)
    return work


def _near(df: DataFrame, row_bytes: int = 32) -> DataFrame:
    """``df`` (stored), to be broadcast if its counted rows are small."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Order of all rotations of ``t`` (uint8, with one unique byte), by prefix doubling from 8 bytes on."""
    n = len(t)
    wide = np.zeros(n, dtype=np.uint64)
    ring = np.concatenate((t, t[:8])) if n >= 8 else np.resize(t, n + 8)
    for k in range(8):
        wide = (wide << np.uint64(8)) | ring[k:k + n]
    order = np.argsort(wide)
    s = wide[order]
    fresh = np.concatenate(([True], s[1:] != s[:-1]))
    place = np.arange(n)
    # A rank is the first place of its group in the order, so ranks that are not shared stay.
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, place, 0))
    step = 8
    # Only places whose rank is shared are sorted again, each group in its own places.
    while True:
        place = place[~(fresh & np.append(fresh[1:], True))]
        if not len(place):
            return order
        tied = order[place]
        pair = rank[tied] * np.int64(n + 1) + rank[(tied + step) % n]
        o = np.argsort(pair)
        tied, pair = tied[o], pair[o]
        order[place] = tied
        fresh = np.concatenate(([True], pair[1:] != pair[:-1]))
        rank[tied] = place[np.maximum.accumulate(np.where(fresh, np.arange(len(place)), 0))]
        step *= 2


def unset_boundaries(t: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Boundaries j (between places j-1 and j of the order) whose common prefix is at least ``length``.

    Breadth-first backward extension: level l holds the intervals of strings of
    l bytes; an extended interval that ends at an unset boundary sets it to l.
    """
    n = len(t)
    kind = np.int32 if n < 1 << 31 else np.int64
    place = np.empty(n, dtype=kind)
    place[order] = np.arange(n, dtype=kind)
    bwt = t[(order - 1) % n]
    back = place[(order - 1) % n]  # place of the suffix one byte longer
    by_char = np.argsort(bwt, kind="stable").astype(kind)
    same = bwt[by_char[1:]] == bwt[by_char[:-1]]
    following, preceding = np.full(n, n, dtype=kind), np.full(n, -1, dtype=kind)
    following[by_char[:-1][same]] = by_char[1:][same]
    preceding[by_char[1:][same]] = by_char[:-1][same]
    done = np.zeros(n + 1, dtype=bool)
    done[0] = done[n] = True
    low, high = np.array([0], dtype=kind), np.array([n], dtype=kind)
    for _ in range(length):
        if not len(low):
            break
        size = high - low
        whole = np.repeat(low - np.cumsum(size, dtype=kind) + size, size) + np.arange(size.sum(), dtype=kind)
        top, bottom = np.repeat(high, size), np.repeat(low, size)
        # Intervals of one level are disjoint, so sorted starts and sorted ends belong together.
        starts = np.sort(back[whole[preceding[whole] < bottom]])
        ends = np.sort(back[whole[following[whole] >= top]]) + 1
        fresh = ~done[ends]
        done[ends] = True
        low, high = starts[fresh], ends[fresh]
    return np.flatnonzero(~done)


def repeated_starts(strings: list[bytes], length: int) -> list[np.ndarray]:
    """Per string, the sorted starts of ``length``-byte strings that also start elsewhere in the pool."""
    t = np.frombuffer(b"\xff".join(strings) + b"\xfe", dtype=np.uint8)  # neither byte occurs in UTF-8
    order = suffix_array(t)
    j = unset_boundaries(t, order, length)
    flagged = np.zeros(len(t), dtype=bool)
    flagged[order[j - 1]] = flagged[order[j]] = True
    out, at = [], 0
    for s in strings:
        out.append(np.flatnonzero(flagged[at:at + max(0, len(s) - length + 1)]))
        at += len(s) + 1
    return out


def _runs(starts: np.ndarray) -> list[tuple[int, int]]:
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return list(zip(starts[np.append(0, cut + 1)].tolist(), starts[np.append(cut, len(starts) - 1)].tolist()))


def _pools(length: int):
    """Over rows (h, digest, bytes) sorted by h: runs of repeated starts, one pool at a time."""
    def solve(rows: list[tuple[int, bytes, bytes]]) -> pd.DataFrame:
        out = []
        if rows:
            for (h, digest, _), starts in zip(rows, repeated_starts([r[2] for r in rows], length)):
                out += [(h, digest, a, b) for a, b in _runs(starts)]
        return pd.DataFrame(out, columns=["h", "digest", "r1", "r2"]).astype({"h": "int64", "r1": "int64", "r2": "int64"})

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple[int, bytes, bytes]] = []
        size = 0
        for batch in batches:
            for h, digest, data in zip(batch["h"], batch["digest"], batch["bytes"]):
                if size >= POOL_BYTES and h != rows[-1][0]:
                    yield solve(rows)
                    rows, size = [], 0
                rows.append((h, bytes(digest), bytes(data)))
                size += len(data)
        yield solve(rows)
    return work


def _word_windows(data: bytes, passage: int) -> list[bytes]:
    starts = [0]
    for word in data.split(b" "):
        starts.append(starts[-1] + len(word) + 1)
    return [data[a:b - 1] for a, b in zip(starts, starts[passage:])]


def _passages(passage: int):
    """Over rows (h, digest, bytes, lo, hi) sorted by h: runs of windows that stand in two texts, one anchor at a time."""
    def solve(rows: list[tuple[int, bytes, bytes, int, int]], out: list[tuple[int, bytes, int, int]]) -> None:
        seen: dict[bytes, tuple[int, int]] = {}
        windows = [_word_windows(r[2], passage) for r in rows]
        for (_, _, _, lo, hi), some in zip(rows, windows):
            for w in some:
                a, b = seen.get(w, (lo, hi))
                seen[w] = (min(a, lo), max(b, hi))
        for (h, digest, _, _, _), some in zip(rows, windows):
            twice = np.array([a != b for a, b in map(seen.__getitem__, some)], dtype=bool)
            out += [(h, digest, a, b) for a, b in _runs(np.flatnonzero(twice))]

    def frame(out: list[tuple[int, bytes, int, int]]) -> pd.DataFrame:
        return pd.DataFrame(out, columns=["h", "digest", "r1", "r2"]).astype({"h": "int64", "r1": "int64", "r2": "int64"})

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple[int, bytes, bytes, int, int]] = []
        for batch in batches:
            out: list[tuple[int, bytes, int, int]] = []
            for h, digest, data, lo, hi in zip(batch["h"], batch["digest"], batch["bytes"], batch["lo"], batch["hi"]):
                if rows and h != rows[-1][0]:
                    solve(rows, out)
                    rows = []
                rows.append((h, bytes(digest), bytes(data), lo, hi))
            yield frame(out)
        out = []
        solve(rows, out)
        yield frame(out)
    return work


def _spread(passage: int):
    """Over rows (h, digest, bytes, lo, hi): every word window by itself, as its digest."""
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for h, digest, data, lo, hi in zip(batch["h"], batch["digest"], batch["bytes"], batch["lo"], batch["hi"]):
                w = [hashlib.blake2b(x, digest_size=16).digest() for x in _word_windows(bytes(data), passage)]
                yield pd.DataFrame({"h": h, "digest": bytes(digest), "r": np.arange(len(w)), "w": w, "lo": lo, "hi": hi})
    return work


def repeated_windows(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, pool_strings: int = POOL_STRINGS,
                     passage: int = 0, passage_gram: int = PASSAGE_GRAM) -> DataFrame:
    """(key, spans, passages): per text (key: its MD5), the runs of window starts that repeat elsewhere, stored.

    ``passages`` holds the runs of word windows that stand in another document; without ``passage`` there are none.
    """
    least = min(length, 2 * passage - 1) if passage else length
    keyed = docs.select("doc_id", F.unhex(F.md5("text")).alias("key"), "text").filter(F.octet_length("text") >= least)
    anchors = stored(keyed.select("key", "text").mapInArrow(
        _anchors(length, gram, passage, passage_gram), "key binary, w1 long, w2 long, h long"), "anchors")
    # Equal whole texts count as one: by text and place for bytes, by text alone for words.
    in_words = F.col("h").bitwiseAND(F.lit(1)) == 1
    where = F.when(in_words, F.xxhash64("key")).otherwise(F.xxhash64("key", "w1"))
    often = anchors.select("h", where.alias("at")).groupBy("h").agg(F.min("at").alias("lo"), F.max("at").alias("hi"))
    often = stored(often.filter("lo <> hi").select("h"), "often")
    wanted = anchors.join(_near(often, 8), "h", "left_semi").groupBy("key").agg(F.collect_set(F.struct("w1", "w2", "h")).alias("strings"))
    wanted = stored(wanted.withColumnRenamed("key", "_key"), "wanted")
    copies = stored(keyed.groupBy("key").agg(F.count("*").alias("copies"), F.min("doc_id").alias("rep")), "copies")
    jobs = stored(wanted.join(copies, F.col("_key") == F.col("key")).select("_key", "rep", "copies", "strings"), "jobs")
    chosen = keyed.join(jobs, (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("rep"))).select("key", "text", "strings")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, data, strings in zip(batch.column("key").to_pylist(), _texts(batch, "text"), batch.column("strings").to_pylist()):
                words = data.split() if passage else []
                for s in strings:
                    piece = b" ".join(words[s["w1"]:s["w2"] + passage]) if passage and s["h"] & 1 else data[s["w1"]:s["w2"] + length]
                    out.append((key, s["w1"], s["w2"], s["h"], hashlib.blake2b(piece, digest_size=16).digest(), piece))
            for a in range(0, len(out), 2000):
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(
                    zip(*out[a:a + 2000]), (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                    names=["key", "w1", "w2", "h", "digest", "bytes"])

    found = stored(chosen.mapInArrow(cut, "key binary, w1 long, w2 long, h long, digest binary, bytes binary"), "strings")
    # lo and hi differ where a string stands in two different texts; a word string's windows are counted by its places.
    merged = found.groupBy("h", "digest").agg(
        F.count("*").alias("n"), F.first("bytes").alias("bytes"), F.max(F.col("w2") - F.col("w1")).alias("last"),
        F.min(F.xxhash64("key")).alias("lo"), F.max(F.xxhash64("key")).alias("hi"))
    merged = stored(merged, "merged")
    kinds = stored(merged.groupBy("h").agg(F.count("*").alias("kinds")).filter("kinds > 1"), "kinds")
    both = merged.join(_near(kinds, 16), "h")
    several = both.filter(~in_words)
    pool = several.filter(F.col("kinds") <= pool_strings).select("h", "digest", "bytes").repartition("h").sortWithinPartitions("h")
    spans = pool.mapInPandas(_pools(length), "h long, digest binary, r1 long, r2 long")
    # Anchors in very many contexts: every window by itself, compared by digest.
    alone = several.filter(F.col("kinds") > pool_strings).select("h", "digest", F.explode(F.transform(
        F.sequence(F.lit(0), F.octet_length("bytes") - length),
        lambda r: F.struct(r.cast("long").alias("r"), F.md5(F.substring("bytes", r + 1, F.lit(length))).alias("w")))).alias("x")).select("h", "digest", "x.*")
    twice = alone.groupBy("w").agg(F.count("*").alias("n")).filter("n > 1").select("w")
    spans = spans.unionByName(alone.join(twice, "w", "left_semi").select("h", "digest", F.col("r").alias("r1"), F.col("r").alias("r2")))
    spans = spans.unionByName(merged.filter(~in_words & (F.col("n") > 1)).select("h", "digest", F.lit(0).cast("long").alias("r1"), F.col("last").alias("r2")))
    if passage:
        several = both.filter(in_words).select("h", "digest", "bytes", "lo", "hi", "kinds")
        pool = several.filter(F.col("kinds") <= pool_strings).drop("kinds").repartition("h").sortWithinPartitions("h")
        spans = spans.unionByName(pool.mapInPandas(_passages(passage), "h long, digest binary, r1 long, r2 long"))
        alone = several.filter(F.col("kinds") > pool_strings).drop("kinds").mapInPandas(
            _spread(passage), "h long, digest binary, r long, w binary, lo long, hi long")
        twice = alone.groupBy("w").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).filter("lo <> hi").select("w")
        spans = spans.unionByName(alone.join(twice, "w", "left_semi").select("h", "digest", F.col("r").alias("r1"), F.col("r").alias("r2")))
        spans = spans.unionByName(merged.filter(in_words & (F.col("lo") != F.col("hi"))).select(
            "h", "digest", F.lit(0).cast("long").alias("r1"), F.col("last").alias("r2")))
    places = found.select("key", "w1", "h", "digest")
    span = F.struct("a", "b")
    hits = places.join(spans, ["h", "digest"]).select(
        "key", (F.col("w1") + F.col("r1")).alias("a"), (F.col("w1") + F.col("r2")).alias("b"), (~in_words).alias("bytes"), in_words.alias("words"))
    # Both hold for a whole text that comes twice.
    whole = copies.filter("copies > 1").select(
        "key", F.lit(0).cast("long").alias("a"), F.lit((1 << 62)).cast("long").alias("b"), F.lit(True).alias("bytes"), F.lit(True).alias("words"))
    return stored(hits.unionByName(whole).groupBy("key").agg(
        F.collect_set(F.when(F.col("bytes"), span)).alias("spans"), F.collect_set(F.when(F.col("words"), span)).alias("passages"))
        .withColumnRenamed("key", "_key"), "spans")


def removed_runs(spans, size: int, length: int) -> list[tuple[int, int]]:
    """Maximal runs (of bytes, or words) covered by windows starting in the given (first, last) spans."""
    out: list[list[int]] = []
    if size < length:
        return []
    for a, b in sorted((s["a"], min(s["b"], size - length)) for s in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b + length)
        else:
            out.append([a, b + length])
    return [(a, b) for a, b in out]


def strip_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, pool_strings: int = POOL_STRINGS,
                  passage: int = 0, passage_gram: int = PASSAGE_GRAM) -> DataFrame:
    """One row per document: bytes, bytes removed, maximal removed runs, and the checksum of what is left.

    With ``passage``, also the words in passages of at least that many words that stand in another document; they stay.
    """
    spans = repeated_windows(docs, length, gram, pool_strings, passage, passage_gram)
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.unhex(F.md5("text")))
    d = d.join(spans, F.col("key") == F.col("_key"), "left")
    hit = F.col("spans").isNotNull()

    @F.pandas_udf("removed long, runs long, sha string, words long")
    def strip(texts: pd.Series, spans: pd.Series, passages: pd.Series) -> pd.DataFrame:
        rows = []
        for text, s, p in zip(texts, spans, passages):
            if text is None:
                rows.append((0, 0, None, 0))
                continue
            data = text.encode("utf-8")
            runs = removed_runs(s, len(data), length)
            kept, at = hashlib.sha256(), 0
            for a, b in runs:
                kept.update(data[at:a])
                at = b
            kept.update(data[at:])
            words = sum(b - a for a, b in removed_runs(p, len(data.split()), passage)) if passage and len(p) else 0
            rows.append((sum(b - a for a, b in runs), len(runs), kept.hexdigest(), words))
        return pd.DataFrame(rows, columns=["removed", "runs", "sha", "words"])

    d = d.withColumn("x", strip(F.when(hit, F.col("text")), F.col("spans"), F.col("passages")))
    out = [F.col("x.words").alias("n_passage_words")] if passage else []
    return d.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.col("x.removed").alias("n_removed"),
                    F.col("x.runs").alias("n_spans"),
                    F.when(hit, F.col("x.sha")).otherwise(F.sha2("text", 256)).alias("kept_sha256"), *out)
