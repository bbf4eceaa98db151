"""SimHash near-duplicates by pivot distance tables.

1. Fingerprints.  XXH64 of every 3-word shingle of the whole text; a bit is set if
   more than half of the hashes set it.  Documents of one fingerprint form a class.
2. Pivot table.  The Hamming distances of each distinct fingerprint to ``PIVOTS``
   reference fingerprints: zero, the 16 that fill one group of four bits, and
   random ones.  |d(x, p) - d(y, p)| <= d(x, y) for every reference p, so a pair
   within ``DIFFER`` bits has no coordinates further apart than that.
3. Candidates.  The coordinates of zero and of a group's reference tell how many
   bits the group has set, and those 16 numbers differ in ``DIFFER`` groups at most.
   So of 6 parts of them at least 4 are equal: each fingerprint is dealt to the 15
   keys of four parts, and partners meet under one of them.
4. Discard and verify.  Under one key, pairs with a maximum coordinate difference
   over ``DIFFER`` are discarded, the rest is compared bit by bit, and links leave
   the task as a forest, never as all pairs of a group.
5. Crowded keys, of more than ``CROWD`` fingerprints, aren't paired.  Their members
   take references of their own: the fingerprints at distance 0 and 1.  Two
   members within 2 bits share one of these, and d(x, p) + d(p, y) <= 2 accepts
   all that do, so the least one per reference links them: linear and exact.
6. Components by alternating large-star and small-star.

Nothing is estimated: every link of 2 or fewer bits is found.

Defined results: without words the fingerprint is zero and linked like any other;
null text has no words; a null doc_id takes part but names no component (null only
where no member has an id); repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import stored
from adlens.llm.near_dup import components

SHINGLE = 3
SEED = 42
DIFFER = 2
CROWD = 64
GROUPS = 16  # of four bits
RANDOM_PIVOTS = 15
PARTS = [(0, 1, 2), (3, 4, 5), (6, 7, 8), (9, 10, 11), (12, 13), (14, 15)]
KEYS = [sum((PARTS[k] for k in some), ()) for some in combinations(range(len(PARTS)), len(PARTS) - DIFFER)]
_CHUNK = 1 << 16

_NIBBLE = np.uint64(0xF) << (np.uint64(4) * np.arange(GROUPS, dtype=np.uint64))
PIVOTS = np.concatenate((np.zeros(1, np.uint64), _NIBBLE, np.random.default_rng(12).integers(0, 1 << 64, RANDOM_PIVOTS, dtype=np.uint64)))
_FLIPS = np.concatenate((np.zeros(1, np.uint64), np.uint64(1) << np.arange(64, dtype=np.uint64)))


def fingerprint(text: str | None) -> int:
    """The 64-bit fingerprint of one whole text."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z, and the contract's six white-space characters
    if not words:
        return 0
    line = b" ".join(words)
    end = np.cumsum([len(w) + 1 for w in words]) - 1
    start = np.concatenate(([0], end[:-1] + 1))
    n = max(1, len(words) - SHINGLE + 1)
    start, end = start[:n].tolist(), end[min(SHINGLE, len(words)) - 1:].tolist()
    of, seen = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for k in range(0, n, _CHUNK):
        h = np.array([of(line[a:b], SEED) for a, b in zip(start[k:k + _CHUNK], end[k:k + _CHUNK])], dtype="<u8")
        seen += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * seen > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the fingerprint's 64 bits as a long) of every document, stored."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t.as_py()) for t in batch.column("text")], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(d.mapInArrow(each, "doc_id long, fp long"), "fingerprints")


def distances(fp: np.ndarray) -> np.ndarray:
    """[fingerprint, pivot] Hamming distances."""
    return np.bitwise_count(fp[:, None] ^ PIVOTS[None, :])


def pivot_table(fps: DataFrame) -> DataFrame:
    """fp, dist (one byte per pivot), keys (of four parts each) of the distinct fingerprints, stored."""
    weights = np.random.default_rng(5).integers(1, 1 << 63, (len(KEYS), GROUPS), dtype=np.uint64)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = distances(batch.column("fp").to_numpy().view(np.uint64))
            # d(x, group) = d(x, 0) + 4 - 2 * (bits set in the group)
            bits = ((d[:, :1].astype(np.int64) + 4 - d[:, 1:1 + GROUPS]) // 2).astype(np.uint64)
            keys = np.empty((len(d), len(KEYS)), dtype=np.uint64)
            for k, groups in enumerate(KEYS):
                key = np.zeros(len(d), dtype=np.uint64)
                for g in groups:
                    key = key * np.uint64(5) + bits[:, g]  # at most 4: exact, 5**12 < 2**28
                keys[:, k] = key * np.uint64(len(KEYS)) + np.uint64(k)
            yield pa.RecordBatch.from_arrays([batch.column("fp"), pa.array([x.tobytes() for x in d], pa.binary()),
                                              pa.array(list(keys.view(np.int64)), pa.list_(pa.int64()))], names=["fp", "dist", "keys"])

    return stored(fps.mapInArrow(each, "fp long, dist binary, keys array<long>"), "pivot-table")


def survivors(fp: np.ndarray, dist: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (i < j) within DIFFER bits: by maximum coordinate difference first, then bit by bit."""
    i, j = np.triu_indices(len(fp), 1)
    apart = np.abs(dist[i].astype(np.int16) - dist[j]).max(axis=1, initial=0)
    i, j = i[apart <= DIFFER], j[apart <= DIFFER]
    near = np.bitwise_count(fp[i] ^ fp[j]) <= DIFFER
    return i[near], j[near]


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """As many of the pairs as it takes to connect what they connect."""
    root, out = list(range(n)), []
    for a, b in zip(i.tolist(), j.tolist()):
        x, y = a, b
        while root[x] != x:
            x = root[x]
        while root[y] != y:
            y = root[y]
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def links(table: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(a, b): fingerprints within DIFFER bits, enough of them to connect all that are linked."""
    rows = table.select("fp", "dist", F.explode("keys").alias("key"))
    sizes = stored(rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "keys")
    crowded = stored(rows.select("fp", "key").join(sizes.filter(F.col("n") > crowd), "key").select("fp").distinct(), "crowded")
    few = rows.join(sizes.filter(F.col("n") <= crowd), "key").groupBy("key").agg(F.collect_list(F.struct("fp", "dist")).alias("group"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for group in batch.column("group"):  # at most CROWD members
                items = group.values
                fp = items.field("fp").to_numpy().view(np.uint64)
                dist = np.frombuffer(b"".join(items.field("dist").to_pylist()), np.uint8).reshape(len(fp), -1)
                out += [(fp[a], fp[b]) for a, b in _forest(len(fp), *survivors(fp, dist))]
            pairs = np.array(out, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    near = few.select("group").mapInArrow(compare, "a long, b long")
    balls = crowded.select("fp", F.explode(F.lit(_FLIPS.view(np.int64).tolist())).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("ref"))
    least = balls.groupBy("ref").agg(F.min("fp").alias("least"), F.count("*").alias("n")).filter("n > 1")
    shared = balls.join(least, "ref").filter("fp <> least").select(F.col("fp").alias("a"), F.col("least").alias("b"))
    return near.unionByName(shared).distinct()


def near_duplicates(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """doc_id, fingerprint (hexadecimal), component_id for every document."""
    fps = fingerprints(docs)
    classes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    roots = components(links(pivot_table(classes.select("fp")), crowd)).withColumnRenamed("node", "fp")
    named = stored(classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    of = named.join(least, "root").select("fp", "component_id")
    return (fps.join(of, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))
