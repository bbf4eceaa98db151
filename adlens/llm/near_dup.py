"""MinHash near-duplicate detection on sets of five-word shingles.

1. Signatures.  ``BANDS`` x ``ROWS`` universal hash functions (multiply-add on
   64-bit words) each keep their minimum over a document's shingles; ``ROWS``
   minima make one band key.  Two bits of each minimum are kept as the signature.
2. Classes.  Documents with the same shingle set form one class; only one
   representative of a class goes on, so copies are never paired.
3. Candidates.  Within a bucket (equal band keys) every member is paired with the
   smallest and the largest one: linear in the bucket, found by partial
   aggregation and a join, whatever its size.
4. Verification.  Pairs whose signatures differ too much for the threshold fall
   away (six standard deviations); the rest is decided on the full sets.
5. Components by alternating large-star and small-star steps.
6. What step 3 left open: buckets of four or more that still hold several
   components.  Each such bucket has a hub, the member that meets most others; its
   members are held as their differences to the hub (shingles missing, shingles
   added), which tells at once who is linked with the hub.  Two members of different components can
   only be linked if they share a computable number of differences, so pairs come
   from a join on shared differences, rarest first (a prefix filter), without loss:
   a crowd of copies that each went their own way doesn't become all pairs.

A link at the threshold J is missed with probability (1 - J**6)**40: 6e-9 at 0.85, 5e-6 at 0.8.

On the driver: counts only.  A table is broadcast only when its counted rows are
at most ``BROADCAST_ROWS``; the same join runs as a shuffle beyond that.

Defined results: without words or text the set is empty and linked with nothing;
documents with one set are linked; a null doc_id takes part but names no
component (``component_id`` is the smallest id that is not null); a document
without id is kept unless it is linked with one that has an id or it has no id
in its whole component and another row of it is kept (then all are kept, as
nothing tells them apart); repeated rows get equal results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlens.llm.common import stored, text_key
from adlens.llm.rolling import mix, prefix_hash, span_hash

SHINGLE = 5
THRESHOLD = 85  # per cent, unless a caller asks for another
BANDS, ROWS = 40, 6
PLANES = 4  # 64-bit words per signature plane
BROADCAST_ROWS = 1_000_000
BATCH_BYTES = 1 << 20
HUB_PARTS = 16

_rng = np.random.default_rng(5_2024)
_A = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_PLACE = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each whole text; all hashing is on the joined bytes of the batch."""
    data = [(t or "").encode("utf-8", "replace").lower() for t in texts]  # bytes.lower: A-Z only
    buffer = np.frombuffer(b" ".join(data) + b" ", dtype=np.uint8)
    space = _IS_SPACE[buffer]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space)).astype(np.int8)))
    start, end = edge[0::2], edge[1::2]  # the buffer ends with a space, so words come in pairs of edges
    words = span_hash(prefix_hash(buffer), start, end) if len(start) else np.zeros(0, np.uint64)
    first = np.concatenate(([0], np.cumsum([len(d) + 1 for d in data])))
    bound = np.searchsorted(start, first)
    out = []
    for a, b in zip(bound[:-1], bound[1:]):
        n = b - a
        if n < SHINGLE:
            out.append(mix(np.array([np.sum(words[a:b] * _PLACE[:n], dtype=np.uint64) + np.uint64(n)], dtype=np.uint64)) if n
                       else np.zeros(0, np.uint64))
            continue
        h = np.zeros(n - SHINGLE + 1, dtype=np.uint64)
        for k in range(SHINGLE):
            h += words[a + k:b - SHINGLE + 1 + k] * _PLACE[k]
        out.append(np.unique(mix(h + np.uint64(SHINGLE))))
    return out


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """[set, function] minima of the upper 32 bits of a * x + b; sets must not be empty."""
    out = np.empty((len(sets), BANDS * ROWS), dtype=np.uint64)
    begin = 0
    while begin < len(sets):
        stop, size = begin, 0
        while stop < len(sets) and (stop == begin or size + len(sets[stop]) <= 1 << 15):  # stays in the processor's cache
            size += len(sets[stop])
            stop += 1
        x = np.concatenate(sets[begin:stop])
        at = np.concatenate(([0], np.cumsum([len(s) for s in sets[begin:stop - 1]]))).astype(np.int64) if stop - begin > 1 else np.zeros(1, np.int64)
        y = np.empty_like(x)
        for k in range(BANDS * ROWS):
            np.multiply(x, _A[k], out=y)
            np.add(y, _B[k], out=y)
            out[begin:stop, k] = np.minimum.reduceat(y, at)
        begin = stop
    return out >> np.uint64(32)


def band_keys(m: np.ndarray) -> np.ndarray:
    """[set, band] keys: a hash of the band's number and its minima."""
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(m), BANDS)).copy()
    for r in range(ROWS):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + m[:, r::ROWS])
    return h.view(np.int64)


def signatures(m: np.ndarray) -> np.ndarray:
    """[set, 2 * PLANES] words: the two lowest bits of each minimum, one plane per bit."""
    planes = []
    for bit in range(2):
        bits = np.zeros((len(m), PLANES * 64), dtype=np.uint8)
        bits[:, :m.shape[1]] = (m >> np.uint64(bit)) & np.uint64(1)
        planes.append(np.packbits(bits, axis=1).view(">i8").astype(np.int64))
    return np.concatenate(planes, axis=1)


_SKETCH = "doc_id long, tk long, n_shingles long, digest binary, bands array<long>, " + \
    ", ".join(f"s{k} long" for k in range(2 * PLANES))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _slices(batch):
            sets = shingle_sets(part.column("text").to_pylist())
            full = [s for s in sets if len(s)]
            m = minima(full) if full else np.zeros((0, BANDS * ROWS), np.uint64)
            where = np.full(len(sets), -1)
            where[[k for k, s in enumerate(sets) if len(s)]] = np.arange(len(full))
            keys, sig = band_keys(m), signatures(m)
            bands = pa.array([keys[w] if w >= 0 else [] for w in where], pa.list_(pa.int64()))
            digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), part.column("tk"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), bands]
                + [pa.array([int(sig[w, k]) if w >= 0 else 0 for w in where], pa.int64()) for k in range(2 * PLANES)],
                names=["doc_id", "tk", "n_shingles", "digest", "bands"] + [f"s{k}" for k in range(2 * PLANES)])


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about BATCH_BYTES of text each, one row at least."""
    sizes = np.array([len(t) if t else 0 for t in batch.column("text").to_pylist()], dtype=np.int64)
    part = np.cumsum(sizes) // BATCH_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def sketch(docs: DataFrame) -> DataFrame:
    """One stored row per document: set size, digest of the set, band keys and signature."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("tk"), "text")
    return stored(d.mapInArrow(_sketch, _SKETCH), "sketch")


def _differ(a: str, b: str):
    """How many of the minima differ by their two bits."""
    total = F.lit(0)
    for k in range(PLANES):
        total = total + F.bit_count(F.col(f"{a}.s{k}").bitwiseXOR(F.col(f"{b}.s{k}")).bitwiseOR(
            F.col(f"{a}.s{k + PLANES}").bitwiseXOR(F.col(f"{b}.s{k + PLANES}"))))
    return total


def max_differ(threshold: int) -> int:
    """Signature disagreements allowed: the minima, two bits each, differ with (1 - J) * 3/4; six standard deviations."""
    n, p = BANDS * ROWS, (1 - threshold / 100) * 0.75
    return int(n * p + 6 * (n * p * (1 - p)) ** 0.5) + 1


def _alike(a: str, b: str, threshold: int):
    """Sizes and signatures allow the threshold."""
    small, large = F.least(F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")), F.greatest(F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles"))
    return (100 * small >= threshold * large) & (_differ(a, b) <= max_differ(threshold))


def _near(df: DataFrame) -> DataFrame:
    """``df``, to be broadcast if it is counted to be small; ``df`` must be stored."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def shingle_table(nodes: DataFrame, reps: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, shingles: the sorted hashes as bytes) of the given nodes, from their whole texts, stored."""
    wanted = stored(reps.join(nodes, "node").select("node", F.col("doc_id").alias("_id"), F.col("tk").alias("_tk")), "wanted")
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = d.join(_near(wanted), d["doc_id"].eqNullSafe(F.col("_id")) & (text_key(d["text"]) == F.col("_tk"))).select("node", "text")

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                sets = shingle_sets(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "shingles"])

    return stored(texts.mapInArrow(to_sets, "node long, shingles binary").dropDuplicates(["node"]), "sets")


def verify(pairs: DataFrame, sets: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The pairs (a, b) of nodes whose full shingle sets reach the threshold, stored."""
    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= threshold * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with_sets = (pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
                 .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b"))
    return stored(with_sets.select("a", "b", "x", "y").mapInArrow(linked, "a long, b long"), "links")


_DIFFERENCES = "hub long, node long, h long, missing long, added long, d array<long>"


def differences(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """Each (hub, node) with the hub's size and the shingles that only one of the two has, stored."""
    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, missing, added, d = [], [], [], []
            for x, y in zip(batch.column("hub_set").to_pylist(), batch.column("shingles").to_pylist()):
                x, y = np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)
                gone, new = np.setdiff1d(x, y, assume_unique=True), np.setdiff1d(y, x, assume_unique=True)
                size.append(len(x))
                missing.append(len(gone))
                added.append(len(new))
                d.append(np.concatenate([gone, new]))
            yield pa.RecordBatch.from_arrays([batch.column("hub"), batch.column("node"), pa.array(size, pa.int64()), pa.array(missing, pa.int64()),
                                              pa.array(added, pa.int64()), pa.array(d, pa.list_(pa.int64()))], names=["hub", "node", "h", "missing", "added", "d"])

    # A hub's group may be large: its rows are dealt over HUB_PARTS tasks, each with the hub's set.
    hubs = sets.join(groups.select("hub").distinct(), F.col("node") == F.col("hub")).select(
        "hub", F.col("shingles").alias("hub_set"), F.explode(F.sequence(F.lit(0), F.lit(HUB_PARTS - 1))).alias("part"))
    dealt = groups.withColumn("part", F.pmod(F.xxhash64("node"), F.lit(HUB_PARTS)).cast("int"))
    return stored(dealt.join(sets, "node").join(hubs, ["hub", "part"]).select("hub", "node", "hub_set", "shingles").mapInArrow(differ, _DIFFERENCES), "differences")


def shared_differences(differing: DataFrame, threshold: int) -> DataFrame:
    """(a, b): the pairs of different components that may be links, from (hub, node, root, cost, budget, d); exact, no estimate.

    With m missing and a added shingles, a node's cost is 100 m + J a, the budget (100 - J) h.
    Two nodes that share s differences are linked exactly if their costs are at most
    budget + (100 + J) s together.  As all within the budget hang on the hub, s >= 1
    for the others.  ``low`` is the least cost a node's partner can have: so many differences, ``need``, it
    shares with any.  Of its differences that another component has, too, ordered
    from the rarest, one of the first (their number - need + 1) must then be shared.
    """
    each = differing.select("hub", "node", "root", "cost", F.explode("d").alias("d"))
    held = each.groupBy("hub", "d").agg(F.count("*").alias("holders"), F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi")
    each = stored(each.join(held.select("hub", "d", "holders"), ["hub", "d"]), "shared-differences")
    nodes = each.groupBy("hub", "node", "root", "cost").agg(F.count("*").alias("able"))
    cheapest = nodes.groupBy("hub", "root").agg(F.min("cost").alias("cost"))
    first = cheapest.groupBy("hub").agg(F.min(F.struct("cost", "root")).alias("first"))
    second = cheapest.join(first, "hub").filter(F.col("root") != F.col("first.root")).groupBy("hub").agg(F.min("cost").alias("second"))
    budgets = differing.select("hub", "budget").distinct()
    per_hub = stored(first.join(second, "hub").join(budgets, "hub"), "hubs")  # one row each
    low = F.when(F.col("root") == F.col("first.root"), F.col("second")).otherwise(F.col("first.cost"))
    need = F.greatest(F.lit(1), F.ceil((F.col("cost") + low - F.col("budget")) / (100 + threshold)))
    left = nodes.join(_near(per_hub), "hub").withColumn("need", need).filter("able >= need")
    left = stored(left.select("hub", "node", "budget", "able", "need"), "sharing")
    rarest = Window.partitionBy("hub", "node").orderBy("holders", "d")
    heads = (each.join(left, ["hub", "node"]).withColumn("place", F.row_number().over(rarest)).filter("place <= able - need + 1")
             .select("hub", "node", "root", "cost", "budget", "able", "d"))
    x, y = heads.alias("x"), heads.alias("y")
    enough = F.col("x.cost") + F.col("y.cost") <= F.col("x.budget") + (100 + threshold) * F.least("x.able", "y.able")
    return (x.join(y, (F.col("x.hub") == F.col("y.hub")) & (F.col("x.d") == F.col("y.d")) & (F.col("x.node") > F.col("y.node"))
                   & (F.col("x.root") != F.col("y.root")) & enough)
            .select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node it reaches.

    Alternating large-star and small-star: a node's neighbours are hung on its
    smallest one, by an aggregate and a join, never by a list of neighbours.
    """
    def star(edges: DataFrame, large: bool) -> DataFrame:
        both = _both_ways(edges) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        hung = both.join(least, "a")
        out = hung.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")) if large else \
            hung.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        return out.filter("a <> b")

    edges = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "edges")
    while not _all_stars(edges):
        edges = stored(star(star(edges, True), False).distinct(), "edges")
    leaves = edges.distinct()
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return leaves.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _all_stars(edges: DataFrame) -> bool:
    """No node has a smaller and a larger neighbour, nor two smaller ones: every component hangs on its smallest node."""
    ends = _both_ways(edges).groupBy("a").agg(F.min("b").alias("lo"), F.max("b").alias("hi"), F.max(F.when(F.col("b") < F.col("a"), F.col("b"))).alias("below"))
    return not ends.filter("lo < a and (hi > a or below > lo)").limit(1).count()


def link(docs: DataFrame, sketched: DataFrame, threshold: int = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(representatives with their node and set, (node, root)) of all documents that have a set."""
    columns = ["doc_id", "tk", "n_shingles", "digest", "bands"] + [f"s{k}" for k in range(2 * PLANES)]
    reps = stored(sketched.filter("digest is not null").dropDuplicates(["digest"])
                  .select(F.monotonically_increasing_id().alias("node"), *columns), "representatives")
    marks = ["node", "n_shingles"] + [f"s{k}" for k in range(2 * PLANES)]
    rows = reps.select("node", F.explode("bands").alias("band"))
    ends = rows.groupBy("band").agg(F.min("node").alias("p"), F.max("node").alias("q"), F.count("*").alias("n")).filter("n > 1")
    ends = stored(ends, "buckets")
    small = ends.count() <= BROADCAST_ROWS
    pairs = (rows.join(F.broadcast(ends) if small else ends, "band").select("node", F.explode(F.array("p", "q")).alias("p")).filter("node <> p")
             .select(F.greatest("node", "p").alias("a"), F.least("node", "p").alias("b")).distinct())
    slim = reps.select(*marks)
    tested = stored(pairs.alias("e").join(slim.alias("x"), F.col("e.a") == F.col("x.node")).join(slim.alias("y"), F.col("e.b") == F.col("y.node"))
                    .filter(_alike("x", "y", threshold)).select("e.a", "e.b"), "pairs")
    ends_of = lambda pairs: pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    links = verify(tested, shingle_table(ends_of(tested), reps, docs), threshold)
    roots = stored(components(links), "components")
    # Buckets of up to three are done: both ends met each other and the middle.
    large = ends.filter("n > 3").select("band")
    open_rows = rows.join(F.broadcast(large) if small else large, "band")
    open_rows = open_rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = open_rows.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("band")
    open_rows = stored(open_rows.join(mixed, "band", "left_semi").select("band", "node"), "open")
    if not open_rows.limit(1).count():
        return reps, roots
    sets = shingle_table(open_rows.select("node").distinct(), reps, docs)
    # The hub of a bucket is the member that meets most others over all open buckets; a node is in a hub's group once.
    sizes = open_rows.groupBy("band").agg(F.count("*").alias("met"))
    meets = open_rows.join(sizes, "band").groupBy("node").agg(F.sum("met").alias("met"))
    hubs = open_rows.join(meets, "node").groupBy("band").agg(F.max(F.struct("met", "node"))["node"].alias("hub"))
    groups = open_rows.join(hubs, "band").select("hub", "node").distinct()
    differing = differences(groups, sets).withColumn("cost", 100 * F.col("missing") + threshold * F.col("added")).withColumn("budget", (100 - threshold) * F.col("h"))
    known = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))  # what is joined stays joined
    spokes = differing.filter("cost <= budget and node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    roots = stored(components(known.unionByName(spokes)), "components")
    differing = differing.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    more = shared_differences(differing, threshold).join(tested, ["a", "b"], "left_anti")
    more = stored(more.alias("e").join(slim.alias("x"), F.col("e.a") == F.col("x.node")).join(slim.alias("y"), F.col("e.b") == F.col("y.node"))
                  .filter(_alike("x", "y", threshold)).select("e.a", "e.b"), "more-pairs")
    if more.limit(1).count():
        known = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        roots = stored(components(known.unionByName(verify(more, sets, threshold))), "components")
    return reps, roots


def _members(sketched: DataFrame, reps: DataFrame, roots: DataFrame) -> DataFrame:
    """Every document that has a set, with the root of its component."""
    nodes = reps.select("digest", "node").join(roots, "node", "left").select("digest", F.coalesce("root", "node").alias("root"))
    return sketched.filter("digest is not null").select("doc_id", "tk", "n_shingles", "digest").join(nodes, "digest")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document."""
    sketched = sketch(docs)
    members = _members(sketched, *link(docs, sketched))
    least = members.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    linked = members.join(least, "root").select("doc_id", "n_shingles", "component_id")
    alone = sketched.filter("digest is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    kept = F.when(F.col("component_id").isNull(), F.lit(True)).otherwise(F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    return linked.unionByName(alone).withColumn("kept", kept)


def unique_documents(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """One document of each component, with all its columns: the least doc_id (null last), then the least text hash.

    Documents without words stay, all of them.
    """
    sketched = sketch(docs)
    members = _members(sketched, *link(docs, sketched, threshold))
    name = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tk")
    first = members.groupBy("root").agg(F.min(name).alias("first"))
    others = members.join(first, "root").filter(~name.eqNullSafe(F.col("first"))).select(F.col("doc_id").alias("_id"), F.col("tk").alias("_tk"))
    others = stored(others.distinct(), "others")
    this = lambda m: docs["doc_id"].cast("long").eqNullSafe(m["_id"]) & (text_key(docs["text"]) == m["_tk"])
    near_others = _near(others)
    rows = docs.join(near_others, this(others), "left_anti")
    # Rows equal in doc_id and text share a name; if there are any, one of each stays.
    again = sketched.filter("digest is not null").groupBy("doc_id", "tk").agg(F.count("*").alias("n")).filter("n > 1")
    again = stored(again.select(F.col("doc_id").alias("_id"), F.col("tk").alias("_tk")), "again")
    if not again.limit(1).count():
        return rows
    same = rows["doc_id"].cast("long").eqNullSafe(again["_id"]) & (text_key(rows["text"]) == again["_tk"])
    return rows.join(again, same, "left_anti").unionByName(rows.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"]))
