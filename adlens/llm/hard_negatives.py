"""Hard-negative mining over Hilbert-ordered candidate blocks with zone maps.

1. Order.  Vectors become whole numbers; a Hilbert curve over all dimensions
   (``CURVE_BITS`` each) gives every row a place, and rows are sorted by label and
   place.  ``BLOCK`` rows make a block, ``PAGE`` blocks of a task a page; blocks are
   written to Parquet, each with its zone map: the least and greatest value per
   dimension, and the least and greatest label.
2. Choice.  For an anchor and a block, interval arithmetic over the zone map bounds
   every inner product from below and above.  An anchor has windows of scores it
   looks for; blocks whose bounds or labels meet no window are not read for it.
3. Seeds.  Each anchor first reads the page with the highest bound.  The k-th best
   score found in a window raises the window's lower end for all other pages.
4. Scores.  A task keeps one page and lets its anchors stream past, a few hundred at
   a time, as a matrix product.  Only the best k rows a window and page leave it.
5. The positives are found by the same search (same label, one open window); each
   positive's score then makes one window for the negatives (other labels).

Bounds decide only what is read: the result is exact and equals a scan of all
rows.  Where vectors don't cluster, few blocks can be left out, and the cost is
that of the scan, anchors x rows.  Scores are exact: 32- or 64-bit floats while
all sums are whole numbers they can hold, integers beyond.

Defined results: rows with a null vec_id, label or vector, or a null or non-finite
component take no part; a shorter vector counts as if zeros followed; repeated
rows are rows of their own, each with its results; equal scores go by vec_id; an
anchor without positives has no rows.  A score that no long can hold raises an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import stored

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # per cent of the positive's score
EVERY = 50
BLOCK = 256
PAGE = 64
CURVE_BITS = 2
PACK = 256  # anchors scored at a time
ZONE_PAGES = 64
LEAST, MOST = -(1 << 63), (1 << 63) - 1

_ROW = "vec_id long, label long, place binary, vec binary"
_BLOCK = "block long, page long, n long, label_lo long, label_hi long, ids binary, labels binary, vecs binary, lo binary, hi binary"
_ANCHOR = "row long, vec_id long, label long, vec binary, lo array<long>, hi array<long>, seed long"


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """[row, byte] places on the Hilbert curve through a grid of ``bits`` bits a dimension (Skilling's transform, on all rows at once)."""
    x = cells.astype(np.uint8).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = np.uint8(q - 1)
        for i in range(n):
            on = (x[i] & q) > 0
            t = np.where(on, 0, (x[0] ^ x[i]) & p).astype(np.uint8)
            x[0] ^= np.where(on, p, t).astype(np.uint8)
            x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where(x[n - 1] & q, np.uint8(q - 1), np.uint8(0))
        q >>= 1
    x ^= t
    planes = [(x.T >> b) & 1 for b in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes, axis=1), axis=1)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of whole numbers, exactly."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    most = lambda x: max(abs(int(x.min())), abs(int(x.max())))
    bound = most(a) * most(b) * a.shape[1]
    if bound >= 1 << 63:
        raise ValueError("vectors too long: a score may not fit a long")
    kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64
    return a.astype(kind) @ b.astype(kind).T


def bounds(anchors: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[anchor, block] least and greatest inner product that the zone maps allow."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    both = lambda x, y: product(np.concatenate((up, down), axis=1), np.concatenate((x, y), axis=1))
    return both(lo, hi), both(hi, lo)


def _array(data: bytes, width: int) -> np.ndarray:
    """Rows of whole numbers; the first byte tells their size."""
    return np.frombuffer(data, f"<i{data[0]}", offset=1).reshape(-1, width)


def _packed(x: np.ndarray) -> bytes:
    size = next(s for s in (1, 2, 4, 8) if not x.size or -(1 << (8 * s - 1)) <= x.min() and x.max() < 1 << (8 * s - 1))
    return bytes([size]) + x.astype(f"<i{size}").tobytes()


def blocks(vectors: DataFrame, scale: int = SCALE) -> tuple[DataFrame, int]:
    """The Hilbert-ordered blocks with their zone maps, stored, and the number of dimensions; vectors: vec_id, label, embedding."""
    x = F.col("embedding").cast("array<double>")
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    rows = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), x.alias("x"))
            .filter("vec_id is not null and label is not null and x is not null").filter(F.forall("x", finite)))
    ranges = rows.select(F.posexplode("x").alias("k", "v")).groupBy("k").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("k").collect()  # one row per dimension
    n, width = rows.count(), max(1, len(ranges))
    lo, hi = (np.array([r[c] for r in ranges] or [0.0]) * scale for c in ("lo", "hi"))
    if max(abs(lo).max(), abs(hi).max()) >= 1 << 62:
        raise ValueError("vectors too long: a score may not fit a long")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column("x")
            sizes = np.diff(data.offsets.to_numpy())
            v = np.zeros((batch.num_rows, width))
            v[np.arange(width)[None, :] < sizes[:, None]] = data.flatten().to_numpy()
            q = np.floor(v * scale)
            cells = np.floor((q - lo) / np.maximum(hi - lo, 1) * (1 << CURVE_BITS)).clip(0, (1 << CURVE_BITS) - 1)
            places = hilbert(cells, CURVE_BITS)
            q = q.astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array([p.tobytes() for p in places], pa.binary()),
                                              pa.array([_packed(r) for r in q], pa.binary())], names=["vec_id", "label", "place", "vec"])

    placed = rows.mapInArrow(place, _ROW).withColumn("copy", F.monotonically_increasing_id())  # equal rows can be parted, too
    order = ["label", "place", "vec_id", "copy"]
    tasks = max(1, -(-n // (2 * PAGE * BLOCK)))
    ordered = placed.repartitionByRange(tasks, *order).sortWithinPartitions(*order).drop("copy")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        ids, labels, vecs = [], [], []
        for batch in batches:
            ids += batch.column("vec_id").to_pylist()
            labels += batch.column("label").to_pylist()
            vecs += batch.column("vec").to_pylist()
            while len(ids) >= BLOCK:
                yield one((part << 24) + made, ids[:BLOCK], labels[:BLOCK], vecs[:BLOCK])
                ids, labels, vecs, made = ids[BLOCK:], labels[BLOCK:], vecs[BLOCK:], made + 1
        if ids:
            yield one((part << 24) + made, ids, labels, vecs)

    def one(block: int, ids: list, labels: list, vecs: list) -> pa.RecordBatch:
        x = np.concatenate([_array(v, width) for v in vecs])
        values = [block, block // PAGE, len(ids), min(labels), max(labels), np.array(ids, "<i8").tobytes(), np.array(labels, "<i8").tobytes(),
                  _packed(x), _packed(x.min(axis=0)), _packed(x.max(axis=0))]
        return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names=[c.split()[0] for c in _BLOCK.split(", ")])

    return stored(ordered.mapInArrow(pack, _BLOCK), "blocks"), width


def anchors_of(table: DataFrame, width: int, every: int = EVERY) -> DataFrame:
    """The rows whose vec_id ``every`` divides, with one open window each, stored."""
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids, labels, vecs in zip(*(batch.column(c).to_pylist() for c in ("block", "ids", "labels", "vecs"))):
                ids, labels, vecs = np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8"), _array(vecs, width)
                at = np.flatnonzero(ids % every == 0)
                m = len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block * BLOCK + at), pa.array(ids[at]), pa.array(labels[at]), pa.array([_packed(v) for v in vecs[at]], pa.binary()),
                     pa.array([[LEAST]] * m, pa.list_(pa.int64())), pa.array([[MOST]] * m, pa.list_(pa.int64())), pa.array([None] * m, pa.int64())],
                    names=[c.split()[0] for c in _ANCHOR.split(", ")])

    return stored(table.select("block", "ids", "labels", "vecs").mapInArrow(pick, _ANCHOR), "anchors")


def _windows(batch: pa.RecordBatch, width: int) -> tuple:
    """(rows, labels, vectors, window ends [anchor, window]) of a batch of anchors; missing windows are empty."""
    most = max([len(x) for x in batch.column("lo").to_pylist()] or [0])
    ends = [np.array([x + [fill] * (most - len(x)) for x in batch.column(c).to_pylist()], dtype=np.int64).reshape(-1, most)
            for c, fill in (("lo", MOST), ("hi", LEAST))]
    vecs = [_array(v, width) for v in batch.column("vec").to_pylist()]
    return (batch.column("row").to_numpy(), batch.column("label").to_numpy(), np.concatenate(vecs) if vecs else np.zeros((0, width), np.int64), *ends)


def choose(table: DataFrame, anchors: DataFrame, width: int, same: bool, seeds: bool) -> DataFrame:
    """The anchors with a page and those of its blocks (``need``) they have to read there.

    ``seeds``: only the page with the highest bound of an anchor; else every page but its seed's.
    """
    n_blocks, n_anchors = table.count(), anchors.count()
    zones, slices = max(1, n_blocks // (PAGE * ZONE_PAGES)), max(1, n_anchors // 4096)
    here = lambda k: F.pmod(F.xxhash64(F.col(k)), F.lit(zones))
    maps = table.select(here("page").alias("zone"), F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), "block", "page", "label_lo", "label_hi",
                        F.col("lo").alias("zone_lo"), F.col("hi").alias("zone_hi"))
    asked = anchors.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(zones - 1).cast("long"))).alias("zone"),
                           F.pmod(F.xxhash64("row"), F.lit(slices)).cast("int").alias("slice"), *anchors.columns)
    both = maps.unionByName(asked, allowMissingColumns=True)
    parts = min(zones * slices, int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 8)
    # Of each (zone, slice) the zone maps come first, then the anchors.
    both = both.repartition(parts, "zone", "slice").sortWithinPartitions("zone", "slice", F.col("row").asc_nulls_first(), "block")

    def bound(maps: list[pa.RecordBatch], batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(maps)
        page, block = held.column("page").to_numpy(), held.column("block").to_numpy()
        lo, hi = (np.concatenate([_array(v, width) for v in held.column(c).to_pylist()]) for c in ("zone_lo", "zone_hi"))
        label_lo, label_hi = held.column("label_lo").to_numpy(), held.column("label_hi").to_numpy()
        for k in range(0, batch.num_rows, PACK):
            part = batch.slice(k, PACK)
            row, label, vec, low, high = _windows(part, width)
            least, greatest = bounds(vec, lo, hi)
            fits = (label_lo <= label[:, None]) & (label[:, None] <= label_hi) if same else (label_lo != label[:, None]) | (label_hi != label[:, None])
            meets = np.zeros_like(fits)
            for w in range(low.shape[1]):
                meets |= (greatest >= low[:, w, None]) & (least <= high[:, w, None])
            meets &= fits
            if seeds:
                best = np.where(meets, greatest.astype(np.float64), -np.inf).argmax(axis=1) if len(page) else np.zeros(0, int)
                meets &= page[None, :] == page[best][:, None]
                rank = np.where(meets, greatest.astype(np.float64), -np.inf).max(axis=1)
            else:
                seed = np.array([-1 if s is None else s for s in part.column("seed").to_pylist()])
                meets &= page[None, :] != seed[:, None]
                rank = np.zeros(len(row))
            at, of = np.nonzero(meets)
            if not len(at):
                continue
            order = np.lexsort((block[of], page[of], at))
            at, of = at[order], of[order]
            cut = np.append(np.flatnonzero((np.diff(at) != 0) | (np.diff(page[of]) != 0)) + 1, len(at))
            first = np.concatenate(([0], cut[:-1]))
            out = part.select([c.split()[0] for c in _ANCHOR.split(", ")]).take(pa.array(at[first]))
            need = pa.ListArray.from_arrays(pa.array(np.append(first, len(at)), pa.int32()), pa.array(block[of]))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(page[of[first]]), need, pa.array(rank[at[first]])],
                                             names=[*out.schema.names, "page", "need", "rank"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _stream(batches, ["zone", "slice"], bound)

    chosen = both.mapInArrow(run, _ANCHOR + ", page long, need array<long>, rank double")
    if seeds:  # of several zones' best pages the best
        chosen = chosen.groupBy("row").agg(F.max_by(F.struct(*chosen.columns), F.struct("rank", "page")).alias("c")).select("c.*")
    return chosen.drop("rank")


def _stream(batches: Iterator[pa.RecordBatch], keys: list[str], work) -> Iterator[pa.RecordBatch]:
    """``work(held rows, anchors)`` where of every key the held rows (no ``row``) come first, then the anchors."""
    last, held = None, []
    for batch in batches:
        names = list(zip(*(batch.column(k).to_pylist() for k in keys), batch.column("row").is_null().to_pylist()))
        cuts = [0, *(k for k in range(1, len(names)) if names[k] != names[k - 1]), len(names)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            *key, is_held = names[a]
            if key != last:
                last, held = key, []
            if is_held:
                held.append(batch.slice(a, b - a))
            elif held:
                yield from work(held, batch.slice(a, b - a))


def best_rows(scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, row) of the k best allowed rows per anchor, by score and then least id, in that order."""
    many = allowed.sum(axis=1) > k
    if many.any():  # rows below an anchor's k-th best score can't count
        some = np.where(allowed[many], scores[many], -np.inf if scores.dtype.kind == "f" else LEAST)
        least = np.partition(some, some.shape[1] - k, axis=1)[:, some.shape[1] - k]
        allowed = allowed.copy()
        allowed[many] &= scores[many] >= least[:, None]
    at, of = np.nonzero(allowed)
    order = np.lexsort((ids[of], -scores[at, of], at))
    at, of = at[order], of[order]
    first = np.searchsorted(at, at)
    keep = np.arange(len(at)) - first < k
    return at[keep], of[keep]


def score(table: DataFrame, chosen: DataFrame, width: int, same: bool, k: int) -> DataFrame:
    """row, w (window), id, score: the best k rows of the chosen blocks, per anchor, window and page."""
    needed = chosen.select(F.explode("need").alias("block")).distinct()
    held = table.join(needed, "block", "left_semi").select("page", "block", "n", "ids", "labels", "vecs")
    both = held.unionByName(chosen, allowMissingColumns=True)
    pages = max(1, table.count() // PAGE)
    parts = max(int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")), pages // 8)
    both = both.repartition(parts, "page").sortWithinPartitions("page", F.col("row").asc_nulls_first(), "block")

    def scores_of(held: list[pa.RecordBatch], batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held)
        block, n = rows.column("block").to_numpy(), rows.column("n").to_numpy()
        ids, labels = (np.concatenate([np.frombuffer(v, "<i8") for v in rows.column(c).to_pylist()]) for c in ("ids", "labels"))
        vecs = np.concatenate([_array(v, width) for v in rows.column("vecs").to_pylist()])
        begin = np.repeat(np.cumsum(n) - n, n)
        places = np.repeat(block, n) * BLOCK + np.arange(len(ids)) - begin
        for a in range(0, batch.num_rows, PACK):
            part = batch.slice(a, PACK)
            row, label, vec, low, high = _windows(part, width)
            needed = np.repeat(np.isin(block, part.column("need").flatten().to_numpy()), n)
            x, its_id, its_label, place = vecs[needed], ids[needed], labels[needed], places[needed]
            s = product(vec, x)
            allowed = (its_label == label[:, None]) == same
            allowed &= place != row[:, None]
            for w in range(low.shape[1]):
                at, of = best_rows(s, its_id, allowed & (s >= low[:, w, None]) & (s <= high[:, w, None]), k)
                yield pa.RecordBatch.from_arrays([pa.array(row[at]), pa.array(np.full(len(at), w, np.int32)), pa.array(its_id[of]),
                                                  pa.array(s[at, of].astype(np.int64))], names=["row", "w", "id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _stream(batches, ["page"], scores_of)

    return both.mapInArrow(run, "row long, w int, id long, score long")


def search(table: DataFrame, anchors: DataFrame, width: int, same: bool, k: int) -> DataFrame:
    """row, w, rank, id, score: the first k rows in each window of each anchor, among those of its own label or of the others; stored."""
    seeds = stored(choose(table, anchors, width, same, True), "seeds")
    first = stored(score(table, seeds, width, same, k), "seed-scores")
    full = first.groupBy("row", "w").agg(F.count("*").alias("n"), F.min("score").alias("least")).filter(F.col("n") == k)
    raised = full.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("w", "least"))).alias("raised"))
    known = anchors.drop("seed").join(seeds.select("row", F.col("page").alias("seed")), "row", "left").join(raised, "row", "left")
    lo = F.transform("lo", lambda x, w: F.greatest(x, F.element_at("raised", w)))
    known = stored(known.withColumn("lo", F.when(F.col("raised").isNull(), F.col("lo")).otherwise(lo)).select(*anchors.columns), "raised")
    chosen = stored(choose(table, known, width, same, False), "chosen")
    found = first.unionByName(score(table, chosen, width, same, k))
    rank = F.expr("row_number() over (partition by row, w order by score desc, id)")
    return stored(found.withColumn("rank", rank).filter(F.col("rank") <= k), "found")


def _floor_div(a: Column, b: int) -> Column:
    return F.call_function("div", a - F.pmod(a, F.lit(b)), F.lit(b))


def mine(vectors: DataFrame, every: int = EVERY, scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; vectors: vec_id, label, embedding."""
    table, width = blocks(vectors, scale)
    anchors = anchors_of(table, width, every)
    near = search(table, anchors, width, True, positives)
    windows = near.select("row", "rank", (-_floor_div(-F.col("score") * low, 100)).alias("lo"), _floor_div(F.col("score") * high, 100).alias("hi"))
    windows = windows.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("rank", "lo", "hi"))).alias("windows"))  # at most ``positives``
    ask = stored(anchors.drop("lo", "hi").join(windows, "row").select(
        "row", "vec_id", "label", "vec", F.col("windows.lo").alias("lo"), F.col("windows.hi").alias("hi"), "seed"), "windows")
    far = search(table, ask, width, False, negatives)
    pairs = near.select("row", (F.col("rank") - 1).alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (far.withColumnRenamed("id", "negative_id").withColumnRenamed("score", "negative_score").join(pairs, ["row", "w"])
            .join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def relabelled(vectors: DataFrame) -> DataFrame:
    """The contract's rows: where vec_id is divisible by 7 the label is the next of ten."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return vectors.select("vec_id", label.alias("label"), "embedding")


def digest(vectors: DataFrame) -> DataFrame:
    """Hard negatives of the contract's anchors."""
    return mine(relabelled(vectors))


def oracle() -> str:
    """DuckDB SQL for ``digest``, where vec_id is unique and all vectors are of one length."""
    finite = "embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"
    return f"""
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                  list_transform(embedding, lambda x: floor({SCALE} * x::double)) as q
           from embeddings where vec_id is not null and label is not null and {finite}),
s as (select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same, list_inner_product(a.q, b.q)::bigint as score
      from v a join v b on a.vec_id <> b.vec_id where a.vec_id % {EVERY} = 0),
p as (select * from s where same qualify row_number() over (partition by anchor_id order by score desc, id) <= {POSITIVES}),
n as (select p.anchor_id, p.id as positive_id, s.id as negative_id, p.score as positive_score, s.score as negative_score,
             row_number() over (partition by p.anchor_id, p.id order by s.score desc, s.id) as rank
      from p join s on s.anchor_id = p.anchor_id and not s.same
      where {LOW} * p.score <= 100 * s.score and 100 * s.score <= {HIGH} * p.score)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from n where rank <= {NEGATIVES}"""
