"""Sharding by fixed virtual slots.

Every record hashes to one of ``n_slots`` virtual slots; a slot never changes.
Bytes are summed per slot, and a small versioned table maps slots to shards.
Moving load edits that table (a new version), never the records' slots, so a
rebalance or a new shard moves only the slots whose entry changed.

Law ``bytes``: the map is built largest slot first onto the lightest shard, so
with thousands of slots the shards' sizes come out nearly equal.

Only slot totals (``n_slots`` rows, a fixed parameter) reach the driver and only
the map (``n_slots`` rows) is broadcast; records are shuffled once, by slot, and
without their texts.

Defined results: null text counts as empty (16 bytes, checksum 0); a null
doc_id hashes like any other value; equal rows share a slot and take
neighbouring places; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adlens.session import scratch_path

N_SLOTS = 16_384
RECORD_OVERHEAD = 16


def records(docs: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", (F.octet_length(text) + RECORD_OVERHEAD).cast("long").alias("size"),
                    F.crc32(text.cast("binary")).alias("text_crc32"))
    return d.withColumn("virtual_slot", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(n_slots)).cast("int"))


def slot_totals(recs: DataFrame) -> dict[int, tuple[int, int]]:
    """slot -> (bytes, rows): at most one entry per slot, whatever the data's size."""
    rows = recs.groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
    return {r.virtual_slot: (r.b, r.n) for r in rows}


def build_map(size_of: dict[int, int], n_shards: int, n_slots: int) -> list[int]:
    """slot -> shard: slots in falling size, each onto the shard with the fewest bytes so far."""
    loads = [(0, k) for k in range(n_shards)]
    out = [0] * n_slots
    for slot in sorted(range(n_slots), key=lambda s: (-size_of.get(s, 0), s)):
        load, shard = heapq.heappop(loads)
        out[slot] = shard
        heapq.heappush(loads, (load + size_of.get(slot, 0), shard))
    return out


def edit_map(current: list[int], size_of: dict[int, int], n_shards: int, tolerance: float = 0.01) -> list[int]:
    """The next version of a map: as few slots as needed leave the shards that are too full.

    Also used when shards are added (``n_shards`` above the map's) or taken away.
    """
    out = list(current)
    load = [0] * n_shards
    homeless = []
    for slot, shard in enumerate(out):
        if shard < n_shards:
            load[shard] += size_of.get(slot, 0)
        else:
            homeless.append(slot)
    mean = sum(size_of.values()) / n_shards
    members: dict[int, list[int]] = {k: [] for k in range(n_shards)}
    for slot, shard in enumerate(out):
        if shard < n_shards:
            members[shard].append(slot)
    for shard in range(n_shards):
        for slot in sorted(members[shard], key=lambda s: (-size_of.get(s, 0), s)):
            size = size_of.get(slot, 0)
            if size and load[shard] - size >= mean * (1 - tolerance) and load[shard] > mean * (1 + tolerance):
                load[shard] -= size
                homeless.append(slot)
    lightest = [(b, k) for k, b in enumerate(load)]
    heapq.heapify(lightest)
    for slot in sorted(homeless, key=lambda s: (-size_of.get(s, 0), s)):
        b, shard = heapq.heappop(lightest)
        out[slot] = shard
        heapq.heappush(lightest, (b + size_of.get(slot, 0), shard))
    return out


def write_map(spark: SparkSession, path: str, version: int, slot_map: list[int]) -> None:
    """Add one version to the stored table; earlier versions stay readable."""
    rows = [(version, slot, shard) for slot, shard in enumerate(slot_map)]
    spark.createDataFrame(rows, "version int, virtual_slot int, shard int").coalesce(1).write.mode("append").parquet(path)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of the stored table, the newest by default."""
    maps = spark.read.schema("version int, virtual_slot int, shard int").parquet(path)
    if version is None:
        version = maps.agg(F.max("version")).first()[0]
    return maps.filter(F.col("version") == version)


def place(recs: DataFrame, slot_map: DataFrame, totals: dict[int, tuple[int, int]]) -> DataFrame:
    """Records with their shard and a place in it, 0 up to its row count.

    A record's place is its slot's first place in the shard plus its rank within
    the slot, so ranking runs over thousands of small groups, never a whole shard.
    """
    spark = recs.sparkSession
    counts = spark.createDataFrame([(s, n) for s, (_, n) in totals.items()] or [(0, 0)], "virtual_slot int, n long")
    first = F.coalesce(F.sum("n").over(W.partitionBy("shard").orderBy("virtual_slot").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    layout = slot_map.join(counts, "virtual_slot").withColumn("first_place", first).select("virtual_slot", "version", "shard", "first_place")
    rank = F.row_number().over(W.partitionBy("virtual_slot").orderBy(F.col("doc_id").asc_nulls_first(), "size", "text_crc32"))
    return (recs.withColumn("rank", rank.cast("long") - 1)
            .join(F.broadcast(layout), "virtual_slot")  # at most n_slots rows
            .withColumn("slot", F.col("first_place") + F.col("rank"))
            .drop("first_place", "rank"))


def shard_documents(docs: DataFrame, n_shards: int = 40, n_slots: int = N_SLOTS, map_path: str | None = None) -> DataFrame:
    """All documents with their shard under law ``bytes``; the map's version is stored at ``map_path``."""
    spark = docs.sparkSession
    recs = records(docs, n_slots)
    totals = slot_totals(recs)
    path = map_path or scratch_path(spark, "slot-map")
    write_map(spark, path, 1, build_map({s: b for s, (b, _) in totals.items()}, n_shards, n_slots))
    placed = place(recs, read_map(spark, path, 1), totals)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.col("version").alias("map_version"))
