"""Buckets that hold several components: no link between two of them is lost, and a crowd is not paired."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlens.llm import near_dup


def linked(x, y, threshold):
    both = len(x & y)
    return 100 * both >= threshold * (len(x) + len(y) - both)


def roots_of(n, edges):
    root = list(range(n))
    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(k) for k in range(n)]


@pytest.mark.parametrize("threshold", [80, 85, 95])
@pytest.mark.parametrize("hub", [0, 7])
def test_shared_differences_lose_no_link(spark, threshold, hub):
    rnd = random.Random(threshold + hub)
    base = set(range(60))
    sets = [set(base)]
    for _ in range(70):  # differences from a small pool, so many are shared; some start from each other
        s = set(rnd.choice(sets))
        s -= set(rnd.sample(sorted(s), rnd.randint(0, 5)))
        s |= {rnd.randint(100, 140) for _ in range(rnd.randint(0, 5))}
        sets.append(s)
    sets.append({500, 501})
    table = spark.createDataFrame([(k, bytearray(np.array(sorted(s), np.int64).tobytes())) for k, s in enumerate(sets)], "node long, shingles binary")
    groups = spark.createDataFrame([(hub, k) for k in range(len(sets))], "hub long, node long")
    d = (near_dup.differences(groups, table).withColumn("cost", 100 * F.col("missing") + threshold * F.col("added"))
         .withColumn("budget", (100 - threshold) * F.col("h")))
    spokes = {r.node for r in d.filter("cost <= budget").collect()}
    assert spokes == {k for k, s in enumerate(sets) if linked(sets[hub], s, threshold)}
    links = [(a, b) for a in range(len(sets)) for b in range(a) if linked(sets[a], sets[b], threshold)]
    root = roots_of(len(sets), [(hub, k) for k in spokes])
    d = d.join(spark.createDataFrame(list(enumerate(root)), "node long, root long"), "node")
    found = {(r.a, r.b) for r in near_dup.shared_differences(d, threshold).collect()}
    across = {(a, b) for a, b in links if root[a] != root[b]}
    assert across <= found and all(root[a] != root[b] for a, b in found)
    assert across or threshold == 95


def test_crowd_of_edited_copies_is_linked_through_its_hub(spark, monkeypatch):
    """Copies that each went their own way: components as of all pairs, and far fewer pairs than the crowd has."""
    rnd = random.Random(3)
    base = [f"w{rnd.randint(0, 10**6)}" for _ in range(120)]
    texts = []
    for k in range(240):
        words = list(base)
        for _ in range(rnd.randint(1, 5)):
            words[rnd.randrange(len(words))] = f"x{rnd.randint(0, 10**6)}"
        texts.append(" ".join(words))
    texts.insert(120, " ".join(base))
    seen = {}
    keep = near_dup.stored
    monkeypatch.setattr(near_dup, "stored", lambda df, name: seen.setdefault(name, keep(df, name)) if name == "more-pairs" else keep(df, name))
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(docs).collect()}
    sets = [set(s.tolist()) for s in near_dup.shingle_sets(texts)]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if linked(sets[a], sets[b], 85)]
    want = roots_of(len(sets), links)
    assert got == dict(enumerate(want)) and len(set(want)) > 10
    assert "more-pairs" in seen and seen["more-pairs"].count() < len(texts)
