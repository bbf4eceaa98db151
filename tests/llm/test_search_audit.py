"""Hard negatives, SimHash components and the source divergence audit against plain versions."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash

from adlens.llm import divergence, hard_negatives, queries, simhash
from tests.llm import plain

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ hard negatives

def plain_negatives(rows, every=50, positives=5, negatives=3):
    """rows: (vec_id, label, numbers); equal rows count as often as they occur."""
    kept = [(i, lab, [int(np.floor(256 * float(v))) for v in x]) for i, lab, x in rows
            if i is not None and lab is not None and x is not None and all(v is not None and np.isfinite(v) for v in x)]
    dot = lambda a, b: sum(p * q for p, q in zip(a, b))  # noqa: E731 - the shorter one ends the sum, as zeros would
    out = []
    for n, (i, lab, x) in enumerate(kept):
        if i % every:
            continue
        scored = [(-dot(x, y), j, other) for m, (j, other, y) in enumerate(kept) if m != n]
        for p, j, other in sorted(s for s in scored if s[2] == lab)[:positives]:
            fit = sorted(s for s in scored if s[2] != lab and 50 * -p <= 100 * -s[0] <= 95 * -p)
            out += [(i, j, rank, s[1], -p, -s[0]) for rank, s in enumerate(fit[:negatives], 1)]
    return sorted(out)


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
VECTORS = "vec_id long, embedding array<double>, label int, row long, block long, lo long, hi long, page long, id long, score long, w int, place string"


def frame(spark, rows):
    return spark.createDataFrame([(i, x, lab, 1, 2, 3, 4, 5, 6, 7, 8, "p") for i, lab, x in rows], VECTORS)


def mined(df, **kw):
    return sorted(map(tuple, hard_negatives.mine(df, **kw).select(COLUMNS).collect()))


def test_negatives_equal_a_scan_and_duckdb(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.label, r.embedding) for r in hard_negatives.relabelled(vectors).collect()]
    got = sorted(map(tuple, queries.op11_hilbert_negatives(spark, SF).select(COLUMNS).collect()))
    assert got == plain_negatives(rows)
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    assert got == sorted(con.sql(queries.LLM_ORACLE["op11_hilbert_negatives"]).select(*COLUMNS).fetchall())


def test_negatives_ties_copies_nulls_and_odd_vectors(spark):
    rng = random.Random(1)
    one = [0.5, -0.25, 0.125]
    rows = [(k, k % 3, one) for k in range(0, 40)] + [(0, 0, one)] * 2  # ties, and one row three times
    rows += [(k, k % 2, [rng.uniform(-1, 1) for _ in range(3)]) for k in range(40, 90)]
    rows += [(100, 0, None), (101, None, one), (None, 0, one), (110, 1, [1.0, None, 2.0]), (111, 1, [float("nan"), 0.0, 0.0]),
             (112, 0, [float("inf"), 0.0, 0.0]), (120, 1, []), (121, 0, [2.0]), (130, 1, [0.5, 0.5, 0.5, 0.5]), (140, 7, one)]
    assert mined(frame(spark, rows), every=10) == plain_negatives(rows, every=10)


def test_negatives_of_long_vectors_are_exact(spark):
    rng = random.Random(2)
    rows = [(k, k % 2, [float(rng.randint(-1, 1) * 10 ** rng.randint(0, 6)) for _ in range(4)]) for k in range(60)]
    assert mined(frame(spark, rows), every=5) == plain_negatives(rows, every=5)
    with pytest.raises(Exception, match="too long"):
        mined(frame(spark, [(0, 1, [1e300, 0.0, 0.0]), (1, 1, [1.0, 1.0, 1.0])]))


def test_negatives_of_an_empty_table_and_of_one_label(spark):
    assert mined(frame(spark, [(0, 1, [1.0])]).limit(0)) == []
    assert mined(frame(spark, [(k, 1, [1.0, float(k)]) for k in range(60)])) == []


def test_zone_maps_leave_blocks_unread(spark, monkeypatch):
    """Clusters far apart: an anchor reads few blocks, and the rows still equal a scan."""
    monkeypatch.setattr(hard_negatives, "BLOCK", 8)
    monkeypatch.setattr(hard_negatives, "PAGE", 2)
    rng = np.random.default_rng(3)
    centres = np.eye(6) * 3
    rows = [(k, int(k // 7 % 4), (centres[k % 6] + rng.normal(0, 0.05, 6)).tolist()) for k in range(600)]
    df = frame(spark, rows)
    assert mined(df) == plain_negatives(rows)
    table, width = hard_negatives.blocks(df)
    anchors = hard_negatives.anchors_of(table, width)
    near = hard_negatives.search(table, anchors, width, True, 5)
    assert near.count() == 5 * anchors.count()
    wide = anchors.drop("lo", "hi").selectExpr("row", "vec_id", "label", "vec", "array(300000L) lo", "array(9000000L) hi", "seed")
    read = hard_negatives.choose(table, wide, width, False, False).selectExpr("sum(size(need)) as n").first().n
    assert 0 < read < 0.4 * table.count() * anchors.count()


def test_hilbert_places_are_a_curve():
    """In a grid of 16 x 16, sorting by place gives every cell once, and neighbours follow each other."""
    cells = np.array([(a, b) for a in range(16) for b in range(16)])
    path = cells[np.argsort([p.tobytes() for p in hard_negatives.hilbert(cells, 4)])]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


# ------------------------------------------------------------------ SimHash

def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64(" ".join(words[k:k + 3]).encode(), seed=42).intdigest() for k in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(prints):
    """The least fingerprint that each reaches by steps of two bits at most."""
    prints, root = sorted(set(prints)), {}
    for p in prints:
        root[p] = p

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(prints):
        for b in prints[:k]:
            if bin(a ^ b).count("1") <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in prints}


def test_fingerprints_and_components_equal_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {r.doc_id: plain_fingerprint(r.text) for r in docs.collect()}
    roots, least = plain_roots(want.values()), {}
    for i, p in sorted(want.items()):
        least.setdefault(roots[p], i)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op12_pivot_simhash(spark, SF).collect()}
    assert got == {i: (f"{p:016x}", least[roots[p]]) for i, p in want.items()}


@pytest.mark.parametrize("crowd", [2, 8, 64])
def test_links_connect_what_all_pairs_connect(spark, crowd):
    """Balls of near fingerprints, chains of two-bit steps, and strangers; crowded keys or none."""
    rng = random.Random(4)
    prints = [rng.getrandbits(64) for _ in range(200)] + [0, 1, 3, 7, (1 << 64) - 1, (1 << 64) - 4]
    for _ in range(3):
        centre = rng.getrandbits(64)
        prints += [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(120)]
        for _ in range(30):
            centre ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            prints.append(centre)
    want = plain_roots(prints)
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    fps = spark.createDataFrame([(signed(p),) for p in want], "fp long")
    links = [(r.a, r.b) for r in simhash.links(simhash.pivot_table(fps), crowd).collect()]
    assert all(bin((a ^ b) & ((1 << 64) - 1)).count("1") <= 2 for a, b in links) or crowd < 64
    root = {signed(p): signed(p) for p in want}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    groups = lambda f: sorted(map(sorted, f.values()))
    ours, theirs = defaultdict(list), defaultdict(list)
    for p, r in want.items():
        ours[find(signed(p))].append(p)
        theirs[r].append(p)
    assert groups(ours) == groups(theirs)


def test_simhash_edges(spark):
    docs = spark.createDataFrame(plain.edge_rows(), plain.SCHEMA)
    got = simhash.near_duplicates(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((r[0] is None, r[0] or 0) for r in plain.edge_rows())
    of = {}
    for r in got:
        of.setdefault(r.doc_id, set()).add((r.fingerprint, r.component_id))
    assert of[1] == of[2] == of[3] == {("0" * 16, 1)} and of[4] == {(f"{plain_fingerprint('word'):016x}", 4)}
    assert ("0" * 16, 1) in of[None]
    texts = {(r[0], f"{plain_fingerprint(r[1]):016x}") for r in plain.edge_rows()}
    assert texts == {(i, f) for i, s in of.items() for f, _ in s}
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    lone = spark.createDataFrame([(None, "a b c d"), (None, "a b c d")], "doc_id long, text string")
    assert [r.component_id for r in simhash.near_duplicates(lone).collect()] == [None, None]


# ------------------------------------------------------------------ divergence

def plain_divergence(docs, min_documents=3, top=200):
    """docs: (text, lang, source)."""
    found = [(lang or "", source or "", Counter(re.findall(divergence.TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))))
             for text, lang, source in docs]
    out = []
    for lang in {d[0] for d in found}:
        mine = [d for d in found if d[0] == lang]
        df = Counter(t for d in mine for t in d[2])
        kept = [t for t in df if df[t] >= min_documents]
        count = defaultdict(Counter)
        for _, source, terms in mine:
            count[source].update({t: n for t, n in terms.items() if df[t] >= min_documents})
        whole = sum(count.values(), Counter())

        def p(c, t):
            return 1 + 1_000_000_000 * (c[t] + 1) // (sum(c.values()) + len(kept))

        f = lambda p, q: (p - q) ** 2 // q
        for s, c in count.items():
            pairs = sorted((-sum(f(p(c, t), p(o, t)) for t in kept), other.encode(), other) for other, o in count.items() if other != s)
            out += [(lang, s, "pair", other, -v, k) for k, (v, _, other) in enumerate(pairs, 1)]
            terms = sorted((-f(p(c, t), p(whole, t)), t.encode(), t) for t in kept if c[t] and p(c, t) > p(whole, t))[:top]
            out += [(lang, s, "term", t, -v, k) for k, (v, _, t) in enumerate(terms, 1)]
    return sorted(out)


AUDIT = ["lang", "source", "part", "item", "value", "rank"]


def audited(df, **kw):
    return sorted(map(tuple, divergence.divergence(df, **kw).select(AUDIT).collect()))


def test_divergence_equals_duckdb(spark):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    got = queries.op13_run_length_divergence(spark, SF)
    assert dict(got.dtypes)["value"] == "bigint" and dict(got.dtypes)["rank"] == "int"
    assert sorted(map(tuple, got.select(AUDIT).collect())) == sorted(con.sql(queries.LLM_ORACLE["op13_run_length_divergence"]).select(*AUDIT).fetchall())


def test_divergence_edges(spark, monkeypatch):
    rng = random.Random(5)
    rows = [plain.row(k, plain.prose(rng.randint(0, 30), k), rng.choice(["a", "b", "c", None]), rng.choice(["en", "de", None])) for k in range(60)]
    rows += plain.edge_rows() + [plain.row(70, "Ärger ÄRGER straße 日本 日本 x1y", "ä", "xx"), plain.row(71, "12 34", "b", "xx"), plain.row(72, "alone", "a", "yy")]
    rows += [plain.row(80 + k, "Ärger ÄRGER naïve 😀", "ab"[k % 2], "zz") for k in range(4)]
    docs = spark.createDataFrame(rows, plain.SCHEMA)
    want = plain_divergence([(r[1], r[2], r[3]) for r in rows])
    assert audited(docs) == want
    monkeypatch.setattr(divergence, "ENTRIES", 5)
    columns = divergence.run_length_columns
    monkeypatch.setattr(divergence, "run_length_columns", lambda terms: columns(terms, 3))  # many stripes
    assert audited(docs) == want
    assert audited(docs, min_documents=10**6) == plain_divergence([(r[1], r[2], r[3]) for r in rows], 10**6)
    assert audited(docs.limit(0)) == []


def test_run_length_sums_are_exact_for_huge_counts():
    counts = np.array([0, 3, 10**12], np.int64)
    assert divergence.shares(counts, 5 * 10**12, 7).tolist() == [1 + 10**9 * (int(c) + 1) // (5 * 10**12 + 7) for c in counts]
    p, q = np.array([5, 10**9], np.int64), np.array([1, 7, 2], np.int64)
    there, back = divergence.intersect(np.array([2, 4]), p, np.array([1, 3, 4]), q)
    each = [(5, 1), (5, 7), (10**9, 7), (10**9, 2)]
    assert (there, back) == (sum((a - b) ** 2 // b for a, b in each), sum((a - b) ** 2 // a for a, b in each))
