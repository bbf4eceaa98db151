"""The pipeline's rows against a plain run of its stages' definitions."""

import re

import corpus_pipeline as cp
from adlens.llm import mixing, quality_classifier
from adlens.llm.common import stored
from tests.llm import plain

SF = "/root/testdata/sf0.001"


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    source = {r.doc_id: r.source for r in docs.collect()}
    frames = []
    for name, stage in cp.STAGES:
        docs = stored(stage(spark, docs, SF), name)
        frames.append(docs)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r.doc_id for r in quality_classifier.digest(spark.read.parquet(f"{SF}/documents.parquet"), labels).filter("kept").collect()}
    assert {r.doc_id for r in frames[0].collect()} == good
    component, _ = plain.near_components({i: text[i] for i in good})
    unique = {i for i, c in component.items() if c == i}
    assert {r.doc_id for r in frames[1].collect()} == unique
    word = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    items = [word(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {i for i in unique if not any(x in word(text[i]) for x in items)}
    assert {r.doc_id for r in frames[2].collect()} == clean
    names = sorted({source[i] for i in clean})
    size = {s: sum(len(text[i].split()) for i in clean if source[i] == s) for s in names}
    taken = dict.fromkeys(names, 0)
    for r in frames[3].collect():
        assert r.doc_id in clean and r.source == source[r.doc_id] and r.n_chars == len(r.text)
        taken[r.source] += len(r.text.split())
    for s, t in zip(names, mixing.targets([size[s] for s in names])):
        assert abs(taken[s] - t) <= mixing.BLOCK_WORDS
    got = frames[4].collect()
    assert len(got) == frames[3].count() and {r.shard for r in got} == set(range(40))
    assert cp.run(spark, SF).count() == len(got)
