"""Nulls, empty and very long texts, repeated rows, empty tables and clashing column names, for every operator and stage."""

import pytest

from adlens.llm import (
    decontaminate,
    mixing,
    near_dup,
    pii,
    quality_classifier,
    quality_rules,
    repeats,
    secrets,
    sharding,
    token_counts,
)
from tests.llm.plain import SCHEMA, edge_rows, prose


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame(edge_rows(), SCHEMA)
    labels = spark.createDataFrame([(4, 0, 0), (5, 1, 0), (6, 1, 0), (6, 1, 1), (None, 1, 0), (9, None, None)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "too short"), (4, prose(40, 4)), (4, prose(40, 4)), (None, prose(30, 99))], "item_id long, text string")
    return docs, labels, bench


OPERATORS = {
    "op1": lambda d, lab, b: quality_classifier.digest(d, lab),
    "op2": lambda d, lab, b: decontaminate.decontaminate(d, b),
    "op3": lambda d, lab, b: token_counts.count_tokens(d),
    "op4": lambda d, lab, b: secrets.digest(d),
    "op5": lambda d, lab, b: near_dup.near_duplicates(d),
    "op6": lambda d, lab, b: pii.pseudonymise(d, "key"),
    "op7": lambda d, lab, b: quality_rules.apply_rules(d),
    "op8": lambda d, lab, b: sharding.shard_documents(d, 4, 64),
    "op9": lambda d, lab, b: mixing.mix_digest(d),
    "op10": lambda d, lab, b: repeats.strip_repeats(d),
}
STAGES = {
    "quality": lambda d, lab, b: quality_classifier.good_documents(d, lab),
    "near_duplicates": lambda d, lab, b: near_dup.unique_documents(d),
    "decontamination": lambda d, lab, b: decontaminate.clean(d, b),
    "source_mix": lambda d, lab, b: mixing.mixed_documents(d),
}


def _id(r):
    return (r["doc_id"] is None, r["doc_id"] or 0)


@pytest.mark.parametrize("name", OPERATORS)
def test_operator_gives_each_document_a_row(tables, name):
    docs, labels, bench = tables
    got = OPERATORS[name](docs, labels, bench).collect()
    assert sorted(map(_id, got)) == sorted((r[0] is None, r[0] or 0) for r in edge_rows())


@pytest.mark.parametrize("name", [*OPERATORS, *STAGES])
def test_empty_tables(tables, name):
    docs, labels, bench = tables
    f = {**OPERATORS, **STAGES}[name]
    assert f(docs.limit(0), labels.limit(0), bench.limit(0)).count() == 0


def test_stages_keep_columns_and_rows(tables):
    docs, labels, bench = tables
    rows = edge_rows()
    for name, f in STAGES.items():
        got = f(docs, labels, bench)
        assert got.columns == docs.columns, name
        out = got.collect()
        if name == "near_duplicates":
            # 1, 2, 3 and the null text have no words and stay; 5 stands for 5, 6, 6; 7 for 7, 8.
            assert sorted(map(_id, out)) == sorted([(False, i) for i in (1, 2, 3, 4, 5, 6, 7, 9, 10)] + [(True, 0)] * 2)
        if name == "decontamination":
            assert sorted(map(_id, out)) == sorted((r[0] is None, r[0] or 0) for r in rows if r[0] != 9)
        if name == "source_mix":
            texts = {r[0]: r[1] for r in rows if r[0] not in (None, 6)}
            assert all(r["text"] in texts[r["doc_id"]] or len(r["text"].split()) < len(texts[r["doc_id"]].split())
                       for r in out if r["doc_id"] in texts)
            assert all(r["spans"] == "x" and r["epoch"] == 7 for r in out)


def test_defined_values(tables):
    docs, labels, bench = tables
    o5 = {(r.doc_id, r.n_shingles): r for r in near_dup.near_duplicates(docs).collect()}
    assert o5[1, 0].component_id == 1 and o5[2, 0].kept and o5[4, 1].kept
    assert o5[6, 116].component_id == 5 and not o5[6, 116].kept
    o7 = {r.doc_id: r for r in quality_rules.apply_rules(docs).collect()}
    assert o7[1].n_words == o7[2].n_words == o7[3].n_lines == 0 and o7[1].base_failed and not o7[1].kept
    o8 = {r.doc_id: r for r in sharding.shard_documents(docs, 4, 64).collect()}
    assert o8[1]["size"] == o8[2]["size"] == 16 and o8[1].text_crc32 == 0
    o9 = {r.doc_id: r for r in mixing.mix_digest(docs).collect()}
    assert o9[1].taken == o9[2].taken == 0 and o9[1]["size"] == 0
    o10 = {r.doc_id: r for r in repeats.strip_repeats(docs).collect()}
    assert o10[1].n_bytes == 0 and o10[1].kept_sha256 == o10[2].kept_sha256 and o10[5].n_removed == o10[5].n_bytes
    o6 = {r.doc_id: r for r in pii.pseudonymise(docs, "key").collect()}
    assert o6[1].text is None and o6[2].text == ""
    assert all(r.kept for r in quality_classifier.digest(docs, labels.limit(0)).collect())
