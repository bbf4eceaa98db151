"""The corpus queries: opN_<name> -> (spark, sf_dir) -> DataFrame, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from adlens.llm import (
    decontaminate,
    divergence,
    hard_negatives,
    mixing,
    near_dup,
    pii,
    quality_classifier,
    quality_rules,
    repeats,
    secrets,
    sharding,
    simhash,
    token_counts,
)
from adlens.llm.common import table


def op1_bayes_quality(spark, sf_dir):
    return quality_classifier.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_template_decontamination(spark, sf_dir):
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_viterbi_tokens(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op4_entropy_secrets(spark, sf_dir):
    return secrets.digest(table(spark, sf_dir, "documents"))


def op5_minhash_components(spark, sf_dir):
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


# Production passes a secret key; this one only makes the query's result repeatable.
PSEUDONYM_KEY = "registered-query"


def op6_feistel_pseudonyms(spark, sf_dir):
    return pii.pseudonymise(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


def op7_quality_rules(spark, sf_dir):
    return quality_rules.apply_rules(table(spark, sf_dir, "documents"))


def op8_virtual_slots(spark, sf_dir):
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op9_block_mix(spark, sf_dir):
    return mixing.mix_digest(table(spark, sf_dir, "documents"))


def op10_bwt_repeats(spark, sf_dir):
    return repeats.strip_repeats(table(spark, sf_dir, "documents"), passage=repeats.PASSAGE_WORDS)


def op11_hilbert_negatives(spark, sf_dir):
    return hard_negatives.digest(table(spark, sf_dir, "embeddings"))


def op12_pivot_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op13_run_length_divergence(spark, sf_dir):
    return divergence.divergence(table(spark, sf_dir, "documents"))


LLM_QUERIES = {f.__name__: f for f in (
    op1_bayes_quality, op2_template_decontamination, op3_viterbi_tokens, op4_entropy_secrets, op5_minhash_components,
    op6_feistel_pseudonyms, op7_quality_rules, op8_virtual_slots, op9_block_mix, op10_bwt_repeats,
    op11_hilbert_negatives, op12_pivot_simhash, op13_run_length_divergence)}

LLM_ORACLE = {"op7_quality_rules": quality_rules.oracle(), "op11_hilbert_negatives": hard_negatives.oracle(),
              "op13_run_length_divergence": divergence.oracle()}
