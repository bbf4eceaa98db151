"""Entropy spans against a plain version, keys of every class, and texts with very many matches."""

import math
import random
import re
import time
from collections import Counter

import pytest

from adlens.llm import secrets
from tests.llm import plain

SF = "/root/testdata/sf0.001"


def plain_hot(run):
    """(first, end) of the hot windows of one candidate, or None."""
    bits = next(b for _, pattern, b in secrets.CLASSES if re.match(pattern, run))
    if any(re.search(p, run) for p in secrets.ALLOW):
        return None
    dark = set()
    left = run  # words are covered first, one after the other, then identifiers in what is left
    for word in [f"(?i:{w})" for w in secrets.ALLOW_WORDS] + [secrets.ALLOW_UUID]:
        for m in re.finditer(word, left):
            dark.update(range(*m.span()))
        left = "".join("~" if k in dark else c for k, c in enumerate(left))
    if re.match(r"^([0-9+/_=-]+|[A-Za-z+/_=-]+)$", run):
        dark.update(k for k, c in enumerate(run) if c in "+/_=-")
    most = 1e6 * secrets.WINDOW * (math.log2(secrets.WINDOW) - bits)
    hot = [k for k in range(len(run) - secrets.WINDOW + 1)
           if not dark & set(range(k, k + secrets.WINDOW))
           and sum(round(1e6 * c * math.log2(c)) for c in Counter(run[k:k + secrets.WINDOW]).values()) <= math.floor(most)]
    return (hot[0], hot[-1] + secrets.WINDOW) if hot else None


def plain_entropy(text):
    base = [tuple(map(int, x.split(":")[1:])) for x in plain.base_secrets(text).split(",") if x]
    out = []
    for m in re.finditer(secrets.CANDIDATE, text):
        hot = plain_hot(m.group())
        if hot:
            a, b = m.start() + hot[0], m.start() + hot[1]
            if not any(x <= a and y >= b for x, y in base):
                out.append(f"entropy:{a}:{b}")
    return out


def scanned(spark, texts):
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in secrets.digest(d).collect()}


def key(rng, alphabet, n):
    return "".join(rng.choice(alphabet) for _ in range(n))


LOWER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
LETTERS = LOWER + LOWER.upper()


def test_spans_equal_a_plain_version(spark):
    rng = random.Random(9)
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    alphabets = [LOWER, LETTERS, DIGITS, LETTERS + DIGITS, LETTERS + DIGITS + "+/", "abcdef" + DIGITS, "ab", LETTERS + "-_/="]
    for _ in range(150):
        parts = [rng.choice([key(rng, rng.choice(alphabets), rng.randint(1, 60)), "sample", "======", "password: " + key(rng, LETTERS + DIGITS, 20), "host/app",
                             "550e8400-e29b-41d4-a716-446655440000", "2024-01-02", "thisIsSomeLongIdentifierName"]) for _ in range(12)]
        texts.append("".join(p + rng.choice([" ", "/", "=", "-", "", " ", "é😀"]) for p in parts))
    got = scanned(spark, texts)
    for k, text in enumerate(texts):
        found = [x for x in got[k].spans.split(",") if x.startswith("entropy")]
        assert sorted(found) == sorted(plain_entropy(text or "")), text


@pytest.mark.parametrize("alphabet, n, least", [(LETTERS, 40, 0.97), (LOWER, 40, 0.9), (DIGITS, 32, 0.9), (LETTERS + DIGITS, 32, 0.97), (LETTERS + DIGITS + "+/", 40, 0.97)])
def test_random_keys_are_found_wherever_they_stand(spark, alphabet, n, least):
    rng = random.Random(n)
    keys = [key(rng, alphabet, n) for _ in range(150)]
    for before in ("", "======", "host/sample/app/") if alphabet is not DIGITS else ("", "======"):
        got = scanned(spark, [f"see {before}{k} there" for k in keys])
        # Digits are found by the hex pattern first, and not said twice.
        assert sum(r.n_entropy + r.n_hex > 0 for r in got.values()) >= least * len(keys), before


def test_what_is_public_or_plain_stays_unsaid(spark):
    texts = ["550e8400-e29b-41d4-a716-446655440000", "id=550e8400-e29b-41d4-a716-446655440000", "some-long-path/with-many-words/and-0012-numbers",
             "thisNameStandsForSomeLongIdentifier", "2024-01-02T03-04-05_2024-01-02", "12345678901234567890", "a" * 60, "=" * 60,
             "your_key_example_placeholder_sample_dummy", "Donaudampfschifffahrtsgesellschaftskapitaen", plain.prose(3000, 5)]
    assert [r.n_entropy for _, r in sorted(scanned(spark, texts).items())] == [0] * len(texts)
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    clean = [t for t in docs if not re.search(r"[A-Za-z0-9+/_=-]{20,}", t or "")]
    assert sum(r.n_entropy for r in scanned(spark, clean).values()) == 0


def test_texts_with_very_many_matches_take_little_time(spark):
    rng = random.Random(3)
    many = " ".join(f"token={key(rng, LETTERS + DIGITS, 12)}" for _ in range(16_000))
    mixed = " ".join(f"{key(rng, LETTERS + DIGITS, 24)} AKIA{key(rng, DIGITS, 16)}" for _ in range(4_000))
    scanned(spark, ["warm token=abcdefghijkl1 " + key(rng, LETTERS + DIGITS, 30)])
    at = time.perf_counter()
    got = scanned(spark, [many])
    assert time.perf_counter() - at < 20
    # The windows of 4000 candidates cost their length (about 4 ms each), whatever the number of matches: no limit here.
    got |= {k + 1: r for k, r in scanned(spark, [mixed]).items()}
    assert got[0].n_assign == 16_000 and got[1].n_access == 4_000 and got[1].n_entropy >= 3_900
    assert got[0].spans.split(",")[-1] == f"assign:{len(many) - 18}:{len(many)}"
