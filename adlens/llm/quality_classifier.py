"""Quality classifier: document evidence combined with host and path posteriors (hierarchical empirical Bayes).

1. Evidence.  Two models over hashed features of whole texts.  Quality: a
   logistic regression on words, word shapes and shares (of odd words, capitals,
   repeated lines), fitted on about ``SAMPLE`` labelled documents.  Toxicity: a
   naive Bayes over words and word beginnings, counted over all labelled
   documents by grouped aggregation, each log-odds shrunk by what chance explains
   and the sum calibrated.  Evidence = P(good quality) * P(not toxic).
2. Sites.  Over all documents, labelled or not, each host and each path of a host
   gathers its count and summed probability.  A host's share of good documents
   is pulled to the corpus share, a path's to its host's, each with as many
   pseudo-documents as the spread between siblings supports (method of moments),
   so sparse sites stay near the prior.
3. Verdict.  Posterior odds = document odds x path odds / corpus odds; a document
   stays at ``KEEP_AT`` or more.

On the driver: the sample's features (``SAMPLE`` bounds them), at most
2 ** ``FEATURE_BITS`` feature counts and a few numbers.  Sites stay a table:
partial sums run before the shuffle, so a hot host is no hot task, and it is
broadcast only up to ``BROADCAST_SITES`` counted rows, labels up to
``BROADCAST_LABELS``; beyond, the same joins shuffle.  Weights and summed
probabilities are whole millionths, so reruns agree to the digit.

Defined results: null and empty texts have the one feature "empty"; null hosts or
paths form a site of their own; a null doc_id is scored but teaches nothing; of
several labels of a doc_id the worse counts; with quality labels of one kind only
among those drawn, or none, all documents are what the labels say, or good; with no toxic label no
document is toxic; equal rows get equal scores.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import stored

FEATURE_BITS = 18
PREFIX = 5
SAMPLE = 8_000  # labelled documents that the quality model is fitted on, about
EPOCHS, RATE, RIDGE = 6, 0.1, 1e-4
FORMS = 4.0
SHRINK = 9.0
KEEP_AT = 0.5
BROADCAST_SITES = 200_000
BROADCAST_LABELS = 2_000_000
_CACHE_WORDS = 1 << 17
_PUNCTUATION = ".,;:!?\"'()[]{}"
_ORDINARY = frozenset("aA9.,;:!?'\"-()")


def _bucket(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) >> (32 - FEATURE_BITS)


def _shape(word: str) -> str:
    """Runs of letters, capitals, digits as a, A, 9; other characters stand for themselves, once."""
    out = []
    for c in word[:24]:
        kind = "A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out)


def _share(part: int, whole: int) -> int:
    return 0 if not part else 1 + min(9, 10 * part // max(whole, 1))


def features(text: str | None, cache: dict[str, tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct feature buckets of one whole text: words; forms (word shapes and shares); word beginnings."""
    words = (text or "").split()
    if not words:
        return np.zeros(0, np.int64), np.array([_bucket("empty")]), np.zeros(0, np.int64)
    different = set(words)
    out, forms, parts = set(), set(), set()
    odd = upper = 0
    for w in different:
        known = cache.get(w)
        if known is None:
            if len(cache) >= _CACHE_WORDS:
                cache.clear()
            shape = _shape(w)
            plain = w.strip(_PUNCTUATION).lower()
            known = (_bucket("w:" + plain), _bucket("s:" + shape), _bucket("p:" + plain[:PREFIX]),
                     not _ORDINARY.issuperset(shape), len(w) > 1 and w.isupper())
            cache[w] = known
        word, form, part, is_odd, is_upper = known
        out.add(word)
        forms.add(form)
        parts.add(part)
        odd += is_odd
        upper += is_upper
    lines = [x for x in text.split("\n") if x.strip()]
    n, m = len(words), len(different)
    forms.update(_bucket(f"{k}:{v}") for k, v in (
        ("length", n.bit_length()), ("odd", _share(odd, m)), ("upper", _share(upper, m)),
        ("lines", _share(len(lines) - len(set(lines)), len(lines))), ("repeats", _share(n - m, n))))
    return tuple(np.fromiter(x, np.int64, len(x)) for x in (out, forms, parts))


def truth(labels: DataFrame) -> DataFrame:
    """doc_id, quality and toxic; of several labels the worse one."""
    return (labels.filter("doc_id is not null and (quality is not null or toxic is not null)")
            .groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("quality"), F.max(F.col("toxic").cast("int")).alias("toxic")))


class Model(NamedTuple):
    """Weights per bucket (whole millionths), and the curves that turn their sums into probabilities."""

    quality: np.ndarray
    quality_at: float
    toxic: np.ndarray
    toxic_slope: float
    toxic_at: float

    def probability(self, text: str | None, cache: dict) -> float:
        """P(good quality) * P(not toxic) of one text."""
        all_of = features(text, cache)
        q = self.quality_at + sum(int(self.quality[f].sum()) / 1e6 * scale for f, scale in zip(all_of, _scales(*all_of)))
        return _logistic(q) * _logistic(-(self.toxic_slope * self.toxic_sum(*all_of) + self.toxic_at))

    def toxic_sum(self, *all_of: np.ndarray) -> float:
        return sum(int(self.toxic[f].sum()) for f in all_of) / 1e6


def _scales(words, forms, parts=None) -> tuple[float, float]:
    """Values of a word and of a form feature: words share one unit of length, forms, which say more, FORMS units."""
    return 1 / math.sqrt(max(1, len(words))), FORMS / math.sqrt(max(1, len(forms)))


def _logistic(x: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Both evidence models: the quality one from a bounded sample of labelled documents, the toxicity one from all of them."""
    known = stored(truth(labels), "truth")
    known = F.broadcast(known) if known.count() <= BROADCAST_LABELS else known

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict = {}
        for b in batches:
            found = [features(t, cache) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "quality": b["quality"], "toxic": b["toxic"]}
                               | {name: [x[k] for x in found] for k, name in enumerate(("words", "forms", "parts"))})

    marked = docs.select("doc_id", "text").join(known, "doc_id").select("doc_id", "text", "quality", "toxic")
    marked = stored(marked.mapInPandas(extract, "doc_id long, quality int, toxic int, words array<int>, forms array<int>, parts array<int>"), "features")
    return Model(*_fit_quality(marked), *_fit_toxic(marked))


def _fit_quality(marked: DataFrame) -> tuple[np.ndarray, float]:
    """Logistic regression (steps of falling size, documents in a fixed shuffled order) on about SAMPLE documents."""
    some = marked.filter("quality is not null")
    share = min(1.0, SAMPLE / max(1, some.count()))
    # Two hashes, so that a share far below one in a million still draws its documents.
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) + F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 40)) / (1 << 40)
    rows = some.filter(draw < share * 1_000_000).select("doc_id", "quality", "words", "forms").toPandas()
    rows = rows.sort_values("doc_id", kind="stable")
    size = 1 << FEATURE_BITS
    weights, square, at, at_square = np.zeros(size), np.full(size, 1e-2), 0.0, 1e-2
    y = (rows["quality"] > 0).to_numpy().astype(int)
    x = [tuple(np.sort(np.asarray(f, dtype=np.int64)) for f in both) for both in zip(rows["words"], rows["forms"])]
    if not len(y) or y.min() == y.max():
        return np.zeros(size, np.int64), 30.0 if not len(y) or y.min() else -30.0
    rng = np.random.default_rng(1)
    for _ in range(max(EPOCHS, min(5 * EPOCHS, EPOCHS * SAMPLE // len(y)))):
        for k in rng.permutation(len(y)):
            scales = _scales(*x[k])
            miss = _logistic(sum(float(weights[f].sum()) * scale for f, scale in zip(x[k], scales)) + at) - y[k]
            for f, scale in zip(x[k], scales):
                step = miss * scale + RIDGE * weights[f]
                square[f] += step * step
                weights[f] -= RATE * step / np.sqrt(square[f])
            at_square += miss * miss
            at -= RATE * miss / math.sqrt(at_square)
    return np.rint(weights * 1e6).astype(np.int64), round(at, 6)


def _fit_toxic(marked: DataFrame) -> tuple[np.ndarray, float, float]:
    """Naive Bayes log-odds; each is shrunk by 1 - SHRINK / z**2, so what chance explains is 0."""
    size = 1 << FEATURE_BITS
    some = marked.filter("toxic is not null")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, total = np.zeros((2, size), dtype=np.int64), np.zeros(2, dtype=np.int64)
        for b in batches:
            for words, forms, parts, toxic in zip(b["words"], b["forms"], b["parts"], b["toxic"]):
                seen[int(toxic > 0), np.unique(np.concatenate((words, forms, parts))).astype(np.int64)] += 1
                total[int(toxic > 0)] += 1
        used = np.flatnonzero(seen.sum(axis=0))
        yield pd.DataFrame({"bucket": np.append(used, -1), "no": np.append(seen[0, used], total[0]), "yes": np.append(seen[1, used], total[1])})

    counts = (some.select("words", "forms", "parts", "toxic").mapInPandas(count, "bucket long, no long, yes long").groupBy("bucket")
              .agg(F.sum("no").alias("no"), F.sum("yes").alias("yes")).toPandas())  # at most 2 ** FEATURE_BITS + 1 rows
    weights = np.zeros(size, dtype=np.int64)
    no, yes = (int(counts.loc[counts.bucket == -1, c].sum()) for c in ("no", "yes"))
    if not no or not yes:
        return weights, 1.0, -30.0 if not yes else 30.0
    c = counts[counts.bucket >= 0]
    a, b = c.yes.to_numpy() + 0.5, c.no.to_numpy() + 0.5
    odds = np.log(a / (yes + 1)) - np.log(b / (no + 1))
    odds *= np.maximum(0, 1 - SHRINK / np.maximum(odds ** 2 / (1 / a + 1 / b), 1e-9))
    weights[c.bucket.to_numpy()] = np.rint(odds * 1e6).astype(np.int64)
    model = Model(weights, 0.0, weights, 1.0, 0.0)

    @F.pandas_udf("long")
    def bin_of(words: pd.Series, forms: pd.Series, parts: pd.Series) -> pd.Series:
        return pd.Series([max(-200, min(200, round(2 * model.toxic_sum(*(f.astype(np.int64) for f in x))))) for x in zip(words, forms, parts)])

    # Calibration on the sums, in bins of half a unit: a bounded table whatever the corpus.
    bins = (some.select((F.col("toxic") > 0).cast("int").alias("yes"), bin_of("words", "forms", "parts").alias("x"))
            .groupBy("x").agg(F.count("*").alias("n"), F.sum("yes").alias("yes")).orderBy("x").toPandas())
    return weights, *calibrate(bins.x.to_numpy() / 2, bins.n.to_numpy(float), bins.yes.to_numpy(float))


def calibrate(x: np.ndarray, n: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve through binned counts; Newton steps with a light pull to slope 0.1."""
    a, b = 0.1, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = n * p * (1 - p) + 1e-9
        grad = np.array([np.sum((good - n * p) * x) - (a - 0.1), np.sum(good - n * p) - 1e-3 * b])
        hess = np.array([[np.sum(w * x * x) + 1, np.sum(w * x)], [np.sum(w * x), np.sum(w) + 1e-3]])
        step = np.linalg.solve(hess, grad)
        size = np.abs(step).max()
        step *= min(1, 1 / size) if size else 1
        a, b = a + step[0], b + step[1]
        if size < 1e-9:
            break
    return float(a), float(b)


def evidence(model: Model):
    """A Column function: text -> probability of a good document by its text alone, in whole millionths."""
    @F.pandas_udf("long")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache: dict = {}
        for batch in texts:
            yield pd.Series([round(1e6 * model.probability(t, cache)) for t in batch], dtype="int64")
    return score


def _strength(groups: DataFrame, own: str, n: str, prior: Column) -> float:
    """Pseudo-documents of a prior: how far the groups' shares stray from it beyond what their sizes explain."""
    m = prior
    var = m * (1 - m)
    r = groups.filter(F.col(n) > 1).agg(
        F.sum((F.col(own) / F.col(n) / 1e6 - m) ** 2 * F.col(n)).alias("spread"),
        F.sum(var).alias("chance"), F.sum(F.col(n) * var).alias("whole")).first()
    if not r.whole:
        return 1e6
    between = max(0.0, (r.spread or 0.0) - r.chance) / r.whole  # share of the variance that lies between groups
    return round(min(1e6, max(1.0, 1 / between - 1 if between else 1e6)), 6)


def sites(scored: DataFrame, host: str, path: str) -> tuple[DataFrame, float]:
    """One row per (host, path): its posterior share of good documents; and the corpus share."""
    per_path = scored.groupBy(host, path).agg(F.count("*").alias("n"), F.sum("p").alias("good"))
    per_host = per_path.groupBy(host).agg(F.sum("n").alias("hn"), F.sum("good").alias("hgood"))
    r = per_host.agg(F.sum("hn").alias("n"), F.sum("hgood").alias("good")).first()
    share = min(0.999, max(0.001, r.good / r.n / 1e6)) if r.n else 0.5
    k = _strength(per_host, "hgood", "hn", F.lit(share))
    hosts = per_host.select(F.col(host).alias("_h"), ((F.col("hgood") / 1e6 + k * share) / (F.col("hn") + k)).alias("host_posterior"))
    both = per_path.join(hosts, F.col(host).eqNullSafe(F.col("_h"))).drop("_h")
    k = _strength(both, "good", "n", F.col("host_posterior"))
    post = (F.col("good") / 1e6 + k * F.col("host_posterior")) / (F.col("n") + k)
    return both.select(F.col(host).alias("_host"), F.col(path).alias("_path"), F.round("host_posterior", 9).alias("host_posterior"),
                       F.round(post, 9).alias("path_posterior")), share


def classify(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang",
             model: Model | None = None, keep: list[str] | None = None) -> DataFrame:
    """Each document (as ``doc``: the columns named in ``keep``, doc_id by default) with its evidence, site posteriors, probability and verdict."""
    p = evidence(model or fit(docs, labels))("text")
    cols = keep or ["doc_id"]
    d = docs.select(F.struct(*[F.col(c) for c in cols]).alias("doc"), F.col(host).alias("h"), F.col(path).alias("pth"), p.alias("p"))
    d = stored(d, "scores")  # texts are scored once: sites and verdicts read the stored column
    table, share = sites(d.select("h", "pth", "p"), "h", "pth")
    table = stored(table, "sites")
    if table.count() <= BROADCAST_SITES:
        table = F.broadcast(table)
    d = d.join(table, F.col("h").eqNullSafe(F.col("_host")) & F.col("pth").eqNullSafe(F.col("_path")), "left")
    logit = lambda x: F.log(x / (1 - x))
    site = F.greatest(F.lit(0.001), F.least(F.lit(0.999), F.col("path_posterior")))
    z = logit(F.greatest(F.lit(1), F.least(F.lit(999_999), F.col("p"))) / 1e6) + logit(site) - F.lit(math.log(share / (1 - share)))
    final = F.round(1 / (1 + F.exp(-z)), 6)
    return d.select("doc", (F.col("p") / 1e6).alias("evidence"), "host_posterior", "path_posterior",
                    final.alias("probability"), (final >= KEEP_AT).alias("kept"))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, evidence, host_posterior, path_posterior, probability, kept for every document."""
    return classify(docs, labels).select("doc.doc_id", "evidence", "host_posterior", "path_posterior", "probability", "kept")


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    return classify(docs, labels, keep=docs.columns).filter("kept").select("doc.*")
