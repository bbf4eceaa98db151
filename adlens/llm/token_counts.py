"""Token counts by Viterbi segmentation over a unigram vocabulary, counting only.

An Aho-Corasick automaton lists every vocabulary piece that ends at each
character; dynamic programming keeps, per character, the best score and the
number of pieces behind it, never the pieces themselves.

Tie rules, as the public unigram tokenizers have them: a later candidate must be
strictly better, and candidates for one end come with the earliest start first;
where no piece covers a single character, that character alone may be unknown at
``lowest score - 10``; neighbouring unknown characters fuse, and with byte
fallback count one token per UTF-8 byte, else one in all.

The vocabulary is read once on the driver from the given file (a few MB, fixed)
and sent to the executors.  Scores are summed as float64: whole-number scores,
as in the public file used here, sum exactly at any length.  Where no piece has a
non-space character before the word mark, texts are cut in front of each run of
marks and repeated words are looked up in a bounded table.

Defined results: null and empty texts have 0 tokens; a null doc_id is carried
through; repeated rows are counted one by one; only doc_id and text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_WORDS = 1 << 18
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def read_vocabulary(path: str = VOCABULARY) -> list[tuple[str, float]]:
    """The ordinary pieces of a sentencepiece model file and their scores."""
    from sentencepiece import sentencepiece_model_pb2 as model

    proto = model.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    ordinary = (model.ModelProto.SentencePiece.NORMAL, model.ModelProto.SentencePiece.USER_DEFINED)
    return [(p.piece, p.score) for p in proto.pieces if p.type in ordinary]


class Counter:
    """Counts tokens of texts; one per Python worker."""

    def __init__(self, pieces: list[tuple[str, float]], byte_fallback: bool = True):
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.byte_fallback = byte_fallback
        self.words = not any(re.search(f"[^{MARK}]{MARK}", piece) for piece, _ in pieces)
        self.cache: dict[str, int] = {}

    def segment(self, s: str) -> int:
        """Pieces on the best path through ``s``."""
        best, count, open_unknown = [0.0] + [None] * len(s), [0] * (len(s) + 1), [False] * (len(s) + 1)
        matches = self.automaton.iter(s)
        last, found = next(matches, (None, None))
        for end in range(1, len(s) + 1):
            single = False
            top = None
            while last == end - 1:  # longest first: earliest start first
                length, score = found
                start = end - length
                value = best[start] + score
                single = single or length == 1
                if top is None or value > top:
                    top, count[end] = value, count[start] + 1
                last, found = next(matches, (None, None))
            if not single:
                value = best[end - 1] + self.unknown
                if top is None or value > top:
                    top, open_unknown[end] = value, True
                    fused = open_unknown[end - 1] and not self.byte_fallback
                    count[end] = count[end - 1] + (len(s[end - 1].encode("utf-8", "replace")) if self.byte_fallback else 0 if fused else 1)
            best[end] = top
        return count[-1]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        s = MARK + text.replace(" ", MARK)
        if not self.words or not self.byte_fallback:
            return self.segment(s)
        total, cache = 0, self.cache
        for word in re.findall(f"{MARK}+[^{MARK}]*", s):
            n = cache.get(word)
            if n is None:
                if len(cache) >= CACHE_WORDS:
                    cache.clear()
                n = self.segment(word)
                if len(word) <= 64:
                    cache[word] = n
            total += n
        return total


def count_tokens(docs: DataFrame, path: str = VOCABULARY, byte_fallback: bool = True) -> DataFrame:
    """doc_id, n_tokens and n_bytes of every document."""
    pieces = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))  # the fixed vocabulary

    @F.pandas_udf("long")
    def tokens(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(pieces.value, byte_fallback)
        for batch in texts:
            yield pd.Series([counter.count(t) for t in batch], dtype="int64")

    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", tokens("text").alias("n_tokens"), F.octet_length(text).cast("long").alias("n_bytes"))
