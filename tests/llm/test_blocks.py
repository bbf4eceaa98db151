"""Contamination by way of blocks: few hashes for a document, and no window lost by them."""

from pyspark.sql import functions as F

from adlens.llm import decontaminate
from adlens.llm.common import words

ODD = ["", " \t\n\x0b\x0c\r", "one", "Anna's 3.5--7 km/h, 1.2.3 and 4..5 -- (6) x-1-y 7. 8 .9", "so. Ben’s\r\nTWENTY-five\x0bMiles\x0cand\x1c5kg\x85of\xa0it",
       "ΟΔΟΣ, Σ ΑΣ. ΣΑΣ'Α", "İstanbul ǅ 12th 5one one5 twenty-5 5-twenty", "étÉ 𝔸𝕓 ٣٤ \u0001\u0002 #!? 1,000.50 3:4 9-9 9--9", "Don't Tom-Tom's O'Neil ten-ten a1b2 c.3.d"]


def test_a_document_is_hashed_at_every_fourth_word(spark):
    d = spark.createDataFrame([(" ".join(f"w{i}" for i in range(n)),) for n in (0, 3, 4, 7, 8, 800)], "text string")
    size = decontaminate._block(decontaminate.WINDOW)
    n = d.select(F.size(decontaminate._hashes(words(F.col("text")), size, size)).alias("n")).collect()
    assert [r.n for r in n] == [0, 0, 1, 1, 2, 200]


def test_whole_texts_give_the_words_that_single_words_gave(spark):
    d = spark.createDataFrame([(t,) for t in [*ODD, "; ".join(ODD), None]], "text string")
    text, m = F.col("text"), decontaminate.marked(F.col("text"))
    c = decontaminate.named(m)
    raw = decontaminate.spoken(text)
    for r in d.select(decontaminate._split(F.coalesce(text, F.lit(""))).alias("a"), words(text).alias("b"), decontaminate.exact_words(text).alias("e"),
                      decontaminate.exact(c, raw).alias("f"), F.size(m).alias("n")).collect():
        assert r.a == r.b and r.e == r.f and len(r.e) == r.n


def test_items_of_any_length_are_found_at_any_place(spark):
    names = ["Anna", "12", "Ben", "5", "Carl", "7", "Dora", "9", "Emil"]  # few literals: by exact words
    plain = "then every farmer walked slowly across another narrow field toward home".split()
    items = [names[:k] for k in (1, 2, 5, 7, 8)] + [plain]
    rows, want = [], {}
    for i, item in enumerate(items):
        for before in range(9):
            other = ["zz"] * before
            rows += [(len(rows), " ".join(other + item + ["yy", "xx"])), (len(rows) + 1, " ".join(other + item[:-1] + ["qq", "xx"]))]
            want[len(rows) - 2], want[len(rows) - 1] = i, None
    for i, item in enumerate(items):
        d = spark.createDataFrame([r for r in rows if want.get(r[0]) == i or want.get(r[0] - 1) == i], "doc_id long, text string")
        b = spark.createDataFrame([(i, " ".join(item))], "item_id long, text string")
        got = {r.doc_id: r.kept for r in decontaminate.decontaminate(d.coalesce(1), b.coalesce(1)).collect()}
        assert all(not got[k] for k in got if want[k] == i)
        if len(item) <= decontaminate.WINDOW:
            assert all(got[k] for k in got if want[k] is None)
