"""Cases that the operators once left out."""

from adlens.llm import decontaminate, near_dup, pii
from tests.llm import plain


def _kept(spark, texts, items):
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return [r.kept for r in decontaminate.decontaminate(d, b).orderBy("doc_id").collect()]


def test_copies_of_number_heavy_and_short_items_are_found(spark):
    sums = "Compute 12 + 7, 34 + 9, 81 + 6 and 55 + 2 then add 19 to 4"
    short = "What is 17 times 23?"
    texts = [f"so it goes. {sums} and an end", f"they ask: what is 17 times 23 here", "they ask: what is 18 times 23 here",
             "12 7 34 9 81 6 55 2 19 4", sums.replace("Compute", "Count").replace("then add", "and take")]
    assert _kept(spark, texts, [sums, short]) == [False, False, True, True, True]


def test_a_clash_does_not_clear_the_rest_of_a_copy(spark):
    item = ("the baker sold 5 loaves in the morning and kept the old oven warm until noon while the boys carried the flour sacks up the stairs "
            "and the cat slept near 5 jars of plum jam which nobody had opened since the last long winter came to an end in 3 days")
    texts = [item.replace("near 5 jars", "near 9 jars"), item.replace(" 5 ", " 4 ").replace(" 3 ", " 4 "),
             item.replace("sold 5", "sold 8").replace("near 5", "near 9").replace(" 3 ", " 8 "),
             "the baker sold 5 loaves in the morning and kept the " + "word " * 40 + "the cat slept near 9 jars of plum jam which"]
    assert _kept(spark, texts, [item]) == [False, False, False, True]


def test_names_are_names_whatever_precedes_them(spark):
    item = "Anna has 3 apples. Ben gives her 5 more. Carl takes 13 pears."
    texts = ["Dora has 4 apples. Emil gives her 6 more. Fritz takes 17 pears.", "dora is here\nDora has 4 apples\nEmil gives her 6 more Fritz takes\nthirteen pears",
             item.lower(), "Dora has 4 apples. Emil sells her 6 more. Fritz wants 17 pears."]
    assert _kept(spark, texts, [item]) == [False, False, False, True]
    farm = "the train leaves at ten and the old farmer walks twenty-five miles to town"
    copies = [farm.capitalize().replace("ten", "thirteen").replace("twenty-five", "19"), "so. " + farm.replace("ten", "one"), farm.replace("leaves", "stops").replace("walks", "rides")]
    assert _kept(spark, copies, [farm]) == [False, False, True]


def test_phones_and_addresses_of_any_range_are_replaced():
    there, back = pii.Pseudonyms(b"k"), pii.Pseudonyms(b"k", back=True)
    for v in ("+1 (017) 555-7713", "+1 (132) 555-1352", "240.56.125.154", "233.254.104.120", "0.1.2.3", "127.0.0.1", "555-123-4567", "(155) 012-4567"):
        out, counts = there.text(f"call {v} now")
        assert v not in out and sum(counts.values()) == 1 and back.text(out)[0] == f"call {v} now"


def test_cards_and_ibans_beside_other_groups_are_replaced():
    there, back = pii.Pseudonyms(b"k"), pii.Pseudonyms(b"k", back=True)
    for v, rest in (("4111 1111 1111 1111", " 123"), ("4041894974608795", " 12"), ("GB82 WEST 1234 5698 7654 32", " ABCD"),
                    ("GB82WEST12345698765432", " 1234"), ("4041894974608795", " 1")):
        for text in (v + rest, "no " + v + rest + " end", "77 " + v + rest):
            out, counts = there.text(text)
            assert v not in out and sum(counts.values()) == 1 and back.text(out)[0] == text, text


def test_near_copies_from_four_fifths_on(spark):
    words = plain.prose(304, 21).split()
    copy = list(words)
    for k in range(30, 270, 42):  # 6 words of 304: 30 of 300 shingles differ, 270 / 330 = 0.82
        copy[k] = "other"
    a, b = map(plain.shingles, (" ".join(words), " ".join(copy)))
    assert 0.8 <= len(a & b) / len(a | b) < 0.85
    d = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(copy))], "doc_id long, text string")
    assert [r.doc_id for r in near_dup.unique_documents(d, threshold=80).collect()] == [1]
    assert near_dup.unique_documents(d).count() == 2
