"""Personal numbers among other numbers: what is no card stays, what is one is found, spellings stay linked."""

import random
import re
import time

import pytest

from adlens.llm import pii

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("count, make", [
    (20, lambda r: r.randint(0, 9)), (12, lambda r: r.randint(100, 999)), (10, lambda r: r.randint(10, 99)), (8, lambda r: r.randint(1900, 2099)),
    (30, lambda r: r.randint(0, 99))])
def test_tables_of_numbers_stay(count, make):
    names, rng = pii.Pseudonyms(b"k"), random.Random(count)
    for sep in (" ", "-"):
        for _ in range(500):
            row = sep.join(str(make(rng)) for _ in range(count))
            out, counts = names.text(row)
            assert counts["card"] == 0 and (sep == "-" or out == row)
    row = " ".join(map(str, range(1, 21)))
    assert names.text(row)[0] == row


def test_long_rows_of_digits_take_little_time():
    names = pii.Pseudonyms(b"k")
    for text in ("1 " * 8000, "1234 " * 3200, "12 " * 5000, "9" * 16000, "1.1." * 4000, "+1 23 " * 2500):
        at = time.perf_counter()
        names.text(text)
        assert time.perf_counter() - at < 0.5


def test_cards_in_every_grouping_and_beside_other_numbers():
    there, back = pii.Pseudonyms(b"k"), pii.Pseudonyms(b"k", back=True)
    rng = random.Random(1)
    for groups in pii.CARD_GROUPS + [[n] for n in range(13, 20)]:
        for _ in range(60):
            body = "4" + "".join(rng.choice("0123456789") for _ in range(sum(groups) - 2))
            digits = iter(body + str(pii.luhn(body)))
            for sep in " -":
                card = sep.join("".join(next(digits) for _ in range(n)) for n in groups)
                digits = iter(card.replace(sep, ""))
                for text in (card, f"pay {card}.", f"12 {card} 34", f"{card} 2024"):
                    out, counts = there.text(text)
                    assert counts["card"] >= 1 and back.text(out)[0] == text, (text, out)
                    assert [len(x) for x in re.split("[ -]", out)] == [len(x) for x in re.split("[ -]", text)]


def test_one_phone_number_in_several_spellings_stays_linked():
    names, digits = pii.Pseudonyms(b"k"), lambda t: re.sub(r"\D", "", t)
    for same in (["+447911123456", "+44 7911 123456", "+44-7911-123456", "+44 (7911) 123456"],
                 ["+15551234567", "+1 555 123 4567", "+1 (555) 123-4567", "1-555-123-4567"],
                 ["+3725123456", "+372 512 3456"], ["+79161234567", "+7 916 123 45 67"]):
        out = [names.text(t) for t in same]
        assert {digits(t) for t, _ in out} == {digits(out[0][0])} and all(c["phone"] == 1 for _, c in out), out
        assert all(o != t and [c for c in o if not c.isdigit()] == [c for c in t if not c.isdigit()] for (o, _), t in zip(out, same))
    assert names.text("+44 7911 123456")[0].startswith("+44 ") and names.text("+3725123456")[0].startswith("+372")
    assert digits(names.text("555-123-4567")[0]) == digits(names.text("+1 555 123 4567")[0])[1:]


def plain_values(text):
    """Cards, phones, addresses and dates of a text by one plain pattern each, left to right."""
    found = [m.group() for m in re.finditer(r"(?<![\w.-])[0-9]{13,19}(?![\w-]|\.[0-9])", text) if pii.is_card(m.group())]
    found += [m.group() for m in re.finditer(r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w]|\.[0-9])", text) if max(map(int, m.group().split("."))) < 256]
    return found + re.findall(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])", text)


def test_whole_texts_lose_their_values_and_nothing_else(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, back = pii.Pseudonyms(b"k"), pii.Pseudonyms(b"k", back=True)
    of, seen = {}, 0
    for r in docs.collect():
        out, counts = names.text(r.text)
        assert back.text(out)[0] == r.text and len(out.split()) == len(r.text.split())
        assert (out == r.text) or sum(counts.values())
        if not re.search(r"[0-9@]", r.text):
            assert out == r.text
        for a, b in zip(r.text.split(), out.split()):
            for v in plain_values(a):
                w = plain_values(b)
                seen += 1
                if v == a:
                    assert of.setdefault(v, b) == b  # equal values stay linked
        if counts["card"]:
            assert sum(map(pii.is_card, re.findall(r"[0-9]{13,19}", out))) >= counts["card"]
    assert seen
