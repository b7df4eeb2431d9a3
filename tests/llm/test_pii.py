"""What the method adds beyond the base patterns, and what it leaves alone."""

from __future__ import annotations

import random

from parcelgrid.llm import pii
from parcelgrid.llm.queries import op8_pii
from paths import TESTDATA


def luhn(number):
    digits = [int(c) for c in reversed(number)]
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0


def card(rng):
    while not luhn(number := "4" + "".join(rng.choices("0123456789", k=15))):
        pass
    return number


def wrong_card(rng):
    while luhn(number := "7" + "".join(rng.choices("0123456789", k=15))):
        pass
    return number


def corpus(rng):
    """Clear cases of each kind, numbers that are nothing, and cases that the base patterns lose."""
    rows, lost = [], {}
    phone = lambda: f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
    ip = lambda: ".".join(str(rng.randrange(1, 250)) for _ in range(4))
    for i in range(300):
        parts = ["some words", rng.choice(["call", "so", "pay by card"])]
        parts += [[card(rng)], [phone()], [ip()], ["a.b@example.org"], [wrong_card(rng)], [str(rng.randrange(10**6))]][i % 6]
        rows.append((i, " ".join([*parts, "and more"])))
    for i in range(300, 330):
        number, address = phone(), ip()
        rows.append((i, f"words {number} {address} and"))
        lost[i] = ("phone", 6, 6 + len(number))
    for i in range(330, 360):
        first, second = wrong_card(rng), card(rng)
        rows.append((i, f"words {first} {second} and"))
        lost[i] = ("card", 23, 39)
    return rows, lost


def test_lost_spans_are_added_and_nothing_else(docs):
    rows, lost = corpus(random.Random(1))
    got = {r.doc_id: r for r in pii.find_pii(docs(rows)).collect()}
    for i, _ in rows:
        if i in lost:
            assert got[i].n_added == 1 and ":".join(map(str, lost[i])) in got[i].spans.split(",")
        else:
            assert got[i].n_added == 0
    # a base span stays as it is, beside an added one too
    assert all(got[i].n_ip == 1 and got[i].n_phone == 0 for i in range(300, 330))


def test_added_spans_of_the_given_documents(spark):
    """Every added card passes the checksum, every added phone has a country code or an area in brackets."""
    folder = f"{TESTDATA}/sf0.01"
    found = op8_pii(spark, folder)
    texts = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    for r in found.where("n_added > 0").join(texts, "doc_id").collect():
        spans = [s.split(":") for s in r.spans.split(",")]
        for kind, a, b in spans:
            piece = r.text[int(a) : int(b)]
            if kind == "card":
                assert luhn("".join(c for c in piece if c.isdigit()))
            elif kind == "phone":
                assert piece[0] in "+(" or piece.startswith("00")
