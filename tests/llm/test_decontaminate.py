"""Decontamination of repetitive texts, short items and ids of any type, against plain alignment."""

from __future__ import annotations

import random
import resource
import time

import numpy as np
from parcelgrid.llm import decontaminate


def best_by_force(item, text):
    """(edits, start) of the first best place: fewest edits, then first start."""
    big = 1 << 32
    row = [j for j in range(len(text) + 1)]
    for c in item:
        last, row = row, [row[0] + big]
        for j, d in enumerate(text):
            row.append(min(last[j] + big * (c != d), last[j + 1] + big, row[j] + big))
    return divmod(min(row), big)


def leaks(items, texts):
    index = decontaminate.Index([(i, decontaminate.normal(t)) for i, t in items], decontaminate.RATE)
    return decontaminate._leaks([decontaminate.normal(t) for t in texts], index)


def repetitive(rng):
    period = "".join(rng.choices("abc", k=rng.choice([1, 2, 3, 7, 20])))
    text = list(period * rng.randrange(1, 40))
    for _ in range(rng.choice([0, 0, 1, 3])):
        text[rng.randrange(len(text))] = rng.choice("abcx")
    return "".join(text)


def test_repetitive_items_and_texts_by_force():
    rng = random.Random(1)
    hits = 0
    for _ in range(40):
        items = list(enumerate(repetitive(rng) for _ in range(4)))
        texts = ["".join(repetitive(rng) for _ in range(rng.randrange(3))) for _ in range(4)]
        texts.append("xyz " + items[0][1] + " zyx")
        for text, found in zip(texts, leaks(items, texts)):
            got = {x["item_id"]: x["distance"] for x in found}
            for i, item in items:
                edits, _ = best_by_force(item.encode(), text.encode()) if text else (len(item), 0)
                if edits <= decontaminate.budget(len(item)):
                    assert got.pop(i) == edits
                    hits += 1
            assert not got
    assert hits > 40


def test_short_items_are_found_as_they_stand(spark, docs):
    benchmark = spark.createDataFrame([("s", "Tiny"), ("t", "a  b"), ("u", ""), ("v", None), ("w", "eleven byte")], "item_id string, text string")
    got = decontaminate.with_leaks(docs([(1, "so tiny"), (2, "A\nB"), (3, "tin y"), (4, None), (5, "x eleven\tBYTE x")]), benchmark)
    found = {r.doc_id: [(x.item_id, x.distance, x.start, x.end) for x in r.leaks] for r in got.collect()}
    assert found == {1: [("s", 0, 3, 7)], 2: [("t", 0, 0, 3)], 3: [], 4: [], 5: [("w", 0, 2, 13)]}


def test_a_long_text_of_one_byte_is_no_blow_up():
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    started = time.process_time()
    (found,) = leaks([(1, "a" * 1000)], ["a" * 10_000_000])
    assert [(x["distance"], x["start"], x["end"]) for x in found] == [(0, 0, 1000)]
    assert time.process_time() - started < 20
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1 << 20  # kilobytes


def test_a_repetitive_item_that_nearly_occurs():
    """No exact place and many near ones: all bands of a long stretch are aligned, in pieces."""
    item = "ab" * 150 + "x" + "ab" * 150
    (found,) = leaks([(1, item)], ["ab" * 40_000])
    assert [x["distance"] for x in found] == [1]
    text = "ab" * 5_000 + item + "ab" * 5_000
    (found,) = leaks([(1, item)], [text])
    assert [(x["distance"], x["start"]) for x in found] == [(0, text.find(item))]


def test_pieces_of_a_range_hide_nothing(monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE", 5)
    monkeypatch.setattr(decontaminate, "PLACES", 7)
    test_repetitive_items_and_texts_by_force()


def test_bounds_of_bands_are_never_too_low():
    """Every place within the budget lies in a range of candidate bands."""
    rng = np.random.default_rng(3)
    for _ in range(30):
        item = bytes(rng.choice(list(b"abcd"), 120).astype(np.uint8))
        changed = bytearray(item)
        for at in rng.choice(120, decontaminate.budget(120), replace=False):
            changed[at] = ord("x")
        text = bytes(rng.choice(list(b"abcd"), 300).astype(np.uint8)) + bytes(changed)
        index = decontaminate.Index([(1, item)], decontaminate.RATE)
        assert decontaminate._candidates(np.frombuffer(text, np.uint8), np.array([0]), index)
