"""Scores, sequences, leaks: the operators that work on one text at a time."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from parcelgrid.llm import decontaminate, lm, packing, toxicity
from parcelgrid.llm.common import remainder_of_id

PATH = public_tokenizers.path("word_bpe_49k.json")


# toxicity


def toxic_rows(n, seed=1):
    rng = random.Random(seed)
    bad = ["vile%d" % i for i in range(8)]
    rows = []
    for i in range(n):
        words = rng.choices(["word%d" % k for k in range(300)], k=60)
        if i % 4 == 0:
            for at in rng.sample(range(60), 4):
                words[at] = rng.choice(bad)
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    return rows


def test_toxic_texts_score_high_and_others_low(spark, docs):
    rows = toxic_rows(900)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    scored = toxicity.with_scores(docs([(i, t) for i, t, _ in rows]), labels, remainder_of_id(3) != 1)
    held = [r for r in scored.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    label = {i: y for i, _, y in rows}
    right = sum((r.score >= 0.7) == bool(label[r.doc_id]) for r in held)
    assert len(held) > 200 and right / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in held)
    assert all(e.doc_id % 3 is not None and zlib.crc32(str(e.doc_id).encode()) % 3 != 1 for r in held for e in r.evidence)


def test_nearest_examples_are_those_of_brute_force():
    rows = toxic_rows(700, 2)
    counts = [toxicity.terms(t) for _, t, _ in rows]
    idf = {w: 1.0 + (zlib.crc32(w.encode()) % 100) / 25 for c in counts for w in c}
    index = toxicity.Examples(counts, [i for i, _, _ in rows], np.array([y for _, _, y in rows], float), idf)
    dense = np.zeros((len(rows), len(idf)))
    for i, c in enumerate(counts):
        at, value = index.vector(c)
        dense[i, at] = value
    for i in range(0, 700, 23):
        found, cosine = index.nearest(counts[i])
        truth = dense @ dense[i]
        best = np.sort(truth)[::-1][: toxicity.NEAREST]
        assert np.allclose(cosine, best) and np.allclose(truth[found], cosine)


def test_scores_of_awkward_texts(spark, docs, awkward):
    rows = toxic_rows(200, 3)
    labels = spark.createDataFrame(
        [(i, y) for i, _, y in rows] + [(None, 1), (5, None), (5, 1), (5, 0)], "doc_id long, toxic int"
    )
    all_docs = docs([(i + 1000, t) for i, t, _ in rows] + awkward).withColumns({"score": F.lit("x"), "evidence": F.lit(1)})
    got = toxicity.with_scores(all_docs, labels, F.lit(True))
    assert got.where("score IS NULL OR score < 0 OR score > 1").count() == 0 and got.count() == 200 + len(awkward)
    none = labels.limit(0)
    assert {r.score for r in toxicity.with_scores(docs(awkward), none, F.lit(True)).collect()} == {0.0}
    assert toxicity.with_scores(docs([]), labels, F.lit(True)).count() == 0


# language model


def by_force(rows, learn, order, mass):
    def tokens(t):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        return [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w] + ["\0end"]

    texts = [(i, tokens(t)) for i, t in rows]
    learnt = [w for i, w in texts if learn(i)]
    counts = Counter()
    for words in learnt:
        padded = ["\0start"] * (order - 1) + words
        for n in range(1, order + 1):
            counts.update(tuple(padded[k - n + 1 : k + 1]) for k in range(order - 1, len(padded)))
    total = sum(c for g, c in counts.items() if len(g) == 1)
    distinct = sum(len(g) == 1 for g in counts)

    def p(context, word):
        if not context:
            return (counts[(word,)] + 1) / (total + distinct + 1)
        seen = len(learnt) if set(context) == {"\0start"} else counts[context]
        return (counts[(*context, word)] + mass * p(context[1:], word)) / (seen + mass)

    out = []
    for i, words in texts:
        padded = ["\0start"] * (order - 1) + words
        score = sum(math.log10(p(tuple(padded[k - order + 1 : k]), padded[k])) for k in range(order - 1, len(padded)))
        base = sum(math.log10(p((), w)) for w in words)
        out.append((i, len(words), sum(counts[(w,)] > 0 for w in words), total, round(base, 6), round(score, 6)))
    return Counter(out)


@pytest.mark.parametrize("order, pack", [(1, 10**6), (2, 300), (3, 10**6), (3, 700)])
def test_scores_are_those_of_the_smoothed_model(docs, monkeypatch, order, pack):
    monkeypatch.setattr(lm, "PACK_TOKENS", pack)  # many packs share one model
    rng = random.Random(order)
    words = ["w%d" % min(int(rng.expovariate(0.2)), 40) for _ in range(4000)]
    rows = [(i, " ".join(words[i * 37 : i * 37 + rng.randrange(60)])) for i in range(100)]
    rows += [(200, None), (201, " \t\n"), (202, "Neu  nEU\x0bneu"), (None, "w1 w2"), (5, rows[5][1]), (5, rows[5][1])]
    got = lm.score_texts(docs(rows), remainder_of_id(7) != 2, order).collect()
    mine = Counter((r[0], r[1], r[2], r[3], round(r[4], 6), round(r[5], 6)) for r in got)
    learn = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2
    assert mine == by_force(rows, learn, order, lm.MASS)


def test_model_beats_single_words_on_held_out_texts(docs):
    rng = random.Random(9)
    follow = {k: rng.sample(range(200), 3) for k in range(200)}
    rows = []
    for i in range(300):
        at, text = rng.randrange(200), []
        for _ in range(80):
            at = rng.choice(follow[at])
            text.append(f"w{at}")
        rows.append((i, " ".join(text)))
    held = lm.score_texts(docs(rows), remainder_of_id(7) != 2).where(remainder_of_id(7) == 2)
    base, score = held.agg(F.sum("base_score"), F.sum("score")).first()
    assert score > 0.5 * base > base


def test_language_model_of_nothing(docs, awkward):
    assert lm.score_texts(docs([]), F.lit(True)).count() == 0
    untrained = lm.score_texts(docs([(1, "a b")]), F.lit(False)).first()
    assert (untrained.n_known, untrained.train_tokens, untrained.base_score, untrained.score) == (0, 0, 0.0, 0.0)
    got = lm.score_texts(docs(awkward), F.lit(True)).collect()
    assert len(got) == len(awkward) and all(math.isfinite(r.score) and r.score <= 0 for r in got)


# packing


ODD = (
    "İstanbul ΑΣ ΟΔΟΣ. don't we'll I'M <|endoftext|>x foo<|startoftext|>bar <|ENDOFTEXT|> a b​c ́x é ﬁ ŉ Ǆ ſtreet"
    " Straße Ñandú!! end... a1b2 12.5% … 中文。 नमस्ते 🙂 a\x00b \x1cq \x85z ABC? DéF, É."
)


def test_words_give_the_ids_of_the_whole_text(docs, awkward):
    import pyarrow as pa

    texts = [t or "" for _, t in awkward] + [ODD, ODD.upper(), ODD.replace(" ", "")]
    ids, sizes = packing.WordTokenizer(PATH).encode(pa.array(texts))
    want = [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    assert sizes.tolist() == list(map(len, want)) and ids.tolist() == [x for w in want for x in w]


def test_pieces_put_together_are_the_documents(docs, awkward, monkeypatch):
    monkeypatch.setattr(packing, "SEGMENT", 9000)  # plans meet several times
    rng = random.Random(4)
    rows = awkward + [
        (100 + i, " ".join(rng.choices(["alpha", "beta.", "gamma,", "Delta!", "épsilon"], k=rng.randrange(900)))) for i in range(60)
    ]
    rows = [(k, t) for k, (_, t) in enumerate(rows)]
    got = packing.pack(docs(rows).repartition(2), PATH).toPandas()
    tokenizer = Tokenizer.from_file(PATH)
    for i, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        own = got[got.doc_id == i].sort_values("start")
        assert own.start.tolist() == [0, *own.length.cumsum().tolist()[:-1]] and own.length.sum() == len(ids)
        assert set(own.doc_tokens) == {len(ids)}
        for r in own.itertuples():
            assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
    padding = total = 0
    for _, own in got.sort_values("offset").groupby("sequence_id"):
        assert own.offset.tolist() == [0, *own.length.cumsum().tolist()[:-1]]
        length = int(own.length.sum())
        assert length <= packing.LENGTH and (own.length > 0).all()
        total += length
        padding += 0 if length & (length - 1) == 0 else packing.LENGTH - length
    assert padding < 0.03 * total  # of many short plans
    assert packing.pack(docs([]), PATH).count() == 0


def best_by_force(place, cost):
    """Least padding and penalties over all ways to cut, full sequences between allowed once."""
    best = [0.0]
    for j in range(1, len(place)):
        ways = []
        for i in range(j):
            gap = place[j] - place[i]
            if gap <= packing.LENGTH:
                ways.append(best[i] + (0 if gap == packing.LENGTH // 2 else packing.LENGTH - gap))
            elif gap <= 2 * packing.LENGTH:
                ways.append(best[i] + packing.MID_CUT + 2 * packing.LENGTH - gap)
        best.append(min(ways) + cost[j])
    return best


@pytest.mark.parametrize("seed", range(5))
def test_plan_is_the_best_of_all(seed):
    rng = np.random.default_rng(seed)
    ends = np.cumsum(rng.integers(1, 3000, 40))
    sentence = rng.random(int(ends[-1])) < 0.01
    place, cost = packing.candidates(ends, sentence)
    assert packing.plan(place, cost)[0] == best_by_force(place, cost)


# leaks


def distance_by_force(item, text):
    row = [0] * (len(text) + 1)
    for c in item:
        last, row = row, [row[0] + 1]
        for j, d in enumerate(text):
            row.append(min(last[j] + (c != d), last[j + 1] + 1, row[j] + 1))
    return min(row)


def test_leaks_are_found_within_the_budget_and_nowhere_else(spark, docs):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdeionrst", k=rng.randrange(2, 9)))
    items = [(i, " ".join(word() for _ in range(rng.randrange(14, 45)))) for i in range(12)]
    rows = []
    for n in range(120):
        parts = [word() for _ in range(60)]
        if n % 2:
            text = list(items[n % 12][1])
            for _ in range(rng.randrange(0, 22)):
                at = rng.randrange(len(text))
                text[at : at + rng.randrange(2)] = rng.choice(["", "x", "yz"])
            parts.insert(rng.randrange(60), "".join(text))
        rows.append((n, " ".join(parts)))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: {x.item_id: x.distance for x in r.leaks} for r in decontaminate.with_leaks(docs(rows), benchmark).collect()}
    found = 0
    for n, text in rows:
        for i, item in items:
            want, own = decontaminate.normal(item), decontaminate.normal(text)
            edits = distance_by_force(want, own) if i == n % 12 else None
            if edits is not None and edits <= decontaminate.budget(len(want)):
                assert got[n][i] == edits
                found += 1
            else:
                assert i not in got[n]
    assert 20 < found < 60


def test_leaks_of_awkward_texts_and_items(spark, docs, awkward):
    passage = "The quick brown fox jumps over the lazy dog near the old river bank"
    items = [(1, passage), (1, passage), (2, None), (3, ""), (4, "short"), (None, "Another passage that is long enough to tell"), (5, "é" * 40)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = awkward + [(50, f"x \n{passage.upper()}  end"), (51, passage.replace(" ", "\n\t")), (52, "É" * 40)]
    rows += [(53, "y " * 300_000 + passage), (54, passage[:40])]
    frame = docs(rows).withColumn("leaks", F.lit("clash"))
    got = {r.doc_id: r.leaks for r in decontaminate.with_leaks(frame, benchmark).where("doc_id >= 50").collect()}
    assert [[x.item_id for x in got[i]] for i in range(50, 55)] == [[1, 1], [1, 1], [5], [1, 1], []]
    assert (got[50][0].start, got[50][0].end) == (2, 2 + len(passage)) and got[50][0].distance == 0
    assert decontaminate.with_leaks(docs(awkward), benchmark).where("size(leaks) > 0").count() == 0
    assert decontaminate.with_leaks(docs(rows), benchmark.limit(0)).where("size(leaks) > 0").count() == 0
    assert decontaminate.with_leaks(docs([]), benchmark).count() == 0


def test_items_in_several_blocks(spark, docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "BENCHMARK_BYTES", 100)
    items = [(i, f"passage number {i} " + "abcdefghij" * 4 + f" {i * 7919}") for i in range(9)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.with_leaks(docs(items), benchmark, rate=0.0).collect()
    assert all([x.item_id for x in r.leaks] == [r.doc_id] for r in got) and len(got) == 9
