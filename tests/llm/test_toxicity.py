"""Toxicity as a whole against dense cosines, votes and calibration; ids of any type; held-out labels."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
from parcelgrid.llm import toxicity
from parcelgrid.llm.queries import op3_toxicity
from paths import TESTDATA
from pyspark.sql import functions as F


def rows_of(rng, n):
    words = [f"word{k}" for k in range(200)]
    out = []
    for i in range(n):
        some = rng.choices(words, k=rng.randrange(1, 50))
        if i % 5 == 0:
            some += rng.choices([f"vile{k}" for k in range(6)], k=3)
        out.append((f"d{i}", " ".join(some), int(i % 5 == 0)))
    return out


def scores_by_force(learnt, texts):
    """Scores by the cosines of every text with every example; ``learnt`` in the order of the sample."""
    counts = [toxicity.terms(t) for _, t, _ in learnt]
    y = np.array([label for _, _, label in learnt], float)
    words = toxicity.telling_terms(counts, y)
    df = Counter(w for t in texts for w in set(toxicity.terms(t)) & set(words))
    weight = np.array([np.log((1 + len(texts)) / (1 + df[w])) for w in words])

    def vector(c):
        v = np.array([1 + np.log(c[w]) if c[w] else 0.0 for w in words]) * weight
        return v / max(np.linalg.norm(v), 1e-12)

    dense = np.array([vector(c) for c in counts])

    def vote(text, leave_out=-1):
        cosine = dense @ vector(toxicity.terms(text))
        cosine[leave_out if leave_out >= 0 else len(cosine) :][:1] = 0
        best = [i for i in sorted(range(len(cosine)), key=lambda i: (-round(cosine[i], 12), i)) if cosine[i] > 0][: toxicity.NEAREST]
        if not best:
            return None
        w = cosine[best] ** 2 / np.maximum(2 - 2 * np.minimum(cosine[best], 1), 1e-3)
        return float((w * y[best]).sum() / w.sum())

    own = [vote(t, i) for i, (_, t, _) in enumerate(learnt)]
    met = np.array([v is not None for v in own])
    knots = toxicity.isotonic(np.array([v for v in own if v is not None]), y[met], np.ones(met.sum()))
    base = float(y[~met].mean()) if not met.all() else float(y.mean())
    return [base if (v := vote(t)) is None else float(np.interp(v, *knots)) for t in texts]


def test_whole_query_by_force(spark):
    rng = random.Random(8)
    rows = rows_of(rng, 260)
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id string, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows[:200]], "doc_id string, toxic int")
    got = toxicity.with_scores(docs, labels, F.lit(True), size=1000)
    assert dict(got.dtypes)["evidence"] == "array<struct<doc_id:string,cosine:double>>"
    found = {r.doc_id: r for r in got.collect()}
    order = {r.doc_id: r.h for r in docs.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    learnt = sorted(rows[:200], key=lambda r: (order[r[0]], r[0]))
    want = scores_by_force(learnt, [t for _, t, _ in rows])
    assert np.allclose([found[i].score for i, _, _ in rows], want, atol=1e-9)
    learnt_ids = {i for i, _, _ in learnt}
    assert all(e.doc_id in learnt_ids for r in found.values() for e in r.evidence)


def test_frequent_telling_words_count(spark):
    """Words that a third of all documents hold tell as well as rare ones."""
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choices([f"w{k}" for k in range(90)], k=40)) + (" vile" if i % 3 == 0 else ""), int(i % 3 == 0)) for i in range(240)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows[:180]], "doc_id long, toxic int")
    found = {r.doc_id: r.score for r in toxicity.with_scores(docs, labels, F.lit(True)).collect()}
    assert all((found[i] >= 0.7) == bool(y) for i, _, y in rows)


def test_one_huge_labelled_text_is_no_end_of_the_sample(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_TEXT", 2_000)
    rng = random.Random(10)
    rows = [*rows_of(rng, 120), ("huge", "word1 " * 5_000, 0)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id string, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id string, toxic int")
    found = toxicity.with_scores(docs, labels, F.lit(True)).collect()
    assert {e.doc_id for r in found for e in r.evidence} and all("huge" != e.doc_id for r in found for e in r.evidence)


def test_held_out_documents(spark):
    folder = f"{TESTDATA}/sf0.01"
    got = op3_toxicity(spark, folder)
    assert got.columns == ["doc_id", "held_out", "score", "predicted", "evidence"]
    rows = {r.doc_id: r for r in got.collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) for i, r in rows.items())
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("toxic IS NOT NULL").collect()
    held = [(rows[r.doc_id].predicted, r.toxic) for r in labels if r.doc_id in rows and rows[r.doc_id].held_out]
    assert np.mean([p == y for p, y in held]) > 0.9
