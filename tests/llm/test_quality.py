"""The quality network: its arithmetic by force, and how well it tells held-out texts apart."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from parcelgrid.llm import quality
from parcelgrid.llm.queries import op13_quality_classifier
from paths import TESTDATA
from pyspark.sql import functions as F

WORDS = "the of and thin stone river walks under light again never house".split()


def made(rng, good):
    words = rng.choices(WORDS, k=rng.randrange(1, 150))
    return " ".join(words) + "." if good else " ".join(w + rng.choice(["###", "$$$"]) for w in words)


@pytest.fixture(scope="module")
def net():
    rng = random.Random(1)
    y = np.array([i % 2 for i in range(120)], float)
    texts = [made(rng, bool(v)).encode() for v in y]
    return quality.train(texts, y, np.ones(120), 12)


def score_by_force(net, text):
    """One text, one filter place at a time."""
    counts = (len(text) + quality.WIDTH) // quality.SEGMENT + 1
    data = text + bytes(counts * quality.SEGMENT + quality.WIDTH - len(text))
    best = np.zeros((counts, quality.FILTERS))
    for s in range(counts):
        for at in range(s * quality.SEGMENT, (s + 1) * quality.SEGMENT, quality.STEP):
            if at < len(text):
                window = net["embed"][list(data[at : at + quality.WIDTH])]
                best[s] = np.maximum(best[s], np.einsum("we,wef->f", window, net["filter"]) + net["bias"])
    chunks = np.array([best[s : s + 2].max(0) for s in range(max(1, counts - 1))])
    features = np.concatenate([chunks.mean(0), chunks.max(0)])
    hidden = np.maximum(features @ net["hidden"] + net["hidden_bias"], 0)
    return 1 / (1 + np.exp(-(hidden @ net["out"] + net["out_bias"][0])))


def test_scores_equal_those_by_force(net):
    rng = random.Random(2)
    texts = [b"", b"a", b"\x00" * 9, b"x" * 247, b"x" * 248, b"x" * 249, b"y" * 256, b"z" * 257, bytes(range(256)) * 3]
    texts += [made(rng, i % 2).encode() for i in range(40)] + [b"long text " * 700]
    want = [score_by_force(net, t) for t in texts]
    scorer = quality.Scorer(net)
    assert np.allclose(scorer.scores(texts), want, atol=1e-4)
    # neighbours make no difference, and neither do small blocks
    assert np.allclose([scorer.scores([t])[0] for t in texts], want, atol=1e-4)
    assert len(scorer.scores([])) == 0


def test_gradients_equal_differences():
    rng = random.Random(3)
    texts = [made(rng, i % 2).encode() for i in range(6)] + [b""]
    y, w = np.array([0, 1, 0, 1, 0, 1, 1.0]), np.array([1, 2, 1, 0.5, 1, 1, 1.0])
    net = quality.train(texts, y, w, 2)

    def loss(some):
        rows, places, counts = quality.segments(texts)
        best = quality.responses(some, np.einsum("be,wef->wbf", some["embed"], some["filter"]), rows, places).max(1)
        p = quality.combined(some, quality.pooled(best, counts)[2])[1]
        return float((-w * (y * np.log(p) + (1 - y) * np.log(1 - p))).mean())

    grad = quality._gradients(net, texts, y, w)
    for name in net:
        at = np.unravel_index(np.abs(grad[name]).argmax(), net[name].shape)
        step = 3e-4
        up, down = ({**net, name: net[name].copy()} for _ in "ud")
        up[name][at] += step
        down[name][at] -= step
        numeric = (loss(up) - loss(down)) / (2 * step)
        assert abs(numeric - grad[name][at]) <= 0.1 * abs(grad[name][at]) + 3e-3, name


def test_awkward_rows(spark, docs, awkward):
    rng = random.Random(4)
    rows = [(i, made(rng, i % 2)) for i in range(100, 160)]
    labels = [(i, i % 2) for i, _ in rows] + [(None, 1), (100, None), (101, 7), (9999, 1), (102, 0), (102, 0)]
    frame = docs(awkward + rows).selectExpr("*", "'x' AS score")
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    everything = F.lit(True)
    got = quality.with_quality(frame, table, everything, size=40)
    assert got.columns == [*(c for c in frame.columns if c != "score"), "score"]
    found = got.collect()
    assert len(found) == len(awkward) + len(rows) and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id == 4}) == 1
    assert len({r.score for r in found if r.text in (None, "")}) == 1
    empty = spark.createDataFrame([], table.schema)
    assert {r.score for r in quality.with_quality(frame, empty, everything).collect()} == {0.5}
    ones = table.where("quality = 1")
    assert {r.score for r in quality.with_quality(frame, ones, everything).collect()} == {1.0}
    assert quality.with_quality(frame.limit(0), table, everything).count() == 0


def test_text_ids(spark):
    rng = random.Random(5)
    rows = [(f"d{i}", made(rng, i % 2)) for i in range(80)]
    frame = spark.createDataFrame(rows, "doc_id string, text string")
    labels = spark.createDataFrame([(f"d{i}", i % 2) for i in range(60)], "doc_id string, quality int")
    got = quality.with_quality(frame, labels, F.lit(True)).collect()
    assert np.mean([(r.score >= 0.5) == bool(int(r.doc_id[1:]) % 2) for r in got]) > 0.9


def test_held_out_documents(spark):
    """The registered query: whole table, columns as agreed, held-out labels met."""
    folder = f"{TESTDATA}/sf0.01"
    got = op13_quality_classifier(spark, folder)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = {r.doc_id: r for r in got.collect()}
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) for i, r in rows.items())
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("quality IS NOT NULL").collect()
    held = [(rows[r.doc_id], r.quality) for r in labels if r.doc_id in rows and rows[r.doc_id].held_out]
    bad = [r.predicted for r, q in held if q == 0]
    good = [r.predicted for r, q in held if q == 1]
    assert np.mean(good) >= 0.95 and np.mean(bad) <= 0.35, (np.mean(good), np.mean(bad), len(bad))
