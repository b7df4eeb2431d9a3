"""Line dedup against plain Python, null and shared ids included, and how much of what repeats it finds."""

from __future__ import annotations

import random
import struct
from collections import Counter, defaultdict

import xxhash
from parcelgrid.llm import line_dedup
from paths import TESTDATA
from pyspark.sql import functions as F


def chunks_of(text):
    lines = (text or "").split("\n")
    hashes = [xxhash.xxh64_intdigest(line.encode(), 42) for line in lines]
    out, first = [], 0
    for i in range(1, len(lines) + 1):
        seed = 42
        for k in range(1, line_dedup.WINDOW + 1):
            seed = xxhash.xxh64_intdigest(struct.pack("<Q", hashes[i - k]), seed)
        signed = seed - (1 << 64) if seed >> 63 else seed
        if i == len(lines) or (i >= line_dedup.WINDOW and signed % line_dedup.CUT == 0):
            out.append((first, lines[first:i]))
            first = i
    return out


def dedup_by_force(spark, rows):
    """Rows (doc_id, text), once for each distinct row."""
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    text = F.coalesce("text", F.lit(""))
    order = [F.xxhash64(F.lit(s), F.col("doc_id").isNull(), "doc_id", text) for s in (0, 1)]
    ranked = {(r[0], r[1] or ""): (r[0] is None, r[0] or 0, r[2], r[3]) for r in frame.select("doc_id", "text", *order).collect()}
    first = {}
    for key in sorted(ranked, key=ranked.get):
        for at, (_, lines) in enumerate(chunks_of(key[1])):
            if len(lines) > 1:
                first.setdefault("\n".join(lines), (key, at))
    out = {}
    for key in ranked:
        chunks = chunks_of(key[1])
        gone = [len(c) > 1 and first["\n".join(c)] != (key, at) for at, (_, c) in enumerate(chunks)]
        kept = [line for (_, c), g in zip(chunks, gone) if not g for line in c]
        cut = [c for (_, c), g in zip(chunks, gone) if g]
        out[key] = (key[0], sum(len(c) for _, c in chunks), sum(map(len, cut)), len(cut), "\n".join(kept))
    return Counter(out[i, t or ""] for i, t in rows)


def corpus(rng, n):
    passages = [[f"shared {p} line {k}" for k in range(rng.randrange(2, 30))] for p in range(12)]
    rows = []
    for i in range(n):
        lines = []
        for _ in range(rng.randrange(5)):
            lines += rng.choice(passages) if rng.random() < 0.5 else [f"own {i} {rng.random()}" for _ in range(rng.randrange(6))]
        text = rng.choice([None, "", "\n"]) if not lines else "\n".join(lines)
        rows.append((rng.choice([i, i % 10, None]), text))
    return rows


def test_random_corpora(spark):
    for seed in range(3):
        rows = corpus(random.Random(seed), 150)
        frame = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n_lines int")
        got = line_dedup.dedup_lines(frame)
        assert got.columns == ["doc_id", "n_lines", "n_removed_lines", "n_removed_chunks", "text"]
        assert Counter(map(tuple, got.collect())) == dedup_by_force(spark, rows)


def test_a_line_that_occurs_once_stays(spark):
    passage = "\n".join(f"shared {k}" for k in range(40))
    alone = "\n".join(f"alone {k}" for k in range(12))
    other = "\n".join(f"other {k}" for k in range(12))
    for first, second in ((None, None), (5, 5), ("a", "a"), ("a", None)):
        kind = "string" if "a" in (first, second) else "long"
        rows = [("1" if kind == "string" else 1, passage), (first, passage), (second, alone), (second, other)]
        got = {r.text for r in line_dedup.dedup_lines(spark.createDataFrame(rows, f"doc_id {kind}, text string")).collect()}
        assert {alone, other} <= got and passage in got and len(got) == 4


def test_equal_rows_are_one_document(spark):
    text = "\n".join(f"line {k % 5}" for k in range(60))
    rows = [(1, text)] * 3 + [(None, text)] * 2
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter(map(tuple, got.collect())) == dedup_by_force(spark, rows)


def test_a_long_text_with_many_repeats(spark):
    lines = [f"line {k}" for k in range(60_000)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(lines)), (3, "\n".join(["same"] * 100_000))]
    got = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].n_removed_lines == 0 and got[1].text == rows[0][1]
    assert got[2].n_removed_lines > 0.7 * 60_000
    assert got[3].n_lines == 100_000


def test_share_of_repeated_passages_found(spark):
    """Lines inside repeated runs of four lines or more, all but the first of each: how many go?"""
    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet").select("doc_id", "text")
    rows = sorted((r.doc_id, (r.text or "").split("\n")) for r in docs.collect())
    seen, repeated = set(), defaultdict(set)
    for doc, lines in rows:
        runs = [tuple(lines[k : k + 4]) for k in range(len(lines) - 3)]
        for k, run in enumerate(runs):
            if run in seen:
                repeated[doc].update(range(k, k + 4))
        seen.update(runs)
    want = sum(map(len, repeated.values()))
    got = line_dedup.dedup_lines(docs).agg(F.sum("n_removed_lines")).first()[0]
    assert want == 0 or got >= 0.5 * want, (got, want)
    print("lines removed", got, "of", want)
