"""Exact and near duplicates, and repeated passages."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from parcelgrid.llm import components, exact_dedup, line_dedup, simhash
from parcelgrid.llm.common import join_keyed
from pyspark.sql import functions as F


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def exact_by_force(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[plain(t)].append((-len(t or ""), i is None, i or 0, i))
    out = []
    taken = set()
    for i, t in rows:
        best = min(groups[plain(t)])
        stays = (-len(t or ""), i is None, i or 0, i) == best and plain(t) not in taken
        if stays:
            taken.add(plain(t))
        out.append((i, best[3], len(groups[plain(t)]), stays, hashlib.sha256(plain(t).encode()).hexdigest()))
    return Counter(out)


def test_exact_duplicates(docs, awkward):
    body = "First one. Second one! A third? " * 30
    rows = awkward + [
        (20, body), (21, body.replace(" ", "  ")), (22, body + "."), (23, body.replace(" ", "\n")), (19, body),
        (24, body.replace(" ", " ")), (25, "A" + body), (26, "Samerow"), (27, "s amerow"),
    ]
    got = exact_dedup.exact_duplicates(docs(rows)).collect()
    assert Counter(map(tuple, got)) == exact_by_force(rows)


def test_one_row_of_repeated_rows_stays(docs):
    rows = [(1, "same text"), (1, "same text"), (1, "sametext"), (None, "other"), (None, "other"), (1, "unlike")]
    got = exact_dedup.exact_duplicates(docs(rows)).where("kept").collect()
    assert Counter((r.keep_id, r.group_size) for r in got) == Counter([(1, 3), (None, 2), (1, 1)])


def test_exact_duplicates_empty_and_clashing_columns(docs):
    empty = exact_dedup.exact_duplicates(docs([]))
    assert empty.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"] and empty.count() == 0
    clash = docs([(1, "a"), (2, "a ")]).withColumns({c: F.lit(0) for c in ("chunks", "recipe", "kept", "group_size", "best")})
    assert [r.keep_id for r in exact_dedup.exact_duplicates(clash).collect()] == [2, 2]


def test_identifiers_are_drawn_anew_when_two_chunks_share_one(docs, monkeypatch):
    asked = []
    real = exact_dedup._ambiguous

    def shared(rows, seed):
        asked.append(seed)
        return seed < 2 or real(rows, seed)

    monkeypatch.setattr(exact_dedup, "_ambiguous", shared)
    got = exact_dedup.exact_duplicates(docs([(1, "a. b"), (2, "a.b")])).collect()
    assert asked == [0, 1, 2] and {r.keep_id for r in got} == {1}


def print_by_force(text, size):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    size = min(size, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + size]).encode(), 42) for i in range(len(words) - size + 1)]
    return sum((2 * sum(h >> j & 1 for h in hashes) > len(hashes)) << j for j in range(64))


def near_by_force(rows, bits):
    prints = [print_by_force(t, 3) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return Counter((d, f"{p:016x}", least.get(find(i))) for i, ((d, _), p) in enumerate(zip(rows, prints)))


def test_near_duplicates(docs, awkward):
    random.seed(5)
    words = ["w%d" % i for i in range(400)]
    rows = list(awkward)
    for group in range(6):
        text = random.choices(words, k=250)
        for copy in range(5):
            changed = list(text)
            changed[random.randrange(250)] = "new%d" % copy
            rows.append((100 + 10 * group + copy, " ".join(changed)))
    got = simhash.near_duplicates(docs(rows)).collect()
    assert Counter(map(tuple, got)) == near_by_force(rows, 2)


def test_near_duplicates_of_nothing(docs):
    assert simhash.near_duplicates(docs([])).count() == 0


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_anchors_cover_every_pair(bits):
    rng = np.random.default_rng(bits)
    tables = simhash.error_patterns(bits)
    a = rng.integers(-(2**63), 2**63 - 1, 300)
    flips = np.array([sum(1 << int(b) for b in rng.choice(63, bits, replace=False)) for _ in a], np.int64)
    ia, anchor_a, home = simhash.anchors(a, bits, tables)
    ib, anchor_b, _ = simhash.anchors(a ^ flips, bits, tables)
    assert (np.bincount(ia[home], minlength=300) == 1).all()
    at_home = dict(zip(ia[home].tolist(), anchor_a[home].tolist()))
    reached = defaultdict(set)
    for i, x in zip(ib.tolist(), anchor_b.tolist()):
        reached[i].add(x)
    assert all(at_home[i] in reached[i] for i in range(300))


def test_links_of_large_and_small_anchors_connect_the_same():
    rng = np.random.default_rng(1)
    fp = np.unique(rng.integers(0, 2**9, 300)).astype(np.int64)
    home = np.ones(len(fp), bool)
    pairs = simhash.links(np.zeros(len(fp), np.int64), fp, home, 1)
    assert len(pairs) < len(fp)  # a spanning set, not all pairs
    root = {x: x for x in fp.tolist()}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        assert (a ^ b).bit_count() >= 1
        root[find(a)] = find(b)
    for a in fp.tolist():
        for b in fp.tolist():
            if (a ^ b).bit_count() == 1:
                assert find(a) == find(b)


def test_components_of_a_long_path(spark):
    order = list(range(200))
    random.Random(3).shuffle(order)
    edges = [(order[i], order[i + 1]) for i in range(199) if i != 99] + [(7, 7)]
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "u long, v long")).collect()))
    want = {x: min(part) for part in (order[:100], order[100:]) for x in part}
    assert got == want
    none = components.components(spark.createDataFrame([], "u long, v long"))
    assert none.count() == 0


PASSAGE = "\n".join(f"shared line number {i} of the passage" for i in range(12))


def test_repeated_passages_go_but_the_first(docs):
    own = lambda i: "\n".join(f"own {i} {k}" for k in range(5))
    rows = [(i, f"{own(i)}\n{PASSAGE}\n{own(i + 50)}") for i in range(6)] + [(40, own(99))]
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs(rows)).collect()}
    assert got[0].text == rows[0][1] and got[0].n_removed_lines == 0 and got[40].text == own(99)
    for i in range(1, 6):
        # what is left out is part of the passage, and most of it is left out
        assert got[i].n_removed_lines >= 6 and got[i].n_lines == 22
        assert all(f"own {i} {k}" in got[i].text and f"own {i + 50} {k}" in got[i].text for k in range(5))
        assert len(got[i].text.split("\n")) == 22 - got[i].n_removed_lines


def test_lines_of_awkward_texts_stay(docs, awkward):
    got = line_dedup.dedup_lines(docs(awkward)).collect()
    kept = [(r.doc_id, r.text) for r in got if not r.n_removed_chunks]
    rows = Counter((i, t or "") for i, t in awkward)
    assert len(got) == len(awkward) and all(rows[x] for x in kept)
    assert {r.doc_id for r in got if r.n_removed_chunks} <= {10}
    assert line_dedup.dedup_lines(docs([])).count() == 0


def test_single_lines_and_repeats_within_a_text(docs):
    got = line_dedup.dedup_lines(docs([(1, "one line"), (2, "one line"), (3, f"{PASSAGE}\n{PASSAGE}")])).collect()
    text = {r.doc_id: r for r in got}
    assert text[1].n_removed_chunks == text[2].n_removed_chunks == 0
    assert text[3].n_removed_lines >= 6 and text[3].text.startswith(PASSAGE)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_keys_meet_their_row_in_many_tasks(spark, how):
    rows = [(0, i) for i in range(4000)] + [(1 + i % 500, i) for i in range(2000)]
    rows = spark.createDataFrame(rows, "k int, x int").repartition(8)
    keyed = spark.createDataFrame([(k, f"value {k}") for k in range(0, 700, 2)], "k int, value string")
    joined = join_keyed(rows, keyed, ["k"], how)
    assert joined.columns == ["k", "x", "value"]
    want = rows.join(keyed, ["k"], how)
    assert Counter(joined.collect()) == Counter(want.collect())
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tasks = join_keyed(rows, keyed, ["k"], how).where("k = 0").select(F.spark_partition_id()).distinct()
        assert tasks.count() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_keyed_join_of_nothing(spark):
    rows = spark.createDataFrame([], "k int, x int")
    keyed = spark.createDataFrame([(1, "a")], "k int, value string")
    assert join_keyed(rows, keyed, ["k"], "left").collect() == []
    assert join_keyed(keyed, rows, ["k"]).collect() == []
