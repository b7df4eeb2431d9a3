"""The conversation trie against one built turn by turn, conversations over several levels of blocks included."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

from parcelgrid.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, words string"


def ordered(rows):
    """Turns (role, text) of each conversation in the order of the docstring."""
    convs = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            convs[conv].append((turn is not None, turn or 0, digest, (role, text)))
    return {c: [t[-1] for t in sorted(turns)] for c, turns in convs.items()}


def rebuilt_by_force(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def trie_by_force(convs):
    class Node:
        def __init__(self, parent, turn):
            self.parent, self.turn, self.members, self.ends, self.children = parent, turn, [], [], {}
            self.depth = parent.depth + 1 if parent else 0

    root = Node(None, ("", ""))
    nodes = [root]
    for c in sorted(convs):
        node = root
        node.members.append(c)
        for turn in convs[c]:
            if turn not in node.children:
                node.children[turn] = Node(node, turn)
                nodes.append(node.children[turn])
            node = node.children[turn]
            node.members.append(c)
        node.ends.append(c)
    for node in reversed(nodes):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node.turn[1]))
        node.leaves = sum(k.leaves for k in node.children.values()) or 1
        node.saved = (len(node.members) - 1) * words + sum(k.saved for k in node.children.values())
    return Counter(
        (n.members[0], n.depth, n.parent.members[0] if n.parent else None, len(n.members), len(n.children),
         n.leaves, n.saved, hashlib.sha256(",".join(map(str, n.ends)).encode()).hexdigest())
        for n in nodes if n.members
    )


def check(spark, rows, schema=SCHEMA):
    frame = spark.createDataFrame(rows, schema)
    convs = ordered(rows)
    got = trie.prefix_trie(*trie.rebuilt(*trie.numbered(frame)))
    assert Counter(map(tuple, got.collect())) == trie_by_force(rebuilt_by_force(convs))
    plain = trie.conversation_trie(frame)
    assert Counter(map(tuple, plain.collect())) == trie_by_force(convs)
    return got


def conversation(rng, c, turns, few=3):
    return [(c, t, "user" if t % 2 == 0 else "assistant", f"say {rng.randrange(few)}\nmore", "x") for t in range(turns)]


def test_short_conversations_that_share_turns(spark):
    rng = random.Random(1)
    rows = [r for c in range(300) for r in conversation(rng, c, rng.randrange(1, 12), 2)]
    got = check(spark, rows)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def test_long_conversations_part_within_any_block(spark):
    rng = random.Random(2)
    long = conversation(rng, 0, 700, 50)
    rows = list(long)
    for c, upto in enumerate([700, 699, 512, 511, 513, 64, 63, 65, 8, 7, 9, 72, 100, 640], 20):
        rows += [(20 * c, t, role, text, "x") for _, t, role, text, _ in long[:upto]]
        rows += [(20 * c + 1, t, role, text if t < upto - 1 else "other", "x") for _, t, role, text, _ in long[: upto + 5]]
    check(spark, rows)


def test_copies_of_one_conversation(spark):
    rng = random.Random(3)
    one = conversation(rng, 0, 17, 9)
    rows = [(c, t, role, text, "x") for c in range(0, 4000, 2) for _, t, role, text, _ in one]
    rows += [r for c in range(1, 60, 2) for r in conversation(rng, c, 3)]
    check(spark, rows)


def test_ends_of_one_node_in_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "ENDS", 7)
    ids = spark.range(1, 1000).selectExpr("if(id % 3 = 0, 'a', 'b') AS node", "id * 37 % 1000 AS conv_id")
    rows = ids.collect()
    want = {n: hashlib.sha256(",".join(map(str, sorted(r.conv_id for r in rows if r.node == n))).encode()).hexdigest() for n in "ab"}
    assert dict(map(tuple, trie._end_hashes(ids.repartition(5)).collect())) == want


def test_awkward_rows(spark):
    rows = [
        (1, None, "user", "first of all", "x"), (1, 0, None, None, None), (1, 0, None, None, None), (1, 1, "user", "ä 🙂 b", "x"),
        (1, 1, "assistant", "tie", "x"), (None, 0, "user", "of nobody", "x"), (None, None, None, None, None),
        (2, 5, "us", "er", "x"), (3, 5, "user", "", "x"), (-7, 0, "user", "below nought", "x"), (0, 9, "", " \t\n\x0b\x0c\r", "x"),
        (0, 2**60, "user", "late", "x"), (4, 0, "user", "word " * 50_000, "x"), (5, 0, "user", "y" * 200_000, "x"),
        (6, 0, "user", "left out", "x"), (40, 0, "a", "b", "x"), (2**40, 0, "a", "b", "x"),
    ]
    rows += [(8, 3, "user", "same again", "x")] * 30
    check(spark, rows)


def test_nothing(spark):
    frame = spark.createDataFrame([(None, 1, "user", "of nobody", "x")], SCHEMA)
    for some in (frame, frame.limit(0)):
        assert trie.prefix_trie(*trie.rebuilt(*trie.numbered(some))).count() == 0
