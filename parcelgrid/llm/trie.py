"""Prefix trie of conversations, by digests of fixed-length blocks of turns.

Every turn becomes a digest, every ``BLOCK`` turns a block with a digest of its own, every
``BLOCK`` blocks a block of the next level, until a conversation is one block. From the top
down, each block learns the name of the prefix it starts from: a digest of the whole blocks
before it, one level inside the other, so a conversation of any length is named in a few
joins and no task holds more than ``BLOCK`` pieces of it. Conversations are then grouped by
(prefix, block): copies collapse here, before any turn is looked at. Only where several
blocks follow one prefix are the turn boundaries inside them compared; a block without
siblings gives its turns as they stand. Sums over subtrees run over blocks first, by
doubling the distance to the ancestor, and then over the turns inside each block.

Digests are the first 128 bits of SHA-256, in hexadecimal; equal ones count as equal turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelgrid.llm.common import join_keyed, materialize

BLOCK = 8
SHARED = 20  # the contract's conversations in a row that share first turns
ENDS = 50_000  # ids joined to one piece of text
_SHORT = 32


def _digest(text: Column) -> Column:
    return F.substring(F.sha2(text.cast("binary"), 256), 1, _SHORT)


def _name(start: Column, digests: Column) -> Column:
    """Digest of a prefix: the one it starts from and what follows."""
    return _digest(F.concat(start, F.lit("/"), F.array_join(digests, "")))


def numbered(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns: conv_id, at, digest, words; conversations: conv_id, n_turns); ``at`` counts from 0.

    Turns are ordered by ``turn``, null first, and those of one number by the digest of role
    and text, so that the order of rows does not matter. Null roles and texts are empty; rows
    with a null conv_id take no part. One sort over all rows places them, so a conversation
    may span tasks: a turn's number is its place in its task's share plus the shares before.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id IS NOT NULL").select(
        "conv_id",
        "turn",
        _digest(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words"),
        F.monotonically_increasing_id().alias("tie"),  # equal turns too are spread over tasks
    )
    turns = materialize(turns, "turn-digests")  # placing them reads them twice, texts only once
    order = [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("digest"), F.asc("tie")]
    tasks = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = turns.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    rows = placed.select("conv_id", "digest", "words", F.monotonically_increasing_id().alias("place"))
    rows = materialize(rows.select("*", F.shiftright("place", 33).alias("task")), "turns")
    shares = rows.groupBy("conv_id", "task").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    shares = materialize(shares, "shares")
    before = Window.partitionBy("conv_id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    shift = (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift")
    shifts = shares.select("conv_id", "task", shift)
    at = (F.col("place") + F.col("shift")).alias("at")
    turns = rows.join(shifts, ["conv_id", "task"]).select("conv_id", at, "digest", "words")
    return turns, shares.groupBy("conv_id").agg(F.sum("n").alias("n_turns"))


def rebuilt(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations of the query contract, in the form of ``numbered``.

    Conversation c starts with the first h turns of c - c % 20, if there is one, and goes on
    with its own turns after its first h; h is crc32 of c in decimal, modulo 4.
    """
    turns = materialize(turns, "numbered")
    base = (F.col("conv_id") - F.col("conv_id") % SHARED).alias("base")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).alias("h")
    heads = convs.select(F.col("conv_id").alias("base"), F.col("n_turns").alias("given"))
    given = F.least("h", F.coalesce("given", F.lit(0)))
    plan = convs.select("conv_id", "n_turns", base, h).join(heads, "base", "left").select(
        "conv_id", "base", "h", given.alias("given"),
        (given + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))).alias("n_turns"),
    )
    plan = materialize(plan, "rebuilt-plan")
    own = join_keyed(turns, plan.drop("base"), ["conv_id"]).where("at >= h")
    own = own.withColumn("at", F.col("at") - F.col("h") + F.col("given"))
    # at most three turns meet at most twenty conversations under one key
    first = turns.where("at < 3").withColumnRenamed("conv_id", "base").join(plan, "base").where("at < given")
    columns = ["conv_id", "at", "digest", "words", "n_turns"]
    return own.select(columns).union(first.select(columns)), plan.select("conv_id", "n_turns")


def _blocks(turns: DataFrame) -> DataFrame:
    """Turns by BLOCK: (conv_id, k, items, own digest, last); at most BLOCK rows in a group."""
    item = F.struct("at", "digest", "words")
    block = turns.groupBy("conv_id", F.expr(f"at div {BLOCK}").alias("k")).agg(
        F.array_sort(F.collect_list(item)).alias("items"), F.max("n_turns").alias("n_turns")
    )
    own = _name(F.lit("0"), F.col("items.digest")).alias("own")
    return block.select("conv_id", "k", "items", own, (F.col("n_turns") <= (F.col("k") + 1) * BLOCK).alias("last"))


def _starts(blocks: DataFrame) -> DataFrame:
    """(conv_id, k, start, next) of every block but the first of a conversation."""
    # conversations of one block need no level above
    lone = F.col("last") & (F.col("k") == 0)
    levels = [blocks.where(~lone).select("conv_id", "k", "own")]
    while (levels[-1].agg(F.max("k")).first()[0] or 0) > 0:
        item = F.array_sort(F.collect_list(F.struct("k", "own")))
        above = levels[-1].groupBy("conv_id", F.expr(f"k div {BLOCK}").alias("up")).agg(item.alias("items"))
        above = above.select("conv_id", F.col("up").alias("k"), F.col("items.own").alias("items"))
        own = _name(F.lit(str(len(levels))), F.col("items")).alias("own")
        levels.append(materialize(above.select("*", own), "blocks-above"))
    whole = F.when(F.size("items") == BLOCK, _name(F.lit(""), F.col("items")))
    if len(levels) == 1:
        return blocks.limit(0).select("conv_id", "k", F.lit("").alias("start"), F.lit("").alias("next"))
    level = levels.pop().select("conv_id", "k", "items", F.lit("").alias("start"), whole.alias("next"))
    while True:
        upto = lambda j: _name(F.col("start"), F.slice("items", 1, j))
        child = level.select("conv_id", "k", "items", "start", "next", F.explode(F.sequence(F.lit(0), F.size("items") - 1)).alias("j"))
        below = child.select(
            "conv_id",
            (F.col("k") * BLOCK + F.col("j")).alias("k"),
            F.when(F.col("j") == 0, F.col("start")).otherwise(upto(F.col("j"))).alias("start"),
            F.when(F.col("j") == BLOCK - 1, F.col("next")).otherwise(upto(F.col("j") + 1)).alias("next"),
        )
        level = levels.pop()
        if not levels:
            return below.where("k > 0")
        level = level.select("conv_id", "k", "items").join(below, ["conv_id", "k"])


def _located(blocks: DataFrame) -> DataFrame:
    """Blocks with ``start``, the prefix they follow, and ``next``, the one they end, if whole."""
    after = _name(F.lit(""), F.array("own"))
    first = blocks.where("k = 0").select("*", F.lit("").alias("start"), after.alias("next"))
    return first.unionByName(blocks.where("k > 0").join(_starts(blocks), ["conv_id", "k"]))


def _turn_nodes(edges: DataFrame) -> DataFrame:
    """Nodes inside blocks: turn boundaries are compared only where blocks share their start."""
    fans = edges.groupBy("start").agg((F.count(F.lit(1)) > 1).alias("diverges"))
    path = F.expr("sequence(1, size(items))")
    path = F.transform(
        path,
        lambda j: F.when(j == BLOCK, F.col("next")).otherwise(_name(F.col("start"), F.slice("items.digest", 1, j))),
    )
    met = join_keyed(edges, fans, ["start"])
    met = met.select("start", "k", "conv_id", "n", "items", "diverges", F.explode(F.array(path)).alias("path"))
    met = met.select("*", F.explode(F.sequence(F.lit(1), F.size("items"))).alias("j"))
    node = met.select(
        F.element_at("path", F.col("j")).alias("node"),
        F.when(F.col("j") == 1, F.col("start")).otherwise(F.expr("path[j - 2]")).alias("parent"),
        "start",
        F.slice("path", F.lit(1), F.col("j")).alias("up"),
        (F.col("k") * BLOCK + F.col("j")).alias("depth"),
        F.expr("items[j - 1].words").alias("words"),
        "conv_id",
        "n",
        "diverges",
    )
    one = [F.first(c).alias(c) for c in ("parent", "start", "up", "depth", "words")]
    shared = node.where("diverges").groupBy("node").agg(*one, F.min("conv_id").alias("conv_id"), F.sum("n").alias("n"))
    return node.where("NOT diverges").drop("diverges").unionByName(shared)


def _below(blocks: DataFrame) -> DataFrame:
    """(start, leaves, saved): sums over all blocks below each start, itself included.

    ``blocks`` has (start, ancestor, leaves, saved). After round r a row sums up what is less
    than 2^r blocks below, and ``ancestor`` is 2^r blocks above; so rounds are few.
    """
    state = materialize(blocks, "block-sums")
    while not (far := state.where("ancestor IS NOT NULL")).isEmpty():
        more = far.groupBy(F.col("ancestor").alias("start")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
        )
        hop = state.select(F.col("start").alias("ancestor"), F.col("ancestor").alias("hop"))
        hopped = join_keyed(far, hop, ["ancestor"]).select("start", F.col("hop").alias("ancestor"), "leaves", "saved")
        moved = hopped.unionByName(state.where("ancestor IS NULL")).join(more, "start", "left")
        leaves, saved = (F.col(c) + F.coalesce(f"more_{c}", F.lit(0)) for c in ("leaves", "saved"))
        state = materialize(moved.select("start", "ancestor", leaves.alias("leaves"), saved.alias("saved")), "block-sums")
    return state.drop("ancestor")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conv_id) to pieces (node, first, ids): a piece is at most ENDS ids of a node."""
    node, first, ids = None, None, []

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"node": [node], "first": [first], "ids": [",".join(ids)]}, schema=_PIECE)

    for batch in batches:
        for name, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if name != node or len(ids) == ENDS:
                if ids:
                    yield piece()
                node, first, ids = name, conv, []
            ids.append(str(conv))
    if ids:
        yield piece()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to (node, ends_sha256); holds one piece and the state of one hash."""
    node, state = None, None
    names, sums = [], []
    for batch in batches:
        for name, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if name == node:
                state.update(f",{ids}".encode())
                continue
            if state:
                names.append(node)
                sums.append(state.hexdigest())
            node, state = name, hashlib.sha256(ids.encode())
        yield pa.RecordBatch.from_pydict({"node": names, "ends_sha256": sums}, schema=_SUM)
        names, sums = [], []
    if state:
        yield pa.RecordBatch.from_pydict({"node": [node], "ends_sha256": [state.hexdigest()]}, schema=_SUM)


_PIECE = pa.schema([("node", pa.string()), ("first", pa.int64()), ("ids", pa.string())])
_SUM = pa.schema([("node", pa.string()), ("ends_sha256", pa.string())])


def _end_hashes(ends: DataFrame) -> DataFrame:
    """SHA-256 of each node's ids in ascending order.

    The ids of a node that ends many conversations are sorted and joined in many tasks; only
    the hash itself, which has no parts, runs over them in one, piece by piece.
    """
    tasks = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ends = ends.repartitionByRange(tasks, "node", "conv_id").sortWithinPartitions("node", "conv_id")
    pieces = sorted_ends.mapInArrow(_joined, "node string, first bigint, ids string")
    pieces = pieces.repartition(tasks, "node").sortWithinPartitions("node", "first")
    return pieces.mapInArrow(_hashed, "node string, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node, that is, per distinct sequence of first turns; the root has none.

    ``turns`` (conv_id, at, digest, words, n_turns) holds turn ``at``, from 0, of each
    conversation; ``convs`` (conv_id, n_turns) every conversation once, turnless ones too;
    ids are integers. Columns: conv_id, the smallest member; depth; parent_conv_id;
    n_convs, members; n_children; n_leaves, childless nodes of the subtree, itself included;
    saved_tokens, over the subtree, the words of a node's last turn times its members but one;
    ends_sha256, of the members that end there, ascending and comma-joined. Without
    conversations there is no node, and the result is empty.
    """
    blocks = materialize(_blocks(turns), "blocks")
    located = materialize(_located(blocks), "located")
    members = F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n")
    one = [F.first(c).alias(c) for c in ("k", "items", "next")]
    edges = materialize(located.groupBy("start", "own").agg(*members, *one), "edges")
    inner = _turn_nodes(edges)
    root = convs.agg(*members).where("n > 0").select(
        F.lit("").alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(None).cast("string").alias("start"),
        F.array(F.lit("")).alias("up"), F.lit(0).cast("bigint").alias("depth"), F.lit(0).cast("bigint").alias("words"),
        "conv_id", "n",
    )
    nodes = materialize(inner.unionByName(root), "nodes")
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    leaf = (F.col("n_children") == 0).cast("bigint").alias("leaves")
    counted = materialize(counted.select("*", leaf, ((F.col("n") - 1) * F.col("words")).alias("saved")), "counted")

    sums = F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
    per_block = counted.where("start IS NOT NULL").groupBy("start").agg(*sums)
    above = counted.select(F.col("node").alias("start"), F.col("start").alias("ancestor"))
    below = _below(per_block.join(above, "start"))
    below = below.select(F.col("start").alias("node"), F.col("leaves").alias("more"), F.col("saved").alias("more_saved"))
    whole = counted.select("node", "up", "leaves", "saved").join(below, "node", "left")
    leaves, saved = F.col("leaves") + F.coalesce("more", F.lit(0)), F.col("saved") + F.coalesce("more_saved", F.lit(0))
    passed = whole.select(F.explode("up").alias("node"), leaves.alias("leaves"), saved.alias("saved"))
    subtree = passed.groupBy("node").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))

    end = F.when(F.size("items") == BLOCK, F.col("next")).otherwise(_name(F.col("start"), F.col("items.digest")))
    ends = located.where("last").select(end.alias("node"), "conv_id")
    ends = ends.union(convs.where("n_turns = 0").select(F.lit("").alias("node"), "conv_id"))

    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    plain = counted.select("node", "parent", "depth", "conv_id", "n", "n_children")
    named = join_keyed(plain.where("parent IS NOT NULL"), parents, ["parent"])
    top = plain.where("parent IS NULL").withColumn("parent_conv_id", F.lit(None).cast("bigint"))
    rows = named.unionByName(top).join(subtree, "node").join(_end_hashes(ends), "node", "left")
    return rows.select(
        "conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations (conv_id, turn, role, text) as they are; see ``numbered``."""
    turns, convs = numbered(conversations)
    turns = join_keyed(materialize(turns, "numbered"), convs, ["conv_id"])
    return prefix_trie(turns, convs)


ORACLE = r"""
WITH RECURSIVE steps(i, v, n) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL
  SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, n + 1 FROM steps WHERE n < 8),
bytes AS (SELECT i, v FROM steps WHERE n = 8),
crc(c, p, v) AS (
  SELECT DISTINCT conv_id, 0, 4294967295 FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL
  SELECT c, p + 1, xor(crc.v >> 8, bytes.v) FROM crc
  JOIN bytes ON bytes.i = xor(crc.v, ascii(substr(c::VARCHAR, p + 1, 1))::BIGINT) & 255
  WHERE p < length(c::VARCHAR)),
h AS (SELECT c, xor(v, 4294967295) % 4 AS h FROM crc WHERE p = length(c::VARCHAR)),
t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
size AS (SELECT c, count(*) AS n FROM t GROUP BY c),
plan AS (
  SELECT h.c, h, h.c - h.c % 20 AS base, least(h, coalesce(b.n, 0)) AS given, size.n
  FROM h JOIN size USING (c) LEFT JOIN size b ON b.c = h.c - h.c % 20),
r AS (
  SELECT c, pos - h + given + 1 AS d, role, text FROM t JOIN plan USING (c) WHERE pos >= h
  UNION ALL
  SELECT plan.c, pos + 1, role, text FROM plan JOIN t ON t.c = base WHERE pos < given),
p AS (
  SELECT c, d, text, string_agg(sha256(strlen(role) || ':' || role || text), '') OVER (PARTITION BY c ORDER BY d) AS path FROM r
  UNION ALL SELECT c, 0, '', '' FROM plan),
last AS (SELECT c, max(d) AS d FROM p GROUP BY c),
node AS (
  SELECT path, d, min(c) AS conv_id, count(*) AS n_convs,
         len(regexp_extract_all(any_value(text), '[^\x20\x09-\x0D]+')) AS words
  FROM p GROUP BY path, d),
up AS (SELECT node.*, q.path AS parent FROM node LEFT JOIN p q ON q.c = node.conv_id AND q.d = node.d - 1),
kids AS (SELECT parent, count(*) AS n_children FROM up WHERE parent IS NOT NULL GROUP BY parent),
sub AS (
  SELECT a.path, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves, sum((n_convs - 1) * words) AS saved_tokens
  FROM node JOIN p a ON a.c = node.conv_id AND a.d <= node.d LEFT JOIN kids ON kids.parent = node.path
  GROUP BY a.path),
ends AS (
  SELECT path, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends_sha256
  FROM p JOIN last USING (c, d) GROUP BY path)
SELECT up.conv_id, up.d AS depth, parents.conv_id AS parent_conv_id, up.n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves, saved_tokens::BIGINT AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM up JOIN sub ON sub.path = up.path LEFT JOIN kids ON kids.parent = up.path LEFT JOIN ends ON ends.path = up.path
LEFT JOIN node parents ON parents.path = up.parent
"""
