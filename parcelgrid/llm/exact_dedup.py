"""Exact duplicates by recipes of content-defined chunks, in built-in functions only.

The text without white space falls into sentences; a sentence whose hash ends in
``CUT_BITS`` zero bits closes a chunk, so an insertion moves no later boundary. Every chunk
gets a 128-bit identifier. All distinct chunks are brought together once, under their
identifier, and compared byte by byte; should two chunks share one, the identifiers are
drawn anew with the next seed. From then on equal identifiers mean equal bytes, and
documents are compared by their ordered identifier lists alone: texts no longer move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelgrid.llm.common import doc_text, join_keyed, materialize, once, without_blanks

CUT_BITS = 3


def with_chunks(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with an array column ``chunks``: the text without white space, cut."""
    pieces = F.split(without_blanks(doc_text(text)), r"(?<=[.!?])")
    ends = F.expr(
        "filter(sequence(1, size(_pieces)),"
        f" i -> (xxhash64(_pieces[i - 1]) & {2**CUT_BITS - 1}) = 0 or i = size(_pieces))"
    )
    chunks = F.expr(
        "transform(_ends, (last, k) -> array_join(slice(_pieces, if(k = 0, 0, _ends[k - 1]) + 1,"
        " last - if(k = 0, 0, _ends[k - 1])), ''))"
    )
    cut = once(once(docs, "_pieces", pieces), "_ends", ends)
    return once(cut, "chunks", chunks).drop("_pieces", "_ends")


def _ids(seed: int) -> tuple[Column, Column]:
    return (
        F.transform("chunks", lambda c: F.xxhash64(F.lit(2 * seed), c)),
        F.transform("chunks", lambda c: F.xxhash64(c, F.lit(2 * seed + 1))),
    )


def _ambiguous(docs: DataFrame, seed: int) -> bool:
    """Whether two different chunks of ``docs`` share an identifier under this seed."""
    chunk = with_chunks(docs).select(F.explode("chunks").alias("chunk"))
    keyed = chunk.select(
        F.xxhash64(F.lit(2 * seed), "chunk").alias("a"),
        F.xxhash64("chunk", F.lit(2 * seed + 1)).alias("b"),
        "chunk",
    )
    distinct = keyed.distinct()
    return not distinct.groupBy("a", "b").count().where("count > 1").isEmpty()


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are the same without the characters ``[\\x20\\x09-\\x0D]``; the
    row with most code points, then the smallest doc_id, stays. Null texts count as empty,
    and all empty texts are equal. A null doc_id comes after every other; ``keep_id`` is null
    only if all ids of the group are. Of rows that repeat a doc_id with equally long text the
    first as written stays, so one row of each group is ``kept``. Other columns of ``docs`` are not looked at. An
    empty table gives an empty result.
    """
    docs = docs.select("doc_id", "text")
    seed = 0
    while _ambiguous(docs, seed):
        seed += 1
    first, second = _ids(seed)
    rows = materialize(
        with_chunks(docs).select(
            "doc_id",
            F.monotonically_increasing_id().alias("row"),  # written with the row, so it stays
            F.char_length(doc_text()).alias("length"),
            F.sha2(F.array_join("chunks", ""), 256).alias("text_sha256"),
            F.struct(first.alias("a"), second.alias("b")).alias("recipe"),
        ),
        "recipes",
    )
    best = F.min(F.struct((-F.col("length")).alias("l"), F.col("doc_id").isNull().alias("n"), "doc_id", "row"))
    groups = rows.groupBy("recipe").agg(
        best.alias("best"), F.count(F.lit(1)).alias("group_size")
    )
    joined = join_keyed(rows, groups, ["recipe"])
    stays = F.col("best.row") == F.col("row")
    return joined.select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        stays.alias("kept"),
        "text_sha256",
    )


ORACLE = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
g AS (
  SELECT text_sha256, count(*) AS group_size,
         arg_min(doc_id, struct_pack(l := -n, d := doc_id)) AS keep_id
  FROM t GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) = 1 AS kept, text_sha256
FROM t JOIN g USING (text_sha256)
"""
