"""Repeated passages of several lines, cut out once their bytes are compared.

A rolling hash over the hashes of ``WINDOW`` lines chooses where a chunk ends, so the same
passage is cut alike wherever it stands. Chunks of two or more lines that occur again
anywhere in the corpus are removed, except at their first place. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelgrid.llm.common import doc_text, join_keyed, materialize, once

WINDOW = 2
CUT = 3  # a chunk ends after about one line in so many


def _with_chunks(docs: DataFrame) -> DataFrame:
    """Adds ``chunks``: an array of (lines, n); joined by line feeds they are the text."""
    hashes = F.transform(F.col("_lines"), lambda line: F.xxhash64(line))
    window = ", ".join(f"_hashes[i - {k}]" for k in range(1, WINDOW + 1))
    ends = F.expr(
        f"filter(sequence(1, size(_lines)), i -> i = size(_lines) OR (i >= {WINDOW} AND"
        f" pmod(xxhash64({window}), {CUT}) = 0))"
    )
    chunks = F.expr(
        "transform(_ends, (last, k) -> struct(array_join(slice(_lines, if(k = 0, 0, _ends[k - 1]) + 1,"
        " last - if(k = 0, 0, _ends[k - 1])), '\\n') AS lines, last - if(k = 0, 0, _ends[k - 1]) AS n))"
    )
    cut = once(docs, "_lines", F.split(doc_text(), "\n"))
    cut = once(once(cut, "_hashes", hashes), "_ends", ends)
    return once(cut, "chunks", chunks).drop("_lines", "_hashes", "_ends")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed_lines, n_removed_chunks, text.

    A chunk stays where its doc_id is least, then (rows that share an id, or have none) where
    a hash of id and text is least, then where it comes first; null ids come last. Lines are
    parted by line feeds and compared byte for byte. Null texts count as empty, and an empty
    text is one empty line. A text of which all chunks go is empty. Rows with the same id and
    unlike texts are documents of their own. Rows equal in both are one document: what one
    loses, all lose, and a first place is one in each of them. Other columns are not looked
    at; ids may be of any type that can be ordered. An empty table gives an empty result.

    Chunks are grouped by a 128-bit hash together with their bytes. Should two different
    chunks share a hash, both stay, whatever their number.
    """
    row = ["r1", "r2"]
    text = F.coalesce("text", F.lit(""))
    hashes = (F.xxhash64(F.lit(seed), F.col("doc_id").isNull(), "doc_id", text).alias(r) for seed, r in enumerate(row))
    docs = docs.select("doc_id", "text", *hashes)
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", *row, "at")
    exploded = _with_chunks(docs).select("doc_id", *row, F.posexplode("chunks").alias("at", "chunk"))
    keyed = exploded.where("chunk.n > 1").select(
        "doc_id", *row, "at", "chunk.lines",
        F.xxhash64("chunk.lines").alias("a"), F.xxhash64("chunk.lines", F.lit(1)).alias("b"),
    )
    compared = keyed.groupBy("a", "b", "lines").agg(
        F.count(F.lit(1)).alias("n"), F.min(place).alias("first")
    )
    repeated = (
        compared.groupBy("a", "b")
        .agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.count(F.lit(1)).alias("texts"))
        .where("n > 1 AND texts = 1")
        .select("a", "b", F.struct(*(F.col(f"first.{c}") for c in (*row, "at"))).alias("first"))
    )
    places = materialize(keyed.select(*row, "at", "a", "b"), "chunk-places")
    again = join_keyed(places, repeated, ["a", "b"]).where(F.col("first") != F.struct(*row, "at"))
    gone = again.groupBy(*row).agg(F.collect_set("at").alias("gone"))
    joined = _with_chunks(docs).join(gone, row, "left")
    gone = F.coalesce("gone", F.array().cast("array<int>"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("chunks") - 1), gone)
    at = lambda places: F.transform(places, lambda i: F.get("chunks", i))
    split = once(once(joined, "kept", at(kept)), "cut", at(gone))
    total = lambda a: F.aggregate(a, F.lit(0).cast("bigint"), lambda s, c: s + c["n"])
    return split.select(
        "doc_id",
        (total(F.col("kept")) + total(F.col("cut"))).alias("n_lines"),
        total(F.col("cut")).alias("n_removed_lines"),
        F.size("cut").cast("bigint").alias("n_removed_chunks"),
        F.array_join(F.col("kept.lines"), "\n").alias("text"),
    )
