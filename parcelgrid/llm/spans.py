"""Regex matches with their places, in built-in functions only.

``split`` and ``regexp_extract_all`` find the same leftmost matches that do not overlap; the
lengths of the pieces between them give each match's place in code points.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelgrid.llm.common import doc_text, materialize, once

TAIL = 32  # code points kept of the text before a match
_BLOCK = 64


def with_running_sums(df: DataFrame, array: str, name: str) -> DataFrame:
    """Adds the sums of a column of longs up to and with each element.

    By blocks of blocks, so that a very long array needs far fewer than n * n steps.
    """
    blocks = f"sequence(0, (size({array}) - 1) div {_BLOCK})"
    total = "aggregate({}, 0L, (s, x) -> s + x)".format
    block_sums = f"transform({blocks}, b -> {total(f'slice({array}, b * {_BLOCK} + 1, {_BLOCK})')})"
    bases = f"transform({blocks}, b -> {total('slice(_sums, 1, b)')})"
    within = f"slice({array}, i - i % {_BLOCK} + 1, i % {_BLOCK} + 1)"
    sums = f"transform({array}, (x, i) -> _bases[i div {_BLOCK}] + {total(within)})"
    df = once(once(df, "_sums", F.expr(block_sums)), "_bases", F.expr(bases))
    return once(df, name, F.expr(sums)).drop("_sums", "_bases")


def find_spans(docs: DataFrame, patterns: dict[str, tuple[Column, str]], keep: list[str]) -> tuple:
    """(rows, spans) of ``docs``, both written to the scratch folder.

    ``patterns`` maps a kind to (a cheap test that a text may hold it, a Java regex). ``rows``
    has one row per document: row (its number) and the columns ``keep``. ``spans`` has row,
    kind, start, end (code points, end exclusive), found, before (up to ``TAIL`` code points
    of the text between the last match of the kind and this one) and after (one code point).
    Null texts count as empty. The texts are read once and do not move.
    """
    found = once(docs.select(*keep, doc_text().alias("text")), "_text", F.col("text"))
    for kind, (test, pattern) in patterns.items():
        hits = F.regexp_extract_all("text", F.lit(pattern), 0)
        found = once(found, f"{kind}_found", F.when(test, hits).otherwise(F.array().cast("array<string>")))
        gaps = F.transform(
            F.split("text", pattern, -1),
            lambda g: F.struct(
                F.char_length(g).alias("n"),
                F.right(g, F.lit(TAIL)).alias("tail"),
                F.left(g, F.lit(1)).alias("head"),
            ),
        )
        found = found.withColumn(f"{kind}_gaps", F.when(F.size(f"{kind}_found") > 0, gaps))
    table = materialize(
        found.drop("text", "_text").withColumn("row", F.monotonically_increasing_id()), "matches"
    )
    parts = []
    for kind in patterns:
        steps = F.expr(
            f"transform({kind}_found, (f, i) -> CAST({kind}_gaps[i].n + char_length(f) AS BIGINT))"
        )
        some = table.where(F.size(f"{kind}_found") > 0)
        placed = with_running_sums(once(some, "steps", steps), "steps", "ends")
        each = placed.select(
            "row",
            F.explode(
                F.expr(
                    f"transform({kind}_found, (f, i) -> struct(ends[i] AS end, f AS found,"
                    f" {kind}_gaps[i].tail AS before, {kind}_gaps[i + 1].head AS after))"
                )
            ).alias("s"),
        )
        parts.append(
            each.select(
                "row",
                F.lit(kind).alias("kind"),
                (F.col("s.end") - F.char_length("s.found")).alias("start"),
                "s.end",
                "s.found",
                "s.before",
                "s.after",
            )
        )
    spans = materialize(reduce(DataFrame.unionByName, parts), "spans")
    return table.select("row", *keep), spans


def span_list(kinds: list[str], chosen: Column | None = None) -> Column:
    """Aggregate: kind:start:end of a document's spans by start, then kind as listed."""
    rank = F.array_position(F.array(*map(F.lit, kinds)), F.col("kind"))
    name = F.concat_ws(":", "kind", "start", "end")
    span = F.struct("start", rank.alias("rank"), "end", name.alias("name"))
    listed = F.sort_array(F.collect_list(span if chosen is None else F.when(chosen, span)))
    return F.array_join(F.transform(listed, lambda s: s["name"]), ",")
