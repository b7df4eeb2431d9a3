"""Secrets, and whether they are somebody's own: ownership frequency over the whole corpus.

Three base patterns, and a broad one for key-like tokens, give candidates. Their hashes are
counted over the corpus by distinct repositories and owners. What many owners hold is a
copied example; what one or few hold and looks random is likely live. Base spans always
stay; key-like tokens are added only if they look live and overlap no base span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelgrid.llm.common import doc_text, join_keyed
from parcelgrid.llm.spans import find_spans, span_list

# The patterns of the contract. Loops are possessive where nothing that
# follows could make them give back, so long runs need no deep recursion.
ASSIGN = (
    r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"""
    r"""|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]++"""
)
VALUE = r"""^[A-Za-z_]+["']?\x20*[:=]\x20*["']?(.*)$"""
ACCESS = r"AKIA[A-Z0-9]++"
HEX = r"[0-9a-f]{16,}+"  # a shorter run never passes, and runs do not overlap
TOKEN = r"[A-Za-z0-9+/_=-]{20,}+"
BASE = ["assign", "access", "hex"]
KINDS = [*BASE, "token"]


def _base_fits(found: Column, kind: Column) -> Column:
    long_value = F.char_length(F.regexp_extract(found, VALUE, 1)) >= 12
    return F.when(kind == "assign", long_value).when(kind == "access", F.char_length(found) >= 18).otherwise(
        kind == "hex"
    )


def _looks_random(value: Column) -> Column:
    """Digits mixed with letters, and many different characters for its length."""
    different = F.size(F.array_distinct(F.split(value, "")))
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    return mixed & (different >= F.least(F.lit(8), F.char_length(value) / 2))


def scan_secrets(
    docs: DataFrame, owner: str = "source", repository: str = "source", copied_by: int = 3
) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied.

    ``base_sha256`` is over the base spans, ``spans`` lists all (kind:start:end by start, then
    kind as listed, comma-joined; empty for none). A candidate held by ``copied_by`` or more
    owners, or by as many repositories, is copied (``n_copied``); any other that looks random
    is likely live (``n_live``). Null texts count as empty; null owners are one owner. Repeated
    rows each give a row. An empty table gives an empty result.
    """
    text = F.col("text")
    named = text.contains("=") | text.contains(":")
    patterns = {
        "assign": (named, ASSIGN),
        "access": (text.contains("AKIA"), ACCESS),
        "hex": (F.lit(True), HEX),
        "token": (F.lit(True), TOKEN),
    }
    docs = docs.select(
        "doc_id", doc_text().alias("text"), F.col(owner).alias("owner"), F.col(repository).alias("repository")
    )
    rows, spans = find_spans(docs, patterns, ["doc_id", "owner", "repository"])
    kind = F.col("kind")
    value = F.when(kind == "assign", F.regexp_extract("found", VALUE, 1)).otherwise(F.col("found"))
    spans = spans.withColumn("value", value)
    spans = spans.withColumn("base", _base_fits(F.col("found"), kind)).where(
        F.col("base") | ((kind == "token") & _looks_random(F.col("value")))
    )
    keyed = spans.withColumn("a", F.xxhash64("value")).withColumn("b", F.xxhash64("value", F.lit(1)))
    held = keyed.join(rows, "row").select(
        "row", "a", "b", F.coalesce("owner", F.lit("")).alias("owner"), F.coalesce("repository", F.lit("")).alias("repository")
    )
    # Distinct holders first, combined before the shuffle; a hot secret is then a few rows.
    holders = held.select("a", "b", "owner", "repository").distinct()
    owned = (
        holders.groupBy("a", "b", "owner")
        .agg(F.count(F.lit(1)).alias("repositories"))
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"))
    )
    copied = F.greatest("owners", "repositories") >= copied_by
    judged = join_keyed(keyed, owned, ["a", "b"]).withColumn("copied", copied).withColumn(
        "live", ~F.col("copied") & _looks_random(F.col("value"))
    )
    inside = F.exists(
        "base_spans", lambda s: (F.col("start") < s["end"]) & (F.col("end") > s["start"])
    )
    base_spans = spans.where("base").groupBy("row").agg(
        F.collect_list(F.struct("start", "end")).alias("base_spans")
    )
    judged = judged.join(base_spans, "row", "left").where(
        F.col("base") | (F.col("live") & ~F.coalesce(inside, F.lit(False)))
    )
    count = lambda test: F.count(F.when(test, 1))
    per_row = judged.groupBy("row").agg(
        *[count(kind == k).alias(f"n_{k}") for k in BASE],
        span_list(KINDS, F.col("base")).alias("base_list"),
        span_list(KINDS).alias("spans"),
        count(F.col("live")).alias("n_live"),
        count(F.col("copied")).alias("n_copied"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    return rows.join(per_row, "row", "left").select(
        "doc_id",
        *[zero(f"n_{k}") for k in BASE],
        F.sha2(F.coalesce("base_list", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
        zero("n_live"),
        zero("n_copied"),
    )
