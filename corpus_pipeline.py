"""A corpus made ready for training: toxic, repeated and leaked documents go, the rest is packed."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelgrid.llm import decontaminate, exact_dedup, packing, simhash, toxicity
from parcelgrid.llm.common import materialize, read, remainder_of_id
from parcelgrid.llm.queries import TOKENIZER, TOXIC

_SCORE, _EVIDENCE, _LEAKS, _ROW = "_toxicity_score", "_toxicity_evidence", "_benchmark_leaks", "_row"


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` written with a number for every row: ids may be null or shared."""
    return materialize(docs.select("*", F.monotonically_increasing_id().alias(_ROW)), "numbered")


def _by_row(numbered: DataFrame) -> DataFrame:
    """Texts by row number, as the operators on documents take them."""
    return numbered.select(F.col(_ROW).alias("doc_id"), "text")


def _keep(numbered: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of ``numbered`` whose number is among the doc_id of ``rows``."""
    kept = numbered.join(rows.select(F.col("doc_id").alias(_ROW)), _ROW, "left_semi")
    return kept.select(*(c for c in numbered.columns if c != _ROW))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator scores below the threshold."""
    labels = read(spark, sf_dir, "labels")
    scored = toxicity.with_scores(docs, labels, remainder_of_id(3) != 1, names=(_SCORE, _EVIDENCE))
    return scored.where(F.col(_SCORE) < TOXIC).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    rows = _numbered(docs)
    return _keep(rows, exact_dedup.exact_duplicates(_by_row(rows)).where("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of each group of near copies."""
    rows = _numbered(docs)
    groups = simhash.near_duplicates(_by_row(rows), shingle=3, max_bits=2)
    return _keep(rows, groups.where("doc_id = component_id"))


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    benchmark = read(spark, sf_dir, "benchmark", "item_id", "text")
    found = decontaminate.with_leaks(docs, benchmark, _LEAKS)
    return found.where(F.size(_LEAKS) == 0).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left, in sequences."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_leaked),
    ("packing", pack),
]

#: Nearest examples, fingerprints, alignment and tokens are beyond SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; each but the last is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
