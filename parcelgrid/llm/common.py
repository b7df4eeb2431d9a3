"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelgrid.session import scratch_dir

#: The white space of the query contracts: [\x20\x09-\x0D].
BLANKS = [" ", "\t", "\n", "\x0b", "\x0c", "\r"]
#: A key is hot with more than 1 / (PIECES * shuffle partitions) of all rows; so few keys can be.
PIECES = 4


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return table.select(*columns) if columns else table


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: computed once, lost executors or not."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without_blanks(text: Column) -> Column:
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def doc_text(name: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def remainder_of_id(modulus: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo; the fold rule of the query contracts."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def total_bytes(df: DataFrame, column: str = "text") -> int:
    """Bytes of one column over all rows."""
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0


def join_keyed(rows: DataFrame, keyed: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined, inner or left, with ``keyed``, which holds each key once.

    The rows of a hot key are cut into pieces by their hash, so that many tasks share them,
    and its row of ``keyed`` is repeated for each. Keys are told hot by a 64-bit hash, counted
    where the rows lie; only hashes of hot keys are broadcast, fewer than ``PIECES`` times the
    shuffle partitions. ``rows`` runs twice, so costly ones should be written before; keys must
    not be null. Which key is hot changes no row of the result.
    """
    share = PIECES * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    code = F.xxhash64(*keys).alias("_code")
    total = max(1, rows.count())
    counts = rows.groupBy(code).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") * share > total)
    hot = F.broadcast(counts.select("_code", F.ceil(F.col("n") * share / total).cast("int").alias("_pieces")))
    n = F.coalesce("_pieces", F.lit(1))
    piece = F.pmod(F.xxhash64(*rows.columns, F.spark_partition_id()), n).cast("int").alias("_piece")
    cut = rows.select("*", code).join(hot, "_code", "left").select(*rows.columns, piece)
    every = F.explode(F.sequence(F.lit(0), n - 1)).alias("_piece")
    repeated = keyed.select("*", code).join(hot, "_code", "left").select(*keyed.columns, every)
    return cut.join(repeated, [*keys, "_piece"], how).drop("_piece")


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``withColumn`` behind a generator: the optimizer copies no generator into its readers."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, learn_from: Column, label: str, size: int, total: int, one: int
) -> tuple[list[tuple], dict[int, int]]:
    """(doc_id, text, label) of a bounded sample, and labelled rows of each label 0 and 1.

    At most ``size`` labelled ids that ``learn_from`` picks from ``labels`` are taken by the
    hash of the id, up to half of them of each label; of their texts those of at most ``one``
    byte count, while there is room in ``total`` bytes, half of it for each label. Other
    labels and null ids are left out; of labels that repeat an id the greatest counts, and of
    texts that repeat one the least. Sorted by the hash of the id.
    """
    known = labels.where(f"{label} IN (0, 1) AND doc_id IS NOT NULL").where(learn_from)
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("_y"))
    shares = {r["_y"]: r.n for r in known.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = F.xxhash64("doc_id"), F.col("doc_id")
    halves = [known.where(F.col("_y") == y).orderBy(*order).limit(size // 2) for y in (0, 1)]
    # at most ``size`` ids, so they may be broadcast
    chosen = F.broadcast(halves[0].union(halves[1]))
    found = docs.select("doc_id", doc_text().alias("text")).join(chosen, "doc_id")
    found = found.where(F.octet_length("text") <= one).groupBy("doc_id", "_y").agg(F.min("text").alias("text"))
    rows = materialize(found.select(F.xxhash64("doc_id").alias("at"), "doc_id", "_y", "text"), "labelled-sample")
    listed = rows.select("at", "doc_id", "_y", F.octet_length("text").alias("n")).collect()
    room, ids = {0: total // 2, 1: total // 2}, []
    for r in sorted(listed, key=lambda r: (r["at"], r.doc_id)):
        if room[r["_y"]] >= r.n:
            room[r["_y"]] -= r.n
            ids.append(r.doc_id)
    few = rows.where(F.col("doc_id").isin(ids)).collect() if ids else []
    return [(r.doc_id, r.text, r["_y"]) for r in sorted(few, key=lambda r: (r["at"], r.doc_id))], shares
