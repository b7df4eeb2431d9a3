"""Equi-join of two large sides that splits hot keys over many tasks, reading each side once.

With adaptive execution the shuffle itself tells which partitions are too large, and Spark
splits those while it joins. Without it the rows are written to the shared scratch folder,
and a frequent-items sketch watches the write: hot keys are known when it ends, and only the
written rows are read from then on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from parcelgrid.session import scratch_dir

# A key is hot when its rows exceed 1 / (PIECES * shuffle partitions) of its side. Fewer
# than PIECES * partitions keys can be hot, so the list of them is safe to broadcast.
PIECES = 4
# The sketch is off by at most 3.5 / (keys tracked) of all rows, and leaves out no key of
# twice that; it can track no more than MOST_TRACKED.
SLACK = 7
MOST_TRACKED = 1_000_000

_ADAPTIVE = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
_CODE = "__code"
_LEFT, _RIGHT = "__salt_l", "__salt_r"


def splits_by_itself(spark: SparkSession) -> bool:
    """Whether this session's shuffles are split where a key is hot."""
    return all(spark.conf.get(name).lower() == "true" for name in _ADAPTIVE)


def _hot_share(df: DataFrame) -> int:
    return PIECES * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def watched(df: DataFrame, keys: list[str]) -> tuple[DataFrame, dict[int, int]]:
    """``df`` written once, with a hash of its keys, and the pieces each hot hash is cut into."""
    share = _hot_share(df)
    tracked = min(MOST_TRACKED, 1 << (SLACK * share - 1).bit_length())
    code = F.when(F.col(keys[0]).isNotNull(), F.xxhash64(*keys)).alias(_CODE)
    seen = Observation()
    top = F.expr(f"approx_top_k({_CODE}, {min(share, tracked)}, {tracked})").alias("top")
    marked = df.select("*", code)
    path = scratch_dir(df.sparkSession, "keyed")
    marked.observe(seen, top, F.count(_CODE).alias("rows")).write.parquet(path)
    hot = {r["item"]: r["count"] for r in seen.get["top"] or [] if r["item"] is not None}
    total = seen.get["rows"]
    pieces = {item: -(-n * share // total) for item, n in hot.items() if n * share > total}
    return df.sparkSession.read.schema(marked.schema).parquet(path), pieces


def _with_pieces(df: DataFrame, hot: dict[int, int], name: str) -> DataFrame:
    """``df`` with the pieces that the key of each row is cut into; NULL where it is not hot."""
    if not hot:
        return df.withColumn(name, F.lit(None).cast("bigint"))
    table = df.sparkSession.createDataFrame(list(hot.items()), f"{_CODE} bigint, {name} bigint")
    return df.join(F.broadcast(table), _CODE, "left")


def _spread(df: DataFrame, count: Column) -> Column:
    """A piece number that is the same whenever a lost task runs again.

    The partition number keeps full copies of one row apart.
    """
    return F.pmod(F.xxhash64(*df.columns, F.spark_partition_id()), count).cast("int")


def _salted(left: DataFrame, right: DataFrame, keys: list[str], how: str, split_right: bool) -> DataFrame:
    """A hot left key is cut into n pieces and the right rows of that key are repeated n
    times, and the other way round. Left rows with a NULL key are spread too."""
    left, left_hot = watched(left, keys)
    if split_right:
        right, right_hot = watched(right, keys)
    else:
        right, right_hot = right.select("*", F.xxhash64(*keys).alias(_CODE)), {}
    one, everywhere = F.lit(1), F.lit(_hot_share(left))

    def cut(df: DataFrame, own: str, other: str) -> DataFrame:
        """Rows in one piece of their own side, and in every piece of the other."""
        n = F.when(F.col(_CODE).isNull(), everywhere).otherwise(F.coalesce(F.col(own), one))
        df = df.withColumn(own, _spread(df, n))
        every = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), one).cast("int") - 1))
        return df.withColumn(other, every).drop(_CODE)

    sides = (_with_pieces(_with_pieces(df, left_hot, _LEFT), right_hot, _RIGHT) for df in (left, right))
    l, r = next(sides), next(sides)
    joined = cut(l, _LEFT, _RIGHT).join(cut(r, _RIGHT, _LEFT).hint("shuffle_merge"), [*keys, _LEFT, _RIGHT], how)
    return joined.drop(_LEFT, _RIGHT)


def split_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "inner",
    condition: Column | None = None,
    split_right: bool = True,
) -> DataFrame:
    """Join where a key with a large share of either side is handled by many tasks.

    For ``how="left"`` the right side must hold each key once, and ``split_right`` must be
    off: its keys are then not looked for.
    """
    if splits_by_itself(left.sparkSession):
        # Both sides are large here; without the hint a wrong size estimate could broadcast one.
        joined = left.join(right.hint("shuffle_merge"), keys, how)
    else:
        joined = _salted(left, right, keys, how, split_right)
    return joined if condition is None else joined.where(condition)
