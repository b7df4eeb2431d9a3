"""Hard negatives, with bounds from a spanning tree of the anchors.

If two anchors are an edge e apart, their scores with a candidate c differ by at most e |c|.
So along a spanning tree of the anchors, an interval around the parent's score bounds the
child's, and only candidates whose interval reaches into a window that is still open are
scored anew; the others pass their widened interval on. An edge as long as an anchor bounds
nothing; the tree is cut there, and both sides start with full scores.

Anchors of one label, near ones together, share a shelf of about ``SHELF``; all candidates
are dealt over cells of about ``CELL`` by the hash of their row, whatever their label. Every
shelf meets every cell in one group of a cogroup, twice: for the positives, then for the
negatives, whose windows the positives give.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelgrid.llm.common import materialize

SHELF = 1024  # anchors that share a tree, about
CELL = 4096  # candidates that a shelf meets at once, about
CUT = 0.75  # edges longer than this share of the anchor's norm start a tree anew
ROOTS = 64  # trees whose roots are scored in one product
_CODE = 30  # components whose signs bring near anchors together

_TREE = pa.schema(
    [("shelf", pa.int32()), ("place", pa.int32()), ("parent", pa.int32()), ("edge", pa.float64()),
     ("row", pa.int64()), ("id", pa.int64()), ("label", pa.string()), ("vector", pa.list_(pa.int64()))]
)
_HIT = pa.schema([("anchor", pa.int64()), ("nth", pa.int32()), ("row", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])


def _matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of ``width`` whole numbers; shorter vectors end in zeros."""
    lists = vectors.combine_chunks()
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _exact(x: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as a type whose products have no rounding: floats while they are exact, else longs."""
    largest = [int(np.abs(m).max(initial=0).astype(np.uint64)) for m in (x, a)]
    most = x.shape[1] * max(largest) ** 2
    if most >= 1 << 63:
        raise ValueError("scores of these vectors may not fit a long")
    return (x.astype(float), a.astype(float)) if most < 1 << 53 else (x, a)


def spanning_forest(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent's place in it or -1, edge) of a least spanning tree, cut at long edges.

    Prim's method, one row of distances at a time. Edges are rounded up.
    """
    n = len(vectors)
    x = vectors.astype(float)
    norm2 = (x * x).sum(1)
    order, parent, edge = np.zeros(n, np.int64), np.full(n, -1), np.zeros(n)
    nearest, by = np.full(n, np.inf), np.full(n, -1)
    waiting = np.ones(n, bool)
    now = 0
    for place in range(n):
        if place:
            now = int(np.argmin(np.where(waiting, nearest, np.inf)))
            length = np.sqrt(nearest[now])
            if length <= CUT * np.sqrt(norm2[now]):
                parent[place], edge[place] = by[now], length
        order[place], waiting[now] = now, False
        apart = norm2 + norm2[now] - 2 * (x @ x[now])
        apart = np.maximum(apart, 0) + 1e-12 * (norm2 + norm2[now])
        closer = apart < nearest
        nearest[closer], by[closer] = apart[closer], place
    return order, parent, edge


def _trees(key: tuple, table: pa.Table) -> pa.Table:
    """Anchors of a shelf in an order in which parents come first, one forest for each label."""
    labels = table["label"].combine_chunks().dictionary_encode().indices.to_numpy()
    width = int(pc.max(pc.list_value_length(table["vector"])).as_py() or 0)
    x = _matrix(table["vector"], width)
    rows, parents, edges = [], [], []
    done = 0
    for label in np.unique(labels):
        own = np.nonzero(labels == label)[0]
        order, parent, edge = spanning_forest(x[own])
        rows.append(own[order])
        parents.append(np.where(parent >= 0, parent + done, -1))
        edges.append(edge)
        done += len(own)
    sorted_ = table.take(np.concatenate(rows))
    new = {"place": np.arange(done), "parent": np.concatenate(parents), "edge": np.concatenate(edges)}
    columns = [pa.array(new[f.name]).cast(f.type) if f.name in new else sorted_[f.name] for f in _TREE]
    return pa.table(columns, schema=_TREE)


Want = Callable[[int, np.ndarray, np.ndarray], np.ndarray]


def walk(
    a: np.ndarray, parent: np.ndarray, edge: np.ndarray, x: np.ndarray, want: Want
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place, candidates scored, scores) of every anchor ``a`` over the candidates ``x``.

    ``want(place, low, high)`` picks the candidates to be scored from the bounds of all.
    """
    norms = np.sqrt((x.astype(float) ** 2).sum(1))
    unit = 1e-12 * norms * np.sqrt((a.astype(float) ** 2).sum(1).max(initial=0)) + 1
    everything = np.arange(len(x))
    root = np.arange(len(a))
    for place in range(len(a)):  # parents come first
        if parent[place] >= 0:
            root[place] = root[parent[place]]
    roots = np.nonzero(parent < 0)[0]
    children = np.bincount(parent[parent >= 0], minlength=len(a))
    members: dict[int, list[int]] = {}
    for place in range(len(a)):
        members.setdefault(int(root[place]), []).append(place)
    for at in range(0, len(roots), ROOTS):
        some = roots[at : at + ROOTS]
        scores = x @ a[some].T
        for k, top in enumerate(some):
            bounds = {}
            for place in members[int(top)]:
                if place == top:
                    low = high = scores[:, k]
                    yield place, everything, scores[:, k]
                else:
                    low, high = bounds[parent[place]]
                    slack = edge[place] * norms * (1 + 1e-9) + unit
                    low, high = low - slack, high + slack
                    index = want(place, low, high)
                    exact = x[index] @ a[place]
                    low[index] = high[index] = exact
                    yield place, index, exact
                    children[parent[place]] -= 1
                    if not children[parent[place]]:
                        del bounds[parent[place]]
                if children[place]:
                    bounds[place] = low, high


def _best(scores: np.ndarray, ties: np.ndarray, k: int) -> np.ndarray:
    """The first ``k``: highest score, then lowest tie."""
    some = np.arange(len(scores))
    if len(scores) > k:
        some = np.nonzero(scores >= np.partition(scores, -k)[-k])[0]
    return some[np.lexsort((ties[some], -scores[some]))[:k]]


def _least_kept(low: np.ndarray, k: int) -> float:
    """No candidate whose upper bound is below this can be among the first ``k``."""
    return float(np.partition(low, -k)[-k]) if len(low) >= k else -np.inf


def _by_label(anchors: pa.Table, cands: pa.Table) -> Iterator[tuple]:
    """For each label of a shelf: (its anchors, candidates as arrays, which of them share it)."""
    anchors = anchors.sort_by("place")
    width = max((pc.max(pc.list_value_length(t["vector"])).as_py() or 0) for t in (anchors, cands))
    both = pa.chunked_array([*anchors["label"].chunks, *cands["label"].chunks], pa.string())
    codes = both.combine_chunks().dictionary_encode().indices.to_numpy()
    mine, theirs = codes[: len(anchors)], codes[len(anchors) :]
    x, a = _exact(_matrix(cands["vector"], width), _matrix(anchors["vector"], width))
    ids = cands["id"].combine_chunks()
    null = ids.is_null().to_numpy(zero_copy_only=False)
    rows = cands["row"].to_numpy()
    tie = np.empty(len(rows), np.int64)  # ids in order, null last
    tie[np.lexsort((rows, ids.fill_null(0).to_numpy(zero_copy_only=False), null))] = np.arange(len(rows))
    parent, edge = anchors["parent"].to_numpy(), anchors["edge"].to_numpy()
    for label in np.unique(mine):
        own = np.nonzero(mine == label)[0]
        up = np.where(parent[own] >= 0, parent[own] - own[0], -1)
        yield anchors.slice(own[0], len(own)), a[own], up, edge[own], x, theirs == label, rows, ids, tie


def _hits(found: list[tuple], rows: np.ndarray, ids: pa.Array) -> pa.Table:
    anchor = np.concatenate([np.full(len(f[2]), f[0]) for f in found]) if found else np.zeros(0, np.int64)
    nth = np.concatenate([np.full(len(f[2]), f[1]) for f in found]) if found else np.zeros(0, np.int64)
    at = np.concatenate([f[2] for f in found]) if found else np.zeros(0, np.int64)
    score = np.concatenate([f[3] for f in found]) if found else np.zeros(0)
    columns = [pa.array(anchor), pa.array(nth), pa.array(rows[at]), ids.take(pa.array(at)), pa.array(score.astype(np.int64))]
    return pa.table([c.cast(f.type) for c, f in zip(columns, _HIT)], schema=_HIT)


def _positives(k: int) -> Callable:
    """The first ``k`` candidates of an anchor's label in one cell, itself not counted."""

    def run(key: tuple, anchors: pa.Table, cands: pa.Table) -> pa.Table:
        tables = [_HIT.empty_table()]
        if len(anchors) and len(cands):
            for some, a, parent, edge, x, same, rows, ids, tie in _by_label(anchors, cands):
                at = np.nonzero(same)[0]
                own = some["row"].to_numpy()

                def want(place: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
                    return np.nonzero(high >= _least_kept(low, k + 1))[0]  # one more, for the anchor itself

                found = []
                for place, index, score in walk(a, parent, edge, x[at], want):
                    other = rows[at[index]] != own[place]
                    index, score = index[other], score[other]
                    best = _best(score, tie[at[index]], k)
                    found.append((own[place], 0, at[index[best]], score[best]))
                tables.append(_hits(found, rows, ids))
        return pa.concat_tables(tables)

    return run


def _negatives(k: int, low_share: int, high_share: int) -> Callable:
    """The first ``k`` candidates of other labels in one cell for every window of an anchor."""

    def run(key: tuple, anchors: pa.Table, cands: pa.Table) -> pa.Table:
        tables = [_HIT.empty_table()]
        if len(anchors) and len(cands):
            for some, a, parent, edge, x, same, rows, ids, tie in _by_label(anchors, cands):
                at = np.nonzero(~same)[0]
                own = some["row"].to_numpy()
                windows = [
                    {s: -(-low_share * s // high_share) for s in scores if s >= 0} for scores in some["scores"].to_pylist()
                ]

                def want(place: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
                    needed = np.zeros(len(low), bool)
                    for top, bottom in windows[place].items():
                        sure = low[(low >= bottom) & (high <= top)]
                        needed |= (high >= max(bottom, _least_kept(sure, k))) & (low <= top)
                    return np.nonzero(needed)[0]

                found = []
                for place, index, score in walk(a, parent, edge, x[at], want):
                    for nth, top in enumerate(some["scores"][place].as_py(), 1):
                        bottom = windows[place].get(top)
                        if bottom is not None:
                            fits = np.nonzero((score >= bottom) & (score <= top))[0]
                            best = fits[_best(score[fits], tie[at[index[fits]]], k)]
                            found.append((own[place], nth, at[index[best]], score[best]))
                tables.append(_hits(found, rows, ids))
        return pa.concat_tables(tables)

    return run


def _ranked(hits: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first ``k`` of all cells; each cell has sent no more than ``k``."""
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("row")]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k)


def mine(
    rows: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 5,
    window: tuple[int, int] = (80, 100),
) -> DataFrame:
    """Hard negatives of the ``rows`` (id, label, vector of longs) that ``anchors`` picks.

    A score is the inner product. An anchor's positives are the ``positives`` best other rows
    of its label; for each, the ``negatives`` best rows of other labels whose score is from
    ``window[0]``/``window[1]`` of the positive's up to it: (anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score), rank from 1. Ties go to the smaller id, a
    null id last. Rows with a null label, a null vector or a null component take no part;
    labels are compared as text, vectors of unlike length as if zeros followed the shorter. A
    negative score has no window. Repeated rows are rows of their own, as anchors too: each
    is the other's positive. Without anchors, or without rows, the result is empty. Scores
    that might not fit a long raise an error. Other columns are not looked at.
    """
    usable = "label IS NOT NULL AND vector IS NOT NULL AND forall(vector, x -> x IS NOT NULL)"
    code = F.expr(f"aggregate(slice(vector, 1, {_CODE}), 0, (s, x) -> 2 * s + CAST(x > 0 AS INT))").alias("code")
    kept = rows.where(usable).select(
        "id", F.col("label").cast("string").alias("label"), "vector", F.coalesce(anchors, F.lit(False)).alias("anchor")
    )
    kept = materialize(kept.select(F.monotonically_increasing_id().alias("row"), "*"), "vectors")
    n, m = kept.agg(F.count(F.lit(1)), F.count_if("anchor")).first()
    shelves, cells = max(1, -(-m // SHELF)), max(1, -(-n // CELL))
    columns = ["row", "id", "label", "vector"]
    chosen = kept.where("anchor").repartitionByRange(shelves, "label", code, "row")
    chosen = chosen.select(F.spark_partition_id().alias("shelf"), *columns)
    schema = "shelf int, place int, parent int, edge double, row bigint, id bigint, label string, vector array<bigint>"
    trees = materialize(chosen.groupBy("shelf").applyInArrow(_trees, schema), "anchor-trees")

    def every(count: int, name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)

    dealt = kept.select(*columns, F.pmod(F.xxhash64("row"), F.lit(cells)).cast("int").alias("cell"))
    dealt = dealt.select("*", every(shelves, "shelf")).groupBy("shelf", "cell")

    def meet(some: DataFrame, run: Callable) -> DataFrame:
        met = some.select("*", every(cells, "cell")).groupBy("shelf", "cell").cogroup(dealt)
        return met.applyInArrow(run, "anchor bigint, nth int, row bigint, id bigint, score bigint")

    best = _ranked(meet(trees, _positives(positives)), ["anchor"], positives)
    best = materialize(best.select("anchor", F.col("rank").alias("nth"), "id", "score"), "positives")
    scores = F.transform(F.array_sort(F.collect_list(F.struct("nth", "score"))), lambda p: p["score"])
    windows = best.groupBy(F.col("anchor").alias("row")).agg(scores.alias("scores"))
    wanted = trees.join(windows, "row", "left").withColumn("scores", F.coalesce("scores", F.array().cast("array<bigint>")))
    found = _ranked(meet(wanted, _negatives(negatives, *window)), ["anchor", "nth"], negatives)
    found = found.select("anchor", "nth", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    best = best.select("anchor", "nth", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    ids = trees.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return found.join(best, ["anchor", "nth"]).join(ids, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def quantized(embeddings: DataFrame) -> DataFrame:
    """(id, label, vector) of the query contract, from (vec_id, embedding, label).

    Every component becomes floor(256 x); a vector with a null or non-finite one is null.
    Where vec_id is divisible by 7, the label is the next of ten.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    vector = F.when(finite, F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)))
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    return embeddings.select(F.col("vec_id").alias("id"), label.alias("label"), vector.alias("vector"))


ORACLE = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, v.r, v.vec_id, v.label = a.label AS same,
         list_inner_product(a.e, v.e)::BIGINT AS score
  FROM v a JOIN v ON a.r <> v.r WHERE a.vec_id % 100 = 0),
positive AS (
  SELECT * FROM pair WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id, r) <= 5),
met AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.a, p.r ORDER BY n.score DESC, n.vec_id, n.r) AS rank
  FROM positive p JOIN pair n ON n.a = p.a AND NOT n.same
  WHERE 80 * p.score <= 100 * n.score AND n.score <= p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM met WHERE rank <= 5
"""
