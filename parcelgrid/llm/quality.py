"""Text quality by a convolutional network over bytes, in numpy.

The UTF-8 bytes of a text are cut into segments of ``SEGMENT`` bytes; two neighbours form a
chunk, so chunks overlap by half and cover the whole text. ``FILTERS`` learned filters of
``WIDTH`` bytes step over it ``STEP`` bytes at a time. Each filter's largest response in a
chunk stays; the mean and the maximum over all chunks go through one hidden layer into a
probability. The network learns from a bounded sample of labelled texts, read whole; tasks
then score every text whole, a bounded block of segments at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelgrid.llm.common import labelled_sample

SAMPLE = 4000  # labelled texts learnt from at most, half of them of each label
SAMPLE_BYTES = 24 << 20  # of their texts together at most
SAMPLE_TEXT = 1 << 20  # of one of them at most
STEPS, BATCH = 600, 32  # of the training, and texts in each
SEGMENT = 256
WIDTH, STEP = 8, 2
FILTERS, EMBED, HIDDEN = 32, 8, 24
BLOCK = 1024  # segments scored together
TEXT_BLOCK = 4 << 20  # bytes of texts scored together, or one longer text

Net = dict[str, np.ndarray]


def segments(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segments with WIDTH bytes of outlook, start positions that hold text, segments of each text).

    A text is filled up with NULs, at least WIDTH of them, so that no filter sees two texts.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    counts = (sizes + WIDTH) // SEGMENT + 1
    flat = np.zeros(counts.sum() * SEGMENT + WIDTH, np.uint8)
    first = (np.cumsum(counts) - counts) * SEGMENT
    for text, at in zip(texts, first):
        flat[at : at + len(text)] = np.frombuffer(text, np.uint8)
    rows = np.lib.stride_tricks.sliding_window_view(flat, SEGMENT + WIDTH)[::SEGMENT]
    left = np.repeat(first + sizes, counts) - np.arange(len(rows)) * SEGMENT
    return rows, np.clip(-(-left // STEP), 0, SEGMENT // STEP), counts


def tables(net: Net) -> np.ndarray:
    """What each byte value adds to each filter at each place: (WIDTH, 256, FILTERS)."""
    return np.einsum("be,wef->wbf", net["embed"], net["filter"], optimize=True).astype(np.float32)


def pair_tables(byte_tables: np.ndarray) -> np.ndarray:
    """The same for two bytes at once: (WIDTH / 2, 65536, FILTERS)."""
    pairs = byte_tables[::2, :, None, :] + byte_tables[1::2, None, :, :]
    return pairs.reshape(WIDTH // 2, 65536, FILTERS)


def _masked(out: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Responses of start positions without text count as 0, as do negative ones."""
    np.maximum(out, 0, out=out)
    for i in np.nonzero(places < out.shape[1])[0]:
        out[i, places[i] :] = 0
    return out


def responses(net: Net, table: np.ndarray, rows: np.ndarray, places: np.ndarray) -> np.ndarray:
    """(segments, start positions, filters), from the table of single bytes; for training."""
    n = SEGMENT // STEP
    out = np.broadcast_to(net["bias"], (len(rows), n, FILTERS)).astype(np.float32)
    for w in range(WIDTH):
        out += table[w][rows[:, w : w + SEGMENT : STEP]]
    return _masked(out, places)


def largest(net: Net, pairs: np.ndarray, rows: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Largest response of each filter in each segment, from the table of byte pairs."""
    two = rows[:, 0::2].astype(np.int32) * 256 + rows[:, 1::2]
    n = SEGMENT // STEP
    out = pairs[0][two[:, :n]]
    for w in range(1, WIDTH // 2):
        out += pairs[w][two[:, w : w + n]]
    out += net["bias"]
    return _masked(out, places).max(1)


def _chunks(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first segment of each chunk, its second, chunks of each text).

    A chunk starts at each segment but the last of a text of several.
    """
    ends = np.cumsum(counts)
    starts = np.ones(ends[-1], bool)
    starts[ends - 1] = counts == 1
    here, n = np.nonzero(starts)[0], np.maximum(counts - 1, 1)
    return here, np.minimum(here + 1, np.repeat(ends - 1, n)), n


def pooled(best: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(chunks, chunks of each text, mean and maximum over the chunks of each text)."""
    here, there, n = _chunks(counts)
    chunk = np.maximum(best[here], best[there])
    first = np.cumsum(n) - n
    mean = np.add.reduceat(chunk, first, 0) / n[:, None]
    return chunk, n, np.hstack([mean, np.maximum.reduceat(chunk, first, 0)])


def combined(net: Net, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hidden layer, probability) of each text."""
    hidden = np.maximum(features @ net["hidden"] + net["hidden_bias"], 0)
    score = np.clip(hidden @ net["out"] + net["out_bias"], -30, 30)
    return hidden, 1 / (1 + np.exp(-score))


def _gradients(net: Net, texts: list[bytes], labels: np.ndarray, weights: np.ndarray) -> Net:
    """Gradient of the weighted log loss; a maximum passes it on to where it was reached."""
    rows, places, counts = segments(texts)
    table = tables(net)
    out = responses(net, table, rows, places)
    at = out.argmax(1)
    best = np.take_along_axis(out, at[:, None, :], 1)[:, 0]
    chunk, n, features = pooled(best, counts)
    hidden, p = combined(net, features)
    down = ((p - labels) * weights / len(labels))[:, None]
    grad = {"out": (hidden * down).sum(0), "out_bias": down.sum(0)}
    inner = down * net["out"] * (hidden > 0)
    grad |= {"hidden": features.T @ inner, "hidden_bias": inner.sum(0)}
    to_features = inner @ net["hidden"].T
    mean, most = to_features[:, :FILTERS], to_features[:, FILTERS:]
    text = np.repeat(np.arange(len(texts)), n)
    peak = chunk == features[text, FILTERS:]
    ties = np.add.reduceat(peak, np.cumsum(n) - n, 0)
    to_chunk = mean[text] / n[text][:, None] + peak * most[text] / np.maximum(ties, 1)[text]
    here, there, _ = _chunks(counts)
    own = best[here] >= best[there]
    to_best = np.zeros_like(best)
    np.add.at(to_best, here, to_chunk * own)
    np.add.at(to_best, there, to_chunk * ~own)
    to_best *= best > 0
    grad["bias"] = to_best.sum(0)
    segment, unit = np.nonzero(to_best)
    place, value = at[segment, unit] * STEP, to_best[segment, unit]
    to_table = np.zeros((WIDTH, 256 * FILTERS))
    for w in range(WIDTH):
        byte = rows[segment, place + w].astype(np.int64)
        to_table[w] = np.bincount(byte * FILTERS + unit, value, 256 * FILTERS)
    to_table = to_table.reshape(WIDTH, 256, FILTERS)
    grad["filter"] = np.einsum("be,wbf->wef", net["embed"], to_table, optimize=True)
    grad["embed"] = np.einsum("wbf,wef->be", to_table, net["filter"], optimize=True)
    return grad


def train(texts: list[bytes], labels: np.ndarray, weights: np.ndarray, steps: int = STEPS) -> Net:
    """The network after so many steps of Adam; the same input gives the same network."""
    rng = np.random.default_rng(7)
    net: Net = {
        "embed": rng.normal(0, 0.5, (256, EMBED)),
        "filter": rng.normal(0, 1 / np.sqrt(WIDTH * EMBED), (WIDTH, EMBED, FILTERS)),
        "bias": np.zeros(FILTERS),
        "hidden": rng.normal(0, 1 / np.sqrt(2 * FILTERS), (2 * FILTERS, HIDDEN)),
        "hidden_bias": np.zeros(HIDDEN),
        "out": rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
        "out_bias": np.zeros(1),
    }
    first = {k: np.zeros_like(v) for k, v in net.items()}
    second = {k: np.zeros_like(v) for k, v in net.items()}
    order = np.zeros(0, np.int64)
    for step in range(1, steps + 1):
        if len(order) < BATCH:
            order = np.append(order, rng.permutation(len(texts)))
        some, order = order[:BATCH], order[BATCH:]
        grad = _gradients(net, [texts[i] for i in some], labels[some], weights[some])
        rate = 0.01 * (1 - 0.95 * step / steps)
        for k, g in grad.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            m = first[k] / (1 - 0.9**step)
            net[k] = net[k] - rate * m / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return net


class Scorer:
    """Scores texts with one network; any number of bytes in bounded memory."""

    def __init__(self, net: Net) -> None:
        self.net = {k: v.astype(np.float32) for k, v in net.items()}
        self.pairs = pair_tables(tables(self.net))

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        rows, places, counts = segments(texts)
        best = [
            largest(self.net, self.pairs, rows[a : a + BLOCK], places[a : a + BLOCK])
            for a in range(0, len(rows), BLOCK)
        ]
        return combined(self.net, pooled(np.concatenate(best), counts)[2])[1]


def fit(docs: DataFrame, labels: DataFrame, learn_from: Column, label: str = "quality", size: int = SAMPLE) -> Net | float:
    """The trained network; a number, the share of label 1, where one label has no text to learn from."""
    rows, shares = labelled_sample(docs, labels, learn_from, label, size, SAMPLE_BYTES, SAMPLE_TEXT)
    y = np.array([r[2] for r in rows], float)
    if len(set(y.tolist())) < 2:
        return shares.get(1, 0) / sum(shares.values()) if shares else 0.5
    texts = [t.encode("utf-8", "surrogatepass") for _, t, _ in rows]
    per_row = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    return train(texts, y, per_row)


def with_quality(
    docs: DataFrame,
    labels: DataFrame,
    learn_from: Column,
    label: str = "quality",
    size: int = SAMPLE,
    name: str = "score",
) -> DataFrame:
    """``docs`` with ``name``: the probability, 0 to 1, that ``label`` is 1.

    ``learn_from`` is a condition on ``labels`` (doc_id of any type, ``label``). Labels other
    than 0 and 1 and null ids are not learnt from; of labels that repeat an id, the greatest
    counts, and of texts that repeat one, the least. At most ``size`` labelled
    rows are learnt from (``SAMPLE_BYTES`` in all, texts over ``SAMPLE_TEXT`` left out),
    taken by the hash of their id; both labels have the same weight, so the probability is
    that among as many texts of either label. Nothing
    but the text enters a score. Null texts count as empty, and an empty text is scored like
    one chunk of nothing. Without texts of both labels all score the labelled share of 1, or
    0.5 without labels. Repeated rows each give a row; an empty table gives an empty result.
    A column of ``docs`` named like the new one is replaced.
    """
    docs = docs.drop(name)
    net = fit(docs, labels, learn_from, label, size)
    if isinstance(net, float):
        return docs.withColumn(name, F.lit(net))
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(net)
        for batch in batches:
            texts = batch.column(place).cast(pa.large_binary())
            ends = np.cumsum(pc.coalesce(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
            edges = [0, *(np.nonzero(np.diff(ends // TEXT_BLOCK))[0] + 1).tolist(), batch.num_rows]
            for a, b in zip(edges[:-1], edges[1:]):
                if a < b:
                    part = scorer.scores([t or b"" for t in texts.slice(a, b - a).to_pylist()])
                    columns = [*batch.slice(a, b - a).columns, pa.array(part, pa.float64())]
                    yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, name])

    return docs.mapInArrow(run, docs.withColumn(name, F.lit(0.0)).schema)
