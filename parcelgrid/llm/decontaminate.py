"""Benchmark passages in documents, found within an edit budget.

Both sides are lower-cased and white space runs become one blank. Of an item of m bytes with
at most k edits in a document, at least m + 1 - q - k * q of its q-grams stand unchanged in
the document (q-gram lemma), on diagonals (place there minus place in the item) at most k
apart. So hits are counted per item in bands of 2(k + 1) diagonals that overlap by half; bands
that meet the bound are verified by alignment within the band.

A place of a document counts once in a band. A q-gram that an item holds several times thus
stands for the range of diagonals between its first and last place, and repetitive texts give
two events a place, not one entry for each pair of places; at worst a band too many is aligned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Q = 12  # bytes; two overlapping 8-byte words
RATE = 0.06  # edits allowed per byte of an item
BLOCK = 1 << 20  # bytes of documents looked at together
BENCHMARK_BYTES = 2 << 20  # of items that one pass over the documents looks for
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_FILTER_BITS = 22
PLACES = 1 << 20  # places of a document whose hits are counted at once
PIECE = 4096  # diagonals aligned at once


def normal(text: str | None) -> bytes:
    return " ".join((text or "").lower().split()).encode("utf-8", "surrogatepass")


def budget(length: int, rate: float = RATE) -> int:
    """Edits allowed: a share of the length, and few enough for the lemma to ask for a hit.

    Items of less than 2 Q bytes have none: they are found as they stand.
    """
    return max(0, min(int(rate * length), (length - Q) // Q))


def grams(data: np.ndarray) -> np.ndarray:
    """A 64-bit key for the Q bytes from every place on."""
    n = max(0, len(data) - Q + 1)
    view = lambda at: np.ndarray((n,), "<u8", data, at, (1,))
    if not n:
        return np.zeros(0, np.uint64)
    return view(0) * _C1 ^ (view(Q - 8) >> np.uint64(32)) * _C2


class Index:
    """q-grams of a block of items, each with its first and last place in every item."""

    def __init__(self, items: list[tuple], rate: float) -> None:
        # items too short for a q-gram are looked for as they stand
        self.short = [(i, t) for i, t in items if 0 < len(t) < Q]
        items = [(i, t) for i, t in items if len(t) >= Q]
        self.ids = [i for i, _ in items]
        self.texts = [t for _, t in items]
        self.length = np.array([len(t) for t in self.texts], np.int64)
        self.k = np.array([budget(len(t), rate) for t in self.texts], np.int64)
        self.bound = self.length + 1 - Q - self.k * Q
        keys = [grams(np.frombuffer(t, np.uint8)) for t in self.texts]
        key = np.concatenate([*keys, np.zeros(0, np.uint64)])
        item = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        place = np.concatenate([*[np.arange(len(k)) for k in keys], np.zeros(0, np.int64)])
        order = np.lexsort((place, item, key))
        key, item, place = key[order], item[order], place[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (item[1:] != item[:-1])
        first = np.nonzero(new)[0]
        self.item, self.low = item[first], place[first]
        self.high = place[np.append(first[1:], len(key)) - 1] if len(key) else place
        self.keys, self.first = np.unique(key[first], return_index=True)
        self.count = np.diff(np.append(self.first, len(first)))
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self.keys >> np.uint64(64 - _FILTER_BITS)] = True


def align(item: bytes, text: bytes, low: int, high: int, most: int | None = None) -> tuple[int, int, int]:
    """(edits, start, end) of the item's best place in the text on diagonals low..high.

    With ``most``, any number above it may come back where there is none of so few edits.
    """
    width = high - low + 1
    diagonals = np.arange(low, high + 1)
    big = np.int64(1) << 32
    chars = np.full(len(item) + width, -1, np.int64)  # text from place ``low`` on
    a, b = max(low, 0), min(len(text), low + len(chars))
    if b > a:
        chars[a - low : b - low] = np.frombuffer(text[a:b], np.uint8)
    outside = (diagonals < 0) | (diagonals > len(text))
    best = np.where(outside, big * (len(item) + 1), np.maximum(diagonals, 0))  # cost * big + start
    steps = np.arange(width) * big
    for i, c in enumerate(item):
        row = best + big * (chars[i : i + width] != c)
        row[:-1] = np.minimum(row[:-1], best[1:] + big)  # a byte of the item is missing
        best = np.minimum.accumulate(row - steps) + steps  # bytes of the text are extra
        if most is not None and i % 16 == 15 and best.min() // big > most:
            return most + 1, 0, 0
    at = int(np.argmin(best))
    return int(best[at] // big), int(best[at] % big), min(len(text), int(diagonals[at]) + len(item))


def _events(keys: np.ndarray, at: int, starts: np.ndarray, index: Index) -> tuple[np.ndarray, ...]:
    """(document and item, band, change) for the q-grams of places ``at`` on, summed up.

    A place adds one to all bands between its first and last, by a change at either end.
    """
    place = np.nonzero(index.filter[keys >> np.uint64(64 - _FILTER_BITS)])[0]
    slot = np.minimum(np.searchsorted(index.keys, keys[place]), len(index.keys) - 1)
    same = index.keys[slot] == keys[place]
    place, slot = place[same], slot[same]
    n = index.count[slot]
    entry = np.repeat(index.first[slot], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    place = np.repeat(place, n) + at
    item = index.item[entry]
    pair = (np.searchsorted(starts, place, "right") - 1) * len(index.ids) + item
    width = index.k[item] + 1
    low = (place - index.high[entry] + index.length[item]) // width - 1
    high = (place - index.low[entry] + index.length[item]) // width + 1
    pairs, number = np.unique(pair, return_inverse=True)
    code = np.concatenate([number << 40 | low + 1, number << 40 | high + 1])  # bands start at -1
    code, back = np.unique(code, return_inverse=True)
    change = np.bincount(back, np.repeat([1, -1], len(pair)), len(code)).astype(np.int64)
    return pairs[code >> 40], (code & (1 << 40) - 1) - 1, change


def _candidates(data: np.ndarray, starts: np.ndarray, index: Index) -> list[tuple[int, int, int, int]]:
    """(document, item, first band, last band) of ranges in which every band meets the bound."""
    keys = grams(data)
    found = [_events(keys[a : a + PLACES], a, starts, index) for a in range(0, len(keys), PLACES)]
    if not found:
        return []
    pair, band, change = (np.concatenate([f[k] for f in found]) for k in range(3))
    order = np.lexsort((band, pair))
    pair, band, change = pair[order], band[order], change[order]
    if not len(pair):
        return []
    last = np.ones(len(pair), bool)  # of the changes at one band
    last[:-1] = (pair[1:] != pair[:-1]) | (band[1:] != band[:-1])
    hits = np.cumsum(change)[last]  # the changes of a pair add up to nought
    pair, band = pair[last], band[last]
    enough = hits >= index.bound[pair % len(index.ids)]
    # neighbouring stretches with enough hits are one range
    begin = enough.copy()
    begin[1:] &= ~(enough[:-1] & (pair[1:] == pair[:-1]))
    ends = np.nonzero(enough & ~np.append(enough[1:] & (pair[1:] == pair[:-1]), False))[0]
    begins = np.nonzero(begin)[0]
    rows = zip(pair[begins].tolist(), band[begins].tolist(), band[ends + 1].tolist())
    return [(*divmod(p, len(index.ids)), low, high - 1) for p, low, high in rows]


def _leaks(texts: list[bytes], index: Index) -> list[list[dict]]:
    """For each text its leaks, one per item, ordered by place."""
    out: list[dict] = [{} for _ in texts]
    gap = b"\0" * Q
    joined = gap.join([*texts, b""])
    starts = np.cumsum([0, *[len(t) + Q for t in texts[:-1]]])
    ranges = _candidates(np.frombuffer(joined, np.uint8), starts, index) if index.ids else []
    for doc, item, first, last in ranges:
        k, length = int(index.k[item]), int(index.length[item])
        text, wanted = texts[doc], index.texts[item]
        if item not in out[doc]:
            exact = text.find(wanted)
            out[doc][item] = (0, exact, exact + length) if exact >= 0 else (k + 1, 0, 0)
        low = first * (k + 1) - length - int(starts[doc]) - k
        high = (last + 2) * (k + 1) - 1 - length - int(starts[doc]) + k
        step = PIECE + 2 * (k + 1)  # an alignment of so few edits keeps within 2 k + 1 diagonals
        for a in range(low, high + 1, PIECE):
            best = out[doc][item]
            if not best[0]:
                break  # as it stands, at its first place
            found = align(wanted, text, a, min(high, a + step), min(k, best[0]))
            if found < best:
                out[doc][item] = found
    ids = index.ids + [i for i, _ in index.short]
    for doc, found in enumerate(out):
        for item in [i for i, f in found.items() if f[0] > index.k[i]]:
            del found[item]
        for n, (_, wanted) in enumerate(index.short, len(index.ids)):
            exact = texts[doc].find(wanted)
            if exact >= 0:
                found[n] = (0, exact, exact + len(wanted))
    points = lambda t, n: len(t[:n].decode("utf-8", "ignore"))
    return [
        sorted(
            (
                {"item_id": ids[i], "distance": d, "start": points(t, s), "end": points(t, e)}
                for i, (d, s, e) in found.items()
            ),
            key=lambda x: (x["start"], x["item_id"]),
        )
        for t, found in zip(texts, out)
    ]


def with_leaks(docs: DataFrame, benchmark: DataFrame, column: str = "leaks", rate: float = RATE) -> DataFrame:
    """``docs`` with an array column of leaks: item_id, distance, start, end.

    A leak is a whole item found within ``rate`` edits per byte (at most one for every ``Q``
    bytes beyond the first ``Q``, so none under 2 ``Q``), edits counted on bytes of the
    normalised texts; start and end are code points of the normalised document. Each
    item is given once a document, at its best and then first place. Null and empty texts
    have none. Null and empty items match nothing; repeated items each match. Ids of items
    may be of any type. Repeated rows each give a row; an empty table gives an empty result. A column of
    ``docs`` with the name of the new one is replaced.

    Items travel to all tasks in blocks of about ``BENCHMARK_BYTES``, one pass over a task's
    documents for each; documents never move and are looked at whole.
    """
    docs = docs.drop(column)
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BENCHMARK_BYTES))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) if blocks > 1 else F.lit(0)
    item_id = benchmark.schema["item_id"].dataType
    leak = T.StructType().add("item_id", item_id).add("distance", "integer").add("start", "integer").add("end", "integer")
    with_column = docs.withColumn(column, F.array().cast(T.ArrayType(leak)))
    place = docs.columns.index("text")
    for block in range(blocks):
        rows = benchmark.where((part == block) & F.col("text").isNotNull()).select("item_id", "text").collect()
        items = docs.sparkSession.sparkContext.broadcast([(r.item_id, normal(r.text)) for r in rows])

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            index = Index(items.value, rate)
            for batch in batches:
                found: list[list[dict]] = []
                texts: list[bytes] = []
                size = 0
                for text in batch.column(place):
                    texts.append(normal(text.as_py()))
                    size += len(texts[-1])
                    if size >= BLOCK:
                        found += _leaks(texts, index)
                        texts, size = [], 0
                found += _leaks(texts, index) if texts else []
                last = batch.num_columns - 1
                kind = batch.schema.field(last).type
                before = batch.column(last).to_pylist()
                both = pa.array([a + b for a, b in zip(before, found)], kind)
                yield pa.RecordBatch.from_arrays([*batch.columns[:last], both], names=batch.schema.names)

        with_column = with_column.mapInArrow(run, with_column.schema)
    return with_column
