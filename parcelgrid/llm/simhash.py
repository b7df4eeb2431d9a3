"""Near duplicates by SimHash: linked within a few bits, found at the anchors of a covering code.

Anchors are pairs of words of the perfect binary Golay code [23, 12], one for each of two
23-bit halves of the fingerprint. The code's covering radius is 3 and it is perfect, so a
fingerprint has exactly one anchor with at most 3 differing bits in either half: its home.
If another fingerprint differs in at most ``max_bits`` bits, x of them in the first half and
y in the second, the same anchor lies within 3 + x and 3 + y bits of it. So each fingerprint
is copied to every anchor within the radius plus its share of the threshold (61 anchors on
average for two bits, of 2^24), and at each anchor the fingerprints at home there are
compared, on all 64 bits, with all that were copied to it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelgrid.llm.common import doc_text, join_keyed, materialize
from parcelgrid.llm.components import components

GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, of the Golay code
HALF = 23
RADIUS = 3
BLOCK = 1 << 15  # shingles, or fingerprints, worked on at once
SMALL_RUN = 64  # up to here an anchor's links are given one by one
HASH_SEED = 42


def fingerprint(text: bytes, size: int) -> int:
    """Majority of the bits of all shingles' hashes; 0 for a text without words."""
    words = text.lower().split()  # of bytes: A-Z and [\x20\x09-\x0D] only
    if not words:
        return 0
    size = min(size, len(words))
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    starts, ends = starts[: len(words) - size + 1], ends[size - 1 :]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), BLOCK):
        part = zip(starts[at : at + BLOCK].tolist(), ends[at : at + BLOCK].tolist())
        hashes = np.array([xxhash.xxh64_intdigest(joined[s:e], HASH_SEED) for s, e in part], np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * ones > len(starts), bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, fp): the fingerprint of every row as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints, pa.int64())], names=["doc_id", "fp"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", doc_text().cast("binary").alias("text"))
    return texts.mapInArrow(run, f"doc_id {kind}, fp bigint")


def _remainders(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit polynomials modulo the generator."""
    words = words.copy()
    for bit in range(HALF - 1, 10, -1):
        high = (words >> bit) & 1
        words ^= high * (GENERATOR << (bit - 11))
    return words


def error_patterns(spare: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Error patterns of weight up to 3 + spare, sorted by remainder: (patterns, excess, first).

    Those of remainder r are ``patterns[first[r]:first[r + 1]]``; XOR with a word of that
    remainder gives the code words around it. ``excess`` is the weight beyond the radius.
    """
    patterns, excess = [], []
    for weight in range(RADIUS + spare + 1):
        for bits in combinations(range(HALF), weight):
            patterns.append(sum(1 << b for b in bits))
            excess.append(max(0, weight - RADIUS))
    patterns, excess = np.array(patterns, np.int64), np.array(excess, np.int64)
    remainders = _remainders(patterns)
    order = np.lexsort((excess, remainders))
    first = np.searchsorted(remainders[order], np.arange(2049))
    return patterns[order], excess[order], first


def anchors(prints: np.ndarray, spare: int, tables: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the fingerprint, anchor, at home) for every anchor a fingerprint is copied to."""
    patterns, excess, first = tables
    near = []
    for half in ((prints >> 0) & (2**HALF - 1), (prints >> HALF) & (2**HALF - 1)):
        start = first[(r := _remainders(half))]
        near.append((half, start, first[r + 1] - start))
    (a, a0, na), (b, b0, nb) = near
    each = na * nb
    index = np.repeat(np.arange(len(prints)), each)
    place = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    i = a0[index] + place // nb[index]
    j = b0[index] + place % nb[index]
    spent = excess[i] + excess[j]
    keep = spent <= spare
    index, i, j, spent = index[keep], i[keep], j[keep], spent[keep]
    anchor = ((b[index] ^ patterns[j]) << HALF) | (a[index] ^ patterns[i])
    return index, anchor, spent == 0


def bits_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of signed 64-bit numbers; of the sign as well, which counting takes off."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def _links_of_run(homes: np.ndarray, members: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning set of the links between homes and members of one large anchor."""
    members = np.unique(members)
    label = np.arange(len(members))  # the homes are members too
    for at in range(0, len(homes), 256):
        block = homes[at : at + 256]
        apart = bits_apart(block[:, None], members[None, :])
        for home_near in apart <= max_bits:
            found = np.unique(label[home_near])
            if len(found) > 1:
                if len(found) == 2:
                    label[label == found[1]] = found[0]
                else:
                    label[np.isin(label, found)] = found[0]
    moved = np.nonzero(label != np.arange(len(members)))[0]
    return list(zip(members[moved].tolist(), members[label[moved]].tolist()))


def links(anchor: np.ndarray, fp: np.ndarray, home: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links among rows sorted by anchor; whole anchors only."""
    bounds = np.nonzero(np.diff(anchor, prepend=anchor[:1] - 1))[0]
    sizes = np.diff(np.append(bounds, len(anchor)))
    out: list[tuple[int, int]] = []
    for at, size in zip(bounds[sizes > SMALL_RUN].tolist(), sizes[sizes > SMALL_RUN].tolist()):
        run = slice(at, at + size)
        if home[run].any():
            out += _links_of_run(fp[run][home[run]], fp[run], max_bits)
    start, size = np.repeat(bounds, sizes), np.repeat(sizes, sizes)
    rows = np.nonzero(home & (size > 1) & (size <= SMALL_RUN))[0]
    for part in np.array_split(rows, max(1, len(rows) * SMALL_RUN // (BLOCK * 64))):
        n = size[part]
        left = np.repeat(part, n)
        right = np.repeat(start[part], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        a, b = fp[left], fp[right]
        near = (bits_apart(a, b) <= max_bits) & (a != b)
        out += zip(a[near].tolist(), b[near].tolist())
    return out


def linked_prints(prints: DataFrame, max_bits: int) -> DataFrame:
    """Links (u, v) between distinct fingerprints ``fp`` that connect all within ``max_bits``."""

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = error_patterns(max_bits)
        for batch in batches:
            all_prints = batch.column(0).to_numpy()
            for at in range(0, len(all_prints), 1024):
                part = all_prints[at : at + 1024]
                index, anchor, home = anchors(part, max_bits, tables)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(part[index]), pa.array(home)], names=["anchor", "fp", "home"]
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(rows: tuple) -> Iterator[pa.RecordBatch]:
            pairs = np.array(links(*rows, max_bits), np.int64).reshape(-1, 2)
            pairs = np.unique(np.sort(pairs, axis=1), axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["u", "v"]
            )

        open_rows: list[tuple] = []  # of the last anchor, which may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = tuple(batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            last = int(np.searchsorted(rows[0], rows[0][-1]))
            if last == 0 and open_rows and open_rows[0][0][0] == rows[0][0]:
                open_rows.append(rows)
                continue
            open_rows.append(tuple(c[:last] for c in rows))
            yield from found(tuple(np.concatenate(c) for c in zip(*open_rows)))
            open_rows = [tuple(c[last:] for c in rows)]
        if open_rows:
            yield from found(tuple(np.concatenate(c) for c in zip(*open_rows)))

    copies = prints.select("fp").mapInArrow(copy, "anchor bigint, fp bigint, home boolean")
    sorted_copies = copies.repartition("anchor").sortWithinPartitions("anchor")
    return sorted_copies.mapInArrow(compare, "u bigint, v bigint").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest doc_id reachable over links, itself included; it is null
    only where every id reached is null. Null and empty texts, and texts of white space, have
    fingerprint zero and are linked like any other. Repeated rows each give a row. An empty
    table gives an empty result; other columns are not looked at.

    Exact fingerprint copies are one node, so a group of copies costs as much as one text.
    At an anchor with many different fingerprints (8 bytes each) the links given are a
    spanning set, never all pairs.
    """
    rows = materialize(fingerprints(docs, shingle), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(linked_prints(nodes, max_bits))
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    rooted = materialize(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of_print = join_keyed(rooted, least, ["root"]).select("fp", "component_id")
    return join_keyed(rows, of_print, ["fp"]).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
