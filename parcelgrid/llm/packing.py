"""Token sequences of fixed length, packed in order by dynamic programming.

Each task packs the documents of its partition in their order, so nothing is shuffled and
sequences are as good as whole at any size: per partition only the last may be short. A cut
may fall behind a document (free), behind a sentence (a small penalty) or inside one (a
larger one). The plan minimises padding plus penalties over all choices of cuts: the best
predecessor of a cut lies in a window of one sequence length, or of two with one full
sequence between, and a monotone queue keeps the least of the window.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from parcelgrid.llm.common import doc_text

END_ID = 1
LENGTH = 2048
SENTENCE_CUT = 1  # penalty in tokens of padding
MID_CUT = 12
LEAST_GAP = 32  # sentences ending sooner than this after another are not cut between
SEGMENT = 1 << 19  # tokens planned together
TEXT_BLOCK = 1 << 20  # bytes tokenized together
KNOWN_WORDS = 250_000  # words a task remembers
MARKS = ".,;:!?"
_PLAIN = re.compile(r"^[A-Za-zÀ-ÖØ-öø-įĲ-ňŊ-ɏ]+$")  # letters that lower case to one letter
_SENTENCE_END = re.compile(r"^[.!?…]+[\"')\]]*$")


class WordTokenizer:
    """Token ids of texts by way of their words, each word tokenized once.

    The tokenizer splits at white space before anything else, so a text's ids are those of
    its words in turn. Words of Latin letters, with at most one mark behind, go to the
    model directly: they are one pre-token each, in lower case, and the mark is another.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        # A task has one core; a pool of threads in each worker would also keep their memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(path)
        self.plain = Tokenizer(self.whole.model)  # shares the model
        self.plain.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        self.mark = np.array([self.whole.encode(m, add_special_tokens=False).ids[0] for m in MARKS], np.int64)
        tokens = self.whole.get_vocab()
        size = max(tokens.values()) + 1
        self.ends, self.closes = np.zeros(size, bool), np.zeros(size, bool)
        for token, at in tokens.items():
            self.closes[at] = token.endswith("</w>")
            self.ends[at] = bool(_SENTENCE_END.match(token.removesuffix("</w>")))
        self._forget()

    def _forget(self) -> None:
        self.stem: dict[str, int] = {}
        self.flat, self.first = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _learn(self, stems: list[str]) -> None:
        plain = [w for w in stems if _PLAIN.match(w)]
        rest = [w for w in stems if not _PLAIN.match(w)]
        joined = [" ".join(plain[i : i + 256]) for i in range(0, len(plain), 256)]
        ids = [e.ids for e in self.plain.encode_batch_fast(joined, add_special_tokens=False)]
        flat = np.fromiter(chain.from_iterable(ids), np.uint32)
        sizes = np.diff(np.nonzero(self.closes[flat])[0] + 1, prepend=0)
        others = [e.ids for e in self.whole.encode_batch_fast(rest, add_special_tokens=False)]
        sizes = np.concatenate([sizes, np.array([len(x) for x in others], np.int64)])
        n = len(self.stem)
        self.stem |= {w: n + i for i, w in enumerate(plain + rest)}
        self.flat = np.concatenate([self.flat, flat, np.fromiter(chain.from_iterable(others), np.uint32)])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(sizes)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts on end, number of ids of each)."""
        if not pc.any(pc.match_substring(texts, "<|")).as_py():  # upper case is no special token
            texts = pc.ascii_lower(texts)
        lists = pc.ascii_split_whitespace(texts)
        words = lists.flatten().dictionary_encode()
        word = words.dictionary
        bare = pc.utf8_rtrim(word, MARKS)
        marks = pc.subtract(pc.utf8_length(word), pc.utf8_length(bare))
        plain = pc.and_(pc.match_substring_regex(bare, _PLAIN.pattern), pc.less_equal(marks, 1))
        stems = pc.if_else(plain, pc.utf8_lower(bare), word).dictionary_encode()
        last = pc.index_in(pc.utf8_slice_codeunits(word, -1), pa.array(list(MARKS)))
        last = pc.if_else(pc.and_(plain, pc.equal(marks, 1)), last, -1).to_numpy(zero_copy_only=False)
        mark_of = np.append(self.mark, -1)[last]
        own = stems.dictionary.to_pylist()
        if len(self.stem) > KNOWN_WORDS:
            self._forget()
        new = [w for w in own if w not in self.stem]
        if new:
            self._learn(new)
        of = np.array([self.stem[w] for w in own], np.int64)
        slot = words.indices.to_numpy()
        stem = of[stems.indices.to_numpy()][slot] if own else of
        mark = mark_of[slot]
        marked = mark >= 0
        size = self.first[stem + 1] - self.first[stem] + marked
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        entry = np.arange(total) + np.repeat(self.first[stem] - ends + size, size)
        ids = self.flat[np.minimum(entry, len(self.flat) - 1)] if total else np.zeros(0, np.uint32)
        ids[ends[marked] - 1] = mark[marked]
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
        return ids, np.diff(np.concatenate([[0], ends])[bounds])


def candidates(ends: np.ndarray, sentence: np.ndarray) -> tuple[list[int], list[int]]:
    """Places of possible cuts and their penalties; none further apart than half a sequence."""
    place = np.nonzero(sentence)[0] + 1
    keep = place[np.diff(place // LEAST_GAP, prepend=-1) > 0]
    place = np.unique(np.concatenate([keep, ends, [0]]))
    gap = np.diff(place)
    far = np.nonzero(gap > LENGTH // 2)[0]
    extra = [np.arange(place[i] + LENGTH // 2, place[i + 1], LENGTH // 2) for i in far]
    cost = np.full(int(place[-1]) + 1, MID_CUT, np.int64)
    cost[keep] = SENTENCE_CUT
    cost[ends] = 0
    place = np.unique(np.concatenate([place, *extra]).astype(np.int64))
    return place.tolist(), cost[place].tolist()


def plan(place: list[int], cost: list[int]) -> tuple[list[float], list[int], list[bool]]:
    """Least penalty up to each candidate, its predecessor, and whether a full sequence lies between.

    ``near`` and ``far`` are monotone queues of candidates by penalty plus place: those up to
    one sequence back, and those one to two back.
    """
    n = len(place)
    best, back, full = [0.0] * n, [0] * n, [False] * n
    key = [0.0] * n  # best + place
    at = {0: 0}
    near, far = [0], []
    near_head = far_head = 0
    moved = 0  # candidates before this one have left the near window
    for j in range(1, n):
        p = place[j]
        while place[moved] < p - LENGTH:
            k = key[moved]
            while len(far) > far_head and key[far[-1]] >= k:
                far.pop()
            far.append(moved)
            moved += 1
        while place[near[near_head]] < p - LENGTH:
            near_head += 1
        i = near[near_head]
        least, via, by_full = key[i] + LENGTH - p, i, False
        while len(far) > far_head and place[far[far_head]] < p - 2 * LENGTH:
            far_head += 1
        if len(far) > far_head:
            other = key[far[far_head]] + 2 * LENGTH - p + MID_CUT
            if other < least:
                least, via, by_full = other, far[far_head], True
        half = at.get(p - LENGTH // 2)  # a power of two needs no padding
        if half is not None and best[half] < least:
            least, via, by_full = best[half], half, False
        best[j], back[j], full[j] = least + cost[j], via, by_full
        k = key[j] = best[j] + p
        at[p] = j
        while len(near) > near_head and key[near[-1]] >= k:
            near.pop()
        near.append(j)
    return best, back, full


def cuts(place: list[int], cost: list[int], last: bool) -> list[int]:
    """Ends of the planned sequences; with ``last`` up to the final place, else to a good one."""
    best, back, full = plan(place, cost)
    j = len(place) - 1
    if not last:  # the rest waits for what follows
        while j > 1 and place[j] > place[-1] - LENGTH:
            j -= 1
    out = []
    while j > 0:
        out.append(place[j])
        if full[j]:
            out.append(place[back[j]] + LENGTH)
        j = back[j]
    out.reverse()
    if last and out:
        length = out[-1] - (out[-2] if len(out) > 1 else 0)
        parts = [1 << b for b in range(length.bit_length()) if length >> b & 1]
        if (len(parts) - 1) * MID_CUT < LENGTH - length:  # powers of two need no padding
            end = out.pop()
            out += [end - sum(parts[:k]) for k in range(len(parts) - 1, -1, -1)]
    return out


def pack(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of its whole text and one ``END_ID``; null and empty texts are
    that id alone. Every id is in exactly one piece; the pieces of a sequence are gapless
    from offset 0 and at most ``LENGTH`` long together. Sequences keep the order of the input
    within a partition and never cross partitions; ``sequence_id`` holds the partition's
    number above 33 bits. Repeated rows are packed each. An empty table gives an empty
    result. Other columns are not looked at. A task holds the ids of about ``SEGMENT`` tokens
    and one whole document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer(tokenizer_path)
        context = TaskContext.get()
        sequence = (context.partitionId() if context else 0) << 33
        ids, sizes, names, first = [], [], [], 0  # first: ids of the first document given out already
        waiting = 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal ids, sizes, names, first, waiting, sequence
            stream = np.concatenate(ids)
            size = np.concatenate(sizes)
            left = size.copy()
            left[0] -= first
            ends = np.cumsum(left)
            cut = np.array(cuts(*candidates(ends, tokenizer.ends[stream]), last), np.int64)
            if not len(cut):
                return
            done = int(cut[-1])
            bounds = np.unique(np.concatenate([[0], cut, ends[ends < done]]))
            start, length = bounds[:-1], np.diff(bounds)
            doc = np.searchsorted(ends, start, "right")
            window = np.searchsorted(cut, start, "right")
            from_cut = np.concatenate([[0], cut[:-1]])[window]
            data = memoryview(stream.astype("<u4").tobytes())
            crc = [zlib.crc32(data[4 * s : 4 * e]) for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            name = pa.concat_arrays(names)
            yield pa.RecordBatch.from_arrays(
                [
                    name.take(pa.array(doc)),
                    pa.array(start - (ends - size)[doc]),
                    pa.array(length),
                    pa.array(crc, pa.int64()),
                    pa.array(size[doc]),
                    pa.array(sequence + window),
                    pa.array(start - from_cut),
                ],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )
            sequence += len(cut)
            ids, waiting = [stream[done:]], len(stream) - done
            whole = int(np.searchsorted(ends, done, "right"))  # documents that are complete
            names, sizes = [name[whole:]], [size[whole:]]
            first = int(done - (ends - size)[whole]) if whole < len(ends) else 0

        for batch in batches:
            texts = batch.column(1)
            length = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
            block = length // TEXT_BLOCK
            edges = [0, *(np.nonzero(np.diff(block))[0] + 1).tolist(), len(texts)] if len(texts) else []
            for a, b in zip(edges[:-1], edges[1:]):
                some, n = tokenizer.encode(texts.slice(a, b - a))
                ids.append(np.insert(some, np.cumsum(n), END_ID))
                sizes.append(n + 1)
                names.append(batch.column(0).slice(a, b - a))
                waiting += len(ids[-1])
                if waiting >= SEGMENT:
                    yield from flush(False)
        if waiting:
            yield from flush(True)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", doc_text().alias("text")).mapInArrow(
        run,
        f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint,"
        " sequence_id bigint, offset bigint",
    )
