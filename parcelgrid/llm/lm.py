"""Log-probabilities of texts under a smoothed n-gram model, scored by a backoff automaton.

Smoothing interpolates each order with the one below (Dirichlet prior): after context h,
p(w | h) = (c(h w) + MASS * p(w | shorter h)) / (c(h) + MASS), and words alone have
(c + 1) / (N + V + 1). As an automaton: contexts seen in training are states; an n-gram seen
is an arc with its log-probability; any other word follows the failure arc to the state of
the shorter context, at the cost log(MASS / (c(h) + MASS)), until a state knows it.

The model grows with the corpus and is never in one place. Texts are split into packs of
about ``PACK_TOKENS`` tokens; a pack asks for the counts of its own n-grams only:

1. each task tokenizes its documents into packs, written to the scratch folder;
2. each pack sends its distinct n-grams (64-bit hashes) with its training counts, sorted, to
   buckets by hash; a bucket adds up the counts over all packs and answers each pack with
   numbers alone, in the order of its question;
3. each pack meets its answers, builds the part of the automaton that its texts can reach,
   and runs it once over every text from left to right.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelgrid.llm.common import doc_text, materialize

ORDER = 2
MASS = 8.0
PACK_TOKENS = 600_000
BUCKET_KEYS = 4_000_000  # n-grams of all packs that meet in one bucket, about
TEXT_BLOCK = 8 << 20  # bytes tokenized together
START, END = np.uint64(0x5354415254), np.uint64(0x454E44)  # stand before and behind a text
_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every token of all texts, tokens of each): lower-cased words, then END."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words = lists.flatten().dictionary_encode()
    known = words.dictionary
    slot = words.indices.to_numpy()
    own = np.array([xxhash.xxh64_intdigest(w, 0) for w in known.to_pylist()], np.uint64)
    real = pc.binary_length(known).to_numpy(zero_copy_only=False) > 0  # blanks at either end leave ''
    real, hashes = real[slot], own[slot]
    bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
    bounds = np.concatenate([[0], np.cumsum(real)])[bounds]
    return np.insert(hashes[real], bounds[1:], END), np.diff(bounds) + 1


def extend(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of an n-gram from that of its context and its last word."""
    mixed = (context ^ (context >> np.uint64(29))) * _MIX
    return (mixed ^ (mixed >> np.uint64(32))) * _MIX + word


def ngrams(tokens: np.ndarray, sizes: np.ndarray, order: int) -> np.ndarray:
    """Hash of the n-gram of ``order`` that ends at each token; START fills up before a text."""
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    place = np.arange(len(tokens))
    key = None
    for back in range(order - 1, -1, -1):
        word = np.where(place - back >= first, tokens[np.maximum(place - back, 0)], START)
        key = word if key is None else extend(key, word)
    return key


def _pressed(numbers: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(numbers.tobytes())


def _numbers(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def make_packs(docs: DataFrame, learn_from: Column) -> DataFrame:
    """Documents as packs of token numbers: one row holds whole texts of about PACK_TOKENS tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        pack = (context.partitionId() if context else 0) << 32
        waiting: list[tuple] = []

        def flush() -> pa.RecordBatch:
            ids = pa.concat_arrays([w[0] for w in waiting])
            train, tokens, sizes = (np.concatenate([w[k] for w in waiting]) for k in (1, 2, 3))
            words, numbers = np.unique(tokens, return_inverse=True)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([pack]),
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                    pa.array([_pressed(train.astype("?"))], pa.binary()),
                    pa.array([_pressed(sizes.astype("<i8"))], pa.binary()),
                    pa.array([_pressed(numbers.astype("<u4"))], pa.binary()),
                    pa.array([_pressed(words.astype("<u8"))], pa.binary()),
                    pa.array([len(tokens)]),
                    pa.array([int(sizes[train].sum())]),
                    pa.array([int(train.sum())]),
                ],
                names=["pack", "ids", "train", "sizes", "numbers", "words", "tokens", "trained", "texts"],
            )

        for batch in batches:
            length = np.cumsum(pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False))
            edges = [0, *(np.nonzero(np.diff(length // TEXT_BLOCK))[0] + 1).tolist(), batch.num_rows]
            for a, b in zip(edges[:-1], edges[1:]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                tokens, sizes = word_hashes(part.column(2))
                train = part.column(1).to_numpy(zero_copy_only=False).astype(bool)
                bounds = np.concatenate([[0], np.cumsum(sizes)])
                at = 0
                while at < len(sizes):
                    room = PACK_TOKENS - sum(len(w[2]) for w in waiting)
                    to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + room, "right")) - 1)
                    waiting.append(
                        (part.column(0).slice(at, to - at), train[at:to], tokens[bounds[at] : bounds[to]], sizes[at:to])
                    )
                    at = to
                    if at < len(sizes) or sum(len(w[2]) for w in waiting) >= PACK_TOKENS:
                        yield flush()
                        pack, waiting = pack + 1, []
        if waiting:
            yield flush()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", learn_from.alias("train"), doc_text().alias("text")).mapInArrow(
        run,
        f"pack bigint, ids array<{kind}>, train binary, sizes binary, numbers binary, words binary,"
        " tokens bigint, trained bigint, texts bigint",
    )


def _texts(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens, sizes, train) of a pack."""
    tokens = _numbers(row["words"], "<u8")[_numbers(row["numbers"], "<u4")]
    return tokens, _numbers(row["sizes"], "<i8"), _numbers(row["train"], "?")


def count_ngrams(packs: DataFrame, order: int, buckets: int) -> DataFrame:
    """(order, bucket, pack, counts, distinct): training counts of a pack's n-grams over all packs.

    ``counts`` are in the order of the pack's distinct n-grams in the bucket, by hash;
    ``distinct``, given once a bucket, is the number of n-grams with a count.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tokens, sizes, train = _texts(row)
                learnt = np.repeat(train, sizes)
                for n in range(1, order + 1):
                    keys, at = np.unique(ngrams(tokens, sizes, n), return_inverse=True)
                    own = np.bincount(at, learnt, len(keys)).astype("<i8")
                    edges = np.searchsorted(bucket_of(keys, buckets), np.arange(buckets + 1))
                    parts = [(b, *edges[b : b + 2]) for b in range(buckets) if edges[b] < edges[b + 1]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([n] * len(parts), pa.int32()),
                            pa.array([b for b, _, _ in parts], pa.int64()),
                            pa.array([row["pack"]] * len(parts), pa.int64()),
                            pa.array([keys[i:j].tobytes() for _, i, j in parts], pa.binary()),
                            pa.array([_pressed(own[i:j]) for _, i, j in parts], pa.binary()),
                        ],
                        names=["order", "bucket", "pack", "keys", "own"],
                    )

    def answer(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        keys = [np.frombuffer(r["keys"], np.uint64) for r in rows]
        own = np.concatenate([_numbers(r["own"], "<i8") for r in rows])
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, own, len(distinct)).astype("<i8")
        parts = np.split(total[at], np.cumsum([len(k) for k in keys])[:-1])
        return pa.table(
            {
                "order": table["order"],
                "bucket": table["bucket"],
                "pack": table["pack"],
                "counts": pa.array([_pressed(p) for p in parts], pa.binary()),
                "distinct": pa.array([int((total > 0).sum())] + [0] * (len(rows) - 1), pa.int64()),
            }
        )

    asked = packs.select("pack", "sizes", "train", "numbers", "words").mapInArrow(
        ask, "order int, bucket bigint, pack bigint, keys binary, own binary"
    )
    return asked.groupBy("order", "bucket").applyInArrow(
        answer, "order int, bucket bigint, pack bigint, counts binary, distinct bigint"
    )


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Rises with the keys, so the buckets of sorted keys are slices."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


class Automaton:
    """The part of the backoff automaton that the texts of one pack can reach.

    State 0 is the empty context, states 1 to order - 1 the beginnings of a text; the others
    are n-grams seen in training. ``arcs`` maps (state, word) to an arc.
    """

    def __init__(
        self, tokens: np.ndarray, sizes: np.ndarray, counts: list[np.ndarray],
        total: int, distinct: int, texts: int, mass: float,
    ) -> None:
        order = len(counts)
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        place = np.arange(len(tokens))
        begins = place == first
        before = np.maximum(place - 1, 0)
        self.unknown = -float(np.log10(total + distinct + 1))
        fail, weight = [np.arange(-1, order - 1)], [np.ones(1), np.full(order - 1, mass / (texts + mass))]
        states = order
        keys, values, targets = [], [], []
        chance = state = last_seen = None
        for n in range(1, order + 1):
            _, shown, at = np.unique(ngrams(tokens, sizes, n), return_index=True, return_inverse=True)
            seen = counts[n - 1][at]
            if n == 1:
                self.words, self.seen = at, seen
                chance = (seen + 1) / (total + distinct + 1)
                self.base = np.log10(chance)
                source = np.zeros(len(tokens), np.int64)
            else:
                held = np.where(begins, texts, last_seen[before])
                chance = (seen + mass * chance) / (held + mass)
                source = np.where(begins, n - 1, state[before])
            if n < order:
                shorter = np.zeros(len(shown), np.int64) if n == 1 else state[shown]
                state = states + at
                states += len(shown)
                fail.append(shorter)
                weight.append(mass / (counts[n - 1] + mass))
            last_seen = seen
            known = shown[seen[shown] > 0]
            keys.append((source[known] << 32) | self.words[known])
            values.append(np.log10(chance[known]))
            targets.append(state[known] if order > 1 else np.zeros(len(known), np.int64))
        self.arcs = dict(zip(np.concatenate(keys).tolist(), range(sum(map(len, keys)))))
        self.value, self.target = np.concatenate(values).tolist(), np.concatenate(targets).tolist()
        self.fail = np.concatenate(fail).tolist()
        self.weight = np.log10(np.concatenate(weight)).tolist()
        self.start = order - 1 if texts else 0

    def run(self, words: list[int]) -> float:
        """Log-probability of a text, read once from left to right."""
        arcs, value, target, fail, weight = self.arcs, self.value, self.target, self.fail, self.weight
        state, total = self.start, 0.0
        for word in words:
            arc = arcs.get(state << 32 | word)
            while arc is None and state:
                total += weight[state]
                state = fail[state]
                arc = arcs.get(state << 32 | word)
            if arc is None:
                total += self.unknown
            else:
                total += value[arc]
                state = target[arc]
        return total


def score_texts(docs: DataFrame, learn_from: Column, order: int = ORDER, mass: float = MASS) -> DataFrame:
    """One row per document: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words, A-Z lower-cased, and one END a text; ``learn_from`` says which rows
    are counted. Null and empty texts are the END alone. ``base_score`` is that of single
    tokens with add-one smoothing, ``score`` the model's; both are log10. Rows are counted
    and scored as often as they occur. Without training rows nothing is known and both scores
    are 0. An empty table gives an empty result; other columns are not looked at. Words and
    n-grams are told apart by 64-bit hashes.
    """
    packs = materialize(make_packs(docs, learn_from), "packs")
    sums = packs.agg(F.sum("tokens"), F.sum("trained"), F.sum("texts")).first()
    tokens, trained, texts = (int(x or 0) for x in sums)
    at_least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(min(at_least, 1 + tokens // 100_000), -(-tokens // BUCKET_KEYS))
    answers = materialize(count_ngrams(packs, order, buckets), "ngram-counts")
    distinct = int(answers.where("order = 1").agg(F.sum("distinct")).first()[0] or 0)

    def score(pack: pa.Table, answers: pa.Table) -> pa.Table:
        row = pack.to_pylist()[0]
        tokens, sizes, _ = _texts(row)
        rows = sorted(answers.to_pylist(), key=lambda r: (r["order"], r["bucket"]))
        counts = [
            np.concatenate([_numbers(r["counts"], "<i8") for r in rows if r["order"] == n]) for n in range(1, order + 1)
        ]
        model = Automaton(tokens, sizes, counts, trained, distinct, texts, mass)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        scores = [model.run(model.words[a:b].tolist()) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        return pa.table(
            {
                "doc_id": pack["ids"].combine_chunks().flatten(),
                "n_tokens": sizes,
                "n_known": np.add.reduceat((model.seen > 0).astype(np.int64), bounds[:-1]),
                "train_tokens": np.full(len(sizes), trained),
                "base_score": np.add.reduceat(model.base, bounds[:-1]),
                "score": pa.array(scores, pa.float64()),
            }
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    mine = packs.select("pack", "ids", "sizes", "train", "numbers", "words").groupBy("pack")
    return mine.cogroup(answers.select("pack", "order", "bucket", "counts").groupBy("pack")).applyInArrow(
        score,
        f"doc_id {kind}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    )
