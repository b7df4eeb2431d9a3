"""Toxicity by the nearest labelled examples under TF-IDF cosine.

A bounded sample of labelled rows, as many of each label as there are up to half the bound,
is indexed under the terms that tell the labels apart beyond chance (under all terms, the
nearest examples are those that share rare words of any kind; README has the figures): for
every term a list of examples with weights, in blocks of examples, and the largest weight in
each block. The largest weights bound the cosine of a document with any
example of a block; blocks are scored in order of that bound until no block left can hold
one of the nearest, so the nearest are exact. They vote, closer ones with more weight, and
isotonic regression on the examples' own leave-one-out votes, weighted back to the labels'
true shares, turns votes into probabilities.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from parcelgrid.llm.common import labelled_sample
from parcelgrid.llm.simhash import bits_apart, fingerprint

SAMPLE = 4000  # labelled examples at most
SAMPLE_BYTES = 64 << 20  # of their texts together at most
SAMPLE_TEXT = 1 << 20  # of one of them at most
CHI2 = 25.0  # a term's least association with the label: chance passes one in 2 million
COPY_BITS = 8  # of two examples whose SimHash differs in no more bits, one tells words apart
NEAREST = 15
BLOCK = 64
_WORD = re.compile(r"\w+")


def terms(text: str | None) -> Counter:
    return Counter(_WORD.findall((text or "").lower()))


def isotonic(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing function of the votes nearest to the labels."""
    order = np.argsort(votes, kind="stable")
    pools: list[list[float]] = []  # weight, sum of labels, sum of votes
    for v, y, w in zip(votes[order], labels[order], weights[order]):
        pools.append([w, w * y, w * v])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    x = np.array([p[2] / p[0] for p in pools])
    y = np.array([p[1] / p[0] for p in pools])
    return x, y


class Examples:
    """Block-max inverted index of labelled examples."""

    def __init__(self, counts: list[Counter], ids: list, labels: np.ndarray, idf: dict[str, float]) -> None:
        self.ids, self.labels, self.idf = ids, labels, idf
        self.term = {t: i for i, t in enumerate(idf)}
        self.weight = np.array(list(idf.values()))
        self.blocks = max(1, -(-len(counts) // BLOCK))
        vectors = [self.vector(c) for c in counts]
        term = np.concatenate([*[v[0] for v in vectors], np.zeros(0, np.int64)])
        value = np.concatenate([*[v[1] for v in vectors], np.zeros(0)])
        example = np.repeat(np.arange(len(counts)), [len(v[0]) for v in vectors])
        order = np.lexsort((example, term))
        term, self.value, self.example = term[order], value[order], example[order]
        slot = term * self.blocks + self.example // BLOCK
        self.start = np.searchsorted(slot, np.arange(len(idf) * self.blocks + 1))
        self.largest = np.zeros(len(idf) * self.blocks)
        np.maximum.at(self.largest, slot, self.value)
        self.largest = self.largest.reshape(len(idf), self.blocks)

    @classmethod
    def of(cls, fields: dict) -> Examples:
        """The index from its fields: what travels is plain arrays."""
        index = cls.__new__(cls)
        vars(index).update(fields)
        return index

    def vector(self, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        known = [(i, n) for t, n in counts.items() if (i := self.term.get(t)) is not None]
        if not known:
            return np.zeros(0, np.int64), np.zeros(0)
        at, n = np.array(known, np.int64).T
        value = (1 + np.log(n)) * self.weight[at]
        return at, value / max(np.sqrt(value @ value), 1e-12)

    def _score(self, at: np.ndarray, value: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Examples of some blocks that share a term, with their exact cosines."""
        slot = (at[:, None] * self.blocks + blocks[None, :]).ravel()
        first = self.start[slot]
        n = self.start[slot + 1] - first
        entry = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        part = np.repeat(np.repeat(value, len(blocks)), n) * self.value[entry]
        cosine = np.bincount(self.example[entry], part, len(self.ids))
        found = np.nonzero(cosine)[0]
        return found, cosine[found]

    def nearest(self, counts: Counter, leave_out: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The NEAREST examples and their cosines, exactly; ties go to the earlier example."""
        at, value = self.vector(counts)
        if not len(at):
            return np.zeros(0, np.int64), np.zeros(0)
        bound = value @ self.largest[at]
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        found, cosine = np.zeros(0, np.int64), np.zeros(0)
        for step in range(0, len(order), 4):
            blocks = order[step : step + 4]
            if len(cosine) == NEAREST:
                blocks = blocks[bound[blocks] >= cosine[-1] * (1 - 1e-9)]
                if not len(blocks):
                    break
            more, its = self._score(at, value, blocks)
            own = more != leave_out
            found, cosine = np.append(found, more[own]), np.append(cosine, its[own])
            best = np.lexsort((found, -np.round(cosine, 12)))[:NEAREST]
            found, cosine = found[best], cosine[best]
        return found, cosine

    def vote(self, found: np.ndarray, cosine: np.ndarray) -> float:
        """Share of label 1 among the votes; a vote weighs the inverse square of its distance."""
        weight = 1 / np.maximum(2 - 2 * np.minimum(cosine, 1), 1e-3)
        # cosines are small in wide vectors, so the part above the weakest counts as well
        weight = weight * cosine**2
        total = weight.sum()
        return float((weight * self.labels[found]).sum() / total) if total else 0.0


def _first_of_copies(texts: list[str]) -> list[int]:
    """Places of texts that are no near copy of an earlier one."""
    prints, first = np.zeros(0, np.int64), []
    for place, text in enumerate(texts):
        own = fingerprint(text.encode("utf-8", "surrogatepass"), 3)
        if not len(prints) or bits_apart(prints, np.array([own], np.int64)).min() > COPY_BITS:
            prints = np.append(prints, np.int64(own))
            first.append(place)
    return first


def telling_terms(counts: list[Counter], labels: np.ndarray) -> list[str]:
    """Terms of two examples or more whose chi-square with the label reaches ``CHI2``."""
    one, all_ = Counter(), Counter()
    for words, label in zip(counts, labels):
        all_.update(words.keys())
        if label:
            one.update(words.keys())
    n, ones = len(counts), float(labels.sum())
    chosen = []
    for word, with_word in all_.items():
        apart = one[word] * n - with_word * ones
        spread = with_word * (n - with_word) * ones * (n - ones)
        if with_word > 1 and spread and apart * apart * n >= CHI2 * spread:
            chosen.append(word)
    return sorted(chosen)


def _document_frequencies(docs: DataFrame, words: list[str]) -> tuple[np.ndarray, int]:
    """In how many of all documents each of a bounded list of words occurs, and their number."""
    shared = docs.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(words)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = shared.value
        seen, n = np.zeros(len(place) + 1, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                some = set(_WORD.findall((text.as_py() or "").lower())) & place.keys()
                seen[[place[w] for w in some]] += 1
                n += 1
        seen[-1] = n
        at = np.nonzero(seen)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["at", "n"])

    counted = docs.select("text").mapInArrow(run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n"))
    total = np.zeros(len(words) + 1, np.int64)
    for r in counted.collect():  # one row a word of the sample at most
        total[r["at"]] = r.n
    return total[:-1], int(total[-1])


def fit(docs: DataFrame, labels: DataFrame, learn_from: Column, size: int = SAMPLE) -> dict:
    """The examples, the weights of their terms and the calibration."""
    rows, shares = labelled_sample(docs, labels, learn_from, "toxic", size, SAMPLE_BYTES, SAMPLE_TEXT)
    counts = [terms(t) for _, t, _ in rows]
    y = np.array([label for _, _, label in rows], float)
    # copies are examples like all others, but would make every word they share look telling
    apart = _first_of_copies([t for _, t, _ in rows])
    words = telling_terms([counts[i] for i in apart], y[apart])
    df, n = _document_frequencies(docs, words)
    idf = {w: float(np.log((1 + n) / (1 + d))) for w, d in zip(words, df)}
    ids = [i for i, _, _ in rows]
    base = shares.get(1, 0) / max(1, sum(shares.values()))
    if len(set(y.tolist())) < 2:  # one label only, or none
        return {"index": None, "base": base}
    examples = Examples(counts, ids, y, idf)
    near = [examples.nearest(c, i) for i, c in enumerate(counts)]
    votes = np.array([examples.vote(*x) for x in near])
    met = np.array([len(x[0]) > 0 for x in near])
    per_row = np.array([shares[int(v)] / max(1, (y == v).sum()) for v in y])
    knots = isotonic(votes[met], y[met], per_row[met]) if met.any() else (np.zeros(1), np.array([base]))
    if not met.all():
        base = float(np.average(y[~met], weights=per_row[~met]))
    return {"index": vars(examples), "base": base, "knots": knots}


def with_scores(
    docs: DataFrame,
    labels: DataFrame,
    learn_from: Column,
    size: int = SAMPLE,
    names: tuple[str, str] = ("score", "evidence"),
) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``evidence`` (examples and cosines, nearest first).

    ``learn_from`` is a condition on ``labels`` (doc_id of any type, toxic). Of labels that
    repeat an id, a 1 wins, and of texts, the least; other labels than 0 and 1 and null ids are
    not used, nor are labelled texts over ``SAMPLE_TEXT`` bytes. A text without any telling term (empty, null,
    all unknown) scores the share of 1 among such examples; if there are no examples of both
    labels, all score the labelled share of 1. ``size`` bounds the labelled rows that are indexed; word counts
    are over all documents, and every document is scored whole. Repeated rows each give a
    row; an empty table gives an empty result. Columns of ``docs`` named like the new ones
    are replaced.
    """
    docs = docs.drop(*names)
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, learn_from, size))
    place = docs.columns.index("text")
    id_kind = docs.schema["doc_id"].dataType
    id_type = to_arrow_type(id_kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, base = model.value["index"], model.value["base"]
        examples = Examples.of(index) if index else None
        for batch in batches:
            scores, evidence = [], []
            for text in batch.column(place):
                near = examples.nearest(terms(text.as_py())) if examples else ([], [])
                if len(near[0]):
                    scores.append(float(np.interp(examples.vote(*near), *model.value["knots"])))
                else:
                    scores.append(base)
                evidence.append(
                    [{"doc_id": examples.ids[i], "cosine": float(c)} for i, c in zip(*near)]
                )
            kind = pa.list_(pa.struct([("doc_id", id_type), ("cosine", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64()), pa.array(evidence, kind)],
                names=[*batch.schema.names, *names],
            )

    added = docs.withColumns(
        {
            names[0]: F.lit(0.0),
            names[1]: F.array().cast(T.ArrayType(T.StructType().add("doc_id", id_kind).add("cosine", "double"))),
        }
    )
    return docs.mapInArrow(run, added.schema)
