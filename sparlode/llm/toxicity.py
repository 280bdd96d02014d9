"""Toxicity by the nearest labelled examples.

Examples are a bounded, documented sample of labelled documents: those with the smallest
hashes of their identifier. All lower-case words of the examples are terms. A document is a
vector over them of length 1: (1 + log tf) * idf * association, where idf counts all documents
and association is a floor plus the root of what the term's log-likelihood ratio with the label,
over the examples, has above chance. Association only weighs, it removes no term: without it,
words that say nothing about the label decide who is near. Examples with the same vector are one entry with their labels
counted, so ties cost nothing.

The index is inverted: a term's postings lie by block of entries, with the term's maximal
weight in each block. A query bounds every block by its weights times these maxima, scores the
blocks with the highest bounds, then all others whose bound reaches the last neighbour needed:
the nearest entries are exact. Neighbours vote with their cosine as weight; the vote becomes a
probability by monotone regression over the examples, each judged by the others.

The index is bounded by `max_examples` and `max_postings` and is broadcast. Scoring needs no
shuffle; counting documents by term is one pass before it.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch

WORD = regex.compile(r"\p{L}+")
#: Entries of a block, and blocks that are scored first.
BLOCK, FIRST = 128, 2

#: Weight of a term that says nothing about the label, and the log-likelihood ratio that chance exceeds for one term in a hundred.
FLOOR, CHANCE = 0.1, 6.63


def word_counts(text: str | None) -> Counter:
    return Counter(WORD.findall((text or "").lower()))


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


class Vocabulary:
    """The terms that documents are compared by: term -> number in order, and each number's weight."""

    def __init__(self, terms: dict[str, int], weight: np.ndarray):
        self.terms, self.weight, self.names = terms, weight, list(terms)

    def vector(self, counts: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers and weights of a document's words, of length 1."""
        at = np.fromiter((self.terms.get(w, -1) for w in counts), dtype=np.int64, count=len(counts))
        order = np.argsort(at)
        order = order[np.searchsorted(at[order], 0) :]
        at, many = at[order], np.fromiter(counts.values(), dtype=np.float64, count=len(counts))[order]
        weight = (1.0 + np.log(many)) * self.weight[at]
        length = math.sqrt(float(weight @ weight))
        return (at, weight / length) if length > 0.0 else (at[:0], weight[:0])


class Index:
    """Exact nearest entries by cosine, with block-max bounds."""

    def __init__(self, vocabulary: Vocabulary, examples: Iterable[tuple[int, np.ndarray, np.ndarray, int]], neighbours: int, evidence: int = 3):
        """examples: identifier, term numbers, weights, label; in order of identifiers."""
        self.vocabulary, self.neighbours = vocabulary, neighbours
        entries: dict[tuple, list] = {}
        for doc_id, at, weight, label in examples:
            entry = entries.setdefault((at.tobytes(), np.round(weight, 12).tobytes()), [0, 0, [], at, weight])
            entry[0] += 1
            entry[1] += label
            if len(entry[2]) < evidence:
                entry[2].append(doc_id)
        total = [sum(e[k] for e in entries.values()) for k in (0, 1)]
        self.base = (total[1] + 0.5) / (total[0] + 1.0)
        none = entries.pop((b"", b""), [0, 0, []])
        self.none = (none[0], none[1], none[2])
        # Entries led by the same term lie together, which makes the bounds tight.
        rows = sorted(entries.values(), key=lambda e: (int(e[3][np.argmax(e[4])]), -float(e[4].max()), e[2][0]))
        self.count = np.array([e[0] for e in rows], dtype=np.int64)
        self.positive = np.array([e[1] for e in rows], dtype=np.int64)
        self.ids = [e[2] for e in rows]
        self.blocks = math.ceil(len(rows) / BLOCK)
        entry = np.repeat(np.arange(len(rows), dtype=np.int32), np.array([len(e[3]) for e in rows], dtype=np.int64))
        term = np.concatenate([e[3] for e in rows]) if rows else np.zeros(0, dtype=np.int64)
        weight = np.concatenate([e[4] for e in rows]) if rows else np.zeros(0)
        order = np.argsort(term, kind="stable")
        term, self.entry, self.weight = term[order], entry[order], weight[order]
        # Lists: the postings of one term in one block.
        block = self.entry // BLOCK
        first = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (block[1:] != block[:-1])]) if len(term) else np.zeros(0, dtype=np.int64)
        self.start = np.r_[first, len(term)].astype(np.int64)
        self.block = block[first].astype(np.int32)
        self.most = np.maximum.reduceat(self.weight, first) if len(term) else np.zeros(0)
        self.lists = np.searchsorted(term[first], np.arange(len(vocabulary.weight) + 1))
        self.curve = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def nearest(self, at: np.ndarray, weight: np.ndarray, skip: int = -1) -> list[tuple[float, int]]:
        """(cosine, entry) of the nearest entries, nearest first, until `neighbours` examples are met; ties go to the earlier entry.

        skip is an entry of which one example is left out.
        """
        if not len(at) or not len(self.count):
            return []
        many = self.lists[at + 1] - self.lists[at]
        lists, asked = _ranges(self.lists[at], many), np.repeat(weight, many)
        block = self.block[lists]
        bounds = np.bincount(block, weights=self.most[lists] * asked, minlength=self.blocks)
        order = np.argsort(-bounds, kind="stable")
        scores = np.zeros(len(self.count))
        early = np.zeros(self.blocks, dtype=bool)
        early[order[:FIRST]] = True
        self._add(scores, lists, asked, early[block])
        found, reach = self._best(scores, skip)
        late = ~early & (bounds > 0.0) & (bounds >= reach - 1e-9)
        if late.any():
            self._add(scores, lists, asked, late[block])
            found, _ = self._best(scores, skip)
        return found

    def _add(self, scores: np.ndarray, lists: np.ndarray, asked: np.ndarray, taken: np.ndarray) -> None:
        lists, asked = lists[taken], asked[taken]
        lengths = self.start[lists + 1] - self.start[lists]
        spots = _ranges(self.start[lists], lengths)
        scores += np.bincount(self.entry[spots], weights=self.weight[spots] * np.repeat(asked, lengths), minlength=len(scores))

    def _best(self, scores: np.ndarray, skip: int) -> tuple[list[tuple[float, int]], float]:
        """The nearest of the entries scored, and the similarity that others must reach."""
        k = self.neighbours + 1  # entries stand for one example at least, but for the one left out
        low = max(0.0, float(np.partition(scores, -k)[-k])) if len(scores) > k else 0.0
        near = np.flatnonzero((scores > 0.0) & (scores >= low - 1e-9))
        near = near[np.lexsort((near, -np.round(scores[near], 9)))]
        met = np.cumsum(self.count[near] - (near == skip))
        last = int(np.searchsorted(met, self.neighbours))
        found = [(float(scores[e]), int(e)) for e in near[: last + 1]]
        return found, found[-1][0] if last < len(near) else 0.0

    def vote(self, at: np.ndarray, weight: np.ndarray, skip: tuple[int, int] = (-1, 0)) -> tuple[float, list[tuple[float, int]]]:
        """The weighted share of positive neighbours, drawn to the base rate where neighbours are few or far."""
        near = self.nearest(at, weight, skip[0])
        if not near:
            return (self.none[1] + self.base) / (self.none[0] + 1.0), near
        up = total = 0.0
        for score, entry in near:
            own = entry == skip[0]
            up += score * (int(self.positive[entry]) - skip[1] * own)
            total += score * (int(self.count[entry]) - own)
        return (up + self.base) / (total + 1.0), near

    def calibrate(self) -> None:
        """Monotone regression of labels on votes, every example judged without itself."""
        votes, good, size = [], [], []
        term = np.repeat(np.arange(len(self.lists) - 1), self.start[self.lists[1:]] - self.start[self.lists[:-1]])
        order = np.argsort(self.entry, kind="stable")
        ends = np.searchsorted(self.entry[order], np.arange(len(self.count) + 1))
        for entry in range(len(self.count)):
            own = order[ends[entry] : ends[entry + 1]]
            for label, many in ((1, int(self.positive[entry])), (0, int(self.count[entry] - self.positive[entry]))):
                if many:
                    votes.append(self.vote(term[own], self.weight[own], (entry, label))[0])
                    good.append(label * many)
                    size.append(many)
        if self.none[0]:
            votes.append(self.vote(np.zeros(0, dtype=np.int64), np.zeros(0))[0])
            good.append(self.none[1])
            size.append(self.none[0])
        if not votes:
            return
        order = np.argsort(votes, kind="stable")
        pools: list[list[float]] = []  # votes' sum, positives, examples
        for i in order:
            pools.append([votes[i] * size[i], good[i], size[i]])
            while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
                last = pools.pop()
                pools[-1] = [a + b for a, b in zip(pools[-1], last)]
        x = np.array([p[0] / p[2] for p in pools])
        y = np.array([(p[1] + self.base) / (p[2] + 1.0) for p in pools])
        self.curve = (x, np.maximum.accumulate(y))

    def score(self, text: str | None) -> tuple[float, list[tuple[float, int]], list[str]]:
        """The calibrated score, the neighbours, and the text's terms of the greatest weight."""
        at, weight = self.vocabulary.vector(word_counts(text))
        raw, near = self.vote(at, weight)
        telling = [self.vocabulary.names[k] for k in at[np.argsort(-weight, kind="stable")[:16]].tolist()]
        return float(min(1.0, max(0.0, np.interp(raw, *self.curve)))), near, telling


def association(positive_with: np.ndarray, negative_with: np.ndarray, positive: int, negative: int) -> np.ndarray:
    """How strongly each term goes with the label, from the positive and negative examples that have it: FLOOR for what chance explains."""

    def part(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a * np.log(np.maximum(a, 1e-300) / np.maximum(b, 1e-300))

    total, k = positive + negative, positive_with + negative_with
    g = sum(part(a.astype(float), n * side / max(1, total)) for a, n, side in ((positive_with, k, positive), (negative_with, k, negative), (positive - positive_with, total - k, positive), (negative - negative_with, total - k, negative)))
    return FLOOR + np.sqrt(np.maximum(2.0 * g - CHANCE, 0.0))


def _example_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = [word_counts(t.as_py()) for t in batch.column(1)]
        yield pa.record_batch(
            [batch.column(0), batch.column(2), pa.array([list(c) for c in counts], pa.list_(pa.string())), pa.array([list(c.values()) for c in counts], pa.list_(pa.int64()))],
            names=["id", "label", "words", "counts"],
        )


def _document_counts(batches: Iterator[pa.RecordBatch], shipped) -> Iterator[pa.RecordBatch]:
    """(term, n): documents that hold each term; term -1 counts all documents."""
    terms: dict[str, int] = shipped.value
    found = np.zeros(len(terms) + 1, dtype=np.int64)
    for batch in batches:
        for text in batch.column(0):
            words = set(WORD.findall((text.as_py() or "").lower()))
            found[[terms[w] for w in words if w in terms]] += 1
            found[-1] += 1
    at = np.flatnonzero(found)
    yield pa.record_batch([pa.array(np.where(at == len(terms), -1, at)), pa.array(found[at])], names=["term", "n"])


def fit(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    max_examples: int = 2000, max_postings: int = 4_000_000, neighbours: int = 15,
) -> Index:
    """An index of at most max_examples labelled documents with at most max_postings different words, added up over documents.

    The sample is the labelled identifiers with the smallest hashes, in that order until a
    bound is met (the first one always counts). Rows whose label or identifier is null are
    left out; of several labels of one identifier or text the largest counts. The number of
    documents that hold a term is counted over all of docs.
    """
    marked = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).where("id IS NOT NULL AND label IS NOT NULL")
    chosen = marked.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(max_examples)
    scratch = Scratch(spark, "toxicity")
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    # Copies of a text are one example; if their labels differ, the largest counts.
    sample = texts.join(F.broadcast(chosen), "id").groupBy("text").agg(F.min("id").alias("id"), F.max("label").alias("label")).select("id", "text", "label")
    rows = scratch.put(sample.mapInArrow(_example_rows, "id long, label int, words array<string>, counts array<long>"), "examples")
    sizes = rows.select("id", F.xxhash64("id").alias("hash"), F.size("words").alias("n")).orderBy("hash", "id").toArrow()
    taken = int(np.searchsorted(np.cumsum(sizes["n"].to_numpy()), max_postings, side="right")) if len(sizes) else 0
    kept = set(sizes["id"].to_pylist()[: max(1, taken)])
    edge = sizes["hash"].to_pylist()[max(1, taken) - 1] if len(sizes) else 0
    got = rows.where(F.xxhash64("id") <= edge).toArrow().sort_by("id")
    terms: dict[str, int] = {}
    examples = []
    for i, label, words, counts in zip(*(got[c] for c in ("id", "label", "words", "counts"))):
        if i.as_py() in kept:
            at = np.array([terms.setdefault(w, len(terms)) for w in words.as_py()], dtype=np.int64)
            examples.append((i.as_py(), int(label.as_py() > 0), at, np.array(counts.as_py(), dtype=np.int64)))
    del got
    scratch.drop("examples")
    shipped = spark.sparkContext.broadcast(terms)
    counted = texts.select("text").mapInArrow(lambda it: _document_counts(it, shipped), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    holding = np.zeros(len(terms) + 1)
    holding[counted["term"].to_numpy()] = counted["n"].to_numpy()  # -1, all documents, comes last
    shipped.unpersist()
    sides = [np.bincount(np.concatenate([at for _, y, at, _ in examples if y == label] or [np.zeros(0, dtype=np.int64)]), minlength=len(terms)) for label in (1, 0)]
    positive = sum(y for _, y, *_ in examples)
    weight = (np.log((1.0 + holding[-1]) / (1.0 + holding[:-1])) + 1.0) * association(*sides, positive, len(examples) - positive)
    vocabulary = Vocabulary(terms, weight)
    index = Index(vocabulary, ((i, *vocabulary.vector({vocabulary.names[a]: n for a, n in zip(at.tolist(), many.tolist())}), y) for i, y, at, many in examples), neighbours)
    index.calibrate()
    return index


def _scored(batches: Iterator[pa.RecordBatch], shipped, threshold: float) -> Iterator[pa.RecordBatch]:
    index = shipped.value
    for batch in batches:
        rows: list[list] = [[], [], [], [], []]
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            score, near, telling = index.score(text.as_py())
            values = (doc_id, score, int(score >= threshold), [d for _, e in near for d in index.ids[e]][:5], telling)
            for column, value in zip(rows, values):
                column.append(value)
        kinds = (pa.int64(), pa.float64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.string()))
        yield pa.record_batch([pa.array(c, k) for c, k in zip(rows, kinds)], names=["doc_id", "score", "predicted", "neighbours", "terms"])


def score(spark: SparkSession, docs: DataFrame, index: Index, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """One row per document: doc_id, score, predicted, neighbours, terms.

    score is the calibrated probability of label 1, predicted is 1 from `threshold` on.
    neighbours (identifiers of the nearest examples) and terms (the at most 16 heaviest of
    the text) are the evidence. Null, empty and other texts without a term of an example get
    the rate of such examples. Without examples every score is 0.5. Rows repeated under one
    id are scored each; an empty table gives an empty result; other columns are ignored.
    """
    shipped = spark.sparkContext.broadcast(index)
    source = docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`"))
    return source.mapInArrow(lambda it: _scored(it, shipped, threshold), "doc_id long, score double, predicted int, neighbours array<long>, terms array<string>")


def reject_toxic(spark: SparkSession, docs: DataFrame, index: Index, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The documents scored below the threshold; columns stay as they are."""
    shipped = spark.sparkContext.broadcast(index)

    def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            yield batch.filter(pa.array([shipped.value.score(t.as_py())[0] < threshold for t in texts], pa.bool_()))

    return docs.mapInArrow(below, docs.schema)
