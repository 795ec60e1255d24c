"""Toxicity by nearest labelled examples.

Terms are lower-cased words and, marked by `*`, their beginnings of four and five letters, which recognise inflected and
compounded forms. The vocabulary has all terms of the examples. A term weighs ln(1 + count) times
ln(common * (1 + documents) / (1 + documents with the term)), never below 0, with the document counts taken over all
documents: plain TF-IDF, with terms of more than the share `common` of all documents counting nothing. Labels have no
part in the weights. Examples and texts are unit vectors; a text's terms that no example has would shorten all its
cosines alike, and are not counted.

The search is exact. Examples lie in blocks of alike ones. For each term the index has its postings block by block, and
for each of these pieces the largest weight in it. The sum of a text's weights times these maxima bounds all cosines of a
block. The blocks with the highest bounds are added up first; then, of the others, those whose bound reaches the k-th best
cosine (all postings at once where that is most of them, by the k-th best of texts before or by the bounds). The votes of the k nearest, weighted by cosine and corrected for the sampling of the labels, give a raw score, and
a monotone curve fitted on the votes that examples get from each other, in tasks, makes it a probability.

Texts without any term that weighs something, null and empty ones included, have no neighbours and get the share of toxic
labels among training rows like them. Repeated labels count once, and a document labelled both ways is an example of
each. Of rows that repeat a drawn id the first text in order is the example. Labels of null or unknown documents are left
out. Without labels of both kinds every score is the share of toxic ones, or 0.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollspark.llm.common import batches_with, column, staged, widened

_WORD = re.compile(r"[^\W\d_]+")
#: Latin-1 with a space in place of all that is in no word.
_LETTERS = bytes(code if _WORD.match(chr(code)) else 32 for code in range(256))


def _words(text: str | None) -> list[str] | list[bytes]:
    """Lower-cased words, as Latin-1 bytes where the whole text is Latin-1, which is cut several times as fast."""
    text = (text or "").lower()
    try:
        return text.encode("latin-1").translate(_LETTERS).split()
    except UnicodeEncodeError:
        return _WORD.findall(text)


def terms_of(text: str | None) -> Counter:
    words = Counter(_WORD.findall((text or "").lower()))
    terms = Counter(words)
    for word, n in words.items():
        for size in (4, 5):
            if len(word) > size:
                terms[word[:size] + "*"] += n
    return terms


class Vocabulary:
    """Numbers of terms; `count` finds those of a text without making the others. The terms of a word are looked up once
    and remembered, for at most `memo` words at a time."""

    def __init__(self, terms: list[str], memo: int = 1 << 18):
        self.terms, self.memo = terms, memo
        self.words = {term: i for i, term in enumerate(terms) if term[-1] != "*"}
        self.four = {term[:4]: i for i, term in enumerate(terms) if term[-1] == "*" and len(term) == 5}
        self.five = {term[:5]: i for i, term in enumerate(terms) if term[-1] == "*" and len(term) == 6}
        self._seen: dict[str | bytes, int] = {}
        self._rows = np.empty((1024, 3), np.int32)

    def _remember(self, words: set[str] | set[bytes]) -> None:
        n, size = len(self._seen), len(self._seen) + len(words)
        while size > len(self._rows):
            self._rows = np.concatenate([self._rows, np.empty_like(self._rows)])
        texts = [word if isinstance(word, str) else word.decode("latin-1") for word in words]
        self._rows[n:size, 0] = [self.words.get(word, -1) for word in texts]
        self._rows[n:size, 1] = [self.four.get(word[:4], -1) if len(word) > 4 else -1 for word in texts]
        self._rows[n:size, 2] = [self.five.get(word[:5], -1) if len(word) > 5 else -1 for word in texts]
        self._seen.update(zip(words, range(n, size)))

    def count(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The terms of the text that are in the vocabulary, rising, and how often each occurs."""
        words = _words(text)
        if len(self._seen) > self.memo:
            self._seen = {}
        places = list(map(self._seen.get, words))
        if None in places:
            self._remember({word for word, place in zip(words, places) if place is None})
            places = list(map(self._seen.get, words))
        found = self._rows[np.array(places, dtype=np.int64)].ravel()
        return np.unique(found[found >= 0], return_counts=True)


def _alike(rows: np.ndarray, size: int) -> list[np.ndarray]:
    """Places of `rows` in groups of at most `size`, halved along the direction in which they differ most."""
    todo, done = [np.arange(len(rows))], []
    while todo:
        group = todo.pop()
        if len(group) <= size:
            done.append(group)
            continue
        centred = rows[group] - rows[group].mean(axis=0)
        direction = centred[np.abs(centred).sum(axis=1).argmax()]
        for _ in range(8):  # power iteration; any direction gives right results, a good one tighter bounds
            direction = centred.T @ (centred @ direction)
            direction /= np.linalg.norm(direction) or 1.0
        order = group[np.argsort(centred @ direction, kind="stable")]
        todo += [order[len(order) // 2:], order[:len(order) // 2]]
    return done


def _slices(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of all slices [begin, end), one after another, and the sizes of the slices."""
    size = end - begin
    places = np.repeat(begin - np.cumsum(size) + size, size)
    places += np.arange(len(places))
    return places, size


class BlockMaxIndex:
    """Examples as unit vectors, in postings by term and block with the largest weight of each piece."""

    _scratch = np.empty(0, np.intp), np.empty(0)

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], terms: int, block: int = 64, sketch: int = 256):
        self.examples = len(vectors)
        term = np.concatenate([ids for ids, _ in vectors] or [np.empty(0, np.int64)]).astype(np.int32)
        weight = np.concatenate([weights for _, weights in vectors] or [np.empty(0)])
        at = np.repeat(np.arange(len(vectors), dtype=np.int32), [len(ids) for ids, _ in vectors])
        # Blocks come from a sketch of the vectors, terms folded together.
        rows = np.bincount(at * np.int64(sketch) + term % sketch, weight, self.examples * sketch).reshape(-1, sketch)
        groups = _alike(rows, block)
        self.blocks, of = len(groups), np.empty(self.examples, np.int32)
        for number, group in enumerate(groups):
            of[group] = number
        order = np.lexsort((at, of[at], term))
        # As the type of places, or each sum would turn the examples of its postings into it first.
        self.example, self.weight, self.terms = at[order].astype(np.intp), weight[order], terms
        piece = term[order] * np.int64(max(1, self.blocks)) + of[at[order]]
        #: Piece p: postings from begin[p] to begin[p + 1], all of one term and block.
        self.begin = np.append(np.flatnonzero(np.diff(piece, prepend=-1)), len(piece))
        first = self.begin[:-1]
        self.block = of[self.example[first]]
        #: Pieces of term t: from start[t] on.
        self.start = np.searchsorted(term[order][first], np.arange(terms + 1))
        self.size = np.bincount(of, minlength=self.blocks)
        #: The k-th best cosine as a share of the highest bound, of late.
        self._reach = 1.0

    @cached_property
    def largest(self) -> np.ndarray:
        """Largest weight by term and block, rounded upwards; made where it is used, as it is many times the pieces."""
        found = np.zeros((self.terms, max(1, self.blocks)), np.float32)
        if len(self.block):
            most = np.maximum.reduceat(self.weight, self.begin[:-1]).astype(np.float32)
            term = np.repeat(np.arange(self.terms), np.diff(self.start))
            found[term, self.block] = np.nextafter(most, np.float32(2))
        return found

    def __getstate__(self) -> dict:
        return {name: value for name, value in self.__dict__.items() if name not in ("largest", "_scratch")}

    def _some(self, pieces: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Scores from the postings of some pieces."""
        return self._sums(self.begin[pieces], self.begin[pieces + 1], weights)

    def _whole(self, ids: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Scores from all postings of terms, which lie together."""
        return self._sums(self.begin[self.start[ids]], self.begin[self.start[ids + 1]], weights)

    def _sums(self, begin: np.ndarray, end: np.ndarray, weights: np.ndarray) -> np.ndarray:
        at, size = _slices(begin, end)
        if len(at) > len(self._scratch[0]):
            self._scratch = np.empty(2 * len(at), np.intp), np.empty(2 * len(at))
        # Into arrays that stay, as fresh memory for each text costs more than the sums; all places are in range.
        example, weight = self._scratch[0][:len(at)], self._scratch[1][:len(at)]
        self.example.take(at, out=example, mode="clip")
        self.weight.take(at, out=weight, mode="clip")
        weight *= np.repeat(weights, size)
        return np.bincount(example, weight, minlength=self.examples)

    def nearest(self, ids: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Examples (places in the list given) and cosines of the k nearest with a positive cosine, best first; ties go
        to the lower place. `without` is an example to leave out."""
        if not len(ids) or not self.examples:
            return np.empty(0, np.int64), np.empty(0)
        bounds = (weights.astype(np.float32) @ self.largest.take(ids, axis=0)).astype(float) * (1 + 1e-4)  # above what rounding may take
        order = np.argsort(-bounds, kind="stable")
        chosen = np.zeros(self.blocks, bool)
        chosen[order[:int(np.searchsorted(np.cumsum(self.size[order]), k + 1)) + 1]] = True
        # Where the k-th best will hardly reach the bounds of half of the examples, all are added up at once; a guess from
        # the texts before, which any answer to is right: both ways add an example's terms in the same order.
        prunes = self.size[chosen | (bounds >= self._reach * bounds[order[0]])].sum() * 2 < self.examples
        scores = np.zeros(self.examples)
        if prunes:
            places, size = _slices(self.start[ids], self.start[ids + 1])
            block, own = self.block[places], np.repeat(weights, size)
            now = chosen[block]
            scores = self._some(places[now], own[now])
            if without >= 0:
                scores[without] = 0.0
            reached = np.partition(scores, -k)[-k] if len(scores) > k else 0.0
            later = ~chosen & (bounds > 0) & (bounds >= reached - 1e-11)
            if self.size[later].sum() * 2 < self.examples:
                more = later[block]
                scores += self._some(places[more], own[more])
            else:  # the bounds rule out little, and whole terms are read faster than pieces
                scores = self._whole(ids, weights)
        else:
            scores = self._whole(ids, weights)
        if without >= 0:
            scores[without] = 0.0
        rounded = np.round(scores, 12)
        if len(scores) > k:
            reached = np.partition(rounded, -k)[-k]
            self._reach += (reached / bounds[order[0]] - self._reach) / 16 if bounds[order[0]] > 0 else 0.0
            found = np.flatnonzero((scores > 0) & (rounded >= reached))
        else:
            found = np.flatnonzero(scores > 0)
        found = found[np.lexsort((found, -rounded[found]))][:k]
        return found, scores[found]


@dataclass
class ToxicityModel:
    vocabulary: Vocabulary
    weight: np.ndarray
    index: BlockMaxIndex | None
    names: list[int] = field(default_factory=list)     # ids of the examples
    labels: np.ndarray = field(default_factory=lambda: np.empty(0))
    votes: np.ndarray = field(default_factory=lambda: np.empty(0))  # rows that an example stands for
    k: int = 100
    knots: tuple[np.ndarray, np.ndarray] | None = None
    without_terms: float = 0.0

    evidence: int = 15
    sent: Broadcast | None = None  # all of it but the curve, as sent for the curve's votes

    def vector(self, terms: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unit vector of rising `terms` that occur so many `times`."""
        known = self.weight[terms] > 0
        ids = terms[known].astype(np.int64)
        weights = np.log1p(times[known].astype(float)) * self.weight[ids]
        length = float(np.sqrt((weights ** 2).sum()))
        return ids, weights / length if length else weights

    def of_text(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        return self.vector(*self.vocabulary.count(text))

    def vote(self, ids: np.ndarray, weights: np.ndarray, without: int = -1) -> tuple[float, np.ndarray, np.ndarray]:
        """Raw score, and the evidence: examples and cosines."""
        found, cosines = self.index.nearest(ids, weights, self.k, without)
        share = cosines * self.votes[found]
        if without >= 0:  # the rest of its kind stands for it as well, or few examples would vote against their own kind
            own = self.labels[found] == self.labels[without]
            kind = int((self.labels == self.labels[without]).sum())
            share = np.where(own, share * kind / max(1, kind - 1), share)
        return float((share * self.labels[found]).sum() / share.sum()) if len(found) else 0.0, found, cosines

    def score(self, text: str | None) -> tuple[float, list[int]]:
        """Probability, and the ids of the nearest examples."""
        if self.index is None:
            return self.without_terms, []
        ids, weights = self.of_text(text)
        if not len(ids):
            return self.without_terms, []
        raw, found, _ = self.vote(ids, weights)
        if not len(found):
            return self.without_terms, []
        return float(np.interp(raw, *self.knots)), [self.names[i] for i in found[:self.evidence]]


def _monotone(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of a rising curve through weighted means (pool adjacent violators)."""
    pools: list[list[float]] = []
    for at, value, w in sorted(zip(x.tolist(), y.tolist(), weight.tolist(), strict=True)):
        pools.append([at * w, value * w, w])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    # Each level is drawn towards the mean by the weight of one row, so that no level is certain.
    mean, unit = float((y * weight).sum() / weight.sum()), float(weight.mean())
    return (np.array([a / w for a, _, w in pools]),
            np.array([(b + mean * unit) / (w + unit) for _, b, w in pools]))


def fit(documents: DataFrame, labels: DataFrame, max_examples: int = 4000, k: int = 100, common: float = 1.0,
        max_chars: int = 200_000, evidence: int = 15) -> ToxicityModel:
    """Learn from `labels` (doc_id, label 0 or 1) and the texts of `documents` (doc_id, text).

    At most `max_examples` labelled documents of each kind become examples, drawn in the order of a hash of the id and
    broadcast (their number is bounded); their terms reach the driver, so a drawn text of more than `max_chars` characters
    is no example. Document counts cover all documents.
    """
    spark = documents.sparkSession
    labels = labels.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).select("doc_id", "label").distinct()
    rows = {row.label: row.n for row in labels.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = rows.get(1, 0) / max(1, sum(rows.values()))
    constant = ToxicityModel(Vocabulary([]), np.empty(0), None, without_terms=share)
    if len(rows) < 2:
        return constant
    spread = F.xxhash64(F.col("doc_id").cast("string"), F.lit("toxicity"))
    drawn = [labels.where(F.col("label") == label).orderBy(spread, "doc_id").limit(max_examples) for label in (0, 1)]
    sample = spark.createDataFrame(drawn[0].union(drawn[1]).select("doc_id", F.col("label").cast("int")).collect(),
                                   "doc_id long, label int")
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chosen = staged(texts.join(F.broadcast(sample), "doc_id").where(F.coalesce(F.length("text"), F.lit(0)) <= max_chars)
                    .groupBy("doc_id", "label").agg(F.min("text").alias("text")), "examples")
    kinds = {row.label: row.n for row in chosen.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(kinds) < 2:
        return constant

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[str] = set()
        for batch in batches:
            for text in column(batch, "text"):
                found.update(terms_of(text))
        yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], names=["term"])

    vocabulary = Vocabulary(sorted(chosen.select("text").mapInArrow(words, "term string").distinct().toArrow()
                                   .column("term").to_pylist()))
    if not vocabulary.terms:
        return constant
    known = spark.sparkContext.broadcast(vocabulary)
    n, counts = _document_counts(texts, known)
    weights = np.maximum(0.0, np.log(common * (1 + n) / (1 + counts)))
    model = ToxicityModel(vocabulary, weights, None, k=k, without_terms=share, evidence=evidence)

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def make(batch: pa.RecordBatch) -> dict:
            counted = [known.value.count(text) for text in column(batch, "text")]
            return {"terms": pa.array([terms for terms, _ in counted], pa.list_(pa.int32())),
                    "counts": pa.array([times for _, times in counted], pa.list_(pa.int32()))}
        return batches_with(batches, ["doc_id", "label"], make)

    # As Arrow columns, since the terms of all examples would be many Python objects.
    found = chosen.mapInArrow(narrow, "doc_id long, label int, terms array<int>, counts array<int>").toArrow()
    examples = []
    for batch in found.to_batches():
        ends = batch.column("terms").offsets.to_numpy()
        terms, times = batch.column("terms").values.to_numpy(), batch.column("counts").values.to_numpy()
        examples += [(doc_id, label, *model.vector(terms[ends[i]:ends[i + 1]], times[ends[i]:ends[i + 1]]))
                     for i, (doc_id, label) in enumerate(zip(column(batch, "doc_id"), column(batch, "label"), strict=True))]
    examples.sort(key=lambda row: row[:2])
    weight = {label: rows[label] / kinds[label] for label in (0, 1)}
    blank = [label for _, label, ids, _ in examples if not len(ids)]
    model.without_terms = (weight[1] * sum(blank) + share) / (sum(weight[label] for label in blank) + 1)
    examples = [row for row in examples if len(row[2])]
    if not examples:
        return constant
    model.index = BlockMaxIndex([(ids, weights) for _, _, ids, weights in examples], len(vocabulary.terms))
    model.names = [row[0] for row in examples]
    model.labels = np.array([row[1] for row in examples], dtype=float)
    model.votes = np.array([weight[row[1]] for row in examples])
    raw = _own_votes(chosen, model)
    places = sorted(raw)
    model.knots = _monotone(np.array([raw[i] for i in places]), model.labels[places], model.votes[places])
    return model


def _own_votes(chosen: DataFrame, model: ToxicityModel) -> dict[int, float]:
    """What each example gets from the others, by its place; worked out in tasks."""
    held = model.sent = chosen.sparkSession.sparkContext.broadcast(replace(model))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {key: i for i, key in enumerate(zip(held.value.names, held.value.labels.astype(int).tolist()))}
        for batch in batches:
            at, raw = [], []
            for doc_id, label, text in zip(*(column(batch, name) for name in ("doc_id", "label", "text")), strict=True):
                if (doc_id, label) in place:
                    at.append(place[doc_id, label])
                    raw.append(held.value.vote(*held.value.of_text(text), without=at[-1])[0])
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(raw, pa.float64())], names=["at", "raw"])

    return dict(map(tuple, chosen.repartition("doc_id").mapInArrow(vote, "at long, raw double").collect()))


def _document_counts(texts: DataFrame, known: Broadcast) -> tuple[int, np.ndarray]:
    """Number of documents, and of those with each term, over all rows: each task adds up its own."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(known.value.terms) + 1, dtype=np.int64)
        for batch in batches:
            for text in column(batch, "text"):
                sums[known.value.count(text)[0]] += 1
                sums[-1] += 1
        seen = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(sums[seen])], names=["term", "n"])

    found = texts.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    sums = np.zeros(len(known.value.terms) + 1)
    found = found.toArrow()
    sums[found.column("term").to_numpy()] = found.column("n").to_numpy()
    return int(sums[-1]), sums[:-1]


def score(documents: DataFrame, model: ToxicityModel, keep: list[str]) -> DataFrame:
    """The columns `keep` of every row with `score` and `evidence`, the ids of the nearest examples, best first."""
    held = model.sent or documents.sparkSession.sparkContext.broadcast(replace(model))
    knots = model.knots

    def make(batch: pa.RecordBatch) -> dict:
        held.value.knots = knots
        found = [held.value.score(text) for text in column(batch, "_text")]
        return {"score": pa.array([value for value, _ in found], pa.float64()),
                "evidence": pa.array([ids for _, ids in found], pa.list_(pa.int64()))}

    return documents.select(*keep, F.col("text").alias("_text")).mapInArrow(
        lambda batches: batches_with(batches, keep, make), widened(documents, keep, "score double, evidence array<long>"))
