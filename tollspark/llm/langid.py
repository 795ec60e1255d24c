"""Language identification by multinomial naive Bayes over hashed character n-grams.

Characters are lower-cased, everything but letters becomes a space, and every run of one to three code points is hashed
to one of 2^16 slots. Training counts slots per language over all rows (each task adds up its own rows and emits sums,
which are added in one aggregate); only the counts reach the driver, languages x slots in number. The matrix of log
probabilities is broadcast, and texts are scored in numpy by summing its rows at their slots.

Null texts and texts without a letter are `und` with score 0. Null languages teach nothing. Without training rows every
text with a letter is `und`. Scores are the posterior of the predicted language.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollspark.llm.common import batches_with, column, widened

SLOTS = 1 << 16
_LETTER = re.compile(r"[^\W\d_]")
_OTHER = re.compile(r"[\W\d_]+")
_ODD = np.array([2654435761, 2246822519, 3266489917], dtype=np.uint32)  # odd multipliers for mixing
_PIECE = 1 << 18  # code points hashed at a time


def slots_of(text: str) -> Iterator[np.ndarray]:
    """Slots of all n-grams, in pieces that bound the memory for long texts."""
    clean = " " + _OTHER.sub(" ", text.lower()) + " "
    points = np.frombuffer(clean.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    for begin in range(0, len(points), _PIECE):
        one = points[begin:begin + _PIECE + 2] * _ODD[0]
        one ^= one >> 15
        two = (one[:-1] * _ODD[1]) + one[1:]
        three = (two[:-1] * _ODD[2]) + one[2:]
        for grams in (one[:_PIECE], two[:_PIECE], three[:_PIECE]):
            mixed = grams * _ODD[1]
            yield (mixed ^ mixed >> 13) * _ODD[0] >> 16


@dataclass(frozen=True)
class LanguageModel:
    names: list[str]
    prior: np.ndarray   # languages
    weight: np.ndarray  # slots x languages, log probabilities

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.names or text is None or not _LETTER.search(text):
            return "und", 0.0
        total = self.prior.copy()
        for slots in slots_of(text):
            total += self.weight[slots].sum(axis=0, dtype=np.float64)
        share = np.exp(total - total.max())
        share /= share.sum()
        best = int(share.argmax())
        return self.names[best], float(share[best])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of one task: (lang, slot, n); slot -1 counts the documents."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for text, lang in zip(column(batch, "text"), column(batch, "lang"), strict=True):
            own = sums.setdefault(lang, np.zeros(SLOTS + 1, dtype=np.int64))
            own[SLOTS] += 1
            for slots in slots_of(text):
                own[:SLOTS] += np.bincount(slots, minlength=SLOTS)
    for lang, own in sums.items():
        filled = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(filled)), pa.array(np.where(filled == SLOTS, -1, filled).astype(np.int32)),
             pa.array(own[filled])], names=["lang", "slot", "n"])


def fit(training: DataFrame, smoothing: float = 0.5, max_languages: int = 500) -> LanguageModel:
    """Learn from all rows of `training` (text, lang) where neither is null."""
    rows = training.select("text", "lang").where("text is not null and lang is not null")
    counts = rows.mapInArrow(_count, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    # One row per language: what reaches the driver is languages x slots, however many rows there are.
    packed = counts.groupBy("lang").agg(F.collect_list("slot").alias("slots"), F.collect_list("n").alias("counts")) \
        .limit(max_languages + 1).toArrow().sort_by("lang")
    if packed.num_rows > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    names = packed["lang"].to_pylist()
    table, docs = np.full((SLOTS, len(names)), smoothing), np.zeros(len(names))
    for i in range(len(names)):
        slots = packed["slots"][i].values.to_numpy()
        n = packed["counts"][i].values.to_numpy()
        docs[i] = n[slots < 0].sum()
        table[slots[slots >= 0], i] += n[slots >= 0]
    weight = np.log(table / table.sum(axis=0)).astype(np.float32)
    return LanguageModel(names, np.log((docs + 1) / (docs.sum() + len(names))) if names else docs, weight)


def predict(documents: DataFrame, model: LanguageModel, keep: list[str]) -> DataFrame:
    """The columns `keep` of every row with `lang_pred` and `score`."""
    held = documents.sparkSession.sparkContext.broadcast(model)

    def make(batch: pa.RecordBatch) -> dict:
        found = [held.value.predict(text) for text in column(batch, "_text")]
        return {"lang_pred": pa.array([name for name, _ in found], pa.string()),
                "score": pa.array([score for _, score in found], pa.float64())}

    return documents.select(*keep, F.col("text").alias("_text")).mapInArrow(
        lambda batches: batches_with(batches, keep, make), widened(documents, keep, "lang_pred string, score double"))
