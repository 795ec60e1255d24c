"""Quality classifier by compression.

Two zstandard dictionaries are built, one from good and one from bad labelled text. A text is cut into pieces of one
size and every piece compressed with both; the difference of the two sizes, divided by the text's size, says which
dictionary knows the text better. Pieces keep the difference independent of the text's length, as a dictionary only
helps at the start of a stream. A weighted logistic curve fitted on other labelled rows turns it into a probability.

Nulls and empty texts have no difference (0) and get the curve's value there; labels of unknown or null documents are
left out; repeated labels count once per row. Without any label of a class every score is the share of good labels, or
0.5 without labels at all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollspark.llm.common import batches_with, column, widened


@dataclass(frozen=True)
class CompressionModel:
    good: bytes | None
    bad: bytes | None
    slope: float
    offset: float
    piece: int
    level: int

    def compressors(self) -> tuple:
        made = []
        for content in (self.good, self.bad):
            known = zstandard.ZstdCompressionDict(content)
            known.precompute_compress(level=self.level)
            made.append(zstandard.ZstdCompressor(level=self.level, dict_data=known, write_checksum=False,
                                                 write_content_size=False, write_dict_id=False))
        return tuple(made)

    def probability(self, difference: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.offset + self.slope * difference, -30, 30)))


def difference(text: str | None, good, bad, piece: int) -> float:
    """(size with the bad dictionary - size with the good one) / size of the text in UTF-8."""
    data = (text or "").encode("utf-8", "surrogatepass")
    gain = 0
    for begin in range(0, len(data), piece):
        part = data[begin:begin + piece]
        gain += len(bad.compress(part)) - len(good.compress(part))
    return gain / len(data) if data else 0.0


def _differences(texts: list, model: CompressionModel) -> np.ndarray:
    if model.good is None:
        return np.zeros(len(texts))
    good, bad = model.compressors()
    return np.array([difference(text, good, bad, model.piece) for text in texts], dtype=float)


def _sample(labels: DataFrame, rows: int) -> dict[int, list[tuple]]:
    """The first ids of each class in the order of a hash of the id, at most `rows`: (id, label), a bounded sample."""
    spread = F.xxhash64(F.col("doc_id").cast("string"), F.lit("quality"))
    return {label: [(row.doc_id, label) for row in
                    labels.where(F.col("label") == label).orderBy(spread, "doc_id").limit(rows).collect()]
            for label in (0, 1)}


def _dictionary(pieces: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the pieces themselves where there are too few to train on."""
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[:size]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset by damped Newton steps, with a small ridge that keeps separable samples finite."""
    scale = float(np.std(x)) or 1.0
    design, beta = np.stack([np.ones_like(x), x / scale], axis=1), np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weight * (y - p)) - 0.01 * beta
        hessian = design.T @ (design * (weight * p * (1 - p))[:, None]) + 0.01 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta = beta + step / max(1.0, float(np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return float(beta[1] / scale), float(beta[0])


def fit(documents: DataFrame, labels: DataFrame, dictionary_rows: int = 1500, calibration_rows: int = 3000,
        dictionary_size: int = 112_640, piece: int = 2048, level: int = 3) -> CompressionModel:
    """Learn from `labels` (doc_id, label 0 or 1) and the texts of `documents` (doc_id, text).

    At most `dictionary_rows` documents of each class give one piece each to the dictionaries and at most
    `calibration_rows` others of each class fit the curve. The ids are drawn in the order of a hash and broadcast (their
    number is bounded by these parameters), so the documents are scanned and never shuffled.
    """
    spark = documents.sparkSession
    labels = labels.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).select("doc_id", "label")
    shares = {row.label: row.n for row in labels.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(shares.values())
    prior = shares.get(1, 0) / total if total else 0.5
    constant = CompressionModel(None, None, 0.0, math.log((prior + 1e-4) / (1 - prior + 1e-4)), piece, level)
    if len(shares) < 2:
        return constant
    drawn = _sample(labels, dictionary_rows + calibration_rows)
    # Small classes are shared between the two uses in the proportion of the parameters.
    part = dictionary_rows / (dictionary_rows + calibration_rows)
    ids, rest = [], []
    for rows in drawn.values():
        cut = min(dictionary_rows, max(1, round(len(rows) * part)))
        ids += rows[:cut]
        rest += rows[cut:]
    schema = labels.select("doc_id", F.col("label").cast("int")).schema
    texts = documents.select("doc_id", "text").where(F.col("text").isNotNull())
    # One piece per document, from a place that the id's hash picks.
    data = F.encode("text", "UTF-8")
    place = F.pmod(F.xxhash64("doc_id"), F.greatest(F.length(data) - piece, F.lit(0)) + 1).cast("int")
    chosen = texts.join(F.broadcast(spark.createDataFrame(ids, schema)), "doc_id") \
        .select("doc_id", "label", F.substring(data, place + 1, F.lit(piece)).alias("piece")).collect()
    pieces = {label: [bytes(row.piece) for row in sorted(chosen, key=lambda row: (row.doc_id, bytes(row.piece)))
                      if row.label == label and row.piece] for label in (0, 1)}
    if not pieces[0] or not pieces[1]:
        return constant
    model = CompressionModel(_dictionary(pieces[1], dictionary_size), _dictionary(pieces[0], dictionary_size), 0.0,
                             0.0, piece, level)
    seen = _calibration(texts, spark.createDataFrame(rest or ids, schema), model)
    y = np.array([row.label for row in seen], dtype=float)
    if len(set(y)) < 2:
        return constant
    x = np.array([row.difference for row in seen], dtype=float)
    counts = {label: float((y == label).sum()) for label in (0, 1)}
    weight = np.where(y == 1, shares[1] / counts[1], shares[0] / counts[0]) * len(y) / total
    slope, offset = _logistic(x, y, weight)
    return CompressionModel(model.good, model.bad, slope, offset, piece, level)


def _calibration(texts: DataFrame, rows: DataFrame, model: CompressionModel) -> list:
    held = texts.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batches_with(batches, ["doc_id", "label"],
                            lambda b: {"difference": pa.array(_differences(column(b, "text"), held.value))})

    chosen = texts.join(F.broadcast(rows), "doc_id")
    return sorted(chosen.mapInArrow(measure, widened(chosen, ["doc_id", "label"], "difference double")).collect(),
                  key=lambda row: (row.doc_id, row.difference))


def score(documents: DataFrame, model: CompressionModel, keep: list[str]) -> DataFrame:
    """The columns `keep` of every row, with `difference` and `score`, the probability of good text. One narrow pass."""
    held = documents.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def make(batch):
            found = _differences(column(batch, "_text"), held.value)
            return {"difference": pa.array(found), "score": pa.array(held.value.probability(found))}
        return batches_with(batches, keep, make)

    return documents.select(*keep, F.col("text").alias("_text")) \
        .mapInArrow(measure, widened(documents, keep, "difference double, score double"))
