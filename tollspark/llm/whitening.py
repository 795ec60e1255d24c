"""Whitening of embeddings by the singular values of the centred rows, found without forming a covariance matrix.

Vectors become whole numbers x = floor(64 * c) + 1 000 000, so that their sums S, and n * x - S, are exact. Each task
reduces its centred rows to a triangle, block by block (QR of the triangle so far on top of the next rows); the
triangles are stacked and reduced in groups until a few are left for the driver, one matrix of dimensions x dimensions
each. Its last triangle R is brought to bidiagonal form; singular values come from dqds, directions from twisted
factorisations (module qd). The eigenvalue of a component is the squared singular value / n.

Vectors that are null, or hold null, non-finite entries or entries of 2^40 and more (whose x is no long) are left out, as
are empty ones and those whose length isn't the commonest (the greater of equally common ones). Repeated rows count and are
returned each. Dimensions in which all vectors agree take no part. Components are those whose singular value is above
rounding (dimensions * 2^-52 of the largest), so fewer than asked for where the vectors have a lower rank; none without
vectors, or where all are equal. `deviation` is null where the exact number is too large for a long. Other columns
can't clash: only those of `keep` are returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollspark.llm.common import staged, widened
from tollspark.llm.qd import EPS, right_singular

_LARGE = float(1 << 40)
_BLOCK = 4096     # rows of a QR step
_STACK = 32       # triangles combined at a time, and left for the driver at most
_OUT = 2048       # vectors turned into output rows at a time


def whole(lists: pa.Array, length: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, x) of the valid vectors of an Arrow list column: places and matrix, one pair per length."""
    starts, sizes = lists.offsets.to_numpy()[:-1], np.diff(lists.offsets.to_numpy())
    there = lists.is_valid().to_numpy(zero_copy_only=False)
    entries = pc.cast(lists.values, pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    for size in ([length] if length else np.unique(sizes[there & (sizes > 0)])):
        rows = np.flatnonzero(there & (sizes == size))
        # At most a slice of rows as floats at a time, whatever the batch holds.
        for begin in range(0, len(rows), _BLOCK):
            some = rows[begin:begin + _BLOCK]
            matrix = entries[starts[some][:, None] + np.arange(size)]
            with np.errstate(invalid="ignore"):
                valid = (np.abs(matrix) < _LARGE).all(axis=1)  # false for NaN
            yield some[valid], np.floor(matrix[valid] * 64).astype(np.int64) + 1_000_000


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per length: (size, place, n, total), the sums of one task."""
    counts: dict[int, int] = {}
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for rows, x in whole(batch.column(0)):
            size = x.shape[1]
            counts[size] = counts.get(size, 0) + len(rows)
            totals[size] = totals.get(size, 0) + x.sum(axis=0)
    for size, total in totals.items():
        yield pa.RecordBatch.from_arrays([pa.array(np.full(size, size)), pa.array(np.arange(size)),
                                          pa.array(np.full(size, counts[size])), pa.array(total)],
                                         names=["size", "place", "n", "total"])


@dataclass(frozen=True)
class Whitening:
    n: int
    total: np.ndarray        # S, whole numbers
    directions: np.ndarray   # dimensions x components, unit eigenvectors
    values: np.ndarray       # eigenvalues of the components
    trace: float
    identity_error: float | None = None

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self._scaled(x).astype(float) / self.n

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact; Python's numbers where a long could overflow."""
        if self.n * float(np.abs(x).max(initial=0)) + float(np.abs(self.total).max(initial=0)) < 2 ** 62:
            return self.n * x - self.total
        return self.n * x.astype(object) - self.total.astype(object)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.directions / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> pa.Array:
        scaled = self._scaled(x)
        if scaled.dtype != object and (scaled.astype(float) ** 2).sum(axis=1).max(initial=0) < 2 ** 62:
            return pa.array((scaled ** 2).sum(axis=1))
        exact = [sum(int(v) ** 2 for v in row) for row in scaled]
        return pa.array([v if v < 2 ** 63 else None for v in exact], pa.int64())


def _triangle(stack: np.ndarray) -> np.ndarray:
    found = np.linalg.qr(stack, mode="r")
    full = np.zeros((stack.shape[1], stack.shape[1]))
    full[:len(found)] = found
    return full


def _reduced(vectors: DataFrame, n: int, total: np.ndarray) -> np.ndarray:
    """R with R'R = sum of (x - S/n)(x - S/n)' over all valid vectors."""
    size, centre = len(total), Whitening(n, total, np.empty((len(total), 0)), np.empty(0), 0.0)

    def rows_to_triangle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        triangle = None
        for batch in batches:
            for rows, x in whole(batch.column(0), size):
                if len(rows):
                    block = centre.centred(x)
                    triangle = _triangle(block if triangle is None else np.vstack([triangle, block]))
        if triangle is not None:
            yield packed(triangle)

    def packed(triangle: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([triangle.ravel().tolist()])], names=["r"])

    def stack(part: pa.Table) -> pa.Table:
        entries = part.column("r").combine_chunks().flatten().to_numpy()
        return pa.Table.from_batches([packed(_triangle(entries.reshape(-1, size)))])

    parts = staged(vectors.mapInArrow(rows_to_triangle, "r array<double>"), "triangles")
    left = parts.count()
    while left > _STACK:
        groups = -(-left // _STACK)
        dealt = parts.select(F.pmod(F.hash("r"), F.lit(groups)).alias("of"), "r")
        parts = staged(dealt.groupBy("of").applyInArrow(stack, "r array<double>"), "triangles")
        left = parts.count()
    last = [np.array(row.r).reshape(-1, size) for row in parts.collect()]
    return _triangle(np.vstack(last)) if last else np.zeros((size, size))


def fit(vectors: DataFrame, column: str = "embedding", components: int = 32) -> Whitening:
    """Learn from all valid vectors of `column`; `identity_error` is measured over them in another pass."""
    vectors = vectors.select(F.col(column).alias("vector"))
    sums = staged(vectors.mapInArrow(_sums, "size long, place long, n long, total long").groupBy("size", "place").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total")), "sums")
    commonest = sums.where("place = 0").orderBy(F.desc("n"), F.desc("size")).select("size", "n").first()
    if commonest is None:
        return Whitening(0, np.empty(0, np.int64), np.empty((0, 0)), np.empty(0), 0.0)
    of_size = sums.where(F.col("size") == commonest["size"]).orderBy("place")  # as many rows as the vectors have entries
    n, total = commonest["n"], np.array([row.total for row in of_size.collect()], dtype=np.int64)
    triangle = _reduced(vectors, n, total)
    used = np.flatnonzero((triangle != 0).any(axis=0))
    values, directions = np.empty(0), np.empty((len(total), 0))
    if len(used):
        found, columns = right_singular(_triangle(triangle[:, used]))
        rank = int((np.sqrt(found) > len(total) * EPS * np.sqrt(found[0])).sum())
        values = found[:min(rank, components)] / n
        directions = np.zeros((len(total), len(values)))
        directions[used] = columns[:, :len(values)]
    model = Whitening(n, total, directions, values, float((triangle ** 2).sum() / n))
    return Whitening(n, total, directions, values, model.trace, _identity_error(vectors, model))


def _identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest entry, in size, of the covariance of the whitened vectors minus the identity. They are centred already."""
    size, k = len(model.total), len(model.values)
    upper = np.triu_indices(k)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = sent.value, np.zeros((k, k))
        for batch in batches:
            for _, x in whole(batch.column(0), size):
                white = held.whitened(x)
                total += white.T @ white
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(upper[0]))), pa.array(total[upper])], names=["at", "sum"])

    if not k:
        return 0.0
    sent = vectors.sparkSession.sparkContext.broadcast(model)
    sums = vectors.mapInArrow(products, "at long, sum double").groupBy("at").agg(F.sum("sum").alias("sum")).collect()
    return max(abs(row["sum"] / model.n - (upper[0][row["at"]] == upper[1][row["at"]])) for row in sums)


def apply(vectors: DataFrame, model: Whitening, keep: list[str], column: str = "embedding") -> DataFrame:
    """A row per valid vector and component: the columns `keep`, component (from 1), n, deviation, whitened, explained
    and identity_error."""
    size, k = len(model.total), len(model.values)
    sent = vectors.sparkSession.sparkContext.broadcast(model)
    added = "component int, n long, deviation long, whitened double, explained double, identity_error double"

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sent.value
        for batch in batches:
            kept = [batch.column(i) for i in range(len(keep))]
            for rows, x in whole(batch.column(len(keep)), size) if k else ():
                for begin in range(0, len(rows), _OUT):
                    some, own = rows[begin:begin + _OUT], x[begin:begin + _OUT]
                    many = len(some) * k
                    repeat = pa.array(np.repeat(some, k))
                    columns = [c.take(repeat) for c in kept]
                    columns += [pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(some))),
                                pa.array(np.full(many, held.n)),
                                held.deviations(own).take(pa.array(np.repeat(np.arange(len(some)), k))),
                                pa.array(held.whitened(own).ravel()),
                                pa.array(np.tile(held.values / held.trace, len(some))),
                                pa.array(np.full(many, held.identity_error))]
                    yield pa.RecordBatch.from_arrays(columns, names=[*keep, *added_names])

    added_names = [part.split()[0] for part in added.split(", ")]
    return vectors.select(*keep, F.col(column).alias("_vector")).mapInArrow(expand, widened(vectors, keep, added))
