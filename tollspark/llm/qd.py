"""Singular values and right singular vectors of a small square matrix by its bidiagonal form.

`bidiagonal` reduces by Householder reflections, `dqds` finds the squared singular values by shifted quotient-difference
sweeps (Fernando and Parlett), and `vectors` recovers the directions from twisted factorisations of B'B - value * I
(Dhillon and Parlett): the stationary factorisation from the top and the progressive one from the bottom meet where the
remaining pivot is smallest. Both work on the pivots themselves, so small values are as accurate as large ones.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)
#: An off-diagonal square is negligible beside its neighbours from this ratio down.
_SPLIT = (10 * EPS) ** 2
#: Values closer than this, relatively, are a cluster, whose vectors come from inverse iteration beside the earlier ones.
_CLUSTER = 1e-4


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """A unit vector v so that x - 2 v (v'x) has only a first entry, and that entry."""
    length = float(np.linalg.norm(x))
    v = x.copy()
    if length == 0:
        return v, 0.0
    first = -length if x[0] > 0 else length
    v[0] -= first
    size = float(np.linalg.norm(v))
    return (v / size if size else v), first


def bidiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal, neither negative, of B, and the orthogonal V with matrix = U B V'."""
    work, n = np.array(matrix, dtype=float), len(matrix)
    right, diagonal, above = np.eye(n), np.zeros(n), np.zeros(max(0, n - 1))
    for k in range(n):
        v, diagonal[k] = _reflector(work[k:, k])
        work[k:, k:] -= 2 * np.outer(v, v @ work[k:, k:])
        if k < n - 1:
            v, above[k] = _reflector(work[k, k + 1:])
            work[k:, k + 1:] -= 2 * np.outer(work[k:, k + 1:] @ v, v)
            right[:, k + 1:] -= 2 * np.outer(right[:, k + 1:] @ v, v)
    # Signs go into the columns of V (and of U, which nobody asks for).
    sign = 1.0
    for k in range(n):
        right[:, k] *= sign
        if k < n - 1:
            sign *= (-1 if diagonal[k] < 0 else 1) * (-1 if above[k] < 0 else 1)
    return np.abs(diagonal), np.abs(above), right


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One dqds transform, or None where the shift is above the smallest value."""
    n, d, new_q, new_e = len(q), q[0] - shift, [], []
    for i in range(n - 1):
        if d < 0:
            return None
        top = d + e[i]
        new_q.append(top)
        if top == 0:  # decoupled: the rest starts anew
            new_e.append(0.0)
            d = q[i + 1] - shift
        else:
            ratio = q[i + 1] / top
            new_e.append(e[i] * ratio)
            d = d * ratio - shift
    if not d >= 0:
        return None
    return new_q + [d], new_e


def _guess(q: list[float], e: list[float]) -> float:
    """The smaller value of the last two rows of B'B, an upper bound of the smallest value that soon becomes sharp."""
    upper = q[-2] + (e[-2] if len(e) > 1 else 0.0)
    lower, cross = q[-1] + e[-1], q[-2] * e[-1]
    root = np.hypot((upper - lower) / 2, cross ** 0.5)
    large = (upper + lower) / 2 + root
    return max(0.0, (upper * lower - cross) / large) if large else 0.0


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of a bidiagonal matrix, falling."""
    found, blocks = [], [([float(a) ** 2 for a in diagonal], [float(b) ** 2 for b in above], 0.0)]
    sweeps = 0
    while blocks:
        q, e, moved = blocks.pop()
        while q:
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= _SPLIT * (moved + min(q[i], q[i + 1]))), None)
            if cut is not None:
                blocks.append((q[:cut + 1], e[:cut], moved))
                q, e = q[cut + 1:], e[cut + 1:]
            if len(q) == 1:
                found.append(moved + q[0])
                break
            if q[0] < q[-1]:  # the small end belongs to the bottom; the reversed product has the same values
                q, e = _reversed(q, e)
            guess = _guess(q, e)
            for part in (1 - 1e-3, 0.75, 0.5, 0.2, 0.05, 0.0):
                step = _sweep(q, e, guess * part)
                if step:
                    (q, e), moved = step, moved + guess * part
                    break
            sweeps += 1
            if sweeps > 200 * (len(diagonal) + 1):
                raise ArithmeticError("the singular values do not settle")
    return np.sort(np.array(found))[::-1]


def _reversed(q: list[float], e: list[float]) -> tuple[list[float], list[float]]:
    """The array of the flipped matrix: B' read from the bottom is an upper bidiagonal with the same singular values."""
    return q[::-1], e[::-1]


class _Twisted:
    """Twisted factorisation of L D L' - value, with D and L of B'B = L D L'."""

    def __init__(self, pivots: np.ndarray, below: np.ndarray, value: float):
        n, tiny = len(pivots), EPS * EPS * float(pivots.max()) + np.finfo(float).tiny
        self.down, self.up = np.zeros(n), np.zeros(n)           # pivots from the top and from the bottom
        self.left, self.right = np.zeros(n), np.zeros(n)        # multipliers
        s, rest = -value, np.zeros(n)
        for i in range(n):
            rest[i] = s
            self.down[i] = pivots[i] + s or tiny
            if i < n - 1:
                self.left[i] = pivots[i] * below[i] / self.down[i]
                s = self.left[i] * below[i] * s - value
        p = pivots[n - 1] - value
        gamma = rest.copy()
        gamma[n - 1] += p + value
        for i in range(n - 2, -1, -1):
            self.up[i + 1] = pivots[i] * below[i] ** 2 + p or tiny
            t = pivots[i] / self.up[i + 1]
            self.right[i] = below[i] * t
            p = p * t - value
            gamma[i] += p + value
        self.gamma = np.where(np.isfinite(gamma), gamma, np.inf)
        self.at = int(np.abs(self.gamma).argmin())

    def vector(self) -> np.ndarray:
        z = np.zeros(len(self.gamma))
        z[self.at] = 1.0
        return self._back(z)

    def _back(self, y: np.ndarray) -> np.ndarray:
        for i in range(self.at - 1, -1, -1):
            y[i] -= self.left[i] * y[i + 1]
        for i in range(self.at, len(y) - 1):
            y[i + 1] -= self.right[i] * y[i]
        return y / np.linalg.norm(y)

    def solve(self, z: np.ndarray) -> np.ndarray:
        """A step of inverse iteration from z."""
        y, k = z.copy(), self.at
        for i in range(k):
            y[i + 1] -= self.left[i] * y[i]
        for i in range(len(y) - 1, k, -1):
            y[i - 1] -= self.right[i - 1] * y[i]
        y[:k] /= self.down[:k]
        y[k + 1:] /= self.up[k + 1:]
        y[k] /= self.gamma[k] or EPS * float(np.abs(self.down).max())
        return self._back(y / np.abs(y).max())


def _beside(z: np.ndarray, held: np.ndarray) -> np.ndarray:
    """The unit vector of the part of z that is orthogonal to the rows of `held`."""
    z = z - held.T @ (held @ z)
    return z / np.linalg.norm(z)


def _product(pivots: np.ndarray, below: np.ndarray, z: np.ndarray) -> np.ndarray:
    """L D L' z."""
    y = z.copy()
    y[:-1] += below * z[1:]
    y *= pivots
    y[1:] += below * y[:-1]
    return y


def vectors(diagonal: np.ndarray, above: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values, falling, and the right singular vectors of B in columns."""
    n = len(diagonal)
    scale = float(max(diagonal.max(initial=0), above.max(initial=0))) or 1.0
    a, b = np.maximum(diagonal / scale, EPS ** 1.5), above / scale  # an exact zero would have no multiplier
    found, begin, spread = [], 0, np.random.default_rng(0)
    negligible = b ** 2 <= _SPLIT * np.minimum(a[:-1], a[1:]) ** 2
    for end in [*(np.flatnonzero(negligible) + 1), n]:
        pivots, below = a[begin:end] ** 2, b[begin:end - 1] / a[begin:end - 1]
        values, own = dqds(a[begin:end], b[begin:end - 1]), []
        for i, value in enumerate(values):
            held, single = np.array(own).reshape(i, len(values)), not i or values[i - 1] - value > _CLUSTER * values[i - 1]
            best = np.inf
            # A factorisation that grows out of bounds gives a poor vector; next to the value there is a better one.
            for ulps in (0, 4, -4, 16, -16, 64, -64):
                twisted = _Twisted(pivots, below, float(value) * (1 + ulps * EPS))
                tried = twisted.vector() if single and not ulps else spread.standard_normal(len(values))
                for _ in range(0 if single and not ulps else 4):
                    tried = twisted.solve(_beside(tried, held))
                tried = _beside(_beside(tried, held), held)
                error = float(np.linalg.norm(_product(pivots, below, tried) - value * tried))
                if error < best:
                    z, best = tried, error
                if best <= 8 * len(values) * EPS * values[0]:
                    break
            own.append(z)
            found.append((float(value), begin, z))
        begin = end
    found.sort(key=lambda row: -row[0])
    columns = np.zeros((n, n))
    for i, (_, at, z) in enumerate(found):
        columns[at:at + len(z), i] = z
    return np.array([value for value, _, _ in found]) * scale ** 2, columns


def right_singular(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values of a square matrix, falling, and its right singular vectors in columns."""
    diagonal, above, right = bidiagonal(matrix)
    values, columns = vectors(diagonal, above)
    return values, right @ columns
