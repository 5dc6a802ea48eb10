"""Singular values and right singular vectors of a small square matrix, by way of a bidiagonal one.

Householder reflections make the matrix upper bidiagonal, dqds (the differential quotient-difference algorithm with
shifts) finds the singular values to high relative accuracy, and twisted factorisations of the bidiagonal's
Gram matrix less a shift give a vector each. Vectors of values that lie close together are made orthogonal by inverse
iteration with the same factorisation.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
CLOSE = 1e-3  # relative gap of eigenvalues below which vectors are kept orthogonal to one another


def bidiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal a, superdiagonal b and V with matrix = U B V^T."""
    work = np.array(matrix, float)
    n = len(work)
    v = np.eye(n)
    for k in range(n):
        h, tau = _reflector(work[k:, k])
        work[k:, k:] -= tau * np.outer(h, h @ work[k:, k:])
        if k < n - 2:
            h, tau = _reflector(work[k, k + 1:])
            work[k:, k + 1:] -= tau * np.outer(work[k:, k + 1:] @ h, h)
            v[:, k + 1:] -= tau * np.outer(v[:, k + 1:] @ h, h)
    return work.diagonal().copy(), work.diagonal(1).copy(), v


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """h and tau: I - tau h h^T takes x to a multiple of the first unit vector."""
    scale = np.abs(x).max()
    if scale == 0 or not np.abs(x[1:]).any():
        return np.zeros(len(x)), 0.0
    h = x / scale
    h[0] += np.copysign(np.sqrt(h @ h), h[0])
    return h, 2 / (h @ h)


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Singular values, falling, of the bidiagonal matrix."""
    scale = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if scale == 0:
        return np.zeros(len(a))
    found: list[float] = []
    todo = [((a / scale) ** 2, (b / scale) ** 2, 0.0)]
    while todo:
        q, e, shift = todo.pop()
        found += _values(q.tolist(), e.tolist(), shift, todo)
    return np.sort(np.sqrt(np.maximum(found, 0)))[::-1] * scale


def _values(q: list[float], e: list[float], shift: float, todo: list) -> list[float]:
    """Squares of the singular values of one block; blocks that come apart go to todo."""
    found, tries = [], 0
    while q:
        n = len(q)
        if n == 1:
            return [*found, q[0] + shift]
        if e[-1] <= (10 * EPS) ** 2 * (shift + q[-1]) or e[-1] < 1e-300:
            found.append(q.pop() + shift)
            e.pop()
            continue
        if n == 2:
            return [*found, *_pair(q[0], e[0], q[1], shift)]
        for i in range(n - 2, -1, -1):
            if e[i] <= (10 * EPS) ** 2 * (shift + q[i]) or e[i] < 1e-300:
                todo += [(np.array(q[:i + 1]), np.array(e[:i]), shift), (np.array(q[i + 1:]), np.array(e[i + 1:]), shift)]
                return found
        if q[-1] > 1.5 * q[0]:
            q, e = q[::-1], e[::-1]
        # The last pivot of a step without a shift bounds the least value from above.
        plain, rest, low = _step(q, e, 0.0)
        tries += 1
        if tries > 100 * len(q) + 1000:
            raise ArithmeticError("dqds does not converge")
        guess = low
        for _ in range(4):
            guess = _estimate(plain, rest, guess)
            if guess <= 0:
                break
            next_q, next_e, least = _step(plain, rest, guess)
            if least >= 0:
                plain, rest, shift = next_q, next_e, shift + guess
                break
            guess *= 0.25
        q, e = plain, rest
    return found


def _estimate(q: list[float], e: list[float], low: float) -> float:
    """A shift below the least value, judged by what the last rows say."""
    if e[-1] < 0.25 * q[-1]:
        gap = e[-1] / q[-1]
        return min(low, q[-1] * (1 - np.sqrt(gap)) ** 2) * (1 - 2 * EPS) if gap < 1 else 0.25 * low
    return 0.25 * min(low, q[-1])


def _pair(q1: float, e1: float, q2: float, shift: float) -> list[float]:
    """Eigenvalues of the Gram matrix of a 2 by 2 bidiagonal block."""
    total = q1 + e1 + q2
    root = np.sqrt(max(0.0, (q1 - q2) ** 2 + e1 * (e1 + 2 * (q1 + q2))))
    large = (total + root) / 2
    return [large + shift, (q1 / large * q2 if large else 0.0) + shift]


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float]:
    """One transform, and its least pivot (below 0: the shift was too large)."""
    new_q, new_e, d = [], [], q[0] - shift
    least = d
    for i in range(len(e)):
        pivot = d + e[i]
        if d < 0 or pivot <= 0:
            if d < 0 or shift:
                return q, e, -1.0
            pivot = 1e-300
        ratio = q[i + 1] / pivot
        new_q.append(pivot)
        new_e.append(e[i] * ratio)
        d = d * ratio - shift
        least = min(least, d)
    return [*new_q, d], new_e, least


class Twisted:
    """B^T B - value, factorised from both ends and joined where the pivot is least."""

    def __init__(self, a: np.ndarray, b: np.ndarray, value: float, coarse: bool = False):
        """coarse: pivots of the size of rounding errors count as equal, so that no direction of a multiple value hides the others."""
        n, scale = len(a), max(float((a * a).max()), value, 1e-300)
        tiny = 8 * EPS * scale if coarse else EPS ** 2 * scale
        safe = np.where(np.abs(a) > EPS * np.sqrt(scale), a, EPS * np.sqrt(scale))
        d, low = safe * safe, b / safe[:-1]
        guard = lambda x: x if abs(x) > tiny else -tiny
        self.down, self.lower, s = np.empty(n), np.empty(max(0, n - 1)), np.empty(n)
        s[0] = -value
        for i in range(n):
            self.down[i] = guard(s[i] + d[i])
            if i < n - 1:
                self.lower[i] = d[i] * low[i] / self.down[i]
                s[i + 1] = self.lower[i] * low[i] * (self.down[i] - d[i]) - value
        self.up, self.upper, p = np.empty(n), np.empty(max(0, n - 1)), np.empty(n)
        p[n - 1] = d[n - 1] - value
        for i in range(n - 2, -1, -1):
            self.up[i + 1] = guard(d[i] * low[i] ** 2 + p[i + 1])
            ratio = d[i] / self.up[i + 1]
            self.upper[i] = low[i] * ratio
            p[i] = (self.up[i + 1] - d[i] * low[i] ** 2) * ratio - value
        gamma = s + p + value
        self.at = int(np.abs(gamma).argmin())
        self.gamma = guard(float(gamma[self.at]))

    def vector(self) -> np.ndarray:
        """What the least pivot's equation leaves open: the vector of the value nearest to the shift."""
        z = np.zeros(len(self.down))
        z[self.at] = 1
        return self._back(z)

    def solve(self, right: np.ndarray) -> np.ndarray:
        y = right.astype(float).copy()
        for i in range(1, self.at):
            y[i] -= self.lower[i - 1] * y[i - 1]
        for i in range(len(y) - 2, self.at, -1):
            y[i] -= self.upper[i] * y[i + 1]
        if self.at > 0:
            y[self.at] -= self.lower[self.at - 1] * y[self.at - 1]
        if self.at < len(y) - 1:
            y[self.at] -= self.upper[self.at] * y[self.at + 1]
        y[: self.at] /= self.down[: self.at]
        y[self.at + 1:] /= self.up[self.at + 1:]
        y[self.at] /= self.gamma
        return self._back(y)

    def _back(self, z: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            for i in range(self.at - 1, -1, -1):
                z[i] -= self.lower[i] * z[i + 1]
            for i in range(self.at, len(z) - 1):
                z[i + 1] -= self.upper[i] * z[i]
        return z / np.sqrt((z / np.abs(z).max()) @ (z / np.abs(z).max())) / np.abs(z).max()


def top_directions(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest singular values (those that are more than rounding) and, as rows, their right singular vectors.

    The largest entry of a vector is positive.
    """
    if not matrix.size or not np.abs(matrix).any():
        return np.zeros(0), np.zeros((0, len(matrix)))
    a, b, v = bidiagonal(matrix)
    values = dqds(a, b)
    values = values[: count][values[: count] > len(a) * EPS * values[0]]
    rng = np.random.default_rng(1)
    vectors: list[np.ndarray] = []
    for k, value in enumerate(values):
        square = value * value
        near = [vectors[i] for i in range(k) if values[i] ** 2 - square <= CLOSE * values[i] ** 2]
        factors = Twisted(a, b, square, bool(near))
        z = factors.vector()
        for _ in range(60):
            for _ in range(2):
                for other in near:
                    z = z - (other @ z) * other
            length = np.sqrt(z @ z)
            if length < 1e-2:  # the vector of an equal value came out again
                z = factors.solve(rng.normal(size=len(a)))
                continue
            z = z / length
            if np.abs(_gram(a, b, z) - square * z).max() <= 16 * EPS * values[0] ** 2:
                break
            z = factors.solve(z)
        else:
            raise ArithmeticError("no vector of a singular value is found")
        vectors.append(z)
    found = np.array([v @ z for z in vectors]).reshape(-1, len(a))
    signs = np.sign(found[np.arange(len(found)), np.abs(found).argmax(axis=1)]) if len(found) else np.ones(0)
    return values, found * signs[:, None]


def _gram(a: np.ndarray, b: np.ndarray, z: np.ndarray) -> np.ndarray:
    """B^T B z."""
    y = a * z
    y[:-1] += b * z[1:]
    x = a * y
    x[1:] += b * y[:-1]
    return x
