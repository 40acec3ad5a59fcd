"""Singular values and right singular vectors of a small square matrix.

Householder reflections make it upper bidiagonal, differential qd sweeps with shifts (dqds) find the squared singular
values, and twisted factorisations of the shifted tridiagonal matrix give the vectors. The matrix has as many rows as
an embedding has components, whatever the number of embeddings, so this runs on the driver.
"""

import numpy as np

_EPS = np.finfo(float).eps
_TINY = 1e-290
_CLOSE = 1e-3            # eigenvalues closer than this share are made orthogonal to each other explicitly


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """(v, alpha) with (I - 2 v v') x = alpha e1 for a unit vector v, or v = 0 if there is nothing to do."""
    norm = np.linalg.norm(x)
    if norm == 0 or len(x) == 1:
        return np.zeros(len(x)), x[0]
    alpha = -norm if x[0] > 0 else norm
    v = x.astype(float)
    v[0] -= alpha
    return v / np.linalg.norm(v), alpha


def bidiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, v): diagonal and superdiagonal of B = U' matrix V, and V."""
    work, n = np.array(matrix, float), len(matrix)
    v, b = np.eye(n), np.zeros(max(n - 1, 0))
    for k in range(n):
        left, work[k, k] = _reflector(work[k:, k])
        work[k:, k + 1:] -= 2 * np.outer(left, left @ work[k:, k + 1:])
        if k + 1 < n:
            right, b[k] = _reflector(work[k, k + 1:])
            work[k + 1:, k + 1:] -= 2 * np.outer(work[k + 1:, k + 1:] @ right, right)
            v[:, k + 1:] -= 2 * np.outer(v[:, k + 1:] @ right, right)
    return np.diag(work).copy(), b, v


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One qd step: (q, e) of the matrix less ``shift``, and the differences on the way, all positive if the shift is small enough."""
    d, new_q, new_e, seen = q[0] - shift, [], [], []
    for i, off in enumerate(e):
        seen.append(d)
        total = d + off
        ratio = q[i + 1] / (total if total != 0 else _TINY)
        new_q.append(total)
        new_e.append(off * ratio)
        d = d * ratio - shift
    seen.append(d)
    return [*new_q, d], new_e, seen


def squared_singular_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Eigenvalues of B'B, falling, for the bidiagonal B with diagonal ``a`` and superdiagonal ``b``.

    Each turn takes an unshifted step, whose differences are the reciprocals of the diagonal of an inverse: their
    harmonic sum is a lower bound of the least eigenvalue. The second step shifts by it, which keeps everything
    positive. An off-diagonal element that has become negligible splits the matrix.
    """
    negligible = (4 * _EPS) ** 2
    found: list[float] = []
    largest = max([*(np.asarray(a) ** 2), *(np.asarray(b) ** 2), 0.0])
    if largest == 0:
        return np.zeros(len(a))
    scale = 1 / largest
    parts = [([x * x * scale for x in a], [x * x * scale for x in b], 0.0)]
    while parts:
        q, e, shifted = parts.pop()
        for _ in range(1000 + 100 * len(q)):
            cut = next((i for i in range(len(e) - 1, -1, -1) if not e[i] > negligible * (shifted + max(q[i + 1], 0.0))), None)
            if len(q) == 1 or cut is not None:
                break
            q, e, seen = _sweep(q, e, 0.0)
            shift = 0.0 if min(seen) <= 0 else (1 - 8 * _EPS) / sum(1 / x for x in seen)
            while shift:
                moved = _sweep(q, e, shift)
                if min(moved[2]) >= 0:
                    (q, e, _), shifted = moved, shifted + shift
                    break
                shift = shift / 2 if shift > _EPS * max(q) else 0.0
        else:
            raise ArithmeticError("the singular values do not converge")
        if len(q) == 1:
            found.append(max(q[0], 0.0) + shifted)
        else:
            parts += [(q[:cut + 1], e[:cut], shifted), (q[cut + 1:], e[cut + 1:], shifted)]
    return np.sort(np.array(found))[::-1] * largest


def _nonzero(x: float) -> float:
    return x if abs(x) > _TINY else _TINY


def _twisted(d: np.ndarray, l: np.ndarray, value: float) -> tuple[np.ndarray, float]:
    """A unit vector z with (L D L' - value) z small, and the correction of ``value`` by its Rayleigh quotient.

    A factorisation from the top and one from the bottom meet where the pivot is least; the vector follows from
    there by multiplications only.
    """
    n = len(d)
    down, up, s, p = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    s[0], p[-1] = -value, d[-1] - value
    for i in range(n - 1):
        down[i] = d[i] * l[i] / _nonzero(s[i] + d[i])
        s[i + 1] = down[i] * l[i] * s[i] - value
    for i in range(n - 2, -1, -1):
        ratio = d[i] / _nonzero(d[i] * l[i] ** 2 + p[i + 1])
        up[i] = l[i] * ratio
        p[i] = p[i + 1] * ratio - value
    pivots = s + p + value
    k = int(np.abs(np.where(np.isfinite(pivots), pivots, np.inf)).argmin())
    z = np.zeros(n)
    z[k] = 1
    for i in range(k - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -up[i] * z[i]
    norm = np.linalg.norm(z)
    return z / norm, pivots[k] / norm ** 2


def _orthogonal(z: np.ndarray, earlier: list[np.ndarray], solve, random: np.random.Generator) -> np.ndarray:
    """``z`` made orthogonal to ``earlier``; if that leaves nothing of it, inverse iteration from a random start."""
    def less(x):
        for _ in range(2):
            for other in earlier:
                x = x - (other @ x) * other
        return x

    rest = less(z)
    tries = 0
    while not np.linalg.norm(rest) > 0.1:
        rest = less(solve(less(random.standard_normal(len(z)))))
        rest = less(solve(rest / np.linalg.norm(rest)))
        rest = rest / np.linalg.norm(rest)
        tries += 1
        if tries > 20:
            raise ArithmeticError("no orthogonal singular vector found")
    return rest / np.linalg.norm(rest)


def right_singular_vectors(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(squared singular values, falling; right singular vectors as columns), signs such that the largest entry is positive."""
    n = len(matrix)
    a, b, v = bidiagonal(matrix)
    values = squared_singular_values(a, b)
    if values[0] == 0:
        return values, np.eye(n)
    floor = np.sqrt(values[0]) * _EPS ** 2
    a = np.where(np.abs(a) > floor, a, floor)
    d, l = a ** 2, b / a[:-1]
    tridiagonal = np.diag(d + np.append(0.0, b ** 2)) + np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
    random, vectors, group = np.random.Generator(np.random.PCG64(12)), [], 0
    for i, value in enumerate(values):
        if i and values[i - 1] - value > max(_CLOSE * values[i - 1], 8 * n * _EPS * values[0]):
            group = i
        with np.errstate(all="ignore"):
            z, correction = _twisted(d, l, value)
            if np.isfinite(z).all() and abs(correction) < _CLOSE * value:
                again, _ = _twisted(d, l, value + correction)
                z = again if np.isfinite(again).all() else z
        shifted = tridiagonal - (value + 4 * _EPS * values[0]) * np.eye(n)
        solve = lambda x, shifted=shifted: np.linalg.solve(shifted, x)
        z = z if np.isfinite(z).all() else np.zeros(n)
        vectors.append(_orthogonal(z, vectors[group:], solve, random))
    found = v @ np.stack(vectors, axis=1)
    signs = np.sign(found[np.abs(found).argmax(axis=0), np.arange(n)])
    return values, found * signs
