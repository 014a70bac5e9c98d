"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

The number of negative eigenvalues of ``A - s I`` is that of its LDL^T factor's
blocks (Sylvester's law of inertia), so a factorisation counts the eigenvalues
below any shift. Bisection by these counts isolates each wanted eigenvalue in an
interval of its own; Rayleigh quotient iteration from inside it converges
cubically, and two more counts on either side of the result certify its number.
Eigenvalues that no interval parts (equal ones to double precision) keep the
bisected value, and their vectors come from inverse iteration against those
already found. The matrices here have as many rows as vectors have components."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

EPS = float(np.finfo(float).eps)


def negative_count(a: np.ndarray) -> int:
    """How many eigenvalues of the symmetric ``a`` are below 0: LDL^T with
    complete pivoting, by blocks of one row, or of two where the largest
    diagonal entry is small. A block of two has one negative eigenvalue."""
    a = a.copy()
    n, below = len(a), 0
    while n:
        diagonal = np.abs(np.diagonal(a))
        i = int(diagonal.argmax())
        off = np.abs(a - np.diag(np.diagonal(a)))
        r, c = divmod(int(off.argmax()), n)
        if off[r, c] == 0 and diagonal[i] == 0:
            return below  # zeros only
        if diagonal[i] >= 0.6403882032022076 * off[r, c]:  # (1 + sqrt 17) / 8 bounds the growth
            pivot = [i]
        else:
            pivot = [r, c]
        rest = np.setdiff1d(np.arange(n), pivot)
        block, border = a[np.ix_(pivot, pivot)], a[np.ix_(rest, pivot)]
        below += 1 if len(pivot) == 2 else int(block[0, 0] < 0)
        a = a[np.ix_(rest, rest)] - border @ np.linalg.solve(block, border.T)
        a = (a + a.T) / 2
        n = len(rest)
    return below


@dataclass
class Eigenpair:
    """``certified`` says that counts at either side of the value number it."""

    value: float
    vector: np.ndarray
    certified: bool


def _unit(v: np.ndarray, against: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):  # the second time takes off what rounding left
        for u in against:
            v = v - (u @ v) * u
    size = np.linalg.norm(v)
    return v / size if size > 0 else v


def _start(n: int, against: list[np.ndarray], shift: int = 0) -> np.ndarray:
    """A unit vector, orthogonal to those given, that no eigenvector is likely
    to be orthogonal to."""
    for k in range(n + 1):
        v = np.cos(np.arange(n) * (0.7 + shift + k) + 0.3) + 1.1
        v = _unit(v, against)
        if np.linalg.norm(v) > 0.5:
            return v
    raise ValueError("no direction left")


def _solve(a: np.ndarray, shift: float, v: np.ndarray) -> np.ndarray:
    scale = max(float(np.abs(a).max()), 1e-300)
    for nudge in (0.0, EPS, 16 * EPS):
        try:
            x = np.linalg.solve(a - (shift + nudge * scale) * np.eye(len(a)), v)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(x).all():
            return x
    return v


def leading(a: np.ndarray, count: int) -> list[Eigenpair]:
    """The ``count`` largest eigenvalues of ``a`` with unit eigenvectors, by
    falling value."""
    n = len(a)
    count = min(count, n)
    radius = np.abs(a).sum(axis=1) - np.abs(np.diagonal(a))
    low = float((np.diagonal(a) - radius).min())
    high = float((np.diagonal(a) + radius).max())
    size = max(abs(low), abs(high), 1e-300)
    low, high = low - 4 * EPS * size, high + 4 * EPS * size
    eye = np.eye(n)
    seen = {low: 0, high: n}  # shift -> eigenvalues below it

    def below(shift: float) -> int:
        if shift not in seen:
            seen[shift] = negative_count(a - shift * eye)
        return seen[shift]

    out: list[Eigenpair] = []
    tiny = 8 * n * EPS * size
    for wanted in range(n, n - count, -1):  # the wanted-th smallest
        a_, b_ = low, high
        for s, c in seen.items():
            if c < wanted:
                a_ = max(a_, s)
            else:
                b_ = min(b_, s)
        # bisection until the interval holds this eigenvalue alone, and is narrow beside its distance to others
        while b_ - a_ > tiny and not (below(a_) == wanted - 1 and below(b_) == wanted and b_ - a_ < 1e-3 * size):
            middle = (a_ + b_) / 2
            if below(middle) < wanted:
                a_ = middle
            else:
                b_ = middle
        alone = below(a_) == wanted - 1 and below(b_) == wanted
        near = [p.vector for p in out] if not alone else [p.vector for p in out if abs(p.value - b_) < 1e-6 * size]
        value, vector = (a_ + b_) / 2, _start(n, near, n - wanted)
        found = None
        while found is None:
            v, shift = vector, value
            for _ in range(3):  # inverse iteration brings the vector near
                v = _unit(_solve(a, shift, v), near)
            for _ in range(30):
                quotient = float(v @ (a @ v))
                if not a_ <= quotient <= b_:
                    break
                residual = np.linalg.norm(a @ v - quotient * v)
                if residual <= 2 * EPS * size:
                    break
                v_next = _unit(_solve(a, quotient, v), near)
                if np.linalg.norm(v_next) < 0.5:
                    break
                if residual <= 16 * n * EPS * size and np.linalg.norm(a @ v_next - float(v_next @ (a @ v_next)) * v_next) >= residual:
                    break
                v = v_next
            quotient = float(v @ (a @ v))
            residual = np.linalg.norm(a @ v - quotient * v)
            if b_ - a_ <= tiny or (a_ <= quotient <= b_ and residual <= 16 * n * EPS * size):
                found = Eigenpair(quotient, v, False)
                break
            # left the interval: narrow it and start again
            middle = (a_ + b_) / 2
            if below(middle) < wanted:
                a_ = middle
            else:
                b_ = middle
            value = (a_ + b_) / 2
        width = 32 * n * EPS * size
        found.certified = negative_count(a - (found.value - width) * eye) <= wanted - 1 and negative_count(a - (found.value + width) * eye) >= wanted
        out.append(found)
    return out
