"""Leading eigenvectors of a symmetric matrix by slicing its spectrum.

By Sylvester's law the signs of D in an LDLᵀ factorisation of A - sI count the eigenvalues
above and below s. Bisection on these counts closes in on one eigenvalue at a time, Rayleigh
quotient iteration then converges to it cubically, and two counts around the result certify
its number. The matrix has the size of a vector's dimension, whatever the number of rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# Growth of a pivot is bounded best with this share (Bunch and Kaufman).
PIVOT_SHARE = (1 + np.sqrt(17)) / 8
EPSILON = np.finfo(np.float64).eps
BISECTIONS, ITERATIONS, STARTS = 200, 30, 8
# An eigenvalue below this many times the rounding noise is taken for zero.
FLOOR = 32


def inertia(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of ``matrix`` are above ``shift``.

    LDLᵀ with symmetric pivots of one or two rows; a pivot of two rows taken here always
    has one positive and one negative eigenvalue. A pivot of exactly zero, with nothing left
    beside it, is an eigenvalue at the shift and does not count as above.
    """
    a = matrix - shift * np.eye(len(matrix))
    above = 0
    while len(a):
        column = np.abs(a[1:, 0])
        most = column.max(initial=0.0)
        if most == 0.0:
            above += a[0, 0] > 0
            a = a[1:, 1:]
            continue
        other = int(column.argmax()) + 1
        beside = np.abs(np.delete(a[other], other)).max()
        if abs(a[0, 0]) * beside >= PIVOT_SHARE * most * most:
            size = 1
        elif abs(a[other, other]) >= PIVOT_SHARE * beside:
            a = _swapped(a, 0, other)
            size = 1
        else:
            a = _swapped(a, 1, other)
            size = 2
        pivot, left = a[:size, :size], a[size:, :size]
        above += 1 if size == 2 else pivot[0, 0] > 0
        a = a[size:, size:] - left @ np.linalg.solve(pivot, left.T)
    return int(above)


def _swapped(a: np.ndarray, i: int, j: int) -> np.ndarray:
    order = np.arange(len(a))
    order[[i, j]] = order[[j, i]]
    return a[np.ix_(order, order)]


@dataclass(frozen=True)
class Component:
    value: float
    vector: np.ndarray
    iterations: int


def leading(matrix: np.ndarray, most: int) -> list[Component]:
    """Up to ``most`` components by falling eigenvalue, those above rounding noise only.

    Equal eigenvalues get orthogonal vectors of their common space. Raises
    ``ArithmeticError`` if the counts do not confirm a component's number.
    """
    matrix = np.asarray(matrix, np.float64)
    size = len(matrix)
    top = float(np.abs(matrix).max(initial=0.0))
    if top == 0.0:
        return []
    # Scaled, so that neither squares nor shifts leave the range of a double.
    a = (matrix + matrix.T) / (2 * top)
    radius = np.abs(a).sum(axis=1) - np.abs(np.diag(a))
    ceiling = float((np.diag(a) + radius).max())
    noise = EPSILON * size * max(1.0, float(np.abs(a).sum(axis=1).max()))
    floor = FLOOR * noise
    found: list[Component] = []
    for number in range(1, min(most, inertia(a, floor)) + 1):
        component = _component(a, number, floor, ceiling + noise, noise, found)
        if not inertia(a, component.value + 4 * noise) < number <= inertia(a, component.value - 4 * noise):
            raise ArithmeticError(f"component {number} is not where the counts of eigenvalues put it")
        found.append(component)
    return [Component(c.value * top, c.vector, c.iterations) for c in found]


def _component(a: np.ndarray, number: int, low: float, high: float, noise: float, found: list[Component]) -> Component:
    """Component ``number``, whose eigenvalue is in (low, high]."""
    below, above = inertia(a, low), inertia(a, high)
    for _ in range(BISECTIONS):
        alone = below == number and above == number - 1
        if alone or high - low <= 2 * noise:
            result = _rayleigh(a, low, high, noise, found)
            if result is not None:
                return result
            if high - low <= 2 * noise:
                break
        middle = (low + high) / 2
        count = inertia(a, middle)
        if count >= number:
            low, below = middle, count
        else:
            high, above = middle, count
    raise ArithmeticError(f"no eigenvector found for component {number}")


def _rayleigh(a: np.ndarray, low: float, high: float, noise: float, found: list[Component]) -> Component | None:
    """The eigenvector in (low, high] that is orthogonal to those found, or None.

    One step of inverse iteration from the middle leads towards the interval's eigenvalue;
    from there on the shift is the Rayleigh quotient.
    """
    for start in range(STARTS):
        # A fixed, even sequence serves as start; another one if it misses the vector.
        vector = ((np.arange(len(a)) + 1) * 0.618033988749895 * (start + 1)) % 1 - 0.5
        vector = _apart(vector, found)
        if vector is None:
            continue
        shift = (low + high) / 2
        for step in range(ITERATIONS):
            vector = _apart(_solved(a, shift, vector), found)
            if vector is None:
                break
            shift = float(vector @ (a @ vector))
            residual = float(np.linalg.norm(a @ vector - shift * vector))
            if residual <= noise:
                # Only an interval that cannot be narrowed lets rounding decide.
                slack = 2 * noise if high - low <= 2 * noise else 0.0
                if low - slack <= shift <= high + slack:
                    return Component(shift, vector, step + 1)
                break
    return None


def _apart(vector: np.ndarray, found: list[Component]) -> np.ndarray | None:
    """``vector`` as a unit orthogonal to the vectors found, or None if nothing is left."""
    length = float(np.linalg.norm(vector))
    if not np.isfinite(length) or length == 0.0:
        return None
    vector = vector / length
    for _ in range(2):
        for other in found:
            vector = vector - other.vector * (other.vector @ vector)
    length = float(np.linalg.norm(vector))
    return vector / length if length > 1e-8 else None


def _solved(a: np.ndarray, shift: float, vector: np.ndarray) -> np.ndarray:
    """A solution of (a - shift) x = vector; a shift that is an eigenvalue is moved a little."""
    for distance in (0.0, EPSILON, 16 * EPSILON):
        try:
            solution = np.linalg.solve(a - (shift + distance) * np.eye(len(a)), vector)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(solution).all():
            return solution
    return vector
