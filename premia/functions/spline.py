"""Uniform cubic B-splines as SQL expressions.

On each of the knot intervals exactly four basis functions are non-zero. With t in [0, 1] the position inside the
interval they are, from the oldest to the newest: (1-t)^3/6, (3t^3-6t^2+4)/6, (-3t^3+3t^2+3t+1)/6, t^3/6.
"""

from __future__ import annotations


def number(x: float) -> str:
    """A double literal that Spark SQL reads back to the same bits."""
    return f"({float(x)!r}D)" if "e" not in repr(float(x)) else f"({float(x):.17e}D)"


def position(column: str, low: float, high: float, knots: int) -> str:
    """Distance from ``low`` in knot steps, with the value clamped to [low, high]."""
    if high <= low:
        raise ValueError("spline range is empty")
    step = (high - low) / (knots - 1)
    clamped = f"least(greatest(cast({column} AS double), {number(low)}), {number(high)})"
    return f"(({clamped} - {number(low)}) / {number(step)})"


def combination(column: str, low: float, high: float, knots: int, weights: list[float]) -> str:
    """sum(weights_i * basis_i), collapsed to one cubic per knot interval.

    The cubic's coefficients are looked up by interval number, so the generated code stays small and free of branches.
    """
    u = position(column, low, high, knots)
    cubics = []
    for j in range(knots - 1):
        a, b, c, d = weights[j : j + 4]
        cubics.append([(a + 4 * b + c) / 6, (c - a) / 2, (a - 2 * b + c) / 2, (3 * b - a - 3 * c + d) / 6])
    interval = f"cast(least(floor({u}), {knots - 2}) AS int)"
    t = f"({u} - {interval})"
    c0, c1, c2, c3 = (f"array({', '.join(number(c[k]) for c in cubics)})[{interval}]" for k in range(4))
    return f"((({c3} * {t} + {c2}) * {t} + {c1}) * {t} + {c0})"


def basis(column: str, low: float, high: float, knots: int = 5) -> list[str]:
    """``knots + 2`` basis values for even knots on [low, high]."""
    count = knots + 2
    return [combination(column, low, high, knots, [float(i == k) for k in range(count)]) for i in range(count)]
