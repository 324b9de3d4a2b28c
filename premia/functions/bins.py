"""Bin positions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _steps(max_edges: int) -> Column:
    powers = [1 << k for k in range(max_edges.bit_length())][::-1]
    return F.array(*[F.lit(p) for p in powers])


def _search(edges: Column, x: Column, max_edges: int, inclusive: bool) -> Column:
    """Number of entries of the sorted array ``edges`` below ``x`` (or up to ``x``), by binary search."""

    def advance(pos: Column, step: Column) -> Column:
        probe = F.get(edges, pos + step - 1)
        passed = (probe <= x) if inclusive else (probe < x)
        return F.when((pos + step <= F.size(edges)) & passed, pos + step).otherwise(pos)

    return F.aggregate(_steps(max_edges), F.lit(0), advance)


def edges_below(edges: Column, x: Column, max_edges: int) -> Column:
    return _search(edges, x, max_edges, inclusive=False)


def edges_up_to(edges: Column, x: Column, max_edges: int) -> Column:
    return _search(edges, x, max_edges, inclusive=True)


def inner(edges: Column) -> Column:
    """The edges without the first and the last."""
    return F.slice(edges, F.lit(2), F.greatest(F.size(edges) - 2, F.lit(0)))


def band(x: Column, cuts: tuple[float, ...]) -> Column:
    """Text label of the half-open band ``[a, b)`` that holds ``x``; values outside every band give ``nan``."""
    label = F.lit("nan")
    for low, high in reversed(list(zip(cuts, cuts[1:]))):
        label = F.when((x >= F.lit(low)) & (x < F.lit(high)), F.lit(f"[{low}, {high})")).otherwise(label)
    return label
