"""Every operator as a named query over the supplied tables."""

from __future__ import annotations


def _load() -> None:
    from premia.catalog import metrics, modelling, online, tables  # noqa: F401


def all_queries():
    _load()
    from premia.catalog.registry import QUERIES

    return dict(QUERIES)


def all_oracles():
    _load()
    from premia.catalog.registry import ORACLES

    return dict(ORACLES)
