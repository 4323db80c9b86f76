"""Checked queries: each operator run over the given tables, with its SQL twin."""

from __future__ import annotations

from catalog import feeds, files, maps, messages, models, quality, streams

MODULES = (messages, feeds, files, quality, models, streams, maps)


def queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
