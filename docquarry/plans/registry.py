"""Queries of the document engine and their oracles, gathered from the modules that hold them."""

from __future__ import annotations

from docquarry.plans import queries_chunks, queries_pages, queries_vectors

MODULES = (queries_chunks, queries_pages, queries_vectors)


def queries() -> dict:
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: q for m in MODULES for name, q in m.ORACLES.items()}
