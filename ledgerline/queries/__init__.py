"""Registered queries: one per operator, with SQL that computes the same from the tables."""

from __future__ import annotations

from importlib import import_module

MODULES = ["charging", "columns", "statistics", "chart_layers", "windowed", "tables", "storage", "streamed"]


def _merged(name: str) -> dict:
    merged: dict = {}
    for module in MODULES:
        part = getattr(import_module(f"ledgerline.queries.{module}"), name)
        clash = merged.keys() & part.keys()
        if clash:
            raise ValueError(f"registered twice: {sorted(clash)}")
        merged |= part
    return merged


def all_queries() -> dict:
    return _merged("QUERIES")


def all_oracles() -> dict:
    return _merged("ORACLES")
