"""All pN_ queries and their SQL."""

from __future__ import annotations

import importlib

MODULES = ("lookalike", "neardup", "mainbody", "mojibake", "sitelines", "neighbours", "pieces", "encode", "packing", "residue")


def _all(what: str) -> dict:
    out: dict = {}
    for name in MODULES:
        try:
            m = importlib.import_module(f"{__package__}.{name}")
        except ModuleNotFoundError as e:
            if e.name != f"{__package__}.{name}":
                raise
            continue
        out |= getattr(m, what, {})
    return dict(sorted(out.items()))


def queries() -> dict:
    return _all("QUERIES")


def oracle_sql() -> dict:
    return _all("SQL")
