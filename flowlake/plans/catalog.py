"""All registered queries and their SQL twins."""

from __future__ import annotations

from importlib import import_module

_AREAS = ["flows", "soc", "telemetry", "tables", "models", "streams"]


def _merged(attribute: str) -> dict:
    merged: dict = {}
    for area in _AREAS:
        part = getattr(import_module(f"flowlake.plans.catalog_{area}"), attribute)
        repeated = merged.keys() & part.keys()
        if repeated:
            raise ValueError(f"registered twice: {sorted(repeated)}")
        merged.update(part)
    return merged


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict:
    return _merged("ORACLES")
