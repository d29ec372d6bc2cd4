"""Every registered query of the curation operators, with its DuckDB twin where SQL can express it."""

from __future__ import annotations

from importlib import import_module

MODULES = (
    "functions.queries", "functions.html", "plans.pages", "plans.rules", "operators.items", "operators.matching", "operators.titles",
    "operators.report", "operators.attempts", "operators.reasons", "operators.render", "operators.picks", "operators.made_rows", "sources.queries", "sources.entities",
)


def queries() -> dict:
    """Name -> callable of (spark, sf_dir)."""
    return {k: f for m in MODULES for k, f in import_module(f"tidemill.{m}").QUERIES.items()}


def oracles() -> dict[str, str]:
    """Name -> DuckDB SQL."""
    return {k: s for m in MODULES for k, s in import_module(f"tidemill.{m}").ORACLES.items()}
