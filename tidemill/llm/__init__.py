"""Training-data operators.

Each operator lives in a module of its own and offers a general function; the
module's ``QUERIES`` and ``ORACLES`` hold the registered queries built on it.
"""

from __future__ import annotations

from importlib import import_module

MODULES = (
    "ppm_scoring", "chat_format", "block_labeller", "parity_join", "containment", "mixture", "fm_quality", "shard_tree",
    "line_dedup", "projection_forest", "ftrl_toxicity", "vector_approximation", "word_runs",
)


def queries() -> dict:
    """Name -> callable of (spark, sf_dir) for every registered query."""
    return {k: f for m in MODULES for k, f in import_module(f"{__name__}.{m}").QUERIES.items()}


def oracles() -> dict[str, str]:
    """Name -> DuckDB SQL for the queries that SQL can express."""
    return {k: s for m in MODULES for k, s in import_module(f"{__name__}.{m}").ORACLES.items()}
