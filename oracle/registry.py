"""Oracle SQL by query name (registered next to each Spark query)."""

from __future__ import annotations


def load_all() -> dict[str, str]:
    from riskspark.registry import ORACLES, load_all as load_queries
    load_queries()
    return dict(ORACLES)
