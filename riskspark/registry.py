"""Query registry: name → (spark, sf_dir) -> DataFrame.

Each registered query runs an operator (or composite) of the library over the
whole driver tables. Results are type-normalised at the edge (integers →
bigint, floats/decimals → double) so they compare 1:1 with the SQL oracle.
"""

from __future__ import annotations

from functools import wraps
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def normalize_types(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        t = f.dataType
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)):
            cols.append(F.col(f.name).cast("bigint").alias(f.name))
        elif isinstance(t, (T.FloatType, T.DecimalType)):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def query(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``; ``oracle`` is
    the equivalent DuckDB SQL (omitted where SQL cannot express the op)."""
    if oracle is not None:
        ORACLES[name] = oracle

    def deco(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return normalize_types(fn(spark, sf_dir))
        QUERIES[name] = run
        return fn
    return deco


def load_all() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    # importing the modules registers their queries
    from riskspark.queries import (  # noqa: F401
        q_sources, q_rules, q_joins, q_aggs, q_windows, q_sets, q_scoring,
        q_persistence, q_gaps, q_claims, q_quality, q_sinks)
    return dict(QUERIES)
