"""Column expressions (all Spark built-ins; no Python UDFs)."""

from riskspark.functions.columns import *  # noqa: F401,F403
