"""Master lists from many sources.

Sources are given in the order of their precedence. All of them meet in one
shuffle on the key; each attribute of a key is that of the first source that
has it (not null, not blank), of several values in one source the smallest.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_sources(sources: Mapping[str, DataFrame], keys: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """keys, attributes, ``first_source`` (the first that has the key) and
    ``n_sources``: one row a key. Keys are trimmed; rows with a null or blank
    key column are left out; an attribute that a source lacks is null."""
    def one(rank: int, df: DataFrame) -> DataFrame:
        cols = [F.trim(F.col(k).cast("string")).alias(k) for k in keys]
        attrs = [(F.trim(F.col(a).cast("string")) if a in df.columns else F.lit(None).cast("string")).alias(a) for a in attributes]
        return df.select(*cols, *attrs, F.lit(rank).alias("_rank"))
    rows = reduce(lambda a, b: a.unionByName(b), [one(i, df) for i, df in enumerate(sources.values())])
    whole = reduce(lambda a, b: a & b, [F.coalesce(F.col(k), F.lit("")) != "" for k in keys])
    best = [F.min(F.when(F.coalesce(F.col(a), F.lit("")) != "", F.struct("_rank", a)))[a].alias(a) for a in attributes]
    merged = rows.where(whole).groupBy(*keys).agg(*best, F.min("_rank").alias("_first"), F.count_distinct("_rank").alias("n_sources"))
    names = F.array(*[F.lit(n) for n in sources])
    return merged.withColumn("first_source", F.get(names, F.col("_first"))).drop("_first")
