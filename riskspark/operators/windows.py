"""Window operators (§2.6). Every pick-one uses a total order."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(cols: Sequence, desc: bool) -> list[Column]:
    out = []
    for c in cols:
        c = F.col(c) if isinstance(c, str) else c
        out.append(c.desc_nulls_last() if desc else c.asc_nulls_last())
    return out


def pick_one(df: DataFrame, keys: Sequence[str], order: Sequence, desc: bool = True) -> DataFrame:
    """win_latest (desc) / win_oldest (asc): one row per key by ``row_number``."""
    w = Window.partitionBy(*keys).orderBy(*_order(order, desc))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def latest(df: DataFrame, keys: Sequence[str], updated: str, created: str, tie: Sequence[str]) -> DataFrame:
    """win_latest: newest by ``coalesce(updated, created)`` desc + tie-breakers (D12)."""
    return pick_one(df, keys, [F.coalesce(F.col(updated), F.col(created)), *tie], desc=True)


def distinct_count_over(df: DataFrame, keys: Sequence[str], item: str, out: str = "frequency") -> DataFrame:
    """win_frequency: distinct ``item`` per key on the raw rows: mark the first
    row of each item, sum the markers over the key."""
    first = F.row_number().over(Window.partitionBy(*keys, item).orderBy(item))
    return df.withColumn("_f", F.when(first == 1, 1).otherwise(0)) \
        .withColumn(out, F.sum("_f").over(Window.partitionBy(*keys))).drop("_f")


def max_over(df: DataFrame, keys: Sequence[str], col: str, out: str) -> DataFrame:
    """win_max_date / win_latest_cycle / win_claim_level_flag building block."""
    return df.withColumn(out, F.max(col).over(Window.partitionBy(*keys)))


def at_max(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Rows at the maximum of ``col`` per key (all ties kept). The maxima are an
    aggregate, combined before its shuffle, so a hot key's rows never meet."""
    mx = df.groupBy(*keys).agg(F.max(col).alias("_mx"))
    same = [F.col(f"d.{k}").eqNullSafe(F.col(f"m.{k}")) for k in keys] + [F.col(f"d.{col}") == F.col("m._mx")]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    return df.alias("d").join(mx.alias("m"), cond, "left_semi")


def lag_lead_rank(df: DataFrame, keys: Sequence[str], order: Sequence[str], col: str) -> DataFrame:
    """win_lag_lead_rank."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns({f"prev_{col}": F.lag(col).over(w), f"next_{col}": F.lead(col).over(w),
                           f"rank_{col}": F.rank().over(w)})


def list_over(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """win_codes_per_member: sorted distinct list and count of ``col`` per key
    on every row (the list is bounded by the code vocabulary)."""
    w = Window.partitionBy(*keys)
    return df.withColumn(f"{col}_list", F.array_join(F.array_sort(F.collect_set(F.col(col).cast("string")).over(w)), ",")) \
        .withColumn(f"{col}_count", F.size(F.collect_set(col).over(w)))


def number_within(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "n") -> DataFrame:
    """Numbers each key's rows from 1 by ``order`` (a total order, but for equal
    rows) without a window over the key: rows are dealt into ranges that are
    written once, and a row's number is its place among the key's rows of the
    range plus the key's rows in the ranges before. Only the first and last key of
    a range can go on in another: a table of one row such key and range has their
    rows before, and is broadcast. A key that holds most rows spreads over ranges."""
    from riskspark.operators.sinks import checkpoint
    keys = list(keys)
    by = [F.col(c).asc_nulls_first() for c in [*keys, *order]]
    ranged = checkpoint(df.repartitionByRange(*by).withColumn("_part", F.spark_partition_id()), "numbered")

    def same(columns: dict[str, str]) -> Column:
        return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(c)) for k, c in columns.items()])
    named = {k: f"_k_{k}" for k in keys}
    key = F.struct(*keys)
    ends = ranged.groupBy("_part").agg(F.array(F.min(key), F.max(key)).alias("_ends")).select(F.inline("_ends")).toDF(*named.values()).distinct()
    spans = ranged.join(F.broadcast(ends), same(named), "left_semi").groupBy(*keys, "_part").agg(F.count("*").alias("_size"))
    before = F.sum("_size").over(Window.partitionBy(*keys).orderBy("_part")) - F.col("_size")
    offsets = spans.select(*[F.col(k).alias(c) for k, c in named.items()], F.col("_part").alias("_p"), before.alias("_before"))
    here = F.row_number().over(Window.partitionBy("_part", *keys).orderBy(*[F.col(c).asc_nulls_first() for c in order]))
    numbered = ranged.withColumn("_here", here).join(F.broadcast(offsets), same({"_part": "_p", **named}), "left")
    return numbered.withColumn(out, F.coalesce("_before", F.lit(0)) + F.col("_here")).drop("_part", "_here", "_p", "_before", *named.values())
