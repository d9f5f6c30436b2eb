"""Interval joins whose intervals differ in length from row to row.

An interval of n days is filed under the smallest block size (1, 4, 16 ...
days) that is not below n, in the one or two blocks of that size it touches;
a day probes its block at every size that occurs. So an interval makes two
rows at most, however long, a pair meets in exactly one block, and the exact
condition is left for the candidates of one block only. For existence, the
intervals of a key are first merged into disjoint ones (one row a start day
goes in), so a key with any number of intervals meets a day at most once.

Intervals without a bound or with the last day before the first match
nothing, days that are null neither.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Block sizes are powers of this many days.
GROWTH = 4
_SIZES = [GROWTH ** k for k in range(12)]  # 4^11 days hold every pair of dates


def _day(c: str) -> Column:
    return F.datediff(F.col(c), F.lit("1970-01-01").cast("date"))


def _size_of(n: Column) -> Column:
    """The smallest block size not below n days."""
    return F.array_min(F.filter(F.array(*[F.lit(s) for s in _SIZES]), lambda s: s >= n))


def _block(day: Column, size: Column) -> Column:
    return F.floor(day / size)


def merge_intervals(df: DataFrame, keys: Sequence[str], first: str, last: str) -> DataFrame:
    """Overlapping and adjoining intervals of a key become one: keys, first, last.
    A key's rows are reduced to one a start day before they are ordered."""
    days = df.where(F.col(first) <= F.col(last)).groupBy(*keys, first).agg(F.max(last).alias(last))
    order = Window.partitionBy(*keys).orderBy(first)
    before = F.max(last).over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(before.isNull() | (F.datediff(F.col(first), before) > 1), 1).otherwise(0)
    runs = days.withColumn("_new", begins).withColumn("_run", F.sum("_new").over(order))
    return runs.groupBy(*keys, "_run").agg(F.min(first).alias(first), F.max(last).alias(last)).drop("_run")


def interval_join(points: DataFrame, intervals: DataFrame, keys: Sequence[str], day: str, first: str, last: str,
                  how: str = "inner") -> DataFrame:
    """Rows of ``points`` with the ``intervals`` of the same keys that hold
    their ``day`` (``first <= day <= last``); ``left_semi`` and ``left_anti``
    keep the points that have such an interval, or have none."""
    keys = list(keys)
    if how in ("left_semi", "left_anti"):
        probe = points.select(*keys, day).distinct()
        hit = interval_join(probe, merge_intervals(intervals, keys, first, last), keys, day, first, last).select(*keys, day)
        return points.join(hit, [*keys, day], how).select(*points.columns)
    size = _size_of(F.datediff(F.col(last), F.col(first)) + 1)
    filed = intervals.where(F.col(first) <= F.col(last)).withColumn("_size", size)
    sizes = filed.agg(F.collect_set("_size")).scalar()  # of the sizes that occur, twelve at most
    filed = filed.withColumn("_block", F.explode(F.array_distinct(F.array(_block(_day(first), F.col("_size")), _block(_day(last), F.col("_size"))))))
    probes = points.withColumn("_size", F.explode(sizes)).withColumn("_block", _block(_day(day), F.col("_size")))
    joined = probes.join(filed, [*keys, "_size", "_block"])
    return joined.where(F.col(day).between(F.col(first), F.col(last))).drop("_size", "_block")
