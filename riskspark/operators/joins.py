"""Join operators (§2.4) beyond plain ``DataFrame.join``.

Rules of thumb used throughout:
* broadcast only what has a proven size bound: rule tables are fixed-size;
  anything derived from data goes through ``broadcast_if_small``, which reads
  Catalyst's size estimate of the optimized plan (no job) and falls back to a
  shuffle join above the threshold;
* range / interval conditions ride on an equi key (member, bucket) with an
  exact residual predicate — never a nested-loop join over data;
* OR conditions are split into one equi join per branch.
"""

from __future__ import annotations

from functools import reduce
from math import ceil
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.operators.sinks import checkpoint, is_in_place

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimized plan (driver-side, no job)."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - unknown → treat as large
        return 1 << 62


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """jn_broadcast: hint broadcast only when the estimated size is bounded."""
    return F.broadcast(df) if estimated_bytes(df) <= max_bytes else df


def checked_join(left: DataFrame, right: DataFrame, on, how: str = "inner",
                 max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Join with a broadcast hint on the right side if (and only if) its
    estimated size is under ``max_bytes``; else a shuffle join (AQE may still
    convert it at run time from real statistics)."""
    return left.join(broadcast_if_small(right, max_bytes), on, how)


#: Rows that one task of a sized shuffle takes, about.
TASK_ROWS = 250_000


def sized(frames: Sequence[DataFrame], rows: int, keys: Sequence[str], task_rows: int = TASK_ROWS) -> list[DataFrame]:
    """The frames dealt out by ``keys`` alike, so that joins and groupings on them
    need no other shuffle: into as many partitions as ``rows``, those of the largest
    frame, need at ``task_rows`` a task. Left to itself, Spark merges partitions
    by their compressed bytes, up to any number of rows, and a task's sort and hash
    memory grows with the input. Rows for one task are left as they are."""
    n = ceil(rows / task_rows)
    if n <= 1:
        return list(frames)
    n = max(n, frames[0].sparkSession.sparkContext.defaultParallelism)
    return [f.repartition(n, *keys) for f in frames]


def dealt(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """One frame of a sized shuffle. A join takes its number of partitions over for
    the other side; that shuffle's partitions are then not merged either."""
    return sized([df], rows, keys)[0]


#: Rows a task of a plan done in place: several steps hold their rows there at once.
PLACED_ROWS = 100_000


def hashed(df: DataFrame) -> DataFrame:
    """The right side of a join done in place, as a hash table of its partition instead
    of a sort of both. For sides that have few rows for any key they are dealt out by."""
    return df.hint("shuffle_hash") if is_in_place(df.sparkSession) else df


def placed(frames: Sequence[DataFrame], rows: int, keys: Sequence[str]) -> list[DataFrame]:
    """``sized`` for plans that are done in place; elsewhere the frames as they are."""
    return sized(frames, rows, keys, PLACED_ROWS) if is_in_place(frames[0].sparkSession) else list(frames)


def keys_first(keys: Sequence[str]) -> list[str]:
    """The keys with the most telling ones in front: a sort compares eight bytes of
    its first key and whole rows where those are equal, as versions mostly are."""
    front = [k for k in ("member_bid", "claim_bid") if k in keys]
    back = [k for k in ("version",) if k in keys]
    return [*front, *[k for k in keys if k not in front and k not in back], *back]


def join_scores(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """jn_scores: left-join any number of score frames on the key."""
    return reduce(lambda a, b: a.join(b, list(keys), "left"), frames)


def split_or_join(left: DataFrame, right: DataFrame, branches: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """An OR join as a union of equi joins: each branch is
    (left column, right column, extra right-side filter)."""
    parts = []
    for lc, rc, rfilter in branches:
        r = right.where(rfilter)
        parts.append(left.join(r, left[lc] == r[rc]))
    return reduce(lambda a, b: a.unionByName(b), parts)


def day_number(c) -> Column:
    return F.datediff(c if isinstance(c, Column) else F.col(c), F.lit("1970-01-01").cast("date"))


def window_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_date: str, right_date: str,
                lo_days: int, hi_days: int, how: str = "inner") -> DataFrame:
    """Rows of ``right`` whose date lies in [left_date + lo, left_date + hi]
    (same keys). Equi join on (keys, bucket) with bucket width = span + 1:
    each left row probes the ≤ 2 buckets its window touches; the residual
    filter is exact. ``how`` = inner / left_semi / left_anti."""
    width = hi_days - lo_days + 1
    rb = right.withColumn("_b", F.floor(day_number(right_date) / width))
    lo = F.floor((day_number(left_date) + lo_days) / width)
    cond = F.datediff(F.col(right_date), F.col(left_date)).between(lo_days, hi_days)
    if how == "inner":
        lb = left.withColumn("_b", F.explode(F.array_distinct(F.array(lo, lo + 1))))
        return lb.join(rb, list(keys) + ["_b"]).where(cond).drop("_b")
    # semi / anti: the predicate depends only on (keys, left date), so match
    # the distinct probes and join back on them (deterministic, no row ids)
    probe = left.select(*keys, left_date).distinct()
    pb = probe.withColumn("_b", F.explode(F.array_distinct(F.array(lo, lo + 1))))
    hit = pb.join(rb.select(*keys, "_b", right_date), list(keys) + ["_b"]).where(cond) \
        .select(*keys, left_date).distinct()
    return left.join(hit, list(keys) + [left_date], how)


def fuzzy_pairs(df: DataFrame, col: str, threshold: float) -> DataFrame:
    """jn_fuzzy: pairs of **distinct** values of ``col`` with
    ``1 − levenshtein / greatest(length) ≥ threshold`` (above 0), none lost.

    The longer value of such a pair, of length L, allows k = floor((1 − threshold) · L)
    edits. Cut it into k + 1 segments, from 0: the edits before segment i less i
    begin at 0, end below 0 and fall by at most 1 a segment, so at some unedited
    segment i exactly i edits lie before it and at most k - i after. It is moved
    by at most i places seen from the beginning and by at most k - i seen from
    the end, where the lengths' difference counts. Segments join substrings at
    those places by (L, i, characters); the distance, given up beyond k + 1, is
    only taken for values that share one."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is above 0 and at most 1")
    v = df.select(F.col(col).alias("v")).where(F.col(col) != "").distinct().withColumn("n", F.length("v"))

    def edits(n: Column) -> Column:
        return F.floor((1.0 - threshold) * n + 1e-9).cast("int")

    def begin(n: Column, i: Column) -> Column:  # of segment i, from 0
        return F.floor(i * n / (edits(n) + 1)).cast("int")

    def keys(text: Column, n: Column, i: Column, at: Column) -> Column:
        return F.struct(n.alias("size"), i.alias("i"), F.substring(text, at + 1, begin(n, i + 1) - begin(n, i)).alias("part"))
    text, size = F.col("v"), F.col("n")
    long_ = v.select(F.col("v").alias("longer"), F.inline(F.transform(
        F.sequence(F.lit(0), edits(size)), lambda i: keys(text, size, i, begin(size, i)))))

    def places(n: Column, i: Column) -> Column:
        last = size - begin(n, i + 1) + begin(n, i)  # where the segment would end with the text
        shorter = n - size
        first = F.greatest(begin(n, i) - i, begin(n, i) - shorter - edits(n) + i, F.lit(0))
        end = F.least(begin(n, i) + i, begin(n, i) - shorter + edits(n) - i, last)
        return F.when(first <= end, F.transform(F.sequence(first, F.greatest(first, end)), lambda q: keys(text, n, i, q))).otherwise(F.array())
    sizes = F.sequence(size, F.floor(size / threshold + 1e-9).cast("int"))
    short = v.select(F.col("v").alias("shorter"), F.inline(F.array_distinct(F.flatten(F.transform(
        sizes, lambda n: F.flatten(F.transform(F.sequence(F.lit(0), edits(n)), lambda i: places(n, i))))))))
    pairs = short.join(long_, ["size", "i", "part"]).where(F.col("shorter") != F.col("longer")).select(
        F.least("shorter", "longer").alias("value_a"), F.greatest("shorter", "longer").alias("value_b")).distinct()
    longest = F.greatest(F.length("value_a"), F.length("value_b"))
    near = pairs.withColumn("_k", edits(longest) + 1).withColumn("_d", F.expr("levenshtein(value_a, value_b, _k)")).where("_d >= 0")
    return near.select("value_a", "value_b", (F.lit(1.0) - F.col("_d") / longest).alias("similarity")).where(
        F.col("similarity") >= threshold)


def assign_bid(df: DataFrame, keys: Sequence[str], prefix: int, n_ranges: int | None = None,
               width: int = 10 ** 12) -> DataFrame:
    """jn_bid_assign: surrogate id = prefix · width + dense rank of the natural
    key, computed without a global single-task window: distinct keys are
    range-partitioned (order-preserving; ``n_ranges`` is the session's number of
    shuffle partitions if not given), ranked inside each range, and offset by the
    counts of the preceding ranges (one row a range). The ranges are written once,
    so that counts and ranks see the same bounds."""
    keys = list(keys)
    n_ranges = n_ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    k = checkpoint(df.select(*keys).distinct().repartitionByRange(n_ranges, *keys)
                   .withColumn("_pid", F.spark_partition_id()), "bid-ranges")
    counts = k.groupBy("_pid").agg(F.count("*").alias("_n"))
    offs = counts.withColumn("_off", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_pid", "_off")
    ranked = k.withColumn("_r", F.row_number().over(Window.partitionBy("_pid").orderBy(*keys)))
    ids = ranked.join(F.broadcast(offs), "_pid").select(
        *keys, (F.lit(prefix) * F.lit(width) + F.col("_off") + F.col("_r")).cast("bigint").alias("bid"))
    return df.join(ids, keys, "left")
