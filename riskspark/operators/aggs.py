"""Aggregation operators (§2.5).

All aggregations are hash aggregates with map-side partial aggregation;
nothing collects an unbounded group: lists are collected only per claim or
per member-code (bounded by the code vocabulary), percentiles use the
bounded-memory ``percentile_approx`` sketch (accuracy is a parameter).
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

AGG_FUNCS = {"sum": F.sum, "count": F.count, "avg": F.avg, "max": F.max, "min": F.min,
             "stddev": F.stddev, "count_distinct": F.count_distinct}


def exact_sum(col: str, scale: int = 2, precision: int = 18) -> Column:
    """Order-independent money sum: add as DECIMAL (exact), return a double.
    Double sums depend on the summation order, which differs by partitioning."""
    return F.sum(F.col(col).cast(f"decimal({precision},{scale})")).cast("double")


def multi_aggregate(df: DataFrame, keys: Sequence[str], spec: Mapping[str, Sequence[str]]) -> DataFrame:
    """agg_multi: ``{column: [sum|count|avg|max|min|…]}`` by a key list → ``{func}_{column}``; sums are exact."""
    aggs = [(exact_sum(c) if f == "sum" else AGG_FUNCS[f](c)).alias(f"{f}_{c}") for c, fs in spec.items() for f in fs]
    return df.groupBy(*keys).agg(*aggs)


def crosstab(df: DataFrame, rows: str, cols: str, values: Sequence, measure: str, func: str = "sum") -> DataFrame:
    """agg_crosstab: rows × columns pivot with the column values given (no
    extra job to discover them)."""
    return df.groupBy(rows).pivot(cols, list(values)).agg(exact_sum(measure) if func == "sum" else AGG_FUNCS[func](measure))


def period_label(date_col: str, period: str) -> Column:
    d = F.col(date_col)
    if period == "day":
        return F.date_format(d, "yyyy-MM-dd")
    if period == "week":  # D18: ISO week-based year + week number
        return F.concat(F.expr(f"extract(YEAROFWEEK FROM {date_col})").cast("string"), F.lit("-W"),
                        F.lpad(F.weekofyear(d).cast("string"), 2, "0"))
    if period == "month":
        return F.date_format(d, "yyyy-MM")
    if period == "quarter":
        return F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string"))
    if period == "year":
        return F.year(d).cast("string")
    raise ValueError(period)


def time_series(df: DataFrame, date_col: str, measure: str, periods: Sequence[str]) -> DataFrame:
    """agg_time_series: sum / avg / count of a measure per period label, for
    several granularities at once (one pass, one shuffle: the label is an
    exploded column)."""
    labels = F.array(*[F.struct(F.lit(p).alias("granularity"), period_label(date_col, p).alias("period"))
                       for p in periods])
    e = df.select(F.explode(labels).alias("_p"), F.col(measure).alias("_m")).select("_p.*", "_m")
    g = e.groupBy("granularity", "period").agg(exact_sum("_m").alias("total"), F.count("_m").alias("n"))
    return g.withColumn("average", F.col("total") / F.col("n"))


def summary_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """agg_summary_stats: count, mean, stddev, min, max, quartiles per column
    — one aggregate pass over all columns, unpivoted to rows; quartiles exact."""
    aggs = []
    for c in cols:
        aggs += [F.count(c).alias(f"{c}__count"), F.avg(c).alias(f"{c}__mean"), F.stddev(c).alias(f"{c}__stddev"),
                 F.min(c).cast("double").alias(f"{c}__min"), F.max(c).cast("double").alias(f"{c}__max")]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__count").alias("n"), F.col(f"{c}__mean").alias("mean"),
                     F.col(f"{c}__stddev").alias("stddev"), F.col(f"{c}__min").alias("min_value"),
                     F.col(f"{c}__max").alias("max_value")) for c in cols]
    stats = one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    values = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in cols])).alias("r")).select("r.*")
    q = percentiles(values, ["column_name"], "v", [0.25, 0.5, 0.75]).toDF("column_name", "q1", "median", "q3")
    return stats.join(q, "column_name", "left")


CUTS = 256  # value ranges per group in which positions are counted


def percentiles(df: DataFrame, keys: Sequence[str], col: str, qs: Sequence[float]) -> DataFrame:
    """agg_percentiles: exact discrete percentiles per group, at every size.

    Equal values are counted first. A sketch cuts each group into ``CUTS`` value
    ranges; positions are running counts inside a range plus the counts of the
    ranges before it, so no window holds a whole group. The cuts only balance
    the work: any cuts give the same result. Nulls are not counted.
    """
    keys = list(keys)
    counts = df.where(F.col(col).isNotNull()).groupBy(*keys, F.col(col).alias("_v")).agg(F.count("*").alias("_n"))
    cuts = df.groupBy(*keys).agg(F.percentile_approx(col, [i / CUTS for i in range(1, CUTS)], 4 * CUTS).alias("_cuts"),
                                 F.count(col).alias("_all"))
    part = F.size(F.filter("_cuts", lambda c: c < F.col("_v"))).alias("_part")
    same = reduce(lambda a, b: a & b, [F.col(f"c.{k}").eqNullSafe(F.col(f"k.{k}")) for k in keys])
    placed = counts.alias("c").join(cuts.alias("k"), same).select(*[F.col(f"c.{k}").alias(k) for k in keys], "_v", "_n", "_all", part)
    by_part = placed.groupBy(*keys, "_part").agg(F.sum("_n").alias("_in"))
    ranges = by_part.withColumn("_before", F.sum("_in").over(
        Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))).drop("_in")
    same = reduce(lambda a, b: a & b, [F.col(f"c.{k}").eqNullSafe(F.col(f"k.{k}")) for k in [*keys, "_part"]])
    running = F.sum("_n").over(Window.partitionBy(*[f"c.{k}" for k in keys], "c._part").orderBy("_v"))
    at = placed.alias("c").join(ranges.alias("k"), same).select(
        *[F.col(f"c.{k}").alias(k) for k in keys], "_v", "_all", (F.coalesce("_before", F.lit(0)) + running).alias("_upto"))
    return at.groupBy(*keys).agg(*[
        F.min(F.when(F.col("_upto") >= F.greatest(F.ceil(F.round(F.col("_all") * q, 6)), F.lit(1)), F.col("_v"))).alias(f"p{int(round(q * 100)):02d}")
        for q in qs])


def profile(df: DataFrame) -> DataFrame:
    """agg_profile: per column null count, null %, exact distinct count and
    type, plus row and column counts. Each column is counted by value in a scan
    of its own, which reads that column only: values are combined in the map
    tasks (a value that most rows share is one row a task), then counted. No
    row is expanded over the columns."""
    n = len(df.columns)

    def column(f: T.StructField) -> DataFrame:
        values = df.select(F.col(f"`{f.name}`").alias("v")).groupBy("v").agg(F.count(F.lit(1)).alias("k"))
        return values.agg(F.coalesce(F.sum("k"), F.lit(0)).alias("row_count"), F.count("v").alias("distinct_count"),
                          F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("k"))), F.lit(0)).alias("null_count")).select(
            F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"), "null_count",
            F.round(F.col("null_count") * 100.0 / F.when(F.col("row_count") > 0, F.col("row_count")), 4).alias("null_pct"), "distinct_count",
            "row_count", F.lit(n).alias("column_count"))
    return reduce(lambda a, b: a.unionByName(b), [column(f) for f in df.schema.fields])


def hcc_tier(n: Column) -> Column:
    """agg_hcc_tier: HIGH_DENSITY ≥ 13, MID 5–12, LOW."""
    return F.when(n >= 13, "HIGH_DENSITY").when(n >= 5, "MID_DENSITY").otherwise("LOW_DENSITY")


def count_factor(n: Column) -> Column:
    """agg_count_factor: 1.25 (≥10), 1.15 (≥5), 1.05 (≥1), else 1.0."""
    return F.when(n >= 10, 1.25).when(n >= 5, 1.15).when(n >= 1, 1.05).otherwise(1.0)


def share_of_total(df: DataFrame, key: str, measure: str | None = None) -> DataFrame:
    """agg_method_share: count, % of total, avg of a measure per key (the
    total is a window over the already-aggregated, tiny result)."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if measure:
        aggs.append(F.avg(measure).alias(f"avg_{measure}"))
    g = df.groupBy(key).agg(*aggs)
    tot = g.agg(F.sum("n").alias("_tot")).withColumn("_one", F.lit(1))
    j = g.withColumn("_one", F.lit(1)).join(F.broadcast(tot), "_one")
    return j.withColumn("pct_of_total", F.round(F.col("n") * 100.0 / F.col("_tot"), 4)).drop("_one", "_tot")
