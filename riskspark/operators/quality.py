"""Data quality, reconciliation, change detection and layout (§2.12).

Every check is one aggregate pass producing a small result table (no
``count()`` per column, no driver loops over data); checks that compare two
tables use one full-outer / anti join on the keys.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from typing import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Observation
from pyspark.sql import types as T

from riskspark.session import scratch_path


def one1(a: DataFrame, b: DataFrame) -> DataFrame:
    """Attach a single-row aggregate ``b`` to every row of ``a`` (equi join on a
    constant key, broadcast of the one-row side)."""
    return a.withColumn("_one", F.lit(1)).join(F.broadcast(b.withColumn("_one", F.lit(1))), "_one").drop("_one")


def _unpivot(one_row: DataFrame, items: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(check, column, metric-column) triples of a one-row frame → rows."""
    arr = F.array(*[F.struct(F.lit(k).alias("check_name"), F.lit(c).alias("column_name"),
                             F.col(m).cast("long").alias("failed_count")) for k, c, m in items])
    return one_row.select(F.explode(arr).alias("r")).select("r.*")


def quality_checks(df: DataFrame, required: Sequence[str], keys: Sequence[str],
                   valid_values: Mapping[str, Sequence]) -> DataFrame:
    """dq_checks: null counts on required columns, duplicate rows on the key
    list, invalid-value counts — one keyed aggregate (partial sums per key,
    map-side combined), then one global sum; no join."""
    per_key = [F.count(F.lit(1)).alias("_n")]
    per_key += [F.sum(F.col(c).isNull().cast("long")).alias(f"null__{c}") for c in required]
    per_key += [F.sum((~F.coalesce(F.col(c).isin(*vals), F.lit(False))).cast("long")).alias(f"invalid__{c}")
                for c, vals in valid_values.items()]
    g = df.groupBy(*keys).agg(*per_key)
    tot = [F.sum(F.col(f"null__{c}")).alias(f"null__{c}") for c in required]
    tot += [F.sum(F.col(f"invalid__{c}")).alias(f"invalid__{c}") for c in valid_values]
    tot.append(F.sum(F.col("_n") - 1).alias("dup__keys"))
    one = g.agg(*tot)
    items = [("null_count", c, f"null__{c}") for c in required]
    items += [("invalid_value", c, f"invalid__{c}") for c in valid_values]
    items.append(("duplicate_key", ",".join(keys), "dup__keys"))
    return _unpivot(one, items)


def drop_quality_failures(df: DataFrame, required: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Optional clean-up of dq_checks: drop rows with a null required column,
    then one row per key."""
    return df.dropna(subset=list(required)).dropDuplicates(list(keys))


def expectations(df: DataFrame, rules: Sequence[Mapping]) -> DataFrame:
    """dq_expectations: row count in range, not null, regex match, value range,
    each with a ``mostly`` threshold and a severity — one aggregate, then one
    result row per expectation (the DQ summary table)."""
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, r in enumerate(rules):
        kind, c = r["kind"], r.get("column")
        if kind == "not_null":
            bad = F.col(c).isNull()
        elif kind == "regex":
            bad = F.col(c).isNotNull() & ~F.col(c).rlike(r["pattern"])
        elif kind == "between":
            bad = F.col(c).isNotNull() & ~F.col(c).between(r["min"], r["max"])
        elif kind == "row_count_between":
            continue
        else:
            raise ValueError(kind)
        aggs.append(F.sum(bad.cast("long")).alias(f"__bad{i}"))
    one = df.agg(*aggs)
    rows = []
    for i, r in enumerate(rules):
        if r["kind"] == "row_count_between":
            bad = F.lit(0).cast("long")
            ok = F.col("__rows").between(r["min"], r["max"])
        else:
            bad = F.col(f"__bad{i}")
            ok = (F.lit(1.0) - bad / F.col("__rows")) >= F.lit(float(r.get("mostly", 1.0)))
        rows.append(F.struct(F.lit(r["name"]).alias("expectation"), F.lit(r.get("column")).cast("string").alias("column_name"),
                             ok.alias("success"), bad.alias("unexpected_count"),
                             F.round(bad * 100.0 / F.col("__rows"), 4).alias("unexpected_pct"),
                             F.lit(r.get("severity", "ERROR")).alias("severity")))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def relationships(child: DataFrame, fk: str, parent: DataFrame, pk: str, name: str) -> DataFrame:
    """dq_relationships: null foreign keys and orphans (FK not in parent) —
    one left join to the distinct parent keys and one aggregate."""
    keys = parent.select(F.col(pk).alias(fk), F.lit(1).alias("_hit")).distinct()
    j = child.select(fk).join(keys, fk, "left")
    return j.agg(F.count(F.lit(1)).alias("child_rows"), F.sum(F.col(fk).isNull().cast("long")).alias("null_fk"),
                 F.sum((F.col(fk).isNotNull() & F.col("_hit").isNull()).cast("long")).alias("orphan_count")) \
        .select(F.lit(name).alias("rule"), "child_rows", "null_fk", "orphan_count")


def schema_diff(df: DataFrame, expected: T.StructType) -> list[tuple[str, str, str, str]]:
    """dq_schema: (column, issue, expected type, actual type) for missing
    columns and type mismatches — metadata only, no data read."""
    actual = {f.name.lower(): f.dataType.simpleString() for f in df.schema.fields}
    out = []
    for f in expected.fields:
        a = actual.get(f.name.lower())
        if a is None:
            out.append((f.name, "MISSING", f.dataType.simpleString(), None))
        elif a != f.dataType.simpleString():
            out.append((f.name, "TYPE_MISMATCH", f.dataType.simpleString(), a))
    return out


def reconcile(source: DataFrame, target: DataFrame, keys: Sequence[str],
              compare: Mapping[str, float] | None = None) -> DataFrame:
    """dq_reconcile: counts, matched, missing in target, extra in target, and
    value mismatches (numeric columns within a tolerance, others exact) —
    one full-outer join on the keys and one aggregate. PASS when nothing is
    missing, extra or mismatched."""
    keys = list(keys)
    compare = compare or {}
    s = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in compare], F.lit(1).alias("_s"))
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in compare], F.lit(1).alias("_t"))
    j = s.join(t, keys, "full_outer")
    both = (F.col("_s") == 1) & (F.col("_t") == 1)
    mism = F.lit(False)
    for c, tol in compare.items():
        a, b = F.col(f"_s_{c}"), F.col(f"_t_{c}")
        diff = (F.abs(a - b) > tol) if tol is not None else ~a.eqNullSafe(b)
        mism = mism | F.coalesce(diff, ~a.eqNullSafe(b))
    agg = j.agg(F.sum(F.coalesce("_s", F.lit(0))).alias("source_count"), F.sum(F.coalesce("_t", F.lit(0))).alias("target_count"),
                F.sum(both.cast("long")).alias("matched"),
                F.sum((F.col("_t").isNull()).cast("long")).alias("missing_in_target"),
                F.sum((F.col("_s").isNull()).cast("long")).alias("extra_in_target"),
                F.sum((both & mism).cast("long")).alias("value_mismatches"))
    ok = (F.col("missing_in_target") == 0) & (F.col("extra_in_target") == 0) & (F.col("value_mismatches") == 0)
    return agg.withColumn("status", F.when(ok, "PASS").otherwise("FAIL"))


def incremental(current: DataFrame, previous: DataFrame, keys: Sequence[str], updated: str) -> DataFrame:
    """dq_incremental (D20): rows of ``current`` that are new (key absent
    before) or changed (later update time); both sides aliased, the output is
    the current row plus ``change_type``."""
    keys = list(keys)
    prev = previous.select(*keys, F.col(updated).alias("_prev_upd"))
    j = current.join(prev, keys, "left")
    ct = F.when(F.col("_prev_upd").isNull(), "NEW").when(F.col(updated) > F.col("_prev_upd"), "CHANGED")
    return j.withColumn("change_type", ct).where(F.col("change_type").isNotNull()).drop("_prev_upd")


def outliers(df: DataFrame, value: str, by: Sequence[str], threshold: float = 3.0) -> DataFrame:
    """dq_outliers: z-score with the sample stddev of the group; the group
    statistics (one row per group) are joined back, broadcast only when their
    estimated size is bounded."""
    from riskspark.operators.joins import broadcast_if_small
    by = list(by)
    st = df.groupBy(*by).agg(F.avg(value).alias("_mean"), F.stddev(value).alias("_sd"))
    j = df.join(broadcast_if_small(st), by) if by else one1(df, st)
    z = (F.col(value) - F.col("_mean")) / F.col("_sd")
    return j.withColumn("z_score", z).withColumn("is_outlier", F.abs(z) > threshold).drop("_mean", "_sd")


def salted_sum(df: DataFrame, key: str, value: str, salt_by: Sequence[str], n_salts: int = 16,
               scale: int = 2) -> DataFrame:
    """lay_skew: a hot key's rows are spread over ``n_salts`` sub-groups by a
    deterministic salt ``pmod(xxhash64(row columns), n)`` (no ``rand``: a
    recomputed task salts identically), summed per (key, salt) first, then per
    key — the row set and the result are unchanged, no task holds a whole hot
    key."""
    salt = F.pmod(F.xxhash64(*salt_by), F.lit(n_salts))
    part = df.withColumn("_salt", salt).groupBy(key, "_salt").agg(
        F.sum(F.col(value).cast(f"decimal(18,{scale})")).alias("_p"), F.count(F.lit(1)).alias("_n"))
    return part.groupBy(key).agg(F.sum("_p").cast("double").alias(f"sum_{value}"), F.sum("_n").alias("n_rows"))


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """lay_cache: a frame used more than once, persisted (memory, spilling to
    disk) within the ``with`` block and released after it. What the block builds
    must be written before its end, or it is computed from the lineage."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


class StepLog:
    """dq_step_log: rows in / out / change % per pipeline step, taken from the
    pipeline's own run by Spark's observed metrics: no count job, no cache."""

    def __init__(self) -> None:
        self._steps: list[tuple[str, Observation]] = []

    def step(self, name: str, df: DataFrame) -> DataFrame:
        """``df``, observed; the count is known once a job has run through it to the end."""
        seen = Observation(f"step-{len(self._steps)}-{name}")
        self._steps.append((name, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("rows_out"))

    def frame(self, spark: SparkSession) -> DataFrame:
        """step_no, step, rows_in, rows_out, change_pct: one row a step."""
        rows, before = [], None
        for i, (name, seen) in enumerate(self._steps):
            n = seen.get["rows_out"]
            rows.append((i, name, before, n, None if not before else (n - before) * 100.0 / before))
            before = n
        out = spark.createDataFrame(rows, "step_no int, step string, rows_in bigint, rows_out bigint, change_pct double")
        return out.withColumn("change_pct", F.round("change_pct", 4))


def quarantine(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Splits rows in one pass: (accepted, rejected). ``rules`` maps a reason code
    to the condition of a valid row (null counts as not met). Rejected rows have
    ``reasons``, the sorted codes of all rules they break. Both sides are written
    by the one job that tags the rows, so the input is read once and the rejected
    rows stay as files whatever becomes of the run that goes on with the others."""
    broken = F.array_sort(F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(code)) for code, ok in rules.items()])))
    path = scratch_path(df.sparkSession, "quarantine")
    tagged = df.withColumn("reasons", broken)
    tagged.withColumn("_side", F.when(F.size("reasons") == 0, "accepted").otherwise("rejected")) \
        .write.partitionBy("_side").parquet(path)
    back = df.sparkSession.read.schema(tagged.schema.add("_side", "string")).parquet(path)
    accepted, rejected = (back.where(F.col("_side") == side).drop("_side") for side in ("accepted", "rejected"))
    return accepted.drop("reasons"), rejected
