"""Sinks and table maintenance (§2.2) without a transactional table format.

Every change is expressed as a pure function returning the **new snapshot**
DataFrame (upsert, scoped delete, insert-if-absent, update, delete, erase);
``write_snapshot`` writes it to a *new* path and returns that path, so a job
never overwrites the files it is reading and a lost executor only re-runs
tasks of the current write.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskspark.session import scratch_path

AUDIT_KEEP = ("created_by", "created_date")


def unique_on(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail the job (at execution, no extra action) if ``keys`` repeat."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    # a filter predicate cannot be pruned away (an unused column could)
    guard = F.when(F.col("_n") > 1, F.raise_error(F.lit(f"duplicate source key on {list(keys)}"))).otherwise(F.lit(True))
    return df.withColumn("_n", n).where(guard).drop("_n")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           keep_from_target: Sequence[str] = AUDIT_KEEP, check_unique: bool = True) -> DataFrame:
    """snk_upsert: matched → source values except ``keep_from_target``
    columns; unmatched source → inserted; other target rows unchanged.
    Target column order and types win; target-only columns keep their value."""
    keys = list(keys)
    src = unique_on(source, keys) if check_unique else source
    tcols = target.columns
    keep = [c for c in tcols if c not in keys and (c in keep_from_target or c not in src.columns)]
    t_keep = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in keep], F.lit(1).alias("_matched"))
    j = src.join(t_keep, keys, "left")
    cols = []
    for f in target.schema.fields:
        c = f.name
        if c in keys:
            cols.append(F.col(c).cast(f.dataType).alias(c))
        elif c in keep:
            v = F.col(f"_t_{c}") if c not in src.columns else \
                F.when(F.col("_matched") == 1, F.col(f"_t_{c}")).otherwise(F.col(c))
            cols.append(v.cast(f.dataType).alias(c))
        else:
            cols.append(F.col(c).cast(f.dataType).alias(c))
    updated = j.select(*cols)
    untouched = target.join(src.select(*keys), keys, "left_anti")
    return untouched.unionByName(updated)


def upsert_scoped_delete(target: DataFrame, source: DataFrame, keys: Sequence[str], scope: Column,
                         keep_from_target: Sequence[str] = AUDIT_KEEP) -> DataFrame:
    """snk_upsert_scoped_delete: upsert, plus delete target rows that are in
    ``scope`` but absent from the source (NOT MATCHED BY SOURCE AND scope)."""
    keys = list(keys)
    new = upsert(target, source, keys, keep_from_target)
    stale = target.where(F.coalesce(scope, F.lit(False))).join(source.select(*keys), keys, "left_anti").select(*keys)
    return new.join(stale, keys, "left_anti")


def insert_if_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """snk_insert_if_absent: MERGE with only WHEN NOT MATCHED THEN INSERT."""
    keys = list(keys)
    new_rows = source.join(target.select(*keys), keys, "left_anti").select(*target.columns)
    return target.unionByName(new_rows)


def update_where(df: DataFrame, cond: Column, set_: Mapping[str, Column]) -> DataFrame:
    """snk_update: ``set`` columns where the condition holds (null → no change)."""
    c = F.coalesce(cond, F.lit(False))
    return df.withColumns({k: F.when(c, v).otherwise(F.col(k)) for k, v in set_.items()})


def delete_where(df: DataFrame, cond: Column) -> DataFrame:
    """snk_delete: rows where the condition is true are removed (null keeps)."""
    return df.where(~F.coalesce(cond, F.lit(False)))


def erase_members(children: Sequence[tuple[DataFrame, str]], parent: DataFrame, parent_key: str,
                  erase_ids: DataFrame) -> list[DataFrame]:
    """snk_member_erase: delete child rows via the parent key first, then the
    parents (left anti joins; ``erase_ids`` holds ``parent_key`` values)."""
    ids = erase_ids.select(parent_key).distinct()
    out = [c.join(ids.withColumnRenamed(parent_key, k), k, "left_anti") for c, k in children]
    out.append(parent.join(ids, parent_key, "left_anti"))
    return out


def align_to(df: DataFrame, target_schema) -> DataFrame:
    """snk_append_cast: every target column, cast, in target order (missing → null)."""
    cols = []
    for f in target_schema.fields:
        src = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(src.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def with_audit(df: DataFrame, operation: str, source: str, target: str, user: str = "riskspark",
               ts: Column | None = None) -> DataFrame:
    """snk_audit_cols: lineage / audit columns (time left out of checked outputs
    by passing a fixed ``ts``)."""
    t = ts if ts is not None else F.current_timestamp()
    return df.withColumns({"audit_operation": F.lit(operation), "audit_source": F.lit(source),
                           "audit_target": F.lit(target), "processed_by": F.lit(user),
                           "processed_ts": t, "created_by": F.lit(user), "updated_by": F.lit(user)})


#: Bytes of one file of a partitioned write, by the sizes of the values before encoding.
FILE_BYTES = 256 * 1024 * 1024


def row_bytes(df: DataFrame) -> Column:
    """A row's size: the bytes of its texts, 8 for any other value (lists and structs as their text)."""
    parts = []
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        if kind in ("string", "binary"):
            parts.append(F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)))
        elif kind.startswith(("array", "map", "struct")):
            parts.append(F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))), F.lit(0)))
        else:
            parts.append(F.lit(8))
    return reduce(lambda a, b: a + b, parts).cast("bigint")


def file_plan(df: DataFrame, partition_by: Sequence[str], file_bytes: int = FILE_BYTES) -> DataFrame:
    """One row a partition value: the value's bytes, its ``files`` (as many as
    the bytes need) and ``first``, the number of the first of them."""
    counted = df.groupBy(*partition_by).agg(F.sum(row_bytes(df)).alias("bytes"))
    plan = counted.withColumn("files", F.greatest(F.lit(1), F.ceil(F.col("bytes") / file_bytes)).cast("int"))
    before = F.sum("files").over(Window.orderBy(*partition_by)) - F.col("files")  # one row a partition value
    return checkpoint(plan.withColumn("first", before.cast("int")), "file-plan")


def spread(df: DataFrame, partition_by: Sequence[str], file_bytes: int = FILE_BYTES) -> DataFrame:
    """``df`` dealt out for a partitioned write: one task a file of the plan, so a
    value with most of the rows is written by many tasks and no small one by several."""
    from riskspark.operators.joins import broadcast_if_small
    plan = file_plan(df, partition_by, file_bytes)
    total = plan.agg(F.sum("files")).first()[0]
    if not total:
        return df
    named = plan.select(*[F.col(f"`{c}`").alias(f"_v{i}") for i, c in enumerate(partition_by)], "files", "first")
    same = reduce(lambda a, b: a & b, [df[f"`{c}`"].eqNullSafe(F.col(f"_v{i}")) for i, c in enumerate(partition_by)])
    salt = F.pmod(F.xxhash64(*[df[f"`{c}`"] for c in df.columns]), F.col("files"))
    at = df.join(broadcast_if_small(named), same).withColumn("_file", (F.col("first") + salt).cast("int"))
    return at.repartitionById(int(total), "_file").select(*df.columns)


def write_snapshot(df: DataFrame, path: str | None = None, partition_by: Sequence[str] = (),
                   mode: str = "errorifexists", spark: SparkSession | None = None, name: str = "snapshot",
                   file_bytes: int = FILE_BYTES) -> str:
    """snk_overwrite / snk_checkpoint: write Parquet to a new path under the
    shared folder (or ``path``); a partitioned write goes by a file plan from
    the counted bytes of each partition value."""
    spark = spark or df.sparkSession
    path = path or scratch_path(spark, name)
    w = spread(df, partition_by, file_bytes) if partition_by else df
    writer = w.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


@contextmanager
def in_place(spark: SparkSession, on: bool = True) -> Iterator[None]:
    """While it lasts, frames dealt out by some of a join's keys are joined where they
    are. Spark shuffles both anew by all of the keys otherwise, as if none were dealt
    out; groupings and windows it does in place anyhow. Only plans made and run
    meanwhile, as those of ``checkpoint``, are changed, and no row of theirs."""
    before = spark.conf.get(CO_PARTITION)
    spark.conf.set(CO_PARTITION, "false" if on else "true")
    try:
        yield
    finally:
        spark.conf.set(CO_PARTITION, before)


def is_in_place(spark: SparkSession) -> bool:
    return spark.conf.get(CO_PARTITION) == "false"


def checkpoint(df: DataFrame, name: str = "ckpt") -> DataFrame:
    """Lineage cut that survives executor loss: write to the shared folder
    (``spark.checkpoint.dir``) and read back."""
    spark = df.sparkSession
    p = write_snapshot(df, spark=spark, name=name)
    return spark.read.parquet(p)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
