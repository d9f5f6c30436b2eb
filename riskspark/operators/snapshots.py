"""Keyed snapshots on plain Parquet that a load changes in part.

A snapshot is a folder of data folders, one a partition value, and of
numbered manifests that say which data folder is current for which value. A
load reads and rewrites only the partitions that hold its keys; the manifest
it adds names the files of all others as they are. Nothing is overwritten: a
load that is lost half-way leaves folders that no manifest names.

``part`` is an expression of columns that a key never changes (a range of the
key, the month of a claim), so old and new rows of a key meet in one partition.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.operators.sinks import AUDIT_KEEP, checkpoint, upsert

_PART = "_part"


def key_range(key: str, width: int) -> Column:
    """Partitions of ``width`` consecutive key values."""
    return F.floor(F.col(key) / width).cast("string")


@dataclass(frozen=True)
class Snapshot:
    """The folder of a keyed snapshot, its key and its partition expression."""
    path: str
    keys: tuple[str, ...]
    part: Column

    def _numbers(self, spark: SparkSession) -> list[int]:
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest")
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(p):
            return []
        return sorted(int(f.getPath().getName()) for f in fs.listStatus(p)
                      if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS")))

    def manifest(self, spark: SparkSession, number: int | None = None) -> dict[str, str]:
        """Partition value → data folder, of the latest or the given load (one entry a partition)."""
        done = self._numbers(spark)
        if not done:
            return {}
        rows = spark.read.parquet(f"{self.path}/manifest/{number or done[-1]}").collect()
        return {r["part"]: r["folder"] for r in rows}

    def read(self, spark: SparkSession, number: int | None = None, parts: Sequence[str] | None = None) -> DataFrame | None:
        """The snapshot, or some of its partitions; None where there is nothing yet."""
        found = self.manifest(spark, number)
        folders = [f for p, f in sorted(found.items()) if parts is None or p in parts]
        return spark.read.parquet(*folders) if folders else None

    def load(self, source: DataFrame, keep_from_target: Sequence[str] = AUDIT_KEEP) -> list[str]:
        """Merges ``source`` (unique on the key, the snapshot's columns): its rows
        replace or join those of equal keys. Returns the partitions written."""
        spark = source.sparkSession
        source = checkpoint(source, "load")  # staged: the load reads it several times
        done, current = self._numbers(spark), self.manifest(spark)
        tagged = source.withColumn(_PART, F.coalesce(self.part, F.lit("none")))
        touched = sorted(r[0] for r in tagged.select(_PART).distinct().collect())  # one value a partition
        old = self.read(spark, parts=touched)
        merged = upsert(old, source, self.keys, keep_from_target) if old is not None else source
        folder = f"{self.path}/data/{len(done) + 1}-{uuid.uuid4().hex[:8]}"
        # a rebalance, not a partitioning by value: Spark splits what is large and merges what is small
        merged.withColumn(_PART, F.coalesce(self.part, F.lit("none"))).hint("rebalance", _PART).write.partitionBy(_PART).parquet(folder)
        new = dict(current) | {p: f"{folder}/{_PART}={p}" for p in touched}
        spark.createDataFrame(sorted(new.items()), "part string, folder string").coalesce(1).write.parquet(
            f"{self.path}/manifest/{(done[-1] if done else 0) + 1}")
        return touched
