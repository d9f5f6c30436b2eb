"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.session import shared_dir

#: Rows whose crc32(doc_id as text) has remainder 0 are held out of training.
FOLDS = 5


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents that no model learns from (false for a null id)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the files:
    a lost executor recomputes from there, and Spark's context cleaner removes
    the files once the frame is no longer used (if the cluster enables it)."""
    shared_dir(df.sparkSession)  # sets a folder only where the session names none
    return df.checkpoint(eager=True)


def sql_array(values, kind: str = "double") -> Column:
    """A literal array of numbers (model weights of bounded size)."""
    return F.from_json(F.lit("[" + ",".join(repr(float(v)) for v in values) + "]"), f"array<{kind}>")
