"""Exact dedup by stateful streaming, with DataFrame operations only.

The documents are read as a stream. Its state, kept on disk (RocksDB) and
checkpointed to the shared folder, has an entry for every digest ever seen and
never expires: how many rows had it, and of the row that stays (most code
points, then smallest id) the identifier and a content locator (file and row
within the file). Entries are aggregates, so a digest that a third of all rows
share reaches its partition as one row per task. A run that is started again
on the same checkpoint goes on where it stopped and takes only new files.

The state is then read as a table. Every row joins the entry of its digest;
rows of digests that were hit more than once carry their normalised text and
are compared, byte for byte, with the text at the entry's locator. Should
different texts share a digest, the rows of that digest are grouped by their
full text instead, so the result does not depend on the digest.

Texts are equal when identical without blanks (space and U+0009 to U+000D);
null counts as empty. Rows without an id lose ties; repeated rows are rows of
their own. Empty tables give empty results. Columns beside ``doc_id`` and
``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm.common import cut
from riskspark.session import scratch_path

BLANKS = " \t\n\x0b\x0c\r"
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # no megabytes reserved for a small store
}


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _rows(read: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """doc_id, n_chars, body, digest and the locator (file, row) of every row."""
    d = read.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.length("text"), F.lit(0)).alias("n_chars"),
        normalised(F.col("text")).alias("body"),
        F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias("at"))
    return d.withColumn("digest", digest(F.col("body")))


def _best() -> Column:
    """Orders rows: most code points, then smallest id (none last), then place."""
    return F.struct(F.col("n_chars"), F.col("doc_id").isNotNull().alias("named"), (F.lit(-1) - F.col("doc_id")).alias("back"), F.col("at"))


def run_stream(spark: SparkSession, path: str, checkpoint: str, digest: Callable[[Column], Column] = sha256) -> None:
    """Takes the files under ``path`` that the checkpoint has not seen into its state."""
    schema = spark.read.parquet(path).schema
    # a glob, so that one file is a source as well as a folder of files
    source = spark.readStream.schema(schema).format("parquet").load(path[:-1] + f"[{path[-1]}]")
    state = _rows(source, digest).groupBy("digest").agg(F.count("*").alias("n"), F.max(_best()).alias("best"))
    with _settings(spark, ROCKSDB):
        query = (state.writeStream.format("noop").outputMode("update").trigger(availableNow=True)
                 .option("checkpointLocation", checkpoint).start())
        query.awaitTermination()


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """digest, n, keep_id, keep_at of every entry."""
    with _settings(spark, ROCKSDB):
        state = spark.read.format("statestore").option("path", checkpoint).load()
        value = state.schema["value"].dataType.names  # the aggregates, in their order
        best = f"value.`{value[1]}`"
        return state.select(
            F.col("key.digest").alias("digest"), F.col(f"value.`{value[0]}`").alias("n"),
            (F.lit(-1) - F.col(f"{best}.back")).alias("keep_id"), F.col(f"{best}.at").alias("keep_at"))


def _by_text(hits: DataFrame) -> DataFrame:
    """The exact way for digests that different texts share: groups by the full text."""
    groups = hits.groupBy("body").agg(F.count("*").alias("size"), F.max(_best()).alias("best"))
    return hits.join(groups, "body").select(
        "doc_id", (F.lit(-1) - F.col("best.back")).alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("at") == F.col("best.at")).alias("kept"), sha256(F.col("body")).alias("text_sha256"))


def exact_groups(spark: SparkSession, path: str, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per row under ``path``."""
    checkpoint = scratch_path(spark, "exact-dedup")
    run_stream(spark, path, checkpoint, digest)
    rows = _rows(spark.read.parquet(path), digest).withColumn("sha", F.col("digest") if digest is sha256 else sha256(F.col("body")))
    if spark.read.parquet(path).isEmpty():
        return rows.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"))
    joined = rows.join(read_state(spark, checkpoint).hint("shuffle_hash"), "digest")
    found = cut(joined.select(
        "doc_id", "n_chars", "at", "digest", "sha", "n", "keep_id", (F.col("at") == F.col("keep_at")).alias("kept"),
        F.when(F.col("n") > 1, F.col("body")).alias("body")))
    forget(spark, checkpoint)
    hits = found.where("n > 1")
    first = hits.where("kept").select("digest", F.col("body").alias("keep_body"))
    differ = cut(hits.join(first, "digest").where("body <> keep_body").select("digest").distinct())
    out = [F.col("doc_id"), F.col("keep_id"), F.col("n").alias("group_size"), F.col("kept"), F.col("sha").alias("text_sha256")]
    if differ.isEmpty():
        return found.select(*out)
    return found.join(differ, "digest", "left_anti").select(*out).unionByName(_by_text(hits.join(differ, "digest", "left_semi")))


def forget(spark: SparkSession, path: str) -> None:
    """Removes a folder of this run that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
