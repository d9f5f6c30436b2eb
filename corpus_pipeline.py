"""The corpus pipeline: documents to token ids, in five stages.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
stage's rows as Parquet to the shared folder and goes on from the files, so a
lost executor repeats no earlier stage.

Null and empty texts are clean, have no line to lose and no token (``ids`` is
empty); all of them with an id have the same fingerprint, so the one with the
smallest id stays. Rows without an id pass every stage by their own text and
stay beside near copies. Repeated rows of one id stay or go together; of equal
ids there is no smaller one. Of ties in a group the smallest id stays. Very long
texts are read whole. Extra columns, also of the names that the operators use,
pass all stages but the last. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm import bpe, line_dedup, mixing, queries, simhash, toxicity
from riskspark.llm.common import documents, labels
from riskspark.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows predicted toxic go."""
    return toxicity.keep_clean(docs, labels(spark, sf_dir))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines go from the texts; rows stay."""
    return line_dedup.dedup_lines(docs).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the smallest id stays."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeat until expected domain totals have the target shares; every row stays at least once."""
    labelled = queries.domain_labels(spark, sf_dir).where(F.col("domain") != "toxic")
    return mixing.realise(docs, labelled, queries.CLEAN_TARGETS, least=1.0, keep_all=True)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_tokens and the digests of ids and of the decoded bytes."""
    return bpe.digests(bpe.round_trip(docs, queries.RANKS, queries.PATTERN), "doc_id", "lang", "source", "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("byte_bpe", tokenize),
]

#: Learned scores and similarity groups have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
