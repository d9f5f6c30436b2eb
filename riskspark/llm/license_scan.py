"""License scans by diagonal voting.

Every word k-gram of every text is joined, by a rolling-window hash and then
by its words, to the places of that gram in the templates. A hit of document
word ``i`` on template word ``j`` votes for the diagonal ``i - j``, the place
where the template would begin. Votes are aggregated by diagonal as a bit mask
of template grams. A phrase stands where one diagonal has all its grams.

Other templates are also found near one. Diagonals up to ``SHIFT`` words apart
(a word more or less in the text) form a chain; in a chain without a complete
diagonal, the hits from each hit on that span no more than ``STRETCH`` times
the template are merged. The share of the template's grams among them is their
coverage; the chain's best span counts at a coverage of ``COVER`` or more. Templates are a fixed, short list,
so that side of the join is broadcast; texts are exploded but only hits are
shuffled. The votes are written once: both kinds of span read them.

Null and empty texts have no words and score 0. Rows that repeat a text under
the same id share their hits; every row stays. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.common import cut

K = 2
SHIFT = 3
STRETCH = 1.5
COVER = 0.8
SCALE = 1 << 20  # the longest span in the order of hits; at least the square of its words
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Phrases and labels. At most 63 grams each (the votes' bit mask).
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]
TEMPLATES = [
    ("licensed under the gnu general public license version 3", "gpl-3.0-notice"),
    ("licensed under the gnu general public license version 2", "gpl-2.0-notice"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("licensed under cc by sa 4 0", "cc-by-sa-4.0"),
    ("creative commons attribution sharealike", "cc-by-sa"),
    ("creative commons attribution noncommercial", "cc-by-nc"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("subject to the terms of the mozilla public license", "mpl"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
]


def words(text: Column) -> Column:
    """Words of the text with A-Z lower-cased."""
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    return F.filter(F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")


def template_grams(spark, base: list, own: list) -> DataFrame:
    """template, label, base, grams, size (words), j, gram, hash."""
    rows = []
    for t, (phrase, label) in enumerate([*base, *own]):
        w = phrase.split()
        if not K <= len(w) <= 64:
            raise ValueError(f"a template has {K} to 64 words: {phrase}")
        rows += [(t, label, t < len(base), len(w) - K + 1, len(w), j, " ".join(w[j:j + K])) for j in range(len(w) - K + 1)]
    df = spark.createDataFrame(rows, "template int, label string, base boolean, grams int, size int, j int, gram string")
    return df.withColumn("hash", F.xxhash64("gram"))


def diagonals(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """Votes by (doc_id, t, template, diagonal): mask of template grams, first and last word hit."""
    grams = F.transform(F.col("w"), lambda x, i: F.concat(x, F.lit(" "), F.get("w", i + 1)))  # null after the last word
    w = docs.select("doc_id", F.xxhash64("text").alias("t"), words(F.col("text")).alias("w"))
    every = w.select("doc_id", "t", F.posexplode(grams).alias("i", "gram")).withColumn("hash", F.xxhash64("gram")).alias("d")
    # the templates are fixed: a few hundred rows
    hits = every.join(F.broadcast(templates).alias("m"), (F.col("d.hash") == F.col("m.hash")) & (F.col("d.gram") == F.col("m.gram")))
    vote = F.expr("shiftleft(1L, j)")
    return hits.groupBy("doc_id", "t", "template", (F.col("i") - F.col("j")).alias("diagonal")).agg(
        F.bit_or(vote).alias("mask"), F.min("i").alias("first"), F.max("i").alias("last"))


def spans(votes: DataFrame, templates: DataFrame) -> DataFrame:
    """Verified spans: doc_id, t, label, base, exact, first, last (words), coverage."""
    of = F.broadcast(templates.select("template", "label", "base", "grams", "size").distinct())  # as few as templates
    v = votes.join(of, "template")
    v = v.withColumn("full", F.bit_count("mask") == F.col("grams"))
    key = ["doc_id", "t", "template", "label", "base", "grams", "size", "span"]
    by = Window.partitionBy("doc_id", "t", "template").orderBy("diagonal")
    chain = Window.partitionBy("doc_id", "t", "template", "span")
    new = F.when(F.col("diagonal") - F.lag("diagonal").over(by) <= SHIFT, 0).otherwise(1)
    chained = v.where("not base").withColumn("new", new).withColumn("span", F.sum("new").over(by)).select(
        *key, "diagonal", "mask", F.bit_or("mask").over(chain).alias("all"), F.max("full").over(chain).alias("complete"))
    hits = chained.where(~F.col("complete") & (F.bit_count("all") / F.col("grams") >= COVER)).select(
        *key, "diagonal", F.explode(F.filter(F.sequence(F.lit(0), F.col("grams") - 1), lambda j: F.getbit("mask", j) == 1)).alias("j")).withColumn("i", F.col("diagonal") + F.col("j"))
    # a range frame has one length for all templates: words are scaled to it
    words_on = F.floor(F.col("size") * STRETCH) - K
    within = chain.orderBy("at").rangeBetween(0, SCALE)
    near = hits.withColumn("at", F.col("i") * F.floor(F.lit(SCALE) / words_on)).select(
        *key, "i", F.bit_or(F.expr("shiftleft(1L, j)")).over(within).alias("mask"), F.max("i").over(within).alias("last"))
    best = F.max(F.struct((F.bit_count("mask") / F.col("grams")).alias("coverage"), (F.col("i") - F.col("last")).alias("shortest"), (-F.col("i")).alias("first")))
    merged = near.groupBy(*key).agg(best.alias("b")).where(F.col("b.coverage") >= COVER).select(
        "doc_id", "t", "label", "base", F.lit(False).alias("exact"), (-F.col("b.first")).alias("first"),
        (-F.col("b.first") - F.col("b.shortest") + (K - 1)).alias("last"), "b.coverage")
    exact = v.where("full").select("doc_id", "t", "label", "base", F.col("full").alias("exact"), "first", (F.col("last") + (K - 1)).alias("last"), F.lit(1.0).alias("coverage"))
    return exact.unionByName(merged)


def scan(docs: DataFrame, base: list = BASE, own: list = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score; one row per row of ``docs``."""
    templates = template_grams(docs.sparkSession, base, own)
    found = spans(cut(diagonals(docs, templates)), templates).groupBy(F.col("doc_id").alias("_id"), "t").agg(
        F.count(F.when(F.col("base"), 1)).alias("n_base"),
        F.min(F.when(F.col("base"), F.col("first"))).alias("first_word"), F.max(F.when(F.col("base"), F.col("first"))).alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"), F.max("coverage").alias("score"))
    d = docs.select("doc_id", F.xxhash64("text").alias("_t"), F.size(words(F.col("text"))).cast("bigint").alias("n_words"))
    out = d.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_t") == F.col("t")), "left")
    none = F.lit("")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"),
        F.col("first_word").cast("bigint").alias("first_word"), F.col("last_word").cast("bigint").alias("last_word"),
        F.coalesce("base_labels", none).alias("base_labels"), F.coalesce("labels", none).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
