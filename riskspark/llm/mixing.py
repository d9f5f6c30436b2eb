"""Mixing sources to target weights, with DataFrame operations only.

1. A classifier learned from a labelled table gives every document a soft
   membership in each domain. It is a naive Bayes model over hashed words
   (``BUCKETS`` log weights a domain, an array of fixed size): the mean log
   weight of a text's words, times at most ``EVIDENCE`` words, beside the
   domain's prior. It is fitted on at most ``TRAIN_ROWS`` labelled documents
   (those with the smallest hashes of their ids); everything else covers all
   documents.
2. Memberships are rounded to steps of 1/``GRID``. Documents with equal
   memberships get equal rates, so the least squares run on one row per
   distinct membership: a table bounded by the grid, whatever the corpus.
3. Projected gradient: all rates start at one; each round sums the expected
   tokens of every domain over the table in Spark and moves a rate against its
   memberships' residuals, never below ``least``. Residuals are scaled by the
   domains' shares, which makes a step of one safe (the scaled Gram matrix of
   memberships has no eigenvalue above one).

A rate's whole part is a number of copies; its fraction is realised by a hash
of the id, so that expected domain totals match the targets.

Null and empty texts weigh nothing: they have the prior membership and do not
move the totals. Repeated rows are weighed each. Without labelled rows all
memberships are equal. Domains without documents cannot be filled;
their targets are spread over the others. Extra columns stay.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import cut, sql_array

BUCKETS = 1 << 12
TRAIN_ROWS = 10_000
EVIDENCE = 40
GRID = 100
ROUNDS = 60
TOLERANCE = 1e-6


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[ \\n]+"), lambda w: w != "")


def _bucket(w: Column) -> Column:
    return F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int")


def fit(docs: DataFrame, labelled: DataFrame, domains: list[str]) -> tuple[Column, Column]:
    """Priors and log weights (bucket-major) over ``domains``, as literal arrays of fixed size.

    ``labelled``: doc_id, domain; the smallest domain counts where an id has several.
    """
    one = labelled.where(F.col("domain").isin(domains) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("domain").alias("domain"))
    sample = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)
    # bounded by TRAIN_ROWS
    seen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    count = [F.count(F.when(F.col("domain") == d, 1)).cast("double").alias(f"c{i}") for i, d in enumerate(domains)]
    by_bucket = seen.select("domain", F.explode(F.transform(words(F.col("text")), _bucket)).alias("bucket")).groupBy("bucket").agg(*count)
    buckets = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    filled = buckets.join(by_bucket, "bucket", "left").na.fill(0.0)
    total = filled.agg(*[F.sum(f"c{i}").alias(f"t{i}") for i in range(len(domains))])
    # rounded, as the model travels as text in the plan
    logs = [F.round(F.log((F.col(f"c{i}") + 0.5) / (F.col(f"t{i}") + 0.5 * BUCKETS)), 4) for i in range(len(domains))]
    for i in range(len(domains)):
        filled = filled.withColumn(f"t{i}", total.select(f"t{i}").scalar())
    weights = filled.select("bucket", F.array(*logs).alias("l"))
    model = weights.agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "l"))), lambda x: x["l"])).alias("w"))
    prior = sample.agg(F.count("*").alias("n"), *count).select(
        F.array(*[F.log((F.col(f"c{i}") + 1.0) / (F.col("n") + float(len(domains)))) for i in range(len(domains))]).alias("prior"))
    row = model.withColumn("prior", prior.scalar()).first()  # BUCKETS weights a domain
    return sql_array(row["prior"]), sql_array(row["w"])


def memberships(docs: DataFrame, model: tuple[Column, Column], domains: list[str]) -> DataFrame:
    """``docs`` with n_words and p (memberships in steps of 1/GRID, sum one)."""
    k = len(domains)
    prior, weights = model
    buckets = F.transform(words(F.col("text")), _bucket)
    zero = F.struct(F.lit(0).alias("n"), *[F.lit(0.0).alias(f"s{i}") for i in range(k)])

    def totals(w: Column) -> Column:
        return F.aggregate(buckets, zero, lambda a, b: F.struct(
            (a["n"] + 1).alias("n"), *[(a[f"s{i}"] + F.get(w, b * k + i)).alias(f"s{i}") for i in range(k)]))
    d = docs.withColumn("_s", totals(weights))
    scale = F.least(F.col("_s.n"), F.lit(EVIDENCE)) / F.greatest(F.col("_s.n"), F.lit(1))
    z = [prior[i] + scale * F.col(f"_s.s{i}") for i in range(k)]
    top = F.greatest(*z) if k > 1 else z[0]
    d = d.withColumn("_z", F.array(*[F.exp(x - top) for x in z]))
    total = F.aggregate("_z", F.lit(0.0), lambda a, x: a + x)
    d = d.withColumn("_p", F.transform("_z", lambda x: F.round(x / total * GRID).cast("int")))
    steps, left = [], F.lit(GRID)  # whole steps that sum to GRID
    for i in range(k):
        share = F.least(F.col("_p")[i], left) if i < k - 1 else left
        steps.append(share)
        left = left - share
    return d.withColumn("n_words", F.col("_s.n").cast("bigint")).withColumn("p", F.array(*[s / GRID for s in steps])).drop("_s", "_z", "_p")


def rate_column(p: Column, history: list[list[float]], least: float) -> Column:
    """The rate that the rounds so far give to memberships ``p``."""
    if not history:
        return F.lit(1.0)
    steps = F.from_json(F.lit(json.dumps(history)), "array<array<double>>")
    return F.aggregate(steps, F.lit(1.0), lambda r, e: F.greatest(
        F.lit(float(least)), r - F.aggregate(F.zip_with(p, e, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)))


def solve(members: DataFrame, targets: dict[str, float], least: float = 0.0, keep_all: bool = False) -> list[list[float]]:
    """Rounds of the projected gradient: the step of every domain in each.

    ``members``: n_words, p. ``keep_all``: the total grows until no domain has
    to shrink; else the total of tokens stays.
    """
    domains = list(targets)
    cells = cut(members.groupBy("p").agg(F.sum("n_words").alias("tokens")))

    def totals(history):
        r = rate_column(F.col("p"), history, least)
        row = cells.agg(*[F.sum(F.col("tokens") * F.col("p")[i] * r).alias(f"d{i}") for i in range(len(domains))]).first()
        return [x or 0.0 for x in row]

    have = totals([])
    total = sum(have)
    goal = [targets[d] if h > 0 else 0.0 for d, h in zip(domains, have)]
    if total == 0 or sum(goal) == 0:
        return []
    goal = [g / sum(goal) for g in goal]
    share = [h / total for h in have]
    size = total * max(s / g for s, g in zip(share, goal) if g > 0) if keep_all else total
    history: list[list[float]] = []
    for _ in range(ROUNDS):
        now = totals(history) if history else have
        residual = [(x - g * size) / total for x, g in zip(now, goal)]
        if max(map(abs, residual)) < TOLERANCE:
            break
        history.append([round(e / s, 12) if s > 0 else 0.0 for e, s in zip(residual, share)])
    return history


def copies_column(doc_id: Column, rate: Column) -> Column:
    unit = F.pmod(F.xxhash64(doc_id.cast("string"), F.lit("mix")), F.lit(1 << 20)) / float(1 << 20)
    return (F.floor(rate) + (unit < rate - F.floor(rate)).cast("int")).cast("int")


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], least: float = 0.0, keep_all: bool = False) -> DataFrame:
    """doc_id, source, n_words, p, rate, copies: one row per row of ``docs``."""
    model = fit(docs, labelled, list(targets))
    members = cut(memberships(docs.select("doc_id", "source", "text"), model, list(targets)).drop("text"))
    history = solve(members, targets, least, keep_all)
    rated = members.withColumn("rate", rate_column(F.col("p"), history, least))
    return rated.withColumn("copies", copies_column(F.col("doc_id"), F.col("rate")))


def realise(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], least: float = 0.0, keep_all: bool = False) -> DataFrame:
    """``docs`` with every row repeated by its copies."""
    names = list(targets)
    model = fit(docs, labelled, names)
    history = solve(memberships(docs.select("text"), model, names), targets, least, keep_all)
    d = memberships(docs.select(F.struct(*docs.columns).alias("row"), "text"), model, names)
    copies = copies_column(F.col("row.doc_id"), rate_column(F.col("p"), history, least))
    # no filter on the copies: pushed down, it would repeat the classifier in every use of the rate
    return d.select("row", F.explode(F.array_repeat(F.lit(1), copies))).select("row.*")
