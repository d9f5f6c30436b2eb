"""URL filters by a character language-model ratio, with DataFrame operations only.

Rules (host, path, verdict) judge the URLs they fit; the longest rule wins.
The URLs they accept and reject train two variable-order Markov models of the
characters of host and path. A context of up to ``ORDER`` characters predicts
the next one; its counts are smoothed towards the context shortened by one
character, with the weight of ``SMOOTH`` observations, down to equal chances
for all characters. Contexts seen fewer than ``LEAST`` times are not used, so
the order varies with the evidence. A URL scores the mean, over its
characters, of the log ratio of the two models.

The threshold is calibrated on the rule-judged URLs of one fold in five, which
the models do not learn from: the score (in steps of 0.01) with the best mean
of both classes' accuracy, the smallest such on ties; 0 if the fold lacks a
class. URLs that no rule fits are allowed when they score the threshold or more.

Equal URLs are scored once. Characters are shuffled as five-character grams;
frequent grams and hosts are split by Spark's skewed joins, and their counts
combined before shuffling.

Null URLs and those without ``://`` have an empty host and path, no rule, and
score 0. Repeated rows stay, extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from riskspark.llm.common import cut

ORDER = 4
SMOOTH = 2.0
LEAST = 2
ALPHABET = 256
STEP = 0.01
PAD = "\u0002"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return (F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, UPPER.lower()),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def judged(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """page_id, host, path, rule and its verdict (null where none fits).

    ``rules``: (host, path, allow or block); few, so they become conditions.
    """
    host, path = host_path(F.col("url"))
    d = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):  # the longest is asked first
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return d.withColumn("rule", rule).withColumn("by_rule", verdict)


def _grams(strings: DataFrame) -> DataFrame:
    padded = F.concat(F.lit(PAD * ORDER), F.col("s"))
    return strings.where("s <> ''").select("*", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("s")), lambda i: F.substring(padded, i, F.lit(ORDER + 1)))).alias("gram"))


def gram_ratios(strings: DataFrame) -> DataFrame:
    """gram, ratio: log of the models' ratio for the last character after the others.

    ``strings``: s, label (allow, block or null: the gram gets a ratio without being counted).
    """
    counted = _grams(strings).groupBy("gram").agg(
        F.count(F.when(F.col("label") == "allow", 1)).alias("a"), F.count(F.when(F.col("label") == "block", 1)).alias("r"))
    counted = cut(counted)
    low = None
    for k in range(ORDER + 1):
        end = F.substring("gram", ORDER + 1 - k, k + 1)  # k characters of context and the next one
        seen = counted.groupBy(end.alias("end")).agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
        seen = seen.withColumn("context", F.substring("end", 1, k))
        total = seen.groupBy("context").agg(F.sum("a").alias("ta"), F.sum("r").alias("tr"))
        level = seen.join(total, "context")
        use = F.col("ta") + F.col("tr") >= LEAST
        if low is None:
            base = {c: F.lit(1.0 / ALPHABET) for c in "ar"}
        else:
            level = level.withColumn("shorter", F.substring("end", 2, k)).join(low, "shorter")
            base = {c: F.col(f"l{c}") for c in "ar"}
        p = {c: F.when(use, (F.col(c) + SMOOTH * base[c]) / (F.col(f"t{c}") + SMOOTH)).otherwise(base[c]) for c in "ar"}
        level = level.select("end", p["a"].alias("pa"), p["r"].alias("pr"))
        low = level.toDF("shorter", "la", "lr")
    return level.select(F.col("end").alias("gram"), F.log(F.col("pa") / F.col("pr")).alias("ratio"))


def scores(strings: DataFrame) -> DataFrame:
    """s, score of every non-empty string; models from those with a label and ``learn``."""
    labelled = strings.withColumn("label", F.when(F.col("learn"), F.col("label")))
    ratios = gram_ratios(labelled.select("s", "label"))
    return _grams(strings.select("s")).join(ratios, "gram").groupBy("s").agg(F.round(F.avg("ratio"), 6).alias("score"))


def threshold(scored: DataFrame) -> DataFrame:
    """One row, cutoff: calibrated on rows (score, label) as the module says."""
    bins = scored.groupBy(F.floor(F.col("score") / STEP).alias("bin")).agg(
        F.count(F.when(F.col("label") == "allow", 1)).alias("a"), F.count(F.when(F.col("label") == "block", 1)).alias("r"))
    # as many rows as there are steps between the extreme log ratios
    up, every = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(1))

    def under(c: str) -> Column:  # share of the class under the step; null without the class
        return F.try_divide(F.coalesce(F.sum(c).over(up), F.lit(0)), F.sum(c).over(every))
    accuracy = under("r") + 1 - under("a")
    best = bins.select("bin", F.round(accuracy, 9).alias("accuracy")).where("accuracy is not null")
    return best.agg(F.coalesce(F.max(F.struct("accuracy", (-F.col("bin")).alias("b")))["b"] * -STEP, F.lit(0.0)).alias("cutoff"))


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """page_id, host, path, rule, verdict, score, cutoff: one row per row of ``pages``."""
    urls = judged(pages, rules).withColumn("s", F.concat("host", "path"))
    strings = cut(urls.groupBy("s").agg(F.max("by_rule").alias("label")).withColumn("learn", F.crc32(F.col("s").cast("binary")) % 5 != 0))
    scored = cut(scores(strings))
    cutoff = threshold(scored.join(strings.where("label is not null and not learn"), "s")).scalar()
    all_urls = urls.join(scored, "s", "left").withColumn("score", F.coalesce("score", F.lit(0.0))).withColumn("cutoff", cutoff)
    by_model = F.when(F.col("score") >= F.col("cutoff"), "allow").otherwise("block")
    return all_urls.select("page_id", "host", "path", "rule", F.coalesce("by_rule", by_model).alias("verdict"), "score", "cutoff")
