"""Line dedup by winnowing over line hashes, with DataFrame operations only.

* A line is its trimmed text; its weight is its number of blank-separated
  words, one at least. A shingle is the shortest run of lines from a line on
  that weighs ``NOISE`` words; a window, the shortest run that weighs
  ``WINDOW`` words. Of the shingles inside a window the one with the smallest
  hash is its fingerprint, so any two equal runs of ``WINDOW`` words select the
  same fingerprint, and no run lighter than ``NOISE`` is ever matched.
* A fingerprint joins the first place (smallest document, then line) that has
  the same shingle, the first that also has the same line before it, and the
  first that also has the same line after it: one partner per key, so a
  passage in a million documents makes a million rows, not its square.
* A shingle at three places or more may have other partners than these: there
  every whole window around it, the shortest that starts at a line and the
  shortest that ends at one, joins its own first place and is deleted at every
  later one. So each line of an equal run of ``WINDOW`` words goes.
* A match is extended both ways, line by line, as far as the next fingerprint
  can be (``WINDOW`` lines; that one extends further), and verified by two
  64-bit hashes of every shingle and one of every line.
* The matched run is deleted at the later place. A line is only ever deleted
  for an equal line at an earlier place, so the first copy of each line stays.

Documents are ordered by (doc_id, hash of the text), null ids first; repeated
rows (same id and text) count as one document and are cleaned alike. Null
texts stay null, empty ones empty. A text that loses all lines becomes empty;
its row stays. Extra columns stay; ``n_chars`` is brought up to date where the
input has it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import cut

NOISE = 8     # words: lighter runs never match
WINDOW = 16   # words: heavier equal runs always do


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _lines(text: Column) -> Column:
    def line(x: Column) -> Column:
        t = F.trim(x)
        return F.struct(F.xxhash64(t).alias("h"), F.xxhash64(t, F.lit("2")).alias("g"),
                        (F.length(t) - F.length(F.translate(t, " ", "")) + 1).alias("w"))
    return F.transform(F.split(text, "\n"), line)


def _reach(lines: Column, words: int) -> Column:
    """How many of ``lines`` weigh ``words``; 0 if all together do not."""
    start = F.struct(F.lit(0).alias("w"), F.lit(0).alias("n"))
    return F.aggregate(
        lines, start,
        lambda a, x: F.when(a["w"] >= words, a).otherwise(F.struct((a["w"] + x["w"]).cast("int").alias("w"), (a["n"] + 1).alias("n"))),
        lambda a: F.when(a["w"] >= words, a["n"]).otherwise(0))


def _shingles(lines: Column, noise: int, window: int) -> Column:
    """For every line: lines in its shingle and window, and the shingle's hashes."""
    def at(i: Column) -> Column:
        def of(part: Column) -> Column:
            return let(_reach(part, noise), lambda n: F.struct(
                n.alias("n"), _reach(part, window).alias("m"),
                F.xxhash64(F.transform(F.slice(part, 1, n), lambda x: x["h"])).alias("a"),
                F.xxhash64(F.transform(F.slice(part, 1, n), lambda x: x["g"])).alias("b")))
        return let(F.slice(lines, i + 1, window), of)
    return F.transform(F.sequence(F.lit(0), F.size(lines) - 1), at)


def _minima(s: Column) -> Column:
    """For every line the position of the minimum of the window that starts there, null without a window."""
    def least(i: Column) -> Column:
        end = i + s[i]["m"]
        inside = F.filter(F.sequence(i, end - 1), lambda j: (s[j]["n"] > 0) & (j + s[j]["n"] <= end))
        return F.array_min(F.transform(inside, lambda j: F.struct(s[j]["a"].alias("a"), j.alias("j"))))["j"]
    return F.transform(F.sequence(F.lit(0), F.size(s) - 1), lambda i: F.when(s[i]["m"] > 0, least(i)))


def _around(s: Column, least: Column, j: Column, window: int) -> Column:
    """The windows with the minimum ``j`` as (lines before j) * (window + 1) + lines: the shortest
    from their first line, and those that are the shortest up to a later last line."""
    def of(i: Column) -> Column:
        beyond = F.when(F.coalesce(F.get(s["m"], i + 1), F.lit(0)) > 0, F.get(s["m"], i + 1)).otherwise(F.size(s) - i)
        sizes = F.sequence(s[i]["m"], F.greatest(s[i]["m"], beyond))
        return F.transform(sizes, lambda n: ((j - i) * (window + 1) + n).cast("smallint"))
    starts = F.filter(F.sequence(F.greatest(j - window, F.lit(0)), j), lambda i: F.coalesce(least[i] == j, F.lit(False)))
    return F.flatten(F.transform(starts, of))


def seeds(docs: DataFrame, noise: int = NOISE, window: int = WINDOW) -> DataFrame:
    """One row per selected shingle: its hashes (a, b), place (doc_id, t, j), its
    length n, the windows around it, and the line hashes before it (nearest first) and from it on."""
    def of(lines: Column) -> Column:
        def rows(s: Column) -> Column:
            h = F.transform(lines, lambda x: x["h"])
            return let(_minima(s), lambda least: F.transform(F.array_distinct(F.filter(least, lambda j: j.isNotNull())), lambda j: F.struct(
                s[j]["a"].alias("a"), s[j]["b"].alias("b"), j.alias("j"), s[j]["n"].alias("n"), _around(s, least, j, window).alias("windows"),
                F.reverse(F.slice(h, F.greatest(j - window, F.lit(0)) + 1, F.least(j, F.lit(window)))).alias("before"),
                F.slice(h, j + 1, s[j]["n"] + window).alias("on"))))
        return let(_shingles(lines, noise, window), rows)

    found = docs.select("doc_id", F.xxhash64("text").alias("t"), F.inline(let(_lines(F.col("text")), of)))
    return found


def _equal(a: Column, b: Column) -> Column:
    """Length of the common beginning of two arrays."""
    return let(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))),
               lambda same: let(F.array_position(same, False), lambda p: F.when(p > 0, p - 1).otherwise(F.size(same)))).cast("int")


def _repeated_windows(shared: DataFrame, window: int) -> DataFrame:
    """doc_id, t, run (first and last line): every window but the first of its kind, of shingles at three places or more."""
    by = ["a", "b", "code", "lines"]
    around = F.concat(F.reverse("before"), F.col("on"))
    size = (F.col("code") % (window + 1)).cast("int")
    ahead = F.floor(F.col("code") / (window + 1)).cast("int")
    every = shared.where("copies > 2").select("a", "b", "doc_id", "t", "j", around.alias("around"), F.size("before").alias("n_before"), F.explode("windows").alias("code"))
    every = every.select("a", "b", "code", F.xxhash64(F.slice("around", F.col("n_before") - ahead + 1, size)).alias("lines"), "doc_id", "t", "j")
    first = every.groupBy(*by).agg(F.min(F.struct("doc_id", "t", "j")).alias("first"), F.count("*").alias("copies")).where("copies > 1")
    later = every.join(first, by).where(F.struct("doc_id", "t", "j") != F.col("first"))
    return later.select("doc_id", "t", F.struct((F.col("j") - ahead).alias("first"), (F.col("j") - ahead + size - 1).alias("last")).alias("run"))


def repeated_runs(docs: DataFrame, noise: int = NOISE, window: int = WINDOW) -> DataFrame:
    """doc_id, t, deleted (sorted line numbers from 0) of the documents that repeat earlier runs."""
    found = cut(seeds(docs, noise, window))
    twice = found.groupBy("a", "b").agg(F.count("*").alias("copies")).where("copies > 1")
    shared = cut(found.join(twice, ["a", "b"]))
    keys = F.array(
        F.struct(F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("beside")),
        F.struct(F.lit(1).alias("kind"), F.get("before", F.lit(0)).alias("beside")),
        F.struct(F.lit(2).alias("kind"), F.get("on", F.col("n")).alias("beside")))
    by = ["a", "b", "kind", "beside"]
    keyed = shared.drop("windows", "copies").select("*", F.inline(keys)).where("beside is not null")
    first = keyed.groupBy(*by).agg(F.min(F.struct("doc_id", "t", "j", "before", "on")).alias("first"), F.count("*").alias("copies"))
    later = keyed.join(first.where("copies > 1"), by).where(
        F.struct("doc_id", "t", "j") != F.struct("first.doc_id", "first.t", "first.j"))
    runs = later.select(
        "doc_id", "t", "j", "n", _equal(F.col("before"), F.col("first.before")).alias("back"),
        _equal(F.col("on"), F.col("first.on")).alias("ahead")).where("ahead >= n")
    runs = runs.select("doc_id", "t", F.struct((F.col("j") - F.col("back")).alias("first"), (F.col("j") + F.col("ahead") - 1).alias("last")).alias("run"))
    lines = F.flatten(F.transform("runs", lambda r: F.sequence(r["first"], r["last"])))
    return runs.unionByName(_repeated_windows(shared, window)).groupBy("doc_id", "t").agg(F.collect_set("run").alias("runs")).select(
        "doc_id", "t", F.sort_array(F.array_distinct(lines)).alias("deleted"))


def dedup_lines(docs: DataFrame, noise: int = NOISE, window: int = WINDOW) -> DataFrame:
    """``docs`` with repeated runs deleted from ``text``, and ``deleted`` (line numbers from 0)."""
    d = docs.drop("deleted")
    runs = repeated_runs(d.select("doc_id", "text"), noise, window).select(F.struct("doc_id", "t").alias("_run_of"), "deleted")
    joined = d.join(runs, F.col("doc_id").eqNullSafe(F.col("_run_of.doc_id")) & (F.xxhash64("text") == F.col("_run_of.t")), "left")

    def rest(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("deleted"))
        return F.array_join(F.transform(kept, lambda i: lines[i]), "\n")
    text = F.when(F.col("deleted").isNull(), F.col("text")).otherwise(let(F.split("text", "\n"), rest))
    new = {c: F.col(c) for c in d.columns} | {"text": text}
    out = joined.select(*[v.alias(c) for c, v in new.items()], F.coalesce("deleted", F.array().cast("array<int>")).alias("deleted"))
    if "n_chars" in d.columns:
        out = out.withColumn("n_chars", F.when(F.size("deleted") > 0, F.length("text").cast(d.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out
