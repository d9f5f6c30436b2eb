"""Toxicity by a weighted finite-state pattern grammar.

The lexical transducer writes words as symbols (insult, threat, target,
negation, report, other); clause ends divide them. Of a clause, the target
transducer first reads the symbols from right to left and marks the insults and
threats with a target up to three words after them. Three transducers, composed
into one machine, then read what it wrote from left to right:

* negation: an insult or threat up to two words after a negation is negated;
* reported speech: one after a reporting word in the same clause is reported,
  negated or not;
* target: one up to three words after a target is targeted, as are the marked.

Beside the listed insults, the lexical transducer knows stems learned from the
labels: prefixes of 4 to 6 letters (the longest of those with equal support)
that toxic documents have and clean ones do not (``STEM_SCORE``), in several different contexts, so that the words of a
group of copies do not become stems. They are learned from at most
``TRAIN_TOXIC`` and ``TRAIN_CLEAN`` labelled documents outside the held-out
fold (smallest hashes of their ids).

What the machine emits, not the words alone, is scored: a document's counts of
each emitted pattern go into a logistic model, fitted on the labelled rows by
ridge regression towards prior weights. The labelled rows are aggregated in
Spark to their distinct level vectors, a small table, before the driver fits the
seven weights. A count's level is its base-2 logarithm (of the count and one) in
half steps: it grows ever more slowly, without an end, and has some 60 values.

Null and empty texts have no pattern and get the base score. Repeated rows
are scored alike; a document with several labels counts as toxic if one says
so. Without any labelled row the prior weights hold. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import cut, held_out
from riskspark.operators.joins import DEFAULT_BROADCAST_BYTES, estimated_bytes

# The grammar's word classes.
INSULT = """idiot idiots moron morons stupid dumb fool fools loser losers scum trash garbage filth vermin pathetic
worthless disgusting clown clowns imbecile imbeciles cretin jerk bastard bastards bitch bitches asshole assholes
dumbass retard retards freak freaks pig pigs whore slut coward cowards parasite parasites subhuman
dummkopf arschloch abschaum trottel connard connards salaud ordure estúpido estúpida imbécil basura escoria""".split()
THREAT = "kill murder stab shoot strangle hang destroy hurt beat smash burn rape töten umbringen tuer matar".split()
TARGET = """you your yours yourself u ur he she they him her them his their these those people this that
du dich dir ihr euch tu toi vous te ti usted ustedes""".split()
NEGATION = "not no never isn aren wasn don doesn didn without neither nor nicht kein keine nie ne pas jamais sans sin nunca".split()
REPORT = "said says say wrote writes called calls claimed claims quoted quote quotes alleged reported accused sagte schrieb dit écrit dijo escribió".split()

SYMBOLS = {w: s for s, words in (("T", TARGET), ("N", NEGATION), ("R", REPORT), ("H", THREAT), ("I", INSULT)) for w in words}
CLAUSE_END = set(".!?;:\n")
TOKEN = re.compile(r"[^\W\d_]+|[.!?;:\n]")

#: Emitted patterns and the weights they have before any label is seen.
PRIOR = {"insult": 2.5, "insult_target": 3.0, "threat": 0.3, "threat_target": 1.0, "negated": 0.3, "reported": 0.5}
PATTERNS = list(PRIOR)
PRIOR_BIAS, RIDGE = -2.5, 0.5
NEGATION_REACH, TARGET_REACH = 2, 3

TRAIN_TOXIC, TRAIN_CLEAN = 3000, 6000
STEM_LETTERS = (4, 5, 6)
STEM_SUPPORT = 4     # toxic documents and contexts, copies counted once
STEM_CONTEXTS = 0.3  # contexts per toxic document
STEM_SCORE = 15.0    # documents times the log ratio of the classes' shares
STEMS = 1000
REMEMBER = 300_000   # words whose symbol a task remembers


class Transducer:
    """Deterministic: (state, input symbol) gives (state, output symbol); state 0 is the start."""

    def __init__(self, step):
        self.step = step

    def compose(self, other: "Transducer") -> "Transducer":
        """Feeds what this machine writes to ``other``."""
        def step(state, symbol):
            mine, theirs = state or (0, 0)
            mine, out = self.step(mine, symbol)
            theirs, out = other.step(theirs, out)
            return (mine, theirs), out
        return Transducer(step)

    def table(self, alphabet: str) -> dict:
        """All reachable transitions, states numbered from 0."""
        number, queue, arcs = {0: 0}, deque([0]), {}
        while queue:
            state = queue.popleft()
            for symbol in alphabet:
                after, out = self.step(state, symbol)
                if after not in number:
                    number[after] = len(number)
                    queue.append(after)
                arcs[number[state], symbol] = (number[after], out)
        return arcs


def _negation(left, symbol):
    if symbol in "IHJK" and left:
        return left - 1, symbol.lower()
    return (NEGATION_REACH if symbol == "N" else 0 if symbol == "." else max(0, left - 1)), symbol


def _reported(seen, symbol):
    if symbol in "IHJKihjk" and seen:
        return seen, "r"
    return (1 if symbol == "R" else 0 if symbol == "." else seen), symbol


def _target(left, symbol):
    if symbol in "IH" and left:
        return left - 1, {"I": "J", "H": "K"}[symbol]
    return (TARGET_REACH if symbol == "T" else 0 if symbol == "." else max(0, left - 1)), symbol


EMITS = {"I": "insult", "J": "insult_target", "H": "threat", "K": "threat_target", "r": "reported"} | dict.fromkeys("ihjk", "negated")


@cache
def grammar() -> tuple[dict, dict]:
    """The machine that reads a clause from its end, and the one that reads what it wrote."""
    target = Transducer(_target)
    return target.table("ITNRHO."), Transducer(_negation).compose(Transducer(_reported)).compose(target).table("ITNRHOJK.")


def transduce(arcs: dict, symbols) -> list[str]:
    state, written = 0, []
    for symbol in symbols:
        state, out = arcs[state, symbol]
        written.append(out)
    return written


class Lexicon(dict):
    """The lexical transducer: a word's symbol, by its stem if it is not listed."""

    def __init__(self, stems: list[str]):
        super().__init__(SYMBOLS)
        self.stems = frozenset(stems)

    def __missing__(self, word: str) -> str:
        symbol = "I" if any(word[:n] in self.stems for n in STEM_LETTERS) else "O"
        if len(self) > REMEMBER:
            self.clear()
            self.update(SYMBOLS)
        self[word] = symbol
        return symbol


def pattern_counts(text: str | None, lexicon: Lexicon) -> list[int]:
    """How often each pattern is emitted, in the order of ``PATTERNS``."""
    counts = [0] * len(PATTERNS)
    (backward, forward), clause = grammar(), []

    def close() -> None:
        symbols = [lexicon[w] for w in clause]
        if "I" not in symbols and "H" not in symbols:
            return
        for out in transduce(forward, reversed(transduce(backward, reversed(symbols)))):
            if out in EMITS:
                counts[PATTERNS.index(EMITS[out])] += 1

    for token in TOKEN.findall((text or "").lower()):
        if token in CLAUSE_END:
            close()
            clause = []
        else:
            clause.append(token)
    close()
    return counts


def features(docs: DataFrame, stems: list[str]) -> DataFrame:
    """doc_id and the count of every pattern, one row per row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(stems)
        for b in batches:
            counts = np.array([pattern_counts(t.as_py(), lexicon) for t in b.column(1)], np.int32).reshape(-1, len(PATTERNS))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(counts[:, i]) for i in range(len(PATTERNS)))], names=["doc_id", *PATTERNS])
    schema = "doc_id bigint, " + ", ".join(f"{p} int" for p in PATTERNS)
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, schema)


def truth(labelled: DataFrame) -> DataFrame:
    """doc_id, toxic (0 or 1) of the labelled documents outside the held-out fold."""
    known = labelled.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return known.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of every text: a hash that copies share, and its distinct prefixes with the word before their first place."""
    for b in batches:
        for text in b.column(0):
            words = [w for w in TOKEN.findall((text.as_py() or "").lower()) if w not in CLAUSE_END]
            before = {}
            for last, w in zip(["", *words], words):
                for n in STEM_LETTERS:
                    if len(w) >= n:
                        before.setdefault(w[:n], last)
            if before:
                like = min(xxhash.xxh64_intdigest(w) for w in set(words)) >> 1
                yield pa.RecordBatch.from_arrays([
                    pa.array(list(before), pa.string()), pa.array(list(before.values()), pa.string()), pa.array([like] * len(before), pa.int64())],
                    names=["stem", "before", "like"])


def learn_stems(docs: DataFrame, labelled: DataFrame) -> list[str]:
    known = truth(labelled)
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]

    def prefixes(toxic: int, rows: int) -> tuple[DataFrame, int]:
        sample = cut(known.where(F.col("toxic") == toxic).orderBy(*by_hash).limit(rows).select("doc_id"))
        texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # bounded by ``rows``
        return texts.select("text").mapInArrow(_prefixes, "stem string, before string, like bigint"), sample.count()

    toxic, n_toxic = prefixes(1, TRAIN_TOXIC)
    clean, n_clean = prefixes(0, TRAIN_CLEAN)
    if not n_toxic or not n_clean:
        return []
    support = toxic.groupBy("stem").agg(F.count_distinct("like").alias("p"), F.count_distinct("before").alias("c")).where(
        (F.col("p") >= STEM_SUPPORT) & (F.col("c") >= STEM_SUPPORT) & (F.col("c") >= STEM_CONTEXTS * F.col("p")))
    against = clean.groupBy("stem").agg(F.count("*").alias("n"))
    ratio = F.log((F.col("p") / F.lit(n_toxic)) / ((F.col("n") + 0.5) / F.lit(n_clean)))
    found = support.join(against, "stem", "left").na.fill(0, ["n"]).withColumn("score", F.col("p") * ratio).where(
        (F.col("score") >= STEM_SCORE) & (ratio >= 3.0))
    rows = found.orderBy("n", F.desc("p"), F.desc(F.length("stem")), "stem").limit(STEMS).collect()
    chosen: dict[str, int] = {}
    for r in rows:
        inside = [s for s in chosen if s.startswith(r["stem"])]
        if not any(r["stem"].startswith(s) for s in chosen) and r["p"] - sum(chosen[s] for s in inside) >= STEM_SUPPORT:
            chosen[r["stem"]] = r["p"]
    return sorted(chosen)


def level_column(pattern: str):
    return F.floor(2 * F.log2(F.col(pattern) + 1) + 1e-9) / 2


def levels(counts: np.ndarray) -> np.ndarray:
    return np.floor(2 * np.log2(counts + 1) + 1e-9) / 2


def fit(feats: DataFrame, labelled: DataFrame) -> np.ndarray:
    """Bias and pattern weights from the labelled rows outside the held-out fold."""
    seen = feats.join(truth(labelled), "doc_id")
    cells = seen.groupBy(*[level_column(p).alias(p) for p in PATTERNS]).agg(F.sum(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("pos"), F.count("*").alias("n")).collect()
    prior = np.array([PRIOR_BIAS, *PRIOR.values()])
    if not cells:
        return prior
    cells = sorted(tuple(r) for r in cells)
    x = np.array([[1.0, *c[:len(PATTERNS)]] for c in cells])
    pos, n = np.array([c[-2] for c in cells], float), np.array([c[-1] for c in cells], float)
    w = prior.copy()
    for _ in range(100):  # Newton steps; the ridge keeps them stable
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (n * p - pos) + RIDGE * (w - prior)
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(w)), grad)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    w[1:] = np.maximum(w[1:], 0.0)  # a matched clause never speaks for a clean text
    return w


def score_column(weights):
    z = F.lit(float(weights[0]))
    for p, w in zip(PATTERNS, weights[1:]):
        z = z + level_column(p) * F.lit(float(w))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def scores(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, and the pattern counts behind the score."""
    feats = cut(features(docs, learn_stems(docs, labelled)))
    w = fit(feats, labelled)
    return feats.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column(w).alias("score"),
                        (score_column(w) >= 0.5).cast("int").alias("predicted"), *PATTERNS)


def keep_clean(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is not predicted toxic (rows without an id go by their own text too)."""
    stems = learn_stems(docs, labelled)
    known = truth(labelled).select("doc_id")
    # the weights need the labelled rows only; too many ids to broadcast would mean a shuffle of whole texts
    few = estimated_bytes(known) <= DEFAULT_BROADCAST_BYTES
    w = fit(features(docs.join(F.broadcast(known), "doc_id", "left_semi") if few else docs, stems), labelled)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, lexicon = schema.names.index("text"), Lexicon(stems)
        for b in batches:
            counts = np.array([pattern_counts(t.as_py(), lexicon) for t in b.column(at)], float).reshape(-1, len(PATTERNS))
            z = w[0] + levels(counts) @ w[1:]
            yield b.filter(pa.array(1 / (1 + np.exp(-z)) < 0.5))
    return docs.mapInArrow(run, schema)
