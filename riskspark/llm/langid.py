"""Language ID by a bidirectional gated recurrent network over bytes.

The network reads the UTF-8 bytes of a letter run (A word of the lower-cased
text; runs over ``SEGMENT`` bytes are cut between characters, in training as
in prediction) forwards and backwards, and gives
every byte position a distribution over the languages. It is trained here, in
numpy, by backpropagation through time. A document pools the log probabilities
of all its positions, tempered to the evidence of at most ``EVIDENCE``
positions, into one distribution.

A letter run's positions depend on nothing outside it, so each task labels
every distinct run once and remembers a bounded number of runs; equal runs
are exact repeats of the same computation, and texts are read whole.

Training takes the letter runs of at most ``TRAIN_DOCS`` documents outside the
held-out fold (smallest hashes of their ids), and of those ``TRAIN_RUNS`` pairs
of run and language: the most frequent of each language, all languages in turn,
so that a rare one keeps its share. All pieces of a run are learned, and all
languages weigh alike.

Null texts and texts without letters are ``und`` with score 0. Repeated rows
are labelled alike. Where nothing can be learned, every text is ``und``.
Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.common import held_out

HIDDEN = 16
SEGMENT = 48
TRAIN_DOCS = 3000
TRAIN_RUNS = 12_000
EPOCHS = 12
EVIDENCE = 60
REMEMBER = 250_000
CHUNK_CHARS = 4_000_000  # texts labelled together
SEED = 7
RUN = re.compile(r"[^\W\d_]+")


def letter_runs(text: str | None) -> list[str]:
    return RUN.findall((text or "").lower())


def pieces(run: str) -> list[bytes]:
    """The bytes of a run in pieces of at most ``SEGMENT`` bytes, no character divided."""
    data, out, start = run.encode("utf-8", "surrogatepass"), [], 0
    while start < len(data):
        end = min(start + SEGMENT, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        out.append(data[start:end])
        start = end
    return out


class GRU:
    """Weights by name: for each direction an input table (256, 3H), recurrent (H, 3H) and bias (3H); output (2H, L)."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @classmethod
    def fresh(cls, languages: int, hidden: int = HIDDEN) -> "GRU":
        rng = np.random.default_rng(SEED)
        w = {"out": rng.normal(0, 0.2, (2 * hidden, languages)), "out_bias": np.zeros(languages)}
        for d in "fb":
            w[f"in_{d}"] = rng.normal(0, 0.3, (256, 3 * hidden))
            w[f"rec_{d}"] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden))
            w[f"bias_{d}"] = np.zeros(3 * hidden)
        return cls({k: v.astype(np.float32) for k, v in w.items()})

    def states(self, x: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        """States (n, length, H) of byte rows of equal length, and what the way back needs."""
        table, rec, bias = self.w[f"in_{d}"], self.w[f"rec_{d}"], self.w[f"bias_{d}"]
        n, length = x.shape
        hid = rec.shape[0]
        h, out, tape = np.zeros((n, hid), np.float32), np.empty((n, length, hid), np.float32), []
        for t in range(length) if d == "f" else range(length - 1, -1, -1):
            a = table[x[:, t]] + bias
            gates = 1 / (1 + np.exp(-(a[:, :2 * hid] + h @ rec[:, :2 * hid])))
            z, r = gates[:, :hid], gates[:, hid:]
            rh = r * h
            new = np.tanh(a[:, 2 * hid:] + rh @ rec[:, 2 * hid:])
            tape.append((t, h, z, r, rh, new))
            h = z * h + (1 - z) * new
            out[:, t] = h
        return out, tape

    def log_probs(self, x: np.ndarray) -> np.ndarray:
        """(n, length, languages): the label distribution of every position."""
        both = np.concatenate([self.states(x, "f")[0], self.states(x, "b")[0]], axis=2)
        z = both @ self.w["out"] + self.w["out_bias"]
        z -= z.max(axis=2, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=2, keepdims=True))

    def gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Weighted mean cross-entropy over positions and its gradients, by backpropagation through time."""
        hid = self.w["rec_f"].shape[0]
        outs = {d: self.states(x, d) for d in "fb"}
        both = np.concatenate([outs["f"][0], outs["b"][0]], axis=2)
        z = both @ self.w["out"] + self.w["out_bias"]
        z -= z.max(axis=2, keepdims=True)
        p = np.exp(z)
        p /= p.sum(axis=2, keepdims=True)
        norm = weight.sum() * x.shape[1]
        rows = np.arange(len(y))
        loss = float(-(weight[:, None] * np.log(p[rows, :, y] + 1e-9)).sum() / norm)
        dz = p.copy()
        dz[rows, :, y] -= 1
        dz *= (weight / norm)[:, None, None]
        g = {"out": np.einsum("ntk,ntl->kl", both, dz), "out_bias": dz.sum(axis=(0, 1))}
        dboth = dz @ self.w["out"].T
        for k, d in enumerate("fb"):
            rec = self.w[f"rec_{d}"]
            gt, gr = np.zeros_like(self.w[f"in_{d}"]), np.zeros_like(rec)
            gb, dh = np.zeros(3 * hid, np.float32), np.zeros((len(y), hid), np.float32)
            for t, h, zt, r, rh, new in reversed(outs[d][1]):
                dh = dh + dboth[:, t, k * hid:(k + 1) * hid]
                dnew = dh * (1 - zt) * (1 - new * new)
                drh = dnew @ rec[:, 2 * hid:].T
                da = np.concatenate([dh * (h - new) * zt * (1 - zt), drh * h * r * (1 - r), dnew], axis=1)
                gr[:, :2 * hid] += h.T @ da[:, :2 * hid]
                gr[:, 2 * hid:] += rh.T @ dnew
                np.add.at(gt, x[:, t], da)
                gb += da.sum(axis=0)
                dh = dh * zt + drh * r + da[:, :2 * hid] @ rec[:, :2 * hid].T
            g |= {f"in_{d}": gt, f"rec_{d}": gr, f"bias_{d}": gb}
        return loss, g


def by_length(runs: list[bytes]) -> Iterator[tuple[list[int], np.ndarray]]:
    """Places of the runs of each length, with their bytes as rows."""
    places: dict[int, list[int]] = {}
    for i, r in enumerate(runs):
        places.setdefault(len(r), []).append(i)
    for n, at in sorted(places.items()):
        yield at, np.frombuffer(b"".join(runs[i] for i in at), np.uint8).reshape(-1, n)


def train(rows: list[tuple[str, int, float]], languages: int, epochs: int = EPOCHS) -> GRU:
    """``rows``: run, language number, weight. Adam over batches of runs of equal length."""
    net, rng = GRU.fresh(languages), np.random.default_rng(SEED)
    data = [(piece, y, w) for r, y, w in rows for piece in pieces(r)]
    y, w = np.array([d[1] for d in data]), np.array([d[2] for d in data], np.float32)
    batches = [(np.array(at)[i:i + 128], x[i:i + 128]) for at, x in by_length([d[0] for d in data]) for i in range(0, len(at), 128)]
    m, v, step = {k: np.zeros_like(a) for k, a in net.w.items()}, {k: np.zeros_like(a) for k, a in net.w.items()}, 0
    for epoch in range(epochs):
        rate = 0.02 * (1 - epoch / epochs) + 0.001
        for b in rng.permutation(len(batches)):
            at, x = batches[b]
            _, g = net.gradients(x, y[at], w[at])
            step += 1
            for k in net.w:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
                net.w[k] = (net.w[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return net


def training_runs(docs: DataFrame) -> DataFrame:
    """run, lang, n: the most frequent pairs of each language in the bounded sample of training documents."""
    ids = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id").distinct()
    sample = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS)
    seen = docs.select("doc_id", "text", "lang").where("lang is not null").join(F.broadcast(sample), "doc_id")  # bounded by TRAIN_DOCS

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text, lang in zip(b.column(0), b.column(1)):
                runs = pa.array(letter_runs(text.as_py()), pa.string())
                yield pa.RecordBatch.from_arrays([runs, pa.array([lang.as_py()] * len(runs), pa.string())], names=["run", "lang"])
    pairs = seen.select("text", "lang").mapInArrow(split, "run string, lang string").groupBy("run", "lang").agg(F.count("*").alias("n"))
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "run"))  # of the bounded sample's runs
    return pairs.withColumn("turn", turn).orderBy("turn", "lang").limit(TRAIN_RUNS).drop("turn")


def fit(docs: DataFrame) -> tuple[list[str], GRU | None]:
    rows = training_runs(docs).collect()  # bounded by TRAIN_RUNS
    languages = sorted({r["lang"] for r in rows})
    if not rows:
        return [], None
    total = {lang: sum(np.sqrt(r["n"]) for r in rows if r["lang"] == lang) for lang in languages}
    return languages, train([(r["run"], languages.index(r["lang"]), np.sqrt(r["n"]) / total[r["lang"]] * 1000) for r in rows], len(languages))


class Labeller:
    """Pooled log probabilities of letter runs, each distinct one computed once."""

    def __init__(self, net: GRU):
        self.net, self.place = net, {}
        self.sums = np.zeros((1024, net.w["out"].shape[1]), np.float32)
        self.counts = np.zeros(1024, np.float32)

    def learn(self, runs: list[str]) -> None:
        """Adds runs that are new, several thousand at a time."""
        for start in range(0, len(runs), 8192):
            part = runs[start:start + 8192]
            parts, owner = [], []
            for k, r in enumerate(part):
                own = pieces(r) if any(c.isalpha() for c in r) else []
                parts += own
                owner += [k] * len(own)
            base, need = len(self.place), len(self.place) + len(part)
            if need > len(self.counts):
                grow = max(need, 2 * len(self.counts))
                self.sums = np.concatenate([self.sums, np.zeros((grow - len(self.sums), self.sums.shape[1]), np.float32)])
                self.counts = np.concatenate([self.counts, np.zeros(grow - len(self.counts), np.float32)])
            for at, x in by_length(parts):
                rows = base + np.array([owner[i] for i in at])
                np.add.at(self.sums, rows, self.net.log_probs(x).sum(axis=1))
                np.add.at(self.counts, rows, x.shape[1])
            for k, r in enumerate(part):
                self.place[r] = base + k

    def documents(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Pooled log probabilities and numbers of positions of each text."""
        runs = [letter_runs(t) for t in texts]
        if len(self.place) > REMEMBER:
            self.__init__(self.net)
        new = sorted(set().union(*runs) - self.place.keys()) if runs else []
        self.learn(new)
        sums, counts = np.zeros((len(texts), self.sums.shape[1])), np.zeros(len(texts))
        place = self.place
        for k, words in enumerate(runs):
            at = np.fromiter((place[w] for w in words), np.int64, len(words))
            sums[k], counts[k] = self.sums[at].sum(axis=0, dtype=np.float64), self.counts[at].sum(dtype=np.float64)
        return sums, counts


def identify(docs: DataFrame, languages: list[str], net: GRU | None) -> DataFrame:
    """doc_id, lang_pred, score: one row per row of ``docs``."""
    names = np.array([*languages, "und"], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(net) if net is not None else None
        for b in batches:
            start = 0
            while start < b.num_rows:
                texts, size = [], 0
                while start + len(texts) < b.num_rows and size < CHUNK_CHARS:
                    texts.append(b.column(1)[start + len(texts)].as_py())
                    size += len(texts[-1] or "")
                if labeller is None:
                    best, score = np.full(len(texts), len(languages)), np.zeros(len(texts))
                else:
                    sums, counts = labeller.documents(texts)
                    z = sums / np.maximum(counts, 1)[:, None] * np.minimum(counts, EVIDENCE)[:, None]
                    p = np.exp(z - z.max(axis=1, keepdims=True))
                    p /= p.sum(axis=1, keepdims=True)
                    best, score = p.argmax(axis=1), p.max(axis=1)
                    best, score = np.where(counts > 0, best, len(languages)), np.where(counts > 0, score, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(start, len(texts)), pa.array(names[best], pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])
                start += len(texts)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, lang_pred string, score double")
