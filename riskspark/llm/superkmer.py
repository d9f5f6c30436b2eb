"""Substring dedup by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one document. A word goes if a
window over it also starts in a document with a smaller id. The minimiser of
a window is the least hash of its runs of ``GRAM`` words, a function of the
window's words alone; consecutive windows with the same minimiser are a
super-k-mer, which travels as one packed string of words.

1. A scan gives each minimiser's least and greatest document id (counted in
   the map tasks first). Only minimisers of two documents or more go on.
2. A second scan gives the super-k-mers as narrow rows (document, place,
   128-bit digest of the string); those of repeated minimisers stay.
3. Equal strings, as copies have them, become one row with the least id. One
   document of each is asked for the words, so each string travels once,
   packed, to the bucket of its minimiser.
4. A bucket ranks all its windows by sorting: runs of 1, 2, 4 ... 32 words and
   then ``WINDOW`` words get numbers that are equal exactly where the words
   are. Each window thus gets the least id of its documents.
5. Windows found in an earlier document go back by the strings' digests to
   every super-k-mer with them, and as ranges of words to the documents.

A minimiser with more than ``HOT`` different strings (a passage that a third
of all documents wrap in words of their own) is no bucket: its windows are
counted one by one, by 128-bit digest, with partial counts in the map tasks.
So no task holds an unbounded group, whichever way a window goes; the text is
dealt out once, by document, for the words and for the result alike.

Null and empty texts have no words. Rows without an id keep all words and
remove none. Rows that share an id remove nothing from each other; equal rows
stay rows of their own. A text is read whole, however long; super-k-mers of
more than ``PIECE`` windows (periodic texts) travel in pieces. Other columns
are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.operators.sinks import checkpoint

WINDOW = 50
GRAM = 6
PIECE = 64
HOT = 4096
#: Words that a bucket task ranks at a time (a group of one minimiser stays whole; it has HOT strings at most).
BLOCK = 400_000
#: Rows of a record batch that a task hands back.
OUT = 50_000
_KNOWN = 1 << 20  # hashes of words that a task remembers
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def text_key(text: Column, doc_id: Column) -> list[Column]:
    """Columns that tell rows apart, never null: two rows with both equal have the same words and id."""
    return [F.coalesce(doc_id.cast("bigint"), F.lit(0)).alias("doc"), F.xxhash64(text, doc_id.isNull()).alias("tid")]


class Words(dict):
    """Hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h

    def hashes(self, words: list[bytes]) -> np.ndarray:
        if len(self) > _KNOWN:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def super_kmers(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First windows, numbers of windows and minimisers of a text's super-k-mers."""
    n = len(hashes) - WINDOW + 1
    if n < 1:
        none = np.zeros(0, np.int64)
        return none, none, none
    grams = len(hashes) - GRAM + 1
    g = np.zeros(grams, np.uint64)
    for i in range(GRAM):
        g = g * _MULTIPLIER + hashes[i:i + grams]
    g ^= g >> np.uint64(32)
    g *= _MIX
    g ^= g >> np.uint64(29)
    least, span, width = g, 1, WINDOW - GRAM + 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[:n], least[width - span:width - span + n])
    at = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1))
    count = np.diff(np.append(at, n))
    if count.max() > PIECE:
        pieces = -(-count // PIECE)
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        at, count = np.repeat(at, pieces) + nth * PIECE, np.minimum(np.repeat(count, pieces) - nth * PIECE, PIECE)
    return at, count, least[at].view(np.int64)


def _digest(words: bytes) -> bytes:
    return blake2b(words, digest_size=16).digest()


def _batches(names: list[str], parts: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Record batches of about OUT rows from tuples of arrays."""
    held, n = [], 0

    def out() -> pa.RecordBatch:
        columns = [[p[i] if isinstance(p[i], pa.Array) else pa.array(p[i], pa.int64()) for p in held] for i in range(len(names))]
        return pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in columns], names=names)
    for p in parts:
        held.append(p)
        n += len(p[0])
        if n >= OUT:
            yield out()
            held, n = [], 0
    if n:
        yield out()


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """doc, tid and words of each row (doc, tid, text as bytes) that has a window."""
    for b in batches:
        for doc, tid, text in zip(b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2)):
            words = text.as_py().split()  # bytes: at the six ASCII blanks only
            if len(words) >= WINDOW:
                yield doc, tid, words


def _minimisers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def parts() -> Iterator[tuple]:
        known = Words()
        for doc, _, words in _texts(batches):
            mini = np.unique(super_kmers(known.hashes(words))[2])
            yield mini, np.full(len(mini), doc, np.int64)
    return _batches(["mini", "doc"], parts())


def _narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def parts() -> Iterator[tuple]:
        known = Words()
        for doc, tid, words in _texts(batches):
            at, count, mini = super_kmers(known.hashes(words))
            sid = b"".join([_digest(b" ".join(words[a:a + c + WINDOW - 1])) for a, c in zip(at.tolist(), count.tolist())])
            s = np.frombuffer(sid, np.int64).reshape(-1, 2)
            yield mini, s[:, 0], s[:, 1], np.full(len(at), doc, np.int64), np.full(len(at), tid, np.int64), at, count
    return _batches(["mini", "s1", "s2", "doc", "tid", "at", "windows"], parts())


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The strings asked of each document: mini, s1, s2, lo, hi, windows, packed."""
    names = ["mini", "s1", "s2", "lo", "hi", "windows", "packed"]

    def parts() -> Iterator[tuple]:
        for b in batches:
            for text, asked in zip(b.column("text"), b.column("asked")):
                asked = asked.as_py()
                if not asked:
                    continue
                words = text.as_py().split()
                packed = [b" ".join(words[x["at"]:x["at"] + x["windows"] + WINDOW - 1]) for x in asked]
                yield (*[np.array([x[c] for x in asked], np.int64) for c in names[:6]], pa.array(packed, pa.binary()))
    return _batches(names, parts())


def window_ranks(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The words of all strings in one line: at each place a number, equal exactly
    where the same ``WINDOW`` words follow (across strings' ends too), and the strings' first places."""
    words, firsts, n = [], np.zeros(len(packed), np.int64), 0
    for i, p in enumerate(packed):
        firsts[i] = n
        own = p.split(b" ")
        words += own
        n += len(own)
    rank = pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    span = 1
    while span < WINDOW:
        step = min(span, WINDOW - span)
        pairs = rank[:len(rank) - step] * (int(rank.max()) + 1) + rank[step:]
        rank = np.unique(pairs, return_inverse=True)[1]
        span += step
    return rank, firsts


def _found(packed: list[bytes], windows: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows that stand in a document before the string's last: string, first window, windows, least id."""
    rank, firsts = window_ranks(packed)
    string = np.repeat(np.arange(len(packed)), windows)
    j = np.arange(len(string)) - np.repeat(np.cumsum(windows) - windows, windows)
    own = rank[firsts[string] + j]
    least = np.full(int(own.max()) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, own, lo[string])
    least = least[own]
    keep = least < hi[string]
    string, j, least = string[keep], j[keep], least[keep]
    if not len(string):
        return string, j, j, least
    new = np.concatenate(([True], (string[1:] != string[:-1]) | (j[1:] != j[:-1] + 1) | (least[1:] != least[:-1])))
    at = np.flatnonzero(new)
    return string[at], j[at], np.diff(np.append(at, len(string))), least[at]


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by minimiser in; s1, s2, j, n, least out."""
    def groups() -> Iterator[list[pa.RecordBatch]]:
        """Whole minimisers, some BLOCK words at a time."""
        held, size = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            mini = b.column("mini").to_numpy()
            starts = np.append(np.flatnonzero(np.append(True, mini[1:] != mini[:-1])), len(mini))
            words = np.append(0, np.cumsum(b.column("windows").to_numpy() + WINDOW - 1))
            done = 0
            for a in starts[:-1].tolist():
                # a minimiser begins at a; what is held ends before it, unless the batch goes on with the one before
                if size + words[a] - words[done] >= BLOCK and not (a == 0 and held and held[-1].column("mini")[-1].as_py() == mini[0]):
                    yield [*held, b.slice(done, a - done)]
                    held, size, done = [], 0, a
            held.append(b.slice(done))
            size += words[-1] - words[done]
        if held:
            yield held

    def parts() -> Iterator[tuple]:
        for held in groups():
            t = pa.Table.from_batches(held).combine_chunks()
            if not t.num_rows:
                continue
            string, j, n, least = _found(t["packed"].to_pylist(), *[t[c].to_numpy() for c in ("windows", "lo", "hi")])
            yield t["s1"].to_numpy()[string], t["s2"].to_numpy()[string], j, n, least
    return _batches(["s1", "s2", "j", "n", "least"], parts())


def _single_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """s1, s2, lo, hi, j and the digest of each window of the strings."""
    def parts() -> Iterator[tuple]:
        for b in batches:
            s1, s2, lo, hi, windows = (b.column(c).to_numpy() for c in ("s1", "s2", "lo", "hi", "windows"))
            for i, p in enumerate(b.column("packed")):
                words, n = p.as_py().split(b" "), int(windows[i])
                w = np.frombuffer(b"".join([_digest(b" ".join(words[j:j + WINDOW])) for j in range(n)]), np.int64).reshape(-1, 2)
                yield (*[np.full(n, x[i], np.int64) for x in (s1, s2, lo, hi)], np.arange(n), w[:, 0], w[:, 1])
    return _batches(["s1", "s2", "lo", "hi", "j", "w1", "w2"], parts())


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text, spans in; doc_id, n_words, n_removed, removed (spans of words), kept out."""
    span = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    for b in batches:
        total, gone, spans, kept = [], [], [], []
        for text, found in zip(b.column("text"), b.column("spans")):
            words, merged = text.as_py().split(), []
            for first, last in sorted((x["first"], x["last"]) for x in found.as_py() or []):
                if merged and first <= merged[-1]["last"] + 1:
                    merged[-1]["last"] = max(merged[-1]["last"], last)
                else:
                    merged.append({"first": first, "last": last})
            at, left = 0, []
            for m in merged:
                left += words[at:m["first"]]
                at = m["last"] + 1
            left += words[at:]
            total.append(len(words))
            gone.append(len(words) - len(left))
            spans.append(merged)
            kept.append(b" ".join(left))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())],
                                         names=["doc_id", "n_words", "n_removed", "removed", "kept"])


def dedup_substrings(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed, removed (array of first and last word), text (the
    kept words, joined by one space), one row per input row."""
    key = ["doc", "tid"]
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *text_key(F.col("text"), F.col("doc_id")), body)
    named = rows.where(F.col("doc_id").isNotNull()).select(*key, "text")

    # written, so that the joins' sides are plain shuffles, whose large parts Spark can split
    minis = checkpoint(named.mapInArrow(_minimisers, "mini bigint, doc bigint").groupBy("mini")
                       .agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last").select("mini"), "superkmer-minimisers")
    members = checkpoint(named.mapInArrow(_narrow, "mini bigint, s1 bigint, s2 bigint, doc bigint, tid bigint, at bigint, windows bigint")
                         .join(minis, "mini", "left_semi"), "superkmer-members")
    strings = checkpoint(members.groupBy("mini", "s1", "s2").agg(
        F.min(F.struct("doc", "tid", "at", "windows")).alias("of"), F.max("doc").alias("hi")), "superkmer-strings")
    many = checkpoint(strings.groupBy("mini").count().where(F.col("count") > hot).select("mini", F.lit(True).alias("hot")), "superkmer-hot")

    asked = (strings.groupBy(F.col("of.doc").alias("doc"), F.col("of.tid").alias("tid"))
             .agg(F.collect_list(F.struct("mini", "s1", "s2", F.col("of.doc").alias("lo"), "hi", F.col("of.at").alias("at"), F.col("of.windows").alias("windows"))).alias("asked")))
    # the same left join of the same rows as below, so that the texts are dealt out once
    packed = rows.join(asked, key, "left").select("doc_id", "text", "asked").mapInArrow(
        _packed, "mini bigint, s1 bigint, s2 bigint, lo bigint, hi bigint, windows bigint, packed binary")
    found_schema = "s1 bigint, s2 bigint, j bigint, n bigint, least bigint"
    some_hot = not many.isEmpty()
    calm = packed.join(many, "mini", "left_anti") if some_hot else packed
    found = calm.repartition("mini").sortWithinPartitions("mini").mapInArrow(_buckets, found_schema)
    if some_hot:
        windows = packed.join(many, "mini", "left_semi").mapInArrow(
            _single_windows, "s1 bigint, s2 bigint, lo bigint, hi bigint, j bigint, w1 bigint, w2 bigint")
        windows = checkpoint(windows, "superkmer-windows")
        least = checkpoint(windows.groupBy("w1", "w2").agg(F.min("lo").alias("least"), F.max("hi").alias("most"))
                           .where("least < most").drop("most"), "superkmer-least")
        found = found.unionByName(windows.join(least, ["w1", "w2"]).where("least < hi").select(
            "s1", "s2", "j", F.lit(1).cast("bigint").alias("n"), "least"))

    first = F.col("at") + F.col("j")
    spans = (members.select("s1", "s2", "doc", "tid", "at").join(found, ["s1", "s2"]).where("least < doc")
             .groupBy(*key).agg(F.collect_list(F.struct(first.alias("first"), (first + F.col("n") + (WINDOW - 2)).alias("last"))).alias("spans")))
    out = rows.join(spans, key, "left").select("doc_id", "text", F.when(F.col("doc_id").isNotNull(), F.col("spans")).alias("spans"))
    out = out.mapInArrow(_cleaned, "doc_id bigint, n_words bigint, n_removed bigint, removed array<struct<first:bigint,last:bigint>>, kept binary")
    return out.select("doc_id", "n_words", "n_removed", "removed", F.col("kept").cast("string").alias("text"))
