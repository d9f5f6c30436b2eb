"""Document fingerprints: an improbable-feature digest.

Features are windows of ``WINDOW`` bytes, one at every byte of the text. A
window's class is the entropy of its bytes, in thousandths of the most that the
window can have; a class is the rarer, the fewer windows of the whole corpus
have it (counted over all documents in Spark). Among every ``NEIGHBOURS``
windows in a row the rarest, the first on ties, gets a point; windows with
``POINTS`` or more are selected, unless their entropy is under ``FLOOR``; a text
without such a window has its rarest. Each selected window sets five bits of a
Bloom filter of 2048; after ``CAPACITY`` windows the chain gets another filter.

Entropies slide: from one window to the next a byte leaves and one comes, and
how often each stands in the window is counted for all places at once, of a
whole batch of texts laid end to end; windows over a text's end do not count.

Two chains compare filter by filter: the bits in common, beyond those that
chance explains, over the most there could be; each filter of the shorter
chain with its best partner, averaged, weighted by the filter's windows.

Texts shorter than a window are one feature. Null and empty texts have no
feature: their fingerprint is the empty string, like itself (1) and unlike all
others (0). Fingerprints depend on the bytes and the corpus' rarities alone,
so equal texts have equal ones.

``edited_pairs`` needs each document's successor by descending id (rows
without an id last, ties by text; after the last comes the first): documents
are dealt by ranges of ids, and the first row of each range also goes to the
range before it. Repeated rows are rows of their own.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 64
NEIGHBOURS = 8
POINTS = 3
CLASSES = 1000
FLOOR = 100
BITS = 2048
HASHES = 5
CAPACITY = 160
BLOCK = 1 << 14  # windows classified, ranked or hashed at a time
GROUP = 1 << 20  # bytes of texts that are laid end to end at a time
ROWS = 512       # rows whose classes are held at a time
PAIRS = 1 << 20  # filter pairs compared at a time
PART_CHARS = 1 << 30  # a range of ids dealt to one task holds about so many characters at most
FINE = 4         # narrow ranges of ids counted for each part

#: n log2 n in whole steps, so that a window's entropy does not depend on the order of the sum.
_G = np.round(np.concatenate([[0.0], np.arange(1, WINDOW + 1) * np.log2(np.arange(1, WINDOW + 1))]) * (1 << 20)).astype(np.int64)
_STEP = np.diff(_G)  # what one more of a byte adds
NONE = np.zeros(0, np.int16)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def padded(data: bytes) -> np.ndarray:
    """The bytes; those of a shorter text than a window are filled up to one, an empty text has none."""
    return np.frombuffer(data if not data or len(data) >= WINDOW else data.ljust(WINDOW, b"\0"), np.uint8)


def classes(a: np.ndarray) -> np.ndarray:
    """Entropy class of the window at every place of the last axis."""
    ahead, behind = np.zeros(a.shape, np.uint8), np.zeros(a.shape, np.uint8)  # the same byte, in the window from here on and up to here
    for d in range(1, WINDOW):
        same = (a[..., d:] == a[..., :-d]).view(np.uint8)
        ahead[..., :-d] += same
        behind[..., d:] += same
    repeated = np.cumsum(_STEP[behind], axis=-1)[..., WINDOW - 1:]
    repeated[..., 1:] -= np.cumsum(_STEP[ahead[..., :-WINDOW]], axis=-1)
    entropy = np.log2(WINDOW) - repeated / (WINDOW << 20)
    return np.clip((entropy / np.log2(WINDOW) * CLASSES).astype(np.int16), 0, CLASSES)


def kinds(data: bytes) -> Iterator[np.ndarray]:
    """Classes of all windows, in blocks, in order."""
    a = padded(data)
    for start in range(0, len(a) - WINDOW + 1, BLOCK):
        yield classes(a[start:start + BLOCK + WINDOW - 1])


def many_kinds(texts: list[bytes]) -> list[np.ndarray]:
    """Classes of all windows of each text. Texts are laid end to end and
    classified block by block; windows over a text's end are left out."""
    out: list[np.ndarray] = [NONE] * len(texts)
    group, size = [], 0

    def flush() -> None:
        if group:
            line = np.concatenate([padded(texts[i]) for i in group])
            found = np.concatenate([classes(line[at:at + BLOCK + WINDOW - 1]) for at in range(0, len(line) - WINDOW + 1, BLOCK)])
            at = 0
            for i in group:
                n = max(len(texts[i]), WINDOW)
                out[i] = found[at:at + n - WINDOW + 1]
                at += n
    for i, data in enumerate(texts):
        if not data:
            continue
        group.append(i)
        size += len(data)
        if size >= GROUP:
            flush()
            group, size = [], 0
    flush()
    return out


def seam(data: bytes, at: int) -> tuple[int, int, bytes]:
    """How many windows of ``data`` end before ``at``, how many begin from there on, and the bytes of all others."""
    first, last = max(0, at - WINDOW + 1), max(0, len(data) - at - WINDOW + 1)
    between = data[first:len(data) - last]
    return first, last, between if len(between) >= WINDOW or not first + last else b""


def joined_kinds(data: bytes, at: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Classes of all windows of ``data``, which up to ``at`` is the beginning of a text with the
    classes ``left`` and from there on that of one with ``right``: only windows over the seam are new."""
    first, last, between = seam(data, at)
    return np.concatenate([left[:first], *many_kinds([between]), right[:last]])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, ROWS):
            yield b.slice(at, ROWS)


def hashes(rows: np.ndarray) -> np.ndarray:
    words = np.ascontiguousarray(rows).view(np.uint64)
    odd = 2 * _mix(np.arange(1, words.shape[1] + 1, dtype=np.uint64)) + np.uint64(1)
    return _mix((_mix(words) * odd).sum(axis=1, dtype=np.uint64))


def select(kind: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Places of the selected windows, given all classes of a text."""
    n = min(len(kind), NEIGHBOURS)
    points = np.zeros(len(kind), np.uint8)
    for start in range(0, len(kind) - n + 1, BLOCK):
        part = rarity[kind[start:start + BLOCK + n - 1]]
        key = part * len(part) + np.arange(len(part))  # the rarest, then the first
        best = key[:len(key) - n + 1].copy()
        for d in range(1, n):
            np.minimum(best, key[d:len(key) - n + 1 + d], out=best)
        points[start:start + len(part)] += np.bincount(best % len(part), minlength=len(part)).astype(np.uint8)
    if len(kind) <= NEIGHBOURS:
        points *= POINTS
    chosen = np.flatnonzero((points >= POINTS) & (kind >= FLOOR))
    return chosen if len(chosen) or not len(kind) else np.array([rarity[kind].argmin()])


def digest(text: str | None, rarity: np.ndarray) -> np.ndarray:
    """The chain: one row of 256 bytes per filter, preceded by its number of windows (2 bytes)."""
    data = utf8(text)
    return chain_of(data, np.concatenate([NONE, *kinds(data)]), rarity)


def chain_of(data: bytes, kind: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    if not data:
        return np.zeros((0, 2 + BITS // 8), np.uint8)
    view, chosen = np.lib.stride_tricks.sliding_window_view(padded(data), WINDOW), select(kind, rarity)
    chosen = np.unique(np.concatenate([hashes(view[chosen[i:i + BLOCK]]) for i in range(0, len(chosen), BLOCK)]), return_index=True)
    features = chosen[0][np.argsort(chosen[1])]  # in the order of the text
    chain = []
    for at in range(0, len(features), CAPACITY):
        part = features[at:at + CAPACITY]
        bits = np.zeros(BITS, bool)
        for k in range(HASHES):
            bits[((part >> np.uint64(11 * k)) & np.uint64(BITS - 1)).astype(np.int64)] = True
        chain.append(np.concatenate([np.array([len(part)], ">u2").view(np.uint8), np.packbits(bits)]))
    return np.array(chain)


def encode(chain: np.ndarray) -> str:
    return base64.b64encode(chain.tobytes()).decode()


def _best(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For every filter of ``a`` the score of its best partner in ``b``."""
    x, y = np.unpackbits(a[:, 2:], axis=1).astype(np.float32), np.unpackbits(b[:, 2:], axis=1).astype(np.float32)
    nx, ny = x.sum(axis=1)[:, None], y.sum(axis=1)[None, :]
    chance, most = nx * ny / BITS, np.minimum(nx, ny)
    return np.clip((x @ y.T - chance) / np.maximum(most - chance, 1e-6), 0, 1).max(axis=1)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1; 1 for equal chains."""
    if a.shape == b.shape and (a == b).all():
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    if len(a) > len(b) or len(a) == len(b) and a.tobytes() > b.tobytes():
        a, b = b, a
    step = max(1, PAIRS // len(b))
    score = np.concatenate([_best(a[i:i + step], b) for i in range(0, len(a), step)])
    weight = a[:, :2].copy().view(">u2").ravel().astype(float)
    return round(float((score * weight).sum() / weight.sum()), 9)


def rarities(docs: DataFrame) -> np.ndarray:
    """Windows of every entropy class over all documents: the fewer, the rarer."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES + 1, np.int64)
        for b in _slices(batches):
            for kind in many_kinds([utf8(t.as_py()) for t in b.column(0)]):
                total += np.bincount(kind, minlength=CLASSES + 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES + 1)), pa.array(total)], names=["kind", "n"])
    rows = docs.select("text").mapInArrow(count, "kind bigint, n bigint").groupBy("kind").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(CLASSES + 1, np.int64)
    for r in rows:  # one row per class
        out[r["kind"]] = r["n"]
    return out


def fingerprints(docs: DataFrame, rarity: np.ndarray | None = None) -> DataFrame:
    """doc_id, fingerprint: one row per row of ``docs``."""
    rarity = rarities(docs) if rarity is None else rarity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            texts = [utf8(t.as_py()) for t in b.column(1)]
            chains = [encode(chain_of(t, kind, rarity)) for t, kind in zip(texts, many_kinds(texts))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(chains, pa.string())], names=["doc_id", "fingerprint"])
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, fingerprint string")


def _above(value: Column, cuts: list[int]) -> Column:
    """How many of ``cuts`` (descending) are greater: by whole blocks, then inside one."""
    step = max(1, isqrt(len(cuts)))
    blocks = [cuts[i:i + step] for i in range(0, len(cuts), step)]
    least = F.from_json(F.lit(json.dumps([b[-1] for b in blocks])), "array<bigint>")
    inside = F.from_json(F.lit(json.dumps(blocks)), "array<array<bigint>>")
    whole = F.size(F.filter(least, lambda c: c > value))
    block = F.coalesce(F.get(inside, whole), F.array().cast("array<bigint>"))
    return F.least(whole * step + F.size(F.filter(block, lambda c: c > value)), F.lit(len(cuts)))  # the last block may be short


def in_order(docs: DataFrame) -> DataFrame:
    """doc_id, text, part, guest: each part holds a range of ids in descending
    order, then, as a guest, the row that follows its last one.

    Ids are counted and their characters summed in ``FINE`` narrow ranges a part;
    neighbouring ranges form parts of about equal length.
    """
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    length = F.coalesce(F.length("text"), F.lit(0)).cast("bigint")
    size = d.agg(F.sum(length)).first()[0] or 0
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // PART_CHARS)
    n = FINE * parts
    cuts = d.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10 * n)).first()[0] or []
    cuts = sorted(set(cuts), reverse=True)  # at most one a range
    dealt = d.withColumn("range", F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(_above(F.col("doc_id"), cuts)))
    # one row a range
    ranges = sorted((r["range"], r["head"], r["size"]) for r in dealt.groupBy("range").agg(
        F.max("doc_id").alias("head"), F.sum(length + F.lit(1)).alias("size")).collect())
    if not ranges:
        return d.select("*", F.lit(0).alias("part"), F.lit(False).alias("guest"))
    every, before, part_of, heads = sum(r[2] for r in ranges), 0, [0] * (len(cuts) + 2), {}
    for k, head, chars in ranges:
        # ids that are null have a part of their own; a range belongs where its middle lies
        part_of[k] = parts if k > len(cuts) else (2 * before + chars) * parts // (2 * every)
        before += chars
        heads.setdefault(part_of[k], head)  # ranges come in descending order of ids
    dealt = dealt.withColumn("part", F.get(F.from_json(F.lit(json.dumps(part_of)), "array<int>"), F.col("range"))).drop("range")
    order = sorted(heads)
    to = docs.sparkSession.createDataFrame([(p, heads[p], order[i - 1]) for i, p in enumerate(order)], "part int, head bigint, to int")
    # one row a part
    guests = dealt.join(F.broadcast(to), "part").where(F.col("doc_id").eqNullSafe(F.col("head"))).select("doc_id", "text", F.col("to").alias("part"), F.lit(True).alias("guest"))
    both = dealt.withColumn("guest", F.lit(False)).unionByName(guests)
    return both.repartitionById(parts + 1, F.col("part")).sortWithinPartitions("part", "guest", F.desc_nulls_last("doc_id"), F.asc_nulls_first("text"))


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def edited_pairs(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    rarity = rarities(docs)
    schema = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row whose successor comes next
        for b in _slices(batches):
            rows = []
            for i, kind in enumerate(many_kinds([utf8(t.as_py()) for t in b.column(1)])):
                text = b.column(1)[i].as_py() or ""
                rows.append((b.column(0)[i].as_py(), text, b.column(2)[i].as_py(), chain_of(utf8(text), kind, rarity), kind, b.column(3)[i].as_py()))
            pairs = []  # each row with its successor
            for row in rows:
                if held is not None and held[2] == row[2]:
                    pairs.append((held, row))
                held = None if row[5] else row
            texts = [utf8(edited(own[1], after[1])) for own, after in pairs]
            seams = [seam(t, len(utf8(own[1][:len(own[1]) - len(own[1]) // 2]))) for t, (own, _) in zip(texts, pairs)]
            out = []
            for data, (first, last, _), between, (own, after) in zip(texts, seams, many_kinds([x[2] for x in seams]), pairs):
                kind = np.concatenate([own[4][:first], between, after[4][:last]])
                chain = chain_of(data, kind, rarity)
                out.append((own[0], len(own[1]), hashlib.sha256(data).hexdigest(), encode(own[3]), encode(chain), likeness(own[3], chain), likeness(own[3], after[3])))
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], SCHEMA)

    return in_order(docs).select("doc_id", "text", "part", "guest").mapInArrow(run, schema)


SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
