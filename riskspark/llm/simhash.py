"""SimHash near-duplicates by Golay-code fuzzy hashing.

A document's 64-bit fingerprint has a bit set where over half of its word
shingles' hashes have it. Two fingerprints link when they differ in at most
three bits. Finding the links:

* A fingerprint is cut into three segments of 22, 21 and 21 bits. Three errors
  over three segments leave either a segment without error beside one with at
  most one error, or exactly one error in each (pigeonhole).
* A segment with at most one error is found through the perfect (23, 12)
  Golay code: every 23-bit word lies within distance three of one codeword.
  If two words differ in one bit, the nearest codeword of the one is the
  nearest of the other, or one of the five codewords at distance four from
  it. So a word has one index (12 bits) when it lies within two bits of its
  codeword, and six otherwise.
* A key joins the index of one segment with the exact bits of another (34
  bits); for one error in each segment, with an exact half of each of the two
  others. One side of the join carries only the nearest codeword, the other
  side all indices; every candidate is verified by its bit distance inside
  the join. No link is lost and no partner count is capped.

Copies collapse first: only distinct fingerprints are joined. Components come
from alternating large-star / small-star rounds over the links, each cut to
the shared folder.

Nulls and empty texts have fingerprint zero, linked like any other. Rows with
a null id get a fingerprint, and a null component unless a document with an id
shares it. Repeated rows stay; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import cut

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
BLOCK = 1 << 15  # shingles whose bits are counted at a time
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # (first bit, bits)
#: Generator polynomial x^11+x^10+x^6+x^5+x^4+x^2+1 of the binary Golay code.
GOLAY_POLY = 0b110001110101


def text_fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """Majority bits over the XXH64 hashes of the word shingles, in blocks."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six ASCII blanks only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        end = min(n, at + BLOCK)
        if shingle == 3 and len(words) >= 3:
            parts = zip(words[at:end], words[at + 1:end + 1], words[at + 2:end + 2])
            hashes = np.fromiter((digest(b"%b %b %b" % p, 42) for p in parts), np.uint64, end - at)
        else:
            hashes = np.fromiter((digest(b" ".join(words[i:i + shingle]), SEED) for i in range(at, end)), np.uint64, end - at)
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((text_fingerprint(t.as_py(), shingle) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])
    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long), one row per input row."""
    d = docs.select(F.col("doc_id").cast("bigint"), F.col("text"))
    return d.mapInArrow(_fingerprints(shingle), "doc_id bigint, fp bigint")


@cache
def _golay() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome (11 bits): up to six error patterns that lead to a key, and how many there are."""
    def syndrome(x: int) -> int:
        for i in range(22, 10, -1):
            if x >> i & 1:
                x ^= GOLAY_POLY << (i - 11)
        return x

    unit = [syndrome(1 << i) for i in range(23)]
    patterns, counts = np.zeros((2048, 6), np.int64), np.zeros(2048, np.int64)
    weight = np.zeros(2048, np.int64)
    for w in range(5):
        for at in combinations(range(23), w):
            s = 0
            for i in at:
                s ^= unit[i]
            if w <= 3 or weight[s] == 3:
                patterns[s, counts[s]] = sum(1 << i for i in at)
                counts[s] += 1
                weight[s] = max(weight[s], w) if w <= 3 else 3
    return patterns, counts


@cache
def _syndromes() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and the high 11 bits of a 23-bit word."""
    def table(shift: int, bits: int) -> np.ndarray:
        x = np.arange(1 << bits, dtype=np.int64) << shift
        for i in range(22, 10, -1):
            x = np.where(x >> i & 1, x ^ (GOLAY_POLY << (i - 11)), x)
        return x
    return table(0, 12), table(12, 11)


def golay_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codeword indices (n, 6) of 23-bit words, the nearest first, and how many of them count."""
    low, high = _syndromes()
    patterns, counts = _golay()
    s = low[words & 0xFFF] ^ high[words >> 12]
    return (words[:, None] ^ patterns[s]) >> 11, counts[s]


def link_keys(fp: np.ndarray, every: bool) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) pairs; ``every``: all Golay indices, else the nearest only."""
    u = fp.view(np.uint64)
    seg = [((u >> np.uint64(a)) & np.uint64((1 << n) - 1)).astype(np.int64) for a, n in SEGMENTS]
    golay = [golay_keys(s) for s in seg]
    halves = [(s & 0x7FF, s >> 11) for s in seg]
    rows, keys = [], []

    def add(kind: int, exact: np.ndarray, j: int) -> None:
        index, n = golay[j]
        for k in range(6 if every else 1):
            use = np.flatnonzero(n > k)
            rows.append(use)
            keys.append((np.int64(kind) << 36) | (exact[use] << 12) | index[use, k])

    for i in range(3):
        for j in range(3):
            if i != j:
                add(3 * i + j, seg[i], j)
    for x in range(2):
        for y in range(2):
            add(10 + 2 * x + y, (halves[0][x] << 11) | halves[2][y], 1)
    return np.concatenate(rows), np.concatenate(keys)


def _keyed(every: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                fp = part.column(1).to_numpy(zero_copy_only=False)
                rows, keys = link_keys(fp, every)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(fp[rows]), part.column(0).take(pa.array(rows))], names=["key", "fp", "rep"])
    return run


def links(reps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) between representatives of distinct fingerprints, a < b, each once.

    ``reps``: rep (document id), fp. ``max_bits`` may be 0 to 3, what the keys guarantee.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError("the keys guarantee links of up to three bits")
    schema = "key bigint, fp bigint, rep bigint"
    r = reps.select("rep", "fp")
    probe = r.mapInArrow(_keyed(True), schema).alias("p")
    index = r.mapInArrow(_keyed(False), schema).alias("i")
    near = (F.col("p.key") == F.col("i.key")) & (F.col("p.fp") < F.col("i.fp")) & (
        F.bit_count(F.col("p.fp").bitwiseXOR(F.col("i.fp"))) <= max_bits)
    pairs = probe.join(index, near)
    return pairs.select(F.least("p.rep", "i.rep").alias("a"), F.greatest("p.rep", "i.rep").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) for the nodes of ``edges`` (a, b).

    Alternating stars: in a large star every greater neighbour of a node moves
    to the node's smallest neighbour; in a small star, every smaller one. Ends
    when the links are a forest of stars, after about log(nodes) rounds. The
    smallest neighbour is an aggregate, so a hub's links never meet in one task.
    """
    e = cut(edges.select("a", "b"))
    before = None
    while True:
        both = e.union(e.select("b", "a")).toDF("u", "v")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a < b").distinct()
        small_min = large.groupBy("b").agg(F.min("a").alias("m"))
        e = cut(large.join(small_min, "b").select(
            F.col("m").alias("x"), F.explode(F.array("a", "b")).alias("y")).where("x < y").distinct().toDF("a", "b"))
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if (now["n"], now["s"]) == before:
            return e.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component"))
        before = (now["n"], now["s"])


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp, component_id: one row per row of ``docs``."""
    fps = cut(fingerprints(docs, shingle))
    reps = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")).where("rep is not null"))
    comp = components(links(reps, max_bits)).withColumnRenamed("node", "rep")
    of = reps.join(comp, "rep", "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return fps.join(of, "fp", "left").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its group (rows without an id stay)."""
    dropped = near_duplicates(docs.select("doc_id", "text"), shingle, max_bits).where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
