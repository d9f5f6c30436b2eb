"""Byte-level BPE by monoid tree reduction.

Encoding one pre-token (a match of the split pattern): its halves are encoded
recursively and joined. A token list is the encoding of its bytes if every two
neighbours are the encoding of their own bytes: merges inside two tokens run
in the same order with or without what surrounds them, so a merge that crossed
a boundary in the whole would cross it in the pair too. Joining therefore
checks the two tokens at the seam; if they would merge otherwise, a window of
tokens around the seam, growing on both sides, is encoded anew until both of
its edges pass that check: the tokens outside are then proven to stay.

Pre-tokens are independent, so a document's encoding is their concatenation,
and decoding concatenates token bytes up a tree. Frequent pre-tokens are
remembered per task, up to a fixed number.

Null and empty texts have no tokens. Texts of any length are encoded whole.
Repeated rows are encoded alike; an empty table gives an empty one; all
columns of the input stay, except that ``ids`` or ``decoded`` replaces an own
column of that name.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEAF_BYTES = 24       # below, merges run directly
REMEMBER = 300_000    # pre-tokens and seams remembered per task
REMEMBER_CHARS = 40   # longer pre-tokens are not
NEVER = 1 << 62       # the rank of two parts that do not merge
BATCH_TOKENS = 1 << 20  # a result batch is sent when it holds so many tokens


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its id a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(i) for token, i in map(bytes.split, f)}


class Pieces(dict):
    """The ids of short pre-tokens, in two generations: one that was not asked for
    while ``REMEMBER / 2`` others came up is forgotten, so frequent ones stay."""

    def __init__(self, encode: Callable[[str], tuple[int, ...]]):
        super().__init__()
        self.encode, self.older = encode, {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.older.get(piece) or self.encode(piece)
        if len(piece) <= REMEMBER_CHARS:
            if len(self) >= REMEMBER // 2:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class TreeBPE:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.pieces = Pieces(self.encode_piece)
        self.seams: dict[tuple[int, int], bool] = {}

    def merge(self, data: bytes) -> list[int]:
        """The merges by rank, lowest first, leftmost of equals."""
        if len(data) > 4 * LEAF_BYTES:
            return self.merge_long(data)
        ranks, rank = self.ranks, self.ranks.get
        parts = [data[i:i + 1] for i in range(len(data))]
        pairs = [rank(data[i:i + 2], NEVER) for i in range(len(data) - 1)]  # of each part and the next one
        while pairs:
            best = min(pairs)
            if best == NEVER:
                break
            i = pairs.index(best)
            parts[i] += parts.pop(i + 1)
            del pairs[i]
            if i:
                pairs[i - 1] = rank(parts[i - 1] + parts[i], NEVER)
            if i < len(pairs):
                pairs[i] = rank(parts[i] + parts[i + 1], NEVER)
        return [ranks[p] for p in parts]

    def merge_long(self, data: bytes) -> list[int]:
        """The same merges from a heap of pairs, for bytes of any length."""
        ranks, n = self.ranks, len(data)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # part i is data[i:end[i]]; -1: merged away
        heap = []

        def offer(i: int) -> None:
            j = end[i]
            if j < n:
                r = ranks.get(data[i:end[j]])
                if r is not None:
                    heapq.heappush(heap, (r, i, j, end[j]))
        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, j, stop = heapq.heappop(heap)
            if end[i] != j or end[j] != stop:
                continue  # one of the two has changed since
            end[i], end[j] = stop, -1
            if stop < n:
                before[stop] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i:end[i]]])
            i = end[i]
        return out

    def stable(self, a: int, b: int) -> bool:
        """Whether the two tokens are the encoding of their own bytes."""
        known = self.seams.get((a, b))
        if known is None:
            known = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
            if len(self.seams) >= REMEMBER:
                self.seams.clear()
            self.seams[a, b] = known
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        if not left or not right:
            return left + right
        if self.stable(left[-1], right[0]):
            return left + right
        reach = 1
        while True:
            i, j = max(0, len(left) - reach), min(len(right), reach)
            data = b"".join([self.bytes_of[t] for t in left[i:]] + [self.bytes_of[t] for t in right[:j]])
            window = self.merge(data)  # as large as the whole, it has nothing outside that could differ
            if (i == 0 or self.stable(left[i - 1], window[0])) and (j == len(right) or self.stable(window[-1], right[j])):
                return left[:i] + window + right[j:]
            reach *= 2

    def encode_bytes(self, data: bytes) -> list[int]:
        if len(data) <= LEAF_BYTES:
            return self.merge(data)
        half = len(data) // 2
        return self.join(self.encode_bytes(data[:half]), self.encode_bytes(data[half:]))

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        data = piece.encode("utf-8", "surrogatepass")
        whole = self.ranks.get(data)
        return (whole,) if whole is not None else tuple(self.encode_bytes(data))

    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(map(self.pieces.__getitem__, self.split(text or ""))))

    def decode(self, ids) -> bytes:
        """Concatenates up a tree of fixed fan-out."""
        level = list(map(self.bytes_of.__getitem__, ids))
        while len(level) > 1:
            level = [b"".join(level[i:i + 512]) for i in range(0, len(level), 512)]
        return level[0] if level else b""


_CODECS: dict[str, TreeBPE] = {}


def _codec(shared, pattern: str) -> TreeBPE:
    """One codec per worker process and vocabulary (the last one used)."""
    key = f"{shared.value[0]}|{pattern}"
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = TreeBPE(shared.value[1], pattern)
    return _CODECS[key]


def _share(spark: SparkSession, path: str):
    """The vocabulary (a file of fixed size) sent to the executors once."""
    return spark.sparkContext.broadcast((path, read_ranks(path)))


def _encoded(codec: TreeBPE, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches with the ids of their first column's texts in its place, as the last column."""
    for b in batches:
        at, flat, offsets = 0, [], [0]
        for k in range(b.num_rows):
            flat.extend(codec.encode(b.column(0)[k].as_py()))
            offsets.append(len(flat))
            if len(flat) >= BATCH_TOKENS or k + 1 == b.num_rows:
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
                part = b.slice(at, k + 1 - at)
                yield pa.RecordBatch.from_arrays([*part.columns[1:], ids], names=[*b.schema.names[1:], "ids"])
                at, flat, offsets = k + 1, [], [0]


def _decoded(codec: TreeBPE, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches with the bytes of their ``ids`` as the last column."""
    for b in batches:
        for start in range(0, b.num_rows, 1024):
            part = b.slice(start, 1024)
            ids = part.column("ids")
            out = [codec.decode(ids[k].values.to_numpy().tolist() if ids[k].is_valid else ()) for k in range(part.num_rows)]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], names=[*b.schema.names, "decoded"])


IDS = T.StructField("ids", T.ArrayType(T.IntegerType(), False))
DECODED = T.StructField("decoded", T.BinaryType())


def encode(docs: DataFrame, ranks_path: str, pattern: str, column: str = "text") -> DataFrame:
    """The rows of ``docs`` without ``column``, with ``ids`` (array of int)."""
    shared = _share(docs.sparkSession, ranks_path)
    rest = [c for c in docs.columns if c not in (column, "ids")]
    schema = T.StructType([*[docs.schema[c] for c in rest], IDS])
    return docs.select(column, *rest).mapInArrow(lambda batches: _encoded(_codec(shared, pattern), batches), schema)


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """The rows of ``encoded`` with ``decoded`` (the bytes of ``ids``; none for null ids)."""
    shared = _share(encoded.sparkSession, ranks_path)
    names = [c for c in encoded.columns if c != "decoded"]
    schema = T.StructType([*[encoded.schema[c] for c in names], DECODED])
    return encoded.select(*names).mapInArrow(lambda batches: _decoded(_codec(shared, pattern), batches), schema)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, column: str = "text") -> DataFrame:
    """``decode(encode(docs))`` in one Python worker a task, with one copy of the
    vocabulary and without a second transfer of the ids."""
    shared = _share(docs.sparkSession, ranks_path)
    rest = [c for c in docs.columns if c not in (column, "ids", "decoded")]
    schema = T.StructType([*[docs.schema[c] for c in rest], IDS, DECODED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared, pattern)
        return _decoded(codec, _encoded(codec, batches))
    return docs.select(column, *rest).mapInArrow(run, schema)


def digests(encoded: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns, n_tokens, and SHA-256 of the comma-joined ids and of the decoded bytes."""
    return encoded.select(
        *keep, F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
