"""op11 to op13 against brute force, and their edge cases."""

import hashlib
import random
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.llm import merkle, queries, superkmer, whitening
from tests.conftest import SF0001

CLASH = ["grp", "pos", "hash", "height", "_part", "_row", "path", "mini", "doc", "tid", "text_", "words", "lo", "asked", "spans", "kept", "c", "part", "n"]
LONG = " ".join(f"mot{i % 997}" for i in range(30_000))
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def rows(df):
    return [r.asDict() for r in df.collect()]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# --- op11
def manifest_by_hand(docs):
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of each row, by plain lists."""
    def leaf(r, text):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][i:i + 16])) for i in range(0, len(out[-1]), 16)])
        return out

    def sides(tree, i):
        for line in tree[:-1]:
            run = i - i % 16
            yield "".join(line[run:i]), "".join(line[i + 1:run + 16])
            i //= 16
    lower = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    groups = defaultdict(list)
    for r in docs:
        own = leaf(r, r["text"])
        bad = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        groups[r["source"]].append(((r["doc_id"] is not None, r["doc_id"] or 0, own), r["doc_id"], own, leaf(r, r["text"] and r["text"].translate(lower)) if bad else own))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(groups[s], key=lambda x: x[0])]) for s in order}
    top = levels([trees[s][-1][0] for s in order])
    out = []
    for place, s in enumerate(order):
        for i, (_, doc_id, own, start) in enumerate(sorted(groups[s], key=lambda x: x[0])):
            path = [*sides(trees[s], i), *sides(top, place)]
            node = start
            for a, b in path:
                node = sha(a + node + b)
            out.append((doc_id, own, trees[s][-1][0], top[-1][0], sha("".join(a + b for a, b in path)), node, node == top[-1][0]))
    return out


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 16, "b": 17, None: 1, "": 3}, {"a": 257, "é": 256, "z": 2}, {f"s{i}": 1 + i % 3 for i in range(40)} | {"hot": 700}])
def test_merkle_is_the_plain_tree(spark, tmp_path, sizes):
    rng, docs = random.Random(4), []
    for s, n in sizes.items():
        for _ in range(n):
            i = len(docs)
            docs.append((i * 7 % 3001, rng.choice([None, "", "Ab É", "no capitals", f"Text {i}"]), rng.choice([None, "en"]), s, rng.choice([None, i])))
    docs += [docs[0], docs[0], (None, "no id", "en", docs[0][3], 5), (None, None, None, docs[0][3], None)]
    frame = spark.createDataFrame(docs, SCHEMA).select("*", *[F.lit("own").alias(c) for c in CLASH])
    frame.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, queries.op11_merkle(spark, str(tmp_path)).collect()), key=str)
    want = manifest_by_hand([dict(zip(("doc_id", "text", "lang", "source", "n_chars"), d)) for d in docs])
    assert got == sorted(want, key=str)


def test_merkle_stores_every_second_level_only(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).alias("n_chars"))
    m = merkle.build(docs)
    assert [n.count() for n in m.sources.levels] == [5000, 20, 1]  # heights 0, 2, 4
    proofs = merkle.proofs(m).select("doc_id", F.size("path").alias("n"), merkle.fold(F.col("leaf"), F.col("path")).alias("root"))
    assert {(r["n"], r["root"]) for r in rows(proofs)} == {(4, m.root)}


def test_merkle_empty(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op11_merkle(spark, str(tmp_path)).collect() == []


# --- op12
def covariance(x):
    n, s = len(x), x.sum(axis=0)
    c = (n * x - s) / n
    return c, c.T @ c / n


@pytest.mark.parametrize("kind", ["plain", "equal values", "falling", "few rows", "constant and equal dimensions"])
def test_directions_are_eigenvectors(kind):
    rng = np.random.default_rng(1)
    a = rng.standard_normal((90, 24))
    if kind == "equal values":
        a = np.linalg.qr(a)[0]
    elif kind == "falling":
        a = a * np.logspace(0, -7, 24)
    elif kind == "few rows":
        a = a[:6]
    elif kind.startswith("constant"):
        a[:, 3], a[:, 5] = 0, a[:, 6]
    r = np.linalg.qr(a, mode="r")
    lam, v = whitening.directions(np.vstack([r, np.zeros((24 - len(r), 24))]), 24)
    exact = np.linalg.svd(a, compute_uv=False) ** 2
    assert len(lam) == (exact > 1e-20 * exact[0]).sum()
    assert np.allclose(lam, exact[:len(lam)], rtol=1e-12) and np.abs(v.T @ v - np.eye(len(lam))).max() < 1e-12
    assert np.abs(a.T @ (a @ v) - v * lam).max() < 1e-12 * lam[0]


def test_bidiagonal_and_dqds():
    r = np.triu(np.random.default_rng(2).standard_normal((12, 12)))
    a, b, w = whitening.bidiagonalise(r)
    m = np.diag(a) + np.diag(b, 1)
    assert np.abs(w.T @ w - np.eye(12)).max() < 1e-14 and np.allclose(m.T @ m, w.T @ r.T @ r @ w)
    tiny = np.logspace(0, -30, 12)  # each value to high relative accuracy, the least too
    assert np.allclose(whitening.dqds(tiny, np.zeros(11)), tiny ** 2, rtol=1e-13, atol=0)
    assert (whitening.dqds(np.zeros(3), np.zeros(2)) == 0).all()


def test_whitening_is_numpy(spark):
    got = queries.op12_whitening(spark, SF0001).toPandas().sort_values(["vec_id", "component"])
    t = spark.read.parquet(f"{SF0001}/embeddings.parquet").orderBy("vec_id").toPandas()
    x = np.floor(64 * np.array(t["embedding"].tolist(), float)).astype(np.int64) + 1_000_000
    c, v = covariance(x)
    e, u = np.linalg.eigh(v)
    e, u, n = e[::-1], u[:, ::-1], len(x)
    own, want = got["whitened"].to_numpy().reshape(n, 32), c @ u[:, :32] / np.sqrt(e[:32])
    assert np.abs(own * np.sign((own * want).sum(axis=0)) - want).max() < 1e-9
    assert (got["deviation"].to_numpy().reshape(n, 32) == ((n * x - x.sum(axis=0)) ** 2).sum(axis=1)[:, None]).all()
    assert np.allclose(got["explained"].to_numpy()[:32], e[:32] / np.trace(v), rtol=1e-9)
    seen = np.abs(own.T @ own / n - np.eye(32)).max()
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-10 and seen < 1e-10


def test_whitening_edges(spark, tmp_path):
    def run(data, name):
        schema = "vec_id bigint, embedding array<float>, whitened string, n string, c string"
        spark.createDataFrame([(i, v, "own", "own", "own") for i, v in data], schema).write.parquet(f"{tmp_path}/{name}/embeddings.parquet")
        return queries.op12_whitening(spark, f"{tmp_path}/{name}").toPandas()
    inf, nan = float("inf"), float("nan")
    good = [[1.0, 2.0, 5.0], [2.0, 1.0, 5.0], [3.5, -1.0, 5.0], [3.5, -1.0, 5.0], [0.0, 1e30, 5.0]]
    data = [(None, good[0]), (7, good[1]), (8, good[2]), (8, good[3]), (1, None), (2, [1.0, None, 2.0]), (3, [nan, 1.0, 1.0]), (4, [inf, 1.0, 1.0]), (5, []), (6, [1.0, 2.0])]
    got = run(data, "some")
    assert sorted(got["vec_id"].fillna(-1)) == [-1, -1, 7, 7, 8, 8, 8, 8] and set(got["n"]) == {4}  # the constant dimension has no direction
    x = np.floor(64 * np.array(good[:4])).astype(np.int64) + 1_000_000
    assert set(got["deviation"]) == set(((4 * x - x.sum(axis=0)) ** 2).sum(axis=1))
    huge = run([(1, good[0]), (2, good[4])], "huge")
    assert len(huge) == 2 and huge["deviation"].isna().all() and np.isfinite(huge["whitened"]).all()
    assert len(run([(1, good[0])], "one")) == 0 and len(run([(1, good[0]), (2, good[0])], "equal")) == 0 and len(run([], "none")) == 0


# --- op13
def substrings_by_hand(docs, window=50):
    first = {}
    words = [(i, (t or "").encode().split()) for i, t in docs]
    for i, w in words:
        for j in range(len(w) - window + 1) if i is not None else ():
            key = tuple(w[j:j + window])
            first[key] = min(first.get(key, i), i)
    out = Counter()
    for i, w in words:
        gone = set()
        for j in range(len(w) - window + 1) if i is not None else ():
            if first[tuple(w[j:j + window])] < i:
                gone.update(range(j, j + window))
        out[i, len(w), len(gone), b" ".join(x for p, x in enumerate(w) if p not in gone).decode()] += 1
    return out


def some_documents():
    rng = random.Random(9)

    def prose(n, of=3000):
        return [f"w{rng.randrange(of)}" for _ in range(n)]
    passage, docs = prose(61), []
    for i in range(120):
        w = prose(rng.randrange(0, 160), rng.choice([3, 3000]))
        if i % 3 == 0:  # the passage in words of its own
            w[len(w) // 2:len(w) // 2] = passage[rng.randrange(4):61 - rng.randrange(8)]
        if i % 5 == 0 and i:
            w += docs[rng.randrange(i)][1].split()[rng.randrange(20):]
        docs.append((i * 37 % 121 - 20, rng.choice([" ", "\n", "\t "]).join(w)))
    edge = [(None, docs[3][1]), (None, " ".join(passage)), (900, None), (901, ""), (902, " \t\n"), (903, LONG), (904, LONG + " end"), (905, "same " * 400),
            (906, "same " * 500), (907, " ".join(passage)), (907, " ".join(passage)), (907, " ".join(passage[:55]) + " é x y"), (908, " ".join(passage[:49]))]
    return docs + edge


@pytest.mark.parametrize("hot", [superkmer.HOT, 3])
def test_substrings_are_brute_force(spark, hot):
    docs = some_documents()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").select("*", *[F.lit("own").alias(c) for c in CLASH])
    got = superkmer.dedup_substrings(frame.repartition(5), hot)
    want = substrings_by_hand(docs)
    seen = Counter()
    for r in rows(got):
        seen[r["doc_id"], r["n_words"], r["n_removed"], r["text"]] += 1
        assert sum(x["last"] - x["first"] + 1 for x in r["removed"]) == r["n_removed"]
    assert seen == want and sum(k[2] > 0 for k in want) > 30


def test_super_kmers_cover_each_window_once():
    rng = random.Random(2)
    for words in ([f"w{rng.randrange(9)}".encode() for _ in range(700)], [b"same"] * 900, [b"a", b"b"] * 200, [b"x"] * 49, [b"x"] * 50):
        at, n, mini = superkmer.super_kmers(superkmer.Words().hashes(words))
        assert [j for a, c in zip(at, n) for j in range(a, a + c)] == list(range(max(0, len(words) - 49))) and (n <= superkmer.PIECE).all()
        own = {}
        for a, c, m in zip(at, n, mini):  # the minimiser depends on the window's words alone
            for j in range(a, a + c):
                assert own.setdefault(tuple(words[j:j + 50]), m) == m


def test_window_ranks_are_exact():
    rng = random.Random(6)
    packed = [b" ".join(rng.choice([b"a", b"b"]) for _ in range(rng.randrange(50, 90))) for _ in range(40)] + [b" ".join([b"a"] * 70)] * 2
    rank, firsts = superkmer.window_ranks(packed)
    seen = {}
    for p, at in zip(packed, firsts):
        w = p.split(b" ")
        for j in range(len(w) - 49):
            assert seen.setdefault(tuple(w[j:j + 50]), rank[at + j]) == rank[at + j]
    assert len(set(seen.values())) == len(seen)


def test_substrings_empty(spark):
    assert superkmer.dedup_substrings(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


# --- op10, a batch at a time
def test_kinds_of_a_batch_are_those_of_each_text():
    from riskspark.llm import fingerprint as f
    rng = random.Random(8)
    texts = ["".join(rng.choice("ab cdé\n") for _ in range(rng.choice([0, 1, 30, 63, 64, 65, 400]))).encode() for _ in range(60)] + [b"x" * 40_000, b"ab" * 700_000, b"end"]
    for data, kind in zip(texts, f.many_kinds(texts)):
        assert (kind == np.concatenate([f.NONE, *f.kinds(data)])).all()
    assert f.many_kinds([]) == [] and [len(k) for k in f.many_kinds([b"", b""])] == [0, 0]


def test_bloom_bits_and_likeness_by_hand():
    from riskspark.llm import fingerprint as f
    rarity = np.arange(f.CLASSES + 1)[::-1].copy()
    rng = random.Random(4)
    text = " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(900))
    other = text[:len(text) // 2] + " ".join("".join(rng.choice("klmnopqrst") for _ in range(5)) for _ in range(400))
    chains = []
    for t in (text, other):
        data = t.encode()
        kind = np.concatenate(list(f.kinds(data)))
        seen, filters = set(), []
        for i in f.select(kind, rarity).tolist():
            h = int(f.hashes(np.frombuffer(data[i:i + 64], np.uint8).reshape(1, -1))[0])
            if h in seen:
                continue
            seen.add(h)
            if not filters or filters[-1][0] == f.CAPACITY:
                filters.append([0, set()])
            filters[-1][0] += 1
            filters[-1][1].update(h >> 11 * k & 2047 for k in range(5))
        chain = f.digest(t, rarity)
        assert [(int.from_bytes(row[:2].tobytes(), "big"), set(np.flatnonzero(np.unpackbits(row[2:])).tolist())) for row in chain] == [tuple(x) for x in filters]
        chains.append((chain, filters))
    (a, fa), (b, fb) = sorted(chains, key=lambda c: (len(c[1]), c[0].tobytes()))

    def score(x, y):
        chance, most = len(x) * len(y) / 2048, min(len(x), len(y))
        return min(max((len(x & y) - chance) / max(most - chance, 1e-6), 0), 1)
    want = sum(n * max(score(x, y) for _, y in fb) for n, x in fa) / sum(n for n, _ in fa)
    assert abs(f.likeness(a, b) - want) < 1e-5 and 0.2 < want < 0.95
