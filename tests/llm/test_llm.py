"""The corpus operators against brute-force versions, round trips and edge cases."""

import base64
import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from riskspark.llm import bpe, exact_dedup, fingerprint, langid, license_scan, line_dedup, mixing, queries, simhash, toxicity, url_filter
from tests.conftest import SF0001

#: Columns of the same names as those the operators add or use inside.
CLASH = ["ids", "decoded", "deleted", "score", "fp", "rep", "key", "part", "guest", "n_words", "p", "rate", "copies", "t", "_id", "line", "predicted", "label", "first"]
LONG = " ".join(f"mot{i % 997}" for i in range(30_000))
EDGE = [(None, "text without an id but with some words in it"), (900, None), (901, ""), (902, " \t\n"), (903, LONG), (904, "same text here twice"),
        (904, "same text here twice"), (905, "same text here\ttwice "), (906, "é" * 300), (907, "\n\n\n"), (908, "x" * 5000 + " " * 3000), (909, "!!! 123")]


@pytest.fixture(scope="module")
def docs(spark):
    real = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text", "lang", "source", F.col("n_chars").cast("bigint").alias("n_chars"))
    edge = spark.createDataFrame(EDGE, "doc_id bigint, text string").select("doc_id", "text", F.lit(None).cast("string").alias("lang"), F.lit("src0").alias("source"), F.length("text").cast("bigint").alias("n_chars"))
    return real.unionByName(edge).select("*", *[F.lit("own").alias(c) for c in CLASH]).cache()


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.read.parquet(f"{SF0001}/labels.parquet")


def rows(df):
    return [r.asDict() for r in df.collect()]


# --- op1
def test_url_model_against_brute_force(spark):
    rng = random.Random(3)
    urls = [f"http://{rng.choice(['', 'www.', 'm.'])}{rng.choice(['aa', 'bbc', 'dd'])}.example.{rng.choice(['com', 'net', 'org'])}/{rng.choice(['en', 'fr', 'es'])}/{rng.randrange(30)}?q" for _ in range(250)]
    urls += [None, "", "no scheme", "://", "HTTP://WWW.Example.COM/en/x#y", "http://example.com", urls[0]]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").withColumn("score", F.lit("own"))
    got = {r["page_id"]: r for r in rows(url_filter.filter_urls(pages, queries.URL_RULES))}
    assert len(got) == len(urls)

    def parse(u):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        tail = rest[cut:]
        end = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
        return rest[:cut].lower(), tail[:end]

    def rule(h, p):
        fit = [(a + b, v) for a, b, v in queries.URL_RULES if (h == a or h.endswith("." + a)) and p.startswith(b)]
        return max(fit, key=lambda x: len(x[0]), default=(None, None))

    strings = {}
    for u in urls:
        h, p = parse(u)
        strings[h + p] = rule(h, p)[1]
    import zlib
    learn = {s: zlib.crc32(s.encode()) % 5 != 0 for s in strings}
    count = {v: defaultdict(Counter) for v in ("allow", "block")}
    known = defaultdict(set)  # contexts and characters of all strings: those the models give chances to
    grams = {}
    for s, v in strings.items():
        pad = url_filter.PAD * 4 + s
        grams[s] = [pad[i:i + 5] for i in range(len(s))]
        for g in grams[s] if v and learn[s] else []:
            for k in range(5):
                count[v][g[4 - k:4]][g[4]] += 1

    def chance(v, g, k):
        low = 1 / 256 if k == 0 else chance(v, g, k - 1)
        c = g[4 - k:4]
        if sum(sum(count[x][c].values()) for x in count) < url_filter.LEAST:
            return low
        return (count[v][c][g[4]] + url_filter.SMOOTH * low) / (sum(count[v][c].values()) + url_filter.SMOOTH)

    score = {s: round(sum(math.log(chance("allow", g, 4) / chance("block", g, 4)) for g in gs) / len(gs), 6) if gs else 0.0 for s, gs in grams.items()}
    for i, u in enumerate(urls):
        h, p = parse(u)
        name, verdict = rule(h, p)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (h, p, name)
        assert abs(got[i]["score"] - score[h + p]) < 2e-6
        assert got[i]["verdict"] == (verdict or ("allow" if got[i]["score"] >= got[i]["cutoff"] else "block"))
    held = [(score[s], v) for s, v in strings.items() if v and s and not learn[s]]
    allow, block = [x for x, v in held if v == "allow"], [x for x, v in held if v == "block"]

    def accuracy(at):
        return sum(x >= at - 1e-9 for x in allow) / len(allow) + sum(x < at - 1e-9 for x in block) / len(block)
    assert all(accuracy(got[0]["cutoff"]) >= accuracy(math.floor(x / 0.01) * 0.01) - 1e-6 for x, _ in held)


# --- op2
def test_mixing_meets_targets_and_numpy(spark, docs, labelled):
    labels = queries.domain_labels(spark, SF0001)
    got = rows(mixing.mix(docs, labels, queries.DOMAIN_TARGETS))
    assert len(got) == docs.count()
    p, n = np.array([r["p"] for r in got]), np.array([r["n_words"] for r in got], float)
    assert np.allclose(p.sum(axis=1), 1) and (p >= 0).all()
    target = np.array(list(queries.DOMAIN_TARGETS.values())) * n.sum()
    r, share = np.ones(len(n)), (p * n[:, None]).sum(axis=0) / n.sum()
    for _ in range(mixing.ROUNDS):
        e = ((p * (n * r)[:, None]).sum(axis=0) - target) / n.sum()
        if np.abs(e).max() < mixing.TOLERANCE:
            break
        r = np.maximum(0, r - p @ (e / share))
    assert np.allclose(r, [x["rate"] for x in got], atol=1e-6)
    assert np.abs((p * (n * r)[:, None]).sum(axis=0) - target).max() < 1e-3 * n.sum()
    assert all(abs(x["copies"] - x["rate"]) < 1 for x in got)
    kept = mixing.realise(docs, labels, queries.DOMAIN_TARGETS, least=1.0, keep_all=True)
    assert kept.columns == docs.columns and {(r["doc_id"], r["text"]) for r in rows(kept)} == {(r["doc_id"], r["text"]) for r in rows(docs)}


# --- op3
def test_bpe_is_tiktoken_and_round_trips(docs):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(queries.RANKS, "rb"))}
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = bpe.decode(bpe.encode(docs, queries.RANKS, queries.PATTERN), queries.RANKS, queries.PATTERN)
    assert [c for c in docs.columns if c not in ("text", "ids", "decoded")] == [c for c in out.columns if c not in ("ids", "decoded")]
    text = Counter((r["doc_id"], r["text"] or "") for r in rows(docs.select("doc_id", "text")))
    seen = Counter()
    for r in rows(out):
        own = bytes(r["decoded"]).decode()
        seen[r["doc_id"], own] += 1
        assert r["ids"] == other.encode_ordinary(own)
    assert seen == text
    both = bpe.round_trip(docs, queries.RANKS, queries.PATTERN)
    assert both.columns == out.columns
    key = lambda df: Counter((r["doc_id"], tuple(r["ids"]), bytes(r["decoded"])) for r in rows(df))
    assert key(both) == key(out)


def test_bpe_seams_grow_until_stable():
    ranks = bpe.read_ranks(queries.RANKS)
    codec, rng = bpe.TreeBPE(ranks, queries.PATTERN), random.Random(5)
    for alphabet in ("a", "ab", "aé", "the", " \n", "abcdefgh", "0123456789"):
        for n in (1, 25, 60, 211, 700):
            data = "".join(rng.choice(alphabet) for _ in range(n)).encode()
            direct = [data[i:i + 1] for i in range(len(data))]
            while pairs := [(ranks[a + b], i) for i, (a, b) in enumerate(zip(direct, direct[1:])) if a + b in ranks]:
                i = min(pairs)[1]
                direct[i:i + 2] = [direct[i] + direct[i + 1]]
            assert codec.encode_bytes(data) == codec.merge(data) == [ranks[x] for x in direct]
            assert codec.decode(codec.encode_bytes(data)) == data


# --- op4
def test_gru_gradients():
    net, rng = langid.GRU.fresh(3, 4), np.random.default_rng(1)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    x, y, w = rng.integers(97, 100, (5, 4)).astype(np.uint8), rng.integers(0, 3, 5), np.ones(5)
    _, g = net.gradients(x, y, w)
    for k in net.w:
        flat = net.w[k].ravel()
        for i in rng.choice(np.flatnonzero(np.abs(g[k]).ravel() > 1e-6), 3):
            old = flat[i]
            flat[i] = old + 1e-3
            up = net.gradients(x, y, w)[0]
            flat[i] = old - 1e-3
            down = net.gradients(x, y, w)[0]
            flat[i] = old
            assert abs((up - down) / 2e-3 - g[k].ravel()[i]) < 1e-3


def test_pieces_divide_no_character():
    rng = random.Random(2)
    for _ in range(300):
        run = "".join(rng.choice("aé日𝒜") for _ in range(rng.randint(0, 60)))
        parts = langid.pieces(run)
        assert "".join(p.decode() for p in parts) == run and all(0 < len(p) <= langid.SEGMENT for p in parts)
        assert all(len(a) + len(b.decode()[0].encode()) > langid.SEGMENT for a, b in zip(parts, parts[1:]))
    assert langid.pieces("\ud800" * 40)  # a lone surrogate has bytes as well


def test_rare_languages_keep_training_runs(spark, monkeypatch):
    monkeypatch.setattr(langid, "TRAIN_RUNS", 30)
    table = [(i, " ".join(f"common{chr(97 + j)}" for j in range(26)) + " " + "x" * (i % 40 + 1), "aa") for i in range(60)]
    table += [(1000 + i, " ".join("rare" + chr(97 + j) for j in range(10)), "bb") for i in range(3)] + [(2000, "only one", "cc"), (2001, "only one", "cc"), (2002, "only one", "cc")]
    runs = rows(langid.training_runs(spark.createDataFrame(table, "doc_id bigint, text string, lang string")))
    assert Counter(r["lang"] for r in runs) == {"aa": 18, "bb": 10, "cc": 2}
    assert all(r["run"].startswith("common") for r in runs if r["lang"] == "aa")


def test_language_id(spark, docs):
    languages, net = langid.fit(docs)
    got = {}
    for r in rows(langid.identify(docs, languages, net)):
        got.setdefault(r["doc_id"], r)
    for i in (900, 901, 902, 907, 909):
        assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
    real = rows(docs.where("lang is not null and crc32(cast(cast(doc_id as string) as binary)) % 5 = 0"))
    assert sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in real) >= 0.9 * len(real)
    labeller = langid.Labeller(net)
    text = "the thing and the thing"
    sums, counts = labeller.documents([text])
    want = sum(net.log_probs(np.frombuffer(w.encode(), np.uint8).reshape(1, -1))[0].sum(axis=0) for w in text.split())
    assert np.allclose(sums[0], want, atol=1e-3) and counts[0] == 19


# --- op5
def test_license_places(spark, docs):
    import re
    texts = [(5001, "All Rights Reserved. all rights reserved"), (5002, "licensed under the very apache license, version 2.0"), (5003, "CC-BY cc by-nc"),
             (5004, "GNU general public license; general public"), (5005, "licensed under apache the license"), (5006, "cc"), (5007, "cc " * 50 + "by"), (5008, None), (5008, None)]
    d = spark.createDataFrame(texts, "doc_id bigint, text string").unionByName(docs.select("doc_id", "text"))
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    up = {i: i + 32 for i in range(65, 91)}
    want = Counter()
    for r in rows(d):
        w, at, labels = word.findall((r["text"] or "").translate(up)), [], set()
        for phrase, label in license_scan.BASE:
            q = phrase.split()
            for i in range(len(w) - len(q) + 1):
                if w[i:i + len(q)] == q:
                    at.append(i)
                    labels.add(label)
        want[r["doc_id"], len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))] += 1
    out = rows(license_scan.scan(d))
    assert Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in out) == want
    labels = {r["doc_id"]: r["labels"] for r in out}
    assert "apache-2.0" in labels[5002] and labels[5005] == "" and all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) for r in out)


def test_license_notices_after_stray_hits(spark):
    texts = [("Creative Commons License: Creative Commons Attribution-ShareAlike", "cc-by-sa", 1.0), ("Creative Commons License: Creative Commons Attribution-NonCommercial", "cc-by-nc", 1.0),
             ("gnu lesser X gnu lesser general public license", "lgpl", 1.0), ("gnu lesser " * 40 + "gnu lesser general public license" + " gnu lesser" * 40, "lgpl", 1.0),
             ("licensed under x licensed under x licensed under the very apache license version 2 0", "apache-2.0", 6 / 7),
             ("creative commons attribution creative commons x x x attribution sharealike", "", 0.0), ("gnu lesser " * 40 + "public license", "", 0.0)]
    d = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(texts)], "doc_id bigint, text string")
    for r in rows(license_scan.scan(d)):
        _, label, score = texts[r["doc_id"]]
        own = set(filter(None, r["labels"].split(","))) - {"gpl"}
        assert own == {label} - {""} and r["score"] == pytest.approx(score), r
    templates = license_scan.template_grams(spark, license_scan.BASE, license_scan.TEMPLATES)
    found = rows(license_scan.spans(license_scan.diagonals(d, templates), templates).where("label = 'cc-by-sa'"))
    assert [(r["doc_id"], r["exact"], r["first"], r["last"]) for r in found] == [(0, True, 3, 6)]


# --- op6
def test_line_dedup_properties(spark, docs):
    rng = random.Random(2)
    shared = [" ".join(rng.choice("alpha beta gamma delta".split()) + str(rng.randrange(50)) for _ in range(rng.randrange(1, 40))) for _ in range(40)]
    made = []
    for i in range(120):
        at = rng.randrange(30)
        lines = [f"own {i} {k} " + "w " * rng.randrange(12) for k in range(rng.randrange(4))]
        lines[rng.randrange(len(lines) + 1):0] = shared[at:at + rng.randrange(1, 7)]
        made.append((2000 + i, "\n".join(lines)))
    d = docs.unionByName(spark.createDataFrame(made, "doc_id bigint, text string"), allowMissingColumns=True)
    texts = sorted({(r["doc_id"] is not None, r["doc_id"] or 0, r["text"]) for r in rows(d) if r["text"] is not None})
    out = {}
    for r in rows(line_dedup.dedup_lines(d)):
        out[r["doc_id"] is not None, r["doc_id"] or 0, r["n_chars"], r["text"]] = r
    full = rows(line_dedup.repeated_runs(d.select("doc_id", "text")))
    deleted = {(r["doc_id"] is not None, r["doc_id"] or 0, r["t"]): set(r["deleted"]) for r in full}
    by_id = defaultdict(set)
    for (named, i, _), lines in deleted.items():
        by_id[named, i] |= lines
    first, windows, hit = set(), set(), 0
    for named, i, text in texts:
        lines = text.split("\n")
        gone = by_id[named, i]
        kept = "\n".join(x for k, x in enumerate(lines) if k not in gone)
        assert any(k[0] == named and k[1] == i and k[3] == kept for k in out)
        trimmed = [x.strip(" ") for x in lines]
        for k, x in enumerate(trimmed):  # only lines that are there before go
            assert k not in gone or x in first
            first.add(x)
        for k in range(len(lines)):  # every heavy run that was there before goes
            weight, e = 0, k
            while e < len(lines) and weight < line_dedup.WINDOW:
                weight += trimmed[e].count(" ") + 1
                e += 1
            if weight >= line_dedup.WINDOW:
                run = tuple(trimmed[k:e])
                if run in windows:
                    hit += 1
                    assert gone >= set(range(k, e))
                windows.add(run)
    assert hit > 50


def test_line_dedup_finds_partners_beyond_a_shared_core(spark):
    rng = random.Random(5)
    table = []
    for k in range(0, 300, 10):  # the core S1 S2 stands first beside another line
        a, x1, x2, s1, s2, y = (" ".join(f"w{rng.randrange(10 ** 9)}" for _ in range(4)) for _ in range(6))
        more = [" ".join(f"w{rng.randrange(10 ** 9)}" for _ in range(4)) for _ in range(4)]
        table += [(k, "\n".join([a, x2, s1, s2, y])), (k + 1, "\n".join([x1, x2, s1, s2, y, *more[:2]])), (k + 2, "\n".join([x1, x2, s1, s2, y, *more[2:]]))]
        w = " ".join(f"v{rng.randrange(10 ** 9)}" for _ in range(16))  # windows that end at a line
        table += [(k + 3, f"{a}1\n{w}\n{y}1"), (k + 4, f"{a}2\n{w}\nend\n{y}2"), (k + 5, f"{a}3\n{w}\nend\n{y}3")]
    got = {r["doc_id"]: r["deleted"] for r in rows(line_dedup.dedup_lines(spark.createDataFrame(table, "doc_id bigint, text string")))}
    for k in range(0, 300, 10):
        assert got[k] == [] and got[k + 1] == [1, 2, 3, 4] and got[k + 2] == [0, 1, 2, 3, 4], (k, got[k + 1], got[k + 2])
        assert got[k + 3] == [] and got[k + 4] == [1] and got[k + 5] == [1, 2], k


# --- op7
def _dedup_truth(table):
    drop = {ord(c): None for c in exact_dedup.BLANKS}
    groups = defaultdict(list)
    for r in table:
        groups[(r["text"] or "").translate(drop)].append(r)
    want = Counter()
    for body, g in groups.items():
        best = max(g, key=lambda r: (len(r["text"] or ""), r["doc_id"] is not None, -(r["doc_id"] or 0)))
        for r in g:
            want[r["doc_id"], best["doc_id"], len(g), hashlib.sha256(body.encode()).hexdigest()] += 1
    return want


@pytest.mark.parametrize("digest", ["sha256", "weak"])
def test_exact_dedup(spark, docs, tmp_path, digest):
    path = f"{tmp_path}/documents.parquet"
    docs.repartition(3).write.parquet(path)
    how = exact_dedup.sha256 if digest == "sha256" else lambda body: (F.length(body) % 5).cast("string")
    got = rows(exact_dedup.exact_groups(spark, path, how))
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == _dedup_truth(rows(docs))
    groups = defaultdict(list)
    for r in got:
        groups[r["text_sha256"]].append(r["kept"])
    assert all(sum(g) == 1 for g in groups.values())


def test_exact_dedup_goes_on_where_it_stopped(spark, tmp_path):
    path, state = f"{tmp_path}/documents.parquet", f"{tmp_path}/state"
    spark.createDataFrame([(5, "a b"), (6, "c")], "doc_id bigint, text string").write.parquet(path)
    exact_dedup.run_stream(spark, path, state)
    spark.createDataFrame([(1, "ab"), (2, "a  b")], "doc_id bigint, text string").write.mode("append").parquet(path)
    exact_dedup.run_stream(spark, path, state)
    got = {(r["n"], r["keep_id"]) for r in rows(exact_dedup.read_state(spark, state))}
    assert got == {(3, 2), (1, 6)}


# --- op8
def test_toxic_patterns():
    lex = toxicity.Lexicon(["grubb"])
    count = lambda t: dict(zip(toxicity.PATTERNS, toxicity.pattern_counts(t, lex)))
    none = dict.fromkeys(toxicity.PATTERNS, 0)
    assert count(None) == count("") == count("a nice day") == none
    assert count("such an IDIOT.") == none | {"insult": 1}
    assert count("you idiot") == count("idiot you") == none | {"insult_target": 1}
    assert count("not an idiot") == none | {"negated": 1}
    assert count("not. an idiot") == none | {"insult": 1}
    assert count("they wrote that idiot") == none | {"reported": 1}
    assert count("kill you; a grubbling") == none | {"threat_target": 1, "insult": 1}
    assert count("idiot***clown") == none | {"insult": 2}


def test_patterns_are_those_of_the_plain_rules():
    """Clauses of random symbols against the rules read one word at a time."""
    rng = random.Random(6)
    word = {"I": "idiot", "H": "kill", "T": "you", "N": "not", "R": "said", "O": "tree"}

    def plain(clause):
        out = []
        for i, s in enumerate(clause):
            if s in "IH":
                targeted = "T" in clause[max(0, i - 3):i] + clause[i + 1:i + 4]
                kind = ("insult" if s == "I" else "threat") + "_target" * targeted
                out.append("reported" if "R" in clause[:i] else "negated" if "N" in clause[max(0, i - 2):i] else kind)
        return out
    lex = toxicity.Lexicon([])
    for _ in range(3000):
        clauses = ["".join(rng.choice("IHTNROOO") for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(1, 3))]
        text = rng.choice(".!?;:\n").join(" ".join(word[s] for s in c) for c in clauses)
        want = Counter(k for c in clauses for k in plain(c))
        assert dict(zip(toxicity.PATTERNS, toxicity.pattern_counts(text, lex))) == {p: want[p] for p in toxicity.PATTERNS}, text


def test_more_insults_score_higher(spark):
    counts = [0, 1, 2, 3, 4, 7, 8, 15, 100, 400, 1023, 10 ** 6]
    d = spark.createDataFrame([(c, *[c] * 6) for c in counts], ["n", *toxicity.PATTERNS])
    in_spark = [r[0] for r in d.select(toxicity.level_column("insult")).collect()]
    assert in_spark == list(toxicity.levels(np.array(counts)))
    assert in_spark[:4] == [0, 1, 1.5, 2] and in_spark[4] < in_spark[5] < in_spark[7] < in_spark[8] < in_spark[9] < in_spark[10] < in_spark[11]


def test_toxicity(spark, docs, labelled, monkeypatch):
    got = rows(toxicity.scores(docs, labelled))
    assert Counter(r["doc_id"] for r in got) == Counter(r["doc_id"] for r in rows(docs))
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    truth = {r["doc_id"]: r["toxic"] for r in rows(labelled)}
    assert not [r for r in got if r["predicted"] and truth.get(r["doc_id"]) == 0]
    kept = toxicity.keep_clean(docs, labelled)
    assert kept.columns == docs.columns and kept.count() == sum(not r["predicted"] for r in got)
    few = Counter((r["doc_id"], r["text"]) for r in rows(kept))
    monkeypatch.setattr(toxicity, "DEFAULT_BROADCAST_BYTES", 0)  # more labels than may be broadcast: the same rows
    assert Counter((r["doc_id"], r["text"]) for r in rows(toxicity.keep_clean(docs, labelled))) == few


def test_stems_are_learned(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("ba be bi bo bu ka ke ki".split()) for _ in range(3))
    table = [(i, " ".join([*(word() for _ in range(20)), *(["zorgx" + word()] * (i % 4 == 0)), *(word() for _ in range(20))]), int(i % 4 == 0)) for i in range(400)]
    d = spark.createDataFrame(table, "doc_id bigint, text string, toxic int")
    assert toxicity.learn_stems(d, d) == ["zorgx"]  # the longest prefix of equal support
    assert {r["doc_id"]: r["predicted"] for r in rows(toxicity.scores(d.drop("toxic"), d))} == {i: y for i, _, y in table}


# --- op9
def test_golay_keys_lose_no_link():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    flips = np.zeros(3000, np.uint64)
    for k in range(3):
        flips ^= np.where(rng.random(3000) < 0.9, np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64), np.uint64(0))
    b = a ^ flips
    probe, index = defaultdict(set), defaultdict(set)
    for out, fp, every in ((probe, a, True), (index, b, False)):
        for r, k in zip(*simhash.link_keys(fp.view(np.int64), every)):
            out[r].add(k)
    assert all(probe[i] & index[i] for i in range(3000))
    words = rng.integers(0, 1 << 23, 2000)
    keys, n = simhash.golay_keys(words)
    assert set(n) <= {1, 6} and keys.max() < 4096


def test_simhash_components(spark, docs):
    up = {i: i + 32 for i in range(65, 91)}
    word = re.compile(r"[^\x20\x09-\x0D]+")
    texts = {r["doc_id"]: r["text"] for r in rows(docs)}
    for r in rows(simhash.fingerprints(docs))[-40:]:
        t = texts[r["doc_id"]] if r["doc_id"] != 904 else "same text here twice"
        w = word.findall((t or "").translate(up))
        shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        votes = [sum(xxhash.xxh64_intdigest(s.encode(), 42) >> i & 1 for s in shingles) for i in range(64)]
        assert r["fp"] % 2 ** 64 == sum(1 << i for i in range(64) if votes[i] * 2 > len(shingles))
    rng = random.Random(1)
    fps = []
    for _ in range(30):
        x = rng.getrandbits(64)
        for _ in range(12):
            fps.append(x)
            for _ in range(rng.randrange(4)):
                x ^= 1 << rng.randrange(64)
    reps = {}
    for i, x in enumerate(fps):
        reps.setdefault(x, 1000 - i)
    d = spark.createDataFrame([(r, x - 2 ** 64 if x >> 63 else x) for x, r in reps.items()], "rep bigint, fp bigint")
    want = {(min(reps[x], reps[y]), max(reps[x], reps[y])) for x in reps for y in reps if x < y and (x ^ y).bit_count() <= 3}
    pairs = {(r["a"], r["b"]) for r in rows(simhash.links(d))}
    assert pairs == want
    root = {r: r for r in reps.values()}
    for _ in range(len(root)):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    comp = {r["node"]: r["component"] for r in rows(simhash.components(simhash.links(d)))}
    assert all(comp.get(r, r) == root[r] for r in root)
    kept = simhash.keep_one(docs)
    ids = [r["doc_id"] for r in rows(kept)]
    assert kept.columns == docs.columns and ids.count(904) == 2 and 905 not in ids and {None, 900} <= set(ids) and not {901, 902, 907} & set(ids)


# --- op10
def test_fingerprints(docs):
    rng = np.random.default_rng(0)
    block = rng.integers(97, 105, (50, fingerprint.WINDOW)).astype(np.uint8)
    for row, kind in zip(block, fingerprint.classes(block)):
        c = np.bincount(row)
        p = c[c > 0] / fingerprint.WINDOW
        assert abs(kind - (-(p * np.log2(p)).sum() / 6 * 1000)) <= 1.01
    table = sorted(((r["doc_id"], r["text"] or "") for r in rows(docs.where("doc_id is not null"))), key=lambda r: (-r[0], r[1]))
    some = docs.where("doc_id is not null")
    rarity = fingerprint.rarities(some)
    want = Counter()
    for k, (i, text) in enumerate(table):
        after = table[(k + 1) % len(table)][1]
        new = text[:len(text) - len(text) // 2] + after[:len(text) // 2]
        a, b, c = (fingerprint.digest(t, rarity) for t in (text, new, after))
        want[i, len(text), hashlib.sha256(new.encode()).hexdigest(), fingerprint.encode(a), fingerprint.encode(b), fingerprint.likeness(a, b), fingerprint.likeness(a, c)] += 1
    got = rows(fingerprint.edited_pairs(some))
    assert Counter(tuple(r.values()) for r in got) == want
    assert sum(r["near_edited"] for r in got) > 5 * sum(r["near_next"] for r in got)
    assert fingerprint.edited_pairs(docs).count() == docs.count()


def test_every_window_is_ranked(spark):
    docs = spark.read.parquet(f"{SF0001}/../sf0.01/documents.parquet").where("length(text) between 150 and 400")
    rarity = fingerprint.rarities(docs)
    texts = [r["text"] for r in rows(docs.orderBy(F.desc("doc_id")))]
    n = fingerprint.WINDOW
    assert len(texts) > 20 and rarity.sum() == sum(len(t.encode()) - n + 1 for t in texts)

    def brute(text):
        a = np.frombuffer(text.encode(), np.uint8)
        kind = [int(fingerprint.classes(a[i:i + n])[0]) for i in range(len(a) - n + 1)]
        points = Counter(min(range(i, i + 8), key=lambda j: (rarity[kind[j]], j)) for i in range(len(kind) - 7))
        return [i for i in range(len(kind)) if points[i] >= 3 and kind[i] >= fingerprint.FLOOR] or [min(range(len(kind)), key=lambda j: rarity[kind[j]])]

    def features(text):
        data = text.encode()
        at = fingerprint.select(np.concatenate(list(fingerprint.kinds(data))), rarity).tolist()
        assert at == brute(text)
        return {data[i:i + n] for i in at}
    for text, after in zip(texts, texts[1:] + texts[:1]):  # the first half stays: some features do
        assert features(text) & features(fingerprint.edited(text, after))
    for k in (0, 1, 3, 63, 64, 65, 126, 127, 128, 129, 300):  # classes of an edited text from those of its halves
        for m in (0, 1, 62, 63, 64, 65, 127, 128, 300):
            left, right = "".join(map(chr, range(40, 340))), texts[0] * 2
            data = left[:k].encode() + right.encode()[:m]
            one, two, whole = (np.concatenate([fingerprint.NONE, *fingerprint.kinds(d)]) for d in (left.encode(), right.encode(), data))
            assert (fingerprint.joined_kinds(data, len(left[:k].encode()), one, two) == whole).all() and len(whole) == (max(1, len(data) - n + 1) if data else 0)


@pytest.mark.parametrize("unit", ["a", "x", " ", "-", "\n", "ab", "lol "])
def test_long_texts_of_one_period_have_a_feature(unit):
    rarity = np.arange(fingerprint.CLASSES + 1)
    long, short, other = (fingerprint.digest(t, rarity) for t in (unit * (200_000 // len(unit)), unit * 5_000, "another text " * 20_000))
    assert len(long) == 1 and fingerprint.encode(long) != "" and fingerprint.likeness(long, short) == 1
    assert fingerprint.likeness(long, fingerprint.digest("", rarity)) == 0 and fingerprint.likeness(long, other) < 1


# --- all
def test_empty_tables(spark, docs, labelled, tmp_path):
    d, none = docs.limit(0), labelled.limit(0)
    path = f"{tmp_path}/documents.parquet"
    d.write.parquet(path)
    outs = [mixing.mix(d, queries.domain_labels(spark, SF0001).limit(0), queries.DOMAIN_TARGETS), bpe.digests(bpe.decode(bpe.encode(d, queries.RANKS, queries.PATTERN), queries.RANKS, queries.PATTERN), "doc_id"),
            langid.identify(d, *langid.fit(d)), license_scan.scan(d), line_dedup.dedup_lines(d), exact_dedup.exact_groups(spark, path), toxicity.scores(d, none), toxicity.keep_clean(d, none),
            simhash.near_duplicates(d), simhash.keep_one(d), fingerprint.edited_pairs(d), fingerprint.fingerprints(d),
            url_filter.filter_urls(spark.createDataFrame([], "page_id bigint, url string"), queries.URL_RULES)]
    assert [o.count() for o in outs] == [0] * len(outs)


def test_pipeline(spark):
    columns = queries.documents(spark, SF0001).columns
    docs = queries.documents(spark, SF0001)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF0001)
        assert docs.columns == columns, name
    out = corpus_pipeline.run(spark, SF0001)
    assert {r["doc_id"] for r in rows(out.select("doc_id"))} <= {r["doc_id"] for r in rows(queries.documents(spark, SF0001))}
    assert out.count() > 100 and set(corpus_pipeline.ORACLE_SQL or ()) == set()


def plain_fingerprint(text):
    lower = (text or "").translate({i: i + 32 for i in range(65, 91)})
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", lower) if x]
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_pipeline_stages_are_the_plain_ones(spark, docs):
    """Null, empty, long and repeated rows and clashing columns through every stage, each held against a plain version."""
    pairs = lambda df: Counter((r["doc_id"], r["text"]) for r in rows(df.select("doc_id", "text")))
    toxicity_, lines, near, mix, last = [stage for _, stage in corpus_pipeline.STAGES]
    given = pairs(docs)
    clean = toxicity_(spark, docs, SF0001).cache()
    assert clean.columns == docs.columns
    toxic = {r["doc_id"]: r["toxic"] for r in rows(queries.labels(spark, SF0001))}
    assert not pairs(clean) - given and not [i for i, _ in given - pairs(clean) if toxic.get(i) == 0]
    shorter = lines(spark, clean, SF0001).cache()
    assert shorter.columns == docs.columns and Counter(i for i, _ in pairs(shorter).elements()) == Counter(i for i, _ in pairs(clean).elements())
    ids, prints = [], []
    for (i, text), n in pairs(shorter).items():
        ids += [i] * n
        prints += [plain_fingerprint(text)] * n
    root = {i: i for i in ids if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    bits = np.array(prints, np.uint64)
    for a, x in enumerate(bits):
        for b in np.flatnonzero(np.bitwise_count(bits[:a] ^ x) <= 3):
            if ids[a] is not None and ids[b] is not None:
                lo, hi = sorted((find(ids[a]), find(ids[b])))
                root[hi] = lo
    single = near(spark, shorter, SF0001).cache()
    assert single.columns == docs.columns
    assert pairs(single) == Counter({k: n for k, n in pairs(shorter).items() if k[0] is None or find(k[0]) == k[0]})
    mixed = mix(spark, single, SF0001).cache()
    assert mixed.columns == docs.columns
    before, after = pairs(single), pairs(mixed)
    assert set(before) == set(after) and all(after[k] >= n for k, n in before.items())
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(queries.RANKS, "rb"))}
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def token_row(i, text):
        found = other.encode_ordinary(text or "")
        return i, tuple(found), len(found), hashlib.sha256((text or "").encode()).hexdigest()
    out = last(spark, mixed, SF0001)
    want = Counter({token_row(*k): n for k, n in after.items()})
    assert Counter((r["doc_id"], tuple(r["ids"]), r["n_tokens"], r["decoded_sha256"]) for r in rows(out)) == want


def test_pipeline_of_no_documents(spark, docs):
    none = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, none, SF0001)
        assert out.count() == 0, name
    assert {"doc_id", "ids", "n_tokens"} <= set(out.columns)
