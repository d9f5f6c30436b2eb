"""The registered queries of this subpackage, with the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm import bpe, exact_dedup, fingerprint, langid, license_scan, line_dedup, merkle, mixing, simhash, superkmer, toxicity, url_filter, whitening
from riskspark.llm.common import documents, held_out, labels

URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]

#: Domains of the labelled table and their target shares of all tokens.
DOMAIN_TARGETS = {"good": 0.6, "plain": 0.35, "toxic": 0.05}
#: In the pipeline, where toxic documents are gone.
CLEAN_TARGETS = {"good": 0.8, "plain": 0.2}

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def domain_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "plain")
    return labels(spark, sf_dir).select("doc_id", domain.alias("domain"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), URL_RULES)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir), domain_labels(spark, sf_dir), DOMAIN_TARGETS)
    return mixed.select("doc_id", "source", "n_words", *[F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(DOMAIN_TARGETS)], "rate", F.col("copies").cast("bigint").alias("copies"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.round_trip(documents(spark, sf_dir).select("doc_id", "text"), RANKS, PATTERN), "doc_id")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = langid.identify(docs, *langid.fit(docs))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(documents(spark, sf_dir).select("doc_id", "text", "n_chars"))
    return out.select("doc_id", "text", F.col("n_chars").cast("bigint").alias("n_chars"), F.size("deleted").cast("bigint").alias("n_deleted"),
                      F.array_join(F.col("deleted").cast("array<string>"), ",").alias("deleted_lines"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(spark, f"{sf_dir}/documents.parquet")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(documents(spark, sf_dir), labels(spark, sf_dir))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(documents(spark, sf_dir))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_pairs(documents(spark, sf_dir))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = merkle.leaf({"text": F.translate("text", ascii_uppercase, ascii_lowercase)})
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, folded)
    manifest = merkle.build(documents(spark, sf_dir), {"tampered": tampered})
    root = F.lit(manifest.root).cast("string")
    out = merkle.proofs(manifest).withColumn("folded_root", merkle.fold(F.coalesce("tampered", "leaf"), F.col("path")))
    return out.select("doc_id", "leaf", "subroot", root.alias("root"), F.sha2(merkle.siblings(F.col("path")).cast("binary"), 256).alias("proof_sha256"),
                      "folded_root", (F.col("folded_root") == root).alias("verified"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.transform(*whitening.fit(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))


def op13_superkmer(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = superkmer.dedup_substrings(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_url_filter, op2_mixing, op3_byte_bpe, op4_language_id, op5_license_scan, op6_line_dedup, op7_exact_dedup, op8_toxicity, op9_simhash, op10_fingerprint, op11_merkle, op12_whitening, op13_superkmer)}

#: Python's \s and DuckDB's regular expressions differ; the six blanks are spelled out.
BLANKS = r"[\x20\x09-\x0D]"

def merkle_sql(depth: int = 6) -> str:
    """The manifest in SQL, level by level: up to 16 ** depth leaves a source, and as many sources."""
    def framed(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE CAST(octet_length(encode(CAST({c} AS VARCHAR))) AS VARCHAR) || ':' || CAST({c} AS VARCHAR) END"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(framed(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    digits = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))"
    crc = f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {digits}), lambda acc, b: xor(acc >> 8, list_reduce([xor(acc, b) & 255, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))), 4294967295)"
    lower = f"translate(text, '{ascii_uppercase}', '{ascii_lowercase}')"

    def tree(name: str) -> list[str]:
        out = []
        for k in range(depth):
            out.append(f"{name}{k + 1} AS (SELECT grp, pos // 16 AS pos, (n + 15) // 16 AS n, sha256(string_agg(h, '' ORDER BY pos)) AS h FROM {name}{k} WHERE n > 1 GROUP BY grp, pos // 16, n)")
            side = "coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos {0} a.pos), '')"
            out.append(f"{name}_side{k} AS (SELECT a.grp, a.pos, {side.format('<')} AS l, {side.format('>')} AS r FROM {name}{k} a JOIN {name}{k} b ON a.grp = b.grp AND a.pos // 16 = b.pos // 16 WHERE a.n > 1 GROUP BY a.grp, a.pos)")
        out.append(f"{name}_roots AS (" + " UNION ALL ".join(f"SELECT grp, h FROM {name}{k} WHERE n = 1" for k in range(depth + 1)) + ")")
        return out

    def climb(name: str, first: str, grp: str, pos: str) -> list[str]:
        out, before = [], first
        for k in range(depth):
            out.append(f"{name}_p{k} AS (SELECT p.* REPLACE (CASE WHEN s.l IS NULL THEN node ELSE sha256(s.l || node || s.r) END AS node, sib || coalesce(s.l || s.r, '') AS sib) "
                       f"FROM {before} p LEFT JOIN {name}_side{k} s ON s.grp = p.{grp} AND s.pos = p.{pos} // {16 ** k})")
            before = f"{name}_p{k}"
        return out
    parts = [
        f"d AS (SELECT doc_id, coalesce('s' || source, '') AS grp, {leaf('text')} AS h, CASE WHEN {crc} % 5 = 0 THEN {leaf(lower)} END AS tampered FROM documents)",
        "e AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY grp) AS n FROM d)",
        "s0 AS (SELECT grp, pos, n, h FROM e)", *tree("s"),
        "places AS (SELECT grp AS source, h, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n FROM s_roots)",
        "t0 AS (SELECT 'top' AS grp, pos, n, h FROM places)", *tree("t"),
        "start AS (SELECT e.doc_id, e.h AS leaf, e.grp, e.pos, 'top' AS top, places.pos AS place, places.h AS subroot, coalesce(e.tampered, e.h) AS node, '' AS sib FROM e JOIN places ON places.source = e.grp)",
        *climb("s", "start", "grp", "pos"), *climb("t", f"s_p{depth - 1}", "top", "place")]
    return ("WITH " + ",\n".join(parts) + "\nSELECT doc_id, leaf, subroot, t_roots.h AS root, sha256(sib) AS proof_sha256, node AS folded_root, node = t_roots.h AS verified "
            f"FROM t_p{depth - 1}, t_roots")


ORACLE_SQL = {
    "op7_exact_dedup": rf"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '{BLANKS}', '', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, count(*) AS group_size, max(n) AS n FROM d GROUP BY text_sha256),
k AS (SELECT d.text_sha256, min(d.doc_id) AS keep_id FROM d JOIN g ON g.text_sha256 = d.text_sha256 AND g.n = d.n GROUP BY d.text_sha256)
SELECT d.doc_id, k.keep_id, g.group_size, d.doc_id = k.keep_id AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256) JOIN k USING (text_sha256)""",
    "op11_merkle": merkle_sql(),
    "op13_superkmer": r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT r, doc_id, i, array_to_string(w[i:i + 49], ' ') AS g FROM d, unnest(range(1, len(w) - 48)) t(i)),
least AS (SELECT g, min(doc_id) AS lo FROM win GROUP BY g),
hit AS (SELECT r, i FROM win JOIN least USING (g) WHERE lo < doc_id),
gone AS (SELECT DISTINCT r, i + k AS p FROM hit, range(50) t(k)),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (r, p) GROUP BY r),
lost AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT d.doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r) LEFT JOIN lost USING (r)""",
}
