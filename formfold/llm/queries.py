"""The operators of this subpackage as queries by name, with their SQL where SQL can say it."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formfold.llm.shared import folder

ROOT = Path(__file__).resolve().parent.parent.parent
SHARDS = 40
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package where their path lacks it."""
    if str(ROOT) not in os.environ.get("PYTHONPATH", "").split(":") and not any(
            "formfold-package" in x for x in spark.sparkContext.listFiles):
        made = os.path.join(tempfile.mkdtemp(prefix="formfold-"), "formfold-package.zip")
        with zipfile.ZipFile(made, "w") as z:
            for p in sorted((ROOT / "formfold").rglob("*.py")):
                z.write(p, p.relative_to(ROOT))
        spark.sparkContext.addPyFile(made)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from formfold.llm.sharding import shard_documents
    return shard_documents(table(spark, sf_dir, "documents"), SHARDS)


def bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import PATTERN, path

    from formfold.llm.bpe import decode_documents, encode_documents
    vocabulary = path("byte_bpe_multi_50k.tiktoken")
    coded = encode_documents(table(spark, sf_dir, "documents"), vocabulary, PATTERN)
    return decode_documents(coded, vocabulary).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def idfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    from formfold.llm.idfile import read_ids, write_ids
    files = f"{folder(spark)}/token-ids-{uuid.uuid4().hex}"
    write_ids(table(spark, sf_dir, "documents"), files, path("byte_bpe_50k.json"))
    return read_ids(spark, files, ids_crc32=F.crc32("ids"))


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def packed(docs: DataFrame, **options) -> DataFrame:
    from public_tokenizers import path

    from formfold.llm.packing import pack_documents
    return pack_documents(docs, path("byte_bpe_50k.json"), **options).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    from formfold.llm.ann import nearest
    return nearest(table(spark, sf_dir, "embeddings"), k=20, every=20)


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from formfold.llm.toxicity import fit, held_out, score_documents
    docs = table(spark, sf_dir, "documents")
    scored = score_documents(docs.select("doc_id", "text"), fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "toxicity.score", "toxicity.predicted")


def minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from formfold.llm.minhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from formfold.llm.suffixes import remove_repeats
    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), length=50).select(
        "doc_id", "removal.n_bytes", "removal.n_removed", "removal.n_spans", F.sha2("removal.kept", 256).alias("kept_sha256"))


def urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    from formfold.llm.urls import judge_urls
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


def topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from formfold.llm.topk import top_k
    return top_k(table(spark, sf_dir, "embeddings"), k=5, every=50)


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    from formfold.llm.phrases import remove_phrases
    return remove_phrases(table(spark, sf_dir, "documents"), width=35).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from formfold.llm.manifest import Manifest
    return Manifest(table(spark, sf_dir, "documents")).proofs().drop("rank", "tree")


def whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from formfold.llm.whitening import whiten
    return whiten(table(spark, sf_dir, "embeddings"), components=16, scale=64).select(
        "vec_id", "component", "n", F.col("deviation").cast("long").alias("deviation"), "whitened", "explained", "identity_error")


QUERIES = {
    "op1_sharding": sharding,
    "op2_toxicity": toxicity,
    "op3_bpe": bpe,
    "op4_idfile": idfile,
    "op5_ann": ann,
    "op6_minhash": minhash,
    "op7_suffixes": suffixes,
    "op8_urls": urls,
    "op9_topk": topk,
    "op10_packing": packing,
    "op11_whitening": whitening,
    "op12_phrases": phrases,
    "op13_manifest": manifest,
}

URL_SQL = """
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
hosts AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM parts),
urls AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM hosts),
rules(r_host, r_path, r_verdict) AS (VALUES {rules}),
best AS (
  SELECT host, path, arg_max(r_host || r_path, length(r_host || r_path)) AS rule,
         arg_max(r_verdict, length(r_host || r_path)) AS verdict
  FROM (SELECT DISTINCT host, path FROM urls) JOIN rules
    ON (host = r_host OR suffix(host, '.' || r_host)) AND prefix(path, r_path)
  GROUP BY host, path)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM urls LEFT JOIN best USING (host, path)
"""

TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""

MINHASH_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE
    list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END) AS s FROM words),
sizes AS (SELECT doc_id, count(s) AS n FROM documents LEFT JOIN sets USING (doc_id) GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared.n >= 80 * (x.n + y.n - shared.n)),
ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, ways.b FROM reach JOIN ways ON ways.a = reach.other)
SELECT doc_id, sizes.n AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM sizes JOIN reach USING (doc_id) GROUP BY doc_id, sizes.n
"""

SUFFIX_SQL = """
WITH texts AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
strings AS (SELECT doc_id, pos, b[pos:pos + 49] AS s FROM texts, unnest(range(1, octet_length(b) - 48)) AS u(pos)),
firsts AS (SELECT s, min(doc_id) AS first FROM strings GROUP BY s),
hits AS (SELECT doc_id, pos FROM strings JOIN firsts USING (s) WHERE first < doc_id),
marked AS (SELECT doc_id, pos, pos > coalesce(lag(pos) OVER (PARTITION BY doc_id ORDER BY pos), -50) + 50 AS fresh FROM hits),
numbered AS (SELECT doc_id, pos, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM marked),
spans AS (SELECT doc_id, min(pos) AS a, max(pos) + 50 AS z FROM numbered GROUP BY doc_id, run),
pieces AS (
  SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 1) AS s, a AS e FROM spans UNION ALL
  SELECT doc_id, coalesce(max(z), 1), any_value(octet_length(b)) + 1 FROM texts LEFT JOIN spans USING (doc_id) GROUP BY doc_id),
kept AS (
  SELECT doc_id, sha256(from_hex(coalesce(string_agg(hex(b[s:e - 1]), '' ORDER BY s) FILTER (WHERE e > s), ''))) AS kept_sha256
  FROM pieces JOIN texts USING (doc_id) GROUP BY doc_id)
SELECT doc_id, octet_length(b) AS n_bytes, CAST(coalesce(sum(z - a), 0) AS BIGINT) AS n_removed, count(z) AS n_spans, kept_sha256
FROM texts JOIN kept USING (doc_id) LEFT JOIN spans USING (doc_id) GROUP BY doc_id, b, kept_sha256
"""

ORACLES = {
    "op6_minhash": MINHASH_SQL,
    "op7_suffixes": SUFFIX_SQL,
    "op8_urls": URL_SQL.format(rules=", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)),
    "op9_topk": TOPK_SQL,
}


def queries() -> dict:
    return {name: (lambda spark, sf_dir, f=f: f(ship(spark), sf_dir)) for name, f in QUERIES.items()}
