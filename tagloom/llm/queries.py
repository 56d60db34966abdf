"""Thin queries over the corpus operators, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagloom.llm.suffixes import remove_repeats

    return remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"), with_kept=False)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagloom.llm.sharding import shard_by_bytes

    return shard_by_bytes(_table(spark, sf_dir, "documents"), shards=40)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagloom.llm.bpe import bpe_encode

    return bpe_encode(_table(spark, sf_dir, "documents"), _tokenizer())


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagloom.llm.secrets import digest_columns, secret_spans

    return digest_columns(secret_spans(_table(spark, sf_dir, "documents").select("doc_id", "text")))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagloom.llm.decontaminate import find_leaks

    return find_leaks(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))


def op4_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagloom.llm.pitman_yor import score_documents

    return score_documents(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagloom.llm.warc import archive_round_trip

    return archive_round_trip(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagloom.llm.fingerprints import fingerprint_neighbours

    return fingerprint_neighbours(_table(spark, sf_dir, "documents"))


def op9_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagloom.llm.neardup import THREE_85, near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"), THREE_85)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagloom.llm.toxicity import score, train

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 1
    model = train(docs, _table(spark, sf_dir, "labels"), held_out)
    scored = score(docs, model)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


QUERIES = {"op1_suffix_dedup": op1_suffix_dedup, "op3_decontamination": op3_decontamination, "op4_pitman_yor": op4_pitman_yor, "op5_warc": op5_warc, "op8_fingerprints": op8_fingerprints, "op9_neardup": op9_neardup, "op10_toxicity": op10_toxicity, "op2_sharding": op2_sharding, "op6_bpe": op6_bpe, "op7_secrets": op7_secrets}
#: Digests in base 32 by groups of 20 bits, the first page of each payload; near-duplicates
#: by joining all shingles, recursion over links.
ORACLE: dict[str, str] = {
    "op5_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS raw FROM pages),
h AS (SELECT page_id, octet_length(raw) AS n, sha1(raw) AS h FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(flatten(list_transform(range(0, 8), lambda i: list_transform([15, 10, 5, 0], lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((CAST('0x' || substr(h, 1 + 5 * i, 5) AS BIGINT) >> s) & 31) + 1, 1)))), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
""",
    "op9_neardup": """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 2], ' ') AS sh FROM (SELECT doc_id, ws, unnest(range(1, greatest(2, len(ws) - 1))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
  JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * p.c >= 85 * (na.n + nb.n - p.c)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(least.b, w.doc_id)) AS component_id, least(w.doc_id, coalesce(least.b, w.doc_id)) = w.doc_id AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN least ON least.a = w.doc_id
""",
}
