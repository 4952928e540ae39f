"""The operators applied to the whole tables, under their contracts; SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwright.llm import embeddings, exact_dedup, langid, mixing, packing, pii, simhash, substrings, token_shards, urls


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op5_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.shards(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_pii, op2_substrings, op3_mixing, op4_langid, op5_token_shards, op6_simhash, op7_packing, op8_urls, op9_embeddings, op10_exact_dedup)}

ORACLE_SQL = {
    "op2_substrings": r"""
WITH docs AS (
  SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT n, i, array_to_string(w[i:i + 34], ' ') AS k FROM docs, unnest(range(1, len(w) - 33)) t(i)
), repeated AS (
  SELECT n, i FROM (SELECT n, i, count(*) OVER (PARTITION BY k) AS c FROM windows) WHERE c > 1
), gone AS (
  SELECT DISTINCT n, i + j AS p FROM repeated, range(0, 35) t(j)
), words AS (
  SELECT n, p, w[p] AS word FROM docs, unnest(range(1, len(w) + 1)) t(p)
), kept AS (
  SELECT n, count(*) AS c, string_agg(word, ' ' ORDER BY p) AS text FROM words ANTI JOIN gone USING (n, p) GROUP BY n
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(c, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (n)
""",
    "op9_embeddings": """
WITH RECURSIVE good AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9
), reach AS (
  SELECT vec_id AS x, vec_id AS y FROM embeddings
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), lowest AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x
), counts AS (SELECT x, count(*) AS c FROM links GROUP BY x)
SELECT vec_id, coalesce(c, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN lowest ON lowest.x = vec_id LEFT JOIN counts ON counts.x = vec_id
""",
    "op8_urls": r"""
WITH rules(rule_host, rule_path, said) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), parsed AS (
  SELECT row_number() OVER () AS n, page_id,
         translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), judged AS (
  SELECT n, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(said, length(rule_host || rule_path)) AS said
  FROM parsed JOIN rules ON (host = rule_host OR host LIKE '%.' || rule_host) AND starts_with(path, rule_path)
  GROUP BY n
)
SELECT page_id, host, path, rule, coalesce(said, 'allow') AS verdict FROM parsed LEFT JOIN judged USING (n)
""",
    "op10_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""",
}
