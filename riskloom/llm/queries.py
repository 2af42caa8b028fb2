"""The queries of these operators over the given tables, and their SQL twins."""

from __future__ import annotations

from riskloom.llm import conversation_repair, decontaminate, embedding_dedup, html_extract, licenses, line_dedup, merkle, minhash, mixing, multiset_hash, quality, secret_scan, token_counts
from riskloom.sources.applications import table

LLM_QUERIES: dict = {}
LLM_ORACLE: dict[str, str] = {}


def query(fn):
    LLM_QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_counts(spark, sf_dir):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), path, token_counts.cache_path(spark, path))


@query
def op4_source_mix(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


LLM_ORACLE["op4_source_mix"] = mixing.MIX_SQL.replace("{docs}", "documents")


@query
def op5_license_scan(spark, sf_dir):
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@query
def op6_secret_scan(spark, sf_dir):
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"))


LLM_ORACLE["op6_secret_scan"] = secret_scan.secrets_sql()


@query
def op8_quality_scores(spark, sf_dir):
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_near_duplicates(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_recurring_lines(docs)


LLM_ORACLE["op7_line_dedup"] = line_dedup.lines_sql()


@query
def op9_benchmark_leaks(spark, sf_dir):
    return decontaminate.benchmark_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op10_near_vectors(spark, sf_dir):
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


# Exact all-pairs links, with components by spreading the least id.
LLM_ORACLE_VECTORS = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL),
n AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS r FROM v),
k AS (SELECT a.vec_id AS x, b.vec_id AS y FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE a.r > 0 AND b.r > 0 AND list_dot_product(a.e, b.e) / (a.r * b.r) >= 0.93),
c AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT c.x, k.y FROM c JOIN k ON c.y = k.x),
m AS (SELECT x, min(y) AS component_id FROM c GROUP BY x)
SELECT e.vec_id, (SELECT count(*) FROM k WHERE k.x = e.vec_id) AS n_links, m.component_id, e.vec_id = m.component_id AS kept
FROM embeddings e JOIN m ON m.x = e.vec_id
"""
LLM_ORACLE["op10_near_vectors"] = LLM_ORACLE_VECTORS


@query
def op3_page_texts(spark, sf_dir):
    return html_extract.extract_text(table(spark, sf_dir, "pages"))


@query
def op11_manifest_proofs(spark, sf_dir):
    return merkle.manifest_proofs(table(spark, sf_dir, "documents"))


LLM_ORACLE["op11_manifest_proofs"] = merkle.MERKLE_SQL.replace("{docs}", "documents")


@query
def op12_conversation_repair(spark, sf_dir):
    return conversation_repair.damage_and_repair(table(spark, sf_dir, "conversations"))


LLM_ORACLE["op12_conversation_repair"] = conversation_repair.REPAIR_SQL


@query
def op13_document_fingerprints(spark, sf_dir):
    return multiset_hash.fingerprints(table(spark, sf_dir, "documents"))


LLM_ORACLE["op13_document_fingerprints"] = multiset_hash.FINGERPRINT_SQL
