"""The registered query keeps its counts: a second run encodes nothing."""

import public_tokenizers

from riskloom.llm import queries, token_counts


def test_a_second_run_encodes_nothing(spark, sf_dir, monkeypatch):
    first = sorted(map(tuple, queries.LLM_QUERIES["op1_token_counts"](spark, sf_dir).collect()))
    cache = token_counts.cache_path(spark, public_tokenizers.path("word_bpe_49k.json"))
    stored = spark.read.parquet(cache).count()
    misses = []
    encode = token_counts.encode_misses
    monkeypatch.setattr(token_counts, "encode_misses", lambda rows, *a: misses.append(rows.count()) or encode(rows, *a))
    assert sorted(map(tuple, queries.LLM_QUERIES["op1_token_counts"](spark, sf_dir).collect())) == first
    assert misses == [0] and spark.read.parquet(cache).count() == stored
