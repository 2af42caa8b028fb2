"""Token counts behind a cache that is keyed by content and tokenizer digests."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import map_batches, text_or_empty
from riskloom.session import shared_dir

SEGMENT_MEMO = 400_000  # words a task remembers at once; forgetting costs time, not counts
LIMIT = 2048


def tokenizer_digest(path: str) -> str:
    """The version of a tokenizer: a digest of its file."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def splits_at_space(path: str) -> bool:
    """Whether a tokenizer's counts add up over the pieces between ASCII white space.

    True only for a ``.json`` model whose normalizers and pre-tokenizer are known to treat
    white space as a mere gap: it is never part of a token and nothing looks across it.
    """
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    norm, pre = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    steps = [n.get("type") for n in norm.get("normalizers", [norm])]
    first = (pre.get("pretokenizers") or [pre])[0]
    gap = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
    return (
        bool(gap)
        and all(kind in ("NFC", "Replace", "Lowercase") for kind in steps)
        and first["pattern"].get("Regex", "").endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec.get("added_tokens", []))
        and not spec["model"].get("fuse_unk")
    )


def counter(path: str) -> Callable[[list[str]], list[int]]:
    """A function from texts to token counts, as the tokenizer's library gives them."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]

    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()

    def whole(texts: list[str]) -> list[int]:
        return [len(model.encode(t, add_special_tokens=False).ids) for t in texts]

    if not splits_at_space(path):
        return whole

    class Memo(dict):
        def __missing__(self, word: str) -> int:
            if len(self) >= SEGMENT_MEMO:
                self.clear()
            n = self[word] = len(model.encode(word, add_special_tokens=False).ids) if word else 0
            return n

    memo = Memo()
    gaps = str.maketrans(dict.fromkeys("\t\n\r", " "))

    def pieces(texts: list[str]) -> list[int]:
        return [sum(map(memo.__getitem__, t.translate(gaps).split(" "))) for t in texts]

    return pieces


def content_digest(text: str = "text"):
    """The digest of a text as it is: no normalisation may change a count."""
    return F.sha2(text_or_empty(text), 256)


def cache_path(spark: SparkSession, path: str) -> str:
    """Where the counts of a tokenizer version are kept, below the shared folder, from run to run."""
    return os.path.join(shared_dir(spark), f"token-cache-{tokenizer_digest(path)[:16]}")


def encode_misses(misses: DataFrame, path: str, version: str) -> DataFrame:
    """(content, tokenizer, n_tokens) for rows of (content, text)."""

    def start():
        count = counter(path)
        return lambda texts: {"tokenizer": [version] * len(texts), "n_tokens": count(texts)}

    return map_batches(misses.select("content", "text"), start, "tokenizer string, n_tokens long")


def read_cache(docs: DataFrame, cache: str) -> DataFrame:
    """The cache so far; a folder with nothing in it is an empty cache."""
    spark = docs.sparkSession
    schema = "content string, tokenizer string, n_tokens long"
    where = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(cache)


def count_tokens(docs: DataFrame, path: str, cache: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every whole text.

    Contents are matched with the cache by their digest and the tokenizer's. Distinct
    contents without a stored count are encoded and appended; the counts are then joined
    from the cache, so a second run over the same or overlapping text encodes only what is
    new. Copies of a text are reduced to one on each task before the shuffle, so a text
    that a third of all rows share is shuffled once per task and encoded once.

    A null text is an empty one: 0 bytes and 0 tokens. Repeated rows and null ids keep
    their rows; an empty table gives an empty one; further columns are ignored. Texts of
    any length are encoded whole.
    """
    version = tokenizer_digest(path)
    keyed = docs.select("doc_id", text_or_empty().alias("text"), content_digest().alias("content"))
    known = read_cache(docs, cache).filter(F.col("tokenizer") == version)
    misses = (
        keyed.select("content", "text").join(known, "content", "left_anti").groupBy("content").agg(F.first("text").alias("text"))
    )
    encode_misses(misses, path, version).write.mode("append").parquet(cache)
    # A run that failed halfway may have left a count twice.
    stored = read_cache(docs, cache).filter(F.col("tokenizer") == version).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))
    sizes = keyed.select("doc_id", "content", F.octet_length("text").cast("long").alias("n_bytes"))
    return sizes.join(stored, "content").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
