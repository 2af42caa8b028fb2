"""A byte-level convolutional network that scores a text's quality, in numpy."""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.bytewords import hash_words, word_bounds
from riskloom.llm.common import map_batches, spread_hash, text_or_empty
from riskloom.session import pin

FILTERS, WIDTH, BLOCK = 8, 5, 256
SYMBOLS = 512  # a byte, and whether it stands in a word that repeats the one before
FOLDS = 5
THRESHOLD = 0.3
SAMPLE = 1_500  # labelled rows of each class that are learned from, at most
SHARDS, ROUNDS, BATCH, STEP = 8, 8, 8, 0.02


def symbols(text: str) -> np.ndarray:
    """The text as symbols; a short one is padded so that it has one position."""
    x = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    out = np.zeros(max(len(x), 1) + WIDTH - 1, np.int16)
    out[: len(x)] = x
    starts, ends = word_bounds(x)
    if len(starts) > 1:
        hashes = hash_words(x, starts, ends)
        again = np.flatnonzero(hashes[1:] == hashes[:-1]) + 1
        if len(again):
            change = np.zeros(len(x) + 1, np.int16)
            change[starts[again]] += 1
            change[ends[again]] -= 1
            out[: len(x)] += np.cumsum(change[:-1], dtype=np.int16) * 256
    return out


class Network:
    """Filters over symbols, max-pooled over overlapping chunks, then one logit per chunk.

    A chunk is two neighbouring blocks, so chunks overlap by half and cover the whole
    text. The text's logit is the mean of its chunks' logits.
    """

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.table = rng.normal(0, 0.3, (WIDTH, SYMBOLS, FILTERS)).astype(np.float32)
        self.out = rng.normal(0, 0.5, FILTERS).astype(np.float32)
        self.bias = np.zeros(1, np.float32)

    @property
    def parts(self) -> list[np.ndarray]:
        return [self.table, self.out, self.bias]

    def dump(self) -> bytes:
        buffer = io.BytesIO()
        np.savez(buffer, *self.parts)
        return buffer.getvalue()

    @classmethod
    def load(cls, data: bytes) -> "Network":
        made, stored = cls.__new__(cls), np.load(io.BytesIO(data))
        made.table, made.out, made.bias = [stored[f"arr_{i}"] for i in range(3)]
        return made

    def blocks(self, x: np.ndarray, places: bool = False):
        """Each block's maximum of each filter, and where it stands."""
        n = len(x) - WIDTH + 1
        count = -(-n // BLOCK)
        best = np.empty((count, FILTERS), np.float32)
        where = np.empty((count, FILTERS), np.int64) if places else None
        for b in range(0, count, 32):
            lo, hi = b * BLOCK, min(n, (b + 32) * BLOCK)
            z = self.table[0].take(x[lo:hi], axis=0)
            for k in range(1, WIDTH):
                z += self.table[k].take(x[lo + k : hi + k], axis=0)
            full = (hi - lo) // BLOCK
            if full:
                cube = z[: full * BLOCK].reshape(full, BLOCK, FILTERS)
                best[b : b + full] = cube.max(axis=1)
                if places:
                    where[b : b + full] = cube.argmax(axis=1) + lo + np.arange(full)[:, None] * BLOCK
            if full * BLOCK < hi - lo:
                rest = z[full * BLOCK :]
                best[b + full] = rest.max(axis=0)
                if places:
                    where[b + full] = rest.argmax(axis=0) + lo + full * BLOCK
        return best, where

    def logit(self, x: np.ndarray) -> float:
        best, _ = self.blocks(x)
        pooled = np.maximum(best[1:], best[:-1]) if len(best) > 1 else best
        return float((np.maximum(pooled, 0) @ self.out + self.bias).mean())

    def probability(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.logit(symbols(text)), -30, 30))))

    def gradient(self, x: np.ndarray, label: float, weight: float, grads: list[np.ndarray]) -> None:
        best, where = self.blocks(x, places=True)
        if len(best) > 1:
            later = best[1:] > best[:-1]
            best, where = np.where(later, best[1:], best[:-1]), np.where(later, where[1:], where[:-1])
        active = np.maximum(best, 0)
        p = 1 / (1 + np.exp(-np.clip((active @ self.out + self.bias).mean(), -30, 30)))
        g = weight * (p - label) / len(best)
        grads[1] += g * active.sum(axis=0)
        grads[2] += g * len(best)
        chunk, f = np.nonzero(best > 0)
        for k in range(WIDTH):
            np.add.at(grads[0][k], (x[where[chunk, f] + k], f), g * self.out[f])

    def train(self, rows: list[tuple[np.ndarray, float, float]]) -> None:
        """One pass of Adam over (symbols, label, weight)."""
        first, second = [np.zeros_like(p) for p in self.parts], [np.zeros_like(p) for p in self.parts]
        for t, at in enumerate(range(0, len(rows), BATCH), 1):
            grads = [np.zeros_like(p) for p in self.parts]
            for x, label, weight in rows[at : at + BATCH]:
                self.gradient(x, label, weight / BATCH, grads)
            for p, g, m, v in zip(self.parts, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= STEP * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)


def held_out(doc_id: str = "doc_id"):
    """One in five documents by the checksum of its id; a null id is never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(shard, place, text, label, weight): at most ``sample`` labelled rows of each class.

    Chosen by a hash of the id, so the choice doesn't depend on the table's order. Weights
    bring the classes back to their shares among all labels that may be learned from.
    """
    usable = (
        labels.select("doc_id", F.col("quality").cast("double").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0.0, 1.0) & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .withColumn("place", spread_hash("doc_id", "quality"))
    )
    counts = {r["label"]: r["n"] for r in usable.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    chosen = None
    for label, n in sorted(counts.items()):
        part = usable.filter(F.col("label") == label).orderBy("place", "doc_id").limit(sample)
        part = part.withColumn("weight", F.lit(2.0 * n / total / min(n, sample) * min(total, 2 * sample) / 2))
        chosen = part if chosen is None else chosen.unionAll(part)
    if chosen is None:
        chosen = usable.withColumn("weight", F.lit(1.0))
    # At most 2 * sample narrow rows, whatever the tables' sizes.
    texts = docs.select(F.col("doc_id"), text_or_empty().alias("text")).join(F.broadcast(chosen), "doc_id")
    return (
        texts.groupBy("doc_id", "label", "weight", "place")
        .agg(F.min("text").alias("text"))
        .select(F.floor(F.col("place") * SHARDS).cast("int").alias("shard"), "place", "text", "label", "weight")
    )


def _local_pass(params: bytes, turn: int):
    """One shard's pass over its rows from the shared parameters."""

    def local(pdf: pd.DataFrame) -> pd.DataFrame:
        net = Network.load(params)
        pdf = pdf.sort_values("place")
        order = np.random.default_rng(turn).permutation(len(pdf))
        texts = [symbols(t) for t in pdf["text"]]
        net.train([(texts[i], pdf["label"].iloc[i], pdf["weight"].iloc[i]) for i in order])
        return pd.DataFrame({"n": [len(pdf)], "params": [net.dump()]})

    return local


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, rounds: int = ROUNDS) -> bytes:
    """Learn the network: each round, every shard trains a copy and the copies are averaged.

    Texts stay on the executors; the driver sees ``SHARDS`` parameter sets of 80 kB a round.
    Without labels the network stays as drawn and only its bias says that nothing is known.
    """
    rows = pin(labelled_sample(docs, labels, sample), "quality-sample")
    params = Network().dump()
    for turn in range(rounds):
        learned = rows.groupBy("shard").applyInPandas(_local_pass(params, turn), "n long, params binary").collect()
        if not learned:
            break
        share = np.array([r["n"] for r in learned]) / sum(r["n"] for r in learned)
        nets = [Network.load(bytes(r["params"])) for r in learned]
        mean = Network()
        mean.table, mean.out, mean.bias = [
            sum(w * p for w, p in zip(share, parts, strict=True)).astype(np.float32)
            for parts in zip(*[n.parts for n in nets], strict=True)
        ]
        params = mean.dump()
    return params


def score(docs: DataFrame, params: bytes, keep_text: bool = False) -> DataFrame:
    """``docs`` with ``text`` replaced by ``_rl_score``, or beside it: whole texts, a few at a time."""

    def start():
        net = Network.load(params)
        return lambda texts: {"_rl_score": [net.probability(t or "") for t in texts]}

    return map_batches(docs, start, "_rl_score double", keep=keep_text)


def quality_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, score and predicted of every whole text.

    Only ``text`` enters a score. Learned from a bounded sample of labelled rows that are
    not held out; conflicting labels of an id count as 1. A null or empty text is scored as
    one blank position; without usable labels scores say nothing but are defined. Repeated
    rows and null ids (held out) keep their rows; an empty table gives an empty one; further
    columns are ignored.
    """
    scored = score(docs.select("doc_id", "text"), fit(docs, labels, sample, rounds))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("_rl_score").alias("score"),
        (F.col("_rl_score") >= THRESHOLD).cast("int").alias("predicted"),
    )
