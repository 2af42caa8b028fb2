"""Benchmark passages in documents: CGK embedding, bit-sampling LSH, exact edit check."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.bytewords import U, mix64, shingles, word_hashes
from riskloom.llm.common import map_batches, row_key, same_columns

EDITS = (1, 10)  # word edits allowed per word of an item
PIECE = 32  # words of a piece at least; items of twice as many are cut into pieces
REPEATS, SAMPLED = 32, 3  # LSH tables, and positions of the embedding in each key
RECALL = 0.98  # of items with all the edits allowed, in each size class
SEED = 3  # words of a seed; that many seeds are lost by an edit at most
SEED_BITS = 24
BLOCK_ITEMS = 4_000  # items that a pass over the documents looks for
WINDOWS = 4_096  # windows embedded at once
PAD = U(0x5851F42D4C957F2D)


def allowed(n: int) -> int:
    return n * EDITS[0] // EDITS[1]


def pieces(n: int) -> list[tuple[int, int]]:
    """(first word, end) of the pieces of an item of ``n`` words.

    The pieces share out the item's words evenly, so at most the allowed edits of the item
    leave some piece with at most the allowed edits of its own.
    """
    m = max(1, n // PIECE)
    return [(n * j // m, n * (j + 1) // m) for j in range(m)]


def share(n: int) -> int:
    """Edits of the piece with the fewest, when an item of ``n`` words has all it may have."""
    return allowed(n) // len(pieces(n))


def _bits(step: int, repeat: int, symbols: np.ndarray) -> np.ndarray:
    """The walk's random bit for each symbol at a step: 1 moves on, 0 repeats the symbol."""
    salt = mix64(np.array([(repeat << 32) + step + 1], U))[0] | U(1)
    return ((symbols * salt) >> U(63)).astype(np.int64)


def keys_of(windows: np.ndarray, repeat: int) -> np.ndarray:
    """LSH keys of rows of words: a few positions of each row's embedding.

    The Chakraborty-Goldenberg-Koucky walk copies a word and moves on or stays as a random
    bit of (step, word) says, so two rows with few edits fall back into step and their
    walks agree in most places: edit distance becomes Hamming distance, which sampled
    positions compare. Past the end of a row the walk reads padding.
    """
    n, width = windows.shape
    steps = np.sort(np.random.default_rng(1_000 + repeat).choice(2 * width, min(SAMPLED, 2 * width), replace=False))
    at, rows, key = np.zeros(n, np.int64), np.arange(n), np.full(n, repeat + 1, U)
    padded = np.concatenate([windows, np.full((n, 1), PAD, U)], axis=1)
    for step in range(int(steps[-1]) + 1):
        symbols = padded[rows, at]
        if step in steps:
            key = mix64(key * U(0xD6E8FEB86659FD93) + symbols)
        at = np.minimum(at + _bits(step, repeat, symbols), width)
    return key


def edit_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Fewest word edits between an item and any run of words of ``text``, and the run's end."""
    places = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, word in enumerate(item, 1):
        new = row + 1
        new[1:] = np.minimum(new[1:], row[:-1] + (text != word))
        new[0] = i
        row = np.minimum.accumulate(new - places) + places
    end = int(row.argmin())
    return int(row[end]), end


class Items:
    """A block of benchmark items, ready to be looked for; items of the same words are one."""

    def __init__(self, items: list[tuple]):
        alike: dict[bytes, tuple[np.ndarray, list]] = {}
        for i, text in items:
            words = word_hashes(text or "")
            if len(words):
                alike.setdefault(words.tobytes(), (words, []))[1].append(i)
        self.words = [words for words, _ in alike.values()]
        self.ids = [ids for _, ids in alike.values()]
        self.seeds = np.zeros(1 << SEED_BITS, bool)
        for w in self.words:
            self.seeds[shingles(w, SEED) >> U(64 - SEED_BITS)] = True
        self.pieces = [(k, a, b) for k, w in enumerate(self.words) for a, b in pieces(len(w))]
        classes: dict[int, list[int]] = {}
        for p, (_, a, b) in enumerate(self.pieces):
            classes.setdefault(int(2 * np.log2(b - a)), []).append(p)
        self.classes = []
        for members in classes.values():
            width = min(b - a for _, a, b in (self.pieces[p] for p in members))
            edits = max(share(len(self.words[self.pieces[p][0]])) for p in members)
            least = max(1, width - SEED + 1 - SEED * edits) if width >= SEED else 0
            rows = np.stack([self.words[k][a : a + width] for k, a, _ in (self.pieces[p] for p in members)])
            tables = []
            for r in range(REPEATS):
                keys = keys_of(rows, r)
                order = np.argsort(keys, kind="stable")
                tables.append((keys[order], np.array(members)[order]))
            self.classes.append((width, edits, least, tables))

    def windows(self, words: np.ndarray):
        """(class, starts) of the windows of each size of pieces with enough seeds.

        An edit destroys at most ``SEED`` seeds, so a window without that many of the
        benchmark's seeds left can't hold a piece of its size.
        """
        if not len(words):
            return
        hits = np.zeros(len(words) + 1, np.int64)
        if len(words) >= SEED:
            np.cumsum(self.seeds[shingles(words, SEED) >> U(64 - SEED_BITS)], out=hits[1 : len(words) - SEED + 2])
            hits[len(words) - SEED + 2 :] = hits[len(words) - SEED + 1]
            if not hits[-1] and all(c[2] for c in self.classes):
                return
        for c, (width, edits, least, _) in enumerate(self.classes):
            if len(words) < width - edits:
                continue
            starts = np.arange(max(1, len(words) - width + edits + 1))
            ends = np.minimum(starts + width + edits - SEED + 1, len(words))
            alive = starts[hits[np.maximum(ends, starts)] - hits[starts] >= least] if least else starts
            if len(alive):
                yield c, alive

    def search(self, texts: list[str | None]) -> list[list[dict]]:
        """For each text its items with the best place and distance of each."""
        docs = [word_hashes(t or "") for t in texts]
        waiting: dict[int, list[tuple[int, np.ndarray]]] = {}
        near: set[tuple[int, int, int]] = set()

        def flush(c: int) -> None:
            width, _, _, tables = self.classes[c]
            group = waiting.pop(c, [])
            owner = np.concatenate([np.full(len(s), d) for d, s in group])
            starts = np.concatenate([s for _, s in group])
            for lo in range(0, len(owner), WINDOWS):
                own, at = owner[lo : lo + WINDOWS], starts[lo : lo + WINDOWS]
                rows = np.full((len(own), width), PAD, U)
                for i, (d, s) in enumerate(zip(own, at, strict=True)):
                    part = docs[d][s : s + width]
                    rows[i, : len(part)] = part
                for r, (keys, members) in enumerate(tables):
                    found = keys_of(rows, r)
                    left, right = np.searchsorted(keys, found, "left"), np.searchsorted(keys, found, "right")
                    for i in np.flatnonzero(right > left):
                        for p in members[left[i] : right[i]]:
                            near.add((int(own[i]), int(p), int(at[i])))

        pending = dict.fromkeys(range(len(self.classes)), 0)
        for d, words in enumerate(docs):
            for c, alive in self.windows(words):
                waiting.setdefault(c, []).append((d, alive))
                pending[c] += len(alive)
                if pending[c] >= WINDOWS:
                    flush(c)
                    pending[c] = 0
        for c in list(waiting):
            flush(c)

        # Where an item would start by a piece of it that is near enough.
        likely: set[tuple[int, int, int]] = set()
        checked: dict[tuple[int, int], int] = {}
        for d, p, at in sorted(near):
            k, first, end = self.pieces[p]
            e = share(len(self.words[k]))
            # A start within the slack of one that was looked at lies in the same stretch.
            if end - first < len(self.words[k]):
                if checked.get((d, p), -1) >= at:
                    continue
                checked[d, p] = at + e
                lo, hi = max(0, at - 2 * e - 1), at + end - first + 3 * e + 1
                if edit_distance(self.words[k][first:end], docs[d][lo:hi])[0] > e:
                    continue
            likely.add((d, k, at - first))

        best: dict[tuple[int, int], tuple[int, int]] = {}
        checked = {}
        for d, k, at in sorted(likely):
            item, e = self.words[k], allowed(len(self.words[k]))
            if (d, k) in checked and checked[d, k] >= at:
                continue
            lo, hi = max(0, at - 3 * e - 1), max(0, at + len(item) + 4 * e + 1)
            checked[d, k] = at + e
            distance, end = edit_distance(item, docs[d][lo:hi])
            if distance <= e and distance < best.get((d, k), (e + 1,))[0]:
                best[d, k] = (distance, lo + end)
        out: list[list[dict]] = [[] for _ in texts]
        for (d, k), (distance, end) in best.items():
            for i in self.ids[k]:
                out[d].append({"item_id": i, "item_words": len(self.words[k]), "distance": distance, "end_word": end})
        return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The columns of ``docs`` but text, with item_id, item_words, distance and end_word.

    One row per document and item whose words occur in the document with at most one edit
    (a word inserted, left out or changed) per ten words; A-Z are lower-cased and words
    are runs without white space. Items of 2 x ``PIECE`` words and more are cut into pieces
    of ``PIECE`` to 2 x ``PIECE`` words, of which at least one has no more than its share of
    the edits. Windows of the pieces' sizes at every word of the document are embedded and
    looked up in ``REPEATS`` hash tables; a piece found is confirmed by exact edit distance,
    and then its whole item. Recall is meant to be at least ``RECALL`` for an item with all
    the edits it may have, whatever its size and the kind of edits. Items of fewer than ten words must occur unchanged.

    The benchmark is a stated set of queries: ``block_items`` items at a time go to all
    tasks and a pass over the documents looks for them, so no side is shuffled and a task
    holds one block. Null or empty items are never found; items of the same words are looked
    for once and found under each id; null or empty texts hold nothing; repeated rows are
    reported each; empty tables give no rows; columns of ``docs`` that are named as the
    result's are left out.
    """
    items = benchmark.select("item_id", F.col("text").alias("item_text")).filter(F.col("item_text").isNotNull())
    blocks = max(1, -(-items.count() // block_items))
    kind = benchmark.schema["item_id"].dataType.simpleString()
    added = f"leaks array<struct<item_id: {kind}, item_words: int, distance: int, end_word: long>>"
    kept = [c for c in docs.columns if c not in ("text", "item_id", "item_words", "distance", "end_word")]
    found = None
    for b in range(blocks):
        part = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("item_text"), F.lit(blocks)) == b)
        block = [tuple(r) for r in part.collect()]

        def start(block=block):
            known = Items(block)
            return lambda texts: {"leaks": known.search(texts)}

        rows = map_batches(docs, start, added).select(*[F.col(f"`{c}`") for c in kept], F.inline("leaks"))
        found = rows if found is None else found.unionAll(rows)
    return found


def benchmark_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return find_leaks(docs.select("doc_id", "text"), benchmark)


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item; rows alike in id and text go together."""
    leaks = find_leaks(docs.select(row_key().alias("_rl_leak"), "text"), benchmark).select("_rl_leak").distinct()
    return same_columns(docs.withColumn("_rl_key", row_key()).join(leaks, F.col("_rl_key") == F.col("_rl_leak"), "left_anti"), docs)
