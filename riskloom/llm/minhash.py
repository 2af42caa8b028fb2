"""Near-duplicates of word shingles by minhash with tensored banding."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.bytewords import U, mix64, shingles, word_hashes
from riskloom.llm.common import SPACES, ascii_lower, map_batches, same_columns, text_or_empty
from riskloom.llm.components import connected_components
from riskloom.session import pin

WORDS = 5
THRESHOLD = (75, 100)
COLLECTIONS, DEPTH = 24, 3  # collections of minhashes, and minhashes in each
BLOCK = 1_000  # documents of a group that meet in one task
CHUNK = 1 << 11  # shingles hashed at once


def _salts() -> np.ndarray:
    return mix64(np.arange(1, COLLECTIONS * DEPTH + 1, dtype=U) * U(0x9E3779B97F4A7C15)) | U(1)


def collections_of(found: np.ndarray) -> np.ndarray:
    """One 64-bit value per collection: equal if all its minhashes are equal."""
    salts = _salts()[:, None]
    least = np.full(len(salts), np.iinfo(U).max, U)
    for at in range(0, len(found), CHUNK):
        part = found[None, at : at + CHUNK] * salts
        part ^= part >> U(32)
        part *= U(0xBF58476D1CE4E5B9)
        part ^= part >> U(29)
        np.minimum(least, part.min(axis=1), out=least)
    grid = least.reshape(COLLECTIONS, DEPTH)
    out = np.arange(COLLECTIONS, dtype=U)
    for k in range(DEPTH):
        out = mix64(out * U(0xD6E8FEB86659FD93) + grid[:, k])
    return out


def sketches(docs: DataFrame) -> DataFrame:
    """``text`` replaced by n_shingles and the collections' values (null without words)."""

    def start():
        def sketch(texts: list) -> dict:
            sizes, values = [], []
            for text in texts:
                found = np.unique(shingles(word_hashes(text or ""), WORDS))
                sizes.append(len(found))
                values.append(collections_of(found).view(np.int64) if len(found) else None)
            return {"n_shingles": sizes, "sketch": values}

        return sketch

    return map_batches(docs, start, "n_shingles long, sketch array<long>")


def verified_links(first: list[np.ndarray], second: list[np.ndarray] | None, marks_a: np.ndarray, marks_b: np.ndarray):
    """Index pairs of one block (or of two) that are linked, enough to connect all that are.

    A pair is compared if two of its collections agree and it isn't connected yet; the
    shingles of one text are marked and counted in all its partners at once.
    """
    inner = second is None
    others = first if inner else second
    flat = np.concatenate(others)
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in others])])
    sizes = np.diff(offsets)
    vocabulary, ids = np.unique(flat, return_inverse=True)
    label = np.arange(len(first) + (0 if inner else len(others)))
    shift = 0 if inner else len(first)
    num, den = THRESHOLD
    mark = np.zeros(len(vocabulary), bool)
    out = []
    for i, own in enumerate(first):
        near = (marks_b == marks_a[i]).sum(axis=1) >= 2
        if inner:
            near[: i + 1] = False
        near &= (label[shift : shift + len(others)] != label[i]) & (den * np.minimum(sizes, len(own)) >= num * np.maximum(sizes, len(own)))
        partners = np.flatnonzero(near)
        if not len(partners):
            continue
        at = np.minimum(np.searchsorted(vocabulary, own), len(vocabulary) - 1)
        at = at[vocabulary[at] == own]
        mark[at] = True
        if len(partners) * 4 < len(others):
            common = np.array([np.count_nonzero(mark[ids[offsets[j] : offsets[j + 1]]]) for j in partners])
        else:
            common = np.add.reduceat(mark[ids].astype(np.int32), offsets[:-1])[partners]
        mark[at] = False
        for j in partners[den * common >= num * (sizes[partners] + len(own) - common)]:
            a, b = label[i], label[shift + j]
            if a != b:
                label[label == max(a, b)] = min(a, b)
                out.append((i, int(j)))
    return out


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (cluster, left, right, side) into links (a, b) of texts."""
    key, rows = None, []

    def links():
        if len(rows) < 2:
            return None
        tables = {s: [r for r in rows if r[0] == s] for s in (0, 1)}
        node = {s: [r[1] for r in tables[s]] for s in tables}
        sets = {s: [np.unique(shingles(word_hashes(r[3] or ""), WORDS)) for r in tables[s]] for s in tables}
        marks = {s: np.array([r[2] for r in tables[s]], np.int64).reshape(-1, COLLECTIONS) for s in tables}
        if not tables[1]:
            found = verified_links(sets[0], None, marks[0], marks[0])
            pairs = [(node[0][i], node[0][j]) for i, j in found]
        elif tables[0]:
            found = verified_links(sets[0], sets[1], marks[0], marks[1])
            pairs = [(node[0][i], node[1][j]) for i, j in found]
        else:
            pairs = []
        if not pairs:
            return None
        return pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*pairs, strict=True)], names=["a", "b"])

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("cluster", "left", "right", "side", "content", "sketch", "text")]
        for cluster, left, right, *rest in zip(*columns, strict=True):
            if (cluster, left, right) != key:
                made = links()
                if made is not None:
                    yield made
                key, rows = (cluster, left, right), []
            rows.append(rest)
    made = links()
    if made is not None:
        yield made


def bucket_hubs(members: DataFrame, key: str) -> DataFrame:
    """(key, hub): the least node of each key that more than one node has."""
    ends = members.groupBy(key).agg(F.min("node").alias("hub"), F.max("node").alias("last"))
    return ends.filter("hub != last").select(key, "hub")


def link_texts(texts: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b) of contents that are linked, enough of them to connect each component.

    ``classes`` has one row per distinct content with its sketch. Any two collections make
    a table key, so ``COLLECTIONS * DEPTH`` minhashes serve 276 tables of six minhashes and
    a pair at the threshold shares a key with probability 0.99996. Collections that no
    other text has can't be part of a common key and are left out before pairs are formed.
    Texts that share a key hang on the bucket's least one, never on each other; the
    components of these hangings are clusters of texts that may be linked. A cluster's
    texts are sent once per block that they meet, and in a pair of blocks the exact shingle
    sets of pairs with a common key are compared until all that belong together are
    connected.
    """
    single = classes.select("node", F.explode("sketch").alias("value"))
    shared = bucket_hubs(single, "value").select("value")
    live = single.join(shared, "value").groupBy("node").agg(F.array_sort(F.collect_list("value")).alias("own"))
    paired = F.flatten(
        F.transform(
            F.col("own"),
            lambda x, i: F.transform(F.slice(F.col("own"), i + 2, COLLECTIONS), lambda y: F.xxhash64(x, y)),
        )
    )
    members = live.select("node", F.explode(paired).alias("key"))
    near = members.join(bucket_hubs(members, "key"), "key").filter("node != hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    clusters = pin(connected_components(pin(near.distinct(), "near")), "clusters")
    sizes = clusters.groupBy("root").agg(F.count("*").alias("n"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    placed = (
        clusters.join(sizes, "root")
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .join(classes.select("node", "content", "sketch"), "node")
        .select("content", "sketch", F.col("root").alias("cluster"), "blocks", "block")
    )
    wanted = texts.join(placed, "content")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    meets = F.transform(every, lambda o: F.struct(F.least("block", o).alias("left"), F.greatest("block", o).alias("right"), (F.col("block") > o).cast("int").alias("side")))
    dealt = wanted.select("content", "sketch", "text", "cluster", F.inline(meets))
    sorted_ = dealt.repartition("cluster", "left", "right").sortWithinPartitions("cluster", "left", "right", "side")
    return sorted_.mapInArrow(_compare, "a string, b string")


def content_of(text: str = "text"):
    """A digest of a text's words: texts that share it have the same shingles."""
    return F.md5(F.trim(F.regexp_replace(ascii_lower(text_or_empty(text)), SPACES, " ")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document.

    A-Z are lower-cased, words are runs without white space, a document's set holds its
    distinct runs of five words, or its whole sequence if it has fewer. Documents are
    linked if 100 |A and B| >= 75 |A or B|, confirmed on full sets. Texts with the same
    words are one class before anything is compared, so copies cost one row.

    ``component_id`` is the smallest doc_id that links reach. Texts without words (null,
    empty, white space) have an empty set and are linked with nothing. Rows with a null id
    take part in links; their component is named by the least id that isn't null, and
    ``kept`` then compares null-safely. Repeated rows keep their rows. An empty table gives
    an empty one; further columns are ignored.
    """
    return judged(docs).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def judged(docs: DataFrame) -> DataFrame:
    """(doc_id, content, n_shingles, component_id, root): root is one content of the component."""
    keyed = docs.select("doc_id", text_or_empty().alias("text"), content_of().alias("content"))
    sketched = pin(sketches(keyed), "sketches")
    classes = pin(
        sketched.filter("n_shingles > 0")
        .groupBy("content")
        .agg(F.min("doc_id").alias("least_id"), F.min("sketch").alias("sketch"))
        .withColumn("node", F.xxhash64("content")),
        "classes",
    )
    # 64 bits are enough to find candidates; links are between whole digests.
    texts = keyed.groupBy("content").agg(F.first("text").alias("text"))
    links = pin(link_texts(texts, classes), "text-links")
    roots = connected_components(links)
    named = pin(roots.join(classes.select(F.col("content").alias("node"), "least_id"), "node"), "named")
    least = named.groupBy("root").agg(F.min("least_id").alias("component"))
    component = named.join(least, "root").select(F.col("node").alias("content"), "component", "root")
    named_classes = classes.join(component, "content", "left").select(
        "content", F.coalesce("component", "least_id").alias("component"), F.coalesce("root", "content").alias("root")
    )
    joined = sketched.select("doc_id", "n_shingles", "content").join(named_classes, "content", "left")
    return joined.select(
        "doc_id",
        "content",
        "n_shingles",
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
        F.coalesce("root", "content").alias("root"),
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each group: the one with the smallest id, once even if repeated.

    Rows without words stay unless id and words are repeated. Of a group without any id
    one row stays, that of its least content; an id that is repeated with texts of
    different groups stays once in each.
    """
    first = (
        judged(docs)
        .filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root", F.col("doc_id").alias("_rl_id"))
        .agg(F.min("content").alias("_rl_first"))
        .drop("root")
    )
    keyed = docs.withColumn("_rl_content", content_of())
    same_row = F.col("doc_id").eqNullSafe(F.col("_rl_id")) & (F.col("_rl_content") == F.col("_rl_first"))
    stays = keyed.join(first, same_row, "left_semi").dropDuplicates(["doc_id", "_rl_content"])
    return same_columns(stays, docs)
