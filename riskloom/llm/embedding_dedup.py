"""Near-duplicate vectors by randomised-rotation binary codes with correction factors."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import map_batches
from riskloom.llm.components import connected_components
from riskloom.session import pin

COSINE = 0.93
RECALL = 0.998  # of pairs at the threshold, by the hash tables
CONFIDENCE = 4.0  # standard errors that an estimate may be off before it decides alone
OCCUPANCY = 64  # vectors of a label per bucket, about
BLOCK = 1_000  # vectors of a bucket that meet in one task
TURNED = 512  # vectors that are rotated in one product
SHORT = 8  # dimensions below which codes say too little


@lru_cache(maxsize=64)
def rotation(dim: int, number: int) -> np.ndarray:
    """A random orthogonal matrix that depends on its dimension and number alone; made once per task."""
    q, r = np.linalg.qr(np.random.default_rng([11, dim, number]).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def tables_for(largest: int) -> tuple[int, int]:
    """(bits of a key, tables): keys get longer with the largest label, tables keep the recall.

    Two vectors at an angle a agree in a rotated sign with probability 1 - a / pi.
    """
    bits = min(24, max(4, math.ceil(math.log2(max(2, largest / OCCUPANCY)))))
    hit = (1 - math.acos(COSINE) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - RECALL) / math.log(1 - hit))


def codes(vectors: DataFrame, bits: int, tables: int) -> DataFrame:
    """``embedding`` replaced by its bytes, code, correction factor and table keys.

    The code is the signs of the rotated unit vector; the factor is the inner product of
    that vector with its own code, scaled to unit length.
    """
    wide = "double" in vectors.schema["embedding"].dataType.simpleString()

    def start():
        def of_one_size(v: np.ndarray) -> tuple:
            """Code, factor and keys of vectors (a row each) of the same dimension."""
            dim = v.shape[1]
            v = v / np.abs(v).max(axis=1, keepdims=True)
            unit = v / np.linalg.norm(v, axis=1, keepdims=True)
            turned = unit @ rotation(dim, 0).T
            # Keys come from other rotations, so they say nothing about the code's error.
            others = [unit @ rotation(dim, 1 + i).T >= 0 for i in range(-(-tables * bits // dim))]
            own = np.concatenate(others, axis=1)[:, : tables * bits].reshape(len(v), tables, bits)
            code = [row.tobytes() for row in np.packbits(turned >= 0, axis=1)]
            return code, np.abs(turned).sum(axis=1) / math.sqrt(dim), own @ (1 << np.arange(bits))

        def encode(rows: list) -> dict:
            vectors = [np.asarray(row, np.float64) for row in rows]
            out = {"raw": [v.astype(np.float64 if wide else np.float32).tobytes() for v in vectors]}
            out |= {name: [None] * len(rows) for name in ("code", "factor", "keys")}
            for dim in {len(v) for v in vectors}:
                at = [i for i, v in enumerate(vectors) if len(v) == dim]
                for first in range(0, len(at), TURNED):
                    here = at[first : first + TURNED]
                    for i, code, factor, keys in zip(here, *of_one_size(np.stack([vectors[i] for i in here])), strict=True):
                        out["code"][i], out["factor"][i], out["keys"][i] = code, float(factor), keys.tolist()
            return out

        return encode

    return map_batches(vectors, start, "raw binary, code binary, factor double, keys array<int>", over="embedding")


class Side:
    """The vectors of one block of a bucket."""

    def __init__(self, rows: list[tuple], dim: int):
        node, copies, raw, code, factor, keys = zip(*rows, strict=True)
        self.node, self.copies = node, np.array(copies, np.int64)
        kind = np.float32 if len(raw[0]) == 4 * dim else np.float64
        v = np.frombuffer(b"".join(raw), kind).reshape(len(rows), dim).astype(np.float64)
        v /= np.abs(v).max(axis=1, keepdims=True)
        self.unit = v / np.linalg.norm(v, axis=1, keepdims=True)
        packed = np.frombuffer(b"".join(code), np.uint8).reshape(len(rows), -1)
        self.signs = np.unpackbits(packed, axis=1)[:, :dim].astype(np.float32) * 2 - 1
        self.factor, self.keys = np.array(factor), np.array(keys, np.int32)


def linked_pairs(left: Side, right: Side, dim: int) -> np.ndarray:
    """Which pairs have a cosine of at least ``COSINE``.

    <code, q> / factor estimates <o, q> without bias; its error has a standard deviation of
    sqrt(1 - <o, q>^2) sqrt(1 / factor^2 - 1) / sqrt(dim - 1). A pair at or over the
    threshold lies below the estimate's lower end with negligible chance, so lower ones go;
    all others are computed again in double precision.
    """
    if dim < SHORT:
        return left.unit @ right.unit.T >= COSINE
    turned = (right.unit @ rotation(dim, 0).T).astype(np.float32)
    estimate = (left.signs @ turned.T) / (math.sqrt(dim) * left.factor[:, None])
    slack = CONFIDENCE * math.sqrt(1 - COSINE**2) * np.sqrt(np.maximum(0, 1 / left.factor**2 - 1)) / math.sqrt(dim - 1)
    i, j = np.nonzero(estimate >= (COSINE - slack)[:, None])
    found = np.zeros(estimate.shape, bool)
    for at in range(0, len(i), 100_000):
        a, b = i[at : at + 100_000], j[at : at + 100_000]
        found[a, b] = np.einsum("ij,ij->i", left.unit[a], right.unit[b]) >= COSINE
    return found


def _least_labels(linked: np.ndarray) -> np.ndarray:
    """Each row's component in a symmetric Boolean matrix, named by its least row."""
    label = np.arange(len(linked))
    todo = linked.any(axis=1)
    for i in range(len(linked)):
        if not todo[i]:
            continue
        reached = np.zeros(len(linked), bool)
        edge = np.zeros(len(linked), bool)
        edge[i] = reached[i] = True
        while edge.any():
            edge = linked[edge].any(axis=0) & ~reached
            reached |= edge
        label[reached] = i
        todo &= ~reached
    return label


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (bucket, left, right, side) into (a, b, n): n links of a, b connected with it."""
    group = ("label", "dim", "number", "key", "left", "right")
    columns = (*group, "side", "node", "copies", "raw", "code", "factor", "keys")
    key, rows = None, []

    def result():
        sides = [[r[1:] for r in rows if r[0] == s] for s in (0, 1)]
        pair = key[4] != key[5]
        if (pair and not (sides[0] and sides[1])) or len(rows) < 2:
            return None
        dim, number = key[1], key[2]
        left = Side(sides[0], dim)
        right = Side(sides[1], dim) if pair else left
        linked = linked_pairs(left, right, dim)
        if not pair:
            linked |= linked.T
            np.fill_diagonal(linked, False)
        # A pair is counted in the first table that it meets in.
        i, j = np.nonzero(linked)
        new = ~(left.keys[i, :number] == right.keys[j, :number]).any(axis=1)
        i, j = i[new], j[new]
        counts = [np.bincount(i, right.copies[j], len(left.node))]
        nodes = list(left.node)
        if pair:
            counts.append(np.bincount(j, left.copies[i], len(right.node)))
            nodes += right.node
            n = len(left.node)
            whole = np.zeros((len(nodes), len(nodes)), bool)
            whole[:n, n:] = linked
            whole[n:, :n] = linked.T
            linked = whole
        label = _least_labels(linked)
        n = np.concatenate(counts).astype(np.int64)
        out = np.flatnonzero((n > 0) | (label != np.arange(len(label))))
        if not len(out):
            return None
        arrays = [pa.array([nodes[x] for x in out]), pa.array([nodes[label[x]] for x in out]), pa.array(n[out])]
        return pa.RecordBatch.from_arrays(arrays, names=["a", "b", "n"])

    for batch in batches:
        for values in zip(*[batch.column(c).to_pylist() for c in columns], strict=True):
            if values[: len(group)] != key:
                made = result() if rows else None
                if made is not None:
                    yield made
                key, rows = values[: len(group)], []
            rows.append(values[len(group) :])
    made = result() if rows else None
    if made is not None:
        yield made


def bucket_links(coded: DataFrame) -> DataFrame:
    """(a, b, n) from every bucket; a large one is dealt out as pairs of blocks."""
    bucket = ["label", "dim", "number", "key"]
    members = coded.select("label", "dim", F.posexplode("keys").alias("number", "key"), "node", "copies", "raw", "code", "factor", "keys")
    narrow = coded.select("label", "dim", F.posexplode("keys").alias("number", "key"))
    sizes = narrow.groupBy(*bucket).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), F.count("*").alias("n"))
    placed = members.join(sizes.filter("n > 1").drop("n"), bucket).withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    meets = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda o: F.struct(F.least("block", o).alias("left"), F.greatest("block", o).alias("right"), (F.col("block") > o).cast("int").alias("side")),
    )
    dealt = placed.select(*bucket, "node", "copies", "raw", "code", "factor", "keys", F.inline(meets))
    order = [*bucket, "left", "right"]
    return dealt.repartition(*order).sortWithinPartitions(*order, "side").mapInArrow(_compare, "a string, b string, n long")


def near_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector.

    Vectors with the same label (not null) and length are linked if their cosine is at
    least ``COSINE``. Equal vectors of a label are one class before anything is compared and
    are linked with each other. Signs under further random rotations give the keys of
    hash tables, so a pair at the threshold meets with probability ``RECALL``; in a bucket,
    code estimates and their confidence bounds decide which pairs are computed exactly. All
    vectors are indexed.

    Vectors that are null, empty, zero or hold null or non-finite components, and those
    without a label, have no links and are components of their own. Repeated rows keep
    their rows and are linked as copies. Rows with a null id take part; a component is
    named by its least id that isn't null. An empty table gives an empty one; further
    columns are ignored.
    """
    rows = vectors.select("vec_id", "label", "embedding")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    sound = (
        F.col("label").isNotNull()
        & F.coalesce(F.forall("embedding", finite), F.lit(False))
        & F.coalesce(F.exists("embedding", lambda x: x != 0), F.lit(False))
    )
    # Two hashes make a digest of 128 bits.
    node = F.when(sound, F.concat(F.hex(F.xxhash64("label", "embedding")), F.lit("-"), F.hex(F.xxhash64("embedding", F.lit(7), "label"))))
    keyed = rows.withColumn("node", node)
    classes = (
        keyed.filter(F.col("node").isNotNull())
        .groupBy("label", "embedding", "node")
        .agg(F.min("vec_id").alias("least_id"), F.count("*").alias("copies"))
        .withColumn("dim", F.size("embedding"))
    )
    largest = classes.groupBy("label", "dim").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    coded = pin(codes(classes, *tables_for(largest)), "codes")
    found = pin(bucket_links(coded), "vector-links")
    counts = found.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    roots = connected_components(found.filter("a != b").select("a", "b"))
    own = coded.select("node", "least_id", "copies")
    named = pin(own.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "vector-roots")
    least = named.groupBy("root").agg(F.min("least_id").alias("component"))
    table = named.join(least, "root").join(counts, "node", "left").select(
        "node", "component", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n")
    )
    joined = keyed.select("vec_id", "node").join(table, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return joined.select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id")
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
