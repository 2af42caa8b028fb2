"""A Merkle manifest of a table: every few levels are stored, proofs regenerate those between."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from riskloom.llm.common import ascii_lower
from riskloom.session import pin

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 8  # nodes that become one
STORED = 3  # every how many levels one is stored
SUBTREE = FAN**STORED  # stored nodes below one node of the next stored level
SERIAL_BITS = 33  # of a row number within its partition
PATH = "lefts array<string>, rights array<string>, tops array<string>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def height(n: int) -> int:
    """Levels from a stored level of ``n`` nodes to the next one; a tree ends at one node."""
    levels = 0
    while n > 1 and levels < STORED:
        n, levels = -(-n // FAN), levels + 1
    return levels


def regenerated(nodes: list[str], n: int) -> list[list[str]]:
    """One aligned subtree's levels, from its stored nodes up to its node of the next stored level.

    ``n`` counts the nodes of the whole level, so that all subtrees of a level are as high.
    """
    levels = [nodes]
    for _ in range(height(n)):
        below = levels[-1]
        levels.append([digest("".join(below[i : i + FAN])) for i in range(0, len(below), FAN)])
    return levels


def siblings(levels: list[list[str]], i: int) -> Iterator[tuple[str, str]]:
    """What stands left and right of node ``i`` in its run, level by level."""
    for level in levels[:-1]:
        run = i // FAN * FAN
        yield "".join(level[run:i]), "".join(level[i + 1 : run + FAN])
        i //= FAN


def folded(leaf: str, lefts: Iterable[str], rights: Iterable[str]) -> str:
    """The root that a leaf and its siblings give."""
    for left, right in zip(lefts, rights, strict=True):
        leaf = digest(left + leaf + right)
    return leaf


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows that are sorted by (key, block, pos), one aligned subtree at a time."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for where, group in groupby(rows, key=lambda r: (r["key"], r["block"])):
        yield where, list(group)


def _climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each subtree's node of the next stored level."""
    schema = pa.schema([("key", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("digest", pa.string())])
    for (key, block), rows in _subtrees(batches):
        n = rows[0]["n"]
        top = regenerated([r["digest"] for r in rows], n)[-1][0]
        yield pa.RecordBatch.from_pylist([{"key": key, "pos": block, "n": -(-n // SUBTREE), "digest": top}], schema)


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[str], list[str], list[str]]]:
    """(node, lefts, rights, tops): the path that a subtree inherits comes first among its rows."""
    for _, rows in _subtrees(batches):
        upper, nodes = rows[0], rows[1:]
        if upper["pos"] >= 0:
            raise ValueError("a subtree without the path above it")
        levels = regenerated([r["digest"] for r in nodes], nodes[0]["n"])
        for i, node in enumerate(nodes):
            own = list(siblings(levels, i))
            yield node, [x for x, _ in own] + upper["lefts"], [y for _, y in own] + upper["rights"], upper["tops"]


def _in_batches(rows: Iterator[dict], schema: pa.Schema, size: int = SUBTREE) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _inherit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The path above each node of a stored level; the levels between are discarded."""
    texts = pa.list_(pa.string())
    schema = pa.schema([("key", pa.string()), ("block", pa.int64()), ("name", pa.string()), ("lefts", texts), ("rights", texts), ("tops", texts)])
    found = (
        {"key": node["key"], "block": node["pos"], "name": node["name"], "lefts": lefts, "rights": rights, "tops": tops}
        for node, lefts, rights, tops in _paths(batches)
    )
    yield from _in_batches(found, schema)


def _prove(id_type: pa.DataType):
    text = pa.string()
    names = ("leaf", "subroot", "root", "proof_sha256", "folded_root")
    schema = pa.schema([("id", id_type), *[(name, text) for name in names], ("verified", pa.bool_())])

    def proof(node: dict, lefts: list[str], rights: list[str], tops: list[str]) -> dict:
        root = folded(node["now"] or node["digest"], lefts, rights)
        of_siblings = digest("".join(x for pair in zip(lefts, rights, strict=True) for x in pair))
        values = (node["digest"], tops[0], tops[-1], of_siblings, root)
        return {"id": node["id"], **dict(zip(names, values, strict=True)), "verified": root == tops[-1]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _in_batches((proof(*found) for found in _paths(batches)), schema)

    return run


def _by_subtree(rows: DataFrame) -> DataFrame:
    """A subtree's rows side by side and in order; it has at most ``SUBTREE`` and a path."""
    return rows.repartition("key", "block").sortWithinPartitions("key", "block", "pos")


def placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` with ``pos``, the place in the key's order, and ``n``, the key's nodes.

    One range shuffle sorts all keys at once, so a key with a third of all rows is spread
    like the rest. Places follow from the numbers within partitions and from the counts of
    each key's rows in the partitions before, of which there is one per partition and key.
    """
    by = ["key", *order]
    ranged = nodes.repartitionByRange(*by).sortWithinPartitions(*by)
    numbered = pin(ranged.withColumn("serial", F.monotonically_increasing_id()), "merkle-leaves")
    part = F.shiftright("serial", SERIAL_BITS)
    row = F.col("serial").bitwiseAND((1 << SERIAL_BITS) - 1)
    numbered = numbered.select(*[c for c in numbered.columns if c != "serial"], part.alias("part"), row.alias("row"))
    runs = numbered.groupBy("key", "part").agg(F.count("*").alias("here"), F.min("row").alias("first"))
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        F.col("key").alias("run_key"),
        F.col("part").alias("run_part"),
        (F.coalesce(F.sum("here").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("here").over(Window.partitionBy("key")).alias("n"),
    )
    joined = numbered.join(runs, (F.col("part") == F.col("run_part")) & F.col("key").eqNullSafe(F.col("run_key")))
    return joined.select(*nodes.columns, (F.col("row") + F.col("shift")).alias("pos"), "n")


def _with_block(level: DataFrame) -> DataFrame:
    return level.withColumn("block", F.floor(F.col("pos") / SUBTREE))


def stored_levels(leaves: DataFrame) -> list[DataFrame]:
    """(key, pos, n, digest) of every ``STORED``-th level, up to the one with a node per key."""
    levels = [leaves]
    while (levels[-1].agg(F.max("n")).first()[0] or 0) > 1:
        rows = _by_subtree(_with_block(levels[-1].select("key", "pos", "n", "digest")))
        levels.append(pin(rows.mapInArrow(_climb, "key string, pos long, n long, digest string"), "merkle-level"))
    return levels


def _stream(level: DataFrame, above: DataFrame) -> DataFrame:
    """A stored level's nodes, each subtree behind the path above it."""
    names = [c for c in ("id", "name", "now") if c in level.columns]
    nodes = _with_block(level).select("key", "block", "pos", "n", "digest", *names)
    paths = above.select("key", "block", F.lit(-1).cast("long").alias("pos"), "lefts", "rights", "tops")
    return _by_subtree(nodes.unionByName(paths, allowMissingColumns=True))


def _inherited(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """Paths of a level's nodes, handed down from the tops' paths ``above``."""
    for level in reversed(levels):
        level = level if "name" in level.columns else level.withColumn("name", F.lit(None).cast("string"))
        above = _stream(level, above).mapInArrow(_inherit, f"key string, block long, name string, {PATH}")
        above = pin(above, "merkle-paths")
    return above


@dataclass
class Manifest:
    """The stored levels of each group's tree, and those of the tree over their tops."""

    groups: list[DataFrame]
    tops: list[DataFrame]

    def root(self) -> str | None:
        top = self.tops[-1].first()
        return top["digest"] if top else None

    def proofs(self) -> DataFrame:
        """(id, leaf, subroot, root, proof_sha256, folded_root, verified) of every leaf.

        Paths go down the stored levels. A subtree's task regenerates the levels between
        from the subtree's stored nodes, gives every node its siblings and drops them, so
        no level between is ever written, and only stored levels above the leaves hold
        whole paths.
        """
        empty = F.array().cast("array<string>")
        of_root = self.tops[-1].select(
            "key", F.lit(0).cast("long").alias("block"), empty.alias("lefts"), empty.alias("rights"), F.array("digest").alias("tops")
        )
        down = _inherited(self.tops[:-1] or self.tops, of_root)
        subroots = self.groups[-1].select(F.col("key").alias("group"), F.col("digest").alias("subroot"))
        above = down.join(subroots, F.col("name").eqNullSafe(F.col("group"))).select(
            F.col("group").alias("key"),
            F.lit(0).cast("long").alias("block"),
            "lefts",
            "rights",
            F.concat(F.array("subroot"), "tops").alias("tops"),
        )
        above = _inherited(self.groups[1:-1], above)
        leaves = self.groups[0]
        id_type = leaves.schema["id"].dataType
        schema = f"id {id_type.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        return _stream(leaves, above).mapInArrow(_prove(to_arrow_type(id_type)), schema)


def manifest(docs: DataFrame, group: str = "lang", order: str = "doc_id", fields: tuple = FIELDS, changed: dict | None = None) -> Manifest:
    """The trees over ``docs``: a leaf per row, a tree per ``group``, a tree over their tops.

    A leaf digests the row's ``fields``, each with its byte count. Leaves ascend by
    ``order`` (null first, ties by digest); groups ascend by name (null first, by bytes).
    ``changed`` gives columns by name with which rows are digested again; proofs then fold
    the digest of the row as it became with the siblings as they were.

    Repeated rows are leaves of their own, a group of one row is its own top, an empty
    table has no root and no proofs; further columns are ignored.
    """
    columns = {name: F.col(f"`{name}`") for name in fields}
    now = leaf_digest([(changed or {}).get(name, value) for name, value in columns.items()])
    leaf = leaf_digest(list(columns.values()))
    leaves = docs.select(
        F.col(f"`{group}`").cast("string").alias("key"), F.col(f"`{order}`").alias("id"), leaf.alias("digest"), (now if changed else F.lit(None).cast("string")).alias("now")
    )
    # The copies of a row are spread by their numbers; any order of them gives the same tree.
    leaves = pin(leaves.withColumn("copy", F.monotonically_increasing_id()), "merkle-digests")
    groups = stored_levels(placed(leaves, ["id", "digest", "copy"]).drop("copy"))
    tops = groups[-1].select(F.lit(None).cast("string").alias("key"), F.col("key").alias("name"), "digest")
    return Manifest(groups, stored_levels(placed(tops, ["name"])))


def tampered(text: str = "text", doc_id: str = "doc_id") -> Column:
    """The text with A-Z lower-cased where three divides the checksum of the row's id."""
    chosen = F.crc32(F.col(doc_id).cast("string")) % 3 == 0
    return F.when(chosen, ascii_lower(F.col(text))).otherwise(F.col(text))


def manifest_proofs(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    Rows are tampered with where three divides the checksum of their id (never where the id
    is null); a tampered row without capitals is what it was and verifies. Nulls in any
    column are digested as ``-``, which differs from every value.
    """
    return manifest(docs, changed={"text": tampered()}).proofs().withColumnRenamed("id", "doc_id")


MERKLE_SQL = r"""
WITH RECURSIVE k AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, s: xor(c >> 1, (c & 1) * 3988292384), i)) AS t),
s AS (SELECT *, xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT),
                    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 3 = 0 AS hit FROM {docs}, k),
h AS (SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
             || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS front,
             CASE WHEN hit THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS new_text FROM s),
d AS (SELECT doc_id, lang, sha256(front || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
             sha256(front || coalesce(strlen(new_text) || ':' || new_text, '-')) AS now FROM h),
l AS (SELECT *, row_number() OVER () AS id, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM d),
t AS (SELECT lang, 0 AS lvl, pos, n, leaf AS h FROM l
      UNION ALL SELECT lang, lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM t WHERE n > 1 GROUP BY lang, lvl, pos // 8, n),
g AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS top_pos, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS lvl, top_pos AS pos, n, subroot AS h FROM g
      UNION ALL SELECT lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM u WHERE n > 1 GROUP BY lvl, pos // 8, n),
e AS (SELECT l.id, t.lvl, coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos < l.pos >> (3 * t.lvl)), '') AS a,
             coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos > l.pos >> (3 * t.lvl)), '') AS b
      FROM l JOIN t ON t.lang IS NOT DISTINCT FROM l.lang AND t.n > 1 AND t.pos >> 3 = l.pos >> (3 * t.lvl + 3) GROUP BY ALL),
f AS (SELECT g.lang, u.lvl, coalesce(string_agg(u.h, '' ORDER BY u.pos) FILTER (u.pos < g.top_pos >> (3 * u.lvl)), '') AS a,
             coalesce(string_agg(u.h, '' ORDER BY u.pos) FILTER (u.pos > g.top_pos >> (3 * u.lvl)), '') AS b
      FROM g JOIN u ON u.n > 1 AND u.pos >> 3 = g.top_pos >> (3 * u.lvl + 3) GROUP BY ALL),
p AS (SELECT id, a, b, row_number() OVER (PARTITION BY id ORDER BY tree, lvl) AS k FROM
      (SELECT id, 0 AS tree, lvl, a, b FROM e UNION ALL SELECT l.id, 1, f.lvl, f.a, f.b FROM l JOIN f ON f.lang IS NOT DISTINCT FROM l.lang)),
w AS (SELECT id, 0 AS k, now AS h FROM l UNION ALL SELECT w.id, p.k, sha256(p.a || w.h || p.b) FROM w JOIN p ON p.id = w.id AND p.k = w.k + 1),
z AS (SELECT id, arg_max(h, k) AS folded_root FROM w GROUP BY id),
q AS (SELECT id, sha256(string_agg(a || b, '' ORDER BY k)) AS proof FROM p GROUP BY id),
r AS (SELECT h AS root FROM u WHERE n = 1)
SELECT doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM l JOIN g ON g.lang IS NOT DISTINCT FROM l.lang JOIN z USING (id) LEFT JOIN q USING (id), r
"""
