"""Boosted trees of a whole parameter grid, many configurations grown at once.

Second-order boosting of the logistic loss with L2 leaf penalties, on binned features.
Configurations of a grid that share rows, columns and depth grow together: one pass over
the rows fills one split-histogram table (configuration, node, feature, bin), from which
every configuration's best splits of a level are read. Such groups, one per fold, are the
tasks that Spark spreads; each passes over all rows, span by span, from files in the shared
folder, so rows are neither shuffled to the tasks nor held by them. Every held-out row is
scored, by a co-group of groups' trees and blocks of rows.
"""

from __future__ import annotations

import io
import itertools
import math
import os
import tempfile
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.constants import BOOSTED_GRID, ROW_ID
from riskloom.functions.running import running_totals
from riskloom.session import pin

# The defaults under which the grid's other parameters are searched.
ETA, PENALTY, ROUNDS, LEAST_GAIN = 0.3, 1.0, 100, 1e-6
BINS = 64  # of a feature, at most
BLOCK = 100_000  # rows that a group's trees score in one task
CHUNK = 32_768  # rows whose bytes pass through a tree together
PLANNED = 10  # rounds whose trees are unfolded together
MASKED = 64  # leaves of a tree up to which its rows are placed by byte masks
SPAN = 65_536  # rows of a pass that are worked on together
HELD_ROWS = 1_000_000  # of a task's columns that stay in memory; more lie in a scratch file
CELLS = 256  # joint values of features that are counted together
FEW_VALUES = 10_000  # of a column, whose counts reach the driver
SHARED = ("max_depth", "subsample", "colsample_bytree")  # what configurations of a group share


def mixed(values: np.ndarray, seed: int) -> np.ndarray:
    """A number in [0, 1) from each integer and the seed."""
    h = values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((seed * 0xD1342543DE82EF95 + 1) % 2**64)
    for shift in (30, 27, 31):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(11)) / float(1 << 53)


@dataclass
class Bins:
    """Cut points of every feature: value x falls into the bin that counts the cuts below x."""

    edges: list[np.ndarray]

    @staticmethod
    def of(rows: DataFrame, p: int, most: int = BINS) -> "Bins":
        """Exact quantiles of a table's ``x``: equal values are counted, ranks found by running totals."""
        cells = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.col("x")[j].alias("value")) for j in range(p)])).alias("c")
        counts = pin(rows.select(cells).select("c.*").filter("value IS NOT NULL").groupBy("j", "value").agg(F.count("*").alias("n")), "boost-values")
        sizes = {r["j"]: r for r in counts.groupBy("j").agg(F.count("*").alias("values"), F.sum("n").alias("n"), F.max("value").alias("top")).collect()}
        few = [j for j, r in sizes.items() if r["values"] <= FEW_VALUES]
        known = {j: g.sort_values("value") for j, g in counts.filter(F.col("j").isin(few)).toPandas().groupby("j")}
        edges = [np.empty(0)] * p
        for j, size in sizes.items():
            spots = [(size["n"] - 1) * i / most for i in range(1, most)]
            wanted = sorted({r for spot in spots for r in (math.floor(spot), math.ceil(spot))})
            if j in known:
                upto = known[j]["n"].cumsum().to_numpy()
                at = dict(zip(wanted, known[j]["value"].to_numpy()[np.searchsorted(upto, wanted, side="right")]))
            else:
                totals = running_totals(counts.filter(F.col("j") == j).select("value", "n"), "value", ["n"])
                inside = lambda r: (F.col("upto_n") > r) & (F.col("upto_n") - F.col("n") <= r)
                hit = totals.filter(F.exists(F.array(*[F.lit(r) for r in wanted]), inside)).collect()
                at = {r: h["value"] for h in hit for r in wanted if h["upto_n"] - h["n"] <= r < h["upto_n"]}
            between = lambda spot, low, high: at[low] if at[low] == at[high] else (high - spot) * at[low] + (spot - low) * at[high]
            quantiles = {between(spot, math.floor(spot), math.ceil(spot)) for spot in spots}
            edges[j] = np.array(sorted(q for q in quantiles if q < size["top"]))
        return Bins(edges)

    @property
    def widths(self) -> np.ndarray:
        return np.array([len(e) + 1 for e in self.edges])

    def place(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(self.edges)], axis=1).astype(np.uint8)


def tree_plan(node: int, feature: list, cut: list, left: list, right: list, leaves: list):
    """The tree below ``node`` as ((feature, cut), left, right), a leaf as its place in ``leaves``."""
    if feature[node] < 0:
        leaves.append(node)
        return len(leaves) - 1
    below = [tree_plan(child, feature, cut, left, right, leaves) for child in (left[node], right[node])]
    return (feature[node], cut[node]), *below


def leaf_places(plan, goes_right, kind: np.dtype):
    """Each row's leaf, by its place: both sides are taken through all rows, and the bits of
    ``goes_right`` (0 or -1) choose between them."""
    if not isinstance(plan, tuple):
        return plan
    test, left, right = plan
    left, right = leaf_places(left, goes_right, kind), leaf_places(right, goes_right, kind)
    return left ^ (goes_right(test).astype(kind, copy=False) & (left ^ right))


def place_type(n_leaves: int) -> np.dtype:
    return np.dtype(np.int8 if n_leaves <= 128 else np.int16 if n_leaves <= 32_768 else np.int32)


def remembered(test):
    """``test(feature, cut)`` as 0 or -1 per row, worked out once for each cut."""
    known: dict = {}

    def goes_right(at: tuple) -> np.ndarray:
        if at not in known:
            known[at] = -test(*at).view(np.int8)
        return known[at]

    return goes_right


@dataclass
class Trees:
    """A group's trees: each round's nodes in one table, and each configuration's root in it.

    Configurations whose trees are the same share them.
    """

    feature: np.ndarray  # -1 at a leaf
    cut: np.ndarray
    left: np.ndarray  # the right child is the next node
    value: np.ndarray
    starts: np.ndarray  # of each round's nodes
    roots: np.ndarray | None = None  # (round, configuration); without them a round's first nodes

    def dump(self) -> bytes:
        buffer = io.BytesIO()
        named = {k: v for k, v in vars(self).items() if v is not None}
        np.savez_compressed(buffer, **named)
        return buffer.getvalue()

    @staticmethod
    def load(data: bytes) -> "Trees":
        return Trees(**np.load(io.BytesIO(data)))

    def margins(self, bins: np.ndarray, configurations: int) -> np.ndarray:
        """(configuration, row): the sum of the trees' leaf values."""
        out = np.zeros((configurations, len(bins)))
        for first in range(0, len(self.starts) - 1, PLANNED):
            plans = [plan for turn in range(first, min(first + PLANNED, len(self.starts) - 1)) for plan in self._plans(turn, configurations)]
            for at in range(0, len(bins), CHUNK):
                rows = bins[at : at + CHUNK]
                columns = np.ascontiguousarray(rows.T)
                goes_right = remembered(lambda feature, cut: columns[feature] > cut)
                for members, plan, value, kind in plans:
                    found = value[leaf_places(plan, goes_right, kind) if kind else walked(rows, *plan)]
                    for i in members:
                        out[i, at : at + CHUNK] += found
        return out

    def _plans(self, turn: int, configurations: int) -> list[tuple]:
        """(configurations, plan, values by leaf, kind) of a round's distinct trees; a tree of
        many leaves is its node table, values are by node and there is no kind."""
        nodes = slice(self.starts[turn], self.starts[turn + 1])
        feature, cut, left, value = self.feature[nodes], self.cut[nodes], self.left[nodes], self.value[nodes]
        roots = np.arange(configurations) if self.roots is None else self.roots[turn]
        sharing: dict[int, list[int]] = {}
        for i, root in enumerate(roots.tolist()):
            sharing.setdefault(root, []).append(i)
        lists = [x.tolist() for x in (feature, cut, left, left + 1)]
        out = []
        for root, members in sharing.items():
            leaves: list[int] = []
            plan = tree_plan(root, *lists, leaves)
            if len(leaves) <= MASKED:
                out.append((members, plan, value[leaves], place_type(len(leaves))))
            else:
                out.append((members, (root, feature, cut, left), value, None))
        return out


def walked(rows: np.ndarray, root: int, feature: np.ndarray, cut: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The leaf, by its node, that each row comes to below ``root``."""
    at = np.full(len(rows), root)
    while route(rows, at, feature, cut, left):
        pass
    return at


def route(rows: np.ndarray, at: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray) -> int:
    """Moves rows at inner nodes to a child, in ``at``; how many there were."""
    asked = feature[at]
    moving = np.flatnonzero(asked >= 0)
    if len(moving):
        node = at[moving]
        at[moving] = left[node] + (rows.reshape(-1)[moving * rows.shape[1] + asked[moving]] > cut[node])
    return len(moving)


def best_splits(grad: np.ndarray, hess: np.ndarray, widths: np.ndarray, allowed: np.ndarray, least: np.ndarray):
    """The best split of each node from its histograms (node, bin of all features side by side).

    Returns gain, position among all bins, and the left child's sums; the lowest position
    wins among equal gains. ``least`` is the hessian that each child needs.
    """
    ends = np.cumsum(widths)
    starts = ends - widths
    feature = np.repeat(np.arange(len(widths)), widths)
    total_g, total_h = grad[:, : widths[0]].sum(axis=1, keepdims=True), hess[:, : widths[0]].sum(axis=1, keepdims=True)

    def lefts(x: np.ndarray) -> np.ndarray:
        upto = np.cumsum(x, axis=1)
        return upto - np.where(starts > 0, upto[:, np.maximum(starts - 1, 0)], 0.0)[:, feature]

    left_g, left_h = lefts(grad), lefts(hess)
    right_g, right_h = total_g - left_g, total_h - left_h
    gain = left_g**2 / (left_h + PENALTY) + right_g**2 / (right_h + PENALTY) - total_g**2 / (total_h + PENALTY)
    fits = allowed[feature] & (left_h >= least[:, None]) & (right_h >= least[:, None])
    fits[:, ends - 1] = False
    # Sums of equal rows in another order differ by rounding only; such gains are ties.
    gain = np.where(fits, np.round(gain, 9), -np.inf)
    at = gain.argmax(axis=1)
    lines = np.arange(len(at))
    return gain[lines, at], at, left_g[lines, at], left_h[lines, at], total_g[:, 0], total_h[:, 0]


def held(n: int, kind: type, wide: tuple[int, ...] = ()) -> np.ndarray:
    """Room for ``n`` rows: in memory, or beyond ``HELD_ROWS`` in a scratch file that goes with the array."""
    if n <= HELD_ROWS:
        return np.empty((n, *wide), kind)
    folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
    return np.memmap(tempfile.TemporaryFile(dir=folder if os.path.isdir(folder) else None), kind, "w+", shape=(n, *wide)).view(np.ndarray)


def spans(n: int) -> list[slice]:
    return [slice(at, min(at + SPAN, n)) for at in range(0, n, SPAN)]


def bundles(widths: np.ndarray) -> list[list[int]]:
    """Features whose bins are counted together: a bundle has at most ``CELLS`` joint values."""
    out: list[tuple[list[int], int]] = []
    for j in np.argsort(-widths, kind="stable").tolist():
        for k, (members, size) in enumerate(out):
            if size * widths[j] <= CELLS:
                out[k] = ([*members, j], size * int(widths[j]))
                break
        else:
            out.append(([j], int(widths[j])))
    return [members for members, _ in out]


class Histograms:
    """Sums of rows by node and bin, from the joint values of bundles of features."""

    def __init__(self, bins: np.ndarray, widths: np.ndarray):
        self.size, starts = int(widths.sum()), np.cumsum(widths) - widths
        self.codes, self.spread = [], []
        for members in bundles(widths):
            ways = np.cumprod([1, *widths[members]])
            code = held(len(bins), np.uint8)
            for s in spans(len(bins)):
                code[s] = bins[s][:, members].astype(int) @ ways[:-1]
            values, spots = np.arange(ways[-1]), np.concatenate([starts[j] + np.arange(widths[j]) for j in members])
            joint = [values[:, None] // way % widths[j] == np.arange(widths[j]) for j, way in zip(members, ways)]
            self.codes.append(code)
            self.spread.append((spots, np.concatenate(joint, axis=1).astype(float)))

    def of(self, slot: np.ndarray, nodes: int, at: np.ndarray, *weights: np.ndarray) -> list[np.ndarray]:
        """(node, bin of all features side by side) of each weight, over rows whose ``slot[at]`` isn't negative."""
        cells = [[np.zeros(nodes * CELLS) for _ in weights] for _ in self.codes]
        for s in spans(len(at)):
            here = slot[at[s]]
            rows = np.flatnonzero(here >= 0)
            if not len(rows):
                continue
            whole = len(rows) == len(here)
            here = here * CELLS if whole else here[rows] * CELLS
            asked = [w[s] if whole else w[s][rows] for w in weights]
            for code, found in zip(self.codes, cells):
                keys = here + (code[s] if whole else code[s][rows])
                for total, w in zip(found, asked):
                    total += np.bincount(keys, w, nodes * CELLS)
        out = [np.empty((nodes, self.size)) for _ in weights]
        for found, (spots, joint) in zip(cells, self.spread):
            for total, cell in zip(out, found):
                total[:, spots] = cell.reshape(nodes, CELLS)[:, : len(joint)] @ joint
        return out


@dataclass
class _Grown:
    """A tree before it is pruned, root first; rows' leaves are beside it."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    parent: np.ndarray
    gains: np.ndarray
    sums: np.ndarray
    lightest: float  # hessian of its lightest child

    def pruned(self, gamma: float) -> np.ndarray:
        """``feature`` without the splits whose gain is under ``gamma`` and whose children are leaves."""
        feature = self.feature.copy()
        weak = self.gains < gamma
        if (weak & (feature >= 0)).any():
            for node in np.flatnonzero(feature >= 0)[::-1]:
                if weak[node] and feature[self.left[node]] < 0 and feature[self.left[node] + 1] < 0:
                    feature[node] = -1
        return feature

    def leaf_values(self, feature: np.ndarray) -> np.ndarray:
        """By node: the value that rows of the unpruned leaf get."""
        stays = np.arange(len(feature))
        if not np.array_equal(feature, self.feature):
            for node in range(1, len(feature)):
                if feature[self.parent[node]] < 0:
                    stays[node] = stays[self.parent[node]]
        return self.values[stays]

    @property
    def values(self) -> np.ndarray:
        return -ETA * self.sums[:, 0] / (self.sums[:, 1] + PENALTY)


def _grown(bins, sums, widths, allowed, depth, least, grad, hess, at) -> _Grown:
    """One configuration's next tree; ``at`` becomes the leaf of each row."""
    starts_of, feature_of = np.cumsum(widths) - widths, np.repeat(np.arange(len(widths)), widths)
    feature, cut, left, parent = np.full(1, -1, np.int16), np.zeros(1, np.int16), np.zeros(1, np.int32), np.full(1, -1)
    gains, totals, lightest = np.zeros(1), np.zeros((1, 2)), np.inf
    for s in spans(len(at)):
        at[s] = 0
        totals[0] += grad[s].sum(), hess[s].sum()
    frontier = np.arange(1)
    for _ in range(depth):
        # Two children need twice the least; what rounding may have taken is allowed for.
        frontier = frontier[totals[frontier, 1] >= 2 * least * (1 - 1e-9)]
        if not len(frontier):
            break
        slot = np.full(len(feature), -1)
        slot[frontier] = np.arange(len(frontier))
        g, h = sums.of(slot, len(frontier), at, grad, hess)
        gain, spot, left_g, left_h, total_g, total_h = best_splits(g, h, widths, allowed, np.full(len(frontier), least))
        good = gain > LEAST_GAIN
        if not good.any():
            break
        split = frontier[good]
        first, added = len(feature) + 2 * np.arange(len(split)), 2 * len(split)
        feature[split], cut[split] = feature_of[spot[good]], (spot - starts_of[feature_of[spot]])[good]
        left[split], gains[split] = first, gain[good]
        feature = np.concatenate([feature, np.full(added, -1, np.int16)])
        cut, left = np.concatenate([cut, np.zeros(added, np.int16)]), np.concatenate([left, np.zeros(added, np.int32)])
        gains, parent = np.concatenate([gains, np.zeros(added)]), np.concatenate([parent, np.repeat(split, 2)])
        children = np.stack([left_g, left_h, total_g - left_g, total_h - left_h], axis=1)[good].reshape(-1, 2)
        totals, lightest = np.concatenate([totals, children]), min(lightest, children[:, 1].min())
        for s in spans(len(at)):
            route(bins[s], at[s], feature, cut, left)
        frontier = np.arange(first[0], len(feature))
    return _Grown(feature, cut, left, parent, gains, totals, lightest)


def grow(bins: np.ndarray, labels: np.ndarray, ids: np.ndarray, widths: np.ndarray, depth: int, subsample: float, columns: float,
         least: np.ndarray, gamma: np.ndarray, rounds: int = ROUNDS, seed: int = 2) -> Trees:
    """The trees of ``len(least)`` configurations that differ in least child weight and gain.

    Each round draws its rows and features by hashes, so a configuration's trees don't
    depend on which others grow with it, and larger shares hold the smaller ones' draws.
    A split whose gain is under ``gamma`` goes once both its children are leaves.
    Configurations whose trees have all been the same so far have the same margins and grow
    as one; a tree whose lightest child weighs enough is also that of a larger least weight.
    Rows are passed over in spans; what is kept of each is a margin for each set of such
    configurations, its gradients and its leaf.
    """
    count, n, p = len(least), len(bins), len(widths)
    sums = Histograms(bins, widths)
    grad, hess, drawn, at = held(n, np.float64), held(n, np.float64), held(n, bool), held(n, np.int32)
    spare: list[np.ndarray] = []
    start = held(n, np.float64)
    for s in spans(n):
        start[s] = 0.0
    alike = [(start, list(range(count)))]
    made: list[tuple] = []
    roots = np.zeros((rounds, count), np.int32)
    for turn in range(rounds):
        for s in spans(n):
            drawn[s] = mixed(np.asarray(ids[s]), seed * 1009 + turn) < subsample
        order = np.argsort(mixed(np.arange(p), seed * 9176 + turn), kind="stable")
        allowed = np.zeros(p, bool)
        allowed[order[: max(1, int(columns * p))]] = True
        tables: list[tuple] = []
        size, after = 0, []
        for margins, members in alike:
            for s in spans(n):
                chance = 1 / (1 + np.exp(-margins[s]))
                grad[s], hess[s] = (chance - labels[s]) * drawn[s], chance * (1 - chance) * drawn[s]
            tree = None
            for weight in sorted({least[i] for i in members}):
                if tree is None or tree.lightest < weight:
                    tree, pruned = _grown(bins, sums, widths, allowed, depth, weight, grad, hess, at), {}
                for i in (i for i in members if least[i] == weight):
                    feature = tree.pruned(gamma[i])
                    key = feature.tobytes()
                    if key not in pruned:
                        value, moved = tree.leaf_values(feature), spare.pop() if spare else held(n, np.float64)
                        for s in spans(n):
                            moved[s] = margins[s] + value[at[s]]
                        pruned[key] = (size, [])
                        after.append((moved, pruned[key][1]))
                        tables.append((feature, tree.cut, tree.left + np.int32(size), tree.values))
                        size += len(feature)
                    roots[turn, i] = pruned[key][0]
                    pruned[key][1].append(i)
            spare.append(margins)
        alike = after
        made.append(tuple(np.concatenate(parts) for parts in zip(*tables)))
    starts = np.cumsum([0] + [len(m[0]) for m in made])
    return Trees(*[np.concatenate(parts) for parts in zip(*made)], starts, roots)


def binned(rows: DataFrame, cuts: Bins, keep: tuple[str, ...]) -> DataFrame:
    """``keep`` and ``bins``, a byte per feature."""
    schema = rows.select(*keep).schema

    def place(batches):
        for pdf in batches:
            if len(pdf):
                yield pdf[list(keep)].assign(bins=[b.tobytes() for b in cuts.place(np.stack(pdf["x"].to_numpy()))])

    return rows.select(*keep, "x").mapInPandas(place, schema.add("bins", "binary"))


def packed(rows: DataFrame, blocks: int) -> DataFrame:
    """(fold, block, bins): the bytes of a fold's rows, whose hashed ids deal them to blocks, one after another."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf[["fold", "block"]].iloc[:1].assign(bins=[b"".join(pdf["bins"])])

    dealt = rows.select("fold", F.pmod(F.xxhash64(ROW_ID), F.lit(blocks)).cast("bigint").alias("block"), "bins")
    return dealt.groupBy("fold", "block").applyInPandas(pack, "fold int, block bigint, bins binary")


def grid_groups(points: list[dict]) -> list[tuple[dict, list[int]]]:
    """(shared parameters, grid indexes) of the points that can grow together."""
    found: dict[tuple, list[int]] = {}
    for i, point in enumerate(points):
        found.setdefault(tuple(point[k] for k in SHARED), []).append(i)
    return [(dict(zip(SHARED, key)), members) for key, members in found.items()]


def _batches(files: list[str], columns: list[str]):
    """Record batches of parquet files in the shared folder, read where a task runs."""
    for uri in files:
        if urlparse(uri).scheme in ("", "file"):
            source, path = fs.LocalFileSystem(), unquote(urlparse(uri).path)
        else:
            source, path = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://"))
        with source.open_input_file(path) as opened:
            yield from pq.ParquetFile(opened).iter_batches(SPAN, columns=columns)


def _outside(files: list[str], fold: int | None, p: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bins, labels, ids) of the rows outside a fold, in the files' order. A missing fold is no fold."""
    inside = lambda batch: batch.column("fold").fill_null(-1).to_numpy(zero_copy_only=False) == (-2 if fold is None else fold)
    n = sum(int((~inside(b)).sum()) for b in _batches(files, ["fold"]))
    bins, labels, ids = held(n, np.uint8, (p,)), held(n, np.float64), held(n, np.int64)
    at = 0
    for batch in _batches(files, [ROW_ID, "fold", "label", "bins"]):
        kept = np.flatnonzero(~inside(batch))
        to = slice(at, at + len(kept))
        whole = batch.column("bins").cast(pa.large_binary())
        offsets = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
        data = np.frombuffer(whole.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        bins[to] = data.reshape(-1, p)[kept]
        labels[to] = batch.column("label").cast(pa.float64()).to_numpy(zero_copy_only=False)[kept]
        ids[to] = batch.column(ROW_ID).cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)[kept]
        at = to.stop
    return bins, labels, ids


def ordered(rows: DataFrame) -> DataFrame:
    """Rows by their id, in files that follow each other."""
    return rows.repartitionByRange(ROW_ID).sortWithinPartitions(ROW_ID)


def fit_groups(learned: DataFrame, cuts: Bins, points: list[dict], folds: list[int | None], rounds: int) -> DataFrame:
    """(work, fold, trees) of every group of points and left-out fold (None: no fold left out).

    ``learned`` (row id, fold, label, x) is written once as bytes in the order of its ids; each
    work is a task that reads the files itself, so that rows aren't shuffled once per work.
    """
    groups = grid_groups(points)
    works = [(g * len(folds) + f, fold) for g in range(len(groups)) for f, fold in enumerate(folds)]
    # The deepest trees take longest, so they come first.
    works.sort(key=lambda w: -groups[w[0] // len(folds)][0]["max_depth"])
    widths, p = cuts.widths, len(cuts.edges)
    files = sorted(pin(binned(ordered(learned), cuts, (ROW_ID, "fold", "label")), "boost-binned").inputFiles())

    def fit(batches):
        for batch in batches:
            for k in batch["id"]:
                work, left_out = works[k]
                shared, members = groups[work // len(folds)]
                trees = grow(
                    *_outside(files, left_out, p), widths, shared["max_depth"], shared["subsample"], shared["colsample_bytree"],
                    np.array([float(points[i]["min_child_weight"]) for i in members]), np.array([points[i]["gamma"] for i in members]), rounds,
                )
                yield pd.DataFrame({"work": [work], "fold": [left_out], "trees": [trees.dump()]}).astype({"fold": "Int32"})

    dealt = learned.sparkSession.range(0, len(works), 1, len(works))
    return dealt.mapInPandas(fit, "work int, fold int, trees binary")


def boosted_grid(
    df: DataFrame, sample: DataFrame, n_features: int, grid: dict[str, list] = BOOSTED_GRID, folds: int = 5, rounds: int = ROUNDS
) -> DataFrame:
    """(grid_index, params, mean_score, std_score): recall of every grid point over the folds.

    ``df`` and ``sample`` have (row id, fold, label, features). Trees learn from the rows of
    ``sample`` outside a fold, which may be all of ``df``. All of ``df`` is scored, as far as
    recall asks: its positives. They travel as one byte per feature, packed, once per group of
    configurations, in blocks that don't grow with the data.
    """
    points = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    groups = grid_groups(points)
    rows = df.select(ROW_ID, "fold", F.col("label").cast("double").alias("label"), vector_to_array("features").alias("x"))
    learned = pin(sample.select(ROW_ID, "fold", F.col("label").cast("double").alias("label"), vector_to_array("features").alias("x")), "boost-sample")
    cuts = Bins.of(learned, n_features)
    trees = pin(fit_groups(learned, cuts, points, list(range(folds)), rounds), "boost-trees")
    positive = binned(rows.filter(F.col("label") == 1), cuts, (ROW_ID, "fold", "label"))
    held = pin(positive, "boost-held")
    blocks = max(1, math.ceil(held.count() / folds / BLOCK))
    asked = pin(packed(held, blocks), "boost-packed")
    works = trees.select(F.col("work").alias("asks"), F.col("fold").alias("of_fold"))
    dealt = asked.join(F.broadcast(works), F.col("fold") == F.col("of_fold")).select("asks", "block", "bins")
    models = trees.select("work", "trees", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>")).alias("block"))

    def score(model: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if model.empty or asked.empty:
            return pd.DataFrame({"work": [], "grid_index": [], "hits": [], "positives": []})
        work = int(model["work"].iloc[0])
        members = groups[work // folds][1]
        rows = np.concatenate([np.frombuffer(b, np.uint8) for b in asked["bins"]]).reshape(-1, n_features)
        found = (Trees.load(model["trees"].iloc[0]).margins(rows, len(members)) > 0).sum(axis=1)
        return pd.DataFrame({"work": work, "grid_index": members, "hits": found, "positives": len(rows)})

    hits = (
        models.groupBy("work", "block").cogroup(dealt.groupBy("asks", "block"))
        .applyInPandas(score, "work int, grid_index int, hits long, positives long")
    )
    found = hits.groupBy("grid_index", "work").agg((F.sum("hits") / F.sum("positives")).alias("found"))
    members = [(g * folds + f, f, i) for g, (_, of) in enumerate(groups) for f in range(folds) for i in of]
    every = df.sparkSession.createDataFrame(members, "work int, fold int, grid_index int")
    # A fold of rows without positives counts as 0, one without rows not at all.
    per_fold = every.join(rows.select("fold").distinct(), "fold").join(found, ["grid_index", "work"], "left")
    value = F.coalesce("found", F.lit(0.0))
    scores = per_fold.groupBy("grid_index").agg(F.avg(value).alias("mean_score"), F.stddev_pop(value).alias("std_score"))
    named = [(i, ", ".join(f"{k}={v}" for k, v in p.items())) for i, p in enumerate(points)]
    return df.sparkSession.createDataFrame(named, "grid_index int, params string").join(scores, "grid_index")


@dataclass
class BoostedModel:
    """One configuration's trees and the cut points they refer to."""

    cuts: Bins
    trees: bytes

    def to_table(self, spark) -> DataFrame:
        edges = [[float(e) for e in edge] for edge in self.cuts.edges]
        return spark.createDataFrame([(edges, bytearray(self.trees))], "edges array<array<double>>, trees binary")

    @staticmethod
    def from_table(table: DataFrame) -> "BoostedModel":
        row = table.first()
        return BoostedModel(Bins([np.array(e) for e in row["edges"]]), bytes(row["trees"]))

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` without its features, with ``probability`` and ``prediction``."""
        keep = [c for c in df.columns if c != "features"]
        schema = df.select(*keep).schema.add("probability", "double").add("prediction", "double")
        cuts, data = self.cuts, self.trees

        def score(batches):
            trees = Trees.load(data)
            for pdf in batches:
                if len(pdf):
                    margin = trees.margins(cuts.place(np.stack(pdf["x"].to_numpy())), 1)[0]
                    yield pdf[keep].assign(probability=1 / (1 + np.exp(-margin)), prediction=(margin > 0).astype(float))

        return df.select(*keep, vector_to_array("features").alias("x")).mapInPandas(score, schema)


def fit_boosted(sample: DataFrame, n_features: int, point: dict, rounds: int = ROUNDS) -> BoostedModel:
    """One grid point's trees, learned from all rows of a table."""
    learned = pin(sample.select(ROW_ID, F.lit(0).alias("fold"), F.col("label").cast("double").alias("label"), vector_to_array("features").alias("x")), "boost-sample")
    cuts = Bins.of(learned, n_features)
    return BoostedModel(cuts, bytes(fit_groups(learned, cuts, [point], [None], rounds).first()["trees"]))
