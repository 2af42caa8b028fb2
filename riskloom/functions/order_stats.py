"""Exact order statistics without sorting the table or holding it in one task."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.functions.scalars import quoted

MAX_GROUPS = 10_000
AT_ONCE = 64  # ranges that one pass tells apart
SAMPLED = 512  # values of a range that its cuts are drawn from


@dataclass
class _Range:
    """Rows of one group with values in [low, high], and the ranks wanted from them."""

    group: tuple
    low: object
    high: object
    rows: int
    before: int
    ranks: list[int] = field(default_factory=list)


def order_statistics(
    df: DataFrame,
    value: str,
    ranks: Callable[[int], list[int]],
    by: tuple[str, ...] = (),
    limit: int = 1_000_000,
    cuts: int = 64,
    max_groups: int = MAX_GROUPS,
) -> dict[tuple, tuple[int, dict[int, object]]]:
    """``{group: (n, {rank: value})}`` for zero-based ranks among non-null values.

    ``ranks`` maps a group's row count to the ranks wanted. Values may be of any type that
    Spark orders, in Spark's order: NaN comes last, text by bytes. Each round draws cut
    values from a small sample, counts what equals a cut and what lies between cuts, and
    keeps only the parts that hold a wanted rank, until those hold at most ``limit`` rows;
    only then are values sorted, after equal values have been counted together. The cuts
    only steer the search: any cuts give the same values. A round is a narrow scan with a
    partial aggregate, so a value held by a third of all rows costs one counter per task.
    """
    value_col = quoted(value)
    data = df.filter(value_col.isNotNull())
    sizes = (
        data.groupBy(*by)
        .agg(F.count("*").alias("n"), F.min(value_col).alias("low"), F.max(value_col).alias("high"))
        .limit(max_groups + 1)
        .collect()
    )
    if len(sizes) > max_groups:
        raise ValueError(f"more than {max_groups} groups")
    result: dict[tuple, tuple[int, dict[int, object]]] = {}
    pending = []
    for row in sizes:
        if row["n"] == 0:
            continue
        group = tuple(row[b] for b in by)
        wanted = sorted({r for r in ranks(row["n"]) if 0 <= r < row["n"]})
        result[group] = (row["n"], {})
        pending.append(_Range(group, row["low"], row["high"], row["n"], 0, wanted))

    pending = [r for r in pending if r.ranks]
    final = []
    while pending:
        wide = []
        for r in pending:
            if _order(r.low) == _order(r.high):
                result[r.group][1].update({k: r.low for k in r.ranks})
            elif r.rows <= limit:
                final.append(r)
            else:
                wide.append(r)
        pending = []
        for at in range(0, len(wide), AT_ONCE):
            pending += _narrow(data, value_col, by, wide[at : at + AT_ONCE], cuts)
    for at in range(0, len(final), AT_ONCE):
        _pick(data, value_col, by, final[at : at + AT_ONCE], result)
    return result


def _membership(value_col: Column, by: tuple[str, ...], r: _Range) -> Column:
    inside = value_col.between(F.lit(r.low), F.lit(r.high))
    for name, key in zip(by, r.group):
        inside = inside & quoted(name).eqNullSafe(F.lit(key))
    return inside


def _tag(value_col: Column, by: tuple[str, ...], ranges: list[_Range]) -> Column:
    chain = F.when(F.lit(False), F.lit(-1))
    for i, r in enumerate(ranges):
        chain = chain.when(_membership(value_col, by, r), F.lit(i))
    return chain


def _order(value: object) -> tuple:
    """A key that sorts values as Spark does."""
    if isinstance(value, float):
        return (math.isnan(value), 0.0 if math.isnan(value) else value)
    return (False, value.encode() if isinstance(value, str) else value)


def _cuts(tagged: DataFrame, ranges: list[_Range], wanted: int) -> list[list]:
    """Up to ``wanted`` cut values of each range, its least value among them."""
    share = F.when(F.lit(False), F.lit(0.0))
    for i, r in enumerate(ranges):
        share = share.when(F.col("tag") == i, F.lit(min(1.0, SAMPLED / r.rows)))
    drawn: list[dict] = [{_order(r.low): r.low} for r in ranges]
    for row in tagged.filter(F.rand(11) < share).collect():
        drawn[row["tag"]][_order(row["v"])] = row["v"]
    out = []
    for found in drawn:
        values = [found[k] for k in sorted(found)]
        step = max(1, -(-len(values) // wanted))
        out.append(values[::step])
    return out


def _narrow(data, value_col, by, ranges, cuts) -> list[_Range]:
    tagged = data.select(_tag(value_col, by, ranges).alias("tag"), value_col.alias("v")).filter(F.col("tag").isNotNull())
    chain = F.when(F.lit(False), F.lit(0))
    for i, values in enumerate(_cuts(tagged, ranges, cuts)):
        # Even numbers lie between cuts, odd ones equal a cut.
        held = F.array(*[F.lit(v) for v in values])
        spot = F.size(F.filter(held, lambda c: F.col("v") >= c)) + F.size(F.filter(held, lambda c: F.col("v") > c))
        chain = chain.when(F.col("tag") == i, spot)
    counted = (
        tagged.groupBy("tag", chain.alias("part"))
        .agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        .collect()
    )
    per_range: list[list] = [[] for _ in ranges]
    for row in counted:
        per_range[row["tag"]].append(row)
    out = []
    for r, rows in zip(ranges, per_range):
        before = r.before
        for row in sorted(rows, key=lambda x: x["part"]):
            inside = [k for k in r.ranks if before <= k < before + row["n"]]
            if inside:
                out.append(_Range(r.group, row["low"], row["high"], row["n"], before, inside))
            before += row["n"]
    return out


def _pick(data, value_col, by, ranges, result) -> None:
    running = W.partitionBy("tag").orderBy("v")
    counted = (
        data.select(_tag(value_col, by, ranges).alias("tag"), value_col.alias("v"))
        .filter(F.col("tag").isNotNull())
        .groupBy("tag", "v")
        .agg(F.count("*").alias("n"))
        .withColumn("upto", F.sum("n").over(running))
    )
    hit = F.lit(False)
    for i, r in enumerate(ranges):
        for k in r.ranks:
            local = k - r.before
            hit = hit | ((F.col("tag") == i) & (F.col("upto") > local) & (F.col("upto") - F.col("n") <= local))
    for row in counted.filter(hit).collect():
        r = ranges[row["tag"]]
        for k in r.ranks:
            if row["upto"] - row["n"] <= k - r.before < row["upto"]:
                result[r.group][1][k] = row["v"]


def quantiles(
    df: DataFrame, value: str, probs: list[float], by: tuple[str, ...] = (), limit: int = 1_000_000
) -> dict[tuple, list[float]]:
    """Exact quantiles per group with linear interpolation between neighbours."""

    def needed(n: int) -> list[int]:
        spots = [(n - 1) * p for p in probs]
        return [math.floor(s) for s in spots] + [math.ceil(s) for s in spots]

    out = {}
    for group, (n, found) in order_statistics(df, value, needed, by, limit).items():
        row = []
        for p in probs:
            spot = (n - 1) * p
            low, high = float(found[math.floor(spot)]), float(found[math.ceil(spot)])
            row.append(low + (high - low) * (spot - math.floor(spot)))
        out[group] = row
    return out


def column_quantiles(
    df: DataFrame, values: dict[str, Column], probs: list[float], limit: int = 1_000_000
) -> dict[str, list[float]]:
    """Exact quantiles of several expressions; columns without any value are left out.

    Values are selected by rounds of counting, whatever the number of rows.
    """
    cells = [F.struct(F.lit(n).alias("column"), v.cast("double").alias("value")) for n, v in values.items()]
    tall = df.select(F.explode(F.array(*cells)).alias("c")).select("c.column", "c.value")
    return {name: q for (name,), q in quantiles(tall, "value", probs, ("column",), limit).items()}
