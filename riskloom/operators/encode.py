"""Indicator (one-hot) encoding and banding."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.constants import AGE_EDGES, AGE_LABELS, PREFIXES, ROW_ID, TARGET, TARGET_COMPLEMENT, TARGET_LEVEL
from riskloom.functions.scalars import quoted
from riskloom.operators.columns import fill_missing, string_columns
from riskloom.session import pin

MAX_LEVELS = 1_000


@dataclass(frozen=True)
class Levels:
    """Sorted distinct values per column: the state an encoder learns."""

    values: dict[str, list[str]]

    def to_table(self, spark: SparkSession) -> DataFrame:
        rows = [(c, i, v) for c, levels in self.values.items() for i, v in enumerate(levels)]
        return spark.createDataFrame(rows, "column string, position int, level string")

    @staticmethod
    def from_table(df: DataFrame) -> "Levels":
        values: dict[str, list[str]] = {}
        for r in df.orderBy("column", "position").collect():
            values.setdefault(r["column"], []).append(r["level"])
        return Levels(values)


def fit_levels(df: DataFrame, columns: list[str], max_levels: int = MAX_LEVELS) -> Levels:
    """Distinct levels of all columns from one scan.

    Distinct runs as a partial aggregate per task, so a hot level costs one row per
    task. The number of rows brought back is bounded: past ``max_levels`` per column
    the fit refuses instead of collecting.
    """
    if not columns:
        return Levels({})
    pairs = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).alias("i"), quoted(c).cast("string").alias("level"))
                    for i, c in enumerate(columns)
                ]
            )
        ).alias("p")
    ).select("p.i", "p.level")
    bound = len(columns) * max_levels + 1
    found = pairs.filter(F.col("level").isNotNull()).distinct().limit(bound).collect()
    values: dict[str, list[str]] = {c: [] for c in columns}
    for row in found:
        values[columns[row["i"]]].append(row["level"])
    for c, levels in values.items():
        if len(levels) > max_levels or len(found) == bound:
            raise ValueError(f"too many levels to encode (limit {max_levels}): {c}")
        levels.sort()
    return Levels(values)


def indicator(column: str, level: str) -> Column:
    return F.coalesce((quoted(column) == F.lit(level)).cast("int"), F.lit(0))


def indicators(
    column: str, levels: list[str], prefix: str, drop_first: bool = True, null_level: bool = False
) -> dict[str, Column]:
    """Indicator name -> expression. Unseen levels are all zeros."""
    made = {f"{prefix}_{level}": indicator(column, level) for level in levels}
    if null_level:
        made[f"{prefix}_nan"] = quoted(column).isNull().cast("int")
    names = list(made)[1:] if drop_first else list(made)
    return {name: made[name] for name in names}


def one_hot_encoder(
    df: DataFrame, nan_as_category: bool = False, levels: Levels | None = None
) -> tuple[DataFrame, list[str]]:
    """Replace every string column by its indicators; returns the new column names too."""
    columns = string_columns(df)
    levels = levels or fit_levels(df, columns)
    made: dict[str, Column] = {}
    for c in columns:
        made.update(indicators(c, levels.values.get(c, []), c, True, nan_as_category))
    kept = [quoted(c) for c in df.columns if c not in columns]
    encoded = df.select(*kept, *[e.alias(name) for name, e in made.items()])
    return encoded, [c for c in encoded.columns if c not in df.columns]


def level_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, position, level): the sorted distinct values of each column, however many.

    Values are distinct per task before they are shuffled. Positions are dense and ascend
    by value from 0; they are counted in ranges of the values, so neither one task nor the
    driver sees a column's levels. A NULL is no level.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column"), quoted(c).cast("string").alias("level")) for c in columns])
    found = pin(df.select(F.inline(cells)).filter(F.col("level").isNotNull()).distinct(), "levels")
    ordered = found.repartitionByRange("column", "level").sortWithinPartitions("column", "level")
    numbered = pin(ordered.withColumn("serial", F.monotonically_increasing_id()), "levels")
    part, row = F.shiftright("serial", 33), F.col("serial").bitwiseAND((1 << 33) - 1)
    numbered = numbered.select("column", "level", part.alias("part"), row.alias("row"))
    # One row per partition and column.
    runs = numbered.groupBy("column", "part").agg(F.count("*").alias("here"), F.min("row").alias("first"))
    before = W.partitionBy("column").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    shifts = runs.select("column", "part", (F.coalesce(F.sum("here").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return numbered.join(shifts, ["column", "part"]).select("column", (F.col("row") + F.col("shift")).cast("int").alias("position"), "level")


def sparse_encode(df: DataFrame, columns: list[str], levels: DataFrame | None = None, row_id: str = ROW_ID) -> DataFrame:
    """(row id, size, ones): indicators of all ``columns`` side by side as a sparse vector.

    A column with m levels takes m - 1 places, as its first level has none; ``ones`` are the
    ascending places that hold a 1 and ``size`` counts all places, both zero-based as in
    ``one_hot_encoder`` over the same columns. Levels come from ``level_table`` (or from an
    earlier one: unseen levels and NULLs have no place). Rows meet the table by value, a join that
    is left to Catalyst's measured sizes, so any number of levels is encoded.
    """
    levels = pin(level_table(df, columns) if levels is None else levels, "level-table")
    order = F.array(*[F.lit(c) for c in columns])
    widths = levels.groupBy("column").agg((F.max("position")).alias("width"))
    # One number per column reaches the driver.
    width = {r["column"]: r["width"] for r in widths.collect()}
    starts, size = [], 0
    for c in columns:
        starts.append(size)
        size += width.get(c, 0)
    start = F.get(F.array(*[F.lit(s) for s in starts]), F.array_position(order, F.col("column")).cast("int") - 1)
    placed = levels.filter(F.col("position") > 0).select("column", "level", (start + F.col("position") - 1).alias("place"))
    cells = F.array(*[F.struct(F.lit(c).alias("column"), quoted(c).cast("string").alias("level")) for c in columns])
    met = df.select(row_id, F.inline(cells)).join(placed, ["column", "level"], "left")
    ones = F.array_sort(F.array_compact(F.collect_list("place"))).alias("ones")
    return met.groupBy(row_id).agg(ones).select(row_id, F.lit(size).alias("size"), "ones")


def bucketize(
    column: str,
    edges: list[float] = AGE_EDGES,
    labels: list[str] = AGE_LABELS,
    right_closed: bool = True,
) -> Column:
    """Text label of the band a number falls in; NULL outside all bands."""
    value = quoted(column)
    chain = F.when(F.lit(False), F.lit(None).cast("string"))
    for low, high, label in zip(edges, edges[1:], labels):
        inside = (value > low) & (value <= high) if right_closed else (value >= low) & (value < high)
        chain = chain.when(inside, F.lit(label))
    return chain


def prepare(df: DataFrame) -> DataFrame:
    """Fill gaps and add the age band where the data has none: the input of ``curate``."""
    filled = fill_missing(df)
    return filled if "age_cat" in df.columns else filled.withColumn("age_cat", bucketize("age"))


def curate(df: DataFrame, levels: Levels | None = None, prefixes: dict[str, str] = PREFIXES) -> DataFrame:
    """Null fill, age band, indicators for every category, source columns dropped.

    The learned levels are literals, so the whole step is one projection over the
    scan: no shuffle and no join back to the rows.
    """
    ready = prepare(df)
    present = {c: p for c, p in prefixes.items() if c in ready.columns}
    levels = levels or fit_levels(ready, list(present))
    made: dict[str, Column] = {}
    for c, prefix in present.items():
        made.update(indicators(c, levels.values.get(c, []), prefix, drop_first=c != "risk"))
    made.pop(TARGET_COMPLEMENT, None)
    if "risk" in present:  # also on a day without one of its classes
        made.setdefault(TARGET, indicator("risk", TARGET_LEVEL))
    kept = [quoted(c) for c in ready.columns if c not in present]
    return ready.select(*kept, *[e.alias(name) for name, e in made.items()])
