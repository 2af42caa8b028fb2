"""Matrices of sums over column pairs from one pass: what pairwise statistics are read from."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.scalars import quoted

CHUNK = 8_192  # rows of one product
MAX_COLUMNS = 1_000
CONSTANT = 1e-10  # a column varies if this share of its sum of squares isn't its mean's


def _flat(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _added(parts: DataFrame, width: int, kinds: int) -> np.ndarray:
    """The tasks' matrices, added up on the executors number by number."""
    cells = parts.select(F.posexplode("sums").alias("at", "value")).groupBy("at").agg(F.sum("value").alias("value"))
    out = np.zeros(kinds * width * width)
    for r in cells.filter(F.col("value") != 0).collect():
        out[r["at"]] = r["value"]
    return out.reshape(kinds, width, width)


def masked_gram(df: DataFrame, columns: list[str], shift: list[float]) -> np.ndarray:
    """Four matrices over column pairs (i, j) on rows where both are present.

    Their number, the sums of i, the sums of squares of i, and the sums of products, all
    of values less ``shift``. Each task multiplies its rows' value and presence matrices
    and gives one set of matrices, whatever its rows; the plan doesn't grow with the pairs.
    NaN counts as absent.
    """
    p = len(columns)
    if p > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} columns")
    gap = F.lit(None).cast("double")
    x = F.array(*[F.nanvl(quoted(c).cast("double") - F.lit(float(s)), gap) for c, s in zip(columns, shift, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, p, p))
        for batch in batches:
            values = _flat(batch.column("x"), p)
            for at in range(0, len(values), CHUNK):
                part = values[at : at + CHUNK]
                there = (~np.isnan(part)).astype(float)
                part = np.nan_to_num(part, nan=0.0)
                total += np.stack([there.T @ there, part.T @ there, (part * part).T @ there, part.T @ part])
        yield pa.RecordBatch.from_pydict({"sums": pa.array([total.ravel()])})

    return _added(df.select(x.alias("x")).mapInArrow(run, "sums array<double>"), p, 4)


def correlations(sums: np.ndarray) -> np.ndarray:
    """Pearson's r of each column pair; NaN where one of the two doesn't vary."""
    n, s, q, products = sums
    spread = n * q - s * s
    varies = (spread > CONSTANT * n * q) & (n > 1)
    usable = varies & varies.T
    with np.errstate(invalid="ignore", divide="ignore"):
        r = (n * products - s * s.T) / np.sqrt(spread * spread.T)
    return np.where(usable, r, np.nan)


def pair_table(df: DataFrame, columns: list[str], values: np.ndarray, name: str) -> DataFrame:
    """(left_column, right_column, name) of each pair, NULL for NaN."""
    rows = [
        (a, b, None if np.isnan(values[i, j]) else float(values[i, j]))
        for (i, a), (j, b) in combinations(list(enumerate(columns)), 2)
    ]
    return df.sparkSession.createDataFrame(rows, f"left_column string, right_column string, {name} double")


def pearson(df: DataFrame, columns: list[str], name: str = "pearson") -> DataFrame:
    """Pearson's r of each pair of numeric columns over the rows that have both."""
    means = df.agg(*[F.avg(F.nanvl(quoted(c).cast("double"), F.lit(None).cast("double"))).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return pair_table(df, columns, correlations(masked_gram(df, columns, [m or 0.0 for m in means])), name)


def null_patterns(df: DataFrame, columns: list[str]) -> DataFrame:
    """(gaps, n): which columns a row lacks, a 0 or 1 per column, and how many rows lack just these."""
    flags = F.concat(*[F.when(quoted(c).isNull(), "1").otherwise("0") for c in columns])
    return df.select(flags.alias("gaps")).groupBy("gaps").agg(F.count("*").alias("n"))


def nullity(df: DataFrame, columns: list[str]) -> DataFrame:
    """Correlation of the columns' is-missing flags, from the table of null patterns alone."""
    p = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, p, p))
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                texts = "".join(part.column("gaps").to_pylist()).encode()
                gaps = (np.frombuffer(texts, np.uint8) - ord("0")).reshape(-1, p).astype(float)
                n = part.column("n").to_numpy(zero_copy_only=False).astype(float)
                total[0] += n.sum()
                total[1] += (gaps * n[:, None]).T @ gaps
        yield pa.RecordBatch.from_pydict({"sums": pa.array([total.ravel()])})

    n, both = _added(null_patterns(df, columns).mapInArrow(run, "sums array<double>"), p, 2)
    single = np.repeat(np.diag(both)[:, None], p, axis=1)
    return pair_table(df, columns, correlations(np.stack([n, single, single, both])), "nullity_correlation")
