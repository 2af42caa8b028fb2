"""What several operators share: text columns, words and row keys."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The classes of characters that make words.
SPACED_WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def text_or_empty(text: str | Column = "text") -> Column:
    """A null text counts as an empty one."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay, whatever the locale."""
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SPACED_WORD)).cast("long")


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A digest of id and text: rows that share it are the same document.

    Ids may be null or repeated, so they can't key a join that must not multiply rows.
    """
    return F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("~")), F.lit("|"), text_or_empty(text)))


def spread_hash(key: str | Column, seed: str) -> Column:
    """A number in (0, 1) that depends on the seed and the key alone."""
    key = F.col(key) if isinstance(key, str) else key
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(key.cast("string"), F.lit("~")))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def same_columns(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like`` in their order; helpers that were added go."""
    return df.select(*[F.col(f"`{c}`") for c in like.columns])


SLICE_BYTES = 4 << 20  # of a column's values that are Python objects at a time


def slices(batch: pa.RecordBatch, over: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most ``SLICE_BYTES`` in column ``over``, one row at least."""
    size = max(batch.column(over).nbytes, 1)
    rows = max(1, batch.num_rows * SLICE_BYTES // size)
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def map_batches(
    df: DataFrame, start: Callable[[], Callable[[list], dict]], added: str, over: str = "text", keep: bool = False
) -> DataFrame:
    """Add columns computed from column ``over``, which is replaced by them unless ``keep``.

    ``start`` is called once per task and gives a function from values to new columns by
    name. The other columns pass as Arrow arrays, so null and large ids stay as they are.
    ``added`` is the new columns' schema.
    """
    kept = [c for c in df.columns if keep or c != over]
    schema = df.select(*[F.col(f"`{c}`") for c in kept]).schema
    fields = df.sparkSession.createDataFrame([], added).schema.fields
    for field in fields:
        schema = schema.add(field)
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(f.dataType) for f in fields]
        fn = start()
        for whole in batches:
            for batch in slices(whole, over):
                made = fn(batch.column(over).to_pylist())
                arrays = [batch.column(c) for c in kept] + [pa.array(made[n], t) for n, t in zip(names, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *names])

    return df.mapInArrow(run, schema)
