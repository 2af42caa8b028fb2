"""Check rows against the fixed schema; keep the bad ones apart with their reasons."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.constants import APPLICATION_SCHEMA, TEXT_LENGTHS
from riskloom.functions.scalars import quoted


@dataclass
class Conformed:
    valid: DataFrame
    quarantine: DataFrame
    violations: DataFrame


def conform(
    df: DataFrame,
    schema: T.StructType = APPLICATION_SCHEMA,
    lengths: dict[str, int] = TEXT_LENGTHS,
) -> Conformed:
    """Cast to ``schema`` and enforce text lengths in one narrow pass.

    Every rule is a column expression, so the three outputs are filters and an
    aggregate over the same projection; nothing is shuffled but rule counts.
    """
    present = [f for f in schema if f.name in df.columns]
    checks = []
    for field in present:
        raw = quoted(field.name)
        if isinstance(field.dataType, T.NumericType):
            bad = raw.isNotNull() & raw.try_cast(field.dataType).isNull()
            checks.append(F.when(bad, F.lit(f"{field.name}:not_numeric")))
        if field.name in lengths:
            limit = lengths[field.name]
            checks.append(F.when(F.length(raw) > limit, F.lit(f"{field.name}:longer_than_{limit}")))
    judged = df.withColumn("violations", F.array_compact(F.array(*checks)))
    broken = F.size("violations") > 0
    return Conformed(
        valid=judged.filter(~broken).select(
            *[quoted(f.name).try_cast(f.dataType).alias(f.name) for f in present]
        ),
        quarantine=judged.filter(broken).withColumn("violations", F.concat_ws(",", "violations")),
        violations=judged.select(F.explode("violations").alias("violation"))
        .groupBy("violation")
        .agg(F.count("*").alias("n_rows")),
    )
