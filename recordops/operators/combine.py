"""Unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack(*frames: DataFrame) -> DataFrame:
    """Rows of all tables by column name; a missing column is NULL (G1)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def stack_same(*frames: DataFrame) -> DataFrame:
    """Rows of all tables by column name; the names must be the same."""
    names = set(frames[0].columns)
    for frame in frames[1:]:
        if set(frame.columns) != names:
            difference = sorted(names.symmetric_difference(frame.columns))
            raise ValueError(f"column names differ: {difference}")
    return reduce(lambda a, b: a.unionByName(b), frames)


def stack_by_position(*frames: DataFrame) -> DataFrame:
    """Rows of all tables by column position."""
    return reduce(lambda a, b: a.union(b), frames)


def stack_labelled(tables: dict[str, DataFrame], label: str) -> DataFrame:
    """Rows of all tables with the name of their table."""
    return stack(*[df.withColumn(label, F.lit(name)) for name, df in tables.items()])


def distinct_values(df: DataFrame, columns: list[str], name: str = "value") -> DataFrame:
    """Distinct values found in any of the columns, without NULL."""
    values = F.explode(F.array(*[F.col(c) for c in columns])).alias(name)
    return df.select(values).dropna().distinct()
