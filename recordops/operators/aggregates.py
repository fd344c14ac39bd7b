"""Grouped summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordops.fixed_values import TOTAL
from recordops.functions.nulls import ColumnOrName, col, distinct_with_null, sum_or_zero
from recordops.operators.columns import numeric_columns
from recordops.operators.ranking import keep_groups


def frequency(
    df: DataFrame,
    by: list[str],
    name: str = "n",
    largest_first: bool = False,
    keep_null: bool = True,
) -> DataFrame:
    """Rows per value (D1, D12); `keep_null` off leaves out missing values."""
    if not keep_null:
        df = df.dropna(subset=by)
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))
    if not largest_first:
        return counts
    return counts.orderBy(F.desc(name), *[F.asc_nulls_last(c) for c in by])


def sum_numeric(df: DataFrame, by: list[str], **labels: str) -> DataFrame:
    """Sum of every numeric column, 0 without values, with constant labels."""
    sums = [sum_or_zero(c).alias(c) for c in numeric_columns(df, skip=by)]
    constants = {k: F.lit(v) for k, v in labels.items()}
    return df.groupBy(*by).agg(*sums).withColumns(constants)


def with_totals(
    df: DataFrame, dims: list[str], measures: dict[str, Column], label: str = TOTAL
) -> DataFrame:
    """Detail rows, subtotals over the later dimensions and a grand total.

    One pass with `rollup`; `level` is the number of dimensions summed over.
    """
    depth = F.length(F.replace(F.bin(F.grouping_id()), F.lit("0"), F.lit("")))
    sums = [m.alias(n) for n, m in measures.items()]
    flags = [F.grouping(d).alias(f"_all_{d}") for d in dims]
    out = df.rollup(*dims).agg(*sums, depth.alias("level"), *flags)
    named = [
        F.when(F.col(f"_all_{d}") == 1, label).otherwise(F.col(d)).alias(d) for d in dims
    ]
    return out.select(*named, *measures, "level")


def with_group_total(counts: DataFrame, by: str, n: str, label: str = TOTAL) -> DataFrame:
    """A frequency table followed by its total row."""
    total = counts.agg(F.coalesce(F.sum(n), F.lit(0)).alias(n))
    return counts.select(by, n).unionByName(total.select(F.lit(label).alias(by), n))


def repeated_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys occur more than once."""
    return keep_groups(df, keys, F.count(F.lit(1)) > 1)


def surplus(c: ColumnOrName) -> Column:
    """Rows beyond the first of each value."""
    return F.count(F.lit(1)) - distinct_with_null(c)


def count_of_counts(df: DataFrame, by: list[str], name: str = "groups") -> DataFrame:
    """How many groups have how many rows."""
    return frequency(frequency(df, by, "n"), ["n"], name)


def pivot_values(
    df: DataFrame, by: list[str], over: str, values: list[str], measure: Column
) -> DataFrame:
    """One column per given value, 0 where nothing falls into it."""
    wide = df.groupBy(*by).pivot(over, values).agg(measure)
    return wide.fillna(0, subset=values)


def row_minimum(columns: list[str], skip_null: bool = True) -> Column:
    """Smallest value of a row (D23); the strict form is NULL if one is missing."""
    smallest = F.least(*columns) if len(columns) > 1 else F.col(columns[0])
    if skip_null:
        return smallest
    missing = [F.col(c).isNull() for c in columns]
    any_missing = missing[0]
    for m in missing[1:]:
        any_missing = any_missing | m
    return F.when(~any_missing, smallest)


def ordered_text(
    c: ColumnOrName, order: ColumnOrName, where: Column, separator: str = ", "
) -> Column:
    """Texts of the qualifying rows in order, '' when there are none.

    The group's texts end up in one value, so this is for groups whose number of
    rows is limited by design, such as the required roles of a team.
    """
    pairs = F.collect_list(F.when(where, F.struct(col(order).alias("o"), col(c).alias("t"))))
    return F.array_join(F.transform(F.array_sort(pairs), lambda p: p["t"]), separator)


def extent(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Smallest box around all points."""
    return df.agg(
        F.min(lon).alias("lon_min"),
        F.min(lat).alias("lat_min"),
        F.max(lon).alias("lon_max"),
        F.max(lat).alias("lat_max"),
    )


def stage_counts(
    df: DataFrame, stages: dict[str, Column], stage: str = "stage", n: str = "records"
) -> DataFrame:
    """Rows of each stage of a pipeline, in order, from one pass.

    A stage is the condition its rows meet; empty stages are listed with 0.
    """
    counts = df.agg(*[F.count_if(c).alias(f"_{i}") for i, c in enumerate(stages.values(), 1)])
    rows = [
        F.struct(
            F.lit(i).alias("position"), F.lit(name).alias(stage), F.col(f"_{i}").alias(n)
        )
        for i, name in enumerate(stages, 1)
    ]
    return counts.select(F.inline(F.array(*rows)))
