"""Rows by rank, whole-group values and ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordops.functions.nulls import ColumnOrName, nulls_last
from recordops.operators.columns import same_keys
from recordops.session import scratch_dir


def top_per_key(
    df: DataFrame, keys: list, order_by: list[ColumnOrName], n: int, rank: str = "rank"
) -> DataFrame:
    """The first `n` rows of each key with their rank.

    The filter directly on the row number lets every map task keep only its own
    first `n` rows of a key before the shuffle, so a hot key stays small. The
    order should end in a unique column.
    """
    window = Window.partitionBy(*keys).orderBy(*nulls_last(*order_by))
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def first_per_key(df: DataFrame, keys: list, order_by: list[ColumnOrName]) -> DataFrame:
    """One whole row per key, the first in a stated order."""
    return top_per_key(df, keys, order_by, 1, "_rank").drop("_rank")


def attach_group(df: DataFrame, keys: list[str], **values: Column) -> DataFrame:
    """Whole-group aggregates put on every row of the group.

    An aggregate joined back instead of a window: the aggregate is combined
    before its shuffle, and adaptive execution can split a hot key in the join,
    while a window would take the whole group into one task.
    """
    names = {k: f"_key_{i}" for i, k in enumerate(keys)}
    totals = df.groupBy(*keys).agg(*[v.alias(n) for n, v in values.items()])
    totals = totals.withColumnsRenamed(names)
    condition = same_keys(df, totals, list(names.items()))
    return df.join(totals, condition, "left").drop(*names.values())


def keep_groups(df: DataFrame, keys: list[str], condition: Column) -> DataFrame:
    """All rows of the groups in which the condition holds.

    `condition` is an aggregate, such as `any_true(..)` or `count(..) > 1`.
    """
    names = {k: f"_key_{i}" for i, k in enumerate(keys)}
    chosen = df.groupBy(*keys).agg(condition.alias("_keep")).filter("_keep")
    chosen = chosen.select(*keys).withColumnsRenamed(names)
    return df.join(chosen, same_keys(df, chosen, list(names.items())), "left_semi")


def _named(order_by: list[str]) -> list[str]:
    return [name.removeprefix("-") for name in order_by]


def _ranges(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Keys and order columns sorted into ranges, with the number of their range and their place in it.

    Written once to the shared folder: places and range sizes must come from the
    same ranges, also when an executor is lost. Only these columns are written;
    `_attached` takes the numbers to the whole rows. The order must be unique,
    which also keeps the ranges even.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, "ranges")
    order = [*nulls_last(*keys), *nulls_last(*order_by)]
    narrow = df.select(*dict.fromkeys([*keys, *_named(order_by)]))
    ranged = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.withColumn("_place", F.monotonically_increasing_id()).write.parquet(path)
    return spark.read.parquet(path).withColumns(
        {
            "_range": F.shiftright("_place", 33),
            "_place": F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)),
        }
    )


def _attached(df: DataFrame, numbered: DataFrame, name: str) -> DataFrame:
    """A number found for the keys and order columns, on the whole rows.

    Rows that agree in all of these share the lowest number.
    """
    columns = [c for c in numbered.columns if c != name]
    if set(df.columns) == set(columns):
        return numbered.select(*df.columns, name)
    numbered = numbered.groupBy(*columns).agg(F.min(name).alias(name))
    names = {c: f"_key_{i}" for i, c in enumerate(columns)}
    numbered = numbered.withColumnsRenamed(names)
    out = df.join(numbered, same_keys(df, numbered, list(names.items())))
    return out.select(*df.columns, name)


def _earlier_ranges(sizes: DataFrame, keys: list[str]) -> DataFrame:
    """Rows in the ranges before; `sizes` is at most a few rows per range."""
    earlier = Window.partitionBy(*keys).orderBy("_range")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_size").over(earlier), F.lit(0))
    return sizes.withColumn("_before", before).drop("_size")


def row_ids(df: DataFrame, order_by: list[str], name: str = "row_id") -> DataFrame:
    """Consecutive ids 1..n in a stated, unique order.

    The order columns are sorted into ranges, and the sizes of the ranges before
    are added to the place inside the range, so no task sees more than its own
    range; the whole rows are read once and meet their id by these columns.
    """
    ranged = _ranges(df, [], order_by)
    columns = [c for c in ranged.columns if not c.startswith(("_place", "_range"))]
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    # One row per range.
    out = ranged.join(_earlier_ranges(sizes, []), "_range")
    out = out.select(*columns, (F.col("_before") + F.col("_place") + 1).alias(name))
    return _attached(df, out, name)


def number_summary(df: DataFrame, order_by: list[ColumnOrName], name: str = "row_id") -> DataFrame:
    """Consecutive numbers for the rows of a summary, which are few: one per category or step (F2).

    One task sorts them; for tables of any length there is `row_ids`.
    """
    return df.withColumn(name, F.row_number().over(Window.orderBy(*nulls_last(*order_by))))


def rank_within(
    df: DataFrame, keys: list[str], order_by: list[str], rank: str = "rank"
) -> DataFrame:
    """Rank of every row in its group, in a stated, unique order.

    For ranks without an upper limit: a hot group lies in many ranges, each
    ranked by itself. Only the group a range begins with can have rows in an
    earlier range, so the rows to add are known from one group per range. The
    whole rows are read once and meet their rank by keys and order columns.
    """
    ranged = _ranges(df, keys, order_by)
    columns = [c for c in ranged.columns if not c.startswith(("_place", "_range"))]
    whole = Window.partitionBy("_range", *keys)
    ranged = ranged.withColumn("_first", F.min("_place").over(whole))
    names = {k: f"_key_{i}" for i, k in enumerate(keys)}
    heads = ranged.filter((F.col("_place") == 0) & (F.col("_range") > 0))
    heads = heads.select(*[F.col(k).alias(n) for k, n in names.items()]).distinct()
    # One group per range at most.
    same = same_keys(ranged, heads, list(names.items()))
    spread = ranged.join(heads, same, "left_semi")
    sizes = spread.groupBy("_range", *keys).agg(F.count(F.lit(1)).alias("_size"))
    before = _earlier_ranges(sizes, keys).filter(F.col("_before") > 0)
    before = before.withColumnsRenamed({**names, "_range": "_range_2"})
    same = same_keys(ranged, before, list(names.items()))
    same &= F.col("_range") == F.col("_range_2")
    out = ranged.join(before, same, "left")
    place = F.coalesce("_before", F.lit(0)) + F.col("_place") - F.col("_first") + 1
    return _attached(df, out.select(*columns, place.alias(rank)), rank)


def duplicate_group_ids(
    df: DataFrame, keys: list[str], name: str = "duplicates", size: str | None = None
) -> DataFrame:
    """A number for every group of repeated keys, 0 for keys that occur once (E5).

    Only the distinct repeated keys are numbered, in key order.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    repeated = row_ids(counted.filter("_n > 1"), keys, name)
    names = {k: f"_key_{i}" for i, k in enumerate(keys)}
    repeated = repeated.withColumnsRenamed(names)
    out = df.join(repeated, same_keys(df, repeated, list(names.items())), "left")
    columns = [F.coalesce(name, F.lit(0)).alias(name)]
    if size is not None:
        columns.append(F.coalesce("_n", F.lit(1)).alias(size))
    return out.select(*df.columns, *columns)
