"""Joins by key, by interval and by list.

Missing keys match missing keys unless `null_safe` is off. No side is forced
into a broadcast here: the optimiser broadcasts a side only when its measured
size is below `spark.sql.autoBroadcastJoinThreshold`, and shuffles otherwise.
The side that is only tested for existence is reduced to its distinct keys
first, so a key repeated many times travels once per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordops.operators.columns import same_keys, shared_columns
from recordops.operators.ranking import first_per_key

Keys = list[str | tuple[str, str]]

STRETCH = 60
LOOK_UP = 960


def key_pairs(keys: Keys) -> list[tuple[str, str]]:
    return [(k, k) if isinstance(k, str) else tuple(k) for k in keys]


def _aliased(right: DataFrame, pairs, null_safe: bool) -> tuple[DataFrame, list[str]]:
    """The right side with its keys under names that cannot clash."""
    names = [f"_right_{i}" for i in range(len(pairs))]
    right = right.withColumnsRenamed({r: n for (_, r), n in zip(pairs, names)})
    if not null_safe:
        right = right.dropna(subset=names)
    return right, names


def _condition(left: DataFrame, right: DataFrame, pairs, names) -> Column:
    return same_keys(left, right, [(l, n) for (l, _), n in zip(pairs, names)])


def matched(
    left: DataFrame, right: DataFrame, keys: Keys, null_safe: bool = True, unique: bool = False
) -> DataFrame:
    """Rows of the left whose keys occur on the right.

    `unique` tells that the right has one row per key, which saves reducing it;
    the result does not depend on it.
    """
    return _existence(left, right, keys, null_safe, unique, "left_semi")


def unmatched(
    left: DataFrame, right: DataFrame, keys: Keys, null_safe: bool = True, unique: bool = False
) -> DataFrame:
    """Rows of the left whose keys do not occur on the right.

    With `null_safe` off a missing key never matches, so such rows stay (C8, C10).
    """
    return _existence(left, right, keys, null_safe, unique, "left_anti")


def _existence(left, right, keys, null_safe, unique, how) -> DataFrame:
    pairs = key_pairs(keys)
    right = right.select(*[r for _, r in pairs])
    if not unique:
        right = right.distinct()
    right, names = _aliased(right, pairs, null_safe)
    return left.join(right, _condition(left, right, pairs, names), how)


def unmatched_on_shared(left: DataFrame, right: DataFrame) -> DataFrame:
    """Anti join on every column name both sides have."""
    return unmatched(left, right, shared_columns(left, right))


def lookup(
    left: DataFrame,
    catalogue: DataFrame,
    keys: Keys,
    how: str = "left",
    null_safe: bool = True,
    one_row_by: list | None = None,
) -> DataFrame:
    """Columns of a catalogue added by key.

    `one_row_by` orders the catalogue rows of a key and keeps only the first, so
    that no row is multiplied; without it a key with several rows fans out.
    """
    pairs = key_pairs(keys)
    if one_row_by is not None:
        catalogue = first_per_key(catalogue, [r for _, r in pairs], one_row_by)
    if how == "right":
        flipped = [(r, l) for l, r in pairs]
        out = lookup(catalogue, left, flipped, "left", null_safe)
        out = out.withColumnsRenamed({r: l for l, r in pairs})
        order = [*left.columns, *[c for c in out.columns if c not in left.columns]]
        return out.select(*order)
    catalogue, names = _aliased(catalogue, pairs, null_safe)
    return left.join(catalogue, _condition(left, catalogue, pairs, names), how).drop(*names)


def natural_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join on every column name both sides have."""
    return lookup(left, right, shared_columns(left, right), "inner")


def full_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    unique: bool = False,
    split_hot: bool = False,
) -> DataFrame:
    """Full outer join on equally named keys, missing keys matching (C4).

    `unique` tells that neither side has a key twice, missing keys included:
    then both sides are put under each other and grouped by key, which needs one
    exchange of the rows and reads each side once; the other columns must have
    different names. Otherwise it is a plain full outer join. That cannot be
    split when a key is hot; `split_hot` writes it as a left join plus the right
    rows without a partner, which can, at the price of reading both sides twice.
    """
    if unique:
        rest = [c for df in (left, right) for c in df.columns if c not in keys]
        both = left.unionByName(right, allowMissingColumns=True)
        return both.groupBy(*keys).agg(*[F.max(c).alias(c) for c in rest])
    if split_hot:
        left_part = lookup(left, right, keys)
        return left_part.unionByName(unmatched(right, left, keys), allowMissingColumns=True)
    pairs = key_pairs(keys)
    other, names = _aliased(right.withColumn("_right", F.lit(True)), pairs, null_safe=True)
    joined = left.withColumn("_left", F.lit(True))
    joined = joined.join(other, _condition(joined, other, pairs, names), "full")
    known = {k: F.when(F.col("_left"), F.col(k)).otherwise(F.col(n)) for (k, _), n in zip(pairs, names)}
    return joined.withColumns(known).drop(*names, "_left", "_right")


def flag_matches(
    left: DataFrame, right: DataFrame, keys: Keys, flag: str, null_safe: bool = True
) -> DataFrame:
    """A true/false column: do the keys occur on the right."""
    present = right.select(*[r for _, r in key_pairs(keys)]).distinct()
    present = present.withColumn(flag, F.lit(True))
    joined = lookup(left, present, keys, null_safe=null_safe)
    return joined.withColumn(flag, F.coalesce(flag, F.lit(False)))


def match_audit(
    left: DataFrame, right: DataFrame, keys: Keys, null_safe: bool = False
) -> DataFrame:
    """Total, matched and missing rows of the left, in one row."""
    hit = F.count_if(F.col("_hit"))
    return flag_matches(left, right, keys, "_hit", null_safe).agg(
        F.count(F.lit(1)).alias("total"),
        hit.alias("matched"),
        (F.count(F.lit(1)) - hit).alias("missing"),
    )


def cross_with(df: DataFrame, rows: list[dict]) -> DataFrame:
    """Every row combined with every row of a short literal list.

    The list is an array of structs inside the projection, so nothing is
    shuffled or joined.
    """
    fields = list(rows[0])
    literal = F.array(
        *[F.struct(*[F.lit(r[f]).alias(f) for f in fields]) for r in rows]
    )
    out = df.withColumn("_row", F.explode(literal))
    return out.select(*df.columns, *[F.col(f"_row.{f}") for f in fields])


def covered_days(intervals: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """The days covered by the intervals of a key, without loss, in few rows.

    Time is cut into stretches of 60 days. The intervals of a key that start in
    the same stretch become one row: a bit per covered day of the stretch, and
    the last end, up to which every day after the stretch is covered. However
    many intervals a key has, it keeps at most one row per stretch of the
    calendar, and they are combined before the shuffle.

    An interval that goes on into later parts of the calendar (of `LOOK_UP`
    days) is cut at their borders. All that reaches into a part starts in its
    first stretch then and is one row with the others that do, so a date, which
    is looked up by key and part, meets at most `LOOK_UP / STRETCH` rows.
    """
    first, last = (F.unix_date(F.col(n).cast("date")) for n in (start, end))
    spans = intervals.filter(F.col(start).cast("date") <= F.col(end).cast("date"))
    part = lambda day: F.floor(day / LOOK_UP).cast("int")
    spans = spans.select(
        *keys,
        first.alias("_first"),
        last.alias("_end"),
        F.explode(F.sequence(part(first), part(last))).alias("_part"),
    )
    low = F.greatest("_first", F.col("_part") * LOOK_UP)
    base = (F.floor(low / STRETCH) * STRETCH).cast("int")
    spans = spans.select(
        *keys,
        "_part",
        base.alias("_base"),
        (low - base).alias("_low"),
        F.least(F.col("_end"), (F.col("_part") + 1) * LOOK_UP - 1).alias("_last"),
    )
    high = F.least(F.col("_last") - F.col("_base"), F.lit(STRETCH - 1))
    one = F.lit(1).cast("bigint")
    run = F.call_function("shiftleft", one, high - F.col("_low") + 1) - one
    mask = F.call_function("shiftleft", run, F.col("_low"))
    return spans.groupBy(*keys, "_part", "_base").agg(
        F.bit_or(mask).alias("_mask"), F.max("_last").alias("_last")
    )


def _interval_existence(left, intervals, keys, date, start, end, how) -> DataFrame:
    pairs = key_pairs(keys)
    days = covered_days(intervals, [r for _, r in pairs], start, end)
    days, names = _aliased(days, pairs, null_safe=True)
    day = F.unix_date(F.col(date).cast("date"))
    part = F.floor(day / LOOK_UP).cast("int") == F.col("_part")
    place = day - F.col("_base")
    bit = F.call_function("shiftright", F.col("_mask"), place).bitwiseAND(F.lit(1)) == 1
    covered = F.when(place < STRETCH, bit).otherwise(day <= F.col("_last"))
    same = _condition(left, days, pairs, names) & part
    return left.join(days, same & (place >= 0) & covered, how)


def covered_by_interval(
    left: DataFrame, intervals: DataFrame, keys: Keys, date: str, start: str, end: str
) -> DataFrame:
    """Rows whose date lies in some interval [start, end] of the same keys (C11).

    Dates have the precision of a day. Nothing is multiplied: overlapping
    intervals are combined first, and the join only tests existence.
    """
    return _interval_existence(left, intervals, keys, date, start, end, "left_semi")


def not_covered_by_interval(
    left: DataFrame, intervals: DataFrame, keys: Keys, date: str, start: str, end: str
) -> DataFrame:
    """Rows whose date lies in no interval of the same keys."""
    return _interval_existence(left, intervals, keys, date, start, end, "left_anti")
