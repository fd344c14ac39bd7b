"""Missing values: membership, conditionals, sorting, text and aggregates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def member(c: ColumnOrName, values: Iterable) -> Column:
    """Membership that is false, not NULL, for a missing value."""
    return F.coalesce(col(c).isin(list(values)), F.lit(False))


def holds(condition: Column) -> Column:
    """A condition with unknown read as false."""
    return F.coalesce(condition, F.lit(False))


def strict_if(condition: Column, yes, no) -> Column:
    """Two-way choice that is NULL where the condition is unknown."""
    yes, no = (v if isinstance(v, Column) else F.lit(v) for v in (yes, no))
    return F.when(condition, yes).when(~condition, no)


def is_blank(c: ColumnOrName) -> Column:
    return col(c).isNull() | (F.trim(col(c)) == "")


def not_blank(c: ColumnOrName) -> Column:
    return ~is_blank(c)


def join_text(separator: str, *columns: ColumnOrName) -> Column:
    """Parts joined, missing parts left out; NULL when nothing is left (H9)."""
    return F.nullif(F.concat_ws(separator, *[col(c) for c in columns]), F.lit(""))


def nulls_last(*keys: ColumnOrName) -> list[Column]:
    """Sort keys with missing values last; a leading "-" means descending (F1)."""
    order = []
    for key in keys:
        if isinstance(key, Column):
            order.append(key)
        elif key.startswith("-"):
            order.append(F.col(key[1:]).desc_nulls_last())
        else:
            order.append(F.col(key).asc_nulls_last())
    return order


def value_order(c: ColumnOrName, values: list) -> Column:
    """Sort key that follows a given list; values outside it come last (F2)."""
    place = F.array_position(F.array(*[F.lit(v) for v in values]), col(c))
    return F.nullif(place, F.lit(0)).asc_nulls_last()


def any_true(condition: Column) -> Column:
    """True when any row of the group qualifies; unknown counts as false."""
    return F.coalesce(F.bool_or(condition), F.lit(False))


def distinct_with_null(c: ColumnOrName) -> Column:
    """Distinct count in which a missing value is one more value (D3)."""
    return F.count_distinct(col(c)) + F.coalesce(
        F.max(col(c).isNull().cast("int")), F.lit(0)
    )


def sum_or_zero(c: ColumnOrName) -> Column:
    """Sum that skips missing values and is 0 without any value."""
    return F.coalesce(F.sum(col(c)), F.lit(0).cast("int"))


def strict_sum(c: ColumnOrName) -> Column:
    """Sum that is NULL as soon as one value is missing."""
    return F.when(F.count(col(c)) == F.count(F.lit(1)), F.sum(col(c)))


def share_percent(condition: Column) -> Column:
    """Percentage of true values among the known ones."""
    return F.avg(condition.cast("double")) * 100
