"""Dates: parsing, weeks, months, cut dates and zones."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordops.fixed_values import LOCAL_ZONE, MONTHS
from recordops.functions.nulls import ColumnOrName, col
from recordops.functions.text import lookup_value


def parse_date(c: ColumnOrName, pattern: str | None = None) -> Column:
    """Date of a text; NULL where it is not a date."""
    if pattern is None:
        return col(c).try_cast("date")
    return F.try_to_timestamp(col(c), F.lit(pattern)).cast("date")


def last_wednesday(c: ColumnOrName) -> Column:
    """Latest Wednesday strictly before a date."""
    return F.date_sub(F.next_day(F.date_sub(col(c), 1), "WE"), 7)


def last_wednesday_of(day: dt.date) -> dt.date:
    """The same for a plain date, used to build file names (A3)."""
    return day - dt.timedelta(days=(day.weekday() - 3) % 7 + 1)


def day_month(c: ColumnOrName) -> Column:
    return F.date_format(col(c), "dd_MM")


def week_start(c: ColumnOrName) -> Column:
    """Monday of the week."""
    return F.date_trunc("week", col(c)).cast("date")


def month_number(c: ColumnOrName) -> Column:
    """Number of a Spanish month name."""
    return lookup_value(c, MONTHS)


def month_start(year: ColumnOrName, month: ColumnOrName) -> Column:
    """First day of a month; NULL where a part is missing or wrong."""
    year, month = col(year).cast("int"), col(month).cast("int")
    possible = year.between(1, 9999) & month.between(1, 12)
    return F.when(possible, F.make_date(year, month, F.lit(1)))


def local_time(df: DataFrame, name: str, zone: str = LOCAL_ZONE) -> Column:
    """Wall clock time in a zone, whatever the session's zone is.

    Text and zoneless values already are wall clock time; instants are moved.
    """
    kind = dict(df.dtypes)[name]
    if kind == "timestamp":
        wall = F.col(name).cast("timestamp_ntz")
        return F.convert_timezone(F.current_timezone(), F.lit(zone), wall)
    return F.col(name).try_cast("timestamp_ntz")


def local_year(df: DataFrame, name: str, zone: str = LOCAL_ZONE) -> Column:
    return F.year(local_time(df, name, zone))


def in_local_year(df: DataFrame, name: str, year: int, zone: str = LOCAL_ZONE) -> Column:
    """Rows of one year by the local clock.

    For dates and times this is a range of the column itself, so that the scan
    can skip files and row groups.
    """
    kind = dict(df.dtypes)[name]
    if kind == "timestamp":
        first, after = (
            F.make_timestamp_ltz(*[F.lit(p) for p in (y, 1, 1, 0, 0, 0)], F.lit(zone))
            for y in (year, year + 1)
        )
    elif kind in ("timestamp_ntz", "date"):
        first, after = (F.lit(dt.date(y, 1, 1)).cast(kind) for y in (year, year + 1))
    else:
        return local_year(df, name, zone) == year
    return (F.col(name) >= first) & (F.col(name) < after)
